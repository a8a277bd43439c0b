"""Visit rates for the new-versus-returning report; zero where nothing was visited."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_WIDE = "decimal(20,0)"


def _divide(numerator: Column, visits: Column, digits: int) -> Column:
    # Decimal division keeps more digits than are asked for, so rounding is half-up
    # on the exact quotient.
    return F.round(numerator.cast(_WIDE) / visits.cast(_WIDE), digits)


def _guarded(value: Column, uv: Column, sv: Column) -> Column:
    safe = (F.coalesce(uv, F.lit(0)) != 0) & (F.coalesce(sv, F.lit(0)) != 0)
    return F.when(safe, value).otherwise(F.lit(0)).cast("decimal(20,2)")


def bounce_rate(uj: Column, sv: Column, uv: Column) -> Column:
    """Bounces per hundred visits, two digits."""
    return _guarded(_divide(uj * 100, sv, 2), uv, sv)


def seconds_per_visit(dur_ms: Column, sv: Column, uv: Column) -> Column:
    """Whole milliseconds per visit, then seconds with one digit."""
    return _guarded(F.round(_divide(dur_ms, sv, 0) / 1000, 1), uv, sv)


def pages_per_visit(pv: Column, sv: Column, uv: Column) -> Column:
    return _guarded(_divide(pv, sv, 2), uv, sv)
