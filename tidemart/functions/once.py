"""Evaluate an expression once per row, however often its parts are used."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def once(value: Column) -> Column:
    """``value`` through a one-element generator, for use alone in a ``select``.

    Filters, join keys and inferred not-null checks on the parts of a parsed text are
    pushed below a plain projection, and each then parses the text again. They cannot
    pass a generator, so the text is parsed once.
    """
    return F.explode(F.array(value))
