"""App log: parsing, the dirty table, new-visitor repair and the page/start/display split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemart import schemas
from tidemart.functions.once import once

_BROKEN = "_broken"


def parse_log(raw: DataFrame, value: str = "value") -> DataFrame:
    """Each line with its record fields at top level and the ``reason`` why it is dirty.

    Dirty are lines that are no JSON record of this shape, and records without ``common``
    or, unless they are start records, without ``page``, and records without a time, which
    no later step could place. Good lines have no reason.
    """
    schema = StructType([*schemas.APP_LOG.fields, StructField(_BROKEN, StringType())])
    record = F.from_json(value, schema, {"columnNameOfCorruptRecord": _BROKEN})
    parsed = raw.select("*", once(record).alias("_log"))
    reason = (
        F.when(F.col("_log").isNull() | F.col(f"_log.{_BROKEN}").isNotNull(), "not_json")
        .when(F.col("_log.common").isNull(), "no_common")
        .when(F.col("_log.page").isNull() & F.col("_log.start").isNull(), "no_page")
        .when(F.col("_log.ts").isNull(), "no_ts")
    )
    fields = [F.col(f"_log.{name}").alias(name) for name in schemas.APP_LOG.fieldNames()]
    return parsed.select(*raw.columns, reason.alias("reason"), *fields)


def dirty_lines(parsed: DataFrame) -> DataFrame:
    """Bad lines as they came, with the reason."""
    return parsed.where(F.col("reason").isNotNull()).drop(*schemas.APP_LOG.fieldNames())


def clean_logs(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Good records, without the text they were parsed from."""
    return parsed.where(F.col("reason").isNull()).drop("reason", value)


def repair_new_flag(logs: DataFrame, order: tuple[str, str] = ("ts", "event_id")) -> DataFrame:
    """Only the first record of a visitor that claims ``is_new = '1'`` keeps it.

    Records with another flag pass as they are: they are neither shuffled nor joined. The
    first claim of each visitor is found by two aggregates that combine before their
    shuffle, the least number per visitor and time and then the least time per visitor, and
    is joined back on visitor, time and number together. So a visitor with very many records
    is neither sorted in one task nor joined in one. A claim without a time comes last.
    """
    mid, flag = F.col("common.mid"), F.col("common.is_new")
    time, number = order
    claims, rest = logs.where(flag == "1"), logs.where(~flag.eqNullSafe("1"))
    late = F.coalesce(F.col(time), F.lit((1 << 63) - 1))
    firsts = (
        claims.groupBy(mid.alias("_mid"), late.alias("_late")).agg(F.min(number).alias("_n"))
        .groupBy("_mid").agg(F.min_by("_n", "_late").alias("_number"), F.min("_late").alias("_time"))
        .withColumn("_is_first", F.lit(True))
    )
    match = (
        mid.eqNullSafe(F.col("_mid")) & (late == F.col("_time"))
        & F.col(number).eqNullSafe(F.col("_number"))
    )
    joined = claims.join(firsts, match, "left")
    kept = F.when(F.col("_is_first"), "1").otherwise("0")
    repaired = joined.withColumn("common", F.col("common").withField("is_new", kept))
    return rest.unionByName(repaired.select(*logs.columns))


def start_logs(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("start").isNotNull())


def page_logs(logs: DataFrame) -> DataFrame:
    """Everything that is not a start record, page or no page."""
    return logs.where(F.col("start").isNull()).drop("start")


def display_logs(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per shown item, with the page id and time of its page."""
    return pages.select(
        *keep, F.explode("displays").alias("_d"),
        F.col("page.page_id").alias("page_id"), "ts",
    ).select(*keep, "_d.*", "page_id", "ts")


def fan_out(parsed: DataFrame, topics: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """(topic, value) rows for the page, start, display and dirty topics, in one pass.

    Every line becomes an array of the messages it causes, which is then exploded. So the
    text is parsed once and one sink with a topic column, or one file sink partitioned by
    topic, writes all outputs; nothing is cached and no second query is needed.
    ``parsed`` is the result of ``parse_log``, with the new flag repaired or not.
    """

    def message(kind: str, value: Column) -> Column:
        return F.struct(F.lit(topics[kind]).alias("topic"), value.alias("value"))

    fields = ["common", "page", "displays", "ts"]
    shown = F.transform(
        F.coalesce(F.col("displays"), F.array()),
        lambda d: message("display", F.to_json(F.struct(
            d["item"].alias("item"), d["item_type"].alias("item_type"),
            F.col("page.page_id").alias("page_id"), F.col("ts").alias("ts"),
        ))),
    )
    start = F.try_parse_json("start").alias("start")
    messages = (
        F.when(F.col("reason").isNotNull(), F.array(message("dirty", F.col("value"))))
        .when(
            F.col("start").isNotNull(),
            F.array(message("start", F.to_json(F.struct(*fields, start)))),
        )
        .otherwise(F.concat(F.array(message("page", F.to_json(F.struct(*fields)))), shown))
    )
    return parsed.select(*keep, F.explode(messages).alias("_m")).select(*keep, "_m.*")


def to_json_rows(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row as one JSON text, the form every topic carries."""
    return df.select(*keep, F.to_json(F.struct(*df.columns)).alias(value))
