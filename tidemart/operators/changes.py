"""Change events: normal form, rules, routing, and tables kept from changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemart import schemas
from tidemart.functions.once import once

# Operation letters of the capture tool.
OPERATIONS = {"c": "create", "r": "read", "u": "update", "d": "delete"}

TO_TOPIC, TO_DIMENSION = "kafka", "hbase"


def normalize(
    raw: DataFrame, value: str = "value", topic: str = "topic",
    map_read_to_insert: bool = True, keep: Sequence[str] = (),
) -> DataFrame:
    """Capture envelopes as (database, tableName, before, after, type).

    Database and table are the second and third part of the dotted topic. New rows are
    ``insert``; rows of the first snapshot are too, unless ``map_read_to_insert`` is
    off, when they stay ``read``. A missing image is an empty map.
    """
    event = F.from_json(value, schemas.RAW_CHANGE)
    op = F.lower(F.col("_e.op"))
    named: Column = op
    for letter, word in OPERATIONS.items():
        named = F.when(op == letter, F.lit(word)).otherwise(named)
    inserts = ["create", "read"] if map_read_to_insert else ["create"]
    kind = F.when(named.isin(inserts), F.lit("insert")).otherwise(named)
    parts = F.split(F.col(topic), "\\.")
    empty = F.create_map().cast(schemas.TEXT_MAP)
    return raw.select("*", once(event).alias("_e")).select(
        *keep,
        F.get(parts, F.lit(1)).alias("database"),
        F.get(parts, F.lit(2)).alias("tableName"),
        F.coalesce("_e.before", empty).alias("before"),
        F.coalesce("_e.after", empty).alias("after"),
        kind.alias("type"),
    )


def drop_deletes(changes: DataFrame) -> DataFrame:
    """Everything but deletes; an unknown operation is kept."""
    return changes.where(~F.col("type").eqNullSafe("delete"))


def latest_per_key(df: DataFrame, keys: Sequence[Column | str], order: str) -> DataFrame:
    """The last row of each key. One row per key and map task is shuffled."""
    last = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def rules_from_changes(changes: DataFrame, order: str = "offset") -> DataFrame:
    """Rule rows in force: the last change per source table and operation wins.

    Changes without a new image name no rule and are skipped.
    """
    fields = [F.col("after").getItem(name).alias(name) for name in schemas.RULE.fieldNames()]
    rows = changes.where(F.size("after") > 0).select(order, *fields)
    return latest_per_key(rows, ["source_table", "operate_type"], order).drop(order)


DELETED = "_deleted"


def _last_changes(changes: DataFrame, key: str, order: str) -> DataFrame:
    gone = F.col("type").eqNullSafe("delete")
    image = F.when(gone, F.col("before")).otherwise(F.col("after"))
    keyed = changes.withColumn("_image", image).withColumn(DELETED, gone)
    return latest_per_key(keyed, ["tableName", F.col("_image").getItem(key)], order)


def current_table(changes: DataFrame, key: str = "id", order: str = "offset") -> DataFrame:
    """Live rows of a changed table: the last change per key, unless it is a delete."""
    return _last_changes(changes, key, order).where(~F.col(DELETED)).drop("_image", DELETED)


def last_images(
    changes: DataFrame, schema: StructType, key: str = "id", order: str = "offset"
) -> DataFrame:
    """The last row of each changed key of one table, marked if the change deletes it."""
    last = _last_changes(changes, key, order)
    return last.select(
        *[F.col("_image").getItem(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields],
        DELETED,
    )


def keep_columns(after: Column | str, columns: Column | str) -> Column:
    """The entries of ``after`` that the comma list names, without trimming names."""
    after = F.col(after) if isinstance(after, str) else after
    columns = F.col(columns) if isinstance(columns, str) else columns
    listed = F.split(columns, ",")
    return F.map_filter(after, lambda name, _: F.array_contains(listed, name))


def route(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Changes that a rule names, cut to its columns, with its sink type and table.

    The rule table, which has a row per source table and operation, goes to every task. By
    estimates alone Spark may send the changes there, or deal them by table, of which one can hold
    nearly all. Without a rule a change is dropped. A rule is found whenever it arrived, since
    rules are read first.
    """
    named = rules.select(
        F.col("source_table").alias("tableName"), F.col("operate_type").alias("type"),
        "sink_type", F.col("sink_table").alias("sinkTable"), "sink_columns", "sink_pk",
    )
    joined = changes.join(F.broadcast(named), ["tableName", "type"], "inner")
    return joined.withColumn("after", keep_columns("after", "sink_columns")).drop("sink_columns")


def routed_facts(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sink_type") == TO_TOPIC).drop("sink_type")


def routed_dimensions(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sink_type") == TO_DIMENSION).drop("sink_type")


def dimension_schema(sink_columns: str, sink_pk: str | None = None) -> StructType:
    """All-text table shape of a rule; the key, ``id`` by default, is required."""
    key = sink_pk or "id"
    return StructType(
        [StructField(name, StringType(), name != key) for name in sink_columns.split(",")]
    )


def rule_shape(rules: DataFrame, sink_table: str) -> tuple[StructType, str]:
    """Shape and key of a dimension as its rules name them.

    All rules of a table agree; where one leaves the key out, another may give it.
    """
    rows = rules.where(F.col("sink_table") == sink_table).select("sink_columns", "sink_pk").distinct().collect()
    if not rows:
        raise ValueError(f"no rule names {sink_table}")
    columns = {row.sink_columns for row in rows}
    if len(columns) > 1:
        raise ValueError(f"rules of {sink_table} disagree: {sorted(columns)}")
    key = next((row.sink_pk for row in rows if row.sink_pk), "id")
    return dimension_schema(columns.pop(), key), key


def image_columns(df: DataFrame, schema: StructType, image: str = "after") -> DataFrame:
    """The map of a change as columns of the given shape."""
    return df.select(
        *[F.col(image).getItem(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def dimension_rows(
    routed: DataFrame, sink_table: str, sink_columns: str, sink_pk: str | None = None,
    order: str = "offset",
) -> DataFrame:
    """The dimension table a rule fills: the last image of each key."""
    return dimension_of(routed, sink_table, dimension_schema(sink_columns, sink_pk), sink_pk or "id", order)


def dimension_of(
    routed: DataFrame, sink_table: str, shape: StructType, key: str, order: str = "offset"
) -> DataFrame:
    """The last image of each key of a dimension, in the given shape."""
    key = F.col("after").getItem(key)
    mine = routed.where(F.col("sinkTable") == sink_table)
    return image_columns(latest_per_key(mine, [key], order), shape)


def upsert(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """``current`` with the rows of ``incoming``, which has one row per key, put in.

    Incoming rows marked as deleted take the row of their key away.
    """
    kept = current.join(incoming.select(key), key, "left_anti")
    if DELETED in incoming.columns:
        incoming = incoming.where(~F.coalesce(DELETED, F.lit(False))).drop(DELETED)
    return kept.unionByName(incoming)
