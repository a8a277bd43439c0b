"""A training corpus from raw documents: five stages, each written and read again.

A stage takes (spark, documents, folder of tables) and returns what it keeps; its decisions
act on its own input. All but the last return the columns of documents; the last returns the
packed pieces. A stage may be run alone on any table with the columns doc_id, text and lang.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.llm import decontaminate, langid, packing, secrets, simhash
from tidemart.llm.common import stored, table, text_of, unused
from tidemart.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are like no language of the labelled ones; write the language found."""
    (found,) = unused(docs.columns, "_lang")
    known = langid.identified(docs, into=found)
    columns = [F.col(f"{found}.lang_pred").alias("lang") if c == "lang" else F.col(f"`{c}`") for c in docs.columns]
    return known.where(~F.col(f"{found}.rejected")).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of near copies, once if it is repeated.

    It is the one with the least id, missing ids last, and of equal ids the least hash of the text.
    """
    (name,) = unused(docs.columns, "__key")
    number = F.col("doc_id")
    key = F.struct(number.isNull().alias("none"), number.alias("id"), F.xxhash64(text_of("text")).alias("hash"))
    keyed = docs.withColumn(name, key)
    found = simhash.near_duplicates(keyed, name)
    first = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(name)).distinct()
    return _columns(keyed.join(first, name, "left_semi").dropDuplicates([name]), docs)


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    d, h, own = unused(docs.columns, "_d", "_h", "__h")
    bad = found.where("contaminated").select(F.col("doc_id").alias(d), F.col("h").alias(h)).distinct()
    keyed = docs.withColumn(own, F.xxhash64(text_of("text")))
    return _columns(keyed.join(bad, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(own) == F.col(h)), "left_anti"), docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by their kind; ``n_chars`` follows the text."""
    clean = secrets.redacted(docs)
    columns = [
        F.length("text").cast(clean.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return clean.select(*columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences for training: pieces with their sequence and place."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language), ("near_dedup", near_duplicates), ("decontaminate", decontaminated),
    ("secret_scan", redacted), ("pack", packed),
]

#: The stages hash with XXH64 and tokenize, which SQL has no words for.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
