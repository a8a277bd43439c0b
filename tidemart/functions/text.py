"""Keyword tokens: letter and digit runs, and Han text cut by a word list.

The finest-grained mode is meant: a run such as ``256gb`` also gives its letter part
and its digit part, and overlapping words of the list are all given. A Han character
that no word covers is given alone. The word list is the caller's; none is shipped.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemart.functions.times import as_column

RUN = "[a-z0-9]+"
PART = "[a-z]+|[0-9]+"
MIXED = "[a-z][0-9]|[0-9][a-z]"
# Scripts written without spaces, all of their blocks.
HAN = "[\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsHangul}]"
HAN_RUN = HAN + "+"
HAN_SQL = HAN.replace("\\", "\\\\")


def letter_runs(text: Column | str) -> Column:
    """Array of the letter and digit runs of a text, lower-case."""
    return F.regexp_extract_all(F.lower(as_column(text)), F.lit(RUN), F.lit(0))


def run_tokens(run: Column | str) -> Column:
    """Array of the tokens of one run: itself and, if it is mixed, its parts."""
    run = as_column(run)
    parts = F.regexp_extract_all(run, F.lit(PART), F.lit(0))
    return F.when(run.rlike(MIXED), F.concat(F.array(run), parts)).otherwise(F.array(run))


def han_tokens(df: DataFrame, text: str, words: DataFrame, keyword: str) -> DataFrame:
    """One row per token of the Han runs of ``df[text]``.

    Every part of a run that is as long as some word is joined with the list as a whole, so
    neither side is collected and a part meets its own word alone. Coverage is decided inside one run of one text, a group no key can make large.
    """
    # The row id exists so that two equal texts stay two rows. It is recomputed
    # nowhere: every later step works on this one frame.
    tagged = df.withColumn("_row", F.monotonically_increasing_id())
    runs = tagged.select(
        "*",
        F.posexplode(F.regexp_extract_all(F.col(text), F.lit(HAN_RUN), F.lit(0)))
        .alias("_run_no", "_run"),
    )
    spots = runs.select("*", F.explode(F.sequence(F.lit(1), F.length("_run"))).alias("_pos"))
    spots = spots.withColumn("_char", F.col("_run").substr(F.col("_pos"), F.lit(1)))
    listed = words.select(F.col(words.columns[0]).alias("_word")).where("_word != ''").distinct()
    # As many values as the longest word has characters, at most.
    sizes = [r.n for r in listed.select(F.length("_word").alias("n")).distinct().collect()]
    fitting = F.filter(
        F.array(*[F.lit(n) for n in sorted(sizes) or [0]]),
        lambda n: (n > 0) & (F.col("_pos") + n - 1 <= F.length("_run")),
    )
    parts = spots.select("*", F.explode_outer(fitting).alias("_size")).withColumn(
        "_part", F.col("_run").substr(F.col("_pos"), F.coalesce("_size", F.lit(0)))
    )
    found = parts.join(listed, F.col("_part") == F.col("_word"), "left")
    # A position is one row for each word that begins there, or one without a word.
    first = F.coalesce("_size", F.lit(0)) == F.coalesce(
        F.min("_size").over(Window.partitionBy("_row", "_run_no", "_pos")), F.lit(0))
    words_here = F.count("_word").over(Window.partitionBy("_row", "_run_no", "_pos"))
    found = found.withColumns({"_some": words_here, "_lead": first})
    matched = found.where(F.col("_word").isNotNull() | ((F.col("_some") == 0) & F.col("_lead")))
    reach = F.max(F.col("_pos") + F.length("_word")).over(
        Window.partitionBy("_row", "_run_no").orderBy("_pos")
    )
    matched = matched.withColumn("_reach", reach)
    alone = F.col("_reach").isNull() | (F.col("_reach") <= F.col("_pos"))
    token = F.coalesce("_word", F.when(alone, F.col("_char")))
    return matched.withColumn(keyword, token).where(F.col(keyword).isNotNull()).select(
        *df.columns, keyword
    )


def keyword_rows(
    df: DataFrame, text: str, keyword: str = "keyword", words: DataFrame | None = None
) -> DataFrame:
    """One row per token; texts without a token vanish. Without words each Han character is one."""
    tokens = F.flatten(F.transform(letter_runs(text), run_tokens))
    if words is None:
        # Text of one byte a character has no Han and need not be searched for it.
        plain = F.length(text) == F.octet_length(text)
        alone = F.when(plain, F.array().cast("array<string>")).otherwise(
            F.regexp_extract_all(F.col(text), F.lit(HAN), F.lit(0)))
        return df.select("*", F.explode(F.concat(tokens, alone)).alias(keyword))
    found = df.select("*", F.explode(tokens).alias(keyword))
    return found.unionByName(han_tokens(df, text, words, keyword))


def register_keyword_function(spark: SparkSession, name: str = "keyword_tokens") -> None:
    """Table function for SQL: ``from t, lateral keyword_tokens(t.text)``.

    It is an SQL function, so it becomes a generator in the plan and no Python worker is
    started. One generator is used and not two, which keeps the watermark of a stream.
    """
    spark.sql(
        f"""
        create or replace temporary function {name}(txt string)
        returns table (keyword string)
        return select explode(concat(flatten(transform(
            regexp_extract_all(lower(txt), '{RUN}', 0),
            run -> case when run rlike '{MIXED}'
                        then concat(array(run), regexp_extract_all(run, '{PART}', 0))
                        else array(run) end)),
            case when length(txt) = octet_length(txt) then cast(array() as array<string>)
                 else regexp_extract_all(txt, '{HAN_SQL}', 0) end))
        """
    )


def word_list(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    schema = StructType([StructField("word", StringType())])
    return spark.createDataFrame([(word,) for word in words], schema)
