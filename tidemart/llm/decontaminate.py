"""Benchmark decontamination by winnowing (operator 10), in DataFrame functions only.

Texts become words, and every run of ``gram`` words a hash. Of each ``span`` consecutive words
the least hash is kept as fingerprint. Two texts that share ``span`` words in a row share that
window's fingerprint, so no shared span is missed. Fingerprints of documents and items are
joined; a document with a hit is read again, and each window whose fingerprint was hit is
compared word by word with the items' windows.

Items with fewer words than ``span`` are one window each; documents are indexed by every run
of that many words for them (only the lengths that occur, at most ``span - 1``).

The benchmark index is written before the join, so Spark broadcasts it only if its size on
disk is under its threshold and sorts and merges otherwise. Arrays are exploded by the outer
forms: for the others Spark adds a filter on the array's size, which it pushes below the
projections and so computes the arrays once more inside each other.

Null texts have no words; items without words match nothing. Items with a null id mark words
but are not listed. Repeated documents get equal rows, repeated items count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import left_join, stored, text_of

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case. ``lower`` is faster, and the same where all is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _gram_hashes(words: str, n: int) -> Column:
    rest = "".join(f", get({words}, i + {k})" for k in range(1, n))
    return F.expr(
        f"transform(slice({words}, 1, greatest(size({words}) - {n - 1}, 0)), "
        f"(w, i) -> xxhash64(w{rest}))"
    )


def _window_minima(hashes: str, width: int) -> Column:
    """The least of each ``width`` consecutive hashes; element i belongs to word i's window."""
    least = ", ".join(["x", *[f"get({hashes}, i + {k})" for k in range(1, width)]])
    return F.expr(
        f"transform(slice({hashes}, 1, greatest(size({hashes}) - {width - 1}, 0)), "
        f"(x, i) -> {f'least({least})' if width > 1 else 'x'})"
    )


def _indexed(rows: DataFrame, span: int, gram: int, lengths: list[int]) -> DataFrame:
    """``rows`` with ``words`` gets ``marks``: per window length an array of window marks.

    The mark of window i is its fingerprint (full span) or its hash (shorter lengths).
    """
    hashed = rows.withColumn("hashes", _gram_hashes("words", gram))
    marked = hashed.withColumn(f"marks_{span}", _window_minima("hashes", span - gram + 1))
    for n in lengths:
        marked = marked.withColumn(f"marks_{n}", _gram_hashes("words", n))
    return marked.drop("hashes")


def item_windows(benchmark: DataFrame, item_id: str, text: str, span: int, gram: int) -> DataFrame:
    """(item_id, n, mark, phrase): every window of every item, its mark and its words."""
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item_id"), words_of(text_of(text)).alias("words")
    ).where(F.size("words") > 0)
    short = items.where(F.size("words") < span).select(
        "item_id", F.size("words").alias("n"), F.array_join("words", " ").alias("phrase"), "words",
    ).select("item_id", "n", _whole_hash(span).alias("mark"), "phrase")
    full = _indexed(items.where(F.size("words") >= span), span, gram, []).select(
        "item_id", F.lit(span).alias("n"), F.posexplode_outer(f"marks_{span}").alias("at", "mark"), "words"
    ).select(
        "item_id", "n", "mark",
        F.expr(f"array_join(slice(words, at + 1, {span}), ' ')").alias("phrase"),
    )
    return full.unionByName(short)


def _whole_hash(span: int) -> Column:
    """The hash of all words of a row that has fewer than ``span``, as _gram_hashes gives it."""
    choice = F.lit(None).cast("long")
    for n in range(1, span):
        listed = ", ".join(f"get(words, {k})" for k in range(n))
        choice = F.when(F.col("n") == n, F.expr(f"xxhash64({listed})")).otherwise(choice)
    return choice


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", span: int = 10, gram: int = 5,
) -> DataFrame:
    """Per document the words inside benchmark windows and the items found."""
    windows = stored(item_windows(benchmark, item_id, item_text, span, gram).distinct(), "bench-windows")
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())  # at most ``span`` values
    short = [n for n in lengths if n < span]
    marks = stored(windows.select("n", "mark").distinct(), "bench-marks")
    phrases = windows.select("n", "mark", "phrase").distinct()

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("h"), text_of(text).alias("body")
    )
    indexed = _indexed(
        rows.select("doc_id", "h", words_of(F.col("body")).alias("words")), span, gram, short
    )
    found = None
    for n in [*short, span]:
        part = indexed.select(
            "doc_id", "h", F.lit(n).alias("n"), F.explode_outer(F.array_distinct(f"marks_{n}")).alias("mark")
        )
        found = part if found is None else found.unionByName(part)
    hits = found.join(marks, ["n", "mark"]).groupBy("doc_id", "h").agg(
        *[F.collect_set(F.when(F.col("n") == n, F.col("mark"))).alias(f"hit_{n}") for n in [*short, span]]
    )
    hits = stored(hits, "mark-hits")

    keys = hits.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), *[f"hit_{n}" for n in [*short, span]])
    again = rows.join(
        keys, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h"))
    ).drop("_d", "_h").withColumn("words", words_of(F.col("body"))).drop("body")
    again = _indexed(again, span, gram, short)
    starts = None
    for n in [*short, span]:
        part = again.select("doc_id", "h", F.lit(n).alias("n"), "words", F.expr(
            f"explode_outer(filter(transform(marks_{n}, (m, i) -> struct(i AS at, m AS mark)), "
            f"x -> array_contains(hit_{n}, x.mark)))"
        ).alias("w"))
        starts = part if starts is None else starts.unionByName(part)
    candidates = starts.select(
        "doc_id", "h", "n", "w.at", "w.mark", F.expr("array_join(slice(words, w.at + 1, n), ' ')").alias("phrase")
    ).distinct()
    occurring = stored(candidates.join(phrases, ["n", "mark", "phrase"]), "window-hits")

    covered = occurring.groupBy("doc_id", "h").agg(
        F.sort_array(F.collect_list(F.struct("at", (F.col("at") + F.col("n")).alias("end")))).alias("spans")
    ).select("doc_id", "h", F.expr(
        "aggregate(spans, struct(0L AS n, 0 AS e), (a, x) -> struct("
        "a.n + greatest(0, x.end - greatest(a.e, x.at)) AS n, greatest(a.e, x.end) AS e), a -> a.n)"
    ).alias("n_hit"))
    listed = occurring.select("doc_id", "h", "n", "mark", "phrase").distinct().join(
        windows.where(F.col("item_id").isNotNull()), ["n", "mark", "phrase"]
    ).select("doc_id", "h", "item_id").distinct().groupBy("doc_id", "h").agg(
        F.sort_array(F.collect_list("item_id")).alias("items")
    )
    base = rows.select("doc_id", "h", F.regexp_count("body", F.lit(_ANY_CASE_WORD)).cast("long").alias("n_words"))
    result = left_join(left_join(base, covered, ("doc_id", "h")), listed, ("doc_id", "h"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return result.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        items.alias("items"), (n_hit > 0).alias("contaminated"), "h",
    )
