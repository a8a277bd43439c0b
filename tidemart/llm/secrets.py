"""Secret scans with linked parts (operator 3), in DataFrame functions only.

Strong parts (assignments, access keys, long hex runs) are always reported. Weak parts are
reported only where complementary parts are near: an opaque token or an account name alone
means little, together they are a credential.

``ident`` needs a secret part, ``opaque`` an identifier part, ``endpoint`` both, each with its
start within ``reach`` code points in the same document. The interval join runs on slices of
``reach`` points: complements are first reduced to the first and last start per slice, which
decides exactly whether one is in reach, so a part meets at most three rows per role however
many parts a document holds.

Places come from the lengths of matches and of the text between them, summed over the
matches of a document. Places are in code points, ends exclusive. Null texts are empty.
Repeated rows get equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemart.functions.once import once
from tidemart.llm.common import left_join, stored, text_of, unused

REACH = 400


def _any_case(words: str) -> str:
    """A pattern's ASCII letters in either case, without flags that engines read differently."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() and c.isascii() else c for c in words)


_SEPARATOR = r"""["']?\x20*[:=]\x20*["']?"""
# Kind, pattern, and the condition on a match ``m`` and its second group ``v``. The order of
# the kinds is part of the result.
KINDS: tuple[tuple[str, str, str], ...] = (
    ("assign", "(" + _any_case("password|passwd|secret|token|api_?key") + ")" + _SEPARATOR
     + r"([A-Za-z0-9+/_.=-]+)", "length(v) >= 6"),
    ("access", r"AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", r"[0-9a-f]{24,}", "true"),
    ("ident", "(" + _any_case("user(?:name)?|login|account|client_?id") + ")" + _SEPARATOR
     + r"([A-Za-z0-9+/_.=@-]+)", "length(v) >= 3"),
    ("opaque", r"[A-Za-z0-9+/_-]{32,}", "m rlike '[0-9]' AND m rlike '[a-z]' AND m rlike '[A-Z]'"),
    ("endpoint", r"""[a-z]+://[^\x20\x09-\x0D"'<>]+""", "true"),
)
STRONG = ("assign", "access", "hex")
ROLES = {
    "assign": "secret", "hex": "secret", "opaque": "secret",
    "access": "ident", "ident": "ident", "endpoint": "endpoint",
}
NEEDS = {"ident": ("secret",), "opaque": ("ident",), "endpoint": ("ident", "secret")}
_ORDER = {kind: place for place, (kind, _, _) in enumerate(KINDS)}
_KEY = ("doc_id", "h")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(kind: str, pattern: str, condition: str) -> str:
    """SQL: the matches of a kind as structs of place in line, gap before, length, verdict."""
    p = _quoted(pattern)
    values = f"regexp_extract_all(body, {p}, 2)" if "(v)" in condition else "array('')"
    return (
        f"if(body rlike {p}, zip_with(zip_with("
        f"regexp_extract_all(body, {p}, 0), {values}, (m, v) -> struct(length(m) AS n, {condition} AS ok)), "
        f"split(body, {p}, -1), (x, g) -> struct({_ORDER[kind]} AS kind, length(g) AS gap, x.n AS n, x.ok AS ok)), "
        f"array())"
    )


def parts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, h, kind, start, end): every candidate part, strong or weak."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("h"), text_of(text).alias("body")
    )
    found = rows.select("doc_id", "h", F.array(*[F.expr(_found(*kind)) for kind in KINDS]).alias("found"))
    one = found.select("doc_id", "h", F.explode_outer("found").alias("matches")).select(
        "doc_id", "h", F.posexplode_outer("matches").alias("k", "m")
    ).select("doc_id", "h", "k", "m.*").where(F.col("n").isNotNull()).dropDuplicates(["doc_id", "h", "kind", "k"])
    # The last element of a split is the text after the last match, which has no length.
    so_far = Window.partitionBy("doc_id", "h", "kind").orderBy("k")
    placed = one.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far))
    names = F.array(*[F.lit(kind) for kind, _, _ in KINDS])
    return placed.where("ok").select(
        "doc_id", "h", F.get(names, F.col("kind")).alias("kind"),
        (F.col("end") - F.col("n")).alias("start"), "end",
    )


def linked(candidates: DataFrame, reach: int = REACH) -> DataFrame:
    """The strong parts, and the weak ones whose complements lie within ``reach``.

    Weak parts that overlap a strong one are part of it and are not given again.
    """
    role = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    own = candidates.withColumns({
        "role": role[F.col("kind")], "slice": F.floor(F.col("start") / reach),
        "strong": F.col("kind").isin(*STRONG),
    })
    # Both frames reach back to the partition's edge, so that Spark keeps a running value: the
    # greatest end of the strong parts that start before, and the least start of those that start after.
    before = Window.partitionBy(*_KEY).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*_KEY).orderBy(F.desc("start"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumns({
        "inside": F.coalesce(F.max(F.when(F.col("strong"), F.col("end"))).over(before) > F.col("start"), F.lit(False)),
        "around": F.coalesce(F.min(F.when(F.col("strong"), F.col("start"))).over(after) < F.col("end"), F.lit(False)),
    })
    weak = own.where(~F.col("strong") & ~F.col("inside") & ~F.col("around"))
    slices = own.where("strong OR NOT (inside OR around)").groupBy(*_KEY, "role", "slice").agg(
        F.min("start").alias("first"), F.max("start").alias("last")
    ).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), F.col("role").alias("other"),
             F.col("slice").alias("near"), "first", "last")
    asked = weak.select(
        *_KEY, "kind", "start", "end", "slice", "role",
        F.explode(F.sequence(F.col("slice") - 1, F.col("slice") + 1)).alias("asked"),
    )
    in_reach = asked.join(
        slices,
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")) & (F.col("asked") == F.col("near"))
        & (F.col("role") != F.col("other"))
        & ((F.col("asked") >= F.col("slice")) | (F.col("last") >= F.col("start") - reach))
        & ((F.col("asked") <= F.col("slice")) | (F.col("first") <= F.col("start") + reach)),
    )
    have = in_reach.groupBy(*_KEY, "kind", "start", "end").agg(
        *[F.max(F.col("other") == name).alias(f"has_{name}") for name in ("ident", "secret")]
    )
    enough = F.lit(False)
    for kind, needs in NEEDS.items():
        ok = F.col("kind") == kind
        for name in needs:
            ok = ok & F.col(f"has_{name}")
        enough = enough | ok
    shown = ["doc_id", "h", "kind", "start", "end"]
    return own.where("strong").select(*shown).unionByName(have.where(enough).select(*shown))


def spans_by_document(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """(doc_id, h, spans): sorted spans of the documents that have any.

    A span carries ``seen``, the greatest end before it, so that overlaps can be cut in one pass.
    """
    place = F.create_map(*[F.lit(x) for kind, at in _ORDER.items() for x in (kind, at)])
    order = Window.partitionBy(*_KEY).orderBy("start", "place").rowsBetween(Window.unboundedPreceding, -1)
    # The parts are few and read several times; the texts are matched once.
    found = stored(parts(docs, doc_id, text), "secret-parts")
    rows = linked(found, reach).withColumn("place", place[F.col("kind")])
    return rows.withColumn("seen", F.coalesce(F.max("end").over(order), F.lit(0).cast("long"))).groupBy(*_KEY).agg(
        F.sort_array(F.collect_list(F.struct("start", "place", "kind", "end", "seen"))).alias("spans")
    )


def with_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """(doc_id, h, spans) for every document row; ``spans`` is empty where nothing was found."""
    found = spans_by_document(docs, doc_id, text, reach)
    keys = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("h"))
    return left_join(keys, found, _KEY).withColumn(
        "spans", F.coalesce("spans", F.expr("filter(array(struct(0L AS start, 0 AS place, '' AS kind, 0L AS end, 0L AS seen)), x -> false)"))
    )


_CHUNK = 1024


def _between(cells: str, start: str, end: str) -> str:
    """SQL: the characters of a text in chunks from ``start`` to ``end``, exclusive."""
    first, last = f"cast(({start}) div {_CHUNK} AS int)", f"cast((({end}) - 1) div {_CHUNK} AS int)"
    low = f"if(j = 0, cast(({start}) AS int) - {first} * {_CHUNK}, 0)"
    high = f"if(j = {last} - {first}, cast(({end}) AS int) - {last} * {_CHUNK}, {_CHUNK})"
    some = f"slice(`{cells}`, {first} + 1, {last} - {first} + 1)"
    return (
        f"if(({start}) < ({end}), array_join(transform({some}, "
        f"(c, j) -> substring(c, {low} + 1, {high} - {low})), ''), '')")


def redacted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """All columns of ``docs``, each span of the text replaced by ``<kind>``; null texts stay null.

    A text that has a span is cut into chunks of ``_CHUNK`` characters once and put together from the
    stretches between its spans, so its cost grows with its length and its spans, not with their product.
    """
    columns = docs.columns
    d, h, key, spans, cells, body = unused(columns, "__d", "__h", "__key", "__spans", "__cells", "__body")
    found = spans_by_document(docs, doc_id, text, reach).select(
        F.col("doc_id").alias(d), F.col("h").alias(h), F.col("spans").alias(spans))
    keyed = docs.select("*", F.xxhash64(text_of(F.col(f"`{text}`"))).alias(key))
    joined = keyed.join(
        found, F.col(f"`{doc_id}`").eqNullSafe(F.col(d)) & (F.col(key) == F.col(h)), "left")
    # Once per row, by a generator of one element; otherwise each span would cut the text anew.
    chunks = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))
    cut = joined.withColumn(cells, once(F.when(F.col(spans).isNotNull(), chunks)))
    seen = f"array_max(transform(`{spans}`, x -> x.end))"
    clean = F.expr(
        f"concat(array_join(transform(`{spans}`, x -> if(x.start >= x.seen, "
        f"concat({_between(cells, 'x.seen', 'x.start')}, '<', x.kind, '>'), '')), ''), "
        f"{_between(cells, seen, f'length(`{text}`)')})")
    done = cut.withColumn(body, F.when(F.col(spans).isNull(), F.col(f"`{text}`")).otherwise(clean))
    return done.select(*[F.col(body).alias(text) if c == text else F.col(f"`{c}`") for c in columns])
