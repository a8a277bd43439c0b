"""Repair of conversations by an edit distance with block tables (operator 12).

Rows of a conversation are kept, given another role or deleted, and rows are inserted, so
that the roles read ``(s?(ua)+)?``, at the least cost; of equally cheap edits the ones whose
initials (D, I, K, R) sort first are taken. Backwards from the end, a row turns the vector
of the four states' remaining costs into the next one. Less their least, only few different
vectors occur, so the change that a block of ``BLOCK`` row symbols makes to each of them is
computed once, as in the Four-Russians method: a conversation is then a lookup per block.
The edits are read forward: a block is expanded backwards from the vector behind it, row by
row, and each row takes the first letter that keeps the cost. Expansions are remembered.

Two passes over rows that Spark has sorted by conversation:

1. Narrow rows (ids, roles, hashes of texts, no texts) give each conversation's faults, cost
   and edits. A row counts as seen earlier by salted ranks, so a text that is repeated without
   end is no task's alone.
2. The edits go ahead of the conversation's rows and are applied as the rows stream by.

So no task holds a conversation's texts; of the longest conversation it holds one byte a row,
as its edits are one value of the result.

Null roles and texts are one space, as are null ids and turns where damage is drawn. Null
conversation ids are one conversation. Rows go by turn, nulls first, and of the same turn by role and
MD5 of the text. A conversation of which no row is left has zeros, no edits and no rows. Roles
are told by their first character. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 4
SALTS = 64
#: States: nothing yet, after system, after user, after assistant.
STATES = 4
_LEGAL = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_TURN = (2, 2, 3, 2)  # the state after the role that may come next, if it is inserted or given
_ROLES = "sua?"
_INFINITE = 1 << 30
#: Symbols: 0 must be deleted; 1 + 2 * role + truncated; the last stands for no row.
SYMBOLS = 2 + 2 * len(_ROLES)
_ABSENT = SYMBOLS - 1
#: Of equal rows the one that comes first, whole or cut, sorts ahead of the others.
_OK, _CUT, _BLANK, _DUPLICATE = range(4)
_DROPPED = 16


def options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a row, in order of the letters."""
    if symbol == 0:
        return [("D", DELETE, state)]
    role, extra = _ROLES[(symbol - 1) // 2], TRUNCATED * ((symbol - 1) % 2)
    found = [("D", DELETE, state)]
    if role in _LEGAL[state]:
        found.append(("K", KEEP + extra, _LEGAL[state][role]))
    return [*found, ("R", REROLE + extra, _TURN[state])]


def _inserted(costs: list[int]) -> list[int]:
    """Costs when any number of rows may be inserted first."""
    for _ in range(STATES):
        costs = [min(c, INSERT + costs[_TURN[s]]) for s, c in enumerate(costs)]
    return costs


def before(symbol: int, after: list[int]) -> list[int]:
    """Remaining costs per state ahead of a row, from those behind it."""
    if symbol == _ABSENT:
        return after
    return _inserted([min(c + after[t] for _, c, t in options(symbol, s)) for s in range(STATES)])


END = _inserted([0, _INFINITE, _INFINITE, 0])


class BlockTable:
    """Changes of all normalised cost vectors by all blocks of ``block`` symbols.

    ``vectors`` have least cost 0; ``next[v, code]`` is the vector ahead of a block whose
    symbols are the digits of ``code``, and ``more[v, code]`` what was taken off it.
    """

    def __init__(self, block: int = BLOCK):
        self.block = block
        places = {tuple(END): 0}
        self.vectors = [tuple(END)]
        step, off = [], []
        for own in self.vectors:  # grows as new vectors are found
            rows, less = [], []
            for symbol in range(SYMBOLS):
                costs = before(symbol, list(own))
                least = min(costs)
                key = tuple(c - least for c in costs)
                if key not in places:
                    places[key] = len(self.vectors)
                    self.vectors.append(key)
                rows.append(places[key])
                less.append(least)
            step.append(rows)
            off.append(less)
        self.step, self.off = np.array(step), np.array(off)
        self.next = np.arange(len(self.vectors))[:, None]
        self.more = np.zeros_like(self.next)
        for _ in range(block):  # one symbol more ahead of what is known
            shape = (len(self.vectors), -1)
            self.more = (self.more[:, None, :] + self.off[self.next].transpose(0, 2, 1)).reshape(shape)
            self.next = self.step[self.next].transpose(0, 2, 1).reshape(shape)
        self.digits = SYMBOLS ** np.arange(block - 1, -1, -1)
        self._known: dict[tuple[int, int, int], tuple[str, int]] = {}

    def codes(self, symbols: np.ndarray) -> list[int]:
        padded = np.full(-(-len(symbols) // self.block) * self.block, _ABSENT, np.int64)
        padded[: len(symbols)] = symbols
        return (padded.reshape(-1, self.block) @ self.digits).tolist()

    def repair(self, symbols: np.ndarray) -> tuple[int, str]:
        """Cost and edits of a conversation's rows."""
        codes = self.codes(symbols)
        vector, cost, behind = 0, 0, []
        for code in reversed(codes):
            behind.append(vector)
            cost += int(self.more[vector, code])
            vector = int(self.next[vector, code])
        cost += self.vectors[vector][0]
        letters, state = [], 0
        for code in codes:
            own, state = self.expanded(behind.pop(), code, state)
            letters.append(own)
        while state not in (0, 3):
            letters.append("I")
            state = _TURN[state]
        return cost, "".join(letters)

    def expanded(self, behind: int, code: int, state: int) -> tuple[str, int]:
        """Letters of a block and the state behind it, from the vector behind and the state ahead."""
        key = behind, code, state
        if key not in self._known:
            symbols = [code // int(d) % SYMBOLS for d in self.digits]
            costs = [list(self.vectors[behind])]
            for symbol in reversed(symbols):
                costs.append(before(symbol, costs[-1]))
            costs.reverse()
            letters = []
            for symbol, ahead, after in zip(symbols, costs, costs[1:]):
                while symbol != _ABSENT:
                    moves = [(letter, to, c + after[to]) for letter, c, to in options(symbol, state)]
                    moves.append(("I", None, INSERT + ahead[_TURN[state]]))
                    letter, to, _ = min(m for m in moves if m[2] == ahead[state])
                    letters.append(letter)
                    if to is not None:
                        state = to
                        break
                    state = _TURN[state]
            self._known[key] = "".join(letters), state
        return self._known[key]


_table: list[BlockTable] = []


def block_table() -> BlockTable:
    if not _table:
        _table.append(BlockTable())
    return _table[0]


def _space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, dropped): rows with the faults drawn from their id and turn.

    Dropped rows stay as marks without a text, so that their conversation is known.
    """
    draw = F.crc32(F.concat_ws(":", _space(F.col(conv_id)), _space(F.col(turn)))) % 20
    own = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), _space(F.col(role)).alias("role"),
        _space(F.col(text)).alias("text"), draw.cast("int").alias("draw"))
    once = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return own.select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") <= 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("draw") == 0).alias("dropped"), F.explode(once).alias("_copy"),
    ).drop("_copy")


def _marked(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, hash, kind): rows without texts; ``kind`` holds role and first fault."""
    place = F.expr(f"locate(substring(role, 1, 1), '{_ROLES[:3]}')")
    initial = F.when((F.length("role") > 0) & (place > 0), place - 1).otherwise(3)
    narrow = rows.select(
        "conv_id", "turn", "role", "dropped", initial.alias("initial"), F.unhex(F.md5("text")).alias("hash"),
        F.col("text").rlike(r"[^\x20\x09-\x0D]").alias("full"),
        F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z").alias("ended"))
    key = ["conv_id", "role", "hash", "dropped"]
    order = F.col("turn").asc_nulls_first()
    salt = F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int")
    # Ranks within salted parts, then among the parts' first rows: at most SALTS of these a key.
    salted = narrow.withColumn("salt", salt)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*key, "salt").orderBy(order)))
    first = F.when(F.col("rank") == 1, -1).otherwise(F.col("salt"))
    again = ranked.withColumn("part", first).withColumn(
        "second", F.row_number().over(Window.partitionBy(*key, "part").orderBy(order)))
    seen = (F.col("rank") > 1) | (F.col("second") > 1)
    fault = F.when(~F.col("full"), _BLANK).when(seen, _DUPLICATE).when(~F.col("ended"), _CUT).otherwise(_OK)
    kind = F.when(F.col("dropped"), _DROPPED).otherwise(F.col("initial") + 4 * fault)
    return again.select("conv_id", "turn", "role", "hash", kind.cast("tinyint").alias("kind"))


def _runs(column: pa.Array) -> list[int]:
    """Starts of the runs of equal values, nulls being equal, and the end."""
    n = len(column)
    if not n:
        return [0]
    coded = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return [0, *(np.flatnonzero(coded[1:] != coded[:-1]) + 1).tolist(), n]


class _Faults:
    """What is known of a conversation whose rows come in order."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.kinds: list[np.ndarray] = []
        self.first = self.last = None
        self.turns = 0

    def add(self, kinds: np.ndarray, turns: pa.Array) -> None:
        kept = kinds != _DROPPED
        self.kinds.append(kinds[kept])
        own = turns.to_numpy(zero_copy_only=False)[kept & turns.is_valid().to_numpy(zero_copy_only=False)]
        if len(own):
            own = own.astype(np.int64)
            self.turns += int((own[1:] != own[:-1]).sum()) + (own[0] != self.last or self.first is None)
            self.first = int(own[0]) if self.first is None else self.first
            self.last = int(own[-1])

    def row(self) -> tuple:
        kinds = np.concatenate(self.kinds)
        role, fault = kinds % 4, kinds // 4
        pair = role[:-1] * 4 + role[1:]
        symbols = np.where(fault >= _BLANK, 0, 1 + 2 * role + (fault == _CUT))
        cost, edits = block_table().repair(symbols)
        gaps = 0 if self.first is None else self.last - self.first + 1 - int(self.turns)
        return (self.conv_id, gaps, *(int((fault == f).sum()) for f in (_BLANK, _DUPLICATE, _CUT)),
                int((~np.isin(pair, (1, 6, 9))).sum()), cost, edits)


FAULTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_NAMES = [c.split()[0] for c in FAULTS.split(", ")]


def _faults(key: pa.DataType):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: _Faults | None = None
        for batch in batches:
            done = []
            ids, turns = batch.column(0), batch.column(1)
            kinds = batch.column(2).to_numpy(zero_copy_only=False)
            runs = _runs(ids)
            for a, b in zip(runs, runs[1:]):
                conv_id = ids[a].as_py()
                if own is None or own.conv_id != conv_id:
                    if own is not None:
                        done.append(own.row())
                    own = _Faults(conv_id)
                own.add(kinds[a:b], turns[a:b])
            yield _fault_rows(done, key)
        yield _fault_rows([] if own is None else [own.row()], key)

    return measure


def _fault_rows(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 8
    kinds = [key, *[pa.int64()] * 6, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["conv_id", *_NAMES])


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def faults(rows: DataFrame) -> DataFrame:
    """Per conversation of damaged rows: its faults, and the cost and initials of its cheapest edits."""
    order = [F.col("turn").asc_nulls_first(), "role", "hash"]
    ordered = _marked(rows).repartition("conv_id").sortWithinPartitions("conv_id", *order, "kind")
    narrow = ordered.select("conv_id", F.col("turn").cast("long").alias("turn"), "kind")
    key = rows.schema["conv_id"].dataType.simpleString()
    return narrow.mapInArrow(_faults(_arrow_type(rows, "conv_id")), f"conv_id {key}, {FAULTS}")


def _merged(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's edits ahead of its rows, all in order."""
    head = F.struct(*_NAMES)
    left = rows.where("NOT dropped").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "text",
        F.lit(None).cast(found.select(head.alias("head")).schema["head"].dataType).alias("head"))
    turn = rows.schema["turn"].dataType
    ahead = found.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast(turn).alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("text"), head.alias("head"))
    every = ahead.union(left).withColumn("hash", F.when(F.col("kind") == 1, F.md5("text")))
    order = ["kind", F.col("turn").asc_nulls_first(), "role", "hash"]
    return every.repartition("conv_id").sortWithinPartitions("conv_id", *order).drop("hash")


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """("head", faults) of each conversation, then ("row", edit, role, text) of the rows it keeps.

    Rows come in batches; nothing but the edits is held.
    """
    head, letters, at, state = None, "", 0, 0

    def role_of(state: int) -> str:
        return "assistant" if state == 2 else "user"

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(letters) and letters[at] == "I":
            yield "row", "I", role_of(state), ""
            at, state = at + 1, _TURN[state]

    for batch in batches:
        ids, kinds, _, roles, texts, heads = (batch.column(i).to_pylist() for i in range(6))
        for conv_id, kind, role, text, own in zip(ids, kinds, roles, texts, heads):
            if kind == 0:
                if head is not None:
                    yield from inserted()
                head, letters, at, state = own, own["audit"], 0, 0
                yield "head", conv_id, own
                continue
            yield from inserted()
            letter, at = letters[at], at + 1
            if letter == "K":
                state = _LEGAL[state][role[:1]]
                yield "row", "K", role, text
            elif letter == "R":
                yield "row", "R", role_of(state), text
                state = _TURN[state]
    if head is not None:
        yield from inserted()


_AT_ONCE = 4096


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the repaired conversations' rows, with the edit that made each."""
    key = rows.schema["conv_id"].dataType.simpleString()
    kinds = [_arrow_type(rows, "conv_id"), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = ["conv_id", "place", "edit", "role", "text"]

    def pack(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv_id, place = None, 0
        for item in _repaired(batches):
            if item[0] == "head":
                conv_id, place = item[1], 0
                continue
            out.append((conv_id, place, *item[1:]))
            place += 1
            if len(out) == _AT_ONCE:
                yield pack(out)
                out = []
        if out:
            yield pack(out)

    return _merged(rows, found).mapInArrow(apply, f"conv_id {key}, place long, edit string, role string, text string")


def digest(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Faults, edits and ``repaired_sha256`` of the repaired ``role:text`` lines, per conversation."""
    key = rows.schema["conv_id"].dataType.simpleString()
    kinds = [_arrow_type(rows, "conv_id"), *[pa.int64()] * 6, pa.string(), pa.string()]

    def pack(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["conv_id", *_NAMES, "repaired_sha256"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        own, line = None, hashlib.sha256()
        for item in _repaired(batches):
            if item[0] == "row":
                line.update(f"{own[-1]}{item[2]}:{item[3]}".encode())
                own[-1] = "\n"
                continue
            if own is not None:
                out.append((*own[:-1], line.hexdigest()))
                if len(out) == _AT_ONCE:
                    yield pack(out)
                    out = []
            own, line = [item[1], *(item[2][n] for n in _NAMES), ""], hashlib.sha256()
        if own is not None:
            out.append((*own[:-1], line.hexdigest()))
        if out:
            yield pack(out)

    return _merged(rows, found).mapInArrow(hashed, f"conv_id {key}, {FAULTS}, repaired_sha256 string")
