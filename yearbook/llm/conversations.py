"""Conversation structure repair: the cheapest edits that give ``(s?(ua)+)?`` role initials.

A row is a symbol: its role (system, user, assistant, other) and its fault. Where the
pattern stands after some rows is one of four states, so a row's edits, with the insertions
before it, are a 4 x 4 matrix of costs, and rows in sequence are the min-plus product of
their matrices. Equal consecutive symbols are one run, whose product is a power: it is put
together from binary powers that are kept for each symbol, and the choices inside are
unrolled by halving the run.

In every state an edit's initial says what state follows, so the least of all cheapest
audits is found by taking the least initial that is on a cheapest path, row by row.

Rows are put in order by ranges, so a conversation may take many tasks. Its rows in one
stretch of ``BLOCK`` rows are a block. Blocks give their matrix; one small task for each
conversation carries the costs back through the matrices; blocks give their edits for each
state they may start in; a second small task picks. An audit is one value of the result,
so a conversation has at most 2^31 rows, and these tasks see at most some 8,192 blocks.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearbook.llm.tables import written

#: Rows of a block: consecutive places of one task of the ordering.
BLOCK = 1 << 18
#: Characters of a text by which rows of one turn and role are ordered; then by hash.
ORDER_CHARS = 64

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: States: nothing yet, after system, after user, after assistant. What finishing costs.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
FINISH = (0, 2 * INSERT, INSERT, 0)
NEVER = 10**15
#: Fault of a row, above its role (0 system, 1 user, 2 assistant, 3 other) in a symbol.
FINE, CUT, BLANK, REPEATED = range(4)
#: Runs up to this length are remembered with their edits.
REMEMBERED = 64

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def turn_state(state: int) -> int:
    """The state after an inserted or re-roled row: the pattern allows one role only."""
    return ASSISTANT if state == USER else USER


def kept_state(role: int, state: int) -> int | None:
    """The state after a row of that role is kept; None if it can't be."""
    if role == 0:
        return SYSTEM if state == BEGIN else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if role == 2 and state == USER else None


def edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """``(initial, cost, next state)`` of the edits that use up a row, by initial."""
    role, fault = symbol & 3, symbol >> 2
    out = [("D", DELETE, state)]
    if fault in (FINE, CUT):
        extra = TRUNCATED if fault == CUT else 0
        if (to := kept_state(role, state)) is not None:
            out.append(("K", extra, to))
        out.append(("R", REROLE + extra, turn_state(state)))
    return out


@functools.cache
def row_matrix(symbol: int) -> Matrix:
    """Least costs from state to state through one row, insertions before it included."""
    out = []
    for state in range(4):
        costs, at, spent = [NEVER] * 4, state, 0
        for _ in range(4):
            for _, cost, to in edits(symbol, at):
                costs[to] = min(costs[to], spent + cost)
            at, spent = turn_state(at), spent + INSERT
        out.append(tuple(costs))
    return tuple(out)


def through(matrix: Matrix, after: Vector) -> Vector:
    """Least costs before, from those after."""
    return tuple(min(NEVER, *(a + b for a, b in zip(row, after, strict=True))) for row in matrix)


def product(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    return tuple(zip(*(through(a, column) for column in zip(*b, strict=True)), strict=True))


@functools.cache
def binary_power(symbol: int, k: int) -> Matrix:
    """The matrix of 2^k equal rows."""
    return row_matrix(symbol) if k == 0 else product(binary_power(symbol, k - 1), binary_power(symbol, k - 1))


def carried(symbol: int, length: int, after: Vector) -> Vector:
    """Least costs before a run, from those after it."""
    for k in range(length.bit_length()):
        if length >> k & 1:
            after = through(binary_power(symbol, k), after)
    return after


@functools.lru_cache(1 << 16)
def _remembered(symbol: int, length: int, state: int, after: Vector) -> tuple[str, int]:
    if length > 1:
        return _halved(symbol, length, state, after)
    before, letters = through(row_matrix(symbol), after), ""
    while True:
        choices = [(initial, to) for initial, cost, to in edits(symbol, state) if cost + after[to] == before[state]]
        on = turn_state(state)
        if INSERT + before[on] == before[state] and not (choices and choices[0][0] == "D"):
            letters, state = letters + "I", on
        else:
            return letters + choices[0][0], choices[0][1]


def _halved(symbol: int, length: int, state: int, after: Vector) -> tuple[str, int]:
    first = 1 << ((length - 1).bit_length() - 1)
    a, middle = unrolled(symbol, first, state, carried(symbol, length - first, after))
    b, end = unrolled(symbol, length - first, middle, after)
    return a + b, end


def unrolled(symbol: int, length: int, state: int, after: Vector) -> tuple[str, int]:
    """The edits of a run from ``state``, given the costs after it, and the state then."""
    least = min(after)
    after = tuple(min(c - least, NEVER) for c in after)
    return _remembered(symbol, length, state, after) if length <= REMEMBERED else _halved(symbol, length, state, after)


def runs_of(symbols: bytes) -> list[tuple[int, int]]:
    """``(symbol, length)`` of the runs of equal symbols."""
    flat = np.frombuffer(symbols, np.uint8)
    starts = np.flatnonzero(np.diff(flat, prepend=255))
    return list(zip(flat[starts].tolist(), np.diff(starts, append=len(flat)).tolist(), strict=True))


def block_matrix(symbols: bytes) -> Matrix:
    """The product over all rows of a block."""
    runs = runs_of(symbols)
    columns = [tuple(0 if i == j else NEVER for i in range(4)) for j in range(4)]
    for symbol, length in reversed(runs):
        columns = [carried(symbol, length, c) for c in columns]
    return tuple(zip(*columns, strict=True))


def block_edits(symbols: bytes, state: int, after: Vector) -> tuple[str, int]:
    """The least cheapest edits of a block from ``state``, and the state behind it."""
    runs = runs_of(symbols)
    costs = [after]
    for symbol, length in reversed(runs):
        costs.append(carried(symbol, length, costs[-1]))
    letters = []
    for (symbol, length), behind in zip(runs, reversed(costs[:-1]), strict=True):
        part, state = unrolled(symbol, length, state, behind)
        letters.append(part)
    return "".join(letters), state


def _ordered(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(id, turn, role, text, key, symbol, place, block)``, stored; places go with the
    order: id, turn (nulls first), role, text."""
    space = F.lit(" ")
    given = rows.select(F.col(id_col).alias("id"), F.col(turn_col).cast("bigint").alias("turn"), F.coalesce(role_col, space).alias("role"), F.coalesce(text_col, space).alias("text"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, BLANK).when(ended, FINE).otherwise(CUT)
    given = given.withColumn("key", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    given = given.withColumn("symbol", (role + 4 * fault).cast("int")).withColumn("front", F.left("text", F.lit(ORDER_CHARS)))
    # Equal rows have no order among them; the last column deals them to several ranges.
    given = given.withColumn("any", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("front"), F.asc("key")]
    sorted_ = given.repartitionByRange(*order, F.asc("any")).sortWithinPartitions(*order).drop("front", "any")
    placed = sorted_.withColumn("place", F.monotonically_increasing_id())
    return written(placed.withColumn("block", F.expr(f"place div {BLOCK}")), "conversation-rows")[0]


def _symbols(rows: DataFrame) -> DataFrame:
    """``(id, block, symbols)``: one byte for each row in order, repeated rows marked.

    The first places of equal rows come as entries of their own beside the rows', so that no
    join on what may be a frequent text is needed.
    """
    entry = (F.col("place") - F.col("block") * BLOCK) * 32
    firsts = rows.groupBy("id", "key").agg(F.min("place").alias("place")).withColumn("block", F.expr(f"place div {BLOCK}"))
    entries = rows.select("id", "block", (entry + F.col("symbol")).alias("entry")).unionByName(firsts.select("id", "block", (entry + 16).alias("entry")))
    blocks = entries.groupBy("id", "block").agg(F.collect_list("entry").alias("entries"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for entries in batch.column(2):
                e = np.sort(entries.values.to_numpy(zero_copy_only=False))
                first = (e & 16) > 0  # stands behind its row
                seen = np.append(first[1:], False)[~first]
                symbols = (e[~first] & 15).astype(np.uint8)
                symbols[~seen & (symbols >> 2 != BLANK)] |= 4 * REPEATED
                out.append(symbols.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "block", "symbols"])

    kind = rows.schema["id"].dataType.simpleString()
    return blocks.mapInArrow(mark, f"id {kind}, block bigint, symbols binary")


_MEASURES = ("blank", "duplicate", "truncated", "illegal")
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[0, 1] = _LEGAL[1, 2] = _LEGAL[2, 1] = True


def _measured(symbols: bytes) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours whose roles may not follow."""
    flat = np.frombuffer(symbols, np.uint8)
    faults, roles = np.bincount(flat >> 2, minlength=4), flat & 3
    return int(faults[BLANK]), int(faults[REPEATED]), int(faults[CUT]), int((~_LEGAL[roles[:-1], roles[1:]]).sum())


def _blocks(rows: DataFrame) -> tuple[DataFrame, str]:
    """``(id, block, symbols, matrix, first, last, blank, duplicate, truncated, illegal)``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_symbols = batch.column(2).to_pylist()
            matrices = [[c for row in block_matrix(s) for c in row] for s in all_symbols]
            measures = np.array([_measured(s) for s in all_symbols], np.int64).reshape(-1, 4)
            ends = np.array([(s[0] & 3, s[-1] & 3) for s in all_symbols], np.int32).reshape(-1, 2)
            arrays = [*batch.columns, pa.array(matrices, pa.list_(pa.int64())), *(pa.array(c.copy()) for c in ends.T), *(pa.array(c.copy()) for c in measures.T)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["id", "block", "symbols", "matrix", "first", "last", *_MEASURES]
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, block bigint, symbols binary, matrix array<bigint>, first int, last int" + "".join(f", {m} bigint" for m in _MEASURES)
    return written(_symbols(rows).mapInArrow(measure, schema), "conversation-blocks")


def _grouped(blocks: DataFrame, *columns: str) -> DataFrame:
    """One row for each conversation with its blocks in order."""
    return blocks.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("block", *columns))).alias("blocks"))


def _costs(blocks: DataFrame) -> DataFrame:
    """``(id, block, after, total, leads)``: the costs behind each block, those of the whole
    conversation, and whether it is the first block."""

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            at = []
            for i, chain in enumerate(batch.column(1).to_pylist()):
                after, mine = FINISH, []
                for b in reversed(chain):
                    m = b["matrix"]
                    mine.append((b["block"], after))
                    after = through(tuple(tuple(m[4 * p : 4 * p + 4]) for p in range(4)), after)
                out += [(block, list(v), after[BEGIN], block == chain[0]["block"]) for block, v in mine]
                at += [i] * len(mine)
            block, after, total, leads = zip(*out, strict=True) if out else ((), (), (), ())
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(block, pa.int64()), pa.array(after, pa.list_(pa.int64())), pa.array(total, pa.int64()), pa.array(leads, pa.bool_())], names=names)

    names = ["id", "block", "after", "total", "leads"]
    kind = blocks.schema["id"].dataType.simpleString()
    return _grouped(blocks, "matrix").mapInArrow(carry, f"id {kind}, block bigint, after array<bigint>, total bigint, leads boolean")


def _pieces(blocks: DataFrame) -> DataFrame:
    """Blocks with their edits, and the state behind them, for each state they may start in."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            walks = [
                [block_edits(symbols, state, tuple(after)) for state in range(1 if leads else 4)]
                for symbols, after, leads in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            letters = pa.array([[w[0] for w in walk] for walk in walks], pa.list_(pa.string()))
            states = pa.array([[w[1] for w in walk] for walk in walks], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], letters, states], names=[*kept, "letters", "states"])

    costs = _costs(blocks).withColumnRenamed("id", "of").withColumnRenamed("block", "of_block")
    joined = blocks.join(costs, blocks["id"].eqNullSafe(costs["of"]) & (blocks["block"] == costs["of_block"]))
    kept = ["id", "block", "total", "first", "last", *_MEASURES]
    joined = joined.select("symbols", "after", "leads", *kept)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields[3:])
    return joined.mapInArrow(walk, f"{schema}, letters array<string>, states array<int>")


def _reports(pieces: DataFrame) -> DataFrame:
    """``(id, blank, duplicate, truncated, illegal, cost, audit, parts)`` for each
    conversation; ``parts (block, state, place, letters)`` are its blocks' edits."""
    columns = ("total", "first", "last", *_MEASURES, "letters", "states")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for chain in batch.column(1).to_pylist():
                sums = {m: sum(b[m] for b in chain) for m in _MEASURES}
                sums["illegal"] += sum(not _LEGAL[a["last"], b["first"]] for a, b in zip(chain[:-1], chain[1:], strict=True))
                state, place, parts = BEGIN, 0, []
                for b in chain:
                    letters, after = b["letters"][state], b["states"][state]
                    parts.append({"block": b["block"], "state": state, "place": place, "letters": letters})
                    place += len(letters) - letters.count("D")
                    state = after
                parts[-1]["letters"] += "I" * (FINISH[state] // INSERT)
                out.append(sums | {"cost": chain[0]["total"], "audit": "".join(p["letters"] for p in parts), "parts": parts})
            arrays = [pa.array([r[n] for r in out], t) for n, t in kinds.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", *kinds])

    part = pa.struct([("block", pa.int64()), ("state", pa.int32()), ("place", pa.int64()), ("letters", pa.string())])
    kinds = {m: pa.int64() for m in (*_MEASURES, "cost")} | {"audit": pa.string(), "parts": pa.list_(part)}
    kind = pieces.schema["id"].dataType.simpleString()
    schema = f"id {kind}" + "".join(f", {m} bigint" for m in (*_MEASURES, "cost")) + ", audit string, parts array<struct<block: bigint, state: int, place: bigint, letters: string>>"
    return _grouped(pieces, *columns).mapInArrow(pick, schema)


def _edited(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """``(id, place, turn, role, text, edit)``: the rows that are left, and inserted ones."""
    none = F.lit(None).cast("string")
    parts = reports.select("id", F.explode("parts").alias("part")).select("id", "part.*")
    parts = parts.select("id", "block", F.lit(-1).cast("bigint").alias("at"), F.col("place").alias("turn"), F.col("state").cast("string").alias("role"), F.col("letters").alias("text"))
    given = rows.select("id", "block", F.col("place").alias("at"), "turn", "role", "text")
    # A block's edits come before its rows.
    both = parts.unionByName(given).repartition("id", "block").sortWithinPartitions("id", "block", "at")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        owner, letters, used, state, place = None, "", 0, BEGIN, 0

        def insertions() -> None:
            nonlocal used, state, place
            while used < len(letters) and letters[used] == "I":
                state = turn_state(state)
                out.append((owner, place, None, "user" if state == USER else "assistant", "", "I"))
                used, place = used + 1, place + 1

        def batch_of() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [()] * 6
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["id", "place", "turn", "role", "text", "edit"])
            out.clear()
            return made

        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = kinds or [batch.column(0).type, pa.int64(), pa.int64(), pa.large_string(), pa.large_string(), pa.string()]
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)]
            for id_, at, turn, role, text in zip(*columns, strict=True):
                if at < 0:
                    insertions()  # what closes the conversation before
                    owner, letters, used, state, place = id_, text, 0, int(role), turn
                    continue
                insertions()
                initial, used = letters[used], used + 1
                if initial == "D":
                    continue
                if initial == "R":
                    state = turn_state(state)
                    role = "user" if state == USER else "assistant"
                else:
                    state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                out.append((id_, place, turn, role, text, initial))
                place += 1
            yield batch_of()
        insertions()
        if out:
            yield batch_of()

    kind = rows.schema["id"].dataType.simpleString()
    return both.mapInArrow(edit, f"id {kind}, place bigint, turn bigint, role string, text string, edit string")


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """What is wrong with each conversation and the cheapest edits, and the repaired rows.

    The first table has ``(id, gaps, blank, duplicate, truncated, illegal, cost, audit)``
    for each id; the second ``(id, place, turn, role, text, edit)``, ``place`` counting
    from 0 and ``edit`` being K, R or I.

    Rows go by turn, nulls first; in one turn by role and text. Null roles and texts are one
    space; rows without id are one conversation. A row without a character other than
    ASCII white space is blank; one with the role and text of an earlier row is a duplicate;
    one whose last such character is none of ``.!?`` is truncated; the first of these
    counts. Blank rows and duplicates must go. The initials of roles have to be
    ``(s?(ua)+)?``; keeping costs 0, a new role of user or assistant 3, deletion 4, an
    inserted empty row 3, and a truncated row that stays 3. Of cheapest edits those with the
    least initials are taken. An empty table gives empty tables; other columns are not
    read, a conversation may hold most rows, and any number of them may be equal.
    """
    ordered = _ordered(rows, id_col, turn_col, role_col, text_col)
    blocks, _ = _blocks(ordered)
    reports, _ = written(_reports(_pieces(blocks)), "conversation-reports")
    lowest, highest = (f(F.col("turn").cast("decimal(20)")) for f in (F.min, F.max))
    span = F.coalesce((highest - lowest + 1 - F.count_distinct("turn")).cast("bigint"), F.lit(0).cast("bigint"))
    gaps = ordered.groupBy("id").agg(span.alias("gaps")).withColumnRenamed("id", "of")
    report = reports.join(gaps, reports["id"].eqNullSafe(gaps["of"]))
    report = report.select(F.col("id").alias(id_col), "gaps", *_MEASURES, "cost", "audit")
    return report, _edited(ordered, reports).withColumnRenamed("id", id_col)


def digests(repaired: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``(id, repaired_sha256)``: the hash of a conversation's ``role:text`` lines.

    A hash over a text goes through it from front to back, so a conversation's rows stream
    through one task, in order and without being held.
    """

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, owner, state = False, None, hashlib.sha256()
        kind = None
        for batch in batches:
            kind, done = batch.column(0).type, []
            for id_, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if known and id_ == owner:
                    state.update(b"\n")
                else:
                    if known:
                        done.append((owner, state.hexdigest()))
                    known, owner, state = True, id_, hashlib.sha256()
                state.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], names=["id", "sha"])
        if known:
            yield pa.RecordBatch.from_arrays([pa.array([owner], kind), pa.array([state.hexdigest()], pa.string())], names=["id", "sha"])

    kind = repaired.schema[id_col].dataType.simpleString()
    together = repaired.repartition(id_col).sortWithinPartitions(id_col, "place").select(id_col, "role", "text")
    return together.mapInArrow(hash_, f"id {kind}, sha string").toDF(id_col, "repaired_sha256")


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations with known faults, to test repairs on: ``(id, turn, role, text)``.

    By ``crc32("id:turn") % 20`` a row is dropped (0), emptied (1), loses its ``.!?`` (2),
    is repeated in place (3), or becomes the user's (4). Nulls are one space, but turns
    stay null.
    """

    def told(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fate = F.pmod(F.crc32(F.concat(told(id_col), F.lit(":"), told(turn_col)).cast("binary")), F.lit(20))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate(told(text_col), ".!?", "")).otherwise(told(text_col))
    role = F.when(F.col("fate") == 4, "user").otherwise(told(role_col))
    hit = rows.select(id_col, turn_col, role_col, text_col, fate.alias("fate")).filter("fate <> 0")
    copies = F.explode(F.expr("if(fate = 3, array(1, 2), array(1))")).alias("copy")
    return hit.select(id_col, turn_col, role.alias(role_col), text.alias(text_col), copies).drop("copy")
