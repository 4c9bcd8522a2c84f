"""Repairs against a plain search over single rows, and the damage against its definition."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from yearbook.llm import conversations as C
from yearbook.llm.queries import QUERIES

COLUMNS = "conv_id bigint, turn bigint, role string, text string, id string, place bigint, block string, symbol int"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_faults(rows):
    """The first fault of each (role, text)."""
    out, seen = [], set()
    for role, text in rows:
        body = text.rstrip(SPACE)
        out.append("blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_repair(rows):
    """``(cost, audit, repaired)``: least cost, then least audit, row by row from behind."""
    faults = plain_faults(rows)

    def follows(last: str, role: str) -> bool:
        return role in {"": "su", "s": "u", "u": "a", "a": "u"}[last]

    @functools.cache
    def best(i: int, last: str, inserted: int):
        """From row ``i`` after a role ``last``: (cost, letters, rows)."""
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        if inserted < 2:
            for role in ("user", "assistant"):
                if follows(last, role[0]):
                    c, a, r = best(i, role[0], inserted + 1)
                    options.append((3 + c, "I" + a, ((role, ""), *r)))
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            c, a, r = best(i + 1, last, 0)
            options.append((4 + c, "D" + a, r))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                for to, cost, letter in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if follows(last, to[:1] or " "):
                        c, a, r = best(i + 1, to[0], 0)
                        options.append((cost + extra + c, letter + a, ((to, text), *r)))
        return min(options, key=lambda o: o[:2]) if options else (10**9, "Z", ())

    for i in range(len(rows), 0, -1):  # from behind, so that no call goes deep
        for last in ("", "s", "u", "a"):
            best(i, last, 0)
    return best(0, "", 0)


def plain(given):
    """The contract's row for one conversation's (turn, role, text) after damage."""
    given = sorted(given, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    rows = [(r, t) for _, r, t in given]
    turns, faults = [t for t, _, _ in given if t is not None], plain_faults(rows)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [(r[:1] or " ") for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    cost, audit, repaired = plain_repair(rows)
    assert re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r, _ in repaired))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha


def plain_damage(row):
    conv, turn, role, text = (row[0], row[1], " " if row[2] is None else row[2], " " if row[3] is None else row[3])
    fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
    return [] if fate == 0 else [(conv, turn, "user" if fate == 4 else role, text)] * (1 + (fate == 3))


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7, "clash", 7) for r in rows], COLUMNS)


def made(seed: int, conversations: int, most: int = 9):
    pick = random.Random(seed)
    roles = ["user", "assistant"] * 3 + ["system", "tool", None, "", "User", "usher"]
    texts = ["Fine.", "Yes!", "no end", "", " \t\n", None, "Why? \n", "é.", "x" * 3000 + ".", "\x1c", ". .\n."]
    out = []
    for conv in [*range(conversations), None]:
        roles_ = roles if pick.random() < 0.5 else ["user", "assistant"]
        for turn in range(pick.randint(1, most)):
            text = pick.choice([*texts, f"own {turn}.", f"own {turn}", f"also {turn}!"])
            out.append((conv, pick.choice([turn, turn, turn, turn + 20, None]), pick.choice(roles_), text))
    return out


def results(report, repaired):
    shas = {r.conv_id: r.repaired_sha256 for r in C.digests(repaired).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, shas.get(r.conv_id, nothing)) for r in report.collect()}


def wanted(rows):
    groups: dict = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {conv: plain(g) for conv, g in groups.items()}


def test_damage(spark):
    rows = made(1, 40) + [(5, None, None, None), (2**62, -3, "user", "Hm.!?")]
    got = C.damaged(table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((r for row in rows for r in plain_damage(row)), key=repr)


@pytest.mark.parametrize("block", [1 << 18, 3])
def test_repairs_equal_the_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)  # small blocks: conversations over several of them
    rows = made(2, 120, 14)
    got = results(*C.repair(table(spark, rows).repartition(5)))
    assert got == wanted(rows)


def test_long_runs_and_a_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 256)
    pick, rows = random.Random(4), []
    for turn in range(50):  # one conversation, long runs of one symbol
        length = pick.choice([1, 2, 100, 7])
        role, end = pick.choice(["user", "assistant", "tool"]), pick.choice([".", ""])
        rows += [(1, len(rows) + k, role, f"{turn} {k}{end}") for k in range(length)]
    rows += [(1, 10**6, "user", "same.")] * 300 + [(2, 0, "user", "Hello."), (2, 1, "assistant", "Hello!")]
    got = results(*C.repair(table(spark, rows).repartition(7)))
    assert got == wanted(rows)


def test_unrolling_equals_single_rows():
    for symbol in range(12):
        for length in (1, 2, 3, 5, 64, 65, 200):
            for after in ((0, 6, 3, 0), (4, 2, 0, 1), (0, 0, 0, 0)):
                for state in range(4):
                    rows, vectors = [], [after]
                    for _ in range(length):
                        vectors.append(C.through(C.row_matrix(symbol), vectors[-1]))
                    at = state
                    for behind in reversed(vectors[:-1]):
                        letters, at = C.unrolled(symbol, 1, at, behind)
                        rows.append(letters)
                    assert C.carried(symbol, length, after) == vectors[-1]
                    assert C.unrolled(symbol, length, state, after) == ("".join(rows), at)


def test_repaired_rows(spark):
    rows = [(7, 0, "system", "S."), (7, 1, "assistant", "A."), (7, 2, "user", "no end"), (8, 0, "user", " "), (8, 1, "user", "")]
    report, repaired = C.repair(table(spark, rows))
    got = sorted(map(tuple, repaired.collect()))
    assert got == [(7, 0, 0, "system", "S.", "K"), (7, 1, None, "user", "", "I"), (7, 2, 1, "assistant", "A.", "K")]
    assert {r.conv_id: (r.cost, r.audit) for r in report.collect()} == {7: (7, "KIKD"), 8: (8, "DD")}
    empty = table(spark, rows).limit(0)
    assert [x.collect() for x in C.repair(empty)] == [[], []] and C.digests(C.repair(empty)[1]).collect() == []


def test_query(spark, tmp_path):
    rows = made(6, 60) + [(900, t, "user", "x.") for t in (0, 1, 2)]
    gone = next(c for c in range(1000, 2000) if not plain_damage((c, 0, "user", "x")))
    rows.append((gone, 0, "user", "x"))
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    want = wanted([r for row in rows for r in plain_damage(row)])
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    frame = QUERIES["op11_conversations"](spark, str(tmp_path))
    got = {r.conv_id: tuple(r)[1:] for r in frame.collect()}
    assert got == {c: want.get(c, nothing) for c in {r[0] for r in rows}} and got[gone] == nothing
    assert dict(frame.dtypes) | {"conv_id": "bigint", "cost": "bigint", "audit": "string"} == dict(frame.dtypes)
    assert frame.select(F.count_distinct("conv_id")).first()[0] == frame.filter("conv_id is not null").count()
