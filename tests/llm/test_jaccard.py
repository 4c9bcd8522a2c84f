"""The Jaccard join against all pairs, with blocks, chunks and frequent shingles forced."""

from __future__ import annotations

import random
import re
from pathlib import Path

import numpy as np
import pytest
from tests.llm.cases import documents, empty, rows, sentence

from yearbook.llm import jaccard
from yearbook.llm.jaccard import SignatureTree, bitmap, components, linked, near_duplicates, reachable


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(pairs):
    sets, parent = [shingles(t) for _, t in pairs], list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(pairs)]


def family(seed, n, words, edits, shared=""):
    r = random.Random(seed)
    base = [f"w{r.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(r.randint(0, edits)):
            own[r.randrange(len(own))] = f"e{r.randrange(10**6)}"
        out.append(" ".join(own[: r.randint(words * 8 // 10, words)]) + shared)
    return out


def corpus():
    shared = " " + " ".join(f"p{i}" for i in range(60))
    texts = [t for s in range(6) for t in family(s, 25, 120, 4)]
    texts += [" ".join(f"x{random.Random(100 + i).randrange(9999)}" for _ in range(5)) + shared for i in range(30)]
    texts += [sentence(80, 50 + i) + shared for i in range(30)] + family(9, 60, 60, 1, shared)
    texts += texts[:20] + ["tiny", "Tiny", "a b c d", "a b c d e"] * 2
    random.Random(3).shuffle(texts)
    return list(enumerate(texts, 1000))


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("sizes", [{}, {"CHUNK_SETS": 7, "FREQUENT": 0, "BUCKET_ROWS": 50}, {"CHUNK_SETS": 7, "SIFT_SETS": 1}])
def test_components_are_those_of_all_pairs(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(jaccard, name, value)
    pairs = corpus()
    frame = spark.createDataFrame(pairs, "doc_id bigint, text string").repartition(4)
    assert order(map(tuple, near_duplicates(frame).collect())) == order(brute(pairs))


def test_awkward_rows(spark):
    assert order(map(tuple, near_duplicates(documents(spark).repartition(3)).collect())) == order(brute([r[:2] for r in rows()]))
    assert near_duplicates(empty(spark)).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_tree_connects_what_links_connect(seed):
    r = np.random.default_rng(seed)
    sets = []
    for _ in range(8):
        base = r.integers(0, 2**63, r.integers(5, 200)).astype(np.uint64)
        for _ in range(r.integers(1, 15)):
            keep = r.random(len(base)) > r.choice([0.02, 0.1, 0.2])
            sets.append(np.unique(np.concatenate([base[keep], r.integers(0, 2**63, r.integers(0, 9)).astype(np.uint64)])))
    sets = [s for s in sets if len(s)]
    tree = SignatureTree(sets, 3)
    label = np.empty(len(sets), int)
    label[tree.order] = tree.connect()
    want = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                want = [want[j] if x == want[i] else x for x in want]
    assert all((label[i] == label[j]) == (want[i] == want[j]) for i in range(len(sets)) for j in range(i))


def test_sifting_keeps_what_is_linked():
    r = np.random.default_rng(7)
    sets = []
    for _ in range(40):
        base = r.integers(0, 2**63, r.integers(3, 700)).astype(np.uint64)
        for _ in range(4):
            sets.append(np.unique(np.concatenate([base[r.random(len(base)) > r.choice([0, 0.05, 0.1])], r.integers(0, 2**63, r.integers(0, len(base) // 10 + 1)).astype(np.uint64)])))
    sets = sorted((s for s in sets if len(s)), key=len)
    label = reachable(np.array([len(s) for s in sets]), [np.frombuffer(bitmap(s), np.uint64) for s in sets])
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if linked(sets[i], sets[j])]
    assert len(pairs) > 40 and all(label[i] == label[j] for i, j in pairs)
    assert len(set(label)) > 30


def test_near_copies_are_not_stored_as_shingles(spark, monkeypatch):
    stored, there, compared = {}, {}, []

    def writing(df, name, codec="zstd"):
        there[name] = [n for n, path in paths.items() if path.exists()]
        out, path = written(df, name, codec)
        paths[name] = Path(path.removeprefix("file:"))
        stored[name] = sum(p.stat().st_size for p in paths[name].glob("*.parquet"))
        return out, path

    def comparing(*args):
        compared.append(args)
        return _compared(*args)

    paths, written, _compared = {}, jaccard.written, jaccard._compared
    monkeypatch.setattr(jaccard, "written", writing)
    monkeypatch.setattr(jaccard, "_compared", comparing)
    texts = [t for s in range(40) for t in family(s, 2, 3000, 20)]
    found = jaccard.links(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)).collect()
    assert found
    # whole sets are 8 bytes a word, more than the texts
    assert max(stored.values()) < 0.5 * sum(map(len, texts))
    assert {"jaccard-rows", "jaccard-blocks"} <= set(there["jaccard-packed"]) <= set(there) - {"jaccard-found", "jaccard-members"}
    assert len(compared) == 1  # no block was cut, so there is nothing to compare again


def test_passages_of_large_tables_are_known_as_frequent(spark):
    seen = jaccard.SIFT_SETS // jaccard.SAMPLE // 4  # by a quarter of the tasks
    counted = spark.createDataFrame([(5, seen - 1), (5, 1), (6, 2)], "shingle bigint, seen bigint")
    shingles, rank = jaccard._frequent(counted, 3_000_000)
    assert shingles.tolist() == [5] and len(rank) == 1


def test_packed_texts_give_their_sets(spark):
    texts = ["a b c d e f", "A  b\tc D e\nf", "\u00e9 " * 9, "tiny", "", None, "w " * 200_000 + "end"]
    every = np.full(64, -1, np.int64).view(np.uint64)
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    keys = "0L hub", "0L chunk", "0L other"
    packed = jaccard._packed(frame, "text", every).selectExpr(*keys, "member", "bytes", "text", "false guest")
    got = [r for b in jaccard._unpacked(packed.toArrow().to_batches()) for r in b.to_pylist()]
    assert len(got) == 4  # equal sets are one
    assert all(jaccard.set_id(np.frombuffer(r["shingles"], np.uint64)) == r["member"] for r in got)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 100), (300, 200), (7, 300)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == dict.fromkeys([*range(61), 100, 200, 300], 0)


def templated(n: int, words: int, own: int, seed: int = 1):
    """Texts with one passage in common and some words of their own: similar, under the limit."""
    r = random.Random(seed)
    base = [f"t{i}" for i in range(words - own)]
    return [" ".join([*base, *(f"o{r.randrange(10**9)}" for _ in range(own))]) for _ in range(n)]


def test_large_block_of_nearly_similar_sets_takes_seconds():
    """A chunk pair of sets at 0.74: nothing is linked, and no pair is looked at by itself."""
    import time

    from yearbook.llm.columns import shingle_sets
    import pyarrow as pa

    sets = list(shingle_sets(pa.array(templated(4000, 104, 16), pa.large_string()), 5))
    a, b = sets[0], sets[1]
    both = len(np.intersect1d(a, b))
    assert 0.70 < both / (len(a) + len(b) - both) < 0.80
    start = time.perf_counter()
    tree = SignatureTree(sets, 0)
    label = tree.connect()
    assert len(set(label.tolist())) == len(sets) and time.perf_counter() - start < 30


def test_cut_blocks_find_what_all_pairs_find(spark, monkeypatch):
    """A templated block over several chunks, with linked pairs far from its first set."""
    monkeypatch.setattr(jaccard, "CHUNK_SETS", 40)
    monkeypatch.setattr(jaccard, "SIFT_SETS", 50)
    texts = templated(150, 60, 14)
    r = random.Random(5)
    for t in r.sample(texts, 30):  # near copies of some
        own = t.split()
        own[-1] = f"z{r.randrange(10**6)}"
        texts.append(" ".join(own))
    texts += [t + " more words here" for t in r.sample(texts, 10)]
    pairs = list(enumerate(texts, 7))
    r.shuffle(pairs)
    frame = spark.createDataFrame(pairs, "doc_id bigint, text string").repartition(4)
    assert order(map(tuple, near_duplicates(frame).collect())) == order(brute(pairs))


def test_chunks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_SETS", 100)
    rows_ = [(1, i, 100 + i % 3) for i in range(5000)] + [(1, 10_000 + i, 5 + i) for i in range(800)] + [(2, i, 50) for i in range(30)]
    frame = spark.createDataFrame(rows_, "hub bigint, member bigint, n bigint")
    got = jaccard._chunked(frame).groupBy("hub", "chunk").agg({"member": "count", "n": "max"}).collect()
    counts = [r["count(member)"] for r in got]
    assert sum(counts) == len(rows_) and max(counts) <= 250 and len([r for r in got if r.hub == 2]) == 1


def test_clashing_names(spark):
    from yearbook.llm.jaccard import keep_one

    texts = family(1, 12, 80, 2) + [None, "", "a b"]
    rows_ = [(i, t, 1, 2, 3, True, 4, "x", "y", 5) for i, t in enumerate(texts)] * 2
    frame = spark.createDataFrame(rows_, "doc_id bigint, text string, __key bigint, __id bigint, __h bigint, __first boolean, __row bigint, doc string, `key` string, salt int")
    got = keep_one(frame)
    assert got.columns == frame.columns
    linked_ = {c for _, _, c in brute(list(enumerate(texts[:12])))}
    kept = [r.doc_id for r in got.collect()]
    assert sorted(set(kept)) == sorted({*linked_, 12, 13, 14}) and kept.count(14) == 1 and kept.count(12) == 2
