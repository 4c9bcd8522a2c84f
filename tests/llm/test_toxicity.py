"""The class models against a plain Kneser-Ney count, and held-out accuracy."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from tests.llm.cases import documents, empty, sentence

from yearbook.llm import toxicity as toxicity_module
from yearbook.llm.toxicity import DISCOUNT, ORDER, SHARED, Model, _counted, _heaviest, _ratios, grams_of, scale, toxicity, words_of


def plain_grams(text):
    for word in re.findall(rb"[a-z\x80-\xff]+", text.lower().encode()):
        spelt = b" " + word + b" "
        for i in range(1, len(spelt)):
            yield spelt[max(0, i - ORDER + 1) : i + 1].rjust(ORDER, b"\0")


def plain_ratios(texts):
    counts = {c: Counter(g for t, toxic in texts if toxic == c for g in plain_grams(t)) for c in (0, 1)}
    grams = set(counts[0]) | set(counts[1])
    levels, above = [], grams
    for n in SHARED:
        c = Counter(bytes(ORDER - n) + g[ORDER - n :] for g in above)
        levels.append((n, c))
        above = set(c)
    p, shorter = {}, None
    for n, c in reversed(levels):
        total, types = Counter(), Counter()
        for g, k in c.items():
            total[g[:-1]] += k
            types[g[:-1]] += 1
        q = {}
        for g, k in c.items():
            h = g[:-1]
            q[g] = k / total[h] if shorter is None else max(k - DISCOUNT, 0) / total[h] + DISCOUNT * types[h] / total[h] * p[bytes(ORDER - shorter) + g[ORDER - shorter :]]
        p, shorter = q, n
    out = {}
    for g in grams:
        both = []
        for c in (1, 0):
            own = {x: k for x, k in counts[c].items() if x[:-1] == g[:-1]}
            total, rest = sum(own.values()), p[bytes(1) + g[1:]]
            both.append(max(counts[c][g] - DISCOUNT, 0) / total + DISCOUNT * len(own) / total * rest if total else rest)
        out[g] = math.log(both[0] / both[1])
    return out


def test_ratios_are_those_of_the_plain_model(spark):
    texts = [("the house of the Moron", 1), ("moron stone über", 1), ("the house, the river", 0), ("stones of the house", 0), ("", 0)]
    labelled = spark.createDataFrame([(t, c, 0) for t, c in texts], "text string, toxic int, fold int").repartition(2)
    got = {r.gram.to_bytes(8, "big", signed=True): r.ratio for r in _ratios(_counted(labelled)).collect()}
    want = plain_ratios(texts)
    assert set(got) == set(want)
    assert all(math.isclose(got[g], want[g], abs_tol=1e-9) for g in want)


def test_grams_and_features():
    words = words_of(pa.array(["Ab abcdefghij x1y é", ""], pa.large_string()), False, letters=True)
    grams, starts = grams_of(words)
    assert words.bounds.tolist() == [0, 4, 4] or words.bounds.tolist() == [0, 5, 5]
    assert len(starts) == len(words.vocabulary)
    model = Model(grams, np.ones(len(grams)))
    got = model.features(pa.array(["abcdefghij", "", None and "", "zz"], pa.large_string()))
    assert got[0].tolist() == [1.0, 11.0, 11.0] and got[1].tolist() == [0, 0, 0]


def test_scale_without_both_classes():
    assert scale(np.zeros((0, 3)), np.zeros(0))[-1] < 0 < scale(np.ones((4, 3)), np.ones(4))[-1]


def test_held_out_rows_are_told_apart(spark):
    r, rows, labels = random.Random(4), [], []
    for i in range(900):
        toxic, words = int(i % 4 == 1), sentence(r.randint(5, 80), i).split()
        if toxic:
            words.insert(r.randrange(len(words)), r.choice(["moron", "scumbags", "idiotic", "Trash"]))
        rows.append((i, " ".join(words)))
        labels += [(i, 1, toxic)] * (1 + (i % 50 == 0))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = toxicity(frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in got)
    held = [x for x in got if x.held_out]
    assert 150 < len(held) < 300
    assert sum(x.predicted == (x.doc_id % 4 == 1) for x in held) > 0.97 * len(held)
    # labels of the held-out fold say nothing
    by_id = defaultdict(int, {x.doc_id: x.held_out for x in got})
    other = [(i, q, 1 - t if by_id[i] else t) for i, q, t in labels]
    again = toxicity(frame, spark.createDataFrame(other, "doc_id bigint, quality int, toxic int")).collect()
    assert {x.doc_id: round(x.score, 9) for x in got} == {x.doc_id: round(x.score, 9) for x in again}


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(40)] + [(None, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    got = toxicity(documents(spark), labels).collect()
    assert len(got) == documents(spark).count() and all(0 <= x.score <= 1 for x in got)
    assert toxicity(empty(spark), labels).collect() == []
    assert {x.predicted for x in toxicity(documents(spark), labels.limit(0)).collect()} == {0}


def test_heaviest_rows(spark):
    rows = spark.range(5000).selectExpr("id as gram", "cast(id % 1000 as double) as weight").repartition(4)
    got = [r.weight for r in _heaviest(rows, 500).collect()]
    assert min(got) >= 880 and 400 <= len(got) <= 550
    assert _heaviest(rows, 5000).count() == 5000


def test_no_ngram_is_left_out(spark, monkeypatch):
    """Words beyond those that go to all tasks score like in the whole table, and unseen
    n-grams like in the plain model."""
    texts = [f"{sentence(20, i)} {'moron trash'[: i % 12]} über{i}" for i in range(40)] + ["", "zzz", None]
    labelled = spark.createDataFrame([(t, i % 2, 0) for i, t in enumerate(texts)], "text string, toxic int, fold int").repartition(3)
    counts = _counted(labelled)
    ratios, backs = _ratios(counts), toxicity_module._back_offs(counts)
    texts += ["moronic trashes übel", "qqqq xyzzy"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    words = toxicity_module._word_ratios(toxicity_module._vocabulary(rows, "text"), ratios, backs)
    table = ratios.select("gram", "ratio").toPandas()
    model = Model(table["gram"].to_numpy().view(np.uint64), table["ratio"].to_numpy(), {r.h: r.ratio for r in backs.collect()})
    want = model.features(pa.array([t or "" for t in texts], pa.large_string()))
    for most in (1 << 18, 3):
        monkeypatch.setattr(toxicity_module, "COMMON_WORDS", most)
        got = {r.id: [r.a, r.b, r.c] for r in toxicity_module.features(rows, words).collect()}
        assert np.allclose([got[i] for i in range(len(texts))], want, atol=1e-5)


def test_ratios_of_unseen_ngrams(spark):
    """Against the plain model: what a class frees after a context, by hand."""
    texts = [("moron morox", 1), ("moron", 1), ("moron", 0), ("stone", 0)]
    labelled = spark.createDataFrame([(t, c, 0) for t, c in texts], "text string, toxic int, fold int").repartition(2)
    counts = _counted(labelled)
    counted = {c: Counter(g for t, toxic in texts if toxic == c for g in plain_grams(t)) for c in (0, 1)}
    backs = {r.h: r.ratio for r in toxicity_module._back_offs(counts).collect()}
    assert set(backs) == {int.from_bytes(g[:-1], "big") for c in counted.values() for g in c}
    for h, ratio in backs.items():
        freed = {}
        for c, grams in counted.items():
            own = [k for g, k in grams.items() if int.from_bytes(g[:-1], "big") == h]
            freed[c] = DISCOUNT * len(own) / sum(own) if own else 1.0
        assert math.isclose(ratio, math.log(freed[1] / freed[0]), abs_tol=1e-12)
    # " moro" is followed by n and x in toxic text, by n only in the other: z is unseen
    frame = spark.createDataFrame([(0, "moroz")], "id int, text string")
    words = toxicity_module._word_ratios(toxicity_module._vocabulary(frame, "text"), _ratios(counts), toxicity_module._back_offs(counts))
    seen = plain_ratios(texts)
    want = sum(seen.get(g, backs.get(int.from_bytes(g[:-1], "big"), 0.0)) for g in plain_grams("moroz"))
    assert math.isclose(words.first().own / toxicity_module.PARTS, want, abs_tol=1e-6)
    assert backs[int.from_bytes(b" moro", "big")] != 0
