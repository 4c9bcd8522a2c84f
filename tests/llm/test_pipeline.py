"""The pipeline's stages against plain versions, and all of it together."""

from __future__ import annotations

import zlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
from tests.llm.cases import documents, empty, rows, sentence
from tests.llm.test_decontam import brute as plain_leaks
from tests.llm.test_jaccard import brute as plain_components
from tests.llm.test_jaccard import family
from tests.llm.test_privacy import plain as plain_spans
from tests.llm.test_privacy import plain_decisions, plain_terms
from tests.llm.test_quality import brute as plain_quality
from tokenizers import Tokenizer

from yearbook.llm.jaccard import keep_one
from yearbook.llm.privacy import masked


def key(row):
    return tuple(map(str, row))


def plain_keep_one(own):
    """Rows that stay: of each component the smallest by (no id, id)."""
    named = [(-1 - i, r[1]) for i, r in enumerate(own)]  # ids of their own
    label = {d: c for d, _, c in plain_components(named)}
    best = {}
    for i, r in enumerate(own):
        best.setdefault(label[-1 - i], []).append((r[0] is None, r[0] or 0, i))
    return [own[i] for c in best.values() for i in ([min(c)[2]] if own[min(c)[2]][1] and own[min(c)[2]][1].split() else [x[2] for x in c])]


def texts():
    return [t for s in range(3) for t in family(s, 12, 90, 3)] + [sentence(120, 900 + i) for i in range(30)]


def test_keep_one(spark):
    own = rows([*(t for _, t, *_ in rows()), *texts()])
    frame = spark.createDataFrame(own, documents(spark).schema).repartition(4)
    assert sorted(map(key, keep_one(frame).collect())) == sorted(map(key, plain_keep_one(own)))
    assert keep_one(empty(spark)).collect() == []


def test_run(spark, tmp_path):
    item = sentence(45, 5000)
    own = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts())]
    own += [(1000, sentence(90, 70) + " " + item + " " + sentence(50, 71), "en", "s", 0), (1001, "write to a.b@c.org or 10.1.2.3 " + sentence(90, 72), "en", "s", 0)]
    own += [(1002, "again " * 300, "en", "s", 0), (1003, None, None, None, None), (1001, own[-1][1], "en", "s", 0)]
    spark.createDataFrame(own, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    left = []
    for r in own:
        words, chars, symbols, _, hits, line, *grams = plain_quality(r[1] or "")
        shares = [g <= s * max(chars, 1) for g, s in zip([line, *grams], (0.30, 0.25, 0.20, 0.15), strict=True)]
        if words >= 50 and 100 * hits <= 50 * words and symbols <= 0.1 * words and all(shares):
            left.append(r)
    left = plain_keep_one(left)
    hit = {d for d, *_ in plain_leaks([r[:2] for r in left], [(1, item)])}
    left = [r for r in left if r[0] not in hit]
    assert hit == {1000} and 20 < len(left) < len(own) - 15
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, decisions = Counter(), plain_decisions([r[1] for r in left])
    assert any(plain_terms(r[1], decisions) for r in left)
    for r in left:
        ids = [*whole.encode(masked(r[1], plain_spans(r[1]) + [*plain_terms(r[1], decisions)]), add_special_tokens=False).ids, 1]
        want[(r[0], len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))] += 1
    docs = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        docs.setdefault(p.doc_id, []).append(p)
    got = Counter((d, ps[0].doc_tokens, zlib.crc32(b"".join(p.ids for p in ps))) for d, ps in docs.items())
    assert got == want


def test_stages_take_awkward_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, sentence(45, 5000))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (documents(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, str(tmp_path))
            if name != "packing":
                assert out.columns == frame.columns
            out.write.format("noop").mode("overwrite").save()
