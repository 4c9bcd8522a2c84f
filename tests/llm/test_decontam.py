"""Leaks against a plain count over all documents and items."""

from __future__ import annotations

import random
import re

import pytest
from tests.llm.cases import documents, empty, rows, sentence

from yearbook.llm import decontam
from yearbook.llm.decontam import keep_unleaked, leaks

ITEMS = [
    (1, sentence(40, 700)), (2, sentence(23, 701)), (3, "rare quiz"), (4, None), (5, " "), (6, "single"), (7, sentence(40, 700)),
    (1, sentence(40, 700)), (8, sentence(5, 702)), (9, sentence(300, 703)),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(own, n):
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}


def brute(pairs, items):
    out = []
    for d, text in pairs:
        for i, item in sorted(set(items), key=str):
            if own := words(item):
                n = min(5, len(own))
                both = len(grams(own, n) & grams(words(text), n))
                if 100 * both >= 80 * len(grams(own, n)):
                    out.append((d, i, both, len(grams(own, n))))
    return sorted(out, key=str)


def planted():
    r, out = random.Random(5), []
    for i, (_, item) in enumerate(ITEMS):
        for cut in (0, 2, 6, 12):
            own = (item or "").split(" ")
            body = sentence(200, i * 10 + cut).split(" ")
            at = r.randrange(len(body))
            out.append(" ".join(body[:at] + own[: max(1, len(own) - cut)] + body[at:]).upper() if cut == 2 else " ".join(body[:at] + own[cut:] + body[at:]))
    return [*(t for _, t, *_ in rows()), *out]


@pytest.mark.parametrize("block", [1_000_000, 60])
def test_leaks(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_SHINGLES", block)
    texts = planted()
    frame, items = documents(spark, texts).repartition(3), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    pairs = [r[:2] for r in rows(texts)]
    got = leaks(frame, items).collect()
    want = brute(pairs, ITEMS)
    assert sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got), key=str) == want and len(want) >= 15
    hit = {d for d, *_ in want}
    assert sorted(str(r.doc_id) for r in keep_unleaked(frame, items).collect()) == sorted(str(d) for d, _ in pairs if d not in hit)
    assert leaks(empty(spark), items).collect() == [] == leaks(frame, items.limit(0)).collect()
    assert keep_unleaked(frame, items.limit(0)).count() == len(pairs)
