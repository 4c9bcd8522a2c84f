"""Repetition measures against a plain count."""

from __future__ import annotations

import re
from collections import Counter

from tests.llm.cases import documents, empty, key, rows

from yearbook.llm.quality import MIN_WORDS, keep_clean, repetition, verdicts


def brute(text: str, lengths=(4, 6, 10)) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    def windows(n):
        return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    counts = Counter(windows(3))
    hit = {j for i, w in enumerate(windows(3)) if counts[w] > 1 for j in range(i, i + 3)}
    lines, known, dup, chars = text.split("\n"), set(), 0, 0
    for line in lines:
        if own := re.findall(r"[^\x20\x09-\x0D]+", line):
            if line in known:
                dup += 1
                chars += sum(map(len, own))
            known.add(line)
    grams = []
    for n in lengths:
        seen, inside = set(), set()
        for i, w in enumerate(windows(n)):
            if w in seen:
                inside.update(range(i, i + n))
            seen.add(w)
        grams.append(sum(len(words[j]) for j in inside))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), chars, *grams)


def test_measures(spark):
    want = [(r[0], *brute(r[1] or "")) for r in rows()]
    got = repetition(documents(spark).repartition(3))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert repetition(empty(spark)).collect() == []


def test_verdicts_and_the_filter_agree(spark):
    judged = verdicts(repetition(documents(spark))).collect()
    for r in judged:
        assert r.base_failed == (r.n_words < MIN_WORDS or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = keep_clean(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in judged if r.kept)
    assert keep_clean(empty(spark)).collect() == []
