"""The kernel against its definition, and held-out accuracy."""

from __future__ import annotations

import random

import numpy as np
from tests.llm.cases import documents, empty

from yearbook.llm.language import FIT_BYTES, LANDMARKS, RIDGE, fit_rows, languages

SYLLABLES = {
    "aa": ["ka", "to", "mi", "ra", "shi", "ne", "u"], "bb": ["tsch", "ein", "ung", "äch", "ver", "heit", "keit"],
    "cc": ["tion", "eau", "ré", "ç", "aux", "elle", "les"], "дд": ["ого", "ть", "при", "ста", "вск", "ние"],
}


def text(lang, n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 4))) for _ in range(n))


def rows():
    r, out = random.Random(1), []
    for i in range(600):
        lang = r.choice(list(SYLLABLES))
        out.append((i, text(lang, r.choice([4, 30, 200]), i), lang if i % 7 else None))
    return out


def test_scores_are_those_of_the_kernel():
    texts, labels = zip(*[(t, g) for _, t, g in rows()[:120] if g], strict=True)
    model = fit_rows(list(texts), list(labels))
    got = model.scores(list(texts[:20]))
    for t, s in zip(texts[:20], got, strict=True):
        grams = set(model.alphabet.grams(t).tolist())
        own = model.weights[[model.place[g] for g in grams if model.place[g]]].sum(axis=0) / np.sqrt(len(grams)) + model.constants
        assert np.allclose(own, s, atol=1e-4)
    padded = "".join(c.lower() if c.isalpha() else " " for c in " " + texts[0] + " ")
    assert len({padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)}) == len(model.alphabet.grams(texts[0]))


def test_held_out_rows(spark):
    own = rows()
    frame = spark.createDataFrame(own, "doc_id bigint, text string, lang string").repartition(3)
    got = languages(frame).collect()
    truth = {i: next(g for g in SYLLABLES if t == text(g, len(t.split()), i)) for i, t, _ in own}
    held = [r for r in got if r.held_out]
    assert len(got) == len(own) and len(held) > 80 and all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.98 * len(held)


def test_awkward_rows(spark):
    got = {r.doc_id: r for r in languages(documents(spark).repartition(3)).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[2].lang_pred == "und" and got[0].score == 0
    assert got[8].lang_pred == "en" and not got[None].held_out
    assert languages(documents(spark)).count() == documents(spark).count()
    assert languages(empty(spark)).collect() == []
    bare = documents(spark).drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r.lang_pred for r in languages(bare).collect()} == {"und"}


def plain_kernel_ridge(texts, labels, alphabet):
    """Scores of the rows by the definition: kernels with the landmarks, the square root of
    their inverse, and weighted least squares for each language."""
    sets = [set(alphabet.grams(t).tolist()) for t in texts]
    names = sorted(set(labels))
    marks = [i for g in names for i in [j for j, x in enumerate(labels) if x == g][:LANDMARKS]]
    k = np.array([[len(a & sets[m]) / np.sqrt(len(a) * len(sets[m])) for m in marks] for a in sets])
    values, vectors = np.linalg.eigh(k[marks])
    z = k @ vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    out = []
    for g in names:
        y = np.array([1.0 if x == g else -1.0 for x in labels])
        w = np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean())
        x = np.c_[z, np.ones(len(z))]
        rows_, side = np.sqrt(w)[:, None] * x, np.sqrt(w) * y
        penalty = np.sqrt(RIDGE * len(y)) * np.eye(x.shape[1])
        penalty[-1, -1] = np.sqrt(1e-9)
        solved, *_ = np.linalg.lstsq(np.r_[rows_, penalty], np.r_[side, np.zeros(x.shape[1])], rcond=None)
        out.append(x @ solved)
    return np.stack(out, 1)


def test_fit_is_kernel_ridge_regression():
    texts, labels = zip(*[(t, g) for _, t, g in rows()[:200] if g], strict=True)
    model = fit_rows(list(texts), list(labels))
    want = plain_kernel_ridge(texts, labels, model.alphabet)
    assert np.allclose(model.scores(list(texts)), want, atol=2e-3)
    assert (model.scores(list(texts)).argmax(axis=1) == want.argmax(axis=1)).all()


def test_every_language_is_learned(spark):
    """Seventy languages, some rare, one of long texts only."""
    r, out = random.Random(9), []
    syllables = {f"l{k:02}": ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(5)] for k in range(70)}
    for i in range(2400):
        lang = f"l{i % 70:02}" if i < 1400 else r.choice([f"l{k:02}" for k in range(20)])
        words = 9000 if lang == "l66" else 40
        if lang == "l66" and i > 700:
            continue
        out.append((i, " ".join("".join(r.choices(syllables[lang], k=2)) for _ in range(words)), lang))
    frame = spark.createDataFrame(out, "doc_id bigint, text string, lang string").repartition(4)
    assert min(len(t) for _, t, g in out if g == "l66") > FIT_BYTES
    got = {x.doc_id: x for x in languages(frame).collect()}
    assert {x.lang_pred for x in got.values()} == set(syllables)
    held = [(g, got[i].lang_pred) for i, _, g in out if got[i].held_out]
    assert sum(a == b for a, b in held) > 0.95 * len(held)
