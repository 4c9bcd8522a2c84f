"""Base spans against the patterns as written, and planted terms."""

from __future__ import annotations

import math
import random
import re

from tests.llm.cases import documents, empty, rows, sentence

from yearbook.llm.privacy import DISCOUNT, GENERALISE, REMOVE, base_spans, digest, luhn, masked, sanitised, sensitive_spans

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and total % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


TEXTS = [
    "mail a.b@c.de, or x@y, @z.de a@b@c.de q_@w-1.org.uk_t@u.v %@a.b", "1.2.3.4 256.1.1.1 1.2.3 1.2.3.4.5.6.7.8 001.02.0003.4 é9.9.9.9",
    "4970 8561 0163 8289 4970856101638289 49-70 8561-0163-8289 4970  8561 1234567890123 0000000000000", "+1 (743) 555-3824 +49.30.1234567 +1+12345678901 +1 2 3 +123456789012345 +1234567890123456",
    "4111 1111 1111 1111 é 日本 a@b.c 10.0.0.1 +44 20 7946 0958", "9" * 3000, "a" * 3000 + "@", "1." * 2000, "+1" * 500, "a@b.co_x@d.com a@b.c.@d.e",
]


def test_base_spans():
    r = random.Random(2)
    texts = TEXTS + ["".join(r.choices("a1.@+- ()%é9", k=60)) for _ in range(3000)]
    for text in texts:
        assert base_spans(text) == plain(text), text
    assert luhn("4970856101638289") and not luhn("4970856101638288")


def disclosing_corpus():
    """Many texts; "Zyxel" is near one address and nowhere else, "house" everywhere."""
    texts = [sentence(60, i) for i in range(300)]
    for i in range(6):
        texts.append(f"{sentence(30, 1000 + i)} {i}a agent Zyxel wrote house jo@secret.org of river,{i} {sentence(30, 2000 + i)}")
    texts += [texts[-1]] * 40 + [f"x{i} Qwerty copy@mail.org same context here" for i in range(2)]
    texts += ["once Hapax here solo@mail.org end"] * 50
    return texts


def test_terms_that_give_an_entity_away(spark):
    texts = disclosing_corpus()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.spans for r in sensitive_spans(frame).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        base = [tuple(s) for s in got[i] if s.kind not in ("general", "remove")]
        assert base == plain(text)
        words = {text[s.start : s.end] for s in got[i] if s.kind in ("general", "remove")}
        for term in ("Zyxel", "Qwerty", "Hapax"):  # in six texts, in two, in one and its copies
            assert (term in words) == (term in text)
        assert not words & {"house", "of"}
    masks = {r.doc_id: r.text for r in sanitised(frame).collect()}
    assert len(masks) == len(texts)
    assert not any("@" in t or "Zyxel" in t or "Qwerty" in t for t in masks.values())
    assert masks[len(texts) - 1] == "xxxx Xxxxx here [EMAIL] xxx"  # told by one text only: generalised


def test_awkward_rows(spark):
    texts = [*(t for _, t, *_ in rows()), *TEXTS]
    frame = documents(spark, texts).repartition(3)
    got = sensitive_spans(frame).select("doc_id", digest(__import__("pyspark").sql.functions.col("spans")).alias("s")).collect()
    want = [(r[0], ",".join(f"{k}:{a}:{b}" for k, a, b in plain(r[1] or ""))) for r in rows(texts)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sensitive_spans(empty(spark)).collect() == []
    masks = sanitised(frame)
    assert masks.columns == frame.columns and masks.count() == len(want)
    assert sanitised(empty(spark)).collect() == []


def test_masked_overlaps():
    assert masked("ab 10.0.0.1 Xy9", [("ip", 3, 11), ("remove", 9, 11), ("general", 12, 15)]) == "ab [IP] Xx0"


def test_a_passage_repeated_in_different_texts_discloses(spark):
    texts = [sentence(40, i) for i in range(200)]
    texts += [f"{sentence(20, 500 + i)} please write to our clerk Zyxel at jo@secret.org or come by at noon {sentence(20, 900 + i)}" for i in range(8)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert not any("Zyxel" in r.text for r in sanitised(frame).collect())


def test_a_disclosing_term_goes_at_all_its_places(spark):
    texts = [sentence(40, i) for i in range(200)]
    texts += [f"Zyxel, {sentence(20, 500 + i)} our clerk {'Zyxel' if i < 2 else 'there'} at jo@secret.org {sentence(30, 900 + i)} ZYXEL." for i in range(8)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert not any("zyxel" in r.text.lower() for r in sanitised(frame).collect())
    spans = {r.doc_id: r.spans for r in sensitive_spans(frame).collect()}
    assert all([texts[i][s.start : s.end].lower() for s in spans[i] if s.kind == "remove"].count("zyxel") == (3 if i < 202 else 2) for i in range(200, 208))


def plain_decisions(texts):
    """``{(entity, term): kind}`` by counting: nominated words beside an entity, then whole texts."""
    different = sorted(set(texts))
    spans = {t: plain(t) for t in different}
    def words(t):
        inside = [(a, b) for _, a, b in spans[t]]
        return [(m[0].lower(), *m.span()) for m in re.finditer(r"\w+(?:['’-]\w+)*", t) if not any(m.start() < b and a < m.end() for a, b in inside)]
    holding, terms, nominated = {}, {}, set()
    for t in different:
        own = words(t)
        for w in {w for w, _, _ in own}:
            terms.setdefault(w, set()).add(t)
        for kind, a, b in spans[t]:
            entity = (kind, t[a:b].lower())
            holding.setdefault(entity, set()).add(t)
            before, after = [w for w in own if w[2] <= a], [w for w in own if w[1] >= b]
            nominated |= {(entity, w) for w, _, _ in before[-5:] + after[:5]}
    out, total = {}, len(different)
    for entity, word in nominated:
        texts_of, both = holding[entity], len(holding[entity] & terms[word])
        content = math.log(total / len(texts_of))
        told = math.log((both - DISCOUNT) * total / (len(texts_of) * len(terms[word]))) / content if content > 0 else 0
        if told >= GENERALISE:
            out[entity, word] = "remove" if told >= REMOVE else "general"
    return out


def plain_terms(text, decisions):
    """The spans of a text's disclosing terms: ``(kind, start, end)``."""
    spans = plain(text)
    held = {(k, text[a:b].lower()) for k, a, b in spans}
    out = set()
    for m in re.finditer(r"\w+(?:['’-]\w+)*", text):
        kinds = {decisions.get((e, m[0].lower())) for e in held} - {None}
        if kinds and not any(m.start() < b and a < m.end() for _, a, b in spans):
            out.add(("remove" if "remove" in kinds else "general", *m.span()))
    return out


def test_decisions_are_those_of_plain_counts(spark):
    r = random.Random(8)
    vocabulary = [f"{a}{b}" for a in "bcdfghklm" for b in ("ana", "ivo", "une", "orro")]
    texts = []
    for i in range(160):
        own = r.choices(vocabulary, weights=[1 / (k + 1) for k in range(len(vocabulary))], k=25)
        for _ in range(r.choice([0, 0, 1, 2])):
            k = r.randrange(12)
            own[r.randrange(25)] = r.choice([f"ag{k}ent", f"Cl-{k}erk"]) + f" {k}p@mail.org " + r.choice([f"ag{k}ent", "river", f"x{r.randrange(40)}"])
        texts.append(" ".join(own))
    texts += texts[:40] * 2
    want = plain_decisions(texts)
    assert {"remove", "general"} <= set(want.values())
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    for row in sensitive_spans(frame).collect():
        assert {tuple(s) for s in row.spans if s.kind in ("remove", "general")} == plain_terms(texts[row.doc_id], want)


def test_clashing_names(spark):
    texts = disclosing_corpus()
    rows_ = [(i, t, 1, 2, "k", "t", 3.0) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows_, "doc_id bigint, text string, __key bigint, `key` bigint, doc string, terms string, `of` double")
    got = sanitised(frame)
    assert got.columns == frame.columns and got.count() == len(texts)
    assert not any("Zyxel" in r.text for r in got.collect())
