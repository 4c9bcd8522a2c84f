"""Personal data: base patterns, and terms that give protected entities away.

An entity is a value of a base pattern (an address, a number). Around each of its
occurrences the words in a window are nominated. Then whole texts are read, and different
ones counted, so copies of a document prove nothing. A term discloses an entity if what it tells about it, the
pointwise mutual information of both over the corpus, comes near to all there is to know,
the entity's information content::

    PMI(e; t) = log((n(e, t) - d) * N / (n(e) * n(t)))  >=  share * IC(e),  IC(e) = log(N / n(e))

``n(e)``, ``n(e, t)`` and ``n(t)`` count different texts with the entity, with both, with
the term, ``N`` all different texts; all counts are exact. ``d`` discounts what a few texts
seem to say: a term that shares one text with an entity and is in no other tells less than one
that shares many. Such a term is
removed wherever it stands in a text that holds the entity, or, if it tells less than
``REMOVE``, generalised to its shape.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearbook.llm.columns import passes, texts_of, words_of
from yearbook.llm.tables import bit_filter, passes_filter, written

KINDS = ("email", "ip", "card", "phone")
#: Words on either side of an entity that are nominated as terms.
WINDOW = 5
#: Texts that are taken off those which a term and an entity share.
DISCOUNT = 0.5
#: Shares of an entity's information content from which a term is generalised, removed.
GENERALISE, REMOVE = 0.8, 0.95

_LOCAL = "A-Za-z0-9._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails as an ip fails from each of its digits: start at its first.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_LOCAL = re.compile(f"[^{_LOCAL}]")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"\w+(?:['’-]\w+)*")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches in time linear in the text: from each ``@`` to both sides."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not _NOT_LOCAL.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by kind and then start. A match that fails
    its check is dropped and the search goes on behind it."""
    out = [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def occurrences(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, int]]:
    """``(term, start, end)`` of all words outside the spans."""
    at = 0
    for a, b in [*sorted((a, b) for _, a, b in spans), (len(text), len(text))]:
        for m in _WORD.finditer(text, at, max(at, a)):
            yield _hash(m[0].lower()), *m.span()
        at = max(at, b)


def contexts(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """For each span its entity, and the ``(term, start, end)`` in its context. Words
    of other spans are no terms."""
    inside = sorted((a, b) for _, a, b in spans)
    for kind, start, end in spans:
        left, right, reach = [], [], 64
        while len(left) < WINDOW:  # a longer stretch where words are long; its first word may be cut
            low = max(0, start - reach)
            left = [m.span() for m in _WORD.finditer(text, low, start)][1 if low else 0 :]
            if not low:
                break
            reach *= 4
        for m in _WORD.finditer(text, end):
            right.append(m.span())
            if len(right) == WINDOW:
                break
        near = [(a, b) for a, b in left[-WINDOW:] + right if not any(a < y and x < b for x, y in inside)]
        terms = [(_hash(text[a:b].lower()), a, b) for a, b in near]
        yield _hash(f"{kind}:{text[start:end].lower()}"), terms


def _terms(word: str) -> list[int]:
    """Hashes of the terms in a lower-cased word."""
    return [_hash(word)] if word.isalnum() else [_hash(m) for m in _WORD.findall(word)]


_NONE: list[int] = []
_STOPS = " .,;:!?()\"“”«»"

_SPAN = "array<struct<kind: string, start: bigint, end: bigint>>"
_TERM = "array<struct<entity: bigint, term: bigint, start: bigint, end: bigint>>"


def found_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, row, key, spans, entities, terms)`` for every row; ``row`` is unique, ``key`` a hash of the text."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    term = pa.list_(pa.struct([(n, pa.int64()) for n in ("entity", "term", "start", "end")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, 3):
            all_spans, all_entities, all_terms = [], [], []
            for text in texts_of(batch, 3).to_pylist():
                spans = base_spans(text)
                all_spans.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                near = list(contexts(text, spans))
                all_entities.append(sorted({e for e, _ in near}))
                all_terms.append([{"entity": e, "term": t, "start": a, "end": b} for e, terms in near for t, a, b in terms])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(all_spans, span), pa.array(all_entities, pa.list_(pa.int64())), pa.array(all_terms, term)], names=["id", "row", "key", "spans", "entities", "terms"])

    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, row bigint, key bigint, spans {_SPAN}, entities array<bigint>, terms {_TERM}")


def _documents_with(docs: DataFrame, text_col: str, candidates: DataFrame) -> DataFrame:
    """``(term, documents)``: how many different texts of the corpus hold each candidate.
    Whole texts are read; a bounded filter holds back most other words. Copies are made one
    by (term, text), so a frequent term is dealt to many tasks."""
    wanted = bit_filter(candidates, "term")

    def learn(words: list[bytes], known: dict[bytes, list[int]]) -> None:
        """The candidates among the terms of each word."""
        new = [w for w in words if w not in known]
        terms = [_terms(w.decode().strip(_STOPS).lower()) for w in new]
        hashes = np.fromiter((h for t in terms for h in t), np.int64)
        kept = iter(passes_filter(wanted, hashes.view(np.uint64)).tolist())
        for word, own in zip(new, terms, strict=True):
            known[word] = [h for h in own if next(kept)] or _NONE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, list[int]] = {}
        for batch in passes(batches, 0):
            words = words_of(texts_of(batch, 0), lower=False)
            if len(known) > 200_000:
                known.clear()
            vocabulary = words.vocabulary.to_pylist()
            learn(vocabulary, known)
            terms = [known[w] for w in vocabulary]
            if not any(terms):
                continue
            row = np.repeat(np.arange(batch.num_rows), np.diff(words.bounds))
            first = np.array([t[0] if t else 0 for t in terms], np.int64)[words.code]
            any_ = np.array([bool(t) for t in terms])[words.code]
            pairs = [np.stack([row[any_], first[any_]], 1)]
            several = np.array([len(t) > 1 for t in terms])
            if several.any():
                at = np.flatnonzero(several[words.code])
                pairs.append(np.array([(row[i], h) for i in at for h in terms[words.code[i]][1:]], np.int64).reshape(-1, 2))
            own = np.unique(np.concatenate(pairs), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(own[:, 1]), batch.column(1).take(pa.array(own[:, 0]))], names=["term", "key"])

    held = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key")).mapInArrow(run, "term bigint, key bigint")
    return held.distinct().groupBy("term").agg(F.count("*").alias("documents"))


def _places(found: DataFrame, docs: DataFrame, text_col: str, candidates: DataFrame, entities: DataFrame) -> DataFrame:
    """Stored ``(key, term, start, end)``: all places of candidate terms in texts that hold
    one of their entities (and of others that a bounded filter lets through)."""
    keys = found.select("key", F.explode("entities").alias("entity")).join(entities, "entity", "left_semi").select("key")
    holding, wanted = bit_filter(keys, "key"), bit_filter(candidates, "term")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            near = passes_filter(holding, whole.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
            for batch in passes(iter([whole.filter(pa.array(near))]), 0):
                rows = []
                for key, text in zip(batch.column(1).to_pylist(), texts_of(batch, 0).to_pylist(), strict=True):
                    rows += [(key, *o) for o in occurrences(text, base_spans(text))]
                columns = np.array(rows, np.int64).reshape(-1, 4)
                columns = columns[passes_filter(wanted, np.ascontiguousarray(columns[:, 1]).view(np.uint64))]
                yield pa.RecordBatch.from_arrays([pa.array(columns[:, i]) for i in range(4)], names=["key", "term", "start", "end"])

    texts = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))
    places = texts.mapInArrow(run, "key bigint, term bigint, start bigint, end bigint")
    return written(places.join(candidates.select("term").distinct(), "term", "left_semi").distinct().select("key", "term", "start", "end"), "privacy-places")[0]


def disclosing(found: DataFrame, docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Stored ``(entity, term, told)``: pairs whose term tells the share ``told`` of the
    entity's information content, ``GENERALISE`` or more; and ``_places``.

    Texts are made distinct before anything is counted, and counted with partial sums,
    so an entity or a copy with a third of all rows is no burden to one task. Entities and
    terms meet by text, so what is joined grows with the texts, not with an entity's rows.
    """
    held = found.select("key", F.explode("entities").alias("entity")).distinct()
    each = found.select("key", F.explode("terms").alias("t")).select("key", "t.entity", "t.term")
    entities = held.groupBy("entity").agg(F.count("*").alias("entity_n"))
    total = F.lit(float(max(found.select("key").distinct().count(), 1)))
    content = F.log(total / F.col("entity_n"))

    def told(both: Column, often: Column) -> Column:
        pmi = F.log((both - DISCOUNT) * total / (F.col("entity_n") * F.greatest(often, both)))
        return F.when(content > 0, pmi / content)

    # A term is in more texts of the corpus than of those with an entity near it, and with
    # an entity in no more than this one is. What tells too little even so needs no other.
    near = each.select("key", "term").distinct().groupBy("term").agg(F.count("*").alias("near"))
    nominated = each.select("entity", "term").distinct().join(entities, "entity").join(near, "term")
    candidates, _ = written(nominated.where(told(F.col("entity_n"), F.col("near")) >= GENERALISE).drop("near"), "privacy-pairs")
    places = _places(found, docs, text_col, candidates, candidates.select("entity").distinct())
    texts = places.select("key", "term").distinct()
    pairs = held.join(candidates, "entity", "left_semi").join(texts, "key").groupBy("entity", "term").agg(F.count("*").alias("both"))
    # a term is in more texts of the corpus than of those with an entity: most that tell too
    # little are known by these, and needn't be counted in the others
    known = texts.groupBy("term").agg(F.count("*").alias("known"))
    supported = candidates.join(pairs, ["entity", "term"]).join(known, "term").where(told(F.col("both"), F.greatest("both", "known")) >= GENERALISE)
    supported, _ = written(supported.drop("known"), "privacy-supported")
    corpus = _documents_with(docs, text_col, supported.select("term").distinct())
    all_ = supported.join(corpus, "term").select("entity", "term", told(F.col("both"), F.col("documents")).alias("told"))
    return written(all_.where(F.col("told") >= GENERALISE), "privacy-terms")[0], places


def sensitive_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, spans)`` for every row of ``docs``: base spans by kind and start, then
    the terms by start, as ``general`` or ``remove``. Offsets are code points, ends exclusive.

    Null and empty texts have no span; repeated rows each have their row, and count as one
    text; ties in the threshold disclose; an empty table gives no rows; other columns
    are not read.
    """
    found, _ = written(found_spans(docs, id_col, text_col), "privacy-spans")
    pairs, places = disclosing(found, docs, text_col)
    held = found.select("key", F.explode("entities").alias("entity")).distinct()
    kind = F.when(F.max("told") >= REMOVE, "remove").otherwise("general")
    told = held.join(pairs, "entity", "left_semi").join(places.select("key", "term").distinct(), "key").join(pairs, ["entity", "term"])
    hits = places.join(told.groupBy("key", "term").agg(kind.alias("kind")), ["key", "term"])
    more = hits.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("more"))
    added = F.transform(F.coalesce("more", F.expr("array()").cast("array<struct<start: bigint, end: bigint, kind: string>>")), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return found.join(more, "key", "left").select(F.col("id").alias(id_col), "key", F.concat("spans", added).alias("spans"))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def shape(term: str) -> str:
    """A term without what it says: letters as ``x`` or ``X``, digits as ``0``."""
    return "".join("0" if c.isdigit() else ("X" if c.isupper() else "x") if c.isalpha() else c for c in term)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with base spans as ``[KIND]``, general ones as shapes, removed ones as
    ``[TERM]``. Where spans overlap, one mark stands for what they cover together."""
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], shape(text[a:b]) if kind == "general" else f"[{'TERM' if kind == 'remove' else kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, with all columns, and its texts masked.

    Base spans are found again beside the text. Only disclosing terms come by a join, on
    the text's hash: spans depend on the text alone, so equal texts share them, and texts
    without such terms need none. ``n_chars``, if there, is left as it is.
    """
    spans = sensitive_spans(docs, id_col, text_col)
    hidden = spans.select(F.col("key").alias("of"), F.filter("spans", lambda s: s["kind"].isin("general", "remove")).alias("terms"))
    by_text = hidden.where(F.size("terms") > 0).groupBy("of").agg(F.first("terms").alias("terms"))
    # The caller's row is one struct, so no name of its columns can clash with ours.
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    keyed = docs.select(whole, F.xxhash64(F.col(text_col)).alias("key"))
    joined = keyed.join(by_text, F.col("key") == F.col("of"), "left").select("doc", "terms", F.col("doc")[text_col].alias("text"))
    fields, place = [f.name for f in docs.schema.fields], docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, 2):
            texts = []
            for text, terms in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    text = masked(text, base_spans(text) + [(t["kind"], t["start"], t["end"]) for t in terms or []])
                texts.append(text)
            out = batch.column(0).flatten()
            out[place] = pa.array(texts, out[place].type)
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(out, fields)], names=["doc"])

    return joined.mapInArrow(run, joined.select("doc").schema).select("doc.*")
