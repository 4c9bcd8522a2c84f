"""Toxicity: two Kneser-Ney models of words, one for each class, over shared counts.

A word is spelt byte by byte, each byte given up to seven before it in the word (a space
bounds it). A class's highest order holds its own discounted counts; what the discount
frees goes to lower orders, whose continuation counts both classes share, so a spelling
that one class has not seen costs it no more than its rarity, and one that neither has
seen tells which of them frees more after the bytes before it. The log-likelihoods of both
classes are compared by their length: over the whole text for each byte, and over the
words that differ most.

The counts come from all labelled texts of two of four folds; a third fold, never counted,
sets the scale of the score. Every n-gram scores: the ratios stay in the shared folder and
meet the distinct words of the texts by a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearbook.llm.columns import Words, passes, text_bytes, texts_of, words_of
from yearbook.llm.tables import Scratch, bit_filter, drop, kept, passes_filter, release, written

#: Bytes of an n-gram, and the orders that the classes share.
ORDER, SHARED = 8, (7, 5, 3, 1)
DISCOUNT = 0.8
#: Words that differ most, as features: the first, and the mean of so many.
PEAK = 3
#: Words whose ratios go to all tasks, about (16 bytes each): the most frequent. All others
#: get theirs by a join, so this decides the work and no result.
COMMON_WORDS = 1 << 18
#: Bytes of a chunk of sorted words that meets the model at once.
CHUNK_BYTES = 1 << 19
#: Ratios are added as whole numbers of such parts: sums don't depend on their order.
PARTS = 1 << 28
#: Labelled rows of the third fold that set the scale, about; chosen by hash.
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.3

_U = np.uint64

#: How a function stores a table that it reads more than once: ``kept``, or for a while.
Store = Callable[[DataFrame, str], DataFrame]


def grams_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the distinct words, and where each word's begin."""
    vocabulary = words.vocabulary
    spaced = pc.binary_join_element_wise(pa.scalar(b" ", vocabulary.type), vocabulary, pa.scalar(b"", vocabulary.type))
    data, starts = text_bytes(spaced)
    flat = data.astype(_U)
    depth = np.arange(len(flat)) - np.repeat(starts[:-1], np.diff(starts))
    grams = flat.copy()
    for k in range(1, min(ORDER, len(flat))):
        earlier = np.zeros(len(flat), _U)
        earlier[k:] = flat[:-k]
        earlier[depth < k] = 0
        grams |= earlier << _U(8 * k)
    return grams[depth > 0], (starts - np.arange(len(starts)))[:-1]


def _words(texts: pa.Array) -> Words:
    return words_of(pc.utf8_lower(texts), False, letters=True)


class Model:
    """For each n-gram the log of its likelihood in toxic text over that in other text, in
    one process: the plain version of ``features``."""

    def __init__(self, grams: np.ndarray, ratios: np.ndarray, back_offs: dict[int, float] | None = None):
        """``back_offs``: by context, the ratio of n-grams that are not among ``grams``."""
        order = np.argsort(grams)
        self.grams, self.ratios = grams[order], ratios[order].astype(np.float32)
        self.back_offs = back_offs or {}

    def features(self, texts: pa.Array) -> np.ndarray:
        """For each text the mean ratio of its bytes, the largest of its words, and the
        mean of the ``PEAK`` largest; 0 where there is no word."""
        words = _words(texts)
        out = np.zeros((len(texts), 3))
        if not len(words.code) or not len(self.grams):
            return out
        grams, starts = grams_of(words)
        place = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        unseen = np.array([self.back_offs.get(h, 0.0) for h in (grams >> _U(8)).tolist()])
        ratio = np.where(self.grams[place] == grams, self.ratios[place], unseen).astype(np.float64)
        own = np.add.reduceat(ratio, starts)[words.code]
        size = np.diff(np.append(starts, len(grams)))[words.code]
        for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
            if b > a:
                part = own[a:b]
                top = np.partition(part, len(part) - PEAK)[-PEAK:] if len(part) > PEAK else part
                out[i] = part.sum() / size[a:b].sum(), top.max(), top.mean()
        return out


def fold(id_col: str) -> Column:
    """crc32 of the id as text, mod 4; null ids are in no fold."""
    return F.crc32(F.col(id_col).cast("string")) % 4


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, store: Store = kept) -> DataFrame:
    """Stored ``(text, toxic, fold)`` of rows with a label outside the held-out fold. Texts
    without one are held back by a bounded filter before the shuffle."""
    known = labels.where(F.col(label_col).isNotNull() & (fold(id_col) != 2)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    wanted = bit_filter(known.select(F.xxhash64("id").alias("key")), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).view(_U)
            yield batch.filter(pa.array(passes_filter(wanted, keys)))

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("key"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    near = rows.mapInArrow(run, f"id {kind}, key bigint, text string")
    return store(near.join(known, "id").select("text", "toxic", fold("id").alias("fold")), "toxicity-rows")


def _counted(labelled: DataFrame, store: Store = kept) -> DataFrame:
    """Stored ``(gram, toxic, other)``: how often each n-gram occurs in either class, over
    all rows of the first two folds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def summed() -> np.ndarray:
            all_ = np.concatenate(held)
            grams, place = np.unique(all_["gram"], return_inverse=True)
            out = np.zeros(len(grams), _COUNT)
            out["gram"] = grams
            for name in ("toxic", "other"):
                out[name] = np.bincount(place, all_[name], len(grams)).astype(np.int64)
            return out

        def rows(counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts["gram"].view(np.int64)), pa.array(counts["toxic"]), pa.array(counts["other"])], names=["gram", "toxic", "other"])

        for batch in passes(batches, 0):
            words = _words(texts_of(batch, 0))
            grams, starts = grams_of(words)
            toxic = np.repeat(batch.column(1).to_numpy(zero_copy_only=False) == 1, np.diff(words.bounds))
            size = np.diff(np.append(starts, len(grams)))
            new = np.zeros(len(grams), _COUNT)
            new["gram"] = grams
            for name, mark in (("toxic", toxic), ("other", ~toxic)):
                new[name] = np.repeat(np.bincount(words.code[mark], minlength=len(starts)), size)
            held.append(new)
            if sum(map(len, held)) > 1 << 21:
                held = [summed()]
                if len(held[0]) > 1 << 20:
                    yield rows(held.pop())
        if held:
            yield rows(summed())

    counts = labelled.where("fold in (0, 1)").select("text", "toxic").mapInArrow(run, "gram bigint, toxic bigint, other bigint")
    return store(counts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "toxicity-grams")


_COUNT = np.dtype([("gram", "<u8"), ("toxic", "<i8"), ("other", "<i8")])


def _suffix(gram: str, n: int) -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << 8 * n) - 1))


def _context(gram: str) -> Column:
    return F.shiftrightunsigned(gram, 8)


def _shared(grams: DataFrame, store: Store = kept) -> DataFrame:
    """``(g, p)``: Kneser-Ney probability of the last byte of each n-gram of the highest
    shared order, by how many longer n-grams end in it, in either class."""
    tables, above = [], grams.select(F.col("gram").alias("g"))
    for n in SHARED:
        above = store(above.groupBy(_suffix("g", n).alias("g")).agg(F.count("*").alias("c")), f"toxicity-order{n}")
        tables.append((n, above))
    p = None
    for n, table in reversed(tables):
        context = table.groupBy(_context("g").alias("h")).agg(F.sum("c").alias("total"), F.count("*").alias("types"))
        here = table.withColumn("h", _context("g")).join(context, "h")
        if p is None:
            p = here.select("g", (F.col("c") / F.col("total")).alias("p"))
        else:
            lower = p.select(F.col("g").alias("low"), F.col("p").alias("q"))
            own = F.greatest(F.col("c") - DISCOUNT, F.lit(0.0)) / F.col("total")
            rest = DISCOUNT * F.col("types") / F.col("total") * F.col("q")
            p = here.withColumn("low", _suffix("g", shorter)).join(lower, "low").select("g", (own + rest).alias("p"))
        shorter = n
    return p


def _contexts(grams: DataFrame) -> DataFrame:
    """For each context ``h`` how often either class goes on from it, and to how many bytes."""
    return grams.groupBy(_context("gram").alias("h")).agg(
        *(f(F.col(c) if f is F.sum else F.when(F.col(c) > 0, 1)).alias(f"{c}_{name}") for c in ("toxic", "other") for f, name in ((F.sum, "total"), (F.count, "types")))
    )


def _freed(c: str) -> Column:
    """The share of a class that the discount frees after a context."""
    return F.when(F.col(f"{c}_total") > 0, DISCOUNT * F.col(f"{c}_types") / F.greatest(F.col(f"{c}_total"), F.lit(1))).otherwise(1.0)


def _back_offs(grams: DataFrame) -> DataFrame:
    """``(h, ratio)`` for every context: the ratio of an n-gram that neither class has seen
    after it, whose shared probability is the same for both. After an unseen context, which
    is not here, both free all: 0."""
    return _contexts(grams).select("h", (F.log(_freed("toxic")) - F.log(_freed("other"))).alias("ratio"))


def _ratios(grams: DataFrame, store: Store = kept) -> DataFrame:
    """``(gram, ratio)`` for every n-gram."""
    all_ = grams.withColumn("h", _context("gram")).withColumn("g", _suffix("gram", SHARED[0])).join(_contexts(grams), "h").join(_shared(grams, store), "g")

    def likelihood(c: str) -> Column:
        total = F.greatest(F.col(f"{c}_total"), F.lit(1))
        return F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / total + _freed(c) * F.col("p")

    ratio = F.log(likelihood("toxic")) - F.log(likelihood("other"))
    return all_.select("gram", ratio.alias("ratio"))


def _heaviest(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows of the greatest weight: those over a quantile that a sketch
    finds, so no task sees all of them."""
    total = rows.count()
    if total <= most:
        return rows
    cut = rows.agg(F.percentile_approx("weight", 1 - most / total, 10_000).alias("cut")).first()["cut"]
    return rows.where(F.col("weight") > cut).limit(most * 11 // 10)


def scale(features: np.ndarray, toxic: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression, the last one its constant."""
    if not len(toxic) or toxic.min() == toxic.max():  # nothing to tell apart
        return np.array([0.0, 0.0, 0.0, -5.0 if not len(toxic) or not toxic.max() else 5.0])
    x = np.c_[features, np.ones(len(features))]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - toxic) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), slope)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def _word_keys(vocabulary: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary.to_pylist()), _U, len(vocabulary)).view(np.int64)


def _vocabulary(docs: DataFrame, text_col: str, store: Store = kept) -> DataFrame:
    """Stored ``(letters, weight)``: the distinct words of all texts, each with a space
    behind it, and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, 0):
            words = _words(texts_of(batch, 0))
            n = np.bincount(words.code, minlength=len(words.vocabulary)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([words.vocabulary.cast(pa.binary()), pa.array(n)], names=["letters", "n"])

    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "letters binary, n bigint")
    return store(counts.groupBy("letters").agg(F.sum("n").cast("double").alias("weight")), "toxicity-words")


def _word_ratios(vocabulary: DataFrame, ratios: DataFrame, back_offs: DataFrame) -> DataFrame:
    """Stored ``(word, weight, own)``: a hash of each word and the sum of its ratios, in
    ``PARTS``, those of unseen n-grams by their contexts.

    Words are sorted and cut into chunks of ``CHUNK_BYTES``. A chunk asks once for each
    context, and gets all that follows it.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(passes(batches, 0, CHUNK_BYTES)):
            chunk = np.full(batch.num_rows, part << 32 | i)
            yield pa.RecordBatch.from_arrays([pa.array(chunk), *batch.columns], names=["chunk", "letters", "weight"])

    def spelt(letters: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return grams_of(Words(np.arange(0), letters.cast(pa.large_binary()), np.arange(1), np.arange(1)))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            for chunk in np.unique(chunks):
                contexts = np.unique(spelt(batch.column(1).filter(pa.array(chunks == chunk)))[0] >> _U(8))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(contexts), chunk)), pa.array(contexts.view(np.int64))], names=["chunk", "h"])

    def summed(words: pa.Table, answers: pa.Table) -> pa.Table:
        letters = words["letters"].combine_chunks()
        grams, starts = spelt(letters)
        h, last, part = (answers[c].to_numpy() for c in ("h", "last", "part"))
        total = np.zeros(len(grams), np.int64)
        # the ratio after a context first, then that of the n-gram itself
        for own, keys, values in ((grams >> _U(8), h[last < 0], part[last < 0]), (grams, h[last >= 0] << 8 | last[last >= 0], part[last >= 0])):
            order = np.argsort(keys.view(_U))
            keys, values = keys.view(_U)[order], values[order]
            if len(keys):
                place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                total = np.where(keys[place] == own, values[place], total)
        return pa.table({"word": _word_keys(letters), "weight": words["weight"], "own": np.add.reduceat(total, starts)})

    ordered = vocabulary.repartitionByRange("letters").sortWithinPartitions("letters")
    chunked, path = written(ordered.mapInArrow(cut, "chunk bigint, letters binary, weight double"), "toxicity-chunks")
    release(vocabulary.sparkSession)
    wanted = chunked.select("chunk", "letters").mapInArrow(asked, "chunk bigint, h bigint").distinct()
    part = F.round(F.col("ratio") * PARTS).cast("bigint").alias("part")
    known = ratios.select(_context("gram").alias("h"), F.col("gram").bitwiseAND(F.lit(255)).alias("last"), part)
    model = known.unionByName(back_offs.select("h", F.lit(-1).cast("bigint").alias("last"), part))
    answers = wanted.join(model, "h").select("chunk", "h", "last", "part")
    own = chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(summed, "word bigint, weight double, own bigint")
    made, _ = written(own, "toxicity-word-ratios")
    drop(vocabulary.sparkSession, path)
    release(vocabulary.sparkSession)
    return made


def most_frequent(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and ratios of the most frequent words, sorted by key; behind them one that is no key."""
    common = _heaviest(words, COMMON_WORDS).select("word", "own").toArrow()
    keys, own = common["word"].to_numpy(), common["own"].to_numpy()
    order = np.argsort(keys)
    return np.append(keys[order], 0), np.append(own[order], 0)


def features(rows: DataFrame, words: DataFrame, common: tuple[np.ndarray, np.ndarray] | None = None, store: Store = kept) -> DataFrame:
    """``rows`` with ``a``, ``b``, ``c`` in place of ``text``: what ``Model.features`` gives.

    ``words`` has the ratios of all words; one that is not there says nothing. Tasks count
    a text's words once. The ratios of the most frequent words (``common``) are with them;
    of other words the keys are stored and joined, which are no more than the text has words.
    """
    keys, own = common or most_frequent(words)
    others = [*(c for c in rows.columns if c != "text"), "row"]
    rare_type = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, len(others)):
            words = _words(texts_of(batch, len(others)))
            key = _word_keys(words.vocabulary)
            place = np.searchsorted(keys[:-1], key)
            known = (keys[place] == key) & (place < len(keys) - 1)
            ratio = np.where(known, own[place], 0)
            size = pc.binary_length(words.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
            totals, sizes, tops, rares = [], [], [], []
            for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
                code = words.code[a:b]
                sizes.append(int(size[code].sum()))
                rare, n = np.unique(code[~known[code]], return_counts=True)
                rares.append([{"word": w, "n": k} for w, k in zip(key[rare].tolist(), n.tolist(), strict=True)])
                part = ratio[code[known[code]]]
                totals.append(int(part.sum()))
                tops.append((np.partition(part, len(part) - PEAK)[-PEAK:] if len(part) > PEAK else part).tolist())
            columns = [pa.array(totals, pa.int64()), pa.array(sizes, pa.int64()), pa.array(tops, pa.list_(pa.int64())), pa.array(rares, rare_type)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*others, "total", "size", "top", "rare"])

    numbered = rows.withColumn("row", F.monotonically_increasing_id()).select(*others, "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.select(*others).schema)
    counted = numbered.mapInArrow(run, f"{kinds}, total bigint, size bigint, top array<bigint>, rare array<struct<word: bigint, n: bigint>>")
    held = store(counted, "toxicity-texts")
    rare = held.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n").join(words.select("word", "own"), "word", "left")
    rare = rare.select("row", "n", F.coalesce("own", F.lit(0)).alias("own"))
    most = F.flatten(F.collect_list(F.expr(f"array_repeat(own, cast(least(n, {PEAK}) as int))")))
    more = rare.groupBy("row").agg(F.sum(F.col("n") * F.col("own")).alias("more"), F.slice(F.sort_array(most, False), 1, PEAK).alias("peak"))
    none = F.expr("cast(array() as array<bigint>)")
    both = held.drop("rare").join(more, "row", "left").withColumn("top", F.slice(F.sort_array(F.concat("top", F.coalesce("peak", none)), False), 1, PEAK))
    named = [F.col(c) for c in others[:-1]]

    def part(value: Column) -> Column:
        return F.when(F.col("size") > 0, value / PARTS).otherwise(0.0)

    mean = F.aggregate("top", F.lit(0).cast("bigint"), lambda x, y: x + y) / F.size("top")
    total = F.col("total") + F.coalesce("more", F.lit(0))
    return both.select(*named, part(total / F.col("size")).alias("a"), part(F.get("top", F.lit(0))).alias("b"), part(mean).alias("c"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[DataFrame, tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The ratios of all words of ``docs``, those of the most frequent ones, and the scale,
    from labelled rows outside the held-out fold.

    Tables are dropped with their last reader; the ratios of the words stay. Counts cover every row of two folds, and every n-gram scores. The driver gets about
    ``COMMON_WORDS`` rows and ``CALIBRATION_ROWS``, and no more than a tenth above that.
    """
    orders, model, learned = (Scratch(docs.sparkSession) for _ in range(3))
    labelled = _labelled(docs, labels, id_col, text_col, label_col, learned.store)
    counts = _counted(labelled, model.store)
    release(docs.sparkSession)
    ratios = model.store(_ratios(counts, orders.store), "toxicity-ratios")
    orders.drop()
    words = _word_ratios(_vocabulary(docs, text_col, model.store), ratios, _back_offs(counts))
    model.drop()
    common = most_frequent(words)
    sample = labelled.where("fold = 3")
    share = min(1.0, CALIBRATION_ROWS / max(sample.count(), 1))
    spread = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 40))
    chosen = sample.where(spread < int(share * (1 << 40))).select("toxic", "text")
    seen = features(chosen, words, common, learned.store).limit(CALIBRATION_ROWS * 11 // 10).toPandas()
    learned.drop()
    return words, common, scale(seen[["a", "b", "c"]].to_numpy(float), seen["toxic"].to_numpy(float))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``(id, held_out, score, predicted, ratio)`` for every row of ``docs``. ``ratio`` is
    the log-likelihood ratio for each byte of the whole text.

    Labels are learned from rows whose crc32 of the id as text, mod 4, is not 2, the
    held-out fold; an id with several labels counts as toxic if one says so. Null, empty
    and wordless texts have ratio 0 and the score that goes with it; rows without an id
    are scored and never learned from; repeated rows each have their row; without any
    label the score is that of ordinary text; an empty table gives no rows; other columns
    are not read.
    """
    words, common, weights = fit(docs, labels, id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(fold(id_col) == 2, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    told = sum((F.col(c) * float(w) for c, w in zip("abc", weights[:-1], strict=True)), F.lit(float(weights[-1])))
    scored = features(rows, words, common).withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), told)))))
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.col("a").alias("ratio"))
