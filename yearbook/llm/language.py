"""Language identification: blended-spectrum string kernels with Nystroem landmarks.

The kernel of two texts is the number of character n-grams, of one to three characters,
that both hold, over the geometric mean of how many each holds. Landmarks, some labelled
texts of each language, span the feature space; kernel ridge regression, one language
against the rest, is solved in it. Whole texts are scored in batches: a presence matrix
of texts by n-grams times the landmarks' presence gives the kernels, kernels times
coefficients the scores. Both factors of the second product are fixed, so they are
multiplied once, and a batch takes one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearbook.llm.columns import passes, texts_of
from yearbook.llm.tables import written

#: Labelled rows of one language that the fit uses at most, those of least hash, and of all
#: languages together; with many languages each has its part of them, ``LEAST_ROWS`` at least.
FIT_ROWS, ALL_ROWS, LEAST_ROWS = 500, 8000, 4
#: The longest text among them, in bytes; a language without a shorter one is learned from its
#: shortest texts.
FIT_BYTES = 20_000
#: Landmarks of one language, and of all together; each has one at least.
LANDMARKS, ALL_LANDMARKS = 64, 1024
RIDGE = 1e-3
#: Characters with a code of their own; all others share ``OTHERS`` codes.
ALPHABET, OTHERS = 96, 16
#: Texts in one matrix product, and the bytes that bound a pass.
BATCH = 256
PASS_BYTES = 4 << 20


class Alphabet:
    """Codes of characters: 0 for anything that is no letter, and runs of it count once."""

    def __init__(self, letters: np.ndarray):
        self.size = 1 + len(letters) + OTHERS
        self.letters = np.sort(letters)
        self.table = np.zeros(0x110000, np.uint8)
        self.table[128:] = 1 + len(letters) + np.arange(0x110000 - 128) % OTHERS
        self.table[self.letters] = 1 + np.arange(len(letters))

    def codes(self, text: str) -> np.ndarray:
        got = self.table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        kept = np.ones(len(got), bool)
        kept[1:] = (got[1:] != 0) | (got[:-1] != 0)
        return np.concatenate([[0], got[kept], [0]]).astype(np.int64)

    def grams(self, text: str) -> np.ndarray:
        """Distinct n-grams of a text as numbers under ``size + size ** 2 + size ** 3``."""
        c, a = self.codes(text), self.size
        two = c[:-1] * a + c[1:]
        three = two[:-1] * a + c[2:]
        present = np.zeros(a + a * a + a**3, bool)
        present[c] = True
        present[a + two] = True
        present[a + a * a + three] = True
        return np.flatnonzero(present)


class Classifier:
    """Weights of n-grams for each language."""

    def __init__(self, alphabet: Alphabet, languages: list[str], place: np.ndarray, weights: np.ndarray, constants: np.ndarray):
        """``place``: the row of ``weights`` for each n-gram, 0 for those no landmark holds."""
        self.alphabet, self.languages, self.place, self.weights, self.constants = alphabet, languages, place, weights, constants
        self.last = np.zeros(len(place), np.int32)

    def presence(self, text: str, out: np.ndarray) -> int:
        """Mark in ``out`` the landmarks' n-grams that a text holds; how many it holds in all."""
        c, a = self.alphabet.codes(text), self.alphabet.size
        two = c[:-1] * a + c[1:]
        three = two[:-1] * a + c[2:]
        distinct = 0
        for grams in (c, a + two, a + a * a + three):
            out[self.place[grams]] = 1
            nth = np.arange(len(grams), dtype=np.int32)
            self.last[grams] = nth  # of equal n-grams one stays
            distinct += np.count_nonzero(self.last[grams] == nth)
        out[0] = 0
        return distinct

    def scores(self, texts: list[str]) -> np.ndarray:
        present = np.zeros((len(texts), len(self.weights)), np.float32)
        norms = np.array([self.presence(t, row) for t, row in zip(texts, present, strict=True)])
        return present @ self.weights / np.sqrt(norms)[:, None] + self.constants


def fit_rows(texts: list[str], labels: list[str]) -> Classifier:
    """Landmarks, Nystroem features and kernel ridge regression, on the given rows."""
    languages = sorted(set(labels))
    landmarks = max(1, min(LANDMARKS, ALL_LANDMARKS // len(languages)))
    characters = np.frombuffer("".join(texts).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points, counts = np.unique(characters, return_counts=True)
    letters = np.array([chr(p).isalpha() for p in points], bool)
    points, counts = points[letters], counts[letters]
    alphabet = Alphabet(points[np.lexsort((points, -counts))[:ALPHABET]])
    rows_of: dict[str, list[int]] = {g: [] for g in languages}
    for i, g in enumerate(labels):
        rows_of[g].append(i)
    chosen = [i for g in languages for i in rows_of[g][:landmarks]]
    sets = [alphabet.grams(t) for t in texts]
    known = np.unique(np.concatenate([sets[i] for i in chosen]))
    place = np.zeros(alphabet.size + alphabet.size**2 + alphabet.size**3, np.int32)
    place[known] = 1 + np.arange(len(known))
    norms = np.sqrt([len(s) for s in sets])
    presence = np.zeros((len(chosen), len(known) + 1), np.float32)
    for row, i in zip(presence, chosen, strict=True):
        row[place[sets[i]]] = 1
    kernel = np.empty((len(texts), len(chosen)))  # of all rows with the landmarks
    for i, s in enumerate(sets):
        kernel[i] = presence[:, place[s][place[s] > 0]].sum(axis=1) / norms[i] / norms[chosen]
    # Nystroem: the landmarks' kernel to the power -1/2 turns kernels into features
    values, vectors = np.linalg.eigh(kernel[chosen])
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = kernel @ root
    # Each side of a language weighs the same, so its normal matrix is that of all rows and that
    # of its own rows, each times a weight.
    x = np.c_[features, np.ones(len(features))]
    ridge = RIDGE * len(texts) * np.diag([*np.ones(features.shape[1]), 0.0]) + 1e-9 * np.eye(x.shape[1])
    all_, sums = x.T @ x, x.sum(axis=0)
    weights, constants = [], []
    for g in languages:
        own = x[rows_of[g]]
        share = len(own) / len(x)
        inside, outside = (0.5 / share, 0.5 / (1 - share)) if share < 1 else (1.0, 1.0)
        squares, ones = own.T @ own, own.sum(axis=0)
        normal = inside * squares + outside * (all_ - squares) + ridge
        solved = np.linalg.solve(normal, inside * ones - outside * (sums - ones))
        weights.append(root @ solved[:-1])
        constants.append(solved[-1])
    folded = (presence / norms[chosen][:, None]).T @ np.stack(weights, 1)
    return Classifier(alphabet, languages, place, folded.astype(np.float32), np.array(constants))


def fold(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 5


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Classifier | None:
    """A classifier of every language that a row outside the held-out fold is labelled with;
    None where none is. The different texts of each language are counted over all rows;
    only rows under a hash bound, a little more than are used, are moved."""
    rows = docs.where(F.col(lang_col).isNotNull() & (fold(id_col) != 0) & F.col(text_col).rlike(r"\p{L}"))
    rows = rows.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.octet_length(text_col).alias("bytes"), F.pmod(F.xxhash64(text_col), F.lit(1 << 40)).alias("h"),
    )
    short = F.col("bytes") <= FIT_BYTES
    counts = rows.groupBy("lang").agg(F.approx_count_distinct(F.when(short, F.col("h"))).alias("n"), F.min("bytes").alias("least"))
    counts, _ = written(counts, "language-counts")  # a row for each language
    number = counts.count()
    if not number:
        return None
    most = max(LEAST_ROWS, min(FIT_ROWS, ALL_ROWS // number))
    bound = F.when(F.col("n") > 0, F.least(F.lit(1 << 40), F.floor(F.lit((1 << 40) * 2.0 * most) / F.col("n"))))
    wanted = rows.join(F.broadcast(counts.select("lang", "least", bound.alias("bound"))), "lang")
    near = wanted.where(F.when(F.col("bound").isNull(), F.col("bytes") == F.col("least")).otherwise(short & (F.col("h") < F.col("bound"))))
    near, _ = written(near.select("lang", "text", "h").dropDuplicates(["lang", "h"]), "language-rows")
    first = Window.partitionBy("lang").orderBy("h", "text")
    sample = near.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= most).orderBy("lang", "nth").select("lang", "text").collect()
    return fit_rows([r.text for r in sample], [r.lang for r in sample])


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` for every row of ``docs``.

    Learned from rows with a language whose crc32 of the id as text, mod 5, is not 0, the
    held-out fold. ``score`` is the regression's value for the language, from [-1, 1] to
    [0, 1].

    Null texts and texts without a letter are ``und`` with score 0, and so is any text if
    no row is labelled; rows without an id are scored and never learned from; ties go to
    the first language by name; repeated rows each have their row; an empty table gives no
    rows; other columns are not read. Texts of any length are read whole.
    """
    model = fit(docs, id_col, text_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, 2, PASS_BYTES):
            texts, told = texts_of(batch, 2), batch.column(3).to_numpy(zero_copy_only=False)
            names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
            at = np.flatnonzero(told) if model else []
            for a in range(0, len(at), BATCH):
                some = at[a : a + BATCH]
                got = model.scores(texts.take(pa.array(some)).to_pylist())
                best = got.argmax(axis=1)
                names[some] = np.array(model.languages, object)[best]
                scores[some] = np.clip((got.max(axis=1) + 1) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(names, pa.string()), pa.array(scores)], names=["id", "held_out", "lang_pred", "score"])

    told = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"), told.alias("told"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)
