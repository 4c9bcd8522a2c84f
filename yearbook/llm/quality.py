"""Quality rules: how much of a text repeats itself.

Rolling hashes of word n-grams of several lengths, in numpy, give the share of a text's
characters that lies in n-grams and lines seen before in the same text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearbook.llm.columns import mixed, passes, text_bytes, texts_of, window_hashes, word_hashes, words_of

#: The largest share of word characters that may lie in repeated n-grams, by length, and
#: in repeated lines.
NGRAM_SHARES = {4: 0.25, 6: 0.20, 10: 0.15}
LINE_SHARE = 0.30
#: The most symbols (``n_symbols``) a text may have for each word.
SYMBOL_SHARE = 0.10
MIN_WORDS = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANK = " \t\r\v\f"


def repeated(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether its row has it twice or more, and whether it had it before."""
    both = mixed(keys ^ mixed(rows.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    later = np.zeros(len(keys), bool)
    any_ = np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, later


def covered(marks: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which words lie in a marked window of ``n`` words."""
    steps = np.zeros(size + 1, np.int64)
    at = np.flatnonzero(marks)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + n, -1)
    return np.cumsum(steps[:-1]) > 0


def repeated_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the word characters in them."""
    lines, known, count, chars = text.split("\n"), set(), 0, 0
    if len(lines) == 1 or len(set(lines)) == len(lines):
        return 0, 0
    for line in lines:
        if line.strip(_BLANK):
            if line in known:
                count += 1
                chars += len(line) - sum(map(line.count, _BLANK))
            known.add(line)
    return count, chars


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _measure(texts: pa.Array, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    words = words_of(texts, lower=False)
    hashes, bounds, size = word_hashes(words), words.bounds, len(words.code)
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    data, starts = text_bytes(texts)
    out = {"n_words": np.diff(bounds), "word_chars": _sums(words.chars, bounds), "n_symbols": _sums(_SYMBOL[data], starts)}
    lines = np.array([repeated_lines(t) for t in texts.to_pylist()], np.int64).reshape(-1, 2)
    out |= {"n_dup_lines": lines[:, 0], "dup_line_chars": lines[:, 1]}
    for n in (3, *lengths):
        runs = window_hashes(hashes, n)
        own = row[: len(runs)] == row[n - 1 :] if len(runs) else np.zeros(0, bool)  # inside one text
        at = np.flatnonzero(own)
        any_, later = repeated(runs[at], row[at])
        if n == 3:
            out["n_repeat_words"] = _sums(covered(_at(at[any_], len(runs)), 3, size), bounds)
        else:
            out[f"dup_{n}gram_chars"] = _sums(np.where(covered(_at(at[later], len(runs)), n, size), words.chars, 0), bounds)
    return out


def _at(places: np.ndarray, size: int) -> np.ndarray:
    marks = np.zeros(size, bool)
    marks[places] = True
    return marks


def repetition(docs: DataFrame, lengths: tuple[int, ...] = tuple(NGRAM_SHARES), keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, *keep, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    dup_line_chars, dup_<n>gram_chars ...)`` for every row of ``docs``.

    Words are runs without ASCII white space. ``dup_<n>gram_chars`` are the characters of
    words inside an n-gram that stood earlier in the same text, each counted once;
    ``dup_line_chars`` those in lines that stood earlier. ``n_repeat_words`` are words in
    3-word windows found twice or more, the first included.

    One narrow job over whole texts. Null and empty texts have 0 everywhere; repeated
    rows each have their row; an empty table gives no rows; columns other than ``keep``
    are not read, and a ``keep`` column may not have one of these names.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup_{n}gram_chars" for n in lengths)]
    place = 1 + len(keep)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, place):
            got = _measure(texts_of(batch, place), lengths)
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], *(pa.array(got[n].astype(np.int64)) for n in names)], names=[id_col, *keep, *names])

    rows = docs.select(id_col, *keep, F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(measure, schema + "".join(f", {n} bigint" for n in names))


def verdicts(measured: DataFrame, shares: dict[int, float] = NGRAM_SHARES, line_share: float = LINE_SHARE, symbol_share: float = SYMBOL_SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """``measured`` with ``base_failed`` (too short, or over half of the words in repeated
    3-word windows) and ``kept``: not failed, and no share of repeated characters passes
    its limit, nor do symbols."""
    chars = F.greatest("word_chars", F.lit(1))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    repeats = (F.col("dup_line_chars") > line_share * chars) | (F.col("n_symbols") > symbol_share * F.col("n_words"))
    for n, share in shares.items():
        repeats |= F.col(f"dup_{n}gram_chars") > share * chars
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & ~repeats)


def keep_clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all columns.

    The verdict is a column beside the text, so no join is needed and repeated rows are
    judged each for itself. Null, empty and blank texts have too few words and go; shares
    that equal a limit stay; an empty table gives an empty one.
    """

    def judge(texts: pa.Array) -> pa.Array:
        got = _measure(pc.fill_null(texts.cast(pa.large_string()), ""), tuple(NGRAM_SHARES))
        chars = np.maximum(got["word_chars"], 1)
        bad = (got["n_words"] < MIN_WORDS) | (100 * got["n_repeat_words"] > 50 * got["n_words"]) | (got["dup_line_chars"] > LINE_SHARE * chars)
        bad |= got["n_symbols"] > SYMBOL_SHARE * got["n_words"]
        for n, share in NGRAM_SHARES.items():
            bad |= got[f"dup_{n}gram_chars"] > share * chars
        return pa.array(~bad)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, place):
            yield batch.filter(judge(batch.column(place)))

    place = docs.columns.index(text_col)
    return docs.mapInArrow(select, docs.schema)
