"""Arrow and numpy helpers for the operators: batches by bytes, words, shingles."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that one numpy pass works on; a longer text is a pass of its own.
PASS_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32
_LOWER[_SPACE] = 0x20
_PLAIN = _SAME.copy()
_PLAIN[_SPACE] = 0x20

#: Letters only: other ASCII becomes space, bytes of other characters stay.
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[65:91] = _LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = _SAME[128:]

_U = np.uint64


def texts_of(batch: pa.RecordBatch, column: int | str) -> pa.Array:
    """The texts of a batch, null as empty, with 64-bit offsets."""
    return pc.fill_null(batch.column(column).cast(pa.large_string()), "")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each starts (one more entry: the end)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def passes(batches: Iterator[pa.RecordBatch], column: int | str, most: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``most`` bytes of text each, or one row.
    ``column`` has the texts, or how many bytes they have."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        sizes = texts if pa.types.is_integer(texts.type) else pc.binary_length(texts)
        sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < len(sizes):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


class Words(NamedTuple):
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts."""

    code: np.ndarray  # for each word, its place in ``vocabulary``
    vocabulary: pa.Array  # the distinct words, each with a space behind it
    bounds: np.ndarray  # text i has the words bounds[i] to bounds[i + 1]
    chars: np.ndarray  # code points of each word


def words_of(texts: pa.Array, lower: bool, letters: bool = False) -> Words:
    """All words, exactly; ``lower`` turns A-Z into a-z first. ``letters``: runs of
    letters (and of characters outside ASCII), lower-cased."""
    table = (_LETTERS if letters else _LOWER if lower else _PLAIN).tobytes()
    data, starts = text_bytes(pc.binary_join_element_wise(texts, pa.scalar("", texts.type), pa.scalar(" ", texts.type)))
    flat = np.frombuffer(data.tobytes().translate(table), np.uint8)
    space = flat == 0x20
    after = np.empty(len(space), bool)  # what stands before is space, or nothing
    if len(space):
        after[0], after[1:] = True, space[:-1]
    last = np.flatnonzero(space & ~after)  # the space behind each word
    flat = flat[~(space & after)]
    ends = np.flatnonzero(flat == 0x20) + 1
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    array = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    coded = array.dictionary_encode()
    sizes = np.diff(offsets) - 1
    inner = np.flatnonzero((flat & 0xC0) == 0x80)  # bytes that begin no character
    sizes -= np.bincount(np.searchsorted(ends, inner, "right"), minlength=len(ends)).astype(np.int64)
    return Words(coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, np.searchsorted(last, starts), sizes)


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix64: spreads sums of products over all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word."""
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words.vocabulary.to_pylist()), _U, len(words.vocabulary))
    return own[words.code] if len(own) else np.zeros(0, _U)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` hashes; entry i is the run that starts there."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, _U)
    total = np.zeros(count, _U)
    factors = mixed(np.arange(1, n + 1, dtype=_U)) | _U(1)
    for k in range(n):
        total += hashes[k : k + count] * factors[k]
    return mixed(total + _U(n))


def shingle_sets(texts: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """For each text, the sorted distinct hashes of its ``n``-word shingles.

    A-Z are lower-cased. A text of fewer words has one shingle, all its words; a text
    without a word has none.
    """
    words = words_of(texts, lower=True)
    hashes = word_hashes(words)
    runs = window_hashes(hashes, n)
    for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        if b - a >= n:
            yield np.unique(runs[a : b - n + 1])
        else:
            yield window_hashes(hashes[a:b], int(b - a)) if b > a else runs[:0]
