"""Fast exact tokenisation: texts are cut where no token can reach across, equal pieces
are encoded once.

A cut lies before ASCII white space that follows a character which is not white space,
and between an ASCII letter and a stop. Byte-level BPE and lower-casing BPE with word ends
both split there before any merge, the special tokens hold no such place (checked), and
Unicode normalisation composes nothing with it. So
the ids of a text are the ids of its pieces, one after the other, however long it is.

Other tokenizers (other models, other splitting, special tokens that a cut could part,
SentencePiece files) encode whole texts with their library.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from yearbook.llm.columns import text_bytes

_SPACES, _STOPS = b" \t\n\v\f\r", b".,;:!?"
_SPACE, _STOP, _LETTER = 1, 2, 3
_CLASS = bytes(
    _SPACE if c in _SPACES else _STOP if c in _STOPS else _LETTER if 65 <= c <= 90 or 97 <= c <= 122 else 0 for c in range(256)
)


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces start, in ascending order; text starts are among them."""
    kind = np.frombuffer(data.tobytes().translate(_CLASS), np.uint8)
    space = kind == _SPACE
    cut = np.zeros(len(data), bool)
    cut[1:] = space[1:] & ~space[:-1] | (kind[1:] == _STOP) & (kind[:-1] == _LETTER)
    # White space of more than one byte: U+0085, U+00A0, U+1680, U+2000-200A, U+2028,
    # U+2029, U+202F, U+205F, U+3000. A cut behind it would part a run of white space.
    at = np.flatnonzero(cut)
    at = at[data[at - 1] >= 0x80]
    last, mid, first = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    wide = (mid == 0xC2) & ((last == 0x85) | (last == 0xA0))
    wide |= (first == 0xE1) & (mid == 0x9A) & (last == 0x80)
    wide |= (first == 0xE2) & (mid == 0x80) & ((last <= 0x8A) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF))
    wide |= (first == 0xE2) & (mid == 0x81) & (last == 0x9F)
    wide |= (first == 0xE3) & (mid == 0x80) & (last == 0x80)
    cut[at[wide]] = False
    cut[starts[:-1][np.diff(starts) > 0]] = True
    return np.flatnonzero(cut)


def _runs(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs, one after the other: where each starts, and how long it is."""
    ends = np.cumsum(lengths)
    place = np.repeat(first - ends + lengths, lengths)
    place += np.arange(len(place))
    return place


class PieceEncoder:
    """Encodes pieces with one tokenizer file and keeps what it has encoded.

    The pieces kept are an Arrow array, so one dictionary encoding tells which pieces of a call
    are known, and only the others become Python texts. Beyond ``most_kept`` those stay that came
    in most calls, most used first; a call of few pieces looks only at the first of them, two for
    each of its own. ``batch_chars`` bounds the text of one call of the library. Pieces that are
    one word of letters go through the library's stages (normaliser, pre-tokenizer, model)
    directly, many words in a call; all others through ``encode``.
    """

    def __init__(self, path: str, most_kept: int = 600_000, batch_chars: int = 64 << 10):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.encoder.no_truncation()
        self.encoder.no_padding()
        self.most_kept, self.batch_chars = most_kept, batch_chars
        self.pieces = pa.array([], pa.large_string())
        self.start, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)  # ids end to end, and where each piece's are
        self.calls = np.zeros(0, np.int64)  # that each piece came in, halved when pieces go
        self.letters: dict[int, str | None] = {}  # what the pre-tokenizer makes of a letter
        self.lead = self._split(" a")[: -len(self._split("a"))]  # and of the space before a word

    def _split(self, text: str) -> str | None:
        """What the pre-tokenizer makes of ``text`` if it takes it as one."""
        parts = self.encoder.pre_tokenizer.pre_tokenize_str(text)
        return parts[0][0] if len(parts) == 1 else None

    def _batches(self, pieces: list[str], places: list[int]) -> Iterator[list[int]]:
        batch, size = [], 0
        for i in places:
            if batch and size + len(pieces[i]) > self.batch_chars:
                yield batch
                batch, size = [], 0
            batch.append(i)
            size += len(pieces[i])
        if batch:
            yield batch

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of tokens of each piece, and all ids in order."""
        words, others, done, sizes, ids = [], [], array("q"), array("q"), array("I")
        for i, p in enumerate(pieces):
            (words if p[0] == " " and p[1:].isalpha() else others).append(i)

        def add(batch: list[int], own: list[list[int]]) -> None:
            done.extend(batch)
            sizes.extend(map(len, own))
            ids.extend(itertools.chain.from_iterable(own))

        normalizer, tokenize, lead = self.encoder.normalizer, self.encoder.model.tokenize, self.lead
        for batch in self._batches(pieces, words):
            joined = "".join([pieces[i] for i in batch])
            normal = normalizer.normalize_str(joined) if normalizer else joined
            for c in set(joined).union(normal):
                if ord(c) not in self.letters and c != " ":
                    self.letters[ord(c)] = self._split(c) if c.isalpha() else None
            odd = {chr(c) for c, made in self.letters.items() if made is None}
            if normal.count(" ") != len(batch) or odd & set(normal):  # a letter the tokenizer does not take as one
                others += batch
                continue
            add(batch, [[t.id for t in tokenize(lead + word)] for word in normal.translate(self.letters).split(" ")[1:]])
        for batch in self._batches(pieces, others):
            add(batch, [e.ids for e in self.encoder.encode_batch_fast([pieces[i] for i in batch], add_special_tokens=False)])
        order, counts = np.argsort(np.array(done, np.int64)), np.array(sizes, np.int64)
        first = np.cumsum(counts) - counts
        return counts[order], np.array(ids, np.uint32)[_runs(first[order], counts[order])]

    def _shrink(self, most: int) -> None:
        """Keep the pieces that came in most calls; of equals the first."""
        kept = np.argsort(-self.calls, kind="stable")[:most]
        counts = np.diff(self.start)[kept]
        self.pieces, self.ids = self.pieces.take(pa.array(kept)), self.ids[_runs(self.start[kept], counts)]
        self.start, self.calls = np.append(0, np.cumsum(counts)), self.calls[kept] >> 1

    def _lookup(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each piece are among some ids, how many, and those ids."""
        if len(self.pieces) > self.most_kept:
            self._shrink(self.most_kept // 2)
        known = min(len(self.pieces), 2 * len(pieces))
        coded = pa.chunked_array([self.pieces[:known], pieces]).dictionary_encode().chunks[-1]
        code = coded.indices.to_numpy(zero_copy_only=False)
        counts, own = self._encode(coded.dictionary[known:].to_pylist())
        start = np.append(self.start[: known + 1], self.start[known] + np.cumsum(counts))
        ids = np.append(self.ids[: self.start[known]], own)
        if known == len(self.pieces):
            self.pieces, self.start, self.ids = coded.dictionary, start, ids
            self.calls = np.append(self.calls, np.zeros(len(counts), np.int64)) + (np.bincount(code, minlength=len(coded.dictionary)) > 0)
        return start[code], np.diff(start)[code], ids

    def __call__(self, texts: pa.Array, with_ids: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The number of tokens of each text, and all ids in order (none if not asked for)."""
        data, starts = text_bytes(texts)
        if not len(data):
            return np.zeros(len(texts), np.int64), np.zeros(0, np.uint32)
        at = cuts(data, starts)
        offsets = np.append(at, len(data)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        first, lengths, ids = self._lookup(pieces)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        totals = np.diff(ends[np.searchsorted(at, starts)])
        return totals, ids[_runs(first, lengths)] if with_ids else np.zeros(0, np.uint32)


def _types(part: dict | list | None) -> set[str]:
    """The types named anywhere in a part of a tokenizer file."""
    if isinstance(part, list):
        return set().union(*map(_types, part)) if part else set()
    if not isinstance(part, dict):
        return set()
    return ({part["type"]} if isinstance(part.get("type"), str) else set()).union(*map(_types, part.values()))


# What is known to split before white space and stops, and not to reach across them.
_SPLITTERS = {"Sequence", "Split", "ByteLevel"}
_NORMALISERS = {"Sequence", "NFC", "NFD", "NFKC", "NFKD", "Lowercase", "Replace"}
_SAMPLE = "ab Cd, ef.\ngh\tij; kl  mn! op? qr: st"


def cuts_are_safe(path: str) -> bool:
    """Whether texts may be encoded in pieces with this file: BPE without chance, known
    stages, every cut of a sample a split of the pre-tokenizer, and no special token that a cut
    could part or whose surroundings it takes."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    model = parts["model"]
    if model.get("type", "BPE") != "BPE" or "merges" not in model or model.get("dropout"):
        return False
    if not parts.get("pre_tokenizer") or not _types(parts["pre_tokenizer"]) <= _SPLITTERS or not _types(parts.get("normalizer")) <= _NORMALISERS:
        return False
    tokenizer = Tokenizer.from_file(path)
    for token in tokenizer.get_added_tokens_decoder().values():
        if token.lstrip or token.rstrip or token.content.isalpha() or set(token.content.encode()) & set(_SPACES + _STOPS):
            return False
    data = np.frombuffer(_SAMPLE.encode(), np.uint8)
    at = cuts(data, np.array([0, len(data)]))
    pieces = [_SAMPLE[a:b] for a, b in zip(at, [*at[1:], len(_SAMPLE)], strict=True)]

    def split(text: str) -> list[str]:
        normal = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
        return [part for part, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    return split(_SAMPLE) == [part for piece in pieces for part in split(piece)]


class WholeEncoder:
    """Whole texts through the library, ``batch_chars`` of them in a call."""

    def __init__(self, path: str, batch_chars: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.batch_chars = batch_chars
        if path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: processor.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.encode = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: pa.Array, with_ids: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """As ``PieceEncoder``."""
        counts, ids, batch, size = [], [], [], 0

        def flush() -> None:
            for own in self.encode(batch):
                counts.append(len(own))
                if with_ids:
                    ids.append(np.array(own, np.uint32))
            batch.clear()

        for text in texts.to_pylist():
            if batch and size + len(text) > self.batch_chars:
                flush()
                size = 0
            batch.append(text)
            size += len(text)
        if batch:
            flush()
        return np.array(counts, np.int64), np.concatenate(ids) if ids else np.zeros(0, np.uint32)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder | WholeEncoder:
    """One encoder for each file and Python worker: in pieces where the file allows it.
    Files of SentencePiece end in ``.model``."""
    return PieceEncoder(path) if not path.endswith(".model") and cuts_are_safe(path) else WholeEncoder(path)
