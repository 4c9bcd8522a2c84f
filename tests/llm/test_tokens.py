"""Token counts and packing against the tokenizer on whole texts."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tests.llm.cases import documents, empty, key, rows
from tokenizers import Tokenizer

from yearbook.llm.packing import pack, sequences
from yearbook.llm.pieces import PieceEncoder, WholeEncoder, cuts_are_safe, encoder
from yearbook.llm.tokencount import token_counts

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("kept", [500_000, 0])
def test_pieces_give_the_ids_of_whole_texts(path, kept):
    texts = [r[1] or "" for r in rows()] + [" 가각 힣 ᄀ ªº ǅ ß İI Σς ﬁ ²³ ① ٣ n̈a é́", " İ İ", " a\u0301 \u1100\u1161", " x.y;z!w?v:u,t . , s"]
    whole = Tokenizer.from_file(path)
    encoder = PieceEncoder(path, most_kept=kept, batch_chars=100)
    for _ in range(2):
        counts, ids = encoder(pa.array(texts, pa.large_string()))
        ends = np.cumsum(counts)
        for text, end, n in zip(texts, ends, counts, strict=True):
            assert ids[end - n : end].tolist() == whole.encode(text, add_special_tokens=False).ids
    assert PieceEncoder(path)(pa.array(texts, pa.large_string()), False)[0].tolist() == counts.tolist()


def test_token_counts(spark):
    whole = Tokenizer.from_file(WORD)
    want = []
    for doc_id, text, *_ in rows():
        n = len(whole.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 2048))
    got = token_counts(documents(spark).repartition(3), WORD)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert token_counts(empty(spark), WORD).collect() == []


def test_pack_cuts_one_stream(spark):
    whole = Tokenizer.from_file(WORD)
    pieces = pack(documents(spark).repartition(4), WORD, length=64)
    got = pieces.collect()
    by_sequence = {}
    for p in got:
        assert len(p.ids) == 4 * p.length and p.length > 0
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for s, parts in by_sequence.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 64 or (s == max(by_sequence) and 0 < at <= 64)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    want = sorted(zlib.crc32(np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for _, t, *_ in rows())
    stream = sorted(got, key=lambda p: (p.sequence_id, p.offset))
    found, held = [], b""
    for p in stream:
        assert p.start == len(held) // 4
        held += p.ids
        if len(held) // 4 == p.doc_tokens:
            found.append(zlib.crc32(held))
            held = b""
    assert sorted(found) == want and not held
    assert {r.sequence_id: len(r.ids) // 4 for r in sequences(pieces).collect()} == {s: sum(n for _, n in p) for s, p in by_sequence.items()}
    assert pack(empty(spark), WORD).collect() == []


def other_files(folder):
    """Tokenizer files whose texts can't be cut as BPE's can."""
    from tokenizers import AddedToken, decoders, models, normalizers, pre_tokenizers

    vocab = [("<unk>", 0.0), ("\u2581", -2.0), ("\u2581the", -3.0), ("th", -4.0), ("e", -4.0), ("\u2581house", -5.0), (",", -3.0), ("\u2581of\u2581", -2.5), ("h", -6.0), ("o", -6.0), ("u", -6.0), ("s", -6.0)]
    unigram = Tokenizer(models.Unigram(vocab, unk_id=0))
    unigram.pre_tokenizer, unigram.decoder = pre_tokenizers.Metaspace(split=False), decoders.Metaspace()
    letters = {c: i for i, c in enumerate(["[UNK]", *map(chr, range(97, 123)), *("##" + chr(c) for c in range(97, 123)), "the", "##ou"])}
    pieces = Tokenizer(models.WordPiece(letters, unk_token="[UNK]"))
    pieces.normalizer, pieces.pre_tokenizer = normalizers.Lowercase(), pre_tokenizers.BertPreTokenizer()
    spaced = Tokenizer.from_file(BYTE)
    spaced.add_tokens([AddedToken("the house", normalized=False)])
    grabbing = Tokenizer.from_file(BYTE)
    grabbing.add_special_tokens([AddedToken("<x>", lstrip=True)])
    out = []
    for name, tokenizer in (("unigram", unigram), ("wordpiece", pieces), ("spaced", spaced), ("grabbing", grabbing)):
        out.append(f"{folder}/{name}.json")
        tokenizer.save(out[-1])
    return out


def test_other_kinds_are_encoded_whole(tmp_path):
    texts = [r[1] or "" for r in rows()] + ["the house of the house, the", " the  house <x> of"]
    for path in other_files(tmp_path):
        assert not cuts_are_safe(path)
        whole = Tokenizer.from_file(path)
        counts, ids = encoder(path)(pa.array(texts, pa.large_string()))
        want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    assert cuts_are_safe(WORD) and cuts_are_safe(BYTE)


def test_sentencepiece_files(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts(documents(spark).repartition(3), path)
    want = [(d, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 2048) for d, t, *_ in rows()]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert WholeEncoder(path, batch_chars=50)(pa.array(["a b", "", "c"] * 30, pa.large_string()))[0].tolist() == [len(library.encode(t)) for t in ["a b", "", "c"] * 30]


def test_pieces_seen_before_are_not_encoded_again(monkeypatch):
    encoded, own = [], PieceEncoder._encode

    def counting(self, pieces):
        encoded.append(len(pieces))
        return own(self, pieces)

    monkeypatch.setattr(PieceEncoder, "_encode", counting)
    encoder = PieceEncoder(BYTE)
    texts = [pa.array([" ".join(f"{c}{i}" for i in range(210_000))], pa.large_string()) for c in "xy"]
    first = encoder(texts[0])
    encoder(texts[1])
    again = encoder(texts[0])
    assert encoded == [210_000, 210_000, 0]
    assert (again[0] == first[0]).all() and (again[1] == first[1]).all()


def test_most_used_pieces_stay():
    encoder, whole = PieceEncoder(BYTE, most_kept=50), Tokenizer.from_file(BYTE)
    for k in range(9):
        text = " often seen" + "".join(f" w{k}-{i}" for i in range(30))
        assert encoder(pa.array([text, "", " often"], pa.large_string()))[1].tolist() == [*whole.encode(text).ids, *whole.encode(" often").ids]
        assert len(encoder.pieces) <= 50 + 32
        assert {" often", " seen"} <= set(encoder.pieces[:25].to_pylist())
