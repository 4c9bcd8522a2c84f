"""Token files: round trips, places and checksums."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from tests.llm.cases import documents, empty, rows
from tokenizers import Tokenizer

from yearbook.llm import tokenfile
from yearbook.llm.tokenfile import Model, decode, encode, read_tokens, write_tokens

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("size", [1, 127, 128, 129, 5000, tokenfile.BLOCK, 3 * tokenfile.BLOCK + 77])
@pytest.mark.parametrize("symbols", [1, 2, 50_000])
def test_round_trip(size, symbols):
    tokens = (np.random.default_rng(size).random(size) ** 4 * symbols).astype(np.uint32)
    model = Model(Model.scaled(np.bincount(tokens)))
    assert model.frequency.sum() == 1 << tokenfile.SCALE_BITS
    blocks, payload = encode(model, tokens)
    assert (decode(model, blocks, payload) == tokens).all()
    assert (decode(model, blocks[-1:], payload) == tokens[len(tokens) - blocks[-1]["n"] :]).all()
    broken = bytearray(payload)
    broken[len(broken) // 2] ^= 1
    with pytest.raises(ValueError):
        decode(model, blocks, bytes(broken))


def test_size_is_near_the_entropy():
    tokens = (np.random.default_rng(1).random(1 << 18) ** 4 * 5000).astype(np.uint32)
    p = np.bincount(tokens) / len(tokens)
    p = p[p > 0]
    bits = -(p * np.log2(p)).sum() * len(tokens)
    assert len(encode(Model(Model.scaled(np.bincount(tokens))), tokens)[1]) * 8 < 1.03 * bits


def test_files_hold_every_document_in_order(spark, tmp_path, monkeypatch):
    folder = write_tokens(documents(spark).repartition(3), BYTE, f"file://{tmp_path}/files")
    got = sorted(read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows()), key=lambda i: (i is not None, i))
    whole, texts, at = Tokenizer.from_file(BYTE), {r[0]: r[1] for r in rows()}, 0
    for r in got:
        assert r.start == at
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == [*whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0]
        at += len(ids)
    nothing = write_tokens(empty(spark), BYTE, f"file://{tmp_path}/empty")
    assert read_tokens(spark, nothing).collect() == []


@pytest.mark.parametrize(("end_id", "width"), [(0, 2), (70_000, 4)])
def test_ids_take_two_bytes_where_they_fit(spark, tmp_path, end_id, width):
    plain = tokenfile._tokenised(documents(spark), BYTE, end_id, "doc_id", "text").where("seq >= 0").select("n", "tokens").collect()
    assert plain and all(len(r.tokens) == width * r.n for r in plain)
    folder = write_tokens(documents(spark), BYTE, f"file://{tmp_path}/files", end_id)
    whole, texts = Tokenizer.from_file(BYTE), {r[0]: r[1] for r in rows()}
    for r in read_tokens(spark, folder).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == [*whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, end_id]
