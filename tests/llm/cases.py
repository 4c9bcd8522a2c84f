"""Awkward documents that every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, n_tokens string, kept string"

_WORDS = ["the", "of", "and", "house", "Tree", "river,", "stone.", "über", "naïve", "日本", "x1", "café", "don't", "ä", "£5"]


def sentence(n: int, seed: int) -> str:
    return " ".join(random.Random(seed).choices(_WORDS, k=n))


TEXTS = [
    None, "", " ", "\n\n\t", "one", "two words", "four words are here", "five words are here now",
    sentence(60, 1), sentence(60, 1), sentence(60, 1) + " more", sentence(300, 2), sentence(30000, 3),
    "a b c " * 200, "line one here\nline one here\n\nother line\nline one here\n" + sentence(60, 4),
    "a \n b  c   d ́e <|endoftext|> f<|startoftext|>g\x1c!\x85 \x85 h", "x" * 5000, "é" * 3000 + " " + "é" * 3000,
    "  lead and trail  \n", "| a | b # c $ d <e> %&", "\x0b\x0c tab\tand\rmore\x0b",
]


def rows(texts=TEXTS) -> list[tuple]:
    """The texts under ascending ids, one row twice, one without id."""
    out = [(i, t, "en" if i % 2 else None, "src0", None, 0.5, "clash", "clash") for i, t in enumerate(texts)]
    return [*out, out[8], (None, "no id " + sentence(60, 9), None, None, None, None, None, None)]


def documents(spark, texts=TEXTS):
    return spark.createDataFrame(rows(texts), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row) -> tuple:
    return tuple((x is None, str(x)) for x in row)
