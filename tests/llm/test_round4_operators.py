"""Figures that grew with the words of a corpus: what the driver holds, recursive steps, candidates of decontamination."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from roomledger.llm import byte_bpe, catalog, decontaminate


def words_of(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randrange(3, 8))) for _ in range(n)]


def test_term_sums_reach_the_driver_as_bytes(spark, monkeypatch):
    """65,536 rows of 48 numbers would be 3 million objects there."""
    docs = spark.createDataFrame([(i, " ".join(words_of(i % 7, 60))) for i in range(20)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(words_of(3, 60)[10:40]))], "item_id long, text string")

    def widest(self, *args, **kwargs):
        raise AssertionError("rows of many columns are taken into the driver as objects")

    monkeypatch.setattr(type(docs), "toPandas", widest)
    assert {r.doc_id for r in decontaminate.leaks(docs, items).collect()} == {3, 10, 17}


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(catalog.BYTE_BPE, public_tokenizers.PATTERN)


def test_short_pieces_take_fewer_steps_than_merges(codec):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    words = words_of(1, 800)
    pieces = [f" {a}{b}".encode() for a, b in zip(words[::2], words[1::2], strict=True)]
    got = [np.frombuffer(i, dtype="<u4").tolist() for i in codec.merge_pieces(pieces)]
    # Before, a step was a merge; the table of the last query tells the steps of each piece.
    rows = codec.db.sql(byte_bpe.SHORT_SQL).fetchnumpy()
    steps = dict(zip(rows["piece"].tolist(), rows["step"].tolist(), strict=True))
    assert sum(steps.values()) < 0.8 * sum(len(p) - len(i) for p, i in zip(pieces, got, strict=True))
    assert got == [library._encode_single_piece(p) for p in pieces]
    hard = [b"a" * n for n in range(1, 60)] + [b"ab" * 20, "ü é日".encode(), b" ", bytes(range(256))[:64], bytes(range(256))[128:192]]
    assert [np.frombuffer(i, dtype="<u4").tolist() for i in codec.merge_pieces(hard)] == [library._encode_single_piece(p) for p in hard]


def test_encoding_any_white_space_and_decoding(codec):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(2)
    texts = ["", " ", "  a", "a  ", "\n x\n\n  y\t z", "a\x1c b \x85c", "don't  'll", "　x 　 y", "</s> <|endoftext|>"]
    texts += ["".join(rng.choice(" \n\tab'sé1.,!\x1c\x85") for _ in range(rng.randrange(60))) for _ in range(500)]
    ids = codec.encode(texts)
    assert [i.tolist() for i in ids] == [library.encode_ordinary(t) for t in texts]
    assert codec.decode(ids) == [t.encode() for t in texts]
    assert codec.encode([]) == codec.decode([]) == []


def test_words_in_another_order_are_no_candidates(spark):
    """Before, every stretch with enough of an item's words was verified, whatever their order."""
    item = words_of(5, 30)
    texts = [" ".join(words_of(6, 40) + item[::-1] + words_of(7, 40)), " ".join(words_of(8, 40) + item + words_of(9, 40))]
    texts += [" ".join(words_of(n, 120)) for n in range(10, 160)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = decontaminate.load_items([" ".join(item)])
    tokens = decontaminate.tokenised(docs, 8)
    space = decontaminate.latent_space(tokens, items.terms)
    found = decontaminate.candidates(tokens.select("key1", "key2", "terms"), space, items)
    assert found.select("key1", "key2").distinct().count() == 1
    bench = spark.createDataFrame([(4, " ".join(item))], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.covered) for r in decontaminate.leaks(docs, bench).collect()] == [(1, 4, 1.0)]


@pytest.mark.parametrize("length", [8, 37, 63, 64, 65, 150])
def test_bound_of_common_words(length, monkeypatch):
    """Exact up to 64 words of an item, never too small beyond, in tables of any size."""
    monkeypatch.setattr(decontaminate, "MASKS", 200)
    rng = random.Random(length)
    items = [np.array([rng.randrange(1, 40) for _ in range(length)], dtype=np.uint16) for _ in range(9)]
    words = np.array([rng.randrange(0, 40) for _ in range(400)] + [0], dtype=np.uint16)
    item = np.array([rng.randrange(9) for _ in range(50)])
    start = np.array([rng.randrange(400) for _ in range(50)])
    stop = np.minimum(start + [rng.randrange(200) for _ in range(50)], 400)
    got = decontaminate.Reach(items, 40).most(words, item, start, stop)
    want = [
        decontaminate.common_subsequence(items[i].tolist(), [w for w in words[a:b].tolist() if w])
        for i, a, b in zip(item, start, stop, strict=True)
    ]
    assert (got >= want).all()
    if length <= 64:
        assert got.tolist() == want


def test_terms_of_many_texts_are_those_of_each():
    texts = ["", "  a ", " \n ", "Σ ΑΣ ΑΣ. İx", "a\x1cb\x85c", "... -", "'Hi,' (x) 　 hi"]
    got = decontaminate.terms_of_texts(pd.Series(texts))
    assert [g.tolist() for g in got] == [decontaminate.terms_of(t).tolist() for t in texts]
