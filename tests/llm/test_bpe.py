import hashlib
import random

import pytest
import public_tokenizers
import tiktoken

from roadflux.llm import bpe


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(bpe.default_vocabulary(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(bpe.default_vocabulary())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts(codec, library):
    rnd = random.Random(3)
    letters = [chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(256), rnd.randrange(0x3000), rnd.randrange(0xE000, 0x20000)])) for _ in range(600)]
    for _ in range(2000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(50)))
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text) and codec.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["", " ", "\n\n  x", "<|endoftext|>", "x" * 30_000, " " * 5000 + "é" * 3000, "don't  stop\t\n", "\x1c\x00﻿", "日本語 テキスト 🎉👩‍👩‍👧"])
def test_defined_texts(codec, library, text):
    assert codec.encode(text) == library.encode_ordinary(text) and codec.decode(codec.encode(text)) == text.encode()


def test_cache_is_bounded(codec, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    own = bpe.ByteBpe(codec.ranks, public_tokenizers.PATTERN)
    for i in range(50):
        assert own.encode(f"word{i} and {i}") == codec.encode(f"word{i} and {i}")
        assert len(own.known) <= 8


def test_every_vocabulary_entry_is_reached(codec):
    assert all(codec.model.encode(bpe.mapped(x)) == [i] for x, i in list(codec.ranks.items())[::7])


def test_query_columns(spark, codec, library):
    rows = [(1, "Hello world", 5), (1, "Hello world", 5), (2, None, 1), (None, "", 1), (3, "é" * 40_000, 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    got = bpe.encoded(df).collect()
    assert len(got) == 5 and bpe.encoded(df.limit(0)).count() == 0
    for r, (doc_id, text, _) in zip(got, rows, strict=True):
        ids = library.encode_ordinary(text or "")
        assert (r.doc_id, r.n_tokens, r.token_ids) == (doc_id, len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
