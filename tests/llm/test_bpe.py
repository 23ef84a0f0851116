"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from citymotion.llm import bpe


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(P.path(bpe.RANKS))


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


EDGE = [
    "", " ", "  ", "\n", "a", "'", "''s", "'s's", "don't they'll I'd we're you've I'm it's", "\n's 's  's\t's", "'sabc 'rexx 'r 'l 'll", "5's !'s x''s",
    " \n \n x", "x  ", "x \n\n  y", " 　 a b", "é😀 ñ 中文字 １２ ½x", "a\x1cb\x85c", "=" * 5000, "ab" * 3000 + "😀" * 700, "-'s-'", "'ſ 'S 'RE",
    "<|endoftext|>", "\x00\x01", " '", "' s", "\U000323b0x",
]


def ids(b):
    return np.frombuffer(b, "<u4").tolist()


def test_edges(own, library):
    for t, got in zip(EDGE, own.encode_batch(EDGE)):
        assert ids(got) == library.encode_ordinary(t), repr(t[:40])
        assert own.decode(got) == t.encode()


def test_random_strings(own, library):
    rng = random.Random(3)
    pieces = ["'", "s", "re", "ll", " ", "  ", "\n", "\t", "A", "é", "9", "²", "!", "😀", "　", "don", "'t", "ʼ", "中"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 60))) for _ in range(4000)]
    assert [ids(x) for x in own.encode_batch(texts)] == [library.encode_ordinary(t) for t in texts]


def test_scan_over_columns(monkeypatch, own, library):
    monkeypatch.setattr(bpe, "BATCH_CHARS", 37)
    texts = ["we're  here\n's don't", "'s", "x" * 100, ""] * 9
    assert [ids(x) for x in own.encode_batch(texts)] == [library.encode_ordinary(t) for t in texts]


def test_driver_documents(spark, docs_rows, library):
    df = spark.createDataFrame([(i, t, "clash") for i, t, _ in docs_rows] + [(None, None, "x"), (-1, "", "x"), (-1, "", "x")], "doc_id long, text string, n_tokens string")
    got = bpe.with_digests(df).collect()
    want = {}
    for i, t, _ in docs_rows:
        x = library.encode_ordinary(t)
        want[i] = (len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    empty = (0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())
    want |= {None: empty, -1: empty}
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want
    assert len(got) == len(docs_rows) + 3
    some = bpe.with_ids(df.limit(5))
    back = some.select("text", bpe.decode(some["token_ids"]).alias("b")).collect()
    assert all(bytes(r["b"]).decode() == r["text"] for r in back)
    assert bpe.with_digests(df.limit(0)).count() == 0


def test_unknown_id(own):
    with pytest.raises(ValueError):
        own.decode(np.array([50256 + 7], "<u4").tobytes())
