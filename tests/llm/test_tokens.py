import base64
import random

import pytest
import tiktoken

from examloom.llm import tokens
from examloom.session import table


@pytest.fixture(scope="module")
def exact():
    with open(tokens.vocabulary(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_like_the_library(exact):
    rng, enc = random.Random(1), tokens.encoder(tokens.vocabulary())
    texts = ["a" * 3000, "aaab" * 300, "é" * 500, "   x", "\x1c \x1d é x", " \x85 é\xa0x\x0b", "½²", "<|endoftext|>", " \n\n x  \n", "日本語テキスト" * 40, "don't 'll", "", None]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz  \n'EINSTaeioust012é-., ") for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    ids, ends = enc.encode_batch(texts)
    assert [ids[a:b] for a, b in zip([0, *ends], ends)] == [exact(t) if t else [] for t in texts]


def test_small_cache(exact, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 50)
    enc = tokens.Encoder(tokens.vocabulary())
    texts = [" ".join(f"w{i * j}" for j in range(30)) for i in range(40)]
    ids, ends = enc.encode_batch(texts)
    assert [ids[a:b] for a, b in zip([0, *ends], ends)] == [exact(t) for t in texts]


def test_long_merges(exact):
    enc, rng = tokens.encoder(tokens.vocabulary()), random.Random(2)
    for _ in range(200):
        word = "".join(rng.choice("aabcdeerst") for _ in range(rng.randint(65, 400)))
        assert enc.exact(word.encode()) == exact(word)


def test_table(spark, sf_dir, exact):
    df = table(spark, sf_dir, "documents")
    want = {r.doc_id: exact(r.text) if r.text else [] for r in df.collect()}
    assert {r.doc_id: r.ids for r in tokens.encode(df).collect()} == want


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "a b", 0), (None, "a b", 0)], "doc_id long, text string, ids int")
    rows = tokens.encode(df).collect()
    assert sorted((r.doc_id or 0, len(r.ids)) for r in rows) == [(0, 2), (0, 2), (1, 0), (2, 0)]
    assert tokens.encode(df.limit(0)).collect() == []
