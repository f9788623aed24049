import random

import pytest

from examloom.llm import split
from examloom.session import table


def natural(text, cut):
    return cut in (0, len(text)) or text[cut - 1].isspace() and not text[cut].isspace()


def check(text, limit, overlap):
    spans = split.spans(text, limit, overlap)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    for (a, b), (c, d) in zip(spans, spans[1:]):
        assert a < c <= b < d and 0 <= b - c <= overlap
    assert all(0 <= b - a <= limit for a, b in spans)
    return spans


def test_random_texts():
    rng = random.Random(3)
    for _ in range(150):
        text = "".join(rng.choice(["word ", "x" * rng.randint(1, 40), ". ", "\n", "\r\n", "\n\n", "é", "́", "。"]) for _ in range(rng.randint(0, 400)))
        limit = rng.randint(60, 400)
        check(text, limit, rng.randint(0, limit // 3))


def test_prefers_paragraphs_and_words():
    para = ("The bank relies on core deposits for its funding. " * 12).strip()
    text = "\n\n".join([para] * 20)
    for a, b in check(text, 2000, 50)[:-1]:
        assert text[b - 2 : b] == "\n\n"
    words = "alpha beta gamma " * 500
    for a, b in check(words, 1000, 100):
        assert natural(words, b) and natural(words, a)


def test_no_boundaries():
    text = "x" * 70_001
    spans = check(text, 32_000, 200)
    assert len(spans) == 3 and all(b - c == 200 for (a, b), (c, d) in zip(spans, spans[1:]))


def test_optimal_on_small_text():
    """Against all ways to cut at the candidate boundaries."""
    rng = random.Random(5)
    for _ in range(30):
        text = "".join(rng.choice(["ab ", "c. ", "d\n", "e\n\n"]) for _ in range(24))
        limit, n, kind = 30, len(text), split.kinds(text)
        even = n / -(-n // limit)
        best = {0: 0.0}
        for e in range(1, n + 1):
            pen = split.COSTS[kind[e]] if e < n else 0.0
            options = [best[s] + split.PIECE_COST + pen + split.BALANCE * ((e - s - even) / limit) ** 2 for s in best if e - s <= limit]
            if options:
                best[e] = min(options)
        got = 0.0
        for a, b in split.spans(text, limit, 0, grid=1):
            got += split.PIECE_COST + (split.COSTS[kind[b]] if b < n else 0.0) + split.BALANCE * ((b - a - even) / limit) ** 2
        assert got == pytest.approx(best[n])


def test_table(spark):
    df = table(spark, "/root/testdata/sf0.01", "get_headers")
    want = {r.topic_id: r.topic_text for r in df.where("length(topic_text) > 32000").collect()}
    got = split.split_oversized(df).where("n_pieces > 1").collect()
    assert {r.topic_id for r in got} == set(want) and want
    for k, text in want.items():
        rows = sorted((r for r in got if r.topic_id == k), key=lambda r: r.piece_no)
        whole = ""
        for r in rows:
            assert len(r.piece) <= 32_000 and len(whole) - 200 <= r.start <= len(whole)
            whole = whole[: r.start] + r.piece
        assert whole == text


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "short", 0), (3, "short", 0), (None, "y " * 40_000, 0), (5, "😀" * 32_000, 0)], "topic_id long, topic_text string, piece int")
    rows = split.split_oversized(df).collect()
    assert sorted((r.topic_id or 0, r.n_pieces) for r in rows) == [(0, 3)] * 3 + [(1, 1), (2, 1), (3, 1), (3, 1), (5, 1)]
    assert split.split_oversized(df.limit(0)).count() == 0
