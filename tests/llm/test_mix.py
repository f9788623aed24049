import pytest

from examloom.llm import mix


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")


def test_shares(spark):
    rows = [(i, "word " * (20 + i % 30), ("a", "b", "c")[min(2, i % 7)], 0) for i in range(2100)] + [(9000 + i, "x y z", None, 0) for i in range(5)] + [(9100, "left out", "z", 0)]
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.3, 2), ("c", 0.15, 1), ("none", 0.05, 4)], "source string, target_weight double, max_repeats int")
    out, report = mix.mix(frame(spark, rows), targets)
    got = {r.source: r for r in report.collect()}
    for s, w in (("a", 0.5), ("b", 0.3), ("c", 0.15)):
        assert got[s].share == pytest.approx(w / 0.95, rel=0.02)
    assert got["none"].share == 0
    caps = {"a": 3, "b": 2, "c": 1, "z": 0, None: 3}
    used = out.collect()
    assert len(used) == len(rows) and all(0 <= r.copies <= caps[r.source] for r in used)
    assert sum(r.n_tokens * r.copies for r in used if r.source == "a") > 0.99 * 3 * sum(r.n_tokens for r in used if r.source == "a")


def test_edges(spark):
    targets = spark.createDataFrame([("a", 1.0, 2), ("b", None, 1), (None, 0.5, 1)], "source string, target_weight double, max_repeats int")
    out, report = mix.mix(frame(spark, [(1, None, "a", 0), (2, "", "a", 0), (3, "some text", "a", 0), (3, "some text", "a", 0), (None, "other", None, 0)]), targets)
    rows = out.collect()
    assert len(rows) == 5 and sorted(r.copies for r in rows if r.doc_id == 3) == [2, 2] and all(r.copies == 0 for r in rows if r.doc_id in (1, 2))
    assert [(r.source, r.share) for r in report.collect()] == [("a", 1.0)]
    out, report = mix.mix(frame(spark, []), targets)
    assert out.count() == 0 and report.first().tokens == 0
