import numpy as np
import pytest

from examloom.llm import quality
from examloom.session import table


@pytest.fixture(scope="module")
def common(spark):
    return [r.word for r in table(spark, "/root/testdata/sf0.01", "common_words").collect()]


def test_statistics(spark, common):
    text = "The bank relies on core deposits.\n- short entry\n- other entry\n\nnonaccrual loans      12     44.01\r\nfarm lines      3     4"
    row = quality.statistics(spark.createDataFrame([(1, text, "x")], "doc_id long, text string, n_words string"), common).first()
    assert (row.n_chars, row.n_lines, row.n_words) == (len(text), 5, 20)
    assert row.punct_line_share == pytest.approx(0.2)
    assert row.list_share == pytest.approx(26 / (33 + 26 + 34 + 23), abs=0.03) and row.table_share > 0.4


def test_held_out_accuracy(spark, common):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rules = quality.induce(docs.where("doc_id % 2 = 0"), common)
    rows = quality.judge(docs.where("doc_id % 2 = 1"), common, rules).join(docs, "doc_id").collect()
    wrong = [r.doc_id for r in rows if r.no_prose != quality.label(r.text, quality.languages(common))]
    assert len(wrong) <= 0.01 * len(rows)


def test_made_texts(spark):
    """Texts of a kind that is known, by rules learned from the corpus: no label is asked."""
    from examloom.llm import queries

    common = queries._common(spark, "/root/testdata/sf0.01")
    rng = np.random.default_rng(5)
    prose = ["The board met in June and approved the policy that was revised by the bank.", "Management should review the loans that are past due, and the reserve has not been tested.", "It was found that the plan is out of date and that no one had been told of it."]
    words = sorted(common)
    rare = ["".join(rng.permutation(list("aeiourstlnmd"))[:7]) for _ in range(300)]
    salad = lambda: " ".join(rng.permutation([*rng.permutation(words)[:12], *rng.permutation(rare)[:60]]))
    listed = lambda: "\n".join(f"- item {k} loan file" for k in rng.integers(1, 99, 30))
    ledger = lambda: "\n".join(f"loan {a}      {b}.{a % 99:02d}     {b % 9}" for a, b in rng.integers(10, 9999, (25, 2)))
    made = [(" ".join(rng.permutation(prose * 2)[: 2 + i % 4]), False) for i in range(40)] + [(f(), True) for f in (salad, listed, ledger) for _ in range(20)] + [("The same phrase again. " * 60, True)]
    docs = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(made)], "doc_id long, text string, y boolean")
    rules = quality.induce(table(spark, "/root/testdata/sf0.1", "documents"), common)
    wrong = quality.judge(docs, common, rules).join(docs, "doc_id").where("no_prose <> y").select("doc_id", "text").collect()
    assert len(wrong) <= 2, wrong


def test_given_labels(spark, common):
    docs = spark.createDataFrame([(i, "word " * (5 + i % 40), i % 40 >= 20) for i in range(400)], "doc_id long, text string, bad boolean")
    rules = quality.induce(docs, common, labels="bad")
    got = quality.judge(docs, common, rules).join(docs, "doc_id")
    assert got.where("no_prose != bad").count() == 0


def test_irep_finds_two_kinds():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = (x[:, 0] > 0.8) | (x[:, 1] < 0.05)
    rules = quality.irep(x, y, ["a", "b", "c"])
    hit = np.any([quality._holds(x, ["a", "b", "c"], r) for r in rules], axis=0)
    assert (hit == y).mean() > 0.98


def test_edges(spark, common):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n\t "), (4, "x" * 200_000), (5, "The board met."), (5, "The board met."), (None, "n/a\n" * 50)], "doc_id long, text string")
    rules = quality.induce(table(spark, "/root/testdata/sf0.01", "documents"), common)
    got = {r.doc_id: r.no_prose for r in quality.judge(docs, common, rules).collect()}
    assert not (got[1] or got[2] or got[3] or got[5]) and got[4] and got[None]
    assert quality.judge(docs.limit(0), common).count() == 0
