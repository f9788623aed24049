import pickle

import pyarrow.fs
import pytest

from examloom.llm import scan
from examloom.session import table


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, "/root/testdata/sf0.01", "get_headers"), table(spark, "/root/testdata/sf0.01", "extract_toc")


@pytest.fixture(scope="module")
def reader(tables):
    return scan.Reader(scan.train(scan._all(*tables)))


CLEAN = "The bank relies on short-\nterm funding for about 40 percent of its funding.\nThe board of directors approved it without change."
NOISY = {
    "The board of directors approved it with-\nout change.": "The board of directors approved it without change.",
    "The board of direct0rs approved it without change.": "The board of directors approved it without change.",
    "The comrnittee reviewed the policy.": "The committee reviewed the policy.",
    "The board of directors\n- 30 -\napproved it without change.": "The board of directors approved it without change.",
    "The board of directors\nCONFIDENTIAL          CAPITAL ADEQUACY\napproved it without change.": "The board of directors approved it without change.",
    "The board of directors\n\fHeritage Trust Company      39\napproved it without change.": "The board of directors approved it without change.",
}


def test_texts(reader):
    assert not reader.noisy(CLEAN, False)
    for text, want in NOISY.items():
        assert reader.noisy(text, False), text
        assert reader.repair(text, False) == want


def test_entries(reader):
    for text in ["Capital Adequacy", "2. Capital Adequacy", "Capital Adequacyy", "Adequacy - Capital", "A) Capital Adequacy", "Off-Balance Sheet Activities"]:
        assert not reader.noisy(text, True), text
    want = {"C@pital Adequacy": "Capital Adequacy", "Cap- ital Adequacy": "Capital Adequacy", "A s s e t Quality Review": "Asset Quality Review", "Page 4  Capital Adequacy": "Capital Adequacy", "Capital Adequacy ........ I4": "Capital Adequacy"}
    for text, plain in want.items():
        assert reader.noisy(text, True), text
        assert reader.repair(text, True) == plain


def test_counts_are_exact(spark):
    """A misread rare word is found beside any number of words seen once."""
    text = "the comrnittee approved " + "the committee reviewed " * 12
    rows = [(text,), *[(" ".join(f"w{i * 1000 + k}x {i * 1000 + k}" for k in range(1000)),) for i in range(1500)]]
    c = scan.train(spark.createDataFrame(rows, "t string"))
    assert c.count("committee") == 12 and c.count("comrnittee") == 1 and c.count("reviewed") == 12
    assert {c.count(f"w{k}x") for k in range(0, 1_500_000, 997)} == {1} and c.count("nowhere") == 0
    assert c.beside("committee", "reviewed", False) == 12 and c.beside("the", "approved", False) == 0
    assert c.beside("the", "comrnittee", True) == 1 and c.total == len(text.split()) + 3_000_000
    assert c.decode("the comrnittee reviewed".split()) == [None, "committee", None]
    assert scan._pair(-5, 7) != scan._pair(7, -5)


def test_edges(spark, reader):
    topics = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "x" * 200_000), (4, "x" * 200_000), (None, "ok then")], "topic_id long, topic_text string")
    entries = spark.createDataFrame([(1, None), (2, ""), (3, "12")], "toc_id long, topic string")
    rows = scan.repair(topics, entries, reader.c).collect()
    assert len(rows) == 9 and not any(r.noisy for r in rows)
    assert scan.find(topics.limit(0), entries.limit(0)).count() == 0


def test_causes_and_repairs(spark, sf_dir):
    """The channel is asked first; misread figures and words broken by a space are mended."""
    from examloom.llm import queries

    rows = scan._all(queries._heavy(spark, "/root/testdata/sf0.01", "get_headers"), queries._heavy(spark, "/root/testdata/sf0.01", "extract_toc"))
    words = [(f"The management reviewed the portfolio in {2000 + i % 9} and it was sound.",) for i in range(400)]
    c = scan.train(spark.createDataFrame(words, "t string"))
    reader = scan.Reader(c)
    text = "The manage ment reviewed the portfo1io of 1O,234 in 2005 and it was sound."
    assert list(reader.causes(text, False)) == ["misread", "broken by a space"]
    assert reader.repair(text, False) == "The management reviewed the portfolio of 10,234 in 2005 and it was sound."
    trained = scan.Reader(scan.train(rows))
    causes = [next(trained.causes(r.t, r.source_table == "extract_toc"), None) for r in rows.collect()]
    assert causes.count("misread") > 0.25 * sum(x is not None for x in causes)
    assert all(0 < p <= 0.1 for p in trained.c.odds) and trained.c.odds != [p for _, _, p in scan.CONFUSIONS]


def test_counts_stay_off_the_driver(spark, monkeypatch):
    """What the driver holds and sends is the same for any corpus; the counts come from the shared folder, or a copy of it."""
    def toArrow(self):  # noqa: N802
        raise AssertionError("a table of counts on the driver")

    monkeypatch.setattr(type(spark.range(1)), "toArrow", toArrow)
    monkeypatch.setattr(scan, "PART", 20_000, raising=False)
    words = [f"w{chr(97 + k % 26)}{k}x" for k in range(100_000)]
    df = spark.createDataFrame([(" ".join(words[i * 1000 : i * 1000 + 1000]),) for i in range(100)] * 2 + [("the committee",)] * 12, "t string")
    c = scan.train(df)
    sent = pickle.dumps(c)
    assert len(sent) < 10_000
    pairs = [(u, v) for i in range(0, 100_000, 1000) for u, v in zip(words[i : i + 999 : 83], words[i + 1 : i + 1000 : 83])]
    monkeypatch.setattr(scan, "_filesystem", lambda folder: (pyarrow.fs.SubTreeFileSystem("/", pyarrow.fs.LocalFileSystem()), folder.removeprefix("file:///")))
    for x in (c, pickle.loads(sent)):
        assert {x.count(w) for w in words[::7]} == {2} and x.count("committee") == 12 and x.count("nowhere") == 0
        assert {x.beside(u, v, False) for u, v in pairs} == {2} and x.beside("the", "committee", False) == 12 and x.beside("committee", "the", False) == 0
    assert x.total == 200_024
