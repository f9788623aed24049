"""Operators over small reports, files and streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from examloom.functions.pyre import is_heading
from examloom.operators import compliance, diagnostics, header, mapper, ratings, subtopics, toc, topics
from examloom.plans import final
from examloom.sources import text as sources
from examloom.streaming import ingest

REPORT = "\r\n".join([
    "First National Bank of X", "Springfield, Ohio          Certificate Number: 12345", "Region: Western Basin", "Examiner-in-Charge: Ann B. Lee; on site", "Examination Start Date: March 3, 2015", "",
    "TABLE OF CONTENTS", "Capital Adequacy ........ 2", "Asset Quality Review ........ 3", "All dollar amounts are reported in thousands", "Not An Entry",
    "\x0cCapital Adequacy", "Capital text one.", "Internal Controls", "Controls text.", "\x0cCapital Adequacy (continued)", "More text.", "\x0cASSET QUALITY REVIEW" + " " * 30 + "7", "Asset text.",
    " " * 20 + "Current Exam    Prior Exam     Prior Exam", "     Capital        2               1              3", "*     Earnings (a)  4                              2", "End.", "Capital - 2", "This follows Part 309 of the FDIC rules.", "Component Ratings: 1-2-3-4-5-6",
])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "a.txt", REPORT), (2, "a.txt", None), (3, "b.txt", ""), (4, "c.txt", "no fields\nat all"), (5, "d.txt", "x" * 100_000)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, file_name string, text string, line string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, "Capital Adequacy", "Capital Adequacy"), (2, "Asset Quality Review", "Asset Quality Review")], "ord long, text string, topic string")


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([("Capital", "Capital"), ("Earnings", "Earnings"), ("Other", "NA")], "name string, canonical string")


def test_toc(docs):
    entries = toc.toc_entries(docs)
    assert [(r.topic, r.sure) for r in entries.orderBy("line_no").collect()] == [("Capital Adequacy", True), ("Asset Quality Review", True)]
    assert {r.doc_id: r.toc_count for r in toc.toc_summary(docs, entries).collect()} == {1: 2, 2: 0, 3: 0, 4: 0, 5: 0}


def test_toc_with_doubts(spark):
    text = "Table of Contents\nGood Entry 1\nLevel 2 q\nLevel 3 x\nLevel 4 y\nLevel 5 z\nLevel 6 w\nAfter\ngood entry follows here\nLevel 3 x repeated"
    entries = toc.toc_entries(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("line_no").collect()
    assert [e.topic for e in entries] == ["Good Entry", "Level 3 x"]


def test_topics(docs, labels):
    hits = final.topic_hits(docs, labels)
    assert [(r.topic, r.line_idx) for r in hits.orderBy("line_idx").collect()] == [("Capital Adequacy", 11), ("Asset Quality Review", 17)]
    texts = {r.topic: r.topic_text for r in topics.topic_texts(docs, hits).collect()}
    assert texts["Capital Adequacy"].startswith("Capital Adequacy\r\nCapital text one.") and texts["Capital Adequacy"].endswith("More text.")
    found = subtopics.subtopics(docs, hits, "Capital Adequacy")
    assert [(r.heading, r.body.split("\n")[0]) for r in found.orderBy("pos").collect()] == [("Initial", "\x0cCapital Adequacy"), ("Internal Controls", "Controls text.")]
    assert [(r.normalized, r.headings) for r in subtopics.subtopic_summary(found).collect()] == [("internal controls", ["Internal Controls"])]


def test_header(docs):
    row = {r.doc_id: r for r in header.header_fields(docs).collect()}
    r = row[1]
    assert (r.region, r.certificate_number, r.bank_name, r.bank_location) == ("Western_Basin", "12345", "First_National_Bank_of_X", "Springfield, Ohio")
    assert (r.examiner_in_charge_first_name, r.examiner_in_charge_middle_name, r.examiner_in_charge_last_name, r.exam_start_date) == ("Ann", "B.", "Lee", "3/3/2015")
    assert len(row) == 5 and row[2].bank_name == "" and row[4].exam_start_year is None


def test_ratings(docs, names):
    table = ratings.rating_tables(docs)
    assert [(r.rating_name, r.current, r.prior, r.prior_prior) for r in table.orderBy("line_no").collect()] == [("Capital", "2", "1", "3"), ("Earnings", "4", "", "2")]
    text = ratings.text_ratings(docs, names)
    assert [(r.canonical, r.value) for r in text.collect()] == [("Capital", "2")]
    wide = {r.doc_id: r for r in ratings.rating_columns(docs, ratings.map_ratings(table, names), text, ["Capital", "Earnings"]).collect()}
    assert wide[1].Capital_current == "2" and wide[1].Earnings_prior_prior == "2" and wide[1].Earnings_current == "4" and wide[2].Capital_current == "" and len(wide) == 5
    assert {r.doc_id: len(r.component) for r in ratings.component_ratings(docs).collect()}[1] == 6


def test_compliance(docs):
    got = {r.doc_id: (r.has_part_309, r.context) for r in compliance.part_309(docs).collect()}
    assert got[1][0] and "PART 309 OF THE FDIC" in got[1][1] and not got[2][0] and len(got) == 5
    assert sorted(r.doc_id for r in compliance.without_part_309(docs).collect()) == [2, 3, 4, 5]


def test_final_table(docs, labels, names):
    df = final.final_table(docs, labels, names, ["Asset Quality Review", "Capital Adequacy"], ["Capital", "Earnings"], split=2)
    rows = {r.serial_no: r for r in df.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5] and len(df.columns) == 15 + 2 * 5 + 3 * 2
    assert rows[1].Asset_Quality_Review_1.endswith("1-2-3-4-5-6") and rows[1].Asset_Quality_Review_2 is None
    assert final.final_table(docs.limit(0), labels, names, ["Capital Adequacy"], ["Capital"]).count() == 0


def test_final_table_keeps_long_texts(spark, labels, names):
    body = "\r\n".join(f"line {i} " + "x" * 90 for i in range(1500))
    df = spark.createDataFrame([(1, "a.txt", "\x0cCapital Adequacy\r\n" + body + "\r\n\x0cAsset Quality Review\r\nend")], "doc_id long, file_name string, text string")
    row = final.final_table(df, labels, names, ["Asset Quality Review", "Capital Adequacy"], ["Capital"]).first()
    assert row.Capital_Adequacy == "Capital Adequacy\r\n" + body and row.Asset_Quality_Review == "Asset Quality Review\r\nend"


def test_diagnostics(spark):
    df = spark.createDataFrame([(1, "ab\nA1z"), (2, "x\r\n"), (3, ""), (4, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.line_no, r.length) for r in diagnostics.line_lengths(df).collect()) == [(1, 1, 3), (1, 2, 3), (2, 1, 2)]
    assert {(r.codepoint, r.n, r.first_line) for r in diagnostics.char_histogram(df).where("doc_id = 2").collect()} == {(120, 1, 1), (10, 1, 1)}
    assert [r.line for r in diagnostics.masked(df, 1).where("doc_id = 1").orderBy("line_no").collect()] == ["ab", "A0z"]
    assert diagnostics.columns_by_number(["3", "5-7", "6", "9-8"]) == [3, 5, 6, 7]


def test_records(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a"b', "x,y"), ("2", None, "two\nlines")], "a string, b string, c string")
    assert [r.value for r in sources.rendered(df).collect()] == ['1,"a""b","x,y"', '2,,"two\nlines"']
    multi = spark.createDataFrame([("1", "2", "3~4")], "a string, b string, c string")
    assert sources.rendered(multi, "~~", "-").first().value == "1~~2~~3~4"
    sources.write_delimited(df, str(tmp_path / "out"))
    back = sources.read_delimited(spark, str(tmp_path / "out"), ["a", "b", "c"])
    assert sorted((r.a, r.b, r.c) for r in back.collect()) == [("1", 'a"b', "x,y"), ("2", None, "two\nlines")]


def test_files_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, body in (("b.txt", "caf\xe9\xa0x"), ("a.txt", REPORT), ("c.log", "no")):
        (folder / name).write_bytes(body.encode("latin1"))
    df = sources.read_reports(spark, str(folder), pattern=r"\.txt$")
    assert {r.file_name: r.text for r in df.collect()}["b.txt"] == "caf\xe9\xa0x"
    assert [r.file_name for r in sources.with_serial(df).orderBy("serial_no").collect()] == ["a.txt", "b.txt"]
    q = ingest.extract_stream(ingest.report_stream(spark, str(folder)), lambda b: header.header_fields(b, "file_name"), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination()
    got = {r.file_name: r.region for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["a.txt"] == "Western_Basin" and len(got) == 3 and os.path.exists(tmp_path / "check")


def test_classifiers(spark, labels, tmp_path):
    rows = [(i, t.upper() if i % 2 else t, t) for i in range(6) for t in ("Capital Adequacy", "Asset Quality Review", "Wire Transfer Controls")]
    train = spark.createDataFrame([(k, f"{t} part {i}", c) for k, (i, t, c) in enumerate(rows)], "ord long, text string, topic string")
    probe = spark.createDataFrame([("capital adequacy and more",), ("wire transfers controls",), (None,)], "name string")
    for algorithm, features in (("lr", "words"), ("rf", "words"), ("lr", "chars")):
        m = mapper.train(train, algorithm, features)
        assert {r.name: r.topic for r in m.guess(probe).collect()} == {"capital adequacy and more": "Capital Adequacy", "wire transfers controls": "Wire Transfer Controls"}
    assert mapper.training_mismatches(m).count() == 0
    far = {r.name: (r.topic, r.ratio > 2) for r in m.outstanding(probe).collect()}
    assert far["capital adequacy and more"] == ("Capital Adequacy", True)
    m.save(str(tmp_path / "model"))
    assert mapper.load(spark, str(tmp_path / "model")).guess(probe).count() == 2
    with pytest.raises(ValueError):
        mapper.train(train, "svm")
    out = topics.resolve_topics(spark.createDataFrame([("ASSET QUALITY REVIEW",), ("Confidential notes",), ("Sabal  Palm bank",), ("capital adequac",)], "name string"), labels, m.guess)
    assert {r.name: r.kind for r in out.collect()} == {"ASSET QUALITY REVIEW": "actual", "Confidential notes": "predefined", "Sabal  Palm bank": "exception", "capital adequac": "guess"}


def test_replicated(spark):
    df = spark.createDataFrame([("a12.txt", "x"), (None, "y")], "file_name string, text string")
    names = [r.file_name for r in sources.replicated(df, 3).collect()]
    assert len(names) == 6 and names.count(None) == 3
    for n in filter(None, names):
        assert n[0] == "a" and n.endswith(".txt") and n[1] in "023456789" and n[2] in "013456789"
    assert sources.replicated(df, 0).count() == 0


def test_final_table_with_subtopics(spark, docs, labels, names):
    known = spark.createDataFrame([(1, "internal controls", "Controls"), (2, "wires", "Wires")], "ord long, text string, topic string")
    within = final.SubtopicColumns("Capital Adequacy", known, ["Controls", "Wires"], None)
    df = final.final_table(docs, labels, names, ["Asset Quality Review", "Capital Adequacy"], ["Capital"], split=2, within=within)
    row = {r.file_name + str(r.serial_no): r.asDict() for r in df.collect()}["a.txt1"]
    assert "Capital_Adequacy_1" not in row and row["Capital_Adequacy_Wires"] is None
    assert json.loads(row["Capital_Adequacy_Controls"])["Internal Controls"].startswith("Controls text.")
    assert row["Asset_Quality_Review_1"].startswith("ASSET QUALITY REVIEW")


def test_subtopic_classes(spark):
    known = spark.createDataFrame([(1, "internal controls", "Controls"), (2, "internal controls", "Audit"), (3, "wires", "wires")], "ord long, text string, topic string")
    heads = spark.createDataFrame([("Internal Controls",), ("1. INTERNAL Controls",), ("Wires",), ("Other Thing",), (None,)], "name string")
    got = {r.name: (r["class"], r.kind) for r in subtopics.resolve_subtopics(heads, known).collect()}
    assert got == {"Internal Controls": ("Audit", "actual"), "1. INTERNAL Controls": ("Audit", "actual"), "Wires": ("wires", "actual"), "Other Thing": (None, "guess")}
    guessed = subtopics.resolve_subtopics(heads, known, lambda n: n.selectExpr("name", "'Wires' AS topic", "0.5D AS score")).where("kind = 'guess'").collect()
    assert [(r.name, r["class"], r.score) for r in guessed] == [("Other Thing", "Wires", 0.5)]


def test_ragged_records(spark):
    df = spark.createDataFrame([("a", 'x,"y ""z""\nw"\n\n1,2,3\r\n'), ("b", None), ("c", "")], "path string, text string")
    got = [(r.path, r.row_no, r.fields) for r in sources.ragged(df).orderBy("row_no").collect()]
    assert got == [("a", 1, ["x", 'y "z"\nw']), ("a", 2, ["1", "2", "3"])]


def test_exceptions_and_headings(spark, docs):
    assert {r.doc_id: r.reason for r in compliance.exceptions(docs).collect()} == {2: "no text", 3: "no text", 4: "no required wording", 5: "no required wording"}
    texts = ["Internal Audit", "IT AUDIT", "the Audit", "Audit."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", is_heading(F.col("t")).alias("h")).orderBy("i")
    assert [r.h for r in df.collect()] == [True, True, False, False]
    assert ratings.rated_documents(ratings.component_ratings(docs)).first().n == 1
