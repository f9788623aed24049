"""Unit tables of dates, names, entries, headings and normal forms."""

import re

import pytest
from pyspark.sql import functions as F

from examloom.functions.dates import date_text, parse_date, repair_digits
from examloom.functions.names import parse_name
from examloom.functions.pyre import pyre, single_spaced, strip, title
from examloom.operators import subtopics, toc, topics


def column(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string").select("i", f(F.col("v")).alias("x")).orderBy("i").collect()
    return [r.x for r in rows]


def test_dates(spark):
    cases = {
        "--March 3Q,2015": "3/30/2015", "04/04/2011": "4/4/2011", "04/04/11": "4/4/2011", "April 06. 2015": "4/6/2015", "July 2 1. 2014": "7/21/2014", "December 08. 2014": "12/8/2014",
        "2015": "1/1/2015", "2015 x": "", "13/01/2011": "", "04/04/85": "4/4/1985", "": "", "x" * 10_000: "", "2/29/2011": "", "Marchember 1, 2011": "", "May I, 2012 at noon": "5/1/2012",
    }
    got = column(spark, list(cases), lambda c: date_text(parse_date(c)))
    assert dict(zip(cases, got)) == cases
    assert column(spark, [None], lambda c: parse_date(c)) == [None]
    assert column(spark, ["Q1IloO"], repair_digits) == ["011100"]


def test_names(spark):
    cases = {
        "Rupen B (XYZ)": ("Rupen", "", "B", ""), "Test 13 Bax^ter": ("Test", "", "Baxter", ""), "U'end\\ R Green": ("R", "", "Green", ""), "(EIC) Gra J. Pratt ": ("Gra", "J.", "Pratt", ""),
        "": ("", "", "", ""), "Lee, Ann B.": ("Ann", "B.", "Lee", ""), "John Lee Jr.": ("John", "", "Lee", "Jr."), "A.B Cole": ("A.", "B", "Cole", ""), "Solo": ("", "", "Solo", ""), "Ann Marie Sue Lee FDIC": ("Ann", "MarieSue", "Lee", ""),
    }
    got = column(spark, list(cases), parse_name)
    assert {k: tuple(g) for k, g in zip(cases, got)} == cases
    assert tuple(column(spark, [None], parse_name)[0]) == ("", "", "", "")


def test_entries(spark):
    cases = {"Risk Assessment . . .": ("Risk Assessment", True), "Level 2 Violations": ("Level 2 Violations", False), "summary of": ("summary of", False), "Schedule No.": ("Schedule No.", False), "...": ("", True), "Statement Of": ("Statement Of", False)}
    got = column(spark, list(cases), toc.analyze)
    assert {k: (g.formatted, g.sure) for k, g in zip(cases, got)} == cases
    lines = {"Capital Adequacy ............ 5": "Capital Adequacy", "   Earnings   l2": "Earnings", "lower case": "", "Bank ' s Record  3": "Bank's Record"}
    assert dict(zip(lines, column(spark, list(lines), toc.entry_text))) == lines


def test_normal_form(spark):
    cases = {"Active Directory/Excessive User Access Rights": "active directory excessive user access rights", "Compliance with Information Security Standards": "compliance information security standards", "Level 2 (B10)": "level b0", "": ""}
    assert dict(zip(cases, column(spark, list(cases), subtopics.normal_form))) == cases


def test_subtopic_headings(spark):
    yes = ["Internal Audit", "1. Loan Review and Credit", "IT AUDIT", "Risk-Based Plan"]
    no = ["The board met today.", " Indented Heading", "", "small first", "One Two Three Four Five Six Seven Eight Nine Ten Eleven", "Wide      Gap", "1) 2"]
    assert column(spark, yes, subtopics.is_subtopic) == [True] * len(yes)
    assert column(spark, no, subtopics.is_subtopic) == [False] * len(no)


def test_numbers_off_headings(spark):
    far = "Capital" + " " * 25 + "12"
    got = column(spark, [far, far + " " * 22 + "x", "Capital 12", " Asset"], topics.without_number)
    assert [x.rstrip() for x in got] == ["Capital", "Capital", "Capital 12", " Asset"]


@pytest.mark.parametrize("pattern", [r"\s+x\w*", r"(a|b)\W+[\s\w]*z", r"^\S.*y$", r"[^\s]q?"])
def test_like_python(spark, pattern):
    texts = ["\xa0x1", "\x85 xé", "a\x85!z", "b\x1c\xa0éz", "éy", " q", "\x0cx", "a\ry", "a - ² z", "²q", "x\x85y"]
    got = column(spark, texts, lambda c: c.rlike(pyre(pattern)))
    assert got == [bool(re.match(pattern, t)) for t in texts]


def test_title_strip(spark):
    texts = ["it-audit o'neil", "ÉCOLE x1y", "", "a  b"]
    assert column(spark, texts, title) == [t.title() for t in texts]
    assert column(spark, ["\xa0 a\x1c b \x85"], strip) == ["a\x1c b"]
    assert column(spark, ["a\xa0 \nb"], single_spaced) == ["a b"]


def test_packing(spark):
    cases = [(["a" * 6, "b" * 6, "c"], ["aaaaaa", "bbbbbb\r\nc"]), (["x" * 20, "y"], ["x" * 20, "y"]), ([], []), (["", "a"], ["\r\na"])]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, v array<string>").select("i", topics.packed(F.col("v"), "\r\n", 10).alias("p")).orderBy("i")
    assert [r.p for r in df.collect()] == [c[1] for c in cases]
