"""Rejects against a plain field-by-field parser."""

import datetime
import re
import unicodedata

import pytest

from examloom.operators import rejects
from examloom.session import table


def parse(line, fd):
    """Fields, or None for broken quoting."""
    out, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            j, value = i + 1, ""
            while True:
                if j >= len(line):
                    return None
                if line[j] == '"':
                    if line[j + 1 : j + 2] == '"':
                        value, j = value + '"', j + 2
                        continue
                    break
                value, j = value + line[j], j + 1
            j += 1
        else:
            j = line.find(fd, i)
            j = len(line) if j < 0 else j
            value = line[i:j]
            if re.search(r'["\r\n]', value):
                return None
        out.append(value)
        if j == len(line):
            return out
        if not line.startswith(fd, j):
            return None
        i = j + len(fd)


def control(text, allowed=""):
    return any(unicodedata.category(c) == "Cc" and c not in allowed for c in text)


def fails(layout, fd, line):
    if layout not in rejects.LAYOUTS or not fd or not line:
        return True
    fields = parse(line, fd)
    names = rejects.LAYOUTS[layout]
    if fields is None or len(fields) != len(names):
        return True
    for name, v in zip(names, fields):
        if name == "serial_no":
            bad = not re.fullmatch("[0-9]+", v) or int(v) == 0
        elif name == "file_name":
            bad = control(v) or bool(re.search(r"[/\\]", v)) or not re.fullmatch(r"(?is).*\S.*\.txt", v)
        elif name.endswith("_date") and v:
            m = re.fullmatch(r"(\d{1,2})/(\d{1,2})/(\d{4})", v, re.A)
            try:
                bad = not m or not datetime.date(int(m[3]), int(m[1]), int(m[2]))
            except ValueError:
                bad = True
        elif name.endswith("_year"):
            bad = bool(v) and not re.fullmatch("[0-9]{4}", v)
        elif name.endswith("_month"):
            bad = bool(v) and not (re.fullmatch("[0-9]{1,2}", v) and 1 <= int(v) <= 12)
        elif name == "topic_text":
            bad = not v.strip() or control(v, "\t\n\r\f")
        else:
            bad = False
        if bad:
            return True
    return False


@pytest.mark.parametrize("data", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_same_as_plain_parser(spark, data):
    raw = table(spark, data, "raw_records")
    rows = raw.select("raw_id", "layout", "fd", "line").collect()
    want = {r.raw_id for r in rows if fails(r.layout, r.fd, r.line)}
    got = {r.raw_id: r.reason for r in rejects.rejected(rejects.load_records(raw)).collect()}
    assert set(got) == want


def test_edges(spark):
    t = "1,a.txt,T,"
    rows = [
        (1, "topics", ",", None), (2, "topics", ",", ""), (3, None, ",", "x"), (4, "topics", None, "x"), (5, "topics", "", "x"),
        (6, "topics", ",", t + '"open'), (7, "topics", ",", t + "fine"), (8, "topics", ",", t + '"two\r\nlines"'), (9, "topics", ",", t + 'a"b'),
        (10, "topics", ",", t + '"' + "x" * 3_000_000 + '"'), (11, "topics", "||", "1||a.txt||T||two | bars"), (12, "topics", ",", t + ""), (12, "topics", ",", t + ""),
        (13, "topics", ",", t + '"x" '), (14, "topics", ",", "\n"), (15, "topics", '"', "x"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "raw_id long, layout string, fd string, line string, reason string")
    got = {r.raw_id: r.reason for r in rejects.load_records(df).collect()}
    assert {k for k, v in got.items() if v is None} == {7, 8, 10, 11, 12}
    assert (got[1], got[2], got[3], got[4], got[6]) == ("null record", "empty record", "unknown layout", "no usable delimiter", "broken quoting")
    loaded = rejects.load_records(df)
    assert rejects.typed(loaded, "topics").count() == 6
    assert rejects.typed(loaded, "topics").where("raw_id = 8").first().topic_text == "two\r\nlines"
    assert rejects.load_records(df.limit(0)).count() == 0


def test_typed_values(spark):
    line = '7,x.txt,Lakes,,"A ""B"" Bank",Town,Ann,,Lee,02/29/2012,2012,2,,,'
    df = spark.createDataFrame([(1, "headers", ",", line)], "raw_id long, layout string, fd string, line string")
    row = rejects.typed(rejects.load_records(df), "headers").first()
    assert (row.serial_no, row.bank_name, row.certificate_number, row.exam_start_date, row.exam_start_month) == (7, 'A "B" Bank', None, datetime.date(2012, 2, 29), 2)
