import random

import pytest

from examloom.llm import canon
from examloom.session import table


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def edits(n):
    return 0 if n < 5 else 1 if n < 7 else 2 if n < 9 else 3 if n < 12 else 4


def test_join_loses_no_pair(spark):
    rng = random.Random(4)
    forms = ["".join(rng.choice("abc d") for _ in range(rng.randint(1, 18))) for _ in range(60)]
    probes = {f for f in forms[:20]}
    for f in forms:
        for _ in range(12):
            x = list(f)
            for _ in range(rng.randint(0, 5)):
                at = rng.randint(0, len(x))
                x[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "cd"])
            probes.add("".join(x))
    fdf = spark.createDataFrame([("t", i, f) for i, f in enumerate(forms)], "field string, canon_id long, form string")
    pdf = spark.createDataFrame([("t", p) for p in probes if p], "field string, probe string")
    got = {(r.probe, r.canon_id): r.edits for r in canon.near_pairs(pdf, fdf).collect()}
    want = {(p, i): d for p in probes if p for i, f in enumerate(forms) if (d := levenshtein(p, f)) <= edits(len(f))}
    assert got == want


@pytest.fixture(scope="module")
def names(spark):
    return table(spark, "/root/testdata/sf0.01", "canon_names")


def test_names(spark, names):
    cases = {
        ("topic", "Trust Dept. Rvw"): 15, ("topic", "Page 4  Capital Adequacy"): 3, ("topic", "A s s e t _ Q u a l i t y _ R e v i e w"): 2, ("topic", "Transactions, Insider"): 24,
        ("topic", "Violatioons of Law and Regulaion .. . ._ . I8"): 11, ("topic", "Weather and Kitchen Policy"): 0, ("topic", "12"): 0, ("topic", "Qual!ty Asset Review"): 2,
        ("topic", "Secs Portf. Rvw"): 17, ("rating_name", "Reinvestment of Community"): 116, ("rating_name", "Asest Qualiyt"): 103, ("rating_name", "Coffee Quality"): 0,
        ("rating_name", "Rating for Earnings"): 105, ("rating_name", "STMR"): 107, ("topic", "Confidential Supervisory Section"): 40, ("other", "Capital"): 0,
        ("topic", "x" * 20_000): 0,
    }
    df = spark.createDataFrame([(f, n) for f, n in cases] + [("topic", None), ("topic", "")], "field string, name string")
    got = {(r.field, r.name): r.canon_id for r in canon.resolve(df, names).collect()}
    assert got == cases


def test_rows(spark, names):
    rows = [("e", 1, "topic", "Capital Adequacy"), ("e", 2, "topic", "capital adequacy"), ("e", 3, "topic", None), ("e", 4, "topic", ""), ("e", 5, "topic", "capital adequacy"), ("e", None, "topic", "zzz")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "source_table string, row_id long, field string, name string, canon_id int")
    got = sorted((r.row_id or 0, r.canon_id) for r in canon.map_names(df.drop("canon_id"), names).collect())
    assert got == [(0, 0), (2, 3), (5, 3)]
    assert canon.map_names(df.drop("canon_id").limit(0), names).count() == 0
