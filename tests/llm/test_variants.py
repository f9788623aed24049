import itertools
import random

from examloom.llm import variants as V
from examloom.session import table


def same_bank(name_a, at_a, name_b, at_b):
    return V.same_bank(V.bank_form(name_a, at_a), V.bank_form(name_b, at_b))


def same_person(a, b):
    return V.same_person(V.person(a), V.person(b))


def plain_distance(a, b):
    d = {}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i or not j:
                d[i, j] = i + j
                continue
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_distance_and_index():
    rng = random.Random(2)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(120)]
    for a, b in itertools.product(words, words):
        d = plain_distance(a, b)
        assert V.distance(a, b, 2) == min(d, 3)
        if d <= 1:
            assert V.deletes(a, 1) & V.deletes(b, 1)
        if d <= 2:
            assert V.deletes(a, 2) & V.deletes(b, 2)


def test_assignment_against_all():
    rng = random.Random(3)
    for _ in range(100):
        n, m = rng.randint(1, 4), rng.randint(4, 6)
        cost = [[rng.random() for _ in range(m)] for _ in range(n)]
        best = min(sum(cost[i][p[i]] for i in range(n)) for p in itertools.permutations(range(m), n))
        assert abs(V.assign(cost, [99.0] * n) - best) < 1e-9


def test_banks():
    at = "Dunomplomouth, Tamberlin"
    for a, b in [("First National Bank of Dunomplomouth", "Frst Nat. Bk of Dunomplomouth"), ("Savings Bank, Dunomplomouth", "The Dunomplomouth Savings Bank"), ("Elsarvgugate_Bank_and_Trust_Company", "Elsarvgugate Bk. & Tr. Co"), ("FNB of Dunomplomouth", "FIRST NATIONAL BANK OF DUNOMPLOMOTUH"), ("Pioneer Trst Company *", "Trust Company, Pioneer")]:
        assert same_bank(a, at, b, "Dunomplomouth, TB"), (a, b)
    assert same_bank("Peoples Trust Company", at, "Peoples Trust Company", "City of Dunomplomouth, TB")
    assert not same_bank("Peoples Trust Company", at, "Peoples Trust Company", "Elsomshidale, New Arden")
    assert not same_bank("Peoples Trust Company", at, "Pioneer Trust Company", at)
    assert not same_bank("Bank of Dunomplomouth", at, "First National Bank of Dunomplomouth", at)
    assert not same_bank("Pioneer Savings Bank", "Falortipool, Wendomin", "Pioneer Savings Bank", "Falortipool, Quorrin")


def test_slips_in_frequent_words():
    at = "Dunomplomouth, Tamberlin"
    for slip in ("Firrst", "Fisrt", "Firts", "Firat", "Fist"):
        assert same_bank("First National Bank of Dunomplomouth", at, f"{slip} National Bank of Dunomplomouth", at), slip
    assert same_bank("Pioneer Savings Bank, Chartered", at, "Pioneer Savings Bank, Chartdred", at)
    assert same_bank("Pioneer Bank and Trust Company", at, "Pioneer Bank adn Trst Company", at)
    lexicon = V.Lexicon({"harborview": 500, "harborvied": 3})
    assert lexicon.correct("habrorvieww") == lexicon.correct("harborvied") == "harborview"
    assert V.bank_tokens("Pioneer Savinsg Bank of Trusd", "trust", lexicon) == ("pioneer", "savings", "bank", "trusd")


def test_frequent_words(spark):
    df = spark.createDataFrame([(i, f"Harborview Bank {chr(97 + i % 26) * 9}") for i in range(60)], "id long, bank_name string")
    got = V.frequent_words(df)
    assert got["harborview"] == got["bank"] == 60 and got["a" * 9] == 3 and len(got) == 10


def test_people():
    for a, b in [("Skelendseman, Gerry", "Gerald K. Skelendseman"), ("(EIC) Margaret P. Holi-ntdiski ", "Meg Holintdiski"), ("GRIESKPUDEZ Jennifer", "J. M. Grieskpudez"), ("Wil. F Peledshimark", "William F. Peledshimark; on site"), ("Chris Holim gradorf", "Chirstopher Holimgradorf"), ("Frederick Osufsleham Sr.", "F. P. Osufsleham Sr. (Lead)")]:
        assert same_person(a, b), (a, b, V.person(a), V.person(b))
    for a, b in [("Quentin C. Gleninpulund", "Priya G. Gleninpulund"), ("Larry Korelfovik", "Harry Korelfovik"), ("Frederick Osufsleham Sr.", "Frederick Osufsleham Jr."), ("Gerald K. Skelendseman", "Gerald B. Skelendseman")]:
        assert not same_person(a, b), (a, b)


def test_middle_initials_by_rows(spark):
    def pairs(names):
        df = spark.createDataFrame([(i, "", "", n) for i, n in enumerate(names)], "serial_no long, bank_name string, bank_location string, examiner_in_charge string")
        return {frozenset((names[r.serial_a], names[r.serial_b])) for r in V.expanded(*V.examiners(df), "examiner").collect()}

    full, odd, plain = "Susan A. Wexlerand", "Susan S. Wexlerand", ["Susan Wexlerand", "Wexlerand, Susan", "SUSAN WEXLERAND"]
    among = {frozenset(p) for p in itertools.combinations(plain, 2)}
    assert pairs([full] * 5 + [odd] + plain) == among | {frozenset((full, p)) for p in plain}
    assert pairs([full, odd] + plain) == among
    assert pairs([full] * 5 + ["S. Wexlerand", "Steven Wexlerand", plain[0]]) == {frozenset((full, plain[0]))}


def test_pairs_like_all_pairs(spark, monkeypatch):
    """The index loses no pair that the verification accepts."""
    rows = table(spark, "/root/testdata/sf0.001", "get_headers_v1").unionAll(table(spark, "/root/testdata/sf0.01", "get_headers_v1").where("serial_no > 300"))
    with_bank = rows.where("trim(bank_name) <> '' AND trim(bank_location) <> ''")
    keys = V._keys(with_bank, ["bank_name", "bank_location"])
    codes, lexicon = V.state_codes(keys), V.Lexicon(V.frequent_words(keys))
    spelled = {r.serial_no: (r.bank_name, r.bank_location) for r in with_bank.collect()}
    got = {frozenset((spelled[r.serial_a], spelled[r.serial_b])) for r in V.expanded(*V.banks(rows), "bank").collect()}
    assert got == {frozenset((x, y)) for x, y in itertools.combinations(sorted(set(spelled.values())), 2) if V.same_bank(V.bank_form(*x, lexicon), V.bank_form(*y, lexicon), codes)}
    monkeypatch.setattr(V, "_unambiguous", lambda forms, links: links)
    named = {r.serial_no: r.examiner_in_charge for r in rows.where("trim(examiner_in_charge) <> ''").collect()}
    got = {frozenset((named[r.serial_a], named[r.serial_b])) for r in V.expanded(*V.examiners(rows), "examiner").collect()}
    assert got == {frozenset((x, y)) for x, y in itertools.combinations(sorted(set(named.values())), 2) if same_person(x, y)}


def test_edges(spark):
    rows = [(1, "Pioneer Bank", "Northold", "Ann Lee"), (2, "pioneer bank", "Northold", "Ann Lee"), (3, None, "Northold", None), (4, " ", "", ""), (5, "Pioneer Bank", "Northold", "A. Lee"), (6, "x" * 50_000, "y" * 50_000, "z" * 50_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "serial_no long, bank_name string, bank_location string, examiner_in_charge string, entity string")
    got = sorted((r.entity, r.serial_a, r.serial_b) for r in V.variants(df).collect())
    assert got == [("bank", 1, 2), ("bank", 2, 5), ("examiner", 1, 5), ("examiner", 2, 5)]
    assert V.variants(df.limit(0)).count() == 0


def test_nothing_that_grows_is_broadcast(spark, monkeypatch):
    """The planner takes the deleted forms, some hundred times the words, for as small as the words."""
    plans = []

    def kept(df, name="table", write=V.materialise):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(V, "materialise", kept)
    kept(V.variants(table(spark, "/root/testdata/sf0.01", "get_headers_v1")))
    assert len(plans) > 7 and not [p for p in plans if "Broadcast" in p]
