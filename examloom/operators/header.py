"""Header fields of reports: region, place, bank, certificate, examiner and dates.

All fields of a document are one expression over its lines, each gone through once: no shuffle, no step quadratic in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions.arrays import first_where, present
from examloom.functions.dates import date_text, parse_date
from examloom.functions.names import parse_name
from examloom.functions.pyre import WHITE, is_lower, let, pyre, single_spaced, strip, title
from examloom.sources.text import line_array

# The wording of each field, by rank.
FIELDS = {
    "bank_name": [r"bank\s+name", r"institution\s+name", "name"],
    "bank_location": ["location"],
    "examiner_in_charge": [r"examiner[\s\-]*in[\s\-]*charge"],
    "exam_start_date": [r"examination[\s\-]*start[\s\-]*date"],
    "exam_date": [r"examination[\s\-]*date"],
    "exam_as_of_date": [r"examination[\s\-]*as[\s\-]*of[\s\-]*date"],
}
# A region, what stands far to the right of a field, a certificate.
_REGION = pyre(r"(^|.*\s+)region(\s*[:']\s*|\s+)(.*)?\s*$", True)
_OTHER = pyre(r"(.*)?\s{5,}(certificate\s+num[bh]e[ir]|certificate|charter\s+num[bh]er|charter|field\s+offic\s*e|url)\s*:?\s*(.*)?\s*$", True)
_CERT = pyre(r"(^|^.*\s+)(certificate\s+number)(\s*:\s*|\s+)(\w+).*$", True)
DATES = ("exam_start_date", "exam_date", "exam_as_of_date")
#: What every wording holds, so that other lines aren't tried against all patterns.
_NEAR = pyre(r"region|certificate\s+number", True, match=False)
ANY = pyre(r"region|name|location|certificate|examiner[\s\-]*in[\s\-]*charge|examination[\s\-]*(?:start|date|as)", True, match=False)


def _field(p: str) -> str:
    return pyre(r"(^|.*\s+)" + p + r"(\s*[:'][\'\s\.]*|['\s\.]+)(.*)?\s*$", True)


def without_certificate(s: Column) -> tuple[Column, Column]:
    """The text before a certificate, charter or office far to the right, and the certificate."""
    group = lambda k: F.regexp_extract(s, _OTHER, k)
    keep = (F.lower(group(2)) == "charter") & (F.lower(group(3)) == "bank")
    cut = s.rlike(_OTHER) & ~keep
    return F.when(cut, group(1)).otherwise(s), F.when(cut & F.lower(strip(group(2))).startswith("certificate"), group(3)).otherwise("")


def candidates(lines: Column) -> Column:
    """array of struct(line_no, field, rank, value, quality) of every wording of every field on every line."""

    def wording(at: Column, field: str, rank: int, pattern: str) -> Column:
        group = lambda k: F.regexp_extract(at["x"], pattern, k)
        values = F.split(group(3), pyre(r"\s{5,}", match=False))

        def read(v: Column) -> Column:
            quality = (strip(group(1)) == "").cast("int") + (strip(group(2)) == ":").cast("int") + (F.size(v) == 1).cast("int")
            return F.struct(at["i"].alias("line_no"), F.lit(field).alias("field"), F.lit(rank).alias("rank"), F.get(v, F.lit(0)).alias("value"), quality.alias("quality"))

        return F.when(at["x"].rlike(pattern), let(values, read))

    def wordings(at: Column) -> Column:
        return present(F.array(*[wording(at, field, rank, _field(p)) for field, patterns in FIELDS.items() for rank, p in enumerate(patterns)]))

    near = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(ANY))
    return F.flatten(F.transform(near, wordings))


def best(cands: Column) -> Column:
    """struct of one value, or date, for each field: the first wording by rank, then by quality, then by line; of dates the first that is one."""
    dates = lambda v: F.transform(F.array(v, _cut_date(v)), parse_date)
    order = F.transform(cands, lambda x: F.struct(x["rank"].alias("rank"), (-x["quality"]).alias("q"), x["line_no"].alias("line_no"), x["value"].alias("value"), x["field"].alias("field"), F.when(x["field"].isin(*DATES), dates(x["value"])).alias("dates")))
    valid = F.filter(order, lambda x: x["dates"].isNull() | F.get(x["dates"], F.lit(0)).isNotNull())
    one = lambda c, field: F.get(F.filter(c, lambda x: x["field"] == field), F.lit(0))
    return let(F.array_sort(valid), lambda c: F.struct(*[(F.get(one(c, f)["dates"], F.lit(1)) if f in DATES else one(c, f)["value"]).alias(f) for f in FIELDS]))


def _cut_date(value: Column) -> Column:
    return F.get(F.split(value, pyre(r"\s{3,}", match=False)), F.lit(0))


def examiner_name(value: Column) -> Column:
    """Words up to one with a semicolon or one in lower case."""
    words = F.split(value, f"{WHITE}+")
    stop = F.array_min(F.filter(F.transform(words, lambda w, i: F.when((w == "") | is_lower(F.substring(w, 1, 1)), i).when(w.endswith(";"), i + 1)), lambda x: x.isNotNull()))
    return F.regexp_replace(F.array_join(F.slice(words, 1, F.coalesce(stop, F.size(words))), " "), ";$", "")


def _named(s: Column) -> Column:
    """From the first capital on, with single spaces."""
    s = strip(s)
    return single_spaced(F.when(s.rlike("[A-Z]"), F.regexp_extract(s, r"(?s)^.*?([A-Z][^\n]*)", 1)).otherwise(s))


def _block(lines: Column) -> Column:
    """struct(region, bank_location, bank_name, certificate) of the lines of one document.

    A region line at the start of a line counts more than one inside, a colon more than none, later ones more than
    earlier ones; the two lines above that aren't blank give place and bank.
    """
    filled = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: ~s["x"].rlike(pyre(r"\s*$")))

    def read(rows: Column) -> Column:
        def one(s: Column, p: Column) -> Column:
            group = lambda k: F.regexp_extract(s["x"], _REGION, k)
            is_region, first = s["x"].rlike(_REGION), strip(group(1)) == ""
            above = lambda k: F.coalesce(F.get(rows, p - k)["x"], F.lit(""))
            (region, c1), (location, c2), (bank, c3) = (without_certificate(x) for x in (group(3), above(1), above(2)))
            quality = F.when(is_region & first & (strip(group(2)) == ":"), 3).when(is_region & first, 2).when(is_region, 1)
            return F.struct(
                s["i"].alias("line_no"), quality.alias("quality"), F.when(is_region, region).alias("region"), F.when(is_region & first, location).alias("location"), F.when(is_region & first, bank).alias("bank"),
                F.when(is_region, F.concat(F.array(c1), F.when(first, F.array(c2, c3)).otherwise(F.array().cast("array<string>")))).alias("beside"), F.regexp_extract(s["x"], _CERT, 4).alias("direct"),
            )

        return F.transform(F.filter(F.transform(rows, lambda s, p: F.struct(s.alias("s"), p.alias("p"))), lambda x: x["s"]["x"].rlike(_NEAR)), lambda x: one(x["s"], x["p"]))

    def pick(found: Column) -> Column:
        # the first places of better lines; a line below one of them isn't accepted
        over = F.struct(first_where(found, lambda x: x["quality"] >= 2).alias("some"), first_where(found, lambda x: x["quality"] >= 3).alias("most"))

        def out(o: Column) -> Column:
            accepted = lambda x, i: F.when(x["quality"] >= 3, True).when(x["quality"] == 2, o["most"].isNull() | (i < o["most"])).when(x["quality"] == 1, o["some"].isNull() | (i < o["some"])).otherwise(False)
            none = F.array().cast("array<string>")
            certificates = F.flatten(F.transform(found, lambda x, i: F.concat(F.when(accepted(x, i), F.coalesce(x["beside"], none)).otherwise(none), F.array(x["direct"]))))
            top = lambda name, least: F.array_max(F.transform(F.filter(found, lambda x: x["quality"] >= least), lambda x: F.struct(x["quality"].alias("q"), x["line_no"].alias("n"), x[name].alias("v"))))["v"]
            return F.struct(top("region", 1).alias("region"), top("location", 2).alias("bank_location"), top("bank", 2).alias("bank_name"), F.get(F.filter(certificates, lambda c: c != ""), F.lit(0)).alias("certificate"))

        return let(over, out)

    return let(let(filled, read), pick)


def region_block(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, region, bank_location, bank_name, certificate) of the documents with a line of a region or certificate."""
    lines = F.filter(line_array(F.col(text), False), lambda x: x.isNotNull())
    found = docs.where(F.col(text).rlike(_NEAR)).select(key, let(lines, lambda ls: F.when(F.exists(ls, lambda x: x.rlike(_NEAR)), _block(ls))).alias("b")).where("b IS NOT NULL")
    return found.select(key, "b.*")


def fields(text: Column) -> Column:
    """struct of the 13 header columns of one text; empty where nothing is found, null numbers where there is no date."""
    or_empty = lambda c: F.coalesce(c, F.lit(""))
    punct = lambda c: strip(F.regexp_replace(c, r"[^\p{L}\p{N}_\s\u0085\u00a0\x1c-\x1f]", ""))
    read = let(line_array(or_empty(text), False), lambda ls: F.struct(_block(ls).alias("b"), best(candidates(ls)).alias("f")))

    def final(r: Column) -> Column:
        b, f = r["b"], r["f"]
        filled = lambda x, y: or_empty(F.coalesce(F.nullif(x, F.lit("")), y))
        region = F.get(F.split(punct(or_empty(b["region"])), pyre(r"\s{5,}", match=False)), F.lit(0))
        parts = F.struct(parse_name(examiner_name(or_empty(f["examiner_in_charge"]))).alias("name"), F.coalesce(f["exam_start_date"], f["exam_date"]).alias("start"), f["exam_as_of_date"].alias("as_of"))

        def named(p: Column) -> Column:
            name, start, as_of = p["name"], p["start"], p["as_of"]
            return F.struct(
                F.replace(title(region), F.lit(" "), F.lit("_")).alias("region"), punct(or_empty(b["certificate"])).alias("certificate_number"),
                F.replace(_named(filled(b["bank_name"], f["bank_name"])), F.lit(" "), F.lit("_")).alias("bank_name"), _named(filled(b["bank_location"], f["bank_location"])).alias("bank_location"),
                name["first"].alias("examiner_in_charge_first_name"), name["middle"].alias("examiner_in_charge_middle_name"), name["last"].alias("examiner_in_charge_last_name"),
                date_text(start).alias("exam_start_date"), F.year(start).alias("exam_start_year"), F.month(start).alias("exam_start_month"),
                date_text(as_of).alias("exam_as_of_date"), F.year(as_of).alias("exam_as_of_year"), F.month(as_of).alias("exam_as_of_month"),
            )

        return let(parts, named)

    return let(read, final)


def header_fields(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the 13 header columns of the final table; empty where nothing is found."""
    near = F.when(F.col(text).rlike(ANY), F.col(text)).otherwise("")  # other texts hold no field
    return docs.select(key, fields(near).alias("h")).select(key, "h.*")
