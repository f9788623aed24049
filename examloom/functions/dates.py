"""Dates as typed on reports, with repair of misread digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from examloom.functions.pyre import let, pyre

_NUMERIC = pyre(r"([0-9]{1,2})[/\-.]([0-9]{1,2})[/\-.]([0-9]{2})([0-9]{2})?(?:\s*$|\s+.*$)")
_WORDS = pyre(r"([a-z]+)\s+([0-9 a-z]+)\s*[/\-.,]\s*([0-9]{2})([0-9]{2})?(?:\s*$|\s+.*$)", True)
_YEAR = pyre(r"[0-9]{4}")
# Fixed values
_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def repair_digits(c: Column) -> Column:
    """Letters read for digits."""
    return F.translate(c, "QIloO", "01100")


def _year(short: Column, rest: Column) -> Column:
    """Four digits, or two with the pivot at 69."""
    two = short.cast("int")
    return F.when(rest != "", F.concat(short, rest).cast("int")).otherwise(two + F.when(two >= 69, 1900).otherwise(2000))


def parse_date(text: Column) -> Column:
    """The first form that matches decides; an impossible date is null."""
    return let(F.regexp_replace(text, pyre(r"^\W+", match=False), ""), _parsed)


def _parsed(s: Column) -> Column:
    part = lambda p, k: F.regexp_extract(s, p, k)
    date = lambda y, m, d: F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")
    numeric = date(_year(part(_NUMERIC, 3), part(_NUMERIC, 4)), part(_NUMERIC, 1).cast("int"), part(_NUMERIC, 2).cast("int"))
    month = F.array_position(F.array(*map(F.lit, _MONTHS)), F.lower(part(_WORDS, 1))).cast("int")
    digits = F.regexp_replace(repair_digits(F.regexp_replace(part(_WORDS, 2), r"[\s\u0085 ]+", "")), "[a-zA-Z]", "")
    day = F.when(digits.rlike("^[0-9]{1,2}$"), F.when(digits.cast("int") == 0, 1).otherwise(digits.cast("int")))
    words = F.when((month > 0) & day.isNotNull(), date(_year(part(_WORDS, 3), part(_WORDS, 4)), month, day))
    year = F.when(s.rlike("^[0-9]{4}$") & (s != "0000"), date(s.cast("int"), F.lit(1), F.lit(1)))
    return F.when(s.rlike(_NUMERIC), numeric).when(s.rlike(_WORDS), words).when(s.rlike(_YEAR), year)


def date_text(d: Column) -> Column:
    """m/d/yyyy without leading zeros; empty for null."""
    return F.when(d.isNull(), "").otherwise(F.concat_ws("/", F.month(d), F.dayofmonth(d), F.year(d)))
