"""Person names cut into first, middle, last name and suffix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from examloom.functions.pyre import let, pyre, strip

# What is deleted from a name, in this order.
_DELETED = [r"\(.*\)", r"\W[0-9]+\W", r"U'end\\", r"\s*-\s*[A-Z]+"]
_AGENCY = pyre(r"[ ,\-]+FDIC\s*$", match=False)
_SUFFIX = pyre(r"(.*[a-z.])[, ]+(jr|sr|jr\.|sr\.|junior|senior|[IVX]+)\s*$", True)
_COMMA = pyre(r"(.*),(.*)$")


def parse_name(name: Column) -> Column:
    """struct(first, middle, last, suffix); null is read as empty."""
    n = F.coalesce(name, F.lit(""))
    for p in _DELETED:
        n = F.regexp_replace(n, pyre(p, match=False), " ")
    return let(F.regexp_replace(n, _AGENCY, ""), _suffixed)


def _suffixed(n: Column) -> Column:
    has = n.rlike(_SUFFIX)
    suffix = F.when(has, F.regexp_extract(n, _SUFFIX, 2)).otherwise("")
    body = strip(F.when(has, F.regexp_extract(n, _SUFFIX, 1)).otherwise(n))
    words = lambda c: F.split(F.regexp_replace(c, r"\.([^\s])", ". $1"), pyre(r"\s+", match=False))
    parts = let(body, lambda b: F.struct(b.rlike(_COMMA).alias("comma"), words(F.when(b.rlike(_COMMA), strip(F.regexp_extract(b, _COMMA, 2))).otherwise(b)).alias("w"), strip(F.regexp_extract(b, _COMMA, 1)).alias("last")))
    return let(F.struct(parts.alias("p"), suffix.alias("s")), lambda x: _cut(x["p"]["comma"], x["p"]["w"], x["p"]["last"], x["s"]))


def _cut(comma: Column, w: Column, before: Column, suffix: Column) -> Column:
    clean = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?i)[^a-z'.\-]", "")
    inner = lambda low, k: F.array_join(F.slice(w, low, F.greatest(F.size(w) - k, F.lit(0))), " ")
    first = F.when(comma | (F.size(w) >= 2), F.get(w, F.lit(0)))
    middle = F.when(comma, inner(2, 1)).when(F.size(w) >= 3, inner(2, 2))
    last = F.when(comma, before).otherwise(F.element_at(w, -1))
    return F.struct(clean(first).alias("first"), clean(middle).alias("middle"), clean(last).alias("last"), suffix.alias("suffix"))
