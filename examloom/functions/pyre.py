"""Regular expressions and string predicates with Python's meaning, as Spark columns.

Java's \\s, \\w and `.` differ from Python's on non-ASCII text; pyre() rewrites a Python pattern so that Spark matches the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CLASSES = {"s": r"\s\x1c-\x1f\x85\xa0", "w": r"\p{L}\p{N}_"}
WHITE = "[" + _CLASSES["s"] + "]"


def pyre(pattern: str, ignore_case: bool = False, match: bool = True) -> str:
    """Java pattern for a Python one; match: anchored at the start only."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            k = pattern[i + 1]
            if k.lower() in _CLASSES:
                body = _CLASSES[k.lower()]
                out.append(body if inside and k.islower() else f"[^{body}]" if k.isupper() else f"[{body}]")
            else:
                out.append(c + k)
            i += 2
            continue
        if c == "[":
            out.append("\\[" if inside else c)
            inside = True
        else:
            if c == "]":
                inside = False
            out.append(c)
        i += 1
    body = "".join(out)
    return ("(?diu)" if ignore_case else "(?d)") + (f"^(?:{body})" if match else body)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WHITE}+|{WHITE}+$", "")


def single_spaced(c: Column) -> Column:
    return F.regexp_replace(c, f"{WHITE}+", " ")


def title(c: Column) -> Column:
    """str.title(): a capital after every character that is no letter."""
    after_letter = lambda chars, i: F.coalesce(F.get(chars, i - 1), F.lit("")).rlike(r"\p{L}")
    return let(F.split(c, ""), lambda chars: F.array_join(F.transform(chars, lambda x, i: F.when((i > 0) & after_letter(chars, i), F.lower(x)).otherwise(F.upper(x))), ""))


def is_upper(c: Column) -> Column:
    return (F.upper(c) == c) & c.rlike(r"\p{L}")


def is_lower(c: Column) -> Column:
    return (F.lower(c) == c) & c.rlike(r"\p{L}")


def is_title(c: Column) -> Column:
    return (title(c) == c) & c.rlike(r"\p{L}")


def is_heading(c: Column) -> Column:
    """Whether all words are in capitals or begin with one."""
    return F.forall(F.split(c, f"[^{_CLASSES['w']}]+"), lambda w: is_upper(w) | is_title(w))


def let(value: Column, f) -> Column:
    """f(value) with the value computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def literal(text: str) -> str:
    """A string in SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
