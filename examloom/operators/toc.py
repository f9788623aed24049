"""Tables of contents: finding them, their entries and how sure an entry is.

Reports without the opening line of a contents are filtered by one search over the text; only the rest is cut into lines.
All state is that of one document, so contents are an expression over its lines: no shuffle, and no step quadratic in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions.arrays import first_repeat, first_where, holds, present, some_begins, tail
from examloom.functions.pyre import is_lower, is_title, is_upper, let, pyre, single_spaced, strip
from examloom.sources.text import line_array

# The patterns of a contents.
START = pyre(r"[0-9\s]*(table\s+of\s+contents)(\s+\S+)?\s*$", True)
BLANK = pyre(r"(?:\s*|\s*page\s*|\s*c\s*|\s*li\s*)$", True)
END = [
    pyre(r"(?:abbreviations:\s*|note:\s*|.*dollar.*|.*in thousands.*|\x0Cexamination conclusions? and comments?.*|.*amounts in tables are shown.*)$", True),
    pyre(r"\s*FFI.*$"),
]
ENTRY = pyre(r"\s{0,30}([A-Z].*?)([\s._\-/:]+[l0-9IVX]*)?\s*$")
UNSURE_LIMIT = 5


def entry_text(line: Column) -> Column:
    """The entry without leaders and page number; empty where the line is none."""
    e = strip(F.regexp_extract(line, ENTRY, 1))
    return F.regexp_replace(e, pyre(r"\s+'\s+", match=False), "'")


def analyze(topic: Column) -> Column:
    """struct(formatted, sure): the words without trailing dots, and whether it looks like an entry."""
    words = F.split(topic, pyre(r"\s+", match=False))
    last = lambda ws: F.coalesce(F.array_max(F.transform(ws, lambda w, i: F.when(w.rlike(r"^\.*$"), 0).otherwise(i + 1))), F.lit(0))

    def judged(kept: Column) -> Column:
        first, final = F.get(kept, F.lit(0)), F.get(kept, F.size(kept) - 1)
        doubtful = F.exists(kept, lambda w: w.endswith(".") | w.rlike("[0-9]")) | F.coalesce(let(first, is_lower), F.lit(False)) | F.coalesce(F.lower(final) == "of", F.lit(False))
        return F.struct(strip(F.array_join(kept, " ")).alias("formatted"), (~doubtful).alias("sure"))

    return let(let(words, lambda ws: F.slice(ws, 1, last(ws))), judged)


def _plain(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.replace(c, F.lit("'"), F.lit("")), "[^a-zA-Z0-9]", " "), r"\s+", " ")


def _case(formatted: Column) -> Column:
    """0 lower, 1 title, 2 upper, 3 mixed, of the first word, or of the second after "IT"."""
    words = F.split(formatted, r"\s+")
    w = F.when(F.get(words, F.lit(0)) == "IT", F.get(words, F.lit(1))).otherwise(F.get(words, F.lit(0)))
    return F.when(w.isNull(), None).when(is_lower(w), 0).when(is_title(w), 1).when(is_upper(w), 2).otherwise(3)


def _closing(line: Column) -> Column:
    return ~line.rlike(BLANK) & (line.rlike(END[0]) | line.rlike(END[1]))


def _recurring(found: Column, after: Column) -> Column:
    """Of the entries those that a line after the contents repeats, up to the first that breaks the streak of cases.

    Lines are sorted once; an entry begins one of them if it begins the first that isn't below it.
    """
    bare = lambda c: single_spaced(F.regexp_replace(c, r"\(.*\)", ""))
    low = F.transform(F.filter(after, lambda x: F.trim(x) != ""), lambda x: F.lower(single_spaced(strip(x))))
    lines_ = F.struct(F.array_sort(F.array_distinct(F.transform(low, _plain))).alias("plain"), F.array_sort(F.array_distinct(F.transform(low, lambda x: _plain(bare(x))))).alias("bare"))
    ordered = F.array_sort(F.transform(found, lambda e, k: F.struct(e["topic_formatted"].alias("name"), k.alias("k"), e["topic"].alias("topic"))))

    def ends(o: Column, step: int) -> Column:
        return present(F.transform(o, lambda x, j: F.when(~x["name"].eqNullSafe(F.get(o, j + step)["name"]), x)))

    # one for each formatted text: its first place and its last wording
    groups = let(ordered, lambda o: F.array_sort(F.zip_with(ends(o, -1), ends(o, 1), lambda x, y: F.struct(x["k"].alias("first"), x["name"].alias("name"), y["topic"].alias("topic")))))

    def repeated(ls: Column, c: Column) -> Column:
        return some_begins(ls["plain"], _plain(c)) | some_begins(ls["bare"], _plain(bare(c)))

    hits = let(lines_, lambda ls: F.filter(groups, lambda g: repeated(ls, F.lower(g["name"])) | repeated(ls, F.lower(g["topic"]))))
    cased = F.transform(hits, lambda g: F.struct(g["name"].alias("name"), _case(g["name"]).alias("case")))

    def streak(m: Column) -> Column:
        begin = first_where(m, lambda x: x["case"].isin(1, 2))
        cut = F.array_min(F.transform(m, lambda x, i: F.when((i > begin) & ~x["case"].eqNullSafe(F.get(m, begin)["case"]), i)))
        return F.slice(m, 1, F.coalesce(cut, F.size(m)))

    kept = F.array_sort(F.transform(let(cased, streak), lambda x: x["name"]))
    return let(kept, lambda k: F.filter(found, lambda e: holds(k, e["topic_formatted"])))


def contents(lines: Column, unsure_limit: int = UNSURE_LIMIT, extended: bool = True) -> Column:
    """array of struct(line_no, topic, topic_formatted, sure) of the lines of one document."""

    def cut(found: Column, after: Column, base: Column) -> Column:
        again = first_repeat(F.transform(found, lambda e: e["topic"]))
        doubts = F.filter(F.transform(found, lambda e, k: F.struct(k.alias("k"), e["sure"].alias("sure"))), lambda x: ~x["sure"])

        def end(at: Column) -> Column:
            more = at["fifth"].isNotNull() & (at["again"].isNull() | (at["fifth"] < at["again"]))
            upto = F.slice(found, 1, F.when(more, at["fifth"] + 1).otherwise(F.coalesce(at["again"], F.size(found))))
            if not extended:
                return upto
            rest = tail(after, F.get(found, at["fifth"])["line_no"] - base + 1)
            return F.when(more, let(upto, lambda u: _recurring(u, rest))).otherwise(upto)

        return let(F.struct(again.alias("again"), F.get(doubts, F.lit(unsure_limit - 1))["k"].alias("fifth")), end)

    def entries(after: Column, base: Column) -> Column:
        body = F.slice(after, 1, F.coalesce(first_where(after, _closing), F.size(after)))
        named = F.transform(body, lambda x, i: F.struct((i + base).alias("line_no"), F.when(x.rlike(BLANK), "").otherwise(entry_text(x)).alias("topic")))
        judged = F.transform(F.filter(named, lambda x: x["topic"] != ""), lambda x: F.struct(x.alias("x"), analyze(x["topic"]).alias("a")))
        flat = F.transform(judged, lambda j: F.struct(j["x"]["line_no"].alias("line_no"), j["x"]["topic"].alias("topic"), j["a"]["formatted"].alias("topic_formatted"), j["a"]["sure"].alias("sure")))
        return let(flat, lambda found: cut(found, after, base))

    begin = first_where(lines, lambda x: x.rlike(START))
    return let(begin, lambda b: F.when(b.isNotNull(), let(tail(lines, b + 1), lambda after: entries(after, b + 1))))


def has_contents(text: Column) -> Column:
    """What every document with a contents holds."""
    return text.rlike(pyre(r"table\s+of\s+contents", True, match=False))


def toc_entries(docs: DataFrame, key: str = "doc_id", text: str = "text", unsure_limit: int = UNSURE_LIMIT, extended: bool = True) -> DataFrame:
    """(key, line_no, topic, topic_formatted, sure), each document by itself.

    The contents end at a closing line, at a repeated entry, or with the fifth doubtful entry. In the last case
    (extended) an entry counts if the rest of the text repeats it and its case doesn't break the streak.
    """
    some = docs.where(has_contents(F.col(text)))
    return some.select(key, F.inline(let(line_array(F.col(text)), lambda ls: contents(ls, unsure_limit, extended))))


def toc_summary(docs: DataFrame, entries: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, toc_count) of every document, 0 without entries."""
    counts = entries.groupBy(key).agg(F.count("*").alias("n"))
    return docs.select(key).distinct().join(counts, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("toc_count"))


def toc_detail(entries: DataFrame, key: str = "doc_id") -> DataFrame:
    return entries.select(key, "line_no", "topic", "topic_formatted", F.when(F.col("sure"), "OK").otherwise("Unsure").alias("flag"))


def toc_distinct(entries: DataFrame) -> DataFrame:
    return entries.select("topic_formatted", F.when(F.col("sure"), "OK").otherwise("Unsure").alias("flag")).distinct()
