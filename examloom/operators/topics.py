"""Page headings, the topics they mean, and the texts between them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examloom.functions.pyre import is_upper, let, pyre, single_spaced, strip
from examloom.sources.text import line_array

# Fixed values
IGNORED = pyre(r"(?:.*\(\s*continued\s*\).*|(?:^|\s+)Table\s*of\s*Contents(?:\s+|$).*|\s*$)", True)
NUMBERED = pyre(r"\s*(.*)\s{20,}[\-/a-zA-Z0-9\s]*$")
CONFIDENTIAL = pyre(r"\s*confidential(\s*|\s+.*)$", True)
#: Headings that are no topic, in lower case with single spaces: those of one site, given as default.
EXCEPTIONS = ("sabal palm bank",)
LIMIT = 32_000


def without_number(heading: Column) -> Column:
    """Without page numbers far to the right, again and again; a heading without one stays as it is."""

    def once(h: Column, _: Column) -> Column:
        return let(strip(h), lambda s: F.when(s.rlike(NUMBERED), F.regexp_extract(s, NUMBERED, 1)).otherwise(h))

    # each removal takes 20 characters or more, so there are no more of them than this
    rounds = F.sequence(F.lit(1), F.floor(F.length(heading) / 20).cast("int") + 1)
    return F.when(F.length(heading) < 20, heading).otherwise(F.aggregate(rounds, heading, once))


def heads(text: Column) -> Column:
    """array of struct(line_idx from 0, heading, char_offset) of the lines that begin with a form feed, but for continuations and contents.

    The text is cut at these lines, so only the sections are gone through, not the lines in them.
    """
    unified = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"\n\z", "")
    breaks = lambda s: F.length(s) - F.length(F.replace(s, F.lit("\n"), F.lit("")))
    sized = lambda parts: F.transform(parts, lambda s: F.struct(F.substring_index(s, "\n", 1).alias("head"), breaks(s).alias("n"), (F.length(F.replace(s, F.lit("\f"), F.lit(""))) + breaks(s)).alias("size")))
    start = F.struct(F.lit(0).alias("line"), F.lit(0).cast("long").alias("offset"), F.array().cast("array<struct<line:int,offset:bigint>>").alias("places"))

    def add(acc: Column, s: Column) -> Column:
        line, offset = acc["line"] + s["n"], acc["offset"] + s["size"]
        return F.struct(line.alias("line"), offset.alias("offset"), F.array_append(acc["places"], F.struct(line.alias("line"), offset.alias("offset"))).alias("places"))

    def named(parts: Column) -> Column:
        places = F.aggregate(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), start, add)["places"]
        at = F.zip_with(places, F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p, s: F.struct(p["line"].alias("line_idx"), s["head"].alias("head"), (p["offset"] + 2).alias("char_offset")))
        some = F.filter(at, lambda x: (x["head"] != "") & ~x["head"].rlike(IGNORED))
        return F.filter(F.transform(some, lambda x: F.struct(x["line_idx"].alias("line_idx"), without_number(x["head"]).alias("heading"), x["char_offset"].alias("char_offset"))), lambda x: x["heading"] != "")

    return let(sized(F.split(unified, r"(?dm)^\f")), named)


def headings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_idx from 0, heading, char_offset).

    char_offset counts the characters before with line ends of two, form feeds apart, and two for the line itself.
    """
    return docs.where(F.contains(F.col(text), F.lit("\f"))).select(key, F.inline(heads(F.col(text))))


def exception(topic: Column, exceptions: Iterable[str] = EXCEPTIONS) -> Column:
    return (topic == "") | F.lower(single_spaced(topic)).isin(*exceptions)


def resolve_topics(names: DataFrame, label_map: DataFrame, guess: Callable[[DataFrame], DataFrame] | None = None, exceptions: Iterable[str] = EXCEPTIONS) -> DataFrame:
    """(name) → (name, topic, score, kind): exact text, upper-case text, class name, confidential, guess; each name once.

    label_map: (ord, text, topic); of equal texts the last counts, of texts equal in upper case the first. guess: a
    function from (name) to (name, topic, score) for the rest.
    """
    names = names.select("name").where("name IS NOT NULL").distinct()
    exact = label_map.groupBy(F.col("text").alias("name")).agg(F.max_by("topic", "ord").alias("exact"))
    upper = label_map.groupBy(F.upper("text").alias("name")).agg(F.min_by("topic", "ord").alias("upper"))
    classes = label_map.select(F.col("topic").alias("name"), F.col("topic").alias("class")).distinct()
    joined = names.join(exact, "name", "left").join(upper, "name", "left").join(classes, "name", "left")
    none = exception(F.col("name"), exceptions)
    topic = F.when(none, None).otherwise(F.coalesce("exact", F.when(is_upper(F.col("name")), F.col("upper")), "class", F.when(F.col("name").rlike(CONFIDENTIAL), "Confidential")))
    kind = F.when(none, "exception").when(F.col("exact").isNotNull() | is_upper(F.col("name")) & F.col("upper").isNotNull() | F.col("class").isNotNull(), "actual").when(F.col("name").rlike(CONFIDENTIAL), "predefined").otherwise("guess")
    known = joined.select("name", topic.alias("topic"), F.when(kind == "exception", -1.0).when(kind == "guess", 0.0).otherwise(1.0).alias("score"), kind.alias("kind"))
    if guess is None:
        return known
    guessed = guess(known.where("kind = 'guess'").select("name")).select("name", F.col("topic").alias("g_topic"), F.col("score").alias("g_score"))
    return known.join(guessed, "name", "left").select("name", F.coalesce("topic", "g_topic").alias("topic"), F.when(F.col("kind") == "guess", F.coalesce("g_score", F.lit(0.0))).otherwise(F.col("score")).alias("score"), "kind")


def topic_hits(heads: DataFrame, resolved: DataFrame, toc_counts: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """(key, line_idx, heading, topic, kind, char_offset): scored headings; guesses only where the document has no contents and
    the heading doesn't begin with a space; a topic repeated at once is dropped."""
    hits = heads.withColumn("name", strip(F.col("heading"))).join(resolved, "name").where("score > 0")
    if toc_counts is not None:
        hits = hits.join(toc_counts.select(key, "toc_count"), key, "left").where("kind <> 'guess' OR coalesce(toc_count, 0) = 0")
    hits = hits.where((F.col("kind") != "guess") | ~F.col("heading").rlike(pyre(r"\s+.*")))
    before = F.lag("topic").over(Window.partitionBy(key).orderBy("line_idx"))
    return hits.withColumn("before", before).where("before IS NULL OR before <> topic").select(key, "line_idx", "heading", "topic", "kind", "char_offset")


def spans(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each hit with the line at which the next begins; null at the end."""
    return hits.withColumn("end_idx", F.lead("line_idx").over(Window.partitionBy(key).orderBy("line_idx")))


def topic_texts(docs: DataFrame, hits: DataFrame, key: str = "doc_id", text: str = "text", newline: str = "\r\n") -> DataFrame:
    """(key, topic, lines): the lines from a hit to the next, form feeds removed; of a topic's several spans the last."""
    last = spans(hits, key).groupBy(key, "topic").agg(F.max_by(F.struct("line_idx", "end_idx"), "line_idx").alias("s"))
    arr = docs.select(key, line_array(F.col(text), False).alias("all"))
    cut = F.slice("all", F.col("s.line_idx") + 1, F.greatest(F.coalesce("s.end_idx", F.size("all")) - F.col("s.line_idx"), F.lit(0)))
    return last.join(arr, key).select(key, "topic", cut.alias("lines")).withColumn("topic_text", F.array_join("lines", newline))


def packed(lines: Column, newline: str = "\r\n", limit: int = LIMIT) -> Column:
    """Lines packed greedily into pieces of at most limit characters, line ends counted; a longer line stands alone."""
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("size"), F.array(F.lit(0)).alias("cuts"))

    def add(acc: Column, x: Column) -> Column:
        full = (acc["i"] > 0) & (acc["size"] + len(newline) + F.length(x) > limit)
        size = F.when(full | (acc["i"] == 0), F.length(x)).otherwise(acc["size"] + len(newline) + F.length(x))
        return F.struct((acc["i"] + 1).alias("i"), size.alias("size"), F.when(full, F.array_append(acc["cuts"], acc["i"])).otherwise(acc["cuts"]).alias("cuts"))

    def pieces(cuts: Column) -> Column:
        return F.transform(cuts, lambda c, k: F.array_join(F.slice(lines, c + 1, F.coalesce(F.get(cuts, k + 1), F.size(lines)) - c), newline))

    return F.when(F.size(lines) == 0, F.array().cast("array<string>")).otherwise(let(F.aggregate(lines, start, add)["cuts"], pieces))


def split_cells(texts: DataFrame, key: str = "doc_id", newline: str = "\r\n", limit: int = LIMIT) -> DataFrame:
    """(key, topic, piece_no, piece)."""
    return texts.select(key, "topic", F.posexplode(packed(F.col("lines"), newline, limit)).alias("n_", "piece")).select(key, "topic", (F.col("n_") + 1).alias("piece_no"), "piece")
