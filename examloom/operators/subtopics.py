"""Sub-topics inside a topic: headings, the texts under them, their normal form and their classes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions.arrays import present
from examloom.functions.pyre import is_lower, is_title, is_upper, let, pyre, strip
from examloom.operators.topics import spans
from examloom.sources.text import line_array

START = "Initial"
# Conjunctions and prepositions that need no capital.
FREE_WORDS = ("and", "or", "but", "nor", "yet", "of", "in", "on", "for", "with", "to", "by", "at", "from", "over", "under", "about", "into", "through", "between", "as", "per", "upon", "within", "without")


def _capital(w: Column) -> Column:
    return is_upper(w) | is_title(w)


def is_subtopic(line: Column) -> Column:
    """A short line of capitalised words, without a closing point or wide gaps, numbering aside."""
    number = lambda w: w.rlike(r"^[0-9][0-9.,]*$")
    gaps = lambda s: F.size(F.split(s, pyre(r"\s{1,5}|\s{0,5}[/\-]\s{0,5}", match=False)))

    def fine(rest: Column) -> Column:
        some = F.filter(rest, lambda w: w != "")
        every = F.forall(some, lambda w: _capital(w) | F.lower(w).isin(*FREE_WORDS) | number(w) | ~w.rlike(r"[\p{L}\p{N}]"))
        return F.coalesce(let(F.get(rest, F.lit(0)), _capital), F.lit(False)) & every & ~F.forall(some, number)

    def worded(s: Column) -> Column:
        words = F.split(s, pyre(r"\s+|\s*[/\-,]\s*", match=False))
        rest = lambda w: F.when(F.get(w, F.lit(0)).rlike(r"^[0-9]+[.)\-]"), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0)))).otherwise(w)
        ok = lambda w: F.when((gaps(s) <= F.size(w)) & (F.size(w) <= 10), let(rest(w), fine)).otherwise(False)
        return F.when((s != "") & ~s.rlike(r'[."]$'), let(words, ok)).otherwise(False)

    return F.coalesce(F.when(~line.rlike(pyre(r"\s+.*$")), let(strip(line), worded)).otherwise(False), F.lit(False))


def normal_form(text: Column) -> Column:
    """Lower-case words without those of small letters only and numbers; only a-z and 0 stay, as models were trained so."""
    words = F.split(text, pyre(r"\s+|\s*[()./\-,]\s*", match=False))
    kept = F.filter(words, lambda w: (w != "") & ~w.rlike(r"^\p{N}+$") & ~is_lower(w))
    return F.array_join(F.filter(F.transform(kept, lambda w: F.regexp_replace(F.lower(w), "[^a-z0]", "")), lambda w: w != ""), " ")


def blocks(lines: Column) -> Column:
    """array of struct(pos, heading, body): the lines under each heading, and those before the first as "Initial".

    Headings without a line are dropped; of a repeated heading the first place and the last lines stay.
    """

    def cut(at: Column) -> Column:
        starts = F.concat(F.array(F.lit(-1)), at)
        parts = F.transform(starts, lambda h, j: F.struct(j.alias("pos"), F.when(h < 0, START).otherwise(F.get(lines, h)).alias("heading"), F.slice(lines, h + 2, F.greatest(F.coalesce(F.get(at, j), F.size(lines)) - h - 1, F.lit(0))).alias("body")))
        return let(F.filter(parts, lambda p: F.size(p["body"]) > 0), once)

    def once(parts: Column) -> Column:
        ordered = F.array_sort(F.transform(parts, lambda p, i: F.struct(p["heading"].alias("heading"), i.alias("i"))))
        ends = lambda o, step: present(F.transform(o, lambda x, j: F.when(~x["heading"].eqNullSafe(F.get(o, j + step)["heading"]), x["i"])))
        places = let(ordered, lambda o: F.zip_with(ends(o, -1), ends(o, 1), lambda x, y: F.struct(F.get(parts, x)["pos"].alias("pos"), F.get(parts, y)["heading"].alias("heading"), F.array_join(F.get(parts, y)["body"], "\n").alias("body"))))
        return F.array_sort(places)

    return let(present(F.transform(lines, lambda x, i: F.when(is_subtopic(x), i))), cut)


def subtopics(docs: DataFrame, hits: DataFrame, topic: str, key: str = "doc_id", text: str = "text", keep_form_feeds: bool = True) -> DataFrame:
    """(key, pos, heading, body): the texts under the headings inside the only span of the topic, none without exactly one.

    With form feeds kept, the heading of the topic itself is no sub-topic, as it begins with white space.
    """
    only = spans(hits, key).where(F.col("topic") == topic).groupBy(key).agg(F.count("*").alias("n_"), F.min("line_idx").alias("from_"), F.min("end_idx").alias("to_")).where("n_ = 1")
    arr = docs.select(key, line_array(F.col(text), keep_form_feeds).alias("lines"))
    cut = F.slice("lines", F.col("from_") + 1, F.greatest(F.coalesce("to_", F.size("lines")) - F.col("from_"), F.lit(0)))
    return only.join(arr, key).select(key, F.inline(let(cut, blocks)))


def resolve_subtopics(names: DataFrame, label_map: DataFrame, guess: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(name) → (name, class, score, kind): by the normal form in the map, by a class of that name, by a guess from the normal form.

    label_map: (ord, text, topic) with normal forms as text; of equal ones the last counts. Each name once; a name without words has no class.
    """
    names = names.select("name").where("name IS NOT NULL").distinct().withColumn("form", normal_form(F.col("name")))
    exact = label_map.where("topic > ''").groupBy(F.col("text").alias("form")).agg(F.max_by("topic", "ord").alias("exact"))
    classes = label_map.where("topic > ''").select(F.col("topic").alias("form"), F.col("topic").alias("class_")).distinct()
    known = names.join(exact, "form", "left").join(classes, "form", "left").select("name", "form", F.coalesce("exact", "class_").alias("class"))
    kind = F.when(F.col("class").isNotNull(), "actual").otherwise("guess")
    if guess is None:
        return known.select("name", "class", F.when(F.col("class").isNotNull(), 1.0).otherwise(0.0).alias("score"), kind.alias("kind"))
    guessed = guess(known.where("class IS NULL AND form <> ''").select(F.col("form").alias("name"))).select(F.col("name").alias("form"), F.col("topic").alias("g"), F.col("score").alias("s"))
    return known.join(guessed, "form", "left").select("name", F.coalesce("class", "g").alias("class"), F.when(F.col("class").isNotNull(), 1.0).otherwise(F.coalesce("s", F.lit(0.0))).alias("score"), kind.alias("kind"))


def subtopic_summary(found: DataFrame) -> DataFrame:
    """(normalized, headings): the different headings of each normal form, sorted."""
    return found.where(F.col("heading") != START).groupBy(normal_form(F.col("heading")).alias("normalized")).agg(F.array_sort(F.collect_set("heading")).alias("headings"))


def subtopic_cells(found: DataFrame, classes: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, class, cell): a JSON object of heading and text per class. classes: (heading, class)."""
    named = found.join(classes, "heading")
    return named.groupBy(key, "class").agg(F.to_json(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("pos", "heading", "body"))), lambda x: F.struct(x["heading"], x["body"])))).alias("cell"))
