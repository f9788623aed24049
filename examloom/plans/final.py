"""The final table: one wide row per report.

Reports are read twice: once for what is small (header, ratings, headings, contents), which is written, and once for the texts of
the topics. Only small rows are shuffled in between; the texts meet their topics in one join by document.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions.pyre import let, literal
from examloom.operators import header, ratings, subtopics, topics
from examloom.operators.toc import contents, has_contents, toc_entries, toc_summary
from examloom.session import materialise
from examloom.sources.text import line_array, with_serial


def column(name: str) -> str:
    return "_".join(name.replace("-", " ").replace("/", " ").replace("'", "").split())


def topic_hits(docs: DataFrame, label_map: DataFrame, guess=None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """guess: (name) → (name, topic, score) for headings outside the map, admitted where a document has no contents."""
    heads = topics.headings(docs, key, text)
    names = heads.select(topics.strip(F.col("heading")).alias("name"))
    counts = toc_summary(docs, toc_entries(docs, key, text), key) if guess else None
    return topics.topic_hits(heads, topics.resolve_topics(names, label_map, guess), counts, key)


@dataclass
class SubtopicColumns:
    """Sub-topics of one topic: its cells are replaced by one for each class. label_map: (ord, text, topic) of normal forms."""

    topic: str
    label_map: DataFrame
    classes: list[str]
    guess: Callable[[DataFrame], DataFrame] | None = None


def extracted(docs: DataFrame, key: str, text: str, counted: bool) -> DataFrame:
    """(key, file_name, 13 header columns, table, spoken, heads, toc_count): all that is small in a report, by one scan without a shuffle."""
    lines = lambda t, f: let(line_array(t), f)
    t = F.col(text)
    # texts without what every contents or table holds aren't cut into lines for it
    table = F.when(ratings.has_table(t), lines(t, ratings.table_rows))
    found = F.when(has_contents(t), lines(t, lambda ls: contents(ls))) if counted else F.lit(None).cast("array<int>")
    df = docs.select(
        key, "file_name", header.fields(F.when(t.rlike(header.ANY), t).otherwise("")).alias("header_"), table.alias("table"), lines(t, ratings.named_values).alias("spoken"),
        F.when(F.contains(t, F.lit("\f")), topics.heads(t)).alias("heads"), F.greatest(F.size(found), F.lit(0)).alias("toc_count"),
    )
    return df.select(key, "file_name", "header_.*", "table", "spoken", "heads", "toc_count")


def final_table(
    docs: DataFrame, label_map: DataFrame, ratings_map: DataFrame, topic_names: list[str], rating_names: list[str], guess=None, split: int = 0, key: str = "doc_id", text: str = "text",
    within: SubtopicColumns | None = None,
) -> DataFrame:
    """serial_no, file_name, 13 header columns, five columns per rating, `split` columns (0: one with the whole text) per topic and for Confidential.

    docs: (key, file_name, text). The names are fixed beforehand, so the columns are known before any data is read. Where a text has
    more pieces than `split`, the last column holds all the rest, so no text is lost. `within` puts columns of sub-topics, JSON
    objects of heading and text, in the place of one topic; a report without the topic, or with several of it, has nulls there.
    """
    found = materialise(extracted(docs, key, text, guess is not None), "extracted")
    names = [*dict.fromkeys([*topic_names, "Confidential"])]
    heads = found.select(key, F.inline("heads"))
    resolved = topics.resolve_topics(heads.select(topics.strip(F.col("heading")).alias("name")), label_map, guess)
    hits = topics.topic_hits(heads, resolved, found.select(key, "toc_count") if guess else None, key)
    last = topics.spans(hits, key).groupBy(key, "topic").agg(F.max_by(F.struct("line_idx", "end_idx"), "line_idx").alias("s"))  # of a topic's several spans the last
    places = last.groupBy(key).agg(F.collect_list(F.struct("topic", "s.line_idx", "s.end_idx")).alias("spans_"))
    table = ratings.map_ratings(found.select(key, F.inline("table")), ratings_map, key)
    spoken = ratings.map_values(found.select(key, F.inline("spoken")), ratings_map, key)
    wide = ratings.rating_columns(found, table, spoken, rating_names, key)
    fixed = [c for c in found.columns if c not in (key, "file_name", "table", "spoken", "heads", "toc_count")]
    small = with_serial(found.select(key, "file_name", *fixed), key).join(wide, key, "left").join(places, key, "left")
    if within:
        small = small.join(_within(docs, hits, within, key, text), key, "left")
    rows = small.join(docs.select(key, F.col(text).alias("text_")), key, "left")  # the one join of texts
    rows = rows.withColumn("cells_", F.when(F.col("spans_").isNotNull(), let(line_array(F.col("text_"), False), lambda ls: _cells(ls, F.col("spans_"), split))))
    out = []
    for n in names:
        cell = f"cells_[{literal(n)}]"
        if within and n == within.topic:
            out += [f"s{i}_ AS `{column(f'{n}_{c}')}`" for i, c in enumerate(within.classes)]
        else:
            out += [f"get({cell}, {i}) AS `{column(n) + (f'_{i + 1}' if split > 1 else '')}`" for i in range(max(split, 1))]
    return rows.selectExpr("serial_no", "file_name", *fixed, *[f"`{c}`" for c in wide.columns if c != key], *out)


def _cells(lines: Column, spans: Column, split: int) -> Column:
    """map(topic, pieces): the whole text, or at most `split` pieces of which the last holds the rest."""
    newline = "\r\n"

    def parts(ls: Column) -> Column:
        if not split:
            return F.array(F.array_join(ls, newline))
        rest = lambda p: F.when(F.size(p) <= split, p).otherwise(F.concat(F.slice(p, 1, split - 1), F.array(F.array_join(F.slice(p, split, F.size(p)), newline))))
        return let(topics.packed(ls, newline), rest)

    cut = lambda s: F.slice(lines, s["line_idx"] + 1, F.greatest(F.coalesce(s["end_idx"], F.size(lines)) - s["line_idx"], F.lit(0)))
    return F.map_from_entries(F.transform(spans, lambda s: F.struct(s["topic"], let(cut(s), parts))))


def _within(docs: DataFrame, hits: DataFrame, within: SubtopicColumns, key: str, text: str) -> DataFrame:
    """(key, s0_, s1_, …): the sub-topics of each class as JSON."""
    parts = subtopics.subtopics(docs, hits, within.topic, key, text, keep_form_feeds=False)
    classes = subtopics.resolve_subtopics(parts.select(F.col("heading").alias("name")), within.label_map, within.guess).select(F.col("name").alias("heading"), "class")
    cells = subtopics.subtopic_cells(parts, classes, key)
    return cells.groupBy(key).agg(*[F.first(F.when(F.col("class") == c, F.col("cell")), True).alias(f"s{i}_") for i, c in enumerate(within.classes)])
