"""Ratings: the table of a report, ratings in running text, their mapping and their columns. Reports are read without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions.arrays import first_where, tail
from examloom.functions.pyre import let, literal, pyre, single_spaced, strip, title
from examloom.sources.text import line_array

# The head of a table, its lines, and a rating in running text.
_HEAD = pyre(r"(\s+)(current\s+exam)([\s.]+)(prior\s+exam)([\s.]+)(prior\s+exam)\s*$", True)
_TABLE = pyre(r"(?:\s{5,}.*|.\s{5,}.*|\s*)$")
_VALUE = pyre(r"(.*?\S)(?:\s{1,10}|\s{0,10}[\-:]\s{0,10})([0-9A-Z])\s*$", True)
PERIODS = ["current", "prior", "prior_prior"]


def rating_code(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), "[^0-9a-zA-Z]", "")


def rating_name(c: Column) -> Column:
    n = strip(c)
    stray = pyre(r"[^\s]\s{3,}(.*)$")
    n = F.when(n.rlike(stray), F.regexp_extract(n, stray, 1)).otherwise(n)
    return strip(single_spaced(F.regexp_replace(F.regexp_replace(n, r"[0-9'\-*,]", ""), r"\(.*\)", "")))


def _first_table(lines: Column) -> Column:
    """struct(no, line, rows): place and wording of the first head, and the lines of its table."""

    def cut(at: Column) -> Column:
        rest = tail(lines, at + 1)
        return F.when(at.isNotNull(), let(rest, lambda r: F.struct(at.alias("no"), F.get(lines, at).alias("line"), F.slice(r, 1, F.coalesce(first_where(r, lambda x: ~x.rlike(_TABLE)), F.size(r))).alias("rows"))))

    return let(first_where(lines, lambda x: x.rlike(_HEAD)), cut)


def table_rows(lines: Column) -> Column:
    """array of struct(line_no, rating_name, current, prior, prior_prior) of the first table, cut by the places of its heads."""

    def cut(t: Column) -> Column:
        size = lambda k: F.length(F.regexp_extract(t["line"], _HEAD, k))
        sizes = F.struct(size(1).alias("a"), size(2).alias("n"), (size(1) + size(2) + size(3)).alias("b"), size(4).alias("m"), (size(1) + size(2) + size(3) + size(4) + size(5)).alias("c"))

        def rows(w: Column) -> Column:
            part = lambda x, low, n: strip(F.upper(F.substring(x, low + 1, n)))
            values = lambda x: F.array(part(x, w["a"], w["n"]), part(x, w["b"], w["m"]), part(x, w["c"], F.greatest(F.length(x) - w["c"], F.lit(0))))
            read = F.transform(t["rows"], lambda x, i: F.struct((t["no"] + 1 + i).alias("line_no"), F.substring(x, F.lit(1), w["a"]).alias("name"), values(x).alias("v")))
            some = F.filter(read, lambda r: F.array_join(r["v"], "") != "")
            return F.transform(some, lambda r: F.struct(r["line_no"].alias("line_no"), rating_name(r["name"]).alias("rating_name"), *[rating_code(r["v"][k]).alias(p) for k, p in enumerate(PERIODS)]))

        return F.when(t.isNotNull(), let(sizes, rows))

    return let(_first_table(lines), cut)


def has_table(text: Column) -> Column:
    """What every document with a table holds."""
    return text.rlike(pyre(r"current\s+exam[\s.]+prior\s+exam", True, match=False))


def rating_tables(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no, rating_name, current, prior, prior_prior) of the first table of each document."""
    return docs.where(has_table(F.col(text))).select(key, F.inline(let(line_array(F.col(text)), table_rows)))


def table_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no, line): the raw lines of the first table, from its head to the first line beyond it."""

    def cut(lines: Column) -> Column:
        whole = lambda t: F.slice(lines, t["no"] + 1, F.size(t["rows"]) + 2)
        return let(_first_table(lines), lambda t: F.when(t.isNotNull(), F.transform(whole(t), lambda x, i: F.struct((t["no"] + i).alias("line_no"), x.alias("line")))))

    return docs.where(has_table(F.col(text))).select(key, F.inline(let(line_array(F.col(text)), cut)))


def map_ratings(table: DataFrame, ratings_map: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows under their canonical names, the last line of each; "NA" and unmapped names are dropped. ratings_map: (name, canonical)."""
    named = table.withColumn("t_", title(F.col("rating_name"))).join(ratings_map.select(F.col("name").alias("t_"), "canonical"), "t_").where("canonical <> 'NA'")
    return named.groupBy(key, "canonical").agg(F.max_by(F.struct(*PERIODS), "line_no").alias("v")).select(key, "canonical", "v.*")


def unmapped_ratings(table: DataFrame, ratings_map: DataFrame) -> DataFrame:
    return table.select(title(F.col("rating_name")).alias("name")).distinct().join(ratings_map, "name", "left_anti")


def named_values(lines: Column) -> Column:
    """array of struct(line_no, name in lower case, value): lines that end in one letter or digit."""
    found = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(_VALUE))
    return F.transform(found, lambda s: F.struct(s["i"].alias("line_no"), F.lower(F.regexp_extract(s["x"], _VALUE, 1)).alias("name"), F.regexp_extract(s["x"], _VALUE, 2).alias("value")))


def map_values(values: DataFrame, ratings_map: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, canonical, value) from (key, line_no, name, value): of several lines the last counts; names that only case tells apart count for none."""
    names = ratings_map.where("canonical <> 'NA'").groupBy(F.lower("name").alias("name")).agg(F.min("canonical").alias("canonical"), F.countDistinct("name").alias("k")).where("k = 1")
    return values.join(names, "name").groupBy(key, "canonical").agg(F.max_by("value", "line_no").alias("value"))


def text_ratings(docs: DataFrame, ratings_map: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, canonical, value): lines of a rating name and one letter or digit.

    The name is cut off the line by the separator and joined by equality, so nothing is compared to every name.
    """
    return map_values(docs.select(key, F.inline(let(line_array(F.col(text)), named_values))), ratings_map, key)


def rating_columns(docs: DataFrame, mapped: DataFrame, in_text: DataFrame, names: list[str], key: str = "doc_id") -> DataFrame:
    """Five columns per name: combined, from text, from table current, prior, prior prior."""
    both = mapped.join(in_text.withColumnRenamed("value", "text_value"), [key, "canonical"], "full")
    both = both.withColumn("combined", F.coalesce(F.nullif("text_value", F.lit("")), F.col("current")))
    cols = {"current": "combined", "from_headers_current": "text_value", "from_table_current": "current", "prior": "prior", "prior_prior": "prior_prior"}
    by_name = both.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("canonical", F.struct(*cols.values())))).alias("m_"))
    return docs.select(key).join(by_name, key, "left").selectExpr(f"`{key}`", *[f"coalesce(m_[{literal(n)}].{c}, '') AS `{f'{n} {p}'.replace(' ', '_')}`" for n in names for p, c in cols.items()])


def component_ratings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, component, roca): the last line with exactly six, or four, values after the words; empty arrays without one."""

    def last(lines: Column, word: str, n: int) -> Column:
        pattern = F.lit(pyre(rf"(?:^|\W){word}\W+([^ ]*)", True, match=False))
        found = F.transform(lines, lambda x: F.flatten(F.transform(F.regexp_extract_all(x, pattern, F.lit(1)), lambda v: F.split(v, "-"))))
        return F.coalesce(F.try_element_at(F.filter(found, lambda v: F.size(v) == n), F.lit(-1)), F.array().cast("array<string>"))

    near = F.filter(line_array(F.coalesce(F.col(text), F.lit(""))), lambda x: x.rlike("(?i)component ratings|roca rating"))
    found = let(near, lambda ls: F.struct(last(ls, "component ratings", 6).alias("component"), last(ls, "roca rating", 4).alias("roca")))
    return docs.select(key, found.alias("f")).select(key, "f.*")


def rated_documents(components: DataFrame) -> DataFrame:
    """(n): documents with a component or ROCA rating."""
    return components.agg(F.count_if((F.size("component") > 0) | (F.size("roca") > 0)).alias("n"))


def improvement(docs: DataFrame, mapped: DataFrame, in_text: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, change): +1 for each rating that the text gives and the table lacks or differs in, -1 for the reverse lack."""
    both = mapped.select(key, "canonical", "current").join(in_text, [key, "canonical"], "full")
    t, h = F.coalesce("current", F.lit("")), F.coalesce("value", F.lit(""))
    step = F.when((h != "") & (h != t), 1).when((h == "") & (t != ""), -1).otherwise(0)
    return docs.select(key).join(both.groupBy(key).agg(F.sum(step).alias("n")), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("change"))


def rating_names(table: DataFrame) -> DataFrame:
    return table.select(title(F.col("rating_name")).alias("rating_name")).distinct()


