"""Small diagnostics over texts and delimited records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.sources.text import lines


def char_histogram(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, codepoint, n, first_line): how often each character occurs and on which line, from 1, first; line ends count."""
    unified = F.regexp_replace(F.col(text), r"\r\n?", "\n")
    chars = docs.select(key, F.posexplode(F.split(unified, "(?<=\n)")).alias("line_no", "line")).select(key, "line_no", F.explode(F.split("line", "")).alias("c")).where("c <> ''")
    return chars.groupBy(key, F.ascii("c").alias("codepoint")).agg(F.count("*").alias("n"), (F.min("line_no") + 1).alias("first_line"))


def line_lengths(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no from 1, length) with the line end, which an unterminated last line lacks."""
    unified = F.regexp_replace(F.regexp_replace(F.col(text), r"\r\n?", "\n"), r"\n\z", "")
    sized = docs.select(key, F.split(unified, "\n").alias("lines"), F.col(text).rlike(r"[\r\n]\z").alias("closed"), text).withColumn("n", F.size("lines"))
    rows = sized.where(F.col(text) != "").select(key, "n", "closed", F.posexplode("lines").alias("i", "line"))
    return rows.select(key, (F.col("i") + 1).alias("line_no"), (F.length("line") + F.when((F.col("i") + 1 < F.col("n")) | F.col("closed"), 1).otherwise(0)).alias("length"))


def ascii_only(text: Column) -> Column:
    """Every other character becomes a space."""
    return F.regexp_replace(text, r"[^\x00-\x7F]", " ")


def masked(docs: DataFrame, after: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no from 1, line): letters as A and digits as 0 beyond the first lines; the last character of a line stays."""
    rows = lines(docs, key, text)
    hide = lambda c: F.regexp_replace(F.regexp_replace(c, "[a-zA-Z]", "A"), "[0-9]", "0")
    body, last = F.expr("substr(line, 1, greatest(length(line) - 1, 0))"), F.expr("right(line, 1)")
    return rows.select(key, (F.col("line_no") + 1).alias("line_no"), F.when(F.col("line_no") >= after, F.concat(hide(body), last)).otherwise(F.col("line")).alias("line"))


def anagram_groups(words: DataFrame, word: str = "word") -> DataFrame:
    """(anagram, words): words of the same letters, sorted; letters are sorted before they are lowered."""
    k = F.lower(F.array_join(F.array_sort(F.split(F.col(word), "")), ""))
    return words.where(F.col(word) != "").select(k.alias("anagram"), F.col(word).alias("w")).groupBy("anagram").agg(F.array_join(F.array_sort(F.collect_set("w")), " ").alias("words"), F.count("*").alias("n"))


def field_counts(rows: DataFrame, fields: str = "fields") -> DataFrame:
    return rows.withColumn("n_fields", F.size(fields))


def longest_field(rows: DataFrame, fields: str = "fields") -> DataFrame:
    """1-based place of the first longest field and its length; 0 and 0 where all are empty."""
    sizes = F.transform(fields, lambda x: F.coalesce(F.length(x), F.lit(0)))
    most = F.coalesce(F.array_max(sizes), F.lit(0))
    return rows.withColumn("longest", most).withColumn("field_no", F.when(most > 0, F.array_position(sizes, most)).otherwise(0).cast("int"))


def columns_by_number(spec: list[str]) -> list[int]:
    """1-based places of a list of numbers and ranges ("3", "5-7"), sorted, each once; a reversed range is empty."""
    out: set[int] = set()
    for part in spec:
        low, _, high = part.partition("-")
        out.update(range(int(low), int(high or low) + 1))
    return sorted(out)


def project(df: DataFrame, places: list[int]) -> DataFrame:
    """Columns by 1-based place, in the order given; a place may be repeated, 0 is the last column."""
    names = df.columns
    return df.select(*[F.col(f"`{names[p - 1]}`").alias(f"c{i}") for i, p in enumerate(places)])
