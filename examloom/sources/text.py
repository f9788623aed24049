"""Reports as rows: whole texts, line arrays and line tables; delimited output."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.session import materialise


def read_reports(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", pattern: str | None = None) -> DataFrame:
    """(path, file_name, text) of the files under path; pattern: a regular expression that the file name must hold."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    df = df.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.decode("content", encoding).alias("text"))
    return df.where(F.col("file_name").rlike(pattern)) if pattern else df


def with_serial(df: DataFrame, order: str = "path") -> DataFrame:
    """1-based position in path order, without one window over all rows: counts of ranges are added up first.

    The ranges are written once and read twice, for the counts and for the rows, as bounds sampled anew would give other ranges.
    """
    ranged = df.repartitionByRange(F.col(order)).sortWithinPartitions(order)
    ranged = materialise(ranged.withColumn("part_", F.spark_partition_id()).withColumn("pos_", F.monotonically_increasing_id()), "ranges")
    counts = ranged.groupBy("part_").agg(F.count("*").alias("n"), F.min("pos_").alias("low_")).orderBy("part_").collect()  # one row for each range
    offsets, total = [], 0
    for r in counts:
        offsets.append((r.part_, r.low_, total))
        total += r.n
    start = df.sparkSession.createDataFrame(offsets or [(0, 0, 0)], "part_ int, low_ long, before_ long")
    return ranged.join(F.broadcast(start), "part_").withColumn("serial_no", F.col("pos_") - F.col("low_") + F.col("before_") + 1).drop("part_", "pos_", "low_", "before_")


def line_array(text: Column, keep_form_feeds: bool = True) -> Column:
    """Lines without their ends, as text files are read; null for null, empty for empty."""
    t = F.regexp_replace(text, r"\r\n?", "\n")
    if not keep_form_feeds:
        t = F.replace(t, F.lit("\f"), F.lit(""))
    t = F.regexp_replace(t, r"\n\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(t, "\n"))


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_form_feeds: bool = True) -> DataFrame:
    """(key, line_no from 0, line)."""
    return docs.select(key, F.posexplode(line_array(F.col(text), keep_form_feeds)).alias("line_no", "line"))


def read_delimited(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """Headerless delimited files with quoting and line breaks inside quotes."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.csv(path, schema=schema, sep=sep, quote='"', escape='"', multiLine=True, header=False)


def ragged(texts: DataFrame, key: str = "path", text: str = "text", sep: str = ",") -> DataFrame:
    """(key, row_no from 1, fields): records of any number of fields, with quotes and line breaks inside them; empty lines are none.

    One text is read by one csv reader in an Arrow batch, as records can't be cut apart without reading those before.
    """
    kind = texts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(2**31 - 1)
        for pdf in batches:
            rows = [(k, i, r) for k, t in zip(pdf[key], pdf["t_"]) if t for i, r in enumerate(filter(None, csv.reader(io.StringIO(t, newline=""), delimiter=sep)), 1)]
            yield pd.DataFrame(rows, columns=[key, "row_no", "fields"])

    return texts.select(key, F.col(text).alias("t_")).mapInPandas(run, f"{key} {kind}, row_no int, fields array<string>")


def quoted(value: Column, sep: str) -> Column:
    """Minimal quoting; null is empty."""
    v = F.coalesce(value.cast("string"), F.lit(""))
    special = v.contains('"') | v.contains(sep) | v.contains("\n") | v.contains("\r")
    return F.when(special, F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)


def rendered(df: DataFrame, sep: str = ",", replacement: str | None = None) -> DataFrame:
    """(value): each row as one record. A separator of several characters is joined without quoting; replacement: what stands for it in data."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    if len(sep) == 1:
        cells = [quoted(c, sep) for c in cols]
    else:
        cells = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
        if replacement is not None:
            cells = [F.replace(c, F.lit(sep), F.lit(replacement)) for c in cells]
    return df.select(F.concat_ws(sep, *cells).alias("value"))


def write_delimited(df: DataFrame, path: str, sep: str = ",", replacement: str | None = None, header: bool = False) -> None:
    """Records ended by CR LF; values keep their own line breaks. With a header each file begins with it."""
    body = rendered(df, sep, replacement)
    if header:
        first = sep.join(c if len(sep) > 1 else f'"{c}"' if sep in c or '"' in c else c for c in df.columns)
        body = df.sparkSession.createDataFrame([(first,)], "value string").coalesce(1).unionAll(body)
    body.write.option("lineSep", "\r\n").text(path)


def replicated(docs: DataFrame, times: int, name: str = "file_name", seed: int = 7) -> DataFrame:
    """Each report `times` times, the digits of its name replaced by others that depend on name, copy and seed."""
    copies = docs.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.lit(times)))) if times > 0 else docs.withColumn("copy_no", F.lit(0)).limit(0)
    shift = lambda i: F.pmod(F.xxhash64(F.col(name), "copy_no", i, F.lit(seed)), F.lit(9)) + 1
    chars = F.transform(F.split(name, ""), lambda c, i: F.when(c.rlike("^[0-9]$"), F.pmod(c.cast("int") + shift(i), F.lit(10)).cast("string")).otherwise(c))
    return copies.withColumn(name, F.array_join(chars, ""))
