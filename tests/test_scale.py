"""What only shows on many rows or long reports, and on odd white space."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from examloom.functions import arrays
from examloom.operators import compliance, header, ratings, rejects, toc, topics
from examloom.plans import final
from examloom.sources.text import with_serial


def test_serials_of_many_rows(spark):
    df = spark.range(1_200_000).select(F.concat(F.lit("r"), F.lpad(F.xxhash64("id").cast("string"), 22, "0"), F.col("id").cast("string")).alias("path"))
    got = with_serial(df.repartition(16)).withColumn("before", F.lag("path").over(Window.orderBy("serial_no")))
    r = got.agg(F.count("*").alias("n"), F.countDistinct("serial_no").alias("d"), F.min("serial_no").alias("low"), F.max("serial_no").alias("high"), F.count_if(F.expr("before > path")).alias("wrong")).first()
    assert (r.n, r.d, r.low, r.high, r.wrong) == (1_200_000, 1_200_000, 1, 1_200_000, 0)


def test_no_break_spaces(spark):
    text = "Table\xa0of\xa0Contents\nCapital Adequacy .... 2\n" + " " * 20 + "Current\xa0Exam    Prior\xa0Exam     Prior\xa0Exam\n     Capital        2               1              3\nUnder Part\xa0309 of the FDIC rules\nExaminer\xa0in\xa0charge: Ann B. Lee"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert toc.toc_entries(df).first().topic == "Capital Adequacy"
    assert ratings.rating_tables(df).first().rating_name == "Capital"
    assert compliance.part_309(df).first().has_part_309
    assert header.header_fields(df).first().examiner_in_charge_last_name == "Lee"


def test_many_numbers_off_a_heading(spark):
    head = "Capital" + "".join(" " * 25 + str(k) for k in range(7))
    df = spark.createDataFrame([(1, f"x\n\x0c{head}\ntext")], "doc_id long, text string")
    assert topics.headings(df).first().heading.strip() == "Capital"


def test_serial_beyond_64_bits(spark):
    df = spark.createDataFrame([(1, "topics", ",", "99999999999999999999,a.txt,T,some text"), (2, "topics", ",", "7,a.txt,T,some text")], "raw_id long, layout string, fd string, line string")
    rows = {r.raw_id: r for r in rejects.typed(rejects.load_records(df), "topics").collect()}
    assert rows[1].serial_no is None and rows[1].serial_digits == "9" * 20 and rows[2].serial_no == 7 and rows[2].serial_digits is None


def test_report_of_many_lines(spark):
    body = "\n".join(f"\x0cCapital Adequacy page {i}" if i % 50 == 0 else f"Region: Part {i}" if i % 20 == 0 else f"line {i}" for i in range(300_000))
    df = spark.createDataFrame([(1, "a.txt", body)], "doc_id long, file_name string, text string")
    heads = topics.headings(df).orderBy("line_idx").collect()
    assert len(heads) == 6000 and heads[-1].line_idx == 299_950
    assert heads[1].char_offset == sum(len(x.replace("\x0c", "")) + 2 for x in body.split("\n")[:50]) + 2
    assert header.header_fields(df).first().region.startswith("Part_")
    labels = spark.createDataFrame([(1, "Capital Adequacy page 50", "Capital Adequacy")], "ord long, text string, topic string")
    names = spark.createDataFrame([("Capital", "Capital")], "name string, canonical string")
    row = final.final_table(df, labels, names, ["Capital Adequacy"], ["Capital"], split=4).first()
    assert row.Capital_Adequacy_1.startswith("Capital Adequacy page 50\r\n") and row.Capital_Adequacy_4.endswith("line 299999")
    whole = "\r\n".join([row.Capital_Adequacy_1, row.Capital_Adequacy_2, row.Capital_Adequacy_3, row.Capital_Adequacy_4])
    assert whole == "\r\n".join(x.replace("\x0c", "") for x in body.split("\n")[50:])


def test_searches(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c", "a"],)], "v array<string>")
    o = F.array_sort("v")
    row = df.select(
        arrays.first_repeat(F.col("v")).alias("again"), arrays.first_where(F.col("v"), lambda x: x == "c").alias("c"), arrays.first_where(F.col("v"), lambda x: x == "z").alias("z"),
        arrays.holds(o, F.lit("b")).alias("has"), arrays.holds(o, F.lit("bb")).alias("not"), arrays.some_begins(o, F.lit("")).alias("empty"),
    ).first()
    assert (row.again, row.c, row.z, row.has, row["not"], row.empty) == (2, 3, None, True, False, True)
