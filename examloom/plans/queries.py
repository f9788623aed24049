"""Registry of the core queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.functions.dates import date_text, parse_date
from examloom.functions.names import parse_name
from examloom.operators import compliance, diagnostics, header, mapper, ratings, rejects, subtopics, toc, topics
from examloom.plans import final, twins
from examloom.session import spread, table
from examloom.sources import text as sources

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "file_name", "text"))


def _label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "canon_names").where("field = 'topic'").selectExpr("canon_id AS ord", "canonical_name AS text", "canonical_name AS topic")


def _ratings_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "canon_names").where("field = 'rating_name'").selectExpr("canonical_name AS name", "canonical_name AS canonical")


def _names(df: DataFrame, column: str) -> list[str]:
    return sorted(r[0] for r in df.select(column).distinct().collect())


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return final.topic_hits(_docs(spark, sf_dir), _label_map(spark, sf_dir))


_LINES = twins.LINES


@query(f"""WITH {_LINES} SELECT doc_id, no::INT AS line_no, (length(line) + CASE WHEN no < n OR closed THEN 1 ELSE 0 END)::INT AS length FROM lines""")
def line_lengths(spark, sf_dir):
    return diagnostics.line_lengths(_docs(spark, sf_dir))


@query(f"""WITH {_LINES}, chars AS (SELECT doc_id, no, unnest(string_split(line || CASE WHEN no < n OR closed THEN chr(10) ELSE '' END, '')) AS c FROM lines)
    SELECT doc_id, unicode(c)::INT AS codepoint, count(*) AS n, min(no)::INT AS first_line FROM chars WHERE c <> '' GROUP BY ALL""")
def char_histogram(spark, sf_dir):
    return diagnostics.char_histogram(_docs(spark, sf_dir))


@query("SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', ' ', 'g') AS text FROM documents")
def ascii_texts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", diagnostics.ascii_only(F.col("text")).alias("text"))


@query(f"""WITH {_LINES} SELECT doc_id, no::INT AS line_no, CASE WHEN no > 5 AND length(line) > 0 THEN regexp_replace(regexp_replace(left(line, length(line) - 1), '[a-zA-Z]', 'A', 'g'), '[0-9]', '0', 'g') || right(line, 1) ELSE line END AS line
    FROM lines UNION ALL SELECT doc_id, 1, '' FROM documents WHERE false""")
def masked_lines(spark, sf_dir):
    return diagnostics.masked(_docs(spark, sf_dir))


@query("""SELECT lower(array_to_string(list_sort(string_split(word, '')), '')) AS anagram, array_to_string(list_sort(list_distinct(list(word))), ' ') AS words, count(*) AS n
    FROM common_words WHERE word <> '' GROUP BY 1""")
def anagram_groups(spark, sf_dir):
    return diagnostics.anagram_groups(table(spark, sf_dir, "common_words"))


@query("""WITH f AS (SELECT raw_id, list_transform(string_split(line, fd), lambda x: length(x)) AS s FROM raw_records)
    SELECT raw_id, len(s)::INT AS n_fields, list_max(s)::INT AS longest, (CASE WHEN list_max(s) > 0 THEN list_position(s, list_max(s)) ELSE 0 END)::INT AS field_no FROM f""")
def record_fields(spark, sf_dir):
    """Fields of the raw lines by plain splitting: their number, the longest and its place."""
    rows = table(spark, sf_dir, "raw_records").select("raw_id", F.expr("split(line, concat('\\\\Q', fd, '\\\\E'))").alias("fields"))
    return diagnostics.longest_field(diagnostics.field_counts(rows)).select("raw_id", "n_fields", "longest", "field_no")


@query("SELECT serial_no AS c0, region AS c1, file_name AS c2, file_name AS c3 FROM get_headers_v1")
def projected_columns(spark, sf_dir):
    return diagnostics.project(table(spark, sf_dir, "get_headers_v1"), [1, 3, 2, 2])


@query("SELECT file_name, count(topic)::BIGINT AS toc_count FROM extract_toc GROUP BY file_name")
def toc_counts_by_file(spark, sf_dir):
    return table(spark, sf_dir, "extract_toc").groupBy("file_name").agg(F.count("topic").alias("toc_count"))


@query("SELECT DISTINCT topic_formatted, flag FROM extract_toc")
def toc_distinct_entered(spark, sf_dir):
    return table(spark, sf_dir, "extract_toc").select("topic_formatted", "flag").distinct()


_ENTRY = r"'^\s{0,30}([A-Z].*?)([\s._\-/:]+[l0-9IVX]*)?\s*$'"
_TOC = f"""{_LINES}, l0 AS (SELECT doc_id, no - 1 AS line_no, line FROM lines),
    started AS (SELECT *, min(CASE WHEN regexp_matches(line, '(?i)^[0-9\\s]*(table\\s+of\\s+contents)(\\s+\\S+)?\\s*$') THEN line_no END) OVER (PARTITION BY doc_id) AS start FROM l0),
    kinds AS (SELECT *, regexp_matches(line, '(?i)^(\\s*|\\s*page\\s*|\\s*c\\s*|\\s*li\\s*)$') AS blank,
        regexp_matches(line, '(?i)^(abbreviations:\\s*|note:\\s*|.*dollar.*|.*in thousands.*|\\x0Cexamination conclusions? and comments?.*|.*amounts in tables are shown.*)$') OR regexp_matches(line, '^\\s*FFI.*$') AS closing
        FROM started WHERE line_no > start),
    named AS (SELECT *, NOT blank AND closing AS "end", CASE WHEN blank OR closing THEN '' ELSE regexp_replace(trim(regexp_extract(line, {_ENTRY}, 1), ' ' || chr(9) || chr(12)), '\\s+''\\s+', '''', 'g') END AS topic FROM kinds),
    words AS (SELECT *, list_filter(string_split_regex(topic, '\\s+'), lambda x: true) AS w FROM named),
    kept AS (SELECT *, w[1:coalesce(list_max(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN regexp_full_match(w[i], '\\.*') THEN 0 ELSE i END)), 0)] AS k FROM words),
    judged AS (SELECT *, NOT (len(list_filter(k, lambda x: x LIKE '%.' OR regexp_matches(x, '[0-9]'))) > 0 OR coalesce(k[1] = lower(k[1]) AND k[1] <> upper(k[1]), false) OR coalesce(lower(k[len(k)]) = 'of', false)) AS sure FROM kept),
    seen AS (SELECT *, topic <> '' AND row_number() OVER (PARTITION BY doc_id, topic ORDER BY line_no) > 1 AS again, sum(CASE WHEN topic <> '' AND NOT sure THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS doubts FROM judged),
    ends AS (SELECT *, coalesce(min(CASE WHEN "end" OR again THEN line_no END) OVER (PARTITION BY doc_id), 2147483647) AS stop, coalesce(min(CASE WHEN topic <> '' AND doubts >= 5 THEN line_no END) OVER (PARTITION BY doc_id), 2147483647) AS fifth FROM seen),
    entries AS (SELECT doc_id, line_no::INT AS line_no, topic, trim(array_to_string(k, ' ')) AS topic_formatted, sure FROM ends WHERE topic <> '' AND line_no < stop AND line_no <= fifth)"""


@query(f"WITH {_TOC} SELECT doc_id, line_no, topic, topic_formatted, CASE WHEN sure THEN 'OK' ELSE 'Unsure' END AS flag FROM entries")
def toc_detail(spark, sf_dir):
    return toc.toc_detail(toc.toc_entries(_docs(spark, sf_dir)))


@query(f"WITH {_TOC} SELECT d.doc_id, count(e.doc_id)::BIGINT AS toc_count FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN entries e USING (doc_id) GROUP BY 1")
def toc_summary(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return toc.toc_summary(docs, toc.toc_entries(docs))


@query(f"WITH {_TOC} SELECT DISTINCT topic_formatted, CASE WHEN sure THEN 'OK' ELSE 'Unsure' END AS flag FROM entries")
def toc_distinct(spark, sf_dir):
    return toc.toc_distinct(toc.toc_entries(_docs(spark, sf_dir)))


@query(f"WITH {_TOC} SELECT doc_id, line_no, topic, topic_formatted, CASE WHEN sure THEN 'OK' ELSE 'Unsure' END AS flag FROM entries")
def toc_plain(spark, sf_dir):
    """Entries up to the fifth doubtful one, without the search for repetitions."""
    return toc.toc_detail(toc.toc_entries(_docs(spark, sf_dir), extended=False))


@query(twins.ANALYSIS)
def entry_analysis(spark, sf_dir):
    return table(spark, sf_dir, "extract_toc").select("toc_id", toc.analyze(F.col("topic")).alias("a")).select("toc_id", "a.*")


_HEADS = f"""{_LINES}, offs AS (SELECT doc_id, no - 1 AS line_idx, line, coalesce(sum(length(replace(line, chr(12), '')) + 2) OVER (PARTITION BY doc_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 2 AS char_offset FROM lines),
    heads AS (SELECT doc_id, line_idx::INT AS line_idx, substr(line, 2) AS head, char_offset::BIGINT AS char_offset FROM offs WHERE line LIKE chr(12) || '%' AND length(line) > 1),
    good AS (SELECT *, CASE WHEN regexp_matches(trim(head), '^\\s*(.*)\\s{{20,}}[\\-/a-zA-Z0-9\\s]*$') THEN regexp_extract(trim(head), '^\\s*(.*)\\s{{20,}}[\\-/a-zA-Z0-9\\s]*$', 1) ELSE head END AS heading FROM heads
        WHERE NOT regexp_matches(head, '(?i)^(.*\\(\\s*continued\\s*\\).*|(^|\\s+)table\\s*of\\s*contents(\\s+|$).*|\\s*$)'))"""


@query(f"WITH {_HEADS} SELECT doc_id, line_idx, heading, char_offset FROM good WHERE heading <> ''")
def headings(spark, sf_dir):
    return topics.headings(_docs(spark, sf_dir))


_HITS = f"""{_HEADS}, map AS (SELECT canonical_name AS topic FROM canon_names WHERE field = 'topic'),
    named AS (SELECT g.*, coalesce(e.topic, CASE WHEN trim(heading) = upper(trim(heading)) AND trim(heading) <> lower(trim(heading)) THEN u.topic END, CASE WHEN regexp_matches(trim(heading), '(?i)^\\s*confidential(\\s*|\\s+.*)$') THEN 'Confidential' END) AS topic,
        CASE WHEN e.topic IS NULL AND NOT (trim(heading) = upper(trim(heading)) AND u.topic IS NOT NULL) THEN 'predefined' ELSE 'actual' END AS kind
        FROM good g LEFT JOIN map e ON trim(heading) = e.topic LEFT JOIN map u ON upper(u.topic) = trim(heading) WHERE heading <> ''),
    hits AS (SELECT * FROM (SELECT *, lag(topic) OVER (PARTITION BY doc_id ORDER BY line_idx) AS before FROM named WHERE topic IS NOT NULL) WHERE before IS NULL OR before <> topic)"""


@query(f"WITH {_HITS} SELECT doc_id, line_idx, heading, topic, kind, char_offset FROM hits")
def topic_hits(spark, sf_dir):
    return _hits(spark, sf_dir)


@query(f"WITH {_HITS} SELECT doc_id, line_idx, topic, lead(line_idx) OVER (PARTITION BY doc_id ORDER BY line_idx) AS end_idx FROM hits")
def topic_spans(spark, sf_dir):
    return topics.spans(_hits(spark, sf_dir)).select("doc_id", "line_idx", "topic", "end_idx")


@query(f"""WITH {_HITS}, spans AS (SELECT *, lead(line_idx) OVER (PARTITION BY doc_id ORDER BY line_idx) AS end_idx FROM hits),
    latest AS (SELECT doc_id, topic, max(line_idx) AS line_idx, arg_max(coalesce(end_idx, 2147483647), line_idx) AS end_idx FROM spans GROUP BY 1, 2)
    SELECT l.doc_id, l.topic, replace(array_to_string(a.ls[l.line_idx + 1:l.end_idx], chr(13) || chr(10)), chr(12), '') AS topic_text FROM latest l JOIN arrays a USING (doc_id)""")
def topic_texts(spark, sf_dir):
    return topics.topic_texts(_docs(spark, sf_dir), _hits(spark, sf_dir)).select("doc_id", "topic", "topic_text")


_TEXTS = f"""{_HITS}, spans AS (SELECT *, lead(line_idx) OVER (PARTITION BY doc_id ORDER BY line_idx) AS end_idx FROM hits),
    latest AS (SELECT doc_id, topic, max(line_idx) AS line_idx, arg_max(coalesce(end_idx, 2147483647), line_idx) AS end_idx FROM spans GROUP BY 1, 2),
    found AS (SELECT l.doc_id, l.topic, replace(array_to_string(a.ls[l.line_idx + 1:l.end_idx], chr(13) || chr(10)), chr(12), '') AS topic_text FROM latest l JOIN arrays a USING (doc_id))"""


@query(f"WITH RECURSIVE {_TEXTS}, {twins.PACKED}")
def topic_cells(spark, sf_dir):
    """Topic texts in cells of at most 32,000 characters."""
    return topics.split_cells(topics.topic_texts(_docs(spark, sf_dir), _hits(spark, sf_dir)))


@query("""WITH n AS (SELECT DISTINCT topic AS name FROM extract_toc WHERE topic IS NOT NULL), m AS (SELECT canonical_name AS t FROM canon_names WHERE field = 'topic')
    SELECT name, CASE WHEN name = '' THEN NULL ELSE coalesce(e.t, CASE WHEN name = upper(name) AND name <> lower(name) THEN u.t END, CASE WHEN regexp_matches(name, '(?i)^\\s*confidential(\\s*|\\s+.*)$') THEN 'Confidential' END) END AS topic
    FROM n LEFT JOIN m e ON name = e.t LEFT JOIN m u ON upper(u.t) = name""")
def topic_lookup(spark, sf_dir):
    names = table(spark, sf_dir, "extract_toc").selectExpr("topic AS name")
    return topics.resolve_topics(names, _label_map(spark, sf_dir)).select("name", "topic")


@query("""SELECT r.rating_id, c.canonical_name AS canonical FROM get_ratings r JOIN canon_names c ON c.field = 'rating_name' AND lower(c.canonical_name) = lower(r.rating_name)""")
def rating_lookup(spark, sf_dir):
    names = _ratings_map(spark, sf_dir).select(F.lower("name").alias("n"), "canonical")
    return table(spark, sf_dir, "get_ratings").select("rating_id", F.lower("rating_name").alias("n")).join(names, "n").select("rating_id", "canonical")


@query("""SELECT serial_no, CASE WHEN d IS NULL THEN '' ELSE month(d) || '/' || day(d) || '/' || year(d) END AS start_date, year(d)::INT AS y, month(d)::INT AS m
    FROM (SELECT serial_no, try_strptime(exam_start_date, '%m/%d/%Y')::DATE AS d FROM get_headers_v1)""")
def exam_dates(spark, sf_dir):
    d = parse_date(F.col("exam_start_date"))
    return table(spark, sf_dir, "get_headers_v1").select("serial_no", date_text(d).alias("start_date"), F.year(d).alias("y"), F.month(d).alias("m"))


@query(f"WITH {twins.name_of('get_headers_v1', 'examiner_in_charge')} SELECT serial_no, first_ AS first, middle_ AS middle, last_ AS last, suffix FROM person")
def examiner_names(spark, sf_dir):
    return table(spark, sf_dir, "get_headers_v1").select("serial_no", parse_name(F.col("examiner_in_charge")).alias("n")).select("serial_no", "n.*")


@query(f"WITH {twins.header()} SELECT * FROM header")
def header_fields(spark, sf_dir):
    return header.header_fields(_docs(spark, sf_dir))


@query(f"WITH {twins.BLOCK} SELECT * FROM block")
def region_blocks(spark, sf_dir):
    return header.region_block(_docs(spark, sf_dir))


_WS = r"[\s.]+"
_TABLE = f"""{_LINES}, l0 AS (SELECT doc_id, no - 1 AS line_no, line FROM lines), hd AS (SELECT *, regexp_matches(line, '(?i)^\\s+current\\s+exam{_WS}prior\\s+exam{_WS}prior\\s+exam\\s*$') AS is_head FROM l0),
    st AS (SELECT *, min(CASE WHEN is_head THEN line_no END) OVER (PARTITION BY doc_id) AS head_no FROM hd),
    he AS (SELECT *, max(CASE WHEN line_no = head_no THEN line END) OVER (PARTITION BY doc_id) AS head FROM st WHERE line_no >= head_no),
    en AS (SELECT *, min(CASE WHEN line_no > head_no AND NOT regexp_matches(line, '^(\\s{{5,}}.*|.\\s{{5,}}.*|\\s*)$') THEN line_no END) OVER (PARTITION BY doc_id) AS end_no FROM he),
    gr AS (SELECT *, length(regexp_extract(head, '(?i)^(\\s+)', 1)) AS a, length(regexp_extract(head, '(?i)^(\\s+current\\s+exam)', 1)) AS a2, length(regexp_extract(head, '(?i)^(\\s+current\\s+exam{_WS})', 1)) AS b,
        length(regexp_extract(head, '(?i)^(\\s+current\\s+exam{_WS}prior\\s+exam)', 1)) AS b2, length(regexp_extract(head, '(?i)^(\\s+current\\s+exam{_WS}prior\\s+exam{_WS})', 1)) AS c FROM en WHERE line_no > head_no AND (end_no IS NULL OR line_no < end_no)),
    va AS (SELECT doc_id, line_no, substr(line, 1, a) AS nm, trim(upper(substr(line, a + 1, a2 - a))) AS v1, trim(upper(substr(line, b + 1, b2 - b))) AS v2, trim(upper(substr(line, c + 1))) AS v3 FROM gr),
    nm AS (SELECT *, CASE WHEN regexp_matches(trim(nm), '^[^\\s]\\s{{3,}}(.*)$') THEN regexp_extract(trim(nm), '^[^\\s]\\s{{3,}}(.*)$', 1) ELSE trim(nm) END AS n1 FROM va WHERE v1 || v2 || v3 <> ''),
    tab AS (SELECT doc_id, line_no::INT AS line_no, trim(regexp_replace(regexp_replace(regexp_replace(n1, '[0-9''\\-*,]', '', 'g'), '\\(.*\\)', '', 'g'), '\\s+', ' ', 'g')) AS rating_name,
        regexp_replace(v1, '[^0-9a-zA-Z]', '', 'g') AS current, regexp_replace(v2, '[^0-9a-zA-Z]', '', 'g') AS prior, regexp_replace(v3, '[^0-9a-zA-Z]', '', 'g') AS prior_prior FROM nm)"""


@query(f"WITH {_TABLE} SELECT * FROM tab")
def rating_tables(spark, sf_dir):
    return ratings.rating_tables(_docs(spark, sf_dir))


@query(f"""WITH {_TABLE}, m AS (SELECT t.*, c.canonical_name AS canonical FROM tab t JOIN canon_names c ON c.field = 'rating_name' AND c.canonical_name = t.rating_name)
    SELECT doc_id, canonical, arg_max(current, line_no) AS current, arg_max(prior, line_no) AS prior, arg_max(prior_prior, line_no) AS prior_prior FROM m GROUP BY 1, 2""")
def mapped_ratings(spark, sf_dir):
    """Names as they stand in the tables are in title case but for the small words, so the map is keyed the same way."""
    named = _ratings_map(spark, sf_dir).select(ratings.title(F.col("name")).alias("name"), "canonical")
    return ratings.map_ratings(ratings.rating_tables(_docs(spark, sf_dir)), named)


@query(f"WITH {_TABLE} SELECT DISTINCT {twins.title('rating_name')} AS rating_name FROM tab")
def rating_names(spark, sf_dir):
    return ratings.rating_names(ratings.rating_tables(_docs(spark, sf_dir)))


@query(f"""WITH {_LINES}, l0 AS (SELECT doc_id, no, lower(regexp_extract(line, '(?i)^(.*?\\S)(?:\\s{{1,10}}|\\s{{0,10}}[\\-:]\\s{{0,10}})([0-9A-Z])\\s*$', 1)) AS n, regexp_extract(line, '(?i)^(.*?\\S)(?:\\s{{1,10}}|\\s{{0,10}}[\\-:]\\s{{0,10}})([0-9A-Z])\\s*$', 2) AS v FROM lines)
    SELECT doc_id, c.canonical_name AS canonical, arg_max(v, no) AS value FROM l0 JOIN canon_names c ON c.field = 'rating_name' AND lower(c.canonical_name) = l0.n GROUP BY 1, 2""")
def text_ratings(spark, sf_dir):
    return ratings.text_ratings(_docs(spark, sf_dir), _ratings_map(spark, sf_dir))


_MAPPED = f"{_TABLE}, {twins.MAPPED}"
_RATED = f"{_MAPPED}, {twins.RATED}"


def _long(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, column, value): one row for each cell of a wide table, so that SQL needn't know its columns."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns if c not in keys])
    return df.select(*keys, F.inline(cells))


@query(f"WITH {_RATED} {twins.RATED_CELLS}")
def rating_columns(spark, sf_dir):
    """The five columns of each rating, cell by cell."""
    docs, names = _docs(spark, sf_dir), _ratings_map(spark, sf_dir)
    mapped = ratings.map_ratings(ratings.rating_tables(docs), names.select(ratings.title(F.col("name")).alias("name"), "canonical"))
    return _long(ratings.rating_columns(docs, mapped, ratings.text_ratings(docs, names), _names(names, "canonical")), ["doc_id"])


@query(f"WITH {_MAPPED}, {twins.IMPROVED}")
def rating_improvement(spark, sf_dir):
    docs, names = _docs(spark, sf_dir), _ratings_map(spark, sf_dir)
    mapped = ratings.map_ratings(ratings.rating_tables(docs), names.select(ratings.title(F.col("name")).alias("name"), "canonical"))
    return ratings.improvement(docs, mapped, ratings.text_ratings(docs, names))


def _spoken_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small report for each row of a rating table, with the rating in running text."""
    return table(spark, sf_dir, "get_ratings").selectExpr("rating_id AS doc_id", "concat('Ratings\\n', rating_name, ' - ', current_rating, '\\nComponent Ratings: ', current_rating, '-', prior_rating, '-1-2-3-4\\nend') AS text")


@query(twins.SPOKEN_ROWS)
def spoken_ratings(spark, sf_dir):
    return ratings.text_ratings(_spoken_docs(spark, sf_dir), _ratings_map(spark, sf_dir))


@query(twins.COMPONENTS)
def component_ratings(spark, sf_dir):
    found = ratings.component_ratings(_spoken_docs(spark, sf_dir))
    return found.select("doc_id", F.array_join("component", "-").alias("component"), F.array_join("roca", "-").alias("roca"))


@query(f"SELECT count(*) AS n FROM ({twins.COMPONENTS}) WHERE component <> ''")
def rated_documents(spark, sf_dir):
    return ratings.rated_documents(ratings.component_ratings(_spoken_docs(spark, sf_dir)))


@query("""SELECT doc_id, coalesce(regexp_matches(upper(text), 'PART\\s+309\\s+OF\\s+(THE\\s+)?(FDIC|FEDERAL\\s+DEPOSIT\\s+INSURANCE\\s+CORPORATION)'), false) AS has_part_309 FROM documents""")
def part_309(spark, sf_dir):
    return compliance.part_309(_docs(spark, sf_dir)).select("doc_id", "has_part_309")


@query("""SELECT doc_id FROM documents WHERE NOT coalesce(regexp_matches(upper(text), 'PART\\s+309\\s+OF\\s+(THE\\s+)?(FDIC|FEDERAL\\s+DEPOSIT\\s+INSURANCE\\s+CORPORATION)'), false)""")
def without_part_309(spark, sf_dir):
    return compliance.without_part_309(_docs(spark, sf_dir))


@query()
def subtopic_texts(spark, sf_dir):
    """Sub-topics of the first section of findings."""
    return subtopics.subtopics(_docs(spark, sf_dir), _hits(spark, sf_dir), "Summary of Examination Findings")


@query()
def subtopic_summary(spark, sf_dir):
    return subtopics.subtopic_summary(subtopic_texts(spark, sf_dir)).select("normalized", F.array_join("headings", "|").alias("headings"))


@query("""SELECT DISTINCT topic, array_to_string(list_filter(list_transform(list_filter(string_split_regex(topic, '\\s+|\\s*[()./\\-,]\\s*'), lambda w: w <> '' AND NOT regexp_full_match(w, '[0-9]+') AND NOT (w = lower(w) AND w <> upper(w))),
    lambda w: regexp_replace(lower(w), '[^a-z0]', '', 'g')), lambda w: w <> ''), ' ') AS normalized FROM extract_toc""")
def normal_forms(spark, sf_dir):
    return table(spark, sf_dir, "extract_toc").select("topic").distinct().select("topic", subtopics.normal_form(F.col("topic")).alias("normalized"))


def _curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map that classifiers learn from: entries equal to a canonical topic but for case and spaces."""
    names = _label_map(spark, sf_dir).select(F.lower("topic").alias("k"), "topic")
    entries = table(spark, sf_dir, "extract_toc").select(F.col("topic").alias("text")).where("text IS NOT NULL").distinct()
    rows = entries.withColumn("k", F.lower(F.trim(F.regexp_replace("text", r"[\s_]+", " ")))).join(names, "k")
    return rows.select(F.xxhash64("text").alias("ord"), "text", "topic")


@query()
def guessed_topics(spark, sf_dir):
    """Topics of all distinct entries: looked up, or guessed by logistic regression."""
    curated = _curated(spark, sf_dir)
    names = table(spark, sf_dir, "extract_toc").selectExpr("topic AS name")
    return topics.resolve_topics(names, curated, mapper.train(curated, "lr").guess).select("name", "topic", "kind")


@query()
def new_topics_forest(spark, sf_dir):
    """What a random forest guesses for the entries outside the map, with the number of each kind."""
    curated = _curated(spark, sf_dir)
    names = table(spark, sf_dir, "extract_toc").selectExpr("topic AS name")
    out = topics.resolve_topics(names, curated, mapper.train(curated, "rf").guess)
    return out.groupBy("kind", "topic").agg(F.count("*").alias("n"))


@query()
def training_mismatches(spark, sf_dir):
    return mapper.training_mismatches(mapper.train(_curated(spark, sf_dir)))


@query()
def outstanding_topics(spark, sf_dir):
    """Guesses far above the mean of all classes, for the distinct entries."""
    return mapper.train(_curated(spark, sf_dir)).outstanding(table(spark, sf_dir, "extract_toc").selectExpr("topic AS name"))


@query("""SELECT doc_id, CASE WHEN trim(coalesce(text, ''), ' ') = '' THEN 'no text' ELSE 'no required wording' END AS reason FROM documents
    WHERE NOT coalesce(regexp_matches(upper(text), 'PART\\s+309\\s+OF\\s+(THE\\s+)?(FDIC|FEDERAL\\s+DEPOSIT\\s+INSURANCE\\s+CORPORATION)'), false)""")
def exceptions(spark, sf_dir):
    return compliance.exceptions(_docs(spark, sf_dir))


def _sectioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report for each topic cell, with the topic's name as a heading inside one section."""
    cells = table(spark, sf_dir, "get_headers").where("topic_text <> ''")
    return cells.selectExpr("topic_id AS doc_id", "file_name", "concat(char(12), 'Summary of Examination Findings\\n', topic, '\\n', topic_text) AS text")


@query()
def subtopic_headings(spark, sf_dir):
    """Sub-topics found in sections that hold some, by normal form."""
    docs = _sectioned(spark, sf_dir)
    found = subtopics.subtopics(docs, final.topic_hits(docs, _label_map(spark, sf_dir)), "Summary of Examination Findings")
    return subtopics.subtopic_summary(found).select("normalized", F.array_join("headings", "|").alias("headings"))


def _subtopic_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_map(spark, sf_dir).select("ord", subtopics.normal_form(F.col("text")).alias("text"), "topic")


@query()
def new_subtopics(spark, sf_dir):
    """Headings that only the classifier gives a class, over character n-grams of their normal forms."""
    docs, known = _sectioned(spark, sf_dir), _subtopic_map(spark, sf_dir)
    found = subtopics.subtopics(docs, final.topic_hits(docs, _label_map(spark, sf_dir)), "Summary of Examination Findings")
    out = subtopics.resolve_subtopics(found.where(F.col("heading") != subtopics.START).select(F.col("heading").alias("name")), known, mapper.train(known, "lr", "chars").guess)
    return out.where("kind = 'guess'").select("name", "class", "score")


@query()
def final_table_with_subtopics(spark, sf_dir):
    """The final table with guessed topics, four pieces a topic, and columns of sub-topics in the place of one topic."""
    labels, names, known = _label_map(spark, sf_dir), _ratings_map(spark, sf_dir), _subtopic_map(spark, sf_dir)
    classes = _names(labels, "topic")
    within = final.SubtopicColumns("Summary of Examination Findings", known, classes, mapper.train(known, "lr", "chars").guess)
    guess = mapper.train(_curated(spark, sf_dir)).guess
    titled = names.select(ratings.title(F.col("name")).alias("name"), "canonical")
    return final.final_table(_docs(spark, sf_dir), labels, titled, classes, _names(names, "canonical"), guess, 4, within=within)


@query()
def training_report(spark, sf_dir):
    return mapper.training_report(mapper.train(_curated(spark, sf_dir)))


@query()
def final_table(spark, sf_dir):
    return entry(spark, sf_dir)


@query(f"WITH {twins.header()}, {_RATED.removeprefix(_LINES + ', ')}, {_TEXTS.removeprefix(_LINES + ', ')}, {twins.FINAL_CELLS}")
def final_cells(spark, sf_dir):
    """The final table cell by cell."""
    return _long(entry(spark, sf_dir), ["serial_no", "file_name"])


@query()
def final_records(spark, sf_dir):
    """The final table as delimited records."""
    return sources.rendered(entry(spark, sf_dir), "~")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, names = _docs(spark, sf_dir), _label_map(spark, sf_dir), _ratings_map(spark, sf_dir)
    titled = names.select(ratings.title(F.col("name")).alias("name"), "canonical")
    return final.final_table(docs, labels, titled, _names(labels, "topic"), _names(names, "canonical"))


@query(f"WITH {twins.RECORDS} SELECT r.raw_id FROM raw_records r LEFT JOIN judged j USING (raw_id) WHERE NOT coalesce(j.good, false)")
def p3_found(spark, sf_dir):
    return p3_rejected(spark, sf_dir).select("raw_id")


@query()
def p3_rejected(spark, sf_dir):
    return rejects.rejected(rejects.load_records(spread(table(spark, sf_dir, "raw_records"))))


@query()
def p3_typed_headers(spark, sf_dir):
    return rejects.typed(rejects.load_records(spread(table(spark, sf_dir, "raw_records"))), "headers")


@query(f"""WITH {twins.RECORDS}, typed AS ({twins.TYPED_HEADERS}) SELECT raw_id, "column", value FROM (SELECT raw_id, COLUMNS(* EXCLUDE (raw_id))::VARCHAR FROM typed) UNPIVOT INCLUDE NULLS (value FOR "column" IN (* EXCLUDE (raw_id)))""")
def p3_typed_header_cells(spark, sf_dir):
    """The typed headers cell by cell."""
    return _long(p3_typed_headers(spark, sf_dir), ["raw_id"])


@query(f"WITH {twins.RECORDS} {twins.TYPED_TOPICS}")
def p3_typed_topics(spark, sf_dir):
    return rejects.typed(rejects.load_records(spread(table(spark, sf_dir, "raw_records"))), "topics")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
