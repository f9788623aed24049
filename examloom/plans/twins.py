"""SQL of the header and rating queries for DuckDB, as chains of common table expressions over `documents`."""

from __future__ import annotations

# texts with unified line ends, and their lines as files are read
UNIFIED = "replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
LINES = f"""texts AS (SELECT doc_id, text, {UNIFIED} AS t FROM documents WHERE text <> ''),
    arrays AS (SELECT doc_id, string_split(CASE WHEN t LIKE '%' || chr(10) THEN left(t, length(t) - 1) ELSE t END, chr(10)) AS ls, t LIKE '%' || chr(10) AS closed FROM texts),
    lines AS (SELECT doc_id, closed, len(ls) AS n, unnest(ls) AS line, generate_subscripts(ls, 1) AS no FROM arrays)"""
WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"


def strip(x: str) -> str:
    return f"trim({x}, {WHITE})"


def title(x: str) -> str:
    """A capital after every character that is no letter."""
    return f"""array_to_string(list_transform(range(1, length({x}) + 1), lambda i: CASE WHEN i > 1 AND regexp_matches(substr({x}, i - 1, 1), '\\pL') THEN lower(substr({x}, i, 1)) ELSE upper(substr({x}, i, 1)) END), '')"""


def _cut(x: str, name: str) -> str:
    """The text before a certificate far to the right, and the certificate."""
    pattern = r"'(?i)^(.*)?\s{5,}(certificate\s+num[bh]e[ir]|certificate|charter\s+num[bh]er|charter|field\s+offic\s*e|url)\s*:?\s*(.*)?\s*$'"
    part = lambda k: f"regexp_extract({x}, {pattern}, {k})"
    cut = f"(regexp_matches({x}, {pattern}) AND NOT (lower({part(2)}) = 'charter' AND lower({part(3)}) = 'bank'))"
    return f"CASE WHEN {cut} THEN {part(1)} ELSE {x} END AS {name}, CASE WHEN {cut} AND lower({part(2)}) LIKE 'certificate%' THEN {part(3)} ELSE '' END AS {name}_cert"


_REGION = r"""'(?i)^(|.*\s+)region(\s*[:'']\s*|\s+)(.*)?\s*$'"""
_CERT = r"""'(?i)^(|.*\s+)(certificate\s+number)(\s*:\s*|\s+)([\pL\pN_]+).*$'"""

BLOCK = rf"""{LINES}, plain AS (SELECT doc_id, no, replace(line, chr(12), '') AS line FROM lines),
    above AS (SELECT *, lag(line, 1, '') OVER (PARTITION BY doc_id ORDER BY no) AS l1, lag(line, 2, '') OVER (PARTITION BY doc_id ORDER BY no) AS l2 FROM plain WHERE {strip('line')} <> ''),
    near AS (SELECT *, regexp_matches(line, {_REGION}) AS is_region, {strip(f"regexp_extract(line, {_REGION}, 1)")} = '' AS first, {strip(f"regexp_extract(line, {_REGION}, 2)")} AS sep,
        regexp_extract(line, {_REGION}, 3) AS v, regexp_extract(line, {_CERT}, 4) AS direct FROM above WHERE regexp_matches(line, '(?i)region|certificate\s+number')),
    parts AS (SELECT *, {_cut('v', 'region')}, {_cut('l1', 'loc')}, {_cut('l2', 'bank')}, CASE WHEN is_region AND first AND sep = ':' THEN 3 WHEN is_region AND first THEN 2 WHEN is_region THEN 1 END AS q FROM near),
    high AS (SELECT *, max(q) OVER (PARTITION BY doc_id ORDER BY no) AS top FROM parts),
    certs AS (SELECT *, CASE WHEN q >= top AND region_cert <> '' THEN region_cert WHEN q >= top AND first AND loc_cert <> '' THEN loc_cert WHEN q >= top AND first AND bank_cert <> '' THEN bank_cert ELSE nullif(direct, '') END AS cert FROM high),
    block AS (SELECT doc_id, arg_max(region, q::BIGINT * 1000000000 + no) FILTER (q >= 1) AS region, arg_max(loc, q::BIGINT * 1000000000 + no) FILTER (q >= 2) AS bank_location,
        arg_max(bank, q::BIGINT * 1000000000 + no) FILTER (q >= 2) AS bank_name, arg_min(cert, no) FILTER (cert IS NOT NULL) AS certificate FROM certs GROUP BY doc_id)"""


def date_of(x: str) -> str:
    """A chain of columns to a date: numbers, a month's name, or a year alone."""
    s = rf"regexp_replace({x}, '^[^\pL\pN_]+', '')"
    numbers = r"'^([0-9]{1,2})[/\-.]([0-9]{1,2})[/\-.]([0-9]{2})([0-9]{2})?(\s*$|\s+.*$)'"
    words = r"'(?i)^([a-z]+)\s+([0-9 a-z]+)\s*[/\-.,]\s*([0-9]{2})([0-9]{2})?(\s*$|\s+.*$)'"
    part = lambda p, k: f"regexp_extract({s}, {p}, {k})"
    year = lambda p: f"CASE WHEN {part(p, 4)} <> '' THEN {part(p, 3)} || {part(p, 4)} WHEN {part(p, 3)} >= '69' THEN '19' || {part(p, 3)} ELSE '20' || {part(p, 3)} END"
    months = "['january', 'february', 'march', 'april', 'may', 'june', 'july', 'august', 'september', 'october', 'november', 'december']"
    day = f"regexp_replace(translate(regexp_replace({part(words, 2)}, '\\s+', '', 'g'), 'QIloO', '01100'), '[a-zA-Z]', '', 'g')"
    date = lambda y, m, d: f"try_strptime(({y}) || '-' || ({m}) || '-' || ({d}), '%Y-%m-%d')::DATE"
    return f"""CASE WHEN regexp_matches({s}, {numbers}) THEN {date(year(numbers), part(numbers, 1), part(numbers, 2))}
        WHEN regexp_matches({s}, {words}) THEN CASE WHEN regexp_full_match({day}, '[0-9]{{1,2}}') THEN {date(year(words), f"nullif(list_position({months}, lower({part(words, 1)})), 0)::VARCHAR", f"greatest({day}::INT, 1)::VARCHAR")} END
        WHEN regexp_full_match({s}, '[0-9]{{4}}') THEN {date(s, "'1'", "'1'")} END"""


def date_text(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '' ELSE month({x}) || '/' || day({x}) || '/' || year({x}) END"


def name_of(source: str, column: str) -> str:
    """CTEs that end in `person`: source with its rows and first, middle, last and suffix of the column."""
    n = f"coalesce({column}, '')"
    for p in (r"\(.*\)", r"[^\pL\pN_][0-9]+[^\pL\pN_]", r"U''end\\", r"\s*-\s*[A-Z]+"):
        n = f"regexp_replace({n}, '{p}', ' ', 'g')"
    n = rf"regexp_replace({n}, '[ ,\-]+FDIC\s*$', '')"
    suffix = r"'(?i)^(.*[a-z.])[, ]+(jr|sr|jr\.|sr\.|junior|senior|[IVX]+)\s*$'"
    clean = lambda x: rf"regexp_replace(coalesce({x}, ''), '(?i)[^a-z''.\-]', '', 'g')"
    middle = "CASE WHEN comma THEN array_to_string(w[2:], ' ') WHEN len(w) >= 3 THEN array_to_string(w[2:len(w) - 1], ' ') END"
    return rf"""n0 AS (SELECT *, {n} AS n_ FROM {source}),
    n1 AS (SELECT *, CASE WHEN regexp_matches(n_, {suffix}) THEN regexp_extract(n_, {suffix}, 2) ELSE '' END AS suffix, {strip(f"CASE WHEN regexp_matches(n_, {suffix}) THEN regexp_extract(n_, {suffix}, 1) ELSE n_ END")} AS body FROM n0),
    n2 AS (SELECT *, contains(body, ',') AS comma, {strip("regexp_extract(body, '^(.*),(.*)$', 1)")} AS before_, CASE WHEN contains(body, ',') THEN {strip("regexp_extract(body, '^(.*),(.*)$', 2)")} ELSE body END AS rest FROM n1),
    n3 AS (SELECT *, string_split_regex(regexp_replace(rest, '\.([^\s])', '. \1', 'g'), '\s+') AS w FROM n2),
    person AS (SELECT *, {clean("CASE WHEN comma OR len(w) >= 2 THEN w[1] END")} AS first_, {clean(middle)} AS middle_, {clean("CASE WHEN comma THEN before_ ELSE w[len(w)] END")} AS last_ FROM n3)"""


_FIELDS = [
    ("bank_name", [r"bank\s+name", r"institution\s+name", "name"]), ("bank_location", ["location"]), ("examiner_in_charge", [r"examiner[\s\-]*in[\s\-]*charge"]),
    ("exam_start_date", [r"examination[\s\-]*start[\s\-]*date"]), ("exam_date", [r"examination[\s\-]*date"]), ("exam_as_of_date", [r"examination[\s\-]*as[\s\-]*of[\s\-]*date"]),
]


def _wordings() -> str:
    out = []
    for field, patterns in _FIELDS:
        for rank, p in enumerate(patterns):
            pattern = rf"'(?i)^(|.*\s+){p}(\s*[:''][''\s\.]*|[''\s\.]+)(.*)?\s*$'"
            part = lambda k, pattern=pattern: f"regexp_extract(line, {pattern}, {k})"
            values = rf"string_split_regex({part(3)}, '\s{{5,}}')"
            out.append(f"SELECT doc_id, no, '{field}' AS field, {rank} AS rank, {values}[1] AS value, ({strip(part(1))} = '')::INT + ({strip(part(2))} = ':')::INT + (len({values}) = 1)::INT AS q FROM plain WHERE regexp_matches(line, {pattern})")
    return " UNION ALL ".join(out)


def _value(field: str) -> str:
    return f"arg_min(value, rank::BIGINT * 1000000000000 + (3 - q)::BIGINT * 100000000000 + no) FILTER (field = '{field}') AS f_{field}"


def _named(x: str) -> str:
    s = strip(x)
    return rf"trim(regexp_replace(CASE WHEN regexp_matches({s}, '[A-Z]') THEN regexp_extract({s}, '([A-Z].*)', 1) ELSE {s} END, '\s+', ' ', 'g'))"


_PUNCT = r"regexp_replace({}, '[^\pL\pN_\s\x{{85}}\x{{a0}}]', '', 'g')"


def header() -> str:
    """CTEs that end in `header`: the 13 columns of each document."""
    split = lambda x: rf"string_split_regex({x}, '\s{{3,}}')[1]"
    words = r"regexp_extract(coalesce(f_examiner_in_charge, ''), '^([^\s;]*(?:\s+[^\s;a-z][^\s;]*)*;?)', 1)"
    examiner = rf"CASE WHEN regexp_matches(coalesce(f_examiner_in_charge, ''), '^[a-z\s]') THEN '' ELSE regexp_replace({words}, ';$', '') END"
    region = strip(_PUNCT.format("coalesce(b.region, '')"))
    return rf"""{BLOCK}, cands AS ({_wordings()}),
    valid AS (SELECT * FROM cands WHERE field NOT IN ('exam_start_date', 'exam_date', 'exam_as_of_date') OR {date_of('value')} IS NOT NULL),
    bests AS (SELECT doc_id, {', '.join(_value(f) for f, _ in _FIELDS)} FROM valid GROUP BY doc_id),
    joined AS (SELECT d.doc_id, f.*, b.*, {examiner} AS examiner_, {date_of(split('coalesce(f.f_exam_start_date, f.f_exam_date)'))} AS start_, {date_of(split('f.f_exam_as_of_date'))} AS as_of_,
        string_split_regex({region}, '\s{{5,}}')[1] AS region_ FROM documents d LEFT JOIN bests f ON f.doc_id = d.doc_id LEFT JOIN block b ON b.doc_id = d.doc_id),
    {name_of('joined', 'examiner_')},
    header AS (SELECT doc_id, replace({title('region_')}, ' ', '_') AS region, {strip(_PUNCT.format("coalesce(certificate, '')"))} AS certificate_number,
        replace(coalesce({_named("coalesce(nullif(bank_name, ''), f_bank_name, '')")}, ''), ' ', '_') AS bank_name, {_named("coalesce(nullif(bank_location, ''), f_bank_location, '')")} AS bank_location,
        first_ AS examiner_in_charge_first_name, middle_ AS examiner_in_charge_middle_name, last_ AS examiner_in_charge_last_name,
        {date_text('start_')} AS exam_start_date, year(start_)::INT AS exam_start_year, month(start_)::INT AS exam_start_month,
        {date_text('as_of_')} AS exam_as_of_date, year(as_of_)::INT AS exam_as_of_year, month(as_of_)::INT AS exam_as_of_month FROM person)"""


ANALYSIS = r"""WITH w AS (SELECT toc_id, topic, string_split_regex(topic, '\s+') AS w FROM extract_toc),
    k AS (SELECT *, w[1:coalesce(list_max(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN regexp_full_match(w[i], '\.*') THEN 0 ELSE i END)), 0)] AS k FROM w)
    SELECT toc_id, trim(array_to_string(k, ' ')) AS formatted,
        NOT (len(list_filter(k, lambda x: x LIKE '%.' OR regexp_matches(x, '[0-9]'))) > 0 OR coalesce(k[1] = lower(k[1]) AND k[1] <> upper(k[1]), false) OR coalesce(lower(k[len(k)]) = 'of', false)) AS sure
    FROM k"""

_FULL = "i = 0 OR size + 2 + length(ls[i + 1]) > 32000"
PACKED = f"""long AS (SELECT doc_id, topic, string_split(topic_text, chr(13) || chr(10)) AS ls FROM found),
    packed AS (SELECT doc_id, topic, ls, 0 AS i, 0 AS piece_no, 0 AS size, '' AS piece FROM long
        UNION ALL SELECT doc_id, topic, ls, i + 1, CASE WHEN {_FULL} THEN piece_no + 1 ELSE piece_no END, CASE WHEN {_FULL} THEN length(ls[i + 1]) ELSE size + 2 + length(ls[i + 1]) END,
            CASE WHEN {_FULL} THEN ls[i + 1] ELSE piece || chr(13) || chr(10) || ls[i + 1] END FROM packed WHERE i < len(ls))
    SELECT doc_id, topic, piece_no::INT AS piece_no, arg_max(piece, i) AS piece FROM packed WHERE i > 0 GROUP BY ALL"""

_VALUE = r"'(?i)^(.*?\S)(?:\s{1,10}|\s{0,10}[\-:]\s{0,10})([0-9A-Z])\s*$'"
MAPPED = f"""mp AS (SELECT t.*, c.canonical_name AS canonical FROM tab t JOIN canon_names c ON c.field = 'rating_name' AND {title('c.canonical_name')} = {title('t.rating_name')}),
    mapped AS (SELECT doc_id, canonical, arg_max(current, line_no) AS current, arg_max(prior, line_no) AS prior, arg_max(prior_prior, line_no) AS prior_prior FROM mp GROUP BY 1, 2),
    l1 AS (SELECT doc_id, no, lower(regexp_extract(line, {_VALUE}, 1)) AS n, regexp_extract(line, {_VALUE}, 2) AS v FROM lines),
    spoken AS (SELECT doc_id, c.canonical_name AS canonical, arg_max(v, no) AS value FROM l1 JOIN canon_names c ON c.field = 'rating_name' AND lower(c.canonical_name) = l1.n GROUP BY 1, 2)"""
RATED = """rated AS (SELECT d.doc_id, c.canonical_name AS canonical, coalesce(nullif(s.value, ''), m.current, '') AS current, coalesce(s.value, '') AS from_headers_current, coalesce(m.current, '') AS from_table_current,
    coalesce(m.prior, '') AS prior, coalesce(m.prior_prior, '') AS prior_prior FROM documents d CROSS JOIN (SELECT DISTINCT canonical_name FROM canon_names WHERE field = 'rating_name') c
    LEFT JOIN mapped m ON m.doc_id = d.doc_id AND m.canonical = c.canonical_name LEFT JOIN spoken s ON s.doc_id = d.doc_id AND s.canonical = c.canonical_name)"""
RATED_CELLS = """SELECT doc_id, replace(canonical || ' ' || "column", ' ', '_') AS "column", value FROM rated UNPIVOT (value FOR "column" IN (current, from_headers_current, from_table_current, prior, prior_prior))"""
IMPROVED = """both_ AS (SELECT coalesce(m.doc_id, s.doc_id) AS doc_id, coalesce(m.current, '') AS t, coalesce(s.value, '') AS h FROM mapped m FULL JOIN spoken s ON s.doc_id = m.doc_id AND s.canonical = m.canonical)
    SELECT d.doc_id, coalesce(sum(CASE WHEN h <> '' AND h <> t THEN 1 WHEN h = '' AND t <> '' THEN -1 ELSE 0 END), 0)::BIGINT AS change FROM documents d LEFT JOIN both_ b USING (doc_id) GROUP BY 1"""
SPOKEN_ROWS = f"""WITH l AS (SELECT rating_id AS doc_id, rating_name || ' - ' || current_rating AS line FROM get_ratings WHERE prior_rating IS NOT NULL),
    v AS (SELECT doc_id, lower(regexp_extract(line, {_VALUE}, 1)) AS n, regexp_extract(line, {_VALUE}, 2) AS v FROM l)
    SELECT doc_id, c.canonical_name AS canonical, v AS value FROM v JOIN canon_names c ON c.field = 'rating_name' AND lower(c.canonical_name) = v.n"""
_PARTS = r"""flatten(list_transform(regexp_extract_all(line, '(?i)(?:^|[^\pL\pN_])component ratings[^\pL\pN_]+([^ ]*)', 1), lambda x: string_split(x, '-')))"""
COMPONENTS = f"""WITH l AS (SELECT rating_id AS doc_id, 'Component Ratings: ' || current_rating || '-' || prior_rating || '-1-2-3-4' AS line FROM get_ratings WHERE rating_name IS NOT NULL)
    SELECT r.rating_id AS doc_id, CASE WHEN len({_PARTS}) = 6 THEN array_to_string({_PARTS}, '-') ELSE '' END AS component, '' AS roca FROM get_ratings r LEFT JOIN l ON l.doc_id = r.rating_id"""
FINAL_CELLS = """serial AS (SELECT doc_id, file_name, row_number() OVER (ORDER BY doc_id) AS serial_no FROM documents),
    names AS (SELECT DISTINCT canonical_name AS topic FROM canon_names WHERE field = 'topic' UNION SELECT 'Confidential'),
    cells AS (SELECT doc_id, "column", value FROM (SELECT doc_id, COLUMNS(* EXCLUDE (doc_id))::VARCHAR FROM header) UNPIVOT INCLUDE NULLS (value FOR "column" IN (* EXCLUDE (doc_id)))
        UNION ALL SELECT doc_id, replace(canonical || ' ' || "column", ' ', '_'), value FROM rated UNPIVOT (value FOR "column" IN (current, from_headers_current, from_table_current, prior, prior_prior))
        UNION ALL SELECT d.doc_id, replace(replace(replace(replace(n.topic, '-', ' '), '/', ' '), chr(39), ''), ' ', '_'), f.topic_text FROM documents d CROSS JOIN names n LEFT JOIN found f ON f.doc_id = d.doc_id AND f.topic = n.topic)
    SELECT s.serial_no, s.file_name, c."column", c.value FROM cells c JOIN serial s USING (doc_id)"""

# Records: fields cut by their own delimiter, one character, after the quoting of the whole line is tested
_BARE = r"""'[^"\r\n' || CASE WHEN fd IN ('|', '~', ',') THEN fd ELSE '\' || fd END || ']*'"""
_FIELD = f"""'(?:"(?:[^"]|"")*"|' || {_BARE} || ')'"""
_BLANK = r"'[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]*'"
_DATE = r"(v[{0}] = '' OR regexp_full_match(v[{0}], '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') AND try_strptime(v[{0}], '%m/%d/%Y') IS NOT NULL)"
_HEADERS = " AND ".join(_DATE.format(k) for k in (10, 13)) + "".join(rf" AND regexp_full_match(v[{k}], '([0-9]{{4}})?') AND regexp_full_match(v[{k + 1}], '(0?[1-9]|1[0-2])?')" for k in (11, 14))
RECORDS = rf"""cut AS (SELECT raw_id, layout, regexp_full_match(line, '(?s)' || {_FIELD} || '(?:[' || fd || ']' || {_FIELD} || ')*') AS quoted,
        regexp_extract_all(line || fd, '(?s)(' || {_FIELD} || ')[' || fd || ']', 1) AS f FROM raw_records WHERE line <> ''),
    vals AS (SELECT raw_id, layout, quoted AND len(f) = CASE layout WHEN 'headers' THEN 15 ELSE 4 END AS whole, list_transform(f, lambda x: CASE WHEN x LIKE '"%' THEN replace(x[2:-2], '""', '"') ELSE x END) AS v FROM cut),
    judged AS (SELECT *, whole AND regexp_full_match(v[1], '0*[1-9][0-9]*') AND NOT regexp_matches(v[2], '[/\\\x00-\x1f\x7f-\x{{9f}}]') AND regexp_full_match(v[2], '(?s).*\S.*\.[tT][xX][tT]')
        AND CASE layout WHEN 'headers' THEN {_HEADERS} ELSE NOT regexp_full_match(v[4], {_BLANK}) AND NOT regexp_matches(v[4], '[\x00-\x08\x0b\x0e-\x1f\x7f\x{{80}}-\x{{9f}}]') END AS good FROM vals)"""
_TEXT = "nullif(v[{}], '') AS {}"
TYPED_TOPICS = f"""SELECT raw_id, TRY_CAST(v[1] AS BIGINT) AS serial_no, {', '.join(_TEXT.format(k + 2, c) for k, c in enumerate(('file_name', 'topic', 'topic_text')))},
    CASE WHEN TRY_CAST(v[1] AS BIGINT) IS NULL THEN v[1] END AS serial_digits FROM judged WHERE good AND layout = 'topics'"""
_NAMES = ["file_name", "region", "certificate_number", "bank_name", "bank_location", "examiner_in_charge_first_name", "examiner_in_charge_middle_name", "examiner_in_charge_last_name"]
_WHEN = [(10, "exam_start"), (13, "exam_as_of")]
TYPED_HEADERS = f"""SELECT raw_id, TRY_CAST(v[1] AS BIGINT) AS serial_no, {', '.join(_TEXT.format(k + 2, c) for k, c in enumerate(_NAMES))},
    {', '.join(f"try_strptime(v[{k}], '%m/%d/%Y')::DATE AS {c}_date, TRY_CAST(v[{k + 1}] AS INT) AS {c}_year, TRY_CAST(v[{k + 2}] AS INT) AS {c}_month" for k, c in _WHEN)},
    CASE WHEN TRY_CAST(v[1] AS BIGINT) IS NULL THEN v[1] END AS serial_digits FROM judged WHERE good AND layout = 'headers'"""
