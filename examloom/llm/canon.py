"""Mapping freely entered names to a reference list, in SQL; only the list's unique prefixes are cut on the driver.

A partition-based pigeonhole join: every reference string is cut into k + 1 segments, and a string within k edits must hold
one of them unchanged near its place, so names are joined to segments by equality of positional substrings and only those
pairs are verified with levenshtein. Names without a pair are reported as meaning none (0), through an anti-join.

Before that a name is folded: case, leaders with page numbers, numbering, traces of page headings, spaced-out letters,
line-end hyphens, punctuation, introductory and closing words, stop words, and abbreviations (a fixed table, and prefixes
of three letters or more that only one word of the reference list has). Words are compared in their order and sorted.

Each distinct name is resolved once. The reference list is small by nature; reference_forms() refuses one of over 100,000 entries.

Defined results: null and empty names, and those equal to a reference name, are no cases; a name without letters means none;
of several entries at the same distance the one with the lowest id is taken. Repeated rows have the same entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from examloom.session import materialise

MAX_REFERENCE = 100_000

# Abbreviations that are no unique prefix.
ABBREVIATIONS = {
    "mgmt": "management", "mgt": "management", "mngmt": "management", "mgmnt": "management", "mgr": "management",
    "rvw": "review", "rev": "review", "dept": "department", "qlty": "quality", "qual": "quality", "captl": "capital",
    "cap": "capital", "cmplnc": "compliance", "compl": "compliance", "cmpl": "compliance", "cmty": "community",
    "comm": "community", "reinvst": "reinvestment", "prog": "program", "pgm": "program", "prgm": "program", "plng": "planning",
    "plan": "planning", "regs": "regulation", "reg": "regulation", "secs": "securities", "pfolio": "portfolio", "stmt": "statement",
    "xactions": "transactions", "trans": "transactions", "txns": "transactions", "ag": "agricultural", "agri": "agricultural",
    "ops": "operations", "oper": "operations", "int": "internal", "intl": "internal", "tech": "technology", "info": "information",
    "liq": "liquidity", "liquid": "liquidity", "liqudty": "liquidity", "perf": "performance", "sched": "schedule", "schd": "schedule", "dev": "development",
    "acq": "acquisition", "svc": "service", "svcs": "services", "comp": "composite", "compos": "composite", "exam": "examination",
    "conc": "concentrations", "cyber": "cybersecurity", "actvs": "activities", "ctrls": "controls", "invest": "investment",
    "alw": "allowance", "elec": "electronic", "bus": "business", "corr": "corrective", "aud": "audit", "lndg": "lending",
    "std": "standards", "stds": "standards", "conf": "confidential", "est": "estate", "tr": "trust", "mkt": "market",
}

# Other names of reference entries, by field.
ALIASES = {
    "topic": {
        "aml": "Anti-Money Laundering Program", "aml program": "Anti-Money Laundering Program", "bsa aml": "Anti-Money Laundering Program",
        "money laundering controls": "Anti-Money Laundering Program", "alll": "Allowance for Loan Losses", "loan loss reserve": "Allowance for Loan Losses",
        "it": "Information Technology Review", "it review": "Information Technology Review", "information systems review": "Information Technology Review",
        "continuity planning": "Business Continuity Planning", "irr management": "Interest Rate Risk Management", "irr": "Interest Rate Risk Management",
        "agricultural loans": "Agricultural Lending Review", "legal violations": "Violations of Law and Regulation", "cra performance": "Community Reinvestment Performance",
        "cra": "Community Reinvestment Performance", "securities holdings review": "Securities Portfolio Review", "portfolio of securities": "Securities Portfolio Review",
        "cybersecurity readiness": "Cybersecurity Preparedness", "cyber security readiness": "Cybersecurity Preparedness", "findings summary": "Summary of Examination Findings", "directors and officers": "Officer and Director List", "crm": "Concentrations of Credit",
        "credit concentrations": "Concentrations of Credit", "transactions with insiders": "Insider Transactions", "statement condition": "Statement of Condition",
    },
    "rating_name": {
        "cra": "Community Reinvestment", "cra rating": "Community Reinvestment", "it composite": "Information Technology Composite", "it": "Information Technology Composite",
        "it management": "Technology Management", "it audit": "Technology Audit", "risk management": "Risk Management Practices", "quality of assets": "Asset Quality",
        "overall": "Composite", "camels composite": "Composite",
    },
}

STOP = ("of", "and", "for", "to", "the", "with", "on", "in", "a", "an", "s")
CLOSING = {"section": 2, "comments": 2, "rating": 2, "component": 2}


def _lit(text: str) -> str:
    """A SQL literal for spark.sql() with named tables, which reads braces."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("{", "{{").replace("}", "}}") + "'"


def _map(pairs: dict[str, str]) -> str:
    return "map(" + ", ".join(f"{_lit(a)}, {_lit(b)}" for a, b in pairs.items()) + ")"


_FOLDS = [
    (r"^[\s\"']+|[\s\"'*]+$", ""),
    (r"(?:\s*[._•…·\-]){3,}\s*\S{0,5}\s*$", ""),
    (r"\s{4,}\S{1,5}\s*$", ""),
    (r"^table of contents\s{2,}", ""),
    (r"^confidential\s{2,}\S{1,3}\s{2,}", ""),
    (r"^page\s+\S{1,3}\s{2,}", ""),
    (r"^-\s*\S{1,3}\s*-\s*", ""),
    (r"(?<=(?:^|[ _\-])[a-z]) (?=[a-z](?:[ _\-]|$))", ""),
    (r"(?<=[a-z])[-¬­] +(?=[a-z])", ""),
    (r"(?<=[a-z])0|0(?=[a-z]{2})", "o"),
    (r"(?<=[a-z])[1|!](?=[a-z])", "i"),
    (r"(?<=[a-z])5(?=[a-z]|$)", "s"),
    (r"@", "a"),
    (r"(?<=[a-z])9(?=[a-z])", "g"),
    (r"^(?:\(?[a-z0-9]{1,3}\)|[0-9ivxl]{1,4}\.|[ivx]{1,4} -|\d{1,3} )\s*", ""),
    (r"^[*\-•]\s*", ""),
    (r"^(?:re:|see:|the |comments on |section on |rating for )\s*", ""),
    (r"\((?:[a-z0-9]{1,3}|cont[a-z.' ]*)\)\s*[*:.\-]*$|\s+\d$", ""),
    (r"[^\p{L}]+", " "),
]


def _fold(column: str) -> str:
    out = f"lower({column})"
    for pattern, by in _FOLDS:
        out = f"regexp_replace({out}, {_lit(pattern)}, {_lit(by)})"
    return f"trim({out})"


def _words(folded: str, abbreviations: str) -> str:
    """Expanded words without stop words; of stop words alone, all of them."""
    split = f"split({folded}, ' ')"
    expanded = f"transform({split}, w -> coalesce(try_element_at({abbreviations}, w), w))"
    stop = ", ".join(map(_lit, STOP))
    return f"filter({expanded}, w -> w NOT IN ({stop}) AND w <> '')"


def _edits(length: str) -> str:
    """Edits allowed for a reference string of this length."""
    return f"CASE WHEN {length} < 5 THEN 0 WHEN {length} < 7 THEN 1 WHEN {length} < 9 THEN 2 WHEN {length} < 12 THEN 3 ELSE 4 END"


def reference_forms(canon: DataFrame) -> DataFrame:
    """(field, canon_id, form) from (canon_id, field, canonical_name): in order, sorted, by initials, and the aliases."""
    spark = canon.sparkSession
    n = canon.limit(MAX_REFERENCE + 1).count()
    if n > MAX_REFERENCE:
        raise ValueError(f"a reference list has at most {MAX_REFERENCE} entries")
    alias = [(f, a, b) for f, m in ALIASES.items() for a, b in m.items()]
    aliases = spark.createDataFrame(alias, "field string, alias string, canonical_name string")
    named = spark.sql(
        """SELECT field, canon_id, canonical_name AS name FROM {canon} WHERE canonical_name IS NOT NULL
           UNION ALL SELECT c.field, c.canon_id, a.alias FROM {aliases} a JOIN {canon} c ON a.field = c.field AND a.canonical_name = c.canonical_name""",
        canon=canon,
        aliases=aliases,
    )
    folded = spark.sql(f"SELECT field, canon_id, {_words(_fold('name'), _map(ABBREVIATIONS))} AS words, {_fold('name')} AS folded FROM {{named}}", named=named)
    initials = "array_join(transform({}, w -> substr(w, 1, 1)), '')"
    options = [("array_join(words, ' ')", 0), ("array_join(sort_array(words), ' ')", 0), ("folded", 0)]
    options += [(f"if(size(words) > 1, {initials.format(x)}, '')", 1) for x in ("words", "split(folded, ' ')")]
    kinds = "array(" + ", ".join(f"named_struct('form', {x}, 'kind', {k})" for x, k in options) + ")"
    forms = spark.sql(f"SELECT field, canon_id, inline({kinds}) FROM {{folded}}", folded=folded)
    return spark.sql(
        "SELECT field, form, min(canon_id) AS canon_id FROM {forms} WHERE form <> '' GROUP BY field, form HAVING min(kind) = 0 OR count(DISTINCT canon_id) = 1",
        forms=forms,
    )


def _prefixes(canon: DataFrame) -> dict[str, dict[str, str]]:
    """By field: prefixes that only one word of the reference list has."""
    out: dict[str, dict[str, str]] = {}
    for field, names in canon.sparkSession.sql("SELECT field, collect_set(lower(canonical_name)) AS names FROM {canon} WHERE field IS NOT NULL AND canonical_name IS NOT NULL GROUP BY field", canon=canon).collect():
        words = sorted({w for n in names for w in "".join(c if c.isalpha() else " " for c in n).split() if w not in STOP})
        seen: dict[str, set[str]] = {}
        for w in words:
            for k in range(3, len(w)):
                seen.setdefault(w[:k], set()).add(w)
        out[field] = {p: next(iter(ws)) for p, ws in sorted(seen.items()) if len(ws) == 1 and p not in words} | ABBREVIATIONS
    return out


def resolve(names: DataFrame, canon: DataFrame) -> DataFrame:
    """(field, name) → (field, name, canon_id, edits): every distinct name that is neither null nor empty; 0 for none."""
    spark = names.sparkSession
    forms = reference_forms(canon)
    prefixes = _prefixes(canon)
    words = "CASE " + " ".join(f"WHEN field = {_lit(f)} THEN {_words('folded', _map(m))}" for f, m in prefixes.items()) + f" ELSE {_words('folded', _map(ABBREVIATIONS))} END"
    closing = " OR ".join(f"levenshtein(try_element_at(words, -1), '{w}') <= {k}" for w, k in CLOSING.items())
    distinct = spark.sql("SELECT DISTINCT field, name FROM {names} WHERE name <> ''", names=names)
    folded = spark.sql(f"SELECT field, name, {_fold('name')} AS folded FROM {{distinct}}", distinct=distinct)
    worded = spark.sql(f"SELECT field, name, folded, {words} AS words FROM {{folded}}", folded=folded)
    cut = spark.sql(f"SELECT *, if(size(words) > 1 AND ({closing}), slice(words, 1, size(words) - 1), words) AS core FROM {{worded}}", worded=worded)
    probes = spark.sql(
        """SELECT field, name, explode(array_remove(array_distinct(array(
               folded, replace(folded, ' ', ''), array_join(words, ' '), array_join(core, ' '), array_join(sort_array(core), ' '))), '')) AS probe FROM {cut}""",
        cut=cut,
    )
    probes, forms = materialise(probes, "names"), materialise(forms, "forms")
    exact = spark.sql(
        "SELECT field, name, min(canon_id) AS canon_id, 0 AS edits FROM {probes} JOIN {forms} f USING (field) WHERE probe = f.form GROUP BY field, name",
        probes=probes,
        forms=forms,
    )
    rest = spark.sql("SELECT p.* FROM {probes} p LEFT ANTI JOIN {exact} e ON p.field = e.field AND p.name = e.name", probes=probes, exact=exact)
    near = near_pairs(spark.sql("SELECT DISTINCT field, probe FROM {rest}", rest=rest), forms)
    best = spark.sql("SELECT r.field, r.name, min(struct(n.edits, n.canon_id)) AS best FROM {rest} r JOIN {near} n ON r.field = n.field AND r.probe = n.probe GROUP BY r.field, r.name", rest=rest, near=near)
    found = materialise(spark.sql("SELECT field, name, best.canon_id AS canon_id, best.edits AS edits FROM {best} UNION ALL SELECT * FROM {exact}", best=best, exact=exact), "found")
    return spark.sql(
        """
        SELECT field, name, canon_id, edits FROM {found}
        UNION ALL
        SELECT d.field, d.name, 0L AS canon_id, CAST(NULL AS INT) AS edits FROM {distinct} d LEFT ANTI JOIN {found} f ON d.field = f.field AND d.name = f.name
        """,
        found=found,
        distinct=distinct,
    )


def near_pairs(probes: DataFrame, forms: DataFrame) -> DataFrame:
    """(field, probe) × (field, canon_id, form) within the allowed edits, by the pigeonhole join: field, probe, canon_id, edits.

    Segment i of k + 1 (from 0) starts at p; in a probe longer by d it may start at q with |q - p| <= i and
    |q - p - d| <= k - i: of the edits, at most i lie before some unchanged segment i and at most k - i after it.
    """
    spark = probes.sparkSession
    sized = spark.sql(f"SELECT field, canon_id, form, length(form) AS n, {_edits('length(form)')} AS k FROM {{forms}}", forms=forms)
    cut = spark.sql("SELECT *, explode(sequence(0, k)) AS i FROM {sized}", sized=sized)
    segments = spark.sql(
        """SELECT field, canon_id, form, n, k, i, n * i DIV (k + 1) AS p,
                  substr(form, CAST(n * i DIV (k + 1) AS INT) + 1, CAST(n * (i + 1) DIV (k + 1) - n * i DIV (k + 1) AS INT)) AS piece FROM {cut}""",
        cut=cut,
    )
    shapes = spark.sql("SELECT DISTINCT field, n, k, i, p, length(piece) AS size FROM {segments}", segments=segments)
    placed = spark.sql(
        """SELECT /*+ BROADCAST(s) */ p.field, p.probe, s.n, s.i, s.size,
                  greatest(s.p - s.i, s.p + length(p.probe) - s.n - (s.k - s.i), 0L) AS low,
                  least(s.p + s.i, s.p + length(p.probe) - s.n + (s.k - s.i), CAST(length(p.probe) - s.size AS BIGINT)) AS high
           FROM {probes} p JOIN {shapes} s ON p.field = s.field AND length(p.probe) BETWEEN s.n - s.k AND s.n + s.k""",
        probes=probes,
        shapes=shapes,
    )
    spots = spark.sql("SELECT *, explode(sequence(low, high)) AS q FROM {placed} WHERE low <= high", placed=placed)
    pieces = spark.sql("SELECT field, probe, n, i, substr(probe, CAST(q AS INT) + 1, size) AS piece FROM {spots}", spots=spots)
    pairs = spark.sql(
        """SELECT /*+ BROADCAST(s) */ DISTINCT c.field, c.probe, s.canon_id, s.form, s.k FROM {pieces} c
           JOIN {segments} s ON c.field = s.field AND c.n = s.n AND c.i = s.i AND c.piece = s.piece""",
        pieces=pieces,
        segments=segments,
    )
    verified = spark.sql("SELECT field, probe, canon_id, levenshtein(probe, form) AS edits, k FROM {pairs}", pairs=pairs)
    return spark.sql("SELECT field, probe, canon_id, min(edits) AS edits FROM {verified} WHERE edits <= k GROUP BY field, probe, canon_id", verified=verified)


def map_names(rows: DataFrame, canon: DataFrame) -> DataFrame:
    """(source_table, row_id, field, name) → the same with canon_id, of every row that is a case."""
    spark = rows.sparkSession
    cases = spark.sql(
        """SELECT /*+ BROADCAST(c) */ r.source_table, r.row_id, r.field, r.name FROM {rows} r LEFT ANTI JOIN {canon} c ON r.field = c.field AND r.name = c.canonical_name
           WHERE r.name <> ''""",
        rows=rows,
        canon=canon,
    )
    resolved = resolve(cases.select("field", "name"), canon)
    return spark.sql("SELECT c.*, m.canon_id FROM {cases} c JOIN {resolved} m ON c.field = m.field AND c.name = m.name", cases=cases, resolved=resolved)
