"""Loading delimited records while setting apart those that fail.

Each worker writes its records, one physical line each, to task-local files (deleted when the batch is done) and
reads them with DuckDB's CSV reader, which keeps line-level errors in its reject tables; the errors are joined back
to the records by line number. Line breaks inside a record are replaced, while DuckDB reads, by code points that the
batch doesn't contain. A record with an open quote would swallow its neighbours, so records with irregular quotes are read
in files of their own, and so is whatever DuckDB neither accepted nor refused for its number of columns: no record is
judged by another's fault. What DuckDB reads more leniently than the rules (a quote inside a bare field) fails by
the exact check of the quotes.

Defined results: a null record is refused ("null record"), an empty one too ("empty record"); an unknown layout
or a missing delimiter is a reason as well. Repeated rows are judged alike. Extra columns of the input are dropped.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns of the two layouts, in file order.
LAYOUTS: dict[str, list[str]] = {
    "headers": [
        "serial_no", "file_name", "region", "certificate_number", "bank_name", "bank_location",
        "examiner_in_charge_first_name", "examiner_in_charge_middle_name", "examiner_in_charge_last_name",
        "exam_start_date", "exam_start_year", "exam_start_month",
        "exam_as_of_date", "exam_as_of_year", "exam_as_of_month",
    ],
    "topics": ["serial_no", "file_name", "topic", "topic_text"],
}

CONTROL = r"[\x00-\x1f\x7f-\x9f]"


def _rules(columns: list[str], nl: str, cr: str) -> list[tuple[str, str]]:
    """(condition of failure, reason) in DuckDB SQL, in column order; nl and cr stand for line breaks."""
    out = []
    for c in columns:
        v = f"replace(replace(coalesce({c}, ''), '{nl}', chr(10)), '{cr}', chr(13))"
        if c == "serial_no":
            out.append((f"NOT regexp_full_match({v}, '0*[1-9][0-9]*')", "serial_no is not a positive integer"))
        elif c == "file_name":
            out.append((f"regexp_matches({v}, '[/\\\\]')", "file_name holds a directory"))
            out.append((f"regexp_matches({v}, '{CONTROL}')", "file_name holds a control character"))
            out.append((f"NOT regexp_full_match({v}, '.*[^\\s].*\\.[tT][xX][tT]', 's')", "file_name is not a .txt name"))
        elif c.endswith("_date"):
            real = f"regexp_full_match({v}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') AND try_strptime({v}, '%m/%d/%Y') IS NOT NULL"
            out.append((f"{v} <> '' AND NOT ({real})", f"{c} is not a date"))
        elif c.endswith("_year"):
            out.append((f"NOT regexp_full_match({v}, '([0-9]{{4}})?')", f"{c} is not a year"))
        elif c.endswith("_month"):
            out.append((f"NOT regexp_full_match({v}, '(0?[1-9]|1[0-2])?')", f"{c} is not a month"))
        elif c == "topic_text":
            out.append((f"regexp_full_match({v}, '[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200b}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}\\x{{feff}}]*')", "topic_text is blank"))
            out.append((f"regexp_matches({v}, '[\\x00-\\x08\\x0b\\x0e-\\x1f\\x7f\\x{{80}}-\\x{{9f}}]')", "topic_text holds a control character"))
    return out


def _quoting(fd: str) -> re.Pattern:
    """Every field free of quotes and line breaks, or wholly enclosed with inner quotes doubled."""
    bare, sep = (f"[^\"\\r\\n{re.escape(fd)}]*" if len(fd) == 1 else f"(?:(?!{re.escape(fd)})[^\"\\r\\n])*"), re.escape(fd)
    field = f'(?:"(?:[^"]|"")*"|{bare})'
    return re.compile(f"{field}(?:{sep}{field})*+", re.S)


def _free_chars(text: str, n: int) -> list[str]:
    """n code points of the private area that the text doesn't contain."""
    used, out = set(text), []
    for cp in [*range(0xE000, 0xF900), *range(0xF0000, 0xFFFFE)]:
        if chr(cp) not in used:
            out.append(chr(cp))
            if len(out) == n:
                return out
    raise ValueError("no free code point in this batch")


def _read(con, folder: str, files: list[list[str]], fd: str, columns: list[str], breaks: tuple[str, str]) -> tuple[pd.DataFrame, pd.DataFrame]:
    """What DuckDB accepts of the files, and the errors in its reject table with file and line."""
    paths = []
    for k, lines in enumerate(files):
        paths.append(path := os.path.join(folder, f"{k:09d}.csv"))
        with open(path, "w", encoding="utf-8", newline="") as out:
            out.write("".join(x + "\n" for x in lines))
    spec = "{" + ", ".join(f"'{c}': 'VARCHAR'" for c in ["n", *columns, "z"]) + "}"
    longest = max((len(x.encode()) for lines in files for x in lines), default=0) + 1024
    con.execute("DROP TABLE IF EXISTS reject_errors; DROP TABLE IF EXISTS reject_scans")
    fails = " ".join(f"WHEN {cond} THEN '{reason}'" for cond, reason in _rules(columns, *breaks))
    names = ", ".join(columns)
    got = con.execute(
        f"""SELECT n, z, [{names}] AS fields, CASE {fails} END AS reason FROM read_csv(?, columns = {spec}, auto_detect = false, header = false,
            delim = ?, quote = '"', escape = '"', new_line = '\\n', strict_mode = true, null_padding = false, ignore_errors = true,
            store_rejects = true, rejects_limit = 0, parallel = false, max_line_size = {longest}, buffer_size = {max(16 * longest, 1 << 16)})""",
        [paths, fd],
    ).df()
    bad = con.execute(
        """SELECT regexp_extract(s.file_path, '([0-9]+)\\.csv$', 1)::INT AS file, e.line::BIGINT AS line, min(e.error_type::VARCHAR) AS kind
           FROM reject_errors e JOIN reject_scans s USING (scan_id, file_id) GROUP BY ALL"""
    ).df()
    for path in paths:
        os.unlink(path)
    return got, bad


_KIND = {"TOO MANY COLUMNS": "too many columns", "MISSING COLUMNS": "missing columns", "UNQUOTED VALUE": "broken quoting", "INVALID STATE": "broken quoting", "LINE SIZE OVER MAXIMUM": "broken quoting", "INVALID ENCODING": "invalid encoding"}


def _load(con, folder: str, texts: list[str], fd: str, columns: list[str]) -> list[tuple[str | None, list | None]]:
    """(reason or None, fields) for each record."""
    nl, cr = _free_chars("".join(texts) + fd, 2)
    out: list[tuple[str | None, list | None] | None] = [None] * len(texts)
    # a closing column, as DuckDB forgives empty columns too many at the end of a line
    lines = [f"{k}{fd}" + x.replace("\n", nl).replace("\r", cr) + f"{fd}{k}" for k, x in enumerate(texts)]
    back = str.maketrans({nl: "\n", cr: "\r"})

    def take(got: pd.DataFrame, bad: pd.DataFrame, ids: list[int], together: bool) -> None:
        """ids: the records line by line in one file, or else one in each file."""
        for file, line, kind in bad.itertuples(index=False):
            k = ids[int(line) - 1 if together else int(file)]
            if not together or kind in ("TOO MANY COLUMNS", "MISSING COLUMNS") and '"' not in texts[k]:
                out[k] = (_KIND.get(kind, kind.lower()), None)
        for n, z, fields, reason in got.itertuples(index=False):
            k = int(n) if n and n.isdecimal() and n == z else -1
            if not 0 <= k < len(texts) or out[k] is not None:
                continue
            if any(v is not None and ("\n" in v or "\r" in v) for v in fields):
                continue
            out[k] = (None if reason is None or pd.isna(reason) else reason, [None if v is None else v.translate(back) for v in fields])

    exact = _quoting(fd)
    broken = [k for k, x in enumerate(texts) if ('"' in x or "\n" in x or "\r" in x) and not exact.fullmatch(x)]
    alone = set(broken)
    if texts:
        sound = [k for k in range(len(texts)) if k not in alone]
        take(*_read(con, folder, [[lines[k] for k in sound]], fd, columns, (nl, cr)), sound, True)
        # an odd number of quotes is never sound, so only even ones are worth a file
        again = [k for k in range(len(texts)) if out[k] is None and not (k in alone and texts[k].count('"') % 2)]
        for a in range(0, len(again), 500):
            part = again[a : a + 500]
            take(*_read(con, folder, [[lines[k]] for k in part], fd, columns, (nl, cr)), part, False)
    for k in broken:
        if out[k] is None or out[k][0] is None:
            out[k] = ("broken quoting", None)
    return [x or ("not readable as delimited text", None) for x in out]


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import duckdb

    with tempfile.TemporaryDirectory() as folder:
        con = duckdb.connect(config={"threads": 1, "temp_directory": folder})
        try:
            for pdf in batches:
                reason, fields = [None] * len(pdf), [None] * len(pdf)
                for (layout, fd), at in pdf.groupby(["layout", "fd"], dropna=False, sort=False).indices.items():
                    texts = pdf["line"].to_numpy()[at]
                    known = layout in LAYOUTS and isinstance(fd, str) and fd not in ("", '"')
                    keep = []
                    for i, text in zip(at, texts):
                        if not known:
                            reason[i] = "unknown layout" if layout not in LAYOUTS else "no usable delimiter"
                        elif text is None:
                            reason[i] = "null record"
                        elif text == "":
                            reason[i] = "empty record"
                        else:
                            keep.append((i, text))
                    if keep:
                        for (i, _), (why, got) in zip(keep, _load(con, folder, [t for _, t in keep], fd, LAYOUTS[layout])):
                            reason[i], fields[i] = why, got
                yield pd.DataFrame({"raw_id": pdf["raw_id"], "layout": pdf["layout"], "reason": reason, "fields": fields})
        finally:
            con.close()


def load_records(df: DataFrame) -> DataFrame:
    """(raw_id, layout, fd, line) → (raw_id, layout, reason, fields): reason null for a loaded record."""
    return df.select("raw_id", "layout", "fd", "line").mapInPandas(_batches, "raw_id long, layout string, reason string, fields array<string>")


def rejected(loaded: DataFrame) -> DataFrame:
    return loaded.where("reason IS NOT NULL").select("raw_id", "layout", "reason")


def _typed(name: str, value: Column) -> Column:
    value = F.nullif(value, F.lit(""))
    if name == "serial_no":
        return value.try_cast("long")
    if name.endswith(("_year", "_month")):
        return value.cast("int")
    if name.endswith("_date"):
        return F.try_to_date(value, "M/d/yyyy")
    return value


def typed(loaded: DataFrame, layout: str) -> DataFrame:
    """The valid records of one layout as typed columns; empty values are null. A serial number beyond 64 bits is null, its digits are in serial_digits."""
    digits = F.get("fields", F.lit(LAYOUTS[layout].index("serial_no")))
    cols = [F.when(digits.try_cast("long").isNull(), digits).alias("serial_digits")]
    cols = [*[_typed(c, F.get("fields", F.lit(i))).alias(c) for i, c in enumerate(LAYOUTS[layout])], *cols]
    return loaded.where(F.col("reason").isNull() & (F.col("layout") == layout)).select("raw_id", *cols)
