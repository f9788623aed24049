"""Per-document text quality statistics, and an ordered rule list that tells prose from lists, tables and junk.

The statistics are taken over whole texts in Arrow batches, without a shuffle: as higher-order functions over lines and words
they took four times the time. A rule list is induced on a bounded sample of
labelled documents by incremental reduced-error pruning (each rule grown on two thirds of the sample by information gain,
pruned on the rest, kept while it is right more often than not), and applied to all documents as one native CASE expression.

Labels: `labels` of induce() may be any Boolean column; where none is given, the sample is labelled by a slower reading of
each text, paragraph by paragraph (label()). The rules see none of its judgements, only plain statistics of the whole text.

Defined results: null, empty and blank texts have counts of 0, shares of 0 and are no cases. Repeated rows are judged alike;
extra columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound of the labelled sample.
SAMPLE = 9000

_BULLET = re.compile(r"(?:[-*•·▪◦–—]|\(?\d{1,4}[.)]|\(?[A-Za-z][.)])\s+").match
_LEADER = re.compile(r"(?:\.\s?){4}|_{4}|(?: {8}|\t)\S+$").search
_GAP = re.compile(r"\S(?: {2,}|\t)\S").search
_DATA = re.compile(r"\d$|\|").search
_FIGURE = re.compile(r"[\d|\t]").search
_FOREIGN = re.compile("[^\x00-\x7f]+")
#: Kinds of ASCII characters: 0 white space and controls, 1 letters, 2 digits, 3 symbols; bytes beyond count as letters or not at all.
_KINDS = np.array([0 if b <= 32 or b == 127 else 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3 if b < 128 else 4 if b < 0xC0 else 1 for b in range(256)], dtype=np.uint8)
_ENDS = tuple(".!?:;…\"”’")

#: The statistics that rules may use.
FEATURES = [
    "n_words", "n_distinct", "mean_word_length", "symbol_ratio", "digit_ratio", "punct_line_share", "mean_line_words",
    "list_share", "table_share", "loose_share", "repetition", "longest_word", "common_share", "same_language",
]


INTS = ("n_chars", "n_words", "n_lines", "n_distinct", "longest_word")
STATS = ["n_chars", "n_words", "n_lines", *[f for f in FEATURES if f not in ("n_words",)]]


def languages(common: Iterable[str] | Mapping[str, int]) -> dict[str, int]:
    """Frequent words of two letters or more → a bit for each language they are frequent in; words without languages have one bit."""
    return {w: m for w, m in (common.items() if isinstance(common, Mapping) else dict.fromkeys(common, 1).items()) if len(w) > 1}


def _same(masks: list[int]) -> float:
    """Share of the neighbouring frequent words that have a language in common: words in no order have few."""
    return sum(1 for a, b in pairwise(masks) if a & b) / (len(masks) - 1) if len(masks) > 1 else 1.0


def measure(text: str | None, common: Mapping[str, int]) -> list:
    """The statistics of one text, in the order of STATS. Words are what stands between white space."""
    if not text or text.isspace():
        return [len(text or ""), 0, 0] + [0 if f in INTS else 0.0 for f in STATS[3:]]
    kinds = np.bincount(_KINDS[np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)], minlength=5)
    letters, digits, symbols = int(kinds[1]), int(kinds[2]), int(kinds[3])
    if not text.isascii():
        other = sum(not c.isalpha() for run in _FOREIGN.findall(text) for c in run)
        letters, symbols = letters - other, symbols + other
    every: list[str] = []
    masks: list[int] = []
    ends = n_lines = total = 0
    sums = [0, 0, 0, 0]
    for line in text.splitlines():
        s = line.strip()
        if not s:
            continue
        words = s.lower().split()
        every += words
        hits = [common[w] for w in words if w in common]
        masks += hits
        w, c, shape = len(words), len(hits), 0
        poor = c < 0.2 * w
        if (poor or w < 8) and (s[0] in "-*•·▪◦–—(" or s[1:5].find(".") >= 0 or s[1:5].find(")") >= 0) and _BULLET(s):
            shape = 1
        elif (poor or w < 8) and ("_" in s or ".." in s or ". ." in s or "        " in s or "\t" in s) and _LEADER(s):
            shape = 2
        elif ("  " in s or "\t" in s) and (poor or _DATA(s)) and _GAP(s):
            shape = 2
        elif c < 0.15 * w and s.count(",") + s.count(";") + s.count("|") + s.count("~") + s.count("\t") >= 3 and _FIGURE(s):
            shape = 2
        end = s.endswith(_ENDS)
        if not shape and w <= 6 and not end:
            shape = 3
        ends, n_lines, total = ends + end, n_lines + 1, total + len(s)
        sums[shape] += len(s)
    n_words, distinct, solid = len(every), len(set(every)), letters + digits + symbols
    values = {
        "n_distinct": distinct, "mean_word_length": letters / n_words, "symbol_ratio": symbols / solid if solid else 0.0, "digit_ratio": digits / solid if solid else 0.0,
        "punct_line_share": ends / n_lines, "common_share": len(masks) / n_words, "same_language": _same(masks), "mean_line_words": n_words / n_lines, "list_share": sums[1] / total,
        "table_share": sums[2] / total, "loose_share": sums[3] / total, "repetition": n_words / distinct, "longest_word": max(map(len, every)),
    }
    return [len(text), n_words, n_lines, *[values[f] if f in INTS else round(values[f], 6) for f in STATS[3:]]]


def statistics(df: DataFrame, common: Iterable[str] | Mapping[str, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: the key and the statistics. `common` are frequent words, lower case, with a bit for each language if these are known."""
    common = languages(common)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t, common) for t in batch.column(1).to_pylist()]
            cols = list(zip(*rows)) if rows else [()] * len(STATS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64() if f in INTS else pa.float64()) for f, c in zip(STATS, cols)]], [key, *STATS])

    schema = ", ".join([f"{key} {kind}", *[f"{f} {'long' if f in INTS else 'double'}" for f in STATS]])
    return df.select(F.col(key), F.col(text).alias("text_")).mapInArrow(run, schema)


def label(text: str | None, common: Mapping[str, int]) -> bool:
    """Whether more than half of the characters are list entries, table rows or junk, by reading the text."""
    lines = [x.strip() for x in re.split(r"\r\n?|\n|\f", text or "") if x.strip()]
    words = [re.findall(r"[^\W\d_]{2,}", x.lower()) for x in lines]
    every = [w for ws in words for w in ws]
    total = sum(map(len, lines))
    if not total:
        return False
    if len(every) >= 16 and len(set(every)) * 8 <= len(every) and len(set(every)) < 20:
        return True
    hits = [sum(w in common for w in ws) for ws in words]
    bad, run = 0, []

    def close() -> int:
        """Characters of a run of plain lines that are no running text."""
        if not run:
            return 0
        n, c = sum(len(words[i]) for i in run), sum(hits[i] for i in run)
        size = sum(len(lines[i]) for i in run)
        ends = sum(bool(re.search(r"[.!?:;…][\"”’)]*$", lines[i])) for i in run)
        order = [common[w] for i in run for w in words[i] if w in common]
        if len(order) >= 6 and _same(order) < 0.56:  # words of several languages in no order
            return size
        if n == 0 or c < (0.19 if n >= 20 else 0.1) * n or size > 12 * (n + 1):
            return size
        return size if len(run) > 3 and n / len(run) < 5 and ends < 0.1 * len(run) and c < 0.3 * n else 0

    for i, (line, ws) in enumerate(zip(lines, words)):
        poor = hits[i] < 0.2 * len(ws) or not ws
        bullet = re.match(r"(?:[-*•·▪◦–—]|\(?\d{1,4}[.)]|\(?[A-Za-z][.)])\s+", line) and (poor or len(ws) < 8)
        leader = re.search(r"(?:\.\s?){4,}|_{4,}|\S(?: {2,}|\t)\S+$", line) and (poor or len(ws) < 8)
        gaps = re.search(r"\S(?: {2,}|\t)\S", line) and poor
        fields = len(re.findall(r"[,;|~\t]", line)) >= 3 and re.search(r"[\d|\t]", line) and hits[i] < 0.15 * len(ws)
        if bullet or leader or gaps or fields:
            bad += close() + len(line)
            run = []
        else:
            run.append(i)
    return bad + close() > 0.5 * total


Condition = tuple[str, str, float]


def _holds(x: np.ndarray, names: list[str], rule: list[Condition]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for name, op, value in rule:
        col = x[:, names.index(name)]
        out &= col >= value if op == ">=" else col < value
    return out


def _grow(x: np.ndarray, y: np.ndarray, names: list[str]) -> list[Condition]:
    """Conditions of the highest information gain until no negative is left."""
    rule: list[Condition] = []
    inside = np.ones(len(x), dtype=bool)
    while True:
        p, n = (y & inside).sum(), (~y & inside).sum()
        if p == 0 or n == 0:
            break
        base, best = np.log2(p / (p + n)), (1e-9, None)
        for j, name in enumerate(names):
            col, lab = x[inside, j], y[inside]
            order = np.argsort(col, kind="stable")
            col, lab = col[order], lab[order]
            cut = np.flatnonzero(np.diff(col) > 0) + 1
            if not len(cut):
                continue
            pos = np.concatenate([[0], np.cumsum(lab)])
            for op, pp, tt in ((">=", p - pos[cut], len(col) - cut), ("<", pos[cut], cut)):
                gain = np.where(pp > 0, pp * (np.log2(np.maximum(pp, 1e-9) / tt) - base), -1)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (name, op, float((col[cut[k] - 1] + col[cut[k]]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= _holds(x, names, [best[1]])
    return rule


def irep(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 7) -> list[list[Condition]]:
    """Ordered rules for the positives."""
    rng, rules = np.random.default_rng(seed), []
    left = np.ones(len(x), dtype=bool)
    while (y & left).any():
        found = None
        for _ in range(8):  # a rare kind of positive may need another split
            parts = [rng.permutation(np.flatnonzero(left & side)) for side in (y, ~y)]
            cuts = [-(-len(p) * 2 // 3) for p in parts]
            grow, prune = np.concatenate([p[:c] for p, c in zip(parts, cuts)]), np.concatenate([p[c:] for p, c in zip(parts, cuts)])
            rule = _grow(x[grow], y[grow], names)

            def worth(r: list[Condition]) -> float:
                h = _holds(x[prune], names, r)
                p, n = (h & y[prune]).sum(), (h & ~y[prune]).sum()
                return (p - n) / (p + n) if p + n else -1.0

            if not rule:
                continue
            rule = rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(rule[:k]), -k))]
            if (len(prune) == 0 or worth(rule) > 0.5) and (_holds(x, names, rule) & left & y).any():
                found = rule
                break
        if found is None:
            break
        rules.append(found)
        left &= ~_holds(x, names, found)
    return rules


def induce(df: DataFrame, common: Iterable[str] | Mapping[str, int], key: str = "doc_id", text: str = "text", labels: str | None = None, sample: int = SAMPLE) -> list[list[Condition]]:
    """Rules from a sample of at most `sample` labelled documents, those of the lowest hash of their text, each text once.

    The sample is measured and labelled on the workers; only its numbers come to the driver.
    """
    masks = languages(common)
    n = max(df.count(), 1)
    cut = int(min(2.0**63 - 1025, -(2.0**63) + 2.0**64 * 2 * sample / n))  # twice the sample, as texts repeat
    full = df.select(F.col(text).alias("t_"), F.xxhash64(text).alias("h_"), (F.col(labels) if labels else F.lit(None)).cast("boolean").alias("y_"))
    taken = full.where((F.col("h_") <= cut) & F.col("t_").rlike(r"\S")).dropDuplicates(["h_"]).orderBy("h_").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, given = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            y = [bool(g) for g in given] if labels else [label(t, masks) for t in texts]
            stats = [[float(v) for v in measure(t, masks)] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(y, pa.bool_()), pa.array(stats, pa.list_(pa.float64()))], ["h", "y", "x"])

    parts = -(-sample // 1000)
    rows = sorted(taken.repartition(parts, "h_").mapInArrow(run, "h long, y boolean, x array<double>").collect())
    at = [STATS.index(f) for f in FEATURES]
    return irep(np.array([[r.x[i] for i in at] for r in rows]), np.array([r.y for r in rows]), FEATURES) if rows else []


def case_sql(rules: list[list[Condition]]) -> str:
    """The ordered rules as SQL over the statistics."""
    whens = " ".join("WHEN " + " AND ".join(f"{n} {op} {v!r}D" for n, op, v in rule) + " THEN true" for rule in rules)
    return f"CASE WHEN n_words + n_lines = 0 THEN false {whens} ELSE false END"


def judge(df: DataFrame, common: Iterable[str] | Mapping[str, int], rules: list[list[Condition]] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The statistics and `no_prose`: more than half list entries, table rows or junk."""
    rules = induce(df, common, key, text) if rules is None else rules
    return statistics(df, common, key, text).withColumn("no_prose", F.expr(case_sql(rules)))
