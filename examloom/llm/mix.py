"""Mixing sources to target weights.

Soft membership: a document of a known source belongs to it; one without a source belongs to all target sources by the
posteriors of a classifier trained on the labelled documents (multinomial naive Bayes over hashed words, counted over all of
them; its log-odds are divided by the square root of the text's length in words, as words of one text aren't independent).
A document of a source without a target weight takes no part.

Rates: projected gradient on the least-squares distance between the expected tokens of each source and its target, over
nonnegative rates of documents not above `max_repeats`. A document's rate depends only on its memberships and cap, and on
the residuals of the steps so far, so no rates are stored between steps: each step is one aggregation over the classes of equal
membership (in 1/QUANTA) and cap, and the final rates replay the residuals in one SQL expression.

A source of the targets without documents can't contribute; the others keep their proportions. The total is the largest at
which no source needs more than its documents times `max_repeats`. Copies: the whole part of the rate, and one more for
documents chosen by systematic sampling along their sizes within (source, group), so shares come close to the targets at
any size and no group is large.

Defined results: null and empty texts have no tokens and no copies; repeated rows count as records of their own; rows with a
null id too. Weights that are null or not positive count as none; caps below one too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examloom.llm.tokens import TOKENIZERS, encoder, vocabulary
from examloom.session import materialise

BUCKETS = 1 << 12
QUANTA = 32
STEPS = 60
GROUP = 2000  # documents in a group of systematic sampling, about


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) & (BUCKETS - 1)


def sizes(df: DataFrame, key: str, text: str, source: str, name: str, folder: str) -> DataFrame:
    """(row_, key, source, n_tokens) of every row."""
    path = vocabulary(name, folder)
    kind, label = df.schema[key].dataType.simpleString(), df.schema[source].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            n = enc.count_batch(batch.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(n, pa.int64())], ["row_", "key", "source", "n_tokens"])

    rows = df.select(F.xxhash64(key, source, text).alias("row_"), F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("text_"))
    return rows.mapInArrow(run, f"row_ long, key {kind}, source {label}, n_tokens long")


def train(df: DataFrame, labels: list[str], text: str, source: str) -> tuple[np.ndarray, np.ndarray]:
    """(log probability of each hashed word by source, log prior) from all labelled rows; the table has a fixed size."""
    place = {s: i for i, s in enumerate(labels)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, known = np.zeros((len(labels), BUCKETS + 1)), {}
        for batch in batches:
            for s, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = []
                for w in (t or "").split():
                    b = known.get(w)
                    if b is None:
                        if len(known) > 200_000:
                            known.clear()
                        b = known[w] = _bucket(w)
                    at.append(b)
                if at:
                    sums[place[s], :BUCKETS] += np.bincount(at, minlength=BUCKETS)
                sums[place[s], BUCKETS] += 1
        flat = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(flat, pa.int64()), pa.array(sums.ravel()[flat])], ["slot", "n"])

    labelled = df.where(F.col(source).isin(labels)).select(F.col(source).alias("s"), F.col(text).alias("t"))
    got = labelled.mapInArrow(count, "slot long, n double").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(len(labels) * (BUCKETS + 1))
    table[got["slot"].to_numpy()] = got["n"].to_numpy()
    table = table.reshape(len(labels), BUCKETS + 1)
    words, docs = table[:, :BUCKETS] + 0.5, table[:, BUCKETS]
    with np.errstate(divide="ignore"):
        return np.log(words / words.sum(axis=1, keepdims=True)), np.log(docs / max(docs.sum(), 1.0))


def posteriors(df: DataFrame, model: tuple[np.ndarray, np.ndarray], key: str, text: str, source: str) -> DataFrame:
    """(row_, p): memberships in 1/QUANTA of the rows without a source."""
    logs, prior = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                words = (t or "").split()
                n = np.bincount([_bucket(w) for w in words], minlength=BUCKETS) if words else np.zeros(BUCKETS)
                score = prior + (logs @ n) / max(1.0, len(words)) ** 0.5
                e = np.exp(score - score.max()) if np.isfinite(score.max()) else np.zeros(len(prior))
                p = e / e.sum() if e.sum() else e
                q = np.floor(p * QUANTA).astype(int)
                if p.sum():  # largest remainders
                    for k in np.argsort(q - p * QUANTA, kind="stable")[: QUANTA - q.sum()]:
                        q[k] += 1
                out.append(q.tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32()))], ["row_", "p"])

    bare = df.where(F.col(source).isNull()).select(F.xxhash64(key, source, text).alias("row_"), F.col(text).alias("t"))
    return bare.mapInArrow(run, "row_ long, p array<int>").dropDuplicates(["row_"])


def _dot(p: Column, values: list[float]) -> Column:
    return sum((p[i] * F.lit(float(v)) for i, v in enumerate(values)), F.lit(0.0)) / QUANTA


def _rate(start: Column, p: Column, cap: Column, steps: list[list[float]]) -> Column:
    """Replays the projected steps."""
    if not steps:
        return start
    history = F.array(*[F.array(*[F.lit(float(v)) for v in s]) for s in steps])
    move = lambda step: F.aggregate(F.zip_with(p, step, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y) / QUANTA
    return F.aggregate(history, start, lambda r, step: F.least(cap, F.greatest(F.lit(0.0), r + move(step))))


def rates(classes: DataFrame, weights: list[float], total: float) -> list[list[float]]:
    """The steps of the projected gradient. classes: (p, cap, n_tokens)."""
    goal = [w * total for w in weights]
    supply = [float(v) for v in classes.agg(*[F.sum(F.col("n_tokens") * F.col("p")[i] / QUANTA) for i in range(len(weights))]).first()]
    steps: list[list[float]] = []
    start, cap = F.lit(0.0), F.col("cap").cast("double")
    for _ in range(STEPS):
        rate = _rate(start, F.col("p"), cap, steps)
        got = classes.agg(*[F.sum(rate * F.col("n_tokens") * F.col("p")[i] / QUANTA) for i in range(len(weights))]).first()
        gap = [g - float(v or 0.0) for g, v in zip(goal, got)]
        if all(abs(d) <= 1e-6 * total for d in gap):
            break
        steps.append([d / s if s > 0 else 0.0 for d, s in zip(gap, supply)])
    return steps


def mix(
    df: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", name: str = "byte_bpe_50k", folder: str = TOKENIZERS
) -> tuple[DataFrame, DataFrame]:
    """(key, source, n_tokens, copies) of every row, and the report (source, target_weight, wanted, tokens, share, residual, documents, repeated).

    wanted: the target among the sources that have documents; residual: what the share is beyond it, so a fit that stopped early shows.
    """
    wanted = sorted((r.source, float(r.target_weight), int(r.max_repeats or 0)) for r in targets.collect() if r.source is not None and (r.target_weight or 0) > 0 and (r.max_repeats or 0) >= 1)
    labels, weights, caps = [w[0] for w in wanted], [w[1] for w in wanted], [w[2] for w in wanted]
    sized = materialise(sizes(df, key, text, source, name, folder), "sizes")
    soft = posteriors(df, train(df, labels, text, source), key, text, source)
    own = F.array(*[F.when(F.col("source") == s, F.lit(QUANTA)).otherwise(F.lit(0)) for s in labels]).cast("array<int>")
    none = F.array(*[F.lit(0)] * len(labels)).cast("array<int>")
    cap_of = F.coalesce(*[F.when(F.col("source") == s, F.lit(c)) for s, c in zip(labels, caps)], F.lit(None).cast("int")) if labels else F.lit(0)
    # a document without a source may be used as often as the strictest of its sources allows
    strict = F.array_min(F.transform(F.arrays_zip(F.col("p").alias("m"), F.array(*[F.lit(c) for c in caps]).alias("c")), lambda x: F.when(x["m"] > 0, x["c"])))
    docs = sized.join(soft, "row_", "left").withColumn("p", F.when(F.col("source").isin(labels), own).otherwise(F.coalesce("p", none)))
    docs = docs.withColumn("cap", F.coalesce(cap_of, strict, F.lit(0)))
    docs = materialise(docs, "memberships")
    classes = materialise(docs.where("n_tokens > 0 AND cap > 0").groupBy("p", "cap").agg(F.sum("n_tokens").alias("n_tokens")), "classes")
    most = classes.agg(*[F.coalesce(F.sum(F.col("n_tokens") * F.col("cap") * F.col("p")[i] / QUANTA), F.lit(0.0)) for i in range(len(labels))]).first() if labels else []
    able = [w if float(m) > 0 else 0.0 for w, m in zip(weights, most)]
    scale = sum(able)
    share = [w / scale if scale else 0.0 for w in able]
    total = min((float(m) / s for m, s in zip(most, share) if s > 0), default=0.0)
    steps = rates(classes, share, total) if total else []
    rate = _rate(F.lit(0.0), F.col("p"), F.col("cap").cast("double"), steps) if steps else F.lit(0.0)
    rated = docs.withColumn("rate", F.when((F.col("n_tokens") > 0) & (F.col("cap") > 0), F.round(rate, 9)).otherwise(0.0))
    # systematic sampling in groups of bounded size
    groups = max(1, -(-sized.count() // GROUP))
    rated = rated.withColumn("group_", F.pmod(F.xxhash64(F.col("row_"), F.lit("g")), F.lit(groups)))
    line = Window.partitionBy("source", "group_").orderBy("n_tokens", F.xxhash64("row_"), "row_", "key")
    part = F.col("rate") - F.floor("rate")
    rated = rated.withColumn("run_", F.sum(part).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    offset = F.pmod(F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit("")), "group_"), F.lit(1_000_000)) / 1_000_000
    more = F.floor(F.col("run_") + offset) - F.floor(F.col("run_") - part + offset)
    copies = F.least(F.col("cap").cast("long"), F.floor("rate") + more)
    out = rated.select(F.col("key").alias(key), F.col("source").alias(source), "n_tokens", F.when(F.col("rate") > 0, copies).otherwise(0).cast("int").alias("copies"), "p")
    out = materialise(out, "mix")
    used = out.where("copies > 0").withColumn("t_", (F.col("n_tokens") * F.col("copies")).cast("double"))
    expected = used.agg(*[F.coalesce(F.sum(F.col("t_") * F.col("p")[i] / QUANTA), F.lit(0.0)).alias(f"s{i}") for i in range(len(labels))]).first() if labels else []
    named = used.groupBy(source).agg(F.sum("t_").alias("t"), F.count("*").alias("d"), F.sum((F.col("copies") > 1).cast("int")).alias("r"))
    known = {r[source]: r for r in named.where(F.col(source).isin(labels)).collect()} if labels else {}
    grand = sum(map(float, expected)) or 1.0
    report = [(s, w, round(h, 9), float(e), round(float(e) / grand, 9), round(float(e) / grand - h, 9), int(known[s].d) if s in known else 0, int(known[s].r) if s in known else 0) for s, w, h, e in zip(labels, weights, share, expected)]
    schema = f"{source} string, target_weight double, wanted double, tokens double, share double, residual double, documents long, repeated long"
    return out.drop("p"), df.sparkSession.createDataFrame(report, schema)
