"""Splitting oversized texts at natural boundaries.

Dynamic programming over boundary positions: a cut costs by the kind of its boundary (paragraph, line, sentence, word,
none), a piece by the square of its distance from the even size, and every piece a constant, so that few pieces of like
size with natural cuts win. No piece is longer than the limit; each piece after the first begins with the last
`overlap` characters of the piece before, or with less, down to the first word boundary among them.

Boundary positions are taken one per cell of `grid` characters, the best of the cell, so the work grows with the length of
the text, and a text without any boundary is cut between characters (not before a combining mark).

Defined results: texts within the limit are one piece, an empty text is one empty piece, a null text one null piece.
Short texts never leave the JVM. Lengths count code points. Repeated rows are split alike; other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cost of a cut by its boundary: paragraph, line, sentence, word, none.
COSTS = (0.0, 0.02, 0.06, 0.25, 4.0)
PIECE_COST = 1.0
BALANCE = 1.0

_SPACES = np.array([*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], dtype=np.uint32)
_ENDS = np.array([ord(c) for c in ".!?…。！？"], dtype=np.uint32)
_CLOSERS = np.array([ord(c) for c in "\"')]»”’"], dtype=np.uint32)
_WIDE_ENDS = np.array([ord(c) for c in "。！？"], dtype=np.uint32)


def kinds(text: str) -> np.ndarray:
    """For every position, the kind of a cut before it: 0 paragraph, 1 line, 2 sentence, 3 word, 4 none."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(cp)
    space = np.isin(cp, _SPACES)
    breaks = (cp == 10) | (cp == 0x2028) | ((cp == 13) & np.append(cp[1:] != 10, True))
    breaks = breaks + 2 * ((cp == 12) | (cp == 0x2029))
    start = np.zeros(n, dtype=bool)
    start[1:] = space[:-1] & ~space[1:]
    out = np.full(n, 4, dtype=np.int8)
    at = np.flatnonzero(start)
    if len(at):
        total = np.concatenate([[0], np.cumsum(breaks)])
        ends = np.flatnonzero(~space)  # the last character before each run of spaces
        before = np.searchsorted(ends, at) - 1
        last = np.where(before >= 0, ends[np.maximum(before, 0)], -1)
        n_breaks = total[at] - total[last + 1]
        closed = (last > 0) & np.isin(cp[last], _CLOSERS)
        final = np.where(closed, cp[np.maximum(last - 1, 0)], cp[np.maximum(last, 0)])
        sentence = (last >= 0) & np.isin(final, _ENDS)
        out[at] = np.select([n_breaks >= 2, n_breaks == 1, sentence], [0, 1, 2], 3)
    wide = np.flatnonzero(np.isin(cp[:-1], _WIDE_ENDS)) + 1
    out[wide] = np.minimum(out[wide], 2)
    return out


def spans(text: str, limit: int = 32_000, overlap: int = 200, grid: int = 256) -> list[tuple[int, int]]:
    """[start, end) of each piece."""
    n = len(text)
    if n <= limit:
        return [(0, n)]
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    grid = max(1, min(grid, (limit - overlap) // 8))
    kind = kinds(text)
    pos = np.arange(1, n)
    # the best boundary of each cell, the last one of a tie
    best = np.lexsort((pos, -kind[1:].astype(np.int16), pos // grid))
    cell = (pos // grid)[best]
    cuts = pos[best][np.append(cell[1:] != cell[:-1], True)]
    word = kind < 4
    for k in range(len(cuts)):  # a hard cut not before a combining mark
        while kind[cuts[k]] == 4 and 0x300 <= ord(text[cuts[k]]) <= 0x36F and cuts[k] > 1:
            cuts[k] -= 1
    cuts = np.unique(cuts)
    starts = np.empty(len(cuts), dtype=np.int64)  # where the piece after each cut starts
    bounds = np.flatnonzero(word)
    for k, c in enumerate(cuts):
        low = max(0, c - overlap)
        i = np.searchsorted(bounds, low)
        starts[k] = bounds[i] if overlap and i < len(bounds) and bounds[i] < c else low
    begin, end = np.concatenate([[0], starts]), np.concatenate([cuts, [n]])
    penalty = np.concatenate([np.array(COSTS)[kind[cuts]], [0.0]])
    even = (n - overlap) / max(1, -(-(n - overlap) // (limit - overlap))) + overlap
    cost, back = np.full(len(begin), np.inf), np.full(len(begin), -1)
    cost[0] = 0.0  # cost[i]: of everything before the piece that starts at begin[i]
    final, final_back = np.inf, -1
    for j in range(len(end)):
        # begin[i] belongs to cut i-1, so a piece that ends at cut j starts at one of begin[0..j]
        i0 = int(np.searchsorted(begin[: j + 1], end[j] - limit))
        if i0 > j:
            continue
        size = end[j] - begin[i0 : j + 1]
        total = cost[i0 : j + 1] + BALANCE * ((size - even) / limit) ** 2 + PIECE_COST + penalty[j]
        i = int(np.argmin(total))
        if j + 1 < len(begin):
            cost[j + 1], back[j + 1] = total[i], i0 + i
        else:
            final, final_back = total[i], i0 + i
    if not np.isfinite(final):
        raise ValueError("no way to cut within the limit")
    out, i, stop = [], final_back, n
    while True:
        out.append((int(begin[i]), int(stop)))
        if i == 0:
            return out[::-1]
        stop, i = cuts[i - 1], back[i]


def split_oversized(df: DataFrame, key: str = "topic_id", text: str = "topic_text", limit: int = 32_000, overlap: int = 200) -> DataFrame:
    """(key, piece_no from 1, n_pieces, start, piece) of every row."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = df.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, t in zip(pdf["key"], pdf["text"]):
                parts = spans(t, limit, overlap)
                out += [(k, i + 1, len(parts), a, t[a:b]) for i, (a, b) in enumerate(parts)]
            yield pd.DataFrame(out, columns=["key", "piece_no", "n_pieces", "start", "piece"])

    long = F.length("text") > limit
    cuts = rows.where(long).mapInPandas(cut, f"key {kind}, piece_no int, n_pieces int, start long, piece string")
    whole = rows.where(~F.coalesce(long, F.lit(False))).select("key", F.lit(1).alias("piece_no"), F.lit(1).alias("n_pieces"), F.lit(0).cast("long").alias("start"), F.col("text").alias("piece"))
    return whole.unionByName(cuts).withColumnRenamed("key", key)
