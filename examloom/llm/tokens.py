"""Encoding texts with a public byte-level BPE tokenizer, by speculation and verification.

Speculate: each word (a piece of the tokenizer's split pattern) is covered by greedy longest match over the vocabulary.
Verify: a sequence of tokens is what the merges give if and only if every adjacent pair is compatible, that is, merging the
bytes of the two gives the two again. Compatibility is tested for all pairs of all new words at once with arrays: the pair
is followed back through the merges that made its tokens, and fails where a merge across the boundary would have come
first. Only words with a failing pair are merged exactly.

Encoded words are kept per worker, with the punctuation beside them, in a dictionary of bounded size.

Defined results: null and empty texts have the empty list of ids. Special tokens' strings are ordinary text. Unpaired
surrogates can't occur in Spark strings. Repeated rows are encoded alike.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
CACHE_CHUNKS = 400_000

# The split pattern, and Unicode's white space.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The split pattern never joins across the ends of these chunks, so texts are cut into them first, and chunks are cached.
CHUNK = f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
#: The same where none of the separators occurs that only Python counts as white space.
FAST_CHUNK = r" ?\S+|\s+(?!\S)|\s+"


class Encoder:
    def __init__(self, path: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.size = max(self.ranks.values()) + 1
        self.longest = max(map(len, self.ranks))
        self.bytes = {i: b for b, i in self.ranks.items()}
        # the merge that makes each token; a token of one byte, or one that merging never gives, has none
        self.left, self.right = np.arange(self.size), np.arange(self.size)
        merges: dict[tuple[int, int], int] = {}
        odd = []
        for token, rank in self.ranks.items():
            if len(token) > 1:
                parts = self.merge(token, below=rank)
                if len(parts) == 2:
                    self.left[rank], self.right[rank] = parts
                    merges[tuple(parts)] = rank
                else:
                    odd.append(rank)
        self.odd = frozenset(odd)
        pairs = sorted((a * self.size + b, r) for (a, b), r in merges.items())
        self.pair_keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], dtype=np.int64)
        self.split = regex.compile(PATTERN)
        self.exact_chunks, self.fast_chunks, self.separators = re.compile(CHUNK).findall, re.compile(FAST_CHUNK).findall, re.compile("[\x1c-\x1f]").search
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, word: bytes, below: int | None = None) -> list[int]:
        """The exact merges, lowest rank first; with below, only merges of lower rank."""
        parts = [self.ranks[word[i : i + 1]] for i in range(len(word))]
        texts = [word[i : i + 1] for i in range(len(word))]
        below = self.size if below is None else below
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, self.size) for a, b in zip(texts, texts[1:])]
            r = min(ranks)
            if r >= below:
                break
            new_parts, new_texts, i = [], [], 0
            while i < len(parts):
                if i < len(ranks) and ranks[i] == r:
                    new_parts.append(r)
                    new_texts.append(texts[i] + texts[i + 1])
                    i += 2
                else:
                    new_parts.append(parts[i])
                    new_texts.append(texts[i])
                    i += 1
            parts, texts = new_parts, new_texts
        return parts

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, i, ranks = [], 0, self.ranks
        while i < len(word):
            for j in range(min(len(word), i + self.longest), i, -1):
                r = ranks.get(word[i:j])
                if r is not None:
                    out.append(r)
                    i = j
                    break
        return out

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; size where there is none."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], self.size)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of each pair gives the pair again.

        Going back in time, the token made last is undone first; `now` is the rank reached. A merge of the two
        tokens at the boundary that comes before `now` would have joined them. Of equal ranks on both sides the
        left one is made first, so the right one is undone first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        ok, open_ = np.ones(len(a), dtype=bool), np.arange(len(a))
        now = np.full(len(a), self.size, dtype=np.int64)
        while len(open_):
            x, y, t = a[open_], b[open_], now[open_]
            r = self.rank_of(x, y)
            clash = r < t
            ok[open_[clash]] = False
            x_single, y_single = self.left[x] == x, self.left[y] == y
            done = clash | (x_single & y_single)
            # undo the token with the higher rank
            undo_x = ~x_single & (y_single | (x > y))
            nx = np.where(undo_x, self.right[x], x)
            ny = np.where(undo_x, y, self.left[y])
            # after undoing x of rank t, merges across at rank < t come before it; after undoing y, those at rank <= t
            nt = np.where(undo_x, x, y + 1)
            keep = ~done
            open_ = open_[keep]
            a[open_], b[open_], now[open_] = nx[keep], ny[keep], nt[keep]
        return ok

    def learn(self, chunks: list[str]) -> None:
        """Encode new chunks into the cache."""
        split = [self.split.findall(c) for c in chunks]
        words = list(set().union(*split))
        raw = [w.encode() for w in words]
        proposed = [self.propose(w) for w in raw]
        sizes = [len(p) for p in proposed]
        flat = np.fromiter((t for p in proposed for t in p), dtype=np.int64, count=sum(sizes))
        word = np.repeat(np.arange(len(words)), sizes)
        inner = word[1:] == word[:-1]
        failing = set()
        if inner.any():
            keys, where = np.unique(flat[:-1][inner] * self.size + flat[1:][inner], return_inverse=True)
            good = self.compatible(keys // self.size, keys % self.size)
            failing = set(word[1:][inner][~good[where]].tolist())
        if self.odd:
            failing |= {k for k, p in enumerate(proposed) if not self.odd.isdisjoint(p)}
        known = {w: self.exact(raw[k]) if k in failing else p for k, (w, p) in enumerate(zip(words, proposed))}
        for c, ws in zip(chunks, split):
            self.cache[c] = tuple(known[ws[0]]) if len(ws) == 1 else tuple(t for w in ws for t in known[w])

    def exact(self, word: bytes) -> list[int]:
        """Exact merging; a long word by a heap, as the plain way takes quadratic time."""
        return self.merge(word) if len(word) <= 64 else self.merge_long(word)

    def merge_long(self, word: bytes) -> list[int]:
        import heapq

        n = len(word)
        text = [word[i : i + 1] for i in range(n)]
        nxt, prv, ranks = list(range(1, n + 1)), list(range(-1, n - 1)), self.ranks
        heap = [(r, i, text[i] + text[i + 1]) for i in range(n - 1) if (r := ranks.get(text[i] + text[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = nxt[i] if text[i] is not None else n
            if j >= n or text[i] + text[j] != both:
                continue
            text[i], text[j] = both, None
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if (r := ranks.get(both + text[nxt[i]])) is not None:
                    heapq.heappush(heap, (r, i, both + text[nxt[i]]))
            if prv[i] >= 0 and (r := ranks.get(text[prv[i]] + both)) is not None:
                heapq.heappush(heap, (r, prv[i], text[prv[i]] + both))
        return [ranks[t] for t in text if t is not None]

    def chunks(self, text: str) -> list[str]:
        return self.exact_chunks(text) if self.separators(text) else self.fast_chunks(text)

    def encode_batch(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """Ids of all texts in one list, and where each text ends."""
        split = [self.chunks(t) if t else [] for t in texts]
        out, ends, a = [], [], 0
        while a < len(split):  # as many texts at once as the cache can hold
            need, b = set(), a
            while b < len(split) and (b == a or len(need) < CACHE_CHUNKS // 4):
                need.update(split[b])
                b += 1
            new = list(need - self.cache.keys())
            if len(self.cache) + len(new) > CACHE_CHUNKS:
                self.cache.clear()
                new = list(need)
            if new:
                self.learn(new)
            get = self.cache.__getitem__
            for cs in split[a:b]:
                out.extend(chain.from_iterable(map(get, cs)))
                ends.append(len(out))
            a = b
        return out, ends

    def count_batch(self, texts: list[str | None]) -> list[int]:
        _, ends = self.encode_batch(texts)
        return [b - a for a, b in zip([0, *ends], ends)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> str:
    return os.path.join(folder, f"{name}.tiktoken")


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(key, ids) of every row."""
    path = vocabulary(name, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ids, ends = enc.encode_batch(batch.column(1).to_pylist())
            offsets = pa.array(np.array([0, *ends], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(np.array(ids, dtype=np.int32)))], [key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(text).alias("text_")).mapInArrow(run, f"{key} {kind}, ids array<int>")
