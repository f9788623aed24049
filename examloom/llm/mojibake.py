"""Text read with the wrong character encoding: found, and restored where the characters survive.

A character trigram model of the words that hold non-ASCII characters is trained on the clean records of the corpus: those in
which no run of characters is UTF-8 read by another code page, and which hold no replacement or C1 control character. Each
such word of any record is then scored as it stands and as every encode-decode chain would restore it; the likeliest chain
is accepted if it beats the word as it stands by a margin. The margin is validated on words known to be right: those that come
out of strictly valid UTF-8 in the other records. It is the smallest at which no more than `FALSE_RATE` of them would be
changed again. Words of a record in which a chain was accepted
need no margin for the same chain.

Words without non-ASCII characters never leave the JVM's filter. Model and margin come from all records; counts are kept in
a fixed number of hash buckets, so what is sent to the workers doesn't grow with the corpus.

Defined results: null, empty and ASCII texts are not garbled and unchanged. A record with U+FFFD or a C1 control character
is garbled even where nothing can be restored. Repeated rows are treated alike; extra columns are dropped.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.session import materialise

BUCKETS = 1 << 18
FALSE_RATE = 0.002
LEAST_MARGIN = 2.0
CACHE = 200_000

#: A word that holds a non-ASCII character, between ASCII white space or controls.
WORD = re.compile("(?<![^\x00-\x20])[\x21-\x7f]*+[^\x00-\x7f][^\x00-\x20]*+")
LOST = re.compile("[�\x80-\x9f]")
PRIVATE = re.compile("[\ue000-\uf8ff]")
PAGES = ("cp1252", "latin_1", "mac_roman", "cp437", "cp850", "cp1251", "cp1250")
RIGHT = ("utf_8", "cp1252", "mac_roman", "cp437", "cp850")


def _encode(text: str, page: str) -> bytes | None:
    """Bytes in the code page; in cp1252 and its kin the five bytes without a character are C1 controls."""
    try:
        return text.encode(page)
    except UnicodeEncodeError:
        if not page.startswith("cp125"):
            return None
    out = bytearray()
    for c in text:
        try:
            out += c.encode(page)
        except UnicodeEncodeError:
            if not 0x80 <= ord(c) <= 0x9F:
                return None
            out.append(ord(c))
    return bytes(out)


def undo(text: str, page: str, right: str) -> str | None:
    """The text whose bytes, written in `right`, were read as `page`."""
    raw = _encode(text, page)
    if raw is None:
        return None
    try:
        return raw.decode(right)
    except UnicodeDecodeError:
        return None


def candidates(word: str) -> dict[tuple, str]:
    """Chain → restored word; chains through UTF-8 up to three times."""
    out: dict[tuple, str] = {}
    for page in PAGES:
        for right in RIGHT:
            if page == right:
                continue
            fixed = undo(word, page, right)
            if fixed is None or fixed == word or PRIVATE.search(fixed) or right != "utf_8" and LOST.search(fixed):
                continue
            chain = (page, right)
            if right == "utf_8":
                for _ in range(3):
                    if not LOST.search(fixed):
                        out.setdefault(chain, fixed)
                    again = next((g for p in PAGES[:2] if (g := undo(fixed, p, "utf_8")) not in (None, fixed)), None)
                    if again is None:
                        break
                    fixed, chain = again, (*chain, "again")
            else:
                out[chain] = fixed
    return out


def _utf8_seen() -> re.Pattern:
    """A two- or three-byte UTF-8 sequence as any of the code pages shows it."""
    parts = []
    for page in PAGES:
        shown = {b: bytes([b]).decode(page, "replace") for b in range(0x80, 0x100)}
        if page.startswith("cp125"):
            shown = {b: chr(b) if c == "�" else c for b, c in shown.items()}
        cls = lambda lo, hi: "[" + "".join(re.escape(shown[b]) for b in range(lo, hi + 1) if shown[b] != "�") + "]"  # noqa: E731,B023
        parts += [cls(0xC2, 0xDF) + cls(0x80, 0xBF), cls(0xE0, 0xEF) + cls(0x80, 0xBF) + "{2}"]
    return re.compile("|".join(parts))


UTF8_SEEN = _utf8_seen()
#: What such a sequence must stand for to count: Latin, Greek, Cyrillic, punctuation, currency, letterlike, arrows, mathematics.
LIKELY = re.compile("[\xa0-\u017f\u0391-\u03c9\u0410-\u044f\u2010-\u203a\u20a0-\u20bf\u2100-\u22ff]")


def looks_garbled(text: str) -> bool:
    """Whether the record is kept out of the clean ones."""
    if LOST.search(text):
        return True
    for m in UTF8_SEEN.finditer(text):
        for page in PAGES:
            c = undo(m.group(), page, "utf_8")
            if c and LIKELY.fullmatch(c):
                return True
    return False


_DIGITS = str.maketrans("123456789", "000000000")
_PADDED = "\x02\x02{}\x03"


def fold(word: str) -> str:
    """The word with like digits, so that amounts are one type."""
    return re.sub("0[0.,]*", "0", word.translate(_DIGITS))


def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def grams(word: str) -> list[tuple[int, int, int, int]]:
    """Buckets of each trigram, its context, its bigram and its character."""
    w = _PADDED.format(word)
    return [(_bucket(w[i - 2 : i + 1]), _bucket("c" + w[i - 2 : i]), _bucket("b" + w[i - 1 : i + 1]), _bucket("u" + w[i])) for i in range(2, len(w))]


class Model:
    """Interpolated trigrams with Witten-Bell-like weights."""

    def __init__(self, buckets: np.ndarray, counts: np.ndarray, total: float, margin: float = LEAST_MARGIN):
        self.counts = np.zeros(BUCKETS, dtype=np.float64)
        self.counts[buckets] = counts
        self.total, self.margin = max(total, 1.0), margin
        self.cache: dict[str, tuple] = {}

    def score(self, word: str) -> float:
        c, out = self.counts, 0.0
        w = _PADDED.format(fold(word))
        for i in range(2, len(w)):
            uni = (c[_bucket("u" + w[i])] + 0.05) / (self.total + 5000 * 0.05)
            bi = (c[_bucket("b" + w[i - 1 : i + 1])] + 2 * uni) / (c[_bucket("u" + w[i - 1])] + 2)
            tri = (c[_bucket(w[i - 2 : i + 1])] + 2 * bi) / (c[_bucket("c" + w[i - 2 : i])] + 2)
            out += math.log(min(max(tri, 1e-12), 1.0))
        return out

    def options(self, word: str) -> tuple[tuple, str, float, dict]:
        """(best chain, restored, gain, gains of all chains); a chain through UTF-8 is preferred on a tie."""
        found = self.cache.get(word)
        if found is None:
            own, gains = self.score(word), {}
            hyphenated = word.rstrip("¬\xad").isascii()  # a break at the end of a line
            for chain, fixed in (() if hyphenated else candidates(word).items()):
                gains[chain] = (self.score(fixed) - own, fixed)
            if gains:
                best = max(gains, key=lambda k: (gains[k][0], "utf_8" in k, k))
                found = (best, gains[best][1], gains[best][0], gains)
            else:
                found = ((), word, -math.inf, gains)
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = found
        return found

    def restore(self, text: str) -> tuple[bool, str]:
        """(garbled, restored text)."""
        words = set(WORD.findall(text))
        fixes, chains = {}, set()
        for w in words:
            chain, fixed, gain, _ = self.options(w)
            if gain > self.margin:
                fixes[w] = fixed
                chains.add(chain)
        if chains:
            for w in words - fixes.keys():
                gains = self.options(w)[3]
                near = max(((gains[c][0], c) for c in chains if c in gains), default=(0.0, ()))
                if near[0] > 0:
                    fixes[w] = gains[near[1]][1]
        garbled = bool(fixes) or bool(LOST.search(text))
        return garbled, WORD.sub(lambda m: fixes.get(m.group(), m.group()), text) if fixes else text


def _foreign(df: DataFrame, text: str) -> DataFrame:
    return df.where(F.col(text).rlike(r"[^\x00-\x7F]"))


def train(df: DataFrame, text: str = "topic_text") -> Model:
    """Model and margin from all records."""

    def types(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clean, known = Counter(), Counter()

        def out() -> pd.DataFrame:
            pdf = pd.DataFrame({"word": [*clean, *known], "n": [*clean.values(), *known.values()], "clean": [True] * len(clean) + [False] * len(known)})
            clean.clear()
            known.clear()
            return pdf

        for pdf in batches:
            for t in pdf["t"]:
                if not looks_garbled(t):
                    clean.update(map(fold, WORD.findall(t)))
                    continue
                for w in map(fold, WORD.findall(t)):
                    fixed = [f for chain, f in candidates(w).items() if chain[1] == "utf_8" and not f.isascii()]
                    if len(set(fixed)) == 1 and not looks_garbled(fixed[0]):
                        known[fixed[0]] += 1
            if len(clean) + len(known) > CACHE:
                yield out()
        yield out()

    foreign = _foreign(df, text).select(F.col(text).alias("t"))
    words = materialise(foreign.mapInPandas(types, "word string, n long, clean boolean").groupBy("word", "clean").agg(F.sum("n").alias("n")), "words")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(BUCKETS + 1)
        for pdf in batches:
            for w, n in zip(pdf["word"], pdf["n"]):
                for at in grams(w):
                    for b in at:
                        sums[b] += n
                    sums[BUCKETS] += n
        at = np.flatnonzero(sums)
        yield pd.DataFrame({"bucket": at.astype("int32"), "n": sums[at]})

    got = words.where("clean").select("word", "n").mapInPandas(count, "bucket int, n double").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    at, n = got["bucket"].to_numpy(), got["n"].to_numpy()
    model = Model(at[at < BUCKETS], n[at < BUCKETS], float(n[at == BUCKETS].sum()))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def gains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"step": [int(10 * min(40.0, max(0.0, shared.value.options(w)[2]))) for w in pdf["word"]]}, dtype="int32")

    steps = words.where("NOT clean").select("word").mapInPandas(gains, "step int").groupBy("step").count().toPandas().sort_values("step", ascending=False)
    over = steps["step"][steps["count"].cumsum() > FALSE_RATE * steps["count"].sum()]
    if len(over):
        model.margin = max(LEAST_MARGIN, (float(over.iloc[0]) + 1) / 10)
    model.cache.clear()
    return model


def repair(df: DataFrame, key: str = "topic_id", text: str = "topic_text", model: Model | None = None) -> DataFrame:
    """(key, garbled, restored) of every row."""
    model = train(df, text) if model is None else model
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("t"))
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            both = [m.restore(t) for t in pdf["t"]]
            yield pd.DataFrame({"key": pdf["key"], "garbled": [b[0] for b in both], "restored": [b[1] for b in both]})

    foreign = rows.where(F.col("t").rlike(r"[^\x00-\x7F]")).mapInPandas(run, f"key {kind}, garbled boolean, restored string")
    plain = rows.where(~F.coalesce(F.col("t").rlike(r"[^\x00-\x7F]"), F.lit(False))).select("key", F.lit(False).alias("garbled"), F.col("t").alias("restored"))
    return plain.unionByName(foreign).withColumnRenamed("key", key)
