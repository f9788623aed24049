"""Noise of scanned pages: found and repaired into continuous paragraphs.

A noisy channel: the probability that a character was misread (first guesses in `CONFUSIONS`, re-estimated from the corpus) times
the likelihood of the words (unigrams and bigrams of the corpus, counted exactly). Every line with a doubtful word is
decoded by Viterbi over the candidate words of each place; a word is misread where the best path differs from what
stands there. Figures with letters in them are decoded the same way. Words broken at a line end or by a space are joined if the corpus knows the whole better than the parts; a compound
wrapped at its own hyphen stays. Running headers, page numbers and spaced-out words are told by their form and place.

Probabilities are estimated by expectation and maximisation over the distinct words: what share of each word's occurrences came from
which printed word by which confusions, against how often the printed characters stand in the corpus; the first guesses keep half
the weight. All limits are shares of the
corpus or ratios of counts, so a larger corpus of the same kind gives the same answers; words longer than any known one are no
misreading of one.

Slips of typing have no path through the channel, so they stay. Wrong encoding alone doesn't count.

Counts are taken over all rows, by keys of 64 bits that are kept, so no word answers for another. Stored for the workers are the words
with a letter, the other words seen twice or more, and the pairs of words seen twice or more: a word seen once stands in one pair
before and one after it, those of its own place, so what is left out is known to be 1 there and 0 elsewhere. Workers write the counts as
files of the shared folder, in parts, and map these into memory, so neither the driver nor a worker's own memory holds them.

Defined results: null, empty and blank texts hold no noise and stay. Repeated rows are treated alike; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.session import materialise, scratch

#: Pairs of words that a worker counts before it hands them on, and entries of each of its caches: two workers share what an executor has beside its heap.
FLUSH, CACHE = 200_000, 100_000
MASK, SIGN = (1 << 64) - 1, 1 << 63
#: Keys of a part of the stored counts, at most about so many; the bits of a key from which its part is taken, above those that find its slot.
PART, PART_BITS = 2_000_000, 40

# What is seen, what was printed, and the first guess of how often.
CONFUSIONS = [
    ("1", "l", 0.002), ("1", "i", 0.001), ("|", "l", 0.001), ("|", "i", 0.001), ("!", "i", 0.001), ("!", "l", 0.0005), ("0", "o", 0.002), ("5", "s", 0.002),
    ("9", "g", 0.001), ("@", "a", 0.001), ("c", "e", 0.001), ("rn", "m", 0.001), ("cl", "d", 0.001), ("ii", "u", 0.001), ("h", "li", 0.0005),
    ("l", "i", 0.001), ("vv", "w", 0.0005), ("8", "b", 0.0005), ("6", "b", 0.0005), ("m", "rn", 0.0003), ("d", "cl", 0.0003), ("$", "s", 0.0005), ("2", "z", 0.0003), ("li", "h", 0.0003), ("3", "e", 0.0002), ("4", "a", 0.0002), ("(", "c", 0.0002), ("€", "e", 0.0002), ("¢", "c", 0.0002),
]
EDGES = ".,;:()[]{}\"'“”‘’…•–—?*<>/\\&#%"
ODD = re.compile(r"[a-z][0-9|!@$][a-z]|^[0-9|!@][a-z]{2,}|[a-z]{2,}[0-9|@]$|[a-z][|!@]")
FIGURES = re.compile(r"[$(]?(?:[\d.,/-]*\d[.,/-]?[OlI]|[OlI]+[.,/-]?\d)[OlI\d.,/-]*%?")
LOW_FIGURES = re.compile(FIGURES.pattern.replace("OlI", "oli"))
DIGITS = str.maketrans("OlI", "011")
SOFT = re.compile("[A-Za-z][¬\xad]\\s*[A-Za-z]")
WRAPPED = re.compile(r"(?<=[^\W\d_])-(?:[ \t]*\r?\n[ \t]*| )(?=[^\W\d_])")
HEAD = re.compile(r"[^\W\d_]+")
SPACED = re.compile(r"(?<![^\s_])[A-Za-z](?: [A-Za-z]){3,}(?![^\s_.,;:])")
NUMBER = r"(?:[\[(]?[-–]?\s*(?:[0-9OIl]{1,4}|[ivxlIVXL]{1,6})\s*[-–]?[\])]?)"
PAGE = re.compile(rf"(?:p\s?a\s?g\s?e|pg)\.?\s*{NUMBER}(?:\s+of\s+[0-9OIl]+)?\.?|{NUMBER}|{NUMBER}\s+of\s+[0-9OIl]+", re.I)
MARKED = re.compile(r"^\s*(?:CONFIDENTIAL\s{3,}|Report of Examination\s{3,})|\((?:cont(?:inued|'d|d)?\.?)\)|\s-\scontinued\b", re.I)
TITLE_WORD = r"(?:[A-Z0-9|!@][\w.'’|!@&-]*|of|and|to|for|the|in|on|&|-)"
TITLE = re.compile(rf"\f?\s*{TITLE_WORD}(?:[ ]{TITLE_WORD})+\s*")
TRAILED = re.compile(rf"\f?\s*{TITLE_WORD}(?:[ ]{TITLE_WORD})+\s{{3,}}(?:(?:p\s?a\s?g\s?e|pg)\.?\s*)?{NUMBER}(?:\s+of\s+\d+)?\.?\s*", re.I)
# Entries of a table of contents
ENTRY_HEAD = re.compile(r"^\s*(?:TABLE OF CONTENTS\s{2,}|Confidential\s{2,}\S{1,4}\s{2,}|Page\s+\S{1,4}\s{2,}|-\s*\d{1,3}\s*-\s+)", re.I)
ENTRY_ODD = re.compile(r"[A-Za-z][|!@][A-Za-z]|[A-Za-z]{2}[01589][a-z]")
ENTRY_TAIL = re.compile(r"(?:(?:\s*[._•…·]){3,}\s*|\s{4,})(?:[0-9OIlSB]{1,4}|[ivxl]{1,6})\s*$")


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True) or 1


def _pair(a: int, b: int) -> int:
    """The key of two words beside each other."""
    x = (a * 0x9E3779B97F4A7C15 ^ b) * 0xC2B2AE3D27D4EB4F & MASK
    x ^= x >> 32
    return (x ^ SIGN) - SIGN or 1


class Counts:
    """Key → count, exact: slots for twice the keys or more, each with its key, the next free one taken on a clash."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.mask = (1 << max(4, int(len(keys) * 2).bit_length())) - 1
        self.keys, self.n = np.zeros(self.mask + 1, dtype=np.int64), np.zeros(self.mask + 1, dtype=np.float32)
        left, at = np.arange(len(keys)), keys & self.mask
        while len(left):
            free = self.keys[at] == 0
            slots, first = np.unique(at[free], return_index=True)
            won = left[free][first]
            self.keys[slots], self.n[slots] = keys[won], n[won]
            rest = self.keys[at] != keys[left]
            left, at = left[rest], (at[rest] + 1) & self.mask

    @classmethod
    def mapped(cls, path: str) -> Counts:
        """Those of a file: the keys of all slots, then the counts."""
        found, slots = cls.__new__(cls), os.path.getsize(path) // 12
        found.mask = slots - 1
        found.keys = np.memmap(path, np.int64, "r", shape=(slots,)).view(np.ndarray)
        found.n = np.memmap(path, np.float32, "r", offset=8 * slots, shape=(slots,)).view(np.ndarray)
        return found

    def __getitem__(self, key: int) -> float:
        at = key & self.mask
        while found := self.keys.item(at):
            if found == key:
                return self.n.item(at)
            at = (at + 1) & self.mask
        return 0.0


def _filesystem(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


class Stored:
    """Counts in files of a shared folder, one for each of its parts but the empty ones, opened when first asked."""

    def __init__(self, folder: str, parts: int, full: frozenset[int]):
        self.folder, self.last, self.full = folder, parts - 1, full
        self.opened: dict[int, Counts] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"opened": {}}

    def __getitem__(self, key: int) -> float:
        part = key >> PART_BITS & self.last
        found = self.opened.get(part)
        if found is None:
            found = self.opened[part] = self._open(part)
        return found[key]

    def _open(self, part: int) -> Counts:
        if part not in self.full:
            return Counts(np.zeros(0, dtype=np.int64), np.zeros(0))
        files, folder = _filesystem(self.folder)
        if isinstance(files, pyarrow.fs.LocalFileSystem):
            return Counts.mapped(f"{folder}/{part}")
        # from elsewhere a copy; its name goes at once, the file with the last process that has it open
        handle, path = tempfile.mkstemp()
        try:
            with os.fdopen(handle, "wb") as to, files.open_input_stream(f"{folder}/{part}") as source:
                while block := source.read(1 << 24):
                    to.write(block)
            return Counts.mapped(path)
        finally:
            os.unlink(path)


def stored(rows: DataFrame, most: int) -> Stored:
    """The counts of different keys (key, n), of which there are at most so many."""
    parts, folder = 1 << max(3, (most // PART).bit_length()), scratch(rows.sparkSession, "counts")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        part, counts = int(pdf["part"].iloc[0]), Counts(pdf["key"].to_numpy(), pdf["n"].to_numpy())
        files, to = _filesystem(folder)
        files.create_dir(to, recursive=True)
        own = f"{to}/.{part}-{uuid.uuid4().hex}"  # a task may run twice
        with files.open_output_stream(own) as out:
            out.write(memoryview(counts.keys).cast("B"))
            out.write(memoryview(counts.n).cast("B"))
        files.move(own, f"{to}/{part}")
        return pd.DataFrame({"part": [part]})

    part = F.shiftright("key", PART_BITS).bitwiseAND(F.lit(parts - 1)).cast("int")
    full = rows.select("key", "n", part.alias("part")).groupBy("part").applyInPandas(write, "part int").collect()
    return Stored(folder, parts, frozenset(r.part for r in full))


def _core(word: str) -> str:
    return word.strip(EDGES).lower()


class Channel:
    """Corpus counts, confusion probabilities, and decoding. longest: letters of the longest word that others may be misread from;
    top: count of the most frequent word of six letters or more."""

    def __init__(self, uni: Counts | Stored, bi: Counts | Stored, total: float, longest: int = 40, top: float = 0.0, odds: list[float] | None = None):
        self.uni, self.bi, self.total, self.longest, self.top = uni, bi, max(total, 1.0), longest, top
        self.odds = odds or [p for _, _, p in CONFUSIONS]
        self.confusions = {(seen, true): (k, math.log(p)) for k, ((seen, true, _), p) in enumerate(zip(CONFUSIONS, self.odds))}
        self.cache: dict[str, tuple] = {}
        self.keys: dict[str, int] = {}
        self.good: set[str] = set()

    def count(self, word: str) -> float:
        """How often the corpus has the word; a word without a letter that isn't kept stands where it is asked for, once."""
        if not word:
            return 0.0
        return self.uni[self.key(word)] or (0.0 if any(map(str.isalpha, word)) else 1.0)

    def beside(self, u: str, v: str, seen: bool) -> float:
        """How often the corpus has the pair; seen: it stands in the text itself."""
        if seen and (self.count(u) == 1 or self.count(v) == 1):
            return 1.0
        return self.bi[_pair(self.key(u), self.key(v))]

    def key(self, word: str) -> int:
        found = self.keys.get(word)
        if found is None:
            if len(self.keys) >= CACHE:
                self.keys.clear()
            found = self.keys[word] = _key(word)
        return found

    def readings(self, core: str) -> dict[str, tuple[float, tuple[int, ...]]]:
        """What a word may be misread from → (log P(seen | printed), the confusions), the word itself left out."""
        out: dict[str, tuple[float, tuple[int, ...]]] = {}
        if not 3 <= len(core) <= self.longest + 3 or not any(map(str.isalpha, core)):
            return out
        own, odd = self.count(core), bool(ODD.search(core))
        if not odd and own >= 0.0002 * self.total:
            return out
        layer: dict[str, tuple[float, tuple[int, ...]]] = {core: (0.0, ())}
        least, rounds = max(8.0, 5 * own), 3 if odd else 2
        if sum(not c.isalpha() for c in core if c not in "-'’") > rounds:  # a word has letters only, and each round mends one place
            return out
        for left in reversed(range(rounds)):
            step: dict[str, tuple[float, tuple[int, ...]]] = {}
            for w, (p, path) in layer.items():
                for (seen, true), (k, q) in self.confusions.items():
                    at = w.find(seen)
                    while at >= 0:
                        v = w[:at] + true + w[at + len(seen) :]
                        if v not in step or p + q > step[v][0]:
                            step[v] = (p + q, (*path, k))
                        at = w.find(seen, at + 1)
            layer = {v: x for v, x in step.items() if v not in out and v != core and sum(not c.isalpha() for c in v if c not in "-'’") <= left}
            for v, x in layer.items():
                if all(part.isalpha() for part in re.split(r"[-'’]", v) if part) and self.count(v) >= least:
                    out.setdefault(v, x)
            if out and not odd:
                break
        return out

    def options(self, word: str) -> tuple[tuple[str, float], ...]:
        """Candidates for what was printed, with log P(seen | printed): the word itself first."""
        found = self.cache.get(word)
        if found is not None:
            return found
        core = _core(word)
        out: dict[str, float] = {core: 0.0}
        if FIGURES.fullmatch(word.strip(EDGES)):
            figure = word.strip(EDGES).translate(DIGITS)
            out[figure] = sum(math.log(self.odds[0] if x in "lI" else self.odds[6]) for x in word.strip(EDGES) if x in "OlI")
        else:
            out |= {v: p for v, (p, _) in self.readings(core).items()}
        found = tuple(out.items())
        if len(self.cache) >= CACHE:
            self.cache.clear()
            self.good.clear()
        self.cache[word] = found
        if len(found) == 1:
            self.good.add(word)
        return found

    def prior(self, word: str) -> float:
        """log P(printed): what holds figures in a word, or letters in a figure, is hardly ever printed."""
        n = self.count(word) + 0.5
        if len(word) <= self.longest + 3:
            n = 1e-4 if ODD.search(word) else 1e-9 if LOW_FIGURES.fullmatch(word) else n
        return math.log(n / self.total)

    def decode(self, words: list[str]) -> list[str | None]:
        """Viterbi over the candidates of each word: what replaces it, None where it stays."""
        places = [self.options(w) for w in words]
        if all(len(p) == 1 for p in places):
            return [None] * len(words)
        # what a misreading stands beside is no evidence for it
        rare = {p[0][0] for p in places if len(p) > 1 and self.count(p[0][0]) < 0.2 * max(self.count(v) for v, _ in p[1:])}
        score = {v: q + self.prior(v) for v, q in places[0]}
        back: list[dict[str, str]] = []
        for before, place in pairwise(places):
            step, link = {}, {}
            for v, q in place:
                own = self.prior(v)
                best = None
                for u, _ in before:
                    n = self.beside(u, v, u == before[0][0] and v == place[0][0])
                    c = self.count(u)
                    move = math.log((n + 5 * math.exp(own)) / (c + 5)) if (c or n) and v not in rare and u not in rare else own
                    total = score[u] + max(own - 1.0, min(move, 0.0))
                    if best is None or total > best[0]:
                        best = (total, u)
                step[v], link[v] = best[0] + q, best[1]
            score = step
            back.append(link)
        v = max(score, key=lambda k: (score[k], k))
        path = [v]
        for link in reversed(back):
            path.append(v := link[v])
        path.reverse()
        return [None if v == p[0][0] else v for v, p in zip(path, places)]

    def joins(self, a: str, b: str) -> bool:
        """Whether a line-end hyphen between the parts is only that of the line."""
        if b[0].isupper() and not a.isupper():
            return False
        a, b = a.lower(), b.lower()
        whole, compound = self.count(a + b), self.count(f"{a}-{b}")
        if whole or compound:
            return whole >= compound
        known = max(3.0, 2e-6 * self.total)
        return not (self.count(a) >= known and self.count(b) >= known)

    def broken(self, a: str, b: str) -> bool:
        """Whether a space stands inside a word: one of its parts is 50 times rarer than the whole."""
        if not (a.isalpha() and b.isalpha()) or len(a) + len(b) < 6:
            return False
        return max(1.0, min(self.count(a), self.count(b))) <= 0.02 * self.count(a + b)


def _like(word: str, by: str) -> str:
    """The replacement in the case and with the edges of the word."""
    at = len(word) - len(word.lstrip(EDGES))
    end = len(word.rstrip(EDGES))
    core = word[at:end]
    letters = [c for c in core if c.isalpha()]
    if len(letters) > 1 and sum(c.isupper() for c in letters) > len(letters) / 2:
        by = by.upper()
    elif core[:1].isupper() or core[:1] in "0158|!@" and len(letters) > 1 and letters[0].isupper():
        by = by[:1].upper() + by[1:]
    return word[:at] + by + word[end:]


def furniture(lines: list[str]) -> list[int]:
    """Lines that are running headers or page numbers."""
    out, seen = [], False
    last = len(lines) - 1
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            continue
        if not seen:  # the heading of the text itself
            seen = True
            if not (PAGE.fullmatch(s) or line[:1] == "\f" and i):
                continue
        if len(s) > 110:
            continue
        if PAGE.fullmatch(s) and any(c.isalnum() for c in s) and not re.fullmatch(r"[IVXLivxl]{1,6}|[A-Za-z]", s) or re.fullmatch(r"[ivx]{1,6}", s):
            out.append(i)
        elif line[:1] == "\f" and len(s) < 90 or MARKED.search(line) and not s.endswith((".", ",")):
            out.append(i)
        elif s[0].isupper() or s[0] in "0158|!@":
            if TRAILED.fullmatch(line) and not re.search(r"\d[.,]\d", s):
                out.append(i)
            elif s[-1] not in ".,;:!?" and TITLE.fullmatch(line) and sum(c.isalpha() for c in s) > 5:
                before = next((lines[j].rstrip() for j in range(i - 1, -1, -1) if lines[j].strip()), "")
                after = lines[i + 1].strip() if i < last else ""
                cut = before[-1:] not in (".", "!", "?", ":", "”", '"') or after[:1].islower()
                if cut or PAGE.fullmatch(after) or i - 1 in out or len(s.split()) >= 2 and s.isupper():
                    out.append(i)
    return out


class Reader:
    def __init__(self, channel: Channel):
        self.c = channel
        self.usual: set[str] = set()  # words that are no half of a broken one

    def words_fixed(self, text: str) -> dict[int, list[str | None]]:
        """Line number → replacements, of the lines with misread words."""
        c = self.c
        doubtful = {w for w in set(text.split()) - c.good if len(c.options(w)) > 1}
        if not doubtful:
            return {}
        out = {}
        for i, line in enumerate(text.split("\n")):
            words = line.split()
            if not doubtful.isdisjoint(words):
                fixed = c.decode(words)
                if any(fixed):
                    out[i] = fixed
        return out

    def halves(self, text: str, m: re.Match) -> tuple[str, str]:
        """The words before and after a hyphen."""
        at = m.start()
        while at and text[at - 1].isalpha():
            at -= 1
        return text[at : m.start()], HEAD.match(text, m.end())[0]

    def breaks(self, text: str) -> bool:
        if ("¬" in text or "\xad" in text) and SOFT.search(text):
            return True
        return ("- " in text or "-\n" in text or "-\r" in text) and any(self.c.joins(*self.halves(text, m)) for m in WRAPPED.finditer(text))

    def split_words(self, text: str) -> dict[int, list[int]]:
        """Line number → places of words that continue in the next one."""
        c, usual = self.c, self.usual
        unknown = set(text.split()) - usual
        for w in list(unknown):
            # the rarer part of a broken word is 50 times rarer than the most frequent word, or more
            if not (x := _core(w)).isalpha() or len(x) == 1 or c.count(x) > 0.02 * c.top:
                usual.add(w)
                unknown.discard(w)
        if len(usual) > CACHE:
            usual.clear()
        out: dict[int, list[int]] = {}
        if unknown:
            for i, line in enumerate(text.split("\n")):
                words = line.split()
                if not unknown.isdisjoint(words):
                    at = [k for k, (a, b) in enumerate(pairwise(words)) if (a in unknown or b in unknown) and a[-1:].isalpha() and b[:1].isalpha() and c.broken(_core(a), _core(b))]
                    if at:
                        out[i] = at
        return out

    def causes(self, text: str | None, entry: bool) -> Iterator[str]:
        """What is wrong with a text: the channel is asked first, form and place last."""
        if not text or text.isspace():
            return
        plain = text.replace("_", " ") if entry else text
        if self.words_fixed(plain):
            yield "misread"
        if self.breaks(plain):
            yield "broken at a line end"
        if self.split_words(plain):
            yield "broken by a space"
        if SPACED.search(text):
            yield "spaced out"
        if entry and ENTRY_ODD.search(text):
            yield "misread, of no known word"
        if (ENTRY_HEAD.search(text) or ENTRY_TAIL.search(text)) if entry else furniture(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            yield "page"

    def noisy(self, text: str | None, entry: bool) -> bool:
        return next(self.causes(text, entry), None) is not None

    def repair(self, text: str | None, entry: bool) -> str | None:
        """Readable paragraphs, or a plain entry."""
        if not text or text.isspace():
            return text
        text = text.replace("\r\n", "\n").replace("\r", "\n")
        if entry:
            while ENTRY_HEAD.search(text):
                text = ENTRY_HEAD.sub("", text)
            text = ENTRY_TAIL.sub("", text)
        lines = text.split("\n")
        if not entry:
            for i in furniture(lines):
                lines[i] = None
        lines = [x for x in lines if x is not None]
        text = SPACED.sub(lambda m: m[0].replace(" ", ""), "\n".join(lines))
        lines = text.split("\n")
        fixes, splits = self.words_fixed(text), self.split_words(text)
        for i in fixes.keys() | splits.keys():
            parts = re.split(r"(\s+)", lines[i])
            words = [k for k, part in enumerate(parts) if part and not part.isspace()]
            for k, new in zip(words, fixes.get(i, ())):
                if new:
                    parts[k] = _like(parts[k], new)
            for at in splits.get(i, ()):
                parts[words[at] + 1] = ""
            lines[i] = "".join(parts)
        text = "\n".join(lines)
        text = re.sub("([^\\W\\d_])[¬\xad]\\s*(?=[^\\W\\d_])", r"\1", text)
        source = text
        text = WRAPPED.sub(lambda m: "" if self.c.joins(*self.halves(source, m)) else "-", source)
        if entry:
            return re.sub(r"\s+", " ", text).strip()
        out = []
        for block in re.split(r"\n\s*\n", text):
            rows = block.split("\n")
            if sum(bool(re.search(r"\S {3,}\S|^\s*(?:[-*•]|\(?\d+[.)])\s", r)) for r in rows) * 2 > len(rows):
                out.append(block)  # tables and lists keep their lines
            else:
                out.append(" ".join(r.strip() for r in rows if r.strip()))
        return "\n\n".join(x for x in out if x)


def train(texts: DataFrame) -> Channel:
    """Corpus counts from rows with a text t."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uni, bi = Counter(), Counter()

        def out() -> pd.DataFrame:
            keys = {w: _key(w) for w in uni}
            a = [*keys.values(), *[keys[u] for u, _ in bi]]
            b = [0] * len(uni) + [keys[v] for _, v in bi]
            word = [w if any(map(str.isalpha, w)) else None for w in uni] + [None] * len(bi)
            got = pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64), "word": pd.Series(word, dtype=object), "n": np.array([*uni.values(), *bi.values()], dtype=np.float64)})
            uni.clear()
            bi.clear()
            return got

        raw_uni, raw_bi = Counter(), Counter()

        def fold() -> None:
            core = {w: _core(w) for w in raw_uni}
            for w, n in raw_uni.items():
                uni[core[w]] += n
            for (a, b), n in raw_bi.items():
                bi[core.get(a) or _core(a), core.get(b) or _core(b)] += n
            raw_uni.clear()
            raw_bi.clear()

        for pdf in batches:
            for t in pdf["t"]:
                words = t.split()
                raw_uni.update(words)
                raw_bi.update(pairwise(words))
                if len(raw_bi) > FLUSH:
                    fold()
                    yield out()
        fold()
        yield out()

    rows = texts.where(F.col("t").rlike(r"\S")).select("t").mapInPandas(count, "a long, b long, word string, n double")
    counted = materialise(rows.groupBy("a", "b").agg(F.max("word").alias("word"), F.sum("n").alias("n")), "counts")
    words, pairs = counted.where("b = 0"), counted.where("b <> 0")
    got = words.where(F.col("a") != _key("")).agg(F.sum("n"), F.max(F.when(F.col("n") >= 8, F.length("word"))), F.max(F.when(F.length("word") >= 6, F.col("n")))).first()
    total, longest, top = got[0] or 0.0, got[1] or 0, got[2] or 0.0
    most = counted.count()
    for side in "ab":  # by merging: read from compressed files, they are taken for smaller than they are
        pairs = pairs.join(words.where("n = 1").select(F.col("a").alias(side)).hint("merge"), side, "left_anti")

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, b = (pdf[x].to_numpy().view(np.uint64) for x in "ab")
            x = (a * np.uint64(0x9E3779B97F4A7C15) ^ b) * np.uint64(0xC2B2AE3D27D4EB4F)
            x = (x ^ x >> np.uint64(32)).view(np.int64)
            x[x == 0] = 1
            yield pd.DataFrame({"key": x, "n": pdf["n"]})

    uni = words.where((F.col("a") != _key("")) & (F.col("word").isNotNull() | (F.col("n") > 1))).select(F.col("a").alias("key"), "n")
    bi = pairs.select("a", "b", "n").mapInPandas(keyed, "key long, n double")
    channel = Channel(stored(uni, most), stored(bi, most), total, longest, top)
    return estimated(channel, words.where("word IS NOT NULL").select("word", "n"))


def estimated(channel: Channel, words: DataFrame, rounds: int = 2) -> Channel:
    """The channel with probabilities estimated from the distinct words (word, n) of the corpus."""
    for _ in range(rounds):
        shared = words.sparkSession.sparkContext.broadcast(channel)

        def expect(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            c = shared.value
            seen, printed = np.zeros(len(CONFUSIONS)), np.zeros(len(CONFUSIONS))
            for pdf in batches:
                for w, n in zip(pdf["word"], pdf["n"]):
                    for k, (_, true, _) in enumerate(CONFUSIONS):
                        if true in w:
                            printed[k] += n * w.count(true)
                    found = c.readings(w)
                    if not found:
                        continue
                    score = {v: math.exp(p + c.prior(v)) for v, (p, _) in found.items()}
                    whole = sum(score.values()) + math.exp(c.prior(w))
                    for v, (_, path) in found.items():
                        for k in path:
                            seen[k] += n * score[v] / whole
            yield pd.DataFrame({"k": range(len(CONFUSIONS)), "seen": seen, "printed": printed})

        got = words.mapInPandas(expect, "k int, seen double, printed double").groupBy("k").agg(F.sum("seen").alias("seen"), F.sum("printed").alias("printed")).orderBy("k").collect()
        first = [p for _, _, p in CONFUSIONS]
        # most of a corpus isn't scanned: what is estimated is how the misreadings of the scanned part share out, at the rate first guessed
        whole = sum(r.seen for r in got)
        scale = sum(r.printed * first[r.k] for r in got) / whole if whole else 0.0
        odds = first[:]
        for r in got:
            odds[r.k] = min(0.1, (first[r.k] + scale * r.seen / max(r.printed, 1.0)) / 2)
        channel = Channel(channel.uni, channel.bi, channel.total, channel.longest, channel.top, odds)
    return channel


def _all(topics: DataFrame, entries: DataFrame) -> DataFrame:
    return topics.select(F.lit("get_headers").alias("source_table"), F.col("topic_id").alias("row_id"), F.col("topic_text").alias("t")).unionAll(
        entries.select(F.lit("extract_toc").alias("source_table"), F.col("toc_id").alias("row_id"), F.col("topic").alias("t"))
    )


def _run(rows: DataFrame, channel: Channel, repair: bool) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(channel)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        for pdf in batches:
            entry = (pdf["source_table"] == "extract_toc").tolist()
            out = pdf[["source_table", "row_id"]].copy()
            out["noisy"] = [reader.noisy(t, e) for t, e in zip(pdf["t"], entry)]
            if repair:
                out["repaired"] = [reader.repair(t, e) if n else t for t, e, n in zip(pdf["t"], entry, out["noisy"])]
            yield out

    return rows.mapInPandas(run, "source_table string, row_id long, noisy boolean" + ", repaired string" * repair)


def find(topics: DataFrame, entries: DataFrame, channel: Channel | None = None) -> DataFrame:
    """(source_table, row_id, noisy) of every row of both tables."""
    rows = _all(topics, entries)
    return _run(rows, train(rows) if channel is None else channel, False)


def repair(topics: DataFrame, entries: DataFrame, channel: Channel | None = None) -> DataFrame:
    """(source_table, row_id, noisy, repaired) of every row of both tables."""
    rows = _all(topics, entries)
    return _run(rows, train(rows) if channel is None else channel, True)
