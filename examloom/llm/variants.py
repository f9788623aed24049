"""Variant spellings of names: which rows name the same bank, or the same examiner.

Distinct spellings are cut into tokens, and those with the same tokens are one form. A symmetric-delete index over the distinct
towns and surnames finds those within small edit distance: words and all their one- and two-letter deletions meet by equality,
nothing is compared to everything. Forms are candidates whose town, or surname and an initial, are near. Each candidate is verified by the cheapest assignment of the
tokens of the shorter name to those of the longer, where equal words, slips, abbreviations, initials and nicknames cost
more in this order. Words of banks are corrected and expanded before, by the same kind of index against the frequent words of
the corpus (`SHARE` of its tokens, so at most 1/SHARE words at any size) and the fixed ones. Words that carry nothing (`EMPTY`,
slips in them included) are left out; any other unmatched word keeps two names apart.

The result are members of forms and links between forms; pairs of rows come out by joining the two, in the query only. A bare initial that fits people who exclude each
other is linked to the one with the nearest surname, and to nobody if these are several. A name without a middle name that fits
several keeps links to the nearest too, of several the one with by far the most rows, and to other names without a middle name.

Defined results: rows with a null or blank name (or location) have no pairs, and neither have equal spellings. Rows repeated
under another serial number count as rows. Extra columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.session import materialise

# Short forms of given names.
NICKNAMES = {
    "abby": "abigail", "gail": "abigail", "al": "albert", "alex": "alexandra", "sandra": "alexandra", "sandy": "alexandra", "lexi": "alexandra", "tony": "anthony", "ant": "anthony", "charlie": "charles",
    "chuck": "charles", "chas": "charles", "chris": "christopher", "kit": "christopher", "dan": "daniel", "danny": "daniel", "deb": "deborah", "debbie": "deborah", "dot": "dorothy",
    "dottie": "dorothy", "dolly": "dorothy", "ed": "edward", "eddie": "edward", "ted": "theodore", "teddy": "theodore", "ned": "edward", "beth": "elizabeth", "betty": "elizabeth", "liz": "elizabeth",
    "eliza": "elizabeth", "betsy": "elizabeth", "essie": "esther", "hettie": "esther", "fred": "frederick", "freddie": "frederick", "gerry": "gerald", "jerry": "gerald", "greg": "gregory", "hal": "harold", "harry": "harold",
    "etta": "henrietta", "hattie": "henrietta", "hank": "henry", "jim": "james", "jimmy": "james", "jamie": "james", "jen": "jennifer", "jenny": "jennifer", "jon": "jonathan",
    "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kay": "katherine", "larry": "lawrence", "len": "leonard", "leo": "leonard", "lenny": "leonard", "lou": "louis", "peg": "margaret",
    "peggy": "margaret", "meg": "margaret", "maggie": "margaret", "greta": "margaret", "marc": "marcus", "mark": "marcus", "mike": "michael", "mick": "michael", "nat": "nathaniel", "nate": "nathaniel", "nick": "nicholas",
    "pat": "patricia", "patty": "patricia", "trish": "patricia", "tricia": "patricia", "phil": "philip", "pete": "peter", "becca": "rebecca", "becky": "rebecca", "dick": "richard",
    "rick": "richard", "rich": "richard", "bob": "robert", "rob": "robert", "bobby": "robert", "sam": "samuel", "sammy": "samuel", "steve": "stephen", "sue": "susan", "susie": "susan", "tom": "thomas",
    "tommy": "thomas", "vicky": "victoria", "vic": "victoria", "tori": "victoria", "ginny": "virginia", "ginger": "virginia", "walt": "walter", "wally": "walter", "bill": "william", "billy": "william", "will": "william",
    "wil": "william", "liam": "william", "yola": "yolanda", "lola": "yolanda", "quent": "quentin", "nan": "naomi", "liv": "olivia", "ollie": "olivia", "don": "donald", "ron": "ronald", "joe": "joseph", "andy": "andrew", "matt": "matthew",
}

# A second given name of some short forms.
ALSO = {"rick": "frederick", "ted": "edward", "kit": "katherine", "dot": "dorothea", "pat": "patrick", "chris": "christine", "sam": "samantha", "alex": "alexander", "leo": "leopold"}

KNOWN = frozenset(NICKNAMES) | frozenset(NICKNAMES.values())

# Short forms in names of banks.
SHORT = {
    "bk": "bank", "bnk": "bank", "bks": "bank", "natl": "national", "nat": "national", "ntl": "national", "nat'l": "national", "co": "company", "comp": "company", "cmpy": "company", "tr": "trust",
    "trst": "trust", "st": "state", "sav": "savings", "svgs": "savings", "svg": "savings", "fed": "federal", "fedl": "federal", "assn": "association", "assoc": "association", "ass": "association",
    "comm": "community", "cmty": "community", "comml": "commercial", "coml": "commercial", "first": "1st", "frst": "1st", "mech": "mechanics", "merch": "merchants", "farm": "farmers", "frmrs": "farmers",
    "citz": "citizens", "cit": "citizens", "peo": "peoples", "ppls": "peoples", "pion": "pioneer", "herit": "heritage", "corn": "cornerstone", "mt": "mount", "&": "and",
}
#: Words that say little: how a bank is organised, articles and joints.
EMPTY = frozenset("the of and na n.a ssb chartered inc incorporated corp fsb".split())
#: A frequent word has this share of the tokens of all spellings; a frequent token that is this much rarer than a word is a slip in it.
SHARE, RARER = 0.001, 20
#: Letters whose deletions are indexed. Two words within k edits have beginnings of any length within k deletions on both sides (what an
#: edit shifts out of one is deleted from the other), so none is missed; it only bounds the forms of very long words.
WINDOW = 40
#: Words whose deleted forms a worker holds at once.
CHUNK = 1000
#: Entries of each cache of a worker.
CACHE = 50_000
#: Rows with one middle initial against those with any other, from which on the others are exceptions.
CLEAR = 4
SUFFIX = {"jr": "jr", "junior": "jr", "sr": "sr", "senior": "sr", "ii": "ii", "iii": "iii", "iv": "iv"}
ROLES = re.compile(r"\((?:eic|lead|examiner|acting|deceased)[^)]*\)|[-;,]\s*(?:examiner|eic|on site|lead|acting|fdic)\b.*$|^\s*(?:eic|mr|mrs|ms|dr)[.:]?\s+", re.I)


def distance(a: str, b: str, most: int = 2) -> int:
    """Edits with swaps of neighbours; most + 1 where there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    return _edits(a, b, most) if len(a) <= 64 else _edits.__wrapped__(a, b, most)


@lru_cache(maxsize=CACHE)
def _edits(a: str, b: str, most: int) -> int:
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            new.append(v)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


def deletes(word: str, n: int) -> set[str]:
    """The word and what is left after deleting up to n letters."""
    out, layer = {word}, {word}
    for _ in range(n):
        layer = {w[:i] + w[i + 1 :] for w in layer for i in range(len(w))}
        out |= layer
    return out


def _slips(word: str) -> int:
    return 0 if len(word) < 4 else 1 if len(word) < 7 else 2


def short_for(a: str, b: str) -> bool:
    """Whether a is an abbreviation of b: b's first letter and then letters of b in order."""
    if len(a) >= len(b) or len(a) < 2 or a[0] != b[0]:
        return False
    it = iter(b)
    return all(c in it for c in a)


class Lexicon:
    """The frequent words of a corpus and the fixed ones, met by their deleted forms."""

    def __init__(self, counts: dict[str, int] | None = None):
        self.fixed = frozenset(SHORT) | frozenset(SHORT.values()) | EMPTY
        self.counts = dict.fromkeys(sorted(self.fixed), 1) | (counts or {})
        self.forms: dict[str, list[str]] = {}
        for w in self.counts:
            if _slips(w):
                for form in deletes(w[:WINDOW], _slips(w)):
                    self.forms.setdefault(form, []).append(w)
        self.cache: dict[str, str] = {}

    def correct(self, word: str) -> str:
        """The frequent word that the word is a slip of (the nearest, then the most frequent), or the word."""
        if word in self.fixed:
            return word
        found = self.cache.get(word)
        if found is None:
            own = self.counts.get(word, 0)
            near = {w for form in deletes(word[:WINDOW], _slips(word)) for w in self.forms.get(form, ()) if self.counts[w] > RARER * own} - {word}
            ranked = [(d, -self.counts[w], w) for w in near if (d := distance(word, w, 2)) <= _slips(min(word, w, key=len))]
            found = min(ranked)[2] if ranked else word
            if not ranked and word not in self.counts and len(word) in (3, 4) and any(distance(word, w, 1) <= 1 for w in ("the", "and", "inc")):
                found = "the"  # a slip in a short word that carries nothing
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = found
        return found


FIXED = Lexicon()


@lru_cache(maxsize=CACHE)
def bank_words(name: str) -> tuple[str, ...]:
    text = re.sub(r"^\W*(?:bank name|name of bank|bank)\s*:\s*", "", name.lower().replace("_", " ")).replace("nat'l", "national")
    text = re.sub(r"\bf\.?\s?n\.?\s?b\b\.?", "1st national bank", text)
    text = re.sub(r"(?<=[a-z])-\s*(?=[a-z])", "", text)
    return tuple(re.findall(r"[^\W_]+|&", re.sub(r"['’]", "", text)))


def bank_tokens(name: str, town: str = "", lexicon: Lexicon = FIXED) -> tuple[str, ...]:
    """Words of a bank's name, corrected and expanded; those that are the town stay as they are."""
    words = [w if town and distance(w, town, 2) <= _slips(w) else lexicon.correct(w) for w in bank_words(name)]
    return tuple(w for w in (SHORT.get(w, w) for w in words) if w not in EMPTY)


@lru_cache(maxsize=CACHE)
def place(location: str) -> tuple[str, str]:
    """(town without spaces, state without spaces)."""
    text = location.lower().strip()
    text = re.sub(r"^([a-z]{2})\s+-\s+(.*)$", r"\2, \1", re.sub(r"^\W*(?:bank )?location\s*:\s*", "", text))
    m = re.match(r"^(.*?)\s*(?:,|\()\s*([^()]*?)\)?[\s.]*$", text)
    town, state = (m[1], m[2]) if m else (text, "")
    if not m and (k := re.match(r"^(.*\S)\s+([a-z]{2})$", text)):
        town, state = k[1], k[2]
    state = re.sub(r"\d+", "", state)
    town = re.sub(r"^(?:the\s+)?(?:city|town|township|village|borough|county)\s+of\s+(?=\w)", "", town)
    town = re.sub(r"\b(?:st|saint)\b\.?", "saint", re.sub(r"\bmt\b\.?", "mount", town))
    return re.sub(r"[^\w]|[\d_]", "", town), " ".join(re.findall(r"[^\W\d_]+", state))


def same_state(a: str, b: str, codes: dict[str, str] | None = None) -> bool:
    """codes: what two-letter codes stand for, as far as the corpus shows."""
    a, b = (codes or {}).get(a, a), (codes or {}).get(b, b)
    if not a or not b or a == b:
        return True
    x, y = a.replace(" ", ""), b.replace(" ", "")
    if len(x) > len(y):
        a, b, x, y = b, a, y, x
    if len(x) <= 2:
        initials = "".join(w[0] for w in b.split())
        return initials == x if " " in b else short_for(x, y)
    if distance(x, y, 2) <= 2 and min(len(x), len(y)) > 4:
        return True
    return short_for(x, y) or len(x) > 3 and distance(x, y[: len(x)], 1) <= 1


def assign(cost: list[list[float]], skip: list[float]) -> float:
    """The cheapest assignment of the rows to different columns, by augmenting paths; a row may be left out at its own cost."""
    n, m = len(cost), len(cost[0]) if cost else 0
    wide = [[*row, *[skip[i] if i == k else 1e9 for k in range(n)]] for i, row in enumerate(cost)]
    u, v, taken = [0.0] * (n + 1), [0.0] * (m + n + 1), [0] * (m + n + 1)
    for i in range(1, n + 1):
        taken[0], at = i, 0
        low, way, seen = [1e18] * (m + n + 1), [0] * (m + n + 1), [False] * (m + n + 1)
        while taken[at]:
            seen[at] = True
            row, best, to = taken[at], 1e18, 0
            for j in range(1, m + n + 1):
                if not seen[j]:
                    c = wide[row - 1][j - 1] - u[row] - v[j]
                    if c < low[j]:
                        low[j], way[j] = c, at
                    if low[j] < best:
                        best, to = low[j], j
            for j in range(m + n + 1):
                if seen[j]:
                    u[taken[j]] += best
                    v[j] -= best
                else:
                    low[j] -= best
            at = to
        while at:
            taken[at], at = taken[way[at]], way[at]
    return sum(wide[taken[j] - 1][j - 1] for j in range(1, m + n + 1) if taken[j])


def _word_cost(a: str, b: str) -> float:
    if a == b:
        return 0.0
    if distance(a, b, _slips(min(a, b, key=len))) <= _slips(min(a, b, key=len)):
        return 0.3
    s, t = sorted((a, b), key=len)
    return 0.35 if short_for(s, t) and len(t) > 3 else 9.0


Bank = tuple[tuple[str, ...], str, str]  # corrected words, town, state
Person = tuple[str, tuple[str, ...], str]  # surname, given names and initials, suffix


def bank_form(name: str, location: str, lexicon: Lexicon = FIXED) -> Bank:
    """All that is compared of a spelling."""
    town, state = place(location)
    return bank_tokens(name, town, lexicon), town, state


def same_bank(x: Bank, y: Bank, codes: dict[str, str] | None = None) -> bool:
    (a, town_a, state_a), (b, town_b, state_b) = x, y
    if distance(town_a, town_b, 2) > min(2, max(_slips(town_a), _slips(town_b))) or not same_state(state_a, state_b, codes):
        return False
    # a name may add its own town
    near_town = lambda w: distance(w, town_a, 2) <= _slips(town_a)
    full_a, full_b = a, b
    if sum(map(near_town, a)) != sum(map(near_town, b)):
        a, b = tuple(w for w in a if not near_town(w)), tuple(w for w in b if not near_town(w))
    if not a or not b:
        return full_a == full_b
    if "".join(a) == "".join(b):
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b) and assign([[_word_cost(v, w) for w in b] for v in a], [9.0] * len(a)) <= 0.36 * len(b):
        return True
    # a word broken in two, or two run together; in another order where more words differ
    order = sorted if len(b) - len(a) > 1 else list
    return distance("".join(order(a)), "".join(order(b)), 2) <= 2


@lru_cache(maxsize=CACHE)
def person(name: str) -> tuple[str, tuple[str, ...], str]:
    """(surname, given names and initials, suffix)."""
    text = name.replace("’", "'").strip()
    for _ in range(2):
        text = ROLES.sub(" ", text).strip()
    text = re.sub(r"\([^)]*\)", " ", text)
    text = re.sub(r"(?<=[A-Za-z])-\s*(?=[a-z])", "", text)
    parts = [p.strip() for p in text.split(",") if p.strip()]
    suffix = ""
    if len(parts) > 1 and parts[-1].lower().strip(". ") in SUFFIX:
        suffix = SUFFIX[parts.pop().lower().strip(". ")]
    words = lambda t: [w for w in re.split(r"[\s.]+", re.sub(r"[^\w\s.']|[\d_]", " ", t)) if w]
    if len(parts) > 1:
        last, first = words(parts[0]), words(" ".join(parts[1:]))
    else:
        every = words(parts[0] if parts else "")
        while every and every[-1].lower() in SUFFIX:
            suffix = SUFFIX[every.pop().lower()]
        if len(every) > 1 and len(every[0]) > 2 and every[0].isupper() and not any(w.isupper() and len(w) > 1 for w in every[1:]):
            last, first = every[:1], every[1:]
        else:
            last, first = every[-1:], every[:-1]
            # a surname broken by a space: its second part starts small
            if len(first) > 1 and last and last[0][:1].islower() and len(first[-1]) > 1 and not text.islower():
                last, first = [first[-1] + last[0]], first[:-1]
    while last and last[-1].lower() in SUFFIX:
        suffix = SUFFIX[last.pop().lower()]
    while first and first[-1].lower() in SUFFIX:
        suffix = SUFFIX[first.pop().lower()]
    return "".join(last).lower().replace("'", ""), tuple(w.lower().replace("'", "") for w in first), suffix


def given_cost(a: str, b: str) -> float:
    """0 equal, more for slips, short forms and initials, 9 for different names."""
    if a == b:
        return 0.0
    if a in KNOWN and b in KNOWN and min(len(a), len(b)) > 3 and not ({a, NICKNAMES.get(a), ALSO.get(a)} & {b, NICKNAMES.get(b), ALSO.get(b)} - {None}):
        return 0.2 if a.startswith(b) or b.startswith(a) else 9.0  # two names, not a slip
    names_a, names_b = ({n, NICKNAMES.get(n, n), ALSO.get(n, n)} for n in (a, b))
    if len(a) == 1 or len(b) == 1:
        return 0.3 if any(x[0] == y[0] for x in names_a for y in names_b) else 9.0
    if names_a & names_b:
        return 0.1
    for x in names_a:
        for y in names_b:
            short, long = sorted((x, y), key=len)
            k = 0 if len(short) < 3 else 1 if len(short) < 6 else 2
            if long.startswith(short) or distance(short, long, k) <= k and (len(short) > 3 or short[0] == long[0]):
                return 0.2
    # a slip in a short form
    s, t = sorted((a, b), key=len)
    if s in NICKNAMES or len(s) < 4:
        return 9.0
    return 0.3 if any(len(n) > 3 and v == t and distance(s, n, 1) <= 1 for n, v in NICKNAMES.items()) else 9.0


def same_person(a: Person, b: Person) -> bool:
    (last_a, first_a, suf_a), (last_b, first_b, suf_b) = a, b
    if not last_a or not last_b or suf_a and suf_b and suf_a != suf_b:
        return False
    if distance(last_a, last_b, 2) > min(_slips(last_a), _slips(last_b)):
        return False
    if not first_a or not first_b:
        return False
    if given_cost(first_a[0], first_b[0]) >= 9:
        return False
    if len(first_a) > 1 and len(first_b) > 1:
        rest_a, rest_b = first_a[1:], first_b[1:]
        if len(rest_a) > len(rest_b):
            rest_a, rest_b = rest_b, rest_a
        return assign([[given_cost(x, y) for y in rest_b] for x in rest_a], [9.0] * len(rest_a)) < 9
    return True


@lru_cache(maxsize=CACHE)
def initials(given: str) -> tuple[str, ...]:
    """The first letters of what a given name may stand for, one more than slips it may have: two names that given_cost() lets pass
    share one of them."""
    names = {given, NICKNAMES.get(given, given), ALSO.get(given, given)}
    if len(given) > 3:
        names |= {full for short, full in NICKNAMES.items() if distance(given, short, 1) <= 1}
    return tuple(sorted({c for n in names for c in n[: 1 if len(n) < 3 else 2 if len(n) < 6 else 3]}))


def joined(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of tables that grow with the corpus, never by broadcast: the planner takes what Python returns, explodes or reads from
    compressed files for far smaller than it is, and all that is broadcast goes through the driver."""
    return left.join(right.hint("merge"), on, how)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near): different words with a deleted form in common, and each word itself, of distinct words (word). The words of a form
    are grouped by its hash; two forms of one hash only make more candidates."""

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), CHUNK):
                found = [(form, w) for w in pdf["word"].iloc[at : at + CHUNK] for form in deletes(w[:WINDOW], _slips(w))]
                yield pd.DataFrame(found, columns=["form", "word"])

    forms = _spread(words).mapInPandas(index, "form string, word string")
    groups = forms.groupBy(F.xxhash64("form").alias("form")).agg(F.collect_list("word").alias("words")).where("size(words) > 1")
    pairs = groups.select(F.explode("words").alias("word"), "words").select("word", F.explode("words").alias("near"))
    return pairs.unionAll(words.select("word", F.col("word").alias("near"))).distinct()


def _spread(df: DataFrame) -> DataFrame:
    """Over all cores, as little data is much work."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def linked(forms: DataFrame, same: Callable, columns: list[str]) -> DataFrame:
    """(a, b) with a < b: ids of different forms (id, word, keys, columns) that mean the same. Forms are compared whose words are near
    and that share a key; same() gets the columns of both."""
    near = materialise(neighbours(forms.select("word").where("word <> ''").distinct()), "near")
    keyed = forms.select("id", "word", F.explode("keys").alias("key"))
    left = joined(keyed, near, "word").select(F.col("id").alias("a"), F.col("near").alias("word"), "key")
    pairs = joined(left, keyed.withColumnRenamed("id", "b"), ["word", "key"]).where("a < b").select("a", "b").distinct()
    side = lambda s: forms.select(F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns])
    full = joined(joined(pairs, side("a"), "a"), side("b"), "b")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, y = ([(tuple(v[0]), *v[1:]) for v in zip(*[pdf[f"{c}_{s}"] for c in columns])] for s in "ab")
            yield pdf.loc[[same(p, q) for p, q in zip(x, y)], ["a", "b"]]

    return _spread(full.select("a", "b", *[f"{c}_{s}" for s in "ab" for c in columns])).mapInPandas(verify, "a long, b long")


def _keys(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, spelling, n): distinct spellings with an id that is the same in every run, and their rows."""
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).withColumn("spelling", F.xxhash64(*columns))


def expanded(members: DataFrame, links: DataFrame, entity: str) -> DataFrame:
    """(entity, serial_a, serial_b): every pair of rows with different spellings of one form or of linked forms."""
    a = members.select(F.col("id").alias("a"), F.col("spelling").alias("sa"), F.col("serial_no").alias("x"))
    b = members.select(F.col("id").alias("b"), F.col("spelling").alias("sb"), F.col("serial_no").alias("y"))
    every = links.select("a", "b").unionAll(members.select(F.col("id").alias("a"), F.col("id").alias("b")).distinct())
    pairs = joined(joined(every, a, "a"), b, "b").where("sa <> sb AND (a <> b OR x < y)")
    return pairs.select(F.lit(entity).alias("entity"), F.least("x", "y").alias("serial_a"), F.greatest("x", "y").alias("serial_b"))


def state_codes(keys: DataFrame) -> dict[str, str]:
    """Two-letter codes → the state whose towns they share most; a code counts that shares three towns or more."""

    @F.pandas_udf("town string, state string")
    def cut(at: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([place(x) for x in at], columns=["town", "state"])

    at = keys.select(cut("bank_location").alias("p")).select("p.town", "p.state").where("state <> ''").distinct()
    codes, states = at.where("length(state) = 2").select("town", F.col("state").alias("code")), at.where("length(state) > 4")
    n = joined(codes, states, "town").groupBy("code", "state").agg(F.count("*").alias("n")).where("n >= 3")
    best = n.groupBy("code").agg(F.max_by("state", F.struct("n", "state")).alias("state"))
    return {r.code: r.state for r in best.where("code RLIKE '^[a-z]{2}$'").orderBy("code").collect()}  # there are 676 such codes


def frequent_words(keys: DataFrame) -> dict[str, int]:
    """Words with at least SHARE of the tokens of all spellings → their number."""

    @F.pandas_udf("array<string>")
    def cut(names: pd.Series) -> pd.Series:
        return pd.Series([list(bank_words(x)) for x in names], dtype=object)

    words = keys.select(F.explode(cut("bank_name")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    total = words.agg(F.sum("n").alias("total"))
    found = words.crossJoin(total).where((F.col("n") >= SHARE * F.col("total")) & (F.col("n") > 2))
    return {r.word: r.n for r in found.select("word", "n").orderBy("word").collect()}  # at most 1/SHARE


def banks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (serial_no, spelling, id) of forms, and links (a, b) between different forms of one bank."""
    columns = ["bank_name", "bank_location"]
    rows = rows.where("trim(bank_name) <> '' AND trim(bank_location) <> ''")
    keys = materialise(_keys(rows, columns), "banks")
    codes, lexicon = state_codes(keys), Lexicon(frequent_words(keys))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [bank_form(*v, lexicon) for v in zip(pdf["bank_name"], pdf["bank_location"])]
            yield pd.DataFrame({"spelling": pdf["spelling"], "words": [list(f[0]) for f in found], "word": [f[1] for f in found], "state": [f[2] for f in found]})

    cuts = _spread(keys).mapInPandas(cut, "spelling long, words array<string>, word string, state string")
    cuts = materialise(cuts.where("word <> ''").withColumn("id", F.xxhash64("words", "word", "state")), "forms")
    forms = cuts.select("id", "words", "word", "state", F.array(F.lit("")).alias("keys")).dropDuplicates(["id"])
    links = linked(forms, lambda x, y: same_bank(x, y, codes), ["words", "word", "state"])
    return _members(rows, columns, cuts), links


def _members(rows: DataFrame, columns: list[str], cuts: DataFrame) -> DataFrame:
    """(serial_no, spelling, id) of every row whose spelling has a form; rows of one spelling aren't pairs, so its hash is enough."""
    return joined(rows.select("serial_no", F.xxhash64(*columns).alias("spelling")), cuts.select("spelling", "id"), "spelling")


def examiners(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (serial_no, spelling, id) of forms, and links (a, b) between different forms of one examiner."""
    columns = ["examiner_in_charge"]
    rows = rows.where("trim(examiner_in_charge) <> ''")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [person(v) for v in pdf["examiner_in_charge"]]
            yield pd.DataFrame({
                "spelling": pdf["spelling"], "n": pdf["n"], "names": [list(f[1]) for f in found], "word": [f[0] for f in found], "suffix": [f[2] for f in found], "keys": [list(initials(f[1][0])) if f[1] else [] for f in found],
            })

    cuts = _spread(materialise(_keys(rows, columns), "examiners")).mapInPandas(cut, "spelling long, n long, names array<string>, word string, suffix string, keys array<string>")
    cuts = materialise(cuts.where("word <> '' AND size(names) > 0").withColumn("id", F.xxhash64("names", "word", "suffix")), "people")
    forms = cuts.groupBy("id").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("names", "word", "suffix", "keys")])
    links = materialise(linked(forms, lambda x, y: same_person((x[1], x[0], x[2]), (y[1], y[0], y[2])), ["names", "word", "suffix"]), "people")
    return _members(rows, columns, cuts), _unambiguous(forms, links)


def _clear(people: list[tuple[str, int]]) -> list[str]:
    """Given names that a bare initial means, of (given, edits in the surname): those with the nearest surname and what passes for
    them, if they are one name; none otherwise."""
    near = min(d for _, d in people)
    groups: list[set[str]] = []
    for given, d in sorted(people):
        if d == near:
            hit = [g for g in groups if any(given_cost(given, x) < 9 for x in g)]
            groups = [g for g in groups if g not in hit] + [{given}.union(*hit)]
    return [given for given, _ in people if any(given_cost(given, x) < 9 for x in groups[0])] if len(groups) == 1 else []


def _unambiguous(keys: DataFrame, links: DataFrame) -> DataFrame:
    """Without the links of forms to neighbours of two different people. keys: (id, names, word, n rows).

    A bare initial that meets different given names keeps links to the one with the nearest surname, and loses all links if these are
    several. A name without a middle name that meets different middle initials keeps links to the one with the nearest surname, of
    several the one with `CLEAR` times the rows of the others, and in any case to names without a middle name.
    """
    given, middle = F.get("names", F.lit(0)), F.coalesce(F.left(F.get("names", F.lit(1)), F.lit(1)), F.lit(""))
    named = keys.select("id", "word", "n", given.alias("given"), middle.alias("middle"), (F.length(given) <= 1).alias("bare"), (F.size("names") < 2).alias("open"))
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = named.select(F.col("id").alias("b"), F.col("word").alias("word_b"), "n", "given", "middle", F.col("bare").alias("bare_b"))
    own = named.select(F.col("id").alias("a"), F.col("word").alias("word_a"), F.col("bare").alias("bare_a"), "open")
    near = materialise(joined(joined(both, other, "b"), own, "a").withColumn("d", F.levenshtein("word_a", "word_b")).drop("word_a", "word_b"), "near")

    @F.pandas_udf("array<string>")
    def meant(people: pd.Series) -> pd.Series:
        return pd.Series([_clear([(x["given"], x["d"]) for x in v]) for v in people], dtype=object)

    met = near.where("bare_a AND NOT bare_b").groupBy("a", "given").agg(F.min("d").alias("d"))
    several = met.groupBy("a").agg(F.collect_list(F.struct("given", "d")).alias("people")).where("size(people) > 1")
    chosen = materialise(_spread(several).select("a", meant("people").alias("kept")), "meant")
    doubtful = chosen.where("size(kept) = 0").select("a")
    strangers = joined(near.where("bare_a AND NOT bare_b"), chosen.where("size(kept) > 0"), "a").where("NOT array_contains(kept, given)").select("a", "b")

    rows = near.where("open AND middle <> ''").groupBy("a", "middle").agg(F.min("d").alias("d"), F.sum("n").alias("w"))
    kinds = rows.groupBy("a").agg(F.collect_list(F.struct("d", "w", "middle")).alias("k")).where("size(k) > 1")
    best = "filter(k, x -> x.d = array_min(k).d)"
    top = kinds.selectExpr("a", f"{best} AS k").selectExpr("a", "array_max(transform(k, x -> struct(x.w, x.middle))) AS top", "aggregate(k, 0L, (s, x) -> s + x.w) AS every")
    middles = top.selectExpr("a", f"CASE WHEN top.w >= {CLEAR} * (every - top.w) THEN top.middle END AS meant")
    others = joined(near.where("middle <> ''"), middles, "a").where("meant IS NULL OR meant <> middle").select("a", "b")
    dropped = strangers.unionAll(others).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    out = joined(joined(links, dropped, ["a", "b"], "left_anti"), doubtful, "a", "left_anti")
    return joined(out, doubtful.withColumnRenamed("a", "b"), "b", "left_anti").select("a", "b")


def variants(rows: DataFrame) -> DataFrame:
    """(entity, serial_a, serial_b) of all rows (serial_no, bank_name, bank_location, examiner_in_charge): banks() and examiners() as pairs of rows."""
    return expanded(*banks(rows), "bank").unionAll(expanded(*examiners(rows), "examiner"))
