"""Free-entered values onto a reference list.

A multi-pattern automaton over all canonical names, readings and aliases finds the names embedded in a value in one pass;
the longest match wins, matches don't overlap. A value whose mentions don't decide (none long enough, or two codes of equal
length) goes to token-set similarity against all entries. What stays below the threshold is ``unmatched``.

The reference list is fixed and small (its size is checked); values are worked out once per distinct text and batch, without
any shuffle. Defined results: null and blank values give no mention and score 0; ties between codes are unmatched."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ENTRIES = 200_000  # more reference rows than this are refused: they'd be shipped to every task
SIMILARITY = 0.7
UNMATCHED = "unmatched"
# Words that decorate a type name without changing it.
DECORATION = re.compile(r"^(?:[国都道府県区市町村]?(?:指定|登録|選定)|[有無]形[・/]|【[^】]*】)|(?:\([^)]*\)?|[、,]附.*|\s*\d+[点件基棟]|類|ほか)$")


def folded(text: str | None) -> str:
    """Comparison key: compatibility form, no case, hiragana for katakana, letters and digits only."""
    s = unicodedata.normalize("NFKC", text or "").casefold()
    s = "".join(chr(ord(c) - 0x60) if "ァ" <= c <= "ヶ" else c for c in s)
    return "".join(c for c in s if c.isalnum() or c == "ー")


def tokens(key: str) -> Counter[str]:
    """Bag of tokens: neighbouring letter pairs of alphabetic text, single characters otherwise (their order may be changed)."""
    if key.isascii():
        padded = f"^{key}$"
        return Counter(padded[i : i + 2] for i in range(len(padded) - 1))
    return Counter(key)


def similarity(a: Counter[str], b: Counter[str]) -> float:
    """Token-set (Dice) similarity with multiplicity."""
    total = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / total if total else 0.0


def elements(bag: Counter[str]) -> list[tuple[str, int]]:
    """The bag as a set: the n-th occurrence of a token is an element of its own."""
    return [(t, n) for t, most in bag.items() for n in range(most)]


class Matcher:
    """The automaton and the token index of one reference list."""

    def __init__(self, entries: list[tuple[str, str]], threshold: float = SIMILARITY) -> None:
        self.threshold = threshold
        codes: dict[str, set[str]] = {}
        for code, name in entries:
            if key := folded(name):
                codes.setdefault(key, set()).add(code)
        self.code = {key: next(iter(c)) if len(c) == 1 else UNMATCHED for key, c in codes.items()}
        self.automaton = ahocorasick.Automaton()
        for key, code in self.code.items():
            if len(key) >= (5 if key.isascii() else 2):
                self.automaton.add_word(key, (len(key), code))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.bags = [(tokens(key), code) for key, code in self.code.items() if len(key) >= 3]
        self.often = Counter(e for bag, _ in self.bags for e in elements(bag))
        self.holding: dict[tuple[str, int], list[int]] = {}
        for k, (bag, _) in enumerate(self.bags):
            for e in self._rarest(bag):
                self.holding.setdefault(e, []).append(k)

    def _rarest(self, bag: Counter[str]) -> list[tuple[str, int]]:
        """The rarest elements, so many that two bags of at least the threshold share one: their overlap is at least
        threshold / (2 - threshold) of either."""
        own = sorted(elements(bag), key=lambda e: (self.often[e], e))
        return own[: len(own) - math.ceil(self.threshold / (2 - self.threshold) * len(own) - 1e-9) + 1]

    def similar(self, forms: list[Counter[str]]) -> dict[str, float]:
        """Best similarity per code, of all entries of at least the threshold."""
        out: dict[str, float] = {}
        for form in forms:
            for k in {k for e in self._rarest(form) for k in self.holding.get(e, ())}:
                bag, code = self.bags[k]
                if (score := similarity(form, bag)) >= self.threshold:
                    out[code] = max(out.get(code, 0.0), score)
        return out

    def mentions(self, key: str) -> list[tuple[int, int, str]]:
        """(start, end, code) of longest non-overlapping mentions, longest first."""
        if not len(self.automaton):
            return []
        found = sorted(((end - n + 1, end + 1, code) for end, (n, code) in self.automaton.iter(key)), key=lambda m: (m[0] - m[1], m[0]))
        out: list[tuple[int, int, str]] = []
        for m in found:
            if all(m[1] <= o[0] or m[0] >= o[1] for o in out):
                out.append(m)
        return out

    def match(self, value: str | None) -> tuple[str, str, float]:
        """(code, how, score)."""
        text = unicodedata.normalize("NFKC", value or "").strip()
        key = folded(text)
        if not key:
            return UNMATCHED, "empty", 0.0
        bare = text
        while (cut := DECORATION.sub("", bare).strip()) != bare and cut:
            bare = cut
        core = folded(bare) or key
        for k in (key, core):
            if k in self.code:
                return self.code[k], "mention" if self.code[k] != UNMATCHED else "tie", 1.0
        spans = self.mentions(core)
        if spans:
            longest = spans[0][1] - spans[0][0]
            best = {c for s, e, c in spans if e - s == longest}
            if len(best) == 1 and longest >= 3 and longest / len(core) >= 0.5:
                return best.pop(), "mention", longest / len(core)
        # an ending that looks like decoration may belong to the name
        scores = self.similar([tokens(k) for k in dict.fromkeys((key, core))])
        if not scores:
            return UNMATCHED, "none", 0.0
        top = max(scores.values())
        best = [code for code, score in scores.items() if score == top]
        return (best[0], "token_set", top) if len(best) == 1 and best[0] != UNMATCHED else (UNMATCHED, "tie", top)


def reference_entries(ref: DataFrame, code: str, names: list[str], lists: list[str]) -> list[tuple[str, str]]:
    """(code, name) of every spelling; ``lists`` are columns of ";"-separated aliases. Refuses more than MAX_ENTRIES rows."""
    rows = ref.select(code, *names, *lists).distinct().limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"the reference list has more than {MAX_ENTRIES} rows")
    out = []
    for r in sorted(rows, key=str):
        out += [(r[code], r[c]) for c in names if r[c]]
        out += [(r[code], a) for c in lists if r[c] for a in r[c].split(";")]
    return out


def map_values(df: DataFrame, value: str, entries: list[tuple[str, str]]) -> DataFrame:
    """``df`` with ``match`` (struct code, how, score) for its column ``value``."""

    @F.pandas_udf("struct<code string, how string, score double>")
    def matched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = Matcher(entries)
        for values in batches:
            known = {v: m.match(v) for v in values.dropna().unique()}
            yield pd.DataFrame([known.get(v, (UNMATCHED, "empty", 0.0)) for v in values], columns=["code", "how", "score"])

    return df.withColumn("match", matched(value))
