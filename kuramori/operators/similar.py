"""Pairs of similar or contained names, found by equi-joins that lose none."""

from __future__ import annotations

import difflib
import itertools
import math
from collections import Counter

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kuramori.session import spread

PAIRED = range(2, 41)  # needed letters in common for which keys are two letters; one letter for shorter and longer names


def needed(a: int, b: int, threshold: float) -> int:
    """Letters two names of these lengths have in common at least, if their ratio 2 M / (a + b) reaches the threshold."""
    return max(1, math.ceil(threshold * (a + b) / 2 - 1e-9))


def ordered(name: str, frequency: dict[str, int]) -> list[tuple[int, str, int]]:
    """The letters of a name, repeated ones told apart by their number, rarest first; the same total order for all names."""
    seen: Counter[str] = Counter()
    out = []
    for c in name:
        seen[c] += 1
        out.append((frequency.get(c, 0) // seen[c] ** 2, c, seen[c]))
    return sorted(out)


def keys(name: str, lengths: list[int], left: bool, frequency: dict[str, int], threshold: float) -> list[int]:
    """Block keys of a name for every length of the other side.

    Two sets with t members in common have, of the first n - t + k members of each in one order, at least k in common. So a pair
    that reaches the threshold shares a key of k letters, made for its two lengths."""
    out, letters, n = set(), ordered(name, frequency), len(name)
    for m in lengths:
        t = needed(n, m, threshold)
        if t > min(n, m):
            continue
        k = 2 if t in PAIRED else 1
        sizes = f"{n}:{m}" if left else f"{m}:{n}"
        out |= {xxhash.xxh3_64_intdigest(f"{sizes}|" + "|".join(f"{c}{i}" for _, c, i in some)) - (1 << 63) for some in itertools.combinations(letters[: n - t + k], k)}
    return sorted(out)


def similar_pairs(left: DataFrame, right: DataFrame, a: str, b: str, threshold: float = 0.72) -> DataFrame:
    """(a, b, ratio) of all pairs of distinct names whose Ratcliff/Obershelp ratio reaches the threshold; empty names have none.

    Collected to the driver: the lengths that occur and the number of names with each character, both bounded by the alphabet."""
    names = [df.filter(F.length(c) > 0).select(F.col(c)).distinct() for df, c in ((left, a), (right, b))]
    lengths = [sorted(r[0] for r in df.select(F.length(c)).distinct().collect()) for df, c in zip(names, (a, b))]
    each = names[0].select(F.col(a).alias("n")).union(names[1].select(F.col(b).alias("n")))
    frequency = dict(each.select(F.explode(F.array_distinct(F.split("n", ""))).alias("c")).groupBy("c").count().collect())

    def keyed(df: DataFrame, c: str, others: list[int], first: bool) -> DataFrame:
        @F.pandas_udf("array<long>")
        def block(s: pd.Series) -> pd.Series:
            return s.map(lambda v: keys(v, others, first, frequency, threshold))

        return spread(df).select(c, F.explode(block(c)).alias("_k"))

    def close(x: pd.Series, y: pd.Series) -> pd.Series:
        found = (difflib.SequenceMatcher(None, v, w) for v, w in zip(x, y))
        return pd.Series([m.ratio() if m.quick_ratio() >= threshold else 0.0 for m in found], dtype="float64")

    # keys are many times the names, which the size estimate of the plan doesn't see: never broadcast
    pairs = keyed(names[0], a, lengths[1], True).hint("merge").join(keyed(names[1], b, lengths[0], False), "_k").select(a, b).distinct()
    # not deterministic to the optimiser, else the filter is computed before the distinct, once for every shared key, and again after it
    exact = F.pandas_udf(close, "double").asNondeterministic()
    return spread(pairs).withColumn("ratio", exact(a, b)).filter(F.col("ratio") >= threshold)


def contained_pairs(left: DataFrame, right: DataFrame, a: str, b: str, least: int = 4) -> DataFrame:
    """(a, b) of all pairs of distinct names of which one contains the other and the shorter has enough letters."""

    def inside(long: DataFrame, x: str, short: DataFrame, y: str) -> DataFrame:
        whole = short.filter(F.length(y) >= least).select(y).distinct()
        sizes = [r[0] for r in whole.select(F.length(y)).distinct().collect()]
        part = lambda n: F.transform(F.sequence(F.lit(1), F.length(x) - n + 1), lambda i: F.substring(F.col(x), i, F.lit(n)))
        parts: list[Column] = [F.when(F.length(x) >= n, part(n)).otherwise(F.array().cast("array<string>")) for n in sizes]
        if not parts:
            return long.select(x).crossJoin(whole).limit(0)
        return long.select(x).distinct().select(x, F.explode(F.array_distinct(F.concat(*parts))).alias(y)).join(whole, y)

    return inside(left, a, right, b).select(a, b).union(inside(right, b, left, a).select(a, b)).distinct()
