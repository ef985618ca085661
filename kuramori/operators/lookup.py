"""Look-ups with rules of precedence: unique-key cascades, first matching rules, code lists, row-wise priorities and upserts."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unique_key_cascade(df: DataFrame, reference: DataFrame, keys: Sequence[tuple[str, ...]], values: Sequence[str]) -> DataFrame:
    """``df`` with ``values`` of the reference row found by the first key (tuple of common columns) that is unique in the
    reference, and ``matched_by`` (position of that key from 1). Blank key parts never match."""
    out, found = df, []
    for n, key in enumerate(keys, 1):
        once = reference.groupBy(*key).agg(F.count("*").alias("_n"), *[F.first(v).alias(f"_{n}_{v}") for v in values]).filter("_n = 1").drop("_n")
        for k in key:
            once = once.filter(F.coalesce(F.trim(F.col(k).cast("string")), F.lit("")) != "")
        out = out.join(once.withColumn(f"_{n}", F.lit(n)), list(key), "left")
        found.append(n)
    picked = [reduce(lambda e, n, v=v: e.when(F.col(f"_{n}").isNotNull(), F.col(f"_{n}_{v}")), found[1:], F.when(F.col("_1").isNotNull(), F.col(f"_1_{v}"))).alias(v) for v in values]
    return out.select(*df.columns, *picked, F.coalesce(*[F.col(f"_{n}") for n in found]).alias("matched_by"))


def first_matching_rule(df: DataFrame, text: str, rules: DataFrame, pattern: str, order: Sequence[str], value: str, regex: bool = False, limit: int = 10_000) -> DataFrame:
    """``df`` with ``value`` of the first rule (by ``order``) whose pattern occurs in ``text``; null if none.

    The rule table is fixed and small: its size is checked, then one CASE holds all rules, in order, so that rows neither join nor
    shuffle. A regular expression that doesn't compile matches nothing."""
    rows = rules.select(*dict.fromkeys([*order, pattern, value])).distinct().orderBy(*order, pattern).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rules")
    out = None
    for r in rows:
        if regex and not _compiles(r[pattern]):
            continue
        hit = F.col(text).rlike(r[pattern]) if regex else F.col(text).contains(r[pattern])
        out = F.when(hit, r[value]) if out is None else out.when(hit, r[value])
    return df.withColumn(value, out if out is not None else F.lit(None).cast("string"))


def _compiles(pattern: str | None) -> bool:
    try:
        return bool(pattern) and re.compile(pattern) is not None
    except re.error:
        return False


def resolve_codes(df: DataFrame, fields: Sequence[str], codelist: DataFrame, by_type: DataFrame, type_column: str) -> DataFrame:
    """Long table (all columns of ``df`` but the triples, field, code, label, status) of coded attributes.

    An existing label wins; else (codespace file, code); else (type, field, code); else ``code:X``. The six triples of a row are
    unpivoted first, so each code list is joined once instead of once per field."""
    rest = [c for c in df.columns if not any(c in (f"{f}_code", f"{f}_label", f"{f}_codespace") for f in fields)]
    triple = lambda f: F.struct(F.lit(f).alias("field"), F.col(f"{f}_code").alias("code"), F.col(f"{f}_label").alias("label"), F.element_at(F.split(F.coalesce(f"{f}_codespace", F.lit("")), "/"), -1).alias("file"))
    long = df.select(*rest, F.explode(F.array(*[triple(f) for f in fields])).alias("x")).select(*rest, "x.*").filter(F.coalesce("code", F.lit("")) != "")
    a = codelist.select("file", "code", F.col("label").alias("_by_file"))
    b = by_type.select(F.col("type").alias(type_column), "field", "code", F.col("label").alias("_by_type"))
    out = long.join(a, ["file", "code"], "left").join(b, [type_column, "field", "code"], "left")
    own = F.nullif(F.trim("label"), F.lit(""))
    status = F.when(own.isNotNull(), "existing").when(F.col("_by_file").isNotNull(), "codelist").when(F.col("_by_type").isNotNull(), "by_type").otherwise("unresolved")
    return out.select(*rest, "field", "code", F.coalesce(own, "_by_file", "_by_type", F.concat(F.lit("code:"), F.col("code"))).alias("label"), status.alias("status"))


def colliding_codes(codelist: DataFrame) -> DataFrame:
    """(file, code, labels) of codes with several labels in one file: such a list must not be used."""
    return codelist.groupBy("file", "code").agg(F.count_distinct("label").alias("labels")).filter("labels > 1")


def priority_merge(sides: Sequence[tuple[DataFrame, Column]], keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Full outer merge of several tables on ``keys`` that takes whole rows, never single columns: for each key the row of the first
    side whose condition holds, sides without a valid row falling back to the first side that has the key at all."""
    tagged = [df.select(*keys, *columns, F.struct(F.when(ok, 0).otherwise(1).alias("a"), F.lit(n).alias("b")).alias("_p")) for n, (df, ok) in enumerate(sides)]
    every = reduce(DataFrame.unionByName, tagged)
    return every.groupBy(*keys).agg(F.min_by(F.struct(*columns), "_p").alias("_r")).select(*keys, "_r.*")


def upsert(df: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` replaced or extended by ``changes`` with the same key; columns are aligned by name."""
    return df.join(changes.select(*keys), list(keys), "left_anti").unionByName(changes, allowMissingColumns=True)


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows with surplus copies on either side, with ``side``."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).union(b.exceptAll(a).withColumn("side", F.lit("right")))


def best_with_conflict(df: DataFrame, key: str, priority: str, value: str) -> DataFrame:
    """(key, priority, value, candidates, conflict): the value of highest priority; several different values at the top conflict."""
    top = df.withColumn("_r", F.rank().over(Window.partitionBy(key).orderBy(F.desc(priority)))).filter("_r = 1")
    return top.groupBy(key).agg(F.max(priority).alias(priority), F.min(value).alias(value), F.count("*").alias("candidates"), (F.count_distinct(value) > 1).alias("conflict"))


def first_seen(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """``df`` with ``status``: ``first`` for the first row of a key under a total order, ``duplicate`` for the others."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("status", F.when(F.row_number().over(w) == 1, "first").otherwise("duplicate"))


def assert_none(df: DataFrame, message: str, show: int = 20) -> None:
    """Raise ``ValueError`` with the first rows if there are any: the form every data-quality invariant takes."""
    bad = df.limit(show).collect()
    if bad:
        raise ValueError(f"{message}: {[r.asDict() for r in bad]}")


def not_one_to_one(df: DataFrame, a: str, b: str) -> DataFrame:
    """Values of either column that go with several values of the other."""
    pairs = df.select(a, b).distinct()
    left = pairs.groupBy(F.col(a).cast("string").alias("value")).agg(F.count("*").alias("partners")).withColumn("side", F.lit(a))
    right = pairs.groupBy(F.col(b).cast("string").alias("value")).agg(F.count("*").alias("partners")).withColumn("side", F.lit(b))
    return left.union(right).filter("partners > 1")
