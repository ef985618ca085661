"""Cross-tabulation, slots and totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kuramori.session import cut


def crosstab(df: DataFrame, rows: Sequence[str], column: str, order: Sequence[str], total_excludes: Sequence[str] = (), drop_empty: bool = False) -> DataFrame:
    """Counts by ``rows`` and the values of ``column`` in a fixed order (absent ones 0), with ``Total``.

    Values outside the order are counted in ``Total`` only through an extra column ``unlisted``; null keys are a row of their own.
    The order is part of the plan, so no pass over the data looks for values."""
    known = F.col(column).isin(list(order))
    cells = [F.count_if(F.col(column) == v).alias(v) for v in order] + [F.count_if(F.coalesce(~known, F.lit(True))).alias("unlisted")]
    out = df.groupBy(*rows).agg(*cells)
    counted = [F.col(f"`{v}`") for v in order if v not in total_excludes] + ([] if "unlisted" in total_excludes else [F.col("unlisted")])
    total = counted[0]
    for c in counted[1:]:
        total = total + c
    out = out.withColumn("Total", total)
    return out.filter("Total > 0") if drop_empty else out


def crosstab_cartesian(df: DataFrame, a: str, b: str, column: str, order: Sequence[str], most: int = 10_000) -> DataFrame:
    """Crosstab over every combination of the observed values of two small keys, zero rows included; more than ``most`` values raise."""
    sides = [df.select(k).distinct() for k in (a, b)]
    if any(side.limit(most + 1).count() > most for side in sides):
        raise ValueError(f"more than {most} values of {a} or {b}")
    keys = sides[0].join(F.broadcast(sides[1]))
    cells = [F.count_if((F.col(column) == v)).alias(v) for v in order]
    counted = df.groupBy(a, b).agg(*cells)
    same = (keys[a].eqNullSafe(counted[a])) & (keys[b].eqNullSafe(counted[b]))
    return keys.join(counted, same, "left").select(keys[a], keys[b], *[F.coalesce(counted[f"`{v}`"], F.lit(0)).alias(v) for v in order])


def distinct_pivot_with_total(df: DataFrame, row: str, column: str, key: str, order: Sequence[str], total_row: str = "TOTAL") -> DataFrame:
    """Distinct keys by row and column; the total row and column count distinct keys over everything, they don't add up cells."""
    cells = [F.count_distinct(F.when(F.col(column) == v, F.col(key))).alias(v) for v in order] + [F.count_distinct(key).alias("Total")]
    body = df.groupBy(row).agg(*cells)
    return body.union(df.agg(*cells).select(F.lit(total_row).alias(row), *[F.col(f"`{v}`") for v in order], "Total"))


def fixed_order_counts(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """(value, n) for every value of a fixed order, 0 where absent."""
    cells = df.agg(*[F.count_if(F.col(column) == v).alias(v) for v in order])
    return cells.select(F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(v).alias("value"), F.col(f"`{v}`").alias("n")) for i, v in enumerate(order)])).alias("x")).select("x.*")


def slots(df: DataFrame, key: str, order: Sequence[Column], fields: Sequence[str], count: int, prefix: str = "risk") -> DataFrame:
    """Long to wide: the first ``count`` rows of a key under ``order`` in numbered columns ``<prefix>NN_<field>``, with the number of rows.

    One aggregation with conditional maxima instead of a join per slot."""
    numbered = df.withColumn("_slot", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    cells = [F.max(F.when(F.col("_slot") == n, F.col(f))).alias(f"{prefix}{n:02d}_{f}") for n in range(1, count + 1) for f in fields]
    return numbered.groupBy(key).agg(F.count("*").alias("slots"), *cells)


def overflowing(df: DataFrame, key: str, limit: int, show: int = 20) -> DataFrame:
    """The keys with more rows than slots, worst first: a top-``show`` report."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > limit).orderBy(F.desc("n"), key).limit(show)


def ordered_unique(value: Column, position: Column) -> Column:
    """Aggregate: distinct non-blank values in order of their first position, joined with ";"."""
    pairs = F.array_sort(F.collect_set(F.when(F.coalesce(F.trim(value), F.lit("")) != "", F.struct(position.alias("p"), F.trim(value).alias("v")))))
    return F.array_join(F.array_distinct(F.transform(pairs, lambda x: x["v"])), ";")


def sorted_unique(value: Column) -> Column:
    """Aggregate: distinct non-blank values in code point order, joined with ";"."""
    return F.array_join(F.array_sort(F.collect_set(F.when(F.coalesce(F.trim(value), F.lit("")) != "", F.trim(value)))), ";")


def numbered(df: DataFrame, group: str, order: str, number: str = "number") -> DataFrame:
    """``df`` with the running number (from 1) of each row within its group, by a unique order column. Rows are sorted by range over the
    cluster, numbered within each partition and raised by the counts of the partitions before, so no group lands in one task."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut(df.repartitionByRange(n, group, order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(group, "_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    here = F.row_number().over(Window.partitionBy(group, "_part").orderBy(order))
    at = ranged.withColumn("_here", here)
    return at.join(counts.withColumnsRenamed({group: "_group", "_part": "_other"}), F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_other"))).select(*df.columns, (F.col("_here") + F.col("_before")).alias(number))
