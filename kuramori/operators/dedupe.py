"""Keeping one row per key, with an explicit order wherever 'first' or 'last' has a meaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where the rows of a key repeat all data (redelivery). Partial aggregation drops copies map-side.

    Rows with a null key form a key of their own. An empty input gives an empty result."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(*[F.first(F.col(f"`{c}`")).alias(c) for c in rest]).select(*df.columns)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: int = 1) -> DataFrame:
    """Rows whose row number within ``keys`` under ``order`` is at most ``rank``. ``order`` must be total for a stable result."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= rank).drop("_rank")


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column], descending: bool = False) -> DataFrame:
    """Arg-min (or arg-max) row per key, by aggregation instead of a window: no sort, and copies combine map-side."""
    pick = F.max_by if descending else F.min_by
    packed = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(*keys).agg(pick(packed, F.struct(*order)).alias("_row")).select("_row.*")
