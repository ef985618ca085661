"""Small selections with stated rules: boxes, best or review, latest, first or longest, positive hazards, column housekeeping."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Degrees of padding around targets, and around bounds when hazard points are read.
TARGET_PAD, READ_MARGIN = 0.0003, 0.001
# Facility types, the specific ones before the general ones.
FACILITY_PRIORITY = {"history": 90, "art": 90, "science": 90, "literature": 90, "zoo": 80, "botanical": 80, "museum": 10}


def in_bounds(df: DataFrame, targets: DataFrame, xy: tuple[str, str], target_xy: tuple[str, str], margin: float = READ_MARGIN) -> DataFrame:
    """Rows inside the bounds of the targets with a margin; without any target no row. The bounds are one broadcast row, and the
    comparison is on plain columns."""
    a, b = target_xy
    box = targets.agg((F.min(a) - margin).alias("_x0"), (F.max(a) + margin).alias("_x1"), (F.min(b) - margin).alias("_y0"), (F.max(b) + margin).alias("_y1"))
    return df.join(F.broadcast(box), F.col(xy[0]).between(F.col("_x0"), F.col("_x1")) & F.col(xy[1]).between(F.col("_y0"), F.col("_y1"))).drop("_x0", "_x1", "_y0", "_y1")


def near_extent(df: DataFrame, extent: tuple[float, float, float, float] | None, xy: tuple[str, str], pad: float = TARGET_PAD) -> DataFrame:
    """Rows in a padded extent known beforehand (a pushed-down range); no extent means no filter."""
    if extent is None:
        return df
    x0, y0, x1, y1 = extent
    return df.filter(F.col(xy[0]).between(x0 - pad, x1 + pad) & F.col(xy[1]).between(y0 - pad, y1 + pad))


def box_around(lon: float, lat: float, radius_km: float) -> tuple[float, float, float, float]:
    """(xmin, ymin, xmax, ymax) of a square around a centre."""
    dy = radius_km / 111.32
    dx = dy / max(0.05, math.cos(math.radians(lat)))
    return lon - dx, lat - dy, lon + dx, lat + dy


def best_or_review(df: DataFrame, key: str, value: str, score: str, threshold: int = 70) -> DataFrame:
    """(key, value, score, status): scores are first maximised per value; the best value is accepted from the threshold on, several best
    values or a lower score go to review. Null values don't count."""
    per = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.max(score).alias(score))
    top = per.groupBy(key).agg(F.max(score).alias("_best"))
    best = per.join(top, key).filter(F.col(score) == F.col("_best")).groupBy(key).agg(F.min(value).alias(value), F.max(score).alias(score), F.count("*").alias("_n"))
    status = F.when(F.col(score) < threshold, "below_threshold").when(F.col("_n") > 1, "tie").otherwise("accepted")
    return best.withColumn("status", status).drop("_n")


def latest(df: DataFrame, key: str, year: str, order: Sequence[Column]) -> DataFrame:
    """Row of the greatest year per key; the first in ``order`` wins among equal years, null years lose."""
    w = Window.partitionBy(key).orderBy(F.col(year).desc_nulls_last(), *order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def first_or_longest(value: Column, position: Column, longest: bool = False) -> Column:
    """Aggregate: first filled value by position, or the longest one (the earliest of equally long); '' if none."""
    filled = F.when(F.trim(F.coalesce(value, F.lit(""))) != "", F.trim(value))
    order = F.struct(-F.length(filled), position) if longest else F.struct(position)
    return F.coalesce(F.min_by(filled, F.when(filled.isNotNull(), order)), F.lit(""))


def facility_type(value: Column, position: Column) -> Column:
    """Aggregate: the most specific type, the earliest of equally specific ones; ``museum`` if none."""
    priority = F.lit(50)
    for name, p in FACILITY_PRIORITY.items():
        priority = F.when(value == name, p).otherwise(priority)
    filled = F.when(F.coalesce(value, F.lit("")) != "", value)
    return F.coalesce(F.min_by(filled, F.when(filled.isNotNull(), F.struct(-priority, position))), F.lit("museum"))


def positive_hazard(df: DataFrame, depth: str, rank: str | None = None, no_data: float = -9000.0) -> DataFrame:
    """Rows with some water: depth above 0, else rank above 0; no-data depths are missing, and rows with neither are left out."""
    d = F.when(F.col(depth) > no_data, F.col(depth))
    r = F.col(rank).cast("string").try_cast("double") if rank else F.lit(None).cast("double")
    return df.filter(F.coalesce(d > 0, r > 0, F.lit(False)))


def one_name(df: DataFrame, column: str, part: str) -> str:
    """The one value that contains a text; none or several are an error."""
    found = [r[0] for r in df.filter(F.col(column).contains(part)).select(column).distinct().limit(6).collect()]
    if part in found:
        return part
    if len(found) != 1:
        raise ValueError(f"{part!r} names {sorted(found) or 'nothing'}")
    return found[0]


def area_code(code: str) -> tuple[str, str]:
    """("prefecture" or "municipality", code) of a valid area code of two or five digits."""
    s = str(code).strip()
    if not re.fullmatch(r"\d{2}|\d{5}", s) or not 1 <= int(s[:2]) <= 47:
        raise ValueError(f"not an area code: {code!r}")
    return ("prefecture" if len(s) == 2 else "municipality"), s


def without_columns(df: DataFrame, pattern: str) -> DataFrame:
    """Columns whose names match a pattern dropped, before they are built anew."""
    return df.drop(*[c for c in df.columns if re.match(pattern, c)])


def with_columns(df: DataFrame, names: Sequence[str], value: str = "") -> DataFrame:
    """Missing columns added with a constant."""
    return df.select("*", *[F.lit(value).alias(n) for n in names if n not in df.columns])


def first_nonempty(candidates: Sequence[DataFrame]) -> DataFrame | None:
    """The first table that has rows."""
    return next((df for df in candidates if not df.isEmpty()), None)


def backfilled(df: DataFrame, list_column: str, records: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """``df`` with ``fields`` filled by the ordered distinct values of the records in a ";" list column."""
    from kuramori.operators.tables import ordered_unique

    ids = df.select(list_column).distinct().select(list_column, F.posexplode(F.split(list_column, ";")).alias("_p", "_id")).withColumn("_id", F.trim("_id"))
    r = records.select(F.col(key).cast("string").alias("_id"), *[F.col(f).alias(f"_{f}") for f in fields])
    found = ids.join(r, "_id").groupBy(list_column).agg(*[ordered_unique(F.col(f"_{f}"), F.col("_p")).alias(f"_{f}") for f in fields])
    out = df.join(found, list_column, "left")
    for f in fields:
        own = F.nullif(F.trim(F.col(f)), F.lit("")) if f in df.columns else F.lit(None).cast("string")
        out = out.withColumn(f, F.coalesce(own, F.col(f"_{f}"), F.lit("")))
    return out.drop(*[f"_{f}" for f in fields])
