"""Human review and repeated deliveries: conflict ladders, indexes, decisions and their validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kuramori.operators.lookup import assert_none

# Decisions a reviewer can take.
CONFIRMED = ("single_building_human_selected", "multiple_buildings_human_selected", "machine_match_confirmed")
DECISIONS = (*CONFIRMED, "no_building", "unresolved")


def duplicate_ladder(df: DataFrame, key: str, order: Sequence[Column], digests: Sequence[tuple[str, str]], weight: str) -> DataFrame:
    """Every occurrence of a repeated key but the first, compared with the first: ``resolution`` names the first digest (column, name) that
    agrees, or ``unresolved``; ``preferred`` is the occurrence with the larger ``weight`` where the pair is resolved and they differ."""
    w = Window.partitionBy(key).orderBy(*order)
    n = df.withColumn("_n", F.row_number().over(w)).withColumn("_f", F.first(F.struct(*df.columns)).over(w)).filter("_n > 1")
    ladder = F.lit("unresolved")
    for column, name in reversed(list(digests)):
        ladder = F.when(F.col(column) == F.col(f"_f.{column}"), name).otherwise(ladder)
    out = n.withColumn("resolution", ladder)
    better = F.when(F.col(weight) > F.col(f"_f.{weight}"), "later").when(F.col(weight) < F.col(f"_f.{weight}"), "first")
    return out.withColumn("preferred", F.when(F.col("resolution") != "unresolved", better)).drop("_f").withColumnRenamed("_n", "occurrence")


def preferred_scan(df: DataFrame, key: str, preferred: DataFrame, excluded: DataFrame, source: str) -> DataFrame:
    """One occurrence per key: excluded (key, source) pairs are left out, a preferred source wins, else the first source by name."""
    mark = preferred.select(key, source).distinct().withColumn("_p", F.lit(1))
    rows = df.join(excluded.select(key, source), [key, source], "left_anti").join(mark, [key, source], "left")
    w = Window.partitionBy(key).orderBy(F.col("_p").desc_nulls_last(), source)
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_p")


def review_index(df: DataFrame, key: str, geometry: str, order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """(index, conflicts): the first row of each key; keys whose geometries differ are conflicts and in no index."""
    kinds = df.groupBy(key).agg(F.count_distinct(F.sha2(F.coalesce(F.col(geometry).cast("string"), F.lit("")), 256)).alias("geometries"))
    conflicts = kinds.filter("geometries > 1")
    w = Window.partitionBy(key).orderBy(*order)
    first = df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return first.join(conflicts.select(key), key, "left_anti"), conflicts


def split_ids(c: Column) -> Column:
    """Trimmed, non-blank members of a ";" list."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda v: F.trim(v)), lambda v: v != "")


def invalid_decisions(decisions: DataFrame, audit: DataFrame, neighbourhood: DataFrame) -> DataFrame:
    """(entity_id, problem) of decisions that break a rule: unknown or repeated entity, unknown decision, a confirmation without building,
    several buildings confirmed but fewer than two named, a building outside the entity's neighbourhood."""
    d = decisions.withColumn("_ids", split_ids(F.col("human_selected_building_ids")))
    problem = lambda df, text: df.select("entity_id", F.lit(text).alias("problem"))
    outside = d.select("entity_id", F.explode("_ids").alias("building_gml_id")).join(neighbourhood.select("entity_id", "building_gml_id").distinct(), ["entity_id", "building_gml_id"], "left_anti")
    found = [
        problem(d.join(audit.select("entity_id").distinct(), "entity_id", "left_anti"), "unknown entity"),
        problem(d.groupBy("entity_id").count().filter("count > 1"), "repeated entity"),
        problem(d.filter(~F.col("human_decision_type").isin(*DECISIONS) | F.col("human_decision_type").isNull()), "unknown decision"),
        problem(d.filter(F.col("human_decision_type").isin(*CONFIRMED) & (F.size("_ids") == 0)), "confirmed without building"),
        problem(d.filter((F.col("human_decision_type") == "multiple_buildings_human_selected") & (F.size("_ids") < 2)), "fewer than two buildings"),
        problem(outside, "building outside the neighbourhood"),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out.distinct()


def apply_decisions(audit: DataFrame, decisions: DataFrame, neighbourhood: DataFrame) -> DataFrame:
    """Audit with the decisions joined on and ``review_applied``; invalid decisions raise before anything is applied."""
    assert_none(invalid_decisions(decisions, audit, neighbourhood), "invalid decisions")
    d = decisions.select("entity_id", "human_decision_type", "human_selected_building_ids", F.lit(1).alias("_a"))
    return audit.drop("human_decision_type", "human_selected_building_ids").join(d, "entity_id", "left").withColumn("review_applied", F.coalesce("_a", F.lit(0))).drop("_a")


def invalid_spaces(spaces: DataFrame) -> DataFrame:
    """(space_id, problem) of spaces with contradictory floors or unknown presence."""
    rules = {
        "floors reversed": F.col("floor_min") > F.col("floor_max"),
        "elevations reversed": F.col("floor_elevation_min_m") > F.col("floor_elevation_max_m"),
        "basement above ground": F.coalesce(F.col("is_basement") == "yes", F.lit(False)) & (F.col("floor_max") > 0),
        "unknown presence": ~F.coalesce("presence_status", F.lit("")).isin("confirmed", "reported", "unknown", ""),
        "missing id": F.coalesce(F.trim("space_id"), F.lit("")) == "",
    }
    cells = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()])
    return spaces.select("space_id", F.explode(F.filter(cells, lambda v: v.isNotNull())).alias("problem"))
