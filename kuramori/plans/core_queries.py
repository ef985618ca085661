"""Queries of the two general problems: nested records (2) and points near points or regions (5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kuramori.functions.geometry import place_of, plausible
from kuramori.operators.nested import risk_scenarios, subtype_tables
from kuramori.operators.spatial import containing_polygons, within_distance
from kuramori.session import table

NEAR_M = 60.0


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """One row per scenario of each risk of each building or part (0: a risk without scenarios)."""
    return risk_scenarios(table(spark, folder, "building_raw"))


def p2_risks(spark: SparkSession, folder: str) -> DataFrame:
    """Flat risks of the newer delivery, with their parent building or part."""
    return subtype_tables(table(spark, folder, "building_raw"))["risks"].drop("raw_id")


def p2_buildings(spark: SparkSession, folder: str) -> DataFrame:
    """Flat buildings and parts with their parent."""
    t = subtype_tables(table(spark, folder, "building_raw"))
    return t["buildings"].union(t["parts"]).drop("raw_id")


def located_listings(spark: SparkSession, folder: str) -> DataFrame:
    """(museum_id, lon, lat) of listings at a plausible place."""
    m = table(spark, folder, "museum_location_review").filter(plausible(F.col("longitude"), F.col("latitude")))
    return m.select("museum_id", F.col("longitude").alias("lon"), F.col("latitude").alias("lat")).distinct()


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Records and hazard points within 60 m of each located listing, and the zones that contain it."""
    listings = located_listings(spark, folder)
    r = table(spark, folder, "records")
    x, y = place_of(F.col("geometry"), F.col("lon"), F.col("lat"))
    records = r.select(F.lit("record").alias("other_kind"), F.col("record_uid").alias("other_id"), x.alias("x"), y.alias("y"))
    hazards = table(spark, folder, "hazard_points").select(F.lit("hazard_point").alias("other_kind"), F.col("point_id").alias("other_id"), F.col("lon").alias("x"), F.col("lat").alias("y"))
    others = records.union(hazards).filter(plausible(F.col("x"), F.col("y")))
    near = within_distance(listings, others, NEAR_M).select("museum_id", "other_kind", "other_id").distinct()
    zones = table(spark, folder, "hazard_zones")
    inside = containing_polygons(listings, zones, "museum_id", "zone_id").select("museum_id", F.lit("zone").alias("other_kind"), F.col("zone_id").cast("long").alias("other_id"))
    return near.union(inside)


QUERIES = {"p2_found": p2_found, "p2_risks": p2_risks, "p2_buildings": p2_buildings, "p5_found": p5_found}


# DuckDB counterpart of p5_found: distances over a coarse grid of pairs, containment by even-odd ray casting over all rings.
SQL = {
    "p5_found": """WITH m AS (SELECT DISTINCT museum_id, longitude AS lon, latitude AS lat FROM museum_location_review WHERE longitude BETWEEN 120 AND 155 AND latitude BETWEEN 20 AND 50),
o AS (SELECT DISTINCT 'record' AS other_kind, record_uid AS other_id, x, y FROM (SELECT record_uid,
  CASE WHEN geometry IS NULL OR trim(geometry) = '' THEN lon ELSE try_cast(nullif(regexp_extract(geometry,'(?i)^(?:SRID=\\d+;)?(?:(?:MULTI)?POINT ?Z? ?\\(+|\\{.*\\[ ?)(-?[0-9.]+)[ ,]+(-?[0-9.]+)',1),'') AS DOUBLE) END AS x,
  CASE WHEN geometry IS NULL OR trim(geometry) = '' THEN lat ELSE try_cast(nullif(regexp_extract(geometry,'(?i)^(?:SRID=\\d+;)?(?:(?:MULTI)?POINT ?Z? ?\\(+|\\{.*\\[ ?)(-?[0-9.]+)[ ,]+(-?[0-9.]+)',2),'') AS DOUBLE) END AS y FROM records)
  UNION SELECT 'hazard_point', point_id, lon, lat FROM hazard_points),
near AS (SELECT DISTINCT museum_id, other_kind, other_id FROM m JOIN o ON x BETWEEN lon - 0.00085 AND lon + 0.00085 AND y BETWEEN lat - 0.00055 AND lat + 0.00055
  WHERE x BETWEEN 120 AND 155 AND y BETWEEN 20 AND 50 AND 2*6371008.8*asin(least(1.0, sqrt(pow(sin(radians(y-lat)/2),2)+cos(radians(lat))*cos(radians(y))*pow(sin(radians(x-lon)/2),2)))) <= 60),
rings AS (SELECT zone_id, unnest(regexp_extract_all(geometry, '\\(([^()]+)\\)', 1)) AS ring FROM hazard_zones), numbered AS (SELECT zone_id, row_number() OVER () AS ring_no, string_split(ring, ',') AS pts FROM rings),
pt AS (SELECT zone_id, ring_no, i, string_split(trim(pts[i]), ' ')[1]::DOUBLE AS px, string_split(trim(pts[i]), ' ')[2]::DOUBLE AS py FROM (SELECT zone_id, ring_no, pts, unnest(range(1, len(pts) + 1)) AS i FROM numbered)),
e AS (SELECT a.zone_id, a.px AS ax, a.py AS ay, b.px AS cx, b.py AS cy FROM pt a JOIN pt b ON a.ring_no = b.ring_no AND b.i = a.i + 1),
box AS (SELECT zone_id, min(px) AS x0, max(px) AS x1, min(py) AS y0, max(py) AS y1 FROM pt GROUP BY 1),
t AS (SELECT m.museum_id, box.zone_id, bool_or((cx-ax)*(lat-ay)-(cy-ay)*(lon-ax) = 0 AND lon BETWEEN least(ax,cx) AND greatest(ax,cx) AND lat BETWEEN least(ay,cy) AND greatest(ay,cy)) AS edge,
  count(*) FILTER (WHERE (ay > lat) <> (cy > lat) AND CASE WHEN cy > ay THEN (cx-ax)*(lat-ay)-(cy-ay)*(lon-ax) > 0 ELSE (cx-ax)*(lat-ay)-(cy-ay)*(lon-ax) < 0 END) AS crossed
  FROM m JOIN box ON lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1 JOIN e ON e.zone_id = box.zone_id GROUP BY 1, 2)
SELECT * FROM near UNION ALL SELECT museum_id, 'zone', zone_id FROM t WHERE edge OR crossed % 2 = 1""",
}
