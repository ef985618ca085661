"""Domain views over the delivered tables: one row per key, codes and places in comparable form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kuramori.functions.classes import designation_level, designation_status, labelled
from kuramori.functions.geometry import place_of, plausible
from kuramori.functions.text import municipality_code
from kuramori.session import table


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Records without redelivered copies, with normalised designation, municipality and place (x, y)."""
    r = table(spark, folder, "records").drop("ingested_at").dropDuplicates(["record_uid"])
    x, y = place_of(F.col("geometry"), F.col("lon"), F.col("lat"))
    return (
        r.withColumn("code", municipality_code(F.col("municipality_code")))
        .withColumn("level", designation_level(F.col("designation_level_code")))
        .withColumn("status", designation_status(F.col("designation_status_code")))
        .withColumn("type_major", labelled(F.col("heritage_type_major_ja"), "未判定"))
        .withColumn("type_detail", labelled(F.col("heritage_type_detail"), "未細分"))
        .withColumn("x", x)
        .withColumn("y", y)
        .withColumn("located", plausible(F.col("x"), F.col("y")))
    )


def risks(spark: SparkSession, folder: str) -> DataFrame:
    """Flat risks without repeated rows."""
    return table(spark, folder, "plateau_disaster_risk").dropDuplicates(["building_gml_id", "risk_index"])


def points(spark: SparkSession, folder: str) -> DataFrame:
    """Hazard points without redelivered copies; no-data depths are null."""
    p = table(spark, folder, "hazard_points").drop("ingested_at").dropDuplicates(["point_id"])
    return p.withColumn("depth", F.when(F.col("inundation_depth_max_m") > -9000, F.col("inundation_depth_max_m")))


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Museum listings without redelivered copies."""
    m = table(spark, folder, "museum_location_review").drop("ingested_at").dropDuplicates(["museum_id"])
    return m.withColumn("code", municipality_code(F.col("municipality_code"))).withColumn("located", plausible(F.col("longitude"), F.col("latitude")))


def elements(spark: SparkSession, folder: str) -> DataFrame:
    """Map elements without redelivered copies."""
    return table(spark, folder, "osm_facilities").dropDuplicates(["osm_id"])


def observed(spark: SparkSession, folder: str) -> DataFrame:
    """Observed values without redelivered copies."""
    return table(spark, folder, "observed_values").drop("ingested_at").dropDuplicates(["obs_id"])


# The same views in DuckDB SQL.
SQL_RECORDS = """(SELECT *, lpad(regexp_replace(trim(coalesce(municipality_code,'')),'\\.0$',''),5,'0') AS code,
  CASE coalesce(designation_level_code,'') WHEN 'national' THEN 'National' WHEN 'prefectural' THEN 'Tokyo Metropolitan' WHEN 'municipal' THEN 'Municipal' ELSE 'Unknown' END AS level,
  CASE coalesce(designation_status_code,'') WHEN 'designated' THEN 'Designated' WHEN 'registered' THEN 'Registered' WHEN 'unknown' THEN 'Unknown' WHEN '' THEN 'Unknown' ELSE 'Other' END AS status,
  coalesce(nullif(heritage_type_major_ja,''),'未判定') AS type_major, coalesce(nullif(heritage_type_detail,''),'未細分') AS type_detail
  FROM (SELECT * EXCLUDE (ingested_at) FROM records QUALIFY row_number() OVER (PARTITION BY record_uid ORDER BY ingested_at) = 1))"""
SQL_PLACED = f"""(SELECT *, coalesce(x BETWEEN 120 AND 155 AND y BETWEEN 20 AND 50, false) AS located FROM (SELECT *,
  CASE WHEN geometry IS NULL OR trim(geometry) = '' THEN lon ELSE try_cast(nullif(regexp_extract(geometry,'(?i)^(?:SRID=\\d+;)?(?:(?:MULTI)?POINT ?Z? ?\\(+|\\{{.*\\[ ?)(-?[0-9.]+)[ ,]+(-?[0-9.]+)',1),'') AS DOUBLE) END AS x,
  CASE WHEN geometry IS NULL OR trim(geometry) = '' THEN lat ELSE try_cast(nullif(regexp_extract(geometry,'(?i)^(?:SRID=\\d+;)?(?:(?:MULTI)?POINT ?Z? ?\\(+|\\{{.*\\[ ?)(-?[0-9.]+)[ ,]+(-?[0-9.]+)',2),'') AS DOUBLE) END AS y
  FROM {SQL_RECORDS}))"""
SQL_RISKS = "(SELECT * FROM plateau_disaster_risk QUALIFY row_number() OVER (PARTITION BY building_gml_id, risk_index ORDER BY source_gml) = 1)"
SQL_POINTS = "(SELECT * EXCLUDE (ingested_at), CASE WHEN inundation_depth_max_m > -9000 THEN inundation_depth_max_m END AS depth FROM hazard_points QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY ingested_at) = 1)"
SQL_LISTINGS = """(SELECT * EXCLUDE (ingested_at), lpad(regexp_replace(trim(coalesce(municipality_code,'')),'\\.0$',''),5,'0') AS code,
  coalesce(longitude BETWEEN 120 AND 155 AND latitude BETWEEN 20 AND 50, false) AS located
  FROM museum_location_review QUALIFY row_number() OVER (PARTITION BY museum_id ORDER BY ingested_at) = 1)"""
SQL_ELEMENTS = "(SELECT * FROM osm_facilities QUALIFY row_number() OVER (PARTITION BY osm_id ORDER BY edited_at) = 1)"
SQL_OBSERVED = "(SELECT * EXCLUDE (ingested_at) FROM observed_values QUALIFY row_number() OVER (PARTITION BY obs_id ORDER BY ingested_at) = 1)"
