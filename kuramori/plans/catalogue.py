"""Queries for the reference operators, one or more per operator, each with its SQL counterpart where SQL can express it.

Names say what is computed; the operator numbers of the survey are in the docstrings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kuramori.functions import classes as C
from kuramori.functions import shapes
from kuramori.functions import text as X
from kuramori.functions.geometry import haversine_m, plausible
from kuramori.functions.mesh import cell_box, code_of
from kuramori.operators import lookup, selection, similar, spatial, tables
from kuramori.operators.dedupe import best_row, ranked
from kuramori.plans import pipelines
from kuramori.plans import views as V
from kuramori.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
R, P, K, G, L, E, O = V.SQL_RECORDS, V.SQL_PLACED, V.SQL_RISKS, V.SQL_POINTS, V.SQL_LISTINGS, V.SQL_ELEMENTS, V.SQL_OBSERVED


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def case(x: str, borders: list[float], labels: list[str], op: str, missing: str) -> str:
    """CASE text of a binned class."""
    arms = " ".join(f"WHEN {x} {op} {b} THEN '{label}'" for b, label in zip(borders, labels))
    return f"CASE WHEN {x} IS NULL THEN '{missing}' {arms} ELSE '{labels[-1]}' END"


DEPTH_A = "CASE WHEN {x} <= 0 THEN '0' WHEN {x} IS NULL THEN 'No data' WHEN {x} < 0.5 THEN '0–0.5 m' WHEN {x} < 3 THEN '0.5–3 m' WHEN {x} < 5 THEN '3–5 m' ELSE '5 m以上' END"
DEPTH_B = case("{x}", [0, 0.5, 3, 5], C.DEPTH_CLASSES, "<=", "")
LIQUEFACTION = case("{x}", [0, 5, 15], C.LIQUEFACTION_CLASSES[:4], "<=", "No data")
SEISMIC = case("{x}", [4.5, 5, 5.5, 6], C.SEISMIC_CLASSES[:5], "<", "No data")


def cells(column: str, order: list[str]) -> str:
    """Pivot cells of a fixed order."""
    return ", ".join(f"count(*) FILTER (WHERE {column} = '{v}') AS \"{v}\"" for v in order)


def other(column: str, order: list[str]) -> str:
    values = ",".join(f"'{v}'" for v in order)
    return f"count(*) FILTER (WHERE {column} IS NULL OR {column} NOT IN ({values})) AS unlisted"


LEVELS = ["National", "Tokyo Metropolitan", "Municipal", "Unknown"]
STATUSES = ["Designated", "Registered", "Other", "Unknown"]
DEPTHS = [*C.DEPTH_CLASSES, C.NO_DATA]


# ---- counts and crosstabs -------------------------------------------------------------------------------------------------


@query(f"SELECT code, count(*) AS record_count FROM {R} r GROUP BY code")
def municipality_record_counts(spark, d):
    """Records per municipality."""
    return V.records(spark, d).groupBy("code").agg(F.count("*").alias("record_count")).orderBy("code")


@query(f'SELECT code, {cells("level", LEVELS)}, {other("level", LEVELS)}, count(*) AS "Total" FROM {R} r GROUP BY code')
def municipality_level_crosstab(spark, d):
    """Municipality by designation level."""
    return tables.crosstab(V.records(spark, d), ["code"], "level", LEVELS)


@query(f'SELECT code, {cells("status", STATUSES)}, {other("status", STATUSES)}, count(*) AS "Total" FROM {R} r GROUP BY code')
def municipality_status_crosstab(spark, d):
    """Municipality by designation status."""
    return tables.crosstab(V.records(spark, d), ["code"], "status", STATUSES)


@query(f"WITH r AS (SELECT * FROM {R}), k AS (SELECT * FROM (SELECT DISTINCT type_major FROM r), (SELECT DISTINCT status FROM r)) SELECT k.type_major, k.status, " + ", ".join(f"count(CASE WHEN r.level = '{v}' THEN 1 END) AS \"{v}\"" for v in LEVELS) + " FROM k LEFT JOIN r ON r.type_major = k.type_major AND r.status = k.status GROUP BY 1, 2")
def type_status_level_cartesian(spark, d):
    """All combinations of type and status, zero rows kept."""
    return tables.crosstab_cartesian(V.records(spark, d), "type_major", "status", "level", LEVELS)


@query(f"SELECT coalesce(entity_class,'unknown') AS entity_class, coalesce(entity_class,'') = 'movable' AS movable, count(*) AS n FROM {R} r GROUP BY 1, 2")
def entity_split(spark, d):
    """Movable and immovable records."""
    r = V.records(spark, d)
    return r.groupBy(F.coalesce("entity_class", F.lit("unknown")).alias("entity_class"), (F.coalesce("entity_class", F.lit("")) == "movable").alias("movable")).agg(F.count("*").alias("n"))


@query(f"SELECT v.position::INT AS position, v.value, count(r.level) AS n FROM (VALUES (0,'National'),(1,'Tokyo Metropolitan'),(2,'Municipal'),(3,'Unknown')) v(position, value) LEFT JOIN {R} r ON r.level = v.value GROUP BY 1, 2")
def level_counts_fixed_order(spark, d):
    """Counts in a fixed order, zeros included."""
    return tables.fixed_order_counts(V.records(spark, d), "level", LEVELS)


@query(f"""WITH r AS (SELECT * FROM {R}) SELECT code, count(DISTINCT CASE WHEN status='Designated' THEN record_uid END) AS "Designated", count(DISTINCT CASE WHEN status='Registered' THEN record_uid END) AS "Registered", count(DISTINCT record_uid) AS "Total" FROM r GROUP BY code
UNION ALL SELECT 'TOTAL', count(DISTINCT CASE WHEN status='Designated' THEN record_uid END), count(DISTINCT CASE WHEN status='Registered' THEN record_uid END), count(DISTINCT record_uid) FROM r""")
def distinct_pivot_total(spark, d):
    """Distinct records by municipality and status with a total row that counts anew."""
    return tables.distinct_pivot_with_total(V.records(spark, d), "code", "status", "record_uid", ["Designated", "Registered"])


@query(f"SELECT level, status, count(*) AS n FROM {R} r GROUP BY ROLLUP (level, status)")
def level_status_rollup(spark, d):
    """Totals over both dimensions."""
    return V.records(spark, d).rollup("level", "status").agg(F.count("*").alias("n"))


# ---- classes over hazard values -------------------------------------------------------------------------------------------


@query(f"SELECT scenario, {DEPTH_A.format(x='depth')} AS depth_class, count(*) AS n FROM {G} p GROUP BY 1, 2")
def depth_class_counts(spark, d):
    """left-closed depth classes per scenario."""
    return V.points(spark, d).groupBy("scenario", C.depth_class(F.col("depth")).alias("depth_class")).agg(F.count("*").alias("n"))


@query(f"SELECT scenario, {DEPTH_B.format(x='depth')} AS depth_class, count(*) AS n FROM {G} p GROUP BY 1, 2")
def depth_class_map_counts(spark, d):
    """right-closed depth classes per scenario."""
    return V.points(spark, d).groupBy("scenario", C.depth_class_map(F.col("depth")).alias("depth_class")).agg(F.count("*").alias("n"))


@query(f"SELECT {SEISMIC.format(x='ground_elevation_m')} AS seismic_class, count(*) AS n FROM {G} p GROUP BY 1")
def seismic_class_counts(spark, d):
    """the intensity borders on a numeric field."""
    return V.points(spark, d).groupBy(C.seismic_class(F.col("ground_elevation_m")).alias("seismic_class")).agg(F.count("*").alias("n"))


LIQ = C.LIQUEFACTION_CLASSES
@query(f'SELECT * FROM (SELECT municipality_code, {cells("c", LIQ)}, {other("c", LIQ)}, count(*) FILTER (WHERE c <> \'No data\') AS "Total" FROM (SELECT municipality_code, {LIQUEFACTION.format(x="depth")} AS c FROM {G} p) GROUP BY 1) WHERE "Total" > 0')
def liquefaction_crosstab(spark, d):
    """Total without No data, empty rows dropped."""
    p = V.points(spark, d).withColumn("c", C.liquefaction_class(F.col("depth")))
    return tables.crosstab(p, ["municipality_code"], "c", LIQ, total_excludes=["No data", "unlisted"], drop_empty=True)


@query(f"SELECT rank_code, CASE WHEN coalesce(try_cast(rank_code AS DOUBLE),0) <= 0 THEN '0' WHEN try_cast(rank_code AS INT)=1 THEN '0–0.5 m' WHEN try_cast(rank_code AS INT)=2 THEN '0.5–3 m' WHEN try_cast(rank_code AS INT)=3 THEN '3–5 m' ELSE '5 m以上' END AS category, count(*) AS n FROM {K} k GROUP BY 1, 2")
def flood_rank_categories(spark, d):
    """category of a flood rank."""
    return V.risks(spark, d).groupBy("rank_code", C.rank_category(F.col("rank_code")).alias("category")).agg(F.count("*").alias("n"))


@query(f"SELECT building_gml_id, risk_index, CASE lower(trim(depth_uom)) WHEN '' THEN depth_value WHEN 'm' THEN depth_value WHEN 'cm' THEN depth_value/100 WHEN 'mm' THEN depth_value/1000 END AS metres, CASE lower(trim(duration_uom)) WHEN '' THEN duration_value WHEN 'h' THEN duration_value WHEN 'hour' THEN duration_value WHEN 'hours' THEN duration_value WHEN 'min' THEN duration_value/60 WHEN 's' THEN duration_value/3600 END AS hours FROM {K} k")
def risk_units(spark, d):
    """lengths in metres, durations in hours."""
    k = V.risks(spark, d)
    return k.select("building_gml_id", "risk_index", C.metres(F.col("depth_value"), F.col("depth_uom")).alias("metres"), C.hours(F.col("duration_value"), F.col("duration_uom")).alias("hours"))


@query(f"SELECT code, coalesce(['low','medium','high'][min(CASE classification_confidence WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 END)], 'low') AS confidence FROM {R} r GROUP BY code")
def least_confidence_by_municipality(spark, d):
    """the lowest confidence present."""
    r = V.records(spark, d).groupBy("code").agg(F.collect_set("classification_confidence").alias("all"))
    return r.select("code", C.least_confidence(F.col("all")).alias("confidence"))


# ---- mesh and spatial joins -----------------------------------------------------------------------------------------------

MESH_SQL = """lpad((floor(floor({y}*120)/80))::INT::VARCHAR,2,'0') || lpad((floor(floor(({x}-100)*80)/80))::INT::VARCHAR,2,'0') || (floor((floor({y}*120)::INT % 80)/10))::INT::VARCHAR || (floor((floor(({x}-100)*80)::INT % 80)/10))::INT::VARCHAR || (floor({y}*120)::INT % 10)::VARCHAR || (floor(({x}-100)*80)::INT % 10)::VARCHAR"""


@query(f"""WITH r AS (SELECT record_uid, code, CASE WHEN located THEN {MESH_SQL.format(x='x', y='y')} END AS mesh FROM {P} p), m AS (SELECT {MESH_SQL.format(x='lon', y='lat')} AS mesh, max(depth) AS value FROM {G} g WHERE lon IS NOT NULL GROUP BY 1),
j AS (SELECT r.code, {DEPTH_A.format(x='m.value')} AS c FROM r LEFT JOIN m ON r.mesh = m.mesh) SELECT code, {cells('c', DEPTHS)}, {other('c', DEPTHS)}, count(*) AS "Total" FROM j GROUP BY code""")
def mesh_depth_by_municipality(spark, d):
    """Records by municipality and the worst depth of their mesh cell, through an equi-join on the cell's code."""
    r = V.records(spark, d).select("record_uid", "code", F.when(F.col("located"), code_of(F.col("x"), F.col("y"), 8)).alias("mesh"))
    m = V.points(spark, d).groupBy(code_of(F.col("lon"), F.col("lat"), 8).alias("mesh")).agg(F.max("depth").alias("value"))
    j = r.join(m, "mesh", "left").withColumn("c", C.depth_class(F.col("value")))
    return tables.crosstab(j, ["code"], "c", DEPTHS)


@query(f"SELECT scenario, {MESH_SQL.format(x='lon', y='lat')} AS mesh, count(*) AS n, max(depth) AS deepest FROM {G} p WHERE lon IS NOT NULL AND lat IS NOT NULL GROUP BY 1, 2")
def mesh_of_points(spark, d):
    """Third-order mesh of every point, worst value per cell and scenario."""
    p = V.points(spark, d).filter("lon is not null and lat is not null")
    return p.groupBy("scenario", code_of(F.col("lon"), F.col("lat"), 8).alias("mesh")).agg(F.count("*").alias("n"), F.max("depth").alias("deepest"))


BOX_SQL = f"""WITH p AS (SELECT point_id, lon, lat, {MESH_SQL.format(x='lon', y='lat')} AS third, lat*120 - floor(lat*120) AS fy, (lon-100)*80 - floor((lon-100)*80) AS fx FROM {G} g WHERE lon IS NOT NULL AND lat IS NOT NULL),
o AS (SELECT *, substr(third,1,2)::INT*2.0::DOUBLE/3 + substr(third,5,1)::INT*5.0::DOUBLE/60 + substr(third,7,1)::INT*30.0::DOUBLE/3600 AS y0, 100.0::DOUBLE + substr(third,3,2)::INT + substr(third,6,1)::INT*7.5::DOUBLE/60 + substr(third,8,1)::INT*45.0::DOUBLE/3600 AS x0,
  least(19, floor(fy*20)::INT) AS iy, least(19, floor(fx*20)::INT) AS ix, floor(fy*4)::INT AS qy, floor(fx*4)::INT AS qx FROM p),
b AS (SELECT point_id, lon, lat, third || lpad(iy::VARCHAR,2,'0') || lpad(ix::VARCHAR,2,'0') AS mesh, x0 + ix*(45.0::DOUBLE/3600/20) AS xmin, y0 + iy*(30.0::DOUBLE/3600/20) AS ymin, 45.0::DOUBLE/3600/20 AS w, 30.0::DOUBLE/3600/20 AS h FROM o
  UNION ALL SELECT point_id, lon, lat, third || (1 + qx//2 + 2*(qy//2))::VARCHAR || (1 + qx%2 + 2*(qy%2))::VARCHAR, x0 + qx*(45.0::DOUBLE/3600/4), y0 + qy*(30.0::DOUBLE/3600/4), 45.0::DOUBLE/3600/4, 30.0::DOUBLE/3600/4 FROM o)
SELECT point_id, lon, lat, mesh, round(xmin, 8) AS xmin, round(ymin, 8) AS ymin, round(xmin + w, 8) AS xmax, round(ymin + h, 8) AS ymax FROM b"""


@query(BOX_SQL)
def mesh_boxes(spark, d):
    """50 m and 250 m cells of the points, decoded; every point lies in its own cell (tested)."""
    p = V.points(spark, d).filter("lon is not null and lat is not null")
    codes = p.select("point_id", "lon", "lat", F.explode(F.array(code_of(F.col("lon"), F.col("lat"), 12), code_of(F.col("lon"), F.col("lat"), 10))).alias("mesh"))
    return codes.select("point_id", "lon", "lat", "mesh", cell_box(F.col("mesh")).alias("b")).select("point_id", "lon", "lat", "mesh", *[F.round(f"b.{c}", 8).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query(f"""WITH e AS (SELECT gml_id, ring_no, i, ring[i] AS a, ring[CASE WHEN i = len(ring) THEN 1 ELSE i + 1 END] AS b FROM (SELECT gml_id, ring_no, ring, unnest(range(1, len(ring) + 1)) AS i FROM (SELECT gml_id, generate_subscripts(rings, 1) AS ring_no, unnest(rings) AS ring FROM buildings))),
box AS (SELECT gml_id, ring_no, min(a.x) AS x0, max(a.x) AS x1, min(a.y) AS y0, max(a.y) AS y1 FROM e GROUP BY 1, 2),
near AS (SELECT p.record_uid, box.gml_id, box.ring_no, p.x, p.y FROM {P} p JOIN box ON p.located AND p.x BETWEEN x0 AND x1 AND p.y BETWEEN y0 AND y1),
t AS (SELECT near.record_uid, near.gml_id, near.ring_no, bool_or((b.x-a.x)*(near.y-a.y)-(b.y-a.y)*(near.x-a.x) = 0 AND near.x BETWEEN least(a.x,b.x) AND greatest(a.x,b.x) AND near.y BETWEEN least(a.y,b.y) AND greatest(a.y,b.y)) AS edge,
  count(*) FILTER (WHERE (a.y > near.y) <> (b.y > near.y) AND CASE WHEN b.y > a.y THEN (b.x-a.x)*(near.y-a.y)-(b.y-a.y)*(near.x-a.x) > 0 ELSE (b.x-a.x)*(near.y-a.y)-(b.y-a.y)*(near.x-a.x) < 0 END) AS crossed FROM near JOIN e USING (gml_id, ring_no) GROUP BY 1, 2, 3)
SELECT DISTINCT record_uid, gml_id FROM t WHERE edge OR crossed % 2 = 1""")
def records_in_footprints(spark, d):
    """Records inside or on building footprints."""
    r = V.records(spark, d).filter("located")
    return spatial.in_box_rings(r, table(spark, d, "buildings"), "record_uid", "gml_id", "rings", ("x", "y"))


NEAREST_REACH = 25.0
MERC_X, MERC_Y = "radians({x})*6378137.0", "ln(tan(pi()/4+radians({y})/2))*6378137.0"
@query(f"""WITH r AS (SELECT record_uid, {MERC_X.format(x='x')} AS mx, {MERC_Y.format(y='y')} AS my FROM {P} p WHERE located), g AS (SELECT point_id, depth, {MERC_X.format(x='lon')} AS gx, {MERC_Y.format(y='lat')} AS gy FROM {G} p),
c AS (SELECT r.record_uid, g.point_id, g.depth, (mx-gx)*(mx-gx)+(my-gy)*(my-gy) AS d2 FROM r JOIN g ON gx BETWEEN mx-25 AND mx+25 AND gy BETWEEN my-25 AND my+25)
SELECT record_uid, point_id, depth FROM c WHERE d2 <= 625 QUALIFY rank() OVER (PARTITION BY record_uid ORDER BY d2) = 1""")
def nearest_point_depth(spark, d):
    """Nearest hazard point within 25 planar units of each located record, ties kept."""
    rx, ry = spatial.to_mercator(F.col("x"), F.col("y"))
    px, py = spatial.to_mercator(F.col("lon"), F.col("lat"))
    r = V.records(spark, d).filter("located").select("record_uid", rx.alias("rx"), ry.alias("ry"))
    p = V.points(spark, d).select("point_id", "depth", px.alias("px"), py.alias("py"))
    return spatial.nearest_within(r, p, "record_uid", NEAREST_REACH, ("rx", "ry"), ("px", "py")).select("record_uid", "point_id", "depth")


HAV = "2*6371008.8*asin(least(1.0, sqrt(pow(sin(radians({b}-{a})/2),2)+cos(radians({a}))*cos(radians({b}))*pow(sin(radians({d}-{c})/2),2))))"
@query(f"""WITH b AS (SELECT gml_id, avg(p.x) AS bx, avg(p.y) AS by FROM (SELECT gml_id, unnest(flatten(rings)) AS p FROM buildings) GROUP BY gml_id), m AS (SELECT * FROM {L} l WHERE located),
c AS (SELECT m.museum_id, b.gml_id, round({HAV.format(a='m.latitude', b='b.by', c='m.longitude', d='b.bx')}, 3) AS metres FROM m JOIN b ON abs(b.by - m.latitude) < 0.0019 AND abs(b.bx - m.longitude) < 0.003)
SELECT museum_id, gml_id, metres FROM c WHERE metres <= 200 QUALIFY row_number() OVER (PARTITION BY museum_id ORDER BY metres, gml_id) <= 12""")
def review_neighbourhood(spark, d):
    """At most 12 nearest buildings within 200 m of each located listing."""
    ring = table(spark, d, "buildings").select("gml_id", F.explode(F.flatten("rings")).alias("p"))
    b = ring.groupBy("gml_id").agg(F.avg("p.x").alias("bx"), F.avg("p.y").alias("by"))
    m = V.listings(spark, d).filter("located").select("museum_id", "longitude", "latitude")
    near = spatial.within_distance(m, b, 200.0, ("longitude", "latitude"), ("bx", "by")).withColumn("metres", F.round("distance_m", 3)).filter("metres <= 200")
    return ranked(near.select("museum_id", "gml_id", "metres"), ["museum_id"], [F.col("metres"), F.col("gml_id")], 12)


@query(f"SELECT floor(lon/0.01)::BIGINT AS ix, floor(lat/0.01)::BIGINT AS iy, max(depth) AS value FROM {G} p WHERE depth IS NOT NULL GROUP BY 1, 2")
def grid_max_depth(spark, d):
    """Worst depth per grid cell."""
    return spatial.grid_max(V.points(spark, d), "lon", "lat", "depth", 0.01)


@query(f"""WITH v AS (SELECT DISTINCT round(lat, 7) AS v FROM {G} g WHERE lat IS NOT NULL), d AS (SELECT round(v - lag(v) OVER (ORDER BY v), 9) AS d FROM v), k AS (SELECT d FROM d WHERE d > 0)
SELECT round(quantile_cont(d, 0.5), 9) AS spacing FROM k WHERE d <= 1.6 * (SELECT quantile_cont(d, 0.35) FROM k)""")
def lattice_spacing(spark, d):
    """Spacing of the points' latitudes."""
    return spatial.lattice_spacing(V.points(spark, d), "lat")


@query(f"WITH g AS (SELECT DISTINCT round(lon/0.005)::BIGINT AS i, round(lat/0.005)::BIGINT AS j FROM {G} p WHERE depth > 0) SELECT record_uid FROM {P} r WHERE located AND EXISTS (SELECT 1 FROM g WHERE g.i = round(r.x/0.005)::BIGINT AND g.j = round(r.y/0.005)::BIGINT)")
def lattice_membership(spark, d):
    """Records whose lattice cell holds a flooded point."""
    snap = lambda c: F.round(F.col(c) / 0.005).cast("bigint")
    g = V.points(spark, d).filter("depth > 0").select(snap("lon").alias("i"), snap("lat").alias("j")).distinct()
    r = V.records(spark, d).filter("located").withColumn("i", snap("x")).withColumn("j", snap("y"))
    return r.join(g, ["i", "j"], "left_semi").select("record_uid")


@query(f"SELECT count(*) FILTER (WHERE latitude BETWEEN 20 AND 50 AND longitude BETWEEN 120 AND 155) AS ingest, count(*) FILTER (WHERE latitude BETWEEN 20 AND 46 AND longitude BETWEEN 122 AND 154.5) AS geocoder, count(*) FILTER (WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) AS general FROM {L} l")
def coordinate_windows(spark, d):
    """P10: the three validity windows."""
    w = lambda a, b, c, e: F.count_if(F.col("latitude").between(a, b) & F.col("longitude").between(c, e))
    return V.listings(spark, d).agg(w(20, 50, 120, 155).alias("ingest"), w(20, 46, 122, 154.5).alias("geocoder"), w(-90, 90, -180, 180).alias("general"))


@query(f"SELECT record_uid, x, y, located FROM {P} p")
def record_places(spark, d):
    """Place of every record by precedence of its sources."""
    return V.records(spark, d).select("record_uid", "x", "y", "located")


# ---- links, buildings and risks -------------------------------------------------------------------------------------------


@query(
f"""WITH l AS (SELECT record_uid, unnest(matched_building_ids) AS gml_id, match_methods FROM {R} r), m AS (SELECT gml_id, unnest(match_methods) AS method FROM l)
SELECT l.gml_id, l.records, coalesce(m.methods, '') AS methods FROM (SELECT gml_id, count(DISTINCT record_uid) AS records FROM l GROUP BY 1) l LEFT JOIN (SELECT gml_id, string_agg(DISTINCT method, ';' ORDER BY method) AS methods FROM m WHERE trim(method) <> '' GROUP BY 1) m USING (gml_id)""")
def building_link_methods(spark, d):
    """Links per building with the sorted union of their methods."""
    r = V.records(spark, d).select("record_uid", F.explode("matched_building_ids").alias("gml_id"), "match_methods")
    counted = r.groupBy("gml_id").agg(F.count_distinct("record_uid").alias("records"), F.flatten(F.collect_set("match_methods")).alias("m"))
    named = F.filter(F.transform("m", lambda v: F.trim(v)), lambda v: v != "")
    return counted.select("gml_id", "records", F.array_join(F.array_sort(F.array_distinct(named)), ";").alias("methods"))


@query(f"""WITH l AS (SELECT record_uid, unnest(matched_building_ids) AS gml_id FROM {R} r), c AS (SELECT gml_id, avg(p.x) AS lon, avg(p.y) AS lat FROM (SELECT gml_id, unnest(flatten(rings)) AS p FROM buildings) GROUP BY gml_id),
b AS (SELECT DISTINCT record_uid, 'building' AS basis, round(lon, 6) AS lon, round(lat, 6) AS lat FROM l JOIN c USING (gml_id))
SELECT * FROM b UNION ALL SELECT record_uid, 'record', round(x, 6), round(y, 6) FROM {P} p WHERE located AND record_uid NOT IN (SELECT record_uid FROM b)""")
def analysis_locations(spark, d):
    """Every matched building's point, else the record's own."""
    r = V.records(spark, d)
    ring = table(spark, d, "buildings").select("gml_id", F.explode(F.flatten("rings")).alias("p"))
    c = ring.groupBy("gml_id").agg(F.round(F.avg("p.x"), 6).alias("lon"), F.round(F.avg("p.y"), 6).alias("lat"))
    b = r.select("record_uid", F.explode("matched_building_ids").alias("gml_id")).join(c, "gml_id").select("record_uid", F.lit("building").alias("basis"), "lon", "lat").distinct()
    rest = r.filter("located").join(b.select("record_uid"), "record_uid", "left_anti").select("record_uid", F.lit("record").alias("basis"), F.round("x", 6).alias("lon"), F.round("y", 6).alias("lat"))
    return b.unionByName(rest)


FLOODS = [("river_flooding", "river"), ("tsunami", "tsunami"), ("high_tide", "high_tide"), ("inland_flooding", "inland"), ("reservoir_flooding", "reservoir")]
@query("WITH k AS (SELECT *, coalesce(nullif(trim(rank_label),''), nullif(trim(rank_code),''), '') AS rank_display FROM " + K + " x), u AS (SELECT building_gml_id, risk_type, rank_display AS v, min(risk_index) AS p FROM k WHERE rank_display <> '' GROUP BY 1, 2, 3), t AS (SELECT building_gml_id, risk_type AS v, min(risk_index) AS p FROM k GROUP BY 1, 2) SELECT k.building_gml_id, count(*) AS risk_count, (SELECT string_agg(v, ';' ORDER BY p) FROM t WHERE t.building_gml_id = k.building_gml_id) AS risk_types, "
+ ", ".join(f"count(*) FILTER (WHERE risk_type = '{t}') AS {n}_count, max(depth_m) FILTER (WHERE risk_type = '{t}') AS {n}_max_depth_m, coalesce((SELECT string_agg(v, ';' ORDER BY p) FROM u WHERE u.building_gml_id = k.building_gml_id AND u.risk_type = '{t}'), '') AS {n}_ranks" for t, n in FLOODS)
+ ", max(duration_h) FILTER (WHERE risk_type = 'river_flooding') AS river_max_duration_h FROM k GROUP BY k.building_gml_id")
def building_risk_summary(spark, d):
    """One row per building with counts, worst depths and ordered unique ranks by flood type, in one aggregation."""
    k = V.risks(spark, d).withColumn("rank_display", C.display(F.col("rank_code"), F.col("rank_label")))
    of = lambda t, c: F.when(F.col("risk_type") == t, F.col(c))
    cells_ = [F.count("*").alias("risk_count"), tables.ordered_unique(F.col("risk_type"), F.col("risk_index")).alias("risk_types")]
    for t, n in FLOODS:
        cells_ += [F.count_if(F.col("risk_type") == t).alias(f"{n}_count"), F.max(of(t, "depth_m")).alias(f"{n}_max_depth_m"), tables.ordered_unique(of(t, "rank_display"), F.col("risk_index")).alias(f"{n}_ranks")]
    return k.groupBy("building_gml_id").agg(*cells_, F.max(of("river_flooding", "duration_h")).alias("river_max_duration_h"))


SLOTS = 8
SLOT_FIELDS = ["risk_type", "rank_code", "depth_m"]
@query(f"WITH k AS (SELECT *, row_number() OVER (PARTITION BY building_gml_id ORDER BY risk_type NULLS LAST, depth_m DESC NULLS LAST, risk_index) AS slot FROM {K} x) SELECT building_gml_id, count(*) AS slots, " + ", ".join(f"max(CASE WHEN slot = {n} THEN {f} END) AS risk{n:02d}_{f}" for n in range(1, SLOTS + 1) for f in SLOT_FIELDS) + " FROM k GROUP BY 1")
def risk_slots_wide(spark, d):
    """Risks of a building in numbered slots."""
    order = [F.col("risk_type").asc_nulls_last(), F.col("depth_m").desc_nulls_last(), F.col("risk_index")]
    return tables.slots(V.risks(spark, d), "building_gml_id", order, SLOT_FIELDS, SLOTS)


@query(f"SELECT building_gml_id, count(*) AS n FROM {K} k GROUP BY 1 HAVING count(*) > 3 ORDER BY n DESC, 1 LIMIT 20")
def slot_overflow_report(spark, d):
    """Buildings with more risks than slots, the 20 worst."""
    return tables.overflowing(V.risks(spark, d), "building_gml_id", 3)


@query(f"""WITH k AS (SELECT building_gml_id, risk_type, coalesce(nullif(trim(rank_label),''), nullif(trim(rank_code),''), '') AS label, depth_m FROM {K} x), s AS (SELECT *, coalesce(depth_m, list_max(list_transform(regexp_extract_all(label, '\\d+(?:\\.\\d+)?'), lambda x: CAST(x AS DOUBLE))), -1.0) AS severity FROM k)
SELECT building_gml_id, risk_type, label, severity FROM s QUALIFY row_number() OVER (PARTITION BY building_gml_id, risk_type ORDER BY severity DESC, label DESC) = 1""")
def worst_rank(spark, d):
    """the most severe rank of a building and risk type; equal severity goes to the larger label."""
    label = C.display(F.col("rank_code"), F.col("rank_label"))
    k = V.risks(spark, d).select("building_gml_id", "risk_type", label.alias("label"), C.severity(F.col("depth_m"), label).alias("severity"))
    return best_row(k, ["building_gml_id", "risk_type"], [F.col("severity"), F.col("label")], descending=True)


@query(f"""WITH k AS (SELECT building_gml_id, coalesce(nullif(trim(area_type_label),''), nullif(trim(area_type_code),'')) AS v, min(risk_index) AS p FROM {K} x WHERE risk_type = 'landslide' GROUP BY 1, 2)
SELECT building_gml_id, coalesce(arg_min(v, p) FILTER (WHERE v LIKE '%特別%'), arg_min(v, p), '') AS worst FROM k GROUP BY 1""")
def worst_landslide(spark, d):
    """special zones first."""
    label = C.display(F.col("area_type_code"), F.col("area_type_label"))
    k = V.risks(spark, d).filter("risk_type = 'landslide'").groupBy("building_gml_id").agg(F.array_sort(F.collect_set(F.when(label != "", F.struct(F.col("risk_index"), label.alias("v"))))).alias("l"))
    return k.select("building_gml_id", C.worst_landslide(F.transform("l", lambda x: x["v"])).alias("worst"))


@query(f"SELECT k.building_gml_id, k.risk_index, k.risk_type, b.usage_label, b.city_code FROM {K} k LEFT JOIN buildings b ON b.gml_id = k.building_gml_id")
def risks_with_buildings(spark, d):
    """Risks with the attributes of their building, unmatched ones kept."""
    b = table(spark, d, "buildings").select(F.col("gml_id").alias("building_gml_id"), "usage_label", "city_code")
    return V.risks(spark, d).select("building_gml_id", "risk_index", "risk_type").join(b, "building_gml_id", "left")


@query(f"SELECT (SELECT count(*) FROM {K} k WHERE building_gml_id IN (SELECT gml_id FROM buildings)) AS kept, (SELECT count(*) FROM {K} k WHERE building_gml_id NOT IN (SELECT gml_id FROM buildings)) AS dropped, (SELECT count(*) FROM buildings WHERE gml_id NOT IN (SELECT building_gml_id FROM plateau_disaster_risk)) AS without_risk")
def risk_invariants(spark, d):
    """Risks of known buildings, of unknown ones, buildings without risks."""
    k, b = V.risks(spark, d), table(spark, d, "buildings").select(F.col("gml_id").alias("building_gml_id"))
    count = lambda df, name: df.agg(F.count("*").alias(name))
    kept, dropped, without = count(k.join(b, "building_gml_id", "left_semi"), "kept"), count(k.join(b, "building_gml_id", "left_anti"), "dropped"), count(b.join(k, "building_gml_id", "left_anti"), "without_risk")
    return kept.join(F.broadcast(dropped)).join(F.broadcast(without))


CODED = ["description", "rank", "rank_org", "admin_type", "scale", "area_type"]
BY_TYPE = [("landslide", "area_type", "1", "警戒区域"), ("landslide", "area_type", "2", "特別警戒区域"), ("river_flooding", "scale", "1", "計画規模"), ("river_flooding", "scale", "2", "想定最大規模")]
BY_FILE = [("RiverFloodingRiskAttribute_rank.xml", "1", "0.5 m 未満"), ("RiverFloodingRiskAttribute_rank.xml", "2", "0.5 m 以上 3 m 未満"), ("HighTideRiskAttribute_rank.xml", "1", "0.5 m 未満")]
@query(f"""WITH k AS (SELECT building_gml_id, risk_index, risk_type, unnest([{', '.join(f"{{'field': '{f}', 'code': {f}_code, 'label': {f}_label, 'file': string_split(coalesce({f}_codespace,''), '/')[-1]}}" for f in CODED)}]) AS x FROM {K} k0), l AS (SELECT building_gml_id, risk_index, risk_type, x.field AS field, x.code AS code, nullif(trim(x.label),'') AS own, x.file AS file FROM k WHERE coalesce(x.code,'') <> ''),
f(file, code, label) AS (VALUES {', '.join(map(str, BY_FILE))}), t(type, field, code, label) AS (VALUES {', '.join(map(str, BY_TYPE))})
SELECT l.building_gml_id, l.risk_index, l.risk_type, l.field, l.code, coalesce(l.own, f.label, t.label, 'code:' || l.code) AS label, CASE WHEN l.own IS NOT NULL THEN 'existing' WHEN f.label IS NOT NULL THEN 'codelist' WHEN t.label IS NOT NULL THEN 'by_type' ELSE 'unresolved' END AS status
FROM l LEFT JOIN f ON f.file = l.file AND f.code = l.code LEFT JOIN t ON t.type = l.risk_type AND t.field = l.field AND t.code = l.code""")
def codelist_resolution(spark, d):
    """Labels of six coded attributes by precedence, with how each was found."""
    k = V.risks(spark, d).select("building_gml_id", "risk_index", "risk_type", *[f"{f}_{x}" for f in CODED for x in ("code", "label", "codespace")])
    by_file = spark.createDataFrame(BY_FILE, "file string, code string, label string")
    by_type = spark.createDataFrame(BY_TYPE, "type string, field string, code string, label string")
    return lookup.resolve_codes(k, CODED, by_file, by_type, "risk_type").select("building_gml_id", "risk_index", "risk_type", "field", "code", "label", "status")


@query(f"""WITH n AS (SELECT r.record_uid, k.risk_type, max(k.depth_m) AS depth, 'building' AS basis FROM (SELECT record_uid, unnest(matched_building_ids) AS g FROM {R} r) r JOIN {K} k ON k.building_gml_id = r.g WHERE k.risk_type IN ('river_flooding','high_tide','tsunami') GROUP BY 1, 2),
e AS (SELECT p.record_uid, 'river_flooding' AS risk_type, max(g.depth) AS depth, 'external' AS basis FROM {P} p JOIN {G} g ON p.located AND floor(p.x/0.005) = floor(g.lon/0.005) AND floor(p.y/0.005) = floor(g.lat/0.005) GROUP BY 1)
SELECT record_uid, risk_type, coalesce(CASE WHEN n.depth IS NOT NULL THEN n.depth END, e.depth) AS depth, CASE WHEN n.depth IS NOT NULL THEN 'building' WHEN e.depth IS NOT NULL THEN 'external' WHEN n.basis IS NOT NULL THEN 'building' ELSE 'external' END AS basis FROM n FULL JOIN e USING (record_uid, risk_type)""")
def best_available_water(spark, d):
    """Native depth, else external depth, else whichever row there is; rows are chosen whole."""
    r = V.records(spark, d)
    links = r.select("record_uid", F.explode("matched_building_ids").alias("building_gml_id"))
    k = V.risks(spark, d).filter(F.col("risk_type").isin(C.WATER_TYPES)).select("building_gml_id", "risk_type", "depth_m")
    native = links.join(k, "building_gml_id").groupBy("record_uid", "risk_type").agg(F.max("depth_m").alias("depth")).withColumn("basis", F.lit("building"))
    cell = lambda x, y: [F.floor(F.col(x) / 0.005).alias("i"), F.floor(F.col(y) / 0.005).alias("j")]
    worst = V.points(spark, d).groupBy(*cell("lon", "lat")).agg(F.max("depth").alias("depth"))
    external = r.filter("located").select("record_uid", *cell("x", "y")).join(worst, ["i", "j"]).select("record_uid", F.lit("river_flooding").alias("risk_type"), "depth", F.lit("external").alias("basis"))
    known = F.col("depth").isNotNull()
    return lookup.priority_merge([(native, known), (external, known)], ["record_uid", "risk_type"], ["depth", "basis"])


@query(f"""WITH l AS (SELECT DISTINCT r.record_uid, k.risk_type, CASE WHEN k.depth_m IS NULL THEN 'rank' ELSE 'depth' END AS basis, max(k.depth_m) OVER (PARTITION BY r.record_uid, k.risk_type) AS worst FROM (SELECT record_uid, unnest(matched_building_ids) AS g FROM {R} r) r JOIN {K} k ON k.building_gml_id = r.g) SELECT risk_type, basis, count(*) AS rows, count(DISTINCT record_uid) AS records, max(worst) AS worst FROM l GROUP BY 1, 2""")
def risk_long_profile(spark, d):
    """The long table of record risks, deduplicated and profiled."""
    links = V.records(spark, d).select("record_uid", F.explode("matched_building_ids").alias("building_gml_id"))
    k = V.risks(spark, d).select("building_gml_id", "risk_type", "depth_m")
    j = links.join(k, "building_gml_id")
    worst = j.groupBy("record_uid", "risk_type").agg(F.max("depth_m").alias("worst"))
    long = j.select("record_uid", "risk_type", F.when(F.col("depth_m").isNull(), "rank").otherwise("depth").alias("basis")).distinct().join(worst, ["record_uid", "risk_type"])
    return long.groupBy("risk_type", "basis").agg(F.count("*").alias("rows"), F.count_distinct("record_uid").alias("records"), F.max("worst").alias("worst"))


@query(f"SELECT museum_id, k.risk_type, k.risk_index, CASE WHEN k.risk_type NOT IN ('river_flooding','inland_flooding','reservoir_flooding','high_tide','tsunami') THEN 'not_assessed_non_inundation' WHEN k.depth_m IS NULL THEN 'hazard_present_depth_unknown' WHEN k.depth_m <= 0 THEN 'above_water_level' WHEN b.storeys_below > 0 THEN 'potentially_exposed' WHEN b.storeys_above <= 1 THEN 'potentially_exposed' WHEN b.storeys_above > 1 THEN 'undetermined_floor_elevation' ELSE 'undetermined_floor' END AS exposure FROM (SELECT museum_id, longitude, latitude FROM {L} l WHERE located) m JOIN (SELECT gml_id, storeys_above, storeys_below, min(p.x) AS x0, max(p.x) AS x1, min(p.y) AS y0, max(p.y) AS y1 FROM (SELECT gml_id, storeys_above, storeys_below, unnest(flatten(rings)) AS p FROM buildings) GROUP BY 1, 2, 3) b ON longitude BETWEEN x0 AND x1 AND latitude BETWEEN y0 AND y1 JOIN {K} k ON k.building_gml_id = b.gml_id")
def space_exposure(spark, d):
    """Exposure class of listings over the risks of the building whose bounds they are in."""
    p = table(spark, d, "buildings").select("gml_id", "storeys_above", "storeys_below", F.explode(F.flatten("rings")).alias("p"))
    b = p.groupBy("gml_id", "storeys_above", "storeys_below").agg(F.min("p.x").alias("x0"), F.max("p.x").alias("x1"), F.min("p.y").alias("y0"), F.max("p.y").alias("y1"))
    cell = 0.01
    at = lambda c: F.floor(F.col(c) / cell)
    celled = b.withColumn("i", F.explode(F.sequence(at("x0"), at("x1")))).withColumn("j", F.explode(F.sequence(at("y0"), at("y1"))))
    m = V.listings(spark, d).filter("located").select("museum_id", "longitude", "latitude", at("longitude").alias("i"), at("latitude").alias("j"))
    inside = m.join(celled, ["i", "j"]).filter("longitude between x0 and x1 and latitude between y0 and y1").withColumnRenamed("gml_id", "building_gml_id")
    k = V.risks(spark, d).select("building_gml_id", "risk_type", "risk_index", "depth_m")
    e = C.floor_exposure(F.col("risk_type"), F.col("depth_m"), F.lit(None).cast("double"), F.col("storeys_below") > 0, F.col("storeys_above"))
    return inside.join(k, "building_gml_id").select("museum_id", "risk_type", "risk_index", e.alias("exposure"))


@query(f"SELECT complex_id, count(*) AS records, count(*) FILTER (WHERE coalesce(entity_class,'') = 'building_direct') AS direct, count(*) FILTER (WHERE spatial_match_status = 'building_matched') AS matched, min(name) AS first_name, CASE WHEN count(*) FILTER (WHERE spatial_match_status = 'building_matched') > 0 THEN 'matched' ELSE 'unresolved' END AS state FROM {R} r WHERE coalesce(complex_id,'') <> '' GROUP BY 1")
def complex_summary(spark, d):
    """Members of each complex by predicate, with its state."""
    r = V.records(spark, d).filter("coalesce(complex_id, '') <> ''")
    matched = F.count_if(F.col("spatial_match_status") == "building_matched")
    return r.groupBy("complex_id").agg(F.count("*").alias("records"), F.count_if(F.col("entity_class") == "building_direct").alias("direct"), matched.alias("matched"), F.min("name").alias("first_name")).withColumn("state", F.when(F.col("matched") > 0, "matched").otherwise("unresolved"))


@query(f"""WITH k AS (SELECT record_uid, code, CASE WHEN coalesce(trim(place_name),'') <> '' THEN 'p:' || code || ':' || trim(place_name) WHEN coalesce(trim(owner),'') <> '' AND coalesce(trim(address),'') <> '' THEN 'o:' || code || ':' || trim(owner) || ':' || trim(address) WHEN coalesce(trim(address),'') <> '' THEN 'a:' || code || ':' || trim(address) ELSE 'r:' || record_uid::VARCHAR END AS key FROM {R} r),
g AS (SELECT code, key, min(record_uid) AS least FROM k GROUP BY 1, 2), n AS (SELECT code, key, dense_rank() OVER (PARTITION BY code ORDER BY least) AS number FROM g)
SELECT k.record_uid, k.code || '-HG' || lpad(n.number::VARCHAR, 5, '0') AS complex FROM k JOIN n USING (code, key)""")
def complex_assignment(spark, d):
    """Complexes by place, owner and address, address, else alone; numbered per municipality by their least member."""
    filled = lambda c: F.coalesce(F.trim(F.col(c)), F.lit(""))
    key = (
        F.when(filled("place_name") != "", F.concat_ws(":", F.lit("p"), "code", filled("place_name")))
        .when((filled("owner") != "") & (filled("address") != ""), F.concat_ws(":", F.lit("o"), "code", filled("owner"), filled("address")))
        .when(filled("address") != "", F.concat_ws(":", F.lit("a"), "code", filled("address")))
        .otherwise(F.concat(F.lit("r:"), F.col("record_uid").cast("string")))
    )
    k = V.records(spark, d).select("record_uid", "code", key.alias("key"))
    g = k.groupBy("code", "key").agg(F.min("record_uid").alias("least"))
    n = tables.numbered(g, "code", "least").drop("least")
    return k.join(n, ["code", "key"]).select("record_uid", F.concat("code", F.lit("-HG"), F.lpad(F.col("number").cast("string"), 5, "0")).alias("complex"))


@query(f"SELECT record_uid, complex_id, x, y, count(*) OVER (PARTITION BY complex_id, round(x, 9), round(y, 9)) > 1 AS shared FROM {P} p WHERE located AND coalesce(complex_id,'') <> ''")
def shared_coordinates(spark, d):
    """Whether a coordinate stands for several records of a complex."""
    w = Window.partitionBy("complex_id", F.round("x", 9), F.round("y", 9))
    r = V.records(spark, d).filter("located and coalesce(complex_id, '') <> ''")
    return r.select("record_uid", "complex_id", "x", "y", (F.count("*").over(w) > 1).alias("shared"))


@query(f"SELECT code, risk_type, count(DISTINCT record_uid) AS records FROM (SELECT record_uid, code, unnest(matched_building_ids) AS g FROM {R} r) r JOIN {K} k ON k.building_gml_id = r.g GROUP BY 1, 2")
def city_hazard_catalogue(spark, d):
    """Distinct records per municipality and hazard."""
    links = V.records(spark, d).select("record_uid", "code", F.explode("matched_building_ids").alias("building_gml_id"))
    return links.join(V.risks(spark, d).select("building_gml_id", "risk_type"), "building_gml_id").groupBy("code", "risk_type").agg(F.count_distinct("record_uid").alias("records"))


# ---- look-ups and priorities ----------------------------------------------------------------------------------------------


@query(f"""WITH r AS (SELECT heritage_type_major_code AS type_code, heritage_type_major_ja AS pattern, row_number() OVER (ORDER BY heritage_type_major_code) AS priority FROM heritage_type_ref)
SELECT obs_id, raw_value, (SELECT arg_min(type_code, priority) FROM r WHERE contains(o.raw_value, r.pattern)) AS type_code FROM {O} o WHERE raw_value IS NOT NULL AND raw_value <> ''""")
def rule_first_match(spark, d):
    """Type of the first rule whose pattern occurs in a value."""
    rules = table(spark, d, "heritage_type_ref").select(F.col("heritage_type_major_code").alias("type_code"), F.col("heritage_type_major_ja").alias("pattern"))
    o = V.observed(spark, d).filter("raw_value is not null and raw_value <> ''").select("obs_id", "raw_value")
    return lookup.first_matching_rule(o, "raw_value", rules, "pattern", ["type_code"], "type_code")


@query(f"""WITH r AS (SELECT * FROM {R}), p AS (SELECT name, code FROM r WHERE level = 'Tokyo Metropolitan' GROUP BY 1, 2 HAVING count(*) = 1), n AS (SELECT name, code FROM r WHERE level = 'National' GROUP BY 1, 2 HAVING count(*) = 1)
SELECT r.record_uid, CASE WHEN p.name IS NOT NULL AND n.name IS NOT NULL THEN 'ambiguous' WHEN n.name IS NOT NULL THEN 'National' WHEN p.name IS NOT NULL THEN 'Tokyo Metropolitan' ELSE 'Unknown' END AS resolved FROM r LEFT JOIN p USING (name, code) LEFT JOIN n USING (name, code) WHERE r.level = 'Unknown' """)
def cross_source_level(spark, d):
    """Level of undecided records from uniquely named records of two reference sources; both hitting is ambiguous."""
    r = V.records(spark, d)
    once = lambda level, flag: r.filter(F.col("level") == level).groupBy("name", "code").agg(F.count("*").alias("n")).filter("n = 1").select("name", "code", F.lit(True).alias(flag))
    j = r.filter("level = 'Unknown'").join(once("Tokyo Metropolitan", "p"), ["name", "code"], "left").join(once("National", "n"), ["name", "code"], "left")
    state = F.when(F.col("p") & F.col("n"), "ambiguous").when(F.col("n"), "National").when(F.col("p"), "Tokyo Metropolitan").otherwise("Unknown")
    return j.select("record_uid", state.alias("resolved"))


CASCADE = [("code", "name"), ("code", "place_name"), ("code", "address")]
@query(f"WITH r AS (SELECT * FROM {R}), ref AS (SELECT * FROM r WHERE heritage_type_major_code <> ''), " + ", ".join(f"k{n} AS (SELECT {', '.join(k)}, any_value(heritage_type_major_code) AS v FROM ref WHERE " + " AND ".join(f"coalesce(trim({c}),'') <> ''" for c in k) + f" GROUP BY {', '.join(k)} HAVING count(*) = 1)" for n, k in enumerate(CASCADE, 1)) + ", t AS (SELECT * FROM r WHERE coalesce(heritage_type_major_code,'') = '') SELECT t.record_uid, coalesce(k1.v, k2.v, k3.v) AS type_code, CASE WHEN k1.v IS NOT NULL THEN 1 WHEN k2.v IS NOT NULL THEN 2 WHEN k3.v IS NOT NULL THEN 3 END AS matched_by FROM t " + " ".join(f"LEFT JOIN k{n} ON " + " AND ".join(f"t.{c} = k{n}.{c}" for c in k) for n, k in enumerate(CASCADE, 1)))
def unique_key_cascade(spark, d):
    """Missing classifications filled through the first key that is unique in the classified records."""
    r = V.records(spark, d).select("record_uid", "code", "name", "place_name", "address", F.col("heritage_type_major_code").alias("type_code"))
    known = r.filter("type_code <> ''")
    todo = r.filter("coalesce(type_code, '') = ''").drop("type_code")
    return lookup.unique_key_cascade(todo, known, CASCADE, ["type_code"]).select("record_uid", "type_code", "matched_by")


@query(f"SELECT facility_name, code, count(*) AS candidates, max(p) AS priority, min(address) AS address, count(DISTINCT address) > 1 AS conflict FROM (SELECT facility_name, code, CASE WHEN coalesce(address_normalized,'') <> '' THEN 110 WHEN coalesce(address_raw,'') <> '' THEN 90 ELSE 80 END AS p, coalesce(nullif(address_normalized,''), nullif(address_raw,''), '') AS address, max(CASE WHEN coalesce(address_normalized,'') <> '' THEN 110 WHEN coalesce(address_raw,'') <> '' THEN 90 ELSE 80 END) OVER (PARTITION BY facility_name, code) AS top FROM {L} l) WHERE p = top GROUP BY 1, 2")
def priority_address(spark, d):
    """Best address candidate per facility name and municipality, conflicts flagged."""
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    p = F.when(filled("address_normalized"), 110).when(filled("address_raw"), 90).otherwise(80)
    m = V.listings(spark, d).select("facility_name", "code", p.alias("priority"), F.coalesce(F.nullif("address_normalized", F.lit("")), F.nullif("address_raw", F.lit("")), F.lit("")).alias("address"), F.struct("facility_name", "code").alias("k"))
    return lookup.best_with_conflict(m, "k", "priority", "address").select("k.facility_name", "k.code", "candidates", "priority", "address", "conflict")


@query(f"""WITH c AS (SELECT l.museum_id, e.osm_id, CASE WHEN e.osm_name = l.facility_name THEN 'exact' WHEN contains(e.osm_name, l.facility_name) OR contains(l.facility_name, e.osm_name) THEN 'contained' ELSE 'none' END AS level, e.addr_city = l.municipality_name AS same_city, {HAV.format(a='l.latitude', b='e.lat', c='l.longitude', d='e.lon')} AS m FROM {L} l JOIN {E} e ON l.located AND abs(e.lat - l.latitude) <= 0.003 AND abs(e.lon - l.longitude) <= 0.004 WHERE e.osm_name IS NOT NULL AND e.osm_name <> ''),
s AS (SELECT museum_id, osm_id, (CASE level WHEN 'exact' THEN 100 WHEN 'contained' THEN 70 ELSE 0 END + CASE WHEN same_city IS NULL THEN 0 WHEN same_city THEN 20 ELSE -100 END + CASE WHEN m <= 100 THEN 30 WHEN m <= 300 THEN 20 WHEN m <= 1000 THEN 5 ELSE -30 END)::INT AS score FROM c WHERE m <= 300)
SELECT museum_id, osm_id, score, row_number() OVER (PARTITION BY museum_id ORDER BY score DESC, osm_id)::INT AS rank FROM s""")
def osm_candidate_scores(spark, d):
    """Scored and ranked map elements within 300 m of a listing."""
    m = V.listings(spark, d).filter("located").select("museum_id", "facility_name", "municipality_name", "longitude", "latitude")
    e = V.elements(spark, d).filter("coalesce(osm_name, '') <> ''").select("osm_id", "osm_name", "addr_city", F.col("lon").alias("x"), F.col("lat").alias("y")).filter(plausible(F.col("x"), F.col("y")))
    near = spatial.within_distance(m, e, 300.0, ("longitude", "latitude"), ("x", "y"))
    level = F.when(F.col("osm_name") == F.col("facility_name"), "exact").when(F.col("osm_name").contains(F.col("facility_name")) | F.col("facility_name").contains(F.col("osm_name")), "contained").otherwise("none")
    s = near.select("museum_id", "osm_id", C.candidate_score(level, F.col("addr_city") == F.col("municipality_name"), F.lit(None).cast("boolean"), F.col("distance_m")).alias("score"))
    return s.withColumn("rank", F.row_number().over(Window.partitionBy("museum_id").orderBy(F.desc("score"), "osm_id")))


@query(f"WITH m AS (SELECT museum_id, facility_name, code, row_number() OVER (PARTITION BY facility_name, code ORDER BY (coalesce(address_normalized,'') <> '') DESC, museum_id) AS n FROM {L} l) SELECT museum_id, 'F-' || substr(sha1(facility_name || '|' || code), 1, 12) AS facility_id, CASE WHEN n = 1 THEN 'first' ELSE 'duplicate' END AS status FROM m WHERE facility_name IS NOT NULL")
def reconcile_listings(spark, d):
    """First listing of each facility (those with an address first) and its duplicates, with stable ids."""
    m = V.listings(spark, d).filter("facility_name is not null").withColumn("key", F.struct("facility_name", "code"))
    order = [(F.coalesce("address_normalized", F.lit("")) != "").desc(), F.col("museum_id")]
    s = lookup.first_seen(m, "key", order)
    return s.select("museum_id", X.stable_id("F-", F.col("facility_name"), F.col("code")).alias("facility_id"), "status")


# ---- set operations, upserts, dedupe, profiles ----------------------------------------------------------------------------


@query(f"SELECT museum_id AS key, facility_name AS name, NULL::VARCHAR AS owner, 'listing' AS origin FROM {L} l UNION ALL SELECT record_uid::VARCHAR, name, owner, 'record' FROM {R} r")
def union_by_name(spark, d):
    """Union with missing columns filled."""
    m = V.listings(spark, d).select(F.col("museum_id").alias("key"), F.col("facility_name").alias("name"), F.lit("listing").alias("origin"))
    r = V.records(spark, d).select(F.col("record_uid").cast("string").alias("key"), "name", "owner", F.lit("record").alias("origin"))
    return m.unionByName(r, allowMissingColumns=True).select("key", "name", "owner", "origin")


@query(f"SELECT (SELECT count(*) FROM (SELECT DISTINCT code FROM {R} r EXCEPT SELECT DISTINCT code FROM {L} l)) AS only_records, (SELECT count(*) FROM (SELECT DISTINCT code FROM {R} r INTERSECT SELECT DISTINCT code FROM {L} l)) AS common, (SELECT count(*) FROM (SELECT code FROM {R} r UNION SELECT code FROM {L} l)) AS either")
def code_set_operations(spark, d):
    """Union, difference and intersection of code sets."""
    a, b = V.records(spark, d).select("code"), V.listings(spark, d).select("code")
    n = lambda df, name: df.agg(F.count("*").alias(name))
    return n(a.subtract(b), "only_records").join(F.broadcast(n(a.intersect(b), "common"))).join(F.broadcast(n(a.union(b).distinct(), "either")))


@query("WITH a AS (SELECT building_gml_id, risk_index, risk_type FROM plateau_disaster_risk), b AS (SELECT DISTINCT * FROM a) SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def repeated_risks(spark, d):
    """Multiset difference between the delivery and its distinct rows."""
    a = table(spark, d, "plateau_disaster_risk").select("building_gml_id", "risk_index", "risk_type")
    return lookup.multiset_difference(a, a.distinct())


@query("WITH base AS (SELECT container, capacity_tokens FROM pack_capacity), ch AS (SELECT 'long' AS container, 9000 AS capacity_tokens UNION ALL SELECT 'huge', 20000) SELECT * FROM base WHERE container NOT IN (SELECT container FROM ch) UNION ALL SELECT * FROM ch")
def upsert_rows(spark, d):
    """Rows replaced or added by key."""
    changes = spark.createDataFrame([("long", 9000), ("huge", 20000)], "container string, capacity_tokens int")
    return lookup.upsert(table(spark, d, "pack_capacity"), changes, ["container"])


@query("SELECT record_uid, count(*) AS deliveries, min(ingested_at) AS first_seen, max(ingested_at) AS last_seen FROM records GROUP BY 1 HAVING count(*) > 1")
def redelivered_records(spark, d):
    """Keys delivered more than once."""
    return table(spark, d, "records").groupBy("record_uid").agg(F.count("*").alias("deliveries"), F.min("ingested_at").alias("first_seen"), F.max("ingested_at").alias("last_seen")).filter("deliveries > 1")


@query(f"WITH k AS (SELECT record_uid, code, name, coalesce(address,'') AS a, printf('%.7f', x) AS kx, printf('%.7f', y) AS ky FROM {P} p) SELECT record_uid FROM k QUALIFY row_number() OVER (PARTITION BY code, name, a, kx, ky ORDER BY record_uid) = 1")
def record_dedupe(spark, d):
    """First record of equal name, address and place (to seven decimals)."""
    r = V.records(spark, d).select("record_uid", "code", "name", F.coalesce("address", F.lit("")).alias("a"), F.round("x", 7).alias("kx"), F.round("y", 7).alias("ky"))
    return best_row(r, ["code", "name", "a", "kx", "ky"], [F.col("record_uid")]).select("record_uid")


@query(f"SELECT building_gml_id, risk_type, risk_index, depth_m FROM {K} k WHERE depth_m IS NOT NULL QUALIFY row_number() OVER (PARTITION BY building_gml_id, risk_type ORDER BY depth_m DESC, risk_index) = 1")
def deepest_risk(spark, d):
    """Deepest risk per building and type with a fixed tie-break."""
    k = V.risks(spark, d).filter("depth_m is not null").select("building_gml_id", "risk_type", "risk_index", "depth_m")
    return best_row(k, ["building_gml_id", "risk_type"], [-F.col("depth_m"), F.col("risk_index")])


@query(f"WITH o AS (SELECT * FROM {O}) " + " UNION ALL ".join(f"SELECT '{c}' AS field, count(DISTINCT {c}) AS distinct_values, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) FILTER (WHERE {c} = '') AS empties FROM o" for c in ("source_scope", "municipality_code", "source_authority", "source_field", "raw_value")))
def observed_profile(spark, d):
    """Distinct values, nulls and blanks of every text column, in one pass."""
    cols = ["source_scope", "municipality_code", "source_authority", "source_field", "raw_value"]
    cells_ = [F.struct(F.lit(c).alias("field"), F.count_distinct(c).alias("distinct_values"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count_if(F.col(c) == "").alias("empties")).alias(c) for c in cols]
    return V.observed(spark, d).agg(*cells_).select(F.explode(F.array(*cols)).alias("x")).select("x.*")


@query(f"SELECT source_field, raw_value, value_count FROM {O} o WHERE raw_value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_field ORDER BY value_count DESC, obs_id) <= 5")
def top_values_per_field(spark, d):
    """The five most frequent values of each field, a top-k report."""
    o = V.observed(spark, d).filter("raw_value is not null")
    return ranked(o, ["source_field"], [F.desc("value_count"), F.col("obs_id")], 5).select("source_field", "raw_value", "value_count")


@query("SELECT municipality_code, municipality_name, count(DISTINCT town_name) AS towns FROM town_master GROUP BY 1, 2")
def municipality_names(spark, d):
    """Code and name of municipalities."""
    return table(spark, d, "town_master").groupBy("municipality_code", "municipality_name").agg(F.count_distinct("town_name").alias("towns"))


@query(f"WITH m AS (SELECT DISTINCT municipality_code AS c, municipality_name AS n FROM town_master) SELECT r.record_uid, coalesce(m.c, r.code) AS code, coalesce(nullif(r.municipality,''), m2.n) AS municipality, m.c IS NOT NULL AND m.c <> r.code AS contradicted FROM {R} r LEFT JOIN m ON m.n = r.municipality LEFT JOIN m m2 ON m2.c = r.code")
def municipality_repair(spark, d):
    """Code filled from the name, name from the code, contradictions flagged."""
    m = table(spark, d, "town_master").select(F.col("municipality_code").alias("c"), F.col("municipality_name").alias("n")).distinct()
    by_name, by_code = m.select(F.col("n").alias("municipality"), F.col("c").alias("by_name")), m.select(F.col("c").alias("code"), F.col("n").alias("by_code"))
    j = V.records(spark, d).select("record_uid", "code", "municipality").join(by_name, "municipality", "left").join(by_code, "code", "left")
    return j.select("record_uid", F.coalesce("by_name", "code").alias("code"), F.coalesce(F.nullif("municipality", F.lit("")), "by_code").alias("municipality"), (F.col("by_name").isNotNull() & (F.col("by_name") != F.col("code"))).alias("contradicted"))


@query(f"SELECT record_uid, CASE WHEN length(regexp_replace(coalesce(municipality_code,''),'\\D','','g')) >= 5 THEN substr(regexp_replace(coalesce(municipality_code,''),'\\D','','g'),1,5) = '13905' WHEN regexp_matches(source_file, '^\\d{{5}}') THEN substr(source_file,1,5) = '13905' WHEN contains(coalesce(municipality,''), '朝霧区') THEN true ELSE contains(coalesce(address,''), '朝霧区') END AS belongs FROM {R} r")
def municipality_predicate(spark, d):
    """Whether a record belongs to a municipality: code decides, else file name, else name, else address."""
    digits = F.regexp_replace(F.coalesce("municipality_code", F.lit("")), r"\D", "")
    name = F.coalesce("municipality", F.lit("")).contains("朝霧区")
    p = F.when(F.length(digits) >= 5, F.substring(digits, 1, 5) == "13905").when(F.col("source_file").rlike(r"^\d{5}"), F.substring("source_file", 1, 5) == "13905").when(name, True).otherwise(F.coalesce("address", F.lit("")).contains("朝霧区"))
    return V.records(spark, d).select("record_uid", p.alias("belongs"))


@query(f"SELECT t.municipality_code, t.municipality_name, count(r.record_uid) AS records FROM (SELECT DISTINCT municipality_code, municipality_name FROM town_master) t LEFT JOIN {R} r ON r.code = t.municipality_code GROUP BY 1, 2 UNION ALL SELECT 'unmapped', '', count(*) FROM {R} r WHERE code NOT IN (SELECT municipality_code FROM town_master)")
def choropleth_counts(spark, d):
    """Counts per region with zeros, and what no region takes."""
    r = V.records(spark, d).select("record_uid", F.col("code").alias("municipality_code"))
    t = table(spark, d, "town_master").select("municipality_code", "municipality_name").distinct()
    mapped = t.join(r.groupBy("municipality_code").count(), "municipality_code", "left").select("municipality_code", "municipality_name", F.coalesce("count", F.lit(0)).alias("records"))
    return mapped.union(r.join(t, "municipality_code", "left_anti").agg(F.count("*").alias("records")).select(F.lit("unmapped"), F.lit(""), "records"))


# ---- text ------------------------------------------------------------------------------------------------------------------


@query(f"SELECT record_uid, CASE WHEN regexp_matches(regexp_replace(trim(coalesce(record_id,'')),'\\.0$',''),'^[0-9]+$') THEN coalesce(nullif(regexp_replace(regexp_replace(trim(record_id),'\\.0$',''),'^0+',''),''),'0') ELSE regexp_replace(trim(coalesce(record_id,'')),'\\.0$','') END AS id, coalesce(nullif(regexp_replace(regexp_replace(source_file,'[^0-9A-Za-z._-]+','_','g'),'^_+|_+$','','g'),''),'file') AS file, substr(sha256(source_file || '|' || record_id),1,16) AS digest FROM {R} r")
def identifiers(spark, d):
    """Comparable ids, file names and digests."""
    digest = F.substring(F.sha2(F.concat_ws("|", "source_file", "record_id"), 256), 1, 16)
    return V.records(spark, d).select("record_uid", X.id_text(F.col("record_id")).alias("id"), X.ascii_slug(F.col("source_file")).alias("file"), digest.alias("digest"))


@query(f"SELECT museum_id, CASE WHEN regexp_extract(coalesce(address_raw,''),'^\\s*〒?\\s*(\\d{{3}})-?(\\d{{4}})',1) <> '' THEN regexp_extract(address_raw,'^\\s*〒?\\s*(\\d{{3}})-?(\\d{{4}})',1) || '-' || regexp_extract(address_raw,'^\\s*〒?\\s*(\\d{{3}})-?(\\d{{4}})',2) ELSE '' END AS postal, trim(regexp_replace(coalesce(address_raw,''),'^\\s*〒?\\s*\\d{{3}}-?\\d{{4}}','')) AS rest FROM {L} l")
def postal_split(spark, d):
    """postal code and rest of an address."""
    code, rest = X.postal_split(F.col("address_raw"))
    return V.listings(spark, d).select("museum_id", code.alias("postal"), rest.alias("rest"))


@query(f"SELECT osm_id, coalesce(regexp_replace(lower(regexp_extract(coalesce(website,''), '^[a-z]+://([^/:?#]+)', 1)), '^www\\.', ''), '') AS host FROM {E} e")
def website_hosts(spark, d):
    """F16: host of a website."""
    return V.elements(spark, d).select("osm_id", X.url_host(F.col("website")).alias("host"))


@query(f"SELECT point_id, CASE WHEN abs(ground_elevation_m - round(ground_elevation_m)) < 1e-9 THEN round(ground_elevation_m)::BIGINT::VARCHAR ELSE regexp_replace(regexp_replace(printf('%.3f', ground_elevation_m), '0+$', ''), '\\.$', '') END AS shown, try_cast(replace(depth::VARCHAR, ',', '') AS DOUBLE) AS parsed FROM {G} p")
def number_formats(spark, d):
    """Numbers as text and back."""
    return V.points(spark, d).select("point_id", X.number_text(F.col("ground_elevation_m")).alias("shown"), X.number(F.col("depth").cast("string")).alias("parsed"))


@query(None)
def normalised_texts(spark, d):
    """The normalisers side by side on record names, owners and addresses."""
    r = V.records(spark, d)
    return r.select("record_uid", X.text(F.col("name")).alias("text"), X.name_key(F.col("name")).alias("name_key"), X.address_key(F.col("address")).alias("address_key"), X.site_address_key(F.col("address"), "東瀬都").alias("site_key"), X.site_label(F.col("place_name")).alias("site"), X.owner_label(F.col("owner")).alias("owner_label"), X.letters_key(F.col("name")).alias("letters"))


@query(None)
def name_address_links(spark, d):
    """Records and buildings with the same normalised name or address; how many buildings a record hits."""
    r, b = V.records(spark, d), table(spark, d, "buildings")
    names = r.select("record_uid", F.explode(F.array_distinct(F.array(X.name_key(F.col("name")), X.name_key(F.col("place_name"))))).alias("k"), F.lit("name").alias("method"))
    addresses = r.select("record_uid", X.address_key(F.col("address")).alias("k"), F.lit("address").alias("method"))
    keys = b.select("gml_id", X.name_key(F.col("name")).alias("k"), F.lit("name").alias("method")).union(b.select("gml_id", X.address_key(F.col("address")).alias("k"), F.lit("address").alias("method"))).filter("k <> ''")
    links = names.union(addresses).filter("k <> ''").join(keys, ["k", "method"]).groupBy("record_uid", "gml_id").agg(tables.sorted_unique(F.col("method")).alias("methods"))
    return links.withColumn("hits", F.count("*").over(Window.partitionBy("record_uid")))


@query(None)
def similar_names(spark, d):
    """Ratcliff/Obershelp similarity of all listings and map elements, wherever they are, from 0.72."""
    m = V.listings(spark, d).select("museum_id", X.facility_key(F.col("facility_name")).alias("a"))
    e = V.elements(spark, d).select("osm_id", X.facility_key(F.col("osm_name")).alias("b"))
    pairs = similar.similar_pairs(m, e, "a", "b", 0.72)
    return pairs.join(m, "a").join(e, "b").select("museum_id", "osm_id", F.round("ratio", 6).alias("ratio"))


# ---- composites ------------------------------------------------------------------------------------------------------------


@query(None)
def extract_states(spark, d):
    """Matching state of every record after exact matching to buildings."""
    return pipelines.extract_package(V.records(spark, d), table(spark, d, "buildings"))["records"]


@query(None)
def extract_complexes(spark, d):
    """Complexes of the extraction."""
    return pipelines.extract_package(V.records(spark, d), table(spark, d, "buildings"))["complex_summary"]


@query(None)
def disaster_layers_wide(spark, d):
    """Buildings with labelled risks in slots."""
    by_file = spark.createDataFrame(BY_FILE, "file string, code string, label string")
    by_type = spark.createDataFrame(BY_TYPE, "type string, field string, code string, label string")
    return pipelines.disaster_layers(V.risks(spark, d), table(spark, d, "buildings"), by_file, by_type, 40)["wide"]


@query(f"""WITH r AS (SELECT record_uid, {MERC_X.format(x='x')} AS mx, {MERC_Y.format(y='y')} AS my FROM {P} p WHERE located), g AS (SELECT depth, {MERC_X.format(x='lon')} AS gx, {MERC_Y.format(y='lat')} AS gy FROM {G} p),
c AS (SELECT r.record_uid, g.depth, (mx-gx)*(mx-gx)+(my-gy)*(my-gy) AS d2 FROM r JOIN g ON gx BETWEEN mx-25 AND mx+25 AND gy BETWEEN my-25 AND my+25), n AS (SELECT record_uid, depth FROM c WHERE d2 <= 625 QUALIFY rank() OVER (PARTITION BY record_uid ORDER BY d2) = 1),
w AS (SELECT record_uid, max(depth) AS value FROM n GROUP BY 1) SELECT q.record_uid, w.value, {DEPTH_A.format(x='w.value')} AS class FROM {R} q LEFT JOIN w USING (record_uid)""")
def record_depth_classes(spark, d):
    """Worst nearest depth of every record and its class."""
    return pipelines.point_hazard(V.records(spark, d).select("record_uid", "x", "y", "located"), V.points(spark, d), "record_uid", "depth", C.depth_class(F.col("value")))


@query(None)
def museum_map_audit(spark, d):
    """Audit of listings against map elements."""
    m = V.listings(spark, d).select("museum_id", "facility_name", "municipality_name", "coordinate_use", "longitude", "latitude")
    e = V.elements(spark, d).filter("coalesce(osm_name, '') <> ''").withColumnsRenamed({"lon": "x", "lat": "y"})
    return pipelines.facility_audit(m, e)


@query(f"""WITH t AS (SELECT record_uid, coalesce(raw_designation,'') || coalesce(raw_category,'') AS s FROM {R} r) SELECT record_uid,
CASE WHEN regexp_matches(s, '区指定|市指定|町指定|村指定|区登録|市登録|町登録|村登録') THEN 'municipal' WHEN regexp_matches(s, '東京都指定|都指定|東京都登録|都登録|東京都選定|都選定') THEN 'prefectural' WHEN regexp_matches(s, '国指定|国登録|国選定|国宝|重要文化財|登録有形文化財|登録記念物|重要有形民俗文化財|重要無形民俗文化財|重要文化的景観|重要伝統的建造物群保存地区') THEN 'national' ELSE 'ambiguous' END AS level FROM t""")
def stated_levels(spark, d):
    """Designation level a record's own words state."""
    s = F.concat(F.coalesce("raw_designation", F.lit("")), F.coalesce("raw_category", F.lit("")))
    return V.records(spark, d).select("record_uid", C.stated_level(s, F.lit(""))["level"].alias("level"))


@query(None)
def classified_values(spark, d):
    """Observed values by overrides and glossary."""
    ref = table(spark, d, "heritage_type_ref")
    names = ref.select(F.col("heritage_type_major_ja").alias("match_value"), F.col("heritage_type_major_code").alias("type_code"), F.lit("high").alias("confidence"), F.lit(1).alias("priority"))
    aliases = ref.select(F.explode(F.split("aliases", ";")).alias("match_value"), F.col("heritage_type_major_code").alias("type_code"), F.lit("medium").alias("confidence"), F.lit(2).alias("priority"))
    overrides = spark.createDataFrame([("その他", "other", 1)], "raw_value string, type_code string, position int")
    o = V.observed(spark, d).filter("raw_value <> ''").select("obs_id", "raw_value")
    return pipelines.classify(o, names.union(aliases), overrides, ["raw_value"]).select("obs_id", "type_code", "confidence", "matched_by")


@query("SELECT building_gml_id, risk_index, count(*) AS copies, count(DISTINCT sha256(coalesce(risk_type,'') || '|' || coalesce(rank_code,''))) AS versions FROM plateau_disaster_risk GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_risk_versions(spark, d):
    """Repeated keys and whether their contents differ."""
    v = F.sha2(F.concat_ws("|", F.coalesce("risk_type", F.lit("")), F.coalesce("rank_code", F.lit(""))), 256)
    return table(spark, d, "plateau_disaster_risk").groupBy("building_gml_id", "risk_index").agg(F.count("*").alias("copies"), F.count_distinct(v).alias("versions")).filter("copies > 1")


@query(None)
def building_shapes(spark, d):
    """Area, interior point, centroid and bounds of footprints."""
    b = table(spark, d, "buildings")
    c, box = shapes.centroid(F.get("rings", F.lit(0))), shapes.bounds(F.col("rings"))
    return b.select("gml_id", F.round(shapes.footprint_area_m2("rings"), 3).alias("area_m2"), shapes.representative_point("rings").alias("p"), c.alias("c"), box.alias("b")).select("gml_id", "area_m2", F.col("p.x").alias("px"), F.col("p.y").alias("py"), F.col("c.x").alias("cx"), F.col("c.y").alias("cy"), "b.*")


@query(None)
def listing_geodesics(spark, d):
    """Ellipsoidal distance of listings to the nearest records of the distance join."""
    m = V.listings(spark, d).filter("located").select("museum_id", "longitude", "latitude")
    r = V.records(spark, d).filter("located").select("record_uid", "x", "y")
    near = spatial.within_distance(m, r, 60.0, ("longitude", "latitude"), ("x", "y"))
    return near.select("museum_id", "record_uid", F.round(shapes.geodesic_m("longitude", "latitude", "x", "y"), 3).alias("metres"))


@query("SELECT zone_id, zone_kind, CASE WHEN upper(geometry) LIKE '%POLYGON%' THEN 'polygon' ELSE '' END AS family, CASE zone_kind WHEN 'flood' THEN 'water' WHEN 'storm_surge' THEN 'water' WHEN 'fire' THEN 'fire' ELSE 'ground' END AS kind FROM hazard_zones")
def zone_families(spark, d):
    """Geometry family and hazard kind of zones."""
    kinds = {"flood": "water", "storm": "water", "fire": "fire"}
    return table(spark, d, "hazard_zones").select("zone_id", "zone_kind", shapes.geometry_family(F.col("geometry")).alias("family"), C.layer_kind(F.col("zone_kind"), kinds, "ground").alias("kind"))


@query(f"SELECT 'inundation_depth_max_m' AS \"column\", count(inundation_depth_max_m) AS numeric, count(inundation_depth_max_m) AS filled, count(DISTINCT inundation_depth_max_m) AS distinct_values FROM {G} g UNION ALL SELECT 'scenario', count(try_cast(scenario AS DOUBLE)), count(scenario), count(DISTINCT scenario) FROM {G} g")
def value_column_profile(spark, d):
    """Which columns hold numbers."""
    return pipelines.numeric_share(V.points(spark, d), ["inundation_depth_max_m", "scenario"])


@query(f"SELECT point_id FROM {G} g, (SELECT min(x)-0.001 AS x0, max(x)+0.001 AS x1, min(y)-0.001 AS y0, max(y)+0.001 AS y1 FROM {P} p WHERE located AND code = '13905') b WHERE lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1")
def points_in_bounds(spark, d):
    """Hazard points in the padded bounds of one municipality's records."""
    targets = V.records(spark, d).filter("located and code = '13905'")
    return selection.in_bounds(V.points(spark, d), targets, ("lon", "lat"), ("x", "y")).select("point_id")


@query(f"SELECT scenario, area, count(*) AS wet, max(depth) AS deepest FROM {G} g WHERE depth > 0 GROUP BY 1, 2")
def positive_points(spark, d):
    """Points with water by scenario and area."""
    return selection.positive_hazard(V.points(spark, d), "depth").groupBy("scenario", "area").agg(F.count("*").alias("wet"), F.max("depth").alias("deepest"))


@query(f"""WITH s AS (SELECT facility_name || '|' || code AS facility, nullif(address_raw,'') AS address, floor(coalesce(geocode_score, 0.0::DOUBLE)*100+0.5)::INT AS score FROM {L} l), p AS (SELECT facility, address, max(score) AS score FROM s WHERE address IS NOT NULL AND facility IS NOT NULL GROUP BY 1, 2),
t AS (SELECT *, max(score) OVER (PARTITION BY facility) AS best FROM p) SELECT facility, min(address) AS address, max(score) AS score, CASE WHEN max(score) < 70 THEN 'below_threshold' WHEN count(*) > 1 THEN 'tie' ELSE 'accepted' END AS status FROM t WHERE score = best GROUP BY 1""")
def best_scored_address(spark, d):
    """Best scored address of each facility, ties and low scores to review."""
    s = F.floor(F.coalesce("geocode_score", F.lit(0.0)) * 100 + 0.5).cast("int")
    m = V.listings(spark, d).filter("facility_name is not null").select(F.concat_ws("|", "facility_name", "code").alias("facility"), F.nullif("address_raw", F.lit("")).alias("address"), s.alias("score"))
    return selection.best_or_review(m, "facility", "address", "score")


@query("SELECT city_code, gml_id, year_of_construction FROM buildings QUALIFY row_number() OVER (PARTITION BY city_code ORDER BY year_of_construction DESC NULLS LAST, gml_id) = 1")
def latest_building(spark, d):
    """Newest building of each municipality."""
    return selection.latest(table(spark, d, "buildings"), "city_code", "year_of_construction", [F.col("gml_id")]).select("city_code", "gml_id", "year_of_construction")


@query(f"SELECT code, coalesce(arg_min(trim(facility_name), museum_id) FILTER (WHERE trim(coalesce(facility_name,'')) <> ''), '') AS first_name, coalesce(arg_min(trim(notes), museum_id) FILTER (WHERE trim(coalesce(notes,'')) <> ''), '') AS first_note FROM {L} l GROUP BY 1")
def first_filled_values(spark, d):
    """First filled name and note of the listings of a municipality."""
    pick = lambda c: selection.first_or_longest(F.col(c), F.col("museum_id"))
    return V.listings(spark, d).groupBy("code").agg(pick("facility_name").alias("first_name"), pick("notes").alias("first_note"))


@query(f"""WITH l AS (SELECT DISTINCT record_uid, unnest(matched_building_ids) AS gml_id FROM {R} r), i AS (SELECT gml_id, string_agg(record_uid::VARCHAR, ';' ORDER BY record_uid::VARCHAR) AS record_ids, list(record_uid ORDER BY record_uid::VARCHAR) AS ids FROM l GROUP BY 1),
f AS (SELECT gml_id, record_ids, ids, unnest(range(1, len(ids) + 1)) AS p FROM i), v AS (SELECT f.gml_id, f.record_ids, f.p, trim(r.name) AS name, trim(r.owner) AS owner FROM f JOIN {R} r ON r.record_uid = f.ids[f.p]),
n AS (SELECT gml_id, string_agg(v, ';' ORDER BY p) AS name FROM (SELECT gml_id, name AS v, min(p) AS p FROM v WHERE coalesce(name,'') <> '' GROUP BY 1, 2) GROUP BY 1), o AS (SELECT gml_id, string_agg(v, ';' ORDER BY p) AS owner FROM (SELECT gml_id, owner AS v, min(p) AS p FROM v WHERE coalesce(owner,'') <> '' GROUP BY 1, 2) GROUP BY 1)
SELECT i.record_ids, i.gml_id, coalesce(n.name,'') AS name, coalesce(o.owner,'') AS owner FROM i LEFT JOIN n USING (gml_id) LEFT JOIN o USING (gml_id)""")
def buildings_with_records(spark, d):
    """Names and owners of the records matched to each building, back-filled through the list of their ids."""
    links = V.records(spark, d).select("record_uid", F.explode("matched_building_ids").alias("gml_id")).groupBy("gml_id").agg(tables.sorted_unique(F.col("record_uid").cast("string")).alias("record_ids"))
    return selection.backfilled(links, "record_ids", V.records(spark, d), "record_uid", ["name", "owner"])


@query(f"SELECT museum_id, CASE WHEN n LIKE '国立%' OR n LIKE '%国立大学%' THEN 'national' WHEN n LIKE '東京都%' OR n LIKE '都立%' THEN 'metropolitan' WHEN regexp_matches(n, '区立|市立|町立|村立') THEN 'municipal' WHEN length(m) > 0 AND starts_with(n, m) THEN 'municipal' WHEN regexp_matches(n, '大学|学園|学院') THEN 'university' ELSE 'unknown' END AS sector FROM (SELECT museum_id, coalesce(facility_name,'') AS n, coalesce(municipality_name,'') AS m FROM {L} l)")
def facility_sectors(spark, d):
    """sector a facility's name speaks of."""
    n, m = F.coalesce("facility_name", F.lit("")), F.coalesce("municipality_name", F.lit(""))
    return V.listings(spark, d).select("museum_id", C.ownership(n, m).alias("sector"))
