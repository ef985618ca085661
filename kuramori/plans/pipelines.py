"""Composite operators: what a user calls. Each is one plan over all municipalities; the municipality is a column, never a loop."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kuramori.functions import classes as C
from kuramori.functions import text as X
from kuramori.functions.geometry import haversine_m, plausible
from kuramori.operators import lookup, similar, spatial, tables
from kuramori.operators.components import connected_components
from kuramori.operators.dedupe import best_row
from kuramori.session import cut


def match_records(records: DataFrame, buildings: DataFrame, match_shared: bool = False) -> DataFrame:
    """(record_uid, gml_id, methods) of exact evidence: point in footprint, equal normalised name, equal normalised address.

    A coordinate shared within a complex locates no building unless asked for; names and addresses count for records that are themselves
    buildings. No radius and no nearest neighbour."""
    usable = F.col("located") & (F.lit(match_shared) | (F.coalesce("source_location_role", F.lit("")) != "shared_complex_coordinate"))
    inside = spatial.in_box_rings(records.filter(usable), buildings, "record_uid", "gml_id", "rings", ("x", "y")).withColumn("method", F.lit("point_in_building"))
    direct = records.filter("entity_class = 'building_direct'")
    names = direct.select("record_uid", F.explode(F.array_distinct(F.array(X.name_key(F.col("name")), X.name_key(F.col("place_name"))))).alias("k"))
    named = buildings.select("gml_id", X.name_key(F.col("name")).alias("k")).filter("k <> ''")
    by_name = names.filter("k <> ''").join(named, "k").select("record_uid", "gml_id", F.lit("exact_name").alias("method"))
    placed = buildings.select("gml_id", X.address_key(F.col("address")).alias("k")).filter("k <> ''")
    by_address = direct.select("record_uid", X.address_key(F.col("address")).alias("k")).filter("k <> ''").join(placed, "k").select("record_uid", "gml_id", F.lit("exact_address").alias("method"))
    return inside.unionByName(by_name).unionByName(by_address).groupBy("record_uid", "gml_id").agg(tables.sorted_unique(F.col("method")).alias("methods"))


def extract_package(records: DataFrame, buildings: DataFrame) -> dict[str, DataFrame]:
    """Links, complex members, complex summary, fallback points and unresolved records of a delivery."""
    links = match_records(records, buildings)
    matched = links.groupBy("record_uid").agg(F.count("*").alias("buildings"))
    r = records.join(matched, "record_uid", "left")
    in_complex = F.coalesce("complex_id", F.lit("")) != ""
    # counted per complex and joined: rows without one, however many, form no group
    per = r.filter(in_complex).groupBy("complex_id").agg(F.count("*").alias("_size"), F.max(F.col("buildings").isNotNull().cast("int")).alias("_hit"))
    r = r.join(per, "complex_id", "left")
    state = (
        F.when(F.col("buildings").isNotNull(), "building_matched")
        .when(in_complex & (F.col("_size") > 1) & (F.col("source_location_role") == "shared_complex_coordinate"), "complex_only")
        .when(F.col("located"), "point_unmatched")
        .otherwise("unlocated")
    )
    r = r.withColumn("state", state)
    members = links.join(records.select("record_uid", "complex_id"), "record_uid").filter("coalesce(complex_id, '') <> ''").select("complex_id", "gml_id").distinct()
    summary = r.filter(in_complex).groupBy("complex_id").agg(F.count("*").alias("records"), F.count_if(F.col("state") == "building_matched").alias("matched_records"), F.max("_hit").alias("_hit"), F.min("name").alias("first_name"))
    summary = summary.withColumn("complex_status", F.when(F.col("_hit") == 1, "matched_building_complex").when(F.col("records") > 1, "complex_only").otherwise("single_unmatched")).drop("_hit")
    return {
        "links": links,
        "complex_members": members,
        "complex_summary": summary,
        "points": r.filter("state = 'point_unmatched'").select("record_uid", "x", "y", F.lit("record_not_in_building").alias("reason")),
        "unresolved": r.filter("state in ('unlocated', 'complex_only')").select("record_uid", "state"),
        "records": r.select("record_uid", "state", F.coalesce("buildings", F.lit(0)).alias("buildings")),
    }


def merged_packages(packages: dict[str, dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Union by name of the layers of several packages {code: {layer: rows}} with their municipality; a code column that contradicts the package
    is an error when the result is checked with ``contradicting_codes``."""
    layers: dict[str, list[DataFrame]] = {}
    for code, tables_ in sorted(packages.items()):
        for name, df in tables_.items():
            layers.setdefault(name, []).append(df.withColumn("package_code", F.lit(code)))
    return {n: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs) for n, dfs in layers.items()}


def contradicting_codes(df: DataFrame, column: str = "municipality_code") -> DataFrame:
    """Rows whose own code differs from their package's."""
    return df.filter((X.municipality_code(F.col(column)) != F.col("package_code")) & (F.coalesce(F.col(column), F.lit("")) != ""))


def classify(values: DataFrame, glossary: DataFrame, overrides: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Classification of typed values: an override with the same keys wins (the last of several), else the glossary rule of lowest priority
    whose normalised value is equal; ``confidence`` is the rule's, ``low`` without one."""
    v = values.withColumn("_k", X.squeezed(F.col("raw_value")))
    last = best_row(overrides.withColumn("_o", F.col("position")), list(keys), [F.col("_o")], descending=True).select(*keys, F.col("type_code").alias("_override"))
    rules = glossary.withColumn("_k", X.squeezed(F.col("match_value"))).groupBy("_k").agg(F.min_by(F.struct("type_code", "confidence"), F.struct("priority", "match_value")).alias("_rule"))
    out = v.join(rules, "_k", "left").join(last, list(keys), "left")
    how = F.when(F.col("_override").isNotNull(), "override").when(F.col("_rule").isNotNull(), "glossary").otherwise("none")
    confidence = F.when(F.col("_override").isNotNull(), "high").otherwise(F.coalesce("_rule.confidence", F.lit("low")))
    return out.select(*values.columns, F.coalesce("_override", "_rule.type_code").alias("type_code"), confidence.alias("confidence"), how.alias("matched_by"))


def disaster_layers(risks: DataFrame, buildings: DataFrame, codelist: DataFrame, by_type: DataFrame, limit: int = 8) -> dict[str, DataFrame]:
    """Risks of known buildings with resolved labels, class and text; and one row per building with numbered slots. Too many risks for the
    slots, or a code list that contradicts itself, raise before anything is written."""
    lookup.assert_none(lookup.colliding_codes(codelist), "code list collisions")
    known = risks.join(buildings.select(F.col("gml_id").alias("building_gml_id")).distinct(), "building_gml_id", "left_semi")
    lookup.assert_none(tables.overflowing(known, "building_gml_id", limit), f"more than {limit} risks")
    fields = ["rank", "rank_org", "area_type"]
    codes = known.select("building_gml_id", "risk_index", "risk_type", *[f"{f}_{x}" for f in fields for x in ("code", "label", "codespace")])
    labels = lookup.resolve_codes(codes, fields, codelist, by_type, "risk_type").groupBy("building_gml_id", "risk_index").pivot("field", fields).agg(F.first("label"))
    plain = known.select("building_gml_id", "risk_index", "risk_type", "risk_type_ja", "depth_m", "duration_h")
    long = plain.join(labels, ["building_gml_id", "risk_index"], "left").withColumn("risk_class", C.risk_class(F.col("rank"), F.col("rank_org"), F.col("area_type")))
    long = long.withColumn("risk_label", C.risk_label([F.coalesce("risk_type_ja", "risk_type"), F.col("risk_class")], F.col("depth_m"), F.col("duration_h")))
    order = [F.col("risk_type").asc_nulls_last(), F.col("depth_m").desc_nulls_last(), F.col("risk_index")]
    return {"risks": long, "wide": tables.slots(long, "building_gml_id", order, ["risk_type", "risk_class", "risk_label", "depth_m"], limit)}


def point_hazard(locations: DataFrame, hazard: DataFrame, key: str, value: str, classify_: Column, reach: float = 25.0) -> DataFrame:
    """(key, value, class) of the worst nearest hazard point of each record's locations; records without one are kept without value.

    The values are as many as the records near a point, so they too are joined by sorting: adaptive execution would else copy them to the driver."""
    x, y = spatial.to_mercator(F.col("x"), F.col("y"))
    hx, hy = spatial.to_mercator(F.col("lon"), F.col("lat"))
    at = locations.filter("located").select(key, x.alias("_x"), y.alias("_y")).distinct().withColumn("_id", F.xxhash64(key, "_x", "_y"))
    hits = spatial.nearest_within(at, hazard.select(hx.alias("_hx"), hy.alias("_hy"), F.col(value).alias("value")), "_id", reach, ("_x", "_y"), ("_hx", "_hy"))
    worst = hits.groupBy(key).agg(F.max("value").alias("value"))
    return locations.select(key).distinct().join(worst.hint("merge"), key, "left").withColumn("class", classify_)


def numeric_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, numeric, filled, distinct_values) of candidate value columns, in one pass; callers choose the value column from it."""
    cells = [F.struct(F.lit(c).alias("column"), F.count(F.col(f"`{c}`").cast("string").try_cast("double")).alias("numeric"), F.count(F.col(f"`{c}`")).alias("filled"), F.count_distinct(F.col(f"`{c}`")).alias("distinct_values")) for c in columns]
    names = [f"c{i}" for i in range(len(cells))]
    return df.agg(*[c.alias(n) for c, n in zip(cells, names)]).select(F.explode(F.array(*names)).alias("x")).select("x.*")


def value_column(df: DataFrame, preferred: Sequence[str], token: str = "", few: int | None = None) -> str | None:
    """Value column by data: a preferred name with numbers, else a name with the token and numbers, else any with numbers; with ``few`` the
    one of at most that many distinct values with the fewest."""
    profile = [r for r in numeric_share(df, df.columns).collect() if r["numeric"]]
    by = {r["column"]: r for r in profile}
    if few is not None:
        small = sorted((r for r in profile if r["distinct_values"] <= few), key=lambda r: (r["distinct_values"], df.columns.index(r["column"])))
        return small[0]["column"] if small else None
    order = [*[c for c in preferred if c in by], *[c for c in df.columns if token and token in c.lower() and c in by], *[c for c in df.columns if c in by]]
    return order[0] if order else None


def facility_candidates(listings: DataFrame, elements: DataFrame) -> DataFrame:
    """(museum_id, osm_id, level) of all elements whose name speaks for a listing, wherever they are: the equal name key, else one
    letters key contained in the other, else similar ones (0.72)."""
    keys = lambda df, key, name: df.select(key, X.facility_key(F.col(name)).alias("same"), X.letters_key(F.col(name)).alias(f"_{key}"))
    m, e = cut(keys(listings, "museum_id", "facility_name")), cut(keys(elements, "osm_id", "osm_name"))
    a, b = "_museum_id", "_osm_id"
    levels = similar.contained_pairs(m, e, a, b).select(a, b, F.lit("contained").alias("level")).union(similar.similar_pairs(m, e, a, b, 0.72).select(a, b, F.lit("similar")))
    loose = m.join(levels, a).join(e.select("osm_id", b), b).select("museum_id", "osm_id", "level")
    exact = m.filter("same <> ''").join(e, "same").select("museum_id", "osm_id", F.lit("exact").alias("level"))
    order = F.when(F.col("level") == "exact", 0).when(F.col("level") == "contained", 1).otherwise(2)
    return exact.union(loose).groupBy("museum_id", "osm_id").agg(F.min_by("level", order).alias("level"))


def facility_audit(listings: DataFrame, elements: DataFrame) -> DataFrame:
    """One row per listing: its best map element, whether elements disagree, and how many distinct facilities they are.

    Candidates come from names alone (``facility_candidates``); municipality and distance only score them, and a place that is missing
    or impossible scores nothing. Elements of a listing are one facility if they share a website host or, with the exact name, lie within
    100 m (components). ``matched`` is a single facility with a corroborated element: the exact name, no other municipality stated,
    supported by its municipality or by a building's place within 2 km, and itself a facility."""
    here, there = plausible(F.col("longitude"), F.col("latitude")), plausible(F.col("x"), F.col("y"))
    m = listings.select("museum_id", "facility_name", "municipality_name", "coordinate_use", *[F.when(here, F.col(c)).alias(c) for c in ("longitude", "latitude")])
    e = elements.withColumn("_there", there).withColumns({c: F.when(F.col("_there"), F.col(c)) for c in ("x", "y")}).drop("_there")
    metres = F.when(F.col("longitude").isNotNull() & F.col("x").isNotNull(), haversine_m(F.col("longitude"), F.col("latitude"), F.col("x"), F.col("y")))
    c = facility_candidates(m, e).join(m, "museum_id").join(e, "osm_id").withColumn("distance_m", metres)
    tags = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("v")) for k in ("tourism", "amenity")]), lambda t: t["v"].isNotNull()))
    city = C.municipality_evidence(F.col("municipality_name"), F.concat_ws(" ", "addr_city", "addr_full"))
    exact_name = F.col("level") == "exact"
    c = c.withColumn("city", city).withColumn("role", C.element_role(tags, F.col("osm_type"), exact_name, F.lit(False)))
    same_city = F.when(F.col("city") == "match", True).when(F.col("city") == "conflict", False)
    c = c.withColumn("score", C.candidate_score(F.col("level"), same_city, F.lit(None).cast("boolean"), F.col("distance_m")))
    placed = F.coalesce((F.col("coordinate_use") == "building_candidate") & (F.col("distance_m") <= 2000), F.lit(False))
    sure = exact_name & (F.col("city") != "conflict") & ((F.col("city") == "match") | placed) & F.col("role").isin("facility_building", "facility_feature")
    node = F.concat_ws("|", "museum_id", F.col("osm_id").cast("string"))
    c = cut(c.select("museum_id", "osm_id", "osm_type", "level", "score", "role", sure.alias("sure"), X.url_host(F.col("website")).alias("host"), node.alias("node")))
    same_host = c.filter("host <> ''").groupBy("museum_id", "host").agg(F.min("node").alias("a")).join(c.select("museum_id", "host", "node"), ["museum_id", "host"]).select("a", "node")
    # elements of one exact name are close or not whatever the listing: found once per name, then a star per listing
    named = e.select("osm_id", X.facility_key(F.col("osm_name")).alias("same"), "x", "y").filter("same <> '' and x is not null")
    other = named.select(F.col("osm_id").alias("other_id"), F.col("same").alias("other_same"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    close = spatial.within_distance(other, named, 100.0, ("ox", "oy"), ("x", "y")).filter("same = other_same and osm_id <= other_id")
    spots = connected_components(close, "osm_id", "other_id").select(F.col("node").alias("osm_id"), F.col("component").alias("spot"))
    at = c.filter("level = 'exact'").select("museum_id", "osm_id", "node").join(spots, "osm_id")
    same_spot = at.groupBy("museum_id", "spot").agg(F.min("node").alias("a")).join(at, ["museum_id", "spot"]).select("a", "node")
    part = connected_components(same_host.union(same_spot), "a", "node").withColumnRenamed("component", "facility")
    g = c.join(part, "node", "left").withColumn("facility", F.coalesce("facility", "node"))
    row, order = F.struct("osm_id", "osm_type", "score", "role"), F.struct(C.role_preference(F.col("role"), F.col("osm_type")), -F.col("score"), "osm_type", "osm_id")
    groups = g.groupBy("museum_id", "facility").agg(F.min_by(row, order).alias("best"), F.min(order).alias("order"), F.count("*").alias("n"), F.bool_or("sure").alias("sure"))
    audit = groups.groupBy("museum_id").agg(
        F.count("*").alias("facilities"), F.sum("n").alias("candidates"), F.count_if("sure").alias("sure"),
        F.min_by("best", "order").alias("first"), F.min_by(F.when(F.col("sure"), F.col("best")), F.when(F.col("sure"), F.col("order"))).alias("corroborated"),
    )
    out = listings.select("museum_id").join(audit, "museum_id", "left").withColumn("best", F.when(F.col("sure") == 1, F.col("corroborated")).otherwise(F.col("first")))
    status = F.when(F.col("best").isNull(), "no_candidate").when(F.col("sure") == 1, "matched").otherwise("review")
    return out.select("museum_id", F.coalesce("facilities", F.lit(0)).alias("facilities"), F.coalesce("candidates", F.lit(0)).alias("candidates"), "best.osm_id", "best.role", "best.score", status.alias("status"))
