"""Classes, units and decision tables as column expressions. Borders are part of the definition: two depth classes differ only there."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_DATA = "No data"
# Class labels in their published order.
SEISMIC_CLASSES = ["5弱未満", "5弱", "5強", "6弱", "6強以上", NO_DATA]
DEPTH_CLASSES = ["0", "0–0.5 m", "0.5–3 m", "3–5 m", "5 m以上"]
LIQUEFACTION_CLASSES = ["PL=0", "0<PL≤5", "5<PL≤15", "PL>15", NO_DATA]
LEVELS = {"national": "National", "prefectural": "Tokyo Metropolitan", "municipal": "Municipal", "unknown": "Unknown", "": "Unknown"}
STATUSES = {"designated": "Designated", "registered": "Registered", "selected": "Other", "record_selected": "Other", "local_other": "Other", "unknown": "Unknown", "": "Unknown"}
# Flood rank, native label, lower and upper depth, summary label.
FLOOD_RANKS = [
    (1, "0–0.5 m", 0.0, 0.5, "0–0.5 m"),
    (2, "0.5–3 m", 0.5, 3.0, "0.5–3 m"),
    (3, "3–5 m", 3.0, 5.0, "3–5 m"),
    (4, "5–10 m", 5.0, 10.0, "5 m以上"),
    (5, "10–20 m", 10.0, 20.0, "5 m以上"),
    (6, "20 m以上", 20.0, None, "5 m以上"),
]
# How many of a unit make a metre, and how many make an hour.
METRES = {"": 1.0, "m": 1.0, "meter": 1.0, "metre": 1.0, "meters": 1.0, "metres": 1.0, "cm": 100.0, "centimeter": 100.0, "centimetre": 100.0, "centimeters": 100.0, "centimetres": 100.0, "mm": 1000.0, "millimeter": 1000.0, "millimetre": 1000.0, "millimeters": 1000.0, "millimetres": 1000.0}
HOURS = {"": 1.0, "h": 1.0, "hr": 1.0, "hrs": 1.0, "hour": 1.0, "hours": 1.0, "min": 60.0, "mins": 60.0, "minute": 60.0, "minutes": 60.0, "s": 3600.0, "sec": 3600.0, "secs": 3600.0, "second": 3600.0, "seconds": 3600.0}
WATER_TYPES = ["river_flooding", "high_tide", "tsunami"]
INUNDATION_TYPES = ["river_flooding", "inland_flooding", "reservoir_flooding", "high_tide", "tsunami"]
CONFIDENCE = ["low", "medium", "high"]


def looked_up(c: Column, table: Mapping[str, str], unknown: str) -> Column:
    """Value of a small fixed map; null counts as ''."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[F.coalesce(c.cast("string"), F.lit(""))], F.lit(unknown))


def designation_level(c: Column) -> Column:
    """Published level name; a code outside the map is Unknown."""
    return looked_up(c, LEVELS, "Unknown")


def designation_status(c: Column) -> Column:
    """Published status name; a code outside the map is Other, a blank one Unknown."""
    return looked_up(c, STATUSES, "Other")


def labelled(c: Column, unknown: str) -> Column:
    """Text or a stand-in for null and ''."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(unknown))


def binned(x: Column, borders: Sequence[float], labels: Sequence[str], right_closed: bool, missing: str) -> Column:
    """Label of the interval; ``borders`` ascend, one label more than borders. NaN and null are missing."""
    out = F.when(x.isNull() | F.isnan(x), missing)
    for b, label in zip(borders, labels):
        out = out.when(x <= b if right_closed else x < b, label)
    return out.otherwise(labels[-1])


def seismic_class(x: Column) -> Column:
    """Intensity classes, left-closed at 4.5, 5.0, 5.5 and 6.0."""
    return binned(x, [4.5, 5.0, 5.5, 6.0], SEISMIC_CLASSES[:5], False, NO_DATA)


def depth_class(x: Column) -> Column:
    """Depth classes for tables: 0 and below, then left-closed at 0.5, 3 and 5."""
    return F.when(x <= 0, DEPTH_CLASSES[0]).otherwise(binned(x, [0.5, 3.0, 5.0], DEPTH_CLASSES[1:], False, NO_DATA))


def depth_class_map(x: Column) -> Column:
    """Depth classes for maps: right-closed at 0, 0.5, 3 and 5; infinite and missing values give ''."""
    finite = F.when(F.abs(x) < float("inf"), x)
    return binned(finite, [0.0, 0.5, 3.0, 5.0], DEPTH_CLASSES, True, "")


def liquefaction_class(x: Column, missing: str = NO_DATA) -> Column:
    """Liquefaction potential classes, right-closed at 0, 5 and 15."""
    return binned(x, [0.0, 5.0, 15.0], LIQUEFACTION_CLASSES[:4], True, missing)


def depth_label(c: Column) -> Column:
    """Canonical depth label from spelling variants of dash and space; '' for anything else."""
    s = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "[-〜～]", "–"), r"\s+", " ")
    s = F.regexp_replace(s, r"(\d) ?m", "$1 m")
    return F.when(s.isin(DEPTH_CLASSES), s).otherwise("")


def rank_category(c: Column) -> Column:
    """Depth class of a flood rank; ranks of 0 and below, and unreadable ones, are 0, above 3 the deepest."""
    rank = F.coalesce(c.cast("string").try_cast("double").cast("int"), F.lit(0))
    out = F.when(rank <= 0, DEPTH_CLASSES[0])
    for code, _, _, _, label in FLOOD_RANKS[:3]:
        out = out.when(rank == code, label)
    return out.otherwise(DEPTH_CLASSES[4])


def in_unit(value: Column, unit: Column, per_base: Mapping[str, float]) -> Column:
    """Value in the base unit, of which ``per_base`` says how many of a unit make one; null for an unknown unit."""
    u = F.lower(F.trim(F.coalesce(unit, F.lit(""))))
    out = None
    for name, n in per_base.items():
        out = F.when(u == name, value / n) if out is None else out.when(u == name, value / n)
    return out


def metres(value: Column, unit: Column) -> Column:
    """Length in metres; no unit means metres, an unknown one gives null."""
    return in_unit(value, unit, METRES)


def hours(value: Column, unit: Column) -> Column:
    """Duration in hours; no unit means hours, an unknown one gives null."""
    return in_unit(value, unit, HOURS)


def display(code: Column, label: Column) -> Column:
    """Resolved label, else the raw code, else ''."""
    return F.coalesce(F.nullif(F.trim(label), F.lit("")), F.nullif(F.trim(code), F.lit("")), F.lit(""))


def severity(depth_m: Column, label: Column) -> Column:
    """How severe a ranked risk is: its depth, else the largest number in its label, else -1."""
    numbers = F.transform(F.regexp_extract_all(label, F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1)), lambda n: n.cast("double"))
    return F.coalesce(depth_m, F.array_max(numbers), F.lit(-1.0))


def worst_landslide(labels: Column) -> Column:
    """First label that speaks of a special zone, else the first one, else ''."""
    special = F.filter(labels, lambda x: x.contains("特別"))
    return F.coalesce(F.try_element_at(special, F.lit(1)), F.try_element_at(labels, F.lit(1)), F.lit(""))


def floor_exposure(risk_type: Column, depth_m: Column, floor_height_m: Column, basement: Column, floor_min: Column) -> Column:
    """Exposure of a space to a flood: seven outcomes, without inventing a floor height."""
    return (
        F.when(~risk_type.isin(INUNDATION_TYPES) | risk_type.isNull(), "not_assessed_non_inundation")
        .when(depth_m.isNull(), "hazard_present_depth_unknown")
        .when(depth_m <= 0, "above_water_level")
        .when(floor_height_m.isNotNull(), F.when(depth_m >= floor_height_m, "potentially_exposed").otherwise("above_water_level"))
        .when(F.coalesce(basement, F.lit(False)), "potentially_exposed")
        .when(floor_min <= 1, "potentially_exposed")
        .when(floor_min > 1, "undetermined_floor_elevation")
        .otherwise("undetermined_floor")
    )


def least_confidence(values: Column) -> Column:
    """The lowest of the confidences present in an array; ``low`` if none is."""
    ranks = F.transform(F.filter(values, lambda v: v.isin(CONFIDENCE)), lambda v: F.array_position(F.array(*[F.lit(c) for c in CONFIDENCE]), v).cast("int"))
    return F.coalesce(F.try_element_at(F.array(*[F.lit(c) for c in CONFIDENCE]), F.array_min(ranks)), F.lit("low"))


def candidate_score(name_level: Column, same_city: Column, same_host: Column, distance_m: Column) -> Column:
    """Additive score of a facility candidate: name level (exact, contained, similar), municipality, website, distance bands."""
    name = F.when(name_level == "exact", 100).when(name_level == "contained", 70).when(name_level == "similar", 55).otherwise(0)
    city = F.when(same_city.isNull(), 0).when(same_city, 20).otherwise(-100)
    host = F.when(F.coalesce(same_host, F.lit(False)), 30).otherwise(0)
    near = F.when(distance_m <= 100, 30).when(distance_m <= 500, 20).when(distance_m <= 2000, 5).when(distance_m > 10_000, -30).otherwise(0)
    return (name + city + host + near).cast("int")


def ownership(name: Column, municipality: Column) -> Column:
    """Sector a facility's name speaks of."""
    return (
        F.when(name.startswith("国立") | name.contains("国立大学"), "national")
        .when(name.startswith("東京都") | name.startswith("都立"), "metropolitan")
        .when(name.rlike("区立|市立|町立|村立"), "municipal")
        .when((F.length(municipality) > 0) & name.startswith(municipality), "municipal")
        .when(name.rlike("大学|学園|学院"), "university")
        .otherwise("unknown")
    )


# Words that state the authority of a designation.
LEVEL_WORDS = {
    "municipal": ["区指定", "市指定", "町指定", "村指定", "区登録", "市登録", "町登録", "村登録"],
    "prefectural": ["東京都指定", "都指定", "東京都登録", "都登録", "東京都選定", "都選定"],
    "national": ["国指定", "国登録", "国選定", "国宝", "重要文化財", "登録有形文化財", "登録記念物", "重要有形民俗文化財", "重要無形民俗文化財", "重要文化的景観", "重要伝統的建造物群保存地区"],
}


def stated_level(text: Column, municipality: Column, default: Column | None = None, words: Mapping[str, Sequence[str]] = LEVEL_WORDS) -> Column:
    """struct(level, reason): the most local authority a text speaks of, else a configured default, else ``ambiguous``."""
    s = F.coalesce(text, F.lit(""))
    says = lambda ws: s.rlike("|".join(ws))
    named = (F.length(F.coalesce(municipality, F.lit(""))) > 0) & (s.contains(F.concat(municipality, F.lit("指定"))) | s.contains(F.concat(municipality, F.lit("登録"))) | s.contains(F.concat(municipality, F.lit("選定"))))
    pair = lambda level, reason: F.struct((F.lit(level) if isinstance(level, str) else level).alias("level"), F.lit(reason).alias("reason"))
    out = F.when(says(words["municipal"]) | F.coalesce(named, F.lit(False)), pair("municipal", "explicit_municipal_keyword"))
    for level in ("prefectural", "national"):
        out = out.when(says(words[level]), pair(level, f"explicit_{level}_keyword"))
    if default is not None:
        out = out.when(default.isin("municipal", "prefectural", "national"), pair(default, "configured_default"))
    return out.otherwise(pair("ambiguous", "no_explicit_designation_level"))


def mapped_class(kind: Column, classes: Mapping[str, str], roles: Mapping[str, str], fallback: str) -> Column:
    """struct(entity_class, geometry_role) of a type by configurable maps; a class without a role is an error of the configuration."""
    if unknown := {*classes.values(), fallback} - set(roles):
        raise ValueError(f"no geometry role for {sorted(unknown)}")
    entity = looked_up(kind, classes, fallback)
    return F.struct(entity.alias("entity_class"), looked_up(entity, roles, "").alias("geometry_role"))


def risk_class(rank: Column, rank_org: Column, area_type: Column) -> Column:
    """First filled of rank, organisational rank and area type; '' if none."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in (rank, rank_org, area_type)], F.lit(""))


def risk_label(parts: Sequence[Column], depth_m: Column, duration_h: Column) -> Column:
    """Readable label of a risk: filled parts, depth and duration, joined by a bar."""
    short = lambda c: F.regexp_replace(F.format_string("%.6f", c), r"\.?0+$", "")
    texts = [F.nullif(F.trim(c), F.lit("")) for c in parts]
    measured = [F.when(depth_m.isNotNull(), F.concat(F.lit("深さ "), short(depth_m), F.lit(" m"))), F.when(duration_h.isNotNull(), F.concat(F.lit("継続 "), short(duration_h), F.lit(" h")))]
    return F.concat_ws("｜", *texts, *measured)


def address_evidence(address: Column, municipality: Column, prefecture: str, linked_data: Column, access_hint: Column, mailing_hint: Column, on_page: Column, in_section: Column, own_host: Column) -> Column:
    """Additive score of an address found on a page."""
    yes = lambda c, n: F.when(F.coalesce(c, F.lit(False)), n).otherwise(0)
    return (
        yes((F.length(municipality) > 0) & address.contains(municipality), 60) + yes(address.startswith(prefecture) & address.rlike(r"\d"), 20) + yes(linked_data, 15)
        + yes(access_hint, 10) + yes(mailing_hint, -50) + yes(on_page, 25) + yes(in_section, 25) + yes(own_host, 10)
    ).cast("int")


def element_role(tags: Column, element: Column, exact_name: Column, own_site: Column) -> Column:
    """What a tagged map element is: the facility's building, the facility, something serving it, or just something of that name."""
    tag = lambda k: F.coalesce(F.trim(F.try_element_at(tags, F.lit(k))), F.lit(""))
    area = element.isin("way", "relation")
    return (
        F.when(area & ((tag("building") == "museum") | (tag("building:use") == "museum") | ((tag("building") != "") & exact_name)), "facility_building")
        .when(tag("tourism").isin("museum", "gallery", "zoo", "aquarium") | (tag("amenity") == "arts_centre") | (tag("museum") != ""), "facility_feature")
        .when((tag("amenity") != "") | (tag("tourism") != "") | (tag("entrance") != "") | (tag("highway") != "") | (tag("shop") != ""), "supporting_poi")
        .when(F.coalesce(own_site, F.lit(False)), "official_site_supported_object")
        .otherwise("named_object")
    )


def role_preference(role: Column, element: Column) -> Column:
    """Order of roles, best first."""
    area = element.isin("way", "relation")
    return (
        F.when((role == "facility_building") & area, 0).when((role == "facility_feature") & area, 1).when(role == "facility_feature", 2)
        .when(role == "official_site_supported_object", 3).when(role == "named_object", 4).otherwise(5)
    )


def municipality_evidence(expected: Column, stated: Column) -> Column:
    """match, conflict (another municipality is named) or unknown."""
    s = F.coalesce(stated, F.lit(""))
    return F.when((F.length(expected) > 0) & s.contains(expected), "match").when(s.rlike("[^\\s,，]+[区市町村]"), "conflict").otherwise("unknown")


def layer_kind(name: Column, prefixes: Mapping[str, str], fallback: str = "other") -> Column:
    """Kind of a layer by the longest matching prefix of its name."""
    out = None
    for prefix, kind in sorted(prefixes.items(), key=lambda kv: -len(kv[0])):
        out = F.when(name.startswith(prefix), kind) if out is None else out.when(name.startswith(prefix), kind)
    return F.lit(fallback) if out is None else out.otherwise(fallback)


# Metrics in names of tsunami resources.
TSUNAMI_METRICS = {"到達時間": "arrival", "津波高": "height", "浸水深": "depth"}


def tsunami_parts(name: Column) -> Column:
    """struct(area, scenario, metric) of a resource name; metric is null where the name states none."""
    s = F.regexp_replace(name, "(?i)CSV$", "")
    area = F.when(s.contains("_"), F.element_at(F.split(s, "_"), 1)).otherwise("")
    metric = None
    for word, code in TSUNAMI_METRICS.items():
        metric = F.when(s.contains(word), code) if metric is None else metric.when(s.contains(word), code)
    rest = F.when(area != "", F.regexp_replace(s, "^[^_]*_", "")).otherwise(s)
    scenario = F.regexp_replace(F.regexp_replace(rest, "_?(?:" + "|".join(TSUNAMI_METRICS) + ")", ""), "^[_ ]+|[_ ]+$", "")
    return F.struct(area.alias("area"), scenario.alias("scenario"), metric.alias("metric"))
