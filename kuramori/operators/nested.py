"""Deeply nested city-model records into related flat tables, routed by a bottom-up tree automaton.

Every JSON node gets a *state* from its own label and the states of its children (``AUTOMATON`` below); the state
names the structural variant of the object. Layouts differ in wrappers, key prefixes (``uro:``, ``gml:``, ``@``) and in
whether an object, a list or a scalar stands in a place, yet each variant ends in one of four subtype tables
(building, part, risk, scenario), which share the supertype keys ``raw_id``, ``node_key``, ``parent_key`` and ``variant``.

Defined results: a payload that is null, empty, or not complete JSON gives no rows; null entries in lists don't count;
an object or list that stands as a string of JSON, at the top or inside, counts as what it holds;
an object without an id is no building; unknown keys are ignored and never clash, as columns are chosen by state."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kuramori.functions.classes import HOURS, METRES
from kuramori.operators.dedupe import best_row
from kuramori.session import cut

CODED = ("description", "rank", "rankOrg", "adminType", "scale", "areaType")
COLUMN_OF = {"description": "description", "rank": "rank", "rankOrg": "rank_org", "adminType": "admin_type", "scale": "scale", "areaType": "area_type"}
# City-model risk attribute names, the published type codes and their Japanese labels.
RISK_TYPES = {
    "RiverFloodingRiskAttribute": ("river_flooding", "洪水"),
    "InlandFloodingRiskAttribute": ("inland_flooding", "内水"),
    "ReservoirFloodingRiskAttribute": ("reservoir_flooding", "ため池"),
    "HighTideRiskAttribute": ("high_tide", "高潮"),
    "TsunamiRiskAttribute": ("tsunami", "津波"),
    "LandSlideRiskAttribute": ("landslide", "土砂災害"),
    "FireSpreadRiskAttribute": ("fire_spread", "延焼"),
}

RISK_FIELDS = (
    "risk_index int, risk_type string, risk_attribute_type string, risk_type_ja string, "
    + ", ".join(f"{c}_code string, {c}_codespace string" for c in COLUMN_OF.values())
    + ", depth_value double, depth_uom string, depth_m double, duration_value double, duration_uom string, duration_h double"
)
ROUTED = (
    "raw_id long, received_at timestamp, source_gml string, city_code string, kind string, variant string, node_key string, parent_key string, building_gml_id string, "
    "scenario_index int, measured_height_m double, storeys_above int, usage_code string, " + RISK_FIELDS
)
NAMES = [part.split()[0] for part in ROUTED.split(", ")]


def local_name(key: str) -> str:
    """Key without namespace prefix and attribute sign."""
    return key.rsplit(":", 1)[-1].lstrip("@")


class Node:
    """A JSON value with the state the automaton gave it."""

    __slots__ = ("state", "value", "kids", "label")

    def __init__(self, state: str, value: Any, kids: dict[str, list["Node"]], label: str) -> None:
        self.state, self.value, self.kids, self.label = state, value, kids, label


# Transitions, tried in order: (state, label test, child-state test). ``has`` holds the states found among the children by local name.
AUTOMATON = (
    ("null", lambda lab, v, has: v is None),
    ("scalar", lambda lab, v, has: not isinstance(v, (dict, list))),
    ("list", lambda lab, v, has: isinstance(v, list)),
    ("code.pair", lambda lab, v, has: "code" in has or ("#text" in has and "codeSpace" in has)),
    ("measure", lambda lab, v, has: "value" in has or ("#text" in has and "uom" in has)),
    ("risk.flat", lambda lab, v, has: "type" in has and lab == "bldgDisasterRiskAttribute"),
    ("risk.body", lambda lab, v, has: lab.endswith("RiskAttribute") and lab != "bldgDisasterRiskAttribute"),
    ("risk.holder", lambda lab, v, has: lab == "bldgDisasterRiskAttribute"),
    ("scenario", lambda lab, v, has: lab in ("scenarios", "scenario")),
    ("part", lambda lab, v, has: ("id" in has or "gml_id" in has) and lab in ("consistsOfBuildingPart", "BuildingPart")),
    ("building", lambda lab, v, has: "id" in has or "gml_id" in has),
    ("wrapper", lambda lab, v, has: True),
)


def decoded(value: Any) -> Any:
    """The object or list behind a string of JSON, however often it was encoded; any other value as it is."""
    inner = value
    while isinstance(inner, str) and inner.lstrip()[:1] in ("{", "[", '"'):
        try:
            inner = json.loads(inner)
        except (ValueError, RecursionError):
            return value
    return inner if isinstance(inner, (dict, list)) else value


def classify(value: Any, label: str = "") -> Node:
    """Bottom-up run: children first, then the first transition that applies. Lists pass their label on to their items; an object or
    list delivered as a string of JSON is read as what it holds."""
    kids: dict[str, list[Node]] = {}
    value = decoded(value)
    if isinstance(value, dict):
        for key, child in value.items():
            kids.setdefault(local_name(key), []).append(classify(child, local_name(key)))
    elif isinstance(value, list):
        kids["[]"] = [classify(child, label) for child in value]
    for state, test in AUTOMATON:
        if test(label, value, kids):
            return Node(state, value, kids, label)
    raise AssertionError("the last transition always applies")


def items(nodes: list[Node] | None) -> Iterator[Node]:
    """Members of a place, whether it holds one object or (nested) lists; null entries don't count."""
    for n in nodes or ():
        if n.state == "list":
            yield from items(n.kids["[]"])
        elif n.state != "null":
            yield n


def _scalar(n: Node | None) -> Any:
    return None if n is None or n.state != "scalar" else n.value


def _text(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return str(value)


def _coded(nodes: list[Node] | None) -> tuple[str, str]:
    for n in items(nodes):
        if n.state == "scalar":
            return _text(n.value), ""
        if n.state == "code.pair":
            first = (n.kids.get("code") or n.kids.get("#text"))[0]
            space = n.kids.get("codeSpace")
            return _text(_scalar(first)), _text(_scalar(space[0] if space else None))
    return "", ""


def _number(value: Any) -> float | None:
    try:
        return None if value is None or isinstance(value, bool) else float(value)
    except ValueError:
        return None


def _measure(nodes: list[Node] | None) -> tuple[float | None, str]:
    for n in items(nodes):
        if n.state == "scalar":
            return _number(n.value), ""
        if n.state == "measure":
            first = (n.kids.get("value") or n.kids.get("#text"))[0]
            unit = n.kids.get("uom")
            return _number(_scalar(first)), _text(_scalar(unit[0] if unit else None))
    return None, ""


def _converted(value: float | None, unit: str, per_base: Mapping[str, float]) -> float | None:
    n = per_base.get(unit.strip().lower())
    return None if value is None or n is None else value / n


def risk_bodies(nodes: list[Node] | None) -> Iterator[tuple[str, Node, str]]:
    """(type, body, variant) of each risk of a holder place, in payload order."""
    for n in items(nodes):
        if n.state == "risk.flat":
            yield local_name(_text(_scalar(n.kids["type"][0]))), n, "risk.flat"
        elif n.state in ("risk.holder", "wrapper"):
            for label, children in n.kids.items():
                if label.endswith("RiskAttribute"):
                    many = any(c.state == "list" for c in children)
                    for body in items(children):
                        yield label, body, "risk.keyed_list" if many else "risk.keyed"


def shred(raw_id: int, payload: str | None, base: dict[str, Any]) -> Iterator[dict[str, Any]]:
    """Typed rows of one payload; parents come before their children."""
    try:
        tree = classify(json.loads(payload or ""))
    except (ValueError, RecursionError):
        return

    def walk(node: Node, parent: str | None, path: str) -> Iterator[dict[str, Any]]:
        if node.state == "null":
            return
        if node.state in ("building", "part"):
            yield from holder(node, parent)
            return
        for label, children in node.kids.items():
            for k, child in enumerate(children):
                yield from walk(child, parent, f"{path}/{label}{k}")

    def holder(node: Node, parent: str | None) -> Iterator[dict[str, Any]]:
        own = _text(_scalar((node.kids.get("id") or node.kids.get("gml_id"))[0]))
        if not own:
            return
        at = next(items(node.kids.get("attributes")), None)
        get = lambda name: next(items(at.kids.get(name)), None) if at is not None else None
        storeys, height = _number(_scalar(get("storeysAboveGround"))), _number(_scalar(get("measuredHeight")))
        kind = "building" if parent is None else "part"
        yield base | {
            "raw_id": raw_id, "kind": kind, "variant": f"{kind}.{'attributed' if at is not None else 'bare'}", "node_key": own, "parent_key": parent, "building_gml_id": own,
            "measured_height_m": height, "storeys_above": None if storeys is None else int(storeys), "usage_code": _text(_scalar(get("usage"))),
        }
        risks = (r for label, place in node.kids.items() if label == "bldgDisasterRiskAttribute" for r in risk_bodies(place))
        for index, (name, body, variant) in enumerate(risks, 1):
            key = f"{own}#{index}"
            yield base | {"raw_id": raw_id, "kind": "risk", "variant": variant, "node_key": key, "parent_key": own, "building_gml_id": own, "risk_index": index} | values(name, body)
            for order, scenario in enumerate(items(body.kids.get("scenarios")), 1):
                yield base | {"raw_id": raw_id, "kind": "scenario", "variant": "scenario", "node_key": f"{key}.{order}", "parent_key": key, "building_gml_id": own, "risk_index": index, "scenario_index": order} | values(name, scenario)
        for part in items(node.kids.get("consistsOfBuildingPart")):
            yield from walk(part, own, own)

    yield from walk(tree, None, "")


def values(name: str, body: Node) -> dict[str, Any]:
    """Typed attributes shared by risks and scenarios."""
    code, ja = RISK_TYPES.get(name, (re.sub(r"RiskAttribute$", "", name).lower(), ""))
    out: dict[str, Any] = {"risk_type": code, "risk_attribute_type": name, "risk_type_ja": ja}
    for field in CODED:
        out[f"{COLUMN_OF[field]}_code"], out[f"{COLUMN_OF[field]}_codespace"] = _coded(body.kids.get(field))
    depth, uom = _measure(body.kids.get("depth"))
    hours, unit = _measure(body.kids.get("duration"))
    return out | {"depth_value": depth, "depth_uom": uom, "depth_m": _converted(depth, uom, METRES), "duration_value": hours, "duration_uom": unit, "duration_h": _converted(hours, unit, HOURS)}


def _shred_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows: list[dict[str, Any]] = []
        for r in pdf.itertuples(index=False):
            rows.extend(shred(r.raw_id, r.payload, {"received_at": r.received_at, "source_gml": r.source_gml, "city_code": r.city_code}))
            if len(rows) >= 20_000:
                yield _frame(rows)
                rows = []
        yield _frame(rows)


def _frame(rows: list[dict[str, Any]]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=NAMES)
    for c in ("raw_id", "risk_index", "scenario_index", "storeys_above"):
        out[c] = out[c].astype("Int64")
    for c in ("depth_value", "depth_m", "duration_value", "duration_h", "measured_height_m"):
        out[c] = out[c].astype("float64")
    return out


def route(building_raw: DataFrame) -> DataFrame:
    """All typed rows of all payloads, before routing; one pass over the input, no shuffle."""
    cols = ["raw_id", "payload", "received_at", "source_gml", "city_code"]
    return building_raw.select(*cols).mapInPandas(_shred_batches, ROUTED)


def subtype_tables(building_raw: DataFrame) -> dict[str, DataFrame]:
    """``buildings``, ``parts``, ``risks`` and ``scenarios``. A holder delivered several times counts once: the last delivery
    (received_at, then raw_id) is kept with everything below it, chosen by a map-side combined arg-max of its delivery stamp."""
    rows = cut(route(building_raw))  # parsed once; every subtype table reads the written rows
    holders = rows.filter(F.col("kind").isin("building", "part"))
    last = holders.groupBy("building_gml_id").agg(F.max(F.struct(F.coalesce("received_at", F.lit("1900-01-01").cast("timestamp")), "raw_id")).alias("s"))
    keep = last.select("building_gml_id", F.col("s.raw_id").alias("raw_id"))
    kept = rows.join(keep, ["building_gml_id", "raw_id"], "left_semi")
    base = ["node_key", "parent_key", "building_gml_id", "raw_id", "variant", "source_gml", "city_code"]
    risk = [c for c in (part.split()[0] for part in RISK_FIELDS.split(", "))]
    once = lambda kind, cols: best_row(kept.filter(F.col("kind") == kind).select(*cols), ["node_key"], [F.col("raw_id")])
    return {
        "buildings": once("building", [*base, "measured_height_m", "storeys_above", "usage_code"]),
        "parts": once("part", [*base, "measured_height_m", "storeys_above", "usage_code"]),
        "risks": once("risk", [*base, *risk]),
        "scenarios": once("scenario", [*base, "scenario_index", *risk]),
    }


def risk_scenarios(building_raw: DataFrame) -> DataFrame:
    """One row per scenario of each risk, or one with scenario_index 0 for a risk without; the rank code is the risk's own."""
    t = subtype_tables(building_raw)
    risks = t["risks"].select(F.col("node_key").alias("risk_key"), "building_gml_id", "risk_index", "risk_attribute_type", "rank_code")
    order = t["scenarios"].select(F.col("parent_key").alias("risk_key"), "scenario_index")
    return risks.join(order, "risk_key", "left").select("building_gml_id", "risk_index", F.coalesce("scenario_index", F.lit(0)).alias("scenario_index"), "risk_attribute_type", "rank_code")
