"""City-model XML: buildings with their attributes and code lists, read member by member.

Spark's XML source splits files by the member tag, so a large file is parsed in parallel; the member's own structure is read by one
Arrow-batched function, whose namespaces are ignored."""

from __future__ import annotations

import os
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kuramori.functions.geometry import LAT_RANGE, LON_RANGE

MEMBER = "cityObjectMember"
BUILDING = (
    "src_file string, src_ord long, gml_id string, name string, address string, usage_code string, usage_codespace string, measured_height_m double, "
    "storeys_above int, storeys_below int, year_of_construction int, building_id string, city_code string, rings array<array<struct<x:double,y:double>>>, risks string, member string"
)


def local(tag: str) -> str:
    """Name without namespace."""
    return tag.rsplit("}", 1)[-1].rsplit(":", 1)[-1]


def _members(text: str) -> Iterator[str]:
    for m in re.finditer(rf"<(?:[\w.-]+:)?{MEMBER}\b.*?</(?:[\w.-]+:)?{MEMBER}\s*>", text, re.S):
        yield m.group()


def parse_member(member: str, namespaces: str = "") -> ET.Element | None:
    """Element tree of one member; undeclared prefixes are dropped."""
    bare = re.sub(r"(</?)([\w.-]+):", r"\1", member)
    bare = re.sub(r"\s(?:xmlns(?::[\w.-]+)?)=\"[^\"]*\"", "", bare)
    bare = re.sub(r"\s[\w.-]+:([\w.-]+)=", r" \1=", bare)
    try:
        return ET.fromstring(bare)
    except ET.ParseError:
        return None


def ring_of(pos_list: str, dimension: int | None = None) -> list[tuple[float, float]]:
    """Points of a coordinate list: two or three numbers each; latitude and longitude are told apart by their ranges."""
    values = [float(v) for v in (pos_list or "").split()]
    if dimension not in (2, 3):
        dimension = 3 if len(values) % 3 == 0 and (len(values) % 2 or _looks_3d(values)) else 2
    pts = [(values[i], values[i + 1]) for i in range(0, len(values) - dimension + 1, dimension)]
    swap = pts and LAT_RANGE[0] <= pts[0][0] <= LAT_RANGE[1] and LON_RANGE[0] <= pts[0][1] <= LON_RANGE[1]
    return [(b, a) for a, b in pts] if swap else pts


def _looks_3d(values: list[float]) -> bool:
    second = values[3:5]
    return len(second) == 2 and abs(values[0] - second[0]) < 1 and abs(values[1] - second[1]) < 1


def building_row(member: str) -> tuple | None:
    """Attributes of a member's building; None without an id."""
    root = parse_member(member)
    b = next((e for e in (root.iter() if root is not None else ()) if local(e.tag) == "Building"), None)
    own = b.get("id") if b is not None else None
    if not own:
        return None
    leaf = lambda n: next((e for e in b.iter() if local(e.tag) == n), None)
    text = lambda n: ((leaf(n).text or "").strip() if leaf(n) is not None else "")
    whole = lambda n: int(float(text(n))) if re.fullmatch(r"-?\d+(?:\.\d+)?", text(n)) else None
    height = float(text("measuredHeight")) if re.fullmatch(r"-?\d+(?:\.\d+)?", text("measuredHeight")) else None
    prefer = [e for e in b.iter() if local(e.tag) in ("lod0FootPrint", "lod0RoofEdge")] or [b]
    lists = [e for p in prefer for e in p.iter() if local(e.tag) == "posList"]
    rings = [[{"x": x, "y": y} for x, y in ring_of(e.text or "", int(e.get("srsDimension") or 0) or None)] for e in lists]
    address = "".join(dict.fromkeys(t.strip() for e in b.iter() if local(e.tag) in ("LocalityName", "Thoroughfare", "ThoroughfareNumber") for t in e.itertext() if t.strip()))
    usage = leaf("usage")
    risks = ";".join(local(e.tag) for e in b.iter() if local(e.tag).endswith("RiskAttribute") and local(e.tag) != "bldgDisasterRiskAttribute")
    return own, text("name"), address, text("usage"), (usage.get("codeSpace") or "") if usage is not None else "", height, whole("storeysAboveGround"), whole("storeysBelowGround"), whole("yearOfConstruction"), text("buildingID"), text("city"), rings, risks, member


def read_buildings(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per building; of a repeated id the last one counts, in the place of the first."""

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.strip().split()[0] for f in re.split(r",(?![^<]*>)", BUILDING)]
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                text, rows = bytes(content).decode("utf-8-sig", errors="replace"), []
                for n, member in enumerate(_members(text)):
                    if r := building_row(member):
                        rows.append((os.path.basename(path), n, *r))
                out = pd.DataFrame(rows, columns=names)
                for c in ("storeys_above", "storeys_below", "year_of_construction"):
                    out[c] = out[c].astype("Int64")
                yield out

    rows = spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(load, BUILDING)
    w = Window.partitionBy("gml_id")
    last = F.row_number().over(w.orderBy(F.desc("src_file"), F.desc("src_ord")))
    return rows.withColumn("_first", F.min(F.struct("src_file", "src_ord")).over(w)).withColumn("_last", last).filter("_last = 1").withColumn("src_ord", F.col("_first.src_ord")).drop("_first", "_last")


def read_members(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Members of huge files through Spark's own XML splitting, with a caller's schema of the parts wanted."""
    return spark.read.format("xml").option("rowTag", MEMBER).option("ignoreNamespace", "true").schema(schema).load(path)


def parse_codelist(content: str) -> list[tuple[str, str]]:
    """(code, label) of a dictionary (definition names and descriptions) or of plain code and label elements; [] if unreadable."""
    bare = re.sub(r"(</?)([\w.-]+):", r"\1", re.sub(r"\sxmlns(?::[\w.-]+)?=\"[^\"]*\"", "", content))
    bare = re.sub(r"\s[\w.-]+:([\w.-]+)=", r" \1=", bare)
    try:
        root = ET.fromstring(re.sub(r"^\s*<\?xml[^>]*\?>", "", bare))
    except ET.ParseError:
        return []
    out = []
    for e in root.iter():
        kids = {local(k.tag).lower(): (k.text or "").strip() for k in e}
        code, label = kids.get("name") or kids.get("code"), kids.get("description") or kids.get("label") or kids.get("value")
        if code and label:
            out.append((code, label))
    return out


def read_codelists(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, code, label) of code list files."""

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(os.path.basename(p), c, v) for p, content in zip(pdf["path"], pdf["content"]) for c, v in parse_codelist(bytes(content).decode("utf-8-sig", errors="replace"))]
            yield pd.DataFrame(rows, columns=["file", "code", "label"])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(load, "file string, code string, label string")


def write_subset(buildings: DataFrame, keep: DataFrame, path: str) -> int:
    """Write the members of the kept buildings once each into a new city model; nothing stays behind if writing fails."""
    members = buildings.join(keep.select("gml_id").distinct(), "gml_id", "left_semi").orderBy("src_file", "src_ord").select("member")
    temporary, n = f"{path}.part", 0
    try:
        with open(temporary, "w", encoding="utf-8") as f:
            f.write('<?xml version="1.0" encoding="UTF-8"?>\n<CityModel>\n')
            for r in members.toLocalIterator():
                f.write(r["member"] + "\n")
                n += 1
            f.write("</CityModel>\n")
        os.replace(temporary, path)
    except BaseException:
        if os.path.exists(temporary):
            os.remove(temporary)
        raise
    return n
