"""Reading values out of HTML pages, JSON documents and XML members, and digests of XML that ignore what doesn't matter."""

from __future__ import annotations

import hashlib
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kuramori.sources.citymodel import local, parse_member

PAIRS = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("value", T.StringType())]))


class _Pairs(HTMLParser):
    """Collects dt/dd and th/td pairs and links."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pairs: list[tuple[str, str]] = []
        self.links: list[tuple[str, str]] = []
        self.label, self.text, self.inside, self.href = "", [], "", None

    def handle_starttag(self, tag, attrs):
        if tag in ("dt", "dd", "th", "td"):
            self._close()
            self.inside, self.text = tag, []
        elif tag in ("br", "p", "li") and self.inside:
            self.text.append(" ")
        elif tag == "a":
            self.href = dict(attrs).get("href")
            self.links.append((self.href or "", ""))

    def handle_endtag(self, tag):
        if tag == self.inside or tag in ("tr", "dl", "table"):
            self._close()
        elif tag == "a":
            self.href = None

    def handle_data(self, data):
        if self.inside:
            self.text.append(data)
        if self.href is not None and self.links:
            self.links[-1] = (self.links[-1][0], self.links[-1][1] + data)

    def _close(self):
        value = re.sub(r"\s+", " ", "".join(self.text)).strip()
        if self.inside in ("dt", "th"):
            self.label = value
        elif self.inside in ("dd", "td") and self.label:
            self.pairs.append((self.label, value))
        self.inside, self.text = "", []


def html_pairs(page: str | None) -> list[tuple[str, str]]:
    """(label, value) of definition lists and tables of a page."""
    p = _Pairs()
    p.feed(page or "")
    p._close()
    return p.pairs


def html_links(page: str | None) -> list[tuple[str, str]]:
    """(target, text) of a page's links."""
    p = _Pairs()
    p.feed(page or "")
    return [(h, re.sub(r"\s+", " ", t).strip()) for h, t in p.links if h]


@F.pandas_udf(PAIRS)
def labelled_values(pages: pd.Series) -> pd.Series:
    """Vectorised ``html_pairs``."""
    return pages.map(lambda p: [{"label": a, "value": b} for a, b in html_pairs(p)])


def walk_json(value: object) -> Iterator[dict]:
    """All objects of a document, outer ones first."""
    if isinstance(value, dict):
        yield value
    for v in value.values() if isinstance(value, dict) else value if isinstance(value, list) else ():
        yield from walk_json(v)


def structured_address(document: str | None) -> str:
    """Postal address of linked data in a page: text, or its parts joined in order."""
    try:
        doc = json.loads(document or "")
    except ValueError:
        return ""
    for o in walk_json(doc):
        a = o.get("address")
        if isinstance(a, str) and a.strip():
            return a.strip()
        if isinstance(a, dict):
            parts = [str(a.get(k) or "").strip() for k in ("postalCode", "addressRegion", "addressLocality", "streetAddress")]
            if any(parts):
                return "".join(p for p in parts if p)
    return ""


def geocoded(document: str | None) -> tuple[float | None, float | None, float | None, str]:
    """(lon, lat, score, level) of a geocoder's answer in any of its three layouts: a list of results, GeoJSON features, one flat object."""
    try:
        doc = json.loads(document or "")
    except ValueError:
        return None, None, None, ""
    first = doc[0] if isinstance(doc, list) and doc else doc
    if isinstance(first, dict) and isinstance(first.get("result"), dict):
        first = first["result"]
    if isinstance(first, dict) and first.get("features"):
        f = first["features"][0]
        first = {**(f.get("properties") or {}), "coordinates": (f.get("geometry") or {}).get("coordinates")}
    if not isinstance(first, dict):
        return None, None, None, ""
    xy = first.get("coordinates") or [first.get("lon") or first.get("longitude"), first.get("lat") or first.get("latitude")]
    number = lambda v: float(v) if isinstance(v, (int, float)) or isinstance(v, str) and re.fullmatch(r"-?\d+(?:\.\d+)?", v) else None
    return number(xy[0]), number(xy[1]), number(first.get("score")), str(first.get("match_level") or first.get("level") or "")


def _facts(e: ET.Element, path: str, names_only: bool, skip: tuple[str, ...], ordered: bool) -> Iterator[str]:
    name = local(e.tag) if names_only else e.tag
    if local(e.tag) in skip:
        return
    here = f"{path}/{name}"
    attributes = ",".join(f"{local(k) if names_only else k}={v}" for k, v in sorted(e.attrib.items()))
    yield f"{here}[{attributes}]{(e.text or '').strip()}"
    for i, kid in enumerate(e):
        yield from _facts(kid, f"{here}#{i}" if ordered else here, names_only, skip, ordered)


def member_digests(member: str, metadata: tuple[str, ...] = ()) -> dict[str, str]:
    """Digests of a member, each ignoring more than the one before: nothing, some metadata elements, also namespaces, also the order of siblings."""
    root = parse_member(member)
    raw = re.sub(r">\s+<", "><", member.strip())
    out = {"digest": hashlib.sha256(raw.encode()).hexdigest()}
    bare = re.sub("|".join(rf"<(?:[\w.-]+:)?{m}\b[^>]*?(?:/>|>.*?</(?:[\w.-]+:)?{m}\s*>)" for m in metadata) or r"(?!)", "", raw, flags=re.S)
    out["metadata_digest"] = hashlib.sha256(bare.encode()).hexdigest()
    facts = list(_facts(root, "", True, metadata, True)) if root is not None else [bare]
    out["name_digest"] = hashlib.sha256("\n".join(facts).encode()).hexdigest()
    loose = sorted(_facts(root, "", True, metadata, False)) if root is not None else [bare]
    out["multiset_digest"] = hashlib.sha256("\n".join(loose).encode()).hexdigest()
    out["metadata_count"] = str(len(re.findall("|".join(rf"<(?:[\w.-]+:)?{m}\b" for m in metadata), raw)) if metadata else 0)
    return out
