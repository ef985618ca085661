"""File discovery and text tables: CSV with encoding fallback, JSON tables in several layouts, GeoJSON, JSON lines, configuration.

Files are found and tried on the driver (a listing, and the first bytes of each); the rows are read by Spark. Every row carries
``src_file`` and ``src_ord``, so that first, last and keep-order semantics never depend on partitioning."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Record file patterns, folders never searched, encodings in the order they are tried, places of a row list in JSON.
RECORD_PATTERNS = ("*.csv", "*.CSV", "*.json", "*.JSON", "*.geojson", "*.GeoJSON")
SKIPPED_FOLDERS = (".cache", "output")
ENCODINGS = ("utf-8-sig", "utf-8", "cp932", "shift_jis")
ROW_KEYS = ("data", "results", "records", "items")
ISSUES = "src_file string, issue string"


def discover(folder: str, patterns: Sequence[str] = RECORD_PATTERNS, recursive: bool = True) -> list[str]:
    """Sorted files of a folder, each real path once; hidden caches and outputs are left out."""
    root, found = Path(folder), {}
    for pattern in patterns:
        for p in sorted(root.rglob(pattern) if recursive else root.glob(pattern)):
            parts = p.relative_to(root).parts[:-1]
            if not any(x in SKIPPED_FOLDERS or x.startswith("heritage_") for x in parts):
                found.setdefault(os.path.realpath(p), str(p))
    return sorted(found.values())


def city_packages(paths: Iterable[str], prefix: str = "", codes: Iterable[str] = ()) -> dict[str, str]:
    """{code: path} of ``NNNNN_*.gpkg`` packages; a code found twice or a requested one not found is an error."""
    wanted, out = set(codes), {}
    for p in sorted(paths):
        m = re.match(r"(\d{5})_[A-Za-z]+\.gpkg$", os.path.basename(p))
        if m and m.group(1).startswith(prefix) and (not wanted or m.group(1) in wanted):
            if m.group(1) in out:
                raise ValueError(f"two packages for {m.group(1)}: {out[m.group(1)]}, {p}")
            out[m.group(1)] = p
    if missing := wanted - set(out):
        raise ValueError(f"no package for {sorted(missing)}")
    return out


def encoding_of(path: str, encodings: Sequence[str] = ENCODINGS) -> str | None:
    """First encoding that decodes the whole file."""
    data = Path(path).read_bytes()
    for e in encodings:
        try:
            data.decode(e)
            return e
        except UnicodeDecodeError:
            continue
    return None


def read_csv(spark: SparkSession, paths: Sequence[str], encodings: Sequence[str] = ENCODINGS) -> tuple[DataFrame | None, DataFrame]:
    """(rows, issues): all-text rows of CSV files of mixed encodings, united by name; blanks stay blank, nothing is parsed as null.

    Files that can't be decoded become issue rows instead of failing the run. Decoding runs on the executors, one file per task."""
    plans = [(p, encoding_of(p, encodings)) for p in paths]
    issues = spark.createDataFrame([(p, "unreadable encoding") for p, e in plans if e is None], ISSUES)
    readable = [(p, e) for p, e in plans if e]
    if not readable:
        return None, issues
    heads = {p: list(pd.read_csv(p, encoding=e, nrows=0, dtype=str).columns) for p, e in readable}
    columns = list(dict.fromkeys(c for p, _ in readable for c in heads[p]))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns] + [T.StructField("src_file", T.StringType()), T.StructField("src_ord", T.LongType())])

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, encoding in zip(pdf["path"], pdf["encoding"]):
                at = 0
                for part in pd.read_csv(path, encoding=encoding, dtype=str, keep_default_na=False, na_filter=False, chunksize=50_000):
                    part = part.reindex(columns=columns).astype(object)
                    part = part.where(part.notna(), None)
                    part["src_file"], part["src_ord"] = os.path.basename(path), range(at, at + len(part))
                    at += len(part)
                    yield part

    files = spark.createDataFrame(readable, "path string, encoding string").repartition(len(readable))
    return files.mapInPandas(load, schema), issues


def records_in(value: object) -> list[dict]:
    """Rows of a JSON document: a list of objects, the list under a known key, else the largest nested list of objects, else the object."""
    if isinstance(value, list):
        own = [v for v in value if isinstance(v, dict)]
        return own or max((records_in(v) for v in value), key=len, default=[])
    if isinstance(value, dict):
        for k in ROW_KEYS:
            if isinstance(value.get(k), list) and any(isinstance(v, dict) for v in value[k]):
                return [v for v in value[k] if isinstance(v, dict)]
        nested = [records_in(v) for v in value.values() if isinstance(v, (list, dict))]
        best = max((n for n in nested if len(n) > 1), key=len, default=[])
        return best or [value]
    return []


def read_json(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(src_file, src_ord, row): rows of JSON documents of any of these layouts as compact JSON text, GeoJSON features included with
    ``__geometry__`` and ``__feature_index__``. Unreadable files give one row with a null ``row``."""

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                name = os.path.basename(path)
                try:
                    doc = json.loads(bytes(content).decode("utf-8-sig"))
                except (ValueError, UnicodeDecodeError):
                    out.append((name, 0, None))
                    continue
                if isinstance(doc, dict) and doc.get("type") == "FeatureCollection":
                    rows = [{**(f.get("properties") or {}), "__geometry__": f.get("geometry"), "__feature_index__": i} for i, f in enumerate(doc.get("features") or [])]
                else:
                    rows = records_in(doc)
                out += [(name, i, json.dumps(r, ensure_ascii=False, separators=(",", ":"))) for i, r in enumerate(rows)]
            yield pd.DataFrame(out, columns=["src_file", "src_ord", "row"])

    return spark.read.format("binaryFile").load(list(paths)).select("path", "content").mapInPandas(load, "src_file string, src_ord long, row string")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; broken lines are kept in ``_corrupt_record`` when a schema names it."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def resolve_columns(columns: Sequence[str], aliases: dict[str, Sequence[str]], explicit: dict[str, str] | None = None, relaxed: bool = False, tokens: dict[str, Sequence[str]] | None = None) -> dict[str, str | None]:
    """Canonical name to physical column: an explicit setting wins even where the column is absent (then None), else the first alias
    present, else (``relaxed``) one equal without case, space and underscore, else the first column containing all given tokens."""
    key = lambda s: re.sub(r"[\s_　]+", "", s).lower()
    loose = {key(c): c for c in reversed(columns)}
    out: dict[str, str | None] = {}
    for name, options in aliases.items():
        if explicit and name in explicit:
            out[name] = explicit[name] if explicit[name] in columns else None
            continue
        hit = next((a for a in options if a in columns), None)
        if hit is None and relaxed:
            hit = next((loose[key(a)] for a in options if key(a) in loose), None)
        if hit is None and tokens and name in tokens:
            hit = next((c for c in columns if all(t in c for t in tokens[name])), None)
        out[name] = hit
    return out


def with_resolved(df: DataFrame, resolved: dict[str, str | None]) -> DataFrame:
    """Canonical projection; missing columns are empty text."""
    return df.select(*[(F.col(f"`{c}`") if c else F.lit("")).alias(n) for n, c in resolved.items()])


def deep_merged(base: dict, over: dict) -> dict:
    """Configuration with recursive override of nested settings."""
    return base | {k: deep_merged(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}


def load_config(path: str, defaults: dict) -> dict:
    """Defaults overridden by a JSON file (or YAML where a parser is installed)."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yml", ".yaml")):
        try:
            import yaml
        except ImportError as e:
            raise ValueError("no YAML parser here; use JSON") from e
        return deep_merged(defaults, yaml.safe_load(text) or {})
    return deep_merged(defaults, json.loads(text))


def city_model_files(folder: str, code: str = "") -> list[str]:
    """City-model files whose name speaks of buildings; with a code only those in a folder or file of that municipality."""
    found = [str(p) for p in sorted(Path(folder).rglob("*.gml")) if re.search(r"bldg|building", p.name, re.I)]
    return [p for p in found if not code or re.search(rf"(?<!\d){code}(?!\d)", p)]
