"""Outputs: a folder per layer as the native form, and small published files (CSV with BOM, documents, manifests, releases)."""

from __future__ import annotations

import csv
import hashlib
import json
import os
import shutil
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOM = "﻿"


def write_layers(folder: str, layers: dict[str, DataFrame], partition_by: Sequence[str] = (), mode: str = "overwrite") -> list[str]:
    """Write each non-empty layer as parquet; the municipality is a partition of the output, never a loop over it."""
    written = []
    for name, df in layers.items():
        if df.isEmpty():
            continue
        keys = [c for c in partition_by if c in df.columns]
        writer = df.repartition(*keys).write if keys else df.write
        (writer.partitionBy(*keys) if keys else writer).mode(mode).parquet(f"{folder}/{name}")
        written.append(name)
    return written


def write_published_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> int:
    """One CSV file with byte order mark and header, streamed through the driver row by row: for published tables of bounded size."""
    rows, n = (df.orderBy(*order) if order else df), 0
    temporary = f"{path}.part"
    with open(temporary, "w", encoding="utf-8", newline="") as f:
        f.write(BOM)
        w = csv.writer(f)
        w.writerow(df.columns)
        for r in rows.toLocalIterator():
            w.writerow(["" if v is None else v for v in r])
            n += 1
    os.replace(temporary, path)
    return n


def companion_documents(parents: DataFrame, children: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """(key, document): a parent with its ordered children as JSON text, non-ASCII kept."""
    rest = [c for c in children.columns if c != key]
    kids = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, F.struct(*rest).alias("_v")))).alias("_k")).select(key, F.transform("_k", lambda x: x["_v"]).alias(name))
    return parents.join(kids, key, "left").select(key, F.to_json(F.struct(*parents.columns, name)).alias("document"))


def file_digest(path: str) -> str:
    """SHA-256 of a file."""
    h = hashlib.sha256()
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            h.update(block)
    return h.hexdigest()


def release(folder: str, tables: dict[str, DataFrame], columns: dict[str, Sequence[str]]) -> dict:
    """Publish exactly the whitelisted tables and columns as CSV with checksums and a manifest; anything missing or surplus is an error."""
    if set(tables) != set(columns):
        raise ValueError(f"tables {sorted(tables)} are not the released set {sorted(columns)}")
    staging = Path(f"{folder}.staging")
    shutil.rmtree(staging, ignore_errors=True)
    staging.mkdir(parents=True)
    manifest = {}
    for name, wanted in columns.items():
        if missing := [c for c in wanted if c not in tables[name].columns]:
            raise ValueError(f"{name} lacks {missing}")
        n = write_published_csv(tables[name].select(*wanted), str(staging / f"{name}.csv"), wanted[:1])
        manifest[name] = {"rows": n, "sha256": file_digest(str(staging / f"{name}.csv"))}
    (staging / "manifest.json").write_text(json.dumps(manifest, ensure_ascii=False, indent=2), encoding="utf-8")
    shutil.rmtree(folder, ignore_errors=True)
    os.replace(staging, folder)
    return manifest
