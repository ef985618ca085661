"""Geographic packages (SQLite) as a Spark data source, and their export, with the standard library alone.

``spark.read.format("gpkg").option("path", p).option("layer", name)``: attribute tables and feature layers; a geometry column becomes well-known
binary plus its bounding box. A layer is read in row ranges, one per partition; an equality or range filter on a plain column is
pushed into SQLite. ``layer`` = ``*contents`` reads the catalogue."""

from __future__ import annotations

import os
import sqlite3
import struct
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

CONTENTS = "*contents"
SYSTEM = ("gpkg_", "rtree_", "sqlite_", "idx_", "trigger_")
ROWS_PER_PARTITION = 200_000
OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def connect(path: str) -> sqlite3.Connection:
    """Read-only connection."""
    return sqlite3.connect(f"file:{os.path.abspath(path)}?mode=ro", uri=True)


def quoted(name: str) -> str:
    """SQLite identifier."""
    return '"' + name.replace('"', '""') + '"'


def layers(path: str, spatial: bool | None = None) -> list[str]:
    """Tables of a package without the system ones; only feature layers or only attribute tables on request."""
    with connect(path) as db:
        names = [r[0] for r in db.execute("select name from sqlite_master where type in ('table','view') order by name")]
        shapes = {r[0] for r in db.execute("select table_name from gpkg_geometry_columns")} if "gpkg_geometry_columns" in names else set()
    own = [n for n in names if not n.startswith(SYSTEM)]
    return own if spatial is None else [n for n in own if (n in shapes) == spatial]


def resolve_layer(names: Sequence[str], candidates: Sequence[str], tokens: Sequence[str] = ()) -> str | None:
    """First candidate present, else the first name that contains all tokens."""
    return next((c for c in candidates if c in names), None) or next((n for n in names if tokens and all(t in n for t in tokens)), None)


def split_geometry(blob: bytes | None) -> tuple[bytes | None, float | None, float | None, float | None, float | None]:
    """(wkb, xmin, ymin, xmax, ymax) of a package geometry; nulls for null, foreign or empty ones. A point without envelope is its own."""
    if not blob or blob[:2] != b"GP" or blob[3] & 0b10000:
        return None, None, None, None, None
    order = "<" if blob[3] & 1 else ">"
    size = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}.get((blob[3] >> 1) & 7, 0)
    wkb = bytes(blob[8 + size :])
    if size:
        x0, x1, y0, y1 = struct.unpack(order + "4d", blob[8:40])
        return wkb, x0, y0, x1, y1
    o = "<" if wkb[0] else ">"
    if struct.unpack(o + "I", wkb[1:5])[0] % 1000 == 1:
        x, y = struct.unpack(o + "2d", wkb[5:21])
        return wkb, x, y, x, y
    return wkb, None, None, None, None


class Range(InputPartition):
    """Row ids of one partition."""

    def __init__(self, low: int, high: int) -> None:
        self.low, self.high = low, high


class PackageReader(DataSourceReader):
    """Reads a layer in row ranges."""

    def __init__(self, path: str, layer: str, schema: StructType, geometry: str | None) -> None:
        self.path, self.layer, self.schema, self.geometry, self.where = path, layer, schema, geometry, []

    def pushFilters(self, filters):  # noqa: N802
        """Plain comparisons go to SQLite; the rest stays with Spark."""
        for f in filters:
            op = OPERATORS.get(type(f))
            if op and len(f.attribute) == 1 and f.attribute[0] not in ("wkb", "xmin", "ymin", "xmax", "ymax") and self.layer != CONTENTS:
                self.where.append((f.attribute[0], op, f.value))
            else:
                yield f

    def partitions(self):
        """Ranges of row ids."""
        if self.layer == CONTENTS:
            return [Range(0, 0)]
        with connect(self.path) as db:
            low, high = db.execute(f"select coalesce(min(rowid),0), coalesce(max(rowid),0) from {quoted(self.layer)}").fetchone()
        return [Range(a, min(high, a + ROWS_PER_PARTITION - 1)) for a in range(low, high + 1, ROWS_PER_PARTITION)]

    def read(self, partition: Range) -> Iterator[tuple]:
        """Rows of a range."""
        with connect(self.path) as db:
            if self.layer == CONTENTS:
                yield from db.execute("select table_name, data_type, min_x, min_y, max_x, max_y, srs_id from gpkg_contents")
                return
            plain = [f.name for f in self.schema.fields if f.name not in ("wkb", "xmin", "ymin", "xmax", "ymax")]
            columns = ", ".join(quoted(c) for c in [*plain, *([self.geometry] if self.geometry else [])])
            extra = "".join(f" and {quoted(c)} {op} ?" for c, op, _ in self.where)
            sql = f"select {columns} from {quoted(self.layer)} where rowid between ? and ?{extra} order by rowid"
            for row in db.execute(sql, [partition.low, partition.high, *(v for _, _, v in self.where)]):
                yield (*row[:-1], *split_geometry(row[-1])) if self.geometry else row


class PackageSource(DataSource):
    """The data source; see ``register``."""

    @classmethod
    def name(cls) -> str:
        """Short name."""
        return "gpkg"

    def _geometry(self) -> str | None:
        with connect(self.options["path"]) as db:
            known = db.execute("select 1 from sqlite_master where name = 'gpkg_geometry_columns'").fetchone()
            row = known and db.execute("select column_name from gpkg_geometry_columns where table_name = ?", [self.options["layer"]]).fetchone()
        return row[0] if row else None

    def schema(self) -> StructType:
        """Columns of the layer."""
        if self.options["layer"] == CONTENTS:
            text, number = StringType(), DoubleType()
            return StructType([StructField("table_name", text), StructField("data_type", text), *(StructField(c, number) for c in ("min_x", "min_y", "max_x", "max_y")), StructField("srs_id", LongType())])
        geometry, out = self._geometry(), []
        with connect(self.options["path"]) as db:
            for _, name, kind, *_ in db.execute(f"pragma table_info({quoted(self.options['layer'])})"):
                if name != geometry:
                    k = (kind or "").upper()
                    out.append(StructField(name, LongType() if "INT" in k or "BOOL" in k else DoubleType() if any(t in k for t in ("REAL", "DOUB", "FLOA")) else BinaryType() if "BLOB" in k else StringType()))
        if geometry:
            out += [StructField("wkb", BinaryType()), *(StructField(c, DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax"))]
        return StructType(out)

    def reader(self, schema: StructType) -> PackageReader:
        """Reader of the layer."""
        layer = self.options["layer"]
        return PackageReader(self.options["path"], layer, schema, None if layer == CONTENTS else self._geometry())


def register(spark: SparkSession) -> None:
    """Make the format known to a session and let filters reach SQLite."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PackageSource)


def export_tables(path: str, tables: dict[str, DataFrame], max_rows: int = 5_000_000) -> list[str]:
    """Write small result tables into a new package as attribute tables and register them; empty tables are left out, and nothing is
    written if all are empty. Written beside the target, checked, then moved over it."""
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "boolean": "INTEGER", "double": "REAL", "float": "REAL", "binary": "BLOB"}
    temporary, written = f"{path}.part", []
    if os.path.exists(temporary):
        os.remove(temporary)
    db = sqlite3.connect(temporary)
    try:
        db.execute("create table gpkg_contents (table_name text primary key, data_type text, identifier text, min_x double, min_y double, max_x double, max_y double, srs_id integer)")
        for name, df in tables.items():
            db.execute(f"create table {quoted(name)} (" + ", ".join(f"{quoted(c)} {kinds.get(t, 'TEXT')}" for c, t in df.dtypes) + ")")
            n = 0
            for r in df.limit(max_rows + 1).toLocalIterator():
                n += 1
                if n > max_rows:
                    raise ValueError(f"{name} is too large for a package; write it as a folder of parquet files")
                db.execute(f"insert into {quoted(name)} values ({','.join('?' * len(df.columns))})", [v if isinstance(v, (int, float, str, bytes, type(None))) else str(v) for v in r])
            if n:
                db.execute("insert into gpkg_contents (table_name, data_type, identifier) values (?, 'attributes', ?)", [name, name])
                written.append(name)
            else:
                db.execute(f"drop table {quoted(name)}")
        db.commit()
        if db.execute("pragma integrity_check").fetchone()[0] != "ok":
            raise ValueError("the written package is damaged")
    except BaseException:
        db.close()
        os.remove(temporary)
        raise
    db.close()
    if written:
        os.replace(temporary, path)
    else:
        os.remove(temporary)
    return written
