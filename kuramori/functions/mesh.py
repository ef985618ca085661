"""Regional mesh codes: decoding to cells and, inversely, the cell of a point, so that a mesh join is an equi-join on the code.

A third-order cell is 30 by 45 seconds; the 50 m cell is a twentieth of it per axis (12 digits), the 250 m cell a quarter by two
quarterings (10 digits, 1 = SW, 2 = SE, 3 = NW, 4 = NE)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_code(c: Column) -> Column:
    """Digits of a code; ``.0`` is stripped first."""
    return F.regexp_replace(F.regexp_replace(F.trim(c.cast("string")), r"\.0$", ""), r"\D", "")


def _digits(c: Column, at: int, n: int) -> Column:
    return F.substring(c, at, n).cast("int")


def third_origin(c: Column) -> tuple[Column, Column]:
    """(lat, lon) of the south-west corner of the first eight digits."""
    lat = _digits(c, 1, 2) * F.lit(2.0) / 3.0 + _digits(c, 5, 1) * F.lit(5.0) / 60.0 + _digits(c, 7, 1) * F.lit(30.0) / 3600.0
    lon = F.lit(100.0) + _digits(c, 3, 2) + _digits(c, 6, 1) * F.lit(7.5) / 60.0 + _digits(c, 8, 1) * F.lit(45.0) / 3600.0
    return lat, lon


def cell_box(c: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax) of a 12-digit or 10-digit code; null for any other code."""
    lat, lon = third_origin(c)
    ilat, ilon = _digits(c, 9, 2), _digits(c, 11, 2)
    h, w = 30.0 / 3600.0, 45.0 / 3600.0
    box = lambda x, y, dx, dy: F.struct(x.alias("xmin"), y.alias("ymin"), (x + dx).alias("xmax"), (y + dy).alias("ymax"))
    fine = F.when(c.rlike(r"^\d{12}$") & (ilat <= 19) & (ilon <= 19), box(lon + ilon * (w / 20), lat + ilat * (h / 20), w / 20, h / 20))
    a, b = _digits(c, 9, 1), _digits(c, 10, 1)
    north, east = (lambda d: F.when(d >= 3, 1).otherwise(0)), (lambda d: F.when(d % 2 == 0, 1).otherwise(0))
    y = lat + north(a) * (h / 2) + north(b) * (h / 4)
    x = lon + east(a) * (w / 2) + east(b) * (w / 4)
    coarse = F.when(c.rlike(r"^\d{8}[1-4]{2}$"), box(x, y, w / 4, h / 4))
    return F.coalesce(fine, coarse)


def _third(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    """(row, column, first eight digits): rows and columns count third-order cells from latitude 0 and longitude 100."""
    row, col = F.floor(lat * 120).cast("int"), F.floor((lon - 100) * 80).cast("int")
    p, q = F.floor(row / 80).cast("int"), F.floor(col / 80).cast("int")
    r, s = F.floor((row % 80) / 10).cast("int"), F.floor((col % 80) / 10).cast("int")
    code = F.concat(F.lpad(p.cast("string"), 2, "0"), F.lpad(q.cast("string"), 2, "0"), r.cast("string"), s.cast("string"), (row % 10).cast("string"), (col % 10).cast("string"))
    return row, col, code


def code_of(lon: Column, lat: Column, digits: int = 12) -> Column:
    """Code of the cell a point lies in (south and west borders belong to it): 8, 10 or 12 digits."""
    row, col, code = _third(lon, lat)
    if digits == 8:
        return code
    fy, fx = lat * 120 - row, (lon - 100) * 80 - col
    if digits == 12:
        two = lambda f: F.lpad(F.least(F.lit(19), F.floor(f * 20).cast("int")).cast("string"), 2, "0")
        return F.concat(code, two(fy), two(fx))
    quarter = lambda n: (1 + F.floor(fx * n) % 2 + 2 * (F.floor(fy * n) % 2)).cast("int").cast("string")
    return F.concat(code, quarter(2), quarter(4))
