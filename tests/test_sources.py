import json
import sqlite3
import struct

import pytest

from kuramori.sources import citymodel, files, gpkg, sinks
from kuramori.streaming.packages import ingest_available


def test_csv_encodings_and_order(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,名称\n001,寺\n002,\n".encode("cp932"))
    (tmp_path / "b.csv").write_bytes("﻿id,x\n003,NA\n".encode("utf-8"))
    (tmp_path / "c.csv").write_bytes(b"\xff\xfe\xfd\x80\x81")
    (tmp_path / "output").mkdir()
    (tmp_path / "output" / "d.csv").write_text("id\n9\n")
    paths = files.discover(str(tmp_path))
    assert len(paths) == 3
    df, issues = files.read_csv(spark, paths)
    assert [(r["id"], r["名称"], r["x"], r["src_ord"]) for r in df.orderBy("src_file", "src_ord").collect()] == [("001", "寺", None, 0), ("002", "", None, 1), ("003", None, "NA", 0)]
    assert issues.count() == 1


def test_json_layouts(spark, tmp_path):
    docs = {"list": [{"a": 1}], "keyed": {"results": [{"a": 2}]}, "deep": {"x": {"y": [{"a": 3}, {"a": 4}], "z": [{"b": 1}]}}, "single": {"a": 5}, "geo": {"type": "FeatureCollection", "features": [{"properties": {"a": 6}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}}
    for n, d in docs.items():
        (tmp_path / f"{n}.json").write_text(json.dumps(d))
    (tmp_path / "bad.json").write_text("{")
    rows = files.read_json(spark, [str(tmp_path)]).collect()
    assert sorted(json.loads(r.row)["a"] for r in rows if r.row) == [1, 2, 3, 4, 5, 6]
    assert [r.src_file for r in rows if r.row is None] == ["bad.json"]


def test_columns_and_config(tmp_path):
    got = files.resolve_columns(["Name ", "lat_x", "PL値"], {"name": ["name"], "lat": ["lat"], "pl": ["pl"]}, relaxed=True, tokens={"lat": ["lat"], "pl": ["PL"]})
    assert got == {"name": "Name ", "lat": "lat_x", "pl": "PL値"}
    assert files.resolve_columns(["a"], {"n": ["a"]}, {"n": "gone"}) == {"n": None}
    (tmp_path / "c.json").write_text('{"a": {"y": 3}}')
    assert files.load_config(str(tmp_path / "c.json"), {"a": {"x": 1, "y": 2}}) == {"a": {"x": 1, "y": 3}}
    assert files.city_packages(["/p/13901_heritage.gpkg"], "13") == {"13901": "/p/13901_heritage.gpkg"}
    with pytest.raises(ValueError):
        files.city_packages(["/p/13901_heritage.gpkg", "/q/13901_heritage.gpkg"])
    with pytest.raises(ValueError):
        files.city_packages([], codes=["13902"])


CITY = """<?xml version="1.0"?><core:CityModel xmlns:core="c" xmlns:bldg="b" xmlns:gml="g"><core:cityObjectMember><bldg:Building gml:id="b1"><gml:name>館</gml:name><bldg:usage codeSpace="x/u.xml">411</bldg:usage><bldg:measuredHeight uom="m">9.5</bldg:measuredHeight><bldg:storeysAboveGround>2</bldg:storeysAboveGround><bldg:lod0FootPrint><gml:posList>35.0 139.0 0 35.0 139.1 0 35.1 139.1 0 35.0 139.0 0</gml:posList></bldg:lod0FootPrint></bldg:Building></core:cityObjectMember><core:cityObjectMember><bldg:Building gml:id="b1"><bldg:measuredHeight>7</bldg:measuredHeight></bldg:Building></core:cityObjectMember><core:cityObjectMember><bldg:Building><gml:name>no id</gml:name></bldg:Building></core:cityObjectMember></core:CityModel>"""


def test_city_model(spark, tmp_path):
    path = tmp_path / "m.gml"
    path.write_text(CITY)
    df = citymodel.read_buildings(spark, [str(path)])
    r = df.collect()
    assert [(x.gml_id, x.measured_height_m, x.src_ord) for x in r] == [("b1", 7.0, 0)]
    row = citymodel.building_row(next(citymodel._members(CITY)))
    assert (row[0], row[1], row[3], row[6]) == ("b1", "館", "411", 2) and row[11][0][0] == {"x": 139.0, "y": 35.0}
    out = tmp_path / "s.gml"
    assert citymodel.write_subset(df, df, str(out)) == 1 and 'id="b1"' in out.read_text()


def test_codelists(spark, tmp_path):
    (tmp_path / "r.xml").write_text('<gml:Dictionary xmlns:gml="g"><gml:dictionaryEntry><gml:Definition gml:id="i"><gml:description>浅い</gml:description><gml:name>1</gml:name></gml:Definition></gml:dictionaryEntry></gml:Dictionary>')
    (tmp_path / "bad.xml").write_text("<x>")
    assert [tuple(r) for r in citymodel.read_codelists(spark, [str(tmp_path)]).collect()] == [("r.xml", "1", "浅い")]


def test_package_round_trip(spark, tmp_path):
    path = str(tmp_path / "p.gpkg")
    df = spark.createDataFrame([(1, "寺", 0.5), (2, None, None)], "id long, name string, depth double")
    assert gpkg.export_tables(path, {"t": df, "empty": df.limit(0)}) == ["t"]
    db = sqlite3.connect(path)
    db.execute("create table gpkg_geometry_columns (table_name text, column_name text)")
    db.execute("insert into gpkg_geometry_columns values ('pts', 'geom')")
    db.execute("create table pts (fid integer primary key, geom blob, code text)")
    blob = b"GP\x00\x01" + struct.pack("<i", 4326) + b"\x01" + struct.pack("<I2d", 1, 139.5, 35.5)
    db.executemany("insert into pts values (?,?,?)", [(1, blob, "a"), (2, None, "b")])
    db.commit()
    db.close()
    gpkg.register(spark)
    read = lambda layer: spark.read.format("gpkg").option("path", path).option("layer", layer).load()
    assert sorted((r.id, r.name, r.depth) for r in read("t").collect()) == [(1, "寺", 0.5), (2, None, None)]
    assert [r.id for r in read("t").filter("id > 1").collect()] == [2]
    assert [(r.code, r.xmin, r.ymax) for r in read("pts").orderBy("fid").collect()] == [("a", 139.5, 35.5), ("b", None, None)]
    assert gpkg.layers(path, spatial=True) == ["pts"] and gpkg.resolve_layer(["a_x_1"], ["b"], ["x"]) == "a_x_1"
    assert read("*contents").count() == 1


def test_sinks_and_release(spark, tmp_path):
    df = spark.createDataFrame([(1, "寺", "s"), (2, None, "t")], "id long, name string, secret string")
    path = str(tmp_path / "o.csv")
    assert sinks.write_published_csv(df, path, ["id"]) == 2
    assert open(path, "rb").read().startswith(b"\xef\xbb\xbfid,name")
    m = sinks.release(str(tmp_path / "rel"), {"t": df}, {"t": ["id", "name"]})
    assert m["t"]["rows"] == 2 and "secret" not in open(tmp_path / "rel" / "t.csv").read()
    with pytest.raises(ValueError):
        sinks.release(str(tmp_path / "rel"), {"t": df}, {"t": ["gone"]})
    kids = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "id long, o int, v string")
    doc = sinks.companion_documents(df.select("id", "name"), kids, "id", ["o"], "kids").filter("id = 1").first().document
    assert json.loads(doc) == {"id": 1, "name": "寺", "kids": [{"o": 1, "v": "a"}, {"o": 2, "v": "b"}]}
    assert sinks.write_layers(str(tmp_path / "l"), {"a": df, "none": df.limit(0)}, ["id"]) == ["a"]


def test_stream_of_folders(spark, tmp_path):
    schema = "k long, v string"
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], schema).write.parquet(str(tmp_path / "in/one"))
    run = lambda: ingest_available(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, str(tmp_path / "out"), str(tmp_path / "cp"), ["k"]).awaitTermination()
    run()
    spark.createDataFrame([(2, "b"), (3, "c")], schema).write.parquet(str(tmp_path / "in/two"))
    run()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]
