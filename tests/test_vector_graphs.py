"""Graphs as GraphML and in metres, and the attributes of Shapefiles."""

import math
import struct
import xml.etree.ElementTree as ET

import numpy as np
import pytest

from roadlens.functions import geo
from roadlens.operators import graphs
from roadlens.sources import vector_files

NS = "{http://graphml.graphdrawing.org/xmlns}"


def read(text):
    root = ET.fromstring(text.encode())
    names = {k.get("id"): (k.get("attr.name"), k.get("attr.type")) for k in root.iter(f"{NS}key")}
    data = lambda e: {names[d.get("key")][0]: d.text or "" for d in e.iter(f"{NS}data")}
    return names, {n.get("id"): data(n) for n in root.iter(f"{NS}node")}, [(e.get("source"), e.get("target"), data(e)) for e in root.iter(f"{NS}edge")]


def test_graphml_is_read_back(spark):
    odd = 'a & "b" <c>\n\t]]>\x01 ü'
    edges = spark.createDataFrame([("g", 2, 3, 1.5, odd), ("g", 1, 2, None, ""), ("g", 1, 2, None, ""), ("h", 9, 9, 0.25, None), ("h", None, 9, 1.0, "x")], "file string, src long, dst long, weight double, `the name` string")
    nodes = spark.createDataFrame([("g", 1, True), ("g", 7, None), ("g", None, True)], "file string, node long, end boolean")
    rows = {r["file"]: r["graphml"] for r in graphs.graphml(edges, "file", nodes).collect()}
    names, seen, lines = read(rows["g"])
    assert sorted(names.values()) == [("end", "boolean"), ("the name", "string"), ("weight", "double")]
    assert seen == {"1": {"end": "true"}, "2": {}, "3": {}, "7": {}}
    assert lines == [("1", "2", {"the name": ""})] * 2 + [("2", "3", {"weight": "1.5", "the name": odd.replace("\x01", "")})]
    assert read(rows["h"])[1:] == ({"9": {}}, [("9", "9", {"weight": "0.25"})])
    assert graphs.graphml(edges.limit(0), "file").count() == 0
    with pytest.raises(ValueError):
        graphs.graphml(edges.selectExpr("file", "src", "dst", "array(1) as a"), "file")


def test_centre_lines_in_metres(spark):
    """A degree of the equator and of a meridian; map coordinates of Mercator give the same metres."""
    lines = spark.createDataFrame([(k, [(0, 0), (1, 0), (1, 1)]) for k in "abcd"], "id string, points array<struct<x: int, y: int>>")
    t = "struct<a: double, b: double, c: double, d: double, e: double, f: double>"
    side = geo.RADIUS * math.radians(1)
    references = spark.createDataFrame(
        [("a", "EPSG:4326", (1.0, 0.0, -0.5, 0.0, -1.0, 0.5)), ("b", "EPSG:3857", (side, 0.0, -side / 2, 0.0, -side, side / 2)), ("c", "EPSG:32633", (1.0, 0.0, 0.0, 0.0, 1.0, 0.0))], f"id string, crs string, transform {t}"
    )
    got = {r["id"]: r["weight"] for r in graphs.skeleton_graph(lines, "id", references=references).collect()}
    e2 = geo.FLATTENING * (2 - geo.FLATTENING)
    at = np.linspace(0, math.radians(1), 10001)
    y = geo.RADIUS * (1 - e2) / (1 - e2 * np.sin(at) ** 2) ** 1.5
    want = side + float(((y[1:] + y[:-1]) / 2 * np.diff(at)).sum())
    assert got["a"] == pytest.approx(want, abs=1e-3) and (got["c"], got["d"]) == (None, None)
    assert got["b"] == pytest.approx(want, rel=1e-4)
    assert [r["weight"] for r in graphs.skeleton_graph(lines, "id").collect()] == [2.0] * 4


def shp(*lines):
    body = b""
    for k, points in enumerate(lines):
        shape = struct.pack("<i4d2ii", 3, 0, 0, 0, 0, 1, len(points), 0) + b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">2i", k + 1, len(shape) // 2) + shape
    return struct.pack(">i", 9994) + bytes(96) + body


def dbf(fields, records, deleted=()):
    head = 32 + 32 * len(fields) + 1
    width = 1 + sum(n for _, n in fields)
    out = struct.pack("<BBBBIHH", 3, 124, 1, 1, len(records), head, width) + bytes(20)
    out += b"".join(name.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([n]) + bytes(15) for name, n in fields) + b"\r"
    for k, r in enumerate(records):
        out += (b"*" if k in deleted else b" ") + b"".join(v.ljust(n)[:n] for v, (_, n) in zip(r, fields))
    return out + b"\x1a"


def test_attributes_of_shapefiles(spark, tmp_path):
    (tmp_path / "v1.2").mkdir()
    line = [(0.0, 0.0), (1.0, 1.0)]
    (tmp_path / "v1.2" / "a.shp").write_bytes(shp(line, line, line))
    (tmp_path / "v1.2" / "a.dbf").write_bytes(dbf([("name", 12), ("lanes", 3)], [("Straße".encode(), b"  2"), (b"gone", b"1"), ("Allée".encode("latin-1"), b"")], deleted={1}))
    (tmp_path / "B.SHP").write_bytes(shp(line))
    (tmp_path / "B.DBF").write_bytes(dbf([("ref", 4)], [(b"A 1",)]))
    (tmp_path / "c.shp").write_bytes(shp(line, line))
    (tmp_path / "c.dbf").write_bytes(dbf([("x", 4)], [(b"1",), (b"2",)])[:-4])
    (tmp_path / "d.shp").write_bytes(shp(line))
    (tmp_path / "d.dbf").write_bytes(b"nothing")
    (tmp_path / "e.shp").write_bytes(shp(line))
    rows = vector_files.shapefile(spark, str(tmp_path), attributes=True).collect()
    got = {(r["path"].rsplit("/", 1)[1], r["feature"]): r["properties"] for r in rows}
    assert len(rows) == len(got) == 8
    assert got[("a.shp", 0)] == {"name": "Straße", "lanes": "2"} and got[("a.shp", 1)] is None and got[("a.shp", 2)] == {"name": "Allée", "lanes": None}
    assert got[("B.SHP", 0)] == {"ref": "A 1"} and got[("c.shp", 0)] == {"x": "1"}
    assert got[("c.shp", 1)] is None and got[("d.shp", 0)] is None and got[("e.shp", 0)] is None
    assert "properties" not in vector_files.shapefile(spark, str(tmp_path)).columns
    assert vector_files.all_lines(spark, str(tmp_path), attributes=True).filter("properties is not null").count() == 4
