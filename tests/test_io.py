"""Sources, sinks and pipelines."""

import gzip
import http.server
import json
import struct
import threading

import pytest
from pyspark.sql import functions as F

from trackweave import fixtures
from trackweave.plans import railway
from trackweave.plans.actions import Action, Pipeline, Table
from trackweave.sinks import flatgeobuf, mvt, pmtiles
from trackweave.sources import geo, wfs

SF = "/root/testdata/sf0.001"


def test_wkb():
    line = [(0.0, 1.0, 2.0), (3.0, 4.0, 5.0)]
    flat = [(0.0, 1.0), (3.0, 4.0)]
    assert geo.decode_wkb(geo.encode_wkb([line])) == [line]
    assert geo.decode_wkb(geo.encode_wkb([line, line])) == [line, line]
    big = struct.pack(">BII4d", 0, 2, 2, *[v for p in flat for v in p])
    assert [[p[:2] for p in part] for part in geo.decode_wkb(big)] == [flat]
    extended = struct.pack("<BIII6d", 1, 0xA0000002, 2056, 2, *[v for p in line for v in p])
    assert geo.decode_wkb(extended) == [line]
    assert geo.decode_wkb(struct.pack("<BI2d", 1, 1, 7.0, 8.0))[0][0][:2] == (7.0, 8.0)
    assert geo.decode_wkb(None) is None
    with pytest.raises(ValueError):
        geo.decode_wkb(struct.pack("<BII", 1, 3, 0))


def test_geoparquet_and_geojson(spark, tmp_path):
    t = fixtures.tracks(spark, SF).select("uuid_track", "line")
    geo.write_geoparquet(t, str(tmp_path / "t"))
    back = geo.read_geoparquet(spark, str(tmp_path / "t")).select("uuid_track", F.col("lines")[0].alias("line"))
    assert back.exceptAll(t).count() == 0 and back.count() == t.count()
    path = tmp_path / "x.geojsonl"
    path.write_text('{"type":"Feature","geometry":{"type":"LineString","coordinates":[[1,2],[3,4,5]]},"properties":{"railway":"rail"}}\n')
    r = geo.read_geojson_sequence(spark, str(path)).select(geo.geojson_line("geometry").alias("l"), F.col("properties")["railway"].alias("k"), F.col("properties")["none"].alias("n")).first()
    assert r["k"] == "rail" and r["n"] is None and r["l"][1]["z"] == 5 and r["l"][0]["z"] != r["l"][0]["z"]
    path.write_text("{broken\n")
    with pytest.raises(Exception):
        geo.read_geojson_sequence(spark, str(path)).collect()
    assert geo.read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0


CAPABILITIES = """<WFS xmlns:ows="http://o"><FeatureTypeList><FeatureType><Name>a:rail</Name><ows:WGS84BoundingBox><ows:LowerCorner>5 45</ows:LowerCorner><ows:UpperCorner>7 46</ows:UpperCorner></ows:WGS84BoundingBox></FeatureType>
<FeatureType><Name>b</Name><LatLongBoundingBox minx="1" miny="2" maxx="3" maxy="4"/></FeatureType></FeatureTypeList></WFS>"""
XSD = """<xsd:schema xmlns:xsd="http://x"><xsd:element name="speed" type="xsd:int"/><xsd:element name="geom" type="gml:LineStringPropertyType"/><xsd:element name="name" type="xsd:string"/></xsd:schema>"""


@pytest.fixture
def service():
    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            if "GetCapabilities" in self.path:
                body = CAPABILITIES
            elif "DescribeFeatureType" in self.path:
                body = XSD
            else:
                body = json.dumps({"type": "FeatureCollection", "features": [{"id": f"f{len(asked)}", "geometry": {"type": "LineString", "coordinates": [[5, 45], [6, 45.5]]}, "properties": {"speed": 80, "name": "x", "other": 1}}]})
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/wfs", asked
    server.shutdown()


def test_wfs(spark, service):
    url, asked = service
    spark.dataSource.register(wfs.WfsSource)
    read = spark.read.format("wfs").option("baseUrl", url).option("feature", "a:rail").option("tileDegrees", "1")
    df = read.load()
    assert df.columns == ["feature_id", "geometry", "speed", "name"]
    rows = df.collect()
    assert len(rows) == 2 and rows[0]["speed"] == 80 and json.loads(rows[0]["geometry"])["type"] == "LineString"
    assert len(read.option("limit", "1").load().collect()) == 1
    with pytest.raises(Exception, match="no feature"):
        spark.read.format("wfs").option("baseUrl", url).option("feature", "zzz").option("schema", "a string").load().collect()


def test_wfs_parts():
    assert wfs.features(CAPABILITIES) == {"a:rail": (5, 45, 7, 46), "b": (1, 2, 3, 4)}
    assert wfs.properties_schema(XSD) == "`speed` int, `name` string"
    assert wfs.boxes((0, 0, 2, 1), 1, 0.1) == [(-0.1, -0.1, 1.1, 1.1), (0.9, -0.1, 2.1, 1.1)]
    assert wfs.boxes((0, 0, 2, 1), 0, 0.1) == [(0, 0, 2, 1)]
    with pytest.raises(ValueError):
        wfs.check_box((0, 0, 200, 1))


def test_vector_tile_bytes():
    assert mvt.varint(300) == b"\xac\x02" and mvt.zigzag(-1) == 1 and mvt.zigzag(1) == 2
    assert mvt.geometry([(25, 17)]) == (1, [9, 50, 34])
    assert mvt.geometry([(2, 2), (2, 10), (10, 10)]) == (2, [9, 4, 4, 18, 0, 16, 16, 0])
    assert mvt.place(0.0, 0.0, 0, 0, 0) == (2048, 2048)
    tile = mvt.encode([("pps", 1, [(25, 17)], {"a": "x", "n": None, "b": True})])
    assert tile[0] == 0x1A and b"pps" in tile and b"a" in tile


def test_pmtiles(spark, tmp_path):
    first = [(0, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 1, 0), (2, 0, 0)]
    assert [pmtiles.tile_id(*t) for t in first] == list(range(6))
    rows = [(5, x, y, f"{x}-{y}".encode()) for x in range(32) for y in range(32)]
    tiles = spark.createDataFrame(rows, "z int, x long, y long, data binary").repartition(5)
    path = tmp_path / "a.pmtiles"
    assert pmtiles.write(tiles, f"file://{path}", {"a": "String"}, compressed=False) == 1024
    raw = path.read_bytes()
    root, root_n, meta, meta_n, _, _, data, data_n, n, _, _ = struct.unpack("<11Q", raw[8:96])
    assert raw[:8] == b"PMTiles\x03" and n == 1024 and len(raw) == data + data_n
    assert json.loads(gzip.decompress(raw[meta : meta + meta_n]))["vector_layers"][0]["id"] == "pps"
    ordered = b"".join(d for _, d in sorted((pmtiles.tile_id(z, x, y), d) for z, x, y, d in rows))
    assert raw[data:] == ordered and gzip.decompress(raw[root : root + root_n])[:2] == b"\x80\x08"


def test_flatgeobuf(spark, tmp_path):
    pytest.importorskip("flatbuffers")
    t = fixtures.tracks(spark, SF).limit(5).select("uuid_track", "k", "tags", F.array("line").alias("lines"))
    path = tmp_path / "a.fgb"
    assert flatgeobuf.write(t, f"file://{path}") == 5
    raw = path.read_bytes()
    assert raw[:8] == flatgeobuf.MAGIC
    at, n = 8 + 4 + struct.unpack_from("<I", raw, 8)[0], 0
    while at < len(raw):
        at += 4 + struct.unpack_from("<I", raw, at)[0]
        n += 1
    assert at == len(raw) and n == 5
    for bad in ({"path": "file:///tmp/a.txt"}, {"path": "file:///tmp/a.fgb", "kind": "Polygon"}, {"path": "file:///tmp/a.fgb", "lines": "none"}):
        with pytest.raises(ValueError):
            flatgeobuf.write(t, **bad)


def test_pipeline_runs_and_repeats(spark, tmp_path):
    root = str(tmp_path)
    fixtures.tracks(spark, SF).where("k < 14").select("uuid_track", "line", "tags").write.parquet(f"{root}/slv-topo-track")
    p = railway.pipeline(railway.Settings(root), standard=lambda df: df)
    done = p.run(spark, report_path=f"{root}/report.json")["actions"]
    assert all(a["state"] == "succeeded" for a in done.values())
    assert done["create-pp"]["rows"]["slv-pp-mapping"] == done["create-slv-topo-pp"]["rows"]["slv-topo-pp"] > 0
    assert p.run(spark, "pp")["actions"]["create-pp"]["rows"]["slv-pp"] == 0  # all candidates snap to what is there
    assert json.load(open(f"{root}/report.json"))["actions"]["create-pp"]["state"] == "succeeded"


def test_plans(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/a")
    tables = {n: Table(n, f"{tmp_path}/{n}") for n in "abc"}
    actions = [Action("second", ("b",), ("c",), (lambda f: {"c": f["b"].selectExpr("sum(y) AS s")},), "two"), Action("first", ("a",), ("b",), ("SELECT id * 2 AS y FROM %{a}",), "one")]
    p = Pipeline(tables, actions)
    assert [a.name for a in p.ordered()] == ["first", "second"] and [a.name for a in p.ordered("two")] == ["second"]
    assert p.dry_run(spark)["second"] == {"c": "struct<s:bigint>"}
    p.run(spark)
    assert spark.read.parquet(f"{tmp_path}/c").first()["s"] == 20
    with pytest.raises(ValueError, match="makes no"):
        Action("bad", ("a",), ("z",), (lambda f: {},)).plan({"a": spark.range(1)})
