"""A Spark data source for web feature services: one input partition per bounding box.

    spark.dataSource.register(WfsSource)
    spark.read.format("wfs").option("baseUrl", url).option("feature", name).load()

Options: baseUrl, feature, schema (DDL of the properties; otherwise the service describes them), bbox
(west,south,east,north; otherwise from the capabilities), tileDegrees (0: a single request), overlapPct,
crs, limit (requests at most), timeout, retries. Overlapping boxes return a feature more than once:
deduplicate by its id.
"""

from __future__ import annotations

import json
import math
import time
import urllib.parse
import urllib.request
import xml.etree.ElementTree as ET
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: XML schema types and their Spark names.
XSD_TYPES = {"string": "string", "int": "int", "integer": "long", "long": "long", "short": "short", "boolean": "boolean", "double": "double", "float": "float", "decimal": "double", "date": "string", "dateTime": "string"}


def get_content(url: str, content_type: str, timeout: float = 60, retries: int = 0) -> str:
    for attempt in range(retries + 1):
        try:
            request = urllib.request.Request(url, headers={"Accept": content_type})  # noqa: S310
            with urllib.request.urlopen(request, timeout=timeout) as r:  # noqa: S310
                return r.read().decode(r.headers.get_content_charset() or "utf-8")
        except OSError:
            if attempt == retries:
                raise
            time.sleep(min(2**attempt, 30))
    raise AssertionError


def _local(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


def features(capabilities: str) -> dict[str, tuple[float, float, float, float] | None]:
    """Names of the features of a service with their boxes (west, south, east, north)."""
    out = {}
    for e in ET.fromstring(capabilities).iter():  # noqa: S314
        if _local(e) != "FeatureType":
            continue
        name, box = None, None
        for x in e.iter():
            if _local(x) == "Name" and name is None:
                name = (x.text or "").strip()
            elif _local(x) == "LatLongBoundingBox":
                box = tuple(float(x.attrib[k]) for k in ("minx", "miny", "maxx", "maxy"))
            elif _local(x) == "WGS84BoundingBox":
                corners = {_local(c): tuple(map(float, (c.text or "").split())) for c in x}
                box = (*corners["LowerCorner"], *corners["UpperCorner"])
        if name:
            out[name] = check_box(box) if box else None
    return out


def check_box(box: tuple) -> tuple[float, float, float, float]:
    west, south, east, north = map(float, box)
    if not (-180 <= west <= east <= 180 and -90 <= south <= north <= 90):
        raise ValueError(f"not a box in degrees: {box}")
    return west, south, east, north


def properties_schema(xsd: str) -> str:
    """DDL of a feature's simple properties; geometry (gml types) is left out."""
    fields = []
    for e in ET.fromstring(xsd).iter():  # noqa: S314
        if _local(e) == "element" and "type" in e.attrib and "name" in e.attrib:
            prefix, _, kind = e.attrib["type"].rpartition(":")
            if kind in XSD_TYPES and prefix != "gml":
                fields.append(f"`{e.attrib['name']}` {XSD_TYPES[kind]}")
    return ", ".join(dict.fromkeys(fields))


def boxes(box: tuple[float, float, float, float], degrees: float, overlap_pct: float) -> list[tuple[float, float, float, float]]:
    """Tiles of `degrees` that cover `box`, each widened by a share of its size on every side."""
    west, south, east, north = box
    if degrees <= 0:
        return [box]
    nx, ny = max(1, math.ceil((east - west) / degrees)), max(1, math.ceil((north - south) / degrees))
    pad = degrees * overlap_pct
    return [
        (west + i * degrees - pad, south + j * degrees - pad, min(east, west + (i + 1) * degrees) + pad, min(north, south + (j + 1) * degrees) + pad)
        for j in range(ny)
        for i in range(nx)
    ]


class BoxPartition(InputPartition):
    def __init__(self, box):
        self.box = box


def _url(base: str, **parameters) -> str:
    return f"{base}{'&' if '?' in base else '?'}{urllib.parse.urlencode(parameters)}"


class WfsReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.options, self.schema_ = dict(options), schema

    def _get(self, content_type: str, **parameters) -> str:
        o = self.options
        return get_content(_url(o["baseUrl"], service="WFS", version="2.0.0", **parameters), content_type, float(o.get("timeout", 60)), int(o.get("retries", 0)))

    def partitions(self):
        o = self.options
        if o.get("bbox"):
            box = check_box(tuple(o["bbox"].split(",")))
        else:
            known = features(self._get("text/xml", request="GetCapabilities"))
            if o["feature"] not in known:
                raise ValueError(f"the service has no feature {o['feature']}; it has {', '.join(sorted(known))}")
            box = known[o["feature"]] or (-180.0, -90.0, 180.0, 90.0)
        made = boxes(box, float(o.get("tiledegrees", o.get("tileDegrees", 0))), float(o.get("overlappct", o.get("overlapPct", 0.01))))
        limit = int(o.get("limit", 0))
        return [BoxPartition(b) for b in (made[:limit] if limit else made)]

    def read(self, partition) -> Iterator[tuple]:
        box = ",".join(map(str, partition.box))
        text = self._get("application/json", request="GetFeature", typeNames=self.options["feature"], outputFormat="application/json", srsName=self.options.get("crs", "EPSG:4326"), bbox=f"{box},EPSG:4326")
        names = self.schema_.names[2:]
        for f in json.loads(text).get("features", []):
            p = f.get("properties") or {}
            yield (f.get("id"), json.dumps(f["geometry"]) if f.get("geometry") else None, *(p.get(n) for n in names))


class WfsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wfs"

    def schema(self):
        o = self.options
        ddl = o.get("schema")
        if ddl is None:
            url = _url(o["baseUrl"], service="WFS", version="2.0.0", request="DescribeFeatureType", typeNames=o["feature"])
            ddl = properties_schema(get_content(url, "text/xml", float(o.get("timeout", 60)), int(o.get("retries", 0))))
        return "feature_id string, geometry string" + (f", {ddl}" if ddl else "")

    def reader(self, schema: StructType):
        return WfsReader({**self.options, "baseUrl": self.options["baseUrl"]}, schema)
