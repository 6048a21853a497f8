"""Vector sources: GeoPackage and dBase as Python data sources, scene catalogues as JSON."""

from __future__ import annotations

import datetime
import sqlite3
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

EDGES = "array<struct<ring:int,x1:double,y1:double,x2:double,y2:double>>"
#: Bytes of the envelope of a GeoPackage geometry, by its code.
ENVELOPES = (0, 32, 48, 48, 64)


def rings(wkb: bytes) -> list[list[tuple[float, float]]]:
    """The rings of a WKB polygon, multipolygon or collection of them."""
    out: list[list[tuple[float, float]]] = []

    def read(at: int) -> int:
        order = "<" if wkb[at] else ">"
        (kind,) = struct.unpack_from(order + "I", wkb, at + 1)
        size = 2 + ((kind // 1000) % 4 in (1, 2)) + 2 * ((kind // 1000) % 4 == 3)
        (n,) = struct.unpack_from(order + "I", wkb, at + 5)
        at += 9
        for _ in range(n):
            if kind % 1000 in (6, 7):
                at = read(at)
            elif kind % 1000 == 3:
                (points,) = struct.unpack_from(order + "I", wkb, at)
                flat = struct.unpack_from(f"{order}{points * size}d", wkb, at + 4)
                out.append([(flat[i], flat[i + 1]) for i in range(0, len(flat), size)])
                at += 4 + 8 * points * size
            else:
                raise ValueError(f"geometry type {kind} isn't a polygon")
        return at

    read(0)
    return out


def edges(blob: bytes | None) -> list[tuple] | None:
    """The edges of a GeoPackage geometry."""
    if not blob:
        return None
    body = blob[8 + ENVELOPES[blob[3] >> 1 & 7] :]
    return [(r, *a, *b) for r, ring in enumerate(rings(body)) for a, b in zip(ring, ring[1:], strict=False) if a != b]


class GeoPackage(DataSource):
    """spark.read.format("gpkg").option("layer", ...).load(path): a layer's columns, geometry as its edges.

    A GeoPackage is one SQLite file that every executor must be able to open; rows are read in ranges of row ids.
    """

    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def opened(self):
        return sqlite3.connect(f"file:{self.options['path'].removeprefix('file:')}?mode=ro", uri=True)

    def layout(self) -> tuple[str, str, list[tuple[str, str]]]:
        with self.opened() as db:
            found = db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY rowid").fetchall()
            layer = self.options.get("layer") or found[0][0]
            geometry = dict(found)[layer]
            return layer, geometry, [(r[1], r[2].upper()) for r in db.execute(f'PRAGMA table_info("{layer}")')]

    def schema(self) -> str:
        _, geometry, columns = self.layout()
        kind = lambda c, t: EDGES if c == geometry else "bigint" if "INT" in t else "double" if t in ("REAL", "DOUBLE", "FLOAT") else "string"
        return ", ".join(f"`{c}` {kind(c, t)}" for c, t in columns)

    def reader(self, schema) -> DataSourceReader:
        return GeoPackageReader(self)


class GeoPackageReader(DataSourceReader):
    def __init__(self, source: GeoPackage):
        self.source = source

    def partitions(self):
        from pyspark.sql.datasource import InputPartition

        layer, _, _ = self.source.layout()
        with self.source.opened() as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{layer}"').fetchone()
        if low is None:
            return [InputPartition((0, -1))]
        step = int(self.source.options.get("rows", 50_000))
        return [InputPartition((a, min(a + step - 1, high))) for a in range(low, high + 1, step)]

    def read(self, partition) -> Iterator[tuple]:
        layer, geometry, columns = self.source.layout()
        place = [c for c, _ in columns].index(geometry)
        with self.source.opened() as db:
            for row in db.execute(f'SELECT * FROM "{layer}" WHERE rowid BETWEEN ? AND ?', partition.value):
                yield tuple(edges(v) if i == place else v for i, v in enumerate(row))


class Dbf(DataSource):
    """spark.read.format("dbf").load(path): a dBase table, as of a shapefile; deleted rows are left out, text is trimmed."""

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def layout(self):
        with open(self.options["path"].removeprefix("file:"), "rb") as f:
            _, n, start, width = struct.unpack("<IIHH", f.read(12))
            f.seek(32)
            fields = []
            while (head := f.read(32)) and head[0] != 0x0D:
                fields.append((head[:11].split(b"\0")[0].decode(), chr(head[11]), head[16], head[17]))
        return n, start, width, fields

    def schema(self) -> str:
        kind = {"D": "date", "L": "boolean", "F": "double"}
        return ", ".join(f"`{c}` {kind.get(t) or ('bigint' if t == 'N' and not d else 'double' if t == 'N' else 'string')}" for c, t, _, d in self.layout()[3])

    def reader(self, schema) -> DataSourceReader:
        return DbfReader(self)


class DbfReader(DataSourceReader):
    def __init__(self, source: Dbf):
        self.source = source

    def read(self, partition) -> Iterator[tuple]:
        n, start, width, fields = self.source.layout()

        def value(raw: bytes, kind: str, decimals: int):
            text = raw.decode("utf-8", "replace").strip().strip("\0")
            try:
                if kind == "D":
                    return datetime.datetime.strptime(text, "%Y%m%d").date()
                if kind == "L":
                    return {"T": True, "Y": True, "F": False, "N": False}.get(text.upper())
                if kind in "NF":
                    return int(text) if kind == "N" and not decimals else float(text)
            except ValueError:
                return None
            return text or None

        with open(self.source.options["path"].removeprefix("file:"), "rb") as f:
            f.seek(start)
            for _ in range(n):
                row, out, at = f.read(width), [], 1
                if row[:1] == b"*":
                    continue
                for _, kind, size, decimals in fields:
                    out.append(value(row[at : at + size], kind, decimals))
                    at += size
                yield tuple(out)


def register(spark: SparkSession) -> None:
    for source in (GeoPackage, Dbf):
        spark.dataSource.register(source)


ITEM = "id string, bbox array<double>, properties struct<datetime timestamp, `proj:code` string, `proj:transform` array<double>, `proj:shape` array<int>, `eo:cloud_cover` double, `landsat:scene_id` string>, assets map<string, struct<href string>>"


def scenes(spark: SparkSession, path: str) -> DataFrame:
    """The items of scene search results (JSON feature collections), flat; the id falls back to the item's."""
    items = spark.read.schema(f"features array<struct<{ITEM.replace('id string', 'id: string', 1).replace('bbox array', 'bbox: array').replace('properties struct', 'properties: struct').replace('assets map', 'assets: map')}>>").option("multiLine", True).json(path)
    p = "properties."
    return items.select(F.inline("features")).select(
        F.coalesce(F.nullif(F.col(p + "`landsat:scene_id`"), F.lit("")), "id").alias("scene_id"),
        F.col(p + "datetime").alias("acq_ts"),
        F.col(p + "`eo:cloud_cover`").alias("cloud_cover"),
        F.regexp_extract(F.col(p + "`proj:code`"), r"(\d+)$", 1).cast("int").alias("epsg"),
        F.col(p + "`proj:transform`").alias("transform"),
        F.col(p + "`proj:shape`").alias("shape"),
        *[F.col("bbox")[i].alias(n) for i, n in enumerate(("lon_w", "lat_s", "lon_e", "lat_n"))],
        F.map_from_entries(F.transform(F.map_entries("assets"), lambda e: F.struct(e["key"], e["value"]["href"]))).alias("assets"),
    )
