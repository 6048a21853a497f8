"""GeoTIFF files of one band: an encoder, a windowed reader and a data source (TIFF 6.0 and GeoTIFF 1.1).

Files are read and written by tasks, a window or a file each; paths must be reachable from every executor. Missing pixels
are NaN in arrays and NULL in rows; a file's nodata value stands for them on disk. An empty file of no pixels can't be
written; a window outside the raster is all missing.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: TIFF's field types: size and struct code.
TYPES = {1: (1, "B"), 2: (1, "c"), 3: (2, "H"), 4: (4, "I"), 5: (8, "Q"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q")}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIP_OFFSETS, SAMPLES, STRIP_ROWS, STRIP_SIZES, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_SIZES, SAMPLE_FORMAT, PIXEL_SCALE, TIEPOINT, GEO_KEYS, NODATA = 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113
NONE, DEFLATE, OLD_DEFLATE, ZSTD = 1, 8, 32946, 50000
TILE = 256
PROJECTED_CRS, GEOGRAPHIC_CRS = 3072, 2048


def local(path: str) -> str:
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def encoded(a: np.ndarray, left: float, top: float, size: float, epsg: int, nodata: float = float("nan")) -> bytes:
    """A tiled, zstd-compressed GeoTIFF of a 2-d array whose upper left corner is (left, top)."""
    a = np.ascontiguousarray(a)
    high, wide = a.shape
    codec = pa.Codec("zstd", compression_level=1)
    tiles = []
    for r in range(0, high, TILE):
        for c in range(0, wide, TILE):
            tile = np.full((TILE, TILE), 0 if np.isnan(nodata) and a.dtype.kind != "f" else nodata, a.dtype)
            part = a[r : r + TILE, c : c + TILE]
            tile[: part.shape[0], : part.shape[1]] = part
            tiles.append(codec.compress(tile.tobytes(), asbytes=True))
    offsets = np.cumsum([8, *map(len, tiles)])
    keys = [1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, PROJECTED_CRS, 0, 1, epsg]
    fields = {
        WIDTH: (4, [wide]), HEIGHT: (4, [high]), BITS: (3, [a.dtype.itemsize * 8]), COMPRESSION: (3, [ZSTD]), 262: (3, [1]), SAMPLES: (3, [1]),
        TILE_WIDTH: (3, [TILE]), TILE_HEIGHT: (3, [TILE]), TILE_OFFSETS: (4, offsets[:-1].tolist()), TILE_SIZES: (4, [len(t) for t in tiles]),
        SAMPLE_FORMAT: (3, [{"u": 1, "i": 2, "f": 3}[a.dtype.kind]]), PIXEL_SCALE: (12, [size, size, 0.0]), TIEPOINT: (12, [0.0, 0.0, 0.0, left, top, 0.0]),
        GEO_KEYS: (3, keys), NODATA: (2, [bytes([b]) for b in f"{nodata:g}\0".encode()]),
    }
    start = int(offsets[-1]) + int(offsets[-1]) % 2
    extra_at, entries, extra = start + 2 + 12 * len(fields) + 4, b"", b""
    for tag, (kind, values) in sorted(fields.items()):
        body = struct.pack(f"<{len(values)}{TYPES[kind][1]}", *values)
        if len(body) > 4:
            entries += struct.pack("<HHII", tag, kind, len(values), extra_at + len(extra))
            extra += body + b"\0" * (len(body) % 2)
        else:
            entries += struct.pack("<HHI", tag, kind, len(values)) + body.ljust(4, b"\0")
    pixels = b"".join(tiles)
    return struct.pack("<2sHI", b"II", 42, start) + pixels + b"\0" * (start - 8 - len(pixels)) + struct.pack("<H", len(fields)) + entries + struct.pack("<I", 0) + extra


class Raster:
    """An open GeoTIFF: its shape, place and windows of its band."""

    def __init__(self, file):
        self.file = file
        order = {b"II": "<", b"MM": ">"}[file.read(2)]
        (magic,) = struct.unpack(order + "H", file.read(2))
        if magic != 42:
            raise ValueError("not a classic TIFF file")
        (at,) = struct.unpack(order + "I", file.read(4))
        file.seek(at)
        (n,) = struct.unpack(order + "H", file.read(2))
        self.tags, raw = {}, file.read(12 * n)
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", raw, 12 * i)
            if kind not in TYPES:
                continue
            size, code = TYPES[kind]
            body = raw[12 * i + 8 : 12 * i + 12]
            if size * count > 4:
                file.seek(struct.unpack(order + "I", body)[0])
                body = file.read(size * count)
            self.tags[tag] = struct.unpack_from(f"{order}{count}{code}", body)
        one = lambda tag, default: self.tags.get(tag, (default,))[0]
        self.height, self.width = one(HEIGHT, 0), one(WIDTH, 0)
        if one(SAMPLES, 1) != 1:
            raise ValueError("more than one band")
        self.type = np.dtype(order + {1: "u", 2: "i", 3: "f"}[one(SAMPLE_FORMAT, 1)] + str(one(BITS, 8) // 8))
        self.compression, self.predictor = one(COMPRESSION, NONE), one(PREDICTOR, 1)
        if self.compression not in (NONE, DEFLATE, OLD_DEFLATE, ZSTD) or self.predictor not in (1, 2):
            raise ValueError(f"compression {self.compression} with predictor {self.predictor} isn't read")
        if TILE_OFFSETS in self.tags:
            self.block, self.offsets, self.sizes = (one(TILE_HEIGHT, 0), one(TILE_WIDTH, 0)), self.tags[TILE_OFFSETS], self.tags[TILE_SIZES]
        else:
            self.block, self.offsets, self.sizes = (min(one(STRIP_ROWS, self.height), self.height), self.width), self.tags[STRIP_OFFSETS], self.tags[STRIP_SIZES]
        scale, tie = self.tags.get(PIXEL_SCALE, (1.0, 1.0, 0.0)), self.tags.get(TIEPOINT, (0.0,) * 6)
        self.size, self.left, self.top = scale[0], tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1]
        keys = self.tags.get(GEO_KEYS, ())
        named = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
        self.epsg = named.get(PROJECTED_CRS) or named.get(GEOGRAPHIC_CRS)
        text = b"".join(self.tags.get(NODATA, ())).split(b"\0")[0].decode()
        self.nodata = float(text) if text.strip() else None

    def tile(self, r: int, c: int) -> np.ndarray:
        high, wide = self.block
        i = r * -(-self.width // wide) + c
        self.file.seek(self.offsets[i])
        data = self.file.read(self.sizes[i])
        rows = high if TILE_OFFSETS in self.tags else min(high, self.height - r * high)
        if self.compression in (DEFLATE, OLD_DEFLATE):
            data = zlib.decompress(data)
        elif self.compression == ZSTD:
            data = pa.Codec("zstd").decompress(data, rows * wide * self.type.itemsize, asbytes=True)
        a = np.frombuffer(data, self.type)[: rows * wide].reshape(rows, wide)
        return np.cumsum(a, axis=1, dtype=self.type.newbyteorder("=")) if self.predictor == 2 else a

    def window(self, row: int, col: int, high: int, wide: int) -> np.ndarray:
        """The pixels from (row, col) on, as doubles; missing ones, and those outside the raster, are NaN."""
        out = np.full((high, wide), np.nan)
        bh, bw = self.block
        for r in range(max(row, 0) // bh, -(-min(row + high, self.height) // bh)):
            for c in range(max(col, 0) // bw, -(-min(col + wide, self.width) // bw)):
                a = self.tile(r, c)[: self.height - r * bh, : self.width - c * bw]
                top, left = max(row, r * bh), max(col, c * bw)
                bottom, right = min(row + high, r * bh + a.shape[0]), min(col + wide, c * bw + a.shape[1])
                if top < bottom and left < right:
                    out[top - row : bottom - row, left - col : right - col] = a[top - r * bh : bottom - r * bh, left - c * bw : right - c * bw]
        return np.where(out == self.nodata, np.nan, out) if self.nodata is not None else out

    def aligned(self, left: float, bottom: float, right: float, top: float, pad: int = 2) -> tuple[int, int, int, int]:
        """row, col, height, width of the window over bounds, padded; it may reach outside the raster."""
        c0, c1 = int(np.floor((left - self.left) / self.size)) - pad, int(np.ceil((right - self.left) / self.size)) + pad
        r0, r1 = int(np.floor((self.top - top) / self.size)) - pad, int(np.ceil((self.top - bottom) / self.size)) + pad
        return r0, c0, r1 - r0, c1 - c0


class GeoTiff(DataSource):
    """spark.read.format("geotiff").load(path): file, row, col, x, y, value of each pixel of a file, or of a folder's files.

    Options bounds ("left,bottom,right,top") and pad read a window only; a partition is a band of `rows` rows.
    """

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return "file string, row int, col int, x double, y double, value double"

    def reader(self, schema) -> DataSourceReader:
        return GeoTiffReader(self.options)


class GeoTiffReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.rows, self.pad = local(options["path"]), int(options.get("rows", 1024)), int(options.get("pad", 0))
        self.bounds = [float(x) for x in options["bounds"].split(",")] if "bounds" in options else None

    def partitions(self):
        out = []
        for path in rasters(self.path):
            with open(path, "rb") as file:
                r = Raster(file)
            row, col, high, wide = r.aligned(*self.bounds, self.pad) if self.bounds else (0, 0, r.height, r.width)
            out += [InputPartition((path, a, col, min(self.rows, row + high - a), wide)) for a in range(row, row + high, self.rows)]
        return out or [InputPartition(None)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        path, row, col, high, wide = partition.value
        with open(path, "rb") as file:
            r = Raster(file)
            a = r.window(row, col, high, wide)
        rows, cols = np.repeat(np.arange(row, row + high), wide), np.tile(np.arange(col, col + wide), high)
        columns = {"file": [os.path.basename(path)] * len(rows), "row": rows.astype(np.int32), "col": cols.astype(np.int32), "x": r.left + (cols + 0.5) * r.size, "y": r.top - (rows + 0.5) * r.size}
        yield pa.RecordBatch.from_pydict(columns | {"value": pa.array(a.ravel(), mask=np.isnan(a.ravel()))})


def rasters(path: str) -> list[str]:
    """A file, or the raster files below a folder, sorted."""
    if not os.path.isdir(path):
        return [path]
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.lower().endswith((".tif", ".tiff")))


def write(pixels: DataFrame, folder: str, epsg: int, size: float = 30.0) -> DataFrame:
    """Writes pixels(file, row, col, x, y, value) as a float32 raster for each file; returns file, width, height, n_valid, error.

    A task holds one raster, which ends at the outermost pixels given. A file appears when it is whole. A raster that
    can't be written gives a row with its error, and the others are written all the same.
    """

    def run(p: pd.DataFrame) -> pd.DataFrame:
        name = p["file"].iloc[0]
        try:
            r, c = p["row"] - p["row"].min(), p["col"] - p["col"].min()
            a = np.full((r.max() + 1, c.max() + 1), np.nan, np.float32)
            a[r, c] = p["value"].astype(np.float32)
            path = os.path.join(local(folder), name)
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(f"{path}.{os.getpid()}.tmp", "wb") as file:
                file.write(encoded(a, p["x"].min() - size / 2, p["y"].max() + size / 2, size, epsg))
            os.replace(file.name, path)
            return pd.DataFrame({"file": [name], "width": [a.shape[1]], "height": [a.shape[0]], "n_valid": [int(np.isfinite(a).sum())], "error": [None]})
        except (OSError, ValueError) as e:
            return pd.DataFrame({"file": [name], "width": [0], "height": [0], "n_valid": [0], "error": [str(e)]})

    return pixels.select("file", "row", "col", "x", "y", F.col("value").cast("double")).groupBy("file").applyInPandas(run, "file string, width int, height int, n_valid long, error string")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GeoTiff)
