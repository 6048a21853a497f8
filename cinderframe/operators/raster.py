"""Grids of pixel rows: warps, clips, merges, mosaics, polygon splitting."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderframe.functions.geo import PIXEL, SNAP, Albers, Utm


def centre(i: Column, origin: float = 0.0, size: float = PIXEL) -> Column:
    return F.lit(origin) + (i + 0.5) * size


def warp_nearest(source: DataFrame, target: DataFrame, r: Column, c: Column, values: list[str]) -> DataFrame:
    """target with the source values of the pixel that holds the fractional source place (r, c); NULL outside."""
    named = source.select(F.col("row").alias("_r"), F.col("col").alias("_c"), *values)
    placed = target.withColumn("_r", F.floor(r).cast("int")).withColumn("_c", F.floor(c).cast("int"))
    return placed.join(named, ["_r", "_c"], "left").drop("_r", "_c")


def warp_bilinear(source: DataFrame, target: DataFrame, r: Column, c: Column, value: str) -> DataFrame:
    """target with the mean of the four source pixels around (r, c), weighted by nearness; missing ones don't count."""
    keys = target.columns
    near = target.withColumn("_fr", r - 0.5).withColumn("_fc", c - 0.5)
    corner = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
    near = near.withColumn("_k", corner)
    near = near.select(
        *keys,
        (F.floor("_fr") + F.col("_k.a")).cast("int").alias("_r"),
        (F.floor("_fc") + F.col("_k.b")).cast("int").alias("_c"),
        ((1 - F.abs(F.col("_k.a") - (F.col("_fr") - F.floor("_fr")))) * (1 - F.abs(F.col("_k.b") - (F.col("_fc") - F.floor("_fc"))))).alias("_w"),
    )
    joined = near.join(source.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col(value).alias("_v")), ["_r", "_c"], "left")
    weight = F.sum(F.when(F.col("_v").isNotNull(), F.col("_w")))
    return joined.groupBy(*keys).agg((F.sum(F.col("_w") * F.col("_v")) / F.nullif(weight, F.lit(0.0))).alias(value))


def inside(pixels: DataFrame, edges: DataFrame, x: str = "x", y: str = "y", on: tuple[str, ...] = (), band: float = PIXEL) -> DataFrame:
    """The pixels whose centre lies in the polygon of edges(x1, y1, x2, y2), holes out: even-odd over a ray to the right.

    Edges are dealt to the bands of `band` metres that they reach across, and pixels join those of their own band, so a
    pixel meets the few edges at its height; each pixel's other columns tell it apart. No edges: no pixel is inside.
    """
    level = lambda v: F.floor(v / band).cast("bigint")
    e = edges.where("y1 <> y2").select(*[F.col(k).alias(f"_{k}") for k in on], "x1", "y1", "x2", "y2", F.explode(F.sequence(level(F.least("y1", "y2")), level(F.greatest("y1", "y2")))).alias("_band"))
    p = pixels.withColumn("_at", level(F.col(y)))
    crosses = ((F.col("y1") > F.col(y)) != (F.col("y2") > F.col(y))) & (F.col(x) < (F.col("x2") - F.col("x1")) * (F.col(y) - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0)) + F.col("x1"))
    same = [F.col("_at") == F.col("_band"), *[p[k].eqNullSafe(F.col(f"_{k}")) for k in on]]
    hit = p.join(e, [*same, crosses])
    return hit.groupBy(*pixels.columns).agg(F.count("*").alias("_n")).where("_n % 2 = 1").drop("_n")


def area_and_bounds(edges: DataFrame, by: str) -> DataFrame:
    """Shoelace area (holes of the other orientation subtract) and bounds of the polygons of edges."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    return edges.groupBy(by).agg((F.abs(F.sum(cross)) / 2).alias("area"), F.min("x1").alias("minx"), F.min("y1").alias("miny"), F.max("x1").alias("maxx"), F.max("y1").alias("maxy"))


def merge_first(pieces: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Of each pixel the first valid value in piece order."""
    return pieces.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, order).alias(value))


def mosaic_last(pieces: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Of each pixel the last valid value in file order."""
    return pieces.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, order).alias(value))


Ring = list[tuple[float, float]]


def half_plane(ring: Ring, axis: int, at: float, below: bool) -> Ring:
    """The part of a ring on one side of a line parallel to an axis (Sutherland-Hodgman)."""
    out: Ring = []
    side = (lambda p: p[axis] <= at) if below else (lambda p: p[axis] >= at)
    for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
        if side(a):
            out.append(a)
        if side(a) != side(b) and a[axis] != b[axis]:
            t = (at - a[axis]) / (b[axis] - a[axis])
            p = (a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1]))
            out.append((at, p[1]) if axis == 0 else (p[0], at))
    return out


def ring_area(ring: Ring) -> float:
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))) / 2


def split_ring(ring: Ring, threshold: float) -> Iterator[Ring]:
    """Pieces of at most `threshold` square metres of bounding box: halved across the longer side, ties across x."""
    todo = [ring]
    while todo:
        part = todo.pop()
        if len(part) < 3 or ring_area(part) <= 0:
            continue
        xs, ys = [p[0] for p in part], [p[1] for p in part]
        w, h = max(xs) - min(xs), max(ys) - min(ys)
        if w * h <= threshold or not math.isfinite(w * h):
            yield part
            continue
        axis = 0 if w >= h else 1
        middle = (min(xs) + max(xs)) / 2 if axis == 0 else (min(ys) + max(ys)) / 2
        todo += [half_plane(part, axis, middle, below) for below in (False, True)]


#: Halvings at most: a box of the Earth's surface is down to a square metre after half as many.
HALVINGS = 100


def split_boxes(fires: DataFrame, threshold: float) -> DataFrame:
    """fires(event_id, minx, miny, maxx, maxy) as pieces: event_id, piece, minx, miny, maxx, maxy, area.

    Halves of a box are alike, so the number of cuts along each axis is arithmetic: no rows travel to Python. Empty and
    infinite boxes give no piece, or stay whole.
    """
    sides = F.struct((F.col("maxx") - F.col("minx")).alias("w"), (F.col("maxy") - F.col("miny")).alias("h"), F.lit(1).cast("bigint").alias("a"), F.lit(1).cast("bigint").alias("b"))

    def halve(s: Column, _: Column) -> Column:
        large, wide = s["w"] * s["h"] > threshold, s["w"] >= s["h"]
        cut = lambda c, now: F.when(now, s[c] / 2).otherwise(s[c]).alias(c)
        more = lambda c, now: F.when(now, s[c] * 2).otherwise(s[c]).alias(c)
        return F.struct(cut("w", large & wide), cut("h", large & ~wide), more("a", large & wide), more("b", large & ~wide))

    finite = (F.col("w0") > 0) & (F.col("h0") > 0)
    found = fires.select("event_id", "minx", "miny", "maxx", "maxy", (F.col("maxx") - F.col("minx")).alias("w0"), (F.col("maxy") - F.col("miny")).alias("h0")).where(finite)
    found = found.withColumn("s", F.when(F.col("w0") * F.col("h0") < float("inf"), F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), sides, halve)).otherwise(sides))
    found = found.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("s.a") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("s.b") - 1)))
    x, y = (lambda k: F.col("minx") + k * F.col("s.w")), (lambda k: F.col("miny") + k * F.col("s.h"))
    return found.select("event_id", (F.col("i") * F.col("s.b") + F.col("j")).cast("int").alias("piece"), x(F.col("i")).alias("minx"), y(F.col("j")).alias("miny"), x(F.col("i") + 1).alias("maxx"), y(F.col("j") + 1).alias("maxy"), (F.col("s.w") * F.col("s.h")).alias("area"))


def split_polygons(parts: DataFrame, threshold: float) -> DataFrame:
    """parts(event_id, edges: array of ring, x1, y1, x2, y2) as pieces with edges of their own: event_id, piece, edges.

    Every ring of a piece, holes too, is cut by the same lines. A concave ring cut in two keeps bridges along the cut;
    even-odd tests and areas don't see them. Pieces without area drop out.
    """

    def run(batches):
        import pandas as pd

        for batch in batches:
            out = []
            for event, edges in zip(batch["event_id"], batch["edges"], strict=True):
                rings: dict[int, Ring] = {}
                for e in edges if edges is not None else ():
                    rings.setdefault(e["ring"], []).append((e["x1"], e["y1"]))
                for n, piece in enumerate(split_rings(list(rings.values()), threshold)):
                    closed = [(k, *a, *b) for k, ring in enumerate(piece) for a, b in zip(ring, ring[1:] + ring[:1], strict=True) if a != b]
                    out.append((event, n, [dict(zip(("ring", "x1", "y1", "x2", "y2"), e, strict=True)) for e in closed]))
            yield pd.DataFrame(out, columns=["event_id", "piece", "edges"])

    return parts.select("event_id", "edges").mapInPandas(run, "event_id string, piece int, edges array<struct<ring:int,x1:double,y1:double,x2:double,y2:double>>")


def split_rings(rings: list[Ring], threshold: float) -> Iterator[list[Ring]]:
    """Like split_ring(), for outer rings and holes together."""
    todo = [rings]
    while todo:
        part = [r for r in todo.pop() if len(r) >= 3 and ring_area(r) > 0]
        if not part:
            continue
        xs, ys = [p[0] for r in part for p in r], [p[1] for r in part for p in r]
        w, h = max(xs) - min(xs), max(ys) - min(ys)
        if w * h <= threshold or not math.isfinite(w * h):
            yield part
            continue
        axis = 0 if w >= h else 1
        middle = (min(xs) + max(xs)) / 2 if axis == 0 else (min(ys) + max(ys)) / 2
        todo += [[half_plane(r, axis, middle, below) for r in part] for below in (False, True)]


def snapped_grid(spark: SparkSession, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """row, col, x, y (centres) of the snapped equal-area grid around bounds, made in parallel."""
    left, top = SNAP[0] + math.floor((minx - SNAP[0]) / PIXEL) * PIXEL, SNAP[1] - math.floor((SNAP[1] - maxy) / PIXEL) * PIXEL
    wide, high = math.ceil((maxx - left) / PIXEL), math.ceil((top - miny) / PIXEL)
    cell = spark.range(wide * high).select(F.floor(F.col("id") / wide).cast("int").alias("row"), (F.col("id") % wide).cast("int").alias("col"))
    return cell.select("row", "col", (F.lit(left) + (F.col("col") + 0.5) * PIXEL).alias("x"), (F.lit(top) - (F.col("row") + 0.5) * PIXEL).alias("y"))


def to_snapped_clip(source: DataFrame, edges: DataFrame, east: float, north: float, zone: str, values: list[str], size: float = PIXEL) -> DataFrame:
    """source(row, col, values) of a UTM grid on the snapped equal-area grid, inside the polygon of edges: row, col, x, y, values.

    Each target pixel takes the value of the source pixel its centre falls in. Only the polygon's pixels are ever
    projected, and rows and columns without any are cropped by not being there.
    """
    minx, miny, maxx, maxy = edges.agg(F.min(F.least("x1", "x2")), F.min(F.least("y1", "y2")), F.max(F.greatest("x1", "x2")), F.max(F.greatest("y1", "y2"))).first()
    kept = inside(snapped_grid(source.sparkSession, minx, miny, maxx, maxy), edges)
    lon, lat = Albers().inverse("x", "y")
    placed = kept.withColumn("_lon", F.expr(lon)).withColumn("_lat", F.expr(lat))
    e, n = Utm().forward("_lon", "_lat", zone)
    placed = placed.withColumn("_e", F.expr(e)).withColumn("_n", F.expr(n))
    return warp_nearest(source, placed, (north - F.col("_n")) / size, (F.col("_e") - east) / size, values).drop("_lon", "_lat", "_e", "_n")
