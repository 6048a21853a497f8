"""Fire catalogue: filters, derived work items, resume and scene search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cinderframe.functions.geo import Albers
from cinderframe.operators import constants as C


def season_windows(spark) -> DataFrame:
    """state, start_day, end_day: 48 rows."""
    return spark.createDataFrame(C.SEASONS, "state string, start_day int, end_day int")


def select_fires(fires: DataFrame, types: Sequence[int] = C.FIRE_TYPES, states: Sequence[str] | None = None, years: tuple[int, int] | None = None) -> DataFrame:
    """Fires of the given types, states and ignition years, with their state's season; states without one drop out."""
    found = fires.where(F.col("incid_type").isin(*types)).withColumn("state", F.upper(F.substring("event_id", 1, 2))).withColumn("year", F.year("ig_date"))
    if states:
        found = found.where(F.col("state").isin(*states))
    if years:
        found = found.where(F.col("year").between(*years))
    return found.join(F.broadcast(season_windows(fires.sparkSession)), "state")


def without(fires: DataFrame, done: DataFrame) -> DataFrame:
    """Fires whose id isn't in done: an exclude list, or the manifest of finished outputs."""
    return fires.join(done.select("event_id").distinct(), "event_id", "left_anti")


def at_index(fires: DataFrame, index: int) -> DataFrame:
    """The fire at a 0-based place in catalogue order; IndexError if there are fewer fires."""
    if index < 0:
        raise IndexError(f"place {index} is negative")
    found = fires.orderBy("ordinal").offset(index).limit(1)
    if found.isEmpty():
        raise IndexError(f"no fire at place {index}")
    return found


def by_id(fires: DataFrame, event_id: str) -> DataFrame:
    """The rows of one fire; LookupError if there are none."""
    found = fires.where(F.col("event_id") == event_id)
    if found.isEmpty():
        raise LookupError(f"no fire {event_id}")
    return found


def largest(fires: DataFrame, n: int = 10) -> DataFrame:
    """The n largest fires of each state, by acres."""
    acres = (F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny")) / C.SQUARE_METRES_PER_ACRE
    ranked = fires.select(F.upper(F.substring("event_id", 1, 2)).alias("state"), "event_id", acres.alias("acres"))
    order = W.partitionBy("state").orderBy(F.desc("acres"), "event_id")
    return ranked.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def state_bounds(fires: DataFrame, buffer: float = 50_000.0) -> DataFrame:
    """Bounds of each state's fires, buffered: what the union of the buffered perimeters spans."""
    return fires.groupBy(F.upper(F.substring("event_id", 1, 2)).alias("state")).agg(
        (F.min("minx") - buffer).alias("minx"), (F.min("miny") - buffer).alias("miny"), (F.max("maxx") + buffer).alias("maxx"), (F.max("maxy") + buffer).alias("maxy")
    )


def search_scenes(fires: DataFrame, scenes: DataFrame, max_cloud: float = C.MAX_CLOUD, drop_fire_year: bool = True) -> DataFrame:
    """(event_id, scene_id, rel_year): scenes that meet a fire's box, season and years, under the cloud limit.

    Both sides are dealt to whole-degree cells, and fires to the calendar years around them, so the range join becomes an
    equi-join on (cell, year); the exact test follows, and a pair counts in the cell of its common south-west corner only.
    """
    cells = lambda w, e: F.sequence(F.floor(w).cast("int"), F.floor(e).cast("int"))
    f = fires.withColumn("yr", F.explode(F.sequence(F.col("year") - 2, F.col("year") + 2)))
    if drop_fire_year:
        f = f.where("yr <> year")
    f = f.withColumn("cx", F.explode(cells(F.col("lon_w"), F.col("lon_e")))).withColumn("cy", F.explode(cells(F.col("lat_s"), F.col("lat_n"))))
    s = scenes.where(F.col("cloud_cover") < max_cloud).withColumn("yr", F.year("acq_date")).withColumn("doy", F.dayofyear("acq_date"))
    s = s.withColumn("cx", F.explode(cells(F.col("lon_w"), F.col("lon_e")))).withColumn("cy", F.explode(cells(F.col("lat_s"), F.col("lat_n"))))
    f, s = f.alias("f"), s.alias("s")
    meets = (F.col("s.lon_w") <= F.col("f.lon_e")) & (F.col("s.lon_e") >= F.col("f.lon_w")) & (F.col("s.lat_s") <= F.col("f.lat_n")) & (F.col("s.lat_n") >= F.col("f.lat_s"))
    once = (F.col("cx") == F.floor(F.greatest("f.lon_w", "s.lon_w"))) & (F.col("cy") == F.floor(F.greatest("f.lat_s", "s.lat_s")))
    joined = f.join(s, ["yr", "cx", "cy"]).where(meets & once & F.col("doy").between(F.col("start_day"), F.col("end_day")))
    return joined.select("event_id", "scene_id", (F.col("yr") - F.col("year")).alias("rel_year"))


def lon_lat_box(fires: DataFrame, buffer: float, points: int = 21) -> DataFrame:
    """event_id, lon_w, lat_s, lon_e, lat_n: the bounds in degrees of the fires' buffered boxes, from points along each side."""
    w, s, e, n = F.col("minx") - buffer, F.col("miny") - buffer, F.col("maxx") + buffer, F.col("maxy") + buffer
    t = F.col("i") / F.lit(float(points))
    x, y = w + (e - w) * t, s + (n - s) * t
    at = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    spread = fires.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points)))).withColumn("p", F.array(at(x, s), at(x, n), at(w, y), at(e, y)))
    spread = spread.select("event_id", F.inline("p"))
    lon, lat = (F.expr(v) for v in Albers().inverse("x", "y"))
    return spread.groupBy("event_id").agg(F.min(lon).alias("lon_w"), F.min(lat).alias("lat_s"), F.max(lon).alias("lon_e"), F.max(lat).alias("lat_n"))


def pixel_window(boxes: DataFrame, left: float, top: float, size: float, height: int, width: int) -> DataFrame:
    """event_id, c0, c1, r0, r1: the columns and rows of a raster that boxes reach, within its shape."""
    whole = lambda v, name: v.cast("int").alias(name)
    col, row = (lambda x: (F.col(x) - left) / size), (lambda y: (F.lit(top) - F.col(y)) / size)
    return boxes.select(
        "event_id", whole(F.greatest(F.floor(col("minx")), F.lit(0)), "c0"), whole(F.least(F.ceil(col("maxx")), F.lit(width)), "c1"),
        whole(F.greatest(F.floor(row("maxy")), F.lit(0)), "r0"), whole(F.least(F.ceil(row("miny")), F.lit(height)), "r1"),
    )


def supported(fires: DataFrame, years: tuple[int, int] = C.YEARS) -> DataFrame:
    """The fires of years that have scenes on both sides."""
    return fires.where(F.col("year").between(*years))


def by_time(scenes: DataFrame, n: int) -> DataFrame:
    """scene_id, place: the first n scenes by time, those without a time first; ties by id."""
    order = [F.col("acq_date").asc_nulls_first(), F.col("scene_id")]
    return scenes.orderBy(*order).limit(n).select("scene_id", F.row_number().over(W.orderBy(*order)).alias("place"))


def scene_counts(found: DataFrame) -> DataFrame:
    """search_scenes()'s rows by fire and year relative to the fire."""
    return found.groupBy("event_id", "rel_year").agg(F.count("*").alias("n"))
