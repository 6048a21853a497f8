"""Analysis: joint histograms, densities, rank correlation, field plots, verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cinderframe.operators import constants as C


#: Different values at most that weighted_spearman() ranks.
MOST_VALUES = 1_000_000


def cbi_bin(v: Column, bins: int = C.CBI_BINS) -> Column:
    """0-based bin of a severity, the last one closed; NULL out of range.

    Severities are single-precision values and edges are doubles, so 0.35, which is a little less in single precision,
    falls below the edge 0.35.
    """
    low, high = C.CBI_RANGE
    v = v.cast("float").cast("double")
    return F.when(v.between(low, high), F.least(F.width_bucket(v, F.lit(low), F.lit(high), F.lit(bins)) - 1, F.lit(bins - 1)).cast("int"))


def joint_histogram(pixels: DataFrame, cover_dim: DataFrame) -> DataFrame:
    """pixels(cbi, mtbs, cover code) counted by bin, class and cover; nodata, unmapped codes and values out of range drop out."""
    named = pixels.where(F.col("mtbs").between(1, 6)).withColumn("bin", cbi_bin(F.col("cbi"))).where("bin is not null")
    return named.join(F.broadcast(cover_dim.where("cat is not null")), "code").groupBy("bin", F.col("mtbs").alias("mtbs_class"), F.col("cat").alias("land_cover")).agg(F.count("*").alias("n"))


def with_classes(pixels: DataFrame, classes: DataFrame, cover: DataFrame) -> DataFrame:
    """pixels(row, col, year, cbi) with mtbs, the class v rounded half to even, and code, the land cover of the year before.

    Pixels without a severity, a class or a cover drop out.
    """
    rounded = classes.select("row", "col", F.rint("v").cast("int").alias("mtbs"))
    before = cover.select("row", "col", (F.col("year") + 1).alias("year"), "code")
    return pixels.where("cbi is not null").join(rounded, ["row", "col"]).join(before, ["row", "col", "year"])


def dense(hist: DataFrame) -> DataFrame:
    """Every combination of bin, class and cover (2 880 rows), with 0 where nothing was counted."""
    spark = hist.sparkSession
    grid = (
        spark.range(C.CBI_BINS).select(F.col("id").cast("int").alias("bin"))
        .crossJoin(spark.createDataFrame([(k,) for k in C.SEVERITY], "mtbs_class int"))
        .crossJoin(spark.createDataFrame([(c,) for c in C.COVERS], "land_cover string"))
    )
    return grid.join(F.broadcast(hist), ["bin", "mtbs_class", "land_cover"], "left").select("bin", "mtbs_class", "land_cover", F.coalesce("n", F.lit(0)).alias("n"))


def edge_sets(rows: DataFrame, year: str, edge: str) -> DataFrame:
    """One row: how many different sets of edges the years have (1 if consistent), how many years, and the largest set."""
    by_year = rows.groupBy(year).agg(F.sort_array(F.collect_set(edge)).alias("e"))
    return by_year.agg(F.count_distinct("e").alias("edge_sets"), F.count("*").alias("years"), F.max(F.size("e")).cast("bigint").alias("most"))


def run_totals(results: DataFrame, status: str = "status") -> DataFrame:
    """How many results there are of each status, and of how many an error is told."""
    return results.groupBy(status).agg(F.count("*").alias("n"))


def rebinned(hist: DataFrame, width: float = 0.1, source: float = 0.05) -> DataFrame:
    """Counts by wider bins and class, all covers together: left is the new bin's left edge."""
    left = F.floor(F.round(F.col("bin") * source / width, 10)).cast("double") * width
    return hist.groupBy(F.round(left, 6).alias("left"), "mtbs_class").agg(F.sum("n").alias("n"))


def density(hist: DataFrame, width: float = 0.1) -> DataFrame:
    """The share of a class in each bin for a unit of severity; NULL for an empty class."""
    total = F.sum("n").over(W.partitionBy("mtbs_class"))
    return hist.withColumn("density", F.col("n") / F.nullif(total * width, F.lit(0.0)))


def pivoted(hist: DataFrame) -> DataFrame:
    """A row for each bin, a column for each class, 0 where nothing was counted."""
    wide = hist.groupBy("left").pivot("mtbs_class", list(C.SEVERITY)).agg(F.sum("n"))
    return wide.select("left", *[F.coalesce(F.col(str(k)), F.lit(0)).alias(f"class_{k}") for k in C.SEVERITY])


def weighted_spearman(cells: DataFrame, a: str, b: str, n: str) -> DataFrame:
    """Spearman's correlation of (a, b) pairs that occur n times: average ranks from running counts, no row expansion.

    Both windows run over different values, one row each, not over observations: severities and classes have some hundred
    of them. More than MOST_VALUES are refused, as a window over all of them is one task's work.
    """
    cells = cells.groupBy(a, b).agg(F.sum(n).alias(n))

    def ranks(c: str) -> DataFrame:
        v = cells.groupBy(c).agg(F.sum(n).alias("m"))
        v = v.withColumn("m", F.when(F.count("*").over(W.partitionBy()) <= MOST_VALUES, F.col("m")).otherwise(F.raise_error(F.lit("too many values to rank"))))
        return v.select(c, (F.sum("m").over(W.orderBy(c)) - F.col("m") + (F.col("m") + 1) / 2).alias(f"r_{c}"))

    r = cells.join(F.broadcast(ranks(a)), a).join(F.broadcast(ranks(b)), b).select(F.col(n).cast("double").alias("w"), F.col(f"r_{a}").alias("x"), F.col(f"r_{b}").alias("y"))
    w, mean = F.sum("w"), lambda e: F.sum(F.col("w") * e) / F.sum("w")
    x, y = F.col("x"), F.col("y")
    cov = mean(x * y) - mean(x) * mean(y)
    return r.agg((cov / F.nullif(F.sqrt((mean(x * x) - mean(x) ** 2) * (mean(y * y) - mean(y) ** 2)), F.lit(0.0))).alias("rho"), w.cast("bigint").alias("n"))


def match_plots(plots: DataFrame, tiles: DataFrame, pixels: DataFrame, size: float = 30.0) -> DataFrame:
    """plots with predicted (first covering tile, by file name, with a value at the plot) and the reason of a miss.

    tiles(file, year, minx, miny, maxx, maxy) is small metadata; pixels(file, row, col, cbi), rows down from maxy.
    """
    years = tiles.select(F.col("year").alias("fire_year")).distinct().withColumn("has_year", F.lit(True))
    cover = plots.join(F.broadcast(tiles.withColumnRenamed("year", "fire_year")), "fire_year").where(F.col("x").between(F.col("minx"), F.col("maxx")) & F.col("y").between(F.col("miny"), F.col("maxy")))
    cover = cover.select("plot_id", "file", F.floor((F.col("maxy") - F.col("y")) / size).cast("int").alias("row"), F.floor((F.col("x") - F.col("minx")) / size).cast("int").alias("col"))
    # few pixels have a plot: only their files, rows and columns are looked up
    wanted = pixels.join(cover.select("file", "row", "col").distinct(), ["file", "row", "col"], "left_semi")
    found = cover.join(wanted, ["file", "row", "col"], "left").groupBy("plot_id").agg(F.min_by("cbi", F.when(F.col("cbi").isNotNull(), F.col("file"))).alias("predicted"), F.lit(True).alias("covered"))
    reason = F.when(F.col("predicted").isNotNull(), "matched").when(F.col("covered"), "nodata").when(F.col("has_year"), "no covering tile").otherwise("no year")
    return plots.join(F.broadcast(years), "fire_year", "left").join(found, "plot_id", "left").select(*plots.columns, "predicted", reason.alias("reason"))


def fit_stats(pairs: DataFrame, observed: str = "observed", predicted: str = "predicted") -> DataFrame:
    """One row: how many complete pairs, their error, correlation and regression of observed on predicted.

    As in SQL, pairs that don't vary give 0 / 0: r and r2 are NaN if either side is constant; if predicted is, so is the
    slope, and there is no intercept. No pairs: all NULL but n.
    """
    o, p = F.col(observed), F.col(predicted)
    both = pairs.where(o.isNotNull() & p.isNotNull())
    # not F.corr: it fails on constant columns
    undefined = F.when(F.count("*") > 0, F.lit(float("nan")))
    r = F.coalesce(F.covar_pop(o, p) / F.nullif(F.stddev_pop(o) * F.stddev_pop(p), F.lit(0.0)), undefined)
    return both.agg(F.count("*").alias("n"), F.sqrt(F.avg((p - o) ** 2)).alias("rmse"), r.alias("r"), (r * r).alias("r2"), F.coalesce(F.regr_slope(o, p), undefined).alias("slope"), F.regr_intercept(o, p).alias("intercept"))


def flagged(pixels: DataFrame, value: str = "cbi") -> DataFrame:
    """pixels with reason: nodata, out-of-range, or NULL for a valid one."""
    low, high = C.CBI_RANGE
    return pixels.withColumn("reason", F.when(F.col(value).isNull(), "nodata").when(~F.col(value).between(low, high), "out-of-range"))


def verify(files: DataFrame, polygons: DataFrame, flags: DataFrame) -> DataFrame:
    """A row for each file: status and counts. flags(file, value, reason) has the file's pixels inside its polygon."""
    count = lambda r: F.count_if(F.col("reason") == r)
    sums = flags.groupBy("file").agg(F.count("*").alias("n_polygon_px"), count("nodata").alias("n_nodata"), count("out-of-range").alias("n_oor"), F.count("reason").alias("n_invalid"), F.min("value").alias("min_val"), F.max("value").alias("max_val"))
    joined = files.join(polygons.select("event_id").distinct().withColumn("known", F.lit(True)), "event_id", "left").join(sums, "file", "left")
    status = F.when(F.col("known").isNull(), "no-polygon-match").when(F.col("n_polygon_px").isNull(), "empty-polygon-mask").when(F.col("n_invalid") > 0, "invalid").otherwise("ok")
    return joined.select(*files.columns, status.alias("status"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_polygon_px", "n_nodata", "n_oor", "n_invalid")], "min_val", "max_val")


def first_invalid(flags: DataFrame, n: int = 500) -> DataFrame:
    """The first n invalid pixels of each file in row-major order."""
    order = W.partitionBy("file").orderBy("row", "col")
    return flags.where("reason is not null").withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")
