"""More named queries: sources and sinks as round trips, resume, caches, mosaics, the run of fires end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderframe.functions.geo import Albers, Utm
from cinderframe.operators import analysis, catalog, raster, spectral
from cinderframe.plans import run
from cinderframe.plans.catalogue import CTES, EAST0, FIRE_FILTER, NORTH0, ORACLE_SQL, ZONE, composites, fires, histogram, matched, plots, query, selected, severity, view
from cinderframe.sources import files, geotiff, vector

YEARS_SQL = "(SELECT unnest([1997, 1998, 1999]) AS year)"
CTES["hist_years"] = f"SELECT y.year, h.bin, h.mtbs_class, h.land_cover, h.n + y.year - 1997 AS n FROM hist h, {YEARS_SQL} y"
ALBERS, UTM = Albers(), Utm()


def by_year(df, *columns):
    """df for each of three years; columns may use the year."""
    return df.withColumn("year", F.explode(F.array(*[F.lit(y) for y in (1997, 1998, 1999)]))).select("year", *columns)


@query("SELECT year, round(bin * CAST(0.05 AS DOUBLE), 10) AS cbi_bin_left, round(round(bin * CAST(0.05 AS DOUBLE), 10) + CAST(0.05 AS DOUBLE), 10) AS cbi_bin_right, mtbs_class, land_cover, CAST(n AS BIGINT) AS count FROM hist_years WHERE year IN (1997, 1999)")
def histogram_csv_roundtrip(spark, sf_dir):
    """Histograms of three years written as CSV, those of two read back."""
    path = files.work_folder(spark, "histograms")
    files.write_histograms(by_year(histogram(spark, sf_dir), "bin", "mtbs_class", "land_cover", (F.col("n") + F.col("year") - 1997).alias("n")), path)
    return files.histograms(spark, path, (1997, 1999)).select("year", "cbi_bin_left", "cbi_bin_right", "mtbs_class", "land_cover", "count")


@query("SELECT plot_id, fire_year, x, y, observed FROM plots")
def field_csv_roundtrip(spark, sf_dir):
    path = files.work_folder(spark, "plots")
    files.write_csv(plots(spark, sf_dir), path)
    return files.read_csv(spark, path, "plot_id bigint, fire_year int, x double, y double, observed double")


@query("SELECT observed AS observed_cbi, predicted AS predicted_cbi FROM matched WHERE predicted IS NOT NULL")
def pairs_csv_roundtrip(spark, sf_dir):
    path = files.work_folder(spark, "pairs")
    pairs = matched(spark, sf_dir).where("predicted is not null").select(F.col("observed").alias("observed_cbi"), F.col("predicted").alias("predicted_cbi"))
    files.write_csv(pairs, path)
    return files.read_csv(spark, path, "observed_cbi double, predicted_cbi double")


@query("SELECT count(*) AS n, min(observed) AS least, max(observed) AS most, round(avg(observed), 8) AS mean, min(fire_year) AS first_year, max(fire_year) AS last_year FROM plots")
def field_summary(spark, sf_dir):
    return files.field_summary(plots(spark, sf_dir)).withColumn("mean", F.round("mean", 8))


@query("SELECT c_custkey::BIGINT AS plot_id, CAST(c_custkey % 700 AS DOUBLE) AS x, CAST(c_custkey % 620 AS DOUBLE) AS y, CAST(c_custkey % 300 AS DOUBLE) / 100 AS cbi_observed, 1996 + c_custkey::INT % 4 AS fire_year FROM customer WHERE c_custkey % 13 <> 0")
def field_renamed(spark, sf_dir):
    """The shapefile's names to those used here; plots without a severity drop out."""
    c = F.col("c_custkey")
    raw = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        c.cast("bigint").alias("Id"), (c % 700).cast("double").alias("X"), (c % 620).cast("double").alias("Y"), F.concat((1996 + c % 4).cast("string"), F.lit("-07-01")).alias("FireDate"),
        F.when(c % 13 != 0, (c % 300).cast("double") / 100).alias("Cbi"), F.lit(0).alias("Other"),
    )
    return files.field_table(raw).select("plot_id", "x", "y", "cbi_observed", "fire_year")


@query("SELECT event_id FROM fx_fire f WHERE ordinal % 7 <> 0 OR event_id NOT IN (SELECT event_id FROM fx_fire WHERE ordinal % 7 = 0)")
def exclude_list_file(spark, sf_dir):
    """An exclude list written as text, with blank lines and spaces, read back and applied."""
    path = files.work_folder(spark, "exclude")
    f = fires(spark, sf_dir)
    lines = f.where("ordinal % 7 = 0").select(F.explode(F.array(F.concat(F.lit("  "), "event_id", F.lit(" ")), F.lit(" "), F.lit(""))).alias("value"))
    lines.write.text(path)
    return catalog.without(f, files.exclude_list(spark, path)).select("event_id")


@query("SELECT y.year, 'MT' || c.row AS event_id, c.row, c.col, c.cbi, c.cbi_bc FROM cbi_bc_px c, " + YEARS_SQL + " y WHERE y.year < 1999")
def severity_parquet_roundtrip(spark, sf_dir):
    """Severities written by year and fire, one year again, and read back."""
    path = files.work_folder(spark, "severity")
    px = by_year(severity(spark, sf_dir), F.concat(F.lit("MT"), "row").alias("event_id"), "row", "col", "cbi", "cbi_bc").where("year < 1999")
    files.write_severity(px, path)
    files.write_severity(px.where("year = 1998"), path)
    return spark.read.parquet(path).select(F.col("year").cast("int").alias("year"), "event_id", "row", "col", "cbi", "cbi_bc")


@query("SELECT DISTINCT 1997 AS year, 'MT' || row AS event_id FROM cbi_bc_px WHERE row NOT IN (SELECT row FROM cbi_bc_px WHERE row < 10 AND cbi IS NOT NULL AND cbi_bc IS NOT NULL)")
def resume_by_manifest(spark, sf_dir):
    """Fires left to do: the output holds the first ten, of which those of row 3 lack a band."""
    path = files.work_folder(spark, "resume")
    px = severity(spark, sf_dir).select(F.lit(1997).alias("year"), F.concat(F.lit("MT"), "row").alias("event_id"), "row", "col", "cbi", "cbi_bc")
    files.write_severity(px.where("row < 10"), path)
    return catalog.without(px.select("year", "event_id").distinct(), files.finished(spark, path))


@query("SELECT CASE WHEN row < 10 THEN 'MT1_CBI.tif' ELSE 'MT1_CBI_bc.tif' END AS file, row % 10 AS row, col, CAST(1000 + (col + CAST(0.5 AS DOUBLE)) * 30 AS DOUBLE) AS x, CAST(9000 - (row % 10 + CAST(0.5 AS DOUBLE)) * 30 AS DOUBLE) AS y, CAST(CAST(cbi AS FLOAT) AS DOUBLE) AS value FROM cbi_bc_px WHERE cbi IS NOT NULL AND row NOT IN (0, 10)")
def geotiff_roundtrip(spark, sf_dir):
    """Severities written as two GeoTIFFs, whose valid pixels below the first row are read back by a window."""
    px = severity(spark, sf_dir).select(F.when(F.col("row") < 10, "MT1_CBI.tif").otherwise("MT1_CBI_bc.tif").alias("file"), (F.col("row") % 10).alias("row"), "col", F.col("cbi").alias("value"))
    px = px.withColumn("x", 1000 + (F.col("col") + 0.5) * 30).withColumn("y", 9000 - (F.col("row") + 0.5) * 30)
    folder = files.work_folder(spark, "rasters")
    geotiff.register(spark)
    written = geotiff.write(px, folder, 5070).collect()
    assert all(w["error"] is None for w in written), written
    read = spark.read.format("geotiff").option("bounds", "1000,8700,1600,8970").load(folder)
    return read.where("value is not null").select("file", "row", "col", "x", "y", "value")


TARGETS = "SELECT *, regexp_extract(file, '^(.*)_CBI', 1) AS event_id FROM (SELECT '/out/' || (1996 + o_orderkey % 5) || '/' || substr('MTCAID', CAST(o_orderkey % 3 * 2 + 1 AS INT), 2) || o_orderkey || '_CBI' || CASE WHEN o_orderkey % 2 = 0 THEN '_bc' ELSE '' END || '.tif' AS path, split_part(path, '/', 4) AS file, CAST(1996 + o_orderkey % 5 AS INT) AS year, CASE WHEN o_orderkey % 2 = 0 THEN 'bc' ELSE 'raw' END AS band FROM orders)"


@query(f"SELECT path, file, year, event_id, substr(event_id, 1, 2) AS state, band FROM ({TARGETS}) WHERE band = 'bc' AND year IN (1997, 1999) AND substr(event_id, 1, 2) IN ('MT', 'CA') ORDER BY path LIMIT 50")
def target_filters(spark, sf_dir):
    """Rasters by what their names say: year, band and state; the first 50 by path."""
    k = F.col("o_orderkey")
    state = F.element_at(F.array(F.lit("MT"), F.lit("CA"), F.lit("ID")), (k % 3 + 1).cast("int"))
    path = F.concat(F.lit("/out/"), (1996 + k % 5).cast("string"), F.lit("/"), state, k.cast("string"), F.lit("_CBI"), F.when(k % 2 == 0, "_bc").otherwise(""), F.lit(".tif"))
    return files.targets(spark.read.parquet(f"{sf_dir}/orders.parquet").select(path.alias("path")), (1997, 1999), ("bc",), ("MT", "CA"), 50)


@query("SELECT row, col, band, arg_max(v, path) AS v FROM (SELECT row, col, 'raw' AS band, cbi AS v, 'a_CBI.tif' AS path FROM rf WHERE col < 12 UNION ALL SELECT row, col, 'raw', cbi + 1, 'b_CBI.tif' FROM rf WHERE col >= 8 UNION ALL SELECT row, col, 'bc', cbi, 'a_CBI_BC.TIF' FROM rf WHERE col % 2 = 0) WHERE v IS NOT NULL GROUP BY row, col, band")
def mosaic_by_band(spark, sf_dir):
    """Raw and corrected rasters, told by their names, mosaicked apart in order of path over the union of their extents."""
    s = severity(spark, sf_dir)
    piece = lambda keep, v, path: s.where(keep).select("row", "col", v.alias("v"), F.lit(f"/out/1997/{path}").alias("path"))
    px = piece("col < 12", F.col("cbi"), "a_CBI.tif").unionByName(piece("col >= 8", F.col("cbi") + 1, "b_CBI.tif")).unionByName(piece("col % 2 = 0", F.col("cbi"), "a_CBI_BC.TIF"))
    px = px.withColumn("band", files.named_parts(F.col("path"))["band"])
    return raster.mosaic_last(px, ["row", "col", "band"], "v", "path")


@query("SELECT count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses FROM (SELECT event_id % 3 = 0 AND (event_id % 5) IN (0, 1) AS hit FROM events)")
def scene_cache(spark, sf_dir):
    """Scenes cached for one grid and looked up for two."""
    path = files.work_folder(spark, "scenes")
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    # cached: a third of the scenes, under grid 0 for two of five and under another grid for the others
    held = e.where("event_id % 3 = 0").select(F.when(F.col("event_id") % 5 < 2, 0).otherwise(9).alias("grid_id"), "event_id")
    files.put_scenes(held.groupBy("grid_id", (F.col("event_id") % 30).alias("scene_id")).agg(F.count("*").alias("n")), path)
    wanted = e.select(F.lit(0).alias("grid_id"), (F.col("event_id") % 30).alias("scene_id"))
    return files.cache_counts(files.cached(wanted, spark.read.parquet(path)))


@query("SELECT lat_idx, lon_idx, def FROM def_year")
def climate_roundtrip(spark, sf_dir):
    """The annual deficit as a table of whole units, a missing cell kept as missing."""
    path = files.work_folder(spark, "climate")
    spectral.annual_deficit(view(spark, sf_dir, "fx_def_month")).withColumn("def", F.col("def").cast("int")).write.parquet(path)
    return spark.read.parquet(path).withColumn("def", F.col("def").cast("double"))


def box_sql(side: str) -> str:
    """A reprojected edge of the buffered box, from 22 points of each side."""
    t = "CAST(p.range AS DOUBLE) / 21"
    w, s, e, n = "minx - 1000", "miny - 1000", "maxx + 1000", "maxy + 1000"
    points = [(f"({w} + ({e} - ({w})) * {t})", f"({s})"), (f"({w} + ({e} - ({w})) * {t})", f"({n})"), (f"({w})", f"({s} + ({n} - ({s})) * {t})"), (f"({e})", f"({s} + ({n} - ({s})) * {t})")]
    axis, f = {"lon_w": (0, "min"), "lat_s": (1, "min"), "lon_e": (0, "max"), "lat_n": (1, "max")}[side]
    pick = "least" if f == "min" else "greatest"
    return f"round({f}({pick}({', '.join(ALBERS.inverse(x, y)[axis] for x, y in points)})), 7) AS {side}"


@query("SELECT event_id, " + ", ".join(box_sql(s) for s in ("lon_w", "lat_s", "lon_e", "lat_n")) + " FROM fx_fire, range(0, 22) p GROUP BY event_id")
def buffered_box(spark, sf_dir):
    """Fires' boxes, buffered by 1000 m, in degrees."""
    out = catalog.lon_lat_box(fires(spark, sf_dir), 1000.0)
    return out.select("event_id", *[F.round(c, 7).alias(c) for c in ("lon_w", "lat_s", "lon_e", "lat_n")])


@query("SELECT event_id, CAST(greatest(floor((minx + 2000000) / 30), 0) AS INT) AS c0, CAST(least(ceil((maxx + 2000000) / 30), 100000) AS INT) AS c1, CAST(greatest(floor((3000000 - maxy) / 30), 0) AS INT) AS r0, CAST(least(ceil((3000000 - miny) / 30), 60000) AS INT) AS r1 FROM fx_fire")
def source_window(spark, sf_dir):
    """The rows and columns of a source raster under each fire's box, within its shape."""
    return catalog.pixel_window(fires(spark, sf_dir), -2_000_000.0, 3_000_000.0, 30.0, 60_000, 100_000)


@query("SELECT event_id, CAST(year(ig_date) AS INT) AS year FROM fx_fire WHERE year(ig_date) BETWEEN 1986 AND 2020 AND year(ig_date) BETWEEN 1993 AND 2020 AND ordinal % 2 = 0")
def year_gate(spark, sf_dir):
    f = fires(spark, sf_dir).where("ordinal % 2 = 0").withColumn("year", F.year("ig_date"))
    return catalog.supported(f).where("year >= 1993").select("event_id", "year")


@query("SELECT scene_id, CAST(row_number() OVER (ORDER BY acq_date, scene_id) AS INT) AS place FROM (SELECT * FROM fx_scene WHERE cloud_cover < 5) ORDER BY acq_date, scene_id LIMIT 100")
def scenes_by_time(spark, sf_dir):
    """The first hundred clear scenes in order of time."""
    return catalog.by_time(view(spark, sf_dir, "fx_scene").where("cloud_cover < 5"), 100)


def target_sql() -> str:
    left, top, wide, high = run.extent(*run.POLYGON_BOUNDS)
    x, y = f"CAST({left} AS DOUBLE) + (c.range + CAST(0.5 AS DOUBLE)) * 30", f"CAST({top} AS DOUBLE) - (r.range + CAST(0.5 AS DOUBLE)) * 30"
    lon, lat = ALBERS.inverse("x", "y")
    e, n = UTM.forward("lon", "lat", ZONE)
    edges = f"SELECT x1 + {run.DX} AS x1, y1 + {run.DY} AS y1, x2 + {run.DX} AS x2, y2 + {run.DY} AS y2 FROM fx_edge"
    cells = f"SELECT CAST(r.range AS INT) AS row, CAST(c.range AS INT) AS col, {x} AS x, {y} AS y FROM range(0, {high}) r, range(0, {wide}) c"
    kept = f"SELECT p.row, p.col, any_value(p.x) AS x, any_value(p.y) AS y FROM ({cells}) p JOIN ({edges}) e ON (e.y1 > p.y) <> (e.y2 > p.y) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1"
    placed = f"SELECT row, col, x, y, floor((CAST({EAST0} AS DOUBLE) * -1 + {e}) / 30) AS sc, floor((CAST({NORTH0} AS DOUBLE) - {n}) / 30) AS sr FROM (SELECT *, {lon} AS lon, {lat} AS lat FROM ({kept}))"
    return f"SELECT p.row, p.col, p.x, p.y, s.cbi, s.cbi_bc FROM ({placed}) p LEFT JOIN cbi_bc_px s ON s.row = CAST(p.sr AS INT) AND s.col = CAST(p.sc AS INT)"


CTES["target_px"] = target_sql()


@query("SELECT row, col, x, y, cbi, cbi_bc FROM target_px")
def to_snapped_clip(spark, sf_dir):
    """Severities on the snapped equal-area grid, inside the fire's polygon."""
    return raster.to_snapped_clip(severity(spark, sf_dir), run.polygon(spark, sf_dir), EAST0, NORTH0, ZONE, ["cbi", "cbi_bc"])


@query(f"""SELECT event_id, year, CASE WHEN ordinal % 5 = 0 THEN 'error' ELSE 'ok' END AS status, CASE WHEN ordinal % 5 <> 0 THEN t.n_valid ELSE 0 END AS n_valid, CASE WHEN ordinal % 5 <> 0 THEN t.med END AS med, CASE WHEN ordinal % 5 <> 0 THEN t.most END AS most
FROM (SELECT event_id, CAST(year(ig_date) AS INT) AS year, ordinal FROM fx_fire JOIN season_windows ON state = upper(substr(event_id, 1, 2)) WHERE {FIRE_FILTER} AND ordinal % 7 <> 0) f, (SELECT count(cbi_bc) AS n_valid, CAST(median(cbi_bc) AS DOUBLE) AS med, max(cbi_bc) AS most FROM target_px) t""")
def fire_pipeline(spark, sf_dir):
    """The run of fires end to end: selection, exclusion, severity, projection, clip, output by fire, summary; fires that fail are told."""
    return run.run_fixture(spark, sf_dir)


@query(f"SELECT status, count(*) AS n FROM (SELECT CASE WHEN ordinal % 5 = 0 THEN 'error' ELSE 'ok' END AS status FROM (SELECT ordinal FROM fx_fire JOIN season_windows ON state = upper(substr(event_id, 1, 2)) WHERE {FIRE_FILTER} AND ordinal % 7 <> 0)) GROUP BY status")
def run_totals(spark, sf_dir):
    return analysis.run_totals(run.run_fixture(spark, sf_dir))


@query("SELECT c.row, c.col, c.cbi_bc AS cbi, CAST(round_even(m.v, 0) AS INT) AS mtbs, l.code FROM cbi_bc_px c JOIN (SELECT CAST(l_partkey % 20 AS INT) AS row, CAST(l_suppkey % 20 AS INT) AS col, avg(l_quantity) / 10 AS v FROM lineitem GROUP BY 1, 2) m ON m.row = c.row AND m.col = c.col JOIN (SELECT CAST(l_suppkey % 20 AS INT) AS row, CAST(l_partkey % 20 AS INT) AS col, CAST(year(l_shipdate) AS INT) AS year, max(l_linenumber) AS code FROM lineitem GROUP BY 1, 2, 3) l ON l.row = c.row AND l.col = c.col AND l.year = 1997 WHERE c.cbi_bc IS NOT NULL AND abs(m.v - floor(m.v) - CAST(0.5 AS DOUBLE)) > CAST(0.0001 AS DOUBLE)")
def severity_by_cover(spark, sf_dir):
    """Severity with the class (rounded to a whole number) and the land cover of the year before, on the same pixel; pixels that lack any drop out."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    p, s = (F.col("l_partkey") % 20).cast("int"), (F.col("l_suppkey") % 20).cast("int")
    classes = items.groupBy(p.alias("row"), s.alias("col")).agg((F.avg("l_quantity") / 10).alias("v"))
    classes = classes.where(F.abs(F.col("v") - F.floor("v") - 0.5) > 0.0001)
    cover = items.groupBy(s.alias("row"), p.alias("col"), F.year("l_shipdate").alias("year")).agg(F.max("l_linenumber").alias("code"))
    px = severity(spark, sf_dir).select("row", "col", F.col("cbi_bc").alias("cbi"), F.lit(1998).alias("year"))
    return analysis.with_classes(px, classes, cover).select("row", "col", "cbi", "mtbs", "code")


COMPOSITES = ("pre_nbr", "post_nbr", "pre_mirbi", "post_mirbi")


@query("SELECT count(*) AS n, " + ", ".join(f"round(avg(CASE WHEN {c} IS NULL THEN CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 8) AS {c}_missing" for c in COMPOSITES) + " FROM comp")
def composite_missing(spark, sf_dir):
    """The percentage of pixels that each composite lacks."""
    shares = spectral.missing_shares(composites(spark, sf_dir), COMPOSITES)
    return shares.select("n", *[F.round(f"{c}_missing", 8).alias(f"{c}_missing") for c in COMPOSITES])


@query("SELECT event_id, rel_year, count(*) AS n FROM (" + ORACLE_SQL["scene_search"][ORACLE_SQL["scene_search"].index("SELECT event_id, scene_id, CAST(year(acq_date)") :] + ") GROUP BY 1, 2")
def scene_counts_by_fire(spark, sf_dir):
    """How many scenes a fire has in each year around it."""
    return catalog.scene_counts(catalog.search_scenes(selected(spark, sf_dir), view(spark, sf_dir, "fx_scene")))


@query("SELECT CAST(p_partkey AS DOUBLE) AS def, CAST(p_partkey % 50 AS DOUBLE) AS lat, CAST(p_size AS DOUBLE) AS rbr, CAST(p_size * -3 AS DOUBLE) AS dmirbi, CAST(p_partkey % 7 AS DOUBLE) AS dndvi, CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_size * 10 AS DOUBLE) END AS post_mirbi, CAST(p_partkey % 300 AS DOUBLE) / 100 AS \"CBI\" FROM part")
def training_csv_roundtrip(spark, sf_dir):
    """A training table with a further column and columns in another order, written as CSV and read by name."""
    path = files.work_folder(spark, "training")
    k, size = F.col("p_partkey"), F.col("p_size").cast("double")
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        ((k % 300).cast("double") / 100).alias("CBI"), F.col("p_name").alias("note"), F.when(k % 11 != 0, size * 10).alias("post_mirbi"), (k % 7).cast("double").alias("dndvi"),
        (size * -3).alias("dmirbi"), size.alias("rbr"), (k % 50).cast("double").alias("lat"), k.cast("double").alias("def"),
    )
    files.write_csv(rows, path)
    return files.training_rows(spark, path)


@query("SELECT scene_id, CAST(acq_date AS VARCHAR) AS acq_date, cloud_cover, CAST(32600 + CAST(right(scene_id, 1) AS INT) AS INT) AS epsg, lon_w, lat_s, lon_e, lat_n, 's3://scenes/' || scene_id || '/red.tif' AS red FROM fx_scene")
def scene_json_roundtrip(spark, sf_dir):
    """Scenes written as search results, pages of JSON features, and read back; one scene in three has an empty id of its own and is known by its item's."""
    path = files.work_folder(spark, "items")
    s, known = view(spark, sf_dir, "fx_scene"), F.pmod(F.xxhash64("scene_id"), F.lit(3)) > 0
    properties = F.struct(
        F.concat(F.col("acq_date").cast("string"), F.lit("T12:00:00Z")).alias("datetime"), F.concat(F.lit("EPSG:3260"), F.substring("scene_id", -1, 1)).alias("proj:code"),
        F.col("cloud_cover").alias("eo:cloud_cover"), F.when(known, F.col("scene_id")).otherwise("").alias("landsat:scene_id"),
    )
    asset = F.create_map(F.lit("red"), F.struct(F.concat(F.lit("s3://scenes/"), "scene_id", F.lit("/red.tif")).alias("href")))
    item = F.struct(F.when(known, "item").otherwise(F.col("scene_id")).alias("id"), F.array("lon_w", "lat_s", "lon_e", "lat_n").alias("bbox"), properties.alias("properties"), asset.alias("assets"))
    # about 1,000 features a page, as searches give them
    n_pages = max(1, s.count() // 1000)
    pages = s.groupBy(F.pmod(F.xxhash64("scene_id", F.lit(1)), F.lit(n_pages)).alias("page")).agg(F.collect_list(item).alias("features"))
    pages.drop("page").write.option("maxRecordsPerFile", 1).json(path)
    read = vector.scenes(spark, path)
    return read.select("scene_id", F.date_format("acq_ts", "yyyy-MM-dd").alias("acq_date"), "cloud_cover", "epsg", "lon_w", "lat_s", "lon_e", "lat_n", F.col("assets")["red"].alias("red"))
