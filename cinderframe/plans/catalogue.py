"""Named queries over the driver's tables, and the same in DuckDB's SQL.

The queries read fixture views (fixtures.VIEWS) and apply the engine's operators; each SQL text states the whole
computation on its own, the views inlined.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderframe.functions.geo import Albers, Utm, snapped
from cinderframe.functions.numeric import floor2, round_binary
from cinderframe.operators import analysis, catalog, raster, spectral
from cinderframe.operators import constants as C
from cinderframe.plans.fixtures import VIEWS

QUERIES: dict = {}
ORACLE_SQL: dict = {}
TABLES = "region|nation|customer|supplier|part|orders|lineitem|events"
YEAR, SEASON = 1998, (91, 258)
SPLIT = 60_000_000.0
#: Averages differ in their last digits with the order of summation: both engines round before they cut.
DIGITS = 6


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(re.sub(rf"(FROM|JOIN) ({TABLES})\b", rf"\1 parquet.`{sf_dir}/\2.parquet`", VIEWS[name]))


def query(sql: str | None = None, *ctes: str):
    """Registers a query under its function's name, with its SQL: the common table expressions it needs, then the text."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            used: dict[str, str] = {}

            def need(name: str) -> None:
                body = VIEWS.get(name) or CTES[name]
                for other in [*CTES, *VIEWS]:
                    if other != name and other not in used and re.search(rf"\b{other}\b", body):
                        need(other)
                used[name] = body

            for name in [n for n in [*VIEWS, *CTES] if re.search(rf"\b{n}\b", sql)]:
                if name not in used:
                    need(name)
            ORACLE_SQL[f.__name__] = ("WITH " + ",\n".join(f"{k} AS ({v})" for k, v in used.items()) + "\n" if used else "") + sql
        return f

    return register


def trunc_sql(x: str) -> str:
    return f"CAST(sign({x}) * floor(abs(round(({x}), 6))) AS DOUBLE)"


WINDOWS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{s}', {a}, {b})" for s, a, b in C.SEASONS) + ") AS t(state, start_day, end_day)"
ALBERS, UTM = Albers(), Utm()
#: Where the fixture grid lies: easting and northing of its upper left corner in UTM zone 11, and its pixel size (wide, so that latitudes differ).
EAST0, NORTH0, ZONE, STEP = 677510.0, 5135300.0, "11", 20000.0
LAT_SQL = UTM.inverse(f"CAST({EAST0} AS DOUBLE) + (col + CAST(0.5 AS DOUBLE)) * CAST({STEP} AS DOUBLE)", f"CAST({NORTH0} AS DOUBLE) - (row + CAST(0.5 AS DOUBLE)) * CAST({STEP} AS DOUBLE)", ZONE)[1]
REFLECT = lambda b, n: f"CASE WHEN (qa_pixel & 187) = 0 THEN dn_{b} * CAST(0.0000275 AS DOUBLE) - CAST(0.2 AS DOUBLE) END AS {n}"
MEAN = lambda n, a, b: f"coalesce(avg(CASE WHEN yr = {a} THEN {n} END), avg(CASE WHEN yr IN ({a}, {b}) THEN {n} END))"

CTES = {
    "season_windows": WINDOWS_SQL,
    "refl": "SELECT row, col, yr, doy, cloud_cover, " + ", ".join(REFLECT(*x) for x in (("blue", "blue"), ("green", "green"), ("red", "red"), ("nir08", "nir"), ("swir16", "sw1"), ("swir22", "sw2"))) + " FROM fx_obs",
    "idx": "SELECT row, col, yr, doy, cloud_cover, (nir - sw2) / (nir + sw2) AS nbr, (nir - red) / (nir + red) AS ndvi, (nir - sw1) / (nir + sw1) AS ndmi, CAST(2.5 AS DOUBLE) * (nir - red) / (nir + 6 * red - CAST(7.5 AS DOUBLE) * blue + 1) AS evi, 10 * sw1 - CAST(9.8 AS DOUBLE) * sw2 + 2 AS mirbi FROM refl",
    "comp": f"SELECT row, col, {', '.join(f'{MEAN(n, a, b)} AS {s}_{n}' for s, a, b in (('pre', YEAR - 1, YEAR - 2), ('post', YEAR + 1, YEAR + 2)) for n in ('nbr', 'ndvi', 'mirbi'))} FROM idx WHERE doy BETWEEN {SEASON[0]} AND {SEASON[1]} AND cloud_cover < 80 AND yr BETWEEN {YEAR - 2} AND {YEAR + 2} AND yr <> {YEAR} GROUP BY row, col",
    "def_year": "SELECT lat_idx, lon_idx, CASE WHEN count(def) = 12 THEN CAST(floor(round(sum(def), 6)) AS DOUBLE) END AS def FROM fx_def_month GROUP BY lat_idx, lon_idx",
    "pred0": f"SELECT row, col, pre_nbr, {trunc_sql('(pre_nbr - post_nbr) * 1000')} AS dnbr, {trunc_sql('(pre_ndvi - post_ndvi) * 1000')} AS dndvi, {trunc_sql('(pre_mirbi - post_mirbi) * 1000')} AS dmirbi, {trunc_sql('post_mirbi * 1000')} AS post_mirbi FROM comp",
    "pred": f"SELECT p.row, p.col, dnbr, {trunc_sql('dnbr / (pre_nbr + CAST(1.001 AS DOUBLE))')} AS rbr, dndvi, dmirbi, post_mirbi, d.def, CAST(round_even({LAT_SQL.replace('col', 'p.col').replace('(row', '(p.row')}, 0) AS DOUBLE) AS lat FROM pred0 p LEFT JOIN def_year d ON d.lat_idx = CAST(floor(p.row / 5) AS INT) AND d.lon_idx = CAST(floor(p.col / 5) AS INT)",
    "rf": """SELECT row, col, CASE WHEN rbr IS NOT NULL AND dmirbi IS NOT NULL AND dndvi IS NOT NULL AND post_mirbi IS NOT NULL AND def IS NOT NULL AND lat IS NOT NULL THEN
  floor(round(((CASE WHEN rbr <= 100 THEN CAST(0.4 AS DOUBLE) WHEN dmirbi <= -500 THEN CAST(2.9 AS DOUBLE) ELSE CAST(1.7 AS DOUBLE) END) + (CASE WHEN post_mirbi <= 1500 THEN CAST(0.8 AS DOUBLE) ELSE CAST(2.2 AS DOUBLE) END) + (CASE WHEN dndvi <= 50 THEN CAST(0.9 AS DOUBLE) ELSE CAST(2.6 AS DOUBLE) END)) / 3 * 100, 6)) / 100 END AS cbi FROM pred""",
    "cbi_bc_px": "SELECT row, col, cbi, floor(round(CASE WHEN cbi IS NOT NULL THEN least(greatest(CASE WHEN cbi <= 1.5 THEN (cbi - CAST(1.5 AS DOUBLE)) * CAST(1.3 AS DOUBLE) + CAST(1.5 AS DOUBLE) ELSE (cbi - CAST(1.5 AS DOUBLE)) * CAST(1.175 AS DOUBLE) + CAST(1.5 AS DOUBLE) END, 0), 3) END * 100, 6)) / 100 AS cbi_bc FROM rf",
    "hist": "SELECT CAST(least(floor(CAST(CAST(cbi_bc AS FLOAT) AS DOUBLE) * 20), 59) AS INT) AS bin, mtbs AS mtbs_class, cat AS land_cover, count(*) AS n FROM (SELECT cbi_bc, CAST((row * 7 + col * 3) % 7 AS INT) AS mtbs, CAST((row * 5 + col * 11) % 17 AS INT) AS idx FROM cbi_bc_px) p JOIN fx_nlcd_dim d ON p.idx = d.idx WHERE mtbs BETWEEN 1 AND 6 AND cat IS NOT NULL AND cbi_bc BETWEEN 0 AND 3 GROUP BY 1, 2, 3",
    "hist10": "SELECT round(floor(round(bin * CAST(0.05 AS DOUBLE) / CAST(0.1 AS DOUBLE), 10)) * CAST(0.1 AS DOUBLE), 6) AS lft, mtbs_class, CAST(sum(n) AS BIGINT) AS n FROM hist GROUP BY 1, 2",
    "plots": "SELECT plot_id, fire_year, x, y, TRY_CAST(cbi_x100 AS DOUBLE) / 100 AS observed FROM fx_field_raw WHERE TRY_CAST(cbi_x100 AS DOUBLE) IS NOT NULL",
    "tiles": "SELECT * FROM (VALUES ('a', 1997, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(600 AS DOUBLE), CAST(600 AS DOUBLE)), ('b', 1997, CAST(300 AS DOUBLE), CAST(0 AS DOUBLE), CAST(900 AS DOUBLE), CAST(600 AS DOUBLE)), ('c', 1998, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(600 AS DOUBLE), CAST(600 AS DOUBLE)), ('d', 1999, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(600 AS DOUBLE), CAST(600 AS DOUBLE))) AS t(file, year, minx, miny, maxx, maxy)",
    "matched": """SELECT p.plot_id, p.fire_year, p.observed, m.predicted, CASE WHEN m.predicted IS NOT NULL THEN 'matched' WHEN m.plot_id IS NOT NULL THEN 'nodata' WHEN p.fire_year IN (SELECT year FROM tiles) THEN 'no covering tile' ELSE 'no year' END AS reason
FROM plots p LEFT JOIN (SELECT q.plot_id, min_by(c.cbi_bc, CASE WHEN c.cbi_bc IS NOT NULL THEN t.file END) AS predicted FROM plots q JOIN tiles t ON t.year = q.fire_year AND q.x BETWEEN minx AND maxx AND q.y BETWEEN miny AND maxy
LEFT JOIN cbi_bc_px c ON c.row = CAST(floor((maxy - q.y) / 30) AS INT) AND c.col = CAST(floor((q.x - minx) / 30) AS INT) AND NOT (t.file = 'a' AND c.col >= 10) GROUP BY q.plot_id) m ON p.plot_id = m.plot_id""",
    "in_poly": "SELECT row, col FROM (SELECT p.row, p.col, count(*) AS k FROM (SELECT r.range AS row, c.range AS col, CAST(30 * c.range + 15 AS DOUBLE) AS px, CAST(30 * r.range + 15 AS DOUBLE) AS py FROM range(0, 20) r, range(0, 20) c) p JOIN fx_edge e ON (e.y1 > py) <> (e.y2 > py) AND px < (e.x2 - e.x1) * (py - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1 GROUP BY 1, 2) WHERE k % 2 = 1",
    "files": "SELECT * FROM (VALUES ('F1', 'f1.tif'), ('F2', 'f2.tif'), ('F9', 'f9.tif')) AS t(event_id, file)",
    "flags": "SELECT 'f1.tif' AS file, p.row, p.col, c.cbi_bc * CASE WHEN (p.row + p.col) % 7 = 0 THEN 2 ELSE 1 END AS value FROM in_poly p LEFT JOIN cbi_bc_px c ON c.row = p.row AND c.col = p.col",
    "flagged": "SELECT *, CASE WHEN value IS NULL THEN 'nodata' WHEN value < 0 OR value > 3 THEN 'out-of-range' END AS reason FROM flags",
}


# ---- catalogue


def fires(spark, sf_dir):
    return view(spark, sf_dir, "fx_fire")


def selected(spark, sf_dir):
    return catalog.select_fires(fires(spark, sf_dir), states=("CA", "OR", "TX", "FL", "MT", "AK"), years=(1993, 1997))


FIRE_FILTER = "incid_type IN (0, 1, 3) AND upper(substr(event_id, 1, 2)) IN ('CA', 'OR', 'TX', 'FL', 'MT', 'AK') AND year(ig_date) BETWEEN 1993 AND 1997"


@query(f"SELECT event_id, state, CAST(year(ig_date) AS INT) AS year, start_day, end_day FROM fx_fire JOIN season_windows ON state = upper(substr(event_id, 1, 2)) WHERE {FIRE_FILTER}")
def fire_catalog_filter(spark, sf_dir):
    return selected(spark, sf_dir).select("event_id", "state", "year", "start_day", "end_day")


@query("SELECT event_id FROM fx_fire f WHERE NOT EXISTS (SELECT 1 FROM fx_fire d WHERE d.ordinal % 7 = 0 AND d.event_id = f.event_id)")
def fire_exclude_anti(spark, sf_dir):
    f = fires(spark, sf_dir)
    return catalog.without(f, f.where("ordinal % 7 = 0")).select("event_id")


@query("SELECT state, event_id, round(acres, 6) AS acres, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY state ORDER BY acres DESC, event_id) AS INT) AS place FROM (SELECT upper(substr(event_id, 1, 2)) AS state, event_id, (maxx - minx) * (maxy - miny) / CAST(4046.8564224 AS DOUBLE) AS acres FROM fx_fire)) WHERE place <= 10")
def fire_topk_by_state(spark, sf_dir):
    return catalog.largest(fires(spark, sf_dir)).withColumn("acres", F.round("acres", 6))


@query("SELECT event_id, ordinal FROM fx_fire WHERE incid_type = 1 ORDER BY ordinal LIMIT 1 OFFSET 5")
def fire_by_index(spark, sf_dir):
    return catalog.at_index(fires(spark, sf_dir).where("incid_type = 1"), 5).select("event_id", "ordinal")


@query("SELECT event_id, ordinal, (maxx - minx) * (maxy - miny) AS area_m2 FROM fx_fire WHERE ordinal IN (1, 2, 3, 32, 33, 100)")
def perimeter_id_lookup(spark, sf_dir):
    fires(spark, sf_dir).createOrReplaceTempView("cinderframe_perimeters")
    return spark.sql("SELECT event_id, ordinal, (maxx - minx) * (maxy - miny) AS area_m2 FROM cinderframe_perimeters WHERE ordinal IN (1, 2, 3, 32, 33, 100)")


@query("SELECT substr(event_id, 1, 2) AS state, min(minx) - 50000 AS minx, min(miny) - 50000 AS miny, max(maxx) + 50000 AS maxx, max(maxy) + 50000 AS maxy FROM fx_fire GROUP BY 1")
def state_bbox(spark, sf_dir):
    return catalog.state_bounds(fires(spark, sf_dir))


# ---- projections and grids


@query(f"SELECT event_id, {Utm.epsg('lon_w', 'lat_s')} AS epsg FROM fx_fire")
def utm_zone(spark, sf_dir):
    return fires(spark, sf_dir).select("event_id", F.expr(Utm.epsg("lon_w", "lat_s")).alias("epsg"))


def corners(lon_lat: str):
    """Eastings and northings, in the west side's zone, of the corners of a fire's box."""
    zone = f"(CAST(floor((({lon_lat}) + 180) / 6) AS INT) + 1)"
    return [UTM.forward(x, y, zone) for x in ("lon_w", "lon_e") for y in ("lat_s", "lat_n")]


GRID_SQL = {
    "x0": "floor(round(least(" + ", ".join(c[0] for c in corners("lon_w")) + ") / 30, 6)) * 30",
    "x1": "ceil(round(greatest(" + ", ".join(c[0] for c in corners("lon_w")) + ") / 30, 6)) * 30",
    "y0": "floor(round(least(" + ", ".join(c[1] for c in corners("lon_w")) + ") / 30, 6)) * 30",
    "y1": "ceil(round(greatest(" + ", ".join(c[1] for c in corners("lon_w")) + ") / 30, 6)) * 30",
}


@query("SELECT event_id, CAST(x0 AS BIGINT) AS x0, CAST(y1 AS BIGINT) AS y0, CAST((x1 - x0) / 30 AS INT) AS w, CAST((y1 - y0) / 30 AS INT) AS h FROM (SELECT event_id, " + ", ".join(f"{v} AS {k}" for k, v in GRID_SQL.items()) + " FROM fx_fire)")
def fire_grid(spark, sf_dir):
    g = fires(spark, sf_dir).select("event_id", *[F.expr(v).alias(k) for k, v in GRID_SQL.items()])
    return g.select("event_id", F.col("x0").cast("bigint").alias("x0"), F.col("y1").cast("bigint").alias("y0"), ((F.col("x1") - F.col("x0")) / 30).cast("int").alias("w"), ((F.col("y1") - F.col("y0")) / 30).cast("int").alias("h"))


SNAPPED = snapped("minx", "miny", "maxx", "maxy")


@query("SELECT event_id, " + ", ".join(f"CAST({v} AS {'INT' if k in ('width', 'height') else 'DOUBLE'}) AS {k}" for k, v in SNAPPED.items()) + " FROM fx_fire")
def snap_5070(spark, sf_dir):
    return fires(spark, sf_dir).select("event_id", *[F.expr(v).cast("int" if k in ("width", "height") else "double").alias(k) for k, v in SNAPPED.items()])


def projected(name: str, pair: tuple[str, str], a: str, b: str, digits: int, table: str = "fx_fire", key: str = "event_id"):
    sql = f"SELECT {key}, round({pair[0]}, {digits}) AS {a}, round({pair[1]}, {digits}) AS {b} FROM {table}"

    def run(spark, sf_dir):
        return view(spark, sf_dir, table).select(key, F.round(F.expr(pair[0]), digits).alias(a), F.round(F.expr(pair[1]), digits).alias(b))

    run.__name__ = name
    return query(sql)(run)


projected("albers_forward", ALBERS.forward("lon_w", "lat_s"), "x", "y", 3)
projected("albers_inverse", ALBERS.inverse("minx", "miny"), "lon", "lat", 7)
projected("utm_inverse_lat", UTM.inverse("(500000 + minx / 20)", "(4000000 + miny / 4)", ZONE), "lon", "lat", 7)


# ---- scenes


@query(f"""SELECT event_id, scene_id, CAST(year(acq_date) - year(ig_date) AS INT) AS rel_year FROM fx_fire f JOIN season_windows ON state = upper(substr(event_id, 1, 2))
JOIN fx_scene s ON s.lon_w <= f.lon_e AND s.lon_e >= f.lon_w AND s.lat_s <= f.lat_n AND s.lat_n >= f.lat_s AND s.cloud_cover < 80 AND year(acq_date) BETWEEN year(ig_date) - 2 AND year(ig_date) + 2
 AND year(acq_date) <> year(ig_date) AND dayofyear(acq_date) BETWEEN start_day AND end_day WHERE {FIRE_FILTER}""")
def scene_search(spark, sf_dir):
    return catalog.search_scenes(selected(spark, sf_dir), view(spark, sf_dir, "fx_scene"))


@query("SELECT CAST(year(acq_date) AS INT) AS yr, count(*) AS n, sum(CASE WHEN cloud_cover < 80 THEN 1 ELSE 0 END)::BIGINT AS n_usable FROM fx_scene GROUP BY 1")
def scene_year_counts(spark, sf_dir):
    return view(spark, sf_dir, "fx_scene").groupBy(F.year("acq_date").alias("yr")).agg(F.count("*").alias("n"), F.count_if(F.col("cloud_cover") < C.MAX_CLOUD).alias("n_usable"))


@query("SELECT row, col, yr FROM fx_obs WHERE yr = 1997 UNION ALL SELECT row, col, yr FROM fx_obs WHERE yr = 1999")
def scene_union(spark, sf_dir):
    o = view(spark, sf_dir, "fx_obs").select("row", "col", "yr")
    return o.where("yr = 1997").unionByName(o.where("yr = 1999"))


@query("SELECT CAST(year(o_orderdate) AS INT) AS yr FROM orders INTERSECT SELECT CAST(year(l_shipdate) AS INT) FROM lineitem")
def years_intersection(spark, sf_dir):
    read = lambda t, c: spark.read.parquet(f"{sf_dir}/{t}.parquet").select(F.year(c).alias("yr"))
    return read("orders", "o_orderdate").intersect(read("lineitem", "l_shipdate"))


# ---- pixels


def observations(spark, sf_dir, bands=("red", "nir08", "swir16", "swir22")):
    return spectral.with_reflectance(view(spark, sf_dir, "fx_obs"), bands)


@query("SELECT row, col, yr, doy, round(blue, 8) AS blue, round(green, 8) AS green, round(red, 8) AS red, round(nir, 8) AS nir08, round(sw1, 8) AS swir16, round(sw2, 8) AS swir22 FROM refl")
def obs_reflectance_qa(spark, sf_dir):
    bands = ("blue", "green", "red", "nir08", "swir16", "swir22")
    return observations(spark, sf_dir, bands).select("row", "col", "yr", "doy", *[F.round(b, 8).alias(b) for b in bands])


@query("SELECT row, col, yr, round(nbr, 8) AS nbr, round(ndvi, 8) AS ndvi, round(ndmi, 8) AS ndmi, round(evi, 8) AS evi, round(mirbi, 8) AS mirbi FROM idx WHERE nbr IS NOT NULL")
def spectral_indices(spark, sf_dir):
    names = ("nbr", "ndvi", "ndmi", "evi", "mirbi")
    # the pixels without an index are told by their quality bits and bands, before anything is computed
    usable = spectral.is_clear(F.col("qa_pixel")) & F.col("dn_nir08").isNotNull() & F.col("dn_swir22").isNotNull()
    o = spectral.with_reflectance(view(spark, sf_dir, "fx_obs").where(usable), ("blue", "red", "nir08", "swir16", "swir22"))
    o = o.where("not (nir08 = 0 and swir22 = 0)").select("row", "col", "yr", *spectral.indices(names))
    return o.select("row", "col", "yr", *[round_binary(F.col(n), 8).alias(n) for n in names])


def composites(spark, sf_dir):
    o = spectral.season(observations(spark, sf_dir), *SEASON)
    return spectral.composite(o.select("row", "col", "yr", *spectral.indices(("nbr", "ndvi", "mirbi"))), YEAR)


@query(f"SELECT row, col, round(pre_nbr, 12) AS pre_nbr, round(post_nbr, 12) AS post_nbr, round(pre_ndvi, 12) AS pre_ndvi, round(post_ndvi, 12) AS post_ndvi, round(pre_mirbi, 12) AS pre_mirbi, round(post_mirbi, 12) AS post_mirbi, {trunc_sql('(pre_nbr - post_nbr) * 1000')} AS dnbr FROM comp WHERE pre_nbr IS NOT NULL AND post_nbr IS NOT NULL")
def composite_pre_post(spark, sf_dir):
    c = composites(spark, sf_dir).where("pre_nbr is not null and post_nbr is not null")
    names = ["pre_nbr", "post_nbr", "pre_ndvi", "post_ndvi", "pre_mirbi", "post_mirbi"]
    return c.select("row", "col", *[F.round(n, 12).alias(n) for n in names], spectral.trunc_scaled(F.col("pre_nbr") - F.col("post_nbr"), digits=DIGITS).alias("dnbr"))


@query("SELECT lat_idx, lon_idx, def FROM def_year")
def annual_def(spark, sf_dir):
    return spectral.annual_deficit(view(spark, sf_dir, "fx_def_month"))


def stack(spark, sf_dir):
    climate = spectral.annual_deficit(view(spark, sf_dir, "fx_def_month"))
    p = spectral.predictors(composites(spark, sf_dir), DIGITS)
    # the climate grid is 16 cells here and 0.9 million at most in full: four bytes a cell
    p = p.withColumn("lat_idx", F.floor(F.col("row") / 5).cast("int")).withColumn("lon_idx", F.floor(F.col("col") / 5).cast("int")).join(F.broadcast(climate), ["lat_idx", "lon_idx"], "left")
    return p.withColumn("lat", F.bround(F.expr(LAT_SQL), 0)).select("row", "col", "dnbr", "rbr", "dndvi", "dmirbi", "post_mirbi", "def", "lat")


@query("SELECT row, col, dnbr, rbr, dndvi, dmirbi, post_mirbi, def, lat FROM pred")
def predictor_stack(spark, sf_dir):
    return stack(spark, sf_dir)


def severity(spark, sf_dir):
    return spectral.score(stack(spark, sf_dir), spectral.Forest(view(spark, sf_dir, "fx_forest").toPandas()), DIGITS)


@query("SELECT row, col, cbi FROM rf")
def rf_predict(spark, sf_dir):
    return severity(spark, sf_dir).select("row", "col", "cbi")


@query("SELECT row, col, cbi, cbi_bc FROM cbi_bc_px")
def bias_correct(spark, sf_dir):
    return severity(spark, sf_dir).select("row", "col", "cbi", "cbi_bc")


@query("SELECT count(cbi) AS n, CAST(median(cbi) AS DOUBLE) AS med, max(cbi) AS most FROM cbi_bc_px")
def cbi_fire_summary(spark, sf_dir):
    return severity(spark, sf_dir).agg(F.count("cbi").alias("n"), F.median("cbi").alias("med"), F.max("cbi").alias("most"))


def grid(spark, h=20, w=20):
    return spark.range(h).select(F.col("id").cast("int").alias("row")).crossJoin(spark.range(w).select(F.col("id").cast("int").alias("col")))


@query("SELECT CAST(g.row AS INT) AS row, CAST(g.col AS INT) AS col, c.cbi_bc FROM (SELECT r.range AS row, k.range AS col FROM range(0, 15) r, range(0, 15) k) g LEFT JOIN cbi_bc_px c ON c.row = CAST(floor((g.row + CAST(0.5 AS DOUBLE)) * CAST(1.3 AS DOUBLE)) AS INT) AND c.col = CAST(floor((g.col + CAST(0.5 AS DOUBLE)) * CAST(1.3 AS DOUBLE)) AS INT)")
def warp_nearest(spark, sf_dir):
    return raster.warp_nearest(severity(spark, sf_dir), grid(spark, 15, 15), (F.col("row") + 0.5) * 1.3, (F.col("col") + 0.5) * 1.3, ["cbi_bc"])


@query("""SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col, round(sum(w * v) / nullif(sum(CASE WHEN v IS NOT NULL THEN w END), 0), 6) AS cbi_bc FROM (
SELECT g.row, g.col, (1 - abs(a.range - (fr - floor(fr)))) * (1 - abs(b.range - (fc - floor(fc)))) AS w, c.cbi_bc AS v
FROM (SELECT r.range AS row, k.range AS col, (r.range + CAST(0.5 AS DOUBLE)) * CAST(1.3 AS DOUBLE) - CAST(0.5 AS DOUBLE) AS fr, (k.range + CAST(0.5 AS DOUBLE)) * CAST(1.3 AS DOUBLE) - CAST(0.5 AS DOUBLE) AS fc FROM range(0, 15) r, range(0, 15) k) g
CROSS JOIN range(0, 2) a CROSS JOIN range(0, 2) b LEFT JOIN cbi_bc_px c ON c.row = CAST(floor(fr) + a.range AS INT) AND c.col = CAST(floor(fc) + b.range AS INT)) GROUP BY 1, 2""")
def warp_bilinear(spark, sf_dir):
    out = raster.warp_bilinear(severity(spark, sf_dir), grid(spark, 15, 15), (F.col("row") + 0.5) * 1.3, (F.col("col") + 0.5) * 1.3, "cbi_bc")
    return out.withColumn("cbi_bc", F.round("cbi_bc", 6))


def in_polygon(spark, sf_dir):
    g = grid(spark).withColumn("x", raster.centre(F.col("col"))).withColumn("y", raster.centre(F.col("row")))
    return raster.inside(g, view(spark, sf_dir, "fx_edge")).select("row", "col")


@query("SELECT CAST(p.row AS INT) AS row, CAST(p.col AS INT) AS col, c.cbi_bc FROM in_poly p LEFT JOIN cbi_bc_px c ON c.row = p.row AND c.col = p.col")
def polygon_clip(spark, sf_dir):
    return in_polygon(spark, sf_dir).join(severity(spark, sf_dir).select("row", "col", "cbi_bc"), ["row", "col"], "left")


@query("SELECT 'fx' AS event_id, abs(sum(x1 * y2 - x2 * y1)) / 2 AS area, min(x1) AS minx, min(y1) AS miny, max(x1) AS maxx, max(y1) AS maxy FROM fx_edge")
def polygon_area_bounds(spark, sf_dir):
    return raster.area_and_bounds(view(spark, sf_dir, "fx_edge").withColumn("event_id", F.lit("fx")), "event_id")


@query(f"""SELECT event_id, count(*) AS pieces, round(sum((maxx - minx) * (maxy - miny)), 3) AS area, round(max((maxx - minx) * (maxy - miny)), 3) AS largest FROM (
WITH RECURSIVE s AS (SELECT event_id, minx, miny, maxx, maxy FROM fx_fire UNION ALL
SELECT event_id, CASE WHEN wide AND k = 1 THEN mx ELSE minx END, CASE WHEN NOT wide AND k = 1 THEN my ELSE miny END, CASE WHEN wide AND k = 0 THEN mx ELSE maxx END, CASE WHEN NOT wide AND k = 0 THEN my ELSE maxy END
FROM (SELECT *, maxx - minx >= maxy - miny AS wide, (minx + maxx) / 2 AS mx, (miny + maxy) / 2 AS my, unnest([0, 1]) AS k FROM s WHERE (maxx - minx) * (maxy - miny) > {SPLIT}))
SELECT * FROM s WHERE (maxx - minx) * (maxy - miny) <= {SPLIT}) GROUP BY event_id""")
def split_polygon_boxes(spark, sf_dir):
    pieces = raster.split_boxes(fires(spark, sf_dir), SPLIT)
    return pieces.groupBy("event_id").agg(F.count("*").alias("pieces"), F.round(F.sum("area"), 3).alias("area"), F.round(F.max("area"), 3).alias("largest"))


def pieces(spark, sf_dir):
    """Overlapping pieces: piece 0 holds columns below 12, piece 1 those from 8 on, its values raised."""
    s = severity(spark, sf_dir)
    return s.where("col < 12").select("row", "col", F.when((F.col("row") + F.col("col")) % 3 != 0, F.col("cbi")).alias("v"), F.lit(0).alias("piece")).unionByName(
        s.where("col >= 8").select("row", "col", (F.col("cbi") + 1).alias("v"), F.lit(1).alias("piece"))
    )


PIECES = "(SELECT row, col, CASE WHEN (row + col) % 3 <> 0 THEN cbi END AS v, 0 AS piece FROM rf WHERE col < 12 UNION ALL SELECT row, col, cbi + 1, 1 FROM rf WHERE col >= 8)"


@query(f"SELECT row, col, arg_min(v, piece) AS v FROM {PIECES} WHERE v IS NOT NULL GROUP BY row, col")
def merge_first_valid(spark, sf_dir):
    return raster.merge_first(pieces(spark, sf_dir), ["row", "col"], "v", "piece")


@query(f"SELECT row, col, arg_max(v, piece) AS v FROM {PIECES} WHERE v IS NOT NULL GROUP BY row, col")
def mosaic_last_wins(spark, sf_dir):
    return raster.mosaic_last(pieces(spark, sf_dir), ["row", "col"], "v", "piece")


# ---- analysis


def histogram(spark, sf_dir):
    p = severity(spark, sf_dir).select(F.col("cbi_bc").alias("cbi"), ((F.col("row") * 7 + F.col("col") * 3) % 7).alias("mtbs"), ((F.col("row") * 5 + F.col("col") * 11) % 17).cast("int").alias("idx"))
    dim = view(spark, sf_dir, "fx_nlcd_dim")
    return analysis.joint_histogram(p.join(F.broadcast(dim.select("idx", "code")), "idx"), dim.select("code", "cat"))


@query("SELECT bin, mtbs_class, land_cover, n FROM hist")
def joint_histogram(spark, sf_dir):
    return histogram(spark, sf_dir)


@query("SELECT CAST(b.range AS INT) AS bin, CAST(m.range AS INT) AS mtbs_class, l.c AS land_cover, coalesce(h.n, 0) AS n FROM range(0, 60) b CROSS JOIN range(1, 7) m CROSS JOIN (SELECT unnest(['" + "', '".join(C.COVERS) + "']) AS c) l LEFT JOIN hist h ON h.bin = b.range AND h.mtbs_class = m.range AND h.land_cover = l.c")
def joint_histogram_dense(spark, sf_dir):
    return analysis.dense(histogram(spark, sf_dir))


@query("SELECT lft, mtbs_class, n, round(n / (sum(n) OVER (PARTITION BY mtbs_class) * CAST(0.1 AS DOUBLE)), 6) AS density FROM hist10")
def hist_rebin_pdf(spark, sf_dir):
    return analysis.density(analysis.rebinned(histogram(spark, sf_dir))).select(F.col("left").alias("lft"), "mtbs_class", "n", F.round("density", 6).alias("density"))


@query("SELECT lft, " + ", ".join(f"CAST(sum(CASE WHEN mtbs_class = {k} THEN n ELSE 0 END) AS BIGINT) AS class_{k}" for k in C.SEVERITY) + " FROM hist10 GROUP BY lft")
def hist_pivot(spark, sf_dir):
    return analysis.pivoted(analysis.rebinned(histogram(spark, sf_dir))).withColumnRenamed("left", "lft")


@query("SELECT count(DISTINCT e) AS edge_sets, count(*) AS years, max(len(e)) AS most FROM (SELECT yr, list(DISTINCT b ORDER BY b) AS e FROM (SELECT CAST(year(l_shipdate) AS INT) AS yr, CAST(l_quantity AS INT) % 7 AS b FROM lineitem WHERE l_linenumber = 1 OR year(l_shipdate) > 1992) WHERE NOT (yr = 1995 AND b = 3) GROUP BY yr)")
def hist_edge_consistency(spark, sf_dir):
    """Years whose sets of bins differ are told: 1995 lacks one."""
    d = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_linenumber = 1 or year(l_shipdate) > 1992")
    d = d.select(F.year("l_shipdate").alias("yr"), (F.col("l_quantity").cast("int") % 7).alias("b")).where("not (yr = 1995 and b = 3)")
    return analysis.edge_sets(d, "yr", "b")


@query("""SELECT round(corr(rx, ry), 6) AS rho, count(*) AS n FROM (SELECT (rank() OVER (ORDER BY lft) + (count(*) OVER (PARTITION BY lft) - 1) / CAST(2 AS DOUBLE)) AS rx, (rank() OVER (ORDER BY mtbs_class) + (count(*) OVER (PARTITION BY mtbs_class) - 1) / CAST(2 AS DOUBLE)) AS ry
FROM (SELECT lft, mtbs_class, unnest(range(0, n)) AS i FROM hist10 WHERE mtbs_class <= 4))""")
def spearman_weighted(spark, sf_dir):
    cells = analysis.rebinned(histogram(spark, sf_dir)).where(F.col("mtbs_class").isin(1, 2, 3, 4))
    return analysis.weighted_spearman(cells, "left", "mtbs_class", "n").select(F.round("rho", 6).alias("rho"), "n")


@query("SELECT 'include' AS side, CAST(sum(n) AS BIGINT) AS n FROM hist WHERE land_cover = 'Forest' AND mtbs_class <= 4 UNION ALL SELECT 'exclude', CAST(sum(n) AS BIGINT) FROM hist WHERE land_cover <> 'Forest' AND mtbs_class <= 4")
def landcover_include_exclude(spark, sf_dir):
    h = histogram(spark, sf_dir).where(F.col("mtbs_class").isin(1, 2, 3, 4))
    side = lambda name, keep: h.where(keep).agg(F.lit(name).alias("side"), F.sum("n").alias("n"))
    return side("include", F.col("land_cover") == "Forest").unionByName(side("exclude", F.col("land_cover") != "Forest"))


def plots(spark, sf_dir):
    raw = view(spark, sf_dir, "fx_field_raw").withColumn("observed", F.try_divide(F.expr("try_cast(cbi_x100 AS double)"), F.lit(100.0)))
    return raw.na.drop(subset=["observed"]).select("plot_id", "fire_year", "x", "y", "observed")


@query("SELECT plot_id, fire_year, x, y, observed FROM plots")
def field_clean(spark, sf_dir):
    return plots(spark, sf_dir)


def matched(spark, sf_dir):
    tiles = spark.sql(CTES["tiles"])
    px = severity(spark, sf_dir).select("row", "col", F.col("cbi_bc").alias("cbi"))
    # each tile holds the whole grid, but for a's right half
    px = px.withColumn("file", F.explode(F.array(*[F.lit(f) for f in "abcd"]))).where("not (file = 'a' and col >= 10)")
    return analysis.match_plots(plots(spark, sf_dir), tiles, px)


@query("SELECT plot_id, observed, predicted FROM matched WHERE predicted IS NOT NULL")
def field_plot_match(spark, sf_dir):
    return matched(spark, sf_dir).where("predicted is not null").select("plot_id", "observed", "predicted")


@query("SELECT reason, count(*) AS n FROM matched GROUP BY reason")
def field_plot_reasons(spark, sf_dir):
    return matched(spark, sf_dir).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, round(sqrt(avg((predicted - observed) * (predicted - observed))), 6) AS rmse, round(corr(observed, predicted), 6) AS r, round(corr(observed, predicted) * corr(observed, predicted), 6) AS r2, round(regr_slope(observed, predicted), 6) AS slope, round(regr_intercept(observed, predicted), 6) AS intercept FROM matched WHERE predicted IS NOT NULL")
def field_fit_stats(spark, sf_dir):
    s = analysis.fit_stats(matched(spark, sf_dir))
    return s.select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "r", "r2", "slope", "intercept")])


def inspected(spark, sf_dir):
    px = in_polygon(spark, sf_dir).join(severity(spark, sf_dir).select("row", "col", "cbi_bc"), ["row", "col"], "left")
    px = px.select(F.lit("f1.tif").alias("file"), "row", "col", (F.col("cbi_bc") * F.when((F.col("row") + F.col("col")) % 7 == 0, 2).otherwise(1)).alias("value"))
    return analysis.flagged(px, "value")


@query("""SELECT f.event_id, f.file, CASE WHEN f.event_id = 'F9' THEN 'no-polygon-match' WHEN s.file IS NULL THEN 'empty-polygon-mask' WHEN s.n_invalid > 0 THEN 'invalid' ELSE 'ok' END AS status,
coalesce(s.n_polygon_px, 0) AS n_polygon_px, coalesce(s.n_nodata, 0) AS n_nodata, coalesce(s.n_oor, 0) AS n_oor, coalesce(s.n_invalid, 0) AS n_invalid, s.min_val, s.max_val
FROM files f LEFT JOIN (SELECT file, count(*) AS n_polygon_px, count(*) FILTER (reason = 'nodata') AS n_nodata, count(*) FILTER (reason = 'out-of-range') AS n_oor, count(reason) AS n_invalid, min(value) AS min_val, max(value) AS max_val FROM flagged GROUP BY file) s ON f.file = s.file""")
def verify_summary(spark, sf_dir):
    polygons = spark.createDataFrame([("F1",), ("F2",)], "event_id string")
    return analysis.verify(spark.sql(CTES["files"]), polygons, inspected(spark, sf_dir))


@query("SELECT file, CAST(row AS INT) AS row, CAST(col AS INT) AS col, value, reason FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY row, col) AS k FROM flagged WHERE reason IS NOT NULL) WHERE k <= 500")
def verify_details(spark, sf_dir):
    return analysis.first_invalid(inspected(spark, sf_dir))


@query()
def rf_train_mllib(spark, sf_dir):
    """A forest of the operator's 500 trees, trained on the pixels under field plots with their observed severity; r2 is of rows left out."""
    px = stack(spark, sf_dir).withColumn("plot", F.col("row") * 20 + F.col("col"))
    observed = plots(spark, sf_dir).select((F.col("plot_id") % 400).alias("plot"), F.col("observed").alias("cbi")).groupBy("plot").agg(F.avg("cbi").alias("cbi"))
    rows = px.join(F.broadcast(observed), "plot").drop("plot")
    model, data = spectral.train_forest(rows.where("(row + col) % 4 <> 0"))
    return spectral.held_out(model, rows.where("(row + col) % 4 = 0"))
