import io
import math
import sqlite3
import struct
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cinderframe.functions import numeric
from cinderframe.functions.geo import Albers, Utm
from cinderframe.operators import analysis, catalog, raster, spectral
from cinderframe.plans import extras, run  # noqa: F401
from cinderframe.plans.catalogue import ORACLE_SQL, QUERIES
from cinderframe.__main__ import main
from cinderframe.sources import files, geotiff, vector

SMALL = "/root/testdata/sf0.001"


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_numeric(spark):
    lit = F.lit
    assert one(spark, *[numeric.trunc0(lit(x)) for x in (-1.7, 1.7, -0.3)]) == (-1.0, 1.0, 0.0)
    assert one(spark, *[numeric.ieee_div(lit(a), lit(0.0)) for a in (1.0, -1.0, 0.0)]) == (math.inf, -math.inf, None)
    assert one(spark, F.bround(lit(44.5), 0), F.bround(lit(45.5), 0)) == (44.0, 46.0)


def test_round_binary(spark):
    """Halves that only the product has, signs, and values beyond the digits: bit for bit as DuckDB."""
    draw = np.random.default_rng(4)
    halves = (draw.integers(-(10**8), 10**8, 20_000) + 0.5) / 1e8
    values = [*halves.tolist(), *draw.normal(size=2_000).tolist(), 0.0, -0.0, -1e-12, 0.49999999999999994e-8, 1e20, -12345678.123456789, 1821199394313286.2, 1e305, 90071992.54740993, math.inf, -math.inf]
    found = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(numeric.round_binary(F.col("x"), 8)).collect()]
    con = duckdb.connect()
    frame = pd.DataFrame({"i": range(len(values)), "x": values})  # noqa: F841
    sql = [r[0] for r in con.execute("SELECT round(x, 8) FROM frame ORDER BY i").fetchall()]
    assert struct.pack(f"{len(values)}d", *found) == struct.pack(f"{len(values)}d", *sql)
    decimal = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(F.round("x", 8)).collect()]
    assert decimal != sql
    assert math.isnan(one(spark, numeric.round_binary(F.lit(math.nan), 8))[0]) and one(spark, numeric.round_binary(F.lit(None).cast("double"), 8)) == (None,)


def test_qa_bits(spark):
    kept = [r[0] for r in spark.range(8).select(spectral.is_clear(F.lit(1).cast("int") * F.pow(F.lit(2), F.col("id")).cast("int"))).collect()]
    assert kept == [b in (2, 6) for b in range(8)]


def test_composite_falls_back(spark):
    rows = [(0, 0, 1996, 4.0), (0, 0, 1997, None), (0, 1, 1997, 1.0), (0, 1, 1996, 9.0), (0, 2, 1998, 5.0), (0, 3, 1999, math.inf), (0, 3, 2000, 1.0)]
    out = {r["col"]: (r["pre_v"], r["post_v"]) for r in spectral.composite(spark.createDataFrame(rows, "row int, col int, yr int, v double"), 1998, names=("v",)).collect()}
    assert out == {0: (4.0, None), 1: (1.0, None), 3: (None, math.inf)}


def test_bias(spark):
    got = spectral.bias_corrected(spark.createDataFrame([(1.5,), (0.0,), (3.0,), (None,)], "cbi double")).collect()
    assert [r["cbi_bc"] for r in got] == [1.5, 0.0, 3.0, None]


def test_bins(spark):
    assert one(spark, *[analysis.cbi_bin(F.lit(x)) for x in (3.0, -0.01, 3.01)], analysis.cbi_bin(F.lit(0.35).cast("float").cast("double"))) == (59, None, None, 6)


def test_projections(spark):
    x, y = Albers().forward("-114.693D", "46.348D")
    lon, lat = Albers().inverse(x, y)
    e, n = Utm().forward("-114.693D", "46.348D", "11")
    back = Utm().inverse(e, n, "11")
    got = one(spark, *map(F.expr, (x, y, lon, lat, e, n, *back)))
    assert got == pytest.approx((-1433207.363, 2736878.781, -114.693, 46.348, 677510.941, 5135300.294, -114.693, 46.348), abs=2e-3)


def test_split_ring():
    parts = list(raster.split_ring([(0, 0), (20, 0), (20, 10), (0, 10)], 50))
    assert len(parts) == 4 and sum(map(raster.ring_area, parts)) == 200
    assert len(list(raster.split_ring([(0, 0), (10, 0), (10, 5), (0, 5)], 50))) == 1


def test_merge_and_mosaic(spark):
    p = spark.createDataFrame([(0, None, 0), (0, 2.0, 1), (1, 3.0, 0), (1, 4.0, 1), (2, 5.0, 0), (2, None, 1)], "k int, v double, o int")
    assert sorted(map(tuple, raster.merge_first(p, ["k"], "v", "o").collect())) == [(0, 2.0), (1, 3.0), (2, 5.0)]
    assert sorted(map(tuple, raster.mosaic_last(p, ["k"], "v", "o").collect())) == [(0, 2.0), (1, 4.0), (2, 5.0)]


def test_geopackage(spark, tmp_path):
    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 0.0)]
    wkb = b"\x01" + struct.pack("<III", 3, 1, len(ring)) + b"".join(struct.pack("<dd", *p) for p in ring)
    with sqlite3.connect(path := str(tmp_path / "a.gpkg")) as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES ('fires', 'geom')")
        db.execute("CREATE TABLE fires (Event_ID TEXT, Incid_Type INTEGER, geom BLOB)")
        db.execute("INSERT INTO fires VALUES ('ID1', 1, ?), ('MT2', 2, NULL)", (b"GP\0\x01" + struct.pack("<i", 5070) + wkb,))
    vector.register(spark)
    rows = spark.read.format("gpkg").load(path).orderBy("Event_ID").collect()
    assert [r["Event_ID"] for r in rows] == ["ID1", "MT2"] and len(rows[0]["geom"]) == 3 and rows[1]["geom"] is None


def test_dbf(spark, tmp_path):
    field = lambda n, t, w, d: n.encode().ljust(11, b"\0") + t.encode() + b"\0" * 4 + bytes([w, d]) + b"\0" * 14
    fields = field("Id", "N", 4, 0) + field("Cbi", "N", 6, 2) + field("When", "D", 8, 0)
    rows = b" " + b"   7" + b"  1.25" + b"20160718" + b"*" + b"   8" + b"  2.00" + b"20160719" + b" " + b"   9" + b"   n/a" + b"        "
    (tmp_path / "a.dbf").write_bytes(struct.pack("<4BIHH", 3, 24, 1, 1, 3, 32 + len(fields) + 1, 19) + b"\0" * 20 + fields + b"\r" + rows)
    vector.register(spark)
    got = spark.read.format("dbf").load(str(tmp_path / "a.dbf")).collect()
    assert [tuple(r)[:2] for r in got] == [(7, 1.25), (9, None)] and str(got[0]["When"]) == "2016-07-18"


def test_scenes(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"features": [{"id": "a", "bbox": [1, 2, 3, 4], "properties": {"datetime": "2016-07-01T00:00:00Z", "proj:code": "EPSG:32611", "eo:cloud_cover": 5.0, "landsat:scene_id": ""}, "assets": {"red": {"href": "s3://x/r.tif"}}}]}')
    r = vector.scenes(spark, str(tmp_path / "s.json")).first()
    assert (r["scene_id"], r["epsg"], r["lat_n"], r["assets"]) == ("a", 32611, 4.0, {"red": "s3://x/r.tif"})


def test_all_bins(spark):
    """Every severity to hundredths falls where double edges put its single-precision value."""
    values = [i / 100 for i in range(301)]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(analysis.cbi_bin(F.col("v"))).collect()]
    edges = np.linspace(0, 3, 61)
    want = np.minimum(np.searchsorted(edges, np.float32(values).astype(float), side="right") - 1, 59)
    assert got == want.tolist() and got[35] == 6


def test_floor2_in_single_precision(spark):
    values = np.random.default_rng(1).uniform(0, 3, 2000).astype(np.float32)
    got = [r[0] for r in spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(numeric.floor2(F.col("v"))).collect()]
    assert got == [float(np.float32(np.floor(v * np.float32(100)) / np.float32(100))) for v in values]


def strips(a, predictor):
    """A little-endian file of deflated strips of three rows."""
    rows = [a[i : i + 3] for i in range(0, len(a), 3)]
    parts = [zlib.compress((np.diff(r, axis=1, prepend=r[:, :1] * 0) if predictor == 2 else r).astype("<u2").tobytes()) for r in rows]
    at = np.cumsum([8, *map(len, parts)])
    n, ifd = len(parts), int(at[-1])
    tags = [(256, 3, [a.shape[1]]), (257, 3, [a.shape[0]]), (258, 3, [16]), (259, 3, [8]), (273, 4, at[:-1].tolist()), (278, 3, [3]), (279, 4, [len(p) for p in parts]), (317, 3, [predictor])]
    tags += [(33550, 12, [30.0, 30.0, 0.0]), (33922, 12, [0.0, 0.0, 0.0, 100.0, 900.0, 0.0]), (42113, 2, [b"0", b"\0"])]
    head, extra, end = b"", b"", ifd + 2 + 12 * len(tags) + 4
    for tag, kind, values in tags:
        body = struct.pack(f"<{len(values)}{geotiff.TYPES[kind][1]}", *values)
        head += struct.pack("<HHI", tag, kind, len(values)) + (body.ljust(4, b"\0") if len(body) <= 4 else struct.pack("<I", end + len(extra)))
        extra += body if len(body) > 4 else b""
    return struct.pack("<2sHI", b"II", 42, ifd) + b"".join(parts) + struct.pack("<H", len(tags)) + head + struct.pack("<I", 0) + extra


@pytest.mark.parametrize("predictor", [1, 2])
def test_geotiff_of_strips(predictor):
    a = np.random.default_rng(predictor).integers(0, 9, (10, 7)).astype(np.uint16)
    r = geotiff.Raster(io.BytesIO(strips(a, predictor)))
    want = np.where(a == 0, np.nan, a.astype(float))
    assert (r.left, r.top, r.size, r.epsg) == (100.0, 900.0, 30.0, None)
    np.testing.assert_array_equal(r.window(0, 0, 10, 7), want)
    np.testing.assert_array_equal(r.window(-2, 5, 14, 4), np.pad(want, ((2, 2), (0, 2)), constant_values=np.nan)[:, 5:9])
    assert np.isnan(r.window(50, 50, 2, 2)).all() and r.aligned(130, 810, 190, 870) == (-1, -1, 6, 6)


def test_geotiff_of_tiles():
    a = np.random.default_rng(0).random((300, 520)).astype(np.float32)
    a[5, 5] = np.nan
    r = geotiff.Raster(io.BytesIO(geotiff.encoded(a, 1000.0, 9000.0, 30.0, 5070)))
    assert (r.left, r.top, r.size, r.epsg, r.width, r.height) == (1000.0, 9000.0, 30.0, 5070, 520, 300)
    np.testing.assert_array_equal(r.window(0, 0, 300, 520), a.astype(float))
    np.testing.assert_array_equal(r.window(250, 500, 10, 20), a[250:260, 500:].astype(float))


def test_write_tells_of_errors(spark, tmp_path):
    px = spark.createDataFrame([("a.tif", 0, 0, 15.0, 85.0, 1.5), ("a.tif", 1, 1, 45.0, 55.0, None), ("no/b.tif", 0, 0, 15.0, 85.0, 2.0)], "file string, row int, col int, x double, y double, value double")
    (tmp_path / "no").write_text("a file, not a folder")
    got = {r["file"]: r for r in geotiff.write(px, str(tmp_path), 5070).collect()}
    assert got["a.tif"]["error"] is None and got["a.tif"]["n_valid"] == 1 and got["no/b.tif"]["error"]
    geotiff.register(spark)
    rows = {(r["row"], r["col"]): (r["x"], r["y"], r["value"]) for r in spark.read.format("geotiff").load(str(tmp_path / "a.tif")).collect()}
    assert rows[0, 0] == (15.0, 85.0, 1.5) and rows[1, 1] == (45.0, 55.0, None) and len(rows) == 4


def test_training_csv_and_forest(spark, tmp_path):
    draw = np.random.default_rng(2)
    x = draw.random((400, 6)) * 100
    frame = pd.DataFrame(x, columns=list(spectral.C.PREDICTORS)).assign(CBI=x[:, 2] / 40, unused="u")
    frame.to_csv(tmp_path / "train.csv", index=False)
    rows = files.training_rows(spark, str(tmp_path / "train.csv")).withColumnRenamed("CBI", "cbi")
    assert rows.columns == [*spectral.C.PREDICTORS, "cbi"] and rows.count() == 400
    model, _ = spectral.train_forest(rows.where("lat < 80"), trees=30)
    spectral.save_forest(model, str(tmp_path / "model"))
    assert spectral.held_out(spectral.load_forest(str(tmp_path / "model")), rows.where("lat >= 80")).first()["r2"] > 0.7


def test_split_polygon_with_a_hole(spark):
    outer, hole = [(0, 0), (40, 0), (40, 40), (0, 40)], [(5, 5), (5, 10), (10, 10), (10, 5)]
    pieces = list(raster.split_rings([outer, hole], 500))
    area = sum(raster.ring_area(p[0]) - sum(map(raster.ring_area, p[1:])) for p in pieces)
    assert len(pieces) == 4 and area == 1600 - 25
    edges = [dict(ring=k, x1=float(a[0]), y1=float(a[1]), x2=float(b[0]), y2=float(b[1])) for k, r in enumerate((outer, hole)) for a, b in zip(r, r[1:] + r[:1], strict=True)]
    rows = raster.split_polygons(spark.createDataFrame([("e", edges), ("none", None)], "event_id string, edges array<struct<ring:int,x1:double,y1:double,x2:double,y2:double>>"), 500).collect()
    assert sorted(r["piece"] for r in rows) == [0, 1, 2, 3] and all(r["event_id"] == "e" for r in rows)


def test_fire_lookup_errors(spark):
    fires = spark.createDataFrame([("a", 0), ("b", 1)], "event_id string, ordinal int")
    assert catalog.by_id(fires, "b").first()["ordinal"] == catalog.at_index(fires, 1).first()["ordinal"] == 1
    with pytest.raises(LookupError):
        catalog.by_id(fires, "c")
    for place in (2, -1):
        with pytest.raises(IndexError):
            catalog.at_index(fires, place)


def test_missing_shares(spark):
    px = spark.createDataFrame([(1.0, None), (math.nan, 2.0), (None, 3.0), (4.0, 4.0)], "a double, b double")
    assert tuple(spectral.missing_shares(px, ["a", "b"]).first()) == (4, 50.0, 25.0)
    assert tuple(spectral.missing_shares(px.where("b > 9"), ["a"]).first()) == (0, None)


def test_fit_of_constant_pairs(spark):
    """Undefined statistics are what SQL gives, and no error."""
    names, nan = ("n", "rmse", "r", "r2", "slope", "intercept"), "NaN"
    sql = "SELECT count(*), sqrt(avg((predicted - observed) * (predicted - observed))), corr(observed, predicted), corr(observed, predicted) * corr(observed, predicted), regr_slope(observed, predicted), regr_intercept(observed, predicted) FROM p WHERE observed IS NOT NULL AND predicted IS NOT NULL"
    plain = lambda row: [nan if isinstance(v, float) and math.isnan(v) else v if v is None else round(v, 9) for v in row]
    for rows in ([(1.0, 2.1), (3.0, 2.1), (4.2, 2.1)], [(2.1, 1.0), (2.1, 3.0)], [(1.0, 2.0)], [(None, 2.0)], [(1.0, 1.5), (2.0, 2.0), (2.5, 3.0)]):
        found = analysis.fit_stats(spark.createDataFrame(rows, "observed double, predicted double").repartition(2)).select(*names).first()
        con = duckdb.connect()
        con.execute("CREATE TABLE p (observed DOUBLE, predicted DOUBLE)")
        con.executemany("INSERT INTO p VALUES (?, ?)", rows)
        assert plain(found) == plain(con.execute(sql).fetchone())


def test_severity_of_many_fires(spark, tmp_path):
    """Folders don't grow with the fires; fires that are written again are replaced, others stay."""
    path = str(tmp_path / "severity")
    px = spark.range(3000).select((1997 + F.col("id") % 2).cast("int").alias("year"), F.concat(F.lit("0"), F.col("id").cast("string")).alias("event_id"), F.lit(0).alias("row"), F.lit(1).alias("col"), F.lit(1.5).alias("cbi"), F.lit(2.5).alias("cbi_bc"))
    files.write_severity(px, path)
    assert len({f.parent for f in (tmp_path / "severity").rglob("*.parquet")}) <= 2 * files.SHARES
    files.write_severity(px.where("event_id like '0%7'").unionByName(px.where("event_id = '012'").withColumn("event_id", F.lit("new"))).withColumn("cbi", F.lit(0.5)), path)
    got = {(r["year"], r["event_id"]): r["cbi"] for r in spark.read.parquet(path).collect()}
    old = {(1997 + i % 2, f"0{i}"): 0.5 if i % 10 == 7 else 1.5 for i in range(3000)}
    assert got == old | {(1997, "new"): 0.5} and spark.read.parquet(path).count() == 3001
    assert files.finished(spark, path).count() == 3001 and not list((tmp_path / "severity").glob("_new*"))


def test_totals_of_many_fires(spark, tmp_path):
    """A run writes a few folders, whatever the number of its fires."""
    fires = spark.range(3000).select(F.col("id").cast("string").alias("event_id"), F.lit(1997).alias("year"))
    bad = F.col("event_id").endswith("5")
    px = lambda f: f.select("event_id", "year", F.lit(0).alias("row"), F.lit(1).alias("col"), F.lit(1.0).alias("cbi"), F.when(~F.col("event_id").endswith("1"), 1.0).alias("cbi_bc"), F.when(bad, "no scene").alias("error"))
    out = str(tmp_path / "run")
    totals = analysis.run_totals(run.run(fires, fires.where("event_id = '3'"), px, out)).collect()
    assert {r["status"]: r["n"] for r in totals} == {"ok": 2399, "empty": 300, "error": 300}
    assert len({f.parent for f in (tmp_path / "run").rglob("*.parquet")}) <= files.SHARES


def test_fires_are_dealt_to_folders(spark, tmp_path):
    """A run deals its fires to the folders they are written to, so their pixels, many times as many, are not shuffled."""
    fires, given = spark.range(3000).select(F.col("id").cast("string").alias("event_id"), (1997 + F.col("id") % 2).cast("int").alias("year")), []

    def px(f):
        given.append(f)
        return f.select("event_id", "year", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("row"), F.lit(1).alias("col"), F.lit(1.0).alias("cbi"), F.lit(2.0).alias("cbi_bc"), F.lit(None).cast("string").alias("error"))

    rows = run.run(fires, None, px, str(tmp_path / "run")).collect()
    assert len(rows) == 3000 and {(r["status"], r["n_valid"], r["med"]) for r in rows} == {("ok", 10, 2.0)}
    tasks = given[0].withColumn("task", F.spark_partition_id()).groupBy("year", files.share(F.col("event_id")).alias("share")).agg(F.count_distinct("task").alias("n")).collect()
    assert len(tasks) == 2 * files.SHARES and max(t["n"] for t in tasks) <= files.PARTS
    written = [f.parent for f in (tmp_path / "run").rglob("*.parquet")]
    assert max(written.count(f) for f in written) <= files.PARTS


def test_raster_paths(spark, tmp_path):
    for name in ("1997/MT1_CBI.tif", "1997/MT1_CBI_bc.TIF", "1998/ca2_CBI.tiff", "1998/notes.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    got = [(r["year"], r["event_id"], r["state"], r["band"]) for r in files.targets(files.raster_paths(spark, str(tmp_path))).collect()]
    assert got == [(1997, "MT1", "MT", "raw"), (1997, "MT1", "MT", "bc"), (1998, "ca2", "CA", "raw")]


def test_command_line(spark, tmp_path, capsys):
    assert main(["queries"]) == 0 and "fire_pipeline" in capsys.readouterr().out
    assert main(["query", "nothing", "--data", SMALL, "--out", str(tmp_path / "o")]) == 2
    assert main(["query", "state_bbox", "--data", SMALL, "--out", str(tmp_path / "o"), "--format", "csv"]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "o")).count() > 0
    with pytest.raises(SystemExit):
        main(["fires", "x.gpkg", "--out", "o", "--states", "ZZ"])
    with pytest.raises(SystemExit):
        main(["fires", "x.gpkg", "--out", "o", "--first", "1900"])


def frames(spark, name):
    db = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    ours, theirs = QUERIES[name](spark, SMALL).toPandas(), db.sql(ORACLE_SQL[name]).df()
    order = sorted(ours.columns)
    return [x[order].sort_values(order).reset_index(drop=True) for x in (ours, theirs)]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    pd.testing.assert_frame_equal(*frames(spark, name), check_dtype=False, rtol=1e-9)
