"""Pixels: reflectance, quality mask, indices, composites, predictors, severity."""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderframe.functions.numeric import clip, floor2, ieee_div, is_finite, trunc_scaled, trunc0
from cinderframe.operators import constants as C

QA_MASK = functools.reduce(lambda a, b: a | 1 << b, C.QA_BITS, 0)


def reflectance(dn: Column) -> Column:
    return dn * C.SCALE + C.OFFSET


def is_clear(qa: Column) -> Column:
    return qa.bitwiseAND(F.lit(QA_MASK)) == 0


def with_reflectance(obs: DataFrame, bands=("blue", "green", "red", "nir08", "swir16", "swir22")) -> DataFrame:
    """obs with each band's reflectance; NULL on pixels whose quality bits reject them."""
    return obs.withColumns({b: F.when(is_clear(F.col("qa_pixel")), reflectance(F.col(f"dn_{b}"))) for b in bands})


def indices(names=("nbr", "ndvi", "ndmi", "evi", "mirbi")) -> list[Column]:
    """Only the named ones, so that unused bands are never read."""
    c = F.col
    every = {
        "nbr": lambda: ieee_div(c("nir08") - c("swir22"), c("nir08") + c("swir22")),
        "ndvi": lambda: ieee_div(c("nir08") - c("red"), c("nir08") + c("red")),
        "ndmi": lambda: ieee_div(c("nir08") - c("swir16"), c("nir08") + c("swir16")),
        "evi": lambda: ieee_div(2.5 * (c("nir08") - c("red")), c("nir08") + 6.0 * c("red") - 7.5 * c("blue") + 1.0),
        "mirbi": lambda: 10.0 * c("swir16") - 9.8 * c("swir22") + 2.0,
    }
    return [every[n]().alias(n) for n in names]


def season(obs: DataFrame, start_day: int, end_day: int, max_cloud: float = C.MAX_CLOUD) -> DataFrame:
    return obs.where(F.col("doy").between(start_day, end_day) & (F.col("cloud_cover") < max_cloud))


def composite(pixels: DataFrame, year: int, keys=("row", "col"), names=("nbr", "ndvi", "mirbi")) -> DataFrame:
    """pre_* and post_* of each pixel: the mean of the year next to the fire's, else of both years next to it.

    One aggregation gives both composites and both fallbacks; missing values don't count, infinities do.
    """
    sides = {"pre": (year - 1, year - 2), "post": (year + 1, year + 2)}
    mean = lambda n, years: F.avg(F.when(F.col("yr").isin(*years), F.col(n)))
    out = [F.coalesce(mean(n, y[:1]), mean(n, y)).alias(f"{side}_{n}") for side, y in sides.items() for n in names]
    return pixels.where(F.col("yr").between(year - 2, year + 2) & (F.col("yr") != year)).groupBy(*keys).agg(*out)


def missing_shares(pixels: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: how many pixels, and the percentage of each column that is missing or NaN; null if there are no pixels."""
    share = lambda n: (F.avg((F.col(n).isNull() | F.isnan(n)).cast("double")) * 100).alias(f"{n}_missing")
    return pixels.agg(F.count("*").alias("n"), *[share(n) for n in names])


def predictors(comp: DataFrame, digits: int | None = None) -> DataFrame:
    """comp with dnbr, rbr (from the truncated dnbr), dndvi, dmirbi and post_mirbi, as whole units; digits as in trunc_scaled()."""
    c = F.col
    cut = comp.withColumn("dnbr", trunc_scaled(c("pre_nbr") - c("post_nbr"), digits=digits)).withColumn("post_mirbi_units", trunc_scaled(c("post_mirbi"), digits=digits))
    return cut.select(
        *[x for x in comp.columns if x != "post_mirbi"],
        "dnbr",
        trunc_scaled(ieee_div(c("dnbr"), c("pre_nbr") + 1.001), 1.0, digits).alias("rbr"),
        trunc_scaled(c("pre_ndvi") - c("post_ndvi"), digits=digits).alias("dndvi"),
        trunc_scaled(c("pre_mirbi") - c("post_mirbi"), digits=digits).alias("dmirbi"),
        c("post_mirbi_units").alias("post_mirbi"),
    )


def annual_deficit(months: DataFrame) -> DataFrame:
    """The yearly sum of a climate cell, whole units; NULL if a month is missing."""
    return months.groupBy("lat_idx", "lon_idx").agg(F.when(F.count("def") == 12, F.floor(F.round(F.sum("def"), 6)).cast("double")).alias("def"))


class Forest:
    """A regression forest as arrays: feature (-1 in leaves), threshold, children and value of each node of each tree."""

    def __init__(self, nodes: pd.DataFrame, features=C.PREDICTORS):
        self.features, self.trees = list(features), []
        place = {f: i for i, f in enumerate(self.features)}
        for _, t in nodes.sort_values(["tree", "node"]).groupby("tree"):
            feat = np.array([place.get(f, -1) for f in t["feat"]])
            number = lambda c: t[c].fillna(0).to_numpy()  # noqa: B023, E731
            self.trees.append((feat, number("thr"), number("lft").astype(int), number("rgt").astype(int), number("val")))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feat, thr, left, right, value in self.trees:
            at = np.zeros(len(x), int)
            while (inner := feat[at] >= 0).any():
                rows = np.flatnonzero(inner)
                n = at[rows]
                at[rows] = np.where(x[rows, feat[n]] <= thr[n], left[n], right[n])
            total += value[at]
        return total / len(self.trees)


def score(pixels: DataFrame, forest: Forest, digits: int | None = None) -> DataFrame:
    """pixels with cbi and cbi_bc; NULL where a predictor is missing or infinite. digits as in floor2().

    The forest is a model of fixed size and travels with the function; Arrow carries the predictors in batches.
    """

    @F.pandas_udf("double")
    def predict(x: pd.DataFrame) -> pd.Series:
        v = x.to_numpy(np.float64)
        out = np.full(len(v), np.nan)
        good = np.isfinite(v).all(axis=1)
        out[good] = forest.predict(v[good])
        return pd.Series(out).where(good, None)

    # said to be nondeterministic so that filters on the score aren't copied below it, each copy scoring again
    predict = predict.asNondeterministic()
    valid = functools.reduce(lambda a, b: a & b, [is_finite(F.col(f)) for f in forest.features])
    raw = F.when(valid, floor2(predict(F.struct(*[F.col(f).cast("double").alias(f) for f in forest.features])), digits))
    return bias_corrected(pixels.withColumn("cbi", raw), digits)


def bias_corrected(df: DataFrame, digits: int | None = None) -> DataFrame:
    """cbi_bc: steeper below and above 1.5, within [0, 3], to hundredths."""
    d = F.col("cbi") - 1.5
    return df.withColumn("cbi_bc", floor2(clip(F.when(F.col("cbi") <= 1.5, d * 1.3 + 1.5).otherwise(d * 1.175 + 1.5), *C.CBI_RANGE), digits))


def train_forest(rows: DataFrame, trees: int = 500, seed: int = 123, features=C.PREDICTORS, target: str = "cbi"):
    """A random forest of Spark's library on complete rows; leaves of at least n / 75 / 6 rows, square-root feature subsets."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    full = rows.dropna(subset=[*features, target])
    least = max(1, round(full.count() / 75 / 6))
    data = VectorAssembler(inputCols=list(features), outputCol="features").transform(full)
    return RandomForestRegressor(labelCol=target, numTrees=trees, minInstancesPerNode=least, featureSubsetStrategy="sqrt", seed=seed).fit(data), data


def held_out(model, rows: DataFrame, features=C.PREDICTORS, target: str = "cbi") -> DataFrame:
    """One row: how well a trained forest tells the target of complete rows it was not trained on."""
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=list(features), outputCol="features").transform(rows.dropna(subset=[*features, target]))
    t, p = F.col(target), F.col("prediction")
    return model.transform(data).agg(F.count("*").alias("n"), (1 - F.sum((t - p) ** 2) / F.nullif(F.var_pop(t) * F.count("*"), F.lit(0.0))).alias("r2"), F.sqrt(F.avg((t - p) ** 2)).alias("rmse"))


def save_forest(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_forest(path: str):
    from pyspark.ml.regression import RandomForestRegressionModel

    return RandomForestRegressionModel.load(path)
