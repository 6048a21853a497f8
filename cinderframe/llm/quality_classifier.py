"""Quality by hierarchical empirical Bayes.

Two logistic heads on hashed words and a few shape features, quality and toxicity, give each document's own evidence.
They are fitted on a bounded sample of labelled rows (at most TRAINING_ROWS). The quality evidence of all documents is
then summed by host and by path within the host; each host's rate is shrunk toward the global one, each path's toward
its host's, by a strength that the spread between groups decides (method of moments). A document's log odds are its own
plus those of its path against the global rate; the path's and the host's rates are those of their other documents, so a
document's evidence counts once. Sites are groups of columns: host and path are parameters.

Defined results: a null text is an empty one, with the evidence of the intercept; null hosts and paths are groups of
their own; labels without a document, and null labels, are ignored; without labels of both kinds a head says the rate it
saw, 1/2 if none; rows that repeat give repeated results; an empty table gives an empty result; only the named columns
are used, so other columns of any name do no harm.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cinderframe.llm.common import split_words, stash, whole_text

#: Labelled rows at most that the heads are fitted on, and characters of their texts together; whole texts, by a hash of their key.
TRAINING_ROWS, TRAINING_CHARS = 12_000, 150_000_000
BINS = 1 << 16
TELLING = 5.0
DENSE = 7
#: Paths at most whose posteriors (under 100 bytes each) are broadcast.
BROADCAST_PATHS = 100_000
STRENGTHS = (2.0, 1000.0)


class Bins(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        b = self[word] = zlib.crc32(word.strip(".,;:!?#*$%&|<>\"'()").lower().encode()) % BINS
        return b


def features(text: str, bins: Bins) -> tuple[np.ndarray, np.ndarray]:
    """The bins of the text's words, each once, and its shape."""
    found = [w.decode() for w in split_words(text)]
    n, c = max(1, len(found)), max(1, len(text))
    marks = len(text) - len(text.translate(MARKS))
    capitals = sum(map(str.isupper, found)) / n
    shape = np.array([min(1.0, marks / n), capitals, min(1.0, text.count("!") / n), len(set(found)) / n, min(1.0, c / n / 20), min(1.0, np.log1p(n) / 10), 1.0])
    return np.fromiter({bins[w] for w in found}, np.int32), shape


MARKS = str.maketrans("", "", "#*$%&|<>")


def telling(bags: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Of each bin, whether its documents' rate differs from that of all by over TELLING standard errors."""
    n = np.bincount(np.concatenate(bags), minlength=BINS) if bags else np.zeros(BINS)
    good = np.bincount(np.concatenate(bags), np.repeat(y, [len(b) for b in bags]), BINS)
    rate = y.mean()
    return np.abs(good - n * rate) > TELLING * np.sqrt(np.maximum(n, 1) * rate * (1 - rate) + 0.25)


def fit(bags: list[np.ndarray], shapes: np.ndarray, y: np.ndarray, rounds: int = 400, penalty: float = 1.0) -> np.ndarray:
    """Logistic weights (BINS then DENSE) by Adam on the whole sample; the last one is the intercept."""
    w = np.zeros(BINS + DENSE)
    if not len(y) or y.min() == y.max():
        w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        return w
    use = telling(bags, y)
    bags = [b[use[b]] for b in bags]
    lengths = np.array([len(b) for b in bags])
    flat = np.concatenate(bags) if lengths.sum() else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(bags)), lengths)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(doc, w[flat], len(bags)) + shapes @ w[BINS:]
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.r_[np.bincount(flat, r[doc], BINS), shapes.T @ r] + penalty * w / len(y)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


def training(docs: DataFrame, labels: DataFrame, key: str, text: str, rows: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Features and labels (quality, toxic) of at most `rows` labelled documents, chosen by a hash of their key."""
    chosen = labels.where("quality is not null and toxic is not null").groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(rows)
    picked = docs.select(F.col(key).alias("id"), whole_text(F.col(text)).alias("text")).join(F.broadcast(chosen), "id").select("id", "text", "quality", "toxic")
    # at most `rows` lengths, in one task
    before = W.orderBy(F.xxhash64("id"), "id", "h").rowsBetween(W.unboundedPreceding, 0)
    lengths = picked.select("id", F.xxhash64("text").alias("h"), F.length("text").alias("chars")).orderBy(F.xxhash64("id"), "id", "h").limit(rows)
    fits = lengths.withColumn("sum", F.sum("chars").over(before)).where(F.col("sum") <= TRAINING_CHARS).select("id", "h").distinct()
    picked = picked.withColumn("h", F.xxhash64("text")).join(F.broadcast(fits), ["id", "h"], "left_semi").select("text", "quality", "toxic")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = Bins()
        for batch in batches:
            found = [features(t, bins) for t in batch["text"]]
            yield pd.DataFrame({"bag": [f[0] for f in found], "shape": [f[1] for f in found], "quality": batch["quality"], "toxic": batch["toxic"]})

    got = picked.mapInPandas(run, "bag array<int>, shape array<double>, quality int, toxic int").limit(rows).toPandas()
    return [np.asarray(b, np.int64) for b in got["bag"]], np.array([np.asarray(s) for s in got["shape"]]).reshape(len(got), DENSE), got[["quality", "toxic"]].to_numpy(np.float64)


def evidence(docs: DataFrame, quality: np.ndarray, toxic: np.ndarray, key: str, text: str, host: str, path: str) -> DataFrame:
    """doc_id, host, path, own (log odds of quality), toxic (log odds): one row for each row of docs."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = Bins()
        both = np.stack([quality, toxic], axis=1)
        for batch in batches:
            z = np.empty((len(batch), 2))
            for i, t in enumerate(batch["text"]):
                bag, shape = features(t, bins)
                z[i] = both[bag].sum(axis=0) + shape @ both[BINS:]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "host": batch["host"], "path": batch["path"], "own": z[:, 0], "toxic": z[:, 1]})

    slim = docs.select(F.col(key).cast("string").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), whole_text(F.col(text)).alias("text"))
    return slim.mapInPandas(run, "doc_id string, host string, path string, own double, toxic double").withColumn("doc_id", F.col("doc_id").cast(kind))


def logit(p):
    return F.log(p / (1 - p))


def strength(groups: DataFrame, above: str) -> DataFrame:
    """Prior observations by the method of moments: what spread is left after sampling noise. One row."""
    rate, p = F.col("good") / F.col("n"), F.col(above)
    spread = F.sum(F.col("n") * (rate - p) ** 2) / F.sum("n")
    noise = F.sum(p * (1 - p)) / F.sum("n")
    m = F.coalesce(F.avg(p * (1 - p)) / F.greatest(spread - noise, F.lit(1e-9)), F.lit(1.0))
    return groups.agg(F.least(F.greatest(m, F.lit(STRENGTHS[0])), F.lit(STRENGTHS[1])).alias("m"))


def posteriors(sums: DataFrame) -> DataFrame:
    """sums(host, path, n, good) with the host's sums (host_n, host_good), global_rate, and the strengths host_m and path_m.

    A row for each path is all that this step holds; the levels' strengths come from sums over groups, one row each.
    """
    total = F.broadcast(sums.agg(((F.sum("good") + 0.5) / (F.sum("n") + 1)).alias("global_rate")))
    hosts = sums.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).crossJoin(total)
    hosts = hosts.crossJoin(F.broadcast(strength(hosts, "global_rate").withColumnRenamed("m", "host_m")))
    hosts = hosts.select(F.col("host").alias("of"), "global_rate", "host_m", F.col("n").alias("host_n"), F.col("good").alias("host_good"))
    paths = sums.join(hosts, F.col("host").eqNullSafe(F.col("of"))).withColumn("host_rate", shrunk("host_good", "host_n", "host_m", F.col("global_rate")))
    return paths.crossJoin(F.broadcast(strength(paths, "host_rate").withColumnRenamed("m", "path_m"))).drop("of", "host_rate")


def shrunk(good: str, n: str, m: str, above: Column, without: Column | None = None) -> Column:
    """A group's rate, shrunk toward the one above by m observations; without one document's evidence, if given."""
    one, it = (F.lit(0), F.lit(0.0)) if without is None else (F.lit(1), without)
    return (F.greatest(F.col(good) - it, F.lit(0.0)) + F.col(m) * above) / (F.col(n) - one + F.col(m))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang", rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, own, path_rate, host_rate, quality (posterior), toxic (probability), kept: a row for each row of docs."""
    bags, shapes, y = training(docs, labels, key, text, rows)
    slim = stash(evidence(docs, fit(bags, shapes, y[:, 0]), fit(bags, shapes, y[:, 1]), key, text, host, path), "evidence")
    p = 1 / (1 + F.exp(-F.col("own")))
    sums = stash(slim.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("good")), "sites")
    sites = posteriors(sums).withColumnsRenamed({"host": "h", "path": "p"})
    joined = slim.join(F.broadcast(sites) if sums.count() <= BROADCAST_PATHS else sites, F.expr("host <=> h and path <=> p"))
    joined = joined.withColumn("host_rate", shrunk("host_good", "host_n", "host_m", F.col("global_rate"), p))
    joined = joined.withColumn("path_rate", shrunk("good", "n", "path_m", F.col("host_rate"), p))
    z = F.col("own") + logit(F.col("path_rate")) - logit(F.col("global_rate"))
    out = joined.select("doc_id", "own", "path_rate", "host_rate", (1 / (1 + F.exp(-z))).alias("quality"), (1 / (1 + F.exp(-F.col("toxic")))).alias("toxic"))
    return out.withColumn("kept", (F.col("quality") >= 0.5) & (F.col("toxic") < 0.5))
