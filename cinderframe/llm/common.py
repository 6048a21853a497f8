"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: The white space that separates words, as a Java regular expression class and as characters.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


#: Different words at most whose hashes a worker remembers.
REMEMBERED = 500_000


def split_words(text: str) -> list[bytes]:
    """The words of a text, as words() has them, in UTF-8; str.split() would also split at other white space."""
    return text.encode().split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (MurmurHash3's constants)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHash(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        self[word] = h
        return h


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, in local mode (tests), a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="cinderframe-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stash(df: DataFrame, label: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a stash() that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Has the driver collect its garbage, as Spark itself does every half hour: shuffle files that nothing refers to any more go."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows that by_slices() gives its function at a time.
SLICE = 512


def give_back() -> None:
    """Gives the system the memory that this process has freed but its allocators keep: a Python worker lives on after a task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def by_slices(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """df.mapInPandas(run, schema), but run gets SLICE rows at a time, not Spark's 10,000, and the worker keeps no memory that it freed."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        slices = (batch.slice(i, SLICE).to_pandas() for batch in batches for i in range(0, batch.num_rows, SLICE))
        for out in run(slices):
            if len(out):
                yield pa.RecordBatch.from_pandas(out, schema=kinds, preserve_index=False)
        give_back()

    return df.mapInArrow(arrow, schema)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one, for files that tasks write themselves."""
    folder = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return folder


def opened(path: str, mode: str):
    """A file of the shared folder: local if it is mounted, else through Arrow's file systems."""
    if path.startswith("file:") or "://" not in path:
        return open("/" + path.removeprefix("file:").lstrip("/"), mode + "b")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner) if mode == "r" else system.open_output_stream(inner)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once for each row, however often body's lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Elements of a run that scanned() folds on its own.
RUN = 64


def scanned(values: Column, op: Callable[[Column, Column], Column], zero: Column) -> Column:
    """An array's exclusive running folds by the associative op: zero, v0, op(v0, v1), ... without the last one.

    Arrays grow by copying, so runs of RUN elements are folded apart and then put behind each other: time in proportion
    to n (RUN + n / RUN^2) copies of a number.
    """
    grow = lambda a, x: F.concat(a, F.array(op(F.element_at(a, -1), x)))
    fold = lambda run, start: F.aggregate(run, F.array(start), grow)

    def cut(v: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.floor((F.size(v) - 1) / RUN), F.lit(0)).cast("int"))
        return F.transform(places, lambda i: fold(F.slice(v, i * RUN + 1, F.lit(RUN)), zero))

    def joined(parts: Column) -> Column:
        starts = fold(F.transform(parts, lambda p: F.element_at(p, -1)), zero)
        shifted = lambda s: F.transform(parts, lambda p, i: F.transform(F.slice(p, F.lit(1), F.size(p) - 1), lambda x: op(s[i], x)))
        return F.flatten(let(starts, shifted))

    return let(let(values, cut), joined)


def whole_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text that isn't null: runs of characters that aren't white space."""
    return F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), 0)


def uniform(*key: Column) -> Column:
    """A number in (0, 1) that the key decides."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11) + F.lit(0.5)) / F.lit(float(2**53))
