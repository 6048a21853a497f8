"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document has the exponential key -ln(u) / weight, where u is decided by its key and text and the weight is its
quality. Within a source, documents are taken by ascending key until the words taken reach the source's target; where
the target exceeds the source, complete epochs come first and the sampling fills the rest. The document at the boundary
is taken if that brings the sum nearer to the target.

No source is sorted. Its keys, as 53-bit numbers that rise with the key's logarithm, are summed by their leading 16 bits;
prefix sums of these few sums give the digit at which the target is reached, and only the rows of that digit are summed by
the next 16 bits, and so on, until at most BUCKET_ROWS rows of a source are left to be sorted. Rows whose keys are equal
go on by a hash of their place in the scan, so not even one row that makes up a third of a table piles up in a task.
What comes out is a row for each source: the place up to which documents are taken once more. times_taken() applies it
to documents without any shuffle.

Defined results: a null text has size 0 and is taken 0 times; a null source is a source of its own, the last one; rows
that repeat key and text tie and are interchangeable; an empty table, or one without words, takes nothing; only the key,
the text and the source of the input are used, so other columns of any name do no harm. The step that shares out targets
holds all sources in one task: a row for each source, not for each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cinderframe.llm.common import discard, stash, uniform, whole_text, words

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
BUCKET_ROWS = 20_000
#: Sources at most whose plan is broadcast (under 100 bytes each); beyond it, plan and documents are joined by shuffle.
BROADCAST_SOURCES = 50_000


def quality_weight(n_words: Column, n_symbols: Column) -> Column:
    """In (0, 1]: fewer symbols a word weigh more."""
    return F.when(n_words > 0, 1.0 / (1.0 + 10.0 * n_symbols / n_words)).otherwise(1.0)


def fill_targets(sources: DataFrame, share: float = 1.0, most: float = float(MOST_EPOCHS)) -> DataFrame:
    """sources(source, source_size) with target: the weights' shares of all sizes, cut at `most` times a source's size.

    What the caps free is shared again by weight until no target is above its cap. The fixed point is
    min(cap, level * weight); sorted by cap / weight, the capped sources come first, so prefix sums give the level.
    A row for each source is all that this step ever holds.
    """
    weigh = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    s = sources.withColumn("weight", weigh).withColumn("cap", most * F.col("source_size"))
    ranked = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = ranked.rowsBetween(W.unboundedPreceding, -1)
    s = (
        s.withColumn("total", share * F.sum("source_size").over(every))
        .withColumn("all_weight", F.sum("weight").over(every))
        .withColumn("freed", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("freed")) / (F.col("all_weight") - F.col("gone")))
        # the level is right at the first source, in this order, that it doesn't cap
        .withColumn("right", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(every)["level"])
    )
    return s.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("right") * F.col("weight"), F.col("cap"))).alias("target"))


#: Bits of a key's place and of a tie's: places rise with the logarithm of the key, from e^-64 to e^64 in 2^53 steps.
KEY_BITS, TIE_BITS, DIGIT = 53, 63, 16


def place(key: Column) -> Column:
    """A whole number below 2^53 that rises with a positive key."""
    return F.least(F.greatest(F.floor((F.log(key) + 64.0) * float(1 << 46)), F.lit(0)), F.lit((1 << KEY_BITS) - 1)).cast("bigint")


def keyed(docs: DataFrame, key: str, text: str, source: str, seed: int, *more: Column) -> DataFrame:
    """doc_id, source, size, place, tie (of equal places: a hash of the row's place in the scan), more."""
    t = whole_text(F.col(text))
    plain = docs.select(
        *more,
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.size(words(t)).cast("bigint").alias("size"),
        F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).alias("marks"),
        uniform(F.lit(seed), F.col(key).cast("string"), t).alias("u"),
        F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 1).alias("tie"),
    )
    return plain.withColumn("place", place(-F.log("u") / quality_weight(F.col("size"), F.col("marks")))).drop("marks", "u")


def digits() -> list[tuple[str, int]]:
    """The columns and shifts by which places, then ties, are cut into digits, leading ones first."""
    cut = lambda name, bits: [(name, max(0, s)) for s in range(bits - DIGIT, -DIGIT, -DIGIT)]
    return cut("place", KEY_BITS) + cut("tie", TIE_BITS)


def plan(rows: DataFrame) -> DataFrame:
    """A row for each source of keyed() rows: of (source), source_size, target, epochs, cut (place, tie of the last row taken once more; null: none)."""
    open_rows, known = rows, None
    for name, shift in digits():
        # the digits above this one are those at which the targets are reached
        digit = F.shiftright(name, shift).alias("digit")
        sums = stash(open_rows.groupBy("source", digit).agg(F.sum("size").alias("words"), F.count("*").alias("rows")), "mix-sums")
        if known is None:
            sources = fill_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")))
            epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0)
            sources = sources.withColumn("epochs", epochs.cast("bigint"))
            sources = stash(sources.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumnRenamed("source", "of"), "mix-sources")
            known = sources.select("of", "rest", F.lit(0).cast("bigint").alias("before"))
        order = W.partitionBy("source").orderBy("digit").rowsBetween(W.unboundedPreceding, -1)
        reached = (
            sums.withColumn("sum", F.coalesce(F.sum("words").over(order), F.lit(0)))
            .join(known.select("of", "rest", "before"), F.col("source").eqNullSafe(F.col("of")))
            .withColumn("before", F.col("before") + F.col("sum"))
            .where("words > 0 and before < rest and before + words >= rest")
            .select("of", "rest", "before", F.col("digit").alias("reached"), "rows")
        )
        known = stash(reached, "mix-reached")
        most = known.agg(F.max("rows")).first()[0] or 0
        near = known.select("of", F.col("reached"))
        near = F.broadcast(near) if known.count() <= BROADCAST_SOURCES else near
        open_rows = open_rows.join(near, F.col("source").eqNullSafe(F.col("of")) & (F.shiftright(name, shift) == F.col("reached"))).select(rows.columns)
        if most <= BUCKET_ROWS:
            break
        open_rows = stash(open_rows, "mix-open")
    # few rows of each source are left: the one at the boundary is taken if that brings the sum nearer
    inner = W.partitionBy("source").orderBy("place", "tie").rowsBetween(W.unboundedPreceding, -1)
    last = (
        open_rows.join(known, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("sum", F.col("before") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
        .groupBy(F.col("of").alias("cut_of"))
        .agg(F.max(F.when(F.col("sum") + F.col("size") / 2 < F.col("rest"), F.struct("place", "tie"))).alias("cut"), F.min(F.struct("place", "tie")).alias("low"))
        # none of them: up to the row before the least one
        .select("cut_of", F.coalesce("cut", F.struct(F.col("low.place").alias("place"), (F.col("low.tie") - 1).alias("tie"))).alias("cut"))
    )
    return stash(sources.join(last, F.col("of").eqNullSafe(F.col("cut_of")), "left").select("of", "source_size", "target", "epochs", "cut"), "mix-plan")


def placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """keyed() rows with their source's plan and times, how often each is taken."""
    small = found.count() <= BROADCAST_SOURCES
    once_more = F.coalesce((F.struct("place", "tie") <= F.col("cut")).cast("bigint"), F.lit(0))
    joined = rows.join(F.broadcast(found) if small else found, F.col("source").eqNullSafe(F.col("of")))
    return joined.withColumn("times", F.when(F.col("size") > 0, F.col("epochs") + once_more).otherwise(0))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, times: one row for each row of docs."""
    rows = stash(keyed(docs, key, text, source, seed), "mix")
    return placed(rows, plan(rows)).select("doc_id", "source", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "times")


def mixed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """docs, with all their columns, each row as often as the mix takes it; texts aren't shuffled.

    The rows' keys are computed twice, once for the plan and once beside the rows; docs must be a table that scans alike.
    """
    rows = stash(keyed(docs, key, text, source, seed), "mix")
    found = plan(rows)
    discard(rows)
    beside = keyed(docs, key, text, source, seed, F.struct(*docs.columns).alias("row"))
    return placed(beside, found).where("times > 0").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*")
