"""Document fingerprints from closed syncmers, matched by position.

A text is its words cut into units of at most UNIT characters, with K - 1 empty units before and after them. A k-mer of K
units is an anchor if the least of its s-mers of S units is its first or its last one. The choice looks at nothing but
the k-mer, so equal passages give equal anchors in any document. One scheme serves texts of any length: the shortest
text has k-mers that reach into the empty units.

A fingerprint lists the anchors in text order, each with its distance, in units, to the one before. Two fingerprints
match where two anchors follow each other at the same distance in both; the matched extent is the sum of these distances,
and likeness is the matched extent as a share of all extent of both. So common anchors that stand apart, or in another
order, don't count.

with_next() compares each document with the next one by ascending key. Only keys are sorted: a range partition deals
them out, each partition links its neighbours, and a row for each partition links the partitions. Texts are shuffled
once, and of each text the prefix that its predecessor asks for once more.

Defined results: a null text is an empty one; a text without words has no anchors, a text whose k-mers all fail the test
has none either (about one of 30 texts of one unit); two fingerprints without anchors are alike
(1), one without is unlike any other (0); nulls come first among keys; rows that repeat key and text are one document
with one neighbour, returned as often as they occur; rows with equal keys and different texts follow each other by a
hash of the text; a single document is its own next; an empty table gives an empty result; only the key and the text of
the input are used, so other columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cinderframe.llm.common import let, stash, whole_text, words

K, S = 8, 2
#: Characters of a unit at most: words are cut from their start.
UNIT = 6
#: An anchor is an int: 4 bits of distance (at most K - S, as each run of so many k-mers has an anchor), 27 bits of hash.
DISTANCE = 4


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """The fingerprint of a text that isn't null: its closed syncmers in text order, hash and distance in one int."""
    inner = k - s

    def of_units(h: Column) -> Column:
        smers = F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - s + 1, F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(h, i + d) for d in range(1, s)]))

        def chosen(m: Column) -> Column:
            least = lambda i: F.least(*[m[i + d] for d in range(inner + 1)])
            edge = lambda i: let(least(i), lambda v: (v == m[i]) | (v == m[i + inner]))
            return F.filter(F.sequence(F.lit(0), F.size(h) - k), edge)

        def coded(places: Column) -> Column:
            hashed = lambda i: F.shiftleft(F.xxhash64(*[h[i + d] for d in range(k)]).bitwiseAND(F.lit((1 << 27) - 1)), DISTANCE)
            return F.transform(places, lambda i, j: hashed(i).bitwiseOR(F.when(j == 0, F.least(i, F.lit((1 << DISTANCE) - 1))).otherwise(i - places[j - 1])).cast("int"))

        return let(let(smers, chosen), coded)

    none = F.array().cast("array<int>")
    edge = F.array_repeat(F.lit(0).cast("bigint"), k - 1)
    units = F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D]{{1,{UNIT}}}"), 0)
    padded = lambda u: F.concat(edge, F.transform(u, lambda x: F.xxhash64(x)), edge)
    return let(units, lambda u: F.when(F.size(u) > 0, let(padded(u), of_units)).otherwise(none))


def as_string(found: Column) -> Column:
    """Eight hexadecimal digits for each anchor, joined: 27 bits of hash, 4 of distance."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The matched extent of two fingerprints as a share of the extent of both."""

    def links(x: Column) -> Column:
        """An anchor, the one before it, and their distance, as one number whose low bits are the distance."""
        pair = lambda y, i: F.xxhash64(F.shiftright(y, DISTANCE), F.when(i > 0, F.shiftright(x[i - 1], DISTANCE)).otherwise(F.lit(-1)), y)
        return F.array_distinct(F.transform(x, lambda y, i: F.shiftleft(pair(y, i), DISTANCE).bitwiseOR(y.bitwiseAND(F.lit((1 << DISTANCE) - 1)).cast("bigint"))))

    # the distance of the first anchor may be 0: each link counts one besides
    extent = lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda t, y: t + y.bitwiseAND(F.lit((1 << DISTANCE) - 1)) + 1)

    def share(p: Column) -> Column:
        common = extent(F.array_intersect(p["a"], p["b"]))
        return let(common, lambda c: F.when((F.size(p["a"]) == 0) & (F.size(p["b"]) == 0), F.lit(1.0)).otherwise(c / (extent(p["a"]) + extent(p["b"]) - c)))

    return let(F.struct(links(a).alias("a"), links(b).alias("b")), share)


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (null: empty), h (hash of the text), anchors: one row for each row of docs."""
    t = whole_text(F.col(text))
    return docs.select(F.col(key).alias("doc_id"), t.alias("text"), F.xxhash64(t).alias("h"), anchors(t).alias("anchors"))


def neighbours(dealt: DataFrame) -> DataFrame:
    """dealt(doc_id, h, n_chars, part), all different, with next_id, next_h: the next key, the first one after the last.

    The parts are ranges of (doc_id, h) in ascending order.
    """
    order = W.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "h")
    ends = dealt.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h")).alias("head"))
    # a row for each partition
    every = W.orderBy("part")
    heads = ends.select("part", F.coalesce(F.lead("head").over(every), F.first("head").over(every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("after"))
    linked = dealt.withColumn("next", F.lead(F.struct(F.lit(True).alias("known"), "doc_id", "h")).over(order)).join(F.broadcast(heads), "part")
    return linked.select("doc_id", "h", "n_chars", F.coalesce("next", "after").alias("n")).select("doc_id", "h", "n_chars", F.col("n.doc_id").alias("next_id"), F.col("n.h").alias("next_h"))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of docs.

    The edited text has its last quarter replaced by as many first characters (or all) of the next document.
    """
    spark = docs.sparkSession
    t = whole_text(F.col(text))
    keys = docs.select(F.col(key).alias("doc_id"), F.xxhash64(t).alias("h"), F.length(t).cast("bigint").alias("n_chars"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one table for the counts and the parts: each of its files costs a task several processes (chmod) on a local disk
    n_rows = keys.groupBy("doc_id", "h", "n_chars").count().repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "h")
    dealt = stash(n_rows.withColumn("part", F.spark_partition_id()), "keys")
    links = neighbours(dealt.drop("count"))
    asked = links.select(F.col("next_id").alias("doc_id"), F.col("next_h").alias("h"), F.col("doc_id").alias("asker_id"), F.col("h").alias("asker_h"), F.floor(F.col("n_chars") / 4).cast("int").alias("quarter"))
    # both joins need the same columns of it by the same key, so one exchange serves both
    printed = fingerprint(docs, key, text)
    sent = printed.alias("d").join(asked.alias("a"), F.expr("d.doc_id <=> a.doc_id and d.h = a.h")).select("asker_id", "asker_h", F.substring("text", F.lit(1), F.col("quarter")).alias("prefix"), F.col("anchors").alias("next_anchors"))
    if not dealt.where("count > 1").isEmpty():
        sent = sent.dropDuplicates(["asker_id", "asker_h"])
    both = printed.alias("d").join(sent.alias("s"), F.expr("d.doc_id <=> s.asker_id and d.h = s.asker_h"))
    n = F.length("text")
    kept = n - F.floor(n / 4).cast("int")
    edited = both.select("doc_id", n.cast("bigint").alias("n_chars"), "anchors", "next_anchors", F.concat(F.substring("text", F.lit(1), kept), "prefix").alias("edited")).withColumn("edited_anchors", anchors(F.col("edited")))
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("anchors")).alias("fingerprint"),
        as_string(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
