"""Near-duplicates by order min-hash (Marcais, DeBlasio, Pandey and Kingsford, 2019), verified by banded alignment.

A text is its sequence of words, its k-mers are runs of five words, each labelled by how often it occurred before. For
each of SKETCHES hash functions the TAKEN labelled k-mers of least hash are kept in text order; texts with an equal
sketch for the same function are candidates. A candidate pair is a link if the edit similarity of the two word
sequences, 1 - distance / longer length, is at least 0.8. The alignment is banded by the distance that 0.8 allows; it
runs on strings with a code point for each word (20 bits of the word's hash).

Texts of at most SHORT words also meet by what is left of them without any floor(0.2 n) words, which finds every link
among them.

Each member of a bucket is first compared with its hub, the member that meets most others, so a star of copies is found
at its original. What sketches miss is found by an exact way: an edit changes at most three of a text's labelled runs of
three words, so two near texts share least_shared() of them. A text with fewer runs that a text of another class and of
near length has too can have no link to find and drops out, as nearly all strangers do. Of the c such runs of one that
stays, the c - least_shared() + 1 least, in one order for all texts, hold one that its link's other text has among its
own (a prefix filter; the order is by the number of texts that have a run). Runs that the same texts have are one key, so
that a passage isn't a key for each of its words. All texts that share such a key and are still in different classes are
compared, but for those that exact bounds rule out (lengths, word counts, how many pairs of words differ): in small groups
by a join, in large ones by units of two blocks of members, which test the bounds in bulk, count the words that two texts
share and list what is left; first one pair of each two classes, then all. So no pair that is in different classes is a link.
Equal texts are one node throughout. Links become classes by alternating large-star and small-star steps on tables;
nothing is collected.

Defined results: a null text is an empty one; empty texts are equal texts; a text of fewer than five words is one k-mer;
texts are taken whole, of any length; rows that repeat have one class; the class is the least key of its rows (null if
none has a key); an empty table gives an empty result; only the key and the text of the input are used (keep_one() keeps
all columns), so other columns of any name do no harm.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderframe.llm.common import REMEMBERED, SPACE_CHARS, by_slices, discard, give_back, mixed, release, stash, whole_text

K = 5
SKETCHES = 64
TAKEN = 2
SIMILARITY = 0.8
#: Candidate nodes at most whose ids (8 bytes each) are broadcast to pick their texts; beyond it they are joined by shuffle.
BROADCAST_NODES = 500_000
#: Words at most of a text whose shortened forms are keys too.
SHORT = 14
#: Members at most of a bucket whose pairs are listed by a join; larger ones are cut in blocks.
SMALL = 24
#: Members of a block of a large bucket, about.
BLOCK = 400
#: Bytes at most of texts that are broadcast to verify their pairs.
BROADCAST_BYTES = 16_000_000
#: Bins of the word counts that rule out pairs before they are aligned.
BINS = 64
#: Bits that say which pairs of adjacent words a text has, for the same.
BITS = 2048
#: Words of the runs of which near texts share least_shared().
RUN = 3
#: Words, about, of texts whose shared words with one text are counted together.
COUNTED = 1 << 20
#: Words at least of a text one of whose links is to a text of more than SHORT words.
LONG = 12
#: Postings of runs, about, that are sorted together, and parts at least that they are dealt to.
POSTINGS, PARTS = 2_000_000, 64
#: Postings, about, that a task gathers before it deals them to the parts.
DEALT = 500_000
#: Edges at most whose components one task finds, without shuffles.
FEW_EDGES = 10_000
#: Bytes, about, of a text that are hashed together.
PIECE = 1 << 17

GOLDEN = 0x9E3779B97F4A7C15
IS_SPACE = np.isin(np.arange(256), list(SPACE_CHARS.encode()))
LETTERS = np.where(IS_SPACE, np.uint64(0), mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(GOLDEN)))
#: Powers of an odd number and of its inverse; hashed() makes them longer for longer words.
POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def hashed(text: bytes) -> np.ndarray:
    """Hashes of the words of a UTF-8 text: each a polynomial of its bytes, all of a piece at once."""
    b = np.frombuffer(text, np.uint8)
    space = IS_SPACE[b]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64)
    out, i = [], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + PIECE)))
        low, high = starts[i], starts[j] if j < len(starts) else len(b)
        if high - low > len(POWERS[0]):
            for k, base in enumerate((GOLDEN, pow(GOLDEN, -1, 2**64))):
                POWERS[k] = np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(PIECE, int(high - low)), base, np.uint64)])
        at = starts[i:j] - low
        out.append(np.add.reduceat(LETTERS[b[low:high]] * POWERS[0][: high - low], at) * POWERS[1][at])
        i = j
    return mixed(np.concatenate(out))


class WordHash(dict):
    """hashed() of single words."""

    def __missing__(self, word: bytes) -> int:
        return int(hashed(word)[0])


def labelled(ids: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the k-mers of a sequence of word hashes, each with the number of its earlier occurrences."""
    if len(ids) < k:
        grams = np.zeros(1, np.uint64)
        for x in ids:
            grams = mixed(grams + x)
        return mixed(grams + np.uint64(len(ids)))
    grams = np.zeros(len(ids) - k + 1, np.uint64)
    for j in range(k):
        grams = mixed(grams + ids[j : len(ids) - k + 1 + j])
    ranked = np.sort(grams)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if len(twice):
        where = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, grams), len(twice) - 1)] == grams)
        own = grams[where]
        order = np.argsort(own, kind="stable")
        ranked, at = own[order], np.arange(len(own))
        first = np.r_[True, ranked[1:] != ranked[:-1]]
        seen = np.empty(len(own), np.uint64)
        seen[order] = at - np.maximum.accumulate(np.where(first, at, 0))
        # a first occurrence stays as it is, so that it equals that of a text in which there is no second one
        grams[where] = np.where(seen > 0, mixed(own + seen * np.uint64(GOLDEN)), own)
    return grams


SEEDS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(GOLDEN))


def sketched(grams: np.ndarray) -> np.ndarray:
    """For each hash function a 64-bit digest of the TAKEN least k-mers, in text order."""
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, (1 << 18) // len(grams))
    take = min(TAKEN, len(grams))
    for a in range(0, SKETCHES, step):
        seeds = SEEDS[a : a + step]
        v = (grams[None, :] ^ seeds[:, None]) * np.uint64(0xFF51AFD7ED558CCD)
        v ^= v >> np.uint64(32)
        v *= np.uint64(0xC4CEB9FE1A85EC53)
        v ^= v >> np.uint64(29)
        if take < len(grams):
            # the least by repeated argmin: take is small
            places = np.empty((len(seeds), take), np.int64)
            rows = np.arange(len(seeds))
            for t in range(take):
                places[:, t] = v.argmin(axis=1)
                v[rows, places[:, t]] = np.uint64(2**64 - 1)
            places.sort(axis=1)
        else:
            places = np.broadcast_to(np.arange(take), (len(seeds), take))
        digest = seeds.copy()
        for t in range(take):
            digest = mixed(digest + grams[places[:, t]])
        out[a : a + step] = digest
    return out


@functools.cache
def left_over(n: int, gone: int) -> np.ndarray:
    """Places of n elements that are left without any `gone` of them, a row each."""
    return np.stack([np.delete(np.arange(n), list(x)) for x in itertools.combinations(range(n), gone)]).astype(np.int64)


def shortened(ids: np.ndarray, least: float = SIMILARITY) -> np.ndarray:
    """Digests of a short sequence without any 0 to floor((1 - least) * n) of its elements: near ones share one."""
    out = []
    for r in range(int((1 - least + 1e-9) * len(ids)) + 1):
        places = left_over(len(ids), r)
        digest = np.full(len(places), GOLDEN, np.uint64)
        for column in places.T:
            digest = mixed(digest + ids[column])
        out.append(digest)
    return np.unique(np.concatenate(out))


def bounded(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words fall in each of BINS bins, and in which of BITS bins a labelled pair of adjacent words falls."""
    bits = np.zeros(BITS, np.uint8)
    bits[(labelled(ids, 2) % np.uint64(BITS)).astype(np.int64)] = 1
    return np.bincount((ids % np.uint64(BINS)).astype(np.int64), minlength=BINS).astype("<i4"), np.packbits(bits).view("<i8")


def unseen(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[np.ndarray], dict[str, list]]]:
    """Of each batch(node, text, ...) the nodes that a partition has not had before as long as it remembers it, their words' hashes, and their other columns."""
    seen = set()
    for batch in batches:
        chosen = []
        for i, node in enumerate(batch["node"]):
            if node not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(node)
                chosen.append(i)
        own = batch.iloc[chosen]
        yield own["node"].to_list(), [hashed(text.encode()) for text in own["text"]], {c: own[c].to_list() for c in own.columns if c not in ("node", "text")}


def sketches(docs: DataFrame) -> DataFrame:
    """docs(node, text) as (node, sketch: SKETCHES digests, short: those of short texts, n words).

    A partition gives a node once as long as it remembers it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for nodes, texts, _ in unseen(batches):
            keys = [sketched(labelled(ids)).astype(np.int64) for ids in texts]
            short = [(shortened(ids) if len(ids) <= SHORT else np.empty(0, np.uint64)).astype(np.int64) for ids in texts]
            yield pd.DataFrame({"node": nodes, "sketch": keys, "short": short, "n": [len(ids) for ids in texts]})

    return by_slices(docs, run, "node long, sketch array<long>, short array<long>, n int")


def least_shared(n: np.ndarray) -> np.ndarray:
    """How many labelled runs of RUN words a text of n >= LONG words shares at least with any that is near it.

    With m words in the longer one they share m - 2 less three for each of floor(0.2 m) edits: for m = 5 k + r, 2 k - 2 + r.
    The least of this over all m >= n is at n or at the next multiple of five.
    """
    return 2 * (n // 5) - 2 + np.minimum(n % 5, 2)


def repeated(g: np.ndarray) -> np.ndarray:
    """The places of the values that g has more than once, by value."""
    order = np.argsort(g)
    same = g[order[1:]] == g[order[:-1]]
    return order[(np.r_[False, same] | np.r_[same, False])[: len(g)]]


def met_runs(g: np.ndarray, node: np.ndarray, label: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of postings (run, node, its class, its words): those whose run a text of another class and of near length has, by run."""
    order = repeated(g)
    order = order[np.lexsort((node[order], n[order], g[order]))]
    if not len(order):
        return order
    g, node = g[order], node[order]
    new = np.r_[True, (g[1:] != g[:-1]) | (node[1:] != node[:-1])]
    order, g = order[new], g[new]
    label, n, at = label[order], n[order].astype(np.int64), np.arange(len(order))
    # in order of length, the nearest of another class stand before and after those of one class that follow each other
    begins = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (label[1:] != label[:-1])])
    which = np.searchsorted(begins, at, "right") - 1
    before, after = begins[which] - 1, np.r_[begins, len(g)][which + 1]
    left, right = np.maximum(before, 0), np.minimum(after, len(g) - 1)
    allowed = np.floor((1 - SIMILARITY + 1e-9) * n).astype(np.int64)
    met = (before >= 0) & (g[left] == g) & (n - n[left] <= allowed)
    met |= (after < len(g)) & (g[right] == g) & (n[right] - n <= allowed[right])
    return order[met]


def run_keys(g: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Of postings (run, node), by run: a key that runs of the same nodes share; keys of runs with fewer nodes are less.

    Runs of other nodes that have a key in common by chance count as one: their nodes are compared, none is missed.
    """
    if not len(g):
        return np.empty(0, np.int64)
    head = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    count = np.diff(np.r_[head, len(g)])
    nodes = np.add.reduceat(mixed(node.view(np.uint64)), head)
    return np.repeat((np.minimum(count, (1 << 23) - 1) << 40) | (mixed(nodes) >> np.uint64(24)).astype(np.int64), count)


def rarest(node: np.ndarray, key: np.ndarray, runs: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (node, key, how many of its runs have it, how many runs its node needs), the keys, and their nodes, that a link's two texts must have one in common of.

    A node's keys are taken in order until fewer runs are left than it needs.
    """
    order = np.lexsort((key, node))
    node, key, need = node[order], key[order], need[order]
    place = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (key[1:] != key[:-1])])
    runs, node, key, need = np.add.reduceat(runs[order], place, dtype=np.int64), node[place], key[place], need[place]
    head = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    ended = np.repeat(np.cumsum(np.add.reduceat(runs, head)), np.diff(np.r_[head, len(node)]))
    kept = ended - np.cumsum(runs) + runs >= need
    return key[kept], node[kept]


def thrifty(run: Callable[[tuple, pd.DataFrame], pd.DataFrame]) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """run for applyInPandas, after which the worker keeps no memory that it freed."""

    def group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = run(key, rows)
        give_back()
        return out

    return group


def sharing(docs: DataFrame, labels: DataFrame, n_words: int) -> DataFrame:
    """key, node: all links of docs(node, text) that labels(node, label) don't hold and that have a text of more than SHORT words are among those of a key.

    Postings travel as arrays, by the first bits of their hash; 32 further bits tell them apart there (strangers that
    meet by chance are compared and found to be strangers; a text needs so many runs fewer as it has equal ones by that).
    """
    parts = 1 << max(PARTS.bit_length() - 1, round(np.log2(max(1.0, n_words / POSTINGS))))
    shift = np.uint64(32 - (parts.bit_length() - 1))
    few = labels.count() <= BROADCAST_NODES

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, about, size = [], [], 0

        def flushed() -> pd.DataFrame:
            runs, which = np.concatenate(held), np.repeat(np.arange(len(held), dtype=np.uint32), [len(h) for h in held])
            node, label, n, lost = (np.array(c, t) for c, t in zip(zip(*about, strict=True), ("<i8", "<i8", "<i4", "<i4"), strict=True))
            part = (runs >> np.uint64(32)).astype(np.uint16)
            order = np.argsort(part, kind="stable")
            ends, runs, which = np.searchsorted(part[order], np.arange(parts + 1)), runs.astype("<u4")[order], which[order]
            rows = []
            for p, (a, b) in enumerate(itertools.pairwise(ends)):
                if a < b:
                    times = np.bincount(which[a:b], minlength=len(held))
                    own = np.flatnonzero(times)
                    joined = np.flatnonzero(label[own] != node[own])
                    rows.append((p, *[c.tobytes() for c in (runs[a:b], times[own].astype("<u4"), node[own], n[own], lost[own], joined.astype("<u4"), label[own][joined])]))
            return pd.DataFrame(rows, columns=["part", "runs", "times", "nodes", "sizes", "lost", "joined", "labels"])

        for nodes, texts, more in unseen(batches):
            for node, ids, label in zip(nodes, texts, more["label"], strict=True):
                if len(ids) >= LONG:
                    own = labelled(ids, RUN) >> shift
                    runs = np.unique(own)
                    held.append(runs)
                    about.append((node, label, len(ids), len(own) - len(runs)))
                    size += len(runs)
                    if size >= DEALT:
                        yield flushed()
                        held, about, size = [], [], 0
        if held:
            yield flushed()

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        read = lambda c, t: [np.frombuffer(x, t) for x in rows[c]]
        node, joined, named, times = read("nodes", "<i8"), read("joined", "<u4"), read("labels", "<i8"), np.concatenate(read("times", "<u4"))
        label = [x.copy() for x in node]
        for x, at, to in zip(label, joined, named, strict=True):
            x[at] = to
        g = np.concatenate(read("runs", "<u4"))
        twice = repeated(g)
        # most runs are one text's alone; what is known of their texts isn't repeated for them
        g, text = g[twice], np.repeat(np.arange(len(times), dtype=np.uint32), times)[twice]
        node, label, n, lost = (np.concatenate(c)[text] for c in (node, label, read("sizes", "<i4"), read("lost", "<i4")))
        del twice, text
        met = met_runs(g, node, label, n)
        keys, node, need = run_keys(g[met], node[met]), node[met], np.maximum(least_shared(n[met]) - lost[met], 1)
        bucket = node & (parts - 1)
        order = np.lexsort((keys, node, bucket))
        keys, node, need, bucket = keys[order], node[order], need[order], bucket[order]
        place = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (keys[1:] != keys[:-1])][: len(node)])
        ends = np.searchsorted(bucket[place], np.arange(parts + 1))
        columns = keys[place], node[place], np.diff(np.r_[place, len(node)]).astype("<u4"), need[place].astype("<i4")
        out = [(i, *[c[a:b].tobytes() for c in columns]) for i, (a, b) in enumerate(itertools.pairwise(ends)) if a < b]
        return pd.DataFrame(out, columns=["bucket", "keys", "nodes", "runs", "need"])

    def keep(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys, node, runs, need = (np.concatenate([np.frombuffer(x, t) for x in rows[c]]) for c, t in (("keys", "<i8"), ("nodes", "<i8"), ("runs", "<u4"), ("need", "<i4")))
        keys, node = rarest(node, keys, runs, need)
        return pd.DataFrame({"key": keys, "node": node})

    named = docs.join(F.broadcast(labels) if few else labels, "node", "left").select("node", "text", F.coalesce("label", "node").alias("label"))
    dealt = by_slices(named, deal, "part int, runs binary, times binary, nodes binary, sizes binary, lost binary, joined binary, labels binary")
    met = dealt.groupBy("part").applyInPandas(thrifty(meet), "bucket int, keys binary, nodes binary, runs binary, need binary")
    return met.groupBy("bucket").applyInPandas(thrifty(keep), "key long, node long")


def coded(docs: DataFrame) -> DataFrame:
    """docs(node, text) as (node, code, n, bag, bits): a code point for each word, the number of words, and bounded()."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for nodes, texts, _ in unseen(batches):
            codes = [((ids & np.uint64(0xFFFFF)).astype("<u4") + np.uint32(0x10000)).tobytes().decode("utf-32-le") for ids in texts]
            bags, bits = zip(*map(bounded, texts), strict=True) if texts else ((), ())
            yield pd.DataFrame({"node": nodes, "code": codes, "n": [len(ids) for ids in texts], "bag": list(bags), "bits": list(bits)})

    return by_slices(docs, run, "node long, code string, n int, bag array<int>, bits array<long>")


def coded_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """coded() texts of docs(node, text), once each, of the nodes in wanted."""
    few = wanted.count() <= BROADCAST_NODES
    return stash(coded(docs.join(F.broadcast(wanted) if few else wanted, "node", "left_semi")).dropDuplicates(["node"]), "codes")


def verified(pairs: DataFrame, codes: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """pairs(node, hub) of edit similarity `least` or more; codes(node, code, n).

    A narrow band is tried first: most links are close.
    """
    a, b = codes.select("node", F.col("code").alias("ca"), F.col("n").alias("na")), codes.select(F.col("node").alias("hub"), F.col("code").alias("cb"), F.col("n").alias("nb"))
    long = F.greatest("na", "nb")
    most = F.floor(F.lit(1 - least + 1e-9) * long).cast("int")
    joined = pairs.join(a, "node").join(b, "hub").where(F.abs(F.col("na") - F.col("nb")) <= most)
    narrow = F.floor(most / 8).cast("int")
    return joined.where((F.call_function("levenshtein", F.col("ca"), F.col("cb"), narrow) >= 0) | (F.call_function("levenshtein", F.col("ca"), F.col("cb"), most) >= 0)).select("node", "hub")


def may_be_near(na: Column, nb: Column, bag_a: Column, bag_b: Column, bits_a: Column, bits_b: Column, least: float = SIMILARITY) -> Column:
    """False only if the edit similarity is below `least`: an edit changes one count at most each way, and two pairs of words."""
    most = F.floor(F.lit(1 - least + 1e-9) * F.greatest(na, nb)).cast("int")
    apart = F.aggregate(F.zip_with(bag_a, bag_b, lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    # counts that fell and counts that rose each need an edit: the larger of their sums is half of all and of the lengths' difference
    # a replaced word changes two pairs each way, one put in or left out three in all
    differ = F.aggregate(F.zip_with(bits_a, bits_b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return F.when(F.abs(na - nb) <= most, (differ + F.abs(na - nb) <= 4 * most) & (apart + F.abs(na - nb) <= 2 * most)).otherwise(F.lit(False))


def components(links: DataFrame) -> DataFrame:
    """links(node, hub) as (node, label): label is the least node of its component."""
    edges = stash(links.select(F.greatest("node", "hub").alias("u"), F.least("node", "hub").alias("v")).where("u > v").distinct(), "edges")
    state = None
    # the steps never add edges
    few = edges.count() <= FEW_EDGES
    dealt = lambda df: df.coalesce(1) if few else df
    while True:
        both = dealt(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = dealt(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))).where("u > v").distinct()
        new = stash(small, "edges")
        found = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        discard(edges)
        edges = new
        if found == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state = found


def with_label(df: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    """df with the label of its column node; a node without links is its own label."""
    named = labels.select(F.col("node").alias(node), F.col("label").alias(label))
    return df.join(named, node, "left").withColumn(label, F.coalesce(label, node))


def joined_classes(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels(node, label), as components() has them, after further links(node, hub): only the links between classes are gone through."""
    between = with_label(with_label(links, labels, "node", "a"), labels, "hub", "b").select(F.col("a").alias("node"), F.col("b").alias("hub"))
    more = components(between)
    # a class that joins another was its own label so far, and so not in labels
    return stash(with_label(labels.withColumnRenamed("label", "old"), more, "old", "label").select("node", "label").unionByName(more), "labels")


class Links:
    """The links found so far, the classes they make, and what is needed to verify more."""

    def __init__(self, codes: DataFrame):
        spark = codes.sparkSession
        self.codes, self.found = codes, spark.createDataFrame([], "node long, hub long")
        self.labels = spark.createDataFrame([], "node long, label long")

    def crossing(self, pairs: DataFrame) -> DataFrame:
        """The rows of pairs(node, hub, ...) whose two nodes are in different classes."""
        return with_label(with_label(pairs, self.labels, "node", "a"), self.labels, "hub", "b").where("a <> b").select(pairs.columns)

    def verify(self, pairs: DataFrame, codes: DataFrame | None = None) -> None:
        """Adds the links among pairs(node, hub)."""
        new = stash(verified(pairs.select("node", "hub"), self.codes if codes is None else codes), "links")
        if not new.isEmpty():
            self.found = self.found.unionByName(new)
            self.labels = joined_classes(self.labels, new)

    def verify_few(self, pairs: DataFrame, codes: DataFrame) -> None:
        """verify() of pairs whose texts are in codes: if they are small they are broadcast, not sent to each pair."""
        if pairs.isEmpty():
            return
        wanted = pairs.select("node").unionByName(pairs.select(F.col("hub").alias("node"))).distinct()
        codes = stash(codes.select("node", "code", "n").join(wanted, "node", "left_semi"), "few")
        size = codes.agg(F.coalesce(F.sum(F.octet_length("code")), F.lit(0))).first()[0]
        if size:
            self.verify(pairs.repartition(F.xxhash64("node", "hub")), F.broadcast(codes) if size <= BROADCAST_BYTES else codes)

    def counts(self) -> DataFrame:
        """node, links: how many verified links each node has."""
        ends = self.found.select("node").unionByName(self.found.select(F.col("hub").alias("node")))
        return ends.groupBy("node").agg(F.count("*").alias("links"))


def gathered(members: DataFrame) -> DataFrame:
    """members(key, node) of the buckets with two nodes or more, with size (of the bucket)."""
    sizes = members.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("size")).where("low < high").select("key", "size")
    return members.join(sizes, "key")


def with_hub(members: DataFrame) -> DataFrame:
    """gathered() members with the hub of their bucket: the node whose buckets are largest together."""
    scores = members.groupBy("node").agg(F.sum("size").alias("met"))
    hubs = members.join(scores, "node").groupBy("key").agg(F.max(F.struct("met", "node"))["node"].alias("hub"))
    return members.join(hubs, "key")


def mixed_buckets(members: DataFrame, links: Links) -> DataFrame:
    """key, node, size, a (class) of the members(key, node) whose bucket holds two classes or more."""
    named = with_label(members.select("key", "node"), links.labels, "node", "a")
    kept = named.groupBy("key").agg(F.min("a").alias("low"), F.max("a").alias("high"), F.count("*").alias("size")).where("low < high").select("key", "size")
    return named.join(kept, "key")


def small_pairs(members: DataFrame, bounds: DataFrame) -> DataFrame:
    """node, hub: the pairs of different classes of mixed_buckets() of at most SMALL members that bounds don't rule out."""
    small = members.where(F.col("size") <= SMALL).select("key", "node", "a").join(bounds, "node")
    other = small.select("key", *[F.col(c).alias(f"{c}_2") for c in ("node", "a", "n", "bag", "bits")])
    pairs = small.join(other, "key").where(F.col("node") > F.col("node_2")).where(F.col("a") != F.col("a_2")).where(may_be_near(*[F.col(c) for c in ("n", "n_2", "bag", "bag_2", "bits", "bits_2")]))
    return pairs.select("node", F.col("node_2").alias("hub")).distinct()


class Words:
    """The words of texts, given as coded(), to count how many of them a text shares with each of others.

    A code point's repetitions in a text are numbered: of those of another, as many are shared as have less numbers than it has repetitions.
    """

    def __init__(self, codes: list[str]):
        words = [np.sort(np.frombuffer(c.encode("utf-32-le"), "<u4") - np.uint32(0x10000)) for c in codes]
        self.ends = np.cumsum([0, *map(len, words)])
        self.words, at = np.concatenate(words), np.arange(self.ends[-1])
        new = np.ones(len(at), bool)
        new[1:] = self.words[1:] != self.words[:-1]
        new[self.ends[:-1][self.ends[:-1] < len(at)]] = True
        self.number = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint32)

    def shared(self, x: np.ndarray, other: Words, y: np.ndarray) -> np.ndarray:
        """How many words text x[i] has in common with other's text y[i], repetitions counted; x in order."""
        out, table = np.empty(len(x), np.int64), np.zeros(1 << 20, np.uint32)
        begins = np.flatnonzero(np.r_[True, x[1:] != x[:-1]][: len(x)])
        for low, high in zip(begins, np.r_[begins[1:], len(x)][: len(begins)], strict=True):
            a, b = self.ends[x[low]], self.ends[x[low] + 1]
            # the last number of a word's repetitions is written last
            table[self.words[a:b]] = self.number[a:b] + np.uint32(1)
            sizes = other.ends[y[low:high] + 1] - other.ends[y[low:high]]
            done = 0
            while done < len(sizes):
                more = max(1, int(np.searchsorted(np.cumsum(sizes[done:]), COUNTED, "right")))
                n = sizes[done : done + more]
                ends = np.r_[0, np.cumsum(n)]
                at = np.repeat(other.ends[y[low + done : low + done + len(n)]] - ends[:-1], n) + np.arange(ends[-1])
                hits = np.r_[0, np.cumsum(other.number[at] < table[other.words[at]])]
                out[low + done : low + done + len(n)] = hits[ends[1:]] - hits[ends[:-1]]
                done += more
            table[self.words[a:b]] = 0
        return out


def block_pairs(one: tuple, two: tuple | None, least: float = SIMILARITY) -> tuple:
    """Pairs of different classes, of members (node, a, n, bag, bits: arrays, Words) of two blocks or of one, that may_be_near() and their shared words leave: node, hub, a, b, slack.

    Counts above 255 are cut there, which only brings them nearer; slack is the share of the allowed edits that are sure: the words of the longer text that aren't shared.
    """
    other, out = two or one, []
    for i in range(0, len(one[0]), 64):
        most = np.floor((1 - least + 1e-9) * np.maximum(one[2][i : i + 64, None], other[2][None, :])).astype(np.int32)
        apart = np.abs(one[2][i : i + 64, None] - other[2][None, :])
        near = (one[1][i : i + 64, None] != other[1][None, :]) & (apart <= most)
        if two is None:
            near &= np.arange(i, i + len(near))[:, None] > np.arange(len(other[0]))[None, :]
        x, y = np.nonzero(near)
        differ = np.bitwise_count(one[4][i + x] ^ other[4][y]).sum(axis=1, dtype=np.int32)
        kept = differ + apart[x, y] <= 4 * most[x, y]
        x, y = x[kept], y[kept]
        p, q = one[3][i + x], other[3][y]
        sure = (np.maximum(p, q) - np.minimum(p, q)).sum(axis=1, dtype=np.int32) + apart[x, y]
        kept = sure <= 2 * most[x, y]
        x, y = x[kept], y[kept]
        sure = np.maximum(one[2][i + x], other[2][y]) - one[5].shared(i + x, other[5], y)
        kept = sure <= most[x, y]
        x, y = x[kept], y[kept]
        out.append((one[0][i + x], other[0][y], one[1][i + x], other[1][y], sure[kept] / np.maximum(most[x, y], 1.0)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def large_pairs(members: DataFrame, codes: DataFrame, closest: bool) -> DataFrame:
    """node, hub: like small_pairs() of the larger buckets, without those that share too few words; with closest, of each two classes only the pair that shares most.

    A bucket is cut in blocks of about BLOCK members, and each two blocks are one unit of work, whatever the bucket's size.
    """
    large = members.where(F.col("size") > SMALL).join(codes, "node")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    large = large.withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    units = large.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "a", "n", "bag", "bits", "code")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        side = lambda r: (r["node"].to_numpy(), r["a"].to_numpy(), r["n"].to_numpy(np.int32), np.minimum(np.stack(r["bag"].to_list()), 255).astype(np.uint8), np.stack(r["bits"].to_list()).view(np.uint64), Words(r["code"].to_list()))
        first, second = rows[rows["block"] == key[1]], rows[rows["block"] == key[2]] if key[1] != key[2] else None
        if not len(first) or (second is not None and not len(second)):
            return pd.DataFrame({c: np.empty(0, np.int64) for c in ("node", "hub", "a", "b")} | {"slack": np.empty(0)})
        node, hub, a, b, slack = block_pairs(side(first), None if second is None else side(second))
        out = pd.DataFrame({"node": np.maximum(node, hub), "hub": np.minimum(node, hub), "a": np.minimum(a, b), "b": np.maximum(a, b), "slack": slack})
        return out.sort_values("slack").drop_duplicates(["a", "b"]) if closest else out

    found = units.groupBy("key", "i", "j").applyInPandas(thrifty(run), "node long, hub long, a long, b long, slack double")
    if closest:
        return found.groupBy("a", "b").agg(F.min_by(F.struct("node", "hub"), F.struct("slack", "node", "hub")).alias("p")).select("p.node", "p.hub")
    return found.select("node", "hub").distinct()


def settled(members: DataFrame, links: Links, docs: DataFrame) -> None:
    """Compares all members(key, node) of one key and different classes, but for those that exact bounds rule out."""
    members = stash(mixed_buckets(members, links), "members")
    codes = coded_of(docs, stash(members.select("node").distinct(), "wanted"))
    bounds = codes.select("node", "n", "bag", "bits")
    links.verify_few(stash(small_pairs(members, bounds), "pairs"), codes)
    members = stash(mixed_buckets(members.where(F.col("size") > SMALL), links), "members")
    if members.isEmpty():
        return
    # first one pair of each two classes: links join most of them, which makes their other pairs needless
    for closest in (True, False):
        links.verify_few(stash(large_pairs(members, codes, closest), "pairs"), codes)
        if closest:
            members = stash(mixed_buckets(members, links), "members")


def near_only(pairs: DataFrame, bounds: DataFrame) -> DataFrame:
    """pairs(node, hub) that exact bounds don't rule out."""
    hubs = bounds.select(F.col("node").alias("hub"), *[F.col(c).alias(f"{c}_2") for c in ("n", "bag", "bits")])
    return pairs.join(bounds, "node").join(hubs, "hub").where(may_be_near(*[F.col(c) for c in ("n", "n_2", "bag", "bag_2", "bits", "bits_2")])).select("node", "hub")


def node_links(docs: DataFrame) -> Links:
    """The links of docs(node, text), rows of equal texts having equal nodes."""
    kept = stash(sketches(docs), "sketches")
    members = gathered(kept.select("node", F.explode(F.concat("sketch", "short")).alias("key")))
    shared = stash(with_hub(stash(members, "buckets")), "shared")
    wanted = stash(shared.select("node").distinct(), "wanted")
    links = Links(coded_of(docs, wanted))
    spokes = stash(shared.where("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("buckets")), "spokes")
    bounds = links.codes.select("node", "n", "bag", "bits")
    # first each node's most common hub: that makes most other pairs needless
    links.verify(near_only(spokes.groupBy("node").agg(F.max_by("hub", F.struct("buckets", "hub")).alias("hub")), bounds))
    links.verify(near_only(links.crossing(spokes.select("node", "hub")), bounds))
    n_words = kept.agg(F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0))).first()[0]
    release(docs.sparkSession)
    runs = stash(sharing(docs, links.labels, n_words), "sharing")
    settled(runs.unionByName(kept.select(F.explode("short").alias("key"), "node").distinct()), links, docs)
    return links


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id, class_size, links (verified ones of its text): one row for each row of docs."""
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(whole_text(F.col(text))).alias("node"))
    links = node_links(as_nodes(docs, text))
    labels = links.labels.join(links.counts(), "node", "left")
    labelled_rows = rows.join(labels, "node", "left").select("doc_id", F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    named = labelled_rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return labelled_rows.join(named, "label").select("doc_id", "class_id", "class_size", "links")


def as_nodes(docs: DataFrame, text: str) -> DataFrame:
    t = whole_text(F.col(text))
    return docs.select(F.xxhash64(t).alias("node"), t.alias("text"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, with all their columns, one row of each class: the one with the least key (nulls last), then least hash.

    Rows that a table repeats are told apart by nothing; of equal keys and texts one is kept.
    """
    t = whole_text(F.col(text))
    labels = node_links(as_nodes(docs, text)).labels
    slim = with_label(docs.select(F.col(key).alias("id"), F.xxhash64(t).alias("node")), labels, "node", "label")
    chosen = slim.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "node")).alias("c"), F.count("*").alias("n"))
    chosen = stash(chosen.select(F.col("c.id").alias("id"), F.col("c.node").alias("node")), "chosen")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("rid"), F.xxhash64(t).alias("rnode"))
    kept = rows.join(chosen, F.expr("rid <=> id and rnode = node"))
    repeated = docs.select(F.col(key).alias("id"), F.xxhash64(t).alias("node")).groupBy("id", "node").count().where("count > 1").isEmpty()
    if not repeated:
        kept = kept.dropDuplicates(["rid", "rnode"])
    return kept.select("row.*")
