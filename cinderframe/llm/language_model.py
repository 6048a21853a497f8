"""A Katz backoff language model of words, of any order.

Counts of up to k = 5 are discounted by Good-Turing; the mass that a context loses goes to the words not seen after it,
by the model of the next lower order, so that each context's distribution sums to exactly one:

    P(w | h) = d(c(h w)) c(h w) / n(h)                       if h w was seen
             = alpha(h) P(w | h')                            if not, h' being h without its first word,
               alpha(h) = (1 - sum seen P(w | h)) / (1 - sum seen P(w | h'))
    P(w)     = d(c(w)) c(w) / N                              if w was seen, else the mass that singletons and the like lost

A context none of whose counts is discounted gets one observation more, of something unseen. A context that was never
seen backs off entirely. All counts cover all training rows.

How it is computed: documents are encoded once into blocks of about BLOCK tokens, each a file in the folder that all
executors share (a task gives files fresh names, and only those of the attempt that won are ever read). The model's tables are
partitioned by ranges of a 64-bit hash of the n-gram, or of the context. A block asks each partition for the totals of
its own different n-grams, sorted, and brings its own counts along; the partition sums them and answers in the order of
the asking. So an n-gram travels once from each block that has it, however frequent it is, and what comes back is counts
only, with two flags: whether the block owns the n-gram (one of those that have it does), and whether no other block
has it. A longer n-gram around one that no other block has is known to be the block's alone, so it isn't asked for;
this makes higher orders cheap. An owner adds the n-gram to the sums of its context; contexts are asked for and answered
alike. Each order is one such round. Scoring evaluates the recursion for each token of a block from the answers. No
table is broadcast or collected; the driver gets a spectrum (seven numbers) for each order. Where blocks are so many that
they share few n-grams with a partition, this degrades to a row for each n-gram and block.

Defined results: a null text is an empty one, of one token (the end); texts are taken whole, of any length; rows that
repeat are counted as often as they occur and have equal scores; a null key is hashed as the empty string; with no
training rows N is 0 and all words share the unseen mass 1; an empty table gives an empty result; only the key and the
text of the input are used, so other columns of any name do no harm.
"""

from __future__ import annotations

import secrets
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderframe.llm.common import WordHash, fresh_dir, mixed, opened, release, stash, whole_text

BEGIN, END = 1, 2
#: Words of an n-gram by default; the operator takes any order, README says what order 3 needs of disk.
ORDER = 2
#: Counts up to this one are discounted.
GOOD_TURING = 5
#: Tokens of a block, about; a document is in one block. N-grams of a partition at most, about.
BLOCK, PART = 1 << 19, 1 << 20
SCHEMA = pa.schema([("ids", pa.list_(pa.string())), *[(c, pa.binary()) for c in ("lengths", "train", "words", "codes")]])
ODD = np.uint64(0x9E3779B97F4A7C15)


def planes(a: np.ndarray) -> bytes:
    """An array, byte plane by byte plane: planes of zeros vanish when rows are compressed."""
    return a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()


def unplaned(b: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(b, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def packed(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked(b: bytes) -> np.ndarray:
    return np.cumsum(unplaned(b, "<u8"), dtype=np.uint64)


def encoded(docs: DataFrame, folder: str, key: str, text: str, folds: int) -> DataFrame:
    """Writes docs as blocks; returns block (the file's name), tokens, train_tokens.

    A block holds ids, lengths, train (flags), words (different ones, hashed), codes (a place in words for each token).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, turn = WordHash(), 0
        ids, flat, lengths = [], [], []

        def written() -> pd.DataFrame:
            words, codes, counts = np.unique(np.concatenate(flat), return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")  # frequent words get small codes
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            train = np.array([zlib.crc32((i or "").encode()) % folds != 0 for i in ids])
            # in the order of partitions, so that sums are the same in each run; attempts differ in the low bits
            block = TaskContext.get().partitionId() << 40 | turn << 16 | secrets.randbits(16)
            row = {"ids": ids, "lengths": planes(np.array(lengths, "<i4")), "train": train.tobytes(), "words": words[order].tobytes(), "codes": planes(place[codes])}
            with opened(f"{folder}/{block}.parquet", "w") as file:
                pq.write_table(pa.Table.from_pylist([row], SCHEMA), file, compression="zstd", use_dictionary=False)
            return pd.DataFrame({"block": [block], "tokens": [sum(lengths)], "train_tokens": [int(np.array(lengths)[train].sum())]})

        held = 0
        for batch in batches:
            for i, t in zip(batch["doc_id"], batch["text"], strict=True):
                words = t.encode().lower().split()  # bytes: only A to Z get lower, only ASCII white space separates
                flat.append(np.fromiter((known[w] for w in words), np.uint64, len(words)))
                flat.append(np.array([END], np.uint64))
                ids.append(i)
                lengths.append(len(words) + 1)
                held += len(words) + 1
                if held >= BLOCK:
                    yield written()
                    ids, flat, lengths, held, turn = [], [], [], 0, turn + 1
        if ids:
            yield written()

    slim = docs.select(F.col(key).cast("string").alias("doc_id"), whole_text(F.col(text)).alias("text"))
    return slim.mapInPandas(run, "block long, tokens long, train_tokens long")


def discounts(spectrum: dict[int, int], k: int = GOOD_TURING) -> list[float]:
    """d(1) to d(k) from the numbers of types seen 1 to k + 1 times.

    Where the spectrum is too thin for Good-Turing, absolute discounting by n1 / (n1 + 2 n2).
    """
    n = [spectrum.get(r, 0) for r in range(k + 2)]
    if all(n[1:]):
        share = (k + 1) * n[k + 1] / n[1]
        if share < 1:
            d = [((r + 1) * n[r + 1] / (r * n[r]) - share) / (1 - share) for r in range(1, k + 1)]
            if all(0 < x < 1 for x in d):
                return d
    least = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return [(r - least) / r for r in range(1, k + 1)]


def discounted(c: np.ndarray, d: list[float]) -> np.ndarray:
    return c * np.concatenate([[1.0], d, [1.0]])[np.minimum(c, len(d) + 1).astype(int)]


class Block:
    """A file of encoded(): its tokens' n-grams."""

    def __init__(self, folder: str, number: int, order: int):
        with opened(f"{folder}/{number}.parquet", "r") as file:
            row = pq.read_table(file).to_pylist()[0]
        self.number, self.ids, self.lengths = int(number), row["ids"], unplaned(row["lengths"], "<i4")
        self.train = np.frombuffer(row["train"], bool)
        self.trained = np.repeat(self.train, self.lengths).astype(float)
        words = np.frombuffer(row["words"], np.uint64)[unplaned(row["codes"], "<u4")]
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(int)
        self.start = np.zeros(len(words), bool)
        self.start[self.starts] = True
        #: Of each order the n-gram that ends at each token, and the one before any token.
        self.grams, self.begins = [words], [np.uint64(BEGIN)]
        for o in range(2, order + 1):
            begin = self.begins[-1:]
            before = np.where(self.start, begin[0], np.concatenate([begin, self.grams[-1][:-1]]))
            self.grams.append(mixed(before * ODD + words + np.uint64(o)))
            self.begins.append(mixed(np.array(begin) * ODD + np.uint64(BEGIN + o))[0])


class Level:
    """The different n-grams of one order in a block: sorted keys, where each occurs first, each token's place among them.

    With totals, ownership and whether no other block has them, once the partitions have answered.
    """

    def __init__(self, block: Block, order: int, below: Level | None, answers: list[bytes]):
        self.order, self.below, self.block = order, below, block
        self.keys, self.first, self.place = np.unique(block.grams[order - 1], return_index=True, return_inverse=True)
        self.counts = np.bincount(self.place, block.trained, len(self.keys))
        self.asked = np.ones(len(self.keys), bool)
        if order > 2:
            inner = ~block.start[self.first]
            self.asked = ~(below.private[below.place[self.first]] | inner & below.private[below.place[self.first - 1]])
        self.totals, self.owned, self.private = self.counts.copy(), self.counts > 0, np.ones(len(self.keys), bool)
        if answers:
            found = [answered(a) for a in answers]
            for mine, j in ((self.totals, 0), (self.owned, 1), (self.private, 2)):
                mine[self.asked] = np.concatenate([f[j] for f in found])

    def questions(self, parts: int) -> pd.DataFrame:
        seen = self.counts[~self.asked & (self.counts > 0)]
        return dealt(self.block.number, self.order, self.keys[self.asked], [self.counts[self.asked].astype("<u8")], parts, spectrum(seen))

    def contexts(self, d: list[float], p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """The keys of contexts (those of the level below, and the one of beginnings), each token's place among them, which to ask for, and the sums over owned n-grams."""
        n = len(self.below.keys)
        of = np.concatenate([[n], self.below.place[:-1]])
        of[self.block.starts] = n
        keys = np.append(self.below.keys, self.block.begins[self.order - 2])
        ask = np.flatnonzero((np.bincount(of, minlength=n + 1) > 0) & ~np.append(self.below.private, False))
        at, c = self.first[self.owned], self.totals[self.owned]
        return keys, of, ask[np.argsort(keys[ask])], [np.bincount(of[at], v, n + 1) for v in (c, discounted(c, d), p[at])]


def answered(a: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, bits = int.from_bytes(a[:4], "little"), np.frombuffer(a[4:], np.uint8)
    flags = np.split(bits[8 * n :], 2)
    return unplaned(a[4 : 4 + 8 * n], "<u8").astype(float), *[np.unpackbits(f, count=n).astype(bool) for f in flags]


def spectrum(seen: np.ndarray) -> list[int]:
    """How many types there are, and how many were seen 1 to k + 1 times."""
    return [len(seen), *np.bincount(np.minimum(seen, GOOD_TURING + 2).astype(int), minlength=GOOD_TURING + 3)[1 : GOOD_TURING + 2].tolist()]


def dealt(block: int, kind: int, keys: np.ndarray, values: list[np.ndarray], parts: int, types: list[int]) -> pd.DataFrame:
    """Rows for the partitions that sorted keys fall into; the first one takes the spectrum of what isn't asked for."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(int)
    ends = np.searchsorted(part, np.arange(parts + 1))
    at = np.flatnonzero(np.diff(ends)) if len(keys) else np.zeros(1, int)
    cuts = [slice(ends[p], ends[p + 1]) for p in at]
    return pd.DataFrame({
        "block": block, "kind": kind, "part": at, "keys": [packed(keys[c]) for c in cuts],
        "amounts": [b"".join(planes(v[c]) for v in values) for c in cuts], "spectrum": [types] + [[0] * len(types)] * (len(at) - 1),
    })


ASKED = "block long, kind int, part int, keys binary, amounts binary, spectrum array<long>"
ANSWERS = "block long, kind int, part int, answer binary, spectrum array<long>"


def totals(rows: pd.DataFrame) -> pd.DataFrame:
    """The answers of one partition to all blocks that asked it."""
    rows = rows.sort_values("block")
    keys = [unpacked(k) for k in rows["keys"]]
    flat, types = np.concatenate(keys), rows["spectrum"].tolist()
    distinct, place = np.unique(flat, return_inverse=True)
    ends = np.cumsum([0, *map(len, keys)])
    each = list(zip(ends, ends[1:], strict=False))
    if rows["kind"].iloc[0] > 0:
        mine = np.concatenate([unplaned(v, "<u8") for v in rows["amounts"]])
        sums = np.bincount(place, mine, len(distinct))
        had = np.flatnonzero(mine)[::-1]
        first = np.full(len(distinct), -1)
        first[place[had]] = had
        owned = np.zeros(len(flat), bool)
        owned[first[first >= 0]] = True
        private = (np.bincount(place, minlength=len(distinct)) == 1)[place]
        types[0] = (np.array(types[0]) + spectrum(sums[sums > 0])).tolist()
        answers = [int(b - a).to_bytes(4, "little") + planes(sums[place[a:b]].astype("<u8")) + np.packbits(owned[a:b]).tobytes() + np.packbits(private[a:b]).tobytes() for a, b in each]
    else:
        thirds = [np.split(np.frombuffer(v, np.uint8), 3) for v in rows["amounts"]]
        sums = [np.bincount(place, np.concatenate([unplaned(t[j].tobytes(), "<f8") for t in thirds]), len(distinct)) for j in range(3)]
        den, alpha = weights(*sums)
        answers = [planes(den[place[a:b]]) + planes(alpha[place[a:b]]) for a, b in each]
    return pd.DataFrame({"block": rows["block"], "kind": rows["kind"], "part": rows["part"], "answer": answers, "spectrum": types})


def weights(n: np.ndarray, kept: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a context's counts are divided by, and its alpha."""
    den = np.where(n - kept > 1e-9, n, n + 1)
    return den, np.where(n > 0, (1 - kept / den) / np.maximum(1 - lower, 1e-300), 1.0)


class Model:
    """What a block needs to evaluate the recursion besides the answers: numbers of the whole corpus."""

    def __init__(self, total: int):
        self.total, self.d = total, {}

    def learn(self, order: int, types: list[int]) -> None:
        self.d[order] = discounts(dict(enumerate(types)))
        if order == 1:
            self.types = types[0]
            lost = sum((1 - d) * r * types[r] for r, d in enumerate(self.d[1], 1))
            # a vocabulary without rare words gives the unseen one observation
            self.scale = 1.0 if lost > 1e-12 * self.total or not self.total else self.total / (self.total + 1)
            self.unseen = 1 - (self.total - lost) / self.total * self.scale if self.total else 1.0

    def evaluated(self, block: Block, found: pd.DataFrame, upto: int) -> tuple[list[Level], np.ndarray]:
        """The levels up to one above `upto`, as far as n-grams go, and each token's probability by the order `upto`."""
        by = {k: g.sort_values("part")["answer"].tolist() for k, g in found[found["answer"].map(len) > 4].groupby("kind")}
        levels, p = [], None
        for o in range(1, min(upto + 1, len(block.grams)) + 1):
            levels.append(level := Level(block, o, levels[-1] if levels else None, by.get(o, [])))
            c = level.totals[level.place]
            if o == 1:
                p = np.where(c > 0, discounted(c, self.d[1]) / max(1, self.total) * self.scale, self.unseen)
            elif o <= upto:
                _, of, ask, sums = level.contexts(self.d[o], p)
                den, alpha = weights(*sums)
                halves = [np.split(np.frombuffer(a, np.uint8), 2) for a in by.get(-o, [])]
                for mine, j in ((den, 0), (alpha, 1)):
                    mine[ask] = np.concatenate([np.zeros(0), *[unplaned(h[j].tobytes(), "<f8") for h in halves]])
                p = np.where(c > 0, discounted(c, self.d[o]) / den[of], alpha[of] * p)
        return levels, p


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row for each row of docs.

    Rows whose crc32 of the key, as text, is divisible by `folds` are held out of the training.
    """
    kind = docs.schema[key].dataType.simpleString()
    folder = fresh_dir(docs.sparkSession, "lm-blocks")
    blocks = stash(encoded(docs, folder, key, text, folds), "lm-manifest")
    n, tokens, total = blocks.agg(F.count("*"), F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("train_tokens"), F.lit(0))).first()
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), tokens // PART)
    model = Model(total)

    def answer(asked: DataFrame) -> DataFrame:
        got = stash(asked.groupBy("kind", "part").applyInPandas(totals, ANSWERS), "lm-answers")
        found = got.where("kind > 0").groupBy("kind").agg(*[F.sum(F.col("spectrum")[r]).alias(f"n{r}") for r in range(GOOD_TURING + 2)]).collect()
        for o, *types in found:
            model.learn(o, types)
        release(docs.sparkSession)
        return got.select("block", "kind", "part", "answer")

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number in batch["block"]:
                block = Block(folder, number, order)
                for o in range(1, min(order, 2) + 1):
                    yield Level(block, o, None, []).questions(parts)

    def further(o: int):
        """Asks for the contexts of order o and the n-grams of order o + 1."""

        def run(found: pd.DataFrame) -> pd.DataFrame:
            block = Block(folder, found["block"].iloc[0], order)
            levels, p = model.evaluated(block, found, o - 1)
            keys, _, ask, sums = levels[-1].contexts(model.d[o], p)
            asked = [dealt(block.number, -o, keys[ask], [s[ask] for s in sums], parts, [0] * (GOOD_TURING + 2))]
            if o < order:
                asked.append(Level(block, o + 1, levels[-1], []).questions(parts))
            return pd.concat(asked)

        return run

    def scored(found: pd.DataFrame) -> pd.DataFrame:
        block = Block(folder, found["block"].iloc[0], order)
        levels, p = model.evaluated(block, found, order)
        count = levels[0].totals[levels[0].place]
        base = np.log10((count + 0.1) / (model.total + 0.1 * (model.types + 1)))
        sums = [np.add.reduceat(x, block.starts) for x in (count > 0, base, np.log10(p))]
        return pd.DataFrame({"doc_id": block.ids, "held_out": ~block.train, "n_tokens": block.lengths.astype(np.int64), "n_known": sums[0].astype(np.int64), "train_tokens": model.total, "base_score": sums[1], "score": sums[2]})

    for o in range(1, order + 1):
        model.learn(o, [0] * (GOOD_TURING + 2))
    answers = answer(blocks.repartition(max(1, n)).mapInPandas(first, ASKED))
    for o in range(2, order + 1):
        answers = answers.unionByName(answer(answers.groupBy("block").applyInPandas(further(o), ASKED)))
    out = answers.groupBy("block").applyInPandas(scored, "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))
