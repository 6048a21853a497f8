"""Packing tokens into sequences by reciprocal-capacity classes (harmonic packing).

Class j holds pieces of at most CAPACITY // j tokens, and each of its bins takes exactly j pieces. Documents are cut so
that pieces nearly fill their class: whole capacities first, then the largest class size below the rest, again and again,
until the rest itself fills its class to within SLACK. Cutting needs a document's length only, so workers cut
independently; a piece's place follows from its rank in its class, which is a count over buckets plus a rank within one.

Less than one bin of each class stays incomplete. These pieces, at most j - 1 of class j and so bounded whatever the
input, are put together by first fit, longest first.

Defined results: a null text is an empty one; an empty text is its end token only; texts are taken whole, of any length;
rows that repeat give repeated pieces in places of their own; a null key is returned as null; an empty table gives an
empty result; only the key and the text of the input are used, so other columns of any name do no harm.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cinderframe.llm.common import stash

CAPACITY = 4096
SLACK = 0.01
END = 2
BUCKET_ROWS = 50_000
#: Different words, and parts of words, at most whose tokens a worker remembers; about as many again are being forgotten.
REMEMBERED = 250_000
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, fold int"


def cut(tokens: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """(length, class) of a document's pieces, in order."""
    out = [(capacity, 1)] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        fold = capacity // rest
        size = capacity // fold
        if size - rest <= slack * size:
            out.append((rest, fold))
            break
        size = capacity // (fold + 1)
        out.append((size, capacity // size))
        rest -= size
    return out


class Pairs:
    """Byte-pair merging of one part of a word, with the ids of the tokenizer's file, by the faster of two libraries.

    The file names pairs to merge; the faster library merges any neighbours that make a known token, least rank first.
    Both are the same if each token is what its own bytes merge to: until it is made no merge has crossed its ends, so
    its bytes have merged as they would alone. Tokens that their own bytes don't merge to are never made; they are left
    out. The end of a word is the byte 255, which no UTF-8 text has; it joins the last byte before anything else.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.end, vocab = model["end_of_word_suffix"], model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        order = {pair: i for i, pair in enumerate(merges)}
        made = {"".join(pair) for pair in merges}
        ids = [vocab["".join(pair)] for pair in merges]
        single = [i for t, i in vocab.items() if t not in made]
        if ids != sorted(ids) or max(single) > ids[0]:
            raise ValueError("the ids of the tokenizer's file don't follow its merges")
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(plain)]
        self.byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        dropped = {"".join(pair) for pair in merges if self.merged("".join(pair), order) != ["".join(pair)]}
        ranks = {bytes(map(self.byte.get, t.removesuffix(self.end))) + b"\xff" * t.endswith(self.end): i for t, i in vocab.items() if t not in dropped}
        self.encode = tiktoken.Encoding("parts", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def merged(self, token: str, order: dict[tuple[str, str], int]) -> list[str]:
        """What the bytes of a token merge to on their own."""
        parts = list(token.removesuffix(self.end))
        if token.endswith(self.end):
            parts[-1] += self.end
        while len(parts) > 1:
            rank, i = min((order.get(pair, len(order)), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(order):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def __call__(self, part: str) -> bytes:
        return np.asarray(self.encode(part.encode() + b"\xff"), "<u4").tobytes()


class Memory(dict):
    """A dict that fills itself and forgets what was not asked for while it last filled up."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make, self.older = make, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.make(word)
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


class Words:
    """The ids of a text, as little-endian 32-bit numbers.

    The tokenizer drops white space and splits words at letters, digits and marks before it merges anything. For texts
    of ASCII and western European letters that split is made here; the words of others go to the tokenizer itself, and so
    do, whole, texts that hold the literal of an added token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f)["added_tokens"]]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)").search
        self.parts, self.words = Memory(Pairs(path)), Memory(self.word)

    def word(self, word: str) -> bytes:
        if PLAIN(word):
            return b"".join([self.parts[x] for x in PARTS(word.lower())])
        return np.asarray(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.added(text):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if PLAIN(text):
            return b"".join(map(self.parts.__getitem__, PARTS(text.lower())))
        return b"".join([self.words[x] for x in BREAK.split(text) if x])


BREAK = re.compile(r"[ \t\n\x0b\x0c\r]+")
#: Texts of characters that normal form C leaves alone and whose lower case is one character.
PLAIN = re.compile("[\x20-\x7e\t-\rÀ-ÖØ-öø-ÿ]*").fullmatch
PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^a-zß-öø-ÿ0-9\\s]+").findall


@functools.cache
def known_words(path: str) -> Words:
    """One memory for each Python worker, whatever number of tasks it runs."""
    return Words(path)


def tokenized(docs: DataFrame, path: str, key: str, text: str) -> DataFrame:
    """doc_id and its pieces: start, length, ids_crc32, doc_tokens, fold (the class).
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, end = known_words(path), np.asarray([END], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, whole in zip(batch["doc_id"], batch["text"], strict=True):
                ids = memoryview(known(whole or "") + end)
                n, start = len(ids) // 4, 0
                for length, fold in cut(n):
                    rows.append((doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, fold))
                    start += length
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "fold"])

    # the key travels as a string: pandas would turn nullable longs into floats
    slim = docs.select(F.col(key).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInPandas(run, "doc_id string, " + PIECES).withColumn("doc_id", F.col("doc_id").cast(kind))


def first_fit(pieces: pd.DataFrame) -> pd.DataFrame:
    """Puts the pieces that fill no bin of their class into bins, longest first, each into the first that has room."""
    pieces = pieces.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
    room, used, places = [], [], []
    open_from = 0
    for length in pieces["length"]:
        while open_from < len(room) and room[open_from] == 0:
            open_from += 1
        b = next((i for i in range(open_from, len(room)) if room[i] >= length), None)
        if b is None:
            b = len(room)
            room.append(CAPACITY)
            used.append(0)
        places.append((b, used[b]))
        room[b] -= length
        used[b] += length
    pieces["bin"], pieces["offset"] = [p[0] for p in places], [p[1] for p in places]
    return pieces


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, fold: one row for each piece."""
    tie = ["doc_id", "start", "length", "ids_crc32"]
    pieces = stash(tokenized(docs, path, key, text), "pieces")
    buckets = max(1, pieces.count() // BUCKET_ROWS)
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64(*tie), F.lit(buckets)))
    # a row for each class (at most 2 * sqrt(CAPACITY)) and bucket
    counts = pieces.groupBy("fold", "bucket").agg(F.count("*").alias("n"))
    before = W.partitionBy("fold").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy("fold")
    counts = counts.select("fold", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank0"), (F.floor(F.sum("n").over(every) / F.col("fold"))).cast("bigint").alias("bins"))
    counts = stash(counts, "pieces-counts")
    by_fold = counts.groupBy("fold").agg(F.first("bins").alias("bins"))
    by_fold = stash(by_fold.withColumn("bin0", F.coalesce(F.sum("bins").over(W.orderBy("fold").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))), "pieces-folds")
    tail0 = by_fold.agg(F.coalesce(F.sum("bins"), F.lit(0))).first()[0]
    rank = F.row_number().over(W.partitionBy("fold", "bucket").orderBy(*tie)) - 1
    ranked = pieces.withColumn("r", rank).join(counts, ["fold", "bucket"]).withColumn("rank", F.col("rank0") + F.col("r"))
    ranked = ranked.join(F.broadcast(by_fold.select("fold", "bin0")), "fold").select(*tie, "doc_tokens", "fold", "rank", "bins", "bin0")
    in_bin = W.partitionBy("sequence_id").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    full = (
        ranked.where(F.col("rank") < F.col("bins") * F.col("fold"))
        .withColumn("sequence_id", (F.col("bin0") + F.floor(F.col("rank") / F.col("fold"))).cast("bigint"))
        .withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)))
    )
    out = [*tie, "doc_tokens", "sequence_id", "offset", "fold"]
    kind = docs.schema[key].dataType.simpleString()
    # fewer than fold pieces of each class are left
    left = ranked.where(F.col("rank") >= F.col("bins") * F.col("fold")).withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("one", F.lit(0))
    fitted = left.groupBy("one").applyInPandas(
        lambda p: first_fit(p)[[*tie, "doc_tokens", "fold", "bin", "offset"]], "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, fold int, bin long, offset long"
    )
    fitted = fitted.withColumn("doc_id", F.col("doc_id").cast(kind)).withColumn("sequence_id", F.col("bin") + F.lit(tail0))
    return full.select(*out).unionByName(fitted.select(*out))
