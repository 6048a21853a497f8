import base64
import collections
import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cinderframe.llm import fingerprints, language_model, mixing, near_dedup, packing, pii, quality_classifier, quality_rules, registry, sharding, warc

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None), (None, "a null key", "en", "s", 10), (2, "", "en", "s", 0), (3, "one", "en", "s", 3), (4, "one", "en", "t", 3),
    (5, " \n\t ", "en", "t", 4), (6, "x" * 50_000, "en", "t", 50_000), (7, "tie tie tie tie " * 400, "en", "t", 6400), (7, "tie tie tie tie " * 400, "en", "t", 6400),
    (8, "mail a@b.co_x@y.com ip 10.0.0.1 999.1.1.1 card 4111 1111 1111 1111 tel +1 (017) 555-7713 iban GB82 WEST 1234 5698 7654 32", "en", "s", 0),
    (9, "1 " * 3000 + "a@" + "b." * 3000, "en", "s", 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    return real.withColumn("doc_id", F.col("doc_id") + 1000).unionByName(spark.createDataFrame(ODD, SCHEMA)).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(docs):
    """Columns named like those that the operators make."""
    extra = ["size", "shard", "slot", "h", "u", "key", "taken", "target", "node", "label", "spans", "t", "n_words", "row", "fold", "anchors", "own", "toxic", "w", "v", "d"]
    return docs.limit(20).select("*", *[F.lit("x").alias(c) for c in extra])


def local(df):
    return [r.asDict() for r in df.collect()]


RUNS = {
    "sharding": lambda d: sharding.shard(d, 40),
    "near_dedup": near_dedup.classes,
    "keep_one": near_dedup.keep_one,
    "pii": lambda d: pii.report(pii.find(d)),
    "redact": pii.redact,
    "fingerprints": fingerprints.with_next,
    "language_model": language_model.score,
    "packing": lambda d: packing.pack(d, registry.tokenizer_path()),
    "quality_rules": quality_rules.judge,
    "keep_good": quality_rules.keep_good,
    "mixing": mixing.mix,
    "quality_classifier": lambda d: quality_classifier.classify(d, d.sparkSession.createDataFrame([(1001, 1, 0), (1002, 0, 1)], "doc_id long, quality int, toxic int")),
}


@pytest.mark.parametrize("name", RUNS)
def test_empty_and_clashing(name, empty, clashing):
    assert RUNS[name](empty).count() == 0
    n = RUNS[name](clashing).count()
    assert n >= 20 if name not in ("keep_one", "keep_good") else n <= 20


def test_sharding(docs):
    rows, texts = local(sharding.shard(docs, 40)), collections.Counter((d["doc_id"], len((d["text"] or "").encode()) + 16, zlib.crc32((d["text"] or "").encode())) for d in local(docs))
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == texts
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def jump_by_definition(key, shards):
    """The published loop, with Python's own numbers."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_sharding_by_definition(spark, docs):
    keys = {r["doc_id"]: r["h"] % 2**64 for r in local(docs.select("doc_id", F.xxhash64("doc_id").alias("h")))}
    for r in local(sharding.shard(docs, 40)):
        assert (r["shard"], r["grown_shard"]) == (jump_by_definition(keys[r["doc_id"]], 40), jump_by_definition(keys[r["doc_id"]], 41))


def test_a_row_that_repeats(spark):
    many = spark.range(25_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.shard(many, 40)
    assert rows.agg(F.count("*"), F.min("slot"), F.max("slot"), F.count_distinct("slot")).first()[:] == (25_000, 0, 24_999, 25_000)


def test_jump_moves_the_necessary_share():
    keys = np.random.default_rng(0).integers(0, 2**63, 20_000).astype(np.uint64)
    a, b = sharding.jump(keys, 40), sharding.jump(keys, 41)
    assert set(b[a != b]) == {40} and abs((a != b).mean() - 1 / 41) < 0.005 and np.bincount(a).min() > 400


def base_spans(x):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        g = [int(c) for c in m.group() if c.isdigit()]
        if 12 <= len(g) <= 19 and sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(g[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def test_pii(docs):
    texts = {d["doc_id"]: d["text"] or "" for d in local(docs)}
    for r in local(pii.report(pii.find(docs))):
        b = base_spans(texts[r["doc_id"]])
        named = ",".join(f"{pii.KINDS[k].name}:{s}:{e}" for s, k, e in b)
        assert r["base_sha256"] == hashlib.sha256(named.encode()).hexdigest(), (r, named)
        assert [r[f"n_{pii.KINDS[i].name}"] for i in range(4)] == [sum(k == i for _, k, _ in b) for i in range(4)]
        if r["doc_id"] == 8:
            assert "iban" in r["spans"]
    new = {d["doc_id"]: d for d in local(pii.redact(docs))}
    assert "[CARD]" in new[8]["text"] and "4111" not in new[8]["text"] and new[8]["n_chars"] == len(new[8]["text"]) and new[1]["text"] is None


def test_iban_before_words_and_context_after(spark):
    iban = "DE89 3704 0044 0532 0130 00"
    texts = {1: f"{iban} BIC COBADEFF", 2: f"{iban} 100 EUR", 3: f"{iban}, thanks", 4: "123-45-6789 (SSN)", 5: "123-45-6789 (no)", 6: "DE89 3704 0044 0532 0130 01 BIC"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = {1: "iban:0:27", 2: "iban:0:27", 3: "iban:0:27", 4: "ssn:0:11", 5: "", 6: ""}
    found = {r["doc_id"]: ",".join(x for x in r["spans"].split(",") if x[:4] in ("iban", "ssn:")) for r in local(pii.report(pii.find(docs)))}
    assert found == want and {r["doc_id"]: r["text"] for r in local(pii.redact(docs))}[1] == "[IBAN] BIC COBADEFF"


def test_fingerprints(docs):
    d = docs.where("doc_id >= 1000")
    texts = {r["doc_id"]: r["text"] for r in local(d)}
    rows, ids = {r["doc_id"]: r for r in local(fingerprints.with_next(d))}, sorted(texts)
    for a, b in zip(ids, ids[1:] + ids[:1], strict=True):
        x = texts[a]
        edited = x[: len(x) - len(x) // 4] + texts[b][: len(x) // 4]
        assert rows[a]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and rows[a]["n_chars"] == len(x)
        if x != texts[b] and len(x) > 12:
            assert rows[a]["near_edited"] > rows[a]["near_next"]
    assert fingerprints.with_next(docs).count() == docs.count()


def hashed(spark, values, *types):
    """xxhash64 of each of the values, as the operators have it."""
    rows = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)], "i int, " + ", ".join(f"c{j} {t}" for j, t in enumerate(types))).orderBy("i")
    return [r[0] for r in rows.select(F.xxhash64(*[f"c{j}" for j in range(len(types))])).collect()]


def brute_fingerprint(spark, text):
    k, s = fingerprints.K, fingerprints.S
    units = [w[i : i + fingerprints.UNIT] for w in WORD.findall(text) for i in range(0, len(w), fingerprints.UNIT)]
    h = [0] * (k - 1) + hashed(spark, units, "string") + [0] * (k - 1)
    smers = hashed(spark, list(itertools.pairwise(h)), "long", "long")
    places = [i for i in range(len(h) - k + 1) if min(smers[i : i + k - s + 1]) in (smers[i], smers[i + k - s])]
    codes = hashed(spark, [tuple(h[i : i + k]) for i in places], *["long"] * k)
    return [(c & (1 << 27) - 1, i - (places[j - 1] if j else 0)) for j, (c, i) in enumerate(zip(codes, places, strict=True))]


def brute_likeness(a, b):
    links = lambda f: {(f[j - 1][0] if j else -1, *x): x[1] + 1 for j, x in enumerate(f)}
    x, y = links(a), links(b)
    common = sum(v for key, v in x.items() if key in y)
    return 1.0 if not x and not y else common / (sum(x.values()) + sum(y.values()) - common)


def test_fingerprints_by_brute_force(spark, docs):
    short = {1: "one", 2: "a few words only", 3: "x" * 40, 4: " ".join(f"w{(i * 7919) % 31}" for i in range(200)), 5: "", 6: "Ein Satz, der sich wiederholt. " * 9}
    texts = short | {r["doc_id"]: r["text"] for r in local(docs.where("doc_id >= 1000").orderBy(F.length("text")).limit(6))}
    rows, ids = {r["doc_id"]: r for r in local(fingerprints.with_next(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))}, sorted(texts)
    prints = {i: brute_fingerprint(spark, x) for i, x in texts.items() if x}
    prints[5] = []
    for a, b in zip(ids, ids[1:] + ids[:1], strict=True):
        x = texts[a]
        edited = x[: len(x) - len(x) // 4] + texts[b][: len(x) // 4]
        other = brute_fingerprint(spark, edited) if edited.strip() else []
        assert rows[a]["fingerprint"] == "".join(f"{c << 4 | min(d, 15):08X}" for c, d in prints[a])
        assert rows[a]["near_edited"] == pytest.approx(brute_likeness(prints[a], other)) and rows[a]["near_next"] == pytest.approx(brute_likeness(prints[a], prints[b]))


def test_fingerprints_write_one_table(spark, monkeypatch):
    """Repeated rows, null keys and the ends of parts come out of one table of keys."""
    stash, made = fingerprints.stash, []
    monkeypatch.setattr(fingerprints, "stash", lambda df, label: made.append(label) or stash(df, label))
    texts = [(i, f"document {i} of a few words") for i in (*range(40), 7, 7, 39)] + [(None, "no key"), (None, "no key"), (5, "another text")]
    rows = local(fingerprints.with_next(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)))
    follows = {39: "no key", **{i: f"document {i + 1} of a few words" for i in range(39) if i not in (4, 5)}}
    assert made == ["keys"] and collections.Counter(r["doc_id"] for r in rows) == collections.Counter(i for i, _ in texts)
    for i, after in follows.items():
        x = f"document {i} of a few words"
        edited = x[: len(x) - len(x) // 4] + after[: len(x) // 4]
        assert {r["edited_sha256"] for r in rows if r["doc_id"] == i} == {hashlib.sha256(edited.encode()).hexdigest()}


class Katz:
    """The model by dictionaries: counts of each order, and the recursion as its definition says it."""

    def __init__(self, texts, order):
        self.order, self.counts = order, {o: collections.Counter() for o in range(1, order + 1)}
        for t in texts:
            padded = ["^"] * (order - 1) + t
            for i in range(order - 1, len(padded)):
                for o in range(1, order + 1):
                    self.counts[o][tuple(padded[i - o + 1 : i + 1])] += 1
        self.total, self.after = sum(self.counts[1].values()), collections.defaultdict(list)
        for o in range(2, order + 1):
            for g in self.counts[o]:
                self.after[g[:-1]].append(g[-1])
        self.d = {o: self.factors(collections.Counter(c.values())) for o, c in self.counts.items()}
        self.known, self.contexts = {}, {}

    @staticmethod
    def factors(n, k=5):
        if all(n[r] for r in range(1, k + 2)):
            a = (k + 1) * n[k + 1] / n[1]
            d = [((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) for r in range(1, k + 1)] if a < 1 else [0]
            if all(0 < x < 1 for x in d):
                return d
        b = n[1] / (n[1] + 2 * n[2]) if n[1] * n[2] else 0.5
        return [1 - b / r for r in range(1, k + 1)]

    def cut(self, o, c):
        return c * self.d[o][c - 1] if 1 <= c <= 5 else c

    def p(self, gram):
        if gram not in self.known:
            o, c = len(gram), self.counts[len(gram)][gram]
            if o == 1:
                self.known[gram] = self.cut(1, c) / self.total if c else 1 - sum(self.cut(1, x) for x in self.counts[1].values()) / self.total
            else:
                den, alpha = self.context(gram[:-1])
                self.known[gram] = self.cut(o, c) / den if c else alpha * self.p(gram[1:])
        return self.known[gram]

    def context(self, h):
        if h not in self.contexts:
            o = len(h) + 1
            seen = [(self.counts[o][(*h, w)], self.p((*h[1:], w))) for w in self.after[h]]
            n, kept = sum(c for c, _ in seen), sum(self.cut(o, c) for c, _ in seen)
            den = n if n - kept > 1e-9 else n + 1
            self.contexts[h] = (den, (1 - kept / den) / (1 - sum(q for _, q in seen))) if seen else (1, 1.0)
        return self.contexts[h]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_language_model(docs, order):
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    found = [(d["doc_id"], WORD.findall((d["text"] or "").translate(low)) + ["$"]) for d in local(docs.where("length(text) < 20000 or text is null"))]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    model = Katz([t for i, t in found if not held(i)], order)
    words = [g[0] for g in model.counts[1]]
    for h in list(model.after)[:: len(model.after) // 30 + 1]:  # each context sums to one
        assert sum(model.p((*h, w)) for w in words) + model.p((*h, "never seen")) == pytest.approx(1)
    n, v, want = model.total, len(words), []
    for i, t in found:
        padded = ["^"] * (order - 1) + t
        base = sum(math.log10((model.counts[1][(w,)] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = sum(math.log10(model.p(tuple(padded[j : j + order]))) for j in range(len(t)))
        want.append((-1 if i is None else i, held(i), len(t), sum(model.counts[1][(w,)] > 0 for w in t), n, base, score))
    got = local(language_model.score(docs.where("length(text) < 20000 or text is null"), order=order))
    got = [(-1 if r["doc_id"] is None else r["doc_id"], *[r[c] for c in ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")]) for r in got]
    assert len(got) == len(want)
    for x, y in zip(sorted(got), sorted(want), strict=True):
        assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], rel=1e-9)


def test_language_model_of_many_blocks(docs, monkeypatch):
    """Blocks of a few documents, and partitions of a few n-grams, give what one block gives."""
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["score"])
    one = sorted(local(language_model.score(docs)), key=key)
    monkeypatch.setattr(language_model, "BLOCK", 2000)
    monkeypatch.setattr(language_model, "PART", 3000)
    for x, y in zip(one, sorted(local(language_model.score(docs)), key=key), strict=True):
        assert x["n_known"] == y["n_known"] and (x["base_score"], x["score"]) == pytest.approx((y["base_score"], y["score"]), rel=1e-9)


def test_warc(spark):
    rows = [(1, "http://a/é", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u\r\nv", None), (4, "u", ""), (None, "u", "<p>x</p>"), (5, "u", "y" * 3_000_000), (6, "u", "\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in local(warc.roundtrip(pages))}
    for i, _, h in rows:
        h = (h or "").encode()
        assert got[i]["payload_bytes"] == len(h) and got[i]["payload_digest"] == base64.b32encode(hashlib.sha1(h).digest()).decode()
        if got[i]["record_type"] == "response":
            assert bytes(got[i]["payload"]) == h
    assert {i: r["refers_to"] for i, r in got.items()} == {1: 2, 2: None, 3: 4, 4: None, None: 2, 5: None, 6: None}
    assert warc.roundtrip(pages.limit(0)).count() == 0


def test_cut_archive():
    whole = b"".join(warc.record(f"urn:x:{i}", i, "u", b"p" * 500, "00" * 20, None, False) for i in range(9))
    import io

    cut = zlib.compressobj(1, zlib.DEFLATED, 31)
    data = cut.compress(whole) + cut.flush(zlib.Z_SYNC_FLUSH)
    assert len(list(warc.records(warc.inflated(io.BytesIO(data))))) == 9
    assert len(list(warc.records(iter([whole[:-600]])))) == 8


def test_packing(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(registry.tokenizer_path())
    want = collections.Counter()
    for d in local(docs):
        ids = t.encode(d["text"] or "", add_special_tokens=False).ids + [2]
        start = 0
        for length, _ in packing.cut(len(ids)):
            want[d["doc_id"], start, length, zlib.crc32(np.asarray(ids[start : start + length], "<u4").tobytes()), len(ids)] += 1
            start += length
        assert start == len(ids)
    rows = pd.DataFrame(local(packing.pack(docs, registry.tokenizer_path())))
    assert collections.Counter((None if math.isnan(r.doc_id) else int(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows.itertuples()) == want
    for _, g in rows.sort_values("offset").groupby("sequence_id"):
        assert g["length"].sum() <= packing.CAPACITY and (g["offset"].to_numpy() == np.r_[0, g["length"].cumsum().to_numpy()[:-1]]).all()
    assert rows["length"].sum() / (rows["sequence_id"].nunique() * packing.CAPACITY) > 0.97 and rows["sequence_id"].max() + 1 == rows["sequence_id"].nunique()


def test_words_equal_the_tokenizer():
    known, draw = packing.known_words(registry.tokenizer_path()), random.Random(3)
    for letters in ("aZé'sSßÿÀ×÷ªº²½µ09.,!$́ΣσİſK<|endoftext|> \n-’\x7f\x1c 中ñ'll", "aZé'sSßÿÀ09.,!$<|> \n-ñ'll'rethe"):
        for _ in range(3000):
            text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 14)))
            assert list(np.frombuffer(known(text), "<u4")) == known.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_special_literals_equal_the_plain_tokenizer():
    from tokenizers import Tokenizer

    plain, known = Tokenizer.from_file(registry.tokenizer_path()), packing.known_words(registry.tokenizer_path())
    for text in ("end <|endoftext|> of", "a<|startoftext|>中 ñ", "a <|ENDOFTEXT|> b", "<|endoftext|>"):
        assert list(np.frombuffer(known(text), "<u4")) == plain.encode(text, add_special_tokens=False).ids, text


def test_mixing(docs):
    rows = pd.DataFrame(local(mixing.mix(docs)))
    assert sorted(rows["size"]) == sorted(len(WORD.findall(d["text"] or "")) for d in local(docs))
    g = rows.assign(source=rows["source"].fillna("\U0010ffff")).groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), largest=("size", "max")).sort_index()
    cap, w = 3.0 * g["size"].to_numpy(), np.array([(5, 2, 1)[i % 3] for i in range(len(g))])
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if np.minimum(cap, mid * w).sum() < g["size"].sum() else (low, mid)
    assert np.allclose(g["target"], np.minimum(cap, low * w), rtol=1e-6) and (abs(g["taken"] - g["target"]) <= g["largest"]).all() and (rows["taken"] <= 3 * rows["size"]).all()
    assert rows.sort_values(list(rows.columns)).reset_index(drop=True).equals(pd.DataFrame(local(mixing.mix(docs))).sort_values(list(rows.columns)).reset_index(drop=True))


def distance(a, b):
    """Edit distance of two sequences of words, by bit vectors (Myers, Hyyro)."""
    at, m = collections.defaultdict(int), len(a)
    for i, x in enumerate(a):
        at[x] |= 1 << i
    every, up, down, d = (1 << m) - 1, (1 << m) - 1, 0, m
    for y in b:
        eq = at.get(y, 0)
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        rise, fall = down | ~(h | up) & every, up & h
        d += (rise >> (m - 1) & 1) - (fall >> (m - 1) & 1) if m else 1
        rise, fall = (rise << 1 | 1) & every, (fall << 1) & every
        up, down = fall | ~(x | rise) & every, rise & x
    return d


def near_pairs(texts):
    """All pairs of edit similarity 0.8 or more, those of equal texts left out."""
    bags, near = {i: collections.Counter(w) for i, w in texts.items()}, []
    order = sorted(texts, key=lambda i: len(texts[i]))
    for j, b in enumerate(order):
        for a in reversed(order[:j]):
            n = len(texts[b])
            if n - len(texts[a]) > 0.2 * n + 1e-9:
                break
            if texts[a] != texts[b] and sum((bags[b] - bags[a]).values()) <= 0.2 * n + 1e-9 and distance(texts[a], texts[b]) <= 0.2 * n + 1e-9:
                near.append((a, b))
    return near


def test_odd_rows(spark, docs):
    """Nulls, empty and very long texts, and repeated rows, where the operators keep or judge rows."""
    odd = spark.createDataFrame([*ODD, (20, "tie " * 200_000, "en", "t", 800_000)], SCHEMA)
    cls = {r["doc_id"]: r for r in local(near_dedup.classes(odd))}
    assert cls[1]["class_id"] == cls[2]["class_id"] == cls[5]["class_id"] == 1 and cls[3]["class_id"] == cls[4]["class_id"] == 3 and cls[None]["class_id"] is None
    kept = local(near_dedup.keep_one(odd))
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept) == [(False, i) for i in (1, 3, 6, 7, 8, 9, 20)] + [(True, None)]
    judged = local(quality_rules.judge(odd))
    assert len(judged) == 12 and [r["base_failed"] for r in judged if r["doc_id"] in (1, 2, 5, 7, 20)] == [True] * 6 and {r["n_words"] for r in judged if r["doc_id"] == 20} == {200_000}
    assert local(quality_rules.keep_good(odd)) == []
    labels = spark.createDataFrame([(8, 1, 0), (9, 0, 1), (99, 1, 1), (None, None, 1)], "doc_id long, quality int, toxic int")
    assert sorted(r["doc_id"] is None for r in local(quality_classifier.classify(odd, labels))) == [False] * 11 + [True]
    pages = spark.createDataFrame([(1, "u", "<p>", "x", "y", "z")], "page_id long, url string, html string, payload string, sha1 string, refers_to string")
    assert local(warc.roundtrip(pages))[0]["payload_bytes"] == 3


def test_sites_leave_the_document_out(spark):
    """A document's posterior is its own evidence and that of the others of its site, by the formulas."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.classify(docs, labels).join(docs.select("doc_id", "source", "lang"), "doc_id").toPandas()
    p = 1 / (1 + np.exp(-rows["own"]))
    world = (p.sum() + 0.5) / (len(p) + 1)

    def shrink(groups, above):
        rate, n = groups["good"] / groups["n"], groups["n"]
        spread, noise = (n * (rate - above) ** 2).sum() / n.sum(), (above * (1 - above)).sum() / n.sum()
        return min(max((above * (1 - above)).mean() / max(spread - noise, 1e-9), 2.0), 1000.0)

    sums = lambda by: p.groupby([rows[c] for c in by]).agg(good="sum", n="count")
    hosts, paths = sums(["source"]), sums(["source", "lang"])
    host_m = shrink(hosts, pd.Series(world, hosts.index))
    above = (hosts["good"] + host_m * world) / (hosts["n"] + host_m)
    path_m = shrink(paths, pd.Series(above.loc[paths.index.get_level_values(0)].to_numpy(), paths.index))
    for i, r in rows.iterrows():
        h, q = hosts.loc[r["source"]], paths.loc[(r["source"], r["lang"])]
        host = (h["good"] - p[i] + host_m * world) / (h["n"] - 1 + host_m)
        path = (q["good"] - p[i] + path_m * host) / (q["n"] - 1 + path_m)
        z = r["own"] + np.log(path / (1 - path)) - np.log(world / (1 - world))
        assert r["quality"] == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-6)


def test_rules_order_is_the_same_each_time(docs):
    rules = quality_rules.base_rules() + quality_rules.default_rules()
    assert len({tuple(r.name for r in quality_rules.sampled(docs, "doc_id", "text", rules)) for _ in range(3)}) == 1


def test_many_addresses(spark):
    """Spans and redaction of a text of nothing but addresses: time in proportion to their number."""
    n = 20_000
    docs = spark.createDataFrame([(1, " ".join(f"u{i}@ex.com" for i in range(n)))], "doc_id long, text string")
    assert local(pii.report(pii.find(docs)))[0]["n_email"] == n and local(pii.redact(docs))[0]["text"] == " ".join(["[EMAIL]"] * n)


def test_mixing_takes_the_least_keys(spark, monkeypatch):
    """The rows taken once more are those of least place within their source, whatever the bucket size; equal rows too."""
    rows = [(i % 700, f"{'a b c d e f g h'[: 2 * (i % 8) + 1]} {i % 700}", "st"[i % 5 == 0]) for i in range(2800)] + [(1, "same text", "s")] * 900
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).cache()
    whole = local(mixing.mix(docs))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    fine = mixing.mix(docs).toPandas()
    for source, g in fine.groupby("source"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= g["size"].max()
        assert abs(sum(r["taken"] for r in whole if r["source"] == source) - g["target"].iloc[0]) <= g["size"].max()
    keyed = mixing.keyed(docs, "doc_id", "text", "source", 0).toPandas()
    for source, g in fine.groupby("source"):
        places = keyed[keyed["source"] == source].groupby(["doc_id", "size"])["place"].first()
        own = places.loc[list(zip(g["doc_id"], g["size"], strict=True))].to_numpy()
        top = (g["times"] == g["times"].max()).to_numpy()
        assert top.all() or own[top].max() <= own[~top].min()


def test_near_dedup_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts, rows = {d["doc_id"]: WORD.findall(d["text"]) for d in local(docs)}, {r["doc_id"]: r for r in local(near_dedup.classes(docs))}
    near, cls = near_pairs(texts), {i: r["class_id"] for i, r in rows.items()}
    equal = [p for p in itertools.combinations(texts, 2) if texts[p[0]] == texts[p[1]]]
    found = sum(cls[a] == cls[b] for a, b in near)
    assert len(near) > 50 and found >= 0.95 * len(near) and all(cls[a] == cls[b] for a, b in equal) and found + len(equal) >= 0.98 * (len(near) + len(equal))
    root = {i: i for i in texts}
    find = lambda i: i if root[i] == i else find(root[i])
    first = {}
    for i, w in texts.items():
        root[find(i)] = find(first.setdefault(tuple(w), i))
    for a, b in near:
        root[find(a)] = find(b)
    assert all(find(a) == find(c) for a, c in cls.items())  # no class holds strangers
    linked = {i for pair in near for i in pair}
    assert all(rows[i]["links"] == 0 or i in linked or list(texts.values()).count(texts[i]) > 1 for i in rows)
    kept = [r["doc_id"] for r in local(near_dedup.keep_one(docs))]
    assert sorted(kept) == sorted(set(cls.values()))


def test_near_dedup_of_short_texts(spark):
    """Texts of up to 14 words miss no pair."""
    draw, rows = random.Random(5), []
    for i in range(60):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.randint(1, 14))]
        for _ in range(3):
            text = list(base)
            for _ in range(draw.randint(0, 2)):
                text[draw.randrange(len(text))] = f"x{draw.randrange(400)}"
            rows.append((len(rows), " ".join(text)))
    cls = {r["doc_id"]: r["class_id"] for r in local(near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")))}
    pairs = near_pairs({i: t.split() for i, t in rows})
    assert len(pairs) > 30 and [(a, b) for a, b in pairs if cls[a] != cls[b]] == []


def test_near_dedup_of_strangers_with_a_passage(spark):
    """A passage that strangers share makes no class of them, and the copies among them are found."""
    draw = random.Random(9)
    words = lambda n: [f"w{draw.randrange(10**5)}" for _ in range(n)]
    passage, rows = words(60), []
    for i in range(400):
        text = words(70) + passage + words(70)
        rows.append((2 * i, " ".join(text)))
        if i % 10 == 0:
            text[draw.randrange(200)] = "changed"
            rows.append((2 * i + 1, " ".join(text)))
    cls = {r["doc_id"]: r["class_id"] for r in local(near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert cls == {i: i - i % 2 for i, _ in rows}


def test_near_dedup_takes_a_passage_for_few_keys(spark):
    """The runs of a passage that the same texts have are one key, and all pairs that share enough runs still have a key in common."""
    draw, texts = random.Random(37), []
    passage = [f"p{i}" for i in range(100)]
    for i in range(80):
        own = list(passage)
        for place in draw.sample(range(100), 3) if i % 10 == 0 else []:
            own[place] = "changed"
        texts.append([f"w{draw.randrange(10**5)}" for _ in range(30)] + own + [f"w{draw.randrange(10**5)}" for _ in range(30)])
    texts += [["other", *texts[7][1:]], texts[3][:150], texts[5][:40] + ["more"] * 20]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "node long, text string")
    rows = local(near_dedup.sharing(docs, spark.createDataFrame([], "node long, label long"), 13_000))
    keys, runs = collections.defaultdict(set), [{tuple(t[j : j + 3]) for j in range(len(t) - 2)} for t in texts]
    for r in rows:
        keys[r["node"]].add(r["key"])
    need = [int(near_dedup.least_shared(np.array(len(t)))) for t in texts]
    pairs = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if len(runs[a] & runs[b]) >= max(need[a], need[b])]
    assert len(pairs) > 3000 and [p for p in pairs if not keys[p[0]] & keys[p[1]]] == []
    assert len(rows) < 20 * len(texts)  # a key for each run made some 37 a text


@pytest.mark.parametrize("step", [near_dedup.sketches, near_dedup.coded])
def test_near_dedup_holds_few_texts_at_once(spark, step):
    """A worker makes Python values of a slice of a batch, not of all its rows: a batch of 4 MB takes less than 12 MB (coded() of all its rows at once took 17)."""
    text = pa.array([" ".join(f"w{(i * 7919 + j * 104729) % 10**5}" for j in range(150)) for i in range(4000)])
    batch, got = pa.RecordBatch.from_arrays([pa.array(range(4000)), text], ["node", "text"]), {}

    class Docs:
        def mapInPandas(self, run, schema):
            got["run"] = lambda: run(iter([batch.to_pandas()]))

        def mapInArrow(self, run, schema):
            got["run"] = lambda: run(iter([batch]))

    step(Docs())
    tracemalloc.start()
    try:
        nodes = [n for out in got["run"]() for n in (out.column("node").to_pylist() if isinstance(out, pa.RecordBatch) else out["node"])]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert nodes == list(range(4000)) and peak < 12e6


def passages(families):
    """Strangers that share a passage; each has a near copy (edit similarity 0.82) whose own words differ in scattered places."""
    draw = random.Random(17)
    words = lambda n: [f"w{draw.randrange(10**5)}" for _ in range(n)]
    passage, rows = words(60), []
    for i in range(families):
        text = words(70) + passage + words(70)
        rows.append((2 * i, " ".join(text)))
        for place in draw.sample([*range(70), *range(130, 200)], 36):
            text[place] = f"x{draw.randrange(10**5)}"
        rows.append((2 * i + 1, " ".join(text)))
    return rows


def test_near_dedup_loses_no_pair_of_a_large_bucket(spark):
    """Near copies that only buckets of hundreds of strangers hold together are joined; no class holds strangers."""
    rows = passages(150)
    sketch = {i: near_dedup.sketched(near_dedup.labelled(np.array([near_dedup.WordHash()[w] for w in t.encode().split()], np.uint64))) for i, t in rows}
    held = [i for i in range(0, 300, 2) if (sketch[i] == sketch[i + 1]).any()]
    cls = {r["doc_id"]: r["class_id"] for r in local(near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert len(held) > 100 and [i for i in held if cls[i] != cls[i + 1]] == []
    assert all(c == i - i % 2 for i, c in cls.items() if c != i)


def test_keep_one_of_a_large_bucket(spark):
    """The pipeline's stage keeps one of each two near copies that only a large bucket holds together."""
    rows = passages(60)
    sketch = {i: near_dedup.sketched(near_dedup.labelled(np.array([near_dedup.WordHash()[w] for w in t.encode().split()], np.uint64))) for i, t in rows}
    apart = [i + 1 for i in range(0, 120, 2) if not (sketch[i] == sketch[i + 1]).any()]
    kept = sorted(r["doc_id"] for r in local(near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert len(apart) < 20 and set(kept) - set(apart) == set(range(0, 120, 2))


def spread(families):
    """Texts of 15 to 115 words and copies with each fifth word replaced, left out or followed by another: near, without five words in a row in common."""
    draw, rows = random.Random(23), []
    for i in range(families):
        text = [f"w{draw.randrange(10**5)}" for _ in range(15 + i)]
        kind = i % 3
        places = range(4, len(text), 5) if kind < 2 else range(3, len(text) - 1, 4)
        copy = []
        edits = int(0.2 * max(len(text), len(text) + len(places) * (kind == 2)))
        for j, word in enumerate(text):
            edit = j in places and edits > 0
            edits -= edit
            copy += [word] if not edit else {0: [f"x{draw.randrange(10**5)}"], 1: [], 2: [word, f"x{draw.randrange(10**5)}"]}[kind]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(copy))]
    return rows


def test_near_dedup_without_a_common_sketch(spark):
    """Links that no sketch holds are found; keep_one() keeps one of them."""
    rows = spread(101)
    sketch = {i: near_dedup.sketched(near_dedup.labelled(np.array([near_dedup.WordHash()[w] for w in t.encode().split()], np.uint64))) for i, t in rows}
    near = [i for i in range(0, len(rows), 2) if near_pairs({k: rows[k][1].split() for k in (i, i + 1)})]
    assert len(near) > 80 and sum(not (sketch[i] == sketch[i + 1]).any() for i in near) > 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cls = {r["doc_id"]: r["class_id"] for r in local(near_dedup.classes(docs))}
    assert cls == {i: i - i % 2 if i - i % 2 in near else i for i, _ in rows}
    assert {r["doc_id"] for r in local(near_dedup.keep_one(docs))} == set(cls.values())


def star(copies):
    """An original and copies that each insert 55 words of their own into its 300: near it, hardly near each other."""
    draw = random.Random(copies)
    base = [f"w{draw.randrange(10**6)}" for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, copies + 1):
        text = list(base)
        for _ in range(55):
            text.insert(draw.randrange(len(text) + 1), f"x{draw.randrange(10**6)}")
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("copies", [10, 150, 1000])
def test_near_dedup_of_a_star(spark, copies):
    rows = star(copies)
    sketch = {i: near_dedup.sketched(near_dedup.labelled(np.array([near_dedup.WordHash()[w] for w in t.encode().split()], np.uint64))) for i, t in rows}
    candidates = [i for i, _ in rows if (sketch[i] == sketch[0]).any()]
    cls = {r["doc_id"]: r["class_id"] for r in local(near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert len(candidates) > 0.9 * copies and [i for i in candidates if cls[i] != cls[0]] == []


def test_near_dedup_of_texts_that_repeat_words(spark):
    """A text with pairs of words that occur twice and a near copy without them, which share no five words in a row, are joined."""
    draw, rows = random.Random(29), []
    for i in range(20):
        text = [f"w{draw.randrange(10**5)}" for _ in range(40)]
        text[:4] = ["p", f"q{i}"] * 2
        copy = [f"x{draw.randrange(10**5)}" if j % 5 == 2 else w for j, w in enumerate(text)]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(copy))]
    assert len(near_pairs({i: t.split() for i, t in rows})) == 20
    cls = {r["doc_id"]: r["class_id"] for r in local(near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert cls == {i: i - i % 2 for i, _ in rows}


def test_near_dedup_aligns_few_strangers(spark, monkeypatch):
    """Long strangers of one language, whose words and pairs of words are often the same, are not aligned; a near copy among them is."""
    draw = np.random.default_rng(31)
    texts = [[f"w{int(x)}" for x in 3000 * draw.random(1500) ** 2] for _ in range(120)]
    texts.append([f"x{i}" if i % 5 == 0 else w for i, w in enumerate(texts[7])])
    seen, verified = [], near_dedup.verified
    monkeypatch.setattr(near_dedup, "verified", lambda pairs, *rest: seen.append(pairs.count()) or verified(pairs, *rest))
    cls = {r["doc_id"]: r["class_id"] for r in local(near_dedup.classes(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")))}
    assert cls == {i: i if i < 120 else 7 for i in range(121)} and sum(seen) < 20


def test_near_dedup_lists_few_pairs_of_a_large_bucket(spark, monkeypatch):
    """Strangers whose lengths, pairs of words and binned counts allow a link are told apart by the words they share before they are listed."""
    draw = random.Random(43)
    passage, rows, listed, large_pairs = [f"p{i}" for i in range(280)], [], [], near_dedup.large_pairs
    for i in range(60):
        text = passage[:140] + [f"w{draw.randrange(10**5)}" for _ in range(120)] + passage[140:]
        rows.append((2 * i, " ".join(text)))
        if i % 10 == 0:
            for place in draw.sample(range(400), 40):
                text[place] = f"x{draw.randrange(10**5)}"
            rows.append((2 * i + 1, " ".join(text)))
    monkeypatch.setattr(near_dedup, "large_pairs", lambda *args: (found := large_pairs(*args), listed.append(found.count()))[0])
    cls = {r["doc_id"]: r["class_id"] for r in local(near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert cls == {i: i - i % 2 for i, _ in rows} and len(listed) == 2 and sum(listed) < 20


@pytest.mark.parametrize("counted", [1 << 20, 60])
def test_shared_words(monkeypatch, counted):
    monkeypatch.setattr(near_dedup, "COUNTED", counted)
    draw = random.Random(47)
    texts = ["".join(chr(0x10000 + draw.choice([0, 1, 0xFFFFF, draw.randrange(30)])) for _ in range(draw.choice([0, 1, 7, 50]))) for _ in range(60)] + [""]
    one, two = near_dedup.Words(texts[:30]), near_dedup.Words(texts[30:])
    x, y = (v.ravel() for v in np.meshgrid(range(30), range(31), indexing="ij"))
    assert one.shared(x, two, y).tolist() == [sum((collections.Counter(texts[i]) & collections.Counter(texts[30 + j])).values()) for i, j in zip(x, y, strict=True)]
    assert near_dedup.Words(["", ""]).shared(x[:0], two, y[:0]).tolist() == [] and near_dedup.Words([""]).shared(x[:1], near_dedup.Words(["", ""]), y[:1]).tolist() == [0]


def test_near_dedup_rules_out_strangers_of_a_hub(spark, monkeypatch):
    """Strangers that meet a hub by a passage that both have are not aligned with it."""
    rows, seen, verified = passages(150), [], near_dedup.verified
    monkeypatch.setattr(near_dedup, "verified", lambda pairs, *rest: seen.append(pairs.count()) or verified(pairs, *rest))
    near_dedup.node_links(spark.createDataFrame(rows, "node long, text string"))
    assert seen[0] <= 150


@pytest.mark.parametrize("few", [0, 10_000])
def test_classes_grow_by_the_links_between_them(spark, monkeypatch, few):
    """Links that are found later are joined to the classes so far without going through the earlier links again."""
    draw, seen, components, root = random.Random(41), [], near_dedup.components, list(range(200))
    monkeypatch.setattr(near_dedup, "FEW_EDGES", few, raising=False)
    monkeypatch.setattr(near_dedup, "verified", lambda pairs, *rest: pairs)
    monkeypatch.setattr(near_dedup, "components", lambda df: seen.append(df.count()) or components(df))
    links = near_dedup.Links(spark.createDataFrame([], "node long, code string, n int"))
    for size in (80, 30, 20):
        pairs = [(draw.randrange(200), draw.randrange(200)) for _ in range(size)]
        links.verify(spark.createDataFrame(pairs, "node long, hub long"))
        for a, b in pairs:
            low, high = sorted((root[a], root[b]))
            root = [low if x == high else x for x in root]
        assert {r["node"]: r["label"] for r in local(links.labels)} == {i: x for i, x in enumerate(root) if i != x}
    assert links.labels.count() == links.labels.distinct().count() and seen == [80, 30, 20]


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.classify(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1").select("doc_id", "quality".__str__(), F.col("toxic").alias("bad")).withColumnRenamed("quality", "good"), "doc_id").toPandas()
    assert ((rows["quality"] >= 0.5) == (rows["good"] == 1)).mean() > 0.9
    clean = rows[(rows["good"] == 1) & (rows["bad"] == 0)]
    assert clean["kept"].mean() > 0.97


def rejected(text):
    """The base and the rules, as their definitions say them."""
    w = WORD.findall(text)
    n, chars = len(w), sum(map(len, w))
    grams = collections.Counter(zip(w, w[1:], w[2:]))  # noqa: B905
    repeat = len({j for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)})  # noqa: B905
    lines = [x for x in text.split("\n") if WORD.search(x)]
    count = lambda cls: len(re.findall(cls, text))
    return (
        n < 50 or 100 * repeat > 50 * n or count("[#*$%&|<>]") > 0.2 * n or count("[A-Z]") > 0.4 * chars or count("[!?]") > 0.3 * n
        or chars > 20 * n or len(lines) - len(set(lines)) > 0.5 * len(lines)
    )


def test_pipeline_stages_by_brute_force(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    real = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = real.withColumn("doc_id", F.col("doc_id") + 1000)
    rows = rows.unionByName(rows.limit(3)).unionByName(rows.limit(2).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("long"))).unionByName(spark.createDataFrame(ODD, SCHEMA))
    rows.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    bag = lambda frame: collections.Counter(tuple(r) for r in frame)
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        steps[name] = (before, docs.collect())
    before, after = steps["quality_rules"]
    assert bag(after) == bag(r for r in before if not rejected(r["text"] or "")) and 0 < len(after) < len(before)
    before, after = steps["near_dedup"]
    texts = [WORD.findall(r["text"]) for r in before]
    root = list(range(len(texts)))
    find = lambda i: i if root[i] == i else find(root[i])
    pairs = near_pairs(dict(enumerate(texts))) + [p for p in itertools.combinations(range(len(texts)), 2) if texts[p[0]] == texts[p[1]]]
    for a, b in pairs:
        root[find(a)] = find(b)
    groups = {find(i) for i in range(len(texts))}
    of = {before[i]["text"]: find(i) for i in range(len(texts))}
    assert {of[r["text"]] for r in after} == groups and len(groups) <= len(after) <= len(groups) + 0.02 * len(pairs) and not bag(after) - bag(before)
    before, after = steps["pii"]
    spans = {r["doc_id"]: [x.split(":") for x in r["spans"].split(",") if x] for r in local(pii.report(pii.find(spark.createDataFrame(before, SCHEMA))))}
    want = []
    for r in before:
        out, at = "", 0
        for kind, a, b in spans[r["doc_id"]]:
            if int(a) >= at:
                out += r["text"][at : int(a)] + f"[{kind.upper()}]"
            at = max(at, int(b))
        out += r["text"][at:]
        want.append((r["doc_id"], out, r["lang"], r["source"], len(out)))
        assert {(k, int(a), int(b)) for k, a, b in spans[r["doc_id"]]} >= {(pii.KINDS[k].name, a, b) for a, k, b in base_spans(r["text"])}
    assert bag(after) == bag(want)
    before, after = steps["mixing"]
    times = {(r["doc_id"], r["source"]): r for r in local(mixing.mix(spark.read.parquet(f"{tmp_path}/pii")))}
    assert bag(after) == collections.Counter({tuple(r): t for r in before if (t := times[r["doc_id"], r["source"]]["times"])})
    before, after = steps["packing"]
    plain, want = Tokenizer.from_file(registry.tokenizer_path()), collections.Counter()
    for r in before:
        ids = plain.encode(r["text"], add_special_tokens=False).ids + [2]
        start = 0
        for length, _ in packing.cut(len(ids)):
            want[r["doc_id"], start, length, zlib.crc32(np.asarray(ids[start : start + length], "<u4").tobytes()), len(ids)] += 1
            start += length
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in after) == want
    assert bag(r[:5] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == bag(r[:5] for r in after)


@pytest.mark.parametrize("name", registry.ORACLE_SQL)
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    ours, theirs = registry.QUERIES[name](spark, SMALL).toPandas(), db.sql(registry.ORACLE_SQL[name]).df()
    order = sorted(ours.columns)
    pd.testing.assert_frame_equal(*[x[order].sort_values(order).reset_index(drop=True) for x in (ours, theirs)], check_dtype=False)
