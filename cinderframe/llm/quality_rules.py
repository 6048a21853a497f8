"""Quality rules as a short-circuit cascade.

Each rule has a predicate that rejects a document, and says how many characters it looks at in one. On a bounded sample,
drawn from the whole table by a hash, the cost (characters looked at) and the selectivity (share rejected) of each rule
are estimated; the rules then run in order of rejection per cost, and a document leaves the cascade at the first rule
that rejects it. The estimates are counts, not times, so reruns choose the same order. The order changes the work, never
the verdict. The base tests are rules of the cascade like others where only the verdict is asked for (keep_good());
where their counts are columns of the result (judge()), all counts are computed once and the rules compare them.

Defined results: a null text counts as empty; an empty text has no words and fails the base; texts are taken whole, of
any length; repeated rows give repeated results; an empty table gives an empty result; only the key and the text of the
input are used, so other columns of any name do no harm. A null key is returned as null.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderframe.llm.common import SPACE_CHARS, let, whole_text, words

#: Rows at most of the sample that estimates cost and selectivity; it only orders the rules.
SAMPLE_ROWS = 256


class Rule(NamedTuple):
    """A predicate on a document (see measures()), and how many characters it looks at."""

    name: str
    rejects: Callable[[dict[str, Column]], Column]
    work: Callable[[dict[str, Column]], Column]


#: Windows that fit the packed form: a position takes the low bits of a long, a hash the rest.
POSITION_BITS = 20


def count_repeat_words(w: Column) -> Column:
    """Words of the array w that lie in a 3-word window found at least twice in w.

    Windows are sorted by hash, so equal ones become neighbours; neighbours count only if their words are equal too.
    """
    n = F.size(w) - 2
    low, high = F.lit((1 << POSITION_BITS) - 1).cast("bigint"), F.lit(-(1 << POSITION_BITS)).cast("bigint")

    def equal_pairs(s: Column, alike, place) -> Column:
        """Places of the sorted windows s whose words equal a neighbour's."""
        near = F.filter(F.sequence(F.lit(0), n - 2), lambda j: alike(s[j], s[j + 1]))

        def both(j: Column) -> Column:
            p, q = place(s[j]), place(s[j + 1])
            same = (w[p] == w[q]) & (w[p + 1] == w[q + 1]) & (w[p + 2] == w[q + 2])
            return F.when(same, F.array(p, q)).otherwise(F.array().cast("array<int>"))

        return F.sort_array(F.array_distinct(F.flatten(F.transform(near, both))))

    def places(h: Column) -> Column:
        hashed = lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))
        windows = F.slice(h, F.lit(1), n)
        packed = F.sort_array(F.transform(windows, lambda x, i: hashed(x, i).bitwiseAND(high).bitwiseOR(i.cast("bigint"))))
        long = F.array_sort(F.transform(windows, lambda x, i: F.struct(hashed(x, i).alias("x"), i.alias("i"))))
        return F.when(
            n < 1 << POSITION_BITS,
            let(packed, lambda s: equal_pairs(s, lambda a, b: a.bitwiseXOR(b).bitwiseAND(high) == 0, lambda a: a.bitwiseAND(low).cast("int"))),
        ).otherwise(let(long, lambda s: equal_pairs(s, lambda a, b: a["x"] == b["x"], lambda a: a["i"])))

    covered = F.aggregate(
        let(F.transform(w, lambda x: F.xxhash64(x)), places),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return F.when(n < 2, F.lit(0).cast("bigint")).otherwise(covered)


def line_counts(text: Column, body) -> Column:
    """body(lines with a word, different ones among them)."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    return let(F.struct(lines.alias("l")), lambda b: body(F.size(b["l"]), F.size(F.array_distinct(b["l"]))))


def symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("bigint")


def measures(text: Column, w: Column) -> dict[str, Column]:
    """What rules look at, of a text that isn't null and its words; each is computed where a rule uses it."""
    stripped = lambda outside: F.length(F.regexp_replace(text, outside, "")).cast("bigint")
    return {
        "n_chars": F.length(text),
        "n_words": F.size(w).cast("bigint"),
        "word_chars": F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)),
        "n_symbols": symbols(text),
        "n_capitals": stripped("[^A-Z]+"),
        "n_exclaiming": stripped("[^!?]+"),
        "lines": line_counts(text, lambda every, distinct: F.struct(every.cast("bigint").alias("all"), (every - distinct).cast("bigint").alias("dup"))),
        "n_repeat_words": count_repeat_words(w),
    }


#: Characters that a word of count_repeat_words() counts as: three hashes and a sort.
REPEAT_WORK = 100


def base_rules() -> list[Rule]:
    n, nothing = lambda m: m["n_words"], lambda m: F.lit(1)
    return [
        Rule("few_words", lambda m: n(m) < 50, nothing),
        Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * n(m), lambda m: n(m) * REPEAT_WORK),
    ]


def default_rules() -> list[Rule]:
    """Rules beyond the base."""
    n, whole = lambda m: m["n_words"], lambda m: m["n_chars"]
    return [
        Rule("symbols", lambda m: m["n_symbols"] > 0.2 * n(m), whole),
        Rule("shouting", lambda m: m["n_capitals"] > 0.4 * m["word_chars"], lambda m: 2 * whole(m)),
        Rule("exclaiming", lambda m: m["n_exclaiming"] > 0.3 * n(m), whole),
        Rule("long_words", lambda m: m["word_chars"] > 20 * n(m), whole),
        Rule("repeated_lines", lambda m: let(m["lines"], lambda x: x["dup"] > 0.5 * x["all"]), lambda m: 3 * whole(m)),
    ]


def order_rules(docs: DataFrame, rules: list[Rule], rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per cost on `rows` rows of docs(key, text), drawn from the whole table by a hash; ties in the order given."""
    drawn = docs.withColumn("h", F.xxhash64("key", "text", F.monotonically_increasing_id()))
    # four times as many as needed pass the threshold, so that a task sends a few rows and not `rows`
    share = min(1.0, 4.0 * rows / max(1, docs.count()))
    drawn = drawn.where(F.abs(F.col("h") / float(1 << 63)) <= share)
    sample = drawn.select("text", "h").orderBy("h").limit(rows).select("text", words(F.col("text")).alias("w"))
    m = measures(F.col("text"), F.col("w"))
    found = sample.agg(F.count("*"), *[f(c) for r in rules for f, c in ((F.count_if, r.rejects(m)), (F.sum, r.work(m)))]).first()
    n = found[0]
    value = lambda i: (found[1 + 2 * i] + 0.5) / (n + 1) / max(1.0, (found[2 + 2 * i] or 0) / max(1, n))
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: -value(i))]


def cascade(rules: list[Rule], m: dict[str, Column]) -> Column:
    """True for rows that no rule rejects; a later rule isn't evaluated once one rejects. A null predicate doesn't reject."""
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(F.coalesce(rule.rejects(m), F.lit(False)), F.lit(False)).otherwise(kept)
    return kept


def sampled(docs: DataFrame, key: str, text: str, rules: list[Rule]) -> list[Rule]:
    return order_rules(docs.select(F.col(key).alias("key"), whole_text(F.col(text)).alias("text")), rules)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, the base counts, base_failed and kept."""
    rules = sampled(docs, key, text, default_rules())
    plain = docs.select(F.col(key).alias("doc_id"), whole_text(F.col(text)).alias("text"))
    counted = plain.select("doc_id", let(words(F.col("text")), lambda w: F.struct(*[c.alias(k) for k, c in measures(F.col("text"), w).items()])).alias("m"))
    m = {k: F.col(f"m.{k}") for k in measures(F.lit(""), F.array())}
    failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    return counted.select(
        "doc_id",
        "m.n_words",
        "m.word_chars",
        "m.n_symbols",
        F.col("m.lines.dup").alias("n_dup_lines"),
        "m.n_repeat_words",
        failed.alias("base_failed"),
        (~failed & cascade(rules, m)).alias("kept"),
    )


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that neither the base nor a rule rejects."""
    rules = sampled(docs, key, text, base_rules() + default_rules())
    t = whole_text(F.col("text"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    return rows.where(let(F.struct(t.alias("t"), words(t).alias("w")), lambda b: cascade(rules, measures(b["t"], b["w"])))).select("row.*")
