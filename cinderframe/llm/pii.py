"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust their score.

Base kinds (email, ip, card, phone) stay whenever their pattern and their check hold. Further kinds (iban, ssn, secret)
start from a prior score that nearby words, before or after a span up to the next one of its kind, raise; an iban must
also pass mod-97, and one of a country without a registered length needs such words. Spans are in code points, end
exclusive. Time is in proportion to a text's length and its number of spans.

Patterns are written so that no text makes them slow: a run of characters is entered at its start only, and repeated
groups are possessive, which changes no match (what follows a run can't be part of it) and needs no stack.

Defined results: a null text is an empty one and has no spans; texts are taken whole, of any length; repeated rows give
repeated results; an empty table gives an empty result; only the key and the text of the input are used (redact() keeps
all columns), so other columns of any name do no harm. A null key is returned as null.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderframe.llm.common import let, scanned, whole_text

SPAN = "array<struct<start:int,kind:int,end:int,score:double>>"
THRESHOLD = 0.5
#: Code points before and after a span in which context words count.
CONTEXT = 48


class Kind(NamedTuple):
    name: str
    pattern: str
    #: A cheap test that the text may hold a match.
    gate: Callable[[Column], Column]
    check: Callable[[Column], Column]
    #: Score without context (of a match), score that context words add, and the words.
    prior: Callable[[Column], Column]
    lift: float
    context: str
    #: Base spans stay whatever their score.
    base: bool


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def luhn(m: Column) -> Column:
    """The digits of m, 12 to 19 of them, pass Luhn's check."""

    def total(d: Column) -> Column:
        def add(a: Column, i: Column) -> Column:
            v = F.substring(d, i, F.lit(1)).cast("int") * (1 + F.pmod(F.length(d) - i, F.lit(2)))
            return a + v - F.when(v > 9, 9).otherwise(0)

        return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add)

    return let(digits(m), lambda d: F.when(F.length(d).between(12, 19), total(d) % 10 == 0).otherwise(F.lit(False)))


def mod97(m: Column) -> Column:
    """m, moved round by four characters and letters as 10 to 35, leaves 1 after division by 97."""

    def rest(s: Column) -> Column:
        turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, F.lit(1), F.lit(4)))

        def step(a: Column, i: Column) -> Column:
            c = F.ascii(F.substring(turned, i, F.lit(1)))
            return F.when(c >= 65, (a * 100 + c - 55) % 97).otherwise((a * 10 + c - 48) % 97)

        return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), step)

    return let(F.regexp_replace(m, "[^A-Z0-9]+", ""), lambda s: F.when(F.length(s) >= 5, rest(s) == 1).otherwise(F.lit(False)))


#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
GROUPS = {n: "|".join(c.split()) for n, c in IBAN_LENGTHS.items()}
#: As long as its country says, so that words after it are left alone; other countries' as long as it goes.
IBAN = "|".join(rf"(?:{c})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in GROUPS.items()) + rf"|(?!{'|'.join(GROUPS.values())})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}"

#: Countries of registered length.
REGISTERED = "|".join(GROUPS.values())


def always(score: float) -> Callable[[Column], Column]:
    return lambda m: F.lit(score)


PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
YES = lambda m: F.lit(True)
HAS_DIGIT = lambda t: t.rlike("[0-9]")

KINDS = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda t: F.contains(t, F.lit("@")), YES, always(0.9), 0.1, "mail|contact|write", True),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+", HAS_DIGIT, lambda m: m.rlike(rf"^(?:{PART}\.){{3}}{PART}$"), always(0.6), 0.3, "ip|address|host|server", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", HAS_DIGIT, luhn, always(0.8), 0.2, "card|visa|credit|payment", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: F.contains(t, F.lit("+")), lambda m: F.length(digits(m)).between(9, 15), always(0.7), 0.3, "phone|call|tel|mobile", True),
    Kind("iban", rf"(?<![A-Za-z0-9])(?:{IBAN})(?![A-Za-z0-9])", lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), mod97, lambda m: F.when(m.rlike(rf"^(?:{REGISTERED})"), 0.7).otherwise(0.3), 0.3, "iban|account|bank", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", HAS_DIGIT, YES, always(0.3), 0.5, "ssn|social|security", False),
    Kind("secret", r"(?<![A-Za-z0-9])[A-Fa-f0-9]{32,128}(?![A-Za-z0-9])", HAS_DIGIT, YES, always(0.2), 0.6, "token|secret|key|password|passwd", False),
]


def spans_of(text: Column, k: int) -> Column:
    """The spans of kind k, in order: what split() leaves between the matches gives their places and contexts."""
    kind = KINDS[k]

    def located(b: Column) -> Column:
        # a match and the gap before it; the gaps' and matches' lengths add up to places
        steps = F.transform(b["m"], lambda m, i: F.length(b["p"][i]) + F.length(m))

        def placed(at: Column) -> Column:
            def span(m: Column, i: Column) -> Column:
                start = (at[i] + F.length(b["p"][i])).cast("int")
                near = F.lower(F.concat_ws("\n", F.right(b["p"][i], F.lit(CONTEXT)), F.left(b["p"][i + 1], F.lit(CONTEXT))))
                score = kind.prior(m) + F.when(near.rlike(rf"\b(?:{kind.context})"), F.lit(kind.lift)).otherwise(F.lit(0.0))
                return F.struct(start.alias("start"), F.lit(k).alias("kind"), (start + F.length(m)).alias("end"), F.when(kind.check(m), score).alias("score"))

            return F.transform(b["m"], span)

        least = 0.0 if kind.base else THRESHOLD
        return F.filter(let(scanned(steps, lambda a, x: a + x, F.lit(0)), placed), lambda s: F.coalesce(s["score"] >= least, F.lit(False)))

    both = F.struct(F.split(text, kind.pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(kind.pattern), 0).alias("m"))
    found = let(both, lambda b: F.when(F.size(b["m"]) > 0, located(b)).otherwise(F.array().cast(SPAN)))
    return F.when(kind.gate(text), found.cast(SPAN)).otherwise(F.array().cast(SPAN))


def all_spans(text: Column) -> Column:
    """The spans of all kinds of a text that isn't null, by start, then kind."""
    return F.array_sort(F.concat(*[spans_of(text, k) for k in range(len(KINDS))]))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans: array of (start, kind as a place in KINDS, end, score), one row for each row of docs."""
    return docs.select(F.col(key).alias("doc_id"), all_spans(whole_text(F.col(text))).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """find()'s rows as counts of the base kinds, the digest of the base spans, all spans as one string, and their scores."""
    base = [i for i, k in enumerate(KINDS) if k.base]
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("bigint").alias(f"n_{KINDS[i].name}")
    return found.select(
        "doc_id",
        *[count(i) for i in base],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.transform("spans", lambda s: F.round(s["score"], 2)).alias("scores"),
    )


#: Spans from which a text is cut as an array of characters: substrings are found by counting from its start.
MANY = 32


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    names = F.array(*[F.lit(f"[{k.name.upper()}]") for k in KINDS])

    def cut(part: Callable[[Column, Column], Column], length: Column) -> Column:
        def joined_up(done: Column) -> Column:
            # done[i]: the furthest end of the spans before i
            pieces = F.transform(spans, lambda s, i: F.when(s["start"] >= done[i], F.concat(part(done[i], s["start"]), names[s["kind"]])).otherwise(F.lit("")))
            last = F.greatest(F.element_at(done, -1), F.element_at(spans, -1)["end"])
            return F.concat(F.array_join(pieces, ""), part(last, length))

        return let(scanned(F.transform(spans, lambda s: s["end"]), lambda a, x: F.greatest(a, x), F.lit(0)), joined_up)

    few = cut(lambda a, b: F.substring(text, a + 1, b - a), F.length(text))
    many = let(F.split(text, ""), lambda c: cut(lambda a, b: F.array_join(F.slice(c, a + 1, b - a), ""), F.length(text)))
    return F.when(F.size(spans) == 0, text).when(F.size(spans) <= MANY, few).otherwise(many)


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """docs, with all its columns, its texts redacted; a null text stays null. n_chars, if there is one, follows the text."""
    row = docs.select(F.struct(*docs.columns).alias("row"), whole_text(F.col(text)).alias("t"))
    row = row.withColumn("spans", all_spans(F.col("t"))).select("row", F.when(F.col(f"row.`{text}`").isNotNull(), redacted(F.col("t"), F.col("spans"))).alias("new"))
    out = {text: F.col("new")} | ({n_chars: F.length("new").cast(docs.schema[n_chars].dataType)} if n_chars in docs.columns else {})
    return row.select(*[out.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
