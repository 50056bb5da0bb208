"""Personal data: labelers vote on candidate spans, their reliabilities are estimated, a classifier decides.

1. Candidates come from patterns: the base kinds (email, ip, card, phone), valid or not, and looser shapes (phone
   numbers without a country code, emails that are spelt out, social security numbers).
2. Labelers vote for, against or not at all: the checks of the format, lists of known endings, prefixes and
   ranges (gazetteers), words before the span, and the signs next to it.
3. Expectation-maximisation over how often each pattern of votes occurs estimates how reliable every labeler
   is, and so how likely each pattern is personal data. A logistic classifier of span features is trained
   on these likelihoods.
4. The classifier, written as a column expression, decides about candidates in a second pass. Valid base spans
   always stay; looser ones are added if the classifier is sure, no labeler is against them, and they
   overlap no other span.

Both passes are column expressions over one row at a time; only counts of vote patterns are
shuffled, and these (a fixed number of combinations) come to the driver.

Defined results: a null text is empty and has no spans; rows are judged one by one, so repeated or null ids do
no harm; a caller's column named like an added one is replaced; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import bound, col, running, without

#: In the order in which spans that start together are listed.
KINDS = ("email", "ip", "card", "phone", "ssn")
BASE = KINDS[:4]
SPANS = "array<struct<kind:int,start:int,end:int,value:string,base:boolean>>"
ADDED = ("pii_spans",)
#: How sure the classifier must be to add a span.
SURE = 0.9

# Stands for a separator between two signs of a run: runs are then of single signs, which Java matches without recursion.
_JOIN = "\x01"
#: Code points of a page of text.
PAGE = 256
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_LOCAL = "A-Za-z0-9._%+" + _JOIN + "-"

# Gazetteers: fixed values, public knowledge.
ENDINGS = ("com", "org", "net", "edu", "gov", "io", "info", "eu", "de", "fr", "es", "it", "uk", "us", "ch", "at", "mx", "ca")
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
                 "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91")
ISSUERS = ("34", "35", "36", "37", "4", "51", "52", "53", "54", "55", "60", "62", "65")
UNROUTED = ("0.", "10.", "127.", "192.168.", "255.")
CUES = ("mail", "e-mail", "correo", "contact", "kontakt", "phone", "call", "tel", "mobile", "fax", "telefon", "téléphone", "card",
        "visa", "karte", "carte", "tarjeta", "ip", "host", "address", "ssn", "social", "name")
AGAINST = ("version", "isbn", "serial", "token", "password", "key", "sha", "build", "page", "order", "part")


# --- spans -----------------------------------------------------------------------------------------


def matches(text: Column, pattern: str) -> Column:
    """struct<gaps, hits>: the matches, and how long the text is before, between and after them."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    return F.struct(gaps.alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))


def located(found: Column) -> Column:
    """array<struct<start, end, value>> of matches; places count code points."""
    sizes = F.transform(found["hits"], lambda h, k: F.get(found["gaps"], k) + F.length(h))
    return bound(running(sizes, lambda a, b: a + b, F.lit(0)), lambda at: F.transform(found["hits"], lambda h, k: bound(
        F.get(at, k) + F.get(found["gaps"], k), lambda start: F.struct(start.alias("start"), (start + F.length(h)).alias("end"), h.alias("value"))
    )))


def paged(text: Column) -> Column:
    """The text cut into pages, so that a piece of it is found without counting from its first sign."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))


def piece(pages: Column, start: Column, size: Column) -> Column:
    """``size`` code points from ``start`` (counted from 0); fewer where the text ends."""
    first = F.floor(start / F.lit(PAGE)).cast("int")
    number = F.floor((start + size) / F.lit(PAGE)).cast("int") - first + 1
    return F.substr(F.array_join(F.slice(pages, first + 1, number), ""), start - first * PAGE + 1, size)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether a text of digits passes the check sum of card numbers."""
    size = F.length(value)

    def step(total: Column, k: Column) -> Column:
        d = F.substr(value, size - k, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(k % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), step) % 10 == 0


def _spans(kind: str, found: Column, valid, base: bool) -> Column:
    """Spans of a kind; a base kind's failing matches stay as candidates that are not base."""
    def of(s: Column) -> Column:
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
            (valid(s["value"]) if base else F.lit(False)).alias("base"),
        )
    return F.transform(found, of)


def candidates(text: Column) -> Column:
    """All candidate spans of a text without nulls."""
    # One sign stands for one sign throughout, so places do not move.
    clean = F.translate(text, _JOIN, "\x02")
    dotted = F.regexp_replace(clean, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _JOIN)
    joined = F.regexp_replace(clean, r"(?<=[0-9])[\x20-](?=[0-9])", _JOIN)
    no_match = F.struct(F.array().cast("array<int>").alias("gaps"), F.array().cast("array<string>").alias("hits"))
    has_digit = text.rlike("[0-9]")

    def when(needed: Column, on: Column, pattern: str) -> Column:
        return F.when(needed, matches(on, pattern)).otherwise(no_match)

    size = lambda v: F.length(digits(v))
    shapes = (
        ("email", when(F.contains(text, F.lit("@")), dotted, rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++{_JOIN}[A-Za-z0-9{_JOIN}-]++"),
         lambda v: F.lit(True)),
        ("ip", when(has_digit, clean, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"), lambda v: v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")),
        ("card", when(has_digit, joined, f"[0-9][0-9{_JOIN}]++"), lambda v: F.when(size(v).between(12, 19), luhn(digits(v))).otherwise(False)),
        ("phone", when(F.contains(text, F.lit("+")), clean, r"\+[0-9][\x20().0-9-]+[0-9]"), lambda v: size(v).between(9, 15)),
        ("phone", when(has_digit, clean, r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])"), None),
        ("email", when(
            F.contains(F.lower(text), F.lit("at")) & text.rlike(r"[(\[][aA][tT][)\]]"), clean,
            r"(?i)(?<![a-z0-9])[a-z][a-z0-9]{1,30}\x20?[(\[]at[)\]]\x20?[a-z0-9-]{2,30}\x20?(?:\.|[(\[]dot[)\]])\x20?[a-z]{2,6}(?![a-z])",
        ), None),
        ("ssn", when(has_digit, clean, r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), None),
    )
    # One expression places the matches of all shapes.
    places = F.transform(F.array(*[found for _, found, _ in shapes]), located)
    return bound(places, lambda p: F.concat(*[_spans(kind, F.get(p, n), valid, valid is not None) for n, (kind, _, valid) in enumerate(shapes)]))


# --- labelers -----------------------------------------------------------------------------------


def _vote(favour: Column, against: Column) -> Column:
    return F.when(favour, 1).when(against, -1).otherwise(0)


def _one_of(values: tuple[str, ...]) -> str:
    return "(?:" + "|".join(v.replace(".", r"\.") for v in values) + ")"


def votes(span: Column, pages: Column) -> Column:
    """struct<format, gazetteer, context, edge>: 1 for, -1 against, 0 no opinion. ``pages`` is the text, paged."""
    value, number = span["value"], digits(span["value"])
    before = F.lower(piece(pages, F.greatest(span["start"] - 30, F.lit(0)), F.least(span["start"], F.lit(30))))
    left = F.when(span["start"] > 0, piece(pages, span["start"] - 1, F.lit(1))).otherwise("")
    right = piece(pages, span["end"], F.lit(1))
    of = lambda kind: span["kind"] == KINDS.index(kind)
    strict = (of("phone") & F.length(number).between(10, 15)) | of("ssn") | of("email")
    format_ = _vote(span["base"] | (strict & ~span["base"] & ~of("card")), ~span["base"])
    known = (
        F.when(of("email"), F.lower(value).rlike(rf"[.\x01\])\x20]{_one_of(ENDINGS)}$"))
        .when(of("phone"), value.rlike(rf"^\+{_one_of(COUNTRY_CODES)}|^\(?[2-9][0-9]{{2}}"))
        .when(of("card"), number.rlike(rf"^{_one_of(ISSUERS)}") & F.length(number).between(12, 19))
        .when(of("ip"), ~value.rlike(rf"^{_one_of(UNROUTED)}"))
        .otherwise(~number.rlike("^(?:000|666|9)"))
    )
    cue = "(?:^|[^a-zà-ÿ]){}[^a-zà-ÿ]*$"
    return F.struct(
        format_.alias("format"), _vote(known, ~known).alias("gazetteer"),
        _vote(before.rlike(cue.format(_one_of(CUES))), before.rlike(cue.format(_one_of(AGAINST)))).alias("context"),
        _vote(left.rlike(r"^[\s(\[<:,;\"']?$") & right.rlike(r"^[\s)\]>:,;\"'.!?]?$"), left.rlike("[A-Za-z0-9._%+@-]") | right.rlike("[A-Za-z0-9_@]")).alias("edge"),
    )


LABELERS = ("format", "gazetteer", "context", "edge")


@dataclass(frozen=True)
class Model:
    """Reliabilities (labeler, label, vote) -> likelihood, and the classifier's weights by feature."""

    share: float
    reliability: dict[tuple[str, int, int], float]
    weights: dict[str, float]


def features(kind: int, pattern: tuple[int, ...], base: bool) -> list[str]:
    named = [f"{name}{vote}" for name, vote in zip(LABELERS, pattern, strict=True) if vote]
    return ["bias", f"kind{kind}", *(["base"] if base else []), *named]


def estimate(counts: dict[tuple[int, tuple[int, ...], bool], int], rounds: int = 60) -> Model:
    """Expectation-maximisation over counted vote patterns, then the classifier. Pure arithmetic on a bounded table."""
    total = max(1, sum(counts.values()))
    sure = {p: 1 / (1 + math.exp(-sum(p[1]))) for p in counts}  # start: the vote
    share, reliability = 0.5, {}
    for _ in range(rounds):
        mass = {1: sum(n * sure[p] for p, n in counts.items()), 0: sum(n * (1 - sure[p]) for p, n in counts.items())}
        share = (mass[1] + 1) / (total + 2)
        for k, name in enumerate(LABELERS):
            for label in (0, 1):
                for vote in (-1, 0, 1):
                    held = sum(n * (sure[p] if label else 1 - sure[p]) for p, n in counts.items() if p[1][k] == vote)
                    # A labeler is taken to be better than chance before any count.
                    prior = 2.0 if (vote > 0) == bool(label) and vote else 1.0
                    reliability[name, label, vote] = (held + prior) / (mass[label] + 4.0)
        for p in counts:
            odds = math.log(share / (1 - share))
            odds += sum(math.log(reliability[n, 1, v] / reliability[n, 0, v]) for n, v in zip(LABELERS, p[1], strict=True))
            sure[p] = 1 / (1 + math.exp(-max(-30, min(30, odds))))
    weights: dict[str, float] = {}
    rows = [(features(*p), sure[p], n / total) for p, n in counts.items()]
    for _ in range(400):
        slope: dict[str, float] = {}
        for named, target, part in rows:
            guess = 1 / (1 + math.exp(-max(-30, min(30, sum(weights.get(f, 0.0) for f in named)))))
            for f in named:
                slope[f] = slope.get(f, 0.0) + part * (target - guess)
        for f, s in slope.items():
            weights[f] = weights.get(f, 0.0) + 2.0 * (s - 0.0005 * weights.get(f, 0.0))
    return Model(share, reliability, weights)


def learn(docs: DataFrame, text_column: str = "text") -> Model:
    """Labelers are applied to every candidate of every text; only counts of vote patterns leave Spark."""
    text = docs.select(F.coalesce(col(text_column).cast("string"), F.lit("")).alias("text"))
    found = text.withColumn("spans", candidates(F.col("text"))).where(F.size("spans") > 0).withColumn("pages", paged(F.col("text")))
    voted = found.select(F.explode(F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), votes(s, F.col("pages")).alias("v"), s["base"].alias("base")))).alias("c"))
    counted = voted.groupBy("c.kind", *[f"c.v.{n}" for n in LABELERS], "c.base").count()
    return estimate({(r[0], tuple(r[1:5]), r[5]): r[6] for r in counted.collect()})


def certainty(span: Column, pages: Column, model: Model) -> Column:
    """The classifier as an expression."""
    w = model.weights
    voted = votes(span, pages)
    score = F.lit(w.get("bias", 0.0)) + F.when(span["base"], w.get("base", 0.0)).otherwise(0.0)
    kind = F.lit(0.0)
    for k in range(len(KINDS)):
        kind = F.when(span["kind"] == k, w.get(f"kind{k}", 0.0)).otherwise(kind)
    for name in LABELERS:
        score = score + F.when(voted[name] == 1, w.get(f"{name}1", 0.0)).when(voted[name] == -1, w.get(f"{name}-1", 0.0)).otherwise(0.0)
    return 1 / (1 + F.exp(-(score + kind)))


def _clear(bases: Column, others: Column) -> Column:
    """Those of ``others`` that overlap no base span."""

    def of(spans: Column) -> Column:
        furthest = running(F.transform(spans, lambda s: F.when(s["base"], s["end"]).otherwise(0)), F.greatest, F.lit(0))
        nearest = F.reverse(running(F.reverse(F.transform(spans, lambda s: F.when(s["base"], s["start"]).otherwise(_FAR))), F.least, F.lit(_FAR)))
        edges = F.arrays_zip(furthest.alias("end"), nearest.alias("start"))
        clear = lambda s, e: ~s["base"] & (e["end"] <= s["start"]) & (e["start"] >= s["end"])
        return bound(edges, lambda es: F.filter(spans, lambda s, k: clear(s, F.get(es, k))))

    return bound(_ordered(F.concat(bases, others)), of)


_FAR = (1 << 31) - 1


def _ordered(spans: Column) -> Column:
    """By start, the longer ones first, then by kind."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"), s.alias("s")))
    return F.transform(F.sort_array(keyed), lambda x: x["s"])


def _first_ones(spans: Column) -> Column:
    """Spans that overlap none before them in order."""

    def of(ordered: Column) -> Column:
        furthest = running(F.transform(ordered, lambda s: s["end"]), F.greatest, F.lit(0))
        return bound(furthest, lambda ends: F.filter(ordered, lambda s, k: F.get(ends, k) <= s["start"]))

    return bound(_ordered(spans), of)


def with_spans(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with ``pii_spans``: kind (place in KINDS), start, end (exclusive, code points), value, base; by start and kind."""
    docs = without(docs, ADDED)
    text = F.coalesce(col(text_column).cast("string"), F.lit(""))
    pages, none = F.col("__tb_p"), F.array().cast(SPANS)
    held = docs.withColumn("__tb_c", candidates(text)).withColumn("__tb_p", F.when(F.size("__tb_c") > 0, paged(text)))
    bases = held.withColumn("__tb_b", F.filter("__tb_c", lambda s: s["base"]))

    def sure(s: Column) -> Column:
        voted = votes(s, pages)
        return (certainty(s, pages, model) >= SURE) & (F.least(*[voted[n] for n in LABELERS]) >= 0)

    bases = bases.withColumn("__tb_m", F.when(F.size("__tb_c") > F.size("__tb_b"), F.filter("__tb_c", lambda s: ~s["base"] & sure(s))).otherwise(none))
    # Of added spans that overlap, the one that starts first stays, then the longer, then the first kind.
    kept = F.when(F.size("__tb_m") > 0, _first_ones(_clear(F.col("__tb_b"), F.col("__tb_m")))).otherwise(none)
    ordered = F.array_sort(
        F.transform(F.concat("__tb_b", kept), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), piece(pages, s["start"], s["end"] - s["start"]).alias("value"), s["base"].alias("base")))
    )
    return bases.withColumn("pii_spans", ordered).drop("__tb_c", "__tb_p", "__tb_b", "__tb_m")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first names the whole."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def of(pages: Column) -> Column:
        def shown(s: Column, at: Column) -> Column:
            gap = piece(pages, at, F.greatest(s["start"] - at, F.lit(0)))
            return F.when(s["start"] >= at, F.concat(gap, F.element_at(names, s["kind"] + 1))).otherwise("")

        covered = running(F.transform(spans, lambda s: s["end"]), F.greatest, F.lit(0))
        front = bound(covered, lambda ends: F.array_join(F.transform(spans, lambda s, k: shown(s, F.get(ends, k))), ""))
        return F.concat(front, F.substr(text, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(bound(paged(text), of))


def mask(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The same columns with personal data in the text replaced by the names of its kinds."""
    found = with_spans(docs, learn(docs, text_column), text_column)
    text = F.coalesce(col(text_column).cast("string"), F.lit(""))
    shown = F.when(col(text_column).isNull(), F.lit(None)).otherwise(masked(text, F.col("pii_spans")))
    return found.withColumn(text_column, shown).select(*[col(c) for c in docs.columns if c.lower() not in ADDED])
