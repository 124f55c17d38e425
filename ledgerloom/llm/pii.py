"""Personal data: patterns, gazetteers and context vote; expectation-maximisation weighs the votes."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import kept, or_empty

# The base patterns are written so that Java's matcher neither recurses nor starts over inside a run
# of characters, however long it is; see _prepared for the texts they are matched on.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9\x20-]+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

# Wider candidates, which only the votes decide on: kind, pattern, and what a text with one contains.
# None reaches into a longer run of digits or letters.
WIDE = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[] ?at ?[)\]] ?[A-Za-z0-9-]{1,63}+(?: ?[(\[] ?dot ?[)\]] ?[A-Za-z0-9-]{1,63}+){1,4}", r"[(\[] ?at ?[)\]]"),
    ("card", r"(?<![0-9][\x20.-]|[0-9])3[47][0-9]{2}[\x20.-]?[0-9]{6}[\x20.-]?[0-9]{5}(?![\x20.-]?[0-9])", r"3[47][0-9]{2}[\x20.-]?[0-9]{6}"),
    ("phone", r"(?<![0-9+.-])(?<![0-9]\x20)\(?[2-9][0-9]{2}\)?[\x20.-][2-9][0-9]{2}[\x20.-][0-9]{4}(?![\x20.-]?[0-9])", r"[0-9]{3}[\x20.-][0-9]{4}"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"-[0-9]{2}-[0-9]{4}"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"),
)
ALL_KINDS = ("email", "ip", "card", "phone", "iban", "ssn")

# What the labelers know.
TOP_DOMAINS = "com org net edu gov mil info biz io co ai app dev de fr es it uk us ca eu ch at be nl pl pt se no dk fi jp cn in br mx au nz ru".split()
IBAN_COUNTRIES = "AD AE AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK SM TR".split()
SUPPORTING = {
    "email": r"e-?mail|mailto|contact|write to|reach|courriel|correo",
    "ip": r"\bip\b|address|host|server|login|client|connect",
    "card": r"card|visa|master|amex|credit|debit|karte|carte|tarjeta",
    "phone": r"phone|\btel|call|mobile|cell|fax|whatsapp|contact|t[eé]l[eé]fono?|telefon|handy",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "ssn": r"ssn|social|security|tax",
}
OPPOSING = r"version|release|isbn|issn|doi|serial|\border|invoice|part no|chapter|section|figure|\bsku\b|build"
# Characters before a candidate that its context labeler reads.
CONTEXT = 40

VOTES = ("pattern", "check", "gazetteer", "context")
ROUNDS = 50
ACCEPT = 0.5
# Candidates imagined beside those found: so many with all votes for, all against, and none. They
# keep a corpus without counter-examples from teaching that everything is personal data.
IMAGINED = 5.0


def located(text: Column, pattern: str) -> Column:
    """All matches of a pattern as an array of ``start``, ``end`` (code points, exclusive), ``found``."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    )

    def add(done: Column, part: Column) -> Column:
        start = done["at"] + F.char_length(part["gap"])
        end = start + F.char_length(part["found"])
        span = F.struct(start.alias("start"), end.alias("end"), part["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    zero = F.struct(
        F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start: int, end: int, found: string>>)").alias("spans")
    )
    return F.aggregate(F.filter(parts, lambda part: part["found"].isNotNull()), zero, add, lambda done: done["spans"])


def _where(there: Column, spans: Column) -> Column:
    """``spans`` of texts that may have some; the condition keeps the others from being searched."""
    return F.when(there, spans).otherwise(F.expr("cast(array() as array<struct<start: int, end: int, found: string>>)"))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def add(total: Column, at: Column) -> Column:
        digit = F.substring(backwards, at, 1).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(at % 2 == 0, doubled).otherwise(digit)

    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length(digits)))
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _small_parts(found: Column) -> Column:
    def small(part: Column) -> Column:
        value = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(F.char_length(value) > 3, F.lit(False)).otherwise(value.cast("int") <= 255)

    return F.forall(F.split(found, r"\."), small)


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each base kind, in the order of their starts."""
    # A dot that is not between two characters of a domain can end none; in an address it may as
    # well be a percent sign. A separator that is not between two digits belongs to no card.
    for_email = F.regexp_replace(text, r"(?<![A-Za-z0-9-])\.|\.(?![A-Za-z0-9-])", "%")
    for_card = F.regexp_replace(text, r"(?<![0-9])[\x20-]|[\x20-](?![0-9])", "x")
    length = lambda span: F.char_length(_digits(span["found"]))
    return {
        "email": _where(text.contains("@"), located(for_email, EMAIL)),
        "ip": F.filter(
            _where(text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), located(text, IP)),
            lambda span: _small_parts(span["found"]),
        ),
        "card": F.filter(
            _where(text.rlike(r"[0-9][0-9\x20-]{14}"), located(for_card, CARD)),
            lambda span: F.when(length(span).between(16, 19), _luhn(_digits(span["found"]))).otherwise(False),
        ),
        "phone": F.filter(
            _where(text.contains("+"), located(text, PHONE)), lambda span: length(span).between(8, 15)
        ),
    }


def candidates(text: Column) -> Column:
    """Base spans and wider candidates outside them, each with its ``kind``, ``base`` and votes."""
    base = base_spans(text)
    arrays = [_voted(text, spans, kind, True) for kind, spans in base.items()]
    taken = F.concat(*base.values())
    for kind, pattern, hint in WIDE:
        free = F.filter(
            _where(text.rlike(hint), located(text, pattern)),
            lambda span: ~F.exists(taken, lambda other: (other["start"] < span["end"]) & (span["start"] < other["end"])),
        )
        arrays.append(_voted(text, free, kind, False))
    return F.concat(*arrays)


def _voted(text: Column, spans: Column, kind: str, base: bool) -> Column:
    """Spans with one vote of each labeler: 1 for personal data, 0 against it, -1 for neither."""

    def vote(span: Column) -> Column:
        found, digits = span["found"], _digits(span["found"])
        before = F.lower(F.substring(text, F.greatest(span["start"] - CONTEXT + 1, F.lit(1)), F.least(span["start"], F.lit(CONTEXT))))
        yes, no, none = F.lit(1), F.lit(0), F.lit(-1)
        one_digit = digits.rlike(r"^([0-9])\1*$")
        if kind == "email":
            domain = F.lower(F.regexp_extract(found, "([A-Za-z0-9-]+)[^A-Za-z0-9]*$", 1))
            check = F.when(F.char_length(found) > 254, no).otherwise(yes)
            gazetteer = F.when(domain.isin(TOP_DOMAINS), yes).otherwise(none)
        elif kind == "ip":
            check = F.when(found.rlike(r"(^|\.)0[0-9]"), no).otherwise(yes)
            gazetteer = F.when(found.rlike(r"^(0|127|2[2-5][0-9])\."), no).otherwise(none)
        elif kind == "card":
            check = F.when(_luhn(digits) & ~one_digit, yes).otherwise(no)
            gazetteer = F.when(digits.rlike("^(4|5[1-5]|2[2-7]|3[47]|6)"), yes).otherwise(none)
        elif kind == "phone":
            check = F.when(one_digit, no).when(F.char_length(digits) >= 10, yes).otherwise(none)
            gazetteer = F.when(digits.rlike("^[01]{3}"), no).otherwise(none)
        elif kind == "ssn":
            check = F.when(digits.rlike("^(000|666|9)|^...00|0000$"), no).otherwise(yes)
            gazetteer = F.when(one_digit | (digits == "123456789"), no).otherwise(none)
        else:
            letters = F.regexp_replace(found, " ", "")
            check = F.when(F.char_length(letters).between(15, 34), yes).otherwise(no)
            gazetteer = F.when(F.substring(letters, 1, 2).isin(IBAN_COUNTRIES), yes).otherwise(no)
        context = F.when(before.rlike(SUPPORTING[kind]), yes).when(before.rlike(OPPOSING), no).otherwise(none)
        return F.struct(
            F.lit(kind).alias("kind"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            F.lit(base).alias("base"),
            (F.lit(1) if base else F.lit(-1)).alias("pattern"),
            check.alias("check"),
            gazetteer.alias("gazetteer"),
            context.alias("context"),
        )

    return F.transform(spans, vote)


@dataclass(frozen=True)
class SpanModel:
    """The classifier: an intercept, and a weight for each labeler's vote for and against."""

    intercept: float
    weights: tuple[float, ...]

    def accepts(self, span: Column) -> Column:
        total = F.lit(self.intercept)
        for i, name in enumerate(VOTES):
            total = total + F.when(span[name] == 1, self.weights[2 * i]).when(span[name] == 0, self.weights[2 * i + 1]).otherwise(0.0)
        return total >= math.log(ACCEPT / (1 - ACCEPT))


def fit(documents: DataFrame) -> SpanModel | None:
    """The classifier of the candidates in all texts of ``documents``; None if there are none.

    Candidates with equal votes are alike, so what is learned from is the number of candidates for
    each combination of kind and votes, a few hundred rows at most whatever the input.
    """
    votes = [f"span.{name} as `{name}`" for name in VOTES]
    found = documents.select(F.explode(candidates(or_empty(F.col("text")))).alias("span"))
    patterns = kept(found.selectExpr("span.kind as kind", *votes).groupBy("kind", *VOTES).count(), 0)
    rows = [(tuple(row[name] for name in VOTES), row["kind"], row["count"]) for row in patterns.collect()]
    if not rows:
        return None
    posterior = reliabilities(rows)

    def inputs(pattern: tuple[int, ...]) -> list[float]:
        return [float(vote == side) for vote in pattern for side in (1, 0)]

    learned = [(float(vote == 1), IMAGINED, *inputs((vote,) * len(VOTES))) for vote in (1, 0, -1)]
    for pattern, kind, count in rows:
        p = posterior[kind, pattern]
        learned += [(1.0, count * p, *inputs(pattern)), (0.0, count * (1 - p), *inputs(pattern))]
    names = [f"x{i}" for i in range(2 * len(VOTES))]
    frame = patterns.sparkSession.createDataFrame(learned, ["label", "weight", *names])
    rows_in = VectorAssembler(inputCols=names, outputCol="features").transform(frame)
    model = LogisticRegression(weightCol="weight", regParam=0.01, maxIter=50).fit(rows_in)
    return SpanModel(float(model.intercept), tuple(float(w) for w in model.coefficients))


def reliabilities(rows: list[tuple[tuple[int, ...], str, int]]) -> dict[tuple[str, tuple[int, ...]], float]:
    """How likely a candidate with these votes is personal data, by expectation-maximisation.

    Each labeler votes for, against or not at all, independently of the others given the truth, with
    rates to be found; the first guess is the share of votes for, and every rate starts from one
    imagined candidate per vote, so that a kind without counter-examples stays moderate.
    """
    found = {}
    for pattern, kind, _ in rows:
        cast = [vote for vote in pattern if vote >= 0]
        found[kind, pattern] = (sum(cast) + 0.5) / (len(cast) + 1)
    for _ in range(ROUNDS):
        rates = {}
        sizes = {True: 1.0, False: 1.0}
        for truth in (True, False):
            weight = [count * (p if truth else 1 - p) for (pattern, kind, count) in rows for p in [found[kind, pattern]]]
            sizes[truth] += sum(weight)
            for i in range(len(VOTES)):
                for vote in (-1, 0, 1):
                    like = sum(w for w, (pattern, _, _) in zip(weight, rows) if pattern[i] == vote)
                    # A labeler is thought better than chance until the data say otherwise.
                    rates[truth, i, vote] = (like + (2.0 if vote == int(truth) else 1.0)) / (sum(weight) + 4)
        for pattern, kind, _ in rows:
            log_odds = math.log(sizes[True] / sizes[False])
            log_odds += sum(math.log(rates[True, i, v] / rates[False, i, v]) for i, v in enumerate(pattern))
            found[kind, pattern] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log_odds))))
    return found


def spans(text: Column, model: SpanModel | None) -> Column:
    """All spans of a text by kind (in the order of ALL_KINDS), then start: ``kind``, ``start``,
    ``end`` and ``base``. Base spans always stay; of the others those that the classifier accepts,
    and of overlapping ones the first."""
    accepted = candidates(text)
    if model is None:
        accepted = F.filter(accepted, lambda span: span["base"])
    else:
        accepted = F.filter(accepted, lambda span: span["base"] | model.accepts(span))

    def add(done: Column, span: Column) -> Column:
        overlaps = F.exists(done, lambda other: (other["start"] < span["end"]) & (span["start"] < other["end"]))
        return F.when(~span["base"] & overlaps, done).otherwise(F.concat(done, F.array(span)))

    order = F.array(*[F.lit(kind) for kind in ALL_KINDS])
    slim = F.transform(
        accepted,
        lambda span: F.struct(
            F.array_position(order, span["kind"]).cast("int").alias("place"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            span["kind"].alias("kind"),
            span["base"].alias("base"),
        ),
    )
    base = F.filter(slim, lambda span: span["base"])
    empty = F.expr("cast(array() as array<struct<place: int, start: int, end: int, kind: string, base: boolean>>)")
    return F.array_sort(F.concat(base, F.aggregate(F.filter(slim, lambda span: ~span["base"]), empty, add)))


def written(found: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(found, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])), ",")


def find(documents: DataFrame, model: SpanModel | None) -> DataFrame:
    """``documents`` with ``spans``; null and empty texts have none.

    Rows are looked at one by one, so repeated rows and null ids change nothing; an empty table
    stays empty; a column named ``spans`` is replaced.
    """
    return documents.withColumn("spans", spans(or_empty(F.col("text")), model))


def redact(text: Column, found: Column) -> Column:
    """A text with its spans replaced by their kind in brackets; spans that overlap become one."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def add(done: Column, span: Column) -> Column:
        inside = span["start"] < done["at"]
        between = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        piece = F.concat(between, F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(inside, done["parts"]).otherwise(F.concat(done["parts"], F.array(piece))).alias("parts"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))
    done = lambda state: F.concat(F.array_join(state["parts"], ""), F.substring(text, state["at"] + 1, F.char_length(text)))
    return F.when(F.size(found) > 0, F.aggregate(ordered, zero, add, done)).otherwise(text)
