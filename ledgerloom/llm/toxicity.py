"""Toxicity by a weighted lexicon, found in folded texts by an Aho-Corasick automaton."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import give_back, hold, kept, or_empty

THRESHOLD = 0.7
# Labelled rows the model is fitted on, at most, by label.
TOXIC_ROWS = 6_000
CLEAN_ROWS = 12_000
ENTRIES = 2_000
# Letters of a stem, an entry that begins words; other entries are whole words.
SHORTEST, LONGEST = 4, 10
# An entry is this many times likelier in toxic texts, as a logarithm, and by so many standard
# deviations, since among very many words some are so by chance.
LEAST_WEIGHT = 1.5
LEAST_DEVIATION = 5.0

# Letters of other alphabets by the Latin letter they look like.
HOMOGLYPHS = dict(
    zip("абвгеёзикмнорстухцчіїјѕһԁԛԝαβεηικνορτυχωγμ", "a6breezukmhopctyxuyiijshdqwabenikvoptuxwyu")
)
DIGITS = str.maketrans("0134578@$!|", "oieastbasii")
# Insults known without labels, and phrases in which such words are harmless.
KNOWN = (
    "idiot moron imbecile scumbag loser asshole bastard bitch dumbass jerk retard pathetic worthless "
    "stupid disgusting scum idiota estupido imbecil cabron pendejo connard salaud abruti debile cretin "
    "arschloch dummkopf vollidiot trottel depp"
).split()
KNOWN_WEIGHT = 3.0
HARMLESS = (
    "trash can",
    "trash bin",
    "trash bag",
    "clown fish",
    "class clown",
    "crown and clown",
    "pathetic fallacy",
    "pond scum",
    "soap scum",
    "loser bracket",
    "stupid simple",
)


def _folding() -> dict[int, str]:
    table = {ord(found): like for found, like in HOMOGLYPHS.items()}
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFKD", chr(code)).lower()[0]
        if base.isascii():
            table[code] = base
    for code in range(0xFF21, 0xFF5B):
        table[code] = unicodedata.normalize("NFKC", chr(code)).lower()
    # Zero-width characters and combining marks go.
    return table | dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF, *range(0x300, 0x370)], "")


_FOLDED = _folding()
_IN_WORD = re.compile(r"(?<=[a-z])[0134578@$!|]+(?=[a-z])|\b[0134578@$!|]+(?=[a-z]\w*[a-z])|(?<=[a-z]{2})[01345780$]+\b")
_NO_LETTERS = re.compile(r"[\W\d_]+")


def fold(text: str) -> str:
    """Lower-case words between single spaces, homoglyphs and digits in words as the letters they
    stand for; a one may stand for i or l, so l is written i everywhere."""
    lower = text.lower().translate(_FOLDED)
    plain = _IN_WORD.sub(lambda found: found[0].translate(DIGITS), lower)
    return f" {_NO_LETTERS.sub(' ', plain).strip()} ".replace("l", "i")


@dataclass(frozen=True)
class Model:
    """Entries (folded, with the space before a stem and those around a word) and their weights,
    entries that take away what they cover, and the coefficients of a document's features."""

    lexicon: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    coefficients: tuple[float, ...]


FEATURES = 4


@lru_cache(maxsize=4)
def _automaton(lexicon: tuple[tuple[str, float], ...], exceptions: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for entry, weight in lexicon:
        found.add_word(entry, (len(entry), weight))
    for entry in exceptions:
        found.add_word(entry, (len(entry), None))
    found.make_automaton()
    return found


def features(text: str, lexicon: tuple, exceptions: tuple) -> tuple[float, ...]:
    """Weight found per hundred words and in all, both as logarithms, the largest weight, and this
    times the first: a few words that clean texts use as well say little in a long text."""
    nothing = (0.0,) * FEATURES
    folded = fold(text)
    if not lexicon or len(folded) < 3:
        return nothing
    # The longest entry of those that begin at a word counts, and none inside an exception.
    begins: dict[int, tuple[int, float]] = {}
    harmless: list[tuple[int, int]] = []
    for end, (length, weight) in _automaton(lexicon, exceptions).iter(folded):
        start = end + 1 - length
        if weight is None:
            harmless.append((start, end))
        elif start not in begins or begins[start][0] < length:
            begins[start] = (length, weight)
    for first, last in harmless:
        at = folded.find(" ", first)
        while 0 <= at < last:
            begins.pop(at, None)
            at = folded.find(" ", at + 1)
    if not begins:
        return nothing
    weights = [weight for _, weight in begins.values()]
    words = folded.count(" ") - 1
    density = math.log1p(100 * sum(weights) / max(words, 10))
    return density, math.log1p(sum(weights)), max(weights), max(weights) * density


def score(text: Column, model: Model) -> Column:
    """The score of a text column, from 0 to 1; null and empty texts are texts with no entry."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        hold("toxicity", _automaton.cache_clear)
        rows = [features(text or "", model.lexicon, model.exceptions) for text in texts]
        give_back()
        return pd.Series(_probability(np.array(rows, float).reshape(-1, FEATURES), model.coefficients))

    return of(text)


def _probability(rows: np.ndarray, coefficients: tuple[float, ...]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(rows @ np.array(coefficients[1:]) + coefficients[0], -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from the model; one without an id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    toxic_rows: int = TOXIC_ROWS,
    clean_rows: int = CLEAN_ROWS,
    entries: int = ENTRIES,
) -> Model:
    """The model learned from documents whose ``labels`` (``doc_id``, ``toxic``) are not held out.

    It is fitted on a sample, at most ``toxic_rows`` and ``clean_rows`` labels, those with the
    smallest hash of their id: the entries are the words and word stems that are likeliest in the
    toxic ones, counted in two thirds of the sample; the coefficients come from the rest, in which a
    row counts for as many as there are of its label for each one chosen: scores then keep to the
    share of toxic labels, which the sample does not have where it is cut.
    Labels null, without a document or held out are not used; an id labelled twice counts by its
    largest label; without labels the known words remain.
    """
    known = labels.filter("toxic is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    once = known.groupBy(F.col("doc_id").alias("of_id")).agg((F.max("toxic") > 0).alias("toxic"))
    there = {row["toxic"]: row["count"] for row in once.groupBy("toxic").count().collect()}
    order = [F.xxhash64("of_id"), F.col("of_id")]
    chosen = (
        once.filter("toxic").orderBy(*order).limit(toxic_rows)
        .union(once.filter("not toxic").orderBy(*order).limit(clean_rows))
    )
    # The documents are read again for each use of the sample, which takes less than keeping it.
    sample = (
        documents.select("doc_id", or_empty(F.col("text")).alias("text"))
        .join(F.broadcast(kept(chosen, 0)), F.col("doc_id") == F.col("of_id"))
        .select("text", "toxic", (F.pmod(F.hash("doc_id"), F.lit(3)) > 0).alias("for_entries"))
    )
    lexicon, exceptions = _entries(sample.filter("for_entries"), entries)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(text, lexicon, exceptions) for text in batch.column(0).to_pylist()]
            columns = np.array(rows, float).reshape(-1, FEATURES).T
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), batch.column(1)], [*names, "toxic"])

    # A few numbers for each row of the sample.
    names = [f"x{i}" for i in range(FEATURES)]
    schema = ", ".join([f"{name} double" for name in names] + ["toxic boolean"])
    measured = sample.filter("not for_entries").mapInArrow(measure, schema)
    rows = np.array([tuple(row) for row in measured.collect()], float).reshape(-1, FEATURES + 1)
    # Labels there are for each one in the sample.
    stands_for = [max(1.0, there.get(label, 0) / max(most, 1)) for label, most in ((True, toxic_rows), (False, clean_rows))]
    weights = np.where(rows[:, -1] > 0, *stands_for)
    return Model(lexicon, exceptions, _regression(rows[:, :-1], rows[:, -1], weights))


def _parts(folded: str) -> set[str]:
    """The words of a folded text and their stems, written as entries."""
    found = set()
    for word in set(folded.split()):
        if SHORTEST - 1 <= len(word) <= 40:
            found.add(f" {word} ")
        for length in range(SHORTEST, min(len(word) - 1, LONGEST) + 1):
            found.add(f" {word[:length]}")
    return found


def _entries(sample: DataFrame, most: int) -> tuple[tuple[tuple[str, float], ...], tuple[str, ...]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, is_toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if is_toxic else clean).update(_parts(fold(text)))
            parts = list(toxic.keys() | clean.keys())
            columns = [pa.array(parts, pa.string())] + [pa.array([c[p] for p in parts], pa.int64()) for c in (toxic, clean)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "in_toxic", "in_clean"])

    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    weight = F.log((F.col("in_toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("in_clean") + 0.5) / (n_clean + 1))
    counts = kept(
        sample.select("text", "toxic")
        .mapInArrow(count, "part string, in_toxic long, in_clean long")
        .groupBy("part")
        .agg(F.sum("in_toxic").alias("in_toxic"), F.sum("in_clean").alias("in_clean"))
        .withColumn("weight", weight),
        20 * (n_toxic + n_clean),
    )
    share = (F.col("in_toxic") + F.col("in_clean")) / (n_toxic + n_clean or 1)
    spread = F.sqrt(share * (1 - share) * (1 / (n_toxic or 1) + 1 / (n_clean or 1)))
    apart = F.col("in_toxic") / (n_toxic or 1) - F.col("in_clean") / (n_clean or 1)
    good = counts.withColumn("deviation", F.when(spread > 0, apart / spread)).filter(
        (F.col("weight") >= LEAST_WEIGHT) & (F.col("deviation") >= LEAST_DEVIATION)
    )
    best = good.orderBy(F.desc("deviation"), "part").limit(4 * most).collect()
    weights = {row["part"]: row["weight"] for row in best}
    chosen: dict[str, float] = {}
    for part in sorted(weights, key=lambda part: (len(part.strip()), part)):
        shorter = [part.strip()[:n] for n in range(SHORTEST, len(part.strip()) + 1)]
        above = max((chosen[f" {stem}"] for stem in shorter if f" {stem}" in chosen), default=None)
        # A longer entry has to say clearly more than the stem it begins with.
        if above is None or weights[part] > above + 0.7:
            chosen[part] = weights[part]
    lexicon = dict(sorted(chosen.items(), key=lambda item: (-item[1], item[0]))[:most])
    for word in KNOWN:
        entry = f" {fold(word).strip()} "
        if not any(entry.startswith(known) for known in lexicon):
            lexicon[entry] = KNOWN_WEIGHT
    stems = [entry for entry in lexicon if not entry.endswith(" ")]
    lengths = sorted({len(stem) for stem in stems})
    begins = F.lit(False)
    for length in lengths:
        same = [stem for stem in stems if len(stem) == length]
        begins = begins | F.substring("part", 1, length).isin(same)
    # Words that begin like an entry and are as likely in clean texts.
    usual = counts.filter(F.col("part").endswith(" ") & (F.col("in_clean") >= 5) & (F.col("weight") <= 0)).filter(begins)
    harmless = [row["part"] for row in usual.orderBy(F.desc("in_clean"), "part").limit(most).collect()]
    phrases = [f" {fold(phrase).strip()} " for phrase in HARMLESS]
    exceptions = tuple(entry for entry in dict.fromkeys(harmless + phrases) if entry not in lexicon)
    return tuple(lexicon.items()), exceptions


def _regression(
    rows: np.ndarray, toxic: np.ndarray, weights: np.ndarray, strength: float = 0.01
) -> tuple[float, ...]:
    """Logistic regression of weighted rows by Newton steps; fixed coefficients where a label is missing."""
    if not 0 < toxic.sum() < len(toxic):
        return -4.0, 1.0, 0.5, 0.5, 0.2
    design = np.column_stack([np.ones(len(rows)), rows])
    found = np.zeros(design.shape[1])
    penalty = strength * np.diag([0.0] + [1.0] * rows.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ found, -30, 30)))
        gradient = design.T @ (weights * (p - toxic)) + penalty @ found
        step = np.linalg.solve((design * (weights * p * (1 - p))[:, None]).T @ design + penalty + 1e-6 * np.eye(len(found)), gradient)
        found -= step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(found.tolist())


def scored(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` with ``score`` and ``predicted`` (1 from ``threshold`` on, else 0) in front.

    Null and empty texts have the score of a text without entries. Every row has a score, whatever
    it repeats; an empty table stays empty; columns of these names are replaced.
    """
    with_score = documents.withColumn("score", score(F.col("text"), model))
    return with_score.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
