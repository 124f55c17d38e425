"""Periodic runs: stretches of words that repeat themselves, found by a sparse diagonal DP."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_slices
from ledgerloom.llm.words import cut, plain

# A run has this many words at least, and this many times its period.
LEAST_WORDS = 6
LEAST_TIMES = 4
# Bytes of text looked at together; a longer text is looked at alone.
SLICE = 4_000_000

FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``documents``: its id, ``n_words``, its ``runs`` and its ``collapsed`` text.

    Words are the maximal stretches without ASCII white space, numbered from 0. A run is a stretch of
    words with smallest period q, of LEAST_WORDS words and LEAST_TIMES q at least, which no neighbouring
    word extends; runs come by start, then period. ``collapsed`` has the words joined by one space
    without those that lie in a run beyond its first q words.

    A null or empty text has no words, no runs and the empty text; runs that share words are all
    found. A text is looked at as a whole, whatever its length, in memory and time in proportion to
    its words (times a logarithm where it repeats itself). Rows that repeat are rows of their own, null
    ids stay null, an empty table gives no rows, and other columns are not looked at.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in in_slices(batch, 1, SLICE):
                yield pa.RecordBatch.from_arrays([some.column(0), *_found(some.column(1))], names=names)

    names = ["id", "n_words", "runs", "collapsed"]
    return rows.mapInArrow(find, f"id {kind}, {FOUND}").withColumnRenamed("id", id_column)


def _found(texts: pa.Array) -> list[pa.Array]:
    words, counts = cut(plain(texts))
    first = np.cumsum(counts) - counts
    text, start, length, period = diagonals(words.indices.to_numpy(), np.repeat(np.arange(len(counts)), counts))
    start = start - first[text]
    # Where runs overlap, a word goes as soon as one of them drops it.
    total = int(counts.sum())
    drops = np.zeros(total + 1, np.int64)
    np.add.at(drops, first[text] + start + period, 1)
    np.add.at(drops, first[text] + start + length, -1)
    stays = np.cumsum(drops[:-1]) == 0
    left = np.bincount(np.repeat(np.arange(len(counts)), counts)[stays], minlength=len(counts))
    lines = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(left))), pa.int32()),
        pc.cast(words.dictionary, pa.string()).take(words.indices.filter(pa.array(stays))),
    )
    runs = pa.StructArray.from_arrays(
        [pa.array(start), pa.array(length), pa.array(period)], names=["start", "length", "period"]
    )
    ends = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(counts)))))
    return [
        pa.array(counts),
        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
        pc.binary_join(lines, " "),
    ]


def diagonals(words: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of every run, by text, start and period.

    ``words`` are numbers of words, text after text; ``texts`` has the text of each word. Starts count
    over all texts.

    A diagonal is a lag at which words equal earlier ones. Where a run has the period q, a stretch of
    at least q words has its nearest earlier occurrence exactly q words before: a nearer one would
    make the period smaller. So of a word's earlier occurrences only the nearest of the stretch of
    ``wide`` words beginning there needs to be followed, for periods over ``wide`` / 2 up to ``wide``, and
    ``wide`` doubles. Each word then has one active lag per width: its match grows as long as the lag
    stays, and where the lag changes the diagonal has ended, and is a run if it was long enough. Only
    words whose stretch occurs again go on to the next width, and these become few at once.
    """
    ends = np.cumsum(np.bincount(texts)) if len(texts) else np.empty(0, np.int64)
    at = np.arange(len(words))
    code = texts.astype(np.int64) * (int(words.max()) + 1 if len(words) else 1) + words
    longest = int(np.bincount(texts).max()) if len(texts) else 0
    found, wide = [], 1
    while len(at) and wide // 2 < longest // LEAST_TIMES:
        order = np.argsort(code, kind="stable")
        same = code[order][1:] == code[order][:-1]
        lag = np.zeros(len(at), np.int64)
        lag[order[1:]] = np.where(same, at[order[1:]] - at[order[:-1]], 0)
        found.append(_ended(at, lag, wide))
        # The next stretches: twice as wide, of two that both occur again.
        group = np.empty(len(at), np.int64)
        group[order] = np.cumsum(np.concatenate(([0], ~same)))
        again = np.bincount(group)[group] > 1
        place = np.full(len(words) + wide, -1, np.int64)
        place[at[again]] = group[again]
        at = at[again]
        at = at[place[at + wide] >= 0]
        at = at[at + 2 * wide <= ends[texts[at]]]
        code = place[at] * (int(group.max()) + 1) + place[at + wide]
        wide *= 2
    if not found:
        return (np.empty(0, np.int64),) * 4
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, start))
    return texts[start[order]].astype(np.int64), start[order], length[order], period[order]


def _ended(at: np.ndarray, lag: np.ndarray, wide: int) -> np.ndarray:
    """Start, length and period of the diagonals over ``wide`` // 2 up to ``wide`` that were long enough."""
    active = (lag > wide // 2) & (lag <= wide)
    at, lag = at[active], lag[active]
    if not len(at):
        return np.empty((3, 0), np.int64)
    ended = np.flatnonzero((at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1]))
    begun = np.concatenate(([0], ended + 1))
    match = at[np.concatenate((ended, [len(at) - 1]))] - at[begun] + wide
    period = lag[begun]
    length = match + period
    run = length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
    return np.stack([(at[begun] - period)[run], length[run], period[run]])


def made_periodic(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` for trying the operator on: with h the crc32 of the id in decimal and g = h
    div 10, in texts with h mod 10 = 0 each of the n words from number a = g mod n on becomes word
    a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Other texts, and those whose id is null, stay as
    they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")
    # Step by step, so that a text is cut once; a null where there is nothing to edit.
    rows = documents.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1)
    a, p, rest = F.col("a"), F.col("p"), F.col("n") - F.col("a")

    def part(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("words", start.cast("int"), length.cast("int")), " ")

    many = F.repeat(F.concat(part(a + 1, p), F.lit(" ")), F.floor(rest / p).cast("int"))
    edited = F.concat_ws(" ", part(F.lit(1), a), F.rtrim(many), part(a + 1, rest % p))
    return rows.select("doc_id", F.when(a.isNotNull(), edited).otherwise(F.col("text")).alias("text"))
