"""Each document with the one after it, in descending order of ids, without one task for all."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A row's place: ids from the greatest down, nulls last; of equal ids by a hash of the text, then as stored.
PLACE = ["turned", "without_id", "print", "stored"]
# Parts for each partition an exchange has: a task hands over all texts of a part, and those after them.
SMALLER = 4
_LAST = 2**63 - 1


def with_next(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the ``next_text`` of every document (``doc_id`` long, ``text``; null: empty).

    The order is that of descending ids; null ids come last, rows that share an id in the order of a
    hash of their texts, and repeated rows as they are stored (so ``documents`` must read alike each
    time, as tables do). The first document comes after the last one, a single one after itself. An
    empty table gives no rows, and other columns are not looked at.

    A first pass over places alone finds where the parts of a range partitioning begin, a row per
    part, a few times as many as exchanges have partitions. In the second, the first row of each part
    goes to the part before as well, so that every part has all it needs and texts are exchanged once.
    """
    rows = _placed(documents)
    parts = SMALLER * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.struct(F.col("dealt.part").alias("part"), F.lit(False).alias("guest"))
    before = F.struct(F.col("dealt.before").alias("part"), F.lit(True).alias("guest"))
    goes_to = F.array_compact(F.array(own, F.when(F.col("dealt.before").isNotNull(), before)))
    dealt = rows.withColumn("dealt", _parts(_firsts(rows, parts))(*PLACE)).select("doc_id", "text", *PLACE, F.inline(goes_to))
    order = Window.partitionBy("part").orderBy("guest", *PLACE)
    # As many tasks as parts, so that a task holds little at a time.
    found = dealt.repartition(parts, "part").withColumn("next_text", F.lead("text").over(order))
    return found.filter(~F.col("guest")).select("doc_id", "text", "next_text")


def _placed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id",
        "text",
        F.coalesce(F.bitwise_not("doc_id"), F.lit(_LAST)).alias("turned"),
        F.col("doc_id").isNull().cast("long").alias("without_id"),
        F.xxhash64("text").alias("print"),
        F.monotonically_increasing_id().alias("stored"),
    )


def _firsts(rows: DataFrame, parts: int) -> list[tuple[int, ...]]:
    """The place at which each of ``parts`` parts begins, a row per part."""
    # Places are narrow: without a number of its own this exchange would be joined into a few parts.
    dealt = rows.select(*PLACE).repartitionByRange(parts, *PLACE).groupBy(F.spark_partition_id().alias("part"))
    return sorted(tuple(row["first"]) for row in dealt.agg(F.min(F.struct(*PLACE)).alias("first")).collect())


def _parts(firsts: list[tuple[int, ...]]):
    """The part of a place, and, where it begins one, the part before (before the first: the last)."""
    turned = np.array([first[0] for first in firsts], np.int64)

    @F.arrow_udf("part int, before int")
    def of(*place: pa.Array) -> pa.Array:
        at = [column.to_numpy(zero_copy_only=False) for column in place]
        part = np.searchsorted(turned, at[0], side="right") - 1
        before = np.full(len(part), -1)
        # Only where a part begins within rows of one id the rest of the place matters.
        for i in np.flatnonzero(np.isin(at[0], turned)).tolist():
            whole = tuple(int(column[i]) for column in at)
            part[i] = bisect_right(firsts, whole) - 1
            if firsts[part[i]] == whole:
                before[i] = (part[i] - 1) % len(firsts)
        return pa.StructArray.from_arrays(
            [pa.array(part, pa.int32()), pa.array(before, pa.int32(), mask=before < 0)], names=["part", "before"]
        )

    return of
