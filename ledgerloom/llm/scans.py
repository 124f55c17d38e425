"""Running values over the elements of an array, natively and in time that grows with its length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that are walked one after another; what is carried on crosses from chunk to chunk.
CHUNK = 512
# How often chunks are chunked in turn. Plans take much longer with each level, and at one a million elements
# are 2,000 chunks.
LEVELS = 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def empty(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


def running(
    values: Column,
    kind: str,
    zero: Column,
    add: Callable[[Column, Column], Column],
    merge: Callable[[Column, Column], Column],
    carried: str,
    emit: Callable[[Column, Column], Column],
    levels: int = LEVELS,
) -> Column:
    """``emit(state, element)`` (of type ``kind``) for each element, with the state of those before it.

    ``add`` takes an element into a state (of type ``carried``), ``merge`` the state of the elements that
    follow. An array grows by being copied, so elements are walked in chunks: those are summed up first,
    the states between them found in the same way, and each is then walked from its own.
    """

    def walk(state: Column, part: Column) -> Column:
        def step(done: Column, value: Column) -> Column:
            grown = F.concat(done["out"], F.array(emit(done["state"], value)))
            return F.struct(add(done["state"], value).alias("state"), grown.alias("out"))

        begin = F.struct(state.alias("state"), empty(kind).alias("out"))
        return F.aggregate(part, begin, step, lambda done: done["out"])

    if levels == 0:
        return walk(zero, values)

    def chunked(whole: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(whole) - 1, F.lit(0)), F.lit(CHUNK))
        return let(F.transform(starts, lambda at: F.slice(whole, at + 1, CHUNK)), walked)

    def walked(chunks: Column) -> Column:
        sums = F.transform(chunks, lambda chunk: F.aggregate(chunk, zero, add))
        between = running(sums, carried, zero, merge, merge, carried, lambda state, _: state, levels - 1)
        both = F.arrays_zip(between.alias("state"), chunks.alias("chunk"))
        return F.flatten(F.transform(both, lambda pair: walk(pair["state"], pair["chunk"])))

    return let(values, chunked)


def sums_before(values: Column) -> Column:
    """For each of some ints the sum of those before it."""
    plus = lambda a, b: a + b
    return running(values, "int", F.lit(0), plus, plus, "int", lambda state, _: state)
