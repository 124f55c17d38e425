"""Document fingerprints: bottom-k sketches of word shingles, which can be merged and compared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_slices
from ledgerloom.llm.words import cut, lowered

WORDS = 5
# Hashes a sketch keeps. A resemblance of r is estimated to about sqrt(r (1 - r) / SIZE).
SIZE = 128
SEED = 42
HASH_BYTES = 8
# Bytes of text looked at together; a longer text is looked at alone.
SLICE = 4_000_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
# The shifts and factors of the finishing steps of the SplitMix64 generator.
_MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1))


def sketch(text: Column, words: int = WORDS, size: int = SIZE) -> Column:
    """The ``size`` smallest distinct hashes of a text's shingles: 8 bytes each, ascending, as binary.

    A shingle is ``words`` words (stretches without ASCII white space, A-Z lower-cased); a text of fewer
    words is one shingle, one without words, null included, has an empty sketch. A sketch of less
    than ``size`` hashes holds all shingles. Equal texts have equal sketches, on every machine. Memory
    and time are in proportion to a text, whatever its length.
    """
    return sketches([text], words, size)["sketch_0"]


def sketches(texts: list[Column], words: int = WORDS, size: int = SIZE) -> Column:
    """The sketches of several texts of a row as a struct (``sketch_0``, ...), and how much the first
    resembles each other one (``resemblance_1``, ...). A text that occurs more than once among
    neighbouring rows is looked at once."""
    names = [f"sketch_{i}" for i in range(len(texts))]
    others = [f"resemblance_{i}" for i in range(1, len(texts))]
    kinds = [f"{name} binary" for name in names] + [f"{name} double" for name in others]

    @F.arrow_udf(", ".join(kinds))
    def of(*columns: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([*columns], names=names)
        parts = []
        for some in in_slices(batch, 0, SLICE // len(names)):
            found = _distinct_sketches(some.columns, words, size)
            alike = [
                pa.array([bytes_resemblance(x, y, size) for x, y in zip(found[0], other)], pa.float64())
                for other in found[1:]
            ]
            parts.append(pa.StructArray.from_arrays([pa.array(one, pa.binary()) for one in found] + alike, names + others))
        empty = [(name, pa.binary()) for name in names] + [(name, pa.float64()) for name in others]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(empty))

    return of(*texts)


def _distinct_sketches(columns: list[pa.Array], words: int, size: int) -> list[list[bytes]]:
    texts = pa.concat_arrays([pc.cast(pc.fill_null(column, ""), pa.large_string()) for column in columns])
    coded = texts.dictionary_encode()
    known = text_sketches(coded.dictionary, words, size)
    places = coded.indices.to_numpy().reshape(len(columns), -1).tolist()
    return [[known[place] for place in mine] for mine in places]


def text_sketches(texts: pa.Array, words: int = WORDS, size: int = SIZE) -> list[bytes]:
    """The sketches of an Arrow column of texts."""
    coded, counts = cut(lowered(texts))
    known = [xxhash.xxh64_intdigest(word, SEED) for word in coded.dictionary.to_pylist()]
    hashes = np.array(known, np.uint64)[coded.indices.to_numpy()] if known else np.empty(0, np.uint64)
    ends = np.cumsum(counts)
    found, mixed = [], _shingles(hashes, words)
    for start, end in zip((ends - counts).tolist(), ends.tolist()):
        if end - start >= words:
            mine = np.unique(mixed[start : end - words + 1])[:size]
        else:
            mine = _shingles(hashes[start:end], end - start)
        found.append(mine.astype(">u8").tobytes())
    return found


def _shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of all stretches of ``words`` words, from those of the words; their order counts."""
    if not words or len(hashes) < words:
        return hashes[:0]
    many = len(hashes) - words + 1
    mixed = np.zeros(many, np.uint64)
    for i in range(words):
        mixed = mixed * _STEP + hashes[i : i + many]
    for shift, factor in _MIX:
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return mixed


def _hashes(sketch: bytes) -> np.ndarray:
    return np.frombuffer(sketch, ">u8").astype(np.uint64)


def bytes_resemblance(a: bytes, b: bytes, size: int = SIZE) -> float:
    if a == b:
        return 1.0
    left, right = _hashes(a), _hashes(b)
    # The smallest of both together are the sketch of the texts' shingles together.
    both = np.union1d(left, right)[:size]
    shared = np.intersect1d(left, right, assume_unique=True)
    return int(np.searchsorted(shared, both[-1], side="right")) / len(both)


def bytes_distinct(sketch: bytes, size: int = SIZE) -> float:
    if len(sketch) < size * HASH_BYTES:
        return float(len(sketch) // HASH_BYTES)
    return (size - 1) * 2.0**64 / float(_hashes(sketch[-HASH_BYTES:])[0])


def bytes_containment(a: bytes, b: bytes, size: int = SIZE) -> float:
    if not a:
        return 1.0
    both = np.union1d(_hashes(a), _hashes(b))[:size].astype(">u8").tobytes()
    return min(1.0, bytes_resemblance(a, b, size) * bytes_distinct(both, size) / bytes_distinct(a, size))


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Share of the shingles of either text that both have, from their sketches, 0 to 1; two texts without
    words have 1, and a null sketch counts as an empty one."""
    return _of_two(bytes_resemblance, a, b, size)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Share of the shingles of ``a`` that ``b`` has too, 0 to 1; a text without words is contained in any."""
    return _of_two(bytes_containment, a, b, size)


def _of_two(compare, a: Column, b: Column, size: int) -> Column:
    @F.arrow_udf("double")
    def of(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = zip(left.to_pylist(), right.to_pylist())
        return pa.array([compare(x or b"", y or b"", size) for x, y in pairs], pa.float64())

    return of(a, b)


def distinct_shingles(sketch: Column, size: int = SIZE) -> Column:
    """How many distinct shingles there are: exact below ``size``, else by the place of the last hash."""
    largest = F.conv(F.hex(F.substring(sketch, -HASH_BYTES, HASH_BYTES)), 16, 10).cast("double")
    kept = F.floor(F.octet_length(sketch) / HASH_BYTES)
    return F.when(kept < size, kept.cast("double")).otherwise(F.lit((size - 1) * 2.0**64) / largest)


def fingerprints(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    size: int = SIZE,
) -> DataFrame:
    """One row per row of ``documents``: its id, ``sketch`` and ``distinct_shingles`` (an estimate).

    Rows that repeat are rows of their own, null ids stay null, an empty table gives no rows, and other
    columns are not looked at.
    """
    found = documents.select(
        F.col(id_column).alias("id"), sketch(F.col(text_column), words, size).alias("sketch")
    )
    return found.select(
        F.col("id").alias(id_column), "sketch", distinct_shingles(F.col("sketch"), size).alias("distinct_shingles")
    )


def merged(sketches: DataFrame, by: list[str], size: int = SIZE, column: str = "sketch") -> DataFrame:
    """The sketch of all texts of each group, from theirs: columns ``by`` and ``sketch``.

    Each task keeps the smallest hashes of a group before the exchange, so a group with any number of
    sketches is ``size`` rows per task from there on. A null in ``by`` is a group too. A group
    whose sketches are all empty (or null) has an empty one.
    """
    keys = [f"by_{i}" for i in range(len(by))]
    groups = [F.col(name).alias(key) for name, key in zip(by, keys)]
    last = F.floor(F.octet_length(column) / HASH_BYTES).cast("int") - 1
    places = F.when(last >= 0, F.sequence(F.lit(0), last))
    each = F.transform(places, lambda i: F.substring(column, i * HASH_BYTES + 1, F.lit(HASH_BYTES)))
    hashes = sketches.select(*groups, F.explode_outer(each).alias("hash")).distinct()
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("hash"))
    smallest = hashes.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)
    in_order = F.array_sort(F.collect_list("hash"))
    united = smallest.groupBy(*keys).agg(F.unhex(F.array_join(F.transform(in_order, F.hex), "")).alias("sketch"))
    return united.select(*[F.col(key).alias(name) for key, name in zip(keys, by)], "sketch")


def written(sketch: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits per hash."""
    return F.lower(F.hex(sketch))
