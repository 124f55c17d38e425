"""Hash keys and change hashes, as column expressions.

All of them stay JVM-side and are applied after grouping or change detection, so a hash is computed
once per result row and 64-character keys never travel through those shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Both are part of every stored hash.
SEPARATOR = "|"
HASH_BITS = 256


def joined_hash(*parts: Column) -> Column:
    """Hash of the parts with a separator between them; null if any part is null."""
    spaced = [parts[0]]
    for part in parts[1:]:
        spaced += [F.lit(SEPARATOR), part]
    return F.sha2(F.concat(*spaced), HASH_BITS)


def entity_key(record_source: Column, business_key: Column) -> Column:
    """Key of one entity; the business key is expected to be trimmed already."""
    return joined_hash(record_source, business_key)


def change_hash(attributes: Sequence[tuple[str, bool]]) -> Column:
    """Hash over named attributes, in the given order.

    ``attributes`` holds (column, as_text). Nulls leave their field out of the hashed document, so a
    null that becomes a value is a change and a null that stays null is not.
    """
    fields = [
        (F.col(name).cast("string") if as_text else F.col(name)).alias(name)
        for name, as_text in attributes
    ]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}), HASH_BITS)


def require_stable_text(df: DataFrame, columns: Sequence[str]) -> None:
    """Refuse zoned timestamps outside UTC: their text, and so their hash, would depend on the zone."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        return
    zoned = [name for name, kind in df.dtypes if name in columns and kind == "timestamp"]
    if zoned:
        raise ValueError(
            f"columns {zoned} are zoned timestamps and the session zone is {zone}; "
            "use UTC or timestamps without zone"
        )
