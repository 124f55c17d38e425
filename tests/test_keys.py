from __future__ import annotations

import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.keys import (
    change_hash,
    entity_key,
    joined_hash,
    require_stable_text,
)
from ledgerloom.sources.stamping import stamp_capture


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def one(spark, column, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, value)
    return df.select(column.alias("x")).first()["x"]


def test_entity_and_link_keys(spark):
    key = entity_key(F.lit("core_banking"), F.lit("A1"))
    assert one(spark, key) == sha("core_banking|A1")
    link = joined_hash(F.lit("a"), F.lit("p1"), F.lit("b"))
    assert one(spark, link) == sha("a|p1|b")


def test_null_part_gives_null(spark):
    assert one(spark, entity_key(F.lit(None).cast("string"), F.lit("A1"))) is None


def test_trim_takes_spaces_only(spark):
    assert one(spark, F.trim(F.lit(" \tA1 "))) == "\tA1"


def test_change_hash_document(spark):
    values = {
        "name": F.lit('a "b" ü'),
        "flag": F.lit(True),
        "day": F.lit(date(2026, 1, 2)),
        "at": F.lit("2026-01-02 03:04:05").cast("timestamp_ntz"),
        "amount": F.lit("1.50").cast("decimal(18,2)"),
        "nothing": F.lit(None).cast("string"),
    }
    hashed = change_hash(
        [
            ("name", False),
            ("flag", False),
            ("day", True),
            ("at", True),
            ("amount", True),
            ("nothing", False),
        ]
    )
    document = (
        '{"name":"a \\"b\\" ü","flag":true,"day":"2026-01-02","at":"2026-01-02 03:04:05",'
        '"amount":"1.50"}'
    )
    assert one(spark, hashed, **values) == sha(document)


def test_all_null_attributes_still_have_a_hash(spark):
    nothing = F.lit(None).cast("string")
    assert one(spark, change_hash([("a", False)]), a=nothing) == sha("{}")


def test_zoned_timestamps_need_utc(spark):
    zoned = spark.range(1).select(F.lit(datetime(2026, 1, 1)).cast("timestamp").alias("at"))
    require_stable_text(zoned, ["at"])
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="session zone"):
            require_stable_text(zoned, ["at"])
        require_stable_text(zoned.select(F.col("at").cast("timestamp_ntz")), ["at"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_source_system_without_separator(spark):
    with pytest.raises(ValueError, match="must not contain"):
        stamp_capture(spark.range(1), "c", datetime(2026, 1, 1), system="a|b")
