from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from ledgerloom.sources.sample import SampleBank


def test_a_history_is_dealt_out_before_its_rows_are_multiplied(spark, tmp_path: Path):
    """One file of one row group is one task's scan, but not one task's history."""
    keys = list(range(1, 201))
    customers = {
        "c_custkey": pa.array(keys, pa.int64()),
        "c_name": [f"Customer {key}" for key in keys],
        "c_nationkey": pa.array([0] * len(keys), pa.int32()),
        "c_acctbal": [1.0] * len(keys),
        "c_mktsegment": ["BUILDING"] * len(keys),
    }
    pq.write_table(pa.table(customers), tmp_path / "customer.parquet")
    bank = SampleBank(spark, str(tmp_path))
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "8")
    try:
        for name in ("customers", "accounts"):
            parts = bank.history(name).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
            assert sum(parts) > 3 * len(keys)
            assert max(parts) < sum(parts) / 3
    finally:
        spark.conf.set(setting, before)
