"""Batches to Python are bounded in bytes."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zonepulse.llm import shipping


def test_batches_of_long_texts(spark):
    rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    found = [r.n for r in shipping.map_arrow(rows, sizes, "n long").collect()]
    assert max(found) <= 1.2 * shipping.BATCH_BYTES and sum(found) >= 60_000_000


def test_a_lower_bound_stays(spark):
    before = spark.conf.get(shipping._BATCH)
    try:
        spark.conf.set(shipping._BATCH, "1m")
        shipping.map_arrow(spark.range(1), lambda b: b, "id long")
        assert spark.conf.get(shipping._BATCH) == "1m"
    finally:
        spark.conf.set(shipping._BATCH, before)


@pytest.mark.parametrize(("text", "size"), [("1048576", 1 << 20), ("64m", 64 << 20), ("64MB", 64 << 20), ("2g", 2 << 30), ("1048576b", 1 << 20), ("-1", 1 << 62)])
def test_sizes(text, size):
    assert shipping._bytes(text) == size
