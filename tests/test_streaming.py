"""A stream through a gate with fixed boundaries, against the same rows in a batch."""

import pytest
from pyspark.sql import functions as F

from tessera.streaming import gated


def test_labelled_stream(spark, tmp_path):
    rows = [(k, float(k), f"2024-01-01 00:{k:02d}:00") for k in range(20)]
    batch = spark.createDataFrame(rows, "id long, v double, t string").withColumn("t", F.to_timestamp("t"))
    batch.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(batch.schema).parquet(f"{tmp_path}/in")
    out = gated.labelled_stream(stream, "v", [5.0, 15.0], F.when(F.col("v") > 18, "too_high"))
    query = gated.windowed_counts(out, "t", "10 minutes", "1 hour", "tier").writeStream.outputMode("complete").format("memory").queryName("tiers").start()
    query.processAllAvailable()
    query.stop()
    got = {(r["start"].minute, r["tier"]): r["n"] for r in spark.table("tiers").collect()}
    assert got == {(0, "slow"): 6, (0, "normal"): 4, (10, "normal"): 5, (10, "fast"): 4, (10, None): 1}
    with pytest.raises(ValueError):
        gated.labelled_stream(batch, "v", [2.0, 1.0])
