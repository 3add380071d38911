"""Row-local operators over streams. Calibration needs all rows, so a stream takes boundaries that a batch has fixed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.calibrate import speed_tier


def labelled_stream(stream: DataFrame, value: str, boundaries: list[float], reason: Column | None = None) -> DataFrame:
    """The stream with reason (null where the gate passes) and tier by fixed boundaries, two or four of them."""
    if len(boundaries) not in (2, 4) or any(a >= b for a, b in zip(boundaries, boundaries[1:], strict=False)):
        raise ValueError("two or four boundaries that rise")
    q = F.array(*(F.lit(float(b)) for b in boundaries))
    out = stream.withColumn("reason", F.lit(None).cast("string") if reason is None else reason)
    return out.withColumn("tier", F.when(F.col("reason").isNull(), speed_tier(F.col(value), q, len(boundaries) == 4)))


def windowed_counts(stream: DataFrame, time: str, window: str, late: str, *keys: str) -> DataFrame:
    """start, the keys and n for each window of time; rows later than the watermark are left out, so state is bounded."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *keys, "n")
