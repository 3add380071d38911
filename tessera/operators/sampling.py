"""Deterministic samples: balanced strata by quotas, uniform draws, seeded orders.

How many rows a stratum gives depends on the strata's sizes alone. So sizes are counted, a small allocator turns each tag's sizes into quotas, and the rows of each stratum are taken in the order of a seeded hash.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def allocate(sizes: list[tuple[tuple[str, ...], int]], count: int) -> list[int]:
    """Rows from each stratum: again and again the one whose values, dimension by dimension, have given least, then the stratum itself, then the first by name."""
    given: list[dict[str, int]] = [{} for _ in (sizes[0][0] if sizes else ())]
    out = [0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: sizes[i][0])
    heap = [((0,) * (len(given) + 1), r, i) for r, i in enumerate(order) if sizes[i][1] > 0]
    heapq.heapify(heap)
    left = min(count, sum(n for _, n in sizes))
    while left and heap:
        key, r, i = heapq.heappop(heap)
        now = (*(g.get(v, 0) for g, v in zip(given, sizes[i][0], strict=True)), out[i])
        if now != key:  # its counters have moved on
            heapq.heappush(heap, (now, r, i))
            continue
        out[i] += 1
        left -= 1
        for g, v in zip(given, sizes[i][0], strict=True):
            g[v] = g.get(v, 0) + 1
        if out[i] < sizes[i][1]:
            heapq.heappush(heap, ((*(g[v] for g, v in zip(given, sizes[i][0], strict=True)), out[i]), r, i))
    return out


def quotas(df: DataFrame, tag: str, strata: list[str], count: int | None = None) -> DataFrame:
    """tag, the strata's columns, size and quota. Without a count each tag gives as many rows as the smallest tag has. One task sees a tag's strata, never its rows."""
    sizes = df.groupBy(tag, *strata).agg(F.count(F.lit(1)).alias("size"))
    per_tag = sizes.groupBy(tag).agg(F.sum("size").alias("rows"))
    cap = per_tag.agg(F.min("rows").alias("cap")) if count is None else df.sparkSession.range(1).select(F.lit(count).cast("long").alias("cap"))
    capped = sizes.join(F.broadcast(cap))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        keys = [tuple("" if v is None else str(v) for v in r) for r in group[strata].itertuples(index=False)]
        group["quota"] = allocate(list(zip(keys, group["size"], strict=True)), int(group["cap"].iloc[0]))
        return group.drop(columns="cap")

    schema = capped.drop("cap").withColumn("quota", F.lit(0).cast("long")).schema
    return capped.groupBy(tag).applyInPandas(fill, schema)


def stratified(df: DataFrame, tag: str, strata: list[str], key: str, seed: int, count: int | None = None) -> DataFrame:
    """A sample as balanced over strata as their sizes allow; quotas are one row for each stratum."""
    q = quotas(df, tag, strata, count).drop("size")
    order = W.partitionBy(tag, *strata).orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)
    ranked = df.withColumn("_rank", F.row_number().over(order))
    kept = ranked.join(q, [ranked[c].eqNullSafe(q[c]) for c in (tag, *strata)]).where("_rank <= quota")
    return kept.select(*(ranked[c] for c in df.columns))


def uniform(df: DataFrame, key: str, seed: int, count: int) -> DataFrame:
    """So many rows by a seeded hash of their key: a top-k, so each task gives its own first rows only."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(count)


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)
