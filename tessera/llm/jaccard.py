"""Links between texts whose sets of five-word shingles have Jaccard similarity SIMILARITY or more.

1. Texts of one shingle set are one node. A node has BANDS keys of ROWS minima each; two of similarity 0.8 share a key with chance 1 - (1 - 0.8^4)^25, over 0.99999.
2. Each node meets the smallest of every key it has, and what met is verified on the sets themselves.
3. Nodes that share a key and aren't joined by links yet all meet, keys of many nodes dealt into blocks. Pairs with ALIKE of their BANDS * ROWS minima in common (at similarity 0.8 all but about 1.3 in a million) are verified likewise, each from the first key that it shares. So a pair is left out only where verified links join it already or its minima differ too much.

Defined cases: a text of under five words has no shingles and no links; words are taken as for passages.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, forget, stored
from tessera.llm.components import components
from tessera.llm.passages import SIMILARITY, _mixed, shingles

BANDS, ROWS = 25, 4
#: Minima (of BANDS * ROWS) that a pair has in common before its sets are compared.
ALIKE = 60
#: Nodes of a key that one block holds, about, and bytes of text that are hashed at once.
BLOCK, CHUNK = 1024, 1 << 20
_NODE_SQL = "node long, fp long, tokens array<int>, bands array<long>, mark binary"


def _sets(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Of texts: which have shingles, the sets of their hashes, their bands' keys, and a byte of each of their minima."""
    token, count = shingles(b"".join(texts), np.cumsum([len(t) for t in texts]))
    has = np.flatnonzero(count)
    sets = [np.unique(t) for t in np.split(token, np.cumsum(count)[:-1])]
    sets = [sets[k] for k in has.tolist()]
    if not sets:
        return has, sets, np.zeros((0, BANDS), np.uint64), np.zeros((0, BANDS * ROWS), np.uint8)
    every, heads = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    keys, minima = np.zeros((len(sets), BANDS), np.uint64), np.zeros((len(sets), BANDS * ROWS), np.uint8)
    seeds = _mixed(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)).reshape(-1, 2)
    with np.errstate(over="ignore"):
        for f, (seed, odd) in enumerate(seeds):
            low = np.minimum.reduceat((every ^ seed) * (odd | np.uint64(1)) >> np.uint64(20), heads)
            keys[:, f // ROWS] = _mixed(keys[:, f // ROWS] + low + np.uint64(f + 1))
            minima[:, f] = low & np.uint64(255)
    return has, sets, keys, minima


def _nodes(batches):
    def rows(fps: list[int], texts: list[bytes]) -> pa.RecordBatch:
        has, sets, keys, minima = _sets(texts)
        with np.errstate(over="ignore"):
            node = np.array([_mixed(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
        tokens = [(s >> np.uint64(32)).astype(np.uint32).view(np.int32) for s in sets]
        columns = [pa.array(node, pa.int64()), pa.array([fps[k] for k in has.tolist()], pa.int64()), pa.array(tokens, pa.list_(pa.int32())), pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())), pa.array([k.tobytes() + m.tobytes() for k, m in zip(keys, minima, strict=True)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["node", "fp", "tokens", "bands", "mark"])

    for batch in batches:
        fps, texts, size = [], [], 0
        for fp, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = t.as_buffer().to_pybytes() if t.is_valid else b""
            if texts and size + len(raw) > CHUNK:
                yield rows(fps, texts)
                fps, texts, size = [], [], 0
            fps.append(fp), texts.append(raw)
            size += len(raw)
        if texts:
            yield rows(fps, texts)


def _verify(batches):
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            u, v = np.unique(np.asarray(x.values)), np.unique(np.asarray(y.values))
            both = np.intersect1d(u, v, assume_unique=True).size if min(len(u), len(v)) >= SIMILARITY * max(len(u), len(v)) else 0
            keep.append(both >= SIMILARITY * (len(u) + len(v) - both))
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of distinct pairs (a, b) of nodes those that are similar, stored. sets: node and tokens, one row for each node."""
    told = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    return cut(told.select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long"))


def _meet(batches):
    """Of sorted rows (key, lo, hi, part, node, root, mark): pairs of a run of equal (key, lo, hi) with different roots that share no key before this and have ALIKE minima in common."""

    def pairs(cols):
        key, lo, hi, part, node, root, mark = cols
        bands, minima = np.ascontiguousarray(mark[:, : 8 * BANDS]).view(np.int64), mark[:, 8 * BANDS :]
        idx, d = np.arange(len(key)), 1
        while True:
            idx = idx[idx + d < len(key)]
            idx = idx[(key[idx + d] == key[idx]) & (lo[idx + d] == lo[idx]) & (hi[idx + d] == hi[idx])]
            if not len(idx):
                return
            i = idx[((lo[idx] == hi[idx]) | (part[idx] != part[idx + d])) & (root[idx] != root[idx + d])]
            i = i[(minima[i] == minima[i + d]).sum(1) >= ALIKE]
            i = i[bands[i, (bands[i] == bands[i + d]).argmax(1)] == key[i]]
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[i + d])), pa.array(np.maximum(node[i], node[i + d]))], ["a", "b"])
            d += 1

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        cols[6] = np.frombuffer(b"".join(cols[6]), np.uint8).reshape(batch.num_rows, -1)
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
        same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
        last = len(same) - int(same[::-1].argmin()) if not same.all() else 0
        held = [c[last:] for c in cols]
        yield from pairs([c[:last] for c in cols])
    if held is not None:
        yield from pairs(held)


def similar_links(texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Of rows (fp, text): links (a, b) of fp that join all whose texts are similar, stored."""
    spark, paths = texts.sparkSession, {}
    nodes = stored(texts.select("fp", F.col("text").cast("string").alias("text")).mapInArrow(_nodes, _NODE_SQL), "sets", paths)
    # only keys that several nodes have go on
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    low = keyed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("most")).where("a < most").select("key", "a")
    shared = stored(keyed.join(low, "key").select("key", "node", "a").distinct(), "shared", paths)
    # texts of one set are linked through the smallest fp among them
    least = cut(nodes.groupBy("node").agg(F.min("fp").alias("fp")))
    own = cut(nodes.select("node", F.col("fp").alias("b")).join(least, "node").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct())
    sets = stored(nodes.select("node", "tokens", "mark").join(shared.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "met", paths)
    forget(spark, paths, "sets")
    first = _verified(shared.where("node <> a").select("a", F.col("node").alias("b")).distinct(), sets)
    roots = cut(components(first))
    named = stored(shared.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")), "named", paths)
    forget(spark, paths, "shared")
    # two nodes have met already
    open_keys = named.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("least"), F.max("root").alias("most")).where("n > 2 and least < most")
    open_keys = open_keys.select("key", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    met = named.join(open_keys, "key").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts").cast("long")).cast("int"))
    dealt = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "node", "root").join(sets.select("node", "mark"), "node").select("key", "lo", "hi", "part", "node", "root", "mark")
    dealt = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    second = _verified(stored(dealt.mapInArrow(_meet, "a long, b long"), "pairs", paths), sets)
    links = first.unionByName(second).join(least.select(F.col("node").alias("a"), F.col("fp").alias("x")), "a").join(least.select(F.col("node").alias("b"), F.col("fp").alias("y")), "b")
    links = cut(own.unionByName(links.select(F.col("x").alias("a"), F.col("y").alias("b"))).where("a <> b").distinct())
    forget(spark, paths, *paths)
    return links
