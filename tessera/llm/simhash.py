"""SimHash near-dedup with pigeonring filtering.

A fingerprint of 64 bits is cut into a ring of five segments. If two fingerprints differ in at most 4 bits, some segment starts a chain in which the first l segments together differ in at most floor(4 l / 5) bits, for every l. So that segment is equal, and of the next two together at most 2 bits differ: of four parts of those, two are equal. These equal bits (about 26) make the keys by which fingerprints meet, 30 for each. Pairs that meet are held against the chain's budgets for two, three and four segments before all bits are counted.

Equal fingerprints are one node throughout. A key held by many fingerprints is dealt into blocks of bounded size, and each pair of blocks is a task's work of its own, so no group is gathered whole; a task returns no more links than join its nodes.

Defined cases: a text without words (null, empty, white space) has fingerprint zero and links like any other; fewer than four words make one shingle; repeated rows and repeated ids are rows of their own; a null doc_id gets the component of its fingerprint and is never its smallest id (null where all are null); an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut, free_name, keyed_texts, stored
from tessera.llm.components import components, forest
from tessera.llm.jaccard import similar_links
from tessera.llm.registry import query

SHINGLE, SEED, MOST_BITS = 4, 42, 4
SEGMENTS = ((0, 13), (13, 26), (26, 39), (39, 52), (52, 64))
#: Fingerprints of a key that one block holds, about.
BLOCK = 1024


_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None) -> int:
    """The fingerprint as a signed integer of 64 bits; bit 0 of the ring is its highest."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: max(1, len(words) - SHINGLE + 1)].tolist()
    stops = ends[min(SHINGLE, len(words)) - 1 :].tolist()
    shingles = map(joined.__getitem__, map(slice, starts, stops))
    raw = np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED))), np.uint8).reshape(-1, 8)
    columns = np.ascontiguousarray(raw.T)
    total = np.concatenate([np.bincount(c, minlength=256) @ _BITS_OF_BYTE for c in columns])
    return int.from_bytes(np.packbits(2 * total > len(raw)).tobytes(), "big", signed=True)


def _bits(start: int, stop: int) -> int:
    return sum(1 << (63 - b) for b in range(start, stop))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def chains() -> list[tuple[int, int]]:
    """(first segment, mask of the bits that are equal) of each key."""
    out = []
    for r in range(5):
        first, *rest = (SEGMENTS[(r + k) % 5] for k in range(3))
        near = [b for s in rest for b in range(*s)]
        cuts = [round(len(near) * k / 4) for k in range(5)]
        parts = [sum(1 << (63 - b) for b in near[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]
        out += [(r, _bits(*first) | parts[i] | parts[j]) for i in range(4) for j in range(i + 1, 4)]
    return out


def keys(fingerprints: DataFrame) -> DataFrame:
    """fp, ring (the chain's first segment) and key of every fingerprint, 30 rows for each."""
    each = [F.struct(F.lit(r).cast("byte").alias("ring"), F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m)))).alias("key")) for k, (r, m) in enumerate(chains())]
    return fingerprints.select("fp", F.explode(F.array(*each)).alias("k")).select("fp", "k.ring", "k.key")


def _budget_masks() -> np.ndarray:
    """By first segment: the bits of the second, of the next two, of the next three."""
    out = np.zeros((5, 3), np.uint64)
    for r in range(5):
        mask = 0
        for k in range(1, 4):
            mask |= _bits(*SEGMENTS[(r + k) % 5])
            out[r, k - 1] = mask
    return out


def _link_blocks(batches):
    """Links within runs of equal (key, lo, hi) of sorted rows: (a, b) that join what is near, reduced to a forest."""
    budgets = _budget_masks()
    held = None
    found_a: list[np.ndarray] = []
    found_b: list[np.ndarray] = []
    size = 0

    def links(cols):
        """Row k of a run meets row k + d, for each d as long as runs are."""
        key, lo, hi, ring, part, fp = cols
        idx = np.arange(len(key))
        d = 1
        while True:
            idx = idx[idx + d < len(key)]
            nxt = idx + d
            idx = idx[(key[nxt] == key[idx]) & (lo[nxt] == lo[idx]) & (hi[nxt] == hi[idx])]
            if not len(idx):
                return
            nxt = idx + d
            ok = (lo[idx] == hi[idx]) | (part[idx] != part[nxt])
            i, j = idx[ok], nxt[ok]
            x = fp[i] ^ fp[j]
            for k, most in enumerate((1, 2, 3)):
                near = np.bitwise_count(x & budgets[ring[i], k]) <= most
                i, j, x = i[near], j[near], x[near]
            near = np.bitwise_count(x) <= MOST_BITS
            if near.any():
                yield fp[i[near]].view(np.int64), fp[j[near]].view(np.int64)
            d += 1

    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        cols[5] = cols[5].astype(np.int64).view(np.uint64)
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
        same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
        last = len(same) - int(same[::-1].argmin()) if not same.all() else 0
        held = [c[last:] for c in cols]
        for a, b in links([c[:last] for c in cols]):
            found_a.append(a), found_b.append(b)
            size += len(a)
            if size > 1 << 20:
                a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
                found_a, found_b, size = [a], [b], len(a)
    if held is not None:
        for a, b in links(held):
            found_a.append(a), found_b.append(b)
    if found_a:
        a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def near_links(fingerprints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join all fingerprints (column fp, distinct) within 4 bits of each other."""
    all_keys = keys(fingerprints)
    shared = all_keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    met = all_keys.join(shared, "key").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts").cast("long")).cast("int"))
    blocks = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = blocks.select("key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "ring", "part", "fp")
    dealt = blocks.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return dealt.mapInArrow(_link_blocks, "a long, b long")


def fingerprints_of(docs: DataFrame) -> DataFrame:
    """doc_id and fp of every document."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t.as_py()) for t in batch.column(1)], pa.int64())], ["doc_id", "fp"])

    return keyed_texts(docs).mapInArrow(run, "doc_id long, fp long")


def groups(first: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """fp and first of every linked fingerprint that is not alone: of rows (fp, first), fp distinct, the smallest first of its component, nulls last. more: further links (a, b) of fingerprints."""
    links = near_links(first.select("fp"))
    roots = components(links if more is None else cut(links.unionByName(more))).withColumnRenamed("node", "fp")
    found = roots.join(first, "fp")
    low = found.groupBy("root").agg(F.min("first").alias("low"))
    return found.join(low, "root").select("fp", F.col("low").alias("first"))


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    found = cut(fingerprints_of(docs))
    first = cut(found.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = groups(first).withColumnRenamed("first", "low")
    # stored, so that the join below has a shuffle alone on each side and a fingerprint of many documents can be split
    named = cut(first.join(linked, "fp", "left").select("fp", F.coalesce("low", "first").alias("component_id")))
    return found.join(named, "fp").select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, similar: bool = False) -> DataFrame:
    """The documents, with all their columns, of which no near copy with a smaller id is there: one row of each component stays (of rows of one id, or without id, one of them). similar: texts whose five-word shingles have Jaccard similarity 0.8 are near copies too."""
    names = docs.columns

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint).astype("int64")

    rid, fp = free_name(docs, "_rid"), free_name(docs, "_fp")
    numbered = stored(docs.withColumn(rid, F.monotonically_increasing_id()).withColumn(fp, of(F.col("text").cast("string"))), "simhash")
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").cast("long").alias("doc_id"), F.col(rid).alias("rid"))
    first = cut(numbered.select(F.col(fp).alias("fp"), place.alias("place")).groupBy("fp").agg(F.min("place").alias("first")))
    more = similar_links(numbered.select(F.col(fp).alias("fp"), F.col("text"))) if similar else None
    linked = groups(first, more).withColumnRenamed("first", "low")
    stays = first.join(linked, "fp", "left").where(F.col("low").isNull() | (F.col("low.rid") == F.col("first.rid"))).select(F.col("first.rid").alias(rid))
    return numbered.join(stays, rid, "left_semi").select(names)


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
