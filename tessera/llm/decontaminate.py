"""Benchmark decontamination by q-gram lemma filtering.

Benchmark items are cut into overlapping segments. A text that holds a segment within k edits shares at least w + 1 - q (k + 1) of its w + 1 - q character q-grams with it, all on diagonals (place in the text less place in the segment) at most k apart. So shared q-grams are counted in overlapping diagonal bands, regions that meet the bound are kept, and a banded alignment verifies each. All steps work on whole batches of texts at once.

Texts are compared in lower case with white space as single spaces. An item shorter than a segment is one segment, with an edit budget in proportion. An item under MIN_ITEM characters must stand in the text as it is, between ends of words; those under Q characters have no q-gram and are looked up by a hash of their whole. Items without a letter or digit match nothing.

Defined cases: a null or empty text or item matches nothing; a null doc_id or item_id is carried; repeated rows match each for themselves; an empty table on either side gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bpe import _slices
from tessera.llm.common import keyed_texts
from tessera.llm.registry import query

Q, SEGMENT, EDITS, MIN_ITEM = 10, 64, 4, 32
#: Characters of benchmark items in one broadcast index; a larger benchmark is worked off in parts of this size.
INDEX_CHARS = 2_000_000

_SPACES = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
_MULT = 0x9E3779B97F4A7C15


def _codes(text: str) -> np.ndarray:
    """Lower-cased code points, one for each of the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)


def squeezed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts in a row: code points with a zero after each text, their places in their text, starts of the texts."""
    parts = [_codes((t or "") + "\0") for t in texts]
    code = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    sizes = np.array([len(p) for p in parts])
    first = np.cumsum(sizes) - sizes
    gap = (code <= 32) & (code >= 9) & ((code <= 13) | (code == 32))
    if (code > 127).any():
        gap |= np.isin(code, _SPACES)
    code = np.where(gap, np.uint32(32), code)
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    place = np.flatnonzero(keep)
    starts = np.searchsorted(place, first)
    return code[place], place, starts, first


def gram_hashes(code: np.ndarray) -> np.ndarray:
    """A hash of the Q code points from each place."""
    m1 = _MULT
    with np.errstate(over="ignore"):
        h = code.astype(np.uint64) + np.uint64(1)
        powers, have, n, m = {1: (h, m1)}, h, 1, m1
        while 2 * n <= Q:
            have = have[:-n] * np.uint64(m) + have[n:]
            n, m = 2 * n, m * m % (1 << 64)
            powers[n] = have, m
        out, done = None, 0
        for k in sorted(powers, reverse=True):
            if done + k <= Q:
                h, m = powers[k]
                out = h if out is None else out[: len(h) - done] * np.uint64(m) + h[done : done + len(out)]
                done += k
        out = out[: max(0, len(code) - Q + 1)]
        return out ^ (out >> np.uint64(29))


def _whole_hashes(code: np.ndarray, w: int) -> np.ndarray:
    """A hash of the w code points from each place."""
    n = max(0, len(code) - w + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(w):
            out = out * np.uint64(_MULT) + code[k : k + n].astype(np.uint64) + np.uint64(1)
    return out


def _word_chars(code: np.ndarray) -> np.ndarray:
    """Which code points are letters or digits."""
    kinds, which = np.unique(code, return_inverse=True)
    return np.array([chr(c).isalnum() for c in kinds.tolist()], bool)[which] if len(kinds) else np.zeros(0, bool)


class SegmentIndex:
    """Segments of benchmark items and, for each q-gram of theirs, where it stands."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids = [i for i, _ in items]
        self.segments: list[np.ndarray] = []
        owner, edits, exact, grams, gram_segment, gram_at = [], [], [], [], [], []
        self.tiny: dict[int, dict[int, list[int]]] = {}
        for k, (_, text) in enumerate(items):
            code, _, _, _ = squeezed([text])
            code = code[:-1]
            code = code[int(len(code) > 0 and code[0] == 32) : len(code) - int(len(code) > 1 and code[-1] == 32)]
            if not _word_chars(code).any():
                continue
            w, short = min(SEGMENT, len(code)), len(code) < MIN_ITEM
            for a in sorted({*range(0, len(code) - w + 1, SEGMENT // 2), len(code) - w}):
                s = len(self.segments)
                self.segments.append(code[a : a + w])
                owner.append(k)
                edits.append(0 if short else max(0, min(EDITS * w // SEGMENT, (w - Q) // Q)))
                exact.append(short)
                if w < Q:
                    self.tiny.setdefault(w, {}).setdefault(int(_whole_hashes(code, w)[0]), []).append(s)
                    continue
                h = gram_hashes(code[a : a + w])
                grams.append(h), gram_segment.append(np.full(len(h), s, np.int32)), gram_at.append(np.arange(len(h), dtype=np.int32))
        self.owner, self.edits, self.exact = np.array(owner, int), np.array(edits, int), np.array(exact, bool)
        self.width = np.array([len(s) for s in self.segments], int)
        self.padded = np.zeros((len(self.segments), SEGMENT), np.uint32)
        for k, s in enumerate(self.segments):
            self.padded[k, : len(s)] = s
        self.least = self.width + 1 - Q * (self.edits + 1)
        all_grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(all_grams, kind="stable")
        self.grams, self.gram_start = np.unique(all_grams[order], return_index=True)
        self.gram_stop = np.append(self.gram_start[1:], len(all_grams))
        self.gram_segment = (np.concatenate(gram_segment) if grams else np.zeros(0, int))[order]
        self.gram_at = (np.concatenate(gram_at) if grams else np.zeros(0, int))[order]
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(self.grams >> np.uint64(42)).astype(np.int64)] = True

    def regions(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, first diagonal) of the bands that meet the segment's bound."""
        none = np.zeros(0, int), np.zeros(0, int)
        if len(code) < Q or not len(self.grams):
            return none
        h = gram_hashes(code)
        place = np.flatnonzero(self.sieve[(h >> np.uint64(42)).astype(np.int64)])
        g = np.searchsorted(self.grams, h[place])
        g[g == len(self.grams)] = 0
        real = self.grams[g] == h[place]
        place, g = place[real], g[real]
        if not len(place):
            return none
        found_s, found_d = [], []
        counts = (self.gram_stop - self.gram_start)[g]
        total = np.cumsum(counts)
        at, step = 0, 1 << 21
        carry: tuple[np.ndarray, np.ndarray] | None = None
        while at < len(place):  # hits in runs of bounded size; counts of a band are summed over runs
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + step)))
            n = counts[at:stop]
            row = np.repeat(np.arange(at, stop), n)
            hit = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + self.gram_start[g[row]]
            seg = self.gram_segment[hit].astype(np.int64)
            diagonal = place[row] - self.gram_at[hit] + SEGMENT
            band = diagonal // (self.edits[seg] + 1)
            both = np.concatenate([seg << 40 | band, seg << 40 | (band - 1)])
            key, num = np.unique(both, return_counts=True)
            if carry is not None:
                key, inverse = np.unique(np.concatenate([carry[0], key]), return_inverse=True)
                num = np.bincount(inverse, np.concatenate([carry[1], num])).astype(int)
            carry = key, num
            at = stop
        key, num = carry
        seg = key >> 40
        good = num >= self.least[seg]
        found_s, band = seg[good], (key & ((1 << 40) - 1))[good]
        found_d = band * (self.edits[found_s] + 1) - SEGMENT
        return found_s, found_d

    def align(self, code: np.ndarray, seg: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least edits of each region's segment against the text about its band, and where in the text that alignment ends (exclusive); more than the budget counts as no match."""
        best, end = np.full(len(seg), SEGMENT), np.zeros(len(seg), int)
        for k in range(0, len(seg), 4096):
            s, d = seg[k : k + 4096], diagonal[k : k + 4096]
            edits, width = self.edits[s], self.width[s]
            span = int(2 * (edits.max() + 1) + 2 * edits.max() + 1)
            first = d - edits
            cols = np.arange(span)
            # texts end in zeros, which no segment has; places outside are as zeros
            padded = np.concatenate([np.zeros(4 * SEGMENT, np.uint32), code, np.zeros(4 * SEGMENT, np.uint32)])
            cost = np.zeros((len(s), span), np.int32)
            done = np.zeros(len(s), bool)
            for i in range(int(width.max())):
                text = padded[np.clip(first[:, None] + i + cols + 4 * SEGMENT, 0, len(padded) - 1)]
                step = cost + (text != self.padded[s, i][:, None])
                step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
                step = np.minimum.accumulate(step - cols, axis=1) + cols
                cost = np.where((i < width)[:, None], step, cost)
                done |= width == i + 1
            at = cost.argmin(axis=1)
            best[k : k + 4096] = cost[np.arange(len(s)), at]
            end[k : k + 4096] = first + at + width
        return best, end

    def exactly(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, end) of all places of the items that have no q-gram."""
        found: list[tuple[int, int]] = []
        for w, known in self.tiny.items():
            h = _whole_hashes(code, w)
            for at in np.flatnonzero(np.isin(h, np.fromiter(known, np.uint64, len(known)))).tolist():
                found += [(s, at + w) for s in known[int(h[at])] if (self.segments[s] == code[at : at + w]).all()]
        both = np.array(found, int).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def matches(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(place of the text, place of the item, start, end, edits) of each text and item that match: the widest stretch of the text over all segments found, in code points, and the fewest edits of a segment."""
        code, place, starts, first = squeezed(texts)
        seg, diagonal = self.regions(code)
        edits, end = self.align(code, seg, diagonal)
        good = edits <= self.edits[seg]
        tiny, tiny_end = self.exactly(code)
        seg, edits, end = np.append(seg[good], tiny), np.append(edits[good], np.zeros(len(tiny), int)), np.append(np.clip(end[good], 1, len(code)), tiny_end)
        if not len(seg):
            return []
        start = np.maximum(0, end - self.width[seg])
        # short items stand between ends of words
        inner = self.exact[seg].copy()
        ends_in_word = _word_chars(code[end - 1]) & _word_chars(code[np.minimum(end, len(code) - 1)])
        starts_in_word = (start > 0) & _word_chars(code[start]) & _word_chars(code[start - 1])
        good = ~(inner & (ends_in_word | starts_in_word))
        seg, edits, end, start = seg[good], edits[good], end[good], start[good]
        text = np.searchsorted(starts, end - 1, side="right") - 1
        out: dict[tuple[int, int], tuple[int, int, int]] = {}
        for t, o, a, b, e in zip(text.tolist(), self.owner[seg].tolist(), np.maximum(place[start], first[text]).tolist(), (place[end - 1] + 1).tolist(), edits.tolist(), strict=True):
            have = out.get((t, o))
            a, b = a - int(first[t]), b - int(first[t])
            out[t, o] = (a, b, e) if have is None else (min(a, have[0]), max(b, have[1]), min(e, have[2]))
        return [(t, o, *x) for (t, o), x in sorted(out.items())]


def indexes(benchmark: DataFrame, most: int = INDEX_CHARS):
    """Indexes of at most so many characters each over all items (an item beyond it has one of its own): the size is counted first, and a large benchmark is dealt by a hash of its texts."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.char_length("text") > 0)
    size = items.agg(F.sum(F.char_length("text").cast("long"))).first()[0] or 0
    parts = -(-size // most)
    for k in range(parts):
        own = items if parts == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == k)
        yield SegmentIndex([(r["item_id"], r["text"]) for r in own.orderBy("item_id", "text").toLocalIterator()])


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end (code points of the text) and edits of every document and item that match."""
    texts = keyed_texts(docs)
    out = None
    for index in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            own = shared.value
            for batch in batches:
                at = 0
                for part in _slices(batch.column(1)):
                    found = own.matches(part.to_pylist())
                    ids = batch.column(0).slice(at, len(part))
                    at += len(part)
                    if found:
                        t, o, a, b, e = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(t)), pa.array([own.ids[k] for k in o], pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(e, pa.int32())], ["doc_id", "item_id", "start", "end", "edits"])

        one = texts.mapInArrow(run, "doc_id long, item_id long, start long, end long, edits int")
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, start long, end long, edits int")
    return out


def _clean_of(shared):
    """A function of texts that says which hold no passage of the index."""

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        own, out, at = shared.value, np.ones(len(texts), bool), 0
        for part in _slices(pa.array(texts, pa.string())):
            hit = {t for t, *_ in own.matches(part.to_pylist())}
            out[[at + t for t in hit]] = False
            at += len(part)
        return pd.Series(out)

    return clean


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, that hold no passage of the benchmark."""
    for index in indexes(benchmark):
        clean = _clean_of(docs.sparkSession.sparkContext.broadcast(index))
        docs = docs.where(clean(F.col("text").cast("string")))
    return docs


@query("op4_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
