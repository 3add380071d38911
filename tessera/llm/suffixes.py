"""Exact substring dedup by a distributed, common-prefix-aware merge sort of suffixes.

Two equal strings of WIDTH bytes have the same minimizer, the 24-byte string of lowest hash in them, at the same place. So each document is cut into runs of windows that share their minimizer, and only the suffix from a minimizer (with the bytes before it that its windows need) has to be sorted: one suffix for about 14 windows.

1. Documents are packed into compressed blocks of bounded size, stored in the shared folder.
2. Each block sends its minimizers' hashes, sorted, delta-coded and dealt by hash range. A range's task answers each block which of them at least two documents have; all else is unique text.
3. Each block sends the suffixes that are left: distinct ones, with the smallest document that has each, sorted and front-coded. A range's task merges the blocks' runs with a loser tree that keeps each contender's common prefix with the last winner, so known prefixes are never compared again. Equal neighbours in that order share a minimizer; their windows are compared exactly, and each block hears which windows a smaller document has.
4. Each block removes the bytes that such windows cover.

A block sends a string that many of its documents share once, so that no task gathers the documents that share a passage. Ranges are dealt by hash and grow in number with the input.

Defined cases: a null or empty text has no bytes and loses none; texts under WIDTH bytes lose nothing; a null doc_id counts as larger than all others, and so do rows of one id among each other as the same document; strings repeated within one document stay; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut, keyed_texts, stored, trim
from tessera.llm.registry import query

WIDTH, GRAM = 50, 24
SPAN = WIDTH - GRAM + 1
#: Bytes of text in a block and of the input for one hash range, about.
BLOCK_BYTES, RANGE_BYTES = 6 << 20, 12 << 20
#: A block has 2^IDX_BITS documents at most, so that a document's number (bid, place in it) is a long.
IDX_BITS = 19
#: Windows whose hashes are held at once.
CHUNK = 1 << 18
_LAST = np.iinfo(np.int64).max
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays in one compressed blob; bytes of one place in the numbers stand together."""
    import zstandard

    out = []
    for a in arrays:
        if isinstance(a, np.ndarray):
            kind, raw = a.dtype.str, np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() if a.size else b""
        else:
            kind, raw = "raw", a
        out.append(f"{kind}:{len(raw)};".encode() + raw)
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def _unpack(blob: bytes) -> list:
    import zstandard

    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        end = raw.index(b";", at)
        kind, _, n = raw[at:end].decode().partition(":")
        body = raw[end + 1 : end + 1 + int(n)]
        at = end + 1 + int(n)
        if kind == "raw":
            out.append(body)
        else:
            size = np.dtype(kind).itemsize
            out.append(np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(size, -1).T).view(kind).reshape(-1))
    return out


def blocks(docs: DataFrame, words: int = 0) -> DataFrame:
    """Rows (bid, n_bytes, body) of packed documents: ids, null flags, sizes and texts. words: also heads, of each document with so many words and an id its place in the block, doc_id, number of words and a digest of the text (A-Z in lower case)."""
    fields = [("bid", pa.int64()), ("n_bytes", pa.int64()), ("body", pa.binary())]
    sql = "bid long, n_bytes long, body binary"
    if words:
        fields.append(("heads", pa.list_(pa.struct([("idx", pa.int32()), ("doc", pa.int64()), ("n", pa.int32()), ("digest", pa.binary())]))))
        sql += ", heads array<struct<idx int, doc long, n int, digest binary>>"

    def heads(ids: list, texts: list[bytes]) -> list[tuple]:
        gap = np.append(_SPACE[np.frombuffer(b"".join(texts), np.uint8)], True)
        starts = np.append(0, np.cumsum([len(t) for t in texts]))
        begins = ~gap
        begins[1:] &= gap[:-1]
        # a word that begins a text may follow another's last at once
        heads = np.minimum(starts[:-1], len(gap) - 1)
        begins[heads] = ~gap[heads]
        total = np.append(0, np.cumsum(begins))
        n = (total[starts[1:]] - total[starts[:-1]]).tolist()
        return [(k, i, n[k], hashlib.blake2b(t.lower(), digest_size=16).digest()) for k, (i, t) in enumerate(zip(ids, texts, strict=True)) if i is not None and n[k] >= words]

    def row(pid: int, seq: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        body = _pack(np.array([_LAST if i is None else i for i in ids], np.int64), np.array([i is None for i in ids], np.uint8), np.array([len(t) for t in texts], np.int64), b"".join(texts))
        values = [pid << 24 | seq, sum(map(len, texts)), body]
        if words:
            values.append(heads(ids, texts))
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(values, fields, strict=True)], [n for n, _ in fields])

    def run(batches):
        from pyspark import TaskContext

        pid, seq, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                if ids and (size + len(raw) > BLOCK_BYTES or len(ids) == 1 << IDX_BITS):
                    yield row(pid, seq, ids, texts)
                    seq, ids, texts, size = seq + 1, [], [], 0
                ids.append(i), texts.append(raw)
                size += len(raw)
        if ids:
            yield row(pid, seq, ids, texts)
        trim()

    return keyed_texts(docs).mapInArrow(run, sql)


class Block:
    """A block's documents and their runs of windows: first window, number of windows, place and hash of the minimizer."""

    def __init__(self, body: bytes):
        self.ids, self.no_id, self.sizes, self.raw = _unpack(body)
        self.ends = np.cumsum(self.sizes)
        code = np.frombuffer(self.raw, np.uint8)
        n = len(code)
        starts = self.ends - self.sizes
        edge = np.zeros(n + 1, np.int32)
        long = self.sizes >= WIDTH
        edge[starts[long]] += 1
        edge[self.ends[long] - WIDTH + 1] -= 1
        whole = np.cumsum(edge[:n], dtype=np.int32) > 0
        # some windows at a time, as hashes take much room; a run cut in two is two runs
        parts = [self._runs(code, whole, a, min(a + CHUNK, n)) for a in range(0, n, CHUNK)]
        parts.append([np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)])
        self.first, self.count, self.anchor, self.key = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.doc = np.searchsorted(self.ends, self.first, side="right")

    @staticmethod
    def _runs(code: np.ndarray, whole: np.ndarray, start: int, stop: int) -> list[np.ndarray]:
        """Runs of the windows that begin in start..stop: first window, number, place and hash of the minimizer."""
        none = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
        code = code[start : stop + WIDTH - 1]
        n = len(code)
        if n < WIDTH:
            return none
        with np.errstate(over="ignore"):
            m = 0x9E3779B97F4A7C15
            h, step, eight = code.astype(np.uint64) + np.uint64(1), 1, (None, 0)
            while step < 16:
                h = h[:-step] * np.uint64(m) + h[step:]
                m, step = m * m % (1 << 64), 2 * step
                if step == 8:
                    eight = h, m
            h = h[: n - GRAM + 1] * np.uint64(eight[1]) + eight[0][16 : 16 + n - GRAM + 1]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        low = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= SPAN:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        low = np.minimum(low[: n - WIDTH + 1], low[SPAN - size : SPAN - size + n - WIDTH + 1])
        p = np.flatnonzero(whole[start : start + len(low)])
        if not len(p):
            return none
        anchor = (low[p] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(p), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1)
        at = np.flatnonzero(new)
        # the smallest of many hashes is small, so they are mixed anew before ranges deal them out
        with np.errstate(over="ignore"):
            key = h[anchor[at]] * np.uint64(0x9E3779B97F4A7C15)
        return [p[at] + start, np.diff(np.append(at, len(p))), anchor[at] + start, key ^ (key >> np.uint64(32))]

    def hashes(self, ranges: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(range, sorted distinct hashes, whether two of the block's documents have each)."""
        return by_range(*distinct(self.key, self.ids[self.doc])[:2], ranges)

    def entries(self, ranges: int, shared: dict[int, np.ndarray]):
        """The distinct suffixes that are left, by range and in order: (range, suffix, bytes before it); the smallest id of each; the runs of windows that are left; and the place of each in the distinct ones. shared: by range, flags of the sorted distinct hashes."""
        key, several, order, member = distinct(self.key, self.ids[self.doc])
        flags = [shared.get(r, np.zeros(len(k), bool)) for r, k, _ in by_range(key, several, ranges)]
        left = np.zeros(len(self.key), bool)
        if flags:
            left[order] = np.concatenate(flags)[member]
        runs = np.flatnonzero(left)
        r = range_of(self.key[runs], ranges).tolist()
        f, a = self.first[runs], self.anchor[runs]
        raw, ids = self.raw, self.ids[self.doc[runs]].tolist()
        place = [(k, raw[j:e], raw[i:j]) for k, i, j, e in zip(r, f.tolist(), a.tolist(), (f + self.count[runs] + WIDTH - 1).tolist(), strict=True)]
        found: dict[tuple[int, bytes, bytes], int] = {}
        for entry, i in zip(place, ids, strict=True):
            if found.setdefault(entry, i) > i:
                found[entry] = i
        every = sorted(found)
        rank = dict(zip(every, range(len(every)), strict=True))
        return every, list(map(found.__getitem__, every)), runs, np.fromiter(map(rank.__getitem__, place), np.int64, len(place))


def range_of(key: np.ndarray, ranges: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def distinct(key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, whether each has several ids, the order that sorts the keys, and the place in the distinct ones of each in that order."""
    if not len(key):
        return key, np.zeros(0, bool), np.zeros(0, int), np.zeros(0, int)
    order = np.argsort(key)
    key, ids = key[order], ids[order]
    new = np.append(True, key[1:] != key[:-1])
    head = np.flatnonzero(new)
    return key[head], np.minimum.reduceat(ids, head) != np.maximum.reduceat(ids, head), order, np.cumsum(new) - 1


def by_range(key: np.ndarray, several: np.ndarray, ranges: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    r = range_of(key, ranges)
    for k in np.unique(r).tolist():
        a, b = np.searchsorted(r, [k, k + 1])
        yield k, key[a:b], several[a:b]


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """How many first bytes are equal; so many are known to be. The highest bit in which the rests differ tells."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n]) ^ int.from_bytes(b[known:n])
    return n - ((x.bit_length() + 7) >> 3)


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Of sorted strings: the length shared with the one before, their lengths, and the rest of each."""
    shared, rest, before = [], [], b""
    for s in strings:
        k = common_prefix(before, s, 0)
        shared.append(k), rest.append(s[k:])
        before = s
    return np.array(shared, np.uint8), np.array([len(s) for s in strings], np.uint8), b"".join(rest)


def front_decode(shared: np.ndarray, sizes: np.ndarray, rest: bytes) -> list[bytes]:
    out, at, before = [], 0, b""
    for k, n in zip(shared.tolist(), sizes.tolist(), strict=True):
        before = before[:k] + rest[at : at + n - k]
        at += n - k
        out.append(before)
    return out


def merge_runs(runs: list[list[bytes]], shared: list[list[int]]) -> Iterator[tuple[int, int, int]]:
    """(run, place in it, length shared with the string before) of all strings of sorted runs, in order, by a loser tree. shared[r][k] is the length that string k of a run shares with the one before it. A contender carries the length it shares with the last winner: of two, the longer wins unread, and only equal lengths are read on from there."""
    m = len(runs)
    width = 1
    while width < max(1, m):
        width *= 2
    at = [0] * width
    head: list[bytes | None] = [r[0] if r else None for r in runs] + [None] * (width - m)
    known = [0] * width
    tree = [0] * width

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's length is then the one it shares with the winner."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        i, j = known[a], known[b]
        if i > j:
            return a, b
        if j > i:
            return b, a
        k = common_prefix(x, y, i)
        if k == len(x) or k < len(y) and x[k] < y[k]:
            known[b] = k
            return a, b
        known[a] = k
        return b, a

    level = list(range(width))
    base = width
    while len(level) > 1:
        base //= 2
        nxt = []
        for k in range(0, len(level), 2):
            won, lost = play(level[k], level[k + 1])
            tree[base + k // 2] = lost
            nxt.append(won)
        level = nxt
    won = level[0]
    while head[won] is not None:
        yield won, at[won], known[won]
        at[won] += 1
        k = at[won]
        if k < len(runs[won]):
            head[won], known[won] = runs[won][k], shared[won][k]
        else:
            head[won] = None
        node = (won + width) // 2
        while node:
            won, tree[node] = play(won, tree[node])
            node //= 2


def window_masks(group: list[tuple[bytes, bytes, int]]) -> list[int]:
    """For strings (suffix, bytes before it, smallest id) of one minimizer: bit k is set if a smaller document has the k-th window."""
    wholes = [b + s for s, b, _ in group]
    if all(w == wholes[0] for w in wholes[1:]):
        low = min(i for *_, i in group)
        full = (1 << (len(wholes[0]) - WIDTH + 1)) - 1
        return [full if i > low else 0 for *_, i in group]
    least: dict[bytes, int] = {}
    cuts = [[w[k : k + WIDTH] for k in range(len(w) - WIDTH + 1)] for w in wholes]
    for windows, (*_, i) in zip(cuts, group, strict=True):
        for w in windows:
            if i < least.get(w, _LAST + 1):
                least[w] = i
    return [sum(1 << k for k, w in enumerate(windows) if least[w] < i) for windows, (*_, i) in zip(cuts, group, strict=True)]


def _rows(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
    return pa.table([pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


_MESSAGE = [("bid", pa.int64()), ("kind", pa.int32()), ("r", pa.int64()), ("blob", pa.binary())]
_MESSAGE_SQL = "bid long, kind int, r long, blob binary"
_RANGED = [("r", pa.int64()), ("bid", pa.int64()), ("blob", pa.binary())]


def _send_hashes(ranges: int):
    def run(batches):
        for batch in batches:
            for bid, body in zip(batch.column("bid").to_pylist(), batch.column("body"), strict=True):
                for r, key, several in Block(body.as_py()).hashes(ranges):
                    yield _rows([(r, bid, _pack(np.diff(key, prepend=np.uint64(0)), np.packbits(several)))], _RANGED).to_batches()[0]

    return run


def _answer_hashes(table: pa.Table) -> pa.Table:
    """Of the hashes of one range: which of each block's stand in two documents at least."""
    parts = [_unpack(b) for b in table["blob"].to_pylist()]
    keys = [np.cumsum(p[0], dtype=np.uint64) for p in parts]
    several = [np.unpackbits(p[1], count=len(k)).astype(bool) for p, k in zip(parts, keys, strict=True)]
    every = np.sort(np.concatenate(keys + [k[s] for k, s in zip(keys, several, strict=True)]))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    rows = []
    for bid, r, k in zip(table["bid"].to_pylist(), table["r"].to_pylist(), keys, strict=True):
        at = np.searchsorted(twice, k)
        at[at == len(twice)] = 0
        hit = twice[at] == k if len(twice) else np.zeros(len(k), bool)
        rows.append((bid, 0, r, _pack(np.array([len(k)], np.int64), np.packbits(hit))))
    return _rows(rows, _MESSAGE)


def _flags(messages: pa.Table) -> dict[int, np.ndarray]:
    out = {}
    for kind, r, blob in zip(messages["kind"].to_pylist(), messages["r"].to_pylist(), messages["blob"].to_pylist(), strict=True):
        if kind == 0:
            n, bits = _unpack(blob)
            out[r] = np.unpackbits(bits, count=int(n[0])).astype(bool)
    return out


def _send_suffixes(ranges: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for body in left["body"].to_pylist():
            order, ids, _, _ = Block(body).entries(ranges, _flags(right))
            a = 0
            while a < len(order):
                r, b = order[a][0], a
                while b < len(order) and order[b][0] == r:
                    b += 1
                own = order[a:b]
                coded = front_code([s for _, s, _ in own])
                before = [x for _, _, x in own]
                rows.append((r, left["bid"][0].as_py(), _pack(*coded, np.array([len(x) for x in before], np.uint8), b"".join(before), np.array(ids[a:b], np.int64))))
                a = b
        return _rows(rows, _RANGED)

    return run


def _answer_suffixes(table: pa.Table) -> pa.Table:
    """Merges the blocks' runs of one range; each block hears, for each string it sent, which of its windows a smaller document has."""
    runs, shared, before, ids = [], [], [], []
    for blob in table["blob"].to_pylist():
        lcp, sizes, rest, before_sizes, before_raw, own = _unpack(blob)
        runs.append(front_decode(lcp, sizes, rest))
        shared.append(lcp.tolist())
        ends = np.cumsum(before_sizes, dtype=np.int64).tolist()
        before.append([before_raw[a:b] for a, b in zip([0, *ends], ends, strict=False)])
        ids.append(own.tolist())
    masks = [np.zeros(len(r), np.uint32) for r in runs]
    held: list[tuple[int, int]] = []

    def settle() -> None:
        if len(held) > 1 and len({ids[r][k] for r, k in held}) > 1:
            for (r, k), mask in zip(held, window_masks([(runs[r][k], before[r][k], ids[r][k]) for r, k in held]), strict=True):
                masks[r][k] = mask

    for r, k, same in merge_runs(runs, shared):
        if held and same < GRAM:
            settle()
            held = []
        held.append((r, k))
    settle()
    return _rows([(bid, 1, r, _pack(m)) for bid, r, m in zip(table["bid"].to_pylist(), table["r"].to_pylist(), masks, strict=True)], _MESSAGE)


def _remove(ranges: int, with_text: bool):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for body in left["body"].to_pylist():
            block = Block(body)
            order, low, runs, place = block.entries(ranges, _flags(right))
            answers = {r: _unpack(blob)[0] for kind, r, blob in zip(right["kind"].to_pylist(), right["r"].to_pylist(), right["blob"].to_pylist(), strict=True) if kind == 1}
            told = np.concatenate([answers[r] for r in sorted(answers)]) if answers else np.zeros(0, np.uint32)
            edge = np.zeros(len(block.raw) + 1, np.int32)
            if len(runs):
                count, first = block.count[runs], block.first[runs]
                # a later document of the block has every window of a string that an earlier one has
                mask = np.where(block.ids[block.doc[runs]] > np.array(low)[place], np.uint32(0xFFFFFFFF), told[place])
                full = mask == 0xFFFFFFFF
                full |= mask == (np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)
                np.add.at(edge, first[full], 1)
                np.add.at(edge, first[full] + count[full] + WIDTH - 1, -1)
                some = ~full & (mask > 0)
                count, first, mask = count[some], first[some], mask[some]
                for k in range(SPAN):
                    at = first[(k < count) & (mask >> np.uint32(k) & np.uint32(1) == 1)] + k
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + WIDTH, -1)
            gone = np.cumsum(edge, dtype=np.int32)[:-1] > 0
            code = np.frombuffer(block.raw, np.uint8)
            for i, no_id, n, end in zip(block.ids.tolist(), block.no_id.tolist(), block.sizes.tolist(), block.ends.tolist(), strict=True):
                cut_here = gone[end - n : end]
                kept = code[end - n : end][~cut_here].tobytes()
                spans = int(np.count_nonzero(np.diff(cut_here.astype(np.int8), prepend=0) == 1))
                rows.append((None if no_id else i, n, n - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        return _rows(rows, [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document, and if asked for the bytes that are kept."""
    packed = stored(blocks(docs), "blocks")
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_BYTES))
    by_range = packed.mapInArrow(_send_hashes(ranges), "r long, bid long, blob binary").groupBy("r")
    flags = cut(by_range.applyInArrow(_answer_hashes, _MESSAGE_SQL))
    sent = packed.groupBy("bid").cogroup(flags.groupBy("bid")).applyInArrow(_send_suffixes(ranges), "r long, bid long, blob binary")
    masks = cut(sent.groupBy("r").applyInArrow(_answer_suffixes, _MESSAGE_SQL))
    told = flags.unionByName(masks)
    out = packed.groupBy("bid").cogroup(told.groupBy("bid")).applyInArrow(_remove(ranges, with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_text else out.drop("kept")


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
