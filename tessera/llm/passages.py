"""Near-duplicate passages by compact windows.

A document's tokens are the shingles of five words. Under a hash function, all subsequences whose smallest token is at c form one compact window (l, c, r): they start in l..c and end in c..r. The windows are the nodes of the Cartesian tree over the token hashes; those that hold a subsequence of MIN_WORDS words are found for all documents of a block at once, by sliding minima and a descent over doubled spans to the nearest smaller token on each side. Two documents that share a passage share its smallest token, so windows meet by that token.

1. Documents are packed into compressed blocks (as for exact dedup). Of documents with the same text one stands for all, and the others are linked with it. Each block sends its windows' token hashes and hears which of them another document has too.
2. Windows that are left and overlap in their document are taken together: their smallest tokens under two functions are a node's key, what they have in common is its stretch. So nodes meet only where ENOUGH functions agree, and a popular shingle alone joins nothing.
3. The nodes of a key meet its first.
4. Where that found no stretch at a node's place, all nodes of the key whose documents aren't linked yet meet. Larger keys are dealt into blocks, whose nodes' tokens are counted against each other, and keys beyond BLOCKS of them are parted by rare tokens that similar stretches must share.
5. Stretches that meet are verified on the shingles themselves: shared shingles are chained over all their places in the other text, by the diagonals that most of them share, chains are split at their widest gaps and run on where both texts go on alike, until a stretch of MIN_WORDS words has Jaccard similarity SIMILARITY.

So two documents that share a passage word for word are always of one class, as such a passage has its smallest tokens under every function, and of those of similarity s enough of HASHES functions agree with chance 0.993 at s = 0.8. Inside a class, copies aren't expanded into all pairs: its documents are held against the first ones of their keys.

Defined cases: a null, empty or short text has no windows; rows without an id aren't compared; rows of one id are texts of their own, which aren't held against each other; an empty table gives an empty result. Words are taken in lower case (A-Z) between ASCII white space. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut, forget, stored, trim
from tessera.llm.components import components
from tessera.llm.registry import query
from tessera.llm.suffixes import _MESSAGE_SQL, IDX_BITS, RANGE_BYTES, _answer_hashes, _flags, _pack, _rows, _unpack, blocks, by_range, distinct

SHINGLE, MIN_WORDS, SIMILARITY, HASHES, ENOUGH = 5, 50, 0.8, 5, 2
TOKENS = MIN_WORDS - SHINGLE + 1
#: Shared tokens that some TOKENS in a row of a similar stretch have at least: the worst is a stretch of 77 tokens with its 15 unshared ones in the middle.
DENSE = 30
#: Tokens of a text that vote on a diagonal together.
NEAR = 256
#: Nodes of a key that meet directly, nodes that one block of a key holds, blocks of a key whose pairs are gone through, and tokens on either side of a node's place that are held against others'.
FEW, BLOCK, BLOCKS, REACH = 4, 512, 16, 52
#: Kind of the messages that name a block's copies.
COPY = 2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_GAP = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles of all texts in a row, and how many each has. ends: of the texts, in bytes."""
    code = np.frombuffer(raw.translate(_LOWER), np.uint8)
    n = len(ends)
    gap = _GAP[code]
    first = ~gap
    first[1:] &= gap[:-1]
    heads = np.append(0, ends[:-1])
    heads = heads[heads < len(code)]
    first[heads] |= ~gap[heads]
    at = np.flatnonzero(first)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    size = np.diff(np.append(at, len(code)))
    with np.errstate(over="ignore"):
        reach = int(size.max())
        powers = np.cumprod(np.full(reach, 0x9E3779B97F4A7C15, np.uint64)) if reach < 1 << 16 else None
        if powers is None:  # a very long word or gap: its powers are made in steps
            powers = np.concatenate([np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, np.uint64)) * np.uint64(pow(0x9E3779B97F4A7C15, k << 16, 1 << 64)) for k in range((reach >> 16) + 1)])
        place = np.arange(at[0], len(code)) - np.repeat(at, size)
        value = code[at[0] :].astype(np.uint64) + np.uint64(1)
        value[gap[at[0] :]] = 0
        word = _mixed(np.add.reduceat(value * powers[place], at - at[0]))
        words = np.bincount(np.searchsorted(ends, at, side="right"), minlength=n)
        count = np.maximum(0, words - SHINGLE + 1)
        last = np.cumsum(words)
        total = np.zeros(max(0, len(word) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            total = total * np.uint64(0xD6E8FEB86659FD93) + word[k : len(word) - SHINGLE + 1 + k]
    edge = np.zeros(len(word) + 1, np.int64)
    np.add.at(edge, last - words, 1)
    np.add.at(edge, last - words + count, -1)
    return _mixed(total)[np.cumsum(edge)[: len(total)] > 0], count


def order_of(token: np.ndarray, function: int) -> np.ndarray:
    """The tokens' values under a function, in 32 bits; none is 0."""
    with np.errstate(over="ignore"):
        seed, odd = _mixed(np.array([2 * function + 1, 2 * function + 2], np.uint64))
        return np.maximum(((token ^ seed) * (odd | np.uint64(1)) >> np.uint64(32)).astype(np.uint32), np.uint32(1))


def _sliding(x: np.ndarray, best: np.ufunc) -> np.ndarray:
    """The least or greatest of each TOKENS in a row."""
    out, size = x, 1
    while 2 * size <= TOKENS:
        out = best(out[:-size], out[size:])
        size *= 2
    n = len(x) - TOKENS + 1
    return best(out[:n], out[TOKENS - size : TOKENS - size + n])


def compact_windows(token: np.ndarray, count: np.ndarray, function: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, l, c, r) of the Cartesian tree's nodes of TOKENS tokens at least, places within their text. Of equal values the leftmost is the smaller.

    Such a node is the least of TOKENS in a row. The nearest smaller token on either side of it is one as well (its window holds the node's), so both are looked for among these alone.
    """
    n = len(token)
    none = np.zeros(0, np.int64)
    if n < TOKENS:
        return none, none, none, none
    # a zero stands before, between and after the texts and ends every window
    text = np.repeat(np.arange(len(count)), count)
    at = np.arange(n) + text + 1
    value = np.zeros(n + len(count) + 1, np.uint32)
    value[at] = order_of(token, function)
    edge = np.zeros(TOKENS - 1, np.uint32)
    most = _sliding(np.concatenate([edge, _sliding(value, np.minimum), edge]), np.maximum)
    c = np.flatnonzero((most == value) & (value > 0))
    if not len(c):
        return none, none, none, none
    v = value[c].astype(np.uint64) << np.uint64(32) | c.astype(np.uint64)
    t = text[np.searchsorted(at, c)]
    first = (np.cumsum(count) - count + np.arange(len(count)) + 1)[t]
    # nodes alone, a zero before, between and after the texts as above
    new = np.append(True, t[1:] != t[:-1])
    place = np.arange(len(c)) + np.cumsum(new)
    nodes = np.zeros(len(c) + int(new.sum()) + 1, np.uint64)
    nodes[place] = v
    where = np.zeros(len(nodes), np.int64)
    where[place] = c
    spans, longest = [nodes], int(np.diff(np.append(np.flatnonzero(new), len(c))).max())
    while 1 << len(spans) <= longest:
        half = 1 << len(spans) - 1
        spans.append(np.minimum(spans[-1][:-half], spans[-1][half:]))
    left, right = place.copy(), place.copy()
    for k in range(len(spans) - 1, -1, -1):
        step = 1 << k
        to = left - step
        ok = to >= 0
        ok[ok] = spans[k][to[ok]] >= v[ok]
        left = np.where(ok, to, left)
        ok = right + 1 + step <= len(nodes)
        ok[ok] = spans[k][right[ok] + 1] >= v[ok]
        right = np.where(ok, right + step, right)
    lo = np.where(nodes[left - 1] > 0, where[left - 1] + 1, first)
    hi = np.where(nodes[right + 1] > 0, where[right + 1], first + count[t]) - 1
    long = hi - lo + 1 >= TOKENS
    return t[long], (lo - first)[long], (c - first)[long], (hi - first)[long]


class Windows:
    """A block's documents and the compact windows of those that have an id."""

    def __init__(self, body: bytes):
        self.ids, self.no_id, sizes, raw = _unpack(body)
        known = self.no_id == 0
        ends = np.cumsum(sizes)
        parts = [[np.zeros(0, np.int64)] * 5 + [np.zeros(0, np.uint64)]]
        a = 0
        self.count = np.zeros(len(sizes), np.int64)
        while a < len(sizes):  # some texts at a time, as the minima take much room
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + (1 << 20), side="right")))
            base = int(ends[a - 1]) if a else 0
            token, count = shingles(raw[base : int(ends[b - 1])], ends[a:b] - base)
            self.count[a:b] = count
            start = np.cumsum(count) - count
            for f in range(HASHES):
                t, lo, c, hi = compact_windows(token, count, f)
                own = known[t + a]
                t, lo, c, hi = t[own], lo[own], c[own], hi[own]
                parts.append([t + a, lo, c, hi, np.full(len(t), f), _mixed(token[start[t] + c] + np.uint64(f + 1))])
            a = b
        self.text, self.lo, self.c, self.hi, self.function, self.key = (np.concatenate(x) for x in zip(*parts, strict=True))

    def hashes(self, ranges: int):
        """(range, sorted distinct token hashes, whether two of the block's documents have each)."""
        return by_range(*distinct(self.key, self.ids[self.text])[:2], ranges)

    def meetings(self, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
        """(key, text, first, last, place) of wanted windows of two functions that hold a common subsequence of TOKENS: the two smallest tokens are the key, the overlap is the stretch, place is the first function's smallest token. Several of a key in one text are one from the first to the last of them."""
        text, lo, c, hi, f, key = (x[wanted] for x in (self.text, self.lo, self.c, self.hi, self.function, self.key))
        # windows of a token that comes again before a smaller one does: the first holds all, its smallest token stands anywhere from c to far
        order = np.lexsort((c, key, f, text))
        text, lo, c, hi, f, key = (x[order] for x in (text, lo, c, hi, f, key))
        own = np.ones(len(key), bool)
        own[1:] = (text[1:] != text[:-1]) | (f[1:] != f[:-1]) | (key[1:] != key[:-1]) | (c[1:] > hi[:-1])
        head = np.flatnonzero(own)
        far = np.maximum.reduceat(c, head) if len(head) else c
        text, lo, c, hi, f, key = (x[head] for x in (text, lo, c, hi, f, key))
        order = np.lexsort((lo, text))
        text, lo, c, far, hi, f, key = (x[order] for x in (text, lo, c, far, hi, f, key))
        n, d, idx, found = len(key), 1, np.arange(len(key)), [(np.zeros(0, np.int64),) * 2]
        while len(idx):
            idx = idx[idx + d < n]
            j = idx + d
            idx = idx[(text[j] == text[idx]) & (lo[j] <= far[idx]) & (hi[idx] - lo[j] + 1 >= TOKENS)]
            j = idx + d
            ok = (f[idx] != f[j]) & (hi[j] - lo[j] + 1 >= TOKENS) & (c[idx] <= hi[j]) & (c[j] <= hi[idx])
            found.append((idx[ok], j[ok]))
            d += 1
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        a, b = np.where(f[i] < f[j], i, j), np.where(f[i] < f[j], j, i)
        first, last, text, place = lo[j], np.minimum(hi[i], hi[j]), text[i], c[a]
        place = np.where((place < first) & (far[a] >= first), first, place)
        with np.errstate(over="ignore"):
            both = _mixed(key[a] * np.uint64(0x9E3779B97F4A7C15) ^ key[b])
        order = np.lexsort((first, both, text))
        text, both, first, last, place = (x[order] for x in (text, both, first, last, place))
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (both[1:] != both[:-1])
        at = np.flatnonzero(new)
        return both[at], text[at], first[at], np.maximum.reduceat(last, at) if len(at) else last, place[at]


def _copies_in(messages: pa.Table) -> np.ndarray:
    return np.array([r for kind, r in zip(messages["kind"].to_pylist(), messages["r"].to_pylist(), strict=True) if kind == COPY], np.int64)


def _send(ranges: int):
    def run(batches):
        for batch in batches:
            for bid, body in zip(batch.column("bid").to_pylist(), batch.column("body"), strict=True):
                for r, k, several in Windows(body.as_py()).hashes(ranges):
                    blob = _pack(np.diff(k, prepend=np.uint64(0)), np.packbits(several))
                    yield pa.RecordBatch.from_arrays([pa.array([r], pa.int64()), pa.array([bid], pa.int64()), pa.array([blob], pa.binary())], ["r", "bid", "blob"])
        trim()

    return run


_NODE = [("key", pa.int64()), ("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("place", pa.int32())]
_NODE_SQL = "key long, row long, first int, last int, place int"


def _meetings(ranges: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        flags, tables = _flags(right), [pa.schema(_NODE).empty_table()]
        for bid, body in zip(left["bid"].to_pylist(), left["body"].to_pylist(), strict=True):
            own = Windows(body)
            alone = np.ones(len(own.count), bool)
            alone[_copies_in(right)] = False
            every = [(k, flags[r]) for r, k, _ in own.hashes(ranges) if r in flags]
            keys = np.concatenate([k[f] for k, f in every]) if every else np.zeros(0, np.uint64)
            at = np.searchsorted(keys, own.key)
            at[at == len(keys)] = 0
            hit = keys[at] == own.key if len(keys) else np.zeros(len(own.key), bool)
            both, text, first, last, place = own.meetings(hit & alone[own.text])
            tables.append(pa.table([both.view(np.int64), (bid << IDX_BITS) + text, *(x.astype(np.int32) for x in (first, last, place))], schema=pa.schema(_NODE)))
            own = every = keys = at = hit = None
        trim()
        return pa.concat_tables(tables)

    return run


def _merged(x: list[np.ndarray]) -> list[np.ndarray]:
    """Of sorted (a, b, a_lo, a_hi, b_lo, b_hi): neighbours of a pair that overlap in both documents are one stretch."""
    while True:
        a, b, alo, ahi, blo, bhi = x
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (alo[1:] > ahi[:-1]) | (alo[:-1] > ahi[1:]) | (blo[1:] > bhi[:-1]) | (blo[:-1] > bhi[1:])
        if new.all():
            return x
        at = np.flatnonzero(new)
        x = [a[at], b[at], np.minimum.reduceat(alo, at), np.maximum.reduceat(ahi, at), np.minimum.reduceat(blo, at), np.maximum.reduceat(bhi, at)]


_STRETCHES = ("a_lo", "a_hi", "b_lo", "b_hi")
_STRETCHES_SQL = "a long, b long, a_lo array<int>, a_hi array<int>, b_lo array<int>, b_hi array<int>, keys array<long>"


def _stretches(batches):
    """Of rows (a, b, a_lo, a_hi, b_lo, b_hi, key) sorted by (a, b): one row for each pair with its stretches and its keys. Stretches that overlap in both documents are one, those at several places of the other document are told apart."""
    held = None

    def lists(new: np.ndarray, columns: list[np.ndarray], kinds: list[pa.DataType]) -> list[pa.ListArray]:
        ends = pa.array(np.append(np.flatnonzero(new), len(new)).astype(np.int32))
        return [pa.ListArray.from_arrays(ends, pa.array(c, k)) for c, k in zip(columns, kinds, strict=True)]

    def heads(x: list[np.ndarray]) -> np.ndarray:
        return np.append(True, (x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1]))

    def rows(cols: list[np.ndarray]) -> pa.RecordBatch:
        x = cols[:6]
        for order in ((4, 2), (2, 4), (4, 2)):
            x = _merged([c[np.lexsort((x[order[1]], x[order[0]], x[1], x[0]))] for c in x])
        new, told = heads(x), heads(cols)
        columns = [pa.array(x[0][new]), pa.array(x[1][new]), *lists(new, x[2:], [pa.int32()] * 4), *lists(told, cols[6:], [pa.int64()])]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", *_STRETCHES, "keys"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
        same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
        last = len(same) - int(same[::-1].argmin()) if not same.all() else 0
        held = [c[last:] for c in cols]
        if last:
            yield rows([c[:last] for c in cols])
    if held is not None:
        yield rows(held)


def _tokens_of(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """The shingles of the wanted documents of a block."""
    rows = []
    wanted = sorted(set(right["row"].to_pylist()))
    for bid, body in zip(left["bid"].to_pylist(), left["body"].to_pylist(), strict=True) if wanted else []:
        ids, _, sizes, raw = _unpack(body)
        ends = np.cumsum(sizes).tolist()
        for w in wanted:
            k = w - (bid << IDX_BITS)
            text = raw[ends[k] - int(sizes[k]) : ends[k]]
            rows.append((w, int(ids[k]), (shingles(text, np.array([len(text)]))[0] >> np.uint64(32)).astype("<u4").tobytes()))
    return _rows(rows, [("row", pa.int64()), ("doc", pa.int64()), ("tokens", pa.binary())])


def _run(x: np.ndarray, y: np.ndarray) -> int:
    """How many tokens at the start are equal."""
    n, step = min(len(x), len(y)), 64
    for k in range(0, n, step):
        differ = np.flatnonzero(x[k : min(n, k + step)] != y[k : min(n, k + step)])
        if len(differ):
            return k + int(differ[0])
    return n


def _places(i: np.ndarray, first: np.ndarray, times: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For tokens at places i of x (rising), each at order[first : first + times] in y: the place of each on the diagonal that most tokens near it share, the first of equals."""
    j = order[first].copy()
    if (times == 1).all():
        return j
    ends = np.cumsum(times)
    a = 0
    while a < len(i):  # some places at a time
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + (1 << 20), side="right")))
        n = times[a:b]
        heads = np.cumsum(n) - n
        place = order[np.repeat(first[a:b] - heads, n) + np.arange(int(n.sum()))]
        at = np.repeat(i[a:b], n)
        shift = place - at + int(i[-1])
        # tokens vote in two spans of NEAR places each, which overlap by half
        votes = np.zeros(len(place), np.int64)
        for half in (0, NEAR // 2):
            _, who, count = np.unique(shift << 24 | (at + half) // NEAR, return_inverse=True, return_counts=True)
            votes = np.maximum(votes, count[who])
        most = np.maximum.reduceat(votes, heads)
        good = np.flatnonzero(votes == np.repeat(most, n))
        row = np.repeat(np.arange(b - a), n)[good]
        j[a:b] = place[good[np.append(True, row[1:] != row[:-1])]]
        a = b
    return j


def _jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Similarity of the sets of tokens."""
    u, v = set(x.tolist()), set(y.tolist())
    both = len(u & v)
    return both / (len(u) + len(v) - both)


def similar_stretches(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """(first, last of x, first, last of y, similarity) of stretches of shared tokens that are long and similar enough, none inside another."""
    found: list[tuple[int, int, int, int, float]] = []
    if len(x) == len(y) and (x == y).all():
        return [(0, len(x) - 1, 0, len(y) - 1, 1.0)] if len(x) >= TOKENS else []
    order = np.argsort(y, kind="stable")
    values, first, times = np.unique(y[order], return_index=True, return_counts=True)
    at = np.searchsorted(values, x)
    at[at == len(values)] = 0
    own = values[at] == x if len(values) else np.zeros(len(x), bool)
    i = np.flatnonzero(own)
    # a similar stretch has DENSE shared tokens among TOKENS in a row, unless what it doesn't share repeats itself
    sums = np.append(0, np.cumsum(own))
    dense = sums[np.minimum(np.arange(len(x)) + TOKENS, len(x))] - sums[:-1] >= DENSE
    rest = x[~own]
    plain = len(np.unique(rest)) == len(rest)
    if plain and not dense.any():
        return []
    dense = np.append(0, np.cumsum(dense))
    j = _places(i, first[at[i]], times[at[i]], order) if len(i) else i
    # equal tokens on the diagonals that run through a stretch's ends belong to it, wherever the chain was split
    todo = [(0, len(i))]
    while todo:
        a, b = todo.pop()
        if b <= a:
            continue
        begin, end, low, high = int(i[a]), int(i[b - 1]), int(j[a:b].min()), int(j[a:b].max())
        if low == j[a]:
            k = _run(x[:begin][::-1], y[:low][::-1])
            begin, low = begin - k, low - k
        if high == j[b - 1]:
            k = _run(x[end + 1 :], y[high + 1 :])
            end, high = end + k, high + k
        if end - begin + 1 < TOKENS * SIMILARITY or plain and dense[end + 1] == dense[max(0, begin - TOKENS)]:
            continue
        sim = _jaccard(x[begin : end + 1], y[low : high + 1])
        if sim >= SIMILARITY:
            more = TOKENS - 1 - max(end - begin, high - low)
            if more <= 0:
                found.append((begin, end, low, high, sim))
                continue
            # too short by some tokens, which may be unshared ones on either side
            tried = []
            for before in range(more + 1):
                w = max(0, begin - before), min(len(x), end + 1 + more - before) - 1, max(0, low - before), min(len(y), high + 1 + more - before) - 1
                if max(w[1] - w[0], w[3] - w[2]) + 1 >= TOKENS:
                    tried.append((_jaccard(x[w[0] : w[1] + 1], y[w[2] : w[3] + 1]), w))
            if tried and max(tried)[0] >= SIMILARITY:
                sim, w = max(tried)
                found.append((*w, sim))
            continue
        if b - a < 2:
            continue
        # of the widest gaps the one nearest to an end
        jump = np.abs(np.diff(i[a:b])) - 1 + np.abs(np.diff(j[a:b]) - 1)
        widest = np.flatnonzero(jump == jump.max()) + 1
        k = a + int(widest[np.minimum(widest, b - a - widest).argmin()])
        todo += [(a, k), (k, b)]
    return _outer(set(found))


def _outer(found: set[tuple[int, int, int, int, float]]) -> list[tuple[int, int, int, int, float]]:
    """Of stretches those that aren't inside another."""
    kept: list[tuple[int, int, int, int, float]] = []
    for f in sorted(found, key=lambda f: (f[0] - f[1], f)):
        if not any(g[0] <= f[0] and f[1] <= g[1] and g[2] <= f[2] and f[3] <= g[3] for g in kept):
            kept.append(f)
    return sorted(kept)


_FOUND = [("a", pa.int64()), ("b", pa.int64()), ("doc_a", pa.int64()), ("doc_b", pa.int64()), *((n, pa.list_(pa.int32())) for n in ("a_first", "a_last", "b_first", "b_last")), ("similarity", pa.list_(pa.float64())), ("failed", pa.list_(pa.int64()))]
_FOUND_SQL = "a long, b long, doc_a long, doc_b long, a_first array<int>, a_last array<int>, b_first array<int>, b_last array<int>, similarity array<double>, failed array<long>"


def _verify(batches):
    for batch in batches:
        rows = []
        a, b, doc_a, doc_b, x_at, y_at = (c.to_pylist() for c in batch.columns[:6])
        for k, (x, y, *lists) in enumerate(zip(*batch.columns[6:], strict=True)):
            u, v, found = np.frombuffer(x.as_buffer(), "<u4"), np.frombuffer(y.as_buffer(), "<u4"), set()
            alo, ahi, blo, bhi, keys = (np.asarray(n.values) for n in lists)
            for i, j, p, q in zip((alo - x_at[k]).tolist(), (ahi - x_at[k]).tolist(), (blo - y_at[k]).tolist(), (bhi - y_at[k]).tolist(), strict=True):
                found |= {(i + s, i + t, p + e, p + f, sim) for s, t, e, f, sim in similar_stretches(u[i : j + 1], v[p : q + 1])} if doc_a[k] != doc_b[k] else set()
            outer = [(s + x_at[k], t + x_at[k], e + y_at[k], f + y_at[k], sim) for s, t, e, f, sim in _outer(found)]
            rows.append((a[k], b[k], doc_a[k], doc_b[k], *(zip(*outer, strict=True) if outer else [[]] * 5), [] if outer else keys.tolist()))
        if rows:
            yield _rows(rows, _FOUND).to_batches()[0]


def _verified(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pairs of documents with their similar stretches (none of one id) or, if there is none, their keys."""

    def part(side: str, as_name: str) -> list:
        low = F.array_min(f"{side}_lo")
        return [low.alias(f"{as_name}_at"), F.substring("tokens", 4 * low + 1, 4 * (F.array_max(f"{side}_hi") - low + 1)).alias(as_name)]

    rest = (*_STRETCHES, "keys")
    told = pairs.join(tokens.select(F.col("row").alias("a"), F.col("doc").alias("doc_a"), "tokens"), "a").select(*pairs.columns, "doc_a", *part("a", "x"))
    told = told.join(tokens.select(F.col("row").alias("b"), F.col("doc").alias("doc_b"), "tokens"), "b").select("a", "b", "doc_a", "doc_b", "x_at", *part("b", "y"), "x", *rest)
    return told.select("a", "b", "doc_a", "doc_b", "x_at", "y_at", "x", "y", *rest).mapInArrow(_verify, _FOUND_SQL)


def _by_pair(pairs: DataFrame) -> DataFrame:
    return pairs.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(_stretches, _STRETCHES_SQL)


def _star(nodes: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Pairs of each node with its key's node of the smallest row, which is b."""
    first = nodes.groupBy("key").agg(F.min(F.struct("row", "first", "last")).alias("f"), F.max("row").alias("high")).where("f.row < high")
    first = stored(first.select("key", F.col("f.row").alias("b"), F.col("f.first").alias("b_lo"), F.col("f.last").alias("b_hi")), "first", paths)
    forget(nodes.sparkSession, paths)
    return nodes.join(first, "key").where("row > b").select(F.col("row").alias("a"), "b", F.col("first").alias("a_lo"), F.col("last").alias("a_hi"), "b_lo", "b_hi", "key")


def _overlaps(batches):
    """Of rows (key, lo, hi, part, label, row, first, last, near) sorted by key, lo and hi: pairs of rows of a run of equal (key, lo, hi) that differ in their label and have of the tokens about their places DENSE in common (where near is given)."""
    held, names = None, ["a", "b", *_STRETCHES, "key"]

    def pairs(cols):
        _, lo, hi, part, label, row, first, last, near = cols
        n = len(row)
        i, j = np.triu_indices(n, 1)
        ok = label[i] != label[j]
        if lo[0] != hi[0]:
            ok &= part[i] != part[j]
        i, j = i[ok], j[ok]
        if len(i) and near[0] is not None:
            own = [np.unique(np.frombuffer(x, "<u4")) for x in near]
            who = np.repeat(np.arange(n), [len(x) for x in own])
            _, token, times = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
            # tokens of many nodes are counted as a product of matrices, the others pair by pair
            many = np.flatnonzero(times > 32)
            rank = np.full(len(times), -1)
            rank[many] = np.arange(len(many))
            common = np.zeros((n, n), np.float32)
            for k in range(0, len(many), 2048):
                at = rank[token] - k
                here = (at >= 0) & (at < 2048)
                has = np.zeros((n, min(2048, len(many) - k)), np.float32)
                has[who[here], at[here]] = 1
                common += has @ has.T
            some = (times[token] > 1) & (times[token] <= 32)
            order = np.flatnonzero(some)[np.argsort(token[some], kind="stable")]
            token, who = token[order], who[order]
            flat, idx, d = common.reshape(-1), np.arange(len(token)), 1
            while len(idx):
                idx = idx[idx + d < len(token)]
                idx = idx[token[idx + d] == token[idx]]
                flat += np.bincount(who[idx] * n + who[idx + d], minlength=n * n)
                d += 1
            ok = common[i, j] >= DENSE
            i, j = i[ok], j[ok]
        swap = row[i] < row[j]
        x, y = np.where(swap, j, i), np.where(swap, i, j)
        for k in range(0, len(i), 1 << 16):
            u, v = x[k : k + (1 << 16)], y[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (row[u], row[v], first[u], last[u], first[v], last[v], np.zeros(len(u), np.int64))], names)

    def runs(cols):
        new = np.ones(len(cols[0]), bool)
        new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
        at = np.append(np.flatnonzero(new), len(new))
        for p, q in zip(at, at[1:], strict=False):
            if q - p > 1:
                yield from pairs([c[p:q] for c in cols])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
        same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
        end = len(same) - int(same[::-1].argmin()) if not same.all() else 0
        held = [c[end:] for c in cols]
        yield from runs([c[:end] for c in cols])
    if held is not None:
        yield from runs(held)


def _met(nodes: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Pairs (a, b and their stretches) of nodes (key, row, first, last, label, near) of a key that differ in their label. sizes: (key, n). A key of many nodes is dealt into blocks; each pair of blocks is work of its own."""
    parted = nodes.join(sizes.select("key", F.ceil(F.col("n") / block).cast("int").alias("parts")), "key")
    parted = parted.withColumn("part", F.pmod(F.xxhash64("row", "first"), F.col("parts").cast("long")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = parted.select("key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "label", "row", "first", "last", "near")
    return dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(_overlaps, "a long, b long, a_lo int, a_hi int, b_lo int, b_hi int, key long")


def _rare_keys(nodes: DataFrame, paths: dict[str, str]) -> DataFrame:
    """The nodes of keys that very many share, under finer keys: two stretches alike have DENSE tokens about their places in common, so if the tokens of each node are put in the order of how many nodes of the key have them, they have one in common before the last DENSE - 1 of either. What only one node has can be left out, and a line that all share falls to the end."""
    told = nodes.withColumn("node", F.xxhash64("row", "first"))

    def spread(batches):
        for batch in batches:
            keys, ids, near = batch.columns
            own = [np.unique(np.frombuffer(x.as_buffer(), "<u4")) for x in near]
            sizes = [len(x) for x in own]
            at = np.repeat(np.arange(len(own)), sizes)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(at)), ids.take(pa.array(at)), pa.array(np.concatenate(own).astype(np.int64) if own else [], pa.int64())], ["key", "node", "token"])

    tokens = stored(told.select("key", "node", "near").mapInArrow(spread, "key long, node long, token long"), "rare_tokens", paths)
    shared = cut(tokens.groupBy("key", "token").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    ranked = tokens.join(shared, ["key", "token"]).groupBy("key", "node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t")).where(F.size("t") >= DENSE)
    rare = ranked.withColumn("t", F.explode(F.slice("t", F.lit(1), F.size("t") - DENSE + 1))).select("key", "node", "t.token")
    return rare.join(told.drop("near"), ["key", "node"]).select(F.xxhash64("key", "token").alias("key"), "row", "first", "last", "label", F.lit(None).cast("binary").alias("near"))


def _near(nodes: DataFrame, tokens: DataFrame) -> DataFrame:
    """The nodes with the tokens about their places (near)."""
    low = F.greatest(F.col("place") - REACH, F.lit(0))
    return nodes.join(tokens.select("row", "tokens"), "row").withColumn("near", F.substring("tokens", 4 * low + 1, 4 * (F.col("place") + REACH - low + 1))).drop("tokens")


def copies(packed: DataFrame) -> DataFrame:
    """row, doc, n (words) of every document that has the text of another (A-Z in lower case), with row and doc of that (first, first_doc)."""
    heads = packed.select("bid", F.explode("heads").alias("h")).select((F.shiftleft("bid", IDX_BITS) + F.col("h.idx")).alias("row"), "h.doc", "h.n", "h.digest")
    least = cut(heads.groupBy("digest").agg(F.min(F.struct("row", "doc")).alias("least"), F.count(F.lit(1)).alias("times")).where("times > 1"))
    return stored(heads.join(least, "digest").where("row <> least.row").select("row", "doc", "n", F.col("least.row").alias("first"), F.col("least.doc").alias("first_doc")), "copies")


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def near_duplicate_passages(docs: DataFrame, few: int = FEW, block: int = BLOCK) -> DataFrame:
    """doc_id, start_word, end_word (exclusive), the same of the other document, similarity, and class_id of every verified stretch. few: nodes of a key that meet without a look at their tokens first; block: nodes of a key in one task."""
    spark, paths = docs.sparkSession, {}
    packed = stored(blocks(docs, MIN_WORDS), "passages", paths)
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_BYTES))
    bodies = packed.select("bid", "body")
    same = copies(packed)
    marks = same.select(F.shiftright("row", IDX_BITS).alias("bid"), F.lit(COPY).alias("kind"), F.pmod("row", F.lit(1 << IDX_BITS)).alias("r"), F.lit(None).cast("binary").alias("blob"))
    sent = bodies.mapInArrow(_send(ranges), "r long, bid long, blob binary")
    told = cut(sent.groupBy("r").applyInArrow(_answer_hashes, _MESSAGE_SQL)).unionByName(marks)
    nodes = stored(bodies.groupBy("bid").cogroup(told.groupBy("bid")).applyInArrow(_meetings(ranges), _NODE_SQL), "nodes", paths)
    forget(spark, paths)
    # the nodes of a key meet its first
    pairs = stored(_by_pair(_star(nodes, paths)), "pairs", paths)
    forget(spark, paths, "first")
    wanted = pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).distinct()
    tokens = stored(bodies.groupBy("bid").cogroup(wanted.groupBy(F.shiftright("row", IDX_BITS))).applyInArrow(_tokens_of, "row long, doc long, tokens binary"), "tokens", paths)
    forget(spark, paths, "passages")
    found = stored(_verified(pairs, tokens), "found", paths)
    forget(spark, paths, "pairs")
    # nodes of the keys of those that failed, with the class of their document by the links found: where classes differ they all meet
    failed = cut(found.select(F.explode("failed").alias("key")).distinct())
    roots = cut(components(found.where(F.size("a_first") > 0).select("a", "b"))).select(F.col("node").alias("row"), F.col("root").alias("label"))
    held = stored(nodes.join(failed, "key").join(roots, "row", "left").withColumn("label", F.coalesce("label", "row")), "held", paths)
    forget(spark, paths, "nodes")
    left = held.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high")
    left = cut(left.select("key", "n"))
    apart = held.join(left, "key")
    met = _met(apart.where(F.col("n") <= few).drop("n").withColumn("near", F.lit(None).cast("binary")), left.where(F.col("n") <= few), block)
    near = stored(_near(apart.where(F.col("n") > few), tokens), "near", paths)
    met = met.unionByName(_met(near.where(F.col("n") <= BLOCKS * block).drop("n"), left.where(F.col("n").between(few + 1, BLOCKS * block)), block))
    rare = stored(_rare_keys(near.where(F.col("n") > BLOCKS * block).drop("n"), paths), "rare", paths)
    met = met.unionByName(_met(rare, rare.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), block))
    later = stored(_by_pair(met), "later", paths)
    forget(spark, paths, "held", "near", "rare", "rare_tokens")
    spots = F.explode(F.arrays_zip("a_first", "a_last", "b_first", "b_last", "similarity")).alias("s")
    found = _all([f.select("a", "b", "doc_a", "doc_b", spots) for f in (found, _verified(later, tokens))]).select("a", "b", "doc_a", "doc_b", "s.*")
    found = stored(found.dropDuplicates(["a", "b", "a_first", "a_last", "b_first", "b_last"]), "stretches")
    forget(spark, paths, *paths)
    # classes of documents
    links = found.select("doc_a", "doc_b").unionByName(same.select(F.col("doc").alias("doc_a"), F.col("first_doc").alias("doc_b"))).where("doc_a <> doc_b").distinct()
    roots = cut(components(links.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))))
    rows = found.select(
        F.col("doc_a").alias("doc_id"), F.col("a_first").cast("long").alias("start_word"), (F.col("a_last") + SHINGLE).cast("long").alias("end_word"),
        F.col("doc_b").alias("other_doc_id"), F.col("b_first").cast("long").alias("other_start_word"), (F.col("b_last") + SHINGLE).cast("long").alias("other_end_word"), "similarity",
    )
    n, zero = F.col("n").cast("long"), F.lit(0).cast("long")
    whole = same.where("doc <> first_doc").select(
        F.col("doc").alias("doc_id"), zero.alias("start_word"), n.alias("end_word"), F.col("first_doc").alias("other_doc_id"), zero.alias("other_start_word"), n.alias("other_end_word"), F.lit(1.0).alias("similarity")
    )
    return rows.unionByName(whole).join(roots.select(F.col("node").alias("doc_id"), F.col("root").alias("class_id")), "doc_id")


@query("op10_compact_windows")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
