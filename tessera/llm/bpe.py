"""BPE encoding and decoding with a pair occurrence index.

A batch's new words are laid out in one array of symbols. An index maps each pair to all its positions there; active ranks are taken in ascending order from a heap, a rank is applied at all its positions, and the lists of the pairs that appear beside a merge are extended. Words seen before come from a bounded cache of the Python worker, so the cost follows the number of distinct words, not of all words.

Defined cases: a null or empty text has no ids and decodes to the empty text; a text of white space alone likewise; repeated documents are rows of their own; a null doc_id stays null. Special tokens' strings in a text become their ids, as the tokenizers library has it.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import keyed_texts
from tessera.llm.registry import query

#: Words in the worker's cache at most; beyond, it starts anew.
CACHE_WORDS = 500_000

# The split pattern of the vocabulary file, for texts of ASCII and Latin-1 letters.
_PLAIN = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in set(shown))
    spare = {b: 256 + k for k, b in enumerate(hidden)}
    return [chr(spare.get(b, b)) for b in range(256)]


class WordBpe:
    """The tokenizer of a vocabulary file of the kind BPE with word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = [""] * (max(*vocab.values(), *self.special.values()) + 1)
        for t, i in (vocab | self.special).items():
            self.token[i] = t
        if len(self.token) > 1 << 16:
            raise ValueError("a pair's key has 16 bits for each symbol")
        self.pair_of = [vocab[a] << 16 | vocab[b] for a, b in model["merges"]]
        self.rule = {pair: (rank, vocab[a + b]) for rank, (pair, (a, b)) in enumerate(zip(self.pair_of, model["merges"], strict=True))}
        end = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.first = np.array([vocab[c] for c in letters])
        self.last = np.array([vocab[c + end] for c in letters])
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.cut_special = re.compile("(" + "|".join(re.escape(s) for s in self.special) + ")")
        self.marks = tuple(s[:2] for s in self.special)
        self.library = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}

    def merge_words(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word, by the pair occurrence index over all of them. A pair (a, b) is the key a << 16 | b."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes) - 1
        symbols = self.first[raw]
        symbols[ends] = self.last[raw[ends]]
        inner = np.ones(len(raw), bool)
        inner[ends] = False
        place = np.flatnonzero(inner)
        keys = symbols[place] << 16 | symbols[place + 1]
        order = np.argsort(keys, kind="stable")
        bounds = np.flatnonzero(np.diff(keys[order], prepend=-1, append=-1))
        sorted_places, heads = place[order].tolist(), keys[order][bounds[:-1]].tolist()
        rule, pair_of = self.rule, self.pair_of
        where = {k: sorted_places[i:j] for k, i, j in zip(heads, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True) if k in rule}
        sym = symbols.tolist()
        n = len(sym)
        after = np.arange(1, n + 1)
        after[ends] = -1
        before = np.arange(-1, n - 1)
        before[ends[:-1] + 1] = -1
        after, before, word_at = after.tolist(), before.tolist(), np.repeat(np.arange(len(words)), sizes).tolist()
        active = [rule[pair][0] for pair in where]
        heapq.heapify(active)
        get, push = rule.get, heapq.heappush
        while active:
            rank = heapq.heappop(active)
            pair = pair_of[rank]
            places = where.pop(pair, None)
            if places is None:
                continue
            left, right, merged = pair >> 16, pair & 0xFFFF, rule[pair][1]
            waiting: set[int] = set()  # words in which a lower rank has appeared; it goes first there
            rest = []
            places.sort()
            for p in places:
                q = after[p]
                if sym[p] != left or q < 0 or sym[q] != right:
                    continue
                if waiting and word_at[p] in waiting:
                    rest.append(p)
                    continue
                sym[p] = merged
                sym[q] = -1
                after[p] = r = after[q]
                if r >= 0:
                    before[r] = p
                    new = merged << 16 | sym[r]
                    hit = get(new)
                    if hit is not None:
                        if new in where:
                            where[new].append(p)
                        else:
                            where[new] = [p]
                            push(active, hit[0])
                        if hit[0] < rank:
                            waiting.add(word_at[p])
                o = before[p]
                if o >= 0:
                    new = sym[o] << 16 | merged
                    hit = get(new)
                    if hit is not None:
                        if new in where:
                            where[new].append(o)
                        else:
                            where[new] = [o]
                            push(active, hit[0])
                        if hit[0] < rank:
                            waiting.add(word_at[p])
            if rest:
                if pair in where:
                    where[pair].extend(rest)
                else:
                    where[pair] = rest
                    push(active, rank)
        flat = np.array(sym)
        left_over = flat >= 0
        counts = np.add.reduceat(left_over, ends - sizes + 1)
        return [x.astype("<u4") for x in np.split(flat[left_over], np.cumsum(counts)[:-1])]

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text with letters beyond Latin-1, by the library's own normalizer and splitter."""
        split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        byte_of = self.byte_of
        return [bytes(byte_of[c] for c in w).decode("utf-8", "surrogateescape") for w, _ in split]

    def encode_batch(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers. No piece holds white space, so the cache goes by what stands between it."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        get = self.cache.get
        parts: list[list[list[str] | bytes]] = []
        fresh: dict[str, list[str]] = {}
        for text in texts:
            own: list[list[str] | bytes] = []
            if text:
                for k, piece in enumerate(self.cut_special.split(text)) if "<|" in text else ((0, text),):
                    if k % 2:
                        own.append(self.special[piece].to_bytes(4, "little"))
                        continue
                    plain = piece.isascii() and piece.isprintable() or not _PLAIN.search(piece)
                    words = piece.lower().split() if plain else self.pieces(piece)
                    ids = list(map(get, words))
                    if None in ids:
                        own.append(words)
                        for w, x in zip(words, ids, strict=True):
                            if x is None and w not in fresh:
                                fresh[w] = _PIECES.findall(w) if plain else [w]
                    else:
                        own.append(b"".join(ids))
            parts.append(own)
        if fresh:
            new = list({p for own in fresh.values() for p in own if p not in self.cache})
            for word, ids in zip(new, self.merge_words([w.encode("utf-8", "surrogateescape") for w in new]), strict=True):
                self.cache[word] = ids.tobytes()
            have = self.cache.__getitem__
            for w, own in fresh.items():
                self.cache[w] = b"".join(map(have, own))
        have = self.cache.__getitem__
        return [b"".join(x if isinstance(x, bytes) else b"".join(map(have, x)) for x in own) for own in parts]

    def decode(self, ids: bytes) -> str:
        """The text of the ids, special tokens included: this vocabulary file has no decoder, so its tokens are joined by spaces."""
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """The tokenizer of a worker, read once."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def _slices(column: pa.Array, most_bytes: int = 4 << 20) -> Iterator[pa.Array]:
    """Runs of rows of about so many bytes at most, one row at least."""
    start, held = 0, 0
    for k, n in enumerate(pc.binary_length(column).to_pylist()):
        if held and held + (n or 0) > most_bytes:
            yield column.slice(start, k - start)
            start, held = k, 0
        held += n or 0
    if start < len(column):
        yield column.slice(start)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) of every text."""

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(1)):
                out = bpe.encode_batch(texts.to_pylist())
                ends = np.cumsum([0, *(len(x) // 4 for x in out)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(out), "<u4").astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], ["doc_id", "ids"])
                at += len(texts)

    return keyed_texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows with doc_id and ids (array of int); null ids give the empty text."""

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            texts = [bpe.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document: each text is encoded, and its ids are decoded again."""

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(1)):
                ids = bpe.encode_batch(texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                        pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                at += len(texts)

    return keyed_texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
