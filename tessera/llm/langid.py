"""Language identification by averaged hashed subword embeddings with a linear softmax.

A text's features are the byte n-grams (2 to 4) of its lower-cased words, word ends included, hashed into buckets. The mean of their embeddings goes through a linear layer and a softmax. Both layers are trained on the driver by stochastic gradient descent in numpy, on a bounded sample of labelled documents whose sparse counts the executors make. A temperature fitted on a part of the sample that training leaves out calibrates the score, and a score below that part's lowest hundredth marks a prediction as rejected. For prediction the two layers are folded into one table of a row per bucket, so a text costs one look-up per feature.

Defined cases: a text that is null or has no letter is `und` with score 0; so is every text where nothing can be learned; a null lang or doc_id teaches nothing, and a null doc_id isn't held out; repeated rows are rows of their own; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import keyed_texts
from tessera.llm.registry import query

#: The bound of the sample: documents in all, documents of one language, languages (those with most documents).
SAMPLE_DOCS, SAMPLE_PER_LANG, MAX_LANGS = 4000, 250, 200
BUCKETS = 1 << 14
DIM, EPOCHS, BATCH, RATE, SEED = 16, 12, 32, 0.5, 7

_LETTER = re.compile("[A-Za-z]")
_TO_GAP = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    return bool(_LETTER.search(text)) or any(c.isalpha() for c in text)


def subwords(text: str) -> np.ndarray:
    """The buckets of all n-grams of a text's words."""
    raw = b" " + text.lower().encode("utf-8", "replace").translate(_TO_GAP) + b" "
    x = np.frombuffer(raw, np.uint8).astype(np.uint32)
    word = x != 32
    out, code = [], x
    for n in (2, 3, 4):
        code = (code[:-1] << np.uint32(8)) | x[n - 1 :]
        if n == 2:
            whole = word[:-1] | word[1:]
        else:
            inner = word[1 : len(x) - n + 2] if n == 3 else word[1 : len(x) - 2] & word[2 : len(x) - 1]
            whole = inner[: len(code)]
        mixed = (code[whole] + np.uint32(n)) * np.uint32(2654435761)
        out.append((mixed ^ (mixed >> np.uint32(15))) * np.uint32(2246822519) >> np.uint32(18))
    return np.concatenate(out)


class Model:
    """Languages, the folded table of logits by bucket, bias, temperature and the score below which a prediction is rejected."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, temperature: float = 1.0, floor: float = 0.0):
        self.langs, self.table, self.bias, self.temperature, self.floor = langs, table, bias, temperature, floor

    def logits(self, features: np.ndarray) -> np.ndarray:
        if len(features) > BUCKETS // 8:
            total = np.bincount(features, minlength=BUCKETS) @ self.table
        else:
            total = self.table[features].sum(axis=0)
        return total / max(1, len(features)) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or text is None or not has_letter(text):
            return "und", 0.0
        z = self.logits(subwords(text)) / self.temperature
        e = np.exp(z - z.max())
        k = int(e.argmax())
        return self.langs[k], float(e[k] / e.sum())


def train(langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """A model of sparse counts (buckets, numbers) and the labels' places in langs. Every fifth document calibrates."""
    n, m = len(counts), len(langs)
    if not n or not m:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    rng = np.random.default_rng(SEED)
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, m), np.float32), np.zeros(m, np.float32)
    aside = np.arange(n) % 5 == 4 if n >= 50 else np.zeros(n, bool)
    scale = np.float32(32)  # of the averages, which a text of many features makes small

    def dense(rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), BUCKETS), np.float32)
        for k, r in enumerate(rows):
            idx, c = counts[r]
            x[k, idx] = c / max(1, c.sum())
        return x * scale

    learn = np.flatnonzero(~aside)
    for epoch in range(EPOCHS):
        rate = np.float32(RATE * (1 - epoch / EPOCHS))
        order = rng.permutation(learn)
        for k in range(0, len(order), BATCH):
            rows = order[k : k + BATCH]
            x = dense(rows)
            h = x @ embed
            z = h @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            p /= len(rows)
            back = p @ out.T
            out -= rate * (h.T @ p)
            bias -= rate * p.sum(axis=0)
            hit = np.flatnonzero(x.any(axis=0))
            embed[hit] -= rate * (x[:, hit].T @ back)
    model = Model(langs, (embed.astype(np.float64) @ out.astype(np.float64)) * float(scale), bias.astype(np.float64))
    if aside.any():
        rows = np.flatnonzero(aside)
        z = np.concatenate([dense(rows[k : k + BATCH]) @ embed for k in range(0, len(rows), BATCH)]) @ out + bias
        y = labels[rows]

        def softmax(t: float) -> np.ndarray:
            e = np.exp((z - z.max(axis=1, keepdims=True)) / t)
            return e / e.sum(axis=1, keepdims=True)

        steps = np.geomspace(0.25, 8, 41)
        loss = [-np.log(np.maximum(softmax(t)[np.arange(len(y)), y], 1e-12)).mean() for t in steps]
        model.temperature = float(steps[int(np.argmin(loss))])
        p = softmax(model.temperature)
        right = p.argmax(axis=1) == y
        if right.any():
            model.floor = float(np.quantile(p.max(axis=1)[right], 0.01))
    return model


def fold_of(column: str) -> Column:
    """crc32 of the id as text, mod 5; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5


def fit(docs: DataFrame, learnable: Column) -> Model:
    """A model of the bounded sample of the documents where learnable holds. The sample takes documents by a hash of their id, an equal number of each language; only their sparse counts go to the driver."""
    from pyspark.sql.types import LongType, StringType

    known = docs.select(F.col("doc_id").cast(LongType()).alias("doc_id"), F.col("lang").cast(StringType()).alias("lang"), F.col("text").cast("string").alias("text")).where(learnable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()
    if not sizes:
        return train([], [], np.zeros(0, int))
    most = max(1, min(SAMPLE_PER_LANG, SAMPLE_DOCS // len(sizes)))
    space = 1 << 30
    place = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(space))
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(space if r["count"] <= most else int(space * most / r["count"])))])
    picked = known.where(place < share[F.col("lang")])

    def count(batches):
        for batch in batches:
            ids, names, idx, num = [], [], [], []
            for d, g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if has_letter(t):
                    u, c = np.unique(subwords(t), return_counts=True)
                    ids.append(d), names.append(g), idx.append(u.astype(np.int32)), num.append(c.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(idx, pa.list_(pa.int32())), pa.array(num, pa.list_(pa.int32()))], ["doc_id", "lang", "idx", "num"])

    rows = picked.mapInArrow(count, "doc_id long, lang string, idx array<int>, num array<int>").toArrow()
    order = np.lexsort((np.arange(len(rows)), rows["doc_id"].to_numpy()))
    names = rows["lang"].to_pylist()
    langs = sorted(set(names))
    at = {g: k for k, g in enumerate(langs)}
    idx, num = rows["idx"].combine_chunks(), rows["num"].combine_chunks()
    counts = [(np.asarray(idx[int(r)].values), np.asarray(num[int(r)].values)) for r in order]
    return train(langs, counts, np.array([at[names[r]] for r in order], int))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every document, by its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows of MAX_LANGS numbers at most: 26 MB

    def run(batches):
        own = shared.value
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch.column(1)]
            names, scores = [f[0] for f in found], [f[1] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array([s < own.floor for s in scores], pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return keyed_texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, fold_of("doc_id") != 0)
    return identify(docs, model).select("doc_id", F.coalesce(fold_of("doc_id") == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
