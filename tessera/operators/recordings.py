"""Operators over recordings: measures, character alignment, models, files. Python runs in Arrow batches, once a partition is set up."""

from __future__ import annotations

import difflib
import os
import shutil
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import audio


def read_audio(spark: SparkSession, path: str) -> DataFrame:
    """path and content of the files under a path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def measured(df: DataFrame, key: str, content: str, top_db: float = 35.0) -> DataFrame:
    """key, the measures and metrics_error of WAV files: a broken file is an error in its row, not a failed query."""

    def run(batches):
        for batch in batches:
            rows = []
            for raw in batch.column(1):
                try:
                    samples, rate = audio.decode_wav(raw.as_buffer().to_pybytes())
                    rows.append((*audio.measure(samples, rate, top_db).values(), None))
                except Exception as e:  # noqa: BLE001  what a file is like decides
                    rows.append((*[None] * len(audio.METRICS), f"{type(e).__name__}: {e}"))
            columns = list(zip(*rows, strict=True)) or [[]] * (len(audio.METRICS) + 1)
            kinds = [pa.float64()] * len(audio.METRICS) + [pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [key, *audio.METRICS, "metrics_error"])

    schema = T.StructType([df.schema[key], *(T.StructField(m, T.DoubleType()) for m in audio.METRICS), T.StructField("metrics_error", T.StringType())])
    return df.select(key, content).mapInArrow(run, schema)


def measured_samples(df: DataFrame, key: str, samples: str, rate: int, top_db: float = 35.0) -> DataFrame:
    """key and the measures of recordings that are arrays of samples."""

    def run(batches):
        for batch in batches:
            rows = [tuple(audio.measure(np.asarray(x.values, np.float64), rate, top_db).values()) for x in batch.column(1)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(audio.METRICS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.float64()) for c in columns)], [key, *audio.METRICS])

    schema = T.StructType([df.schema[key], *(T.StructField(m, T.DoubleType()) for m in audio.METRICS)])
    return df.where(F.size(samples) > 0).select(key, samples).mapInArrow(run, schema)


def match_characters(expected: list[str], observed: list[dict], duration: float) -> list[dict]:
    """Times of expected characters from what an aligner saw, by matching blocks in order; times are held to the recording, and what is empty then has none."""
    out = [{"index": k, "character": c, "start": None, "end": None, "score": None} for k, c in enumerate(expected)]
    blocks = difflib.SequenceMatcher(None, [c.lower() for c in expected], [str(o["character"]).lower() for o in observed], False).get_matching_blocks()
    for block in blocks:
        for row, seen in zip(out[block.a : block.a + block.size], observed[block.b : block.b + block.size], strict=True):
            row["score"] = seen.get("score")
            if seen.get("start") is not None and seen.get("end") is not None:
                s, e = (min(max(float(seen[n]), 0.0), duration) for n in ("start", "end"))
                if e > s:
                    row["start"], row["end"] = s, e
    return out


def _codes(values: pa.Array, known: dict[str, int], missing: int | None) -> np.ndarray:
    """Numbers of lower-cased characters, the same for the same ones; null is missing, or the word none."""
    coded = values.dictionary_encode("encode")
    numbers = [missing if v is None and missing is not None else known.setdefault(str(v).lower(), len(known)) for v in coded.dictionary.to_pylist()]
    return np.array(numbers, np.int64)[coded.indices.to_numpy()]


def _aligned(expected: pa.Array, observed: pa.Array, duration: pa.Array) -> tuple[pa.Array, pa.Array]:
    """match_characters of many rows in columns: a character takes no object of its own, and rows that are seen as expected aren't matched in Python."""
    a_at, b_at = (np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False))]).astype(np.int64) for c in (expected, observed))
    characters, seen = expected.flatten().cast(pa.string()), observed.flatten()
    fields = dict(zip([seen.type.field(k).name for k in range(seen.type.num_fields)], seen.flatten(), strict=True))
    known: dict[str, int] = {}
    a, b = _codes(characters, known, -1), _codes(fields["character"], known, None)
    b[seen.is_null().to_numpy(zero_copy_only=False)] = -2
    at = np.full(len(a), -1, np.int64)
    for a0, a1, b0, b1 in zip(*(x.tolist() for x in (a_at[:-1], a_at[1:], b_at[:-1], b_at[1:])), strict=True):
        x, y = a[a0:a1], b[b0:b1]
        if len(x) == len(y) and (x == y).all():
            at[a0:a1] = np.arange(b0, b1)
        elif len(x) and len(y):
            for block in difflib.SequenceMatcher(None, x.tolist(), y.tolist(), False).get_matching_blocks():
                at[a0 + block.a : a0 + block.a + block.size] = np.arange(b0 + block.b, b0 + block.b + block.size)
    taken = pa.array(at, mask=at < 0)
    none = pa.nulls(len(seen), pa.float64())
    score, start, end = (fields.get(n, none).cast(pa.float64()).take(taken) for n in ("score", "start", "end"))
    most = np.repeat(duration.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False), np.diff(a_at))
    s, e = (np.where(x < 0, 0.0, x) for x in (start.to_numpy(zero_copy_only=False), end.to_numpy(zero_copy_only=False)))
    s, e = np.where(most < s, most, s), np.where(most < e, most, e)
    ok = e > s  # null is nan here, which no comparison holds for
    index = np.arange(len(a)) - np.repeat(a_at[:-1], np.diff(a_at))
    rows = pa.StructArray.from_arrays([pa.array(index), characters, pa.array(s, mask=~ok), pa.array(e, mask=~ok), score], ["index", "character", "start", "end", "score"])
    timed = np.concatenate([[0], np.cumsum(ok)])
    return pa.ListArray.from_arrays(pa.array(a_at, pa.int32()), rows), pa.array(timed[a_at[1:]] - timed[a_at[:-1]], pa.int64())


#: Expected and observed characters that are aligned at once, but for a row that has more; a batch can hold millions.
_PIECE = 1 << 16


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in turn, _PIECE characters at a time."""
    size = sum(pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[1:3])
    turn = (np.cumsum(size) - size) // _PIECE
    cuts = [*np.flatnonzero(np.diff(turn, prepend=-1)).tolist(), batch.num_rows]
    for low, high in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(low, high - low)


_CHARACTER = "index: bigint, character: string, start: double, end: double, score: double"


def align_characters(df: DataFrame, key: str, expected: str, observed: str, duration: str) -> DataFrame:
    """key, characters and timed of rows with expected characters (array of strings), observed ones (array of struct<character, start, end, score>) and a duration."""

    def run(batches):
        for batch in batches:
            for piece in _pieces(batch):
                yield pa.RecordBatch.from_arrays([piece.column(0), *_aligned(*piece.columns[1:])], [key, "characters", "timed"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, expected, observed, duration).mapInArrow(run, f"`{key}` {kind}, characters array<struct<{_CHARACTER}>>, timed long")


def with_model(df: DataFrame, key: str, content: str, load: Callable[[], Callable[[bytes], dict]], schema: str) -> DataFrame:
    """key, the model's columns (schema) and model_error. load runs once in each partition and gives a function of a recording's bytes; a failed load or call is an error in the rows."""
    fields = T.StructType.fromDDL(schema).fields
    names = [f.name for f in fields]

    def run(batches):
        try:
            model, broken = load(), None
        except Exception as e:  # noqa: BLE001
            model, broken = None, f"{type(e).__name__}: {e}"
        for batch in batches:
            rows = []
            for raw in batch.column(1):
                try:
                    if broken:
                        raise RuntimeError(broken)
                    out = model(raw.as_buffer().to_pybytes())
                    rows.append({n: out.get(n) for n in names} | {"model_error": None})
                except Exception as e:  # noqa: BLE001
                    rows.append({n: None for n in names} | {"model_error": f"{type(e).__name__}: {e}"})
            table = pd.DataFrame(rows, columns=[*names, "model_error"])
            table.insert(0, key, batch.column(0).to_pandas())
            yield pa.RecordBatch.from_pandas(table, preserve_index=False)

    full = T.StructType([df.schema[key], *fields, T.StructField("model_error", T.StringType())])
    return df.select(key, content).mapInArrow(run, full)


def materialize(source: str, target: str, mode: str = "copy") -> str:
    """Brings a file to a place and says how; nothing is overwritten, and a hard link that can't be made is a copy."""
    if os.path.lexists(target):
        raise FileExistsError(f"refusing to overwrite {target}")
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    if mode == "symlink":
        os.symlink(source, target)
        return "symlink"
    if mode == "hardlink":
        try:
            os.link(source, target)
            return "hardlink"
        except OSError:
            shutil.copy2(source, target)
            return "copy_fallback"
    shutil.copy2(source, target)
    return "copy"


def materialized(df: DataFrame, source: str, target: str, mode: str = "copy") -> DataFrame:
    """The rows with materialization and materialization_error; files lie where all executors reach them."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = []
            for s, t in zip(batch.column(names.index(source)).to_pylist(), batch.column(names.index(target)).to_pylist(), strict=True):
                try:
                    rows.append((materialize(s, t, mode), None))
                except OSError as e:
                    rows.append((None, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], [*names, "materialization", "materialization_error"])

    told = [T.StructField(n, T.StringType()) for n in ("materialization", "materialization_error")]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *told]))


def rendered(df: DataFrame, key: str, content: str, **how) -> DataFrame:
    """key, wav, gain_db, ceiling_cut_db, peak_dbfs, lufs_before, lufs_after and error of recordings with a playback gain."""
    names = ["gain_db", "ceiling_cut_db", "peak_dbfs", "lufs_before", "lufs_after"]

    def run(batches):
        for batch in batches:
            rows = []
            for raw in batch.column(1):
                try:
                    samples, rate = audio.decode_wav(raw.as_buffer().to_pybytes())
                    wav, told = audio.render(samples, rate, **how)
                    rows.append((wav, *(told[n] for n in names), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((None, *[None] * len(names), f"{type(e).__name__}: {e}"))
            columns = list(zip(*rows, strict=True)) or [[]] * (len(names) + 2)
            kinds = [pa.binary(), *[pa.float64()] * len(names), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [key, "wav", *names, "error"])

    schema = T.StructType([df.schema[key], T.StructField("wav", T.BinaryType()), *(T.StructField(n, T.DoubleType()) for n in names), T.StructField("error", T.StringType())])
    return df.select(key, content).mapInArrow(run, schema)
