"""Interval and sequence functions over array columns; intervals are struct<s: double, e: double>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTERVALS = "array<struct<s: double, e: double>>"


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def merge(intervals: Column) -> Column:
    """Sorted and disjoint: what overlaps or touches is one, what is empty is gone."""

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
        return F.when(F.size(done) == 0, F.array(x)).when(x["s"] <= last["e"], joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(F.filter(intervals, lambda x: x["e"] > x["s"])), F.array().cast(_INTERVALS), step)


def duration(intervals: Column) -> Column:
    return total(F.transform(intervals, lambda x: x["e"] - x["s"]))


def overlap(intervals: Column, start: Column, end: Column) -> Column:
    """How much of start..end disjoint intervals cover."""
    return total(F.transform(intervals, lambda x: F.greatest(F.lit(0.0), F.least(x["e"], end) - F.greatest(x["s"], start))))


def clip(intervals: Column, start: Column, end: Column) -> Column:
    cut = F.transform(intervals, lambda x: F.struct(F.greatest(x["s"], start).alias("s"), F.least(x["e"], end).alias("e")))
    return F.filter(cut, lambda x: x["e"] > x["s"])


def bounds(characters: Column) -> tuple[Column, Column]:
    """The first start and the last end of valid characters (struct<start, end>)."""
    valid = F.filter(characters, lambda c: c["start"].isNotNull() & c["end"].isNotNull())
    return F.array_min(F.transform(valid, lambda c: c["start"])), F.array_max(F.transform(valid, lambda c: c["end"]))


def quantile(values: Column, level: float) -> Column:
    """The exact quantile of an array, linear between ranks; null of an empty one."""
    ranked = F.array_sort(values)
    at = (F.size(values) - 1) * F.lit(float(level))
    low, high = F.get(ranked, F.floor(at).cast("int")), F.get(ranked, F.ceil(at).cast("int"))
    return F.when(F.size(values) > 0, low + (high - low) * (at - F.floor(at)))


def held(characters: Column, lower: Column, upper: Column) -> Column:
    """The characters (struct<index, start, end>) held to lower..upper; times that leave nothing are null."""

    def one(c: Column) -> Column:
        s, e = F.greatest(c["start"], lower), F.least(c["end"], upper)
        ok = c["start"].isNotNull() & c["end"].isNotNull() & (e > s)
        return F.struct(c["index"].alias("index"), F.when(ok, s).alias("start"), F.when(ok, e).alias("end"))

    return F.transform(characters, one)


def pauses(characters: Column, active: Column, gap_min: float, active_max: float) -> Column:
    """array<struct<after, before, s, e, active, ratio>> of the pauses between adjacent characters (struct<index, start, end>): gaps from gap_min seconds of which sound fills a share of active_max at most. A character without times breaks adjacency, one that starts before its predecessor begins anew, and the end is carried over characters that overlap."""
    empty = F.array().cast("array<struct<after: bigint, before: bigint, s: double, e: double, active: double, ratio: double>>")
    null = F.lit(None).cast("double")
    first = F.struct(F.lit(None).cast("bigint").alias("index"), null.alias("start"), null.alias("end"), empty.alias("out"))

    def step(state: Column, c: Column) -> Column:
        valid, known = c["start"].isNotNull() & c["end"].isNotNull(), state["start"].isNotNull()
        ordered = known & (c["start"] >= state["start"])
        gap = c["start"] - state["end"]
        sound = overlap(active, state["end"], c["start"])
        ratio = F.least(F.lit(1.0), F.try_divide(sound, gap))
        pause = F.struct(state["index"].alias("after"), c["index"].cast("bigint").alias("before"), state["end"].alias("s"), c["start"].alias("e"), sound.alias("active"), ratio.alias("ratio"))
        new = valid & ordered & (gap >= gap_min) & (ratio <= active_max)
        within = ordered & (c["start"] <= state["end"])
        return F.struct(
            F.when(valid, c["index"].cast("bigint")).alias("index"),
            F.when(valid, F.when(within, state["start"]).otherwise(c["start"])).alias("start"),
            F.when(valid, F.when(within, F.greatest(state["end"], c["end"])).otherwise(c["end"])).alias("end"),
            F.when(F.coalesce(new, F.lit(False)), F.concat(state["out"], F.array(pause))).otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(characters, first, step)["out"]


def pause_rate(found: Column, lower: Column, upper: Column, units: Column) -> Column:
    """struct of the pauses' number, length and share, and of what is left and its rate; all null without a span."""
    span = F.when(upper > lower, upper - lower)
    silent = F.least(span, duration(merge(F.transform(found, lambda p: F.struct(p["s"].alias("s"), p["e"].alias("e"))))))
    kept = F.greatest(F.lit(0.0), span - silent)
    return F.struct(
        F.when(span.isNotNull(), F.size(found).cast("long")).alias("pause_count"),
        F.when(span.isNotNull(), silent).alias("pause_sec"),
        F.try_divide(silent, span).alias("pause_ratio"),
        F.when(span.isNotNull(), kept).alias("kept_sec"),
        F.try_divide(units.cast("double"), F.when(kept > 0, kept)).alias("cps"),
    )


def residual_activity(characters: Column, active: Column, lower: Column, upper: Column, pad: float = 0.05) -> Column:
    """struct of lexical_sec, residual_sec and ratio: active sound of lower..upper inside and outside the padded characters; null without such sound."""
    valid = F.filter(characters, lambda c: c["start"].isNotNull() & c["end"].isNotNull() & (c["end"] > c["start"]))
    windows = merge(F.transform(valid, lambda c: F.struct(F.greatest(lower, c["start"] - pad).alias("s"), F.least(upper, c["end"] + pad).alias("e"))))
    sound = merge(clip(active, lower, upper))
    whole = duration(sound)
    whole = F.when(whole > 0, whole)
    lexical = F.least(whole, total(F.transform(sound, lambda a: overlap(windows, a["s"], a["e"]))))
    rest = F.greatest(F.lit(0.0), whole - lexical)
    return F.struct(F.when(whole.isNotNull(), lexical).alias("lexical_sec"), F.when(whole.isNotNull(), rest).alias("residual_sec"), F.try_divide(rest, whole).alias("ratio"))


def gaps(characters: Column) -> Column:
    """Times between each character's end and the next one's start."""
    n = F.greatest(F.size(characters) - 1, F.lit(0))
    return F.zip_with(F.slice(characters, F.lit(1), n), F.slice(characters, F.lit(2), n), lambda a, b: b["start"] - a["end"])


def timestamp_quality(characters: Column, score_cutoff: float = 0.50, short_sec: float = 0.035, gap_min: float = 0.15) -> Column:
    """struct of the health of timestamps (struct<start, end, score, pair>): scores, short characters, long gaps."""
    scored = F.filter(F.transform(characters, lambda c: c["score"]), lambda s: s.isNotNull())
    n = F.size(characters)
    low = F.size(F.filter(scored, lambda s: s < score_cutoff))
    short = F.size(F.filter(characters, lambda c: ~c["pair"] & (c["end"] - c["start"] < short_sec)))
    long_gaps = F.filter(gaps(characters), lambda g: g >= gap_min)
    gone = total(long_gaps)
    span = F.when(n >= 2, F.element_at(characters, -1)["end"] - F.element_at(characters, 1)["start"])
    return F.struct(
        ((F.size(scored) == n) & (n > 0)).alias("scores_available"),
        quantile(scored, 0.5).alias("score_p50"),
        F.try_divide(low.cast("double"), F.size(scored).cast("double")).alias("low_score_ratio"),
        short.cast("long").alias("short_count"),
        F.try_divide(short.cast("double"), n.cast("double")).alias("short_ratio"),
        F.size(long_gaps).cast("long").alias("long_gap_count"),
        gone.alias("long_gap_sec"),
        F.try_divide(gone, F.when(span > 0, span)).alias("long_gap_ratio"),
    )
