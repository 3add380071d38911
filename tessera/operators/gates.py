"""Reason-coded gates: predicates in a fixed order, of which the first that holds names why a row is rejected."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import alias, intervals, text
from tessera.functions.identity import field, first_present, present

# Statuses that count as success, events that speech may hold, marks of generated data, style folders.
SUCCESS = ("ok", "success", "aligned", "complete", "completed")
SPOKEN_EVENTS = ("breath", "hold")
GENERATED_FIELDS = ("speed_tempo_factor", "speed_original_audio", "volume_output_lufs", "actual_gain_db")
GENERATED_NAMES = ("speed_source", "volume_source", "volume_label_source", "augmentation", "generated_by", "control_source")
GENERATED_TOKENS = ("atempo", "ffmpeg", "gain", "augment", "synthetic", "loud_pair")
WHISPER_FOLDERS, RECITED_FOLDERS = ("whisper", "悄悄话"), ("recitation", "panting", "朗诵", "气喘")


def first_reason(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that holds; null if none does. A rule that is null doesn't hold."""
    out = F.lit(None).cast("string")
    for name, test in reversed(rules):
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def rejections(df: DataFrame, reason: str = "reason") -> DataFrame:
    """reason, n of the rows that have one."""
    return df.where(F.col(reason).isNotNull()).groupBy(F.col(reason).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def status_ok(c: Column) -> Column:
    """Missing, or a success; an empty status is no success."""
    return c.isNull() | F.lower(text.strip(c)).isin(*SUCCESS)


def contains_any(c: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def is_generated(df: DataFrame) -> Column:
    """A field that only processing sets, or a name that tells of it."""
    out = F.lit(False)
    for f in GENERATED_FIELDS:
        out = out | field(df, f).isNotNull()
    for f in GENERATED_NAMES:
        out = out | contains_any(F.lower(text.text(field(df, f))), GENERATED_TOKENS)
    return out


def is_whisper(df: DataFrame) -> Column:
    values = F.lower(F.concat_ws(" ", *(text.text(field(df, f)) for f in ("audio", "audio_path", "audio_path_raw", "style", "voice_style"))))
    return F.array_contains(text.event_tags(field(df, "text")), "whisper") | contains_any(values, WHISPER_FOLDERS)


def is_speed_excluded(df: DataFrame) -> Column:
    """A style folder in the path, or an event beyond those that speech may hold."""
    path = first_present(field(df, "audio"), field(df, "wav_path"), field(df, "audio_path"))
    other = F.array_except(text.event_tags(field(df, "text")), F.array(*map(F.lit, SPOKEN_EVENTS)))
    path = F.coalesce(path, F.lit(""))
    return F.lower(path).contains("whisper") | contains_any(path, ("悄悄话", "朗诵", "气喘")) | (F.size(other) > 0)


def style_reason(df: DataFrame, ratio: Column, most: float = 0.15, allow_paralinguistic: bool = False) -> Column:
    """Why a row's style keeps it out; ratio: its share of sound beside speech."""
    path = F.lower(F.concat_ws(" ", *(text.text(field(df, f)) for f in ("audio", "audio_path", "audio_path_raw"))))
    rules = [("whisper_style", is_whisper(df)), ("speed_style_excluded", contains_any(path, RECITED_FOLDERS))]
    if not allow_paralinguistic:
        rules += [
            ("speed_style_excluded", is_speed_excluded(df)),
            ("missing_paralinguistic_ratio", ratio.isNull()),
            ("invalid_paralinguistic_ratio", ~ratio.between(0.0, 1.0)),
            ("long_paralinguistic_ratio", ratio > most),
        ]
    return first_reason(*rules)


@dataclass(frozen=True)
class AlignmentGate:
    """Bounds of the alignment gate."""

    max_cer: float = 0.12
    min_coverage: float = 0.90
    min_units: int = 4
    min_span: float = 0.6
    max_span: float = 30.0
    min_active_ratio: float = 0.35
    max_pause_ratio: float = 0.65
    rate: str = "pause_excluded_cps"
    legacy_fallback: bool = False
    score_cutoff: float = 0.50
    short_sec: float = 0.035
    gap_min: float = 0.15

    def __post_init__(self):
        if self.rate not in ("pause_excluded_cps", "speech_span_cps", "full_audio_vad_cps"):
            raise ValueError(f"unknown rate {self.rate}")
        if not 0 < self.min_span <= self.max_span:
            raise ValueError("spans must be positive and in order")


def with_alignment(df: DataFrame, gate: AlignmentGate = AlignmentGate(), record: str = "record") -> DataFrame:
    """The rows with the metrics of their record (VARIANT) and alignment_reason, null where the alignment is good enough."""
    v = F.col(record)
    names = ("asr_cer", "coverage", "speech_start", "speech_end", "speech_span", "speech_vad_active_duration", "active_duration", "active_ratio", "pause_ratio", "pause_excluded_cps", "legacy_speech_cps", "global_vad_active_duration", "audio_duration")
    out = df.withColumns({f"raw_{n}": alias.number(v, n) for n in names})
    out = out.withColumns({"status_": alias.word(v, "status"), "alignment_status_": alias.word(v, "alignment_status"), "stamps": alias.timestamps(v)})
    said, clean = F.try_variant_get(v, "$.text", "string"), F.try_variant_get(v, "$.clean_text", "string")
    out = out.withColumn("clean", F.coalesce(F.nullif(clean, F.lit("")), text.clean_spoken_text(said)))
    out = out.withColumn("units", text.count_units(F.col("clean")))
    out = out.withColumn("start", F.coalesce("raw_speech_start", F.get("stamps", F.lit(0))["start"]))
    out = out.withColumn("end", F.coalesce("raw_speech_end", F.element_at(F.col("stamps"), F.when(F.size("stamps") > 0, -1))["end"]))
    out = out.withColumn("span", F.col("end") - F.col("start"))
    out = out.withColumn("active", F.coalesce("raw_speech_vad_active_duration", "raw_active_duration"))
    out = out.withColumn("derived_ratio", F.try_divide("active", "span"))
    out = out.withColumn("vad_active_ratio", F.least(F.lit(1.0), F.col("derived_ratio")))
    out = out.withColumn("pause_ratio", F.coalesce("raw_pause_ratio", F.greatest(F.lit(0.0), 1 - F.col("vad_active_ratio"))))
    span_rate = F.try_divide(F.col("units").cast("double"), F.col("span"))
    pause_rate = F.coalesce("raw_pause_excluded_cps", "raw_legacy_speech_cps", span_rate) if gate.legacy_fallback else F.col("raw_pause_excluded_cps")
    whole = F.col("raw_global_vad_active_duration")
    out = out.withColumns({"pause_excluded_cps": pause_rate, "speech_span_cps": span_rate, "full_audio_vad_cps": F.try_divide(F.col("units").cast("double"), whole), "alignment_vad_coverage": F.try_divide("active", whole)})
    out = out.withColumn("timestamp_quality", intervals.timestamp_quality(F.col("stamps"), gate.score_cutoff, gate.short_sec, gate.gap_min))
    c = F.col
    first_ratio = F.coalesce("raw_active_ratio", "derived_ratio")
    reason = first_reason(
        ("alignment_not_successful", ~status_ok(c("status_")) | ~status_ok(c("alignment_status_"))),
        ("missing_asr_cer", c("raw_asr_cer").isNull()),
        ("asr_cer_out_of_range", (c("raw_asr_cer") < 0) | (c("raw_asr_cer") > gate.max_cer)),
        ("missing_alignment_coverage", c("raw_coverage").isNull()),
        ("alignment_coverage_out_of_range", (c("raw_coverage") < gate.min_coverage) | (c("raw_coverage") > 1.001)),
        ("too_few_spoken_units", c("units") < gate.min_units),
        ("missing_character_timestamps", F.size("stamps") == 0),
        ("invalid_speech_boundaries", (c("start") < 0) | (c("end") <= c("start"))),
        ("inconsistent_speech_span", F.abs(c("raw_speech_span") - c("span")) > F.greatest(F.lit(0.05), c("span") * 0.05)),
        ("speech_span_out_of_range", ~c("span").between(gate.min_span, gate.max_span)),
        ("missing_vad_active_duration", c("active").isNull() | (c("active") <= 0)),
        ("invalid_vad_active_duration", c("active") > c("span") * 1.05),
        ("invalid_vad_active_ratio", ~((first_ratio > 0) & (first_ratio <= 1.001))),
        ("vad_active_ratio_too_low", c("vad_active_ratio") < gate.min_active_ratio),
        ("invalid_pause_ratio", ~c("pause_ratio").between(0.0, 1.001)),
        ("pause_ratio_too_high", c("pause_ratio") > gate.max_pause_ratio),
        ("missing_pause_excluded_cps", c("pause_excluded_cps").isNull() if gate.rate == "pause_excluded_cps" else F.lit(False)),
        ("invalid_pause_excluded_cps", c("pause_excluded_cps") <= 0),
        ("invalid_full_audio_vad_active_duration", whole <= 0),
        ("full_audio_vad_duration_exceeds_audio", whole > c("raw_audio_duration") * 1.05),
        (f"missing_{gate.rate}", c(gate.rate).isNull()),
    )
    return out.withColumns({"alignment_reason": reason, "speed_rate_cps": c(gate.rate)})


@dataclass(frozen=True)
class SpeedGate:
    """Bounds of the speed gate; None leaves a bound out."""

    include_non_cjk: bool = False
    min_coverage: float = 1.0
    min_units: int | None = None
    max_units: int | None = None
    check_scores: bool = False
    max_low_score_ratio: float | None = None
    max_short_ratio: float | None = None
    max_long_gap_ratio: float | None = None
    min_vad_coverage: float | None = None
    max_breaths: int | None = None
    max_holds: int | None = None

    def __post_init__(self):
        if self.check_scores != (self.max_low_score_ratio is not None):
            raise ValueError("a score check needs its ratio, and the ratio the check")


#: Bounds of the clean profile.
CLEAN_SPEED = SpeedGate(min_units=20, max_units=80, check_scores=True, max_low_score_ratio=0.10, max_short_ratio=0.10, max_long_gap_ratio=0.15, min_vad_coverage=0.85, max_breaths=2, max_holds=0)


def speed_reason(gate: SpeedGate, said: Column, skip_events: Column | None = None) -> Column:
    """Why a row with alignment metrics is no speed candidate. said: its text; skip_events: rows whose events don't count."""
    c, q = F.col, F.col("timestamp_quality")
    counted = F.lit(True) if skip_events is None else ~skip_events
    rules = [("non_cjk_speed_control", F.lit(not gate.include_non_cjk) & ~c("clean").rlike(f"[{text.CJK}]")), ("speed_alignment_coverage_below_threshold", c("raw_coverage") < gate.min_coverage)]
    if gate.min_units is not None:
        rules.append(("speed_too_few_spoken_units", c("units") < gate.min_units))
    if gate.max_units is not None:
        rules.append(("speed_too_many_spoken_units", c("units") > gate.max_units))
    if gate.check_scores:
        rules += [("speed_missing_ctc_scores", ~q["scores_available"]), ("speed_ctc_low_score_ratio_too_high", q["low_score_ratio"] > gate.max_low_score_ratio)]
    if gate.max_short_ratio is not None:
        rules.append(("speed_short_character_ratio_too_high", q["short_ratio"] > gate.max_short_ratio))
    if gate.max_long_gap_ratio is not None:
        rules.append(("speed_long_gap_ratio_too_high", q["long_gap_ratio"] > gate.max_long_gap_ratio))
    if gate.min_vad_coverage is not None:
        rules += [("speed_missing_full_audio_vad_coverage", c("alignment_vad_coverage").isNull()), ("speed_vad_alignment_coverage_too_low", c("alignment_vad_coverage") < gate.min_vad_coverage)]
    if gate.max_breaths is not None:
        rules.append(("speed_too_many_breath_events", counted & (text.event_count(said, "breath") > gate.max_breaths)))
    if gate.max_holds is not None:
        rules.append(("speed_too_many_hold_events", counted & (text.event_count(said, "hold") > gate.max_holds)))
    return first_reason(*rules)


EFFORT_METRICS = ("rms_p25", "rms_p50", "lufs_p25", "lufs_p50")


@dataclass(frozen=True)
class EffortGate:
    """Bounds of the effort gate."""

    max_clipping: float = 1e-4
    min_dynamic_range: float = 4.0
    max_noise_floor: float = -25.0
    min_snr: float = 12.0
    integrated_fallback: bool = False


def with_effort(df: DataFrame, gate: EffortGate = EffortGate()) -> DataFrame:
    """Rows with the columns rms_p25, rms_p50, lufs_p25, lufs_p50, integrated_lufs, clipping_ratio, dynamic_range, noise_floor and snr; their loudness filled where that is allowed, lufs_source and effort_reason."""
    c = F.col
    absent = c("lufs_p25").isNull() | c("lufs_p50").isNull()
    filled = absent & c("integrated_lufs").isNotNull() & F.lit(gate.integrated_fallback)
    out = df.withColumn("lufs_source", F.when(filled, "integrated_lufs_fallback").when(~absent, "active_short_term"))
    out = out.withColumns({n: F.when(c("lufs_source") == "integrated_lufs_fallback", c("integrated_lufs")).otherwise(c(n)) for n in ("lufs_p25", "lufs_p50")})
    missing = F.lit(False)
    for n in (*EFFORT_METRICS, "clipping_ratio", "dynamic_range"):
        missing = missing | c(n).isNull()
    reason = first_reason(
        ("missing_active_lufs_metrics", c("lufs_source").isNull()),
        ("missing_active_effort_metrics", missing),
        ("clipping_ratio_out_of_range", ~c("clipping_ratio").between(0.0, gate.max_clipping)),
        ("dynamic_range_too_low", c("dynamic_range") < gate.min_dynamic_range),
        ("noise_floor_too_high", F.lit(gate.max_noise_floor < 0) & (c("noise_floor") > gate.max_noise_floor)),
        ("snr_too_low", F.lit(gate.min_snr > 0) & (c("snr") < gate.min_snr)),
    )
    return out.withColumn("effort_reason", reason)


def reference_reason(df: DataFrame, max_cer: float = 0.12, min_coverage: float = 0.90) -> Column:
    """Why a row is no clean reference; here a missing or empty status is no success."""
    from tessera.functions.numbers import finite

    cer, coverage = finite(field(df, "asr_cer")), finite(field(df, "alignment_coverage"))
    said = text.text(field(df, "text"))
    other = F.array_except(text.event_tags(said), F.array(*map(F.lit, SPOKEN_EVENTS)))
    done = lambda f: F.coalesce(F.lower(present(field(df, f))).isin(*SUCCESS), F.lit(False))
    return first_reason(
        ("status_not_successful", ~done("status")),
        ("alignment_not_successful", ~done("alignment_status")),
        ("not_clean_text", (said == "") | (F.size(other) > 0)),
        ("asr_cer_out_of_range", cer.isNull() | (cer < 0) | (cer > max_cer)),
        ("alignment_coverage_out_of_range", coverage.isNull() | (coverage < min_coverage) | (coverage > 1.001)),
    )


def final_status(stages: list[tuple[str, Column, Column]], essential: str) -> tuple[Column, Column]:
    """(status, error) of stages (name, status, error): ok if all are, partial if the essential one is, else failed."""
    errors = F.array_compact(F.array(*(F.when(s != "ok", F.concat(F.lit(f"{n}: "), F.coalesce(F.nullif(e, F.lit("")), s))) for n, s, e in stages)))
    good = next(s for n, s, _ in stages if n == essential) == "ok"
    status = F.when(F.size(errors) == 0, "ok").when(good, "partial").otherwise("failed")
    return status, F.when(F.size(errors) > 0, F.array_join(errors, "; "))
