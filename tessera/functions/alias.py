"""Look-up of logical fields by aliases in records of an open schema (VARIANT): the record itself first, then its nested containers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numbers import finite

# Nested containers in their order, and the aliases of each logical field in theirs.
CONTAINERS = ("alignment", "alignment_metrics", "audio_metrics", "active_speech_metrics", "loudness_metrics", "audio_control_metrics", "loud_scan_metrics", "metrics")
ALIASES = {
    "status": ("status",),
    "alignment_status": ("alignment_status", "align_status"),
    "asr_cer": ("asr_cer", "cer", "character_error_rate"),
    "coverage": ("alignment_coverage", "coverage", "aligned_coverage"),
    "speech_start": ("speech_start_sec", "aligned_start_sec", "first_speech_sec"),
    "speech_end": ("speech_end_sec", "aligned_end_sec", "last_speech_sec"),
    "speech_span": ("speech_span_sec", "aligned_span_sec", "speech_duration_sec"),
    "audio_duration": ("audio_duration_sec", "duration_sec", "duration"),
    "global_vad_active_duration": ("vad_active_duration_sec", "active_speech_duration_sec", "active_duration_sec", "active_duration_sec_est"),
    "speech_vad_active_duration": ("speech_vad_active_duration_sec", "aligned_vad_active_duration_sec"),
    "active_duration": ("speech_vad_active_duration_sec", "vad_active_duration_sec", "active_speech_duration_sec", "active_duration_sec", "active_duration_sec_est"),
    "active_ratio": ("speech_vad_active_ratio", "vad_active_ratio", "speech_ratio", "speech_ratio_est", "active_speech_ratio"),
    "pause_ratio": ("pause_ratio", "internal_pause_ratio"),
    "pause_excluded_cps": ("pause_excluded_cps",),
    "pause_excluded_duration": ("pause_excluded_duration_sec",),
    "char_pause_count": ("char_pause_count",),
    "char_pause_duration": ("char_pause_duration_sec",),
    "char_pause_ratio": ("char_pause_ratio",),
    "legacy_speech_cps": ("speech_cps", "speed_cps", "units_per_sec"),
    "rms_p25": ("active_rms_dbfs_p25", "active_rms_p25_dbfs", "active_frame_rms_dbfs_p25", "rms_dbfs_p25"),
    "rms_p50": ("active_rms_dbfs_p50", "active_rms_p50_dbfs", "active_frame_rms_dbfs_p50", "rms_dbfs_p50"),
    "lufs_p25": ("active_lufs_p25", "short_term_lufs_p25", "short_term_lufs_db_p25", "lufs_short_term_p25", "lufs_p25"),
    "lufs_p50": ("active_lufs_p50", "short_term_lufs_p50", "short_term_lufs_db_p50", "lufs_short_term_p50", "lufs_p50"),
    "integrated_lufs": ("lufs_i", "integrated_lufs", "lufs"),
    "clipping_ratio": ("clipping_ratio", "clip_ratio", "clipped_sample_ratio"),
    "dynamic_range": ("dynamic_range_db", "active_rms_span_p90_p10_db", "active_dynamic_range_db", "loudness_range_lu", "crest_db"),
    "noise_floor": ("noise_floor_dbfs", "vad_noise_floor_dbfs", "noise_gate_dbfs"),
    "snr": ("snr_db", "signal_to_noise_db"),
    "paralinguistic_ratio": ("paralinguistic_ratio", "non_speech_ratio", "long_non_speech_ratio"),
}
TIMESTAMPS = ("character_timestamps", "word_timestamps", "alignment_timestamps", "aligned_timestamps")


def lookup(record: Column, names: tuple[str, ...]) -> Column:
    """The first value that isn't null, container by container and alias by alias, as a VARIANT. A JSON null counts as null, and a value of the wrong kind is not passed over."""
    paths = [f"$.{n}" for n in names] + [f"$.{c}.{n}" for c in CONTAINERS for n in names]
    found = [F.try_variant_get(record, p, "variant") for p in paths]
    return F.coalesce(*(F.when(~F.is_variant_null(v), v) for v in found))


def as_string(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def number(record: Column, name: str) -> Column:
    """The logical field as a finite double; the choice comes before the cast."""
    return finite(as_string(lookup(record, ALIASES[name])))


def word(record: Column, name: str) -> Column:
    return as_string(lookup(record, ALIASES[name]))


def member(item: Column, *names: str) -> Column:
    """The first of these members that an object has, as a finite double; a JSON null that is there counts."""
    found = [F.try_variant_get(item, f"$.{n}", "variant") for n in names]
    return finite(as_string(F.coalesce(*found)))


def timestamps(record: Column) -> Column:
    """array<struct<start, end, score, pair>> of the record's timestamps, objects or pairs; only what holds 0 <= start <= end."""
    items = F.coalesce(F.try_variant_get(lookup(record, TIMESTAMPS), "$", "array<variant>"), F.array().cast("array<variant>"))

    def entry(v: Column) -> Column:
        pair = F.schema_of_variant(v).startswith("ARRAY")
        start = F.when(pair, finite(as_string(F.try_variant_get(v, "$[0]", "variant")))).otherwise(member(v, "start_sec", "start", "begin"))
        end = F.when(pair, finite(as_string(F.try_variant_get(v, "$[1]", "variant")))).otherwise(member(v, "end_sec", "end", "stop"))
        return F.struct(start.alias("start"), end.alias("end"), F.when(~pair, member(v, "score")).alias("score"), pair.alias("pair"))

    return F.filter(F.transform(items, entry), lambda t: (t["start"] >= 0) & (t["start"] <= t["end"]))
