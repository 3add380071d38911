"""The curation jobs end to end: alignment rows, candidates, stages, references, evaluation cases, review lists. Each is one plan over a scan; reports are small aggregates of it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import alias, identity, text
from tessera.functions.numbers import finite
from tessera.operators import calibrate, gates, rows, sampling
from tessera.session import cut

#: String fields of a record that jobs look at.
NAMES = "key id item_id item_name record_id utt_id control_candidate_id text clean_text audio audio_path audio_path_raw wav_path source dataset_source control_source speaker_id gender recording_group control_tag speed_label effort_label control_dataset_role ref_audio style voice_style status alignment_status asr_cer alignment_coverage speech_cps".split()


@dataclass(frozen=True)
class Sources:
    """How a corpus names its sources and groups its recordings."""

    rules: tuple[identity.SourceRule, ...] = ()
    goal: str = "目标"
    whole_prefix: tuple[str, ...] = ()
    itemized: tuple[str, ...] = ()

    def source(self, df: DataFrame) -> Column:
        return identity.infer_source(df, list(self.rules))

    def names(self) -> list[str]:
        return [r.name for r in self.rules]


def opened(scan: DataFrame) -> DataFrame:
    """A scan's lines (manifest, path, line, record) with the record's string fields as columns."""
    more = sorted({*gates.GENERATED_FIELDS, *gates.GENERATED_NAMES} - set(NAMES))
    return scan.select("manifest", "path", "line", "record", *(F.try_variant_get("record", f"$.{n}", "string").alias(n) for n in [*NAMES, *more]))


def with_identity(df: DataFrame, sources: Sources) -> DataFrame:
    """The rows with source_name, group and rid: a record's source, recording group and namespaced id."""
    declared = F.lower(identity.first_present(F.col("source"), F.col("dataset_source")))
    inferred = sources.source(df)
    named = F.lit(None).cast("string")
    for r in reversed(sources.rules):
        named = F.when(gates.contains_any(F.coalesce(declared, inferred), (r.name, *r.declared)), r.name).otherwise(named)
    out = df.withColumn("source_name", F.coalesce(named, declared, inferred))
    group = F.coalesce(identity.present(F.col("recording_group")), identity.recording_group(out, inferred, sources.goal, sources.whole_prefix, sources.itemized))
    out = out.withColumn("group", F.when(group.startswith(F.concat(F.col("source_name"), F.lit(":"))), group).otherwise(F.concat(F.col("source_name"), F.lit(":"), group)))
    return out.withColumn("rid", identity.record_id(out, F.col("source_name"), F.col("path"), F.col("line")))


def alignment_rows(scan: DataFrame, exclude: tuple[str, ...] = (), cjk_only: bool = False, most: int | None = None, shards: int = 1, shard: int = 0, sources: Sources = Sources()) -> DataFrame:
    """Lines to align, in order: a prefix limit, then source and script filters, then the shard by ordinal."""
    from tessera.sources.jsonl import with_ordinal

    numbered = with_ordinal(scan.select("manifest", "line"), ["manifest", "line"])
    if most is not None:
        numbered = numbered.where(F.col("ordinal") < most)
    out = opened(scan).join(numbered, ["manifest", "line"])
    if exclude:
        out = out.where(~sources.source(out).isin(*exclude))
    out = out.withColumn("clean", text.clean_spoken_text("text"))
    if cjk_only:
        out = out.where(text.is_cjk_only(F.col("clean")))
    return rows.shard(out, "ordinal", shards, shard)


@dataclass(frozen=True)
class CandidatePlan:
    """What the candidate job does."""

    sources: Sources = Sources()
    alignment: gates.AlignmentGate = gates.AlignmentGate()
    speed: gates.SpeedGate = gates.SpeedGate()
    effort: gates.EffortGate = gates.EffortGate()
    tiers: calibrate.Tiers = calibrate.Tiers()
    groups: calibrate.GroupTiers = field(default_factory=lambda: calibrate.GroupTiers(spans=((("rms_p25", "rms_p50"), 3.0, "group_rms_span_too_small"), (("lufs_p25", "lufs_p50"), 3.0, "group_lufs_span_too_small"))))
    proxies: tuple[str, ...] = ()
    proxy_events: bool = False
    paralinguistic: bool = False
    max_paralinguistic: float = 0.15
    require_normal_effort: bool = False
    emit: tuple[str, ...] = ("speed", "effort")
    audio_root: str | None = None


def gated_records(scan: DataFrame, plan: CandidatePlan = CandidatePlan()) -> DataFrame:
    """Every first record of an id with its metrics and reason, speed_reason and effort_reason. Later records of an id are dropped before any gate, so a rejected first one still stands for them; duplicates says how many they were."""
    df = with_identity(opened(scan), plan.sources)
    counts = df.groupBy("rid").agg((F.count(F.lit(1)) - 1).alias("duplicates"))
    df = rows.keep_first(df, ["rid"], ["manifest", "line"]).join(counts, "rid")
    df = gates.with_alignment(df, plan.alignment)
    df = df.withColumns({n: alias.number(F.col("record"), n) for n in ("rms_p25", "rms_p50", "lufs_p25", "lufs_p50", "integrated_lufs", "clipping_ratio", "dynamic_range", "noise_floor", "snr", "paralinguistic_ratio")})
    df = gates.with_effort(df, plan.effort)
    style = gates.style_reason(df, F.col("paralinguistic_ratio"), plan.max_paralinguistic, plan.paralinguistic)
    value, _ = identity.audio_value(df)
    df = df.withColumn("resolved", identity.resolve_audio(value, plan.audio_root))
    df = df.withColumn("is_proxy", text.matches_proxy("text", list(plan.proxies)))
    df = df.withColumn("is_mixed", F.lit(bool(plan.proxies)) & ~F.col("is_proxy") & F.exists(text.emotion_tags("text"), lambda t: gates.contains_any(t, plan.proxies) if plan.proxies else F.lit(False)))
    early = F.when(gates.is_generated(df), "generated_control_provenance").when(text.has_control_tag("text"), "prelabeled_control_text")
    reason = F.coalesce(early, style, F.col("alignment_reason"), F.when(F.col("resolved").isNull(), "missing_audio"))
    speed = gates.speed_reason(plan.speed, F.col("text"), F.col("is_proxy") if plan.proxy_events else None)
    df = df.withColumn("reason", reason).withColumn("speed_reason", F.when(F.col("reason").isNull(), speed))
    # calibration and labels read this more than once, and a filter on a reason would else carry all of its making into the scan
    return cut(df.withColumn("effort_reason", F.when(F.col("reason").isNull(), F.col("effort_reason"))))


def labelled(found: DataFrame, plan: CandidatePlan = CandidatePlan()) -> DataFrame:
    """The gated records with speed_label and effort_label and why a label isn't emitted (speed_out, effort_out)."""
    ok = found.where("reason IS NULL")
    pace = ok.withColumn("pace", F.when(F.col("speed_reason").isNull(), F.col("speed_rate_cps")))
    if plan.proxies:
        out = calibrate.with_proxy_tiers(pace, "pace", plan.tiers, "is_proxy", "is_mixed").withColumnRenamed("tier", "speed_label")
        out = out.withColumn("speed_label", F.when(F.col("speed_reason").isNull(), F.col("speed_label")))
    else:
        out = calibrate.with_tiers(pace, "pace", plan.tiers, "speed_label")
    metrics = list(gates.EFFORT_METRICS)
    good = out.where("effort_reason IS NULL")
    t = calibrate.group_thresholds(good, "group", metrics, plan.groups).where("reason IS NULL").drop("n", "reason").withColumn("has_group", F.lit(True))
    out = out.join(t, "group", "left").withColumn("effort_label", F.when(F.col("effort_reason").isNull(), calibrate.agreed_tier(metrics)))
    lost = F.when(F.col("speed_reason") == "non_cjk_speed_control", "effort_requires_cjk_lexical_content").when(F.col("speed_reason").isNotNull(), "effort_requires_complete_speed_alignment")
    speed_out, effort_out = calibrate.conditioned(F.col("speed_label"), F.col("effort_label"), plan.require_normal_effort)
    out = out.withColumn("speed_out", F.coalesce("speed_reason", speed_out))
    group_out = F.when(F.col("has_group").isNull(), "effort_group_without_threshold")
    return out.withColumn("effort_out", F.coalesce("effort_reason", group_out, F.when(F.col("effort_label").isNull(), "effort_metric_disagreement_or_ambiguous"), lost, effort_out)).drop("pace", "has_group")


def candidates(scan: DataFrame, plan: CandidatePlan = CandidatePlan()) -> DataFrame:
    """Candidate rows of both kinds with provenance, in the order kind, source, group, id, line (column place)."""
    out = labelled(gated_records(scan, plan), plan)
    kinds = [F.when((F.lit(kind in plan.emit)) & F.col(f"{kind}_out").isNull(), F.struct(F.lit(k).alias("place"), F.lit(kind).alias("kind"), F.concat(F.lit(f"{kind}_"), F.col(f"{kind}_label")).alias("tag"))) for k, kind in enumerate(("speed", "effort"))]
    out = out.withColumn("c", F.explode(F.array_compact(F.array(*kinds))))
    said = F.when(F.lit(bool(plan.proxies)) & (F.col("c.kind") == "speed") & F.col("is_proxy"), text.strip_emotion_tags("text", list(plan.proxies))).otherwise(text.strip(text.text("text")))
    emotion = text.emotion_family("text")
    return out.select(
        F.struct("c.place", "source_name", "group", "rid", "line").alias("place"),
        F.concat("rid", F.lit("::"), "c.kind").alias("control_candidate_id"),
        F.col("rid").alias("record_id"),
        "key",
        F.col("resolved").alias("audio"),
        F.concat(F.lit("【"), F.col("c.tag"), F.lit("】"), said).alias("text"),
        F.col("source_name").alias("source"),
        F.col("group").alias("recording_group"),
        F.col("c.kind").alias("control_kind"),
        F.col("c.tag").alias("control_tag"),
        "speed_label",
        "effort_label",
        F.lit(plan.alignment.rate).alias("speed_rate_metric"),
        "speed_rate_cps",
        (F.col("c.kind") == "effort").alias("requires_review"),
        F.struct(F.struct(F.col("raw_asr_cer").alias("asr_cer"), F.col("raw_coverage").alias("alignment_coverage"), "units", "span", "pause_ratio", "speed_rate_cps", "timestamp_quality").alias("alignment"), F.struct(*gates.EFFORT_METRICS, "dynamic_range", "noise_floor", "snr", "lufs_source").alias("active_loudness")).alias("control_metrics"),
        F.struct(F.struct(F.col("source_name").alias("source"), emotion.alias("emotion_family"), text.duration_bin(F.col("span")).alias("duration_bin")).alias("stratum"), *(F.col(f"q_{m}").alias(f"threshold_{m}") for m in gates.EFFORT_METRICS)).alias("control_selection"),
        F.col("record").alias("input_record"),
    )


def candidate_report(scan: DataFrame, plan: CandidatePlan = CandidatePlan()) -> DataFrame:
    """reason, n of all rejections: of duplicates, gates, and labels that aren't emitted."""
    found = gated_records(scan, plan)
    out = labelled(found, plan)
    twice = found.agg(F.lit("duplicate_record_id").alias("reason"), F.sum("duplicates").alias("n")).where("n > 0")
    parts = [gates.rejections(found), *(gates.rejections(out, c) for c in ("speed_out", "effort_out"))]
    for p in parts:
        twice = twice.unionByName(p)
    return twice.groupBy("reason").agg(F.sum("n").alias("n"))


def assemble(found: DataFrame, replay: DataFrame, in_stage: Column, excluded_keys: DataFrame, approved_ids: DataFrame | None, sources: list[str], seed: int = 42, per_control: int | None = None, replay_ratio: float = 1.0) -> DataFrame:
    """A stage's rows: controls balanced over tags and, within a tag, over source and emotion; and untagged replay rows that are no control's target. Both tables have key, record_id, control_candidate_id, audio, text, source and line; found has control_tag. Fails where a tag is missing, has fewer rows than asked for, or replay falls short."""
    listed = excluded_keys.select(F.col("key").alias("_k")).distinct()

    def outside(df: DataFrame) -> DataFrame:
        ids = identity.identity_variants([F.col("key"), F.col("record_id"), F.col("control_candidate_id")], sources)
        return rows.excluded(df.withColumn("_ids", ids), F.col("_ids"), listed, "_k").drop("_ids")

    staged = outside(found.where(in_stage & F.col("control_tag").isNotNull()))
    if approved_ids is not None:
        who = F.coalesce(identity.present(F.col("control_candidate_id")), identity.present(F.col("key")), identity.present(F.col("record_id")))
        ids = approved_ids.select(F.col("key").alias("_who")).distinct()
        effort = staged.where(F.col("control_tag").startswith("effort_")).withColumn("_who", who).join(ids, "_who", "left_semi").drop("_who")
        staged = staged.where(~F.col("control_tag").startswith("effort_")).unionByName(effort)
    stable = identity.stable_key(F.col("key"), F.col("audio"))
    staged = staged.withColumn("target", F.coalesce(stable, F.concat(F.lit("line:"), F.col("line").cast("string"))))
    staged = rows.keep_first(staged, ["control_tag", "target"], ["line"])
    seen = {r["control_tag"]: r["count"] for r in staged.groupBy("control_tag").count().collect()}
    if missing := sorted(set(text.CONTROL_TAGS) - set(seen)):
        raise ValueError(f"missing eligible control tags: {missing}")
    if per_control is not None and (short := sorted(t for t, n in seen.items() if n < per_control)):
        raise ValueError(f"fewer than {per_control} eligible rows of {short}")
    staged = staged.withColumn("emotion", text.emotion_family("text"))
    controls = sampling.stratified(staged, "control_tag", ["source", "emotion"], "target", seed, per_control)
    pool = outside(replay.where(in_stage & ~text.text("text").rlike("【(?:" + "|".join(text.CONTROL_TAGS) + "|loud|speed_very_slow|speed_very_fast)】")))
    pool = pool.withColumn("target", F.coalesce(stable, F.concat(F.lit("line:"), F.col("line").cast("string")))).join(controls.select("target").distinct(), "target", "left_anti")
    pool = rows.keep_first(pool, ["target"], ["line"]).withColumn("emotion", text.emotion_family("text")).withColumn("_one", F.lit("replay"))
    n, have = controls.count(), pool.count()
    wanted = round(n * replay_ratio)
    if wanted > have:
        raise ValueError(f"requested {wanted} replay rows but only {have} are available")
    drawn = sampling.stratified(pool, "_one", ["source", "emotion"], "target", seed, wanted).drop("_one")
    both = controls.withColumn("control_dataset_role", F.lit("control")).unionByName(drawn.withColumn("control_dataset_role", F.lit("replay")), allowMissingColumns=True)
    return sampling.shuffled(both.drop("emotion"), "target", seed)


def clean_references(refs: DataFrame, group: str = "recording_group", k: int = 3, root: str | None = None) -> DataFrame:
    """The pool of each recording group: its k best clean references by emotion, pace near four units a second, text length and path."""
    value, _ = identity.audio_value(refs)
    path = identity.resolve_audio(value, root)
    out = refs.withColumn("reason", gates.reference_reason(refs)).withColumn("path", path).where("reason IS NULL AND path IS NOT NULL")
    family = text.emotion_family("text")
    rank = F.when(family == "neutral", 0).when(family == "no_emotion", 1).otherwise(2)
    out = out.withColumn("family_rank", rank).withColumn("far", F.coalesce(F.abs(finite(identity.field(refs, "speech_cps")) - 4), F.lit(99.0)))
    out = out.withColumn("size", F.char_length(text.normalized(text.clean_spoken_text("text")))).withColumn("path_key", identity.path_key(F.col("path")))
    return rows.reference_pool(out.select(group, "family_rank", "far", "size", "path_key", "path"), group, ["family_rank", "far", "size", "path_key"], k)


def attach_group_references(targets: DataFrame, pool: DataFrame, root: str | None = None) -> DataFrame:
    """The targets with a reference of their group that isn't themselves."""
    value, _ = identity.audio_value(targets)
    out = targets.withColumn("audio", identity.resolve_audio(value, root))
    out = out.withColumn("_key", identity.path_key(F.col("audio")))
    who = F.coalesce(*(identity.present(identity.field(out, n)) for n in ("control_candidate_id", "key", "record_id", "audio")))
    out = rows.attach_reference(out, pool, "recording_group", F.col("_key"), who, "path_key")
    best = pool.select("recording_group", F.explode("pool").alias("p")).select("recording_group", F.col("p.path_key").alias("ref_audio"), F.col("p.path").alias("_path")).distinct()
    return out.join(best, ["recording_group", "ref_audio"], "left").withColumn("ref_audio", F.when(F.col("ref_policy").startswith("same"), F.col("_path")).otherwise(F.col("audio"))).drop("_path", "_key")


def evaluation_cases(pool: DataFrame, trained: DataFrame, reference: str, count: int = 50, min_units: int = 10, seed: int = 42) -> DataFrame:
    """Seven prompts, one plain and one for each control tag, of so many held-out texts: rows with key, text and audio whose key no trained identity (column key) names."""
    clean = text.clean_spoken_text("text")
    ok = pool.where(identity.present(F.col("key")).isNotNull() & ~text.has_control_tag("text")).where((text.count_units(clean) >= min_units) & ~gates.is_speed_excluded(pool))
    ok = ok.join(trained.select("key").distinct(), "key", "left_anti")
    drawn = sampling.uniform(ok, "key", seed, count)
    if drawn.count() < count:
        raise ValueError(f"fewer than {count} eligible held-out rows")
    numbered = rows.top_k(drawn.withColumn("_all", F.lit(1)), ["_all"], [F.xxhash64(F.col("key"), F.lit(seed)), F.col("key")], count, "n").drop("_all")
    each = rows.variants(numbered.select("n", "key", "text"), [("untagged", ""), *((t, f"【{t}】") for t in text.CONTROL_TAGS)])
    sample = F.format_string("%03d", "n")
    dimension = F.when(F.col("variant").startswith("speed_"), "speed").when(F.col("variant").startswith("effort_"), "effort").otherwise("none")
    said = text.strip(F.col("text"))
    return each.select(F.concat(sample, F.lit("_"), "variant").alias("case_id"), sample.alias("sample_id"), F.col("key").alias("source_key"), "variant", dimension.alias("control_dimension"), F.concat("prefix", said).alias("prompt_text"), said.alias("base_text"), F.lit(reference).alias("ref_audio"))


def review_list(found: DataFrame, k: int = 100) -> DataFrame:
    """Of candidates (control_tag, control_candidate_id, sort_value) the k to listen to of each tag with their rank: the lowest of slow and soft, the highest of fast and strong, those nearest to the median of the others."""
    low, high = ["speed_slow", "effort_soft"], ["speed_fast", "effort_strong"]
    ok = rows.keep_first(found.where("sort_value IS NOT NULL").withColumn("_n", F.monotonically_increasing_id()), ["control_tag", "control_candidate_id"], ["_n"]).drop("_n")
    first = rows.top_k(ok.where(F.col("control_tag").isin(low)), ["control_tag"], ["sort_value", "control_candidate_id"], k)
    last = rows.top_k(ok.where(F.col("control_tag").isin(high)), ["control_tag"], [F.desc("sort_value"), "control_candidate_id"], k)
    middle = rows.closest_to_median(ok.where(~F.col("control_tag").isin(low + high)), "control_tag", "sort_value", "control_candidate_id", k)
    return first.unionByName(last).unionByName(middle.select(first.columns))


def relative_loudness(value: Column, low: Column, high: Column) -> Column:
    """Where a loudness stands between its group's outer thresholds; the loudness itself without them."""
    return F.when(high > low, (value - low) / (high - low)).otherwise(value)
