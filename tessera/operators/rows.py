"""Row operators: keep-first dedup, lookups, unions, top-k, dataset validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.functions.identity import audio_key, field, path_key, present, stable_index
from tessera.operators.calibrate import quantiles
from tessera.operators.gates import first_reason
from tessera.session import cut


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. A group's rows are reduced by a partial aggregate before the shuffle, so a key with many rows doesn't meet in one task."""
    row = F.struct(*(c for c in df.columns if c not in order))
    kept = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_o"), F.min_by(row, F.struct(*order)).alias("_r"))
    return kept.select("_o.*", "_r.*").select(df.columns)


def first_of_key(df: DataFrame, keys: list[str], place: str, out: str) -> DataFrame:
    """Each row with the place of its key's first row; the firsts are a partial aggregate joined back, which splits skewed keys."""
    first = df.groupBy(*keys).agg(F.min(place).alias(out))
    return df.join(first, keys)


def shard(df: DataFrame, ordinal: str, count: int, index: int) -> DataFrame:
    """The rows of a shard by their ordinal."""
    if count < 1 or not 0 <= index < count:
        raise ValueError("the shard's index must be in 0..count-1")
    return df.where(F.when(F.col(ordinal) < 0, F.raise_error(F.lit("an ordinal can't be negative")).cast("boolean")).otherwise(F.pmod(ordinal, F.lit(count)) == index))


def approved(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows whose key is in the list."""
    return df.join(keys.select(on).distinct(), on, "left_semi")


def excluded(df: DataFrame, variants: Column, keys: DataFrame, key: str) -> DataFrame:
    """The rows without any identity in the list. Rows get a number, and identities and numbers alone meet the list, so rows of any types will do and a row with several identities goes if one is listed."""
    numbered = cut(df.withColumn("_v", variants).withColumn("_row", F.monotonically_increasing_id()))
    listed = keys.select(F.col(key).alias("_k")).distinct()
    hit = numbered.select("_row", F.explode("_v").alias("_k")).join(listed, "_k", "left_semi").select("_row").distinct()
    return numbered.join(hit, "_row", "left_anti").select(df.columns)


def top_k(df: DataFrame, group: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group with their rank; a group limit runs before the shuffle."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= k)


def closest_to_median(df: DataFrame, group: str, value: str, tie: str, k: int) -> DataFrame:
    """The k rows of each group nearest to its exact median, ranked by value. Medians are aggregated and joined, not windowed over whole groups."""
    medians = quantiles(df, [group], value, [0.5]).select(group, F.col("q")[0].alias("median"))
    near = df.join(medians, group).withColumn("distance", F.abs(F.col(value) - F.col("median")))
    return top_k(top_k(near, [group], ["distance", tie], k, "_near").drop("_near"), [group], [value, tie], k)


def reference_pool(refs: DataFrame, group: str, order: list[str], k: int) -> DataFrame:
    """group and the k best references of each as an array of structs in order."""
    best = top_k(refs, [group], order, k, "_rank")
    return best.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_rank", *[c for c in refs.columns if c != group]))).alias("pool"))


def attach_reference(targets: DataFrame, pool: DataFrame, group: str, target_path: Column, target_id: Column, path: str = "path") -> DataFrame:
    """The targets with ref_audio and ref_policy: of their group's pool without themselves one by a stable hash of their id, else themselves. A pool has k rows at most, so each group is one row of the join."""
    out = targets.join(pool, group, "left").withColumn("_self", target_path).withColumn("_id", target_id)
    out = out.withColumn("_can", F.filter(F.coalesce("pool", F.array().cast(pool.schema["pool"].dataType)), lambda r: r[path] != F.col("_self")))
    some = F.size("_can") > 0
    pick = F.get("_can", F.when(some, stable_index(F.col("_id"), F.size("_can"))))[path]
    policy = F.when(some, "same_recording_group_clean_reference").otherwise("self_reference_no_same_group_pool")
    return out.withColumn("ref_audio", F.when(some, pick).otherwise(F.col("_self"))).withColumn("ref_policy", policy).drop("pool", "_self", "_id", "_can")


def attach_fixed(targets: DataFrame, refs: DataFrame, key: str, key_value: str, place: str, path: str, applies: Column, audio: str | None = None) -> DataFrame:
    """The targets where applies holds with the path of the first reference of the key; the others untouched. Fails without such a reference and, if the targets' own audio is named, where a target has none or is itself the reference."""
    found = refs.where(F.col(key) == key_value).orderBy(place).limit(1).select(path).collect()
    if not found or not found[0][0]:
        raise ValueError(f"no reference with the key {key_value}")
    ref = F.lit(found[0][0])
    if audio is not None:
        own = present(F.col(audio))
        fault = F.when(own.isNull(), "a target has no audio").when(path_key(own) == path_key(ref), "a target is the fixed reference")
        ref = F.when(fault.isNull(), ref).otherwise(F.raise_error(fault).cast("string"))
    return targets.withColumn("ref_audio", F.when(applies, ref))


def variants(df: DataFrame, table: list[tuple[str, str]]) -> DataFrame:
    """Each row once for every (variant, prefix)."""
    each = F.explode(F.array(*(F.struct(F.lit(v).alias("variant"), F.lit(p).alias("prefix")) for v, p in table)))
    return df.withColumn("_v", each).select(*df.columns, "_v.variant", "_v.prefix")


def control_tag(df: DataFrame) -> Column:
    """The declared control tag, else the one that a label names."""
    tag, speed, effort = field(df, "control_tag"), field(df, "speed_label"), field(df, "effort_label")
    return F.when(tag.isin(*text.CONTROL_TAGS), tag).when(speed.isin("slow", "normal", "fast"), F.concat(F.lit("speed_"), speed)).when(effort.isin("soft", "normal", "strong"), F.concat(F.lit("effort_"), effort))


def present_tags(c: Column) -> Column:
    return F.filter(F.array(*map(F.lit, sorted(text.CONTROL_TAGS))), lambda t: F.contains(c, F.concat(F.lit("【"), t, F.lit("】"))))


def valid_codes(codes: Column) -> Column:
    """Frames of 16 codes each, one at least."""
    return F.coalesce((F.size(codes) > 0) & F.forall(codes, lambda f: F.coalesce(F.size(f) == 16, F.lit(False))), F.lit(False))


def validation_failures(df: DataFrame, line: str, need_reference: bool = False, codes: str | None = None, files: DataFrame | None = None) -> DataFrame:
    """line, reason, tags, first_line of every failure; a row may have several. files: a table of the paths (column path) that exist."""
    said, role = text.text(field(df, "text")), field(df, "control_dataset_role")
    declared, audio, ref = present(field(df, "control_tag")), present(field(df, "audio")), present(field(df, "ref_audio"))
    out = df.select(F.col(line).alias("line"), said.alias("said"), role.alias("role"), declared.alias("declared"), audio.alias("audio"), ref.alias("ref"), *([F.col(codes).alias("codes")] if codes else []))
    out = out.withColumn("tags", present_tags(F.col("said")))
    out = out.withColumn("tag_key", F.coalesce("declared", F.when(F.size("tags") == 1, F.get("tags", F.lit(0))), F.lit("")))
    out = out.withColumn("audio_key", F.when(F.col("audio").isNotNull(), _collapsed(F.col("audio"))))
    firsts = out.where("audio_key IS NOT NULL").groupBy("audio_key", "tag_key").agg(F.min("line").alias("first_line"))
    out = out.join(firsts, ["audio_key", "tag_key"], "left")
    control = F.coalesce(F.col("role") == "control", F.lit(False))
    in_dimension = lambda tags: F.size(F.array_intersect("tags", F.array(*map(F.lit, tags)))) > 1
    checks = [
        ("multiple_tags_in_dimension", in_dimension(text.SPEED_TAGS) | in_dimension(text.EFFORT_TAGS)),
        ("control_row_requires_one_tag", control & (F.size("tags") != 1)),
        ("declared_control_tag_does_not_match_text", control & F.col("declared").isNotNull() & ~F.col("tags").eqNullSafe(F.array("declared"))),
        ("legacy_v3_control_tag", F.col("said").rlike("【loud】|【speed_very_slow】|【speed_very_fast】")),
        ("missing_audio", F.col("audio").isNull()),
        ("duplicate_control_audio_and_tag", control & (F.col("first_line") < F.col("line"))),
    ]
    if files is not None:
        known = files.select(F.col("path").alias("_p")).distinct().withColumn("_there", F.lit(True))
        out = out.join(known, out["audio"] == known["_p"], "left").withColumnRenamed("_there", "audio_there").drop("_p")
        out = out.join(known, out["ref"] == known["_p"], "left").withColumnRenamed("_there", "ref_there").drop("_p")
        checks.append(("audio_missing_on_disk", F.col("audio").isNotNull() & F.col("audio_there").isNull()))
    if need_reference:
        checks.append(("missing_ref_audio", F.col("ref").isNull()))
        checks.append(("self_reference_audio", audio_key(F.col("audio")) == audio_key(F.col("ref"))))
        if files is not None:
            checks.append(("ref_audio_missing_on_disk", F.col("ref").isNotNull() & F.col("ref_there").isNull()))
    if codes:
        checks.append(("invalid_audio_codes", ~valid_codes(F.col("codes"))))
    found = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in checks)))
    out = out.withColumn("reason", F.explode(found))
    first = F.when(F.col("reason") == "duplicate_control_audio_and_tag", F.col("first_line"))
    return out.select("line", "reason", "tags", first.alias("first_line"))


def _collapsed(c: Column) -> Column:
    from tessera.functions.identity import collapse

    return collapse(c)


def validation_report(failures: DataFrame, most: int = 200) -> dict:
    """The number of failures and the first of them, as the report lists them."""
    n = failures.count()
    rows = [r.asDict() for r in failures.orderBy("line", "reason").limit(most).collect()]
    return {"valid": n == 0, "failure_count": n, "failures": rows, "failures_truncated": n > most}


def stage_reason(df: DataFrame, tag: Column, in_stage: Column, is_excluded: Column, is_approved: Column) -> Column:
    """Why a candidate doesn't enter a stage, before duplicates are looked for."""
    return first_reason(("missing_control_tag", tag.isNull()), ("outside_stage_source", ~in_stage), ("explicitly_excluded_key", is_excluded), ("effort_not_approved", tag.startswith("effort_") & ~is_approved))
