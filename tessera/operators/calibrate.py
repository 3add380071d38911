"""Exact quantile calibration and tiers. Boundaries are exact, as tiers turn on them; approximations would move rows over them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.gates import first_reason
from tessera.session import cut


@dataclass(frozen=True)
class Tiers:
    """Quantile levels of a three-tier split: low and high, and of the middle band if only its rows are normal."""

    low: float = 1 / 3
    high: float = 2 / 3
    band: tuple[float, float] | None = None
    min_records: int = 100

    def __post_init__(self):
        levels = self.levels
        if not all(0 < a < 1 for a in levels) or any(a >= b for a, b in zip(levels, levels[1:], strict=False)):
            raise ValueError("levels must rise within 0..1")

    @property
    def levels(self) -> tuple[float, ...]:
        return (self.low, *(self.band or ()), self.high)


EXTREME_MIDDLE = Tiers(0.20, 0.80, (0.40, 0.60))


def counted(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Each group's values (_g0 and so on, _v) and how often they come (_c), null too, dealt out in ranges (_p) and stored."""
    g = [F.col(c).alias(f"_g{k}") for k, c in enumerate(group)]
    return _ranged(df.groupBy(*g, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c")), len(group))


def _ranged(counts: DataFrame, groups: int) -> DataFrame:
    return cut(counts.repartitionByRange(*(f"_g{k}" for k in range(groups)), "_v").withColumn("_p", F.spark_partition_id()))


def counted_metrics(df: DataFrame, group: str, metrics: list[str]) -> DataFrame:
    """counted() of all metrics in one pass, as groups of their own: _g0 is the group, _g1 the metric."""
    each = df.select(F.col(group).alias("_g0"), F.posexplode(F.array(*(F.col(m).cast("double") for m in metrics))).alias("_at", "_v"))
    counts = each.groupBy("_g0", "_at", "_v").agg(F.count(F.lit(1)).alias("_c"))  # a metric is a number until its values are counted
    return _ranged(counts.select("_g0", F.get(F.array(*map(F.lit, metrics)), F.col("_at")).alias("_g1"), "_v", "_c"), 2)


def quantiles(df: DataFrame, group: list[str], value: str, levels) -> DataFrame:
    """group, n and q: the exact quantiles of each group's values, linear between ranks; without groups one row.

    Values are counted, dealt out in ranges and numbered within them; ranks follow from the ranges' sums. So neither the values of a large group nor the rows of a frequent value meet in one task.
    """
    return quantiles_of(counted(df.where(F.col(value).isNotNull()), group, value), group, levels)


def quantiles_of(counts: DataFrame, group: list[str], levels) -> DataFrame:
    """quantiles() of values that are counted already."""
    keys = [f"_g{k}" for k in range(len(group))]
    ranged = counts.where("_v IS NOT NULL")
    sums = ranged.groupBy(*keys, "_p").agg(F.sum("_c").alias("_t"))
    whole = W.partitionBy(*keys)
    sums = sums.withColumn("_b", F.sum("_t").over(whole.orderBy("_p")) - F.col("_t")).withColumn("_n", F.sum("_t").over(whole)).drop("_t")
    inside = ranged.withColumn("_s", F.sum("_c").over(W.partitionBy(*keys, "_p").orderBy("_v")))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in (*keys, "_p")]
    placed = inside.alias("a").join(sums.alias("b"), same).select(*(f"a.{k}" for k in keys), "_v", "_n", (F.col("_b") + F.col("_s") - F.col("_c")).alias("_from"), (F.col("_b") + F.col("_s")).alias("_to"))
    at = {k: F.lit(float(x)) * (F.col("_n") - 1) for k, x in enumerate(levels)}
    ends = [(f"_{name}{k}", f(x)) for k, x in at.items() for name, f in (("low", F.floor), ("high", F.ceil))]
    found = placed.groupBy(*keys).agg(F.max("_n").alias("_n"), *(F.max(F.when((F.col("_from") <= r) & (r < F.col("_to")), F.col("_v"))).alias(name) for name, r in ends))
    between = [
        F.when(F.col(f"_low{k}") == F.col(f"_high{k}"), F.col(f"_low{k}")).otherwise((F.ceil(x) - x) * F.col(f"_low{k}") + (x - F.floor(x)) * F.col(f"_high{k}")) for k, x in at.items()
    ]
    return found.select(*(F.col(k).alias(c) for k, c in zip(keys, group, strict=True)), F.coalesce("_n", F.lit(0)).alias("n"), F.array(*between).alias("q"))


def boundaries(df: DataFrame, value: str, tiers: Tiers) -> DataFrame:
    """One row: n and the quantiles q of the value over the rows that have one."""
    return quantiles(df, [], value, tiers.levels)


def check_boundaries(bounds: DataFrame, tiers: Tiers) -> list[float]:
    """The boundaries on the driver; too few records or boundaries that don't rise fail."""
    row = bounds.first()
    if row["n"] < tiers.min_records:
        raise ValueError(f"{row['n']} records to calibrate with, {tiers.min_records} needed")
    if any(a >= b for a, b in zip(row["q"], row["q"][1:], strict=False)):
        raise ValueError(f"boundaries don't rise: {row['q']}")
    return list(row["q"])


def speed_tier(value: Column, q: Column, banded: bool) -> Column:
    """slow up to the lowest boundary, then fast from the highest, then normal (within the band, if there is one)."""
    top = F.get(q, F.size(q) - 1)
    middle = value.between(F.get(q, F.lit(1)), F.get(q, F.lit(2))) if banded else F.lit(True)
    return F.when(value.isNull(), None).when(value <= F.get(q, F.lit(0)), "slow").when(value >= top, "fast").when(middle, "normal")


def with_tiers(df: DataFrame, value: str, tiers: Tiers, tier: str = "tier", calibrate: Column | None = None, counts: DataFrame | None = None) -> DataFrame:
    """The rows with their tier; boundaries come from the rows where calibrate holds, or from the value's counts in counted_metrics(). Fails with too few of these, or if boundaries don't rise."""
    if counts is None:
        found = boundaries(df if calibrate is None else df.where(calibrate), value, tiers)
    else:
        found = quantiles_of(_ranged(counts.where(F.col("_g1") == value).groupBy("_v").agg(F.sum("_c").alias("_c")), 0), [], tiers.levels)
    q = check_boundaries(found, tiers)
    return df.withColumn(tier, speed_tier(F.col(value), F.array(*map(F.lit, q)), tiers.band is not None))


def with_proxy_tiers(df: DataFrame, value: str, tiers: Tiers, proxy: str, mixed: str) -> DataFrame:
    """Tiers where proxy rows, which don't calibrate, are slow by what they are, and rows slow by rate, or mixed, have none."""
    out = with_tiers(df, value, tiers, "tier", ~F.col(proxy))
    return out.withColumn("tier", F.when(F.col(proxy), "slow").when((F.col("tier") != "slow") & ~F.col(mixed), F.col("tier")))


@dataclass(frozen=True)
class GroupTiers:
    """Levels and least sizes of thresholds by group."""

    levels: tuple[float, float, float, float] = (0.20, 0.40, 0.60, 0.80)
    min_records: int = 20
    spans: tuple[tuple[tuple[str, ...], float, str], ...] = ()


def group_thresholds(df: DataFrame, group: str, metrics: list[str], tiers: GroupTiers, counts: DataFrame | None = None) -> DataFrame:
    """group, n, an array of thresholds for each metric, and reason: why the group has none. counts: counted_metrics() of df, if there already."""
    counts = counted_metrics(df, group, metrics) if counts is None else counts
    q = quantiles_of(counts, ["_group", "_m"], tiers.levels)
    wide = q.groupBy("_group").agg(*(F.max(F.when(F.col("_m") == m, F.col("q"))).alias(f"q_{m}") for m in metrics))
    sizes = counts.where(F.col("_g1") == metrics[0]).groupBy(F.col("_g0").alias("_size_of")).agg(F.sum("_c").alias("n"))
    out = sizes.join(wide, F.col("_size_of").eqNullSafe(F.col("_group")), "left").select(F.col("_size_of").alias(group), "n", *(f"q_{m}" for m in metrics))
    rules = [("group_too_small", F.col("n") < tiers.min_records)]
    for names, least, reason in tiers.spans:
        spans = [F.get(f"q_{m}", F.lit(3)) - F.get(f"q_{m}", F.lit(0)) for m in names]
        rules.append((reason, (F.least(*spans) if len(spans) > 1 else spans[0]) < least))
    return out.withColumn("reason", first_reason(*rules))


def agreed_tier(metrics: list[str]) -> Column:
    """soft, strong or normal where all metrics agree, else null; the thresholds stand beside the metrics."""
    soft = strong = normal = F.lit(True)
    for m in metrics:
        q = [F.get(f"q_{m}", F.lit(k)) for k in range(4)]
        soft, strong, normal = soft & (F.col(m) <= q[0]), strong & (F.col(m) >= q[3]), normal & F.col(m).between(q[1], q[2])
    return F.when(soft, "soft").when(strong, "strong").when(normal, "normal")


#: Groups of which the thresholds (16 numbers for four metrics) go to every task; more are joined as the planner likes.
_FEW_GROUPS = 10_000


def with_group_tiers(df: DataFrame, group: str, metrics: list[str], tiers: GroupTiers, tier: str = "tier", counts: DataFrame | None = None) -> DataFrame:
    """The rows with their tier by their group's thresholds and tier_reason; a group's thresholds are a row, stored and counted, so that rows aren't dealt out to meet a few of them. counts: as in group_thresholds()."""
    t = cut(group_thresholds(df, group, metrics, tiers, counts).where("reason IS NULL").drop("n", "reason").withColumn("_found", F.lit(True)))
    t = F.broadcast(t) if t.count() <= _FEW_GROUPS else t
    out = df.join(t, group, "left").withColumn(tier, agreed_tier(metrics))
    reason = first_reason(("effort_group_without_threshold", F.col("_found").isNull()), ("effort_metric_disagreement_or_ambiguous", F.col(tier).isNull()))
    return out.withColumn("tier_reason", reason).drop("_found", *(f"q_{m}" for m in metrics))


def conditioned(speed: Column, effort: Column, require_normal_effort: bool = False) -> tuple[Column, Column]:
    """(speed reason, effort reason): why a label isn't emitted given the other one."""
    speed_rules = [("speed_transition_band_excluded", speed.isNull())]
    if require_normal_effort:
        speed_rules.append(("speed_requires_normal_effort", ~effort.eqNullSafe("normal")))
    effort_rules = [("effort_metric_disagreement_or_ambiguous", effort.isNull()), ("effort_speed_transition_band_excluded", speed.isNull()), ("effort_requires_normal_speed", speed != "normal")]
    return first_reason(*speed_rules), first_reason(*effort_rules)
