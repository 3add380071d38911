"""The library's operators over the driver's tables, each with its DuckDB form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import alias, identity, intervals, numbers, text
from tessera.operators import calibrate, gates, rows, sampling
from tessera.plans.registry import query
from tessera.session import cut, table

TOKEN_SQL = "len(regexp_extract_all(text, '[一-鿿]|[A-Za-z0-9]+'))"
RATED_SQL = f"rated AS (SELECT doc_id, source, lang, text, {TOKEN_SQL} AS units, {TOKEN_SQL} / length(text)::DOUBLE AS rate FROM documents WHERE {TOKEN_SQL} >= 4)"


def rated(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of four tokens at least with their tokens per character; stored, as texts are read once and the numbers more often."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", F.char_length("text").alias("size"), text.count_units(F.col("text")).alias("units"))
    return cut(docs).where("units >= 4").withColumn("rate", F.col("units") / F.col("size")).drop("size")


def literal(spark: SparkSession, schema: str, data: list[tuple]) -> DataFrame:
    return spark.createDataFrame(data, schema)


def values_sql(columns: list[str], data: list[tuple]) -> str:
    """The same rows for DuckDB."""

    def one(v) -> str:
        if v is None:
            return "NULL"
        return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(map(one, r)) + ")" for r in data)
    return f"(VALUES {body}) AS t({', '.join(columns)})"


def _tier_sql(levels: list[str], case: str) -> str:
    return f"WITH {RATED_SQL}, b AS (SELECT quantile_cont(rate, [{', '.join(levels)}]) AS q FROM rated) SELECT source, {case} AS tier, count(*) AS n FROM rated, b GROUP BY ALL"


@query("speed_tiers_contiguous", _tier_sql(["1/3.0::DOUBLE", "2/3.0::DOUBLE"], "CASE WHEN rate <= q[1] THEN 'slow' WHEN rate >= q[2] THEN 'fast' ELSE 'normal' END"))
def speed_tiers_contiguous(spark, sf):
    return calibrate.with_tiers(rated(spark, sf), "rate", calibrate.Tiers()).groupBy("source", "tier").agg(F.count(F.lit(1)).alias("n"))


@query("speed_tiers_extreme_middle", _tier_sql(["0.2", "0.4", "0.6", "0.8"], "CASE WHEN rate <= q[1] THEN 'slow' WHEN rate >= q[4] THEN 'fast' WHEN rate BETWEEN q[2] AND q[3] THEN 'normal' END"))
def speed_tiers_extreme_middle(spark, sf):
    return calibrate.with_tiers(rated(spark, sf), "rate", calibrate.EXTREME_MIDDLE).groupBy("source", "tier").agg(F.count(F.lit(1)).alias("n"))


@query(
    "speed_boundaries",
    f"WITH {RATED_SQL} SELECT count(rate) AS n, round(quantile_cont(rate, 0.2), 6) AS q20, round(quantile_cont(rate, 0.8), 6) AS q80, round(min(rate), 6) AS low, round(quantile_cont(rate, 0.5), 6) AS middle, round(max(rate), 6) AS high FROM rated",
)
def speed_boundaries(spark, sf):
    docs = rated(spark, sf)
    out = calibrate.quantiles(docs, [], "rate", (0.2, 0.5, 0.8)).crossJoin(F.broadcast(docs.agg(F.min("rate").alias("low"), F.max("rate").alias("high"))))
    return out.select("n", F.round(F.col("q")[0], 6).alias("q20"), F.round(F.col("q")[2], 6).alias("q80"), F.round("low", 6).alias("low"), F.round(F.col("q")[1], 6).alias("middle"), F.round("high", 6).alias("high"))


@query(
    "slow_proxy_tiers",
    f"WITH {RATED_SQL}, f AS (SELECT *, lang = 'de' AS proxy, lang = 'fr' AS mixed FROM rated), b AS (SELECT quantile_cont(rate, [1/3.0::DOUBLE, 2/3.0::DOUBLE]) AS q FROM f WHERE NOT proxy) "
    "SELECT lang, CASE WHEN proxy THEN 'slow' WHEN rate <= q[1] OR mixed THEN NULL WHEN rate >= q[2] THEN 'fast' ELSE 'normal' END AS tier, count(*) AS n FROM f, b GROUP BY ALL",
)
def slow_proxy_tiers(spark, sf):
    docs = rated(spark, sf).withColumn("proxy", F.col("lang") == "de").withColumn("mixed", F.col("lang") == "fr")
    return calibrate.with_proxy_tiers(docs, "rate", calibrate.Tiers(), "proxy", "mixed").groupBy("lang", "tier").agg(F.count(F.lit(1)).alias("n"))


_GATE_SQL = f"CASE WHEN {TOKEN_SQL} < 4 THEN 'too_few_spoken_units' WHEN length(text) > 8000 THEN 'speech_span_out_of_range' WHEN regexp_matches(text, '[#*$%&|<>]') THEN 'not_clean_text' WHEN {TOKEN_SQL} / length(text)::DOUBLE < 0.15 THEN 'invalid_pause_excluded_cps' END"


def gated(spark, sf):
    docs = table(spark, sf, "documents")
    units, size = text.count_units(F.col("text")), F.char_length("text")
    reason = gates.first_reason(
        ("too_few_spoken_units", units < 4),
        ("speech_span_out_of_range", size > 8000),
        ("not_clean_text", F.col("text").rlike("[#*$%&|<>]")),
        ("invalid_pause_excluded_cps", units / size < 0.15),
    )
    return docs.withColumn("reason", reason)


@query("gate_rejections", f"SELECT {_GATE_SQL} AS reason, count(*) AS n FROM documents WHERE {_GATE_SQL} IS NOT NULL GROUP BY 1")
def gate_rejections(spark, sf):
    return gates.rejections(gated(spark, sf))


@query("gate_survivors", f"SELECT lang, count(*) AS n, sum(length(text)) AS chars FROM documents WHERE {_GATE_SQL} IS NULL GROUP BY 1")
def gate_survivors(spark, sf):
    return gated(spark, sf).where("reason IS NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("chars"))


_EFFORT = "SELECT p_brand AS g, l_quantity AS m1, l_extendedprice AS m2, l_discount * 100 + l_quantity AS m3, l_tax * 100 + l_extendedprice / 1000 AS m4 FROM lineitem JOIN part ON l_partkey = p_partkey"
_METRICS = ["m1", "m2", "m3", "m4"]
_GROUPS = calibrate.GroupTiers(spans=((("m1", "m3"), 3.0, "group_rms_span_too_small"), (("m2", "m4"), 3.0, "group_lufs_span_too_small")))
_THRESHOLDS = "SELECT g, count(*) AS n, " + ", ".join(f"quantile_cont({m}, [0.2, 0.4, 0.6, 0.8]) AS q_{m}" for m in _METRICS) + " FROM e GROUP BY g HAVING count(*) >= 20"


def effort_rows(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    out = lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
    return out.select(F.col("p_brand").alias("g"), F.col("l_quantity").alias("m1"), F.col("l_extendedprice").alias("m2"), (F.col("l_discount") * 100 + F.col("l_quantity")).alias("m3"), (F.col("l_tax") * 100 + F.col("l_extendedprice") / 1000).alias("m4"))


@query("group_thresholds", f"WITH e AS ({_EFFORT}), t AS ({_THRESHOLDS}) SELECT g, n, " + ", ".join(f"round(q_{m}[{k + 1}], 4) AS {m}_{k}" for m in _METRICS for k in range(4)) + " FROM t")
def group_thresholds(spark, sf):
    t = calibrate.group_thresholds(effort_rows(spark, sf), "g", _METRICS, _GROUPS).where("reason IS NULL")
    return t.select("g", "n", *(F.round(F.get(f"q_{m}", F.lit(k)), 4).alias(f"{m}_{k}") for m in _METRICS for k in range(4)))


#: What the SQL's inner join with the thresholds keeps.
_HAS_THRESHOLD = "tier_reason IS DISTINCT FROM 'effort_group_without_threshold'"


def _all(test: str) -> str:
    return " AND ".join(test.format(m=m) for m in _METRICS)


_AGREED = f"CASE WHEN {_all('{m} <= q_{m}[1]')} THEN 'soft' WHEN {_all('{m} >= q_{m}[4]')} THEN 'strong' WHEN {_all('{m} BETWEEN q_{m}[2] AND q_{m}[3]')} THEN 'normal' END"


@query("effort_agreement", f"WITH e AS ({_EFFORT}), t AS ({_THRESHOLDS}) SELECT g, {_AGREED} AS tier, count(*) AS n FROM e JOIN t USING (g) GROUP BY ALL")
def effort_agreement(spark, sf):
    out = calibrate.with_group_tiers(effort_rows(spark, sf), "g", _METRICS, _GROUPS).where(_HAS_THRESHOLD)
    return out.groupBy("g", "tier").agg(F.count(F.lit(1)).alias("n"))


@query(
    "effort_rejections",
    f"WITH e AS ({_EFFORT}), t AS ({_THRESHOLDS}) SELECT CASE WHEN t.g IS NULL THEN 'effort_group_without_threshold' ELSE 'effort_metric_disagreement_or_ambiguous' END AS reason, count(*) AS n FROM e LEFT JOIN t USING (g) WHERE {_AGREED} IS NULL GROUP BY 1",
)
def effort_rejections(spark, sf):
    return gates.rejections(calibrate.with_group_tiers(effort_rows(spark, sf), "g", _METRICS, _GROUPS), "tier_reason")


@query(
    "conditioned_controls",
    f"WITH e AS ({_EFFORT}), t AS ({_THRESHOLDS}), b AS (SELECT quantile_cont(m2, [0.2, 0.4, 0.6, 0.8]) AS q FROM e), "
    f"l AS (SELECT {_AGREED} AS effort, CASE WHEN m2 <= q[1] THEN 'slow' WHEN m2 >= q[4] THEN 'fast' WHEN m2 BETWEEN q[2] AND q[3] THEN 'normal' END AS speed FROM e JOIN t USING (g), b) "
    "SELECT CASE WHEN speed IS NULL THEN 'speed_transition_band_excluded' WHEN effort IS DISTINCT FROM 'normal' THEN 'speed_requires_normal_effort' END AS speed_reason, "
    "CASE WHEN effort IS NULL THEN 'effort_metric_disagreement_or_ambiguous' WHEN speed IS NULL THEN 'effort_speed_transition_band_excluded' WHEN speed <> 'normal' THEN 'effort_requires_normal_speed' END AS effort_reason, count(*) AS n FROM l GROUP BY ALL",
)
def conditioned_controls(spark, sf):
    lines = effort_rows(spark, sf)
    counts = calibrate.counted_metrics(lines, "g", _METRICS)
    out = calibrate.with_group_tiers(lines, "g", _METRICS, _GROUPS, "effort", counts)
    out = calibrate.with_tiers(out, "m2", calibrate.EXTREME_MIDDLE, "speed", counts=counts)
    speed, effort = calibrate.conditioned(F.col("speed"), F.col("effort"), True)
    return out.where(_HAS_THRESHOLD).groupBy(speed.alias("speed_reason"), effort.alias("effort_reason")).agg(F.count(F.lit(1)).alias("n"))


@query("dedup_keep_first", "SELECT doc_id, source, lang FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def dedup_keep_first(spark, sf):
    return rows.keep_first(table(spark, sf, "documents").select("doc_id", "source", "lang", F.sha2("text", 256).alias("k")), ["k"], ["doc_id"]).drop("k")


@query("duplicate_first_line", "SELECT * FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first_line FROM documents) WHERE first_line < doc_id")
def duplicate_first_line(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("k"))
    return rows.first_of_key(docs, ["k"], "doc_id", "first_line").where("first_line < doc_id").select("doc_id", "first_line")


@query("shard_mod", "SELECT doc_id % 4 AS shard, count(*) AS n, min(doc_id) AS low FROM documents GROUP BY 1")
def shard_mod(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    parts = [rows.shard(docs, "doc_id", 4, k).select(F.lit(k).cast("long").alias("shard"), "doc_id") for k in range(4)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"))


@query("semi_approved", "SELECT doc_id, source FROM documents SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) USING (doc_id)")
def semi_approved(spark, sf):
    keys = table(spark, sf, "labels").where("quality = 1")
    return rows.approved(table(spark, sf, "documents").select("doc_id", "source"), keys, "doc_id")


@query("anti_excluded", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) AND source NOT IN (SELECT 'src' || quality FROM labels)")
def anti_excluded(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    toxic = table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("k"))
    named = table(spark, sf, "labels").select(F.concat(F.lit("src"), F.col("quality").cast("string")).alias("k"))
    return rows.excluded(docs, F.array(F.col("doc_id").cast("string"), F.col("source")), toxic.unionByName(named), "k")


@query("replay_union", "SELECT role, count(*) AS n, sum(doc_id) AS ids FROM (SELECT 'control' AS role, doc_id FROM labels WHERE quality = 1 UNION ALL SELECT 'replay', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)) GROUP BY 1")
def replay_union(spark, sf):
    controls = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    replay = table(spark, sf, "documents").select("doc_id").join(controls, "doc_id", "left_anti")
    both = controls.withColumn("role", F.lit("control")).unionByName(replay.withColumn("role", F.lit("replay")))
    return both.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


@query("replay_quota", "SELECT n, CASE WHEN n % 2 = 0 OR (n // 2) % 2 = 1 THEN (n + 1) // 2 ELSE n // 2 END AS half FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)")
def replay_quota(spark, sf):
    counts = table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("n", numbers.quota(F.col("n"), 0.5).alias("half"))


_POOL = "SELECT source AS g, 'doc/' || doc_id AS path, row_number() OVER (PARTITION BY source ORDER BY abs(length(text) - 1000), doc_id) AS r FROM documents"


@query(
    "reference_pool_pick",
    f"WITH pool AS (SELECT * FROM ({_POOL}) WHERE r <= 3), t AS (SELECT doc_id, source AS g, 'doc/' || doc_id AS path FROM documents), "
    "can AS (SELECT doc_id, t.path AS own, list(pool.path ORDER BY r) FILTER (pool.path <> t.path) AS c FROM t JOIN pool USING (g) GROUP BY ALL) "
    "SELECT doc_id, CASE WHEN len(c) > 0 THEN c[(('0x' || substr(sha256(doc_id::VARCHAR), 1, 16))::UBIGINT % len(c)::UBIGINT)::INT + 1] ELSE own END AS ref_audio, "
    "CASE WHEN len(c) > 0 THEN 'same_recording_group_clean_reference' ELSE 'self_reference_no_same_group_pool' END AS ref_policy FROM can",
)
def reference_pool_pick(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("g"), F.abs(F.char_length("text") - 1000).alias("far"), F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"))
    pool = rows.reference_pool(docs, "g", ["far", "doc_id"], 3)
    out = rows.attach_reference(docs.select("doc_id", "g", "path"), pool, "g", F.col("path"), F.col("doc_id").cast("string"))
    return out.select("doc_id", "ref_audio", "ref_policy")


@query("fixed_reference", "SELECT doc_id, CASE WHEN source = 'src1' THEN (SELECT 'doc/' || min(doc_id) FROM documents WHERE source = 'src2') END AS ref_audio FROM documents")
def fixed_reference(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    refs = docs.select("doc_id", "source", F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"))
    return rows.attach_fixed(docs, refs, "source", "src2", "doc_id", "path", F.col("source") == "src1").select("doc_id", "ref_audio")


@query("topk_per_tag", "SELECT o_orderpriority, o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 10")
def topk_per_tag(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return rows.top_k(orders, ["o_orderpriority"], [F.desc("o_totalprice"), "o_orderkey"], 10)


@query(
    "closest_to_median",
    "WITH m AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.5) AS median FROM orders GROUP BY 1), n AS (SELECT o.o_orderpriority, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o.o_orderpriority ORDER BY abs(o_totalprice - median), o_orderkey) AS near FROM orders o JOIN m USING (o_orderpriority)) "
    "SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS rank FROM n WHERE near <= 10",
)
def closest_to_median(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return rows.closest_to_median(orders, "o_orderpriority", "o_totalprice", "o_orderkey", 10).select("o_orderpriority", "o_orderkey", "rank")


@query("ordered_output", "SELECT doc_id, row_number() OVER (ORDER BY source, lang, doc_id) - 1 AS ordinal FROM documents WHERE length(text) > 500")
def ordered_output(spark, sf):
    from tessera.sources.jsonl import with_ordinal

    docs = table(spark, sf, "documents").where(F.char_length("text") > 500).select("doc_id", "source", "lang")
    return with_ordinal(docs, ["source", "lang", "doc_id"]).select("doc_id", "ordinal")


@query("value_summary", "SELECT event_type, min(value) AS low, round(quantile_cont(value, 0.5), 6) AS middle, max(value) AS high, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def value_summary(spark, sf):
    events = table(spark, sf, "events")
    ends = events.groupBy("event_type").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count_distinct("user_id").alias("users"))
    middle = calibrate.quantiles(events, ["event_type"], "value", [0.5]).select("event_type", F.round(F.col("q")[0], 6).alias("middle"))
    return ends.join(middle, "event_type", "left").select("event_type", "low", "middle", "high", "users")


_SECONDS = "epoch_us(ts) / 1000000.0"


@query(
    "event_gaps_pause_excluded",
    f"WITH t AS (SELECT user_id, {_SECONDS} AS s FROM events), g AS (SELECT user_id, s, s - lag(s) OVER (PARTITION BY user_id ORDER BY s) AS gap FROM t) "
    "SELECT user_id, count(*) AS n, count(*) FILTER (gap >= 7200) AS pauses, round(coalesce(sum(gap) FILTER (gap >= 7200), 0), 3) AS pause_sec, round(max(s) - min(s) - coalesce(sum(gap) FILTER (gap >= 7200), 0), 3) AS kept_sec FROM g GROUP BY 1",
)
def event_gaps_pause_excluded(spark, sf):
    from pyspark.sql import Window as W

    t = table(spark, sf, "events").select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("s"))
    g = t.withColumn("gap", F.col("s") - F.lag("s").over(W.partitionBy("user_id").orderBy("s")))
    long = F.coalesce(F.sum(F.when(F.col("gap") >= 7200, F.col("gap"))), F.lit(0.0))
    return g.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("gap") >= 7200).alias("pauses"), F.round(long, 3).alias("pause_sec"), F.round(F.max("s") - F.min("s") - long, 3).alias("kept_sec"))


@query(
    "interval_merge",
    f"WITH t AS (SELECT user_id, {_SECONDS} AS s, {_SECONDS} + 60 * abs(value) AS e FROM events WHERE value <> 0), o AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM t), "
    "i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM o), m AS (SELECT user_id, island, max(e) - min(s) AS d FROM i GROUP BY ALL) "
    "SELECT user_id, count(*) AS islands, round(sum(d), 2) AS covered FROM m GROUP BY 1",
)
def interval_merge(spark, sf):
    s = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    t = table(spark, sf, "events").where("value <> 0").select("user_id", F.struct(s.alias("s"), (s + 60 * F.abs("value")).alias("e")).alias("i"))
    merged = t.groupBy("user_id").agg(intervals.merge(F.collect_list("i")).alias("m"))
    return merged.select("user_id", F.size("m").cast("long").alias("islands"), F.round(intervals.duration(F.col("m")), 2).alias("covered"))


_MARKED = [(1, "【Happy_low】你好 [breath] Hello 42"), (2, "【sad】【angry】<cry>no</cry> [Hold]"), (3, "plain text"), (4, ""), (5, None), (6, "【speed_slow】【calm】<stress>so</stress> [laugh][laugh]")]


@query(
    "token_units",
    "SELECT doc_id AS id, " + TOKEN_SQL + " AS units FROM documents UNION ALL SELECT id, coalesce(len(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '【[^】]+】', '', 'g'), '\\[[^\\]]+\\]', '', 'g'), '</?[^>]+>', '', 'g'), '[一-鿿]|[A-Za-z0-9]+')), 0) FROM " + values_sql(["id", "text"], [(-i, t) for i, t in _MARKED]),
)
def token_units(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    marked = literal(spark, "id long, text string", [(-i, t) for i, t in _MARKED])
    return docs.unionByName(marked).select("id", text.count_units(text.clean_spoken_text("text")).alias("units"))


_FAMILY_WANT = [(1, "happy", "breath"), (2, "transition", "cry,hold"), (3, "no_emotion", ""), (4, "no_emotion", ""), (5, "no_emotion", ""), (6, "calm", "laugh")]


@query("emotion_family", f"SELECT id, family FROM {values_sql(['id', 'family', 'events'], _FAMILY_WANT)} UNION ALL SELECT doc_id + 100, 'no_emotion' FROM documents")
def emotion_family(spark, sf):
    marked = literal(spark, "id long, text string", _MARKED)
    docs = table(spark, sf, "documents").select((F.col("doc_id") + 100).alias("id"), "text")
    return marked.unionByName(docs).select("id", text.emotion_family("text").alias("family"))


@query("event_tags", f"SELECT id, events FROM {values_sql(['id', 'family', 'events'], _FAMILY_WANT)}")
def event_tags(spark, sf):
    return literal(spark, "id long, text string", _MARKED).select("id", F.array_join(text.event_tags("text"), ",").alias("events"))


@query("normalized_transcripts", "SELECT doc_id, md5(regexp_replace(lower(text), '[^A-Za-z0-9一-鿿]+', '', 'g')) AS digest FROM documents")
def normalized_transcripts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.normalized(text.clean_spoken_text("text"))).alias("digest"))


@query(
    "cer_pairs",
    "WITH d AS (SELECT doc_id, regexp_replace(text, '[^a-zA-Z ]', '', 'g') AS a FROM documents), b AS (SELECT item_id, regexp_replace(text, '[^a-zA-Z ]', '', 'g') AS b FROM benchmark) "
    "SELECT doc_id, item_id, round(levenshtein(a, b) / length(a)::DOUBLE, 6) AS cer FROM d JOIN b ON doc_id % 40 = item_id WHERE length(a) > 0",
)
def cer_pairs(spark, sf):
    kept = lambda c: F.array_join(F.regexp_extract_all(c, F.lit("[a-zA-Z ]+"), F.lit(0)), "")  # noqa: E731  runs are found faster than what lies between them is replaced
    d = table(spark, sf, "documents").where(F.col("text").rlike("[a-zA-Z ]")).select("doc_id", kept("text").alias("a"))
    b = table(spark, sf, "benchmark").select("item_id", kept("text").alias("b"))
    out = d.join(b, F.pmod("doc_id", F.lit(40)) == F.col("item_id"))
    return out.select("doc_id", "item_id", F.round(text.character_error_rate(F.col("a"), F.col("b")), 6).alias("cer"))


@query(
    "audio_metrics_array",
    "WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a FROM embeddings) SELECT vec_id, round(sqrt(list_sum(list_transform(a, lambda x: x * x)) / len(a)), 6) AS rms, round(list_max(list_transform(a, lambda x: abs(x))), 6) AS peak, "
    "round(20 * log10(list_max(list_transform(a, lambda x: abs(x)))), 4) AS peak_dbfs, len(list_filter(a, lambda x: abs(x) >= 0.3)) / len(a)::DOUBLE AS clipping FROM v",
)
def audio_metrics_array(spark, sf):
    a = F.transform("embedding", lambda x: x.cast("double"))
    v = table(spark, sf, "embeddings").select("vec_id", a.alias("a"))
    v = v.withColumn("peak", F.array_max(F.transform("a", F.abs))).withColumn("rms", F.sqrt(intervals.total(F.transform("a", lambda x: x * x)) / F.size("a")))
    loud = F.size(F.filter("a", lambda x: F.abs(x) >= 0.3)) / F.size("a")
    return v.select("vec_id", F.round("rms", 6).alias("rms"), F.round("peak", 6).alias("peak"), F.round(numbers.dbfs(F.col("peak")), 4).alias("peak_dbfs"), loud.alias("clipping"))


@query("array_quantiles", "SELECT vec_id, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.9) - quantile_cont(x, 0.1), 6) AS span FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY 1")
def array_quantiles(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("a"))
    q = {k: intervals.quantile(F.col("a"), k) for k in (0.1, 0.25, 0.5, 0.9)}
    return v.select("vec_id", F.round(q[0.25], 6).alias("p25"), F.round(q[0.5], 6).alias("p50"), F.round(q[0.9] - q[0.1], 6).alias("span"))


@query("peak_ceiling", "WITH v AS (SELECT vec_id, list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))) AS peak FROM embeddings) SELECT vec_id, round(least(1.0, 0.25 / peak), 6) AS factor, round(least(6.0, 20 * log10(0.25 / peak)), 4) AS gain_db FROM v")
def peak_ceiling(spark, sf):
    peak = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
    v = table(spark, sf, "embeddings").select("vec_id", peak.alias("peak"))
    return v.select("vec_id", F.round(F.least(F.lit(1.0), 0.25 / F.col("peak")), 6).alias("factor"), F.round(F.least(F.lit(6.0), numbers.dbfs(0.25 / F.col("peak"))), 4).alias("gain_db"))


@query("frame_windows", "WITH f AS (SELECT vec_id, embedding AS a, unnest([1, 17, 33, 49]) AS s FROM embeddings) SELECT vec_id, s - 1 AS first, round(sqrt(list_sum(list_transform(a[s:s + 15], lambda x: x::DOUBLE * x::DOUBLE)) / 16), 6) AS rms FROM f")
def frame_windows(spark, sf):
    frames = table(spark, sf, "embeddings").select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(48), F.lit(16))).alias("first"))
    frame = F.slice("embedding", F.col("first") + 1, F.lit(16))
    return frames.select("vec_id", "first", F.round(F.sqrt(intervals.total(F.transform(frame, lambda x: x.cast("double") * x.cast("double"))) / 16), 6).alias("rms"))


_VARIANTS = [("plain", ""), *((t, f"【{t}】") for t in text.CONTROL_TAGS)]


@query("eval_variants", f"SELECT conv_id, turn, variant, prefix || text AS text FROM conversations, {values_sql(['variant', 'prefix'], _VARIANTS)}")
def eval_variants(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return rows.variants(turns, _VARIANTS).select("conv_id", "turn", "variant", F.concat("prefix", "text").alias("text"))


_STAGE = [
    (1, "control", "【speed_slow】a", "speed_slow", "x/a.wav", "r.wav"),
    (2, "control", "【speed_slow】b", "speed_slow", "x/./a.wav", "r.wav"),
    (3, "control", "【speed_slow】【speed_fast】c", "speed_slow", "c.wav", "c.wav"),
    (4, "replay", "d", None, "", None),
    (5, "control", "【effort_soft】e", "effort_strong", "e.wav", "d/../E.wav"),
    (6, "replay", "【loud】f", None, "f.wav", "r.wav"),
]
_FAILED = [(2, "duplicate_control_audio_and_tag"), (3, "multiple_tags_in_dimension"), (3, "control_row_requires_one_tag"), (3, "declared_control_tag_does_not_match_text"), (3, "self_reference_audio"), (4, "missing_audio"), (4, "missing_ref_audio"), (5, "declared_control_tag_does_not_match_text"), (5, "self_reference_audio"), (6, "legacy_v3_control_tag")]


@query("validation_failures", f"SELECT line, reason FROM {values_sql(['line', 'reason'], _FAILED)} UNION ALL SELECT doc_id + 100, 'missing_ref_audio' FROM documents")
def validation_failures(spark, sf):
    staged = literal(spark, "line long, control_dataset_role string, text string, control_tag string, audio string, ref_audio string", _STAGE)
    null = F.lit(None).cast("string")
    docs = table(spark, sf, "documents").select((F.col("doc_id") + 100).alias("line"), F.lit("replay").alias("control_dataset_role"), "text", null.alias("control_tag"), F.concat(F.lit("d/"), F.col("doc_id").cast("string")).alias("audio"), null.alias("ref_audio"))
    return rows.validation_failures(staged.unionByName(docs), "line", need_reference=True).select("line", "reason")


@query("codec_shapes", "SELECT vec_id, vec_id % 3 <> 0 AS valid FROM embeddings")
def codec_shapes(spark, sf):
    width = F.when(F.pmod("vec_id", F.lit(3)) == 0, 15).otherwise(16)
    codes = F.array(F.slice("embedding", F.lit(1), F.lit(16)), F.slice("embedding", F.lit(1), width))
    return table(spark, sf, "embeddings").select("vec_id", rows.valid_codes(codes).alias("valid"))


@query("stratum_sizes", "SELECT lang AS tag, source, CASE WHEN length(text) < 1000 THEN 'short' WHEN length(text) < 3000 THEN 'medium' ELSE 'long' END AS bin, count(*) AS size FROM documents GROUP BY ALL")
def stratum_sizes(spark, sf):
    return stratified_docs(spark, sf).groupBy("tag", "source", "bin").agg(F.count(F.lit(1)).alias("size"))


def stratified_docs(spark, sf):
    n = F.char_length("text")
    return table(spark, sf, "documents").select("doc_id", F.col("lang").alias("tag"), "source", F.when(n < 1000, "short").when(n < 3000, "medium").otherwise("long").alias("bin"))


@query("stratum_quota")
def stratum_quota(spark, sf):
    return sampling.quotas(stratified_docs(spark, sf), "tag", ["source", "bin"])


@query("balanced_sample", "SELECT lang AS tag, (SELECT min(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang)) AS n FROM documents GROUP BY 1")
def balanced_sample(spark, sf):
    return sampling.stratified(stratified_docs(spark, sf), "tag", ["source", "bin"], "doc_id", 42).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query("uniform_sample", "SELECT least(50, count(*)) AS n FROM documents WHERE length(text) > 200")
def uniform_sample(spark, sf):
    docs = table(spark, sf, "documents").where(F.char_length("text") > 200).select("doc_id")
    return sampling.uniform(docs, "doc_id", 42, 50).agg(F.count(F.lit(1)).alias("n"))


@query("balanced_cap", "SELECT min(n) AS cap FROM (SELECT count(*) AS n FROM documents GROUP BY lang, source)")
def balanced_cap(spark, sf):
    return table(spark, sf, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")).agg(F.min("n").alias("cap"))


@query("required_tags_missing", "SELECT unnest(['en', 'fr', 'de', 'es', 'it', 'nl']) AS tag EXCEPT SELECT lang FROM documents")
def required_tags_missing(spark, sf):
    wanted = literal(spark, "tag string", [(x,) for x in ("en", "fr", "de", "es", "it", "nl")])
    return wanted.join(table(spark, sf, "documents").select(F.col("lang").alias("tag")).distinct(), "tag", "left_anti")


@query("key_union", "SELECT doc_id::VARCHAR AS key FROM labels UNION SELECT item_id::VARCHAR FROM benchmark UNION SELECT 'src' || quality FROM labels")
def key_union(spark, sf):
    labels = table(spark, sf, "labels")
    parts = [labels.select(F.col("doc_id").cast("string").alias("key")), table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("key")), labels.select(F.concat(F.lit("src"), F.col("quality").cast("string")).alias("key"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


@query("stable_hash_pick", "SELECT doc_id, (('0x' || substr(sha256(doc_id::VARCHAR), 1, 16))::UBIGINT % 7::UBIGINT)::INT AS pick FROM documents")
def stable_hash_pick(spark, sf):
    return table(spark, sf, "documents").select("doc_id", identity.stable_index(F.col("doc_id").cast("string"), F.lit(7)).alias("pick"))


_PATHS = [("a/./b/../c.wav", "a/c.wav"), ("\\\\srv\\x\\..\\y", "//srv/y"), ("/r//s/", "/r/s"), ("..\\up", "../up"), (".", ".")]


@query("path_keys", f"SELECT raw, path FROM {values_sql(['raw', 'path'], _PATHS)} UNION ALL SELECT url, regexp_replace(regexp_replace(url, '/+', '/', 'g'), '/$', '') FROM pages")
def path_keys(spark, sf):
    raw = literal(spark, "raw string", [(r,) for r, _ in _PATHS]).unionByName(table(spark, sf, "pages").select(F.col("url").alias("raw")))
    return raw.select("raw", identity.collapse(F.col("raw")).alias("path"))


_ALIASED = [('{"cer": null, "metrics": {"asr_cer": 0.25}}', 0.25), ('{"asr_cer": "x", "cer": 0.5}', None), ('{"alignment": {"cer": 1}}', 1.0)]


@query("alias_lookup", f"SELECT id, cer FROM {values_sql(['id', 'cer'], [(i, c) for i, (_, c) in enumerate(_ALIASED)])} UNION ALL SELECT event_id + 10, json_extract(props, '$.k')::DOUBLE FROM events")
def alias_lookup(spark, sf):
    made = literal(spark, "id long, t string", [(i, t) for i, (t, _) in enumerate(_ALIASED)]).select("id", F.parse_json("t").alias("v"))
    events = table(spark, sf, "events").select((F.col("event_id") + 10).alias("id"), F.parse_json("props").alias("v"))
    both = made.select("id", alias.number(F.col("v"), "asr_cer").alias("cer"))
    return both.unionByName(events.select("id", numbers.finite(alias.as_string(alias.lookup(F.col("v"), ("k",)))).alias("cer")))


@query("duration_bins", "SELECT CASE WHEN l_quantity < 3 THEN 'short' WHEN l_quantity < 8 THEN 'medium' ELSE 'long' END AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def duration_bins(spark, sf):
    return table(spark, sf, "lineitem").groupBy(text.duration_bin(F.col("l_quantity")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("destination_names", "SELECT doc_id, source || '__' || doc_id || '__' || substr(sha256('None|' || source || '|' || doc_id || '|a/b.WAV'), 1, 12) || '.wav' AS name FROM documents")
def destination_names(spark, sf):
    return table(spark, sf, "documents").select("doc_id", identity.destination_name(F.lit(None).cast("string"), F.col("source"), F.col("doc_id").cast("string"), F.lit("a/b.WAV")).alias("name"))


@query("review_ids", "SELECT doc_id, source || '-' || lpad((row_number() OVER (PARTITION BY source ORDER BY doc_id))::VARCHAR, 4, '0') AS review_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20")
def review_ids(spark, sf):
    top = rows.top_k(table(spark, sf, "documents").select("doc_id", "source"), ["source"], ["doc_id"], 20)
    return top.select("doc_id", F.format_string("%s-%04d", "source", "rank").alias("review_id"))


@query("final_statuses", "SELECT doc_id, CASE WHEN doc_id % 3 <> 0 AND doc_id % 5 <> 0 THEN 'ok' WHEN doc_id % 5 <> 0 THEN 'partial' ELSE 'failed' END AS status, nullif(concat_ws('; ', CASE WHEN doc_id % 3 = 0 THEN 'asr: missing' END, CASE WHEN doc_id % 5 = 0 THEN 'alignment: bad' END), '') AS error FROM documents")
def final_statuses(spark, sf):
    k = F.col("doc_id")
    asr, aligned = F.when(k % 3 == 0, "missing").otherwise("ok"), F.when(k % 5 == 0, "error").otherwise("ok")
    status, error = gates.final_status([("asr", asr, F.lit(None).cast("string")), ("alignment", aligned, F.lit("bad"))], "alignment")
    return table(spark, sf, "documents").select("doc_id", status.alias("status"), error.alias("error"))


@query("cjk_filter", "SELECT id, ok FROM (VALUES (1, true), (2, false), (3, false), (4, false)) AS t(id, ok) UNION ALL SELECT doc_id + 10, false FROM documents")
def cjk_filter(spark, sf):
    made = literal(spark, "id long, text string", [(1, "你好，世界。"), (2, "你好 world"), (3, "你好3"), (4, "，。")])
    docs = table(spark, sf, "documents").select((F.col("doc_id") + 10).alias("id"), "text")
    return made.unionByName(docs).select("id", text.is_cjk_only(F.col("text")).alias("ok"))


@query("audio_measures")
def audio_measures(spark, sf):
    from tessera.operators import recordings

    return recordings.measured_samples(table(spark, sf, "embeddings"), "vec_id", "embedding", 2000)


@query("character_alignment", "SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]+')) AS n FROM documents")
def character_alignment(spark, sf):
    from tessera.operators import recordings

    units = table(spark, sf, "documents").select("doc_id", F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)).alias("e"))
    seen = F.transform("e", lambda x, k: F.struct(F.lower(x).alias("character"), (k * 0.1).cast("double").alias("start"), (k * 0.1 + 0.1).cast("double").alias("end"), F.lit(1.0).alias("score")))
    docs = units.select("doc_id", "e", seen.alias("o"), F.lit(1e9).alias("d"))
    return recordings.align_characters(docs, "doc_id", "e", "o", "d").select("doc_id", F.col("timed").alias("n"))


@query(
    "review_list",
    "WITH t AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'speed_fast' WHEN '5-LOW' THEN 'speed_slow' ELSE 'speed_normal' END AS control_tag, o_orderkey::VARCHAR AS id, o_totalprice AS v FROM orders), "
    "m AS (SELECT quantile_cont(v, 0.5) AS median FROM t WHERE control_tag = 'speed_normal'), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY control_tag ORDER BY CASE control_tag WHEN 'speed_fast' THEN -v WHEN 'speed_slow' THEN v ELSE abs(v - median) END, id) AS k FROM t, m) "
    "SELECT control_tag, id, row_number() OVER (PARTITION BY control_tag ORDER BY CASE control_tag WHEN 'speed_fast' THEN -v ELSE v END, id) AS rank FROM r WHERE k <= 20",
)
def review_list(spark, sf):
    from tessera.plans import curation

    tag = F.when(F.col("o_orderpriority") == "1-URGENT", "speed_fast").when(F.col("o_orderpriority") == "5-LOW", "speed_slow").otherwise("speed_normal")
    found = table(spark, sf, "orders").select(tag.alias("control_tag"), F.col("o_orderkey").cast("string").alias("control_candidate_id"), F.col("o_totalprice").alias("sort_value"))
    return curation.review_list(found, 20).select("control_tag", F.col("control_candidate_id").alias("id"), "rank")
