"""Gates, calibration, row operators, sampling and line sources on small tables."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import calibrate, gates, rows, sampling
from tessera.sources import jsonl


def record(**more):
    base = dict(status="ok", asr_cer=0.05, alignment_coverage=1.0, text="你好世界", speech_start_sec=0.0, speech_end_sec=2.0, speech_vad_active_duration_sec=1.5, pause_excluded_cps=2.0, character_timestamps=[{"start": 0, "end": 1, "score": 0.9}, {"start": 1, "end": 2, "score": 0.8}])
    return json.dumps({k: v for k, v in (base | more).items() if v != "drop"})


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, None),
        ({"status": "failed"}, "alignment_not_successful"),
        ({"status": ""}, "alignment_not_successful"),
        ({"status": "drop"}, None),
        ({"asr_cer": None}, "missing_asr_cer"),
        ({"asr_cer": 0.5}, "asr_cer_out_of_range"),
        ({"alignment_coverage": "drop"}, "missing_alignment_coverage"),
        ({"alignment_coverage": 1.01}, "alignment_coverage_out_of_range"),
        ({"text": "你好"}, "too_few_spoken_units"),
        ({"character_timestamps": []}, "missing_character_timestamps"),
        ({"speech_end_sec": 0.0}, "invalid_speech_boundaries"),
        ({"speech_span_sec": 1.0}, "inconsistent_speech_span"),
        ({"speech_end_sec": 0.5}, "speech_span_out_of_range"),
        ({"speech_vad_active_duration_sec": "drop"}, "missing_vad_active_duration"),
        ({"speech_vad_active_duration_sec": 3.0}, "invalid_vad_active_duration"),
        ({"speech_vad_active_ratio": 0}, "invalid_vad_active_ratio"),
        ({"speech_vad_active_duration_sec": 0.3}, "vad_active_ratio_too_low"),
        ({"pause_ratio": 2}, "invalid_pause_ratio"),
        ({"pause_ratio": 0.7}, "pause_ratio_too_high"),
        ({"pause_excluded_cps": "x"}, "missing_pause_excluded_cps"),
        ({"pause_excluded_cps": 0}, "invalid_pause_excluded_cps"),
        ({"vad_active_duration_sec": 0}, "invalid_full_audio_vad_active_duration"),
        ({"vad_active_duration_sec": 3, "duration": 2}, "full_audio_vad_duration_exceeds_audio"),
    ],
)
def test_alignment_gate(spark, change, reason):
    df = spark.createDataFrame([(record(**change),)], "t string").select(F.parse_json("t").alias("record"))
    assert gates.with_alignment(df).select("alignment_reason").first()[0] == reason


def test_speed_gate(spark):
    df = spark.createDataFrame([(record(),), (record(text="four plain words here"),), (record(text="你好世界[breath][breath][breath]"),)], "t string").select(F.parse_json("t").alias("record"))
    out = gates.with_alignment(df).withColumn("said", F.try_variant_get("record", "$.text", "string"))
    assert [r[0] for r in out.select(gates.speed_reason(gates.SpeedGate(), F.col("said"))).collect()] == [None, "non_cjk_speed_control", None]
    loose = gates.SpeedGate(min_units=2, max_breaths=2, check_scores=True, max_low_score_ratio=0.1)
    assert [r[0] for r in out.select(gates.speed_reason(loose, F.col("said"))).collect()] == [None, "non_cjk_speed_control", "speed_too_many_breath_events"]
    assert {r[0] for r in out.select(gates.speed_reason(gates.CLEAN_SPEED, F.col("said"))).collect()} == {"speed_too_few_spoken_units", "non_cjk_speed_control"}
    with pytest.raises(ValueError):
        gates.SpeedGate(check_scores=True)


def test_style_and_generated(spark):
    rows_ = [("a", "x/whisper/a.wav", None, 0.1), ("a", "x/朗诵/a.wav", None, 0.1), ("[laugh]a", "a.wav", None, 0.1), ("[breath]a", "a.wav", None, None), ("a", "a.wav", None, 2.0), ("a", "a.wav", None, 0.5), ("a", "a.wav", "by FFmpeg", 0.1)]
    df = spark.createDataFrame(rows_, "text string, audio string, generated_by string, ratio double")
    assert [r[0] for r in df.select(gates.style_reason(df, F.col("ratio"))).collect()] == ["whisper_style", "speed_style_excluded", "speed_style_excluded", "missing_paralinguistic_ratio", "invalid_paralinguistic_ratio", "long_paralinguistic_ratio", None]
    assert [r[0] for r in df.select(gates.is_generated(df)).collect()] == [False] * 6 + [True]


def test_effort_gate(spark):
    base = (-20.0, -18.0, -22.0, -20.0, None, 0.0, 6.0, -50.0, 20.0)
    changes = [{}, {2: None}, {0: None}, {5: 0.1}, {6: 3.0}, {7: -10.0}, {8: 5.0}, {8: None}, {2: None, 4: -19.0}]
    data = [tuple(c.get(k, v) for k, v in enumerate(base)) for c in changes]
    df = spark.createDataFrame(data, "rms_p25 double, rms_p50 double, lufs_p25 double, lufs_p50 double, integrated_lufs double, clipping_ratio double, dynamic_range double, noise_floor double, snr double")
    assert [r["effort_reason"] for r in gates.with_effort(df).collect()] == [None, "missing_active_lufs_metrics", "missing_active_effort_metrics", "clipping_ratio_out_of_range", "dynamic_range_too_low", "noise_floor_too_high", "snr_too_low", None, "missing_active_lufs_metrics"]
    assert gates.with_effort(df, gates.EffortGate(integrated_fallback=True)).collect()[8]["effort_reason"] is None


def test_extreme_middle(spark):
    df = spark.createDataFrame([(float(k),) for k in range(1, 11)], "v double")
    got = {r["v"]: r["tier"] for r in calibrate.with_tiers(df, "v", calibrate.Tiers(0.20, 0.80, (0.40, 0.60), 10)).collect()}
    assert {k for k, t in got.items() if t == "slow"} == {1, 2} and {k for k, t in got.items() if t == "normal"} == {5, 6} and {k for k, t in got.items() if t == "fast"} == {9, 10}
    with pytest.raises(ValueError):
        calibrate.check_boundaries(calibrate.boundaries(df, "v", calibrate.EXTREME_MIDDLE), calibrate.EXTREME_MIDDLE)
    with pytest.raises(ValueError):
        calibrate.Tiers(0.7, 0.3)


def test_group_reasons(spark):
    df = spark.createDataFrame([("a", float(k)) for k in range(30)] + [("b", 1.0)] * 30 + [("c", 5.0)], "g string, m double")
    tiers = calibrate.GroupTiers(spans=((("m",), 3.0, "group_rms_span_too_small"),))
    got = {r["g"]: r["reason"] for r in calibrate.group_thresholds(df, "g", ["m"], tiers).collect()}
    assert got == {"a": None, "b": "group_rms_span_too_small", "c": "group_too_small"}


def test_keep_first_before_and_after(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, "b", None), (4, None, "z")], "line long, k string, v string")
    assert sorted(tuple(r) for r in rows.keep_first(df, ["k"], ["line"]).collect()) == [(1, "a", "x"), (3, "b", None), (4, None, "z")]


def test_excluded(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, []), (4, None)], "id long, v array<string>")
    keys = spark.createDataFrame([("b",), (None,)], "k string")
    assert sorted(r["id"] for r in rows.excluded(df.select("id", "v"), F.col("v"), keys, "k").collect()) == [2, 3, 4]


def test_reference_attach(spark):
    refs = spark.createDataFrame([("g", 1, "a"), ("g", 2, "b"), ("g", 3, "c"), ("h", 1, "z")], "g string, far long, path string")
    pool = rows.reference_pool(refs, "g", ["far", "path"], 2)
    targets = spark.createDataFrame([("1", "g", "a"), ("2", "h", "z"), ("3", "none", "q")], "id string, g string, own string")
    got = {r["id"]: (r["ref_audio"], r["ref_policy"][:4]) for r in rows.attach_reference(targets, pool, "g", F.col("own"), F.col("id")).collect()}
    assert got == {"1": ("b", "same"), "2": ("z", "self"), "3": ("q", "self")}


def greedy(sizes, count):
    left, given, own = dict(sizes), [{}, {}], {}
    out = {k: 0 for k, _ in sizes}
    for _ in range(min(count, sum(left.values()))):
        key = min((k for k, n in left.items() if n), key=lambda k: (given[0].get(k[0], 0), given[1].get(k[1], 0), own.get(k, 0), k))
        left[key] -= 1
        out[key] += 1
        own[key] = own.get(key, 0) + 1
        for g, v in zip(given, key):
            g[v] = g.get(v, 0) + 1
    return out


def test_allocator():
    rng = random.Random(3)
    for _ in range(60):
        sizes = [((a, b), rng.randint(0, 9)) for a in "xyz" for b in "pqrs" if rng.random() < 0.8]
        count = rng.randint(0, 60)
        assert dict(zip([k for k, _ in sizes], sampling.allocate(sizes, count))) == greedy(sizes, count)


def test_stratified_sample(spark):
    df = spark.createDataFrame([(k, "a" if k % 3 else "b", "s" if k % 2 else None) for k in range(40)], "id long, tag string, s string")
    got = sampling.stratified(df, "tag", ["s"], "id", 7, 10)
    assert sorted(r["n"] for r in got.groupBy("tag").agg(F.count("*").alias("n")).collect()) == [10, 10]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, sampling.stratified(df, "tag", ["s"], "id", 7, 10).collect()), key=str)


def test_jsonl(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('\n{"a": 1, "t": "é"}\n \n{"a": null}\n\n', encoding="utf-8")
    df = jsonl.read_jsonl(spark, str(path))
    assert [(r["line"], r["a"]) for r in df.select("line", F.try_variant_get("record", "$.a", "int").alias("a")).orderBy("line").collect()] == [(2, 1), (4, None)]
    path.write_text("{}\n[1]\n")
    with pytest.raises(Exception, match="in.jsonl:2"):
        jsonl.read_jsonl(spark, str(path)).select(F.to_json("record")).collect()
    out = spark.createDataFrame([(2, None, "ü"), (1, 0.5, None)], "k long, v double, t string")
    jsonl.write_jsonl(out, str(tmp_path / "out"), ["k"])
    lines = [line for p in sorted((tmp_path / "out").glob("part*")) for line in p.read_text(encoding="utf-8").splitlines()]
    assert lines == ['{"k":1,"v":0.5,"t":null}', '{"k":2,"v":null,"t":"ü"}']
    bad = spark.createDataFrame([(1, float("nan"))], "k long, v double")
    with pytest.raises(Exception, match="finite"):
        jsonl.write_jsonl(bad, str(tmp_path / "bad"), ["k"], strict=True)


def test_lists_and_reports(spark, tmp_path):
    keys = tmp_path / "keys.txt"
    keys.write_text("# no\n a \n\na\nb\n")
    assert sorted(r["key"] for r in jsonl.read_keys(spark, str(keys)).collect()) == ["a", "b"]
    df = spark.createDataFrame([(2, "b<"), (1, None)], "k long, t string")
    jsonl.write_csv(df, str(tmp_path / "r.csv"), ["k", "t"], ["k"])
    assert (tmp_path / "r.csv").read_bytes() == b"\xef\xbb\xbfk,t\r\n1,\r\n2,b<\r\n"
    jsonl.write_html(df, str(tmp_path / "r.html"), "x", ["k", "t"], "t", ["k"])
    assert "b&lt;" in (tmp_path / "r.html").read_text()
    jsonl.write_report({"n": 1}, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"n": 1}


def test_ordinals_and_shards(spark):
    df = jsonl.with_ordinal(spark.createDataFrame([(k,) for k in range(10)], "line long"), ["line"])
    assert sorted(r["line"] for r in rows.shard(df, "ordinal", 3, 1).collect()) == [1, 4, 7]
    with pytest.raises(ValueError):
        rows.shard(df, "ordinal", 3, 3)


def test_exact_quantiles_by_rank(spark):
    """Against numpy: groups of all sizes, one with most rows and many equal values, nulls and a null group."""
    import numpy as np

    rng = np.random.default_rng(3)
    values = {"hot": rng.integers(0, 40, 4000).astype(float), "one": np.array([2.5]), None: rng.random(7), "two": np.array([1.0, 4.0])}
    rows_ = [(g, float(v)) for g, vs in values.items() for v in vs] + [("hot", None), ("none", None)]
    levels = (0.0, 0.2, 1 / 3, 0.5, 0.9, 1.0)
    got = {r["g"]: r for r in calibrate.quantiles(spark.createDataFrame(rows_, "g string, v double").repartition(5), ["g"], "v", levels).collect()}
    assert set(got) == set(values)
    for g, vs in values.items():
        assert got[g]["n"] == len(vs) and got[g]["q"] == pytest.approx(np.quantile(vs, levels).tolist())
    empty = calibrate.quantiles(spark.createDataFrame([], "v double"), [], "v", levels).first()
    assert empty["n"] == 0 and set(empty["q"]) == {None}


def test_calibration_refuses(spark):
    """Too few records, or boundaries that don't rise, label nothing."""
    few = spark.createDataFrame([(float(k),) for k in range(10)], "v double")
    same = spark.createDataFrame([(1.0,)] * 200, "v double")
    for df, word in ((few, "needed"), (same, "rise")):
        with pytest.raises(ValueError, match=word):
            calibrate.with_tiers(df, "v", calibrate.Tiers())
    assert calibrate.with_tiers(few, "v", calibrate.Tiers(min_records=10)).where("tier = 'slow'").count() == 4


def test_excluded_takes_any_types(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None)], "k string, other string").withColumn("record", F.parse_json(F.lit('{"z": 1}')))
    left = rows.excluded(df, F.array("k", F.coalesce("other", F.lit("-"))), spark.createDataFrame([("y",), ("c",)], "key string"), "key")
    assert left.columns == df.columns and [r["k"] for r in left.select("k").collect()] == ["a"]


def test_fixed_reference_refuses(spark):
    refs = spark.createDataFrame([("k", 1, "/a/ref.wav"), ("k", 2, "/a/later.wav")], "key string, line int, path string")
    targets = spark.createDataFrame([(1, "/a/x.wav"), (2, None), (3, "/a/REF.wav"), (4, None)], "id int, audio string")

    def attached(ids, key="k"):
        return rows.attach_fixed(targets, refs, "key", key, "line", "path", F.col("id").isin(ids), "audio").orderBy("id").collect()

    assert [r["ref_audio"] for r in attached([1])] == ["/a/ref.wav", None, None, None]
    with pytest.raises(ValueError, match="no reference"):
        attached([1], "other")
    for ids, word in (([2], "no audio"), ([3], "is the fixed reference")):
        with pytest.raises(Exception, match=word):
            attached(ids)


def test_both_calibrations_read_the_rows_twice(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows_ = [("a" if k % 4 else "b", float(k), None if k % 7 == 0 else float(k % 90)) for k in range(800)] + [("few", 900.0 + k, None) for k in range(5)]
    df = spark.createDataFrame(rows_, "g string, v double, w double")
    slow = df.mapInArrow(seen, df.schema)
    tiers = calibrate.GroupTiers()
    counts = calibrate.counted_metrics(slow, "g", ["v", "w"])
    out = calibrate.with_group_tiers(slow, "g", ["v", "w"], tiers, "effort", counts)
    out = calibrate.with_tiers(out, "v", calibrate.EXTREME_MIDDLE, "speed", counts=counts)
    got = {(r["g"], r["v"]): r for r in out.collect()}
    assert len(got) == 805 and read.value == 2 * 805
    q = calibrate.quantiles(df, [], "v", calibrate.EXTREME_MIDDLE.levels).first()["q"]
    assert all((r["speed"] == "slow") == (r["v"] <= q[0]) and (r["speed"] == "fast") == (r["v"] >= q[3]) for r in got.values())
    t = {r["g"]: r for r in calibrate.group_thresholds(df, "g", ["v", "w"], tiers).collect()}
    assert {g: r["n"] for g, r in t.items()} == {"a": 600, "b": 200, "few": 5} and t["few"]["reason"] == "group_too_small" and t["few"]["q_w"] is None
    for g in "ab":
        for m in "vw":
            values = [x for r in rows_ if r[0] == g and (x := r["gvw".index(m)]) is not None]
            assert t[g][f"q_{m}"] == pytest.approx(np.quantile(values, tiers.levels).tolist(), abs=1e-9)
    assert {r["tier_reason"] for r in got.values() if r["g"] == "few"} == {"effort_group_without_threshold"}


def test_conditioned_controls_leave_out_groups_without_threshold(spark, tmp_path):
    import duckdb

    from tessera.plans import queries, registry  # noqa: F401

    db = duckdb.connect()
    db.execute("CREATE TABLE part AS SELECT k AS p_partkey, CASE WHEN k < 3 THEN 'few' ELSE 'many' END AS p_brand FROM range(100) r(k)")
    db.execute("CREATE TABLE lineitem AS SELECT k % 100 AS l_partkey, (k % 50)::DOUBLE AS l_quantity, (k * 37 % 5000)::DOUBLE AS l_extendedprice, (k % 11) / 100.0::DOUBLE AS l_discount, (k % 9) / 100.0::DOUBLE AS l_tax FROM range(500) r(k)")
    for name in ("part", "lineitem"):
        db.execute(f"COPY {name} TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    for name in ("conditioned_controls", "effort_agreement"):
        df = registry.QUERIES[name](spark, str(tmp_path))
        out = db.execute(registry.ORACLES[name])
        names = [c[0] for c in out.description]
        assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(out.fetchall(), key=repr), name
