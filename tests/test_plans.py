"""The curation jobs end to end, recordings, and the queries against DuckDB."""

import json
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import audio, identity
from tessera.operators import calibrate, gates, recordings, rows
from tessera.plans import curation
from tessera.sources import jsonl

DATA = "/root/testdata/sf0.001"


def line(k, cps, group="g", rms=-20.0, **more):
    base = dict(key=f"k{k}", text="你好世界啊", audio=f"/d/{k}.wav", source="studio", recording_group=group, status="ok", asr_cer=0.0, alignment_coverage=1.0, speech_start_sec=0.0, speech_end_sec=2.0, speech_vad_active_duration_sec=1.8, pause_excluded_cps=cps, paralinguistic_ratio=0.0, clipping_ratio=0.0, dynamic_range_db=8.0, noise_floor_dbfs=-60.0, snr_db=30.0, character_timestamps=[{"start": 0.0, "end": 1.0}, {"start": 1.0, "end": 2.0}])
    base |= {f"active_{m}_{p}": rms for m in ("rms_dbfs", "lufs") for p in ("p25", "p50")}
    return {k: v for k, v in (base | more).items() if v != "drop"}


SOURCES = curation.Sources((identity.SourceRule("studio", ("studio",)),))


def scan(spark, tmp_path, records, name="in.jsonl"):
    path = tmp_path / name
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records), encoding="utf-8")
    return jsonl.read_jsonl(spark, str(path))


def test_extreme_middle_candidates(spark, tmp_path):
    tiers = calibrate.Tiers(0.20, 0.80, (0.40, 0.60), 10)
    plan = curation.CandidatePlan(sources=SOURCES, tiers=tiers, emit=("speed",))
    found = curation.candidates(scan(spark, tmp_path, [line(k, float(k)) for k in range(1, 11)]), plan)
    tags = {r["key"]: r["control_tag"] for r in found.collect()}
    assert tags == {f"k{k}": t for ks, t in (((1, 2), "speed_slow"), ((5, 6), "speed_normal"), ((9, 10), "speed_fast")) for k in ks}
    row = found.where("key = 'k1'").first()
    assert row["text"] == "【speed_slow】你好世界啊" and row["control_candidate_id"] == "studio:k1::speed" and row["recording_group"] == "studio:g" and not row["requires_review"]


def test_gates_and_effort(spark, tmp_path):
    records = [line(k, 3.0 + k / 100 if k != 20 else 1.0, rms=-30.0 + k) for k in range(21)]
    records += [line(0, 3.0, asr_cer=0.5), line(30, 3.0, asr_cer=0.5), line(31, 3.0, text="plain english words here now"), line(32, 3.0, group="lone"), line(33, 3.0, text="【speed_slow】你好世界"), line(34, 3.0, generated_by="ffmpeg"), line(35, 3.0, audio="drop")]
    df = scan(spark, tmp_path, records)
    plan = curation.CandidatePlan(sources=SOURCES, tiers=calibrate.Tiers(0.1, 0.9, (0.2, 0.8), 2))
    found = curation.labelled(curation.gated_records(df, plan), plan)
    labels = {r["key"]: r for r in found.collect()}
    assert labels["k0"]["effort_label"] == "soft" and labels["k19"]["effort_label"] == "strong" and labels["k10"]["effort_label"] == "normal"
    assert labels["k31"]["speed_reason"] == "non_cjk_speed_control" and labels["k32"]["effort_out"] == "effort_group_without_threshold"
    report = {r["reason"]: r["n"] for r in curation.candidate_report(df, plan).collect()}
    assert report["duplicate_record_id"] == 1 and report["asr_cer_out_of_range"] == 1 and report["prelabeled_control_text"] == 1 and report["generated_control_provenance"] == 1 and report["missing_audio"] == 1
    assert report["non_cjk_speed_control"] == 1 and report["effort_group_without_threshold"] == 1


def test_alignment_rows(spark, tmp_path):
    df = scan(spark, tmp_path, [line(k, 1.0, text="你好" if k % 2 else "a", source="studio" if k < 8 else "other") for k in range(10)])
    got = curation.alignment_rows(df, most=9, shards=3, shard=1, sources=SOURCES)
    assert sorted(r["ordinal"] for r in got.collect()) == [1, 4, 7]
    got = curation.alignment_rows(df, exclude=("studio",), cjk_only=True, sources=SOURCES)
    assert sorted(r["ordinal"] for r in got.collect()) == [9]


def test_stage_references_and_validation(spark):
    tags = ("speed_slow", "speed_normal", "speed_fast", "effort_soft", "effort_normal", "effort_strong")
    found = spark.createDataFrame([(f"{t}{k}", None, f"{t}{k}::x", f"/a/{t}{k}.wav", f"【{t}】你好", "studio", t, k) for t in tags for k in range(3 if t != "speed_fast" else 2)], "key string, record_id string, control_candidate_id string, audio string, text string, source string, control_tag string, line long")
    replay = spark.createDataFrame([(f"r{k}", None, None, f"/r/{k}.wav", "你好" if k else "【loud】你好", "studio", k) for k in range(14)] + [("speed_slow0", None, None, "/a/x.wav", "你好", "studio", 99)], "key string, record_id string, control_candidate_id string, audio string, text string, source string, line long")
    none = spark.createDataFrame([("r1",)], "key string")
    out = curation.assemble(found, replay, F.lit(True), none, None, ["studio"])
    got = out.collect()
    counts = {}
    for r in got:
        counts[r["control_dataset_role"], r["control_tag"]] = counts.get((r["control_dataset_role"], r["control_tag"]), 0) + 1
    assert counts == {("control", t): 2 for t in tags} | {("replay", None): 12}
    assert not {"r0", "r1"} & {r["key"] for r in got}
    with pytest.raises(ValueError, match="missing eligible"):
        curation.assemble(found.where("control_tag <> 'effort_soft'"), replay, F.lit(True), none, None, ["studio"])
    with pytest.raises(ValueError, match="replay rows"):
        curation.assemble(found, replay, F.lit(True), none, None, ["studio"], replay_ratio=3.0)
    refs = spark.createDataFrame([("g", "ok", "ok", "你好", 0.0, 1.0, 4.0, "/A/1.wav"), ("g", "ok", "ok", "【neutral】你好", 0.0, 1.0, 9.0, "/a/2.wav"), ("g", "ok", "", "你好", 0.0, 1.0, 4.0, "/a/3.wav"), ("g", "ok", "ok", "[laugh]你好", 0.0, 1.0, 4.0, "/a/4.wav")], "recording_group string, status string, alignment_status string, text string, asr_cer double, alignment_coverage double, speech_cps double, audio string")
    pool = curation.clean_references(refs)
    targets = spark.createDataFrame([("g", "t1", "/a/2.wav"), ("g", "t2", "/a/1.wav"), ("h", "t3", "/a/9.wav")], "recording_group string, key string, audio string")
    attached = {r["key"]: (r["ref_audio"], r["ref_policy"][:4]) for r in curation.attach_group_references(targets, pool).collect()}
    assert attached == {"t1": ("/A/1.wav", "same"), "t2": ("/a/2.wav", "same"), "t3": ("/a/9.wav", "self")}
    report = rows.validation_report(rows.validation_failures(out.withColumn("n", F.monotonically_increasing_id()).withColumn("ref_audio", F.lit("/z.wav")), "n", need_reference=True))
    assert report == {"valid": True, "failure_count": 0, "failures": [], "failures_truncated": False}


def test_evaluation_and_reviews(spark):
    pool = spark.createDataFrame([(f"k{k}", "一二三四五六七八九十" if k != 3 else "短", f"/a/{k}.wav") for k in range(6)], "key string, text string, audio string")
    trained = spark.createDataFrame([("k0",)], "key string")
    cases = curation.evaluation_cases(pool, trained, "ref.wav", count=2).collect()
    assert len(cases) == 14 and {r["variant"] for r in cases} == {"untagged", "speed_slow", "speed_normal", "speed_fast", "effort_soft", "effort_normal", "effort_strong"}
    assert not {"k0", "k3"} & {r["source_key"] for r in cases} and {r["sample_id"] for r in cases} == {"001", "002"}
    with pytest.raises(ValueError):
        curation.evaluation_cases(pool, trained, "ref.wav", count=5)
    found = spark.createDataFrame([(t, f"{t}{k}", float(k)) for t in ("speed_slow", "speed_normal", "effort_strong") for k in range(9)], "control_tag string, control_candidate_id string, sort_value double")
    got = {}
    for r in curation.review_list(found, 3).orderBy("rank").collect():
        got.setdefault(r["control_tag"], []).append(r["sort_value"])
    assert got == {"speed_slow": [0, 1, 2], "speed_normal": [3, 4, 5], "effort_strong": [8, 7, 6]}


def tone(level, seconds, rate=16000, hz=997):
    return level * np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate)


def test_measures():
    x = np.concatenate([np.zeros(8000), tone(0.5, 1.0), np.zeros(8000)])
    got = audio.measure(x, 16000, start=0.5, end=1.5)
    assert got["audio_duration_sec"] == 2.0 and got["vad_active_duration_sec"] == pytest.approx(1.0, abs=0.06) and got["peak_dbfs"] == pytest.approx(-6.02, abs=0.01)
    assert got["active_rms_dbfs_p50"] == pytest.approx(20 * math.log10(0.5 / math.sqrt(2)), abs=0.05) and got["noise_floor_dbfs"] == pytest.approx(-240.0)
    assert audio.integrated_lufs(tone(1.0, 5.0, 48000), 48000) == pytest.approx(-3.01, abs=0.05)
    assert audio.integrated_lufs(np.zeros(48000), 48000) is None and audio.integrated_lufs(np.ones(100), 48000) is None
    assert audio.active_samples(np.arange(10.0), 10, [(0.0, 0.2), (0.5, 0.7)], 0.0, 1.0).tolist() == [0, 1, 5, 6]
    with pytest.raises(ValueError):
        audio.measure(np.zeros(0), 16000)
    with pytest.raises(ValueError):
        audio.measure(np.array([np.nan]), 16000)


def test_gain_and_ceiling():
    held, cut = audio.hold_peak(np.array([[0.9], [-0.9]]), 20 * math.log10(0.5), 1)
    assert np.abs(held).max() <= 0.5 + 1e-12 and cut < 0
    wav, told = audio.render(tone(0.5, 1.0), 16000, gain_db=20.0)
    samples, rate = audio.decode_wav(wav)
    assert rate == 16000 and told["peak_dbfs"] <= -1 + 1e-6 and np.abs(samples).max() < 0.9
    _, told = audio.render(tone(0.1, 2.0), 16000, target_lufs=-30.0)
    assert told["lufs_after"] == pytest.approx(-30.0, abs=0.1)
    for bad in ({}, {"gain_db": 1.0, "target_lufs": -20.0}, {"gain_db": 500.0}, {"target_lufs": 1.0}):
        with pytest.raises(ValueError):
            audio.render(tone(0.1, 1.0), 16000, **bad)


def test_recordings(spark, tmp_path):
    audio.publish(f"{tmp_path}/in/a.wav", audio.encode_wav(tone(0.25, 1.0), 16000))
    audio.publish(f"{tmp_path}/in/b.wav", b"broken")
    with pytest.raises(FileExistsError):
        audio.publish(f"{tmp_path}/in/b.wav", b"")
    files = recordings.read_audio(spark, f"{tmp_path}/in")
    got = {os.path.basename(r["path"]): r for r in recordings.measured(files, "path", "content").collect()}
    assert got["a.wav"]["metrics_error"] is None and got["a.wav"]["peak_dbfs"] == pytest.approx(-12.04, abs=0.01) and got["b.wav"]["metrics_error"]
    louder = {os.path.basename(r["path"]): r for r in recordings.rendered(files, "path", "content", gain_db=6.0).collect()}
    assert louder["a.wav"]["peak_dbfs"] == pytest.approx(-6.04, abs=0.05) and louder["b.wav"]["error"]
    named = recordings.with_model(files, "path", "content", lambda: lambda raw: {"said": str(len(raw) > 100), "n": len(raw)}, "said string, n long")
    assert sorted((r["said"], r["model_error"]) for r in named.collect()) == [("False", None), ("True", None)]

    def broken():
        raise RuntimeError("no model")

    assert {r["model_error"] for r in recordings.with_model(files, "path", "content", broken, "said string").collect()} == {"RuntimeError: RuntimeError: no model"}
    plan = spark.createDataFrame([(f"{tmp_path}/in/a.wav", f"{tmp_path}/out/a.wav"), (f"{tmp_path}/in/none", f"{tmp_path}/out/n.wav")], "s string, t string")
    done = {r["t"][-5:]: r for r in recordings.materialized(plan, "s", "t", "hardlink").collect()}
    assert done["a.wav"]["materialization"] == "hardlink" and done["n.wav"]["materialization_error"]
    with pytest.raises(FileExistsError):
        recordings.materialize(f"{tmp_path}/in/a.wav", f"{tmp_path}/out/a.wav")


def test_character_alignment(spark):
    seen = [("h", 0.0, 0.1, 0.9), ("l", 0.2, 0.3, 0.8), ("l", 0.3, 0.3, 0.8), ("o", 0.9, 5.0, 0.7)]
    df = spark.createDataFrame([(1, list("Hello"), seen, 1.0), (2, [], [], 0.0)], "id long, e array<string>, o array<struct<character: string, start: double, end: double, score: double>>, d double")
    got = {r["id"]: r for r in recordings.align_characters(df, "id", "e", "o", "d").collect()}
    assert [(c["start"], c["end"]) for c in got[1]["characters"]] == [(0.0, 0.1), (None, None), (0.2, 0.3), (None, None), (0.9, 1.0)]
    assert got[1]["timed"] == 3 and got[2]["timed"] == 0


def test_alignment_is_bounded_and_the_same_in_columns():
    import random

    import pyarrow as pa

    rnd = random.Random(3)
    kind = pa.list_(pa.struct([("character", pa.string()), *((n, pa.float64()) for n in ("start", "end", "score"))]))
    number = lambda: rnd.choice([None, math.nan, math.inf, -1.0, 0.0, rnd.random() * 9])
    rows_ = []
    for k in range(600):
        e = [rnd.choice([*"aAbBcCİßΣ", "None"]) for _ in range(rnd.randrange(9))]
        seen = e if k % 3 == 0 else [rnd.choice([c, c, "x", None]) for c in e] if k % 3 == 1 else [rnd.choice("abc") for _ in range(rnd.randrange(9))]
        o = [dict(character=c, start=number(), end=number(), score=rnd.choice([None, 0.5])) for c in seen]
        rows_.append((None if k % 50 == 1 else e, None if k % 50 == 2 else o, rnd.choice([None, math.nan, 0.0, 3.0, 8.0])))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows_, strict=True), (pa.list_(pa.string()), kind, pa.float64()), strict=True)]
    for low in (0, 7):
        got, timed = recordings._aligned(*(c.slice(low) for c in columns))
        want = [recordings.match_characters(e or [], o or [], d or 0.0) for e, o, d in rows_[low:]]
        assert repr(got.to_pylist()) == repr(want) and timed.to_pylist() == [sum(c["start"] is not None for c in w) for w in want]
    many = pa.RecordBatch.from_arrays([pa.array(range(5000)), pa.array([["a"] * 50] * 5000), pa.nulls(5000, kind)], ["k", "e", "o"])
    parts = list(recordings._pieces(many))
    assert max(50 * p.num_rows for p in parts) < recordings._PIECE + 50 and [k for p in parts for k in p.column(0).to_pylist()] == list(range(5000))
    assert not list(recordings._pieces(many.slice(0, 0)))


def test_final_status(spark):
    df = spark.createDataFrame([("ok", "ok"), ("bad", "ok"), ("ok", "none")], "a string, b string")
    status, error = gates.final_status([("asr", F.col("a"), F.lit(None).cast("string")), ("alignment", F.col("b"), F.lit(""))], "alignment")
    assert [tuple(r) for r in df.select(status, error).collect()] == [("ok", None), ("partial", "asr: bad"), ("failed", "alignment: none")]


def _same(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    return repr(float(value) + 0.0) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_queries_against_duckdb(spark):
    import duckdb

    from tessera.plans import queries, registry  # noqa: F401

    db = duckdb.connect()
    for name in "customer orders lineitem part events documents embeddings pages benchmark labels conversations".split():
        path = f"{DATA}/{name}.parquet"
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    for name, run in registry.QUERIES.items():
        df = run(spark, DATA)
        columns = sorted(df.columns)
        got = sorted(tuple(map(_same, r)) for r in df.select(*columns).collect())
        if name in registry.ORACLES:
            out = db.execute(registry.ORACLES[name])
            names = [c[0] for c in out.description]
            assert sorted(names) == columns, name
            want = sorted(tuple(_same(r[names.index(c)]) for c in columns) for r in out.fetchall())
            assert got == want, name
