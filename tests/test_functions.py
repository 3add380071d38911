"""Text, identity, alias and interval functions against known values."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import alias, identity, intervals, numbers, text


def one(spark, column, **values):
    row = spark.range(1)
    for k, v in values.items():
        row = row.withColumn(k, F.lit(v) if not isinstance(v, str) or not v.startswith("sql:") else F.expr(v[4:]))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, clean",
    [("【happy】Ｈello [breath]<b>you</b> ", "Hello you"), ("　你好　", "你好"), (None, ""), ("", ""), ("<stress>a</stress>b", "ab")],
)
def test_clean_text(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(text.clean_spoken_text("t")).first()[0] == clean


def test_tokens_and_rates(spark):
    df = spark.createDataFrame([("你好, hello 42!",)], "t string")
    row = df.select(text.spoken_units(F.col("t")).alias("u"), text.count_units(F.col("t")).alias("n"), text.normalized(F.col("t")).alias("z")).first()
    assert row["u"] == ["你", "好", "hello", "42"] and row["n"] == 4 and row["z"] == "你好hello42"


@pytest.mark.parametrize(
    "raw, tags, family",
    [("【Happy_low】x", ["happy_low"], "happy"), ("【speed_slow】x", [], "no_emotion"), ("【happy】【sad】", ["happy", "sad"], "transition"), ("【odd】", ["odd"], "other"), ("【sad】【sad_2】", ["sad", "sad_2"], "sad"), (None, [], "no_emotion")],
)
def test_emotions(spark, raw, tags, family):
    df = spark.createDataFrame([(raw,)], "t string")
    row = df.select(text.emotion_tags("t").alias("a"), text.emotion_family("t").alias("b")).first()
    assert (row["a"], row["b"]) == (tags, family)


def test_events_and_stripping(spark):
    df = spark.createDataFrame([("[Breath]a<cry >b<stress>c[ odd ]【happy】【sad】",)], "t string")
    row = df.select(text.event_tags("t").alias("a"), text.strip_emotion_tags("t", ["HAPPY"]).alias("b"), text.event_count("t", "breath").alias("c")).first()
    assert row["a"] == ["breath", "cry", "odd"] and row["b"] == "[Breath]a<cry >b<stress>c[ odd ]【sad】" and row["c"] == 1


def test_cjk_only_and_control_tags(spark):
    df = spark.createDataFrame([("你好，世界。",), ("你好 world",), ("你好3",), ("，。",)], "t string")
    assert [r[0] for r in df.select(text.is_cjk_only(F.col("t"))).collect()] == [True, False, False, False]
    assert df.select(text.add_control_tags(F.lit(" a "), "speed_fast")).first()[0] == "【speed_fast】a"
    with pytest.raises(ValueError):
        text.add_control_tags(F.lit("a"), "loud")


def test_error_rate(spark):
    df = spark.createDataFrame([("你好世界", "你坏世"), ("", "x"), ("ab", "")], "a string, b string")
    assert [r[0] for r in df.select(text.character_error_rate(F.col("a"), F.col("b"))).collect()] == [0.5, None, 1.0]


def test_edit_distance_is_exact_and_takes_no_step_for_each_pair():
    import random
    import time

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rnd = random.Random(5)
    for k in range(300):
        letters = ("ab", "abc de", "aé你𝄞x")[k % 3]
        a, b = ("".join(rnd.choices(letters, k=rnd.choice([0, 1, 2, 29, 30, 31, 63, 64, 65, 90]))) for _ in range(2))
        assert text.edit_distance(a, b) == plain(a, b)
    a, b = ("".join(rnd.choices("abcdefgh ", k=n)) for n in (1500, 1100))
    assert text.edit_distance(a, b) == plain(a, b)
    a = "".join(rnd.choices("abcdefgh ", k=100_000))
    began = time.process_time()
    assert text.edit_distance(a, a[:50_000] + "xyz" + a[50_001:]) == 3  # 10,000,000,000 pairs
    assert time.process_time() - began < 120


def test_finite(spark):
    df = spark.createDataFrame([("1.5",), ("nan",), ("inf",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(numbers.finite(F.col("t"))).collect()] == [1.5, None, None, None, None]


@pytest.mark.parametrize("raw, path", [("/a/./b/../c//d", "/a/c/d"), ("a\\b\\..\\c", "a/c"), ("../x", "../x"), ("/..", "/"), ("a/..", ".")])
def test_collapse(spark, raw, path):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(identity.collapse(F.col("t"))).first()[0] == path


def test_sources_and_groups(spark):
    rules = [identity.SourceRule("studio", ("studio",), ("/studio/", "/goal/")), identity.SourceRule("acted", ("acted",), ("/acted/",), "wav_path")]
    rows = [
        ("STUDIO_2", None, "x/y/goal/a.wav", None, None, None),
        (None, "/d/acted/b.wav", None, None, "line_12", "F"),
        (None, None, "p/q/r/s.wav", "anna", None, None),
        (None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "source string, wav_path string, audio_path string, speaker_id string, item_name string, gender string")
    source = identity.infer_source(df, rules)
    got = df.select(source.alias("s"), identity.recording_group(df, source, "goal", ("studio",), ("acted",)).alias("g")).collect()
    assert [tuple(r) for r in got] == [("studio", "studio:recording:x/y"), ("acted", "acted:item:line:gender:f"), ("unknown", "unknown:speaker:anna"), ("unknown", "unknown:unknown")]


def test_identity_variants_and_stable_index(spark):
    df = spark.createDataFrame([("studio:a1::speed", None)], "key string, record_id string")
    assert df.select(identity.identity_variants([F.col("key"), F.col("record_id")], ["studio"])).first()[0] == ["a1", "studio:a1", "studio:a1::speed"]
    import hashlib

    want = int.from_bytes(hashlib.sha256(b"abc").digest()[:8], "big") % 7
    assert df.select(identity.stable_index(F.lit("abc"), F.lit(7))).first()[0] == want


def test_alias_lookup(spark):
    rows = [('{"cer": null, "metrics": {"asr_cer": 0.25}}',), ('{"asr_cer": "x", "cer": 0.5}',), ('{"cer": "0.5"}',), ("{}",), ('{"alignment": {"cer": 1}, "metrics": {"asr_cer": 2}}',)]
    df = spark.createDataFrame(rows, "t string").select(F.parse_json("t").alias("v"))
    assert [r[0] for r in df.select(alias.number(F.col("v"), "asr_cer")).collect()] == [0.25, None, 0.5, None, 1.0]


def test_timestamps(spark):
    df = spark.createDataFrame([('{"word_timestamps": [{"start": 0, "end": 0.5, "score": 0.9}, [1, 2], [3, 2], {"start": 1}, 7]}',)], "t string").select(F.parse_json("t").alias("v"))
    got = df.select(alias.timestamps(F.col("v"))).first()[0]
    assert [(t["start"], t["end"], t["score"]) for t in got] == [(0.0, 0.5, 0.9), (1.0, 2.0, None)]


def _pauses(spark, characters, active, units, gap, ratio):
    rows = [([(k, *c) if c else (k, None, None) for k, c in enumerate(characters)], active)]
    df = spark.createDataFrame(rows, "c array<struct<index: bigint, start: double, end: double>>, a array<struct<s: double, e: double>>")
    low, high = intervals.bounds(F.col("c"))
    df = df.withColumn("low", low).withColumn("high", high)
    df = df.withColumn("p", intervals.pauses(intervals.held(F.col("c"), F.col("low"), F.col("high")), intervals.merge(intervals.clip(F.col("a"), F.col("low"), F.col("high"))), gap, ratio))
    return df.select(intervals.pause_rate(F.col("p"), F.col("low"), F.col("high"), F.lit(units)).alias("x")).first()["x"]


def test_pause_rates(spark):
    marks = [(0.0, 0.2), (1.2, 1.4), (1.4, 1.6)]
    got = _pauses(spark, marks, [(0.0, 0.25), (1.15, 1.6)], 6, 0.3, 0.2)
    assert got["pause_count"] == 1 and got["pause_sec"] == pytest.approx(1.0) and got["pause_ratio"] == pytest.approx(0.625)
    assert got["kept_sec"] == pytest.approx(0.6) and got["cps"] == pytest.approx(10.0)
    got = _pauses(spark, marks, [(0.2, 1.2)], 6, 0.3, 0.2)
    assert (got["pause_count"], got["cps"]) == (0, pytest.approx(3.75))
    got = _pauses(spark, [(0.0, 0.2), None, (1.2, 1.4)], [], 3, 0.3, 0.2)
    assert got["pause_count"] == 0 and got["kept_sec"] == pytest.approx(1.4)
    got = _pauses(spark, [(0.0, 1.0), (0.2, 0.4), (1.5, 1.6)], [], 3, 0.3, 0.2)
    assert got["pause_count"] == 1 and got["pause_sec"] == pytest.approx(0.5)


def test_residual_activity(spark):
    df = spark.createDataFrame([([(0.0, 0.2), (0.8, 1.0)], [(0.0, 0.2), (0.3, 0.6), (0.8, 1.0)])], "c array<struct<start: double, end: double>>, a array<struct<s: double, e: double>>")
    got = df.select(intervals.residual_activity(F.col("c"), F.col("a"), F.lit(0.0), F.lit(1.0), 0.05).alias("x")).first()["x"]
    assert got["lexical_sec"] == pytest.approx(0.4) and got["residual_sec"] == pytest.approx(0.3) and got["ratio"] == pytest.approx(3 / 7)


def test_merge_and_quantile(spark):
    df = spark.createDataFrame([([(3.0, 4.0), (0.0, 1.0), (1.0, 2.0), (5.0, 5.0)], [4.0, 1.0, 3.0])], "a array<struct<s: double, e: double>>, q array<double>")
    row = df.select(intervals.merge(F.col("a")).alias("m"), intervals.quantile(F.col("q"), 0.25).alias("q")).first()
    assert [tuple(x) for x in row["m"]] == [(0.0, 2.0), (3.0, 4.0)] and row["q"] == 2.0
