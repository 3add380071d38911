"""Quality rules by distribution divergence, in DataFrame functions alone.

Base rules count words, symbols, repeated lines and repeated three-word windows. The method then compares two histograms of a document, of its character classes and of common words, with the reference of its language by Jensen-Shannon distance. References are sums over all documents of the language that pass the base rules; a language with few documents, or none given, is held against the sum over all. Short documents are judged by the base rules only, as their histograms say little.

Defined cases: a null or empty text has no words and fails the base rules; a null lang uses the reference over all; an empty table gives an empty result; without any reference (no document passes the base rules) distances are null and only base rules count; other columns are ignored; repeated rows stay rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut, stored
from tessera.llm.registry import query

#: Words and word characters from which a histogram counts.
MIN_WORDS, MIN_CHARS = 80, 200
#: Jensen-Shannon distances (root of the divergence to base 2) beyond which a document is rejected: a bound for long documents and a slack over the root of the length, as short histograms scatter.
MAX_CLASS_DISTANCE, SLACK_CLASS = 0.22, 2.0
MAX_WORD_DISTANCE, SLACK_WORD = 0.14, 2.0
#: Share of symbols among word characters up to which a document counts for a reference.
MAX_REFERENCE_SYMBOLS = 0.02
#: Documents that a language needs for a reference of its own, and languages with one at most (those with most documents); the rest use the reference over all.
MIN_REFERENCE_DOCS, MAX_REFERENCES = 20, 1000

# Frequent function words of four languages.
COMMON_WORDS = (
    "the of and to in a is that for it was on "
    "de la le et les des en un du une que est "
    "der die und den von zu das mit sich auf für ist "
    "el los y se del las por con una su para es"
).split()
LONGEST_COMMON = max(len(w.encode()) for w in COMMON_WORDS)

# Character classes, taken from what the ones before have left; the rest are symbols.
_CLASSES = ("[a-z]+", "[\\p{Ll}\\p{Lo}\\p{M}]+", "[\\p{Lu}\\p{Lt}]+", "\\p{N}+", "[.,;:!?'\"()-]+")
N_CLASSES = len(_CLASSES) + 1


def features(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """row (doc_id by default), lang, the base counts and the two histograms (classes, common) of every document."""
    row = F.col("doc_id").cast("long") if row is None else row
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = docs.select(row.alias("row"), F.col("lang").cast("string").alias("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang"), t.alias("t"))
    gap = F.lit(" \t\n\x0b\x0c\r")
    out = out.select("row", "lang", "t", F.trim(F.col("t"), gap).alias("tt"))
    words = F.split("tt", "[\\x20\\x09-\\x0D]+", -1)
    out = out.select("row", "lang", "t", F.when(F.col("tt") == "", F.array().cast("array<string>")).otherwise(words).alias("w"))
    out = out.select(
        "row",
        "lang",
        "t",
        "w",
        F.array_join("w", "").alias("r0"),
        F.expr("filter(split(t, '\n', -1), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')").alias("lines"),
        # hashes tell that no window stands twice; where two are equal, the windows themselves are compared
        F.expr("CASE WHEN size(w) >= 3 THEN transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) ELSE cast(array() AS array<bigint>) END").alias("tri"),
        F.transform(F.filter("w", lambda x: (F.octet_length(x) <= LONGEST_COMMON) & F.lower(x).isin(COMMON_WORDS)), lambda x: F.lower(x)).alias("cw"),
    )
    out = out.withColumn("seen", F.size(F.array_distinct("tri")))
    placed = "sort_array(transform(sequence(0, size(w) - 3), i -> struct(concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS x, i AS i)))"
    out = out.withColumn("placed", F.expr(f"CASE WHEN seen < size(tri) THEN {placed} ELSE cast(array() AS array<struct<x: string, i: int>>) END"))
    # places of windows that equal a neighbour in the sorted order
    out = out.withColumn(
        "hits",
        F.expr(
            """sort_array(array_distinct(flatten(filter(
                zip_with(placed, slice(placed, 2, greatest(size(placed) - 1, 0)), (a, b) -> CASE WHEN a.x = b.x THEN array(a.i, b.i) END),
                x -> x IS NOT NULL))))"""
        ),
    )
    # each window has three words, fewer where the next one starts inside it
    covered = F.expr("aggregate(zip_with(hits, slice(hits, 2, greatest(size(hits) - 1, 0)), (a, b) -> least(3, coalesce(b - a, 3))), 0L, (s, x) -> s + x)")
    names = []
    for k, shape in enumerate(_CLASSES):
        out = out.withColumn(f"r{k + 1}", F.regexp_replace(f"r{k}", shape, ""))
        names.append((F.char_length(f"r{k}") - F.char_length(f"r{k + 1}")).cast("long"))
    names.append(F.char_length(f"r{len(_CLASSES)}").cast("long"))
    n_common = F.size("cw")
    words = ", ".join("'" + w + "'" for w in COMMON_WORDS)
    return out.select(
        "row",
        "lang",
        F.size("w").cast("long").alias("n_words"),
        F.char_length("r0").cast("long").alias("word_chars"),
        (F.char_length("r0") - F.char_length(F.regexp_replace("r0", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.array(*names).alias("classes"),
        F.concat(F.expr(f"transform(array({words}), v -> cast(size(filter(cw, x -> x = v)) AS bigint))"), F.array((F.size("w") - n_common).cast("long"))).alias("common"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def references(found: DataFrame) -> DataFrame:
    """lang, ref_classes and ref_common and their totals: sums over the documents that pass the base rules and have few symbols; lang null is the sum over all."""
    good = found.where(~F.col("base_failed") & (F.col("n_symbols") <= MAX_REFERENCE_SYMBOLS * F.col("word_chars")))
    sums = [F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(N_CLASSES)] + [F.sum(F.col("common")[k]).alias(f"v{k}") for k in range(len(COMMON_WORDS) + 1)]
    own = good.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *sums).where(F.col("n") >= MIN_REFERENCE_DOCS).orderBy(F.desc("n"), "lang").limit(MAX_REFERENCES)
    both = own.unionByName(good.groupBy().agg(F.lit(None).cast("string").alias("lang"), F.count(F.lit(1)).alias("n"), *sums).where("n > 0"))
    classes, words = [f"c{k}" for k in range(N_CLASSES)], [f"v{k}" for k in range(len(COMMON_WORDS) + 1)]
    return both.select("lang", F.array(*classes).alias("ref_classes"), F.array(*words).alias("ref_common"), F.expr(" + ".join(classes)).alias("ref_chars"), F.expr(" + ".join(words)).alias("ref_words"))


def jensen_shannon(a: str, b: str, total_a: str, total_b: str) -> Column:
    """The distance of two arrays of counts with these totals: the root of their divergence to base 2; null if either is empty."""
    part = "CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / (_x / {a} + _y / {b})) ELSE 0D END"
    p, q = (part.format(x=f"({v} / {t})", a=total_a, b=total_b) for v, t in (("_x", total_a), ("_y", total_b)))
    return F.expr(f"CASE WHEN {total_a} > 0 AND {total_b} > 0 THEN sqrt(greatest(0D, aggregate(zip_with({a}, {b}, (_x, _y) -> {p} + {q}), 0D, (_s, _z) -> _s + _z) / 2)) END")


def judged(found: DataFrame) -> DataFrame:
    """The features with the distances to the references, which are made of all of them, and kept."""
    refs = cut(references(found))  # of MAX_REFERENCES + 1 rows at most
    names = ("ref_classes", "ref_common", "ref_chars", "ref_words")
    every = refs.where("lang IS NULL").select(*(F.col(n).alias(f"all_{n}") for n in names))
    out = found.join(F.broadcast(refs.where("lang IS NOT NULL")), "lang", "left").join(F.broadcast(every), F.lit(True), "left")
    for n in names:
        out = out.withColumn(n, F.coalesce(n, f"all_{n}"))
    out = out.withColumn("class_distance", F.when(F.col("word_chars") >= MIN_CHARS, jensen_shannon("classes", "ref_classes", "word_chars", "ref_chars")))
    out = out.withColumn("word_distance", F.when(F.col("n_words") >= MIN_WORDS, jensen_shannon("common", "ref_common", "n_words", "ref_words")))
    most_class = MAX_CLASS_DISTANCE + SLACK_CLASS / F.sqrt("word_chars")
    most_word = MAX_WORD_DISTANCE + SLACK_WORD / F.sqrt("n_words")
    far = F.coalesce(F.col("class_distance") > most_class, F.lit(False)) | F.coalesce(F.col("word_distance") > most_word, F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~far)


def judge_quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the base counts, base_failed, kept and the two distances of every document. The counts are stored once, as the references need all of them first."""
    out = judged(cut(features(docs)))
    return out.select(F.col("row").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def keep_quality(docs: DataFrame) -> DataFrame:
    """The documents that quality keeps, with all their columns. Each row carries its own verdict, so ids may repeat or be null."""
    return judged(stored(features(docs, F.struct("*")), "quality")).where("kept").select("row.*")


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
