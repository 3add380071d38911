"""Line-delimited JSON: scan with line numbers and clear failures, writers that keep nulls and order, key lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def read_jsonl(spark: SparkSession, paths: str | list[str], manifest: int = 0) -> DataFrame:
    """manifest, path, line (from 1, blank lines count) and record (VARIANT) of every line that isn't blank. A line that is no JSON object fails the query with its place. Line numbers come from the partitions' sizes: one narrow count, no shuffle."""
    out = None
    for k, p in enumerate([paths] if isinstance(paths, str) else paths):
        lines = spark.read.text(p)
        numbered = lines.rdd.zipWithIndex().map(lambda x: (x[1] + 1, x[0][0])).toDF("line bigint, value string")
        parsed = numbered.where(F.col("value").rlike("(?U)\\S")).withColumn("record", F.try_parse_json("value"))
        ok = F.col("record").isNotNull() & F.coalesce(F.schema_of_variant("record").startswith("OBJECT"), F.lit(False))
        place = F.concat(F.lit(f"{p}:"), F.col("line").cast("string"), F.lit(": expected a JSON object"))
        one = parsed.select(F.lit(manifest + k).alias("manifest"), F.lit(p).alias("path"), "line", F.when(ok, F.col("record")).otherwise(F.raise_error(place).cast("variant")).alias("record"))
        out = one if out is None else out.unionByName(one)
    return out


def with_ordinal(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their ordinal from 0 in this order: sizes of the sorted partitions are counted and summed, and each partition numbers its own rows."""
    names = df.columns
    ordered = df.orderBy(*order)
    return ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1])).toDF(StructType([*df.schema.fields, StructField("ordinal", LongType())])).select(*names, "ordinal")


def write_jsonl(df: DataFrame, path: str, order: list[str], columns: list[str] | None = None, strict: bool = False) -> None:
    """One object a line, nulls and all characters kept, in order over the part files. strict: NaN or infinity fails."""
    names = columns or df.columns
    out = df.orderBy(*order)
    if strict:
        for c, kind in out.dtypes:
            if kind in ("double", "float") and c in names:
                bad = F.isnan(c) | (F.abs(c) == float("inf"))
                out = out.withColumn(c, F.when(bad, F.raise_error(F.lit(f"{c} is not a finite number")).cast(kind)).otherwise(F.col(c)))
    out.select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value")).write.mode("errorifexists").text(path)


def write_csv(df: DataFrame, path: str, fields: list[str], order: list[str]) -> None:
    """One UTF-8 CSV file with a byte order mark and a header; for review lists, whose size a top-k or sample bounds."""
    import csv
    import os

    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(fields)
        for row in df.orderBy(*order).select(*fields).toLocalIterator():
            out.writerow(["" if v is None else v for v in row])


def write_report(report: dict, path: str) -> None:
    """A report as one JSON file, put in place whole."""
    import json
    import os

    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.tmp", "w", encoding="utf-8") as f:
        json.dump(report, f, ensure_ascii=False, indent=2, default=str)
        f.write("\n")
    os.replace(f"{path}.tmp", path)


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """key of every line that is neither blank nor a comment, each once."""
    key = F.trim(F.regexp_replace("value", "(?U)^\\s+|\\s+$", ""))
    return spark.read.text(path).select(key.alias("key")).where((F.col("key") != "") & ~F.col("key").startswith("#")).distinct()


def write_html(df: DataFrame, path: str, title: str, columns: list[str], audio: str, order: list[str]) -> None:
    """A review page of escaped rows with a player each; for lists that a top-k or sample bounds."""
    import html
    from urllib.parse import quote

    with open(path, "w", encoding="utf-8") as f:
        f.write(f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><table><tr>" + "".join(f"<th>{html.escape(c)}</th>" for c in columns) + "<th>audio</th></tr>\n")
        for row in df.orderBy(*order).toLocalIterator():
            cells = "".join(f"<td>{html.escape('' if row[c] is None else str(row[c]))}</td>" for c in columns)
            f.write(f"<tr>{cells}<td><audio controls preload='none' src='{quote(str(row[audio] or ''))}'></audio></td></tr>\n")
        f.write("</table>\n")
