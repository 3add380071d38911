"""What several corpus operators share: scratch space on the cluster and text handling."""

from __future__ import annotations

import contextlib
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut, shared_folder

__all__ = ["cut", "forget", "free_name", "keyed_texts", "stored", "trim"]


def stored(df: DataFrame, name: str, paths: dict[str, str] | None = None) -> DataFrame:
    """The rows, written as compressed Parquet in the shared folder and read again; for tables as large as the input, which a checkpoint would keep uncompressed. paths: takes note of the folder, for forget()."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if paths is not None:
        paths[name] = path
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, paths: dict[str, str], *names: str) -> None:
    """Delete stored tables that nothing reads any more, and let go of the shuffles that made stored ones."""
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop(name))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark.range(1).count()  # the engine holds on to the last query alone
    gc.collect()
    spark._jvm.System.gc()


def trim() -> None:
    """Give memory that a Python worker has freed back to the machine; workers live on between tasks, and so would their largest moment."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library is another
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that df has not (names are compared as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone; other columns may have any names."""
    return docs.select(F.col("doc_id").cast(T.LongType()).alias("doc_id"), F.col("text").cast(T.StringType()).alias("text"))
