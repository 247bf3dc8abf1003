"""Intermediate tables in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barwise.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared scratch folder and read again: lineage ends there,
    lost executors lose nothing, and Spark knows the table's size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove tables of ``stored``; nothing may be derived from them any more that is not stored itself."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
