"""Row numbers over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwise.session import checkpoint_root


def number_rows(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """``df`` with ``out`` = 1, 2, ... in the order of the columns ``order``.

    Rows are dealt over tasks by range, sorted there, and numbered by the
    rows of the ranges before plus their place. The checkpoint keeps places
    from moving between the count and the use. Only one row per partition
    (its size) meets in one task.
    """
    checkpoint_root(df.sparkSession)
    cols = [F.col(c).asc_nulls_first() for c in order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.repartitionByRange(parts, *cols).sortWithinPartitions(*cols)
              .withColumn("_id", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftright("_id", 33)).checkpoint(eager=True))
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.join(F.broadcast(starts), "_pid")  # a row per partition
            .withColumn(out, F.col("_start") + place + 1).drop("_id", "_pid", "_start"))
