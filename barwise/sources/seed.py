"""Literal reference rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barwise import schema as S

# The two exchanges of the instrument universe.
EXCHANGES = [
    (1, "XNYS", "New York Stock Exchange", "US", "America/New_York"),
    (2, "XNAS", "Nasdaq Stock Market", "US", "America/New_York"),
]


def exchanges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXCHANGES, S.EXCHANGE)
