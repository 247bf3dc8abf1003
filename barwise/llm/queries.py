"""Registered queries of the operators in this package: one ``opN_<name>`` each,
with production parameters over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barwise.llm import bpe, chat, decontamination, langid, licenses, merkle, neardup, quality_pu, quality_rules, resampling, secrets, sharding, urlrules

SHARDS = 24

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_decontamination")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("items")


@query("op3_sharding")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(table(spark, sf, "documents"), SHARDS)


@query("op4_bpe")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(table(spark, sf, "documents"))


@query("op10_neardup")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.classify(table(spark, sf, "documents"), shingle=2, percent=80).drop("key")


@query("op7_quality_rules")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf, "documents"))


@query("op6_secrets")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.report(table(spark, sf, "documents"))


@query("op8_language_id")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return langid.fit_and_identify(table(spark, sf, "documents"))


@query("op5_quality_pu")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return quality_pu.fit_and_score(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op2_license_scan")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


@query("op9_chat_format")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return chat.repaired(table(spark, sf, "conversations"))


# The list of the op13 query: fixed values.
URL_LIST = [urlrules.Rule("allow", "com", "/"), urlrules.Rule("block", "example.com", "/en/"), urlrules.Rule("allow", "www.example.com", "/en/"),
            urlrules.Rule("block", "net", "/es/"), urlrules.Rule("block", "net", "/fr/")]


@query("op13_url_filter")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of ``pages``; edge cases as in ``urlrules.judge``."""
    return urlrules.judge(table(spark, sf, "pages"), URL_LIST)


@query("op11_resampling")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of ``documents`` towards ``benchmark``; edge cases as in ``resampling.resample``."""
    return resampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op12_merkle")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of ``documents``; edge cases as in ``merkle.verify``."""
    return merkle.verify(table(spark, sf, "documents"))
