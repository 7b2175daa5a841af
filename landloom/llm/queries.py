"""Queries of the training-data problems over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table
from .components import connected_components, core_links
from .leaks import find_leaks, remove_leaks
from .linkage import link_records
from .spans import shared_chars
from .tokens import encode_corpus
from .truncation import cut_shares, truncated


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    return link_records(table(spark, d, "clean_records"), table(spark, d, "search_results"), table(spark, d, "permit_records"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_links(spark, d).select("clean_id", "other_table", "other_id")


RAW_FIELDS = {"land": "land", "name": "name", "date": "date"}


def _cut(spark: SparkSession, d: str) -> DataFrame:
    return truncated(table(spark, d, "raw_records"), "raw_id", "feed_id", RAW_FIELDS)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _cut(spark, d).where("cut").select("raw_id", "field")


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    return cut_shares(_cut(spark, d), "feed_id")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    links = core_links(table(spark, d, "corrections"), table(spark, d, "projects"))
    return connected_components(links).select(F.col("component").alias("group_core"), F.col("node").alias("land_core"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p9_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return remove_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return shared_chars(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_links, p2_found, p2_shares, p7_found, p8_ids, p9_found, p9_cleaned, p10_found)}
SQL: dict[str, str] = {}
