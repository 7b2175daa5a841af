"""Queries of the general data problems (3 to 6) over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.packed import unpack
from ..operators.rejects import parse_lines, records, rejects
from ..operators.snapshots import snapshot_changes
from ..operators.timestamps import normal_forms
from ..runtime import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return unpack(table(spark, d, "clean_records"), "clean_id", {"land": "land", "parcels": "items", "aliases": "aliases"})


def dated_values(spark: SparkSession, d: str) -> DataFrame:
    """Every date value of the three tables with its feed's clock."""
    feeds = table(spark, d, "feeds").select("feed_id", "zone")
    parts = [("raw_records", "raw_id", "date"), ("clean_records", "clean_id", "iso_date"), ("permit_records", "permit_id", "date")]
    values = None
    for t, k, c in parts:
        one = table(spark, d, t).where(F.col(c).isNotNull()).select(F.lit(t).alias("src"), "feed_id", F.col(k).cast("bigint").alias("row_id"), F.col(c).alias("value"))
        values = one if values is None else values.unionByName(one)
    return values.join(feeds, "feed_id", "left").withColumn("source", F.col("feed_id").cast("string"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return normal_forms(dated_values(spark, d)).select(F.col("src").alias("src_table"), "row_id", F.col("normal").alias("normal_form"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "release_records")).select("change", "prev_row", "cur_row")


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return parse_lines(table(spark, d, "raw_lines"), table(spark, d, "release_records").select("district"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return rejects(_parsed(spark, d)).select("line_id")


def p6_rejects(spark: SparkSession, d: str) -> DataFrame:
    return rejects(_parsed(spark, d))


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    return records(_parsed(spark, d))


QUERIES = {f.__name__: f for f in (p3_found, p4_found, p5_found, p6_found, p6_rejects, p6_records)}
