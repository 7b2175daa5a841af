"""Coverage of spans by segments: which parts of a span no segment covers.

Defined cases: null ends cover nothing; touching or overlapping segments and gaps up to ``tolerance`` count as
covered; a line without segments leaves its whole span open; repeated segments add nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merged(segments: DataFrame, keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """(keys, lo, hi): the union of each key's segments (lo, hi)."""
    w = Window.partitionBy(*keys).orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    s = segments.where("lo is not null and hi is not null").withColumn("_new", F.when(F.col("lo") > reach + tolerance, 1).otherwise(0))
    island = s.withColumn("_i", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*keys, "_i").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_i")


def uncovered(spans: DataFrame, segments: DataFrame, keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """(columns of spans): the spans (``s_lo``, ``s_hi``) that no merged segment of their key contains within the tolerance."""
    m = merged(segments, keys, tolerance)
    on = [spans[k] == m[k] for k in keys]
    held = (m["lo"] <= spans["s_lo"] + tolerance) & (m["hi"] >= spans["s_hi"] - tolerance)
    cond = held
    for c in on:
        cond = cond & c
    return spans.join(m, cond, "left_anti")
