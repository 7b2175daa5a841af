"""The life of a publication: corrections, comparison of two lists, snapshots of a state.

Keys are content (land without separators and day), never the row number. Null keys are compared as null equals
null where lists are compared, and match nothing where corrections look up records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def effective(entries: DataFrame, key: str = "seq", supersedes: str = "supersedes") -> DataFrame:
    """Entries that no other entry supersedes."""
    gone = entries.where(F.col(supersedes).isNotNull() & (F.col(supersedes) != F.col(key))).select(F.col(supersedes).alias(key)).distinct()
    return entries.join(gone, key, "left_anti")


def field_values(entries: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row per key with the last value written to each field as ``new_<field>``, and how many entries it came from."""
    last = lambda f: F.max_by(F.when(F.col("field") == f, F.col("to_value")), F.when(F.col("field") == f, F.col("seq"))).alias(f"new_{f}")
    return entries.groupBy(*keys).agg(*[last(f) for f in fields], F.count("*").alias("entries"))


def apply_corrections(records: DataFrame, values: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Records with the corrected fields in place of their own, and ``corrected``."""
    v = values.select(*keys, *[F.col(f"new_{f}") for f in fields], F.lit(True).alias("_hit"))
    j = records.join(v, keys, "left")
    keep = [c for c in records.columns if c not in fields]
    kinds = dict(records.dtypes)
    return j.select(*keep, *[F.coalesce(F.col(f"new_{f}").try_cast(kinds[f]), f).alias(f) for f in fields], F.coalesce("_hit", F.lit(False)).alias("corrected"))


def unmatched(values: DataFrame, records: DataFrame, keys: list[str]) -> DataFrame:
    return values.join(records, keys, "left_anti")


def reconcile(rows: DataFrame, group: list[str], day: str, which: str) -> DataFrame:
    """Per consecutive pair of publications, counts of vanished, new, redated and kept entries.

    ``rows``: one publication per value of ``which`` (1, 2, ...). Within a group both lists share, days are compared
    as multisets; a group in one list only is vanished or new.
    """
    n = rows.groupBy(which, *group, day).agg(F.count("*").alias("n"))
    both = n.withColumn("pair", F.col(which)).withColumn("side", F.lit("prev")).unionByName(n.withColumn("pair", F.col(which) - 1).withColumn("side", F.lit("cur")))
    last = rows.agg(F.max(which)).first()[0]
    per = both.where((F.col("pair") >= 1) & (F.col("pair") < F.lit(last))).groupBy("pair", *group, day).agg(
        F.sum(F.when(F.col("side") == "prev", F.col("n")).otherwise(0)).alias("p"), F.sum(F.when(F.col("side") == "cur", F.col("n")).otherwise(0)).alias("c")
    )
    more = lambda a, b: F.greatest(F.col(a) - F.col(b), F.lit(0))
    g = per.groupBy("pair", *group).agg(F.sum("p").alias("p"), F.sum("c").alias("c"), F.sum(more("p", "c")).alias("lost"), F.sum(more("c", "p")).alias("gained"))
    shared = (F.col("p") > 0) & (F.col("c") > 0)
    only = lambda cond, v: F.sum(F.when(cond, F.col(v)).otherwise(0))
    return g.groupBy("pair").agg(
        only(F.col("c") == 0, "p").alias("vanished"),
        only(F.col("p") == 0, "c").alias("new"),
        F.sum(F.when(shared, F.least("lost", "gained")).otherwise(0)).alias("redated"),
        F.sum(F.when(shared, F.col("p") - F.col("lost")).otherwise(0)).alias("kept"),
    )


def new_cohort(rows: DataFrame, day: str, which: str) -> DataFrame:
    """Rows of each publication newer than the newest day of the one before."""
    top = rows.groupBy(which).agg(F.max(day).alias("_top")).select((F.col(which) + 1).alias(which), "_top")
    return rows.join(top, which).where(F.col(day) > F.col("_top")).drop("_top")


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, flag: str) -> DataFrame:
    """One row: keys lost, gained and shared, flags that went from true to false, and whether nothing is shared."""
    j = before.select(key, F.col(flag).alias("b"), F.lit(1).alias("in_b")).join(after.select(key, F.col(flag).alias("a"), F.lit(1).alias("in_a")), key, "full_outer")
    both = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    return j.agg(
        F.count_if(F.col("in_a").isNull()).alias("lost"),
        F.count_if(F.col("in_b").isNull()).alias("gained"),
        F.count_if(both).alias("shared"),
        F.count_if(both & F.col("b") & ~F.col("a")).alias("regressions"),
        (F.count_if(both) == 0).alias("total_rekey"),
    )


def multiset_minus(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.exceptAll(b)
