"""Aggregations and ordered folds of the dashboard and reports.

Percentiles interpolate linearly; medians of nothing are null; ordered folds carry an explicit order column, whose
ties are broken by the value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize


def half_up(c: Column, places: int) -> Column:
    """Rounding that doesn't depend on the engine: half up after scaling."""
    p = F.lit(float(10**places))
    return F.floor(c * p + 0.5) / p


def with_total(df: DataFrame, key: str, total: str, *aggs: Column) -> DataFrame:
    """The aggregates per key and over all, labelled ``total``, in one pass (rollup)."""
    return df.rollup(key).agg(F.grouping(key).alias("_g"), *aggs).withColumn(key, F.when(F.col("_g") == 1, F.lit(total)).otherwise(F.col(key))).drop("_g")


def spread(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """n, min, quartiles and max of a value per key."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).cast("double").alias("lo"), q.alias("q"), F.max(value).cast("double").alias("hi")).select(
        *keys, "n", "lo", half_up(F.col("q")[0], 1).alias("q1"), half_up(F.col("q")[1], 1).alias("med"), half_up(F.col("q")[2], 1).alias("q3"), "hi"
    )


def zero_filled(df: DataFrame, dims: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """A pivot whose rows are given: combinations without data have zeros. ``dims`` is a small table of literals."""
    got = df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])
    return dims.join(got, keys, "left").select(*keys, *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in measures])


def fold_last(df: DataFrame, keys: list[str], value: str, seq: str, credit: str) -> DataFrame:
    """(keys, value, credit): the last value written, credited to the first writer of its final unbroken run."""
    w = Window.partitionBy(*keys).orderBy(seq)
    marked = df.where(F.col(value).isNotNull()).withColumn("_new", F.coalesce(F.lag(value).over(w) != F.col(value), F.lit(True)))
    return marked.groupBy(*keys).agg(F.max_by(value, seq).alias(value), F.max_by(F.when(F.col("_new"), F.col(credit)), F.when(F.col("_new"), F.col(seq))).alias(credit))


def best_payload(df: DataFrame, key: str, size: Column, seq: str, columns: list[str]) -> DataFrame:
    """Of each key the row with the most filled fields, the first of equals."""
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(size, -F.col(seq))).alias("r")).select(key, "r.*")


def departures(df: DataFrame, keys: list[str], pos: str, tie: str, day: str, block: int = 50_000) -> DataFrame:
    """Per key: dated rows, rows later than the dated one before them, the largest such step in days, and whether the list descends.

    A key's list may be long, so it is walked in blocks of ``block`` positions; blocks meet through their first and
    last days, one row a block.
    """
    d = df.where(F.col(day).isNotNull()).withColumn("_b", F.floor(F.col(pos) / F.lit(block)))
    w = Window.partitionBy(*keys, "_b").orderBy(pos, tie)
    d = d.withColumn("_p", F.lag(day).over(w))
    up = F.col(day) > F.col("_p")
    at = F.struct(pos, tie)
    per = d.groupBy(*keys, "_b").agg(F.count("*").alias("n"), F.count_if(up).alias("u"), F.max(F.when(up, F.datediff(day, "_p"))).alias("m"), F.min_by(day, at).alias("first"), F.max_by(day, at).alias("last"))
    before = F.lag("last").over(Window.partitionBy(*keys).orderBy("_b"))
    per = per.withColumn("_l", before).withColumn("_x", F.col("first") > F.col("_l"))
    total = F.sum("u") + F.count_if("_x")
    step = F.greatest(F.col("m"), F.when(F.col("_x"), F.datediff("first", "_l")))
    return per.groupBy(*keys).agg(F.sum("n").alias("dated"), total.alias("departures"), F.coalesce(F.max(step), F.lit(0)).alias("max_days"), ((total == 0) & (F.sum("n") >= 2)).alias("descends"))


def longest_gap(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Longest time between consecutive rows of a key, or since its last row at the newest of all, in whole seconds."""
    w = Window.partitionBy(*keys).orderBy(ts)
    # Whole seconds on both sides, so engines agree.
    sec = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / 1000000)
    now = df.agg(F.max(sec)).first()[0]
    g = df.withColumns({"_gap": sec - F.lag(sec).over(w), "_s": sec}).groupBy(*keys).agg(F.max("_gap").alias("_g"), (F.lit(now) - F.max("_s")).alias("_open"), F.count("*").alias("n"))
    return g.select(*keys, F.greatest("_g", "_open").alias("max_gap_s"), "n")


def _in_blocks(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` cut into ranges of (keys, order), numbered by ``_b``: a key with any share of the rows lies in many blocks."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = df.repartitionByRange(n, *keys, *order).withColumn("_b", F.spark_partition_id())
    return materialize(ranged, "blocks")  # read by several branches, which must see the same ranges


def islands(df: DataFrame, keys: list[str], order: list[str], what: str) -> DataFrame:
    """Runs of equal ``what`` in order: (keys, island, what, n). Runs are found in blocks, which meet through their ends, one row a block."""
    d = _in_blocks(df.select(*keys, *order, what), keys, order)
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    step = d.withColumn("_s", F.when(F.lag(what).over(w).eqNullSafe(F.col(what)) & F.lag(F.lit(1)).over(w).isNotNull(), 0).otherwise(1))
    run = step.withColumn("_r", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "_b", "_r", what).agg(F.count("*").alias("n"))
    run = materialize(run, "runs")
    ends = run.groupBy(*keys, "_b").agg(F.max("_r").alias("_n"), F.min_by(F.struct(what), "_r").alias("_first"), F.max_by(F.struct(what), "_r").alias("_last"))
    over = Window.partitionBy(*keys).orderBy("_b")
    ends = ends.withColumn("_joined", F.coalesce(F.lag("_last").over(over).eqNullSafe(F.col("_first")) & F.lag("_b").over(over).isNotNull(), F.lit(False)).cast("int"))
    upto = over.rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.select(*keys, "_b", (F.sum("_n").over(upto) - F.col("_n") - F.sum("_joined").over(upto)).alias("_base"))
    on = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in [*keys, "_b"]]
    j = run.alias("x").join(ends.alias("y"), on).select(*[f"x.{k}" for k in keys], (F.col("_r") + F.col("_base")).alias("island"), f"x.{what}", "n")
    return j.groupBy(*keys, "island", what).agg(F.sum("n").alias("n"))


def changes_by_key(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the one before (the first counts as a change)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_prev", F.lag(value).over(w)).withColumn("_first", F.row_number().over(w) == 1).where(F.col("_first") | ~F.col("_prev").eqNullSafe(F.col(value))).drop("_prev", "_first")


def nearest_marked(df: DataFrame, keys: list[str], order: list[str], mark: Column, value: str) -> DataFrame:
    """Each row with the nearest marked row's value above it, else below. Blocks hand their first and last marked value on, one row a block."""
    d = _in_blocks(df.withColumn("_v", F.when(mark, F.col(value))), keys, order)
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    last = lambda c, win: F.last(c, ignorenulls=True).over(win.rowsBetween(Window.unboundedPreceding, -1))
    first = lambda c, win: F.first(c, ignorenulls=True).over(win.rowsBetween(1, Window.unboundedFollowing))
    d2 = d.withColumns({"_above": last("_v", w), "_below": first("_v", w)})
    at = F.when(F.col("_v").isNotNull(), F.struct(*order))
    ends = d.groupBy(*keys, "_b").agg(F.min_by("_v", at).alias("_first"), F.max_by("_v", at).alias("_last"))
    over = Window.partitionBy(*keys).orderBy("_b")
    ends = ends.select(*keys, "_b", last("_last", over).alias("_before"), first("_first", over).alias("_after"))
    on = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in [*keys, "_b"]]
    return d2.alias("x").join(ends.alias("y"), on).select(*[f"x.{c}" for c in df.columns], F.coalesce("_above", "_before", "_below", "_after").alias("nearest"))
