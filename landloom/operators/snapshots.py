"""What changed between consecutive full snapshots, without a key that lasts.

Every snapshot is sorted by content (its rows' digests) and cut into content-defined chunks: a row whose digest
is divisible by ``chunk_rows`` starts one, so equal content is cut alike whatever lies around it. Chunks whose
digests agree in two consecutive snapshots are dropped; only rows of the other chunks are joined.

Rows are shuffled once, as hashes, by a range of digests; a range holds the same part of every snapshot, so chunks
are cut, digested and compared where they lie, and only what differs moves again.

Two rows are one record if at least two of the three compared values agree, and changed if the third does not.
Values are compared in NFKC form without white space and the separators 、 , and ，.

Defined cases: null equals null, and an empty value counts as null; a record printed several times in one
snapshot counts once, with its smallest row key; if several rows could be partners they are paired one to one in
row order (land and name first, then date and name, then date and land); a single snapshot or an empty table
gives no change; rows are told apart by snapshot id only, so late deliveries and moved positions change nothing.
Unequal lands and names are told apart by 128 bits of hash, days by 64.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import discard, materialize

_DROP = re.compile(r"[\s、,，]+")


@F.pandas_udf(T.StringType())
def match_form(s: pd.Series) -> pd.Series:
    """The form in which values are compared; null and values without content give null."""
    return pd.Series([None if x is None else _DROP.sub("", unicodedata.normalize("NFKC", x)) or None for x in s], dtype=object)


def _wide_hash(c: Column) -> tuple[Column, Column]:
    c = F.coalesce(c, F.lit("\x00"))
    return F.xxhash64(c), F.xxhash64(F.lit("second"), c)


def _content(c: str) -> list[str]:
    # Days are few: 64 bits tell them apart.
    return ["d1"] if c == "d" else [f"{c}1", f"{c}2"]


FIELDS = ["d", "l", "n"]
KEYS = [k for f in FIELDS for k in _content(f)]


def snapshot_rows(df: DataFrame, snapshot: str, row: str, date: str, land: str, name: str, buckets: int) -> tuple[DataFrame, int]:
    """(bucket, ord, h, g, rid, two hashes a field), one row per distinct content of a snapshot; the number of snapshots.

    The rows lie together by bucket, a range of the digest ``h``.
    """
    ids = sorted(r[0] for r in df.select(snapshot).where(F.col(snapshot).isNotNull()).distinct().collect())  # one per delivery
    order = F.array_position(F.array(*[F.lit(i) for i in ids]).cast("array<string>"), F.col(snapshot).cast("string")).cast("int")
    forms = df.where(F.col(snapshot).isNotNull()).select(
        order.alias("ord"), F.col(row).alias("rid"), *[match_form(F.col(c).cast("string")).alias(f) for f, c in zip(FIELDS, (date, land, name))]
    )
    hashed = forms.select("ord", "rid", *[h.alias(k) for f in FIELDS for k, h in zip(_content(f), _wide_hash(F.col(f)))])
    bucket = F.pmod(F.shiftright(F.xxhash64(*KEYS), 7), F.lit(buckets)).cast("int")
    # Grouped by the bucket first, so its partitioning serves every later step.
    near = hashed.withColumn("bucket", bucket).repartition(min(buckets, 50_000), "bucket")
    one = near.groupBy("bucket", "ord", *KEYS).agg(F.min("rid").alias("rid"))
    return one.withColumns({"h": F.xxhash64(*KEYS), "g": F.xxhash64(F.lit("chunk"), *KEYS)}), len(ids)


def unmatched_rows(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """The rows whose chunk isn't in both neighbouring snapshots, with ``seen_before`` and ``seen_after``. Sorts, but no shuffle."""
    sorted_ = Window.partitionBy("bucket", "ord").orderBy("h", "g").rowsBetween(Window.unboundedPreceding, 0)
    starts = F.when(F.pmod("h", F.lit(chunk_rows)) == 0, F.col("h"))
    rows = rows.withColumn("start", F.coalesce(F.max(starts).over(sorted_), F.lit(-(1 << 63))))
    chunk = Window.partitionBy("bucket", "ord", "start")
    digest = ["bucket", "start", "c", "x", "y"]
    rows = rows.withColumns({"c": F.count("*").over(chunk), "x": F.bit_xor("h").over(chunk), "y": F.bit_xor("g").over(chunk)})
    rows = rows.withColumn("ords", F.collect_set("ord").over(Window.partitionBy(*digest)))  # as many as there are snapshots at most
    seen = lambda step: F.array_contains("ords", F.col("ord") + step)
    rows = rows.withColumns({"seen_before": seen(-1), "seen_after": seen(1)})
    return rows.where(~(F.col("seen_before") & F.col("seen_after"))).select("ord", "seen_before", "seen_after", "rid", *KEYS)


def snapshot_changes(
    df: DataFrame,
    snapshot: str = "release_id",
    row: str = "release_row",
    date: str = "iso_date",
    land: str = "land",
    name: str = "name",
    chunk_rows: int = 4,
    rows_per_bucket: int = 50_000,
) -> DataFrame:
    """(snapshot_ord, change, prev_row, cur_row); 0 stands for the missing row. ``snapshot_ord`` counts the earlier one from 1.

    ``rows_per_bucket`` sizes the sorted pieces, ``chunk_rows`` is the mean chunk; neither affects the result.
    """
    buckets = max(16, df.count() // rows_per_bucket)
    rows, n = snapshot_rows(df, snapshot, row, date, land, name, buckets)
    rows = materialize(unmatched_rows(rows, chunk_rows), "unmatched")
    old = rows.where(~F.col("seen_after") & (F.col("ord") < n)).select(F.col("ord").alias("pair"), "rid", F.lit(True).alias("old"), *KEYS)
    new = rows.where(~F.col("seen_before") & (F.col("ord") > 1)).select((F.col("ord") - 1).alias("pair"), "rid", F.lit(False).alias("old"), *KEYS)
    both = old.unionByName(new).groupBy("pair", *KEYS).agg(F.min(F.when(F.col("old"), F.col("rid"))).alias("o"), F.min(F.when(~F.col("old"), F.col("rid"))).alias("n"))
    rest = materialize(both.where(F.col("o").isNull() | F.col("n").isNull()), "unpaired")
    discard(rows)
    pairs = None
    for a, b in (("l", "n"), ("d", "n"), ("d", "l")):
        on = ["pair", *_content(a), *_content(b)]
        rank = Window.partitionBy(*on, F.col("o").isNull()).orderBy(F.coalesce("o", "n"))
        ranked = rest.withColumn("k", F.row_number().over(rank))
        met = ranked.groupBy(*on, "k").agg(F.min("o").alias("o"), F.min("n").alias("n"), F.collect_list(F.struct("o", "n", *KEYS)).alias("rows"))  # at most one of each side
        met = materialize(met, "paired")
        found = F.col("o").isNotNull() & F.col("n").isNotNull()
        step = met.where(found).select("pair", F.col("o").alias("prev_row"), F.col("n").alias("cur_row"))
        pairs = step if pairs is None else pairs.unionByName(step)
        rest = met.where(~found).select("pair", F.explode("rows").alias("r")).select("pair", "r.*")
    left = rest.select(
        "pair",
        F.when(F.col("o").isNull(), F.lit("added")).otherwise(F.lit("removed")).alias("change"),
        F.coalesce("o", F.lit(0)).cast("bigint").alias("prev_row"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("cur_row"),
    )
    return pairs.select("pair", F.lit("changed").alias("change"), "prev_row", "cur_row").unionByName(left).withColumnRenamed("pair", "snapshot_ord")
