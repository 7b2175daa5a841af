"""Incremental intake with Structured Streaming. Every function takes a batch or a streaming frame alike.

Late rows: with ``late`` set, rows older than the watermark are dropped by windows and their state freed; without it
a batch keeps everything. Null times belong to no window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _timed(df: DataFrame, ts: str, late: str | None) -> DataFrame:
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, late) if late else df


def tumbling(df: DataFrame, ts: str = "ts", length: str = "1 hour", keys: tuple[str, ...] = ("event_type",), value: str = "value", late: str | None = None, slide: str | None = None) -> DataFrame:
    """(start, keys, n, total) per window; sliding with ``slide``."""
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    return _timed(df, ts, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(df: DataFrame, ts: str = "ts", gap: str = "30 minutes", keys: tuple[str, ...] = ("user_id",), late: str | None = None) -> DataFrame:
    return _timed(df, ts, late).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("start"), "n")


def first_offers(df: DataFrame, content: str, ts: str | None = None, late: str | None = None) -> DataFrame:
    """Rows whose content digest has not been seen: within ``late`` where a time is given, so the state stays bounded; else ever, which keeps a digest of everything."""
    d = df.withColumn("sha256", F.sha2(F.col(content), 256))
    return _timed(d, ts, late).dropDuplicatesWithinWatermark(["sha256"]) if ts and late else d.dropDuplicates(["sha256"])


def running_state(df: DataFrame, key: str = "user_id", ts: str = "ts", value: str = "event_type", late: str | None = None, idle_ms: int = 0) -> DataFrame:
    """(key, n, latest, changes): a stateful operator that counts a key's events and the changes of its value, batch after batch in order of time.

    With ``late`` the state of a key is dropped once the watermark is ``idle_ms`` past its last event, so the state is
    bounded by the keys active meanwhile; without it every key is kept, which suits a fixed set of keys. A null value
    is a value of its own.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, latest, changes = state.get if state.exists else (0, None, 0)
        rows = pd.concat(list(batches)).sort_values(ts, kind="stable")
        v = rows[value].astype(object).where(rows[value].notna(), None)
        before = v.shift(1)
        changed = (v != before) & ~(v.isna() & before.isna())
        # The first row changes only against what was kept.
        head = n > 0 and v.iloc[0] != latest
        changes += int(changed.iloc[1:].sum()) + head
        n, latest = n + len(v), v.iloc[-1]
        state.update((n, latest, changes))
        if late:
            state.setTimeoutTimestamp(max(int(rows[ts].max().timestamp() * 1000) + idle_ms, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame({key: [k[0]], "n": [n], "latest": [latest], "changes": [changes]})

    kind = dict(df.dtypes)[key]
    timeout = GroupStateTimeout.EventTimeTimeout if late else GroupStateTimeout.NoTimeout
    return _timed(df.select(key, ts, value), ts, late).groupBy(key).applyInPandasWithState(step, f"`{key}` {kind}, n bigint, latest string, changes bigint", "n bigint, latest string, changes bigint", "update", timeout)


def append_once(stream: DataFrame, target: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda x: x) -> StreamingQuery:
    """Append every available row once; a batch that is run again overwrites its own folder, so nothing is written twice."""

    def write(batch: DataFrame, n: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{target}/batch={n}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The target with each key's latest change in place of its row: union and one aggregation, no table format needed."""
    cols = [c for c in target.columns if c not in keys]
    both = target.withColumn(seq, F.lit(None).cast("bigint")).unionByName(changes.select(*target.columns, F.col(seq).cast("bigint").alias(seq)))
    return both.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.coalesce(seq, F.lit(-(1 << 62)))).alias("r")).select(*keys, "r.*")


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed run still has to do."""
    return work.join(done.select(key), key, "left_anti")


def stream_files(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).parquet(path)


def refresh(held: DataFrame, fetched: DataFrame, keys: list[str], value: str, keep: list[str], label: str) -> DataFrame:
    """Held values after a fetch: (keys, value, status).

    A key of which nothing was fetched stays as it is; fetched values replace; a value no longer fetched is removed,
    but for the labels in ``keep``, which stay and are marked withdrawn. ``keys`` begin with the fetched unit.
    """
    unit = keys[0]
    j = held.join(fetched.select(*keys, F.col(value).alias("_new")), keys, "full_outer").join(fetched.select(unit).distinct().withColumn("_asked", F.lit(True)), unit, "left")
    status = (
        F.when(F.col("_asked").isNull(), "kept")
        .when(F.col("_new").isNotNull() & F.col(value).isNull(), "added")
        .when(F.col("_new").isNotNull() & (F.col("_new") == F.col(value)), "same")
        .when(F.col("_new").isNotNull(), "changed")
        .when(F.col(label).isin(keep), "withdrawn")
        .otherwise("removed")
    )
    out = j.withColumn("status", status).withColumn(value, F.coalesce("_new", value))
    return out.where("status != 'removed'").select(*keys, value, "status")


def due(work: DataFrame, log: DataFrame, key: str, ts: str, now, cooldown: str) -> DataFrame:
    """Work that was never tried or whose last try is older than the cooldown."""
    recent = log.groupBy(key).agg(F.max(ts).alias("_t")).where(F.col("_t") > F.lit(now).cast("timestamp") - F.expr(f"interval {cooldown}"))
    return work.join(recent.select(key), key, "left_anti")
