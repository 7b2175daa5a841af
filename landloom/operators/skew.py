"""Joins in which a few keys may hold any share of the left side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than one part in ``PARTS`` of the rows; so there are fewer than ``PARTS`` hot keys.
PARTS = 500


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], count: str, total: int, how: str = "inner", least: int = 100_000) -> DataFrame:
    """``left`` joined (inner or left_semi) to ``right``, which has each key once with its ``count`` of left rows.

    Rows of hot keys are joined where they lie against a broadcast of the hot keys, fewer than ``PARTS`` rows by
    definition; the others are shuffled. ``count`` is dropped. Null keys match nothing. ``right`` is read twice, so it
    should be cheap to read.
    """
    top = max(least, total // PARTS)
    extra = [c for c in right.columns if c not in keys and c != count] if how == "inner" else []
    hot = right.where(F.col(count) > top).select(*keys, *extra, F.lit(True).alias("_hot"))
    rest = right.where(F.col(count) <= top).select(*keys, *extra)
    cols = [*left.columns, *extra]
    tagged = left.join(F.broadcast(hot), keys, "left")
    done = tagged.where("_hot").select(*cols)
    cold = tagged.where("_hot is null").select(*left.columns)
    # Sorted on both sides at every size, so the plan does not change with the data.
    return done.unionByName(cold.join(rest.hint("merge"), keys, how).select(*cols))
