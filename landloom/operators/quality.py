"""Gates that run before a write: every figure in one pass, then a verdict.

A gate returns its figures as one row and never drops data; ``require`` turns a failed gate into an error with the
exit code of its kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Exit codes of the gate kinds.
EXIT = {"reconcile": 2, "structure": 3, "tripwire": 4, "lock": 5}


class GateFailed(RuntimeError):
    def __init__(self, kind: str, detail: str):
        super().__init__(f"{kind}: {detail}")
        self.exit_code = EXIT[kind]


def require(figures: DataFrame, kind: str) -> None:
    row = figures.first().asDict()
    bad = {k: v for k, v in row.items() if k.startswith("bad_") and v}
    if bad:
        raise GateFailed(kind, ", ".join(f"{k[4:]}={v}" for k, v in sorted(bad.items())))


def missing_numbers(df: DataFrame, number: str, explained: DataFrame | None = None) -> DataFrame:
    """Numbers from 1 to the maximum that are neither present nor explained. The range is generated in parallel."""
    top = df.agg(F.max(number)).first()[0] or 0
    want = df.sparkSession.range(1, top + 1).select(F.col("id").alias(number))
    gone = want.join(df.select(F.col(number).cast("bigint").alias(number)).distinct(), number, "left_anti")
    return gone.join(explained.select(F.col(number).cast("bigint").alias(number)), number, "left_anti") if explained is not None else gone


def partition_figures(members: DataFrame, key: str, group: str, universe: DataFrame) -> DataFrame:
    """Whether groups split the universe: members in several groups, outside it, and missing from all."""
    each = members.groupBy(key).agg(F.count_distinct(group).alias("g"))
    j = each.join(universe.select(key, F.lit(1).alias("u")).distinct(), key, "full_outer")
    return j.agg(F.count("*").alias("keys"), F.count_if(F.col("g") > 1).alias("bad_shared"), F.count_if(F.col("u").isNull()).alias("bad_unknown"), F.count_if(F.col("g").isNull()).alias("bad_missing"))


def figures(df: DataFrame, _more: list[Column] | None = None, **tests: Column) -> DataFrame:
    """Counts of rows that fail each named test, and ``_more`` aggregates, in one pass."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(f"bad_{n}") for n, c in tests.items()], *(_more or []))


def presence(layers: dict[str, DataFrame], key: str) -> DataFrame:
    """(pattern, n): in which layers each key is found, as a string of 1 and 0 in the order given."""
    names = list(layers)
    tagged = None
    for n in names:
        one = layers[n].select(F.col(key).cast("string").alias("k"), F.lit(n).alias("layer")).where("k is not null")
        tagged = one if tagged is None else tagged.unionByName(one)
    per = tagged.groupBy("k").agg(*[F.max((F.col("layer") == n).cast("int")).alias(n) for n in names])
    return per.groupBy(F.concat(*[F.col(n).cast("string") for n in names]).alias("pattern")).agg(F.count("*").alias("n"))
