"""Decisions over cases and their sources as pure operators: live ones, precedence, disagreement, gates.

Null values take no part in a comparison; ties are broken by the key; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def live(df: DataFrame, group: str, state: str, dead: list[str], none: str) -> DataFrame:
    """The rows of states that aren't ``dead``; rows of the state ``none`` yield where their group has others. Counts are joined back, so no group is sorted."""
    alive = df.where(~F.coalesce(F.col(state).isin(*dead), F.lit(False)))
    others = alive.where(F.coalesce(F.col(state) != none, F.lit(True))).select(group).distinct().withColumn("_o", F.lit(True))
    j = alive.join(others, group, "left")
    return j.where(F.col("_o").isNull() | F.coalesce(F.col(state) != none, F.lit(True))).drop("_o")


def awaiting(df: DataFrame, group: list[str], label: str, asked: list[str], answered: list[str]) -> DataFrame:
    """The groups that have one of the labels ``asked`` and none of ``answered``."""
    g = df.groupBy(*group).agg(F.bool_or(F.col(label).isin(*asked)).alias("a"), F.bool_or(F.col(label).isin(*answered)).alias("b"))
    return g.where(F.coalesce("a", F.lit(False)) & ~F.coalesce("b", F.lit(False))).select(*group)


def first_class(text: Column, classes: list[tuple[str, str]], other: Column) -> Column:
    """The class of the first keyword, in order of precedence, that a text holds."""
    out = F.when(text.contains(classes[0][0]), classes[0][1])
    for word, name in classes[1:]:
        out = out.when(text.contains(word), name)
    return out.otherwise(other)


def disagreement(one: Column, two: Column, witnesses: Column) -> Column:
    """Which of two differing values a list of witnesses confirms: one, two, both, neither, or none without witnesses; null where they agree or one is missing."""
    held = lambda c: F.array_contains(witnesses, c)
    which = F.when(F.size(witnesses) == 0, "none").when(held(one) & held(two), "both").when(held(one), "one").when(held(two), "two").otherwise("neither")
    return F.when(one.isNotNull() & two.isNotNull() & (one != two), which)


def verdict(accept: Column, reason: Column) -> Column:
    return F.struct(accept.alias("accept"), reason.alias("reason"))


def precedence(*sources: tuple[str, DataFrame], key: str, value: str) -> DataFrame:
    """(key, value, source) by the first source that has exactly one value of the key; where the first source to have any has several: null, with ``ambiguous``."""
    tagged = None
    for i, (name, df) in enumerate(sources):
        one = df.groupBy(key).agg(F.min(value).alias("lo"), F.max(value).alias("hi")).select(key, "lo", "hi", F.lit(i).alias("i"), F.lit(name).alias("source"))
        tagged = one if tagged is None else tagged.unionByName(one)
    best = tagged.groupBy(key).agg(F.min_by(F.struct("lo", "hi", "source"), "i").alias("b"))
    single = F.col("b.lo") == F.col("b.hi")
    return best.select(key, F.when(single, F.col("b.lo")).alias(value), F.when(single, F.col("b.source")).otherwise("ambiguous").alias("source"))


def conflicts(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, copies, conflicts): the fields in which the copies of a key say different things; extremes are compared, so no copies are gathered."""
    said = lambda f: F.nullif(F.col(f).cast("string"), F.lit(""))
    g = df.groupBy(key).agg(F.count("*").alias("copies"), *[x.alias(f"{p}_{f}") for f in fields for p, x in (("lo", F.min(said(f))), ("hi", F.max(said(f))))])
    return g.select(key, "copies", F.concat_ws("|", *[F.when(F.col(f"lo_{f}") != F.col(f"hi_{f}"), F.lit(f)) for f in fields]).alias("conflicts"))
