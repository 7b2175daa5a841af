"""Joins that match or refuse: one candidate or none, tiers, tolerances, overlaps, one-to-one pairing.

Null keys match nothing unless stated; ties are broken by the keys named last, so results are repeatable; empty
inputs give empty results; further columns pass through where the docstring doesn't name the output.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import discard, materialize


def unique_or_nothing(df: DataFrame, keys: list[str], candidate: str) -> DataFrame:
    """(keys, ``candidate``) where a key has exactly one distinct candidate. One aggregation with map-side combine."""
    lo, hi = F.min(candidate), F.max(candidate)
    return df.where(F.col(candidate).isNotNull()).groupBy(*keys).agg(lo.alias("_lo"), hi.alias("_hi")).where(F.col("_lo") == F.col("_hi")).select(*keys, F.col("_lo").alias(candidate))


def first_tier(tiers: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of the first tier (in list order) that has any for the key, with ``tier`` counted from 1."""
    tagged = reduce(DataFrame.unionByName, [t.withColumn("tier", F.lit(i)) for i, t in enumerate(tiers, 1)])
    best = tagged.groupBy(*keys).agg(F.min("tier").alias("tier"))
    return tagged.join(best, [*keys, "tier"])


def by_date(left: DataFrame, right: DataFrame, on: list[str], left_key: str, right_key: str, left_day: str, right_day: str, days: int = 1) -> DataFrame:
    """(``left_key``, ``right_key``, tier): equal day and unique (tier 1), else within ``days`` and unique (tier 2).

    The tolerance is an equi-join: the right side is repeated once per day of the range.
    """
    a = left.select(*on, left_key, F.col(left_day).alias("_d"))
    b = right.select(*on, right_key, F.col(right_day).alias("_r")).where("_r is not null")
    exact = unique_or_nothing(a.join(b.withColumnRenamed("_r", "_d"), [*on, "_d"]).select(left_key, right_key), [left_key], right_key)
    spread = b.select(*on, right_key, F.explode(F.sequence(F.date_sub("_r", days), F.date_add("_r", days))).alias("_d")).distinct()
    rest = a.join(exact, left_key, "left_anti")
    near = unique_or_nothing(rest.join(spread, [*on, "_d"]).select(left_key, right_key), [left_key], right_key)
    return exact.withColumn("tier", F.lit(1)).unionByName(near.withColumn("tier", F.lit(2)))


def drift_join(left: DataFrame, right: DataFrame, on: list[str], left_day: str, right_day: str, days: int) -> DataFrame:
    """All pairs on equal keys whose days differ by no more than ``days``: equi-join on day buckets, then the check."""
    bucket = lambda c: F.floor(F.unix_date(F.col(c)) / F.lit(days + 1)).cast("int")
    a = left.withColumn("_b", F.explode(F.array(*[bucket(left_day) + i for i in (-1, 0, 1)])))
    b = right.withColumn("_b", bucket(right_day))
    return a.join(b, [*on, "_b"]).where(F.abs(F.datediff(F.col(left_day), F.col(right_day))) <= days).drop("_b")


def prefix_completion(cut: DataFrame, whole: DataFrame, on: list[str], text: str, tokens: str, key: str, label: str) -> DataFrame:
    """(``key``, completed): the least ``label`` of the whole rows with equal ``on`` whose ``text`` a cut one begins and that hold all its ``tokens`` (array)."""
    a = cut.select(*on, key, F.col(text).alias("_cut"), F.col(tokens).alias("_seen"))
    b = whole.select(*on, F.col(text).alias("_whole"), F.col(tokens).alias("_held"), F.col(label).alias("_label")).distinct()
    hit = a.join(b, on).where(F.col("_whole").startswith(F.col("_cut")) & (F.length("_whole") > F.length("_cut")) & (F.size(F.array_except("_seen", "_held")) == 0))
    return hit.groupBy(key).agg(F.min("_label").alias("completed"))


def best_overlap(left: DataFrame, right: DataFrame, left_key: str, right_key: str, token: list[str]) -> DataFrame:
    """(``left_key``, ``right_key``, shared): the right rows that share most tokens, ties kept. Inputs are (key, tokens), exploded."""
    shared = left.select(left_key, *token).distinct().join(right.select(right_key, *token).distinct(), token).groupBy(left_key, right_key).agg(F.count("*").alias("shared"))
    top = shared.groupBy(left_key).agg(F.max("shared").alias("shared"))
    return shared.join(top, [left_key, "shared"]).select(left_key, right_key, "shared")


def single_witness(overlap: DataFrame, left_key: str, right_key: str, evidence: DataFrame) -> DataFrame:
    """(``left_key``, ``right_key``, how): the only best row, or the only one of several that ``evidence`` (left, right) names; else none."""
    n = overlap.groupBy(left_key).agg(F.count("*").alias("n"), F.min(right_key).alias("one"))
    named = unique_or_nothing(overlap.join(evidence, [left_key, right_key], "left_semi"), [left_key], right_key).withColumnRenamed(right_key, "named")
    j = n.join(named, left_key, "left")
    how = F.when(F.col("n") == 1, "only").when(F.col("named").isNotNull(), "named").otherwise("ambiguous")
    return j.select(left_key, F.when(F.col("n") == 1, F.col("one")).otherwise(F.col("named")).alias(right_key), how.alias("how"))


def gap_ranges(held: DataFrame, keys: list[str], number: str) -> DataFrame:
    """(``keys``, first, last): the ranges of numbers between two held ones that the key doesn't hold. As many rows as numbers at most, however wide the gaps."""
    n = held.where(F.col(number).isNotNull()).select(*keys, F.col(number).cast("bigint").alias("_n")).distinct()
    gaps = n.withColumn("_m", F.lead("_n").over(Window.partitionBy(*keys).orderBy("_n"))).where("_m - _n > 1")
    return gaps.select(*keys, (F.col("_n") + 1).alias("first"), (F.col("_m") - 1).alias("last"))


def gap_ids(held: DataFrame, stem: str, number: str, block: int = 1000) -> DataFrame:
    """(``stem``, ``number``): each number of ``gap_ranges``, written out in blocks, so a wide gap makes no long array. For narrow spans: a row a number."""
    gaps = gap_ranges(held.where(F.col(stem).isNotNull()), [stem], number)
    starts = gaps.select(stem, "last", F.explode(F.sequence("first", "last", F.lit(block).cast("bigint"))).alias("_s"))
    each = starts.select(stem, F.explode(F.sequence("_s", F.least(F.col("_s") + (block - 1), F.col("last")))).alias("_g"))
    return each.select(stem, F.col("_g").cast(dict(held.dtypes)[number]).alias(number))


def superseded(cases: DataFrame, on: list[str], key: str, evidence: str, least: int = 1) -> DataFrame:
    """(``key``, successor): the only later case with equal ``on`` whose evidence (array) holds all of this one's.

    Chains of equal keys are matched by evidence values, not by all pairs of a group: a case and its successor share
    every value, so they meet at the least one.
    """
    a = cases.where(F.size(evidence) >= least).select(*on, F.col(key).alias("_k"), F.col(evidence).alias("_e"), F.array_min(evidence).alias("_m"))
    b = cases.select(*on, F.col(key).alias("successor"), F.col(evidence).alias("_f"), F.explode(F.array_distinct(evidence)).alias("_m"))
    hit = a.join(b, [*on, "_m"]).where((F.col("successor") > F.col("_k")) & (F.size(F.array_except("_e", "_f")) == 0))
    return unique_or_nothing(hit.select(F.col("_k").alias(key), "successor"), [key], "successor")


def votes(old: DataFrame, new: DataFrame, old_id: str, new_id: str, member: list[str]) -> DataFrame:
    """(old, new, votes): members that two groups have in common. Inputs are (id, members)."""
    return old.select(old_id, *member).distinct().join(new.select(new_id, *member).distinct(), member).groupBy(old_id, new_id).agg(F.count("*").alias("votes"))


def unique_top(scored: DataFrame, key: str, other: str, score: str) -> DataFrame:
    """Of each key the other with the highest score, if no second has it."""
    top = scored.groupBy(key).agg(F.max(score).alias(score))
    return unique_or_nothing(scored.join(top, [key, score]), [key, score], other)


def claimed_once(pairs: DataFrame, scope: list[str], left: str, right: str, rank: list[Column]) -> DataFrame:
    """The pairs in which ``right`` is taken for the first time within ``scope``, by ``rank``; those that come later have nothing."""
    return pairs.groupBy(*scope, right).agg(F.min_by(left, F.struct(*rank)).alias(left)).select(*scope, left, right)


def one_to_one(scored: DataFrame, left: str, right: str, score: str, max_rounds: int | None = None) -> DataFrame:
    """Greedy one-to-one pairing, strongest first, ties by left then right.

    Each round takes every pair that is the best of both its sides, which the greedy order would take too, and drops
    the pairs of what is taken; the strongest remaining pair always qualifies, so it ends. With ``max_rounds``, an
    error if pairs remain after so many.
    """
    order = F.struct(F.col(score), -F.col(left), -F.col(right))
    rest, taken, rounds = materialize(scored.select(left, right, score), "pairs"), None, 0
    while True:
        bl = rest.groupBy(left).agg(F.max(order).alias("_o"))
        br = rest.groupBy(right).agg(F.max(order).alias("_o"))
        best = materialize(rest.withColumn("_o", order).join(bl, [left, "_o"], "left_semi").join(br, [right, "_o"], "left_semi").select(left, right, score), "best")
        if best.isEmpty():
            break
        if rounds == max_rounds:
            raise RuntimeError(f"pairs remain after {max_rounds} rounds")
        rounds += 1
        taken = best if taken is None else taken.unionByName(best)
        if rounds % 50 == 0:  # a long chain of ties takes a round a pair
            taken = materialize(taken, "taken")
        new = materialize(rest.join(best.select(left), left, "left_anti").join(best.select(right), right, "left_anti").select(left, right, score), "pairs")
        discard(rest)
        rest = new
    return taken if taken is not None else rest


def best_similar(left: DataFrame, right: DataFrame, left_key: str, right_key: str, tokens: str, on: list[str]) -> DataFrame:
    """(``left_key``, ``right_key``, jaccard): the most similar right row on equal keys by token overlap; ties by the lower key.

    Only rows that share a token meet; others have no overlap.
    """
    a = left.select(*on, left_key, F.array_distinct(tokens).alias("_a"))
    b = right.select(*on, right_key, F.array_distinct(tokens).alias("_b"))
    hit = a.withColumn("_t", F.explode("_a")).join(b.withColumn("_t", F.explode("_b")), [*on, "_t"])
    n = hit.groupBy(left_key, right_key).agg(F.count("*").alias("_n"), F.first(F.size("_a") + F.size("_b")).alias("_s"))
    scored = n.select(left_key, right_key, (F.col("_n") / (F.col("_s") - F.col("_n"))).alias("jaccard"))
    return scored.groupBy(left_key).agg(F.max_by(F.struct(F.col(right_key), "jaccard"), F.struct(F.col("jaccard"), -F.col(right_key))).alias("r")).select(left_key, f"r.{right_key}", "r.jaccard")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in the given order, by aggregation: no key is sorted in one task."""
    cols = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("r")).select(*keys, "r.*")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    cols = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("r")).select(*keys, "r.*")


def rank_in(keys: list[str], order: list[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def coalesce_merge(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer merge: the first side's value wins, the second fills in; arrays are united in order."""
    kinds = dict(first.dtypes)
    rest = [c for c in first.columns if c not in keys]
    j = first.join(second.select(*keys, *[F.col(c).alias(f"_{c}") for c in rest]), keys, "full_outer")
    empty = lambda c: F.array().cast(kinds[c])
    pick = lambda c: F.array_union(F.coalesce(c, empty(c)), F.coalesce(f"_{c}", empty(c))) if kinds[c].startswith("array") else F.coalesce(c, f"_{c}")
    return j.select(*keys, *[pick(c).alias(c) for c in rest])


def member_changes(old: DataFrame, new: DataFrame, pairs: DataFrame, old_id: str, new_id: str, member: str) -> DataFrame:
    """(old, new, added, lost, change) of each matched pair of groups: grew, shrank, both or same."""
    side = lambda df, k, n: pairs.join(df, k).select(old_id, new_id, F.col(member).alias("m"), F.lit(n).alias("side")).distinct()
    both = side(old, old_id, 1).unionByName(side(new, new_id, 2))
    each = both.groupBy(old_id, new_id, "m").agg(F.sum("side").alias("s"))
    g = each.groupBy(old_id, new_id).agg(F.count_if(F.col("s") == 2).alias("added"), F.count_if(F.col("s") == 1).alias("lost"))
    change = F.when((F.col("added") > 0) & (F.col("lost") > 0), "both").when(F.col("added") > 0, "grew").when(F.col("lost") > 0, "shrank").otherwise("same")
    return g.withColumn("change", change)
