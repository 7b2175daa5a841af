"""Consolidating pairwise matches into groups: connected components by alternating star rewrites.

A large-star step links every node's greater neighbours to its least neighbour, a small-star step its smaller ones;
repeated until nothing changes, every node hangs on its component's least node. Each step is one aggregation with
map-side combine and one join; the edges never leave the cluster, and each round is written to the shared folder, so
a lost executor costs at most one round.

Nodes with a large share of the edges would make their join partition hot; fewer than 500 can have more than one
edge in 500, and only their rows are broadcast, so their edges are joined where they lie (``skew.hot_join``).

Defined cases: null and blank nodes link nothing; self-links and repeated or mirrored pairs add nothing; a node
without links to others is in no group; no edges give no rows; nodes are compared by code point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nfkc, no_space
from ..operators.skew import PARTS, hot_join
from ..runtime import discard, materialize


def core_form(c: Column) -> Column:
    """Land cores are compared and given in NFKC form without white space; blank ones are null."""
    return F.nullif(no_space(nfkc(c)), F.lit(""))


def _with_least(sym: DataFrame, count: int, hot_degree: int, hottest: int) -> DataFrame:
    """(u, v, m): each directed edge with the least of u and its neighbours. ``hottest`` bounds the edges of one node."""
    stat = sym.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("deg"))
    if hottest <= max(hot_degree, count // PARTS):
        return sym.join(stat.drop("deg"), "u")
    return hot_join(sym, stat, ["u"], "deg", count, least=hot_degree)


def _directed(e: DataFrame) -> DataFrame:
    return e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _edges(pairs: DataFrame, u: Column, v: Column) -> DataFrame:
    """Distinct edges with u > v."""
    return pairs.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(F.col("u") != F.col("v")).distinct()


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", F.lit(1), "u"))).first()
    return tuple(r)


def _hottest(e: DataFrame) -> int:
    """The most edges any node has, on either side."""
    return _directed(e).groupBy("u").count().agg(F.max("count")).first()[0] or 0


def connected_components(pairs: DataFrame, a: str = "a", b: str = "b", hot_degree: int = 100_000, max_rounds: int = 100) -> DataFrame:
    """(node, component) of every node linked to another; the component is its least node.

    Nodes are numbered once in their order, so the rounds move two 64-bit numbers an edge.
    """
    given = materialize(_edges(pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()), F.col(a), F.col(b)), "links")
    names = given.select(F.col("u").alias("node")).unionByName(given.select(F.col("v").alias("node"))).distinct()
    ids = materialize(names.orderBy("node").withColumn("id", F.monotonically_increasing_id()), "nodes")
    side = lambda c: ids.select(F.col("node").alias(c), F.col("id").alias(f"{c}_id"))
    e = materialize(given.join(side("u"), "u").join(side("v"), "v").select(F.col("u_id").alias("u"), F.col("v_id").alias("v")), "edges")
    discard(given)
    mark = _mark(e)
    for _ in range(max_rounds):
        hottest = _hottest(e)
        large = _with_least(_directed(e), 2 * mark[0], hot_degree, hottest).where(F.col("v") > F.col("u"))
        e1 = materialize(_edges(large, F.col("v"), F.col("m")), "large")
        # Small star: of each node only its smaller neighbours, so the edges as they lie.
        small = _with_least(e1.select("u", "v"), mark[0], hot_degree, mark[0])
        linked = small.select(F.col("v").alias("x"), "m").unionByName(small.select(F.col("u").alias("x"), "m"))
        e2 = materialize(_edges(linked, F.col("x"), F.col("m")), "small")
        new = _mark(e2)
        discard(e)
        discard(e1)
        e = e2
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = e.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("root"))
    label = e.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)
    name = ids.select(F.col("id").alias("root"), F.col("node").alias("component"))
    return label.join(ids, "id").join(name, "root").select("node", "component")


def core_links(corrections: DataFrame, projects: DataFrame) -> DataFrame:
    """(a, b): links between land cores, from confirmed merges and from borderline pairs of records."""
    merges = corrections.where(F.col("confirm_merge")).select(core_form(F.col("match_land_core")).alias("a"), core_form(F.col("with_land_core")).alias("b"))
    cores = projects.select(core_form(F.col("land_core")).alias("core"), "member_recnos", "borderline")
    member = cores.select("core", F.explode("member_recnos").alias("recno"))
    pair = cores.select(F.explode("borderline").alias("p")).select("p.a", "p.b").where("a is not null and b is not null").distinct()
    found = pair.join(member.select(F.col("recno").alias("a"), F.col("core").alias("ca")), "a").join(member.select(F.col("recno").alias("b"), F.col("core").alias("cb")), "b")
    return merges.unionByName(found.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).where("a is not null and b is not null")
