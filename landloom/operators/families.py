"""Families of approvals: candidate pairs, similarity, components, anchors, names and edges.

Records that agree in everything the score reads form one class; pairs are between class representatives (the lowest
record number) and membership is given apart, so repeated records never multiply. Pairs meet at a shared parcel
number within a section, which every pair of score 0.5 or more has, or at a named anchor, through which each record
is linked to the lowest one only.

Defined cases: missing numbers and texts are 0 and ''; a record without section or parcels is its own family;
record numbers are unique; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.land import land_core, parcel_set, record_score
from ..runtime import discard, materialize

SIDE = ["district", "section", "first", "parcels", "aliases", "count", "orig", "anchor"]
LINK, BORDER = 0.7, 0.5


def classes(rec: DataFrame) -> DataFrame:
    """(rep, recno) with the scored columns: every record with the lowest record of its class. Classes are told apart by 128 bits of hash, so lists aren't shuffled to compare them."""
    h = ["_h1", "_h2"]
    rec = rec.select("recno", *SIDE, F.xxhash64(*SIDE).alias("_h1"), F.xxhash64(F.lit("second"), *SIDE).alias("_h2"))
    rep = rec.groupBy(*h).agg(F.min("recno").alias("rep"))
    return rec.join(rep, h).select("rep", "recno", *SIDE)


def _sides(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    one = reps.select(F.col("recno").alias("a"), *[F.col(c).alias(f"a_{c}") for c in SIDE])
    two = reps.select(F.col("recno").alias("b"), *[F.col(c).alias(f"b_{c}") for c in SIDE])
    return pairs.join(one, "a").join(two, "b")


def scored_pairs(reps: DataFrame) -> DataFrame:
    """(a, b, score) with a < b of every pair of representatives that share a present or former parcel in their section, or an anchor."""
    tok = reps.select("recno", "district", "section", F.explode(F.array_union(parcel_set(F.col("parcels"), F.col("aliases")), F.array("first"))).alias("t")).where("t != ''")
    met = tok.select(F.col("recno").alias("a"), "district", "section", "t").join(tok.select(F.col("recno").alias("b"), "district", "section", "t"), ["district", "section", "t"])
    near = met.where("a < b").select("a", "b").distinct()
    named = reps.where("anchor != ''").select("recno", "anchor")
    star = named.join(named.groupBy("anchor").agg(F.min("recno").alias("a")), "anchor").where("a < recno").select("a", F.col("recno").alias("b"))
    both = _sides(near.unionByName(star).distinct(), reps)
    side = lambda p: {c: F.col(f"{p}_{c}") for c in SIDE}
    return both.select("a", "b", record_score(side("a"), side("b")).alias("score"))


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(recno, family) of every node: least-label propagation with label jumping until nothing changes.

    Each round every node takes the least label of its neighbours and then its label's label, so long chains shrink
    by more than half. Labels are written to the shared folder each round.
    """
    sym = materialize(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct(), "sym")
    label = materialize(nodes.select("recno", F.col("recno").alias("family")), "label")
    for _ in range(max_rounds):
        low = sym.join(label.select(F.col("recno").alias("y"), "family"), "y").groupBy("x").agg(F.min("family").alias("low"))
        step = label.join(low.withColumnRenamed("x", "recno"), "recno", "left").select("recno", F.least("family", F.coalesce("low", "family")).alias("family"))
        hop = step.join(step.select(F.col("recno").alias("family"), F.col("family").alias("next")), "family").select("recno", F.least("family", "next").alias("family"))
        new = materialize(hop, "label")
        changed = new.join(label.withColumnRenamed("family", "was"), "recno").where("family != was").limit(1).count()
        discard(label)
        label = new
        if not changed:
            return label
    raise RuntimeError("no fixed point")


def families(rec: DataFrame) -> DataFrame:
    """(recno, family): every record with the lowest record number of its family."""
    member = materialize(classes(rec), "classes")
    reps = member.where("rep = recno").select("recno", *SIDE)
    links = scored_pairs(reps).where(F.col("score") >= LINK)
    label = components(reps.select("recno"), links)
    return member.select("recno", F.col("rep")).join(label.select(F.col("recno").alias("rep"), "family"), "rep").select("recno", "family")


def anchors(rec: DataFrame) -> DataFrame:
    """(family, anchor_recno): the newest member, of equal days the lowest number; undated members come last."""
    return rec.groupBy("family").agg(F.max_by("recno", F.struct(F.coalesce("day", F.lit("")), -F.col("recno"))).alias("anchor_recno"))


def slugs(rec: DataFrame) -> DataFrame:
    """(family, anchor_recno, slug): place, parcel and count of the anchor; the count of the highest member that has one fills in."""
    a = anchors(rec)
    size = rec.where("count > 0").groupBy("family").agg(F.max_by("count", "recno").alias("any"))
    at = rec.select(F.col("recno").alias("anchor_recno"), "district", "section", "first", "count")
    j = a.join(at, "anchor_recno").join(size, "family", "left")
    count = F.coalesce(F.nullif("count", F.lit(0)), F.col("any"))
    slug = F.when(F.col("section") == "", F.concat(F.lit("未解析-"), F.col("anchor_recno").cast("string"))).otherwise(
        F.concat_ws("-", "district", "section", F.concat("first", F.lit("地號等"), F.coalesce(count.cast("string"), F.lit("?")), F.lit("筆")))
    )
    return j.select("family", "anchor_recno", slug.alias("slug"))


def project_ids(slugged: DataFrame) -> DataFrame:
    """(family, anchor_recno, project_id): the n-th repeat of a slug in anchor order gets ``-n``."""
    n = F.row_number().over(Window.partitionBy("slug").orderBy("anchor_recno"))
    s = slugged.withColumn("n", n)
    return s.select("family", "anchor_recno", F.when(F.col("n") > 1, F.concat("slug", F.lit("-"), F.col("n").cast("string"))).otherwise(F.col("slug")).alias("project_id"))


def edges(rec: DataFrame) -> DataFrame:
    """(family, frm, to, kind): consecutive members by (day, number); the same within each track; between areas of one stage and track."""
    order = [F.coalesce("day", F.lit("")), F.col("recno")]
    step = lambda df, keys, kind, by=order: (
        df.select("family", F.col("recno").alias("frm"), F.lead("recno").over(Window.partitionBy(*keys).orderBy(*by)).alias("to"), F.lit(kind).alias("kind")).where("to is not null")
    )
    revision = step(rec, ["family"], "revision")
    track = step(rec.withColumn("t", F.explode(F.split("track", "、"))).where("t != ''"), ["family", "t"], "track")
    several = rec.where("area != ''").groupBy("family", "stage_index", "track").agg(F.count_distinct("area").alias("n")).where("n > 1").drop("n")
    section = step(rec.join(several, ["family", "stage_index", "track"], "left_semi"), ["family", "stage_index", "track"], "section", [F.col("recno")])
    return revision.unionByName(track).unionByName(section).distinct()


def core_of(rec: DataFrame) -> DataFrame:
    return rec.withColumn("land_core", land_core(F.col("district"), F.col("section"), F.col("first"), F.col("count")))
