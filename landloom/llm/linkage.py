"""Matching entities across sources without keys: probabilistic record linkage.

Approvals, city cases and building permits are brought to comparable attributes, candidate pairs come from several
blocking passes, each pair becomes a vector of agreement levels, and the match and non-match probabilities of the
levels are estimated by expectation-maximisation without labels. A pair's posterior is its confidence, and decides:
pairs of at least ``least`` are links, of which a search takes the approval, and a permit the unit, with the most.

A search is linked in two steps, each with a model of its own: to land units by what they say of the land, then to one
of the unit's approvals by stage, day, year of filing and kind of plan. Permits speak of land only: one step.

Texts that are only compared are carried as 64-bit numbers, so joins and sorts move no strings; two texts with one number
would give a candidate pair more, which the levels judge.

Scale: blocks are a section and a parcel number (permits with the district), or a district and a day, and pair a search
or permit with the few land units that hold them, never with each other. Only the counts of the distinct agreement vectors (a fixed number
of combinations) reach the driver; the posteriors come back as a table of that size. Approvals that are one record
printed twice are one candidate; their rows are listed at the end, as every one of them is asked for.

Defined cases: null and blank attributes are a level of their own, not a disagreement; a search without section,
number, district and day, and a permit without section and number, is in no block; equally likely candidates are
taken by the nearest day, then the earliest approval, then the lowest number; empty tables give no rows; a date that
is missing is taken from a copy of the record or from its city case, and otherwise bounded by the unit's earlier and
later stages. No result depends on the order of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.land import NUMERALS, STAGE_HEAD, STAGE_TAIL, cn_to_int, normalize_name
from ..functions.moments import readings
from ..functions.text import fold_width, no_space
from ..runtime import materialize

_HAN = "[一-鿿]"
_PARCEL = r"([0-9]+)(?:[-之]([0-9]+))?地(?:號|等號)"
_SECTION = f"{_HAN}{{2}}段?{_HAN}?[0-9一二三四五六七八九]小段|{_HAN}{{2,3}}段"


def _said(c: Column, pattern: str, i: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))


def _number(c: Column) -> Column:
    return F.regexp_replace(c, "^0+(?=[0-9])", "")


def _key(section: Column) -> Column:
    return F.nullif(F.translate(F.regexp_replace(section, "[段小]", ""), "123456789", NUMERALS), F.lit(""))


def section_key(c: Column) -> Column:
    """A section's name without place, and without the words for section and subsection, its number as a numeral; null if nothing is left."""
    t = F.regexp_replace(no_space(fold_width(c)), f"^(?:[臺台]北市)?(?:{_HAN}{{2}}區)?", "")
    return _key(t)


def with_headings(df: DataFrame, **texts: str) -> DataFrame:
    """``df`` with a struct (dist, sec, parcel, cnt, stage, track) read from each case name or searched land; null where it doesn't say.

    One projection a step, and several groups from one match, so that no pattern is matched twice.
    """
    each = lambda f: {f"_{n}_{k}": v for n in texts for k, v in f(lambda k: F.col(f"_{n}_{k}")).items()}
    parts = lambda c, pattern, groups: F.split(F.regexp_replace(c, pattern, groups), "\t")
    df = df.withColumns({f"_{n}_t": normalize_name(fold_width(F.col(c))) for n, c in texts.items()})
    df = df.withColumns(each(lambda c: {
        "p": parts(c("t"), f"^(.*?){_PARCEL}.*$", "$1\t$2\t$3"), "n": F.regexp_extract(c("t"), "地?等號?([0-9]+)筆", 1),
        "w": F.coalesce(_said(c("t"), STAGE_HEAD), _said(c("t"), STAGE_TAIL)),
        "track": F.concat(F.when(c("t").contains("事業計畫"), "b").otherwise(""), F.when(c("t").contains("權利變換"), "r").otherwise("")),
    }))
    df = df.withColumns(each(lambda c: {
        "place": F.when(F.size(c("p")) == 3, F.get(c("p"), F.lit(0))), "main": _number(F.get(c("p"), F.lit(1))), "below": _number(F.get(c("p"), F.lit(2))),
        "nth": F.regexp_extract(c("w"), "第([一二三四五六七八九十]+)次", 1),
    }))
    df = df.withColumns(each(lambda c: {
        "d": parts(c("place"), f"^(.*?)({_HAN}{{2}}區)(.*)$", "$2\t$3"), "parcel": F.when(c("below") == "", c("main")).otherwise(F.concat(c("main"), F.lit("-"), c("below"))),
        "stage": F.when(c("w").startswith("擬"), 0).when(c("nth") != "", cn_to_int(c("nth"))).when(c("w").isNotNull(), 1).cast("int"),
    }))
    df = df.withColumns(each(lambda c: {
        "dist": F.when(F.size(c("d")) == 2, F.get(c("d"), F.lit(0))),
        "rest": F.when(F.size(c("d")) == 2, F.get(c("d"), F.lit(1))).otherwise(F.regexp_replace(c("place"), r"^(?:擬[訂定]|變更(?:\(第.次\))?)?(?:[臺台]北市)?", "")),
    }))
    # The section is the last part of the place; an implementer may stand before it.
    df = df.withColumns(each(lambda c: {"sec": _key(F.regexp_extract(c("rest"), f"({_SECTION})$", 1))}))
    text = lambda c: F.nullif(c, F.lit(""))
    made = lambda c: F.struct(text(c("dist")).alias("dist"), c("sec").alias("sec"), text(c("parcel")).alias("parcel"), c("n").try_cast("int").alias("cnt"), c("stage").alias("stage"), text(c("track")).alias("track"))
    df = df.withColumns({n: made(lambda k, n=n: F.col(f"_{n}_{k}")) for n in texts})
    return df.drop(*[f"_{n}_{k}" for n in texts for k in ("t", "p", "n", "w", "track", "place", "main", "below", "nth", "d", "parcel", "stage", "dist", "rest", "sec")])


@F.pandas_udf(T.StringType())
def _day_read(s: pd.Series) -> pd.Series:
    return pd.Series([None if v is None else r[0][1][:10] if (r := readings(v, "UTC")) else None for v in s], dtype=object)


def day_of(c: Column) -> Column:
    """The day a value names, as YYYY-MM-DD; of a moment, the UTC day. ISO days stay as they are."""
    plain = F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(c, "yyyy-MM-dd").isNotNull(), c)
    return F.coalesce(plain, _day_read(F.when(plain.isNull(), c)))


def main_number(parcel: Column) -> Column:
    """Parcel number without its sub-number and leading zeros."""
    return F.nullif(_number(F.regexp_extract(parcel, r"^([0-9]+)", 1)), F.lit(""))


def approvals(clean: DataFrame) -> DataFrame:
    """One row per clean row: unit, section, parcel, count, stage, track, district, day and the parcels it lists."""
    h = clean.select(
        F.col("clean_id").cast("bigint").alias("clean_id"), "recno", "name", no_space(F.regexp_replace(fold_width(F.col("land")), r"(?<=[0-9])\s+(?=[0-9])", "、")).alias("land"), section_key(F.col("section")).alias("s"),
        "first_parcel", "district", "stage_index", F.to_date(day_of(F.col("iso_date"))).alias("day"), fold_width(F.col("parcels")).alias("parcels"),
    )
    h = with_headings(h, h="name")
    # The cell's place stands before its first number; its list and the packed one hold the unit's numbers.
    at = f"^(.*?)({_SECTION})([0-9]+(?:-[0-9]+)?)(.*)$"
    h = h.withColumn("l", F.split(F.regexp_replace("land", at, "$1\t$2\t$3\t$3$4"), "\t"))
    part = lambda i: F.when(F.size("l") == 4, F.get("l", F.lit(i)))
    h = h.withColumns({"l_dist": _said(part(0), f"({_HAN}{{2}}區)"), "l_sec": _key(part(1)), "l_parcel": _number(part(2)), "list": F.regexp_replace(part(3), r"等[0-9]+筆.*$", "")})
    cells = F.regexp_replace(F.concat_ws("|", "list", "parcels"), r"\([^()]*\)", "")
    listed = F.array_distinct(F.regexp_extract_all(cells, F.lit("([0-9]+(?:-[0-9]+)?)"), F.lit(1)))
    sec = F.coalesce("h.sec", "s", "l_sec")
    first = F.coalesce("h.parcel", F.nullif("first_parcel", F.lit("")), "l_parcel")
    rows = h.select(
        "clean_id", "recno", sec.alias("sec"), first.alias("first"), "h.cnt", F.coalesce("h.stage", "stage_index").alias("stage"), "h.track",
        F.coalesce("h.dist", "l_dist", F.nullif("district", F.lit(""))).alias("said"), "day", listed.alias("listed"),
    )
    # Read once: a filter on what was read would otherwise be pushed below and read it again.
    rows = materialize(rows, "read").where("sec is not null and first is not null")
    # Districts have sections of the same name; a row without a district takes that of the only unit it can mean.
    only = rows.groupBy("sec", "first").agg(F.max("said").alias("a"), F.min("said").alias("b")).where("a = b").select("sec", "first", F.col("a").alias("only"))
    rows = rows.join(only, ["sec", "first"], "left").withColumn("dist", F.coalesce("said", "only"))
    place = F.coalesce("dist", F.lit(""))
    named = lambda p: F.struct(F.xxhash64(p).alias("number"), F.xxhash64("sec", main_number(p)).alias("at"), F.xxhash64(F.coalesce("dist", F.lit("")), "sec", main_number(p)).alias("inside"))
    rows = rows.withColumns({"listed": F.transform(F.array_union("listed", F.array("first")), named), "unit": F.xxhash64(place, "sec", "first"), "main": number(main_number(F.col("first")))})
    rows = rows.withColumns({"dist": number("dist"), "sec": number("sec"), "first": number("first"), "track": track_code(F.col("track"))})
    return rows.select("clean_id", "recno", "unit", "dist", "sec", "first", "main", "cnt", "stage", "track", "day", "listed")


def number(c: Column | str) -> Column:
    """A text as a 64-bit number that stands for it; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.xxhash64(c))


def track_code(track: Column) -> Column:
    return F.when(track == "b", 1).when(track == "r", 2).when(track == "br", 3)


def unit_parcels(rows: DataFrame) -> DataFrame:
    """(unit, number, at, inside): the parcels listed by any row of a unit, with the numbers of (section, main number) and (district, section, main number)."""
    return rows.select("unit", F.explode("listed").alias("p")).groupBy("unit", "p.number").agg(F.min("p.at").alias("at"), F.min("p.inside").alias("inside"))


def level(known: Column, *levels: Column) -> Column:
    """0 where unknown, else the number of the first level that holds, counted from the best down to 1 for none."""
    out = F.when(~F.coalesce(known, F.lit(False)), F.lit(0))
    for i, c in enumerate(levels):
        out = out.when(F.coalesce(c, F.lit(False)), F.lit(len(levels) + 1 - i))
    return out.otherwise(F.lit(1))


def fit(counts: pd.DataFrame, levels: list[str], rounds: int = 200) -> pd.DataFrame:
    """Posterior of each agreement vector by expectation-maximisation.

    ``counts`` has one row per distinct vector. Level 0 (unknown) says nothing either way. The start says that matches
    agree: the better a level, the likelier under a match.
    """
    n = counts["n"].to_numpy(float)
    x = counts[levels].to_numpy(int)
    size = x.max(axis=0) + 1
    m = [np.r_[1.0, np.linspace(1, 9, s - 1) / np.linspace(1, 9, s - 1).sum()] if s > 1 else np.ones(1) for s in size]
    u = [np.r_[1.0, np.linspace(9, 1, s - 1) / np.linspace(9, 1, s - 1).sum()] if s > 1 else np.ones(1) for s in size]
    share = 0.4
    post = np.zeros(len(n))
    for _ in range(rounds):
        lm = np.log(share) + sum(np.log(m[j][x[:, j]]) for j in range(len(levels)))
        lu = np.log1p(-share) + sum(np.log(u[j][x[:, j]]) for j in range(len(levels)))
        new = 1 / (1 + np.exp(np.clip(lu - lm, -700, 700)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
        share = float(np.clip((n * post).sum() / n.sum(), 1e-6, 1 - 1e-6))
        for j, s in enumerate(size):
            for side, w in ((m, n * post), (u, n * (1 - post))):
                c = np.bincount(x[:, j], w, minlength=s)[1:] + 0.5
                side[j] = np.r_[1.0, c / c.sum()]
    return counts[levels].assign(confidence=post)


def with_confidence(pairs: DataFrame, levels: list[str]) -> DataFrame:
    """``pairs`` with the posterior of their vector. At most the product of the levels' sizes comes to the driver."""
    spark = pairs.sparkSession
    counts = pairs.groupBy(*levels).agg(F.count("*").alias("n")).orderBy(*levels).toPandas()
    schema = ", ".join(f"{c} int" for c in levels) + ", confidence double"
    if counts.empty:
        return pairs.withColumn("confidence", F.lit(None).cast("double"))
    post = spark.createDataFrame([(*map(int, r[:-1]), float(r[-1])) for r in fit(counts, levels).itertuples(index=False)], schema)
    return pairs.join(F.broadcast(post), levels)


UNIT_LEVELS = ["g_parcel", "g_head", "g_count", "g_dist"]
STAGE_LEVELS = ["g_stage", "g_day", "g_filed", "g_track"]


def _neighbours(df: DataFrame, day: str) -> DataFrame:
    """``df`` with the last day of the unit's earlier stages and the first of its later ones."""
    order = Window.partitionBy("unit").orderBy("stage", "recno")
    return df.withColumns({"after": F.max(day).over(order.rowsBetween(Window.unboundedPreceding, -1)), "before": F.min(day).over(order.rowsBetween(1, Window.unboundedFollowing))})


def candidates(rows: DataFrame) -> DataFrame:
    """One row per printed approval of a unit: of its copies each value comes from the first that has it."""
    of = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("clean_id"))).alias(c)
    same = [F.min(c).alias(c) for c in ("dist", "sec", "first", "main")]  # one of each in a unit
    return _neighbours(rows.groupBy("unit", "recno").agg(*same, *[of(c) for c in ("cnt", "stage", "track", "day")]), "day")


def searches(search: DataFrame) -> DataFrame:
    """The resolved searches with what their land (c) and heading (h) say, texts as numbers."""
    s = search.where(F.col("status") == "resolved").select(
        F.col("search_id").cast("bigint").alias("search_id"), "land_core", "case_name", F.to_date(day_of(F.col("chk_date"))).alias("s_day"),
        (F.substring(F.get("case_ids", F.lit(0)), 1, 3).try_cast("int") + 1911).alias("filed"),
    )
    s = with_headings(s, c="land_core", h="case_name")
    s = s.withColumns({"c_sec": F.coalesce("c.sec", "h.sec"), "h_sec": F.coalesce("h.sec", "c.sec")})
    at = lambda sec, parcel: F.when(F.col(sec).isNotNull() & F.col(parcel).isNotNull(), F.xxhash64(sec, main_number(F.col(parcel))))
    return s.select(
        "search_id", at("c_sec", "c.parcel").alias("c_at"), number("c.parcel").alias("c_number"), at("h_sec", "h.parcel").alias("h_at"), number("h.parcel").alias("h_number"), number(main_number(F.col("h.parcel"))).alias("h_main"), number("h_sec").alias("h_sec"),
        F.col("h.cnt").alias("s_cnt"), F.col("h.stage").alias("s_stage"), track_code(F.col("h.track")).alias("s_track"), number(F.coalesce("c.dist", "h.dist")).alias("s_dist"), "s_day", "filed",
    )


def unit_pairs(s: DataFrame, cand: DataFrame, parcels: DataFrame) -> DataFrame:
    """Candidate (search, unit) pairs of all blocking passes with their agreement levels."""
    # Pass 1: section and searched number. Pass 2: section and number of the heading.
    key = lambda at, parcel, first: F.struct(F.col(at).alias("at"), F.col(parcel).alias("k"), F.lit(first).alias("searched"))
    keys = s.select("search_id", F.explode(F.array(key("c_at", "c_number", True), key("h_at", "h_number", False))).alias("k")).select("search_id", "k.*").where("at is not null")
    met = keys.join(parcels.select("unit", "number", "at"), "at").select("search_id", "unit", "searched", (F.col("searched") & (F.col("number") == F.col("k"))).alias("same"))
    # Pass 3: district and day, for sections and numbers that are wrong or missing.
    days = cand.where("dist is not null and day is not null").select("unit", F.col("dist").alias("s_dist"), F.col("day").alias("s_day")).distinct()
    dated = s.where("s_dist is not null and s_day is not null").select("search_id", "s_dist", "s_day").join(days, ["s_dist", "s_day"]).select("search_id", "unit", F.lit(False).alias("searched"), F.lit(False).alias("same"))
    blocks = met.unionByName(dated).groupBy("search_id", "unit").agg(F.max("searched").alias("has_main"), F.max("same").alias("has"))
    u = cand.groupBy("unit").agg(*[F.min(c).alias(c) for c in ("dist", "sec", "first", "main")], F.collect_set("cnt").alias("counts"))  # a unit has a handful of counts
    p = s.join(blocks, "search_id").join(u, "unit")
    known = lambda *c: F.expr(" and ".join(f"{x} is not null" for x in c))
    return p.select(
        "search_id", "unit",
        level(known("c_number"), F.col("has"), F.col("has_main")).alias("g_parcel"),
        level(known("h_number"), (F.col("h_number") == F.col("first")) & (F.col("h_sec") == F.col("sec")), F.col("h_main") == F.col("main")).alias("g_head"),
        level(known("s_cnt") & (F.size("counts") > 0), F.array_contains("counts", F.col("s_cnt"))).alias("g_count"),
        level(known("s_dist", "dist"), F.col("s_dist") == F.col("dist")).alias("g_dist"),
    )


def approval_pairs(units: DataFrame, s: DataFrame, cand: DataFrame) -> DataFrame:
    """(search, approval) pairs of linked units with their agreement levels; ``at_unit`` is the confidence of the unit."""
    p = units.select("search_id", "unit", F.col("confidence").alias("at_unit")).join(s.select("search_id", "s_stage", "s_track", "s_day", "filed"), "search_id").join(cand.select("unit", "recno", "stage", "track", "day", "after", "before"), "unit")
    gap = F.abs(F.datediff("s_day", "day"))
    # Without a day of its own an approval lies between its neighbours.
    fits = F.col("day").isNull() & F.col("s_day").isNotNull() & F.coalesce(F.col("s_day") > F.col("after"), F.lit(True)) & F.coalesce(F.col("s_day") < F.col("before"), F.lit(True))
    return p.select(
        "search_id", "unit", "recno", "day", "s_day", "at_unit",
        level(F.col("s_stage").isNotNull() & F.col("stage").isNotNull(), F.col("s_stage") == F.col("stage")).alias("g_stage"),
        level(F.col("s_day").isNotNull() & (F.col("day").isNotNull() | fits), gap <= 4, fits, gap <= 31).alias("g_day"),
        level(F.col("filed").isNotNull() & F.col("day").isNotNull(), F.year("day") >= F.col("filed")).alias("g_filed"),
        level(F.col("s_track").isNotNull() & F.col("track").isNotNull(), F.col("s_track") == F.col("track")).alias("g_track"),
    )


def case_links(cand: DataFrame, parcels: DataFrame, search: DataFrame, least: float = 0.5) -> DataFrame:
    """(search_id, unit, recno, s_day, confidence): the approval of each resolved search.

    The unit is linked first, then the approval among those of the unit; the confidence is the product of both posteriors.
    """
    s = materialize(searches(search), "searches")
    units = with_confidence(materialize(unit_pairs(s, cand, parcels), "units"), UNIT_LEVELS).where(F.col("confidence") >= least)
    pairs = with_confidence(materialize(approval_pairs(units, s, cand), "cases"), STAGE_LEVELS).where(F.col("confidence") >= least)
    pairs = pairs.withColumn("confidence", F.col("confidence") * F.col("at_unit"))
    # The least tuple: most confident, then the nearest day, the earliest approval, the lowest number.
    rank = F.struct(-F.col("confidence"), -F.col("g_day"), F.coalesce("day", F.lit("9999-12-31").cast("date")), "unit", "recno")
    return pairs.groupBy("search_id").agg(F.min_by(F.struct("unit", "recno", "s_day", "confidence"), rank).alias("r")).select("search_id", "r.*")


PERMIT_LEVELS = ["g_hits", "g_cover", "g_unit"]


def permit_pairs(parcels: DataFrame, permits: DataFrame) -> DataFrame:
    """Candidate (permit, unit) pairs with their agreement levels: numbers shared, and the share of the permit's and of the unit's that they are.

    The shares have one count in common, so the posterior is sharper than independent evidence would make it.
    """
    said = F.array_distinct(F.filter(F.transform("parcels", lambda x: F.nullif(F.trim(x["district"]), F.lit(""))), lambda x: x.isNotNull()))
    named = F.transform("parcels", lambda x: F.struct(F.coalesce(F.nullif(F.trim(x["district"]), F.lit("")), F.lit("")).alias("dist"), section_key(x["section"]).alias("sec"), main_number(no_space(fold_width(x["mono"]))).alias("main")))
    p = permits.select(F.col("permit_id").cast("bigint").alias("permit_id"), said.alias("s"), F.to_date(issued_on()).alias("issued"), named.alias("x"))
    p = p.withColumn("p_dist", F.when(F.size("s") == 1, F.get("s", F.lit(0))).otherwise(""))
    # A parcel without a district takes its permit's only one; without any it meets the section's of all districts.
    dist = lambda x: F.when(x["dist"] == "", F.col("p_dist")).otherwise(x["dist"])
    own = F.transform(F.filter("x", lambda x: x["sec"].isNotNull() & x["main"].isNotNull()), lambda x: F.when(dist(x) == "", F.xxhash64(x["sec"], x["main"])).otherwise(F.xxhash64(dist(x), x["sec"], x["main"])))
    p = p.withColumn("x", F.array_distinct(own))
    each = p.select("permit_id", "issued", F.size("x").alias("n"), F.explode("x").alias("key"))
    unit = parcels.groupBy("unit", "at").agg(F.min("inside").alias("inside"))
    size = unit.groupBy("unit").agg(F.count("*").alias("u_n"))
    keyed = unit.select("unit", F.explode(F.array("inside", "at")).alias("key"))
    hits = each.join(keyed, "key").groupBy("permit_id", "unit").agg(F.count("*").alias("hits"), *[F.max(c).alias(c) for c in ("issued", "n")])
    q = hits.join(size, "unit")
    share = lambda whole: level(F.lit(True), F.col("hits") == F.col(whole), 2 * F.col("hits") > F.col(whole))
    return q.select(
        "permit_id", "unit", "hits", "u_n", "issued",
        level(F.lit(True), F.col("hits") >= 3, F.col("hits") == 2).alias("g_hits"), share("n").alias("g_cover"), share("u_n").alias("g_unit"),
    )


def permit_links(parcels: DataFrame, permits: DataFrame, least: float = 0.5) -> DataFrame:
    """(permit_id, unit, issued, confidence): the land unit of each building, the one with the highest posterior, then with most of its numbers."""
    pairs = with_confidence(materialize(permit_pairs(parcels, permits), "permits"), PERMIT_LEVELS).where(F.col("confidence") >= least)
    rank = F.struct(-F.col("confidence"), -F.col("hits"), F.col("u_n"), "unit")
    return pairs.groupBy("permit_id").agg(F.min_by(F.struct("unit", "issued", "confidence"), rank).alias("r")).select("permit_id", "r.*")


def issued_on() -> Column:
    """The day of issue; where it is missing, the last day of the year in the permit's number."""
    roc = _said(no_space(fold_width(F.col("permit_no"))), r"^([0-9]{2,3})").try_cast("int") + 1911
    return F.coalesce(day_of(F.col("date")), F.concat(roc.cast("string"), F.lit("-12-31")))


def link_records(clean: DataFrame, search: DataFrame, permits: DataFrame) -> DataFrame:
    """(clean_id, other_table, other_id, confidence) of every pair that belongs together."""
    listed = materialize(approvals(clean), "approvals")
    parcels = materialize(unit_parcels(listed), "parcels")
    rows = listed.drop("listed")
    cand = materialize(candidates(rows), "candidates")
    cases = materialize(case_links(cand, parcels, search), "cases")
    # The day of an approval: its own, a copy's, its case's.
    case_day = cases.groupBy("unit", "recno").agg(F.min("s_day").alias("case_day"))
    stage = cand.select("unit", "recno", "stage", "day").join(case_day, ["unit", "recno"], "left").withColumn("known", F.coalesce("day", "case_day"))
    stage = _neighbours(stage, "known").select("unit", "recno", "known", "after")
    # What a case asks for: a permit issued after the approval; one without any day was approved between its neighbours.
    p = permit_links(parcels, permits).join(stage, "unit")
    later = F.when(F.col("known").isNotNull(), F.col("issued") > F.col("known")).otherwise(F.coalesce(F.col("issued") > F.col("after"), F.lit(True)))
    of_permits = p.where(F.coalesce(later, F.lit(True))).select("unit", "recno", F.lit("permit_records").alias("other_table"), F.col("permit_id").alias("other_id"), "confidence")
    of_cases = cases.select("unit", "recno", F.lit("search_results").alias("other_table"), F.col("search_id").alias("other_id"), "confidence")
    return of_cases.unionByName(of_permits).join(rows.select("clean_id", "unit", "recno"), ["unit", "recno"]).select("clean_id", "other_table", "other_id", "confidence")
