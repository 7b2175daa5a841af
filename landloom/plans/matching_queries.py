"""Matching joins and cleansing over the register."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, land
from ..functions.similarity import complete_list, gestalt_ratio, order_repairs
from ..operators import matching as match
from ..functions.text import SPACE, fold_width, nfkc, no_space
from ..operators.cleanse import cleanse
from ..operators.packed import land_items, split_items
from ..runtime import materialize, table
from .registry import AP, CASES, PERMIT_PARCELS, REL, SPACES, UNITS, anywhere, approvals, cases, cell_unit, fold_sql, kinds_sql, permit_parcels, query, releases, squeeze_sql, strip0_sql, units

TIERS = (
    f"WITH {AP}, {UNITS}, {CASES}, "
    + """h AS (SELECT search_id, recno, abs(cs.dt - a.dt) AS drift FROM cs JOIN un2 a ON a.dist = cs.dist AND a.sec = cs.sec AND a.dt BETWEEN cs.dt - 1 AND cs.dt + 1 WHERE cs.sec <> ''),
 e AS (SELECT search_id, min(recno) AS recno, 1 AS tier FROM h WHERE drift = 0 GROUP BY search_id HAVING count(DISTINCT recno) = 1),
 n AS (SELECT search_id, min(recno) AS recno, 2 AS tier FROM h WHERE search_id NOT IN (SELECT search_id FROM e) GROUP BY search_id HAVING count(DISTINCT recno) = 1)"""
)


@query(f"{TIERS} SELECT * FROM e UNION ALL SELECT * FROM n")
def date_match_tiered(spark: SparkSession, d: str) -> DataFrame:
    """The only approval of the district and section on the case's day, else within a day; a case that names no district meets the section's of all."""
    a = anywhere(units(spark, d, "recno", "district", "section", "day").where("day is not null and sec != ''")).select("recno", "dist", "sec", dates.real_day(F.col("day")).alias("a_day"))
    return match.by_date(cases(spark, d).where("sec != '' and dt is not null").select("search_id", "dist", "sec", "dt"), a, ["dist", "sec"], "search_id", "recno", "dt", "a_day")


@query(
    f"""WITH {AP}, {UNITS}, {CASES}, j AS (SELECT DISTINCT search_id, recno, abs(a.dt - cs.dt)::INTEGER AS drift, cs.stage = a.stage_index AS alike FROM cs JOIN un2 a ON a.dist = cs.dist AND a.sec = cs.sec AND a.first = cs.first WHERE cs.sec <> '' AND cs.first <> '' AND abs(a.dt - cs.dt) <= 10),
 e AS (SELECT search_id, min(recno) AS recno FROM j WHERE drift = 0 GROUP BY 1 HAVING count(DISTINCT recno) = 1), n AS (SELECT search_id, min(recno) AS recno FROM j WHERE alike AND search_id NOT IN (SELECT search_id FROM e) GROUP BY 1 HAVING count(DISTINCT recno) = 1)
 SELECT search_id, recno, drift FROM j JOIN (SELECT * FROM e UNION ALL SELECT * FROM n) USING (search_id, recno)"""
)
def drift_range_join(spark: SparkSession, d: str) -> DataFrame:
    """The only approval of a case's land on its day, else the only one of its stage within ten days."""
    a = anywhere(units(spark, d, "recno", "district", "section", "first", "stage_index", "day").where("sec != '' and first != '' and day is not null"))
    a = a.select("recno", "dist", "sec", "first", "stage_index", dates.real_day(F.col("day")).alias("a_day")).where("a_day is not null")
    c = cases(spark, d).where("sec != '' and first != '' and dt is not null").select("search_id", "dist", "sec", "first", "stage", "dt")
    j = match.drift_join(c, a, ["dist", "sec", "first"], "dt", "a_day", 10).select("search_id", "recno", F.abs(F.datediff("a_day", "dt")).alias("drift"), (F.col("stage") == F.col("stage_index")).alias("alike"))
    exact = match.unique_or_nothing(j.where("drift = 0"), ["search_id"], "recno")
    near = match.unique_or_nothing(j.where("alike").join(exact, "search_id", "left_anti"), ["search_id"], "recno")
    return j.drop("alike").join(exact.unionByName(near), ["search_id", "recno"])


@query("WITH v AS (SELECT regexp_replace(land_core, '\\s+', '', 'g') AS core, min(view_id) AS view_id FROM search_results WHERE coalesce(view_id, '') <> '' GROUP BY 1 HAVING count(DISTINCT view_id) = 1), k AS (SELECT regexp_replace(land_core, '\\s+', '', 'g') AS core, min(c) AS case_id FROM search_results, unnest(case_ids) t(c) GROUP BY 1 HAVING count(DISTINCT c) = 1) SELECT project_id, coalesce(v.view_id, k.case_id) AS found, CASE WHEN v.view_id IS NOT NULL THEN 'view' WHEN k.case_id IS NOT NULL THEN 'case' ELSE 'none' END AS by FROM projects p LEFT JOIN v ON v.core = p.land_core LEFT JOIN k ON k.core = p.land_core")
def unique_lookup_chain(spark: SparkSession, d: str) -> DataFrame:
    """The only view of a land core, else its only case."""
    s = table(spark, d, "search_results").withColumn("core", F.regexp_replace("land_core", r"\s+", ""))
    v = match.unique_or_nothing(s.where("coalesce(view_id, '') != ''"), ["core"], "view_id")
    k = match.unique_or_nothing(s.select("core", F.explode("case_ids").alias("case_id")), ["core"], "case_id")
    j = table(spark, d, "projects").select("project_id", F.col("land_core").alias("core")).join(v, "core", "left").join(k, "core", "left")
    by = F.when(F.col("view_id").isNotNull(), "view").when(F.col("case_id").isNotNull(), "case").otherwise("none")
    return j.select("project_id", F.coalesce("view_id", "case_id").alias("found"), by.alias("by"))


def _loose(c: Column) -> Column:
    """A name without what differs between publications: counts' 等, former counts, the city, a closing 案."""
    c = F.regexp_replace(F.replace(F.replace(F.replace(c, F.lit("擬定"), F.lit("擬訂")), F.lit("案及"), F.lit("及")), F.lit("權利變換案"), F.lit("權利變換計畫案")), r"\(原[^)]*\)|等|[臺台]北市", "")
    return F.regexp_replace(c, "案$", "")


LOOSE = lambda c: f"regexp_replace(regexp_replace(replace(replace(replace({c}, '擬定', '擬訂'), '案及', '及'), '權利變換案', '權利變換計畫案'), '\\(原[^)]*\\)|等|[臺台]北市', '', 'g'), '案$', '')"
NAMES = f"""y AS (SELECT *, translate({squeeze_sql(fold_sql("name"))}, '劃ㄧ', '畫一') AS nm, {kinds_sql("track")} AS own FROM un), h AS (SELECT search_id, recno, 1 AS tier FROM cs JOIN y USING (nm) UNION ALL SELECT search_id, recno, 2 FROM cs JOIN y ON {LOOSE("cs.nm")} = {LOOSE("y.nm")}
 UNION ALL SELECT search_id, y.recno, 3 FROM cs JOIN y ON cs.h_sec = y.sec AND cs.h_first = y.first AND cs.stage = y.stage_index AND (cs.h_dist = '' OR cs.h_dist = y.district) WHERE cs.h_sec <> '' AND cs.h_first <> '' AND list_has_all(cs.kinds, y.own)),
 ti AS (SELECT DISTINCT search_id, recno, tier FROM h WHERE tier = (SELECT min(tier) FROM h g WHERE g.search_id = h.search_id))"""


def _name_tiers(spark: SparkSession, d: str) -> DataFrame:
    x = cases(spark, d).where("nm is not null").select("search_id", "nm", "h_dist", "h_sec", "h_first", "stage", "kinds")
    name = land.normalize_name(fold_width(F.col("name")))
    y = units(spark, d, "recno", "district", "section", "first", "stage_index", "track", "name").withColumns({"nm": name, "own": land.kinds(F.col("track"))}).drop("name")
    exact = x.join(y.select("recno", "nm"), "nm")
    loose = x.withColumn("n2", _loose(F.col("nm"))).join(y.select("recno", _loose(F.col("nm")).alias("n2")), "n2")
    third = anywhere(y.where("sec != '' and first != ''"), alias="h_dist").select("recno", "h_dist", F.col("sec").alias("h_sec"), F.col("first").alias("h_first"), F.col("stage_index").alias("stage"), "own")
    third = x.join(third, ["h_dist", "h_sec", "h_first", "stage"]).where(F.size(F.array_except("own", "kinds")) == 0)
    return match.first_tier([t.select("search_id", "recno").distinct() for t in (exact, loose, third)], ["search_id"]).select("search_id", "recno", "tier")


@query(f"WITH {AP}, {UNITS}, {CASES}, {NAMES} SELECT search_id, recno, tier FROM ti")
def name_tier_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Approvals of a case's name by the first tier that has any: equal names, loosely equal ones, equal stage and land with no kind of plan that the case lacks."""
    return _name_tiers(spark, d)


@query(f"WITH {AP}, {UNITS}, {CASES}, {NAMES}, g AS (SELECT recno, tier, case_id, max(nm) AS nm FROM ti JOIN cs USING (search_id) WHERE case_id IS NOT NULL GROUP BY ALL), f AS (SELECT * FROM g WHERE tier = (SELECT min(tier) FROM g x WHERE x.recno = g.recno)), s AS (SELECT *, regexp_extract(nm, '\\(([A-D甲乙丙丁])區段?\\)', 1) AS area FROM f), n AS (SELECT recno, count(*) AS n, count(DISTINCT nullif(area, '')) AS areas FROM s GROUP BY 1) SELECT recno, case_id, tier FROM s JOIN n USING (recno) WHERE n = 1 OR areas = n")
def bound_cases(spark: SparkSession, d: str) -> DataFrame:
    """The case of each approval by name: the only one of its first tier, or all of them if each names an area of its own."""
    c = cases(spark, d).where("case_id is not null").select("search_id", "case_id", "nm")
    g = _name_tiers(spark, d).join(c, "search_id").groupBy("recno", "tier", "case_id").agg(F.max("nm").alias("nm"))
    g = g.join(g.groupBy("recno").agg(F.min("tier").alias("tier")), ["recno", "tier"]).withColumn("area", F.nullif(F.regexp_extract("nm", r"\(([A-D甲乙丙丁])區段?\)", 1), F.lit("")))
    n = g.groupBy("recno").agg(F.count("*").alias("n"), F.count_distinct("area").alias("areas")).where("n = 1 or areas = n")
    return g.join(n, "recno").select("recno", "case_id", "tier")


_CELL = lambda t: f"regexp_replace(regexp_replace({t}, '^[^0-9]*區', ''), '(?:{SPACES}|[、､,;/|及與])+', '、', 'g')"
_PLACED = lambda name, source: rf"""{name}_a AS (SELECT *, {fold_sql("trim(land)")} AS t FROM {source}), {name}_b AS (SELECT *, {_CELL("t")} AS body FROM {name}_a),
 {name} AS (SELECT * EXCLUDE (district), coalesce(nullif(trim(district), ''), nullif(regexp_extract(land, '(..區)', 1), '')) AS district, nullif(regexp_extract(body, '^([^0-9]*段(?:[^0-9]*小段)?)', 1), '') AS sec, regexp_replace(body, '\\([^()]*\\)', '', 'g') AS plain,
 list_distinct(list_transform(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(body, '\\([^()]*\\)', '', 'g'), '^.*段', ''), '(?:地號|等[0-9]+筆|土地|\\s)+$', ''), '[0-9]+(?:-[0-9]+)?'), lambda x: regexp_replace(x, '^0+([0-9])', '\\1'))) AS seen,
 list_transform(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(body, '\\([^()]*\\)', '', 'g'), '^.*段', ''), '(?:地號|等[0-9]+筆|土地|\\s)+$', ''), '[0-9]+(?:-[0-9]+)?'), lambda x: regexp_replace(x, '^0+([0-9])', '\\1'))[1] AS head FROM {name}_b)"""  # noqa: E731


@query(
    rf"""WITH {_PLACED("cut", "(SELECT raw_id, district, name, land FROM raw_records WHERE NOT regexp_matches(" + fold_sql("trim(land)") + ", '(?:地號|土地|筆)$'))")},
 {_PLACED("whole", "(SELECT DISTINCT district, land FROM (SELECT district, land FROM raw_records UNION SELECT district, land FROM clean_records UNION SELECT district, land FROM release_records) WHERE regexp_matches(" + fold_sql("trim(land)") + ", '(?:地號|土地|筆)$'))")},
 k AS (SELECT raw_id, district, sec, body, seen, try_cast(nullif(regexp_extract({fold_sql("trim(name)")}, '等\s*([0-9]+)\s*筆', 1), '') AS BIGINT) AS n,
 CASE WHEN regexp_matches(plain, '段[^0-9]*[0-9]+(?:-[0-9]+)?[^0-9-]') THEN head ELSE coalesce(nullif(regexp_extract({fold_sql("trim(name)")}, '{land.NAME_PATTERN}', 3), ''), head) END AS head FROM cut)
 SELECT raw_id, min(w.land) AS completed FROM k JOIN whole w ON w.district = k.district AND w.sec = k.sec AND w.head = k.head AND len(w.seen) = k.n WHERE starts_with(w.body, k.body) AND length(w.body) > length(k.body) AND list_has_all(w.seen, k.seen) GROUP BY raw_id"""
)
def prefix_completion(spark: SparkSession, d: str) -> DataFrame:
    """Open land cells completed from a closed one of the district, section and first parcel that they begin.

    The candidate, of any table, holds the cell's parcels and as many as the name declares. A cell cut before the end
    of its first number takes the first parcel from its name; one cut inside a later number is not completed.
    """
    text = lambda c: fold_width(F.trim(c))
    # From the section on, with one mark between items whatever was printed.
    body = F.regexp_replace(F.regexp_replace(text(F.col("land")), "^[^0-9]*區", ""), rf"[{SPACE}、､,;/|及與]+", "、")
    plain = F.regexp_replace(body, r"\([^()]*\)", "")
    district = F.coalesce(F.nullif(F.trim("district"), F.lit("")), F.nullif(F.regexp_extract("land", "(..區)", 1), F.lit("")))
    section = F.nullif(F.regexp_extract(body, "^([^0-9]*段(?:[^0-9]*小段)?)", 1), F.lit(""))
    cell = {"district": district, "section": section, "_body": body, "_seen": land.parcel_tokens(plain)}
    named = land.name_identity(text(F.col("name")))["parcel"]
    first = F.when(plain.rlike(f"段[^0-9]*{land.PARCEL}[^0-9-]"), F.get("_seen", F.lit(0))).otherwise(F.coalesce(named, F.get("_seen", F.lit(0))))
    closed = text(F.col("land")).rlike("(?:地號|土地|筆)$")
    raw = table(spark, d, "raw_records").select("raw_id", "district", "name", "land")
    cut = raw.where(~closed).withColumns({**cell, "count": land.declared_count(text(F.col("name")))}).withColumn("first", first)
    whole = reduce(DataFrame.unionByName, [table(spark, d, t).select("district", "land") for t in ("raw_records", "clean_records", "release_records")]).distinct()
    whole = whole.where(closed).withColumns(cell).withColumns({"first": F.get("_seen", F.lit(0)), "count": F.size("_seen")})
    return match.prefix_completion(cut, whole, ["district", "section", "first", "count"], "_body", "_seen", "raw_id", "land")


TOK = rf"""pt AS (SELECT project_id, unnest(member_recnos)::BIGINT AS recno FROM projects), lt AS (SELECT DISTINCT pt.project_id, un2.dist, un2.sec, {strip0_sql("regexp_extract(p, '^[0-9]+')")} AS main FROM pt JOIN un2 USING (recno), unnest(un2.parcels) t(p) WHERE un2.sec <> ''),
 {PERMIT_PARCELS}, sh AS (SELECT project_id, permit_id, count(*) AS shared FROM lt JOIN mt USING (dist, sec, main) WHERE is_jianzi GROUP BY ALL)"""


def _overlap(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "projects").select("project_id", F.explode(F.col("member_recnos").cast("array<bigint>")).alias("recno"))
    a = anywhere(units(spark, d, "recno", "district", "section", "parcels").where("sec != ''")).select("recno", "dist", "sec", F.explode("parcels").alias("p"))
    left = m.join(a, "recno").select("project_id", "dist", "sec", F.regexp_replace(F.regexp_extract("p", "^([0-9]+)", 1), "^0+(?=[0-9])", "").alias("main"))
    return match.best_overlap(left, permit_parcels(table(spark, d, "permit_records").where("is_jianzi")), "project_id", "permit_id", ["dist", "sec", "main"])


@query(f"WITH {AP}, {UNITS}, {TOK} SELECT project_id, permit_id, shared FROM sh WHERE shared = (SELECT max(shared) FROM sh s WHERE s.project_id = sh.project_id)")
def overlap_permits(spark: SparkSession, d: str) -> DataFrame:
    """The permits that share most parcels with a project, ties kept."""
    return _overlap(spark, d)


@query(f"""WITH {AP}, {UNITS}, {TOK}, b AS (SELECT project_id, permit_id FROM sh WHERE shared = (SELECT max(shared) FROM sh s WHERE s.project_id = sh.project_id)), e AS (SELECT permit_id FROM permit_records WHERE coalesce(construction_start, '') <> ''),
 n AS (SELECT project_id, count(*) AS n, min(permit_id) AS one FROM b GROUP BY 1), w AS (SELECT project_id, min(permit_id) AS named FROM b JOIN e USING (permit_id) GROUP BY 1 HAVING count(DISTINCT permit_id) = 1)
 SELECT project_id, CASE WHEN n = 1 THEN one ELSE named END AS permit_id, CASE WHEN n = 1 THEN 'only' WHEN named IS NOT NULL THEN 'named' ELSE 'ambiguous' END AS how FROM n LEFT JOIN w USING (project_id)""")
def permit_witness(spark: SparkSession, d: str) -> DataFrame:
    """One permit, else the only one with a start of construction, else ambiguous."""
    o = _overlap(spark, d)
    e = o.join(table(spark, d, "permit_records").where("coalesce(construction_start, '') != ''").select("permit_id"), "permit_id", "left_semi").select("project_id", "permit_id")
    return match.single_witness(o, "project_id", "permit_id", e)


@query("""WITH m AS (SELECT DISTINCT c AS case_id, regexp_replace(land_core, '\\s+', '', 'g') AS core FROM search_results, unnest(case_ids) t(c)), n AS (SELECT case_id, count(*) AS cores FROM m GROUP BY 1),
 o AS (SELECT a.core, a.case_id, b.core AS other FROM m a JOIN m b ON a.case_id = b.case_id AND a.core <> b.core JOIN n ON n.case_id = a.case_id AND n.cores = 2), k AS (SELECT core, count(*) AS held FROM m GROUP BY 1)
 SELECT o.core, min(other) AS target FROM o JOIN k USING (core) GROUP BY o.core, k.held HAVING count(DISTINCT o.case_id) = k.held AND count(DISTINCT other) = 1""")
def fragment_families(spark: SparkSession, d: str) -> DataFrame:
    """Cores of which every case also shows under exactly one other core, always the same."""
    m = table(spark, d, "search_results").select(F.explode("case_ids").alias("case_id"), F.regexp_replace("land_core", r"\s+", "").alias("core")).distinct()
    # A case of exactly two cores has one other: the least or the greatest, whichever it isn't. No pairs are made.
    two = m.groupBy("case_id").agg(F.count("*").alias("n"), F.min("core").alias("lo"), F.max("core").alias("hi"))
    o = m.join(two, "case_id").withColumn("other", F.when(F.col("n") == 2, F.when(F.col("core") == F.col("lo"), F.col("hi")).otherwise(F.col("lo"))))
    g = o.groupBy("core").agg(F.count("*").alias("held"), F.count("other").alias("k"), F.min("other").alias("target"), F.max("other").alias("t2"))
    return g.where("held = k and target = t2").select("core", "target")


@query("""WITH s AS (SELECT case_ids[1] AS case_id, case_name, list_sort(list_distinct(list(land_core))) AS lands FROM search_results WHERE status = 'resolved' AND case_name IS NOT NULL GROUP BY 1, 2),
 h AS (SELECT a.case_id, b.case_id AS successor FROM s a JOIN s b ON a.case_name = b.case_name AND b.case_id > a.case_id AND list_has_all(b.lands, a.lands)) SELECT case_id, min(successor) AS successor FROM h GROUP BY 1 HAVING count(DISTINCT successor) = 1""")
def superseding_cases(spark: SparkSession, d: str) -> DataFrame:
    """The only later case of the same name that was found on all the lands of the earlier one.

    A second id of a search is the first with a sub-number (``…-1``): the same case under the same heading, so it is no case of its own.
    """
    s = table(spark, d, "search_results").where("status = 'resolved' and case_name is not null").groupBy(F.get("case_ids", F.lit(0)).alias("case_id"), "case_name").agg(F.collect_set("land_core").alias("lands"))
    return match.superseded(s, ["case_name"], "case_id", "lands")


VOTES = f"WITH {REL}, f AS (SELECT k, unit, name FROM rel WHERE unit IS NOT NULL), v AS (SELECT a.k, a.unit AS old_unit, b.unit AS new_unit, count(*) AS votes FROM (SELECT DISTINCT * FROM f) a JOIN (SELECT DISTINCT k - 1 AS k, unit, name FROM f) b USING (k, name) GROUP BY ALL)"


def _printed(spark: SparkSession, d: str) -> DataFrame:
    """The printed rows that name a unit."""
    return releases(spark, d, *cell_unit()).where("unit is not null")


@query(f"{VOTES} SELECT k, old_unit, new_unit, votes FROM v")
def alias_votes(spark: SparkSession, d: str) -> DataFrame:
    """Names that a unit of one release shares with a unit of the next; a cell that names no parcel is no unit."""
    f = _printed(spark, d).select("k", "unit", "name")
    old = f.select(F.struct("k", "unit").alias("old"), "k", "name")
    new = f.select(F.struct("unit").alias("new"), (F.col("k") - 1).alias("k"), "name")
    return match.votes(old, new, "old", "new", ["k", "name"]).select("old.k", F.col("old.unit").alias("old_unit"), F.col("new.unit").alias("new_unit"), "votes")


@query(
    f"""{VOTES}, t AS (SELECT k, old_unit, max(votes) AS m FROM v GROUP BY ALL), u1 AS (SELECT v.k, v.old_unit, min(new_unit) AS new_unit FROM v JOIN t ON v.k = t.k AND v.old_unit = t.old_unit AND votes = m GROUP BY ALL HAVING count(DISTINCT new_unit) = 1),
 c1 AS (SELECT k, arg_min(old_unit, (old_unit <> new_unit, old_unit)) AS old_unit, new_unit FROM u1 GROUP BY k, new_unit), s AS (SELECT DISTINCT k, district, sec, unit, list_sort(tokens) AS tokens FROM rel WHERE unit IS NOT NULL),
 held AS (SELECT k, district, sec, unit, list_distinct(flatten(list(tokens))) AS p FROM s GROUP BY ALL), rest AS (SELECT * FROM held h WHERE k < (SELECT max(k) FROM rel) AND NOT EXISTS (SELECT 1 FROM v WHERE v.k = h.k AND v.old_unit = h.unit)),
 j AS (SELECT a.k, a.unit AS old_unit, b.unit AS new_unit, max(round(len(list_intersect(a.p, b.tokens))::DOUBLE / len(list_distinct(list_concat(a.p, b.tokens))), 9)) AS score FROM rest a JOIN s b ON b.k = a.k + 1 AND b.district = a.district AND b.sec = a.sec GROUP BY ALL),
 j5 AS (SELECT * FROM j WHERE score >= 0.5), u2 AS (SELECT k, old_unit, min(new_unit) AS new_unit FROM j5 WHERE score = (SELECT max(score) FROM j5 x WHERE x.k = j5.k AND x.old_unit = j5.old_unit) GROUP BY k, old_unit HAVING count(DISTINCT new_unit) = 1),
 c2 AS (SELECT k, arg_min(old_unit, (old_unit <> new_unit, old_unit)) AS old_unit, new_unit FROM u2 GROUP BY k, new_unit)
 SELECT k, old_unit, new_unit FROM c1 UNION ALL SELECT k, old_unit, new_unit FROM c2 WHERE NOT EXISTS (SELECT 1 FROM c1 WHERE c1.k = c2.k AND c1.new_unit = c2.new_unit)"""
)
def unit_aliases(spark: SparkSession, d: str) -> DataFrame:
    """The only best-voted successor of each unit; without any vote the only one of the section that shares most parcels, half at least.

    A new unit is taken once: by names before parcels, by the unit that keeps its name first, then in the order of the old units.
    A unit with several best successors, or whose best is taken, has no alias.
    """
    v = materialize(alias_votes(spark, d).select(F.struct("k", "old_unit").alias("o"), "new_unit", "votes"), "votes")
    claim = lambda t: match.claimed_once(t.select("o.k", "o.old_unit", "new_unit"), ["k"], "old_unit", "new_unit", [F.col("old_unit") != F.col("new_unit"), F.col("old_unit")])
    named = claim(match.unique_top(v, "o", "new_unit", "votes"))
    f = materialize(_printed(spark, d).select("k", "district", "sec", "unit", F.array_sort("tokens").alias("parcels")).distinct(), "cells")
    last = f.agg(F.max("k")).first()[0] or 0
    old = f.where(F.col("k") < last).join(v.select("o.k", F.col("o.old_unit").alias("unit")).distinct(), ["k", "unit"], "left_anti")
    old = old.groupBy("k", "district", "sec", "unit").agg(F.array_distinct(F.flatten(F.collect_set("parcels"))).alias("parcels"))
    a = old.select(F.struct("k", F.col("unit").alias("old_unit")).alias("o"), "k", "district", "sec", "parcels")
    b = f.select((F.col("k") - 1).alias("k"), "district", "sec", F.struct("unit", "parcels").alias("n"))
    j = a.withColumn("p", F.explode("parcels")).join(b.withColumn("p", F.explode("n.parcels")), ["k", "district", "sec", "p"])
    j = j.groupBy("o", "n").agg(F.count("*").alias("both"), F.first(F.size("parcels") + F.size("n.parcels")).alias("all"))
    near = j.select("o", F.col("n.unit").alias("new_unit"), F.round(F.col("both") / (F.col("all") - F.col("both")), 9).alias("score")).where("score >= 0.5")
    near = near.groupBy("o", "new_unit").agg(F.max("score").alias("score"))
    like = claim(match.unique_top(near, "o", "new_unit", "score"))
    return named.unionByName(like.join(named, ["k", "new_unit"], "left_anti").select("k", "old_unit", "new_unit"))


@query()
def release_families_matched(spark: SparkSession, d: str) -> DataFrame:
    """Projects and register families paired one to one, strongest overlap first (greedy, so no SQL), then by place; the rest is lost or born.

    A place pairs where one project and one family that are left have it.
    """
    p = table(spark, d, "projects").select(F.col("anchor_recno").cast("bigint").alias("project"), "district", "section", land.place(no_space(fold_width(F.col("land_core"))))["first"].alias("first"), F.col("member_recnos").cast("array<bigint>").alias("m"))
    fams = approvals(spark, d, "recno", "district", "section", "first").where("section != '' and first != ''")
    place = ["district", "section", "first"]
    unit = materialize(fams.groupBy(*place).agg(F.min("recno").alias("family"), F.collect_list("recno").alias("m")), "units")  # the approvals of one land
    members = lambda df, k: df.select(k, F.explode("m").alias("recno"))
    by_members = match.one_to_one(match.votes(members(p, "project"), members(unit, "family"), "project", "family", ["recno"]), "project", "family", "votes").withColumn("how", F.lit("members"))
    left, right = p.join(by_members, "project", "left_anti"), unit.join(by_members, "family", "left_anti")
    one = match.unique_or_nothing(left.select("project", *place), place, "project").join(match.unique_or_nothing(right.select("family", *place), place, "family"), place)
    by_place = one.select("project", "family", F.lit(0).cast("bigint").alias("votes"), F.lit("place").alias("how"))
    none = F.lit(None).cast("bigint")
    lost = left.join(by_place, "project", "left_anti").select("project", none.alias("family"), F.lit(0).cast("bigint").alias("votes"), F.lit("lost").alias("how"))
    born = right.join(by_place, "family", "left_anti").select(none.alias("project"), "family", F.lit(0).cast("bigint").alias("votes"), F.lit("born").alias("how"))
    return reduce(DataFrame.unionByName, [by_members, by_place, lost, born])


@query(f"""WITH {AP}, t AS (SELECT recno, section, parcels, unnest(parcels) AS p FROM ap WHERE section <> ''), n AS (SELECT a.recno, b.recno AS other, count(*) AS n, any_value(len(a.parcels) + len(b.parcels)) AS s FROM t a JOIN t b ON a.section = b.section AND a.p = b.p AND a.recno > b.recno GROUP BY ALL),
 j AS (SELECT recno, other, n::DOUBLE / (s - n) AS jaccard FROM n) SELECT recno, other, round(jaccard, 6) AS jaccard FROM (SELECT *, row_number() OVER (PARTITION BY recno ORDER BY jaccard DESC, other) AS r FROM j) WHERE r = 1""")
def most_similar_earlier(spark: SparkSession, d: str) -> DataFrame:
    """Of each record the earlier-numbered one of its section with the largest parcel overlap."""
    a = approvals(spark, d, "recno", "section", "parcels").where("section != ''").select("recno", "section", "parcels")
    t = a.withColumn("p", F.explode("parcels"))
    n = t.alias("x").join(t.select(F.col("recno").alias("other"), "section", F.size("parcels").alias("s2"), "p"), ["section", "p"]).where("recno > other").groupBy("recno", "other").agg(F.count("*").alias("n"), F.first(F.size("parcels") + F.col("s2")).alias("s"))
    j = n.select("recno", "other", (F.col("n") / (F.col("s") - F.col("n"))).alias("jaccard"))
    best = j.groupBy("recno").agg(F.max_by(F.struct("other", "jaccard"), F.struct("jaccard", -F.col("other"))).alias("r"))
    return best.select("recno", "r.other", F.round("r.jaccard", 6).alias("jaccard"))


@query(f"WITH {AP}, f AS (SELECT DISTINCT district, section, first, unnest(parcels) AS p FROM ap WHERE section <> '' AND first <> '') SELECT DISTINCT district || s || p || '地號' AS query FROM f, unnest([section, replace(section, '小段', '')]) a(s) WHERE NOT (s = section AND p = first)")
def generated_queries(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling of a unit's section with every parcel it ever had, but the query it was found by."""
    f = approvals(spark, d, "district", "section", "first", "parcels").where("section != '' and first != ''").select("district", "section", "first", F.explode("parcels").alias("p")).distinct()
    s = f.withColumn("s", F.explode(F.array("section", F.replace("section", F.lit("小段"), F.lit(""))))).where(~((F.col("s") == F.col("section")) & (F.col("p") == F.col("first"))))
    return s.select(F.concat("district", "s", "p", F.lit("地號")).alias("query")).distinct()


@query("""WITH s AS (SELECT DISTINCT unnest(case_ids) AS case_id FROM search_results) SELECT DISTINCT case_id FROM documents WHERE case_id IS NOT NULL AND case_id NOT IN (SELECT case_id FROM s)""")
def orphan_cases(spark: SparkSession, d: str) -> DataFrame:
    """Cases that documents name and no search returned."""
    s = table(spark, d, "search_results").select(F.explode("case_ids").alias("case_id")).distinct()
    return table(spark, d, "documents").where("case_id is not null").select("case_id").distinct().join(s, "case_id", "left_anti")


@query()
def cleansed_records(spark: SparkSession, d: str) -> DataFrame:
    """The whole cleansing projection (NFKC has no SQL here)."""
    c = cleanse(table(spark, d, "raw_records"))
    return c.select(*[F.array_join(n, "|").alias(n) if n in ("parcels", "aliases", "auto_fixes", "review_flags") else F.col(n) for n in c.columns])


@query()
def review_figures(spark: SparkSession, d: str) -> DataFrame:
    """How often each fix was made and each flag raised while cleansing (NFKC, so no SQL)."""
    c = cleanse(table(spark, d, "raw_records"))
    each = c.select(F.explode(F.concat(*[F.transform(n, lambda x, n=n: F.struct(F.lit(k).alias("kind"), x.alias("label"))) for n, k in (("auto_fixes", "fix"), ("review_flags", "flag"))])).alias("e"))
    return each.groupBy("e.kind", "e.label").agg(F.count("*").alias("n"))


@query()
def name_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Gestalt ratio of the names of consecutive approvals of a unit."""
    a = approvals(spark, d, "recno", "district", "section", "first", "stage_index", "name").where("section != '' and first != ''").select("recno", "district", "section", "first", "stage_index", "name")
    b = a.select("district", "section", "first", (F.col("stage_index") - 1).alias("stage_index"), F.col("recno").alias("next"), F.col("name").alias("next_name"))
    return a.join(b, ["district", "section", "first", "stage_index"]).select("recno", "next", gestalt_ratio("name", "next_name").alias("ratio"))


@query()
def repaired_lists(spark: SparkSession, d: str) -> DataFrame:
    """printed lists with a single mistyped number put right, and cut ones completed from a list of their unit.

    A number out of the printed order that no other record of the section has is replaced by the only number of another
    record that is one digit longer or shorter and fits its place. A list is completed where exactly one completion closes the count.
    """
    unit = ["district", "section", "first"]
    said = lambda c: F.coalesce(c, F.lit(""))
    c = table(spark, d, "clean_records").where("recno is not null").select(F.col("recno").cast("bigint").alias("recno"), "clean_id", "district", "section", "first_parcel", "land_count", "name", "parcels", "land")
    c = match.first_per_key(c, ["recno"], [F.col("clean_id")])
    # A cell without items is as good as none: the land shows the list too.
    numbers = lambda items: F.filter(F.transform(items, lambda x: F.regexp_extract(x, f"^({land.PARCEL})", 1)), lambda x: x != "")
    c = c.withColumns({n: nfkc(n) for n in ("parcels", "land", "name")}).withColumns({"_p": numbers(split_items(F.col("parcels"))), "_l": numbers(land_items(F.col("land")))})
    p = F.array_distinct(F.when(F.size("_p") > 0, F.col("_p")).otherwise(F.coalesce("_l", F.array().cast("array<string>"))))
    a = c.select("recno", said(F.col("district")).alias("district"), said(F.col("section")).alias("section"), F.coalesce(F.nullif("first_parcel", F.lit("")), F.get(p, F.lit(0))).alias("first"),
                 F.coalesce(F.nullif("land_count", F.lit(0)), land.declared_count(F.col("name")), F.lit(0)).alias("count"), p.alias("p")).where(F.size("p") > 0)
    place = ["district", "section"]
    held = a.select("recno", *place, F.explode("p").alias("x")).groupBy(*place, "x").agg(F.min("recno").alias("_lo"), F.max("recno").alias("_hi"))
    o = a.select("recno", *place, F.explode(order_repairs("p")).alias("o")).select("recno", *place, "o.*")
    alone = o.select("recno", *place, F.col("old").alias("x")).distinct().join(held, [*place, "x"]).where("_lo = _hi").select("recno")
    known = o.join(held.select(*place, F.col("x").alias("new")), [*place, "new"]).join(alone, "recno", "left_semi")
    fix = known.groupBy("recno").agg(F.count("*").alias("_k"), F.min("old").alias("old"), F.min("new").alias("new")).where("_k = 1").drop("_k")
    r = a.join(fix, "recno", "left").withColumn("p", F.transform("p", lambda x: F.when(x == F.col("old"), F.col("new")).otherwise(x)))
    r = r.withColumn("s", land.sorted_parcels(F.col("p")))
    lists = r.where("section != ''").groupBy(*unit).agg(F.collect_set("s").alias("lists"))
    j = r.join(lists, unit, "left")
    own = F.coalesce("lists", F.array("s"))
    whole = F.array_distinct(F.filter(F.transform(own, lambda x: complete_list(F.col("s"), x, F.col("count"))), lambda x: x.isNotNull()))
    return j.select("recno", F.array_join("p", ",").alias("repaired"), F.array_join(F.when(F.size(whole) == 1, whole[0]), ",").alias("completed"))
