"""Families, graph edges and corrections over the register."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import families as fam
from ..operators import publication as pub
from ..functions.text import fold_width, no_space
from ..operators.matching import unique_or_nothing
from ..runtime import materialize, table
from .registry import AP, approvals, fold_sql, query, squeeze_sql

REPS = AP + """, reps AS (SELECT min(recno) AS recno, district, section, first, parcels, aliases, "count", orig, anchor, list_distinct(list_concat(parcels, flatten(list_transform(aliases, lambda x: string_split(x, ':'))))) AS held FROM ap GROUP BY ALL)"""
PAIRS = (
    REPS
    + """, tok AS (SELECT DISTINCT recno, district, section, unnest(list_append(held, first)) AS t FROM reps),
met AS (SELECT DISTINCT a.recno AS a, b.recno AS b FROM tok a JOIN tok b USING (district, section, t) WHERE t <> '' AND a.recno < b.recno
 UNION SELECT m, recno FROM (SELECT recno, min(recno) OVER (PARTITION BY anchor) AS m FROM reps WHERE anchor <> '') WHERE m < recno),
parts AS (SELECT met.a, met.b, x.anchor <> '' AND x.anchor = y.anchor AS named, x.district <> y.district OR x.section <> y.section AS apart,
 CASE WHEN x.first <> '' AND x.first = y.first THEN 1.0::DOUBLE WHEN x.first <> '' AND y.first <> '' AND (list_contains(y.parcels, y.first) AND list_contains(y.aliases, y.first || ':' || x.first) OR list_contains(x.parcels, x.first) AND list_contains(x.aliases, x.first || ':' || y.first)) THEN 0.95::DOUBLE
 WHEN x.first <> '' AND y.first <> '' AND (list_contains(y.held, x.first) OR list_contains(x.held, y.first)) THEN 0.7::DOUBLE ELSE 0.0::DOUBLE END AS fp,
 (x.orig > 0 AND x.orig = y."count") OR (y.orig > 0 AND y.orig = x."count") AS shrunk,
 CASE WHEN x."count" > 0 AND x."count" = y."count" THEN 1.0::DOUBLE WHEN x."count" > 0 AND y."count" > 0 AND (x.orig = y."count" OR y.orig = x."count") THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END AS cnt,
 CASE WHEN len(x.held) > 0 AND len(y.held) > 0 THEN len(list_intersect(x.held, y.held))::DOUBLE / len(list_distinct(list_concat(x.held, y.held))) ELSE 0.0::DOUBLE END AS jac,
 len(x.held) = 0 AND len(y.held) = 0 AS neither
 FROM met JOIN reps x ON x.recno = met.a JOIN reps y ON y.recno = met.b),
scored AS (SELECT a, b, CASE WHEN named THEN 1.0::DOUBLE WHEN apart THEN 0.0::DOUBLE WHEN fp >= 0.95 AND shrunk THEN (0.35::DOUBLE + 0.2::DOUBLE * fp + 0.1::DOUBLE) / 0.65::DOUBLE
 WHEN neither AND fp >= 1 AND cnt >= 1 THEN (0.35::DOUBLE + 0.2::DOUBLE * fp + 0.1::DOUBLE * cnt) / 0.65::DOUBLE ELSE 0.35::DOUBLE + 0.2::DOUBLE * fp + 0.3::DOUBLE * jac + 0.1::DOUBLE * cnt END AS score FROM parts)"""
)
FAMILY = (
    PAIRS
    + """, link AS (SELECT a AS x, b AS y FROM scored WHERE score >= 0.7::DOUBLE UNION SELECT b, a FROM scored WHERE score >= 0.7::DOUBLE),
reach(recno, root) AS (SELECT recno, recno FROM reps UNION SELECT link.y, reach.root FROM reach JOIN link ON link.x = reach.recno),
label AS (SELECT recno, min(root) AS family FROM reach GROUP BY recno),
fam AS (SELECT ap.*, label.family FROM ap JOIN reps r ON ap.district = r.district AND ap.section = r.section AND ap.first = r.first AND ap.parcels = r.parcels AND ap.aliases = r.aliases AND ap."count" = r."count" AND ap.orig = r.orig AND ap.anchor = r.anchor JOIN label ON label.recno = r.recno)"""
)
RFAMILY = "WITH RECURSIVE " + FAMILY
ANCHORS = """, anc AS (SELECT family, recno AS anchor_recno FROM (SELECT family, recno, row_number() OVER (PARTITION BY family ORDER BY coalesce(day, '') DESC, recno) AS n FROM fam) WHERE n = 1)"""
SLUGS = (
    ANCHORS
    + """, slug AS (SELECT anc.family, anchor_recno, CASE WHEN f.section = '' THEN '未解析-' || anchor_recno ELSE concat_ws('-', f.district, f.section, f.first || '地號等' ||
 coalesce(coalesce(nullif(f."count", 0), (SELECT arg_max(m."count", m.recno) FROM fam m WHERE m.family = anc.family AND m."count" > 0))::VARCHAR, '?') || '筆') END AS slug
 FROM anc JOIN fam f ON f.recno = anc.anchor_recno)"""
)


def _families(spark: SparkSession, d: str) -> DataFrame:
    rec = materialize(approvals(spark, d), "approvals")  # read for the families and again with them
    return rec.join(fam.families(rec), "recno")


@query(f"WITH {PAIRS} SELECT a, b, round(score, 6) AS score FROM scored WHERE score >= 0.5::DOUBLE")
def candidate_pair_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scored pairs of class representatives, from 0.5 up."""
    reps = fam.classes(approvals(spark, d)).where("rep = recno").select("recno", *fam.SIDE)
    return fam.scored_pairs(reps).where("score >= 0.5").withColumn("score", F.round("score", 6))


@query(f"WITH {PAIRS} SELECT a, b, round(score, 6) AS score FROM scored WHERE score >= 0.5::DOUBLE AND score < 0.7::DOUBLE")
def borderline_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs kept for review."""
    return candidate_pair_scores(spark, d).where("score < 0.7")


@query(f"WITH {REPS} SELECT r.recno AS rep, ap.recno AS recno FROM ap JOIN reps r ON ap.district = r.district AND ap.section = r.section AND ap.first = r.first AND ap.parcels = r.parcels AND ap.aliases = r.aliases AND ap.\"count\" = r.\"count\" AND ap.orig = r.orig AND ap.anchor = r.anchor")
def record_classes(spark: SparkSession, d: str) -> DataFrame:
    """Membership of the classes that the pairs stand for."""
    return fam.classes(approvals(spark, d)).select("rep", "recno")


@query(f"{RFAMILY} SELECT recno, family FROM fam")
def family_components(spark: SparkSession, d: str) -> DataFrame:
    """A01."""
    return fam.families(approvals(spark, d))


@query(f"{RFAMILY}{ANCHORS} SELECT family, anchor_recno FROM anc")
def family_anchor(spark: SparkSession, d: str) -> DataFrame:
    """A02."""
    return fam.anchors(_families(spark, d))


@query(f"{RFAMILY}{SLUGS} SELECT family, anchor_recno, CASE WHEN n > 1 THEN slug || '-' || n ELSE slug END AS project_id FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY anchor_recno) AS n FROM slug)")
def family_project_ids(spark: SparkSession, d: str) -> DataFrame:
    """A03, W05."""
    return fam.project_ids(fam.slugs(_families(spark, d)))


@query(f"{RFAMILY}{ANCHORS} SELECT fam.recno, fam.family, fam.recno = anc.anchor_recno AS is_current FROM fam JOIN anc USING (family)")
def current_members(spark: SparkSession, d: str) -> DataFrame:
    """W10."""
    f = _families(spark, d)
    return f.join(fam.anchors(f), "family").select("recno", "family", (F.col("recno") == F.col("anchor_recno")).alias("is_current"))


@query(f"""{RFAMILY}, tr AS (SELECT *, unnest(string_split(track, '、')) AS t FROM fam),
 e AS (SELECT family, recno AS frm, lead(recno) OVER (PARTITION BY family ORDER BY coalesce(day, ''), recno) AS "to", 'revision' AS kind FROM fam
 UNION SELECT family, recno, lead(recno) OVER (PARTITION BY family, t ORDER BY coalesce(day, ''), recno), 'track' FROM tr WHERE t <> ''
 UNION SELECT family, recno, lead(recno) OVER (PARTITION BY family, stage_index, track ORDER BY recno), 'section' FROM fam
 WHERE (family, stage_index, track) IN (SELECT (family, stage_index, track) FROM fam WHERE area <> '' GROUP BY ALL HAVING count(DISTINCT area) > 1))
 SELECT family, frm, "to", kind FROM e WHERE "to" IS NOT NULL""")
def history_edges(spark: SparkSession, d: str) -> DataFrame:
    """W02 to W04a."""
    return fam.edges(_families(spark, d))


@query(f"{RFAMILY} SELECT family, count(*) AS members, count(DISTINCT stage_index) AS stages FROM fam GROUP BY family ORDER BY members DESC, family LIMIT 50")
def largest_families(spark: SparkSession, d: str) -> DataFrame:
    """A top-50 report."""
    return _families(spark, d).groupBy("family").agg(F.count("*").alias("members"), F.count_distinct("stage_index").alias("stages")).orderBy(F.desc("members"), "family").limit(50)


@query(f"{RFAMILY} SELECT size, count(*) AS families FROM (SELECT family, least(count(*), 6) AS size FROM fam GROUP BY family) GROUP BY size")
def family_sizes(spark: SparkSession, d: str) -> DataFrame:
    """How many families have 1 to 5, or more, members."""
    return _families(spark, d).groupBy("family").agg(F.least(F.count("*"), F.lit(6)).alias("size")).groupBy("size").agg(F.count("*").alias("families"))


@query(f"{RFAMILY} SELECT family, array_to_string(list_sort(list_distinct(list(\"count\"))), ',') AS counts, len(list_distinct(flatten(list(parcels)))) AS n_parcels FROM fam GROUP BY family")
def unit_counts_and_parcels(spark: SparkSession, d: str) -> DataFrame:
    """The counts and parcels a unit had across its approvals."""
    f = _families(spark, d)
    per = f.groupBy("family").agg(F.array_sort(F.collect_set("count")).alias("c"))
    n = f.select("family", F.explode("parcels").alias("p")).groupBy("family").agg(F.count_distinct("p").alias("n"))
    return per.join(n, "family", "left").select("family", F.array_join(F.transform("c", lambda x: x.cast("string")), ",").alias("counts"), F.coalesce("n", F.lit(0)).alias("n_parcels"))


CORE = lambda c: squeeze_sql(fold_sql(c))
LEDGER = f"""led AS (SELECT seq, {CORE("match_land_core")} AS core, match_iso_date AS day, CASE field WHEN 'iso_date' THEN 'day' WHEN 'land_count' THEN 'count' ELSE field END AS field, to_value, supersedes, confirm_merge, {CORE("with_land_core")} AS wcore, with_iso_date FROM corrections),
 eff AS (SELECT * FROM led WHERE seq NOT IN (SELECT supersedes FROM led WHERE supersedes IS NOT NULL AND supersedes <> seq))"""
CORES = AP + r""", cores AS (SELECT *, district || section || first || '地號' || CASE WHEN "count" > 0 THEN '等' || "count" || '筆' ELSE '' END AS core FROM ap WHERE section <> '' AND first <> '')"""
#: Fields a correction may name, as columns of the approvals.
EDITABLE = ["implementer", "planner", "district", "day", "count"]
NAMED = {"iso_date": "day", "land_count": "count"}


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    core = lambda c: no_space(fold_width(F.col(c)))
    field = F.col("field")
    for name, column in NAMED.items():
        field = F.when(F.col("field") == name, column).otherwise(field)
    return table(spark, d, "corrections").select(
        "seq", core("match_land_core").alias("core"), F.col("match_iso_date").alias("day"), field.alias("field"), "to_value", "supersedes", "confirm_merge", core("with_land_core").alias("wcore"), "with_iso_date"
    )


def _cores(spark: SparkSession, d: str) -> DataFrame:
    return fam.core_of(approvals(spark, d).where("section != '' and first != ''")).withColumnRenamed("land_core", "core")


@query(f"WITH {LEDGER} SELECT seq, field FROM eff")
def effective_corrections(spark: SparkSession, d: str) -> DataFrame:
    """J02b."""
    return pub.effective(_ledger(spark, d)).select("seq", "field")


@query(
    f"""WITH {CORES}, {LEDGER}, v AS (SELECT core, day, {", ".join(f"arg_max(to_value, seq) FILTER (field = '{f}') AS new_{f}" for f in EDITABLE)} FROM eff GROUP BY core, day)
 SELECT c.recno, {", ".join(f'coalesce(v.new_{f}, c.{f}) AS {f}' for f in EDITABLE if f != "count")}, coalesce(try_cast(v.new_count AS BIGINT), c."count") AS "count", v.core IS NOT NULL AS corrected FROM cores c LEFT JOIN v ON c.core = v.core AND c.day = v.day"""
)
def corrected_records(spark: SparkSession, d: str) -> DataFrame:
    """Effective corrections on (land core, day), later entries over earlier ones; the day itself can be corrected, too."""
    v = pub.field_values(pub.effective(_ledger(spark, d)), ["core", "day"], EDITABLE)
    return pub.apply_corrections(_cores(spark, d).select("recno", "core", *EDITABLE), v, ["core", "day"], EDITABLE).select("recno", *EDITABLE, "corrected")


@query(f"WITH {CORES}, {LEDGER} SELECT core, day, count(*) AS entries FROM eff WHERE NOT EXISTS (SELECT 1 FROM cores c WHERE c.core = eff.core AND c.day = eff.day) GROUP BY core, day")
def unmatched_corrections(spark: SparkSession, d: str) -> DataFrame:
    """Corrections that no record answers to."""
    v = pub.effective(_ledger(spark, d)).groupBy("core", "day").agg(F.count("*").alias("entries"))
    return pub.unmatched(v, _cores(spark, d), ["core", "day"])


@query(
    f"""WITH {CORES}, {LEDGER}, one AS (SELECT core, day, min(recno) AS recno FROM cores WHERE day IS NOT NULL GROUP BY core, day HAVING count(*) = 1)
 SELECT eff.seq, x.recno AS a, y.recno AS b FROM eff JOIN one x ON eff.core = x.core AND eff.day = x.day JOIN one y ON eff.wcore = y.core AND eff.with_iso_date = y.day WHERE confirm_merge"""
)
def confirmed_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Both ends of a confirmed merge must be exactly one record."""
    one = unique_or_nothing(_cores(spark, d).where("day is not null").select("core", "day", "recno"), ["core", "day"], "recno")
    e = pub.effective(_ledger(spark, d)).where("confirm_merge")
    return e.join(one.withColumnRenamed("recno", "a"), ["core", "day"]).join(one.select(F.col("core").alias("wcore"), F.col("day").alias("with_iso_date"), F.col("recno").alias("b")), ["wcore", "with_iso_date"]).select("seq", "a", "b")
