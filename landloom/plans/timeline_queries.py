"""Timelines, clusters and slots over the register."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import land
from ..functions.land import PLACE
from ..functions.similarity import jaccard
from ..functions.text import fold_width, no_space
from ..operators import matching as match
from ..runtime import table
from .registry import AP, PERMIT_PARCELS, UNITS, anywhere, approvals, fold_sql, permit_parcels, query, section_key_sql, squeeze_sql, strip0_sql, units

ROWS = f"""{AP}, {UNITS}, {PERMIT_PARCELS}, u AS (SELECT DISTINCT district, section, first, dist, sec, regexp_extract(first, '^[0-9]+') AS main FROM un2 WHERE section <> '' AND first <> ''),
 ev AS (SELECT district, section, first, day, 1 AS rank, 'approval' AS kind, recno AS id FROM ap WHERE section <> '' AND first <> '' AND day IS NOT NULL
 UNION ALL SELECT DISTINCT district, section, first, construction_start, 0, 'permit', permit_id FROM mt JOIN u USING (dist, sec, main) WHERE regexp_full_match(construction_start, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'))"""


def _events(spark: SparkSession, d: str) -> DataFrame:
    unit = ["district", "section", "first"]
    a = units(spark, d, "recno", *unit, "day").where("section != '' and first != ''")
    own = anywhere(a).select(*unit, "dist", "sec", F.regexp_extract("first", "^[0-9]+", 0).alias("main")).distinct()
    p = permit_parcels(table(spark, d, "permit_records").where("construction_start rlike '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'"), "construction_start")
    permit = p.join(own, ["dist", "sec", "main"]).select(*unit, F.col("construction_start").alias("day"), F.lit(0).alias("rank"), F.lit("permit").alias("kind"), F.col("permit_id").alias("id")).distinct()
    return a.where("day is not null").select(*unit, "day", F.lit(1).alias("rank"), F.lit("approval").alias("kind"), F.col("recno").alias("id")).unionByName(permit)


@query(f"WITH {ROWS} SELECT district, section, first, kind, id, row_number() OVER (PARTITION BY district, section, first ORDER BY day, rank, id) AS pos FROM ev")
def timeline(spark: SparkSession, d: str) -> DataFrame:
    """Approvals and starts of construction of a unit in one order; of one day the event comes first."""
    unit = ["district", "section", "first"]
    return _events(spark, d).select(*unit, "kind", "id", match.rank_in(unit, [F.col("day"), F.col("rank"), F.col("id")]).cast("bigint").alias("pos"))


@query(f"WITH {AP} SELECT district, section, first, stage_index, coalesce(arg_min(day, recno) FILTER (day IS NOT NULL AND anchor = ''), min(day)) AS day, count(*) AS n FROM ap GROUP BY district, section, first, stage_index")
def stage_clusters(spark: SparkSession, d: str) -> DataFrame:
    """The day of a stage is that of its first dated member without a name of its own, else the earliest."""
    own = F.col("day").isNotNull() & (F.col("anchor") == "")
    g = approvals(spark, d, "recno", "district", "section", "first", "stage_index", "day", "anchor").groupBy("district", "section", "first", "stage_index")
    return g.agg(F.coalesce(F.min_by(F.when(own, F.col("day")), F.when(own, F.col("recno"))), F.min("day")).alias("day"), F.count("*").alias("n"))


@query(f"WITH {AP}, v AS (SELECT *, lag(stage_index) OVER w AS p, lag(recno) OVER w AS pr FROM ap WHERE day IS NULL WINDOW w AS (PARTITION BY district, section, first, track ORDER BY recno)) SELECT pr AS frm, recno AS \"to\" FROM v WHERE p = 0")
def undated_chain_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Consecutive undated members of one track, the first of them a first stage."""
    w = Window.partitionBy("district", "section", "first", "track").orderBy("recno")
    v = approvals(spark, d, "recno", "district", "section", "first", "track", "stage_index", "day").where("day is null").select(F.lag("recno").over(w).alias("frm"), F.lag("stage_index").over(w).alias("p"), F.col("recno").alias("to"))
    return v.where("p = 0").select("frm", "to")


@query(
    """WITH s AS (SELECT permit_id, slot, value, src FROM (SELECT permit_id, 1 AS slot, nullif(construction_start, '') AS value, 'start' AS src FROM permit_records UNION ALL SELECT permit_id, 2, nullif(date, ''), 'issue' FROM permit_records UNION ALL SELECT permit_id, 3, nullif(orig_permit, ''), 'origin' FROM permit_records))
 SELECT slot::INTEGER AS slot, src, count(value) AS filled, count(*) - count(value) AS missing FROM s GROUP BY ALL"""
)
def permit_slots(spark: SparkSession, d: str) -> DataFrame:
    """Three slots per permit, by one scan."""
    p = table(spark, d, "permit_records").selectExpr("stack(3, 1, nullif(construction_start, ''), 'start', 2, nullif(date, ''), 'issue', 3, nullif(orig_permit, ''), 'origin') as (slot, value, src)")
    return p.groupBy("slot", "src").agg(F.count("value").alias("filled"), F.count_if(F.col("value").isNull()).alias("missing"))


@query(f"WITH {AP} SELECT recno, coalesce(nullif(anchor, ''), nullif(implementer, ''), nullif(first, '')) AS label FROM ap")
def first_label(spark: SparkSession, d: str) -> DataFrame:
    """The first non-empty of several labels."""
    return approvals(spark, d, "recno", "anchor", "implementer", "first").select("recno", F.coalesce(*[F.nullif(c, F.lit("")) for c in ("anchor", "implementer", "first")]).alias("label"))


@query("""SELECT case_name, chk_date, count(DISTINCT regexp_replace(land_core, '\\s+', '', 'g')) AS lands FROM search_results WHERE status = 'resolved' AND chk_date IS NOT NULL AND case_name IS NOT NULL GROUP BY ALL HAVING count(DISTINCT regexp_replace(land_core, '\\s+', '', 'g')) >= 2""")
def shared_events(spark: SparkSession, d: str) -> DataFrame:
    """The same event shown under several lands."""
    s = table(spark, d, "search_results").where("status = 'resolved' and chk_date is not null and case_name is not null")
    return s.groupBy("case_name", "chk_date").agg(F.count_distinct(F.regexp_replace("land_core", r"\s+", "")).alias("lands")).where("lands >= 2")


@query(
    f"""WITH {AP},
 k AS (SELECT district, section, first, arg_min(implementer, recno) FILTER (stage_index = 0 AND implementer <> '') AS plan, arg_max(implementer, recno) FILTER (implementer <> '') AS latest, count(DISTINCT implementer) FILTER (implementer <> '') AS n FROM ap WHERE section <> '' GROUP BY district, section, first)
 SELECT district, section, first, coalesce(plan, latest) AS implementer, n > 1 AS conflict FROM k"""
)
def plan_values(spark: SparkSession, d: str) -> DataFrame:
    """A unit's value from its first plan, else its latest; whether its rows disagree."""
    said = F.col("implementer") != ""
    plan = said & (F.col("stage_index") == 0)
    g = approvals(spark, d, "recno", "district", "section", "first", "stage_index", "implementer").where("section != ''").groupBy("district", "section", "first").agg(
        F.min_by(F.when(plan, F.col("implementer")), F.when(plan, F.col("recno"))).alias("plan"),
        F.max_by(F.when(said, F.col("implementer")), F.when(said, F.col("recno"))).alias("latest"),
        F.count_distinct(F.when(said, F.col("implementer"))).alias("n"),
    )
    return g.select("district", "section", "first", F.coalesce("plan", "latest").alias("implementer"), (F.col("n") > 1).alias("conflict"))


_PROJECT = f"""pj AS (SELECT project_id, coalesce(p.dist, '') AS dist, {section_key_sql("p.sec")} AS sec, {strip0_sql("p.first")} AS first, try_cast(nullif(p.cnt, '') AS BIGINT) AS cnt, member_recnos FROM (SELECT *, regexp_extract({squeeze_sql(fold_sql("land_core"))}, '{PLACE}', ['dist', 'sec', 'first', 'cnt']) AS p FROM projects)),
 held AS (SELECT DISTINCT project_id, {strip0_sql("p")} AS p FROM (SELECT project_id, unnest(member_recnos)::BIGINT AS recno FROM projects) JOIN ap USING (recno), unnest(list_append(parcels, first)) t(p) WHERE p <> ''),
 own AS (SELECT project_id, p FROM held UNION SELECT project_id, first FROM pj)"""
_SEEN = f"""se AS (SELECT search_id, coalesce(p.dist, '') AS dist, {section_key_sql("p.sec")} AS sec, {strip0_sql("p.first")} AS first, try_cast(nullif(p.cnt, '') AS BIGINT) AS cnt FROM (SELECT search_id, regexp_extract({squeeze_sql(fold_sql("land_core"))}, '{PLACE}', ['dist', 'sec', 'first', 'cnt']) AS p FROM search_results))"""


@query(
    f"""WITH {AP}, {_PROJECT}, {_SEEN}, h AS (SELECT DISTINCT se.search_id, pj.project_id, round(0.85::DOUBLE + CASE WHEN se.cnt = pj.cnt THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END, 6) AS score FROM se JOIN pj ON se.sec = pj.sec AND se.dist = pj.dist JOIN own ON own.project_id = pj.project_id AND own.p = se.first WHERE se.sec <> '' AND se.first <> '' AND se.dist <> '')
 SELECT search_id, min(project_id) AS project_id, max(score) AS score FROM h GROUP BY search_id HAVING count(DISTINCT project_id) = 1"""
)
def core_offers(spark: SparkSession, d: str) -> DataFrame:
    """A searched land core goes to the only project of its district and section that has its parcel, as first or another of its own; place and parcel weigh .85, an equal count .1."""
    at = lambda df, key, *more: df.select(key, *more, land.place(no_space(fold_width(F.col("land_core")))).alias("p")).select(key, *more, F.coalesce("p.dist", F.lit("")).alias("dist"), "p.sec", "p.first", "p.cnt")
    p = at(table(spark, d, "projects"), "project_id", "member_recnos")
    held = p.select("project_id", F.explode(F.col("member_recnos").cast("array<bigint>")).alias("recno")).join(approvals(spark, d, "recno", "first", "parcels"), "recno")
    held = held.select("project_id", F.explode(F.array_union("parcels", F.array("first"))).alias("x")).unionByName(p.select("project_id", F.col("first").alias("x"))).where("x != ''")
    own = held.select("project_id", F.regexp_replace("x", "^0+(?=[0-9])", "").alias("first")).distinct().join(p.select("project_id", "dist", "sec", "cnt"), "project_id")
    s = at(table(spark, d, "search_results"), "search_id").where("sec != '' and first != '' and dist != ''").withColumnRenamed("cnt", "m")
    h = s.join(own, ["dist", "sec", "first"]).select("search_id", "project_id", F.round(F.lit(0.85) + F.when(F.col("m") == F.col("cnt"), 0.1).otherwise(0.0), 6).alias("score"))
    return match.unique_or_nothing(h, ["search_id"], "project_id").join(h.groupBy("search_id").agg(F.max("score").alias("score")), "search_id")


@query("""WITH l AS (SELECT source, case_id, max(crawled_at) AS last FROM documents WHERE case_id IS NOT NULL GROUP BY ALL), g AS (SELECT max(last) AS newest FROM l) SELECT source, count(*) AS cases, count(*) FILTER (last < newest - INTERVAL 90 DAY) AS stale FROM l, g GROUP BY source""")
def stale_cases(spark: SparkSession, d: str) -> DataFrame:
    """Cases last crawled more than 90 days before the newest crawl. The newest is one value."""
    last = table(spark, d, "documents").where("case_id is not null").groupBy("source", "case_id").agg(F.max("crawled_at").alias("last"))
    newest = last.agg(F.max("last").alias("n")).first()[0]
    old = F.col("last") < F.lit(newest).cast("timestamp_ntz") - F.expr("interval 90 days")
    return last.groupBy("source").agg(F.count("*").alias("cases"), F.count_if(old).alias("stale"))


@query("""WITH d AS (SELECT source, sha256(text) AS h, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY ALL) SELECT source, sum(n)::BIGINT AS documents, count(*) AS texts, sum(n - 1)::BIGINT AS repeats FROM d GROUP BY source""")
def content_digests(spark: SparkSession, d: str) -> DataFrame:
    """Distinct contents by digest."""
    h = table(spark, d, "documents").where("text is not null").groupBy("source", F.sha2("text", 256).alias("h")).agg(F.count("*").alias("n"))
    return h.groupBy("source").agg(F.sum("n").alias("documents"), F.count("*").alias("texts"), F.sum(F.col("n") - 1).alias("repeats"))


@query(r"""WITH m AS (SELECT doc_id, regexp_extract_all(regexp_replace(regexp_replace(text, '都市更新|事業計畫|權利變換|股份有限公司', '|', 'g'), '[^\p{Han}]+', '|', 'g'), '\p{Han}{4,}') AS runs FROM documents WHERE text IS NOT NULL) SELECT doc_id, len(list_distinct(runs)) AS n, list_sort(list_distinct(runs))[1] AS least FROM m""")
def place_runs(spark: SparkSession, d: str) -> DataFrame:
    """runs of four or more Han characters after masking boilerplate."""
    masked = F.regexp_replace(F.regexp_replace("text", "都市更新|事業計畫|權利變換|股份有限公司", "|"), r"[^\p{IsHan}]+", "|")
    runs = F.array_sort(F.array_distinct(F.regexp_extract_all(masked, F.lit(r"(\p{IsHan}{4,})"), F.lit(1))))
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.size(runs).cast("bigint").alias("n"), F.get(runs, F.lit(0)).alias("least"))


@query("""WITH p AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS c FROM embeddings, unnest(generate_series(1, len(embedding))) t(i) WHERE label IS NOT NULL GROUP BY label, i), c AS (SELECT label, list(c ORDER BY i) AS c FROM p GROUP BY label) SELECT vec_id, e.label, round(list_cosine_similarity(e.embedding::DOUBLE[], c.c), 4) AS similarity FROM embeddings e JOIN c ON c.label = e.label WHERE embedding IS NOT NULL""")
def label_centroids(spark: SparkSession, d: str) -> DataFrame:
    """F19's shape on vectors: each vector's cosine to the centroid of its label (one aggregation and one join on the label)."""
    e = table(spark, d, "embeddings").where("embedding is not null and label is not null")
    parts = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("c"))
    centre = parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "c"))), lambda s: s["c"]).alias("c"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    v = F.transform("embedding", lambda x: x.cast("double"))
    j = e.withColumn("v", v).join(centre, "label")
    return j.select("vec_id", "label", F.round(dot(F.col("v"), F.col("c")) / F.sqrt(dot(F.col("v"), F.col("v")) * dot(F.col("c"), F.col("c"))), 4).alias("similarity"))


@query(f"WITH {AP}, t AS (SELECT recno, district, section, first, parcels FROM ap WHERE section <> '' AND first <> ''), n AS (SELECT a.recno, b.recno AS next, len(list_intersect(a.parcels, b.parcels))::DOUBLE AS i, len(list_distinct(list_concat(a.parcels, b.parcels))) AS u FROM (SELECT *, lead(recno) OVER (PARTITION BY district, section, first ORDER BY recno) AS nx FROM t) a JOIN t b ON b.recno = a.nx) SELECT recno, next, round(CASE WHEN u = 0 THEN 0 ELSE i / u END, 6) AS overlap FROM n")
def parcel_drift(spark: SparkSession, d: str) -> DataFrame:
    """How a unit's parcels change from one approval to the next."""
    w = Window.partitionBy("district", "section", "first").orderBy("recno")
    a = approvals(spark, d, "recno", "district", "section", "first", "parcels").where("section != '' and first != ''").withColumns({"next": F.lead("recno").over(w), "np": F.lead("parcels").over(w)})
    return a.where("next is not null").select("recno", "next", F.round(jaccard(F.col("parcels"), F.col("np")), 6).alias("overlap"))
