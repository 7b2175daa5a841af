"""Aggregates, rankings and lists of the dashboard, over the register and the trade tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import matching as match
from ..operators import measures
from ..operators.measures import half_up
from ..runtime import table
from .registry import AP, approvals, query

ORD = """o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::DATE AS od, s.first_ship, s.last_ship, s.lines FROM orders
 LEFT JOIN (SELECT l_orderkey, min(l_shipdate::DATE) AS first_ship, max(l_shipdate::DATE) AS last_ship, count(*) AS lines FROM lineitem GROUP BY l_orderkey) s ON l_orderkey = o_orderkey)"""


def _orders(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min(F.to_date("l_shipdate")).alias("first_ship"), F.max(F.to_date("l_shipdate")).alias("last_ship"), F.count("*").alias("lines"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("od"))
    return o.join(s, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


@query(f"WITH {AP} SELECT substr(day, 1, 4) AS year, count(*) FILTER (stage_index = 0) AS n_new, count(*) FILTER (stage_index > 0) AS n_changed FROM ap WHERE day IS NOT NULL GROUP BY year")
def approvals_by_year(spark: SparkSession, d: str) -> DataFrame:
    """A07."""
    a = approvals(spark, d, "day", "stage_index").where("day is not null")
    return a.groupBy(F.substring("day", 1, 4).alias("year")).agg(F.count_if(F.col("stage_index") == 0).alias("n_new"), F.count_if(F.col("stage_index") > 0).alias("n_changed"))


@query(
    f"""WITH {ORD}, x AS (SELECT year(od)::INTEGER AS year, (first_ship - od)::DOUBLE AS v FROM o WHERE first_ship IS NOT NULL)
 SELECT year, count(*) AS n, min(v) AS lo, floor(quantile_cont(v, 0.25) * 10 + 0.5) / 10 AS q1, floor(quantile_cont(v, 0.5) * 10 + 0.5) / 10 AS med, floor(quantile_cont(v, 0.75) * 10 + 0.5) / 10 AS q3, max(v) AS hi FROM x GROUP BY year"""
)
def review_spread_by_year(spark: SparkSession, d: str) -> DataFrame:
    """The interval from order to first shipment."""
    x = _orders(spark, d).where("first_ship is not null").select(F.year("od").alias("year"), F.datediff("first_ship", "od").cast("double").alias("v"))
    return measures.spread(x, ["year"], "v")


@query(
    f"""WITH {ORD} SELECT CASE WHEN grouping(n_name) = 1 THEN '全部' ELSE n_name END AS n_name, count(*) AS n, floor(count(*) FILTER (o_orderstatus = 'F') * 1000.0 / count(*) + 0.5) / 10 AS done_pct,
 median((first_ship - od)::DOUBLE) AS med_days, count(*) FILTER (last_ship - od > 100) AS slow, sum(lines)::BIGINT AS lines FROM o JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ROLLUP (n_name)"""
)
def kpi_by_nation_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Figures per group and over all in one rollup."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = _orders(spark, d).join(c, F.col("c_custkey") == F.col("o_custkey")).join(n, F.col("n_nationkey") == F.col("c_nationkey"))
    return measures.with_total(
        j, "n_name", "全部",
        F.count("*").alias("n"),
        half_up(F.count_if(F.col("o_orderstatus") == "F") * 100.0 / F.nullif(F.count("*"), F.lit(0)), 1).alias("done_pct"),
        F.percentile(F.datediff("first_ship", "od").cast("double"), F.lit(0.5)).alias("med_days"),
        F.count_if(F.datediff("last_ship", "od") > 100).alias("slow"),
        F.sum("lines").alias("lines"),
    )


@query(
    f"""WITH {AP}, dims AS (SELECT s::BIGINT AS stage_index, t AS track FROM (VALUES (0), (1), (2), (3), (4), (5)) a(s), (VALUES ('事業概要'), ('事業計畫'), ('權利變換計畫'), ('事業計畫及權利變換計畫')) b(t))
 SELECT d.stage_index, d.track, count(ap.recno) AS n, count(ap.recno) FILTER (ap.day IS NULL) AS undated FROM dims d LEFT JOIN ap ON ap.stage_index = d.stage_index AND ap.track = d.track GROUP BY ALL"""
)
def pipeline_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Stages by track, empty combinations with zeros."""
    dims = spark.createDataFrame([(s, t) for s in range(6) for t in ("事業概要", "事業計畫", "權利變換計畫", "事業計畫及權利變換計畫")], "stage_index bigint, track string")
    return measures.zero_filled(approvals(spark, d, "stage_index", "track", "day"), dims, ["stage_index", "track"], {"n": F.count("*"), "undated": F.count_if(F.col("day").isNull())})


@query(
    f"""WITH {ORD} SELECT o_custkey, count(*) AS orders, min(od) AS first_day, max(od) AS last_day, arg_min(o_orderkey, (od, o_orderkey)) FILTER (o_orderstatus = 'O') AS first_open, min(last_ship) FILTER (o_orderstatus = 'F') AS first_done,
 CASE WHEN max(od) >= min(od) THEN floor((max(od) - min(od)) / 365.25 * 100 + 0.5) / 100 END AS years FROM o GROUP BY o_custkey"""
)
def flatten_customers(spark: SparkSession, d: str) -> DataFrame:
    """One row per group with filtered extremes and argmins."""
    from ..functions.dates import years_between

    o = _orders(spark, d)
    open_ = F.col("o_orderstatus") == "O"
    g = o.groupBy("o_custkey").agg(
        F.count("*").alias("orders"),
        F.min("od").alias("first_day"),
        F.max("od").alias("last_day"),
        F.min_by(F.when(open_, F.col("o_orderkey")), F.when(open_, F.struct("od", "o_orderkey"))).alias("first_open"),
        F.min(F.when(F.col("o_orderstatus") == "F", F.col("last_ship"))).alias("first_done"),
    )
    return g.withColumn("years", years_between(F.col("first_day"), F.col("last_day")))


@query(f"WITH {ORD} SELECT o_orderkey, (last_ship - od)::INTEGER AS idle FROM o WHERE o_orderstatus <> 'F' AND last_ship - od >= 100")
def watchlist(spark: SparkSession, d: str) -> DataFrame:
    """O01."""
    idle = F.datediff("last_ship", "od")
    return _orders(spark, d).where((F.col("o_orderstatus") != "F") & (idle >= 100)).select("o_orderkey", idle.alias("idle")).orderBy(F.desc("idle"), "o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 12")
def top_twelve(spark: SparkSession, d: str) -> DataFrame:
    """A top-12 report."""
    return table(spark, d, "orders").where("o_orderstatus <> 'F'").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_totalprice").limit(12)


@query(f"WITH {AP} SELECT district, count(*) AS n, sum(\"count\")::BIGINT AS parcels FROM ap GROUP BY district")
def district_bars(spark: SparkSession, d: str) -> DataFrame:
    """O05."""
    return approvals(spark, d, "district", "count").groupBy("district").agg(F.count("*").alias("n"), F.sum("count").alias("parcels")).orderBy(F.desc("parcels"), "district")


@query("SELECT project_id, anchor_recno FROM projects ORDER BY anchor_recno NULLS LAST, project_id OFFSET 40 LIMIT 86")
def list_window(spark: SparkSession, d: str) -> DataFrame:
    """The visible slice of the project list."""
    return table(spark, d, "projects").select("project_id", "anchor_recno").orderBy(F.asc_nulls_last("anchor_recno"), "project_id").offset(40).limit(86)


@query(f"WITH {AP}, r AS (SELECT section, recno, row_number() OVER (PARTITION BY section ORDER BY recno) AS k, count(*) OVER (PARTITION BY section) AS n FROM ap) SELECT section, string_agg(recno::VARCHAR, ',' ORDER BY recno) AS shown, greatest(max(n) - 10, 0) AS more FROM r WHERE k <= 10 GROUP BY section")
def previews(spark: SparkSession, d: str) -> DataFrame:
    """The first ten of each section and how many more; the smallest are kept while aggregating, not ranked in one task."""
    a = approvals(spark, d, "recno", "section").withColumn("p", F.pmod(F.xxhash64("recno"), F.lit(32)))
    few = lambda c: F.slice(F.array_sort(c), 1, 10)
    part = a.groupBy("section", "p").agg(few(F.collect_list("recno")).alias("x"), F.count("*").alias("n"))
    g = part.groupBy("section").agg(few(F.flatten(F.collect_list("x"))).alias("x"), F.sum("n").alias("n"))
    return g.select("section", F.array_join(F.transform("x", lambda v: v.cast("string")), ",").alias("shown"), F.greatest(F.col("n") - 10, F.lit(0)).alias("more"))


@query(f"WITH {AP} SELECT 'district' AS facet, district AS value, count(*) AS n FROM ap GROUP BY ALL UNION ALL SELECT 'year', substr(day, 1, 4), count(*) FROM ap WHERE day IS NOT NULL GROUP BY ALL UNION ALL SELECT 'track', track, count(*) FROM ap GROUP BY ALL")
def facet_options(spark: SparkSession, d: str) -> DataFrame:
    """One pass for all facets."""
    a = approvals(spark, d, "district", "day", "track")
    f = lambda n, c: F.struct(F.lit(n).alias("facet"), c.alias("value"))
    e = a.select(F.explode(F.array(f("district", F.col("district")), f("year", F.substring("day", 1, 4)), f("track", F.col("track")))).alias("f"))
    return e.where("f.value is not null").groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


@query(f"WITH {AP} SELECT recno FROM ap WHERE district IN ('大安區', '中山區') AND substr(day, 1, 4) IN ('2015', '2016', '2017') AND contains(track, '權利變換') AND contains(name || '|' || section || '|' || implementer, '建設')")
def facet_search(spark: SparkSession, d: str) -> DataFrame:
    """AND across facets, OR within, text search over the joined fields."""
    hay = F.concat_ws("|", "name", "section", "implementer")
    return approvals(spark, d, "recno", "district", "day", "track", "name", "section", "implementer").where(F.col("district").isin("大安區", "中山區") & F.substring("day", 1, 4).isin("2015", "2016", "2017") & F.col("track").contains("權利變換") & hay.contains("建設")).select("recno")


@query(
    """WITH e AS (SELECT user_id, event_type, event_id, ts, round(value, 0) AS v FROM events WHERE value IS NOT NULL), m AS (SELECT *, lag(v) OVER w IS DISTINCT FROM v AS nw FROM e WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
 o AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS seq FROM m)
 SELECT user_id, event_type, arg_max(v, seq) AS v, arg_max(event_id, seq) FILTER (nw) AS event_id FROM o GROUP BY ALL"""
)
def milestone_fold(spark: SparkSession, d: str) -> DataFrame:
    """Last value written per label, credited to the first writer of its final run."""
    e = table(spark, d, "events").where("value is not null").select("user_id", "event_type", "event_id", F.round("value", 0).alias("v"), F.struct("ts", "event_id").alias("seq"))
    return measures.fold_last(e, ["user_id", "event_type"], "v", "seq", "event_id")


FILLED = ["iso_date", "district", "section", "first_parcel", "parcels", "aliases", "named_anchor", "implementer", "planner"]


@query(f"""WITH f AS (SELECT recno, clean_id, {" + ".join(f"(coalesce({c}, '') <> '')::BIGINT" for c in FILLED)} AS filled FROM clean_records)
 SELECT recno, arg_max(clean_id, (filled, -clean_id)) AS clean_id, max(filled) AS filled FROM f GROUP BY recno""")
def best_copy(spark: SparkSession, d: str) -> DataFrame:
    """Of each number the row with most fields filled, the first of equals."""
    filled = sum((F.when(F.coalesce(c, F.lit("")) != "", 1).otherwise(0) for c in FILLED[1:]), F.when(F.coalesce(FILLED[0], F.lit("")) != "", 1).otherwise(0)).cast("bigint")
    c = table(spark, d, "clean_records").select("recno", "clean_id", filled.alias("filled"))
    return measures.best_payload(c, "recno", F.col("filled"), "clean_id", ["clean_id", "filled"])


@query("""WITH s AS (SELECT unnest(case_ids) AS case_id, case_name, land_core FROM search_results WHERE status = 'resolved') SELECT case_id, count(*) AS hits, count(DISTINCT case_name) AS names, count(DISTINCT land_core) AS lands FROM s GROUP BY case_id""")
def case_register(spark: SparkSession, d: str) -> DataFrame:
    """Names and lands per case id."""
    s = table(spark, d, "search_results").where("status = 'resolved'").select(F.explode("case_ids").alias("case_id"), "case_name", "land_core")
    return s.groupBy("case_id").agg(F.count("*").alias("hits"), F.count_distinct("case_name").alias("names"), F.count_distinct("land_core").alias("lands"))


@query("""WITH s AS (SELECT DISTINCT unnest(case_ids) AS case_id FROM search_results) SELECT source, count(*) AS n, count(*) FILTER (d.case_id IS NULL) AS without_case, count(*) FILTER (s.case_id IS NOT NULL) AS known, count(*) FILTER (d.case_id IS NOT NULL AND s.case_id IS NULL) AS orphan FROM documents d LEFT JOIN s USING (case_id) GROUP BY source""")
def case_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Documents by whether their case is known."""
    s = table(spark, d, "search_results").select(F.explode("case_ids").alias("case_id")).distinct().withColumn("known", F.lit(True))
    j = table(spark, d, "documents").select("source", "case_id").join(s, "case_id", "left")
    return j.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("case_id").isNull()).alias("without_case"), F.count_if("known").alias("known"), F.count_if(F.col("case_id").isNotNull() & F.col("known").isNull()).alias("orphan"))


@query(f"WITH {AP} SELECT min(day) AS first_day, max(day) AS last_day, count(*) AS n, count(*) FILTER (day IS NULL) AS undated, count(*) FILTER (orig > 0 AND \"count\" > 0 AND orig <> \"count\") AS disagree, floor(count(*) FILTER (stage_index > 0) * 1000.0 / nullif(count(*), 0) + 0.5) / 10 AS repeat_pct FROM ap")
def corpus_measurements(spark: SparkSession, d: str) -> DataFrame:
    """A17."""
    a = approvals(spark, d, "day", "orig", "count", "stage_index")
    return a.agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("n"), F.count_if(F.col("day").isNull()).alias("undated"),
        F.count_if((F.col("orig") > 0) & (F.col("count") > 0) & (F.col("orig") != F.col("count"))).alias("disagree"), half_up(F.count_if(F.col("stage_index") > 0) * 100.0 / F.nullif(F.count("*"), F.lit(0)), 1).alias("repeat_pct"),
    )


@query("WITH e AS (SELECT user_id, floor(epoch(ts)) AS s FROM events), g AS (SELECT user_id, s, s - lag(s) OVER (PARTITION BY user_id ORDER BY s) AS g FROM e), n AS (SELECT max(s) AS now FROM e) SELECT user_id, greatest(max(g), any_value(now) - max(s))::BIGINT AS max_gap_s, count(*) AS n FROM g, n GROUP BY user_id")
def longest_gap(spark: SparkSession, d: str) -> DataFrame:
    """With the time since a group's last event."""
    return measures.longest_gap(table(spark, d, "events"), ["user_id"], "ts")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, floor(sum(value) * 100 + 0.5) / 100 AS total FROM events GROUP BY ALL")
def events_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """§2.10: the batch form of the streaming window in ``streaming.intake``."""
    from ..streaming.intake import tumbling

    return tumbling(table(spark, d, "events")).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", half_up(F.col("total"), 2).alias("total"))


@query("""WITH e AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM e)
 SELECT user_id, min(ts) AS start, count(*) AS n FROM i GROUP BY user_id, k""")
def events_sessions(spark: SparkSession, d: str) -> DataFrame:
    """§2.10: sessions that end after 30 minutes without an event."""
    from ..streaming.intake import sessions

    return sessions(table(spark, d, "events")).select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_state(spark: SparkSession, d: str) -> DataFrame:
    """§2.10, W13."""
    return match.latest_per_key(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "event_type")


@query("SELECT event_type, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL")
def json_fields(spark: SparkSession, d: str) -> DataFrame:
    """Landed JSON to columns."""
    return table(spark, d, "events").groupBy("event_type", F.from_json("props", "k bigint")["k"].alias("k")).agg(F.count("*").alias("n"))
