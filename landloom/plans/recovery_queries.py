"""Recovery, candidate lists and member changes over the register."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import land
from ..operators import matching as match
from ..operators.intervals import merged, uncovered
from ..runtime import table
from .registry import AP, CASES, REL, anywhere, approvals, cases, cell_unit, cells_sql, kinds_sql, query, releases, section_key_sql

@query(f"WITH {cells_sql('c', 'SELECT release_id, district, land FROM release_records')} SELECT release_id, district, sec AS section, count(*) AS cells, max(coalesce(len(tokens), 0)) AS most FROM c GROUP BY ALL")
def candidate_corpus(spark: SparkSession, d: str) -> DataFrame:
    """The cells that may complete others, by publication and section; width and spacing don't tell cells apart."""
    r = table(spark, d, "release_records").withColumn("_cell", land.even_cell(F.col("land")))
    size = F.coalesce(F.size(land.parcel_tokens(F.col("_cell"))), F.lit(0)).cast("bigint")
    return r.groupBy("release_id", "district", land.section_token(F.col("_cell")).alias("section")).agg(F.count("*").alias("cells"), F.max(size).alias("most"))


@query(
    f"""WITH {AP}, {CASES}, u AS (SELECT *, {section_key_sql("section")} AS sec, {kinds_sql("track")} AS own FROM ap WHERE day IS NULL AND section <> '' AND first <> '')
 SELECT u.recno, min(cs.day) AS day FROM u JOIN cs ON cs.h_sec = u.sec AND cs.h_first = u.first AND (cs.h_dist = '' OR cs.h_dist = u.district) WHERE cs.day IS NOT NULL AND (cs.cnt IS NULL OR u."count" = 0 OR cs.cnt = u."count") AND (cs.stage IS NULL OR u.stage_index < 0 OR cs.stage = u.stage_index)
 AND (len(cs.kinds) = 0 OR len(u.own) = 0 OR list_sort(cs.kinds) = list_sort(u.own)) GROUP BY u.recno HAVING count(DISTINCT cs.day) = 1"""
)
def recovered_days(spark: SparkSession, d: str) -> DataFrame:
    """An undated record takes its day from the cases of its unit whose count, stage and kinds of plan don't differ, if they agree on one day."""
    a = approvals(spark, d, "recno", "day", "district", "section", "first", "count", "stage_index", "track").where("day is null and section != '' and first != ''")
    a = anywhere(a, alias="h_dist").select("recno", "h_dist", land.section_key(F.col("section")).alias("h_sec"), F.col("first").alias("h_first"), "count", "stage_index", land.kinds(F.col("track")).alias("own"))
    j = a.join(cases(spark, d).where("day is not null").select("h_dist", "h_sec", "h_first", "cnt", "stage", "kinds", "day"), ["h_dist", "h_sec", "h_first"])
    alike = lambda x, y, unknown: unknown | (F.col(x) == F.col(y))
    kinds = (F.size("kinds") == 0) | (F.size("own") == 0) | (F.array_sort("kinds") == F.array_sort("own"))
    j = j.where(alike("cnt", "count", F.col("cnt").isNull() | (F.col("count") == 0)) & alike("stage", "stage_index", F.col("stage").isNull() | (F.col("stage_index") < 0)) & kinds)
    return match.unique_or_nothing(j, ["recno"], "day")


UNITS = f"WITH {REL}, f AS (SELECT DISTINCT k, unit, name FROM rel WHERE unit IS NOT NULL), p AS (SELECT DISTINCT k, unit FROM f)"


@query(
    f"""{UNITS}, m AS (SELECT a.k, a.unit FROM p a JOIN p b ON b.k = a.k + 1 AND b.unit = a.unit), e AS (SELECT m.k, m.unit, name, sum(side) AS s FROM m JOIN (SELECT k, unit, name, 1 AS side FROM f UNION ALL SELECT k - 1, unit, name, 2 FROM f) USING (k, unit) GROUP BY ALL),
 g AS (SELECT k, unit, count(*) FILTER (s = 2) AS added, count(*) FILTER (s = 1) AS lost FROM e GROUP BY ALL) SELECT k, CASE WHEN added > 0 AND lost > 0 THEN 'both' WHEN added > 0 THEN 'grew' WHEN lost > 0 THEN 'shrank' ELSE 'same' END AS change, count(*) AS units FROM g GROUP BY ALL"""
)
def unit_member_changes(spark: SparkSession, d: str) -> DataFrame:
    """Units of consecutive releases by whether their approvals grew or shrank; a cell that names no parcel is no unit."""
    f = releases(spark, d, *cell_unit()).where("unit is not null").select("k", "unit", "name").distinct()
    old = f.select(F.struct("k", "unit").alias("old"), "name")
    new = f.select(F.struct((F.col("k") - 1).alias("k"), "unit").alias("new"), "name")
    pairs = old.select("old").distinct().join(new.select("new").distinct(), F.col("old") == F.col("new"))
    g = match.member_changes(old, new, pairs, "old", "new", "name")
    return g.groupBy("old.k", "change").agg(F.count("*").alias("units"))


SEG = "seg AS (SELECT l_orderkey AS k, least(l_shipdate::DATE, l_shipdate::DATE) AS lo, (l_shipdate::DATE + CAST(l_quantity AS INTEGER))::DATE AS hi FROM lineitem)"


@query(
    f"""WITH {SEG}, r AS (SELECT *, CASE WHEN lo > max(hi) OVER (PARTITION BY k ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS n FROM seg), i AS (SELECT *, sum(n) OVER (PARTITION BY k ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM r), m AS (SELECT k, g, min(lo) AS lo, max(hi) AS hi FROM i GROUP BY k, g)
 SELECT islands, count(*) AS orders FROM (SELECT k, count(*) AS islands FROM m GROUP BY k) GROUP BY islands"""
)
def merged_spans(spark: SparkSession, d: str) -> DataFrame:
    """Unions of overlapping spans per key, counted."""
    lo = F.to_date("l_shipdate")
    seg = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.unix_date(lo).alias("lo"), (F.unix_date(lo) + F.col("l_quantity").cast("int")).alias("hi"))
    return merged(seg, ["k"]).groupBy("k").agg(F.count("*").alias("islands")).groupBy("islands").agg(F.count("*").alias("orders"))


@query(f"WITH {SEG}, sp AS (SELECT o_orderkey AS k, o_orderdate::DATE + 20 AS a, o_orderdate::DATE + 40 AS b FROM orders), r AS (SELECT *, CASE WHEN lo > max(hi) OVER (PARTITION BY k ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS n FROM seg), i AS (SELECT *, sum(n) OVER (PARTITION BY k ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM r), m AS (SELECT k, min(lo) AS lo, max(hi) AS hi FROM i GROUP BY k, g) SELECT k FROM sp WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.k = sp.k AND m.lo <= a AND m.hi >= b)")
def uncovered_spans(spark: SparkSession, d: str) -> DataFrame:
    """Spans that no union of segments contains."""
    lo, day = F.to_date("l_shipdate"), F.unix_date(F.to_date("o_orderdate"))
    seg = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.unix_date(lo).alias("lo"), (F.unix_date(lo) + F.col("l_quantity").cast("int")).alias("hi"))
    spans = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), (day + 20).alias("s_lo"), (day + 40).alias("s_hi"))
    return uncovered(spans, seg, ["k"]).select("k")
