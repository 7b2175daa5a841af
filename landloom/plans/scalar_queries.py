"""Scalar functions of the register applied to whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, land
from ..functions.text import fold_width, no_space
from ..operators import matching as match
from ..runtime import table
from .registry import AP, CASES, approvals, cases, days_sql, fold_sql, query, squeeze_sql

NAME = land.NAME_PATTERN


@query(f"SELECT clean_id, nullif(p.d, '') AS district, nullif(p.s, '') AS section, nullif(p.p, '') AS parcel, try_cast(nullif(p.n, '') AS INT) AS \"count\" FROM (SELECT clean_id, regexp_extract({squeeze_sql(fold_sql('name'))}, '{NAME}', ['d', 's', 'p', 'n']) AS p FROM clean_records)")
def name_identities(spark: SparkSession, d: str) -> DataFrame:
    """What a name says of district, section, parcel and count."""
    return table(spark, d, "clean_records").select("clean_id", land.name_identity(no_space(fold_width(F.col("name")))).alias("p")).select("clean_id", "p.*")


@query("SELECT search_id, regexp_replace(regexp_replace(trim(c), '^[A-Z]', ''), '-[0-9]+$', '') AS number FROM search_results, unnest(case_ids) t(c)")
def case_numbers(spark: SparkSession, d: str) -> DataFrame:
    """case ids without letter and sub-number."""
    return table(spark, d, "search_results").select("search_id", F.explode("case_ids").alias("c")).select("search_id", land.case_number(F.col("c")).alias("number"))


@query(r"""WITH t AS (SELECT search_id, regexp_extract(trim(chk_date), '^(\d{1,4})[/-](\d{1,2})[/-](\d{1,2})(?:[T ].*)?$', ['y', 'm', 'd']) AS p FROM search_results WHERE chk_date IS NOT NULL) SELECT search_id, lpad(p.y, CASE WHEN p.y::INT > 999 THEN 4 ELSE 3 END, '0') || '-' || lpad(p.m, 2, '0') || '-' || lpad(p.d, 2, '0') AS padded FROM t WHERE p.y <> ''""")
def padded_days(spark: SparkSession, d: str) -> DataFrame:
    """days with padded month and day, an ROC year kept."""
    return table(spark, d, "search_results").select("search_id", dates.padded(F.col("chk_date")).alias("padded")).where("padded is not null")


@query(r"""WITH t AS (SELECT search_id, regexp_extract(trim(chk_date), '^(\d{4})[/-](\d{1,2})[/-](\d{1,2})', ['y', 'm', 'd']) AS g, regexp_extract(trim(chk_date), '^(\d{2,3})\.(\d{1,2})\.(\d{1,2})$', ['y', 'm', 'd']) AS r FROM search_results WHERE chk_date IS NOT NULL),
 v AS (SELECT search_id, try_cast(CASE WHEN g.y <> '' THEN printf('%04d-%02d-%02d', g.y::INT, g.m::INT, g.d::INT) WHEN r.y <> '' THEN printf('%04d-%02d-%02d', r.y::INT + 1911, r.m::INT, r.d::INT) END AS DATE) AS day FROM t) SELECT search_id, day FROM v WHERE day BETWEEN DATE '1995-01-01' AND DATE '2020-12-31'""")
def shown_days(spark: SparkSession, d: str) -> DataFrame:
    """The days a dashboard shows: real ones from 1995 to a given day."""
    return table(spark, d, "search_results").select("search_id", dates.display_day(F.col("chk_date"), F.lit("2020-12-31").cast("date")).alias("day")).where("day is not null")


@query(f"""WITH {AP}, {CASES}, b AS (SELECT recno, day FROM ap WHERE day IS NOT NULL), c AS (SELECT case_id, min(day) AS one, max(day) AS two FROM cs WHERE case_id IS NOT NULL AND day IS NOT NULL GROUP BY case_id),
 k AS (SELECT project_id, unnest(member_recnos)::BIGINT AS recno FROM projects), p AS (SELECT DISTINCT project_id, case_id FROM (SELECT project_id, {squeeze_sql(fold_sql("land_core"))} AS lc FROM projects) JOIN cs USING (lc) WHERE case_id IS NOT NULL)
 SELECT b.recno, c.case_id, CASE WHEN one = day THEN 'field1' WHEN two = day THEN 'field2' WHEN abs(try_cast(one AS DATE) - try_cast(day AS DATE)) = 1 THEN 'field1_off_by_one' WHEN abs(try_cast(two AS DATE) - try_cast(day AS DATE)) = 1 THEN 'field2_off_by_one' ELSE 'none' END AS closes FROM k JOIN b USING (recno) JOIN p USING (project_id) JOIN c USING (case_id)""")
def date_closures(spark: SparkSession, d: str) -> DataFrame:
    """how the first and last day of a case found under a project's land confirm the days of its approvals."""
    cs = cases(spark, d).where("case_id is not null")
    c = cs.where("day is not null").groupBy("case_id").agg(F.min("day").alias("one"), F.max("day").alias("two"))
    lc = table(spark, d, "projects").select("project_id", no_space(fold_width(F.col("land_core"))).alias("lc"))
    p = lc.join(cs.select("lc", "case_id"), "lc").select("project_id", "case_id").distinct()
    k = table(spark, d, "projects").select("project_id", F.explode(F.col("member_recnos").cast("array<bigint>")).alias("recno"))
    j = k.join(approvals(spark, d, "recno", "day").where("day is not null"), "recno").join(p, "project_id").join(c, "case_id")
    return j.select("recno", "case_id", dates.closes(F.col("day"), F.col("one"), F.col("two")).alias("closes"))


@query("SELECT event_id, array_to_string(list_sort(json_keys(props)), '|') AS keys FROM events WHERE json_keys(props) <> []")
def kept_json(spark: SparkSession, d: str) -> DataFrame:
    """The fields of a landed JSON document that hold something."""
    m = land.kept_fields(F.from_json("props", "map<string,string>"))
    return table(spark, d, "events").select("event_id", F.array_join(F.array_sort(F.map_keys(m)), "|").alias("keys")).where("keys != ''")


@query(r"SELECT doc_id FROM documents WHERE regexp_matches(text, '[A-Z甲乙丙丁](?:區段?|基地)(?:[^公]|公[^所]|公?$)|第[一二三四五六七八九]期')")
def zone_names(spark: SparkSession, d: str) -> DataFrame:
    """Texts that speak of a lettered or numbered zone."""
    return table(spark, d, "documents").where(land.zone_marker(F.col("text"))).select("doc_id")


@query(rf"""WITH x AS (SELECT permit_id, p.section || p.mono AS t FROM permit_records, unnest(parcels) u(p)), f AS (SELECT permit_id, {squeeze_sql(fold_sql("t"))} AS t FROM x WHERE t IS NOT NULL)
 SELECT permit_id, nullif(regexp_extract(t, '^(.*段(?:[^0-9]*小段)?)', 1), '') AS section, nullif(regexp_extract(t, '段(?:[^0-9]*小段)?0*([0-9]+)(?:-0*([0-9]+))?(?:地號)?$', 1), '') AS main FROM f""")
def permit_numbers(spark: SparkSession, d: str) -> DataFrame:
    """section and number of each land of a permit."""
    x = table(spark, d, "permit_records").select("permit_id", F.explode("parcels").alias("p")).select("permit_id", F.concat("p.section", "p.mono").alias("t")).where("t is not null")
    return x.select("permit_id", land.land_number(F.col("t")).alias("n")).select("permit_id", "n.section", "n.main")


#: A ring of (x, y): an irregular polygon over quantities and discounts.
RING = [(5.0, 1.0), (45.0, 0.5), (40.0, 8.5), (25.0, 4.0), (10.0, 9.0)]
_EDGES = list(zip(RING, RING[1:] + RING[:1]))


@query("SELECT l_linestatus, count(*) AS n FROM (SELECT l_linestatus, l_quantity::DOUBLE AS x, l_discount::DOUBLE * 100 AS y FROM lineitem) WHERE (" + " + ".join(f"CASE WHEN ({y1}::DOUBLE > y) <> ({y2}::DOUBLE > y) AND x < ({x2 - x1}::DOUBLE) * (y - {y1}::DOUBLE) / ({y2 - y1}::DOUBLE) + {x1}::DOUBLE THEN 1 ELSE 0 END" for (x1, y1), (x2, y2) in _EDGES) + ") % 2 = 1 GROUP BY l_linestatus")
def points_in_ring(spark: SparkSession, d: str) -> DataFrame:
    """points inside a ring by the even-odd rule."""
    ring = F.array(*[F.array(F.lit(x), F.lit(y)) for x, y in RING])
    p = table(spark, d, "lineitem").select("l_linestatus", F.col("l_quantity").cast("double").alias("x"), (F.col("l_discount").cast("double") * 100).alias("y"))
    return p.where(land.even_odd(F.col("x"), F.col("y"), ring)).groupBy("l_linestatus").agg(F.count("*").alias("n"))


@query("SELECT (o_totalprice >= 500)::INT + (o_totalprice >= 1000)::INT + (o_totalprice >= 2000)::INT + (o_totalprice >= 3000)::INT AS bucket, count(*) AS n FROM orders GROUP BY 1")
def area_buckets(spark: SparkSession, d: str) -> DataFrame:
    """sizes by the steps they reach."""
    return table(spark, d, "orders").groupBy(land.area_bucket(F.col("o_totalprice")).cast("int").alias("bucket")).agg(F.count("*").alias("n"))


@query(f"""WITH c AS (SELECT recno, clean_id, nullif(district, '') AS district, nullif(implementer, '') AS implementer, nullif(planner, '') AS planner, row_number() OVER (PARTITION BY recno ORDER BY clean_id) AS k FROM clean_records WHERE recno IS NOT NULL), a AS (SELECT * FROM c WHERE k = 1), b AS (SELECT * FROM c WHERE k = 2)
 SELECT recno, coalesce(a.district, b.district) AS district, coalesce(a.implementer, b.implementer) AS implementer, coalesce(a.planner, b.planner) AS planner FROM a FULL JOIN b USING (recno)""")
def merged_copies(spark: SparkSession, d: str) -> DataFrame:
    """Two copies of a record merged: the first one's values, filled in from the second."""
    blank = lambda c: F.nullif(c, F.lit("")).alias(c)
    c = table(spark, d, "clean_records").where("recno is not null").select("recno", "clean_id", *[blank(x) for x in ("district", "implementer", "planner")])
    first = match.first_per_key(c, ["recno"], [F.col("clean_id")])
    second = match.first_per_key(c.join(first.select("recno", "clean_id"), ["recno", "clean_id"], "left_anti"), ["recno"], [F.col("clean_id")])
    return match.coalesce_merge(first.drop("clean_id"), second.drop("clean_id"), ["recno"])


@query(f"""WITH {days_sql("cd", "SELECT clean_id AS key, iso_date AS v, zone FROM clean_records LEFT JOIN feeds USING (feed_id)")} SELECT clean_id, cd.day FROM clean_records JOIN cd ON key = clean_id WHERE cd.day IS NOT NULL""")
def clock_days(spark: SparkSession, d: str) -> DataFrame:
    """the day each value names on its feed's clock, whatever its form."""
    c = table(spark, d, "clean_records").join(table(spark, d, "feeds").select("feed_id", "zone"), "feed_id", "left")
    return c.select("clean_id", dates.clock_day(F.col("iso_date"), F.col("zone")).alias("day")).where("day is not null")


@query("WITH s AS (SELECT DISTINCT section FROM clean_records WHERE coalesce(section, '') <> '') SELECT section, row_number() OVER (ORDER BY section COLLATE zh_hk, section)::INT AS pos FROM s")
def sections_in_locale_order(spark: SparkSession, d: str) -> DataFrame:
    """The distinct sections in the order of the locale (strokes of traditional Chinese). A short list, ordered in one window."""
    from pyspark.sql import Window

    s = table(spark, d, "clean_records").where("coalesce(section, '') != ''").select("section").distinct()
    return s.withColumn("pos", F.row_number().over(Window.orderBy(F.collate("section", "zh_Hant"), "section")))
