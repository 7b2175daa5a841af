"""Comparison of publications, gates and orderings over the register."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, land
from ..functions.text import fold_width
from ..operators import matching as match
from ..operators import measures, quality
from ..operators import publication as pub
from ..runtime import table
from .registry import AP, REL, approvals, cells_sql, fold_sql, query, releases, squeeze_sql

PAIRED = (
    f"WITH {REL}, "
    + """c AS (SELECT k, district, land, day, count(*) AS n FROM rel GROUP BY ALL), top AS (SELECT max(k) AS m FROM rel),
 per AS (SELECT pair, district, land, day, sum(p) AS p, sum(c) AS c FROM (SELECT k AS pair, district, land, day, n AS p, 0 AS c FROM c UNION ALL SELECT k - 1, district, land, day, 0, n FROM c), top WHERE pair >= 1 AND pair < m GROUP BY ALL),
 g AS (SELECT pair, district, land, sum(p) AS p, sum(c) AS c, sum(greatest(p - c, 0)) AS lost, sum(greatest(c - p, 0)) AS gained FROM per GROUP BY ALL)"""
)


@query(
    PAIRED
    + """ SELECT pair, sum(CASE WHEN c = 0 THEN p ELSE 0 END)::BIGINT AS vanished, sum(CASE WHEN p = 0 THEN c ELSE 0 END)::BIGINT AS "new",
 sum(CASE WHEN p > 0 AND c > 0 THEN least(lost, gained) ELSE 0 END)::BIGINT AS redated, sum(CASE WHEN p > 0 AND c > 0 THEN p - lost ELSE 0 END)::BIGINT AS kept FROM g GROUP BY pair"""
)
def reconcile_publications(spark: SparkSession, d: str) -> DataFrame:
    """Vanished, new, redated and kept entries of consecutive releases."""
    return pub.reconcile(releases(spark, d), ["district", "land"], "day", "k")


@query(f"WITH {REL}, t AS (SELECT k + 1 AS k, max(day) AS top FROM rel GROUP BY k) SELECT release_row, rel.k FROM rel JOIN t USING (k) WHERE day > top")
def new_cohort(spark: SparkSession, d: str) -> DataFrame:
    """J03a."""
    return pub.new_cohort(releases(spark, d), "day", "k").select("release_row", "k")


@query(
    f"WITH {REL}, t AS (SELECT k, max(day) AS top FROM rel GROUP BY k), n AS (SELECT k, max(k) OVER () AS m FROM t) SELECT release_row, rel.k FROM rel JOIN t USING (k) JOIN n USING (k) WHERE day = top AND rel.k < m AND NOT EXISTS (SELECT 1 FROM rel x WHERE x.k = rel.k + 1 AND x.land = rel.land AND x.day = rel.day)"
)
def withdrawn_from_newest(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a release's newest day that the next release no longer has."""
    r = releases(spark, d)
    t = r.groupBy("k").agg(F.max("day").alias("day"))
    last = r.agg(F.max("k")).first()[0]
    nxt = r.select((F.col("k") - 1).alias("k"), "land", "day").distinct()
    return r.join(t, ["k", "day"]).where(F.col("k") < F.lit(last)).join(nxt, ["k", "land", "day"], "left_anti").select("release_row", "k")


@query(f"WITH {REL} SELECT k, land, day, count(*) AS n FROM (SELECT k, land, day FROM rel EXCEPT ALL SELECT k + 1, land, day FROM rel) GROUP BY ALL")
def multiset_gains(spark: SparkSession, d: str) -> DataFrame:
    """Entries that each release has more often than the one before."""
    r = releases(spark, d)
    return pub.multiset_minus(r.select("k", "land", "day"), r.select((F.col("k") + 1).alias("k"), "land", "day")).groupBy("k", "land", "day").agg(F.count("*").alias("n"))


@query(f"WITH {REL} SELECT k, substr(day, 1, 4) AS year, count(*) AS n FROM (SELECT k, land, day FROM rel EXCEPT ALL SELECT k + 1, land, day FROM rel) WHERE day IS NOT NULL GROUP BY ALL")
def churn_by_year(spark: SparkSession, d: str) -> DataFrame:
    """A15."""
    return multiset_gains(spark, d).where("day is not null").groupBy("k", F.substring("day", 1, 4).alias("year")).agg(F.sum("n").alias("n"))


@query(
    f"""WITH {REL}, s AS (SELECT k, land, bool_or(day IS NOT NULL) AS f FROM rel GROUP BY k, land), top AS (SELECT max(k) AS m FROM rel),
 b AS (SELECT land, f FROM s, top WHERE k = m - 1), a AS (SELECT land, f FROM s, top WHERE k = m)
 SELECT count(*) FILTER (a.land IS NULL) AS lost, count(*) FILTER (b.land IS NULL) AS gained, count(*) FILTER (a.land = b.land) AS shared, count(*) FILTER (a.land = b.land AND b.f AND NOT a.f) AS regressions, count(*) FILTER (a.land = b.land) = 0 AS total_rekey FROM b FULL JOIN a ON a.land = b.land"""
)
def coverage_diff(spark: SparkSession, d: str) -> DataFrame:
    """Which lands lost their day between the last two releases."""
    r = releases(spark, d)
    s = r.groupBy("k", "land").agg(F.bool_or(F.col("day").isNotNull()).alias("f"))
    last = r.agg(F.max("k")).first()[0] or 0
    return pub.snapshot_diff(s.where(F.col("k") == last - 1).drop("k"), s.where(F.col("k") == last).drop("k"), "land", "f")


@query(f"WITH {REL} SELECT k, recno, min(release_row) AS release_row, count(*) AS printed FROM rel GROUP BY k, recno")
def first_of_number(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each number in a release, and how often it is printed."""
    return releases(spark, d).groupBy("k", "recno").agg(F.min("release_row").alias("release_row"), F.count("*").alias("printed"))


@query("SELECT recno FROM (SELECT unnest(generate_series(1, (SELECT max(recno) FROM clean_records)))::BIGINT AS recno) WHERE recno NOT IN (SELECT recno FROM clean_records WHERE recno IS NOT NULL)")
def contiguity_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Numbers missing from 1 to the maximum."""
    return quality.missing_numbers(table(spark, d, "clean_records").where("recno is not null"), "recno")


@query(
    """WITH m AS (SELECT project_id, unnest(member_recnos)::BIGINT AS recno FROM projects), e AS (SELECT recno, count(DISTINCT project_id) AS g FROM m GROUP BY recno), u AS (SELECT DISTINCT recno::BIGINT AS recno FROM clean_records WHERE recno IS NOT NULL)
 SELECT count(*) AS keys, count(*) FILTER (g > 1) AS bad_shared, count(*) FILTER (u.recno IS NULL) AS bad_unknown, count(*) FILTER (g IS NULL) AS bad_missing FROM e FULL JOIN u ON e.recno = u.recno"""
)
def partition_check(spark: SparkSession, d: str) -> DataFrame:
    """G04, G05."""
    m = table(spark, d, "projects").select("project_id", F.explode(F.col("member_recnos").cast("array<bigint>")).alias("recno"))
    return quality.partition_figures(m, "recno", "project_id", table(spark, d, "clean_records").where("recno is not null").select(F.col("recno").cast("bigint").alias("recno")))


@query(
    """SELECT count(*) AS "rows", count(*) FILTER (NOT regexp_full_match(coalesce(iso_date, ''), '[0-9]{4}-[0-9]{2}-[0-9]{2}')) AS bad_date, count(*) FILTER (coalesce(section, '') = '') AS bad_section,
 count(*) FILTER (coalesce(land_count, 0) <= 0) AS bad_count, count(*) FILTER (coalesce(recno, 0) <= 0) AS bad_recno, greatest(count(recno) - count(DISTINCT recno) - 400, 0) AS bad_repeats FROM clean_records"""
)
def record_gate(spark: SparkSession, d: str) -> DataFrame:
    """Failing rows per test, and repeated numbers beyond the 400 that are allowed, in one pass."""
    return quality.figures(
        table(spark, d, "clean_records"),
        date=~F.coalesce("iso_date", F.lit("")).rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
        section=F.coalesce("section", F.lit("")) == "",
        count=F.coalesce("land_count", F.lit(0)) <= 0,
        recno=F.coalesce("recno", F.lit(0)) <= 0,
        _more=[F.greatest(F.count("recno") - F.count_distinct("recno") - 400, F.lit(0)).alias("bad_repeats")],
    )


@query(
    """WITH l AS (SELECT recno::VARCHAR AS k, 1 AS r, 0 AS c, 0 AS p FROM raw_records WHERE recno IS NOT NULL UNION ALL SELECT recno::VARCHAR, 0, 1, 0 FROM clean_records WHERE recno IS NOT NULL UNION ALL SELECT unnest(member_recnos)::VARCHAR, 0, 0, 1 FROM projects)
 SELECT pattern, count(*) AS n FROM (SELECT k, max(r)::VARCHAR || max(c)::VARCHAR || max(p)::VARCHAR AS pattern FROM l GROUP BY k) GROUP BY pattern"""
)
def layer_identity(spark: SparkSession, d: str) -> DataFrame:
    """In which of raw, clean and projects each record number is found."""
    return quality.presence(
        {"raw": table(spark, d, "raw_records"), "clean": table(spark, d, "clean_records"), "projects": table(spark, d, "projects").select(F.explode("member_recnos").alias("recno"))}, "recno"
    )


@query(
    f"""WITH {REL}, v AS (SELECT k, recno, release_row, CASE WHEN regexp_full_match(day, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_cast(day AS DATE) END AS dt FROM rel),
 s AS (SELECT k, dt, lag(dt) OVER (PARTITION BY k ORDER BY recno, release_row) AS p FROM v WHERE dt IS NOT NULL)
 SELECT k, count(*) AS dated, count(*) FILTER (dt > p) AS departures, coalesce(max(dt - p) FILTER (dt > p), 0)::BIGINT AS max_days, count(*) FILTER (dt > p) = 0 AND count(*) >= 2 AS descends FROM s GROUP BY k"""
)
def order_departures(spark: SparkSession, d: str) -> DataFrame:
    """Where a release's list is not in descending order of days."""
    r = releases(spark, d).withColumn("dt", dates.real_day(F.col("day")))
    return measures.departures(r, ["k"], "recno", "release_row", "dt").withColumn("max_days", F.col("max_days").cast("bigint"))


@query("SELECT release_id, lag(release_id) OVER (ORDER BY release_id) AS predecessor FROM (SELECT DISTINCT release_id FROM release_records)")
def predecessors(spark: SparkSession, d: str) -> DataFrame:
    """One row per release, so a single ordered window suffices."""
    return table(spark, d, "release_records").select("release_id").distinct().withColumn("predecessor", F.lag("release_id").over(Window.orderBy("release_id")))


@query("SELECT release_id, max(delivered_at) AS last_delivery, count(*) AS n FROM release_records GROUP BY release_id")
def archive_index(spark: SparkSession, d: str) -> DataFrame:
    """Latest entry and size per publication."""
    return table(spark, d, "release_records").groupBy("release_id").agg(F.max("delivered_at").alias("last_delivery"), F.count("*").alias("n"))


@query(
    f"""WITH {REL}, x AS (SELECT k, land, sha256(coalesce(string_agg(coalesce(day, '-') || ':' || name, '|' ORDER BY coalesce(day, '-') || ':' || name), '')) AS h FROM rel GROUP BY k, land)
 SELECT k, CASE WHEN p.h IS NULL THEN 'new' WHEN p.h = x.h THEN 'same' ELSE 'reuploaded' END AS kind, count(*) AS n FROM x LEFT JOIN (SELECT k + 1 AS k, land, h FROM x) p USING (k, land) GROUP BY ALL"""
)
def offer_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each land's content (days and names, with repeats) against the release before, by digest."""
    v = F.struct("day", "name")
    # A multiset's digest: count and two sums of hashes, so no land's rows are gathered.
    x = releases(spark, d).groupBy("k", "land").agg(F.count("*").alias("n"), *[F.sum(F.xxhash64(F.lit(i), v).cast("decimal(38,0)")).alias(f"h{i}") for i in (1, 2)])
    h = F.struct("n", "h1", "h2")
    p = x.select((F.col("k") + 1).alias("k"), "land", h.alias("ph"))
    kind = F.when(F.col("ph").isNull(), "new").when(F.col("ph") == h, "same").otherwise("reuploaded")
    return x.join(p, ["k", "land"], "left").groupBy("k", kind.alias("kind")).agg(F.count("*").alias("n"))


CELL = r"""cell AS (SELECT raw_id, trim(date) AS c FROM raw_records), ymd AS (SELECT raw_id, c, try_cast(nullif(regexp_extract(c, '^(\d{1,4})/(\d{1,2})/(\d{1,2})$', 1), '') AS INT) AS y,
 try_cast(nullif(regexp_extract(c, '^(\d{1,4})/(\d{1,2})/(\d{1,2})$', 2), '') AS INT) AS m, try_cast(nullif(regexp_extract(c, '^(\d{1,4})/(\d{1,2})/(\d{1,2})$', 3), '') AS INT) AS d FROM cell),
 iso AS (SELECT raw_id, y, CASE WHEN m BETWEEN 1 AND 12 AND d BETWEEN 1 AND 31 THEN printf('%04d-%02d-%02d', CASE WHEN y < 1911 THEN y + 1911 ELSE y END, m, d) END AS iso FROM ymd)"""


@query(f"WITH {CELL} SELECT raw_id, iso FROM iso WHERE iso IS NOT NULL")
def date_cell_iso(spark: SparkSession, d: str) -> DataFrame:
    """F01."""
    return table(spark, d, "raw_records").select("raw_id", dates.to_iso(F.col("date")).alias("iso")).where("iso is not null")


@query(f"WITH {CELL} SELECT gazette_id, count(*) FILTER (y < 1911) AS roc, count(*) FILTER (y >= 1911) AS gregorian FROM iso JOIN raw_records USING (raw_id) WHERE iso IS NOT NULL GROUP BY gazette_id")
def calendar_mix(spark: SparkSession, d: str) -> DataFrame:
    """F02."""
    r = table(spark, d, "raw_records").select("gazette_id", dates.calendar_of(F.col("date")).alias("cal")).where("cal is not null")
    return r.groupBy("gazette_id").agg(F.count_if(F.col("cal") == "roc").alias("roc"), F.count_if(F.col("cal") == "gregorian").alias("gregorian"))


@query(r"""WITH p AS (SELECT permit_id, translate(trim(date), '０１２３４５６７８９', '0123456789') AS c FROM permit_records), s AS (SELECT permit_id, try_cast(c[:-5] AS INT) + 1911 AS y, c[-4:-3] AS m, c[-2:] AS d FROM p WHERE regexp_full_match(c, '[0-9]{6,7}'))
 SELECT permit_id, printf('%04d-%s-%s', y, m, d) AS iso FROM s WHERE y - 1911 BETWEEN 50 AND 200 AND try_cast(printf('%04d-%s-%s', y, m, d) AS DATE) IS NOT NULL""")
def permit_compact_dates(spark: SparkSession, d: str) -> DataFrame:
    """F03."""
    return table(spark, d, "permit_records").select("permit_id", dates.roc_compact(F.col("date")).alias("iso")).where("iso is not null")


@query(f"WITH {AP}, x AS (SELECT recno, try_cast(day AS DATE) AS dt FROM ap WHERE day IS NOT NULL) SELECT recno, strftime(dt + INTERVAL 10 DAY, '%Y-%m-%d') AS later, strftime(dt - INTERVAL 10 DAY, '%Y-%m-%d') AS earlier FROM x WHERE dt IS NOT NULL")
def shifted_days(spark: SparkSession, d: str) -> DataFrame:
    """F04a."""
    a = approvals(spark, d, "recno", "day").select("recno", dates.shift(F.col("day"), 10).alias("later"), dates.shift(F.col("day"), -10).alias("earlier"))
    return a.where("later is not null")


@query(
    f"WITH {AP}, x AS (SELECT recno, translate({squeeze_sql(fold_sql('name'))}, '劃ㄧ', '畫一') AS n FROM ap) SELECT recno, CASE WHEN regexp_matches(n, '^變更\\(第[一二三四五六七八九]次\\)') THEN strpos('一二三四五六七八九', substr(n, 5, 1)) WHEN starts_with(n, '變更') THEN 1 WHEN starts_with(n, '擬訂') THEN 0 ELSE -1 END::INTEGER AS stage, concat_ws('、', CASE WHEN contains(n, '事業概要') THEN '事業概要' END, CASE WHEN contains(n, '事業計畫') THEN '事業計畫' END, CASE WHEN contains(n, '權利變換') THEN '權利變換' END) AS tracks FROM x"
)
def stages_and_tracks(spark: SparkSession, d: str) -> DataFrame:
    """F05, F10, F11 on names in half width."""
    n = land.normalize_name(fold_width(F.col("name")))
    return approvals(spark, d, "recno", "name").select("recno", land.stage_index(n).cast("int").alias("stage"), land.tracks(n).alias("tracks"))


@query(f"WITH {cells_sql('c', 'SELECT raw_id, name, land FROM raw_records WHERE land IS NOT NULL')} SELECT raw_id, len(tokens) AS tokens, regexp_matches(trim(even), '(?:地號|土地|筆)$') AS closed, try_cast(nullif(regexp_extract(name, '等\\s*([0-9]+)\\s*筆', 1), '') AS INT) AS declared FROM c")
def land_cell_counts(spark: SparkSession, d: str) -> DataFrame:
    """Parcels a cell shows, whether it closes, and the count its name declares."""
    r = table(spark, d, "raw_records").where("land is not null").withColumn("_cell", land.even_cell(F.col("land")))
    return r.select("raw_id", F.size(land.parcel_tokens(F.col("_cell"))).cast("bigint").alias("tokens"), land.has_closing(F.col("_cell")).alias("closed"), land.declared_count(F.col("name")).alias("declared"))


@query(f"WITH {AP}, s AS (SELECT recno, unnest(parcels) AS p FROM ap), o AS (SELECT recno, string_agg(p, ',' ORDER BY regexp_extract(p, '^[0-9]+')::BIGINT, coalesce(try_cast(nullif(regexp_extract(p, '-([0-9]+)$', 1), '') AS BIGINT), -1), p) AS ordered, string_agg(lpad(regexp_extract(p, '^([0-9]+)', 1), 4, '0') || lpad(regexp_extract(p, '-([0-9]+)$', 1), 4, '0'), ',' ORDER BY p) AS keys FROM s GROUP BY recno) SELECT recno, ordered, keys FROM o")
def parcel_order(spark: SparkSession, d: str) -> DataFrame:
    """Parcels in the order of number and sub-number, and their eight-digit keys."""
    a = approvals(spark, d, "recno", "parcels").where(F.size("parcels") > 0)
    return a.select("recno", F.array_join(land.sorted_parcels(F.col("parcels")), ",").alias("ordered"), F.array_join(F.transform("parcels", land.padded_parcel), ",").alias("keys"))


@query(f"WITH {AP} SELECT recno, CASE WHEN regexp_matches(name, '(^|[^0-9.\\-])' || first || '($|[^0-9\\-])') THEN 'exact' WHEN regexp_matches(name, '(^|[^0-9.\\-])' || string_split(first, '-')[1] || '($|[^0-9\\-])') THEN 'stem' ELSE 'none' END AS rule FROM ap WHERE first <> ''")
def parcel_rule(spark: SparkSession, d: str) -> DataFrame:
    """How a name carries its record's first parcel."""
    return approvals(spark, d, "recno", "name", "first").where("first != ''").select("recno", land.carries_parcel(F.col("name"), F.col("first")).alias("rule"))


@query(r"SELECT project_id, regexp_replace(project_id, '[^\p{L}\p{N}_\-]', '_', 'g') AS safe, regexp_replace(project_id, '-', '', 'g') AS core FROM projects")
def project_id_forms(spark: SparkSession, d: str) -> DataFrame:
    """F35."""
    return table(spark, d, "projects").select("project_id", land.safe_id(F.col("project_id")).alias("safe"), F.regexp_replace("project_id", "-", "").alias("core"))


@query(
    f"WITH {AP}, e AS (SELECT district, section, day, recno, stage_index FROM ap WHERE day IS NOT NULL), s AS (SELECT *, CASE WHEN lag(stage_index) OVER w = stage_index THEN 0 ELSE 1 END AS st FROM e WINDOW w AS (PARTITION BY district, section ORDER BY day, recno)), i AS (SELECT *, sum(st) OVER (PARTITION BY district, section ORDER BY day, recno) AS island FROM s) SELECT district, section, island::BIGINT AS island, stage_index, count(*) AS n FROM i GROUP BY ALL"
)
def stage_islands(spark: SparkSession, d: str) -> DataFrame:
    """Runs of one stage in a section's order of days."""
    a = approvals(spark, d, "recno", "district", "section", "day", "stage_index").where("day is not null")
    return measures.islands(a, ["district", "section"], ["day", "recno"], "stage_index")


@query(
    f"WITH {AP} SELECT recno, coalesce(last_value(CASE WHEN stage_index = 0 THEN recno END IGNORE NULLS) OVER (PARTITION BY district, section ORDER BY day, recno ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), first_value(CASE WHEN stage_index = 0 THEN recno END IGNORE NULLS) OVER (PARTITION BY district, section ORDER BY day, recno ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS nearest FROM ap WHERE day IS NOT NULL"
)
def branch_points(spark: SparkSession, d: str) -> DataFrame:
    """The nearest first-stage approval above each row of a section's timeline, else below."""
    a = approvals(spark, d, "recno", "district", "section", "day", "stage_index").where("day is not null")
    return measures.nearest_marked(a, ["district", "section"], ["day", "recno"], F.col("stage_index") == 0, "recno").select("recno", "nearest")


@query(
    f"WITH {AP}, x AS (SELECT section, day, recno, implementer, lag(implementer) OVER w AS p, row_number() OVER w AS r FROM ap WHERE day IS NOT NULL WINDOW w AS (PARTITION BY district, section, first ORDER BY day, recno)) SELECT recno, implementer FROM x WHERE r = 1 OR p IS DISTINCT FROM implementer"
)
def implementer_changes(spark: SparkSession, d: str) -> DataFrame:
    """Records whose implementer differs from the unit's record before."""
    a = approvals(spark, d, "recno", "district", "section", "first", "day", "implementer").where("day is not null")
    return measures.changes_by_key(a, ["district", "section", "first"], ["day", "recno"], "implementer").select("recno", "implementer")


@query(
    """WITH u AS (SELECT DISTINCT permit_id, x.section AS section, try_cast(x.mono AS BIGINT) AS n FROM permit_records, unnest(parcels) t(x) WHERE x.section IS NOT NULL AND try_cast(x.mono AS BIGINT) IS NOT NULL),
 g AS (SELECT *, lead(n) OVER (PARTITION BY permit_id, section ORDER BY n) AS m FROM u) SELECT permit_id, section, n + 1 AS from_n, m - 1 AS to_n FROM g WHERE m - n > 1"""
)
def parcel_gaps(spark: SparkSession, d: str) -> DataFrame:
    """J11a on permits: the numbers inside a permit's span that it doesn't hold, as ranges, however wide the span is."""
    u = table(spark, d, "permit_records").select("permit_id", F.explode("parcels").alias("x")).select("permit_id", F.col("x.section").alias("section"), F.col("x.mono").try_cast("bigint").alias("n")).where("section is not null and n is not null")
    return match.gap_ranges(u, ["permit_id", "section"], "n").withColumnsRenamed({"first": "from_n", "last": "to_n"})


@query(
    """WITH c AS (SELECT DISTINCT unnest(case_ids) AS id FROM search_results), s AS (SELECT DISTINCT substr(id, 1, length(id) - 1) AS stem, substr(id, length(id)) AS digit FROM c WHERE regexp_full_match(id, '[0-9]+')),
 g AS (SELECT stem, digit::INT AS d, lead(digit::INT) OVER (PARTITION BY stem ORDER BY digit::INT) AS m FROM s) SELECT stem || n AS case_id FROM g, unnest(generate_series(d + 1, m - 1)) t(n) WHERE m - d > 1"""
)
def sibling_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids between the lowest and highest held digit of a stem that no search holds; at most eight a stem."""
    c = table(spark, d, "search_results").select(F.explode("case_ids").alias("id")).where("id rlike '^[0-9]+$'")
    held = c.select(F.expr("substr(id, 1, length(id) - 1)").alias("stem"), F.expr("cast(substr(id, -1) as int)").alias("digit"))
    return match.gap_ids(held, "stem", "digit").select(F.concat("stem", F.col("digit").cast("string")).alias("case_id"))


@query(
    """WITH c AS (SELECT DISTINCT unnest(case_ids) AS id FROM search_results), s AS (SELECT DISTINCT substr(id, 1, length(id) - 1) AS stem FROM c WHERE regexp_full_match(id, '[0-9]+')) SELECT stem || n AS case_id FROM s, unnest(generate_series(0, 9)) t(n) WHERE stem || n NOT IN (SELECT id FROM c WHERE id IS NOT NULL)"""
)
def probe_ids(spark: SparkSession, d: str) -> DataFrame:
    """The ids of a stem, last digit 0 to 9, that are still unknown."""
    c = table(spark, d, "search_results").select(F.explode("case_ids").alias("case_id")).where("case_id rlike '^[0-9]+$'").distinct()
    stems = c.select(F.expr("substr(case_id, 1, length(case_id) - 1)").alias("stem")).distinct()
    want = stems.select("stem", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("n")).select(F.concat("stem", F.col("n").cast("string")).alias("case_id"))
    return want.join(c, "case_id", "left_anti")
