"""Cells to rows, cases attached to approvals, verdicts and gates over the register."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, land
from ..functions.similarity import gestalt_ratio
from ..functions.text import fold_width, no_space
from ..operators import cases as ops
from ..operators import matching as match
from ..operators import quality
from ..runtime import table
from ..sources.cells import document_meta, rows_of_cells
from . import dashboard_queries, family_queries, matching_queries, publication_queries, timeline_queries  # noqa: F401
from .registry import AP, CASES, SQL, UNITS, anywhere, approvals, cases, days_sql, fold_sql, kinds_sql, query, releases, section_key_sql, squeeze_sql, strip0_sql, units

# ---- cells to rows

CELLS = r"""cell AS (SELECT gazette_id, (line_no - 1) // 50 AS page, line_no AS row, i - 1 AS col, parts[i] AS text FROM (SELECT gazette_id, line_no, string_split(line, chr(9)) AS parts FROM raw_lines WHERE line IS NOT NULL), unnest(generate_series(1, len(parts))) t(i)),
 wide AS (SELECT gazette_id, page, row, """ + ", ".join(f"coalesce(max(CASE WHEN col = {i} THEN trim(regexp_replace(coalesce(text, ''), '[\\r\\n]+', '', 'g')) END), '') AS {n}" for i, n in enumerate(["recno", "date", "district", "name", "land", "implementer", "planner"])) + r""" FROM cell GROUP BY ALL),
 num AS (SELECT * EXCLUDE (recno), recno::INT AS recno, regexp_extract(date, '^(\d{1,4})/(\d{1,2})/(\d{1,2})$', ['y', 'm', 'd']) AS p FROM wide WHERE regexp_full_match(recno, '[0-9]{1,4}')),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY gazette_id, recno ORDER BY page, row) AS k, count(*) OVER (PARTITION BY gazette_id, recno) - 1 AS repeats FROM num),
 rw AS (SELECT *, concat_ws('；', CASE WHEN NOT (coalesce(try_cast(p.m AS INT), 0) BETWEEN 1 AND 12 AND coalesce(try_cast(p.d AS INT), 0) BETWEEN 1 AND 31) THEN 'date' END, CASE WHEN district = '' THEN 'district' END, CASE WHEN name = '' THEN 'name' END, CASE WHEN land = '' THEN 'land' END) AS parse_error FROM ranked WHERE k = 1)"""


def _cells(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "raw_lines").where("line is not null")
    page = F.floor((F.col("line_no") - 1) / 50).alias("page")
    return lines.select("gazette_id", page, F.col("line_no").alias("row"), F.posexplode(F.split("line", "\t")).alias("col", "text"))


@query(f"WITH {CELLS} SELECT gazette_id, recno, page, row, date, district, name, land, implementer, planner, repeats, parse_error FROM rw")
def cell_rows(spark: SparkSession, d: str) -> DataFrame:
    """S01, S01a, S01e, P03, G01: cells of a table to rows, the first of each number, with what is wrong with it. A line is a row of cells here."""
    return rows_of_cells(_cells(spark, d))


@query(f"WITH {CELLS} SELECT gazette_id, count(*) AS records, sum(repeats)::BIGINT AS repeats, count(DISTINCT page) AS pages, count(*) FILTER (parse_error <> '') AS faulty, array_to_string(list_sort(list_distinct(list(CASE WHEN contains(parse_error, 'date') THEN NULL WHEN p.y::INT < 1911 THEN 'roc' ELSE 'gregorian' END))), '|') AS calendars FROM rw GROUP BY gazette_id")
def extraction_meta(spark: SparkSession, d: str) -> DataFrame:
    """One row of figures a document."""
    return document_meta(rows_of_cells(_cells(spark, d)))


@query(r"SELECT doc_id, printf('%04d-%02d-%02d', CASE WHEN p.y::INT < 1911 THEN p.y::INT + 1911 ELSE p.y::INT END, p.m::INT, p.d::INT) AS day FROM (SELECT doc_id, regexp_extract(text, '([0-9]{2,4})年([0-9]{1,2})月([0-9]{1,2})日', ['y', 'm', 'd']) AS p FROM documents) WHERE coalesce(p.y, '') <> '' AND p.m::INT BETWEEN 1 AND 12 AND p.d::INT BETWEEN 1 AND 31")
def stated_days(spark: SparkSession, d: str) -> DataFrame:
    """S01d: the first day that a text states in words, as ISO text; what a publication says of its own date."""
    t = table(spark, d, "documents").select("doc_id", F.regexp_replace(F.regexp_extract("text", "([0-9]{2,4}年[0-9]{1,2}月[0-9]{1,2})日", 1), "[年月]", "/").alias("t"))
    return t.select("doc_id", dates.to_iso(F.col("t")).alias("day")).where("day is not null")


@query("WITH n AS (SELECT release_id, count(*) AS n FROM release_records GROUP BY 1) SELECT release_id, n, lag(n) OVER (ORDER BY release_id) AS before, coalesce(n < 0.8 * lag(n) OVER (ORDER BY release_id), FALSE) AS shrank FROM n")
def shrink_check(spark: SparkSession, d: str) -> DataFrame:
    """Publications that shrank by more than a fifth against the one before. One row a publication is ordered."""
    n = table(spark, d, "release_records").groupBy("release_id").agg(F.count("*").alias("n")).withColumn("before", F.lag("n").over(Window.orderBy("release_id")))
    return n.withColumn("shrank", F.coalesce(F.col("n") < 0.8 * F.col("before"), F.lit(False)))


@query("""SELECT seq, concat_ws('|', CASE WHEN coalesce(why, '') = '' THEN 'why' END, CASE WHEN coalesce(made_by, '') = '' THEN 'made_by' END, CASE WHEN made_at IS NULL THEN 'made_at' END, CASE WHEN coalesce(gazette_id, '') = '' THEN 'gazette_id' END) AS missing FROM corrections""")
def evidence_gaps(spark: SparkSession, d: str) -> DataFrame:
    """The evidence that each human entry lacks; only entries without a gap count."""
    need = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in ("why", "made_by", "made_at", "gazette_id")}
    return table(spark, d, "corrections").select("seq", F.concat_ws("|", *[F.when(bad, F.lit(c)) for c, bad in need.items()]).alias("missing"))


# ---- states

@query("WITH a AS (SELECT user_id, event_id, event_type FROM events WHERE event_type IS DISTINCT FROM 'error'), o AS (SELECT DISTINCT user_id FROM a WHERE event_type IS DISTINCT FROM 'view') SELECT user_id, count(*) AS live FROM a WHERE event_type IS DISTINCT FROM 'view' OR user_id NOT IN (SELECT user_id FROM o) GROUP BY user_id")
def live_cases(spark: SparkSession, d: str) -> DataFrame:
    """What is live of each group: no dead states, and rows without a state only where there is nothing else."""
    return ops.live(table(spark, d, "events").select("user_id", "event_type"), "user_id", "event_type", ["error"], "view").groupBy("user_id").agg(F.count("*").alias("live"))


@query("SELECT user_id, ts::DATE AS day FROM events GROUP BY ALL HAVING bool_or(event_type = 'signup') AND NOT bool_or(event_type = 'purchase')")
def awaiting_answer(spark: SparkSession, d: str) -> DataFrame:
    """Groups with an application and no approval."""
    return ops.awaiting(table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), "event_type"), ["user_id", "day"], "event_type", ["signup"], ["purchase"])


@query("SELECT CASE WHEN contains(error, 'timeout') THEN 'timeout' WHEN contains(error, 'changed') THEN 'layout' WHEN contains(error, 'no rows') THEN 'blank' ELSE status END AS class, count(*) AS n FROM search_results GROUP BY 1")
def failure_classes(spark: SparkSession, d: str) -> DataFrame:
    """Searches by the first cause that applies, in order of precedence."""
    c = ops.first_class(F.col("error"), [("timeout", "timeout"), ("changed", "layout"), ("no rows", "blank")], F.col("status"))
    return table(spark, d, "search_results").groupBy(c.alias("class")).agg(F.count("*").alias("n"))


@query(f"WITH s AS (SELECT {squeeze_sql(fold_sql('land_core'))} AS land, concat_ws('|', status, case_name, chk_date) AS state, (searched_at, search_id) AS seen FROM search_results) SELECT land, count(*) AS checks, arg_min(state, seen) <> arg_max(state, seen) AS moved FROM s GROUP BY land")
def moved_pages(spark: SparkSession, d: str) -> DataFrame:
    """Whether what a land's page says differs between its first and last check."""
    at = F.struct("searched_at", "search_id")
    s = table(spark, d, "search_results").select(no_space(fold_width(F.col("land_core"))).alias("land"), F.concat_ws("|", "status", "case_name", "chk_date").alias("state"), at.alias("at"))
    return s.groupBy("land").agg(F.count("*").alias("checks"), (F.min_by("state", "at") != F.max_by("state", "at")).alias("moved"))


@query("""WITH e AS (SELECT user_id, event_type, event_id, ts, round(value, 0) AS v FROM events WHERE value IS NOT NULL), f AS (SELECT user_id, event_type, count(DISTINCT v) AS n, arg_min(event_id, (ts, event_id)) AS first FROM e GROUP BY ALL)
 SELECT user_id, event_type, v, CASE WHEN n = 1 THEN first ELSE m.event_id END AS event_id FROM (""" + SQL["milestone_fold"] + """) m JOIN f USING (user_id, event_type)""")
def agreed_credit(spark: SparkSession, d: str) -> DataFrame:
    """A label all writers agree on is credited to the first of them, others as the fold says."""
    from .dashboard_queries import milestone_fold

    e = table(spark, d, "events").where("value is not null").select("user_id", "event_type", "event_id", F.round("value", 0).alias("v"), "ts")
    f = e.groupBy("user_id", "event_type").agg((F.min("v") == F.max("v")).alias("one"), F.min_by("event_id", F.struct("ts", "event_id")).alias("first"))
    j = milestone_fold(spark, d).join(f, ["user_id", "event_type"])
    return j.select("user_id", "event_type", "v", F.when(F.col("one"), F.col("first")).otherwise(F.col("event_id")).alias("event_id"))


COPIED = ["iso_date", "district", "section", "first_parcel", "land_count", "named_anchor", "implementer", "planner"]


@query("SELECT recno, count(*) AS copies, concat_ws('|', " + ", ".join(f"CASE WHEN min(nullif({c}::VARCHAR, '')) <> max(nullif({c}::VARCHAR, '')) THEN '{c}' END" for c in COPIED) + ") AS conflicts FROM clean_records WHERE recno IS NOT NULL GROUP BY recno")
def copy_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """A10: the fields in which copies of a record disagree."""
    return ops.conflicts(table(spark, d, "clean_records").where("recno is not null").select("recno", *COPIED), "recno", COPIED)


# ---- recovery and verdicts

@query(rf"""WITH r AS (SELECT raw_id, {squeeze_sql(fold_sql("land"))} AS land, try_cast(nullif(regexp_extract({fold_sql("name")}, '等\s*([0-9]+)\s*筆', 1), '') AS INT) AS declared FROM raw_records WHERE land IS NOT NULL),
 t AS (SELECT *, regexp_matches(land, '(?:[、,，\-(]|等[0-9]*)$') AS tail, regexp_matches(land, '(?:地號|土地|筆)$') AS closed, len(list_distinct(list_transform(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(land, '\([^()]*\)', '', 'g'), '^.*段', ''), '(?:地號|等[0-9]+筆|土地|\s)+$', ''), '[0-9]+(?:-[0-9]+)?'), lambda x: regexp_replace(x, '^0+([0-9])', '\1')))) AS n FROM r)
 SELECT raw_id, CASE WHEN declared IS NOT NULL AND n = declared THEN 'complete' WHEN tail THEN 'tail' WHEN NOT closed AND declared IS NOT NULL AND n < declared THEN 'declared_count' ELSE 'complete' END AS cause FROM t""")
def cut_causes(spark: SparkSession, d: str) -> DataFrame:
    """Whether a land cell is cut and what shows it: its end, or fewer parcels than its name declares; never if all declared are there."""
    r = table(spark, d, "raw_records").where("land is not null").select("raw_id", no_space(fold_width(F.col("land"))).alias("land"), land.declared_count(fold_width(F.col("name"))).alias("declared"))
    n = F.size(land.parcel_tokens(F.col("land")))
    short = ~land.has_closing(F.col("land")) & F.col("declared").isNotNull() & (n < F.col("declared"))
    cause = F.when(n == F.col("declared"), "complete").when(F.col("land").rlike(r"(?:[、,，\-(]|等[0-9]*)$"), "tail").when(F.coalesce(short, F.lit(False)), "declared_count").otherwise("complete")
    return r.select("raw_id", cause.alias("cause"))


@query()
def row_recovery(spark: SparkSession, d: str) -> DataFrame:
    """The cases of each cut row that pass four checks: unit, declared count, name (contained, or alike to .7), and day (exact, else a day beside it if no case is exact).

    Several cases of one row are kept and marked. The ratio has no SQL.
    """
    name = land.normalize_name(fold_width(F.col("name")))
    r = table(spark, d, "raw_records").join(table(spark, d, "feeds").select("feed_id", "zone"), "feed_id", "left")
    r = r.select("raw_id", name.alias("name"), no_space(fold_width(F.col("land"))).alias("land"), dates.real_day(dates.clock_day(F.col("date"), F.col("zone"))).alias("day")).where("day is not null and name is not null")
    r = r.where(~F.coalesce(land.has_closing(F.col("land")), F.lit(False))).withColumn("p", land.place(F.regexp_replace("name", land.STAGE_HEAD, "")))
    r = r.select("raw_id", "name", "day", F.col("p.dist").alias("dist"), F.col("p.sec").alias("h_sec"), F.col("p.cnt").alias("cnt"), F.concat(F.col("p.first"), F.lit("地號")).alias("core")).where("h_sec != '' and cnt is not null")
    c = cases(spark, d).where("dt is not null and cnt is not null and h_sec != ''").select("search_id", "nm", "h_dist", "h_sec", "cnt", "dt")
    j = anywhere(r, "dist", "h_dist").drop("dist").join(c, ["h_dist", "h_sec", "cnt"]).where(F.abs(F.datediff("dt", "day")) <= 1)
    j = j.withColumn("held", F.contains("nm", "core")).withColumn("ratio", F.when(~F.col("held"), gestalt_ratio("name", "nm"))).where("held or ratio >= 0.7")
    j = j.select("raw_id", "search_id", F.when(F.col("dt") == F.col("day"), 0).otherwise(1).alias("off"), (~F.col("held")).alias("alike_only")).distinct()
    best = j.groupBy("raw_id").agg(F.min("off").alias("off"))
    k = j.join(best, ["raw_id", "off"])
    several = k.groupBy("raw_id").agg((F.count("*") > 1).alias("several"))
    return k.join(several, "raw_id").select("raw_id", "search_id", F.when(F.col("off") == 0, "exact").otherwise("beside").alias("day"), "alike_only", "several")


@query(f"""WITH {AP}, {CASES}, b AS ({SQL["bound_cases"]}), c AS (SELECT case_id, min(day) AS day FROM cs WHERE day IS NOT NULL AND case_id IS NOT NULL GROUP BY case_id HAVING count(DISTINCT day) = 1),
 {days_sql("cp_day", "SELECT clean_id AS key, iso_date AS v, zone FROM clean_records LEFT JOIN feeds USING (feed_id)")}, w AS (SELECT x.recno, list_distinct(list(cp_day.day)) AS days FROM clean_records x JOIN first_print f ON f.recno = x.recno AND f.rn = 1 AND f.clean_id <> x.clean_id JOIN cp_day ON key = x.clean_id WHERE cp_day.day IS NOT NULL GROUP BY 1)
 SELECT b.recno, b.case_id, CASE WHEN w.days IS NULL THEN 'none' WHEN list_contains(w.days, ap.day) AND list_contains(w.days, c.day) THEN 'both' WHEN list_contains(w.days, ap.day) THEN 'one' WHEN list_contains(w.days, c.day) THEN 'two' ELSE 'neither' END AS confirmed
 FROM b JOIN ap ON ap.recno = b.recno JOIN c USING (case_id) LEFT JOIN w ON w.recno = b.recno WHERE ap.day <> c.day""")
def date_disagreements(spark: SparkSession, d: str) -> DataFrame:
    """Approvals whose day differs from their case's, and which of the two the record's other copies confirm; nothing is repaired."""
    day = match.unique_or_nothing(cases(spark, d).where("case_id is not null"), ["case_id"], "day").withColumnRenamed("day", "case_day")
    copies = table(spark, d, "clean_records").where("recno is not null").join(table(spark, d, "feeds").select("feed_id", "zone"), "feed_id", "left")
    copies = copies.select(F.col("recno").cast("bigint").alias("recno"), "clean_id", dates.clock_day(F.col("iso_date"), F.col("zone")).alias("day"))
    first = copies.groupBy("recno").agg(F.min("clean_id").alias("clean_id"))
    others = copies.join(first, ["recno", "clean_id"], "left_anti").where("day is not null").groupBy("recno").agg(F.collect_set("day").alias("days"))  # as many as a record has days
    j = matching_queries.bound_cases(spark, d).join(approvals(spark, d, "recno", "day"), "recno").join(day, "case_id").join(others, "recno", "left")
    which = ops.disagreement(F.col("day"), F.col("case_day"), F.coalesce("days", F.array().cast("array<string>")))
    return j.select("recno", "case_id", which.alias("confirmed")).where("confirmed is not null")


@query(f"""WITH {AP}, {UNITS}, {CASES}, l AS (SELECT DISTINCT unnest(member_recnos)::BIGINT AS recno FROM projects p JOIN (SELECT DISTINCT lc FROM cs WHERE coalesce(view_id, '') <> '') v ON v.lc = {squeeze_sql(fold_sql("p.land_core"))}),
 t AS (SELECT DISTINCT nm FROM cs WHERE nm IS NOT NULL), h AS (SELECT DISTINCT h_dist, h_sec, h_first FROM cs WHERE h_sec <> '' AND h_first <> '' AND h_dist <> '')
 SELECT un.recno, CASE WHEN l.recno IS NOT NULL THEN 'listed' WHEN t.nm IS NOT NULL THEN 'title' WHEN un.stage_index = 0 AND h.h_sec IS NOT NULL THEN 'land' ELSE 'none' END AS badge FROM un LEFT JOIN l USING (recno) LEFT JOIN t ON t.nm = translate({squeeze_sql(fold_sql("un.name"))}, '劃ㄧ', '畫一') LEFT JOIN h ON h.h_dist = un.district AND h.h_sec = un.sec AND h.h_first = un.first""")
def case_badges(spark: SparkSession, d: str) -> DataFrame:
    """By what an approval is known to the searches: its project's land has a page, its very title, or for first plans its land."""
    c = cases(spark, d)
    core = table(spark, d, "projects").select(no_space(fold_width(F.col("land_core"))).alias("lc"), "member_recnos")
    listed = core.join(c.where("coalesce(view_id, '') != ''").select("lc").distinct(), "lc", "left_semi").select(F.explode(F.col("member_recnos").cast("array<bigint>")).alias("recno")).distinct().withColumn("listed", F.lit(True))
    title = c.where("nm is not null").select("nm").distinct().withColumn("title", F.lit(True))
    at = c.where("h_sec != '' and h_first != '' and h_dist != ''").select(F.col("h_dist").alias("district"), F.col("h_sec").alias("sec"), F.col("h_first").alias("first")).distinct().withColumn("at", F.lit(True))
    a = units(spark, d, "recno", "district", "section", "first", "stage_index", "name").withColumn("nm", land.normalize_name(fold_width(F.col("name"))))
    j = a.join(listed, "recno", "left").join(title, "nm", "left").join(at, ["district", "sec", "first"], "left")
    return j.select("recno", F.when(F.col("listed"), "listed").when(F.col("title"), "title").when((F.col("stage_index") == 0) & F.col("at"), "land").otherwise("none").alias("badge"))


@query(f"""WITH {AP}, {UNITS}, {CASES}, u AS (SELECT DISTINCT dist, sec, first FROM un2 WHERE sec <> '' AND first <> ''), v AS (SELECT cs.*, h_sec = cs.sec AND h_first = cs.first AS label, u.sec IS NOT NULL AS city FROM cs LEFT JOIN u ON u.dist = cs.h_dist AND u.sec = cs.h_sec AND u.first = cs.h_first WHERE nm IS NOT NULL)
 SELECT search_id, label OR city AS accept, CASE WHEN label AND city THEN 'label and city' WHEN label THEN 'label' WHEN city THEN 'city' ELSE 'neither' END AS reason FROM v""")
def membership_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Whether a case found for a land belongs to it, and by which evidence: its heading names the searched land, or a land that has approvals."""
    u = anywhere(units(spark, d, "district", "section", "first").where("sec != '' and first != ''")).select(F.col("dist").alias("h_dist"), F.col("sec").alias("h_sec"), F.col("first").alias("h_first")).distinct().withColumn("city", F.lit(True))
    v = cases(spark, d).where("nm is not null").join(u, ["h_dist", "h_sec", "h_first"], "left")
    label, city = (F.col("h_sec") == F.col("sec")) & (F.col("h_first") == F.col("first")), F.col("city").isNotNull()
    reason = F.when(label & city, "label and city").when(label, "label").when(city, "city").otherwise("neither")
    return v.select("search_id", ops.verdict(label | city, reason).alias("v")).select("search_id", "v.*")


@query(f"""WITH {CASES}, p AS (SELECT project_id, coalesce(q.dist, '') AS dist, {section_key_sql("q.sec")} AS sec, {strip0_sql("q.first")} AS first, try_cast(nullif(q.cnt, '') AS BIGINT) AS cnt FROM (SELECT project_id, regexp_extract({squeeze_sql(fold_sql("land_core"))}, '{land.PLACE}', ['dist', 'sec', 'first', 'cnt']) AS q FROM projects))
 SELECT search_id, min(project_id) AS project_id FROM cs JOIN p ON p.sec = cs.h_sec AND p.first = cs.h_first AND p.cnt = cs.cnt AND (cs.h_dist = '' OR cs.h_dist = p.dist) WHERE cs.h_sec <> '' AND cs.h_first <> '' GROUP BY search_id HAVING count(DISTINCT project_id) = 1""")
def view_matches(spark: SparkSession, d: str) -> DataFrame:
    """The only project whose section, parcel and count a heading names."""
    p = table(spark, d, "projects").select("project_id", land.place(no_space(fold_width(F.col("land_core")))).alias("p")).select("project_id", F.coalesce("p.dist", F.lit("")).alias("dist"), F.col("p.sec").alias("h_sec"), F.col("p.first").alias("h_first"), F.col("p.cnt").alias("cnt"))
    j = cases(spark, d).where("h_sec != '' and h_first != ''").select("search_id", "h_dist", "h_sec", "h_first", "cnt").join(anywhere(p, "dist", "h_dist"), ["h_dist", "h_sec", "h_first", "cnt"])
    return match.unique_or_nothing(j, ["search_id"], "project_id")


# ---- attaching

@query(f"""WITH a AS ({SQL["name_tier_cascade"]}), b AS ({SQL["drift_range_join"]}), c AS ({SQL["date_match_tiered"]}), s AS (SELECT search_id, min(recno) AS lo, max(recno) AS hi, 1 AS i, 'name' AS source FROM a GROUP BY 1 UNION ALL SELECT search_id, min(recno), max(recno), 2, 'land and day' FROM b GROUP BY 1 UNION ALL SELECT search_id, min(recno), max(recno), 3, 'day' FROM c WHERE tier = 1 GROUP BY 1),
 f AS (SELECT * FROM s WHERE i = (SELECT min(i) FROM s x WHERE x.search_id = s.search_id)) SELECT search_id, CASE WHEN lo = hi THEN lo END AS recno, CASE WHEN lo = hi THEN source ELSE 'ambiguous' END AS source FROM f""")
def attached_cases(spark: SparkSession, d: str) -> DataFrame:
    """The approval of each resolved search by the first step that has any: name tiers, land and day, day alone; several make it ambiguous, not the next step's."""
    by_day = matching_queries.date_match_tiered(spark, d).where("tier = 1")
    steps = (("name", matching_queries.name_tier_cascade(spark, d)), ("land and day", matching_queries.drift_range_join(spark, d)), ("day", by_day))
    return ops.precedence(*steps, key="search_id", value="recno")


@query(f"""WITH {CASES}, a AS ({SQL["attached_cases"]}), o AS ({SQL["core_offers"]}), held AS (SELECT DISTINCT case_id FROM cs JOIN a USING (search_id) WHERE a.recno IS NOT NULL AND case_id IS NOT NULL), ev AS (SELECT DISTINCT case_id, nm, day FROM cs WHERE case_id IS NOT NULL AND nm IS NOT NULL AND day IS NOT NULL),
 orphan AS (SELECT DISTINCT case_id FROM cs WHERE case_id IS NOT NULL AND case_id NOT IN (SELECT case_id FROM held)), offered AS (SELECT DISTINCT case_id FROM cs JOIN o USING (search_id) WHERE o.score >= 0.7),
 sh AS (SELECT case_id, count(DISTINCT (nm, day)) AS n FROM ev JOIN orphan USING (case_id) WHERE EXISTS (SELECT 1 FROM ev x JOIN held USING (case_id) WHERE x.nm = ev.nm AND x.day = ev.day) GROUP BY case_id)
 SELECT orphan.case_id, CASE WHEN offered.case_id IS NOT NULL THEN 'land' WHEN sh.n >= 3 THEN 'shared' ELSE 'flagged' END AS gate FROM orphan LEFT JOIN offered USING (case_id) LEFT JOIN sh USING (case_id)""")
def orphan_gate(spark: SparkSession, d: str) -> DataFrame:
    """Cases that no approval holds, by the first test they pass: a project has their land, three of their events are those of held cases; else flagged."""
    c = cases(spark, d).where("case_id is not null").select("search_id", "case_id", "nm", "day")
    held = c.join(attached_cases(spark, d).where("recno is not null"), "search_id").select("case_id").distinct()
    orphan = c.select("case_id").distinct().join(held, "case_id", "left_anti")
    offered = c.join(timeline_queries.core_offers(spark, d).where("score >= 0.7"), "search_id").select("case_id").distinct().withColumn("land", F.lit(True))
    ev = c.where("nm is not null and day is not null").select("case_id", "nm", "day").distinct()
    known = ev.join(held, "case_id").select("nm", "day").distinct()
    shared = ev.join(orphan, "case_id").join(known, ["nm", "day"]).groupBy("case_id").agg(F.count("*").alias("n"))
    j = orphan.join(offered, "case_id", "left").join(shared, "case_id", "left")
    return j.select("case_id", F.when(F.col("land"), "land").when(F.col("n") >= 3, "shared").otherwise("flagged").alias("gate"))


@query(f"""WITH {AP}, t AS (SELECT recno, district, section, parcels, unnest(parcels) AS p FROM ap WHERE section <> '' AND len(parcels) > 0), n AS (SELECT a.recno, b.recno AS other, count(*) AS n, any_value(len(a.parcels) + len(b.parcels)) AS s FROM t a JOIN t b ON a.district = b.district AND a.section = b.section AND a.p = b.p AND a.recno > b.recno GROUP BY ALL),
 m AS (SELECT recno, max(n::DOUBLE / (s - n)) AS j FROM n GROUP BY 1), f AS (SELECT district, section, min(recno) AS lo FROM ap WHERE section <> '' GROUP BY ALL)
 SELECT ap.recno, CASE WHEN m.j >= 0.2 THEN 'shared' WHEN f.lo < ap.recno THEN 'unrelated' ELSE 'absent' END AS class FROM ap LEFT JOIN m USING (recno) LEFT JOIN f ON f.district = ap.district AND f.section = ap.section WHERE ap.section <> ''""")
def stranded_units(spark: SparkSession, d: str) -> DataFrame:
    """Whether an earlier record of its section shares a fifth of a record's parcels, none does, or the section has no earlier record."""
    a = approvals(spark, d, "recno", "district", "section", "parcels").where("section != ''")
    t = a.where(F.size("parcels") > 0).withColumn("p", F.explode("parcels"))
    other = t.select(F.col("recno").alias("other"), "district", "section", F.size("parcels").alias("s2"), "p")
    n = t.join(other, ["district", "section", "p"]).where("recno > other").groupBy("recno", "other").agg(F.count("*").alias("n"), F.max(F.size("parcels") + F.col("s2")).alias("s"))
    m = n.groupBy("recno").agg(F.max(F.col("n") / (F.col("s") - F.col("n"))).alias("j"))
    lo = a.groupBy("district", "section").agg(F.min("recno").alias("lo"))
    j = a.join(m, "recno", "left").join(lo, ["district", "section"])
    return j.select("recno", F.when(F.col("j") >= 0.2, "shared").when(F.col("lo") < F.col("recno"), "unrelated").otherwise("absent").alias("class"))


# ---- dashboard rows

YEARS = lambda a, b: f"CASE WHEN {b} >= {a} THEN floor(({b} - {a}) / 365.25 * 100 + 0.5) / 100 END"
PROJECT_ROWS = f"""WITH {AP}, {CASES}, o AS ({SQL["core_offers"]}), w AS ({SQL["permit_witness"]}), {days_sql("pm_day", "SELECT permit_id AS key, date AS v, zone FROM permit_records LEFT JOIN feeds USING (feed_id)")},
 bound AS (SELECT max(try_cast(published_date AS DATE)) AS t FROM projects), m AS (SELECT project_id, unnest(member_recnos)::BIGINT AS recno FROM projects),
 nd AS (SELECT m.project_id, try_cast(ap.day AS DATE) AS dt, ap.stage_index, track <> '事業概要' AS eligible FROM m JOIN ap USING (recno), bound WHERE try_cast(ap.day AS DATE) BETWEEN DATE '1995-01-01' AND bound.t),
 n AS (SELECT project_id, coalesce(min(dt) FILTER (eligible AND stage_index = 0), min(dt) FILTER (eligible)) AS first, max(dt) FILTER (eligible) AS latest, max(dt) AS top, NOT bool_or(eligible) AS outline FROM nd GROUP BY 1),
 c AS (SELECT o.project_id, min(make_date(substr(case_id, 1, 3)::INT + 1911, 1, 1)) FILTER (regexp_matches(case_id, '^[0-9]{{3}}')) AS apply, max(dt) FILTER (dt BETWEEN DATE '1995-01-01' AND bound.t) AS seen FROM o JOIN cs USING (search_id), bound GROUP BY 1),
 b AS (SELECT w.project_id, min(try_cast(construction_start AS DATE)) FILTER (try_cast(construction_start AS DATE) BETWEEN DATE '1995-01-01' AND bound.t) AS start, max(try_cast(pm_day.day AS DATE)) FILTER (try_cast(pm_day.day AS DATE) BETWEEN DATE '1995-01-01' AND bound.t) AS comp FROM w JOIN permit_records p USING (permit_id) LEFT JOIN pm_day ON pm_day.key = p.permit_id, bound GROUP BY 1),
 x AS (SELECT p.project_id, coalesce(p.district, '') AS district, coalesce(p.implementer, '') AS implementer, n.first, n.latest, coalesce(n.outline, FALSE) AS only_outline, c.apply, b.start, b.comp, greatest(n.top, c.seen, b.start, b.comp) AS last, bound.t FROM projects p LEFT JOIN n USING (project_id) LEFT JOIN c USING (project_id) LEFT JOIN b USING (project_id), bound),
 y AS (SELECT *, CASE WHEN comp IS NOT NULL THEN '已完工' WHEN start IS NOT NULL THEN '施工中' ELSE '已核定未領建照' END AS status, {YEARS("last", "t")} AS idle_years FROM x),
 rows_ AS (SELECT project_id, district, implementer, status, CASE WHEN status = '已完工' THEN '' WHEN idle_years >= 5 THEN '停滯5年' WHEN idle_years >= 3 THEN '停滯3年' ELSE '推進中' END AS flag, first::VARCHAR AS first_approval, last::VARCHAR AS last_activity, idle_years, {YEARS("apply", "first")} AS review_years, {YEARS("apply", "latest")} AS review2_years, only_outline, {YEARS("apply", "comp")} AS total_years FROM y)"""


@query(f"{PROJECT_ROWS} SELECT * FROM rows_")
def project_rows(spark: SparkSession, d: str) -> DataFrame:
    """One dashboard row a project from its approvals, cases and permit: status, idle time, review times. Days before 1995 or after the publication count as absent."""
    p = table(spark, d, "projects").withColumn("m", F.col("member_recnos").cast("array<bigint>"))
    asof = p.agg(F.max(F.try_to_date("published_date", "yyyy-MM-dd"))).first()[0]
    t = F.lit(asof).cast("date")
    known = lambda c: F.when(c.between(F.lit("1995-01-01").cast("date"), t), c)
    nd = p.select("project_id", F.explode("m").alias("recno")).join(approvals(spark, d, "recno", "day", "stage_index", "track"), "recno").withColumns({"dt": known(dates.real_day(F.col("day"))), "ok": F.col("track") != "事業概要"}).where("dt is not null")
    first = lambda cond: F.min(F.when(cond, F.col("dt")))
    n = nd.groupBy("project_id").agg(F.coalesce(first(F.col("ok") & (F.col("stage_index") == 0)), first(F.col("ok"))).alias("first"), F.max(F.when(F.col("ok"), F.col("dt"))).alias("latest"), F.max("dt").alias("top"), (~F.bool_or("ok")).alias("outline"))
    filed = F.when(F.col("case_id").rlike("^[0-9]{3}"), F.make_date(F.substring("case_id", 1, 3).try_cast("int") + 1911, F.lit(1), F.lit(1)))
    c = timeline_queries.core_offers(spark, d).join(cases(spark, d).select("search_id", "case_id", "dt"), "search_id").groupBy("project_id").agg(F.min(filed).alias("apply"), F.max(known(F.col("dt"))).alias("seen"))
    permits = table(spark, d, "permit_records").join(table(spark, d, "feeds").select("feed_id", "zone"), "feed_id", "left").select("permit_id", known(F.try_to_date("construction_start", "yyyy-MM-dd")).alias("s"), known(dates.real_day(dates.clock_day(F.col("date"), F.col("zone")))).alias("i"))
    b = matching_queries.permit_witness(spark, d).select("project_id", "permit_id").join(permits, "permit_id").groupBy("project_id").agg(F.min("s").alias("start"), F.max("i").alias("comp"))
    x = p.select("project_id", F.coalesce("district", F.lit("")).alias("district"), F.coalesce("implementer", F.lit("")).alias("implementer")).join(n, "project_id", "left").join(c, "project_id", "left").join(b, "project_id", "left")
    x = x.withColumn("last", F.greatest("top", "seen", "start", "comp")).withColumns({"status": F.when(F.col("comp").isNotNull(), "已完工").when(F.col("start").isNotNull(), "施工中").otherwise("已核定未領建照"), "idle_years": dates.years_between(F.col("last"), t)})
    flag = F.when(F.col("status") == "已完工", "").when(F.col("idle_years") >= 5, "停滯5年").when(F.col("idle_years") >= 3, "停滯3年").otherwise("推進中")
    years = lambda a, b: dates.years_between(F.col(a), F.col(b))
    return x.select(
        "project_id", "district", "implementer", "status", flag.alias("flag"), F.col("first").cast("string").alias("first_approval"), F.col("last").cast("string").alias("last_activity"), "idle_years", years("apply", "first").alias("review_years"),
        years("apply", "latest").alias("review2_years"), F.coalesce("outline", F.lit(False)).alias("only_outline"), years("apply", "comp").alias("total_years"),
    )


@query(f"""{PROJECT_ROWS} SELECT CASE WHEN grouping(district) = 1 THEN '全市' ELSE district END AS district, count(*) AS n, floor(count(*) FILTER (status = '已完工') * 1000.0 / count(*) + 0.5) / 10 AS done_pct, count(*) FILTER (flag = '停滯3年') AS idle3, count(*) FILTER (flag = '停滯5年') AS idle5,
 median(review_years) AS med_review, median(review2_years) AS med_review2, median(total_years) AS med_total FROM rows_ GROUP BY ROLLUP (district)""")
def kpi_by_district(spark: SparkSession, d: str) -> DataFrame:
    """The figures of each district and the whole city, with three medians, in one rollup."""
    from ..operators.measures import half_up, with_total

    med = lambda c: F.percentile(c, F.lit(0.5)).alias(f"med_{c.removesuffix('_years')}")
    return with_total(
        project_rows(spark, d), "district", "全市", F.count("*").alias("n"), half_up(F.count_if(F.col("status") == "已完工") * 100.0 / F.nullif(F.count("*"), F.lit(0)), 1).alias("done_pct"),
        F.count_if(F.col("flag") == "停滯3年").alias("idle3"), F.count_if(F.col("flag") == "停滯5年").alias("idle5"), med("review_years"), med("review2_years"), med("total_years"),
    )


STATUSES, FLAGS = ["已核定未領建照", "已領建照未開工", "施工中", "已完工"], ["推進中", "停滯3年", "停滯5年"]


@query(f"{PROJECT_ROWS}, dims AS (SELECT s AS status, f AS flag FROM (VALUES {', '.join(f'({chr(39)}{s}{chr(39)})' for s in STATUSES)}) a(s), (VALUES {', '.join(f'({chr(39)}{f}{chr(39)})' for f in FLAGS)}) b(f)) SELECT dims.status, dims.flag, count(project_id) AS n FROM dims LEFT JOIN rows_ USING (status, flag) GROUP BY ALL")
def pipeline_idle(spark: SparkSession, d: str) -> DataFrame:
    """Projects by status and idle time, empty combinations with zeros."""
    from ..operators.measures import zero_filled

    dims = spark.createDataFrame([(s, f) for s in STATUSES for f in FLAGS], "status string, flag string")
    return zero_filled(project_rows(spark, d), dims, ["status", "flag"], {"n": F.count("*")})


@query(f"""{PROJECT_ROWS}, v AS (SELECT substr(first_approval, 1, 4) AS year, unnest(['review', 'review2']) AS interval_, unnest([review_years, review2_years]) AS v FROM rows_) SELECT year, interval_ AS span, count(v) AS n, min(v) AS lo, floor(quantile_cont(v, 0.25) * 10 + 0.5) / 10 AS q1, floor(quantile_cont(v, 0.5) * 10 + 0.5) / 10 AS med, floor(quantile_cont(v, 0.75) * 10 + 0.5) / 10 AS q3, max(v) AS hi FROM v WHERE year IS NOT NULL AND v IS NOT NULL GROUP BY ALL""")
def review_spread(spark: SparkSession, d: str) -> DataFrame:
    """The spread of both review times by the year of the first approval."""
    from ..operators.measures import spread

    r = project_rows(spark, d).select(F.substring("first_approval", 1, 4).alias("year"), F.expr("stack(2, 'review', review_years, 'review2', review2_years) as (span, v)")).where("year is not null and v is not null")
    return spread(r, ["year", "span"], "v")


# ---- gates

@query(f"WITH r AS ({SQL['reconcile_publications']}), w AS (SELECT k, count(*) AS n FROM ({SQL['withdrawn_from_newest']}) GROUP BY k) SELECT pair, concat_ws('|', CASE WHEN vanished > \"new\" THEN 'shrank' END, CASE WHEN coalesce(w.n, 0) > 0 THEN 'withdrawn' END, CASE WHEN kept + redated = 0 THEN 'rekeyed' END) AS blocking FROM r LEFT JOIN w ON w.k = r.pair")
def reconcile_gate(spark: SparkSession, d: str) -> DataFrame:
    """What blocks each publication: the list shrank, its predecessor's newest entries were withdrawn, or no key is shared."""
    w = publication_queries.withdrawn_from_newest(spark, d).groupBy(F.col("k").alias("pair")).agg(F.count("*").alias("w"))
    r = publication_queries.reconcile_publications(spark, d).join(w, "pair", "left")
    rules = {"shrank": F.col("vanished") > F.col("new"), "withdrawn": F.coalesce("w", F.lit(0)) > 0, "rekeyed": F.col("kept") + F.col("redated") == 0}
    return r.select("pair", F.concat_ws("|", *[F.when(bad, F.lit(n)) for n, bad in rules.items()]).alias("blocking"))


@query(SQL["partition_check"])
def payload_gate(spark: SparkSession, d: str) -> DataFrame:
    """The emitted document is parsed again, and its members must split the records as the tables do."""
    made = table(spark, d, "projects").select(F.to_json(F.struct("project_id", "land_core", "member_recnos")).alias("j"))
    back = made.select(F.from_json("j", "project_id string, land_core string, member_recnos array<bigint>").alias("p")).select("p.project_id", F.explode("p.member_recnos").alias("recno"))
    return quality.partition_figures(back, "recno", "project_id", table(spark, d, "clean_records").where("recno is not null").select(F.col("recno").cast("bigint").alias("recno")))


@query(f"WITH b AS ({SQL['case_badges']}), h AS (SELECT DISTINCT recno FROM ({SQL['bound_cases']})) SELECT count(*) FILTER (badge <> 'none' AND h.recno IS NULL) AS silent, count(*) FILTER (badge = 'none' AND h.recno IS NOT NULL) AS stale, count(*) AS n FROM b LEFT JOIN h USING (recno)")
def badge_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Approvals with a badge but no case, and with a case but no badge."""
    h = matching_queries.bound_cases(spark, d).select("recno").distinct().withColumn("has", F.lit(True))
    j = case_badges(spark, d).join(h, "recno", "left")
    badge, has = F.col("badge") != "none", F.col("has").isNotNull()
    return j.agg(F.count_if(badge & ~has).alias("silent"), F.count_if(~badge & has).alias("stale"), F.count("*").alias("n"))


@query("WITH a AS (SELECT count(*) AS projects, sum(len(member_recnos))::BIGINT AS records, max(published_date) AS day FROM projects), b AS (SELECT count(DISTINCT recno) AS records FROM clean_records WHERE recno IS NOT NULL), c AS (SELECT max(release_id) AS last FROM release_records) SELECT a.projects, a.records = b.records AS same_records, starts_with(a.day, substr(c.last, 2)) AS same_month FROM a, b, c")
def document_consistency(spark: SparkSession, d: str) -> DataFrame:
    """Whether two documents agree on their records and date. Three one-row aggregates are compared."""
    a = table(spark, d, "projects").agg(F.count("*").alias("projects"), F.sum(F.size("member_recnos")).alias("records"), F.max("published_date").alias("day")).first()
    b = table(spark, d, "clean_records").where("recno is not null").agg(F.count_distinct("recno").alias("n")).first()
    c = table(spark, d, "release_records").agg(F.max("release_id").alias("last")).first()
    same = a.records == b.n if a.records is not None else None
    month = a.day.startswith(c.last[1:]) if a.day is not None and c.last is not None else None
    return spark.createDataFrame([(a.projects, same, month)], "projects bigint, same_records boolean, same_month boolean")


@query(f"WITH e AS ({SQL['history_edges']}), f AS ({SQL['family_components']}) SELECT kind, count(*) AS edges, count(*) FILTER (x.family IS DISTINCT FROM e.family OR y.family IS DISTINCT FROM e.family) AS bad_outside FROM e LEFT JOIN f x ON x.recno = e.frm LEFT JOIN f y ON y.recno = e.\"to\" GROUP BY kind")
def edges_inside(spark: SparkSession, d: str) -> DataFrame:
    """Edges whose ends aren't both members of their family."""
    f = family_queries.family_components(spark, d)
    e = family_queries.history_edges(spark, d).join(f.select(F.col("recno").alias("frm"), F.col("family").alias("x")), "frm", "left").join(f.select(F.col("recno").alias("to"), F.col("family").alias("y")), "to", "left")
    out = ~(F.col("x").eqNullSafe(F.col("family")) & F.col("y").eqNullSafe(F.col("family")))
    return e.groupBy("kind").agg(F.count("*").alias("edges"), F.count_if(out).alias("bad_outside"))


@query("""WITH s AS (SELECT case_name, chk_date, count(DISTINCT regexp_replace(land_core, '\\s+', '', 'g')) AS lands FROM search_results WHERE status = 'resolved' AND chk_date IS NOT NULL AND case_name IS NOT NULL GROUP BY ALL) SELECT count(*) FILTER (lands = 1) AS isolated, count(*) FILTER (lands > 1) AS shared FROM s""")
def isolated_events(spark: SparkSession, d: str) -> DataFrame:
    """Events shown under one land only, and under several."""
    s = table(spark, d, "search_results").where("status = 'resolved' and chk_date is not null and case_name is not null")
    g = s.groupBy("case_name", "chk_date").agg(F.count_distinct(F.regexp_replace("land_core", r"\s+", "")).alias("lands"))
    return g.agg(F.count_if(F.col("lands") == 1).alias("isolated"), F.count_if(F.col("lands") > 1).alias("shared"))


@query(f"WITH g AS ({SQL['multiset_gains']}), r AS (SELECT dense_rank() OVER (ORDER BY release_id)::BIGINT AS k, {squeeze_sql(fold_sql('land'))} AS l, iso_date AS day FROM release_records), n AS (SELECT k, regexp_replace(l, '[、,]+', '', 'g') AS land, day, count(*) AS n FROM r GROUP BY ALL), lost AS (SELECT a.k, a.day, a.n - coalesce(b.n, 0) AS n FROM n a LEFT JOIN n b ON b.k = a.k + 1 AND b.land IS NOT DISTINCT FROM a.land AND b.day IS NOT DISTINCT FROM a.day WHERE a.n > coalesce(b.n, 0)) SELECT k, 'gained' AS side, substr(day, 1, 4) AS year, sum(n)::BIGINT AS n FROM g GROUP BY ALL UNION ALL SELECT k, 'lost', substr(day, 1, 4), sum(n)::BIGINT FROM lost GROUP BY ALL")
def churn_sides(spark: SparkSession, d: str) -> DataFrame:
    """Entries gained against the release before and lost to the one after, by year."""
    r = releases(spark, d).select("k", "land", "day")
    n = r.groupBy("k", "land", "day").agg(F.count("*").alias("n"))
    sides = n.select("k", "land", "day", F.col("n").alias("own"), F.lit(0).cast("bigint").alias("before"), F.lit(0).cast("bigint").alias("after"))
    shift = lambda step, c: n.select((F.col("k") + step).alias("k"), "land", "day", F.lit(0).cast("bigint").alias("own"), *[(F.col("n") if x == c else F.lit(0).cast("bigint")).alias(x) for x in ("before", "after")])
    g = sides.unionByName(shift(1, "before")).unionByName(shift(-1, "after")).groupBy("k", "land", "day").agg(*[F.sum(c).alias(c) for c in ("own", "before", "after")])
    e = g.select("k", F.substring("day", 1, 4).alias("year"), F.expr("stack(2, 'gained', own - before, 'lost', own - after) as (side, n)")).where("n > 0")
    return e.groupBy("k", "side", "year").agg(F.sum("n").alias("n"))


@query(f"""WITH a AS ({SQL["attached_cases"]}), b AS ({SQL["case_badges"]}), g AS ({SQL["orphan_gate"]}) SELECT 'attached' AS part, source AS label, count(*) AS n FROM a GROUP BY ALL UNION ALL SELECT 'badge', badge, count(*) FROM b GROUP BY ALL UNION ALL SELECT 'orphan', gate, count(*) FROM g GROUP BY ALL
 UNION ALL SELECT 'projects', CASE WHEN len(member_recnos) = 1 THEN 'single' ELSE 'several' END, count(*) FROM projects GROUP BY ALL UNION ALL SELECT 'searches', status, count(*) FROM search_results GROUP BY ALL""")
def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    """The figures of a coverage report, one row a line; rendering is left to its reader."""
    line = lambda df, part, label: df.groupBy(F.lit(part).alias("part"), label.alias("label")).agg(F.count("*").alias("n"))
    parts = [
        line(attached_cases(spark, d), "attached", F.col("source")), line(case_badges(spark, d), "badge", F.col("badge")), line(orphan_gate(spark, d), "orphan", F.col("gate")),
        line(table(spark, d, "projects"), "projects", F.when(F.size("member_recnos") == 1, "single").otherwise("several")), line(table(spark, d, "search_results"), "searches", F.col("status")),
    ]
    return reduce(DataFrame.unionByName, parts)
