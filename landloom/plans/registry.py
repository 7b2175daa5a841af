"""Registration of queries with their SQL, and the tables derived from the register that several queries read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import clock_day, real_day
from ..functions.land import KINDS, NUMERALS, PARCEL, PLACE, STAGE_HEAD, STAGE_TAIL, area_section, even_cell, heading_stage, kinds, normalize_land, normalize_name, parcel_tokens, place, section_key, section_token
from ..functions.moments import ABBREVIATIONS, REGISTER
from ..functions.text import NARROW, WIDE, fold_width, no_space
from ..operators.matching import first_per_key
from ..operators.packed import alias_items
from ..runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


#: Width folding in SQL, as ``text.fold_width``, and the white space of ``text.SPACE``.
_QUOTED = NARROW.replace("'", "''")
SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def fold_sql(c: str) -> str:
    return f"translate({c}, '{WIDE}', '{_QUOTED}')"


def squeeze_sql(c: str) -> str:
    return f"regexp_replace({c}, '{SPACES}+', '', 'g')"


_AT = r"(?:(上午|下午|AM|PM) ?)?([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,][0-9]+)?)? ?(AM|PM)? ?(Z|[+-][0-9]{2}:?[0-9]{2}|\[[A-Za-z_+\-/0-9]+\]|[A-Z]{3,4})?"
_AT_NAMES = "'noon', 'h', 'mi', 's', 'ap', 'zone'"
_OFFSETS = " ".join(f"WHEN '{z}' THEN {hours[0]}" for z, hours in ABBREVIATIONS.items() if len(hours) == 1)


def days_sql(name: str, source: str) -> str:
    """CTEs ending in ``name`` (key, day): the day that each value ``v`` of ``source`` (key, v, zone) names on its clock, as ``dates.clock_day``."""
    first = lambda *c: "coalesce(" + ", ".join(f"nullif({x}, '')" for x in c) + ", '')"
    return rf"""{name}_a AS (SELECT key, v, coalesce(zone, '{REGISTER}') AS clock, trim(regexp_replace({fold_sql("v")}, '{SPACES}+', ' ', 'g')) AS t FROM ({source}) WHERE v IS NOT NULL),
 {name}_b AS (SELECT *, regexp_extract(t, '^(?:中華民國|民國)? ?([0-9]{{1,4}})([/.-])([0-9]{{1,2}})([/.-])([0-9]{{1,2}})(?:[T ] ?{_AT})?$', ['y', 'a', 'mo', 'b', 'd', {_AT_NAMES}]) AS n,
 regexp_extract(t, '^(?:中華民國|民國)? ?([0-9]{{1,4}}) ?年 ?([0-9]{{1,2}}) ?月 ?([0-9]{{1,2}}) ?日?(?:[T ]*{_AT})?$', ['y', 'mo', 'd', {_AT_NAMES}]) AS k,
 regexp_extract(t, '^([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})T([0-9]{{2}})([0-9]{{2}})([0-9]{{2}})?(Z|[+-][0-9]{{2}}:?[0-9]{{2}})?$', ['y', 'mo', 'd', 'h', 'mi', 's', 'zone']) AS c,
 regexp_extract(t, '^([0-9]{{1,2}})[ -]([A-Za-z]{{3}})[a-z]*[ -]([0-9]{{4}})(?:[, ] ?{_AT})?$', ['d', 'mon', 'y', {_AT_NAMES}]) AS e, regexp_extract(t, '^([A-Za-z]{{3}})[a-z]* +([0-9]{{1,2}}),? +([0-9]{{4}})(?:[, ] ?{_AT})?$', ['mon', 'd', 'y', {_AT_NAMES}]) AS f,
 regexp_extract(t, '^([0-9]{{2,4}})([0-9]{{2}})([0-9]{{2}})$', ['y', 'mo', 'd']) AS g, CASE WHEN regexp_full_match(t, '[0-9]{{10}}|[0-9]{{13}}') THEN to_timestamp(substr(t, 1, 10)::BIGINT) END AS epoch FROM {name}_a),
 {name}_c AS (SELECT key, v, clock, epoch, try_cast({first("CASE WHEN n.a = n.b THEN n.y END", "k.y", "c.y", "e.y", "f.y", "g.y")} AS INT) AS y,
 coalesce(try_cast({first("n.mo", "k.mo", "c.mo", "g.mo")} AS INT), nullif((strpos('janfebmaraprmayjunjulaugsepoctnovdec', lower({first("e.mon", "f.mon")})) + 2) // 3, 0)) AS mo, try_cast({first("n.d", "k.d", "c.d", "e.d", "f.d", "g.d")} AS INT) AS d,
 {first("n.noon", "n.ap", "k.noon", "k.ap", "e.noon", "e.ap", "f.noon", "f.ap")} AS noon, try_cast({first("n.h", "k.h", "c.h", "e.h", "f.h")} AS INT) AS h, {first("n.zone", "k.zone", "c.zone", "e.zone", "f.zone")} AS zone,
 coalesce(try_cast({first("n.mi", "k.mi", "c.mi", "e.mi", "f.mi")} AS INT), 0) AS mi, coalesce(try_cast({first("n.s", "k.s", "c.s", "e.s", "f.s")} AS INT), 0) AS s FROM {name}_b),
 {name}_d AS (SELECT key, v, clock, epoch, zone, h, CASE WHEN h IS NULL OR mi < 60 AND s < 60 AND (noon = '' AND h < 24 OR noon <> '' AND h BETWEEN 1 AND 12) THEN try_cast(printf('%04d-%02d-%02d', CASE WHEN y BETWEEN 1 AND 1910 THEN y + 1911 ELSE y END, mo, d) AS DATE) END AS dt,
 CASE WHEN noon = '' THEN h WHEN noon IN ('下午', 'PM') THEN h % 12 + 12 ELSE h % 12 END * 3600 + mi * 60 + s AS sec FROM {name}_c),
 {name}_e AS (SELECT key, v, clock, dt, CASE WHEN epoch IS NOT NULL THEN epoch WHEN zone = '' THEN NULL WHEN zone[1] = '[' THEN timezone(zone[2:-2], dt + to_seconds(sec)) ELSE timezone('UTC', dt + to_seconds(sec) - to_seconds(3600 *
 CASE WHEN zone[1] IN ('+', '-') THEN (zone[1:3]::INT + CASE zone[1] WHEN '-' THEN -1 ELSE 1 END * zone[-2:]::INT / 60.0)::DOUBLE ELSE (CASE zone {_OFFSETS} END)::DOUBLE END)) END AS moment, zone FROM {name}_d),
 {name} AS (SELECT key, CASE WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN v ELSE strftime(CASE WHEN zone = '' AND moment IS NULL THEN dt ELSE timezone(clock, moment)::DATE END, '%Y-%m-%d') END AS day FROM {name}_e)"""


#: The approvals in SQL: one row per record number, the first printed.
AP = (
    "first_print AS (SELECT *, row_number() OVER (PARTITION BY recno ORDER BY clean_id) AS rn FROM clean_records WHERE recno IS NOT NULL), "
    + days_sql("ap_day", "SELECT clean_id AS key, iso_date AS v, zone FROM first_print LEFT JOIN feeds USING (feed_id) WHERE rn = 1")
    + rf""",
 al_a AS (SELECT clean_id, regexp_extract_all(regexp_replace({fold_sql("aliases")}, '->|=|\(|[": ]*:["\[ ]*', ':', 'g'), '[0-9]+(?:-[0-9]+)?:?') AS x FROM first_print WHERE rn = 1 AND coalesce(aliases, '') <> ''),
 al_b AS (SELECT clean_id, unnest(x) AS tok, generate_subscripts(x, 1) AS i FROM al_a), al_c AS (SELECT clean_id, tok, last_value(CASE WHEN tok LIKE '%:' THEN tok END IGNORE NULLS) OVER (PARTITION BY clean_id ORDER BY i) AS head FROM al_b),
 al AS (SELECT clean_id, list_sort(list_distinct(list(head || tok))) AS aliases FROM al_c WHERE tok NOT LIKE '%:' AND head IS NOT NULL GROUP BY 1),
 ap AS (SELECT recno::BIGINT AS recno, day, coalesce(district, '') AS district, coalesce(section, '') AS section, coalesce(first_parcel, '') AS first,
 list_sort(list_distinct(regexp_extract_all(regexp_replace({fold_sql("coalesce(parcels, '')")}, '\([^()]*\)', '', 'g'), '[0-9]+(?:-[0-9]+)?'))) AS parcels, coalesce(al.aliases, []) AS aliases,
 coalesce(land_count, 0)::BIGINT AS "count", coalesce(orig_count, 0)::BIGINT AS orig, coalesce(named_anchor, '') AS anchor,
 coalesce(stage_index, -1)::BIGINT AS stage_index, coalesce(track, '') AS track, coalesce(implementer, '') AS implementer, coalesce(planner, '') AS planner, name, regexp_extract({fold_sql("coalesce(land, '')")}, '\(([A-D甲乙丙丁])區段\)', 1) AS area
 FROM first_print LEFT JOIN ap_day ON ap_day.key = clean_id LEFT JOIN al USING (clean_id) WHERE rn = 1)"""
)


def approvals(spark: SparkSession, d: str, *need: str) -> DataFrame:
    """The approvals, with the columns ``need`` names or all; only their sources are read and shuffled.

    ``day`` reads every form of ``iso_date``, a moment on the clock of its feed; ``aliases`` holds ``parcel:alias`` texts.
    """
    text = lambda n: F.coalesce(n, F.lit(""))
    number = lambda n, other: F.coalesce(n, F.lit(other)).cast("bigint")
    made = {
        "recno": ("recno", F.col("recno").cast("bigint")),
        "day": ("iso_date", clock_day(F.col("iso_date"), F.col("zone"))),
        "district": ("district", text("district")),
        "section": ("section", text("section")),
        "first": ("first_parcel", text("first_parcel")),
        "parcels": ("parcels", F.array_sort(F.array_distinct(F.regexp_extract_all(F.regexp_replace(fold_width(text("parcels")), r"\([^()]*\)", ""), F.lit(f"({PARCEL})"), F.lit(1))))),
        "aliases": ("aliases", F.array_sort(F.array_distinct(alias_items(fold_width(text("aliases")))))),
        "count": ("land_count", number("land_count", 0)),
        "orig": ("orig_count", number("orig_count", 0)),
        "anchor": ("named_anchor", text("named_anchor")),
        "stage_index": ("stage_index", number("stage_index", -1)),
        "track": ("track", text("track")),
        "implementer": ("implementer", text("implementer")),
        "planner": ("planner", text("planner")),
        "name": ("name", F.col("name")),
        "area": ("land", area_section(fold_width(text("land")))),
    }
    made = {n: made[n] for n in (need or made)}
    c = table(spark, d, "clean_records").where("recno is not null")
    dated = "day" in made
    c = first_per_key(c.select("recno", "clean_id", *[src for src, _ in made.values() if src != "recno"], *["feed_id"] * dated), ["recno"], [F.col("clean_id")])
    if dated:
        c = c.join(table(spark, d, "feeds").select("feed_id", "zone"), "feed_id", "left")
    return c.select(*[e.alias(n) for n, (_, e) in made.items()])


_EVEN = squeeze_sql("regexp_replace(regexp_replace(f, '([0-9])" + SPACES + "+([0-9])', '\\1、\\2', 'g'), '([0-9])" + SPACES + "+([0-9])', '\\1、\\2', 'g')")


def cells_sql(name: str, source: str) -> str:
    """CTEs ending in ``name``: ``source`` (with a column land) with ``even``, ``sec`` and ``tokens``, as ``even_cell``, ``section_token`` and ``parcel_tokens``."""
    body = r"regexp_replace(regexp_replace(regexp_replace(even, '\([^()]*\)', '', 'g'), '^.*段', ''), '(?:地號|等[0-9]+筆|土地|\s)+$', '')"
    return rf"""{name}_f AS (SELECT *, {fold_sql("land")} AS f FROM ({source})), {name}_g AS (SELECT *, {_EVEN} AS even FROM {name}_f),
 {name} AS (SELECT * EXCLUDE (f), nullif(regexp_extract(even, '區([^0-9區]*段(?:[^0-9]*小段)?)', 1), '') AS sec, list_distinct(list_transform(regexp_extract_all({body}, '[0-9]+(?:-[0-9]+)?'), lambda x: regexp_replace(x, '^0+([0-9])', '\1'))) AS tokens,
 list_transform(regexp_extract_all({body}, '[0-9]+(?:-[0-9]+)?'), lambda x: regexp_replace(x, '^0+([0-9])', '\1'))[1] AS head FROM {name}_g)"""


#: Releases in order, with the land and day that identify a row; ``unit`` is its place and first parcel, null where the cell names none.
REL = (
    cells_sql("rel_c", "SELECT *, dense_rank() OVER (ORDER BY release_id)::BIGINT AS k FROM release_records")
    + rf""", rel AS (SELECT release_row, release_id, k, regexp_replace({squeeze_sql(fold_sql("land"))}, '[、,]+', '', 'g') AS land, iso_date AS day, district, recno::BIGINT AS recno, name, section,
 district || '|' || sec || '|' || head AS unit, sec, tokens FROM rel_c)"""
)


def releases(spark: SparkSession, d: str, *more: Column) -> DataFrame:
    """One row per printed row, with ``more`` columns; ``k`` counts the releases from 1. The list of releases is one row per delivery."""
    r = table(spark, d, "release_records")
    ids = sorted(x[0] for x in r.select("release_id").distinct().collect())
    k = F.array_position(F.array(*[F.lit(i) for i in ids]).cast("array<string>"), F.col("release_id"))
    return r.select("release_row", "release_id", k.alias("k"), normalize_land(fold_width(F.col("land"))).alias("land"), F.col("iso_date").alias("day"), "district", F.col("recno").cast("bigint").alias("recno"), "name", "section", *more)


def cell_unit() -> tuple[Column, Column, Column]:
    """(unit, section, parcels) of a printed row: place and first parcel of its land, null where the cell names none."""
    even = even_cell(F.col("land"))
    sec, tokens = section_token(even), parcel_tokens(even)
    return F.concat(F.col("district"), F.lit("|"), sec, F.lit("|"), F.get(tokens, F.lit(0))).alias("unit"), sec.alias("sec"), tokens.alias("tokens")


def section_key_sql(c: str) -> str:
    return f"translate(regexp_replace({c}, '[段小]', '', 'g'), '123456789', '{NUMERALS}')"


def kinds_sql(c: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN contains({c}, '{w}') THEN '{k}' END" for k, w in KINDS.items()) + "], lambda x: x IS NOT NULL)"


#: The resolved searches in SQL: land and heading as places, stage, kinds and day.
_NTH = "CASE WHEN contains(n, '十') THEN CASE WHEN split_part(n, '十', 1) = '' THEN 1 ELSE strpos('" + NUMERALS + "', split_part(n, '十', 1)) END * 10 + CASE WHEN split_part(n, '十', 2) = '' THEN 0 ELSE strpos('" + NUMERALS + "', split_part(n, '十', 2)) END ELSE nullif(strpos('" + NUMERALS + "', n), 0) END"
CASES = (
    days_sql("cs_day", "SELECT search_id AS key, chk_date AS v, NULL::VARCHAR AS zone FROM search_results WHERE status = 'resolved'")
    + rf""", cs_a AS (SELECT search_id, case_ids[1] AS case_id, view_id, {squeeze_sql(fold_sql("land_core"))} AS lc, translate({squeeze_sql(fold_sql("case_name"))}, '劃ㄧ', '畫一') AS nm FROM search_results WHERE status = 'resolved'),
 cs_b AS (SELECT *, regexp_extract(lc, '{PLACE}', ['dist', 'sec', 'first', 'cnt']) AS l, regexp_extract(regexp_replace(nm, '{STAGE_HEAD}', ''), '{PLACE}', ['dist', 'sec', 'first', 'cnt']) AS h,
 coalesce(nullif(regexp_extract(nm, '{STAGE_HEAD}', 1), ''), nullif(regexp_extract(nm, '{STAGE_TAIL}', 1), '')) AS w, regexp_extract(coalesce(nullif(regexp_extract(nm, '{STAGE_HEAD}', 1), ''), regexp_extract(nm, '{STAGE_TAIL}', 1)), '第([一二三四五六七八九十]+)次', 1) AS n FROM cs_a),
 cs AS (SELECT search_id, case_id, view_id, lc, nm, coalesce(l.dist, '') AS dist, {section_key_sql("l.sec")} AS sec, regexp_replace(l.first, '^0+([0-9])', '\1') AS first, coalesce(h.dist, '') AS h_dist, {section_key_sql("h.sec")} AS h_sec, regexp_replace(h.first, '^0+([0-9])', '\1') AS h_first, try_cast(nullif(h.cnt, '') AS BIGINT) AS cnt,
 (CASE WHEN starts_with(w, '擬') THEN 0 WHEN n <> '' THEN {_NTH} WHEN w IS NOT NULL THEN 1 END)::BIGINT AS stage, {kinds_sql("nm")} AS kinds, day, try_cast(day AS DATE) AS dt FROM cs_b LEFT JOIN cs_day ON key = search_id)"""
)


def cases(spark: SparkSession, d: str) -> DataFrame:
    """The resolved searches with the place of their land (dist, sec, first) and of their heading (h_dist, h_sec, h_first, cnt), stage, kinds and day."""
    s = table(spark, d, "search_results").where("status = 'resolved'")
    s = s.select("search_id", F.get("case_ids", F.lit(0)).alias("case_id"), "view_id", no_space(fold_width(F.col("land_core"))).alias("lc"), normalize_name(fold_width(F.col("case_name"))).alias("nm"), clock_day(F.col("chk_date"), F.lit(None).cast("string")).alias("day"))
    s = s.withColumns({"l": place(F.col("lc")), "h": place(F.regexp_replace("nm", STAGE_HEAD, ""))})
    return s.select(
        "search_id", "case_id", "view_id", "lc", "nm", F.coalesce("l.dist", F.lit("")).alias("dist"), "l.sec", "l.first", F.coalesce("h.dist", F.lit("")).alias("h_dist"), F.col("h.sec").alias("h_sec"), F.col("h.first").alias("h_first"), "h.cnt",
        heading_stage(F.col("nm")).alias("stage"), F.coalesce(kinds(F.col("nm")), F.array().cast("array<string>")).alias("kinds"), "day", real_day(F.col("day")).alias("dt"),
    )


def anywhere(a: DataFrame, district: str = "district", alias: str = "dist") -> DataFrame:
    """``a`` once under its district and once under '': a side that doesn't say its district meets it there."""
    return a.withColumn(alias, F.explode(F.array_distinct(F.array(F.coalesce(district, F.lit("")), F.lit("")))))


#: Approvals with the key of their section, in SQL; ``un2`` has each also without its district.
UNITS = f"""un AS (SELECT *, {section_key_sql("section")} AS sec, try_cast(day AS DATE) AS dt FROM ap), un2 AS (SELECT *, district AS dist FROM un UNION ALL SELECT *, '' FROM un WHERE district <> '')"""


def units(spark: SparkSession, d: str, *need: str) -> DataFrame:
    return approvals(spark, d, *need).withColumn("sec", section_key(F.col("section")))


def strip0_sql(c: str) -> str:
    return rf"regexp_replace({c}, '^0+([0-9])', '\1')"


#: Parcels of permits in SQL. A parcel without a district takes its permit's only one, else it meets every district.
PERMIT_PARCELS = rf"""pd AS (SELECT permit_id, CASE WHEN min(x.district) = max(x.district) THEN min(x.district) END AS only FROM permit_records, unnest(parcels) t(x) WHERE coalesce(x.district, '') <> '' GROUP BY 1),
 mt AS (SELECT * FROM (SELECT DISTINCT r.permit_id, is_jianzi, construction_start, coalesce(nullif(x.district, ''), pd.only, '') AS dist, {section_key_sql(squeeze_sql(fold_sql("x.section")))} AS sec, {strip0_sql("regexp_extract(" + squeeze_sql(fold_sql("x.mono")) + ", '^([0-9]+)', 1)")} AS main FROM permit_records r LEFT JOIN pd USING (permit_id), unnest(r.parcels) t(x)) WHERE main <> '')"""


def permit_parcels(permits: DataFrame, *keep: str) -> DataFrame:
    """(permit_id, ``keep``, dist, sec, main) of every parcel of a permit."""
    said = F.array_distinct(F.filter(F.transform("parcels", lambda x: F.nullif(x["district"], F.lit(""))), lambda x: x.isNotNull()))
    only = F.when(F.size(said) == 1, F.get(said, F.lit(0)))
    x = permits.select("permit_id", *keep, only.alias("only"), F.explode("parcels").alias("x"))
    number = F.regexp_replace(F.regexp_extract(no_space(fold_width(F.col("x.mono"))), "^([0-9]+)", 1), "^0+(?=[0-9])", "")
    return x.select("permit_id", *keep, F.coalesce(F.nullif("x.district", F.lit("")), "only", F.lit("")).alias("dist"), section_key(no_space(fold_width(F.col("x.section")))).alias("sec"), number.alias("main")).where("main != ''").distinct()
