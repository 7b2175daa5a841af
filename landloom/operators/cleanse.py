"""Cleansing: one wide projection from raw to clean rows, with the fixes made and the flags raised in rule order.

Nothing is dropped but rows with a source fault; what can't be read is flagged and left empty. Where the name and the
land cell disagree the name wins. Districts are those that occur in the raw rows, collected once (a handful of
names); a longer name is tried before a shorter one.

Defined cases: null and empty cells raise the flag of their field; repeated rows are kept; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, land
from ..functions.text import nfkc, no_space

#: Fixed values of the register.
DISTRICT_TYPOS = {"松化區": "松山區"}
ANCHOR = r"原([^0-9()]{2,12}?(?:基地|國宅|整宅|大樓|市場))"


def known_districts(raw: DataFrame, limit: int = 1000) -> list[str]:
    """The district names printed in the rows, longest first. Names beyond ``limit`` mean the column isn't a district: an error, not a cut."""
    names = [r[0] for r in raw.select(no_space(F.col("district")).alias("d")).where("d like '%區'").distinct().limit(limit + 1).collect()]
    if len(names) > limit:
        raise ValueError(f"more than {limit} districts")
    return sorted({DISTRICT_TYPOS.get(n, n) for n in names}, key=lambda n: (-len(n), n))


def cleanse(raw: DataFrame, districts: list[str] | None = None) -> DataFrame:
    if "source_fault" in raw.columns:
        raw = raw.where(F.coalesce("source_fault", F.lit("")) == "")
    districts = known_districts(raw) if districts is None else districts
    typo = F.lit(None).cast("string")
    for wrong, right in DISTRICT_TYPOS.items():
        typo = F.when(F.col("district") == wrong, right).otherwise(typo)
    r = raw.select("*", nfkc("name").alias("_n"), nfkc("land").alias("_l"))
    spaceless = no_space(F.coalesce("_n", F.lit("")))
    folded = land.normalize_name(F.coalesce("_n", F.lit("")))
    plan = F.replace(folded, F.lit("事業換計畫"), F.lit("事業計畫"))
    insert = F.when(plan.contains("都市更新計畫") & ~plan.contains("事業計畫"), F.replace(plan, F.lit("都市更新計畫"), F.lit("都市更新事業計畫"))).otherwise(plan)
    flat = no_space(F.coalesce("_l", F.lit("")))
    r = r.withColumns({"_plan": plan, "_folded": folded, "_name": insert, "_raw": spaceless, "_flat": flat, "_typo": typo, "_iso": dates.to_iso(F.col("date"))})
    # An empty cell whose name ends with the land: the tail becomes the cell.
    tail = F.regexp_extract("_name", "((?:臺北市|台北市)[^()]*段[^()]*地號[^()]*)$", 1)
    moved = (F.col("_flat") == "") & (tail != "") & ~F.col("_name").startswith(tail) & F.col("_name").rlike("案(?:臺北市|台北市)")
    r = r.withColumns({"_moved": moved, "_tail": tail})
    r = r.withColumns({"_cell": F.when(F.col("_moved"), F.col("_tail")).otherwise(F.col("_flat")), "_name": F.when(F.col("_moved"), F.substring("_name", F.lit(1), F.length("_name") - F.length("_tail"))).otherwise(F.col("_name"))})
    ident = land.name_identity(F.col("_name"))
    enum = F.regexp_extract("_cell", "(" + "|".join(districts) + ")", 1) if districts else F.lit("")
    r = r.withColumns({"_id": ident, "_parcels": land.parcel_tokens(F.col("_cell")), "_section": land.section_token(F.col("_cell")), "_dland": F.nullif(enum, F.lit(""))})
    r = r.withColumn("_district", F.coalesce("_typo", F.nullif(no_space(F.coalesce("district", F.lit(""))), F.lit(""))))
    section = F.coalesce("_id.section", "_section")
    n, own = F.col("_id.count"), F.col("_id.parcel")
    contradiction = (n == 1) & (F.size("_parcels") == 1) & own.isNotNull() & ~F.array_contains("_parcels", own)
    parcels = F.when(contradiction, F.array(own)).when((F.size("_parcels") == 0) & own.isNotNull(), F.array(own)).otherwise(F.col("_parcels"))
    anchor = F.coalesce(F.nullif(F.regexp_extract("_name", ANCHOR, 1), F.lit("")), F.nullif(F.regexp_extract("_cell", ANCHOR, 1), F.lit("")))
    second = F.nullif(F.regexp_extract("_name", "及[^及]*第([一二三四五六七八九十]+)次[^及]*$", 1), F.lit(""))
    tracks = land.tracks(F.col("_name"))
    listed = lambda *cases: F.array_compact(F.array(*[F.when(c, F.lit(t)) for c, t in cases]))
    fixes = listed(
        (F.col("_typo").isNotNull(), "district typo"),
        (F.col("_moved"), "land recovered from name"),
        (F.col("_plan") != F.col("_folded"), "plan wording"),
        (F.col("_plan").contains("都市更新計畫") & ~F.col("_plan").contains("事業計畫"), "plan word inserted"),
        (contradiction, "single parcel from name"),
    )
    flags = listed(
        (F.col("_iso").isNull(), "date not read"),
        (F.col("_dland").isNotNull() & (F.col("_dland") != F.col("_district")), "district differs"),
        (F.col("_section").isNull(), "no section"),
        (F.size("_parcels") == 0, "no parcels"),
        (contradiction, "single parcel contradicts"),
        (F.col("_id.section").isNotNull() & F.col("_section").isNotNull() & (F.col("_id.section") != F.col("_section")), "section differs"),
    )
    keys = [c for c in ("raw_id", "recno", "gazette_id") if c in raw.columns]
    return r.select(
        *keys,
        F.col("_iso").alias("iso_date"),
        F.col("_district").alias("district"),
        F.col("_dland").alias("district_land"),
        F.col("_name").alias("name"),
        F.col("_raw").alias("name_raw"),
        section.alias("section"),
        F.coalesce(own, F.get("_parcels", F.lit(0))).alias("first_parcel"),
        parcels.alias("parcels"),
        land.cell_aliases(F.col("_cell")).alias("aliases"),
        land.area_section(F.col("_cell")).alias("area_section"),
        F.coalesce(n, land.declared_count(F.col("_cell")), F.nullif(F.size("_parcels"), F.lit(0))).alias("land_count"),
        land.declared_count(F.coalesce(F.nullif(F.regexp_extract("_name", "(原.*)", 1), F.lit("")), F.col("_cell"))).alias("orig_count"),
        F.coalesce(anchor, F.lit("")).alias("named_anchor"),
        F.regexp_extract("_name", r"^(擬訂|變更(?:\(第[一二三四五六七八九十]+次\))?)", 1).alias("stage"),
        land.stage_index(F.col("_name")).alias("stage_index"),
        tracks.alias("track"),
        F.when(tracks.contains("、"), land.stage_index(F.substring_index("_name", "及", 1))).alias("stage_plan"),
        F.when(tracks.contains("、"), F.coalesce(land.cn_to_int(second), land.stage_index(F.substring_index("_name", "及", 1)))).alias("stage_rights"),
        no_space(F.coalesce("implementer", F.lit(""))).alias("implementer"),
        no_space(F.coalesce("planner", F.lit(""))).alias("planner"),
        fixes.alias("auto_fixes"),
        flags.alias("review_flags"),
    )
