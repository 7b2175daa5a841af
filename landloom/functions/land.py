"""Names, land cells and parcels as column expressions.

Inputs are expected in NFKC form (``text.nfkc``) unless ``fold_width`` is enough. Null gives null; what a pattern
doesn't find gives null for numbers and names and an empty array for lists.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, fold_width, no_space

#: Fixed values of the register.
NUMERALS = "一二三四五六七八九"
STAGE_WORDS = ["擬訂", "變更"]
TRACKS = ["事業概要", "事業計畫", "權利變換"]
PARCEL = r"[0-9]+(?:-[0-9]+)?"
CLOSING = r"(?:地號|等[0-9]+筆|土地|\s)+$"
NAME_PATTERN = r"(?:(..區))?([^0-9區]*段(?:[^0-9]*小段)?)([0-9]+(?:-[0-9]+)?)地號(?:等([0-9]+)筆)?"
AREA_STEPS = [500, 1000, 2000, 3000]


def normalize_name(c: Column) -> Column:
    """Typo folds and no white space."""
    return F.translate(no_space(c), "劃ㄧ", "畫一")


def normalize_land(c: Column) -> Column:
    return F.translate(no_space(c), "、,，", "")


def cn_to_int(c: Column) -> Column:
    """Chinese numerals up to 99."""
    digit = lambda x: F.when(x == "", 0).otherwise(F.instr(F.lit(NUMERALS), x))
    tens, ones = F.substring_index(c, "十", 1), F.substring_index(c, "十", -1)
    return F.when(c.contains("十"), F.when(tens == "", 1).otherwise(digit(tens)) * 10 + digit(ones)).when(F.length(c) == 1, F.nullif(digit(c), F.lit(0)))


def _group(c: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))


def name_identity(name: Column) -> Column:
    """struct(district, section, parcel, count) read from a case name."""
    return F.struct(
        _group(name, NAME_PATTERN, 1).alias("district"), _group(name, NAME_PATTERN, 2).alias("section"), _group(name, NAME_PATTERN, 3).alias("parcel"), _group(name, NAME_PATTERN, 4).try_cast("int").alias("count")
    )


def stage_index(name: Column) -> Column:
    """擬訂 0, 變更 1, the N-th change N, else -1; a name without white space begins with its stage."""
    nth = _group(name, r"^變更\(第([一二三四五六七八九十]+)次\)", 1)
    return F.when(name.startswith("變更"), F.coalesce(cn_to_int(nth), F.lit(1))).when(name.startswith("擬訂"), 0).otherwise(-1)


def tracks(name: Column) -> Column:
    return F.array_join(F.array_compact(F.array(*[F.when(name.contains(t), t) for t in TRACKS])), "、")


def declared_count(c: Column) -> Column:
    return _group(c, r"等\s*([0-9]+)\s*筆", 1).try_cast("int")


def even_cell(c: Column) -> Column:
    """A land cell in half width, without line breaks or spaces; between two numbers a space is a separator and becomes 、."""
    t = F.regexp_replace(fold_width(c), rf"(?<=[0-9])[{SPACE}]+(?=[0-9])", "、")
    return no_space(t)


def parcel_tokens(land: Column) -> Column:
    """Distinct parcel numbers of a land cell: what stands between the section and the closing words.

    Bracketed notes hold no parcels of the cell, and leading zeros don't tell numbers apart.
    """
    plain = F.regexp_replace(land, r"\([^()]*\)", "")
    body = F.regexp_replace(F.regexp_replace(plain, r"^.*段", ""), CLOSING, "")
    found = F.regexp_extract_all(body, F.lit(f"({PARCEL})"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")))


def cell_aliases(land: Column) -> Column:
    """``parcel:alias`` texts of a land cell's notes on former numbers, as in 5地號(原12、13)."""
    notes = F.regexp_extract_all(land, F.lit(rf"({PARCEL}地號\(原(?:核定地號為)?[^()]+\))"), F.lit(1))
    each = F.transform(
        notes,
        lambda n: F.transform(
            F.regexp_extract_all(F.substring_index(n, "(原", -1), F.lit(f"({PARCEL})"), F.lit(1)), lambda a: F.concat(F.regexp_extract(n, f"^0*({PARCEL})", 1), F.lit(":"), a)
        ),
    )
    return F.array_distinct(F.flatten(each))


def area_section(land: Column) -> Column:
    """The lettered area a cell names, '' without one."""
    return F.regexp_extract(land, r"\(([A-D甲乙丙丁])區段\)", 1)


def has_closing(land: Column) -> Column:
    return F.trim(land).rlike(r"(?:地號|土地|筆)$")


def section_token(c: Column) -> Column:
    return _group(c, r"區([^0-9區]*段(?:[^0-9]*小段)?)", 1)


def section_key(section: Column) -> Column:
    """A section's name without the words for section and subsection and with its number as a numeral; spellings differ in these."""
    return F.translate(F.regexp_replace(section, "[段小]", ""), "123456789", NUMERALS)


#: District (optional), section, parcel and count of a searched land or a heading, without white space.
PLACE = r"(?:([^市]{2}區))?([^0-9區市]+(?:[0-9]小段)?)([0-9]+(?:-[0-9]+)?)(?:地號)?(?:等([0-9]+)筆)?"
STAGE_HEAD = r"^(擬[訂定]|變更(?:\(第[一二三四五六七八九十]+次\))?)"
STAGE_TAIL = r"\((擬[訂定]|變更(?:\(第[一二三四五六七八九十]+次\))?)\)$"
KINDS = {"概": "概要", "事": "事業計畫", "權": "權利變換"}


def place(c: Column) -> Column:
    """struct(dist, sec, first, cnt) of a searched land or a heading: the section as its key, '' where nothing is said."""
    return F.struct(
        F.regexp_extract(c, PLACE, 1).alias("dist"), section_key(F.regexp_extract(c, PLACE, 2)).alias("sec"), F.regexp_replace(F.regexp_extract(c, PLACE, 3), "^0+(?=[0-9])", "").alias("first"), _group(c, PLACE, 4).try_cast("bigint").alias("cnt")
    )


def heading_stage(name: Column) -> Column:
    """The stage a case name says at its head, or in brackets at its end; null where it says none."""
    w = F.coalesce(_group(name, STAGE_HEAD, 1), _group(name, STAGE_TAIL, 1))
    nth = F.regexp_extract(w, "第([一二三四五六七八九十]+)次", 1)
    return F.when(w.startswith("擬"), 0).when(nth != "", cn_to_int(nth)).when(w.isNotNull(), 1).cast("bigint")


def kinds(name: Column) -> Column:
    """The kinds of plan a name or track speaks of."""
    return F.array_compact(F.array(*[F.when(name.contains(w), k) for k, w in KINDS.items()]))


def land_core(district: Column, section: Column, parcel: Column, count: Column) -> Column:
    """district + section + first parcel + 地號, with the count where there is one."""
    return F.concat(F.coalesce(district, F.lit("")), section, parcel, F.lit("地號"), F.when(F.coalesce(count, F.lit(0)) > 0, F.concat(F.lit("等"), count.cast("string"), F.lit("筆"))).otherwise(""))


def main_sub(parcel: Column) -> Column:
    """Order key of a parcel: (number, sub-number, -1 without one)."""
    return F.struct(_group(parcel, r"^([0-9]+)", 1).try_cast("int").alias("main"), F.coalesce(_group(parcel, r"-([0-9]+)$", 1).try_cast("int"), F.lit(-1)).alias("sub"))


def sorted_parcels(parcels: Column) -> Column:
    keyed = F.array_sort(F.transform(parcels, lambda p: F.struct(main_sub(p).alias("k"), p.alias("p"))))
    return F.transform(keyed, lambda s: s["p"])


def padded_parcel(parcel: Column) -> Column:
    """Eight digits: number and sub-number of four each."""
    return F.concat(F.lpad(F.regexp_extract(parcel, r"^([0-9]+)", 1), 4, "0"), F.lpad(F.regexp_extract(parcel, r"-([0-9]+)$", 1), 4, "0"))


def carries_parcel(text: Column, parcel: Column) -> Column:
    """'exact' if the text has the parcel between other characters than digits, '-' and '.', 'stem' if only its number, else 'none'."""
    stem = F.substring_index(parcel, "-", 1)
    at = lambda p: F.regexp_like(text, F.concat(F.lit(r"(^|[^0-9.\-])"), p, F.lit(r"($|[^0-9\-])")))
    return F.when(at(parcel), "exact").when(at(stem), "stem").otherwise("none")


def parcel_set(parcels: Column, aliases: Column) -> Column:
    """A record's parcels with the keys and values of its ``parcel:alias`` texts."""
    return F.array_union(parcels, F.flatten(F.transform(aliases, lambda x: F.split(x, ":"))))


def record_score(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Similarity of two approvals from anchor, place, first parcel, counts and parcel sets (0 to 1).

    Each side has anchor, district, section, first, parcels, aliases, count, orig. The weights are fixed values: .35
    for the place, .2 for the first parcel (1 equal, .95 bridged by an alias, .7 held by the other), .3 for the overlap
    of the parcel sets, .1 for the counts; without parcels, or where a declared change of the count bridges the two,
    the rest is scaled to the weights that remain.
    """
    said = lambda c: F.coalesce(c, F.lit("")) != ""
    number = lambda c: F.coalesce(c, F.lit(0))
    held = [parcel_set(x["parcels"], x["aliases"]) for x in (a, b)]
    bridge = lambda x, y: F.array_contains(y["parcels"], y["first"]) & F.array_contains(y["aliases"], F.concat(y["first"], F.lit(":"), x["first"]))
    fp = F.when(said(a["first"]) & said(b["first"]), (
        F.when(a["first"] == b["first"], 1.0)
        .when(bridge(a, b) | bridge(b, a), 0.95)
        .when(F.array_contains(held[1], a["first"]) | F.array_contains(held[0], b["first"]), 0.7)
    )).otherwise(0.0)
    fp = F.coalesce(fp, F.lit(0.0))
    shrunk = (number(a["orig"]) > 0) & (number(a["orig"]) == number(b["count"])) | (number(b["orig"]) > 0) & (number(b["orig"]) == number(a["count"]))
    counted = (number(a["count"]) > 0) & (number(b["count"]) > 0)
    cnt = F.when(counted & (number(a["count"]) == number(b["count"])), 1.0).when(counted & shrunk, 0.8).otherwise(0.0)
    both = (F.size(held[0]) > 0) & (F.size(held[1]) > 0)
    jac = F.when(both, F.size(F.array_intersect(*held)) / F.size(F.array_union(*held))).otherwise(0.0)
    neither = (F.size(held[0]) == 0) & (F.size(held[1]) == 0)
    return (
        F.when(said(a["anchor"]) & (a["anchor"] == b["anchor"]), 1.0)
        .when((a["district"] != b["district"]) | (a["section"] != b["section"]), 0.0)
        .when((fp >= 0.95) & shrunk, (0.35 + 0.2 * fp + 0.1) / 0.65)
        .when(neither & (fp >= 1) & (cnt >= 1), (0.35 + 0.2 * fp + 0.1 * cnt) / 0.65)
        .otherwise(0.35 + 0.2 * fp + 0.3 * jac + 0.1 * cnt)
    )


def area_bucket(area: Column) -> Column:
    """Number of the steps 500, 1000, 2000, 3000 that an area reaches."""
    return sum((F.when(area >= s, 1).otherwise(0) for s in AREA_STEPS[1:]), F.when(area >= AREA_STEPS[0], 1).otherwise(0))


def safe_id(c: Column) -> Column:
    """An id usable as a folder name: letters of any script, digits, - and _ stay."""
    return F.regexp_replace(c, r"(?U)[^\w\-]", "_")


def case_number(c: Column) -> Column:
    """R089213-02 -> 089213."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), "^[A-Z]", ""), "-[0-9]+$", "")


def even_odd(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies inside a ring (array of [x, y]) by the even-odd rule; edges count by the half-open rule."""
    n = F.size(ring)
    crossings = F.transform(
        ring,
        lambda p, i: F.when(
            ((p[1] > y) != (F.get(ring, (i + 1) % n)[1] > y))
            & (x < (F.get(ring, (i + 1) % n)[0] - p[0]) * (y - p[1]) / F.nullif(F.get(ring, (i + 1) % n)[1] - p[1], F.lit(0.0)) + p[0]),
            1,
        ).otherwise(0),
    )
    return F.aggregate(crossings, F.lit(0), lambda a, b: a + b) % 2 == 1


def stable_flags(flags: Column) -> Column:
    """Flags without repeats, those of a case by its number first, then by text."""
    key = lambda f: F.struct(F.regexp_extract(f, "案([0-9]+)", 1).alias("case"), f.alias("f"))
    return F.transform(F.array_sort(F.transform(F.array_distinct(flags), key)), lambda s: s["f"])


def kept_fields(m: Column) -> Column:
    """A map without empty values."""
    return F.map_filter(m, lambda k, v: v.isNotNull() & (F.trim(v) != ""))


def strip_footer(land: Column, page: Column) -> Column:
    """A cell without the page number that ran into its end: the digits after the closing word, if they are the page's number."""
    tail = F.regexp_extract(land, r"(?:地號|土地|筆)\s*([0-9]+)$", 1)
    return F.when(tail == page.cast("string"), F.regexp_replace(land, r"\s*[0-9]+$", "")).otherwise(land)


def zone_marker(name: Column) -> Column:
    """Whether a name speaks of a lettered or numbered zone (A區, 甲區段, 第一期) rather than a named place."""
    return name.rlike(r"[A-Z甲乙丙丁](?:區段?|基地)(?!公所)|第[一二三四五六七八九]期")


def parse_core(core: Column) -> Column:
    """struct(district, section, parcel, count) of a land core."""
    return F.struct(
        _group(core, r"^(..區)", 1).alias("district"),
        _group(core, r"(?:區|^)([^0-9區]*段(?:[^0-9]*小段)?)[0-9]", 1).alias("section"),
        _group(core, r"([0-9]+(?:-[0-9]+)?)地號", 1).alias("parcel"),
        _group(core, r"等([0-9]+)筆", 1).try_cast("int").alias("count"),
    )


def core_similarity(a: Column, b: Column) -> Column:
    """Similarity of two parsed cores: 0 across districts or sections, else .35 + .2 + .3 for the parcel and .1 for the count."""
    same = lambda f: F.coalesce(a[f] == b[f], F.lit(False))
    return F.when(~(same("district") & same("section")), 0.0).otherwise(F.lit(0.35) + F.when(same("parcel"), 0.5).otherwise(0.0) + F.when(same("count"), 0.1).otherwise(0.0))


def land_number(c: Column) -> Column:
    """struct(section, main, sub) of a permit's land text; numbers without leading zeros, full width folded."""
    t = no_space(fold_width(c))
    number = lambda i: _group(t, r"段(?:[^0-9]*小段)?0*([0-9]+)(?:-0*([0-9]+))?(?:地號)?$", i)
    return F.struct(_group(t, r"^(.*段(?:[^0-9]*小段)?)", 1).alias("section"), number(1).alias("main"), number(2).alias("sub"))
