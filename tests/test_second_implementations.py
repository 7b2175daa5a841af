"""Queries that have no SQL, held against a second implementation over whole tables."""

import difflib
import os
import re
import unicodedata
from collections import Counter
from datetime import date

import pytest

import __spark_entry__ as entry
from landloom.functions.moments import day_on
from landloom.runtime import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def rows(spark, name):
    return [r.asDict() for r in table(spark, SF, name).collect()]


def folded(s):
    return re.sub(r"\s", "", unicodedata.normalize("NFKC", s or ""))


def named(s):
    return folded(s).replace("劃", "畫").replace("ㄧ", "一")


def test_cleansed_records(spark):
    got = {r.raw_id: r for r in entry.queries()["cleansed_records"](spark, SF).collect()}
    raw = rows(spark, "raw_records")
    assert set(got) == {r["raw_id"] for r in raw}
    for r in raw:
        g = got[r["raw_id"]]
        m = re.fullmatch(r"(\d{1,4})/(\d{1,2})/(\d{1,2})", (r["date"] or "").strip(" "), re.ASCII)
        y, mo, d = map(int, m.groups()) if m else (0, 0, 0)
        iso = f"{y + 1911 if y < 1911 else y:04d}-{mo:02d}-{d:02d}" if m and 1 <= mo <= 12 and 1 <= d <= 31 else None
        assert g.iso_date == iso, r
        name, cell = named(r["name"]), folded(r["land"])
        if not cell:
            continue
        name = name.replace("事業換計畫", "事業計畫")
        if "都市更新計畫" in name and "事業計畫" not in name:
            name = name.replace("都市更新計畫", "都市更新事業計畫")
        assert g.name == name
        stage = re.match(r"(擬訂|變更(?:\(第([一二三四五六七八九])次\))?)", name)
        nth = -1 if not stage else 0 if stage[1] == "擬訂" else "一二三四五六七八九".index(stage[2]) + 1 if stage[2] else 1
        assert (g.stage, g.stage_index) == (stage[1] if stage else "", nth)
        assert g.track == "、".join(t for t in ("事業概要", "事業計畫", "權利變換") if t in name)
        who = re.search(r"(?:(..區))?([^0-9區]*段(?:[^0-9]*小段)?)([0-9]+(?:-[0-9]+)?)地號(?:等([0-9]+)筆)?", name)
        plain = re.sub(r"\([^()]*\)", "", cell)
        body = re.sub(r"(?:地號|等[0-9]+筆|土地)+$", "", re.sub("^.*段", "", plain))
        parcels = list(dict.fromkeys(re.sub("^0+(?=[0-9])", "", p) for p in re.findall("[0-9]+(?:-[0-9]+)?", body)))
        section = re.search(r"區([^0-9區]*段(?:[^0-9]*小段)?)", cell)
        assert g.section == (who[2] if who and who[2] else section[1] if section else None)
        own, n = (who[3], int(who[4]) if who[4] else None) if who else (None, None)
        if n == 1 and len(parcels) == 1 and own not in parcels:
            assert "single parcel contradicts" in g.review_flags
            parcels = [own]
        parcels = parcels or ([own] if own else [])
        assert g.parcels == "|".join(parcels) and g.first_parcel == (own or (parcels[0] if parcels else None))
        count = re.search("等([0-9]+)筆", cell)
        assert g.land_count == (n or (int(count[1]) if count else None) or len(parcels) or None) or n is None
        assert ("date not read" in g.review_flags) == (iso is None) and ("no parcels" in g.review_flags) == (not re.findall("[0-9]+", body))


@pytest.fixture(scope="module")
def printed(spark):
    """The first print of each record number."""
    out = {}
    for r in sorted(rows(spark, "clean_records"), key=lambda r: r["clean_id"]):
        if r["recno"] is not None:
            out.setdefault(r["recno"], r)
    return out


def test_name_similarity(spark, printed):
    unit = lambda r: (r["district"] or "", r["section"], r["first_parcel"])
    stage = lambda r: -1 if r["stage_index"] is None else r["stage_index"]
    known = [r for r in printed.values() if r["section"] and r["first_parcel"]]
    want = {}
    for a in known:
        for b in known:
            if unit(a) == unit(b) and stage(b) == stage(a) + 1:
                ok = a["name"] is not None and b["name"] is not None
                want[a["recno"], b["recno"]] = round(difflib.SequenceMatcher(None, a["name"], b["name"]).ratio(), 9) if ok else None
    got = {(r.recno, r.next): None if r.ratio is None else round(r.ratio, 9) for r in entry.queries()["name_similarity"](spark, SF).collect()}
    assert got == want and want


def test_release_families_matched(spark, printed):
    families = {}
    for r in printed.values():
        if r["section"] and r["first_parcel"]:
            families.setdefault((r["district"] or "", r["section"], r["first_parcel"]), []).append(r["recno"])
    scored = []
    for p in rows(spark, "projects"):
        for f in families.values():
            if n := len(set(f) & set(p["member_recnos"] or [])):
                scored.append((-n, p["anchor_recno"], min(f)))
    taken, left, right = set(), set(), set()
    for n, a, f in sorted(scored):
        if a not in left and f not in right:
            taken.add((a, f, -n))
            left.add(a)
            right.add(f)
    rest_p = [p for p in rows(spark, "projects") if p["anchor_recno"] not in left]
    rest_f = {u: min(f) for u, f in families.items() if min(f) not in right}
    at = lambda p: (p["district"], p["section"], re.search("([0-9]+(?:-[0-9]+)?)地號", folded(p["land_core"]))[1])
    for p in rest_p:
        f = rest_f.get(at(p))
        if f is not None and sum(at(q) == at(p) for q in rest_p) == 1:
            left.add(p["anchor_recno"])
            right.add(f)
            taken.add((p["anchor_recno"], f, 0))
    got = list(entry.queries()["release_families_matched"](spark, SF).collect())
    assert {(r.project, r.family, r.votes) for r in got if r.how in ("members", "place")} == taken and taken
    assert sorted(r.project for r in got if r.how == "lost") == sorted(p["anchor_recno"] for p in rows(spark, "projects") if p["anchor_recno"] not in left)
    assert sorted(r.family for r in got if r.how == "born") == sorted(min(f) for f in families.values() if min(f) not in right)


def test_row_recovery(spark):
    zones = {r["feed_id"]: r["zone"] for r in rows(spark, "feeds")}
    place = re.compile(r"(?:([^市]{2}區))?([^0-9區市]+(?:[0-9]小段)?)([0-9]+(?:-[0-9]+)?)(?:地號)?(?:等([0-9]+)筆)?")

    def read(name):
        n = named(name)
        m = place.search(re.sub(r"^(擬[訂定]|變更(?:\(第[一二三四五六七八九十]+次\))?)", "", n))
        key = lambda s: re.sub("[段小]", "", s).translate(str.maketrans("123456789", "一二三四五六七八九"))
        return (n, m[1] or "", key(m[2]), re.sub("^0+(?=[0-9])", "", m[3]), int(m[4]) if m[4] else None) if m else None

    cases = []
    for s in rows(spark, "search_results"):
        day = day_on(s["chk_date"], None)
        if s["status"] == "resolved" and s["case_name"] and day and (p := read(s["case_name"])) and p[4] is not None and p[2]:
            cases.append((s["search_id"], *p, date.fromisoformat(day)))
    want = set()
    for r in rows(spark, "raw_records"):
        day = day_on(r["date"], zones.get(r["feed_id"]))
        land = folded(r["land"])
        if not day or r["name"] is None or r["land"] is not None and re.search("(?:地號|土地|筆)$", land) or not (p := read(r["name"])) or p[4] is None or not p[2]:
            continue
        hits = []
        for sid, nm, dist, sec, _, cnt, at in cases:
            off = abs((at - date.fromisoformat(day)).days)
            if sec == p[2] and cnt == p[4] and off <= 1 and dist in ("", p[1]):
                held = p[3] + "地號" in nm
                if held or difflib.SequenceMatcher(None, p[0], nm).ratio() >= 0.7:
                    hits.append((sid, off, not held))
        best = [h for h in hits if h[1] == min(x[1] for x in hits)]
        want |= {(r["raw_id"], sid, "beside" if off else "exact", alike, len(best) > 1) for sid, off, alike in best}
    got = {(r.raw_id, r.search_id, r.day, r.alike_only, r.several) for r in entry.queries()["row_recovery"](spark, SF).collect()}
    assert got == want


def test_review_figures(spark):
    rows_ = entry.queries()["cleansed_records"](spark, SF).collect()
    want = Counter((k, x) for r in rows_ for k, f in (("fix", r.auto_fixes), ("flag", r.review_flags)) for x in f.split("|") if x)
    assert {(r.kind, r.label): r.n for r in entry.queries()["review_figures"](spark, SF).collect()} == want and want
