import random

import pandas as pd
import pytest

from landloom.llm import linkage as lk

CLEAN = "clean_id bigint, recno int, iso_date string, district string, name string, land string, section string, first_parcel string, parcels string, stage_index int, unit string, confidence string"
SEARCH = "search_id bigint, land_core string, case_ids array<string>, case_name string, chk_date string, status string, unit string"
PERMIT = "permit_id bigint, permit_no string, date string, parcels array<struct<district string, section string, mono string>>, unit string"
NTH = ["擬訂", "變更", "變更(第二次)"]


def test_heading(spark):
    texts = [
        "變更岳築建設松山區鏡坪段三小段164-2地號等3筆事業計劃及權利變換計畫", "松山區鏡坪段3小段１２４地號等2筆", "鏡坪三小段124地號", "擬訂臺北市松山區鏡段坪三小段124地號", "鏡坪段三小段164地號等1筆土地事業計畫案(變更(第二次))", None, "專區"
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    h = [r.h.asDict() for r in lk.with_headings(rows, h="t").orderBy("i").collect()]
    assert h[0] == dict(dist="松山區", sec="鏡坪三", parcel="164-2", cnt=3, stage=1, track="br")
    assert h[1]["sec"] == h[2]["sec"] == h[3]["sec"] == "鏡坪三"
    assert h[4]["stage"] == 2
    assert h[5]["sec"] is None and h[6]["parcel"] is None


def test_em_separates_matches():
    rng = random.Random(1)
    rows = []
    for _ in range(4000):
        match = rng.random() < 0.3
        rows.append((match, *[0 if rng.random() < 0.1 else 3 if rng.random() < (0.9 if match else 0.1) else rng.choice([1, 2]) for _ in range(4)]))
    f = pd.DataFrame(rows, columns=["m", "a", "b", "c", "d"])
    counts = f.groupby(["a", "b", "c", "d"]).agg(n=("m", "size"), k=("m", "sum")).reset_index()
    p = lk.fit(counts, ["a", "b", "c", "d"])["confidence"]
    assert ((p > 0.5) * counts.k).sum() > 0.9 * counts.k.sum()
    assert ((p > 0.5) * counts.n).sum() < 1.15 * counts.k.sum()


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(6)
    clean, search, permits, want = [], [], [], set()
    recno = 0
    for u in range(60):
        base, dist = 100 * u + 10, ["大安區", "中山區"][u % 2]
        ps = [base, base + 1, base + 3]
        ids = []
        for s in range(1 + u % 3):
            recno += 1
            day = f"{2005 + s * 2}-0{1 + u % 9}-1{u % 9}"
            name = f"{NTH[s]}臺北市{dist}松濤段一小段{base}地號等{3 + u % 7}筆土地都市更新事業計畫案"
            copies = [recno * 10] + ([recno * 10 + 1] if rng.random() < 0.1 else [])
            for c in copies:
                clean.append((c, recno, day, dist, name, f"臺北市{dist}松濤段一小段{'、'.join(map(str, ps))}地號", "松濤段一小段", str(base), "|".join(map(str, ps)), s, "x", "y"))
            ids.append((s, day, name, copies))
        for s, day, name, copies in ids:
            if rng.random() < 0.8:
                i = len(search) + 1
                mangled = rng.choice([name, name.replace("畫", "劃"), f"松濤段一小段{base}地號等{3 + u % 7}筆都更案"])
                search.append((i, f"{dist}松濤段１小段{rng.choice(ps)}地號", [f"{93 + s:03d}00001"], mangled, day if "都更" in mangled else rng.choice([day, None]), "resolved", "z"))
                want |= {(c, "search_results", i) for c in copies}
        if u % 2:
            i = len(permits) + 1
            permits.append((i, f"{100 + i}使字第1號", "1000105", [(rng.choice([dist, None]), "松濤段一 小段", f"{p:04d}") for p in ps[:2]], "z"))
            want |= {(c, "permit_records", i) for s, day, _, cs in ids for c in cs if day < "2011-01-05"}
            permits.append((1000 + i, "100使字第2號", "1000105", [("南港區", "松濤段一小段", str(p)) for p in ps], "z"))
    search += [(9001, None, None, None, None, "error", "z"), (9002, "松濤段一小段公營住宅", [], "", "", "resolved", None)]
    permits += [(9003, None, None, None, None), (9004, "", "", [], None), (9005, "", "0000000", [(None, None, None)], None)]
    clean += [(9006, None, None, None, None, None, None, None, None, None, None, None), (9007, 1, "", "", "", "", "", "", "", None, "", "")]
    return clean, search, permits, want


def link(spark, clean, search, permits):
    c, s, p = (spark.createDataFrame(r, k) for r, k in ((clean, CLEAN), (search, SEARCH), (permits, PERMIT)))
    return lk.link_records(c, s, p).collect()


def test_finds_the_pairs(spark, world):
    *tables, want = world
    rows = link(spark, *tables)
    got = {(r.clean_id, r.other_table, r.other_id) for r in rows}
    assert len(got) == len(rows) and all(0 <= r.confidence <= 1 for r in rows)
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(got)


def test_empty_tables(spark, world):
    clean, search, permits, _ = world
    assert link(spark, [], [], []) == []
    assert link(spark, clean, [], []) == [] and link(spark, [], search, permits) == []
