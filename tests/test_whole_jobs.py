"""Queries on small tables of their own: every row takes part, whatever its form."""

import os

import pytest

import __spark_entry__ as entry
from landloom.functions.moments import day_on
from landloom.operators.matching import one_to_one

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture()
def run(spark, tmp_path):
    """Runs a query on the given rows; what a row doesn't name is null."""

    def go(query, **tables):
        for name, given in tables.items():
            schema = spark.read.parquet(f"{SF}/{name}.parquet").schema
            rows = [tuple(r.get(c) for c in schema.names) for r in given]
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet", mode="overwrite")
        return sorted(map(tuple, entry.queries()[query](spark, str(tmp_path)).collect()), key=str)

    return go


FEEDS = [{"feed_id": 1, "zone": "Asia/Taipei"}, {"feed_id": 4, "zone": "America/Los_Angeles"}]


def approval(recno, day, section="松濤段一小段", feed=1, **more):
    return {"clean_id": recno, "recno": recno, "iso_date": day, "district": "大安區", "section": section, "first_parcel": "7", "parcels": "7", "feed_id": feed} | more


def case(search_id, day, **more):
    return {"search_id": search_id, "land_core": "大安區松濤段一小段7地號", "chk_date": day, "status": "resolved", "case_ids": [str(search_id)]} | more


def test_days_on_a_clock():
    assert [day_on(v, "Asia/Taipei") for v in ("108/6/8", "090.12.21", "20190608", "2019-06-07T20:00:00Z", "08 Jun 2019", "2019/2/30", "", None)] == ["2019-06-08", "2001-12-21", "2019-06-08", "2019-06-08", "2019-06-08", None, None, None]
    assert day_on("2019-06-08T01:00:00Z", "America/Los_Angeles") == "2019-06-07"
    assert day_on("2019/6/8 23:50", None) == day_on("2019-06-08T23:50:00+08:00", None) == "2019-06-08"


def test_dates_of_all_forms_match(run):
    approvals = [approval(1, "108/6/8 下午3:37"), approval(2, "20010101"), approval(3, "2019-06-09T05:00:00Z", feed=4), approval(4, "")]
    cases = [case(1, "108/6/8"), case(2, "090.01.02"), case(3, "2019/06/20"), case(4, None), case(5, "2019-06-09")]
    tables = {"feeds": FEEDS, "clean_records": approvals, "search_results": cases}
    # The approval of feed 4 falls on June 8 of its clock, so June 8 and 9 have two candidates.
    assert run("date_match_tiered", **tables) == [(2, 2, 2)]
    # Beyond the day itself the stage must agree.
    assert run("drift_range_join", **tables) == []
    named = [a | {"stage_index": i} for i, a in enumerate(approvals)]
    cases = [c | {"case_name": n} for c, n in zip(cases, ["擬訂x案", "變更x案", "x", "x", "變更(第二次)x案"])]
    assert run("drift_range_join", feeds=FEEDS, clean_records=named, search_results=cases) == [(1, 1, 0), (2, 2, 1), (5, 3, 1)]


def test_sections_of_several_districts(run):
    approvals = [approval(1, "2019-06-08"), approval(2, "2019-06-08") | {"district": "中山區"}]
    plain = {"land_core": "松濤段１小段7地號"}
    found = run("date_match_tiered", feeds=FEEDS, clean_records=approvals, search_results=[case(1, "108/6/8"), case(2, "108/6/8") | plain, case(3, "108/6/8") | {"land_core": "中山區松濤一小段 7地號"}])
    assert found == [(1, 1, 1), (3, 2, 1)]


def test_days_of_all_forms_are_recovered(run):
    heading = {"case_name": "擬訂大安區松濤段一小段7地號等2筆土地"}
    approvals = [approval(1, None, land_count=2, stage_index=0), approval(2, "108/6/1", land_count=2, stage_index=0)]
    tables = {"feeds": FEEDS, "clean_records": approvals}
    assert run("recovered_days", **tables, search_results=[case(1, "108/6/8", **heading), case(2, "108.06.08", **heading)]) == [(1, "2019-06-08")]
    assert run("recovered_days", **tables, search_results=[case(1, "2019-06-08", **heading), case(2, "108/6/9", **heading)]) == []


def test_mistyped_and_cut_lists(run):
    cells = {1: ("10|115|12", 3), 2: ("11、14", 2), 3: ("10,11", 4), 4: ("10/11/12/13", 4), 5: ("20,28,22,23", 4), 6: ("218,21", 0), 7: ("30,30-11,30-3", 3), 8: ("10", 4), 9: ("", 2)}
    first = {5: "20", 2: "11", 6: "21", 7: "30"}
    approvals = [approval(k, "2019-06-08", parcels=v, land_count=n, first_parcel=first.get(k, "10")) for k, (v, n) in cells.items()]
    approvals.append(approval(10, "2019-06-08", parcels="400,41,402", land_count=3, first_parcel="400") | {"name": "x"})
    approvals.append(approval(11, "2019-06-08", parcels="401", first_parcel="401") | {"name": "擬訂松濤段一小段401地號等1筆土地"})
    approvals.append(approval(12, "2019-06-08", parcels=None, first_parcel="60", land="大安區松濤段一小段60、61地號等2筆土地", land_count=2))
    assert run("repaired_lists", clean_records=approvals) == [
        # 115 is put right by record 2; 41 by 401 of record 11; 28 and 30-11 have no number in their place.
        (1, "10,11,12", "10,11,12"), (10, "400,401,402", "400,401,402"), (11, "401", "401"), (12, "60,61", "60,61"), (2, "11,14", "11,14"), (3, "10,11", "10,11,12,13"),
        (4, "10,11,12,13", "10,11,12,13"), (5, "20,28,22,23", "20,22,23,28"), (6, "218,21", None), (7, "30,30-11,30-3", "30,30-3,30-11"), (8, "10", "10,11,12,13"),
    ]


def test_gaps_of_wide_spans(run):
    held = {1: ["1", "3"], 2: ["5", "2510", "2508"], 3: ["7", "8"]}
    permits = [{"permit_id": k, "permit_no": str(k), "parcels": [("大安區", "松濤段", n) for n in v]} for k, v in held.items()]
    assert run("parcel_gaps", permit_records=permits) == [(1, "松濤段", 2, 2), (2, "松濤段", 2509, 2509), (2, "松濤段", 6, 2507)]


def test_completion_closes_the_declared_count(run):
    name = "擬訂臺北市大安區松濤段一小段{}地號等{}筆土地都市更新事業計畫案"
    cuts = {1: ("1、2", "1", 4), 2: ("1、2、3", "1", 9), 3: ("1", "1", 3), 4: ("", "5", 2), 5: ("1、2、1", "1", 4), 6: ("５,　６", "5", "３")}
    raw = [{"raw_id": k, "district": "大安區", "name": name.format(f, n), "land": f"臺北市大安區松濤段一小段{x}"} for k, (x, f, n) in cuts.items()]
    raw.append({"raw_id": 7, "district": None, "name": name.format("1", 3), "land": "大安區松濤段一小段1、"})
    lands = ["大安區松濤段一小段1、2、11地號等3筆土地", "臺北市大安區松濤段一小段1、2、3、12地號等4筆土地", "臺北市大安區松濤段二小段1、2、3、4地號等4筆土地", "臺北市大安區松濤段一小段5、6地號等2筆土地", "臺北市大安區松濤段一小段5、6、7(東側,1/2)地號等3筆土地", "臺北市大安區松濤段一小段8、9地號等2筆土地"]
    raw += [{"raw_id": 10 + k, "district": "大安區", "land": x} for k, x in enumerate(lands[:4])]
    clean = [{"clean_id": 1, "district": "大安區", "land": lands[4]}]
    release = [{"release_row": 1, "district": "大安區", "land": lands[5]}]
    want = [(1, lands[1]), (3, lands[0]), (4, lands[3]), (6, lands[4]), (7, lands[0])]
    assert run("prefix_completion", raw_records=raw, clean_records=clean, release_records=release) == want


def test_aliases_by_parcels_and_claims(run):
    def rows(release, units):
        return [{"release_row": hash((release, i)) % 10**9, "release_id": release, "district": "大安區", "name": n, "land": f"大安區松濤段一小段{p}地號"} for i, (n, p) in enumerate(units)]

    old = [("甲", "1、2"), ("乙", "20、21、22"), ("丙", "30、31"), ("丁", "40、41"), ("戊", "50"), ("己", "61"), ("己", "62"), ("庚", "70、71")]
    new = [("甲", "1、2"), ("乙改", "19、20、21、22"), ("丙改", "29、31、32、33"), ("丁改", "39、40"), ("戊改", "49、50"), ("戊又", "48、50"), ("己", "60"), ("庚改", "69\n70\n71")]
    got = run("unit_aliases", release_records=rows("r1", old) + rows("r2", new))
    unit = lambda n: f"大安區|松濤段一小段|{n}"
    # 2 of 4 and 1 of 3 parcels: 20 and 70 overlap enough, 30 and 40 do not; 50 has two equal successors; 61 comes before 62.
    want = {(1, unit(a), unit(b)) for a, b in ((1, 1), (20, 19), (61, 60), (70, 69))}
    assert set(got) == want and len(got) == len(want)


def test_cells_of_any_spacing_count(run):
    lands = ["臺北市大安區松濤段一小段1、2地號等2筆土地", "臺北市大安區\n松濤段一小段1\n2\n3地號等3筆土地", "臺北市大安區松濤段　一小段１、　２、３、４地號", None]
    rows = [{"release_row": i, "release_id": "r1", "district": "大安區", "land": x} for i, x in enumerate(lands)]
    assert run("candidate_corpus", release_records=rows) == [("r1", "大安區", "松濤段一小段", 3, 4), ("r1", "大安區", None, 1, 0)]
    raw = [{"raw_id": i, "land": x, "name": "x"} for i, x in enumerate(lands)]
    assert run("land_cell_counts", raw_records=raw) == [(0, 2, True, None), (1, 3, True, None), (2, 4, True, None)]


def test_pairing_says_when_pairs_remain(spark):
    chain = spark.createDataFrame([(i, j, 1) for i in range(5) for j in (i, i + 1)], "l int, r int, s int")
    assert sorted(map(tuple, one_to_one(chain, "l", "r", "s").collect())) == [(i, i, 1) for i in range(5)]
    assert one_to_one(chain, "l", "r", "s", max_rounds=5).count() == 5
    with pytest.raises(RuntimeError):
        one_to_one(chain, "l", "r", "s", max_rounds=3)
