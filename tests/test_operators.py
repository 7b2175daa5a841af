import itertools
import random

import pytest
from pyspark.sql import functions as F

from landloom.operators import families as fam
from landloom.operators import matching as m
from landloom.operators import measures, quality
from landloom.operators import publication as pub
from landloom.operators.cleanse import cleanse


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_unique_and_tiers(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, None), (None, "c")], "k int, c string")
    assert rows(m.unique_or_nothing(df, ["k"], "c")) == [(1, "a"), (None, "c")]
    t = [spark.createDataFrame(x, "k int, v int") for x in ([(1, 5)], [(1, 6), (2, 7)])]
    assert rows(m.first_tier(t, ["k"]).select("k", "v", "tier")) == [(1, 5, 1), (2, 7, 2)]


def test_dates_within_a_tolerance(spark):
    a = spark.sql("select * from values ('p', 1, date'2020-01-05'), ('p', 2, date'2020-02-05'), ('p', 3, date'2020-03-05'), ('q', 4, null) t(g, l, d)")
    b = spark.sql("select * from values ('p', 10, date'2020-01-05'), ('p', 11, date'2020-01-06'), ('p', 12, date'2020-02-06'), ('p', 13, date'2020-03-04'), ('p', 14, date'2020-03-06'), ('q', 15, null) t(g, r, e)")
    assert rows(m.by_date(a, b, ["g"], "l", "r", "d", "e")) == [(1, 10, 1), (2, 12, 2)]
    near = m.drift_join(a.withColumnRenamed("g", "g"), b, ["g"], "d", "e", 10).select("l", "r")
    assert rows(near) == [(1, 10), (1, 11), (2, 12), (3, 13), (3, 14)]


def test_greedy_pairing_equals_sequential(spark):
    rng = random.Random(3)
    scored = list({(rng.randint(0, 20), rng.randint(0, 20)): rng.randint(1, 5) for _ in range(120)}.items())
    taken, used_l, used_r = set(), set(), set()
    for (left, right), s in sorted(scored, key=lambda x: (-x[1], x[0])):
        if left not in used_l and right not in used_r:
            taken.add((left, right, s))
            used_l.add(left)
            used_r.add(right)
    df = spark.createDataFrame([(a, b, s) for (a, b), s in scored], "l int, r int, s int")
    assert set(map(tuple, m.one_to_one(df, "l", "r", "s").collect())) == taken
    assert m.one_to_one(df.limit(0), "l", "r", "s").count() == 0


def test_overlap_witness_gaps_successors(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c"), (3, None)], "l int, t string")
    right = spark.createDataFrame([(7, "a"), (7, "b"), (8, "b"), (9, "c"), (10, "c")], "r int, t string")
    o = m.best_overlap(left, right, "l", "r", ["t"])
    assert rows(o) == [(1, 7, 2), (2, 9, 1), (2, 10, 1)] or sorted(rows(o)) == [(1, 7, 2), (2, 9, 1), (2, 10, 1)]
    e = spark.createDataFrame([(2, 10)], "l int, r int")
    assert rows(m.single_witness(o, "l", "r", e)) == [(1, 7, "only"), (2, 10, "named")]
    assert rows(m.single_witness(o, "l", "r", e.limit(0))) == [(1, 7, "only"), (2, None, "ambiguous")]
    held = spark.createDataFrame([("x", 1), ("x", 4), ("x", 4), ("y", 5), ("y", 6)], "s string, n int")
    assert rows(m.gap_ids(held, "s", "n")) == [("x", 2), ("x", 3)]
    cases = spark.createDataFrame([("n", 1, ["d1"]), ("n", 2, ["d1", "d2"]), ("n", 3, ["d2"]), ("o", 9, ["d1"]), ("n", 0, [])], "name string, c int, e array<string>")
    assert rows(m.superseded(cases, ["name"], "c", "e")) == [(1, 2)]


def approval(recno, section="松濤段", first="1", parcels=("1", "2"), aliases=(), count=2, orig=0, anchor="", day="2020-01-01", stage=0, track="a"):
    return (recno, "大安區", section, first, list(parcels), list(aliases), count, orig, anchor, day, stage, track, anchor)


SCHEMA = "recno bigint, district string, section string, first string, parcels array<string>, aliases array<string>, count int, orig int, anchor string, day string, stage_index int, track string, area string"


def test_families(spark):
    data = [approval(1), approval(2, day="2021-01-01"), approval(3, count=9, orig=2, parcels=("1",)), approval(4, section="別段"), approval(5, first="8", parcels=("8", "9"), anchor="原甲國宅"),
            approval(6, section="別段", first="7", parcels=("7",), anchor="原甲國宅"), approval(7, first="", parcels=(), section="", count=0), approval(8, first="5", parcels=("5", "2"))]
    rec = spark.createDataFrame(data, SCHEMA)
    got = dict(map(tuple, fam.families(rec).collect()))
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8}
    f = rec.join(fam.families(rec), "recno")
    assert dict(map(tuple, fam.anchors(f).collect())) == {1: 2, 4: 4, 5: 5, 7: 7, 8: 8}
    ids = {r.family: r.project_id for r in fam.project_ids(fam.slugs(f)).collect()}
    assert ids[1] == "大安區-松濤段-1地號等2筆" and ids[7] == "未解析-7"
    assert (1, 3, 2, "revision") in rows(fam.edges(f)) or (1, 1, 3, "revision") in rows(fam.edges(f))
    assert fam.families(rec.limit(0)).count() == 0


def test_score_reads_aliases(spark):
    """The score's rules, each against the published weights."""
    score = lambda *recs: round(fam.scored_pairs(spark.createDataFrame(list(recs), SCHEMA)).first().score, 6)
    a = approval(1, first="5", parcels=("5", "6"))
    assert score(a, approval(2, first="5", parcels=("5", "6"))) == 0.95
    # The second's first parcel was the first's: bridged.
    b = approval(2, first="12", parcels=("12", "13"), aliases=("12:5", "13:6"))
    assert score(a, b) == round(0.35 + 0.2 * 0.95 + 0.3 * 2 / 4 + 0.1, 6)
    assert score(a, approval(2, first="12", parcels=("12", "13"), aliases=("13:5",))) == round(0.35 + 0.2 * 0.7 + 0.3 * 1 / 4 + 0.1, 6)
    assert score(a, approval(2, first="12", parcels=("12",), aliases=("12:5",), count=9, orig=2)) == round((0.35 + 0.2 * 0.95 + 0.1) / 0.65, 6)
    # A count is matched by a former one only where both are known.
    assert score(approval(1, first="5", parcels=("5", "7"), count=4), approval(2, first="5", parcels=("5", "8"), count=0, orig=4)) == round((0.35 + 0.2 + 0.1) / 0.65, 6)
    assert score(approval(1, first="7", parcels=("5", "7"), count=4), approval(2, first="5", parcels=("5", "8"), count=0, orig=4)) == round(0.35 + 0.14 + 0.3 / 3, 6)


def test_runs_and_marks_over_any_blocks(spark):
    rng = random.Random(4)
    data = [(rng.choice("ab") if i % 9 else None, i, rng.choice("xyz") if i % 7 else None, rng.random() < 0.1) for i in range(300)]
    df = spark.createDataFrame(data, "k string, s int, v string, m boolean")
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = {(r.k, r.island): (r.v, r.n) for r in measures.islands(df, ["k"], ["s"], "v").collect()}
        near = {r.s: r.nearest for r in measures.nearest_marked(df, ["k"], ["s"], F.col("m"), "s").collect()}
        for k in ("a", "b", None):
            own = [(s, v, m) for kk, s, v, m in data if kk == k]
            runs = [(v, len(list(g))) for v, g in itertools.groupby(x[1] for x in own)]
            assert [got.pop((k, i + 1)) for i in range(len(runs))] == runs
            for s, _, _ in own:
                above, below = [x for x, _, m in own if m and x < s], [x for x, _, m in own if m and x > s]
                assert near[s] == (above[-1] if above else below[0] if below else None)
        assert got == {}
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_gap_ranges(spark):
    held = spark.createDataFrame([("x", 1), ("x", 4), ("x", 4), ("x", 1_000_000_000), ("y", 5), ("y", None), (None, 7)], "s string, n int")
    assert rows(m.gap_ranges(held, ["s"], "n")) == [("x", 2, 3), ("x", 5, 999_999_999)]


def test_long_chain_of_labels(spark):
    n = 300
    nodes = spark.range(n).select(F.col("id").alias("recno"))
    chain = spark.createDataFrame([((i * 7) % n, ((i + 1) * 7) % n) for i in range(n - 1)], "a bigint, b bigint")
    assert {r.family for r in fam.components(nodes, chain).collect()} == {0}


def test_publication(spark):
    e = spark.createDataFrame([(1, "c", "d", "f", "x", None), (2, "c", "d", "f", "y", 1), (3, "c", "d", "g", "z", 3), (4, None, None, "f", "q", None)], "seq bigint, core string, day string, field string, to_value string, supersedes bigint")
    live = pub.effective(e)
    assert {r.seq for r in live.collect()} == {2, 3, 4}
    v = pub.field_values(live, ["core", "day"], ["f", "g"])
    rec = spark.createDataFrame([("c", "d", "a", "b", 1), ("z", None, "a", "b", 2), (None, None, "a", "b", 3)], "core string, day string, f string, g string, n int")
    assert {(r.n, r.f, r.g, r.corrected) for r in pub.apply_corrections(rec, v, ["core", "day"], ["f", "g"]).collect()} == {(1, "y", "z", True), (2, "a", "b", False), (3, "a", "b", False)}
    assert pub.unmatched(v, rec, ["core", "day"]).count() == 1
    r = spark.createDataFrame([(1, "p", "1"), (1, "p", "1"), (1, "q", "1"), (1, "r", None), (2, "p", "1"), (2, "p", "2"), (2, "s", "3"), (2, "r", None)], "k int, land string, day string")
    assert rows(pub.reconcile(r, ["land"], "day", "k")) == [(1, 1, 1, 1, 2)]


def test_measures(spark):
    f = spark.createDataFrame([(1, "a", 1, "p"), (1, "b", 2, "q"), (1, "b", 3, "r"), (2, None, 1, "p"), (2, "a", 2, "q")], "k int, v string, s int, c string")
    assert rows(measures.fold_last(f, ["k"], "v", "s", "c")) == [(1, "b", "q"), (2, "a", "q")]
    i = measures.islands(f, ["k"], ["s"], "v")
    assert rows(i.select("k", "island", "v", "n")) == [(1, 1, "a", 1), (1, 2, "b", 2), (2, 1, None, 1), (2, 2, "a", 1)]
    d = spark.sql("select 1 as k, id as pos, id as tie, date_add(date'2020-01-01', cast(-id + if(id % 5 = 0, 3, 0) as int)) as day from range(23)")
    one = rows(measures.departures(d, ["k"], "pos", "tie", "day"))
    assert rows(measures.departures(d, ["k"], "pos", "tie", "day", block=4)) == one and one[0][1] == 23 and one[0][2] == 4


@pytest.mark.parametrize("bad", [True, False])
def test_gates(spark, bad):
    df = spark.createDataFrame([(1, "a"), (2, "b" if bad else "a"), (4, None)], "n int, g string")
    assert [r.n for r in quality.missing_numbers(df, "n").collect()] == [3]
    assert quality.missing_numbers(df, "n", spark.createDataFrame([(3,)], "n int")).count() == 0
    figures = quality.figures(df.where("g is not null"), g=F.col("g") != "a")
    if bad:
        with pytest.raises(quality.GateFailed) as e:
            quality.require(figures, "tripwire")
        assert e.value.exit_code == 4
    else:
        quality.require(figures, "tripwire")
    p = quality.partition_figures(spark.createDataFrame([(1, "x"), (1, "y"), (9, "x")], "k int, g string"), "k", "g", spark.createDataFrame([(1,), (2,)], "k int")).first()
    assert (p.keys, p.bad_shared, p.bad_unknown, p.bad_missing) == (3, 1, 1, 1)


def test_cleanse(spark):
    raw = [
        (1, "115/8/11", "松化區", "擬訂臺北市松山區鏡坪段三小段159地號等113筆土地都市更新計劃案", "臺北市松山區鏡坪段三小段159、161、162地號等113筆", "甲 乙", None, "k"),
        (2, "2026/2/30", "大安區", "變更(第二次)臺北市大安區松濤段一小段9地號等1筆土地都市更新事業換計畫及權利變換計畫案", "臺北市松山區松濤段一小段８地號", "", "", "k"),
        (3, None, None, None, None, None, None, "k"),
        (4, "x", "大安區", "擬訂案臺北市大安區松濤段一小段7、8地號", "", "", "", "k"),
        (5, "1/1/1", "松山區", "原某某國宅都市更新事業計畫案", "松山區", "", "", "k"),
    ]
    out = {r.recno: r for r in cleanse(spark.createDataFrame(raw, "recno int, date string, district string, name string, land string, implementer string, planner string, section string")).collect()}
    assert out[1].district == "松山區" and out[1].auto_fixes[:1] == ["district typo"] and "plan word inserted" in out[1].auto_fixes
    assert out[1].name.endswith("都市更新事業計畫案") and out[1].parcels == ["159", "161", "162"] and out[1].land_count == 113 and out[1].implementer == "甲乙"
    assert out[2].parcels == ["9"] and {"single parcel contradicts", "district differs"} <= set(out[2].review_flags) and out[2].stage_index == 2 and out[2].iso_date == "2026-02-30"
    assert {"date not read", "no section", "no parcels"} <= set(out[3].review_flags) and out[3].land_count is None
    assert out[4].parcels == ["7", "8"] and out[4].name == "擬訂案" and "land recovered from name" in out[4].auto_fixes
    assert out[5].named_anchor == "某某國宅"


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_hot_join_equals_join(spark, how):
    from landloom.operators.skew import hot_join

    left = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 5), (3, 6), (None, 7)], "k int, v int")
    right = spark.createDataFrame([(1, 50, "x"), (2, 1, "y"), (9, 1, "z")], "k int, n int, w string")
    got = rows(hot_join(left, right, ["k"], "n", 53, how, least=10))
    want = left.join(right.drop("n"), ["k"], how)
    assert got == rows(want.select("k", "v", "w") if how == "inner" else want)
