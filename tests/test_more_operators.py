import datetime

from pyspark.sql import functions as F

from landloom.functions import land
from landloom.operators import matching as m
from landloom.operators.intervals import merged, uncovered
from landloom.streaming import intake


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_intervals(spark):
    seg = spark.createDataFrame([("a", 0.0, 2.0), ("a", 1.0, 3.0), ("a", 1.0, 3.0), ("a", 4.0, 5.0), ("b", None, 9.0), ("c", 1.0, 1.0)], "k string, lo double, hi double")
    assert rows(merged(seg, ["k"])) == [("a", 0.0, 3.0), ("a", 4.0, 5.0), ("c", 1.0, 1.0)]
    assert rows(merged(seg, ["k"], 1.0).where("k = 'a'")) == [("a", 0.0, 5.0)]
    spans = spark.createDataFrame([("a", 0.5, 3.0, "x"), ("a", 2.0, 4.5, "y"), ("b", 1.0, 2.0, "z"), ("q", 1.0, 2.0, "w")], "k string, s_lo double, s_hi double, lo string")
    assert [r[3] for r in rows(uncovered(spans, seg, ["k"]))] == ["y", "z", "w"]
    assert [r[3] for r in rows(uncovered(spans, seg, ["k"], 1.0))] == ["z", "w"]
    assert uncovered(spans.limit(0), seg, ["k"]).count() == 0


def test_cores_and_cells(spark):
    df = spark.createDataFrame([("大安區松濤段一小段5-1地號等3筆", "松濤段一小段5-1地號"), (None, "大安區松濤段一小段5-1地號等3筆"), ("大安區松濤段一小段5-1地號等3筆", "大安區松濤段一小段5-1地號等4筆"), ("大安區松濤段一小段5-1地號等3筆",) * 2], "a string, b string")
    got = [round(r[0], 6) for r in df.select(land.core_similarity(land.parse_core(F.col("a")), land.parse_core(F.col("b")))).collect()]
    assert got == [0.0, 0.0, 0.85, 0.95]
    assert tuple(df.select(land.parse_core(F.col("b")).alias("x")).first().x) == (None, "松濤段一小段", "5-1", None)
    cells = spark.createDataFrame([("松濤段1、2地號12", 12), ("松濤段1、2地號12", 3), ("松濤段1、12", 12), (None, 1)], "c string, p int")
    assert [r[0] for r in cells.select(land.strip_footer(F.col("c"), F.col("p"))).collect()] == ["松濤段1、2地號", "松濤段1、2地號12", "松濤段1、12", None]
    names = spark.createDataFrame([("擬訂甲區段案",), ("B區案",), ("大安區案",), ("原某某國宅",), (None,)], "n string")
    assert [r[0] for r in names.select(land.zone_marker(F.col("n"))).collect()] == [True, True, False, False, None]
    lands = spark.createDataFrame([("松濤段一小段００１２-0003",), ("松濤段12地號",), ("x",), (None,)], "n string")
    assert [tuple(r[0]) for r in lands.select(land.land_number(F.col("n"))).collect()] == [("松濤段一小段", "12", "3"), ("松濤段", "12", None), (None, None, None), (None, None, None)]


def test_merge_and_member_changes(spark):
    a = spark.createDataFrame([(1, "x", ["p", "q"]), (2, None, None)], "k int, v string, ids array<string>")
    b = spark.createDataFrame([(1, "y", ["q", "r"]), (2, "z", ["s"]), (3, "w", None)], "k int, v string, ids array<string>")
    assert rows(m.coalesce_merge(a, b, ["k"])) == [(1, "x", ["p", "q", "r"]), (2, "z", ["s"]), (3, "w", [])]
    old = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), ("C", 4)], "o string, r int")
    new = spark.createDataFrame([("a", 1), ("a", 2), ("a", 5), ("b", 9), ("c", 4), ("c", 4)], "n string, r int")
    pairs = spark.createDataFrame([("A", "a"), ("B", "b"), ("C", "c")], "o string, n string")
    assert rows(m.member_changes(old, new, pairs, "o", "n", "r")) == [("A", "a", 1, 0, "grew"), ("B", "b", 1, 1, "both"), ("C", "c", 0, 0, "same")]


def test_refresh_and_cooldown(spark):
    held = spark.createDataFrame([("p", "c", "approved", "1"), ("p", "c", "filed", "2"), ("p", "c", "heard", "3"), ("q", "c", "filed", "4")], "p string, c string, label string, v string")
    got = spark.createDataFrame([("p", "c", "filed", "9"), ("p", "d", "filed", "5")], "p string, c string, label string, v string")
    out = rows(intake.refresh(held, got, ["p", "c", "label"], "v", ["approved"], "label"))
    assert out == [("p", "c", "approved", "1", "withdrawn"), ("p", "c", "filed", "9", "changed"), ("p", "d", "filed", "5", "added"), ("q", "c", "filed", "4", "kept")]
    now = datetime.datetime(2026, 1, 10)
    log = spark.createDataFrame([("a", datetime.datetime(2026, 1, 9)), ("b", datetime.datetime(2026, 1, 1))], "k string, t timestamp")
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert rows(intake.due(work, log, "k", "t", now, "3 days")) == [("b",), ("c",)]
