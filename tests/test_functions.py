import datetime

from pyspark.sql import functions as F

from landloom.functions import dates, land
from landloom.functions.similarity import complete_list, gestalt_ratio, jaccard, repair_order, vertex_fraction
from landloom.functions.text import nfkc, no_space


def values(spark, expr, rows, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_dates(spark):
    assert values(spark, dates.to_iso, ["115/8/27", "2026/2/30", " 87/1/9 ", "115/13/1", "115/8", None, ""]) == ["2026-08-27", "2026-02-30", "1998-01-09", None, None, None, None]
    assert values(spark, dates.calendar_of, ["115/8/27", "2026/2/3", "x", None]) == ["roc", "gregorian", None, None]
    assert values(spark, dates.roc_compact, ["0891121", "１１５０８２４", "870230", "0000000", "9991231", None]) == ["2000-11-21", "2026-08-24", None, None, None, None]
    assert values(spark, dates.padded, ["115/8/7", "2026-1-2T10:00", "x", None]) == ["115-08-07", "2026-01-02", None, None]
    assert values(spark, lambda c: dates.shift(c, -10), ["2026-01-05", "2026-02-30", None]) == ["2025-12-26", None, None]
    shown = values(spark, lambda c: dates.display_day(c, F.lit("2026-01-01").cast("date")), ["107.02.08", "1994-01-01", "2026-05-01", "2025/3/4", None])
    assert shown == [datetime.date(2018, 2, 8), None, None, datetime.date(2025, 3, 4), None]
    df = spark.createDataFrame([("2020-01-02", "2020-01-02", None), ("2020-01-02", None, "2020-01-02"), ("2020-01-02", "2020-01-03", None), ("2020-01-02", None, "2020-01-01"), ("2020-01-02", None, None), (None, None, None)], "w string, a string, b string")
    assert [r[0] for r in df.select(dates.closes(F.col("w"), F.col("a"), F.col("b"))).collect()] == ["field1", "field2", "field1_off_by_one", "field2_off_by_one", "none", "none"]


def test_land_and_names(spark):
    assert values(spark, land.cn_to_int, ["一", "十", "十二", "二十", "九十九", "x", None]) == [1, 10, 12, 20, 99, None, None]
    name = "變更(第十二次)臺北市大安區芷棧段三小段302-1地號等9筆土地都市更新事業計畫及權利變換計畫案"
    got = values(spark, lambda c: F.struct(land.name_identity(c).alias("n"), land.stage_index(c).alias("s"), land.tracks(c).alias("t")), [name, "擬訂案", None])
    assert tuple(got[0].n) == ("大安區", "芷棧段三小段", "302-1", 9) and (got[0].s, got[0].t) == (12, "事業計畫、權利變換")
    assert got[1].s == 0 and got[1].t == "" and tuple(got[1].n) == (None, None, None, None)
    assert values(spark, land.parcel_tokens, ["臺北市大安區芷棧段三小段302、302-1、302地號等9筆土地", "", None]) == [["302", "302-1"], [], None]
    assert values(spark, land.parcel_tokens, ["松濤段5地號(原12、13)、06地號等2筆土地", "松濤段一小段7(東側,1/2)、8(B區段)"]) == [["5", "6"], ["7", "8"]]
    assert values(spark, land.cell_aliases, ["松濤段5地號(原12、13)、06地號(原核定地號為7-1)等2筆土地", "松濤段5地號", None]) == [["5:12", "5:13", "6:7-1"], [], None]
    assert values(spark, land.area_section, ["松濤段5地號(B區段)", "x"]) == ["B", ""]
    assert values(spark, land.stage_index, ["變更(第二次)x", "變更x", "擬訂x", "x變更", "x(變更(第二次))"]) == [2, 1, 0, -1, -1]
    assert values(spark, land.heading_stage, ["x案(變更(第二次))", "擬定x", "x", None]) == [2, 0, None, None]
    at = values(spark, lambda c: land.place(c), ["臺北市大安區松濤段1小段07-2地號等3筆", "杉洲三小段590地號", "x"])
    assert [tuple(p) for p in at] == [("大安區", "松濤一", "7-2", 3), ("", "杉洲三", "590", None), ("", "", "", None)]
    assert values(spark, land.normalize_land, [" 松濤段1、2 ,3，", None]) == ["松濤段123", None]
    assert values(spark, land.sorted_parcels, [["10", "2-10", "2", "2-9"], []], "array<string>") == [["2", "2-9", "2-10", "10"], []]
    assert values(spark, land.padded_parcel, ["30-2", "7", None]) == ["00300002", "00070000", None]
    assert values(spark, lambda c: land.carries_parcel(c, F.lit("30-2")), ["段30-2地號", "段30地號", "段130-2地號", "段30-21", None]) == ["exact", "stem", "none", "none", "none"]
    assert values(spark, land.safe_id, ["大安區-松濤段/1 x"]) == ["大安區-松濤段_1_x"] and values(spark, land.case_number, ["R089213-02", "089213"]) == ["089213", "089213"]
    assert values(spark, land.area_bucket, [0.0, 500.0, 2999.0, 9e9], "double") == [0, 1, 3, 4]
    assert values(spark, land.stable_flags, [["案12 b", "x", "案11 c", "x"], None], "array<string>") == [["x", "案11 c", "案12 b"], None]
    square = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in ((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0))])
    assert values(spark, lambda c: land.even_odd(c, F.lit(2.0), square), [2.0, 5.0, -1.0], "double") == [True, False, False]


def test_text_and_similarity(spark):
    assert values(spark, nfkc, ["ＡＢ１､", "", None, "plain"]) == ["AB1、", "", None, "plain"]
    assert values(spark, no_space, [" a　b\n c\t", None]) == ["abc", None]
    df = spark.createDataFrame([("abcd", "bcde"), (None, "x"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(gestalt_ratio("a", "b")).collect()] == [0.75, None, 1.0]
    assert values(spark, lambda c: jaccard(c, F.array(F.lit("a"))), [["a", "b"], [], None], "array<string>") == [0.5, 0.0, None]
    lists = [["10", "115", "12"], ["10", "191", "20"], ["10", "99", "12"], ["10", "11", "12"], ["1"], None]
    assert values(spark, repair_order, lists, "array<string>") == [["10", "11", "12"], *lists[1:]]
    whole = lambda c: complete_list(c, F.array(*map(F.lit, ["1", "2", "3", "4"])), F.lit(4))
    assert values(spark, whole, [["1", "2"], ["1", "9"], [], ["1", "4"]], "array<string>") == [["1", "2", "3", "4"], None, None, None]
    box = "array<array<array<double>>>"
    df = spark.createDataFrame([([[[1.0, 1.0], [9.0, 9.0]]], [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]]]), (None, [])], f"p {box}, w {box}")
    assert [r[0] for r in df.select(vertex_fraction("p", "w")).collect()] == [0.5, None]
