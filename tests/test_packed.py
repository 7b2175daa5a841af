from landloom.operators.packed import unpack

FORMS = {"land": "land", "parcels": "items", "aliases": "aliases"}


def found(spark, rows, extra=""):
    df = spark.createDataFrame(rows, "clean_id bigint, land string, parcels string, aliases string, field string, pos int, value string")
    out = {}
    for r in unpack(df, "clean_id", FORMS).collect():
        out.setdefault((r.clean_id, r.field), []).append((r.pos, r.value))
    return {k: [v for _, v in sorted(x)] for k, x in out.items()}


def row(i, land=None, parcels=None, aliases=None):
    return (i, land, parcels, aliases, "clash", 9, "clash")


def test_delimiters_quotes_and_notes(spark):
    got = found(
        spark,
        [
            row(1, '臺北市大安區芷棧段三小段302、"306(原|舊編)"、307地號等9筆土地', '"109"、"109-6(東側,臨路)"', "253:253-32,253-30"),
            row(2, "台北市 大安區 松濤段一小段 5393、5393-5地號土地", '["755", "755-4"]', '{"5393-5": ["5393-34", "5393-23"], "5393": ["5393-17"]}'),
            row(3, "芷洲段一小段23　26及28，30;、地號等12筆", "２８|｜,, 29 (部分) \n", '"34:34-18,34-21";"34-4:34-27"'),
            row(4, "31||35||35-6|地號等40筆土地", "204|", "74->74-34/74-38 | 70->70-36"),
            row(5, "松濤段一小段19(A;B區段)地號", "267、", "38-2=38-35、38-14；37=37-30"),
            row(6, "松濤段一小段19-1", "1 2\t3", "23-8(23-26,23-31)、20(20-28)"),
        ],
    )
    assert got[1, "land"] == ["302", "306(原|舊編)", "307"]
    assert got[1, "parcels"] == ["109", "109-6(東側,臨路)"]
    assert got[1, "aliases"] == ["253:253-32", "253:253-30"]
    assert got[2, "land"] == ["5393", "5393-5"] and got[2, "parcels"] == ["755", "755-4"]
    assert got[2, "aliases"] == ["5393-5:5393-34", "5393-5:5393-23", "5393:5393-17"]
    assert got[3, "land"] == ["23", "26", "28", "30"] and got[3, "parcels"] == ["28", "29(部分)"]
    assert got[3, "aliases"] == ["34:34-18", "34:34-21", "34-4:34-27"]
    assert got[4, "land"] == ["31", "35", "35-6"] and got[4, "parcels"] == ["204"]
    assert got[4, "aliases"] == ["74:74-34", "74:74-38", "70:70-36"]
    assert got[5, "land"] == ["19(A;B區段)"] and got[5, "aliases"] == ["38-2:38-35", "38-2:38-14", "37:37-30"]
    assert got[6, "land"] == ["19-1"] and got[6, "parcels"] == ["1", "2", "3"] and got[6, "aliases"] == ["23-8:23-26", "23-8:23-31", "20:20-28"]


def test_placeholders_cannot_collide(spark):
    odd = "0"
    got = found(spark, [row(1, None, f'{odd}|"a|b"||c', None), row(2, None, 'say "he said ""x|y"""|z', None), row(3, None, '"open|1|(2', None)])
    assert got[1, "parcels"] == [odd, "a|b", "", "c"]
    assert got[3, "parcels"] == ['"open', "1", "(2"]


def test_nulls_empties_repeats_and_long(spark):
    long = "|".join(str(i) for i in range(20_000))
    got = found(spark, [row(1), row(2, "", " 、,; ", ""), row(3, None, long, None), row(4, None, "7|7", None), row(4, None, "7|7", None)])
    assert (1, "land") not in got and (2, "parcels") not in got
    assert len(got[3, "parcels"]) == 20_000 and got[3, "parcels"][-1] == "19999"
    assert got[4, "parcels"] == ["7"] * 4
    assert found(spark, []) == {}


def test_quotes_protect_in_alias_cells(spark):
    got = found(spark, [row(1, None, None, '5:"5-1,東"、5-2;"6:6-1,6-2";"7"->"7-1/2"'), row(2, None, None, '{"5": ["5-1", "5-2"], "6": ["a:b"]}')])
    assert got[1, "aliases"] == ["5:5-1,東", "5:5-2", "6:6-1", "6:6-2", "7:7-1/2"]
    assert got[2, "aliases"][:2] == ["5:5-1", "5:5-2"]
