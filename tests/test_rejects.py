from landloom.operators.rejects import parse_lines, records, rejects

GOOD = ["7", "115/8/11", "大安區", "擬訂案", "松濤段1地號", "甲", "乙", "", "2026-01-08"]


def run(spark, lines, districts=("大安區", None)):
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(lines)], "line_id bigint, line string, reasons string")
    parsed = parse_lines(df, spark.createDataFrame([(d,) for d in districts], "district string"))
    return {r.line_id: r.parse_error for r in rejects(parsed).collect()}, {r.line_id: r for r in records(parsed).collect()}


def line(**cells):
    names = ["recno", "date", "district", "name", "land", "implementer", "planner", "parse_error", "gazette_id"]
    return "\t".join(cells.get(n, g) for n, g in zip(names, GOOD))


def test_every_reason(spark):
    lines = [
        "\t".join(GOOD),
        "\t".join(f'"{x}"' for x in GOOD) + "\r",
        line(land='"松濤段1\t2\n3 ""x"""'),
        line(name='say "hi"'),
        "\t".join(GOOD[:8]),
        "\t".join([*GOOD, "x"]),
        "",
        None,
        line(planner='"open'),
        line(name='"ab"c'),
        line(name="a\nb"),
        line(recno="0"),
        line(recno="１"),
        line(recno="5a"),
        line(date="99/2/29"),
        line(date="2000/2/29"),
        line(date="115/13/1"),
        line(district="大同區"),
        line(name=" 　", land=""),
        line(gazette_id="20260108"),
        line(gazette_id="2026-02-30", recno="-1"),
        line(implementer="", planner="", parse_error="實施者缺漏"),
        line(land="長" * 300_000),
    ]
    bad, good = run(spark, lines)
    assert set(good) == {0, 1, 2, 3, 15, 21, 22}
    assert good[0].recno == 7 and good[2].land == '松濤段1\t2\n3 "x"' and good[21].parse_error == "實施者缺漏" and good[1].gazette_id == "2026-01-08"
    assert bad == {
        4: "columns: 8", 5: "columns: 10", 6: "columns: 1", 7: "columns: 1", 8: "quoting", 9: "quoting", 10: "quoting", 11: "recno", 12: "recno", 13: "recno",
        14: "date", 16: "date", 17: "district", 18: "name；land", 19: "gazette_id", 20: "recno；gazette_id",
    }


def test_only_rejects_and_empty_tables(spark):
    assert run(spark, []) == ({}, {})
    assert run(spark, ["x", "y\tz"])[0] == {0: "columns: 1", 1: "columns: 2"}
    bad, good = run(spark, ["\t".join(GOOD)] * 3, districts=())
    assert bad == {0: "district", 1: "district", 2: "district"} and not good
