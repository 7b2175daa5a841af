from landloom.llm.truncation import condition, cut_shares, open_structure, truncated

FIELDS = {"land": "land", "name": "name", "date": "date"}


def test_automaton():
    for text, want in [("a(b[c]", "("), ("「x", "「"), ('say "x', '"'), ("a)b", ""), ("<b>x", "<b>"), ("<b>x</b><br/>", ""), ("a <im", "<"), ("x\\u00", "escape"), ("50%E", "escape"), ("a &am", "escape"), ("(a)(b)", "")]:
        assert open_structure(text) == want, text


def test_conditions():
    closed = ["松濤段1、2地號等9筆土地", "松濤段1地號", "松濤段1等2筆", "松濤段1、2地號土地 "]
    inside = ["松濤段1、2地", "松濤段1、2、", "松濤段", "松濤段1、2地號等9", "松濤段25、25-4、2", "松濤段1、2地號等9筆土", "臺北市中"]
    assert {condition(x, "land") for x in closed} == {"closed"} and {condition(x, "land") for x in inside} == {"inside"}
    assert condition("松濤段1、2", "land") == "bare" and condition("松濤段1、2(部", "land") == "open" and condition("松濤段1、�", "land") == "replaced"
    assert condition("擬訂案", "name") == condition("擬訂事業計劃", "name") == condition("變更案（修正版）", "name") == "closed"
    assert condition("變更(第二次)", "name") == "bare" and condition("變更案(修", "name") == "open" and condition("擬訂事業計...", "name") == condition("擬訂事業計…", "name") == "replaced"
    whole = ["115/8/11", "20080301", "1238734235", "Nov 2, 2014 1:31:12 AM PST", "110/13/5", "99/2/30", "2015-02-19T00:28:33+08:00", "0891121"]
    assert {condition(x, "date") for x in whole} == {"closed"}
    cut = ["2003/1/", " 2006/0", "2001-06", "104/", "107.", "99/3 ", "中華民國九十年", "民國97年03月", "Nov 6,", "105年10月", "2008-01-04T1", "2008030"]
    assert {condition(x, "date") for x in cut} == {"inside"}
    assert {condition(x, "date") for x in (None, "", "  ", "待核定", "—", "未定")} == {None}


def test_baseline_tells_short_forms_from_cut_ones(spark):
    rows = [(i, 1, "松濤段1地號", "擬訂案", "115/8/11", "clash") for i in range(20)] + [(i, 2, "松濤段1、2", None, "", "clash") for i in range(20, 30)]
    rows += [(50, 1, "松濤段1、2", "擬訂", "115/8/", "c"), (51, 2, "松濤段1、", "擬訂案", None, "c"), (52, None, "松濤段1、", "x" * 100_000 + "案", None, "c"), (50, 1, "松濤段1、2", "擬訂", "115/8/", "c")]
    df = spark.createDataFrame(rows, "raw_id bigint, feed_id int, land string, name string, date string, field string")
    t = truncated(df, "raw_id", "feed_id", FIELDS)
    got = sorted((r.raw_id, r.field) for r in t.where("cut").collect())
    assert got == [(50, "date")] * 2 + [(50, "land")] * 2 + [(50, "name")] * 2 + [(51, "land"), (52, "land")]
    share = {(r.feed_id, r.field): r.share for r in cut_shares(t, "feed_id").collect()}
    assert share[1, "land"] == 2 / 22 and share[2, "land"] == 1 / 11
    assert truncated(df.limit(0), "raw_id", "feed_id", FIELDS).count() == 0


def test_stack_automaton():
    closed = ["擬訂(甲)案", '5" 案', "50%", "a < b", "a && b", "<b>x</b>", "<br>", "<br/>x", "<p><b>x</b></p>", "&amp;", r"\u4e00", r"\n", "%E4%B8", 'say "x"', "it’s", "x) y", "〈擬〉", "AT&T x", "<>", r"\x41", "&#20013;"]
    assert {t: open_structure(t) for t in closed if open_structure(t)} == {}
    opened = {"擬訂“大安": "“", "〈擬訂案": "〈", "<b>x": "<b>", "<p><b>x</b>": "<p>", "x <a hre": "<", "&am": "escape", r"\u4e0": "escape", "\\": "escape", "%E4%B": "escape", 'a "b (c)': '"', "((a)": "(", '"a "b" c': '"', r"\x4": "escape", "&#200": "escape", "a (b “c”": "("}
    assert {t: open_structure(t) for t in opened} == opened
