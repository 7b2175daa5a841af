import datetime

from pyspark.sql import functions as F

from landloom.sources import readers, sinks
from landloom.streaming import intake


def test_tsv_round_trip(spark, tmp_path):
    rows = [("1", ["a", "b-1"], {"a": ["a-1", "a-2"], "b": ["b-9"]}, 'say "hi"\tx', None, True), ("2", [], {}, "", "line\nbreak", False)]
    df = spark.createDataFrame(rows, "recno string, parcels array<string>, aliases map<string,array<string>>, name string, note string, is_current boolean")
    sinks.write_tsv(df, str(tmp_path / "t"))
    back = {r.recno: r for r in readers.tsv(spark, str(tmp_path / "t"), df.columns, ("parcels",), ("aliases",)).collect()}
    assert back["1"].parcels == ["a", "b-1"] and back["1"].aliases == {"a": ["a-1", "a-2"], "b": ["b-9"]} and back["1"].name == 'say "hi"\tx' and back["1"].is_current == "true"
    assert back["2"].parcels == [] and back["2"].aliases == {} and back["2"].note == "line\nbreak"


def test_logs_payloads_and_digests(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"seq": 1, "field": "f", "to": "x"}\n{"seq": 2, "fie\n{"seq": 3, "confirm_merge": true}\n')
    assert sorted(r.seq for r in readers.jsonl(spark, str(tmp_path / "log.jsonl"), readers.LEDGER).collect()) == [1, 3]
    p = spark.createDataFrame([("p1", 5), ("p2", None)], "project_id string, anchor bigint")
    (tmp_path / "p.js").write_text(sinks.script_form(p, "2026-01-08").first().value + "\n")
    back = readers.payload(spark, str(tmp_path / "p.js"), "project_id: string, anchor: bigint")
    assert sorted(map(tuple, back.collect()), key=str) == [("2026-01-08", "p1", 5), ("2026-01-08", "p2", None)]
    assert sinks.document(p, "d").count() == 2
    v = p.select(sinks.asset_version(F.lit("2026"), F.lit(1), F.lit(2)).alias("v")).first().v
    assert v.startswith("2026-") and len(v) == 9


def test_xml_geometry_and_html(spark, tmp_path):
    (tmp_path / "p.xml").write_text("<R><Data><執照號碼>1</執照號碼><發照日期>1130823</發照日期><地段地號><地段號>松濤段1</地段號><地段號>松濤段2</地段號></地段地號></Data><Data><執照號碼>2</執照號碼></Data></R>")
    assert [(r.permit_no, r.date, r.lands) for r in readers.permit_xml(spark, str(tmp_path / "p.xml")).orderBy("permit_no").collect()] == [("1", "1130823", ["松濤段1", "松濤段2"]), ("2", None, [])]
    (tmp_path / "g.json").write_text('{"type":"FeatureCollection","features":[{"properties":{"id":7},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1]]]}},{"properties":{},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1]]],[[[5,5],[6,5],[6,6]]]]}}]}')
    g = readers.geojson(spark, str(tmp_path / "g.json")).collect()
    assert len(g) == 3 and g[0].properties == {"id": "7"} and g[0].polygon[0][1] == [1.0, 0.0]
    html = "<html><title> 案名 - 站</title><table><tr><th>項目</th><td>日期<b>x</b></td></tr></table><a href='/v/1'>看 這</a><p>12:30"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<table><td>loose")], "page_id bigint, html string")
    got = {(r.page_id, r.kind, r.n): r.cells for r in readers.html_rows(pages, "page_id", "html").collect()}
    assert got == {(1, "row", 0): ["項目", "日期x"], (1, "link", 0): ["/v/1", "看 這"]}
    one = pages.where("page_id = 1").select(readers.html_title(F.col("html")).alias("t"), readers.page_fingerprint(F.col("html")).alias("f"), readers.page_fingerprint(F.replace("html", F.lit("12:30"), F.lit("09:15"))).alias("g")).first()
    assert one.t == "案名" and one.f == one.g


def event(i, user, minute, kind="a"):
    return (i, datetime.datetime(2026, 1, 1) + datetime.timedelta(minutes=minute), user, kind, 1.0)


SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def drain(df, name, mode):
    # All there is, once: a state with a timeout would run on.
    df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.table(name)


def test_stream_equals_batch(spark, tmp_path):
    rows = [event(i, i % 3, i * 17 % 400, "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = intake.stream_files(spark, str(tmp_path / "in"), df.schema)
    key = lambda x: sorted(map(tuple, x.collect()))
    assert key(drain(intake.tumbling(stream), "w1", "complete")) == key(intake.tumbling(df))
    assert key(drain(intake.tumbling(stream, slide="30 minutes"), "w2", "complete")) == key(intake.tumbling(df, slide="30 minutes"))
    assert key(drain(intake.sessions(stream), "w3", "complete")) == key(intake.sessions(df))
    n = {r.user_id: r.n for r in drain(intake.running_state(stream), "w4", "update").groupBy("user_id").agg(F.max("n").alias("n")).collect()}
    assert n == {0: 20, 1: 20, 2: 20}
    e = sorted(((r.user_id, r.ts, r.event_type) for r in df.collect()), key=lambda r: (r[0], r[1]))
    for late in (None, "1 hour"):
        got = {r.user_id: (r.n, r.latest, r.changes) for r in drain(intake.running_state(stream, late=late, idle_ms=60_000), f"w6{bool(late)}", "update").collect()}
        for u in {x[0] for x in e}:
            v = [x[2] for x in e if x[0] == u]
            assert got[u][0] == len(v) and got[u][2] <= len(v) - 1
            if len({x[1] for x in e if x[0] == u}) == len(v):
                assert got[u][1:] == (v[-1], sum(a != b for a, b in zip(v, v[1:])))
    assert drain(intake.first_offers(stream, "event_type"), "w5", "append").count() == 2


def test_append_once_upsert_and_resume(spark, tmp_path):
    df = spark.createDataFrame([event(i, i, i) for i in range(10)], SCHEMA)
    df.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        intake.append_once(intake.stream_files(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    c = spark.createDataFrame([(2, "x", 5), (2, "y", 6), (3, "z", 1)], "k int, v string, seq bigint")
    assert sorted((r.k, r.v) for r in intake.upsert(t, c, ["k"], "seq").collect()) == [(1, "a"), (2, "y"), (3, "z")]
    assert [r.k for r in intake.pending(t, c, "k").collect()] == [1]


def test_tables_and_milestones_of_pages(spark):
    head = "<tr><th>項目</th><th>日期</th></tr>"
    shown = f"<table><tr><td>x</td><td>y</td></tr></table><table>{head}<tr><td>申請</td><td>107/1/2</td></tr><tr><td>one</td></tr><tr><td>核定</td><td></td></tr></table>"
    hidden = f'<table style="display: none">{head}<tr><td>舊</td><td>99/1/1</td></tr></table>'
    nested = f'<div><table style="display:none"><tr><td><table>{head}<tr><td>內</td><td>1</td></tr></table></td></tr></table></div>'
    pages = spark.createDataFrame([(1, hidden + shown), (2, hidden), (3, None), (4, "<p>x</p><a href='?p=2'>下一頁</a>"), (5, nested), (6, "<a>下一頁</a>")], "k int, html string")
    t = readers.html_tables(pages, "k", "html")
    got = sorted((r.k, r.label, r.value) for r in readers.milestones(t, "k").collect())
    assert got == [(1, "核定", ""), (1, "申請", "107/1/2"), (2, "舊", "99/1/1"), (5, "內", "1")]
    more = {r.k: r.more for r in readers.has_next_page(readers.html_rows(pages, "k", "html"), "k").collect()}
    assert more[4] and not more.get(6) and not more.get(1)
