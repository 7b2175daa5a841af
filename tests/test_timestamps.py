import itertools
import random

import pytest

from landloom.functions.moments import interpretations, readings
from landloom.operators.timestamps import RULE, normal_forms, own_cost, step_cost, viterbi

CASES = [
    ("115/8/11", None, "2026-08-11"),
    (" 2017/08/31 ", None, "2017-08-31"),
    ("民國99年12月15日", None, "2010-12-15"),
    ("中華民國一〇一年四月八日", None, "2012-04-08"),
    ("中華民國九十二年二月二十四日", None, "2003-02-24"),
    ("民國元年1月1日", None, "1912-01-01"),
    ("０８９/１１/２１", None, "2000-11-21"),
    ("0891121", None, "2000-11-21"),
    ("680725", None, "1979-07-25"),
    ("20080301", None, "2008-03-01"),
    ("01 Mar 2013", None, "2013-03-01"),
    ("1238734235", None, "2009-04-03T04:50:35Z"),
    ("1199861004460", None, "2008-01-09T06:43:24Z"),
    ("2015-07-23T15:16:59.709Z", "Asia/Taipei", "2015-07-23T15:16:59Z"),
    ("2008-01-15 17:27:23.240530", "Asia/Taipei", "2008-01-15T09:27:23Z"),
    ("20080411T165233", "Asia/Taipei", "2008-04-11T08:52:33Z"),
    ("100/3/27 上午12:38", "Asia/Taipei", "2011-03-26T16:38:00Z"),
    ("103/5/14 下午12:20", "Asia/Taipei", "2014-05-14T04:20:00Z"),
    ("2008-09-25T17:08:14-04:00", "Asia/Taipei", "2008-09-25T21:08:14Z"),
    ("2008-09-12T17:01[America/Los_Angeles]", None, "2008-09-13T00:01:00Z"),
    ("2014-11-02T01:30", "America/New_York", "2014-11-02T05:30:00Z"),  # occurs twice: the first
    ("Nov 2, 2014 1:30:00 AM EST", None, "2014-11-02T06:30:00Z"),  # the value says which
    ("2014/3/9 02:27", "America/Los_Angeles", "2014-03-09T10:27:00Z"),  # skipped: old offset
]
NONE = ["", None, "待核定", "—", "2003/1/", "2001-06", "110/13/5", "99/2/30", "0000000", "100/3/27 下午13:00", "2008-01-01 25:00", "12345", "2008-01-01 10:00", "Foo 1, 2010 1:00:00 AM GMT"]


@pytest.mark.parametrize("value,zone,want", CASES)
def test_reading(value, zone, want):
    assert [r[1] for r in readings(value, zone)] == [want]


@pytest.mark.parametrize("value", NONE)
def test_no_reading(value):
    assert readings(value, None) == []


def test_ambiguous_values_have_several_readings():
    assert {r[1] for r in readings("03/04/2015", None)} == {"2015-04-03", "2015-03-04"}
    assert len(readings("Jan 5, 2015 1:00:00 PM CST", None)) == 2


def test_interpretations_that_break_a_rule_are_marked():
    of = lambda *v: [(r[1], r[3]) for r in interpretations(*v)]
    assert of("98/11/17", None) == [("2009-11-17", False), ("1998-11-17", True)] and of("910716", None) == [("2002-07-16", False), ("1991-07-16", True)]
    assert of("98/2/29", None) == [] and of("112/2/28", None) == [("2023-02-28", False)]
    assert of("2014-11-02T01:30", "America/New_York") == [("2014-11-02T05:30:00Z", False), ("2014-11-02T06:30:00Z", True)]
    assert of("2014/3/9 02:27", "America/Los_Angeles") == [("2014-03-09T10:27:00Z", False), ("2014-03-09T09:27:00Z", True)]
    assert of("2014-11-02T01:30[America/New_York]", "UTC")[1][1] and len(of("Nov 2, 2014 1:30:00 AM EST", "America/New_York")) == 1 and len(of("2014-11-02T12:30", "America/New_York")) == 1


def brute(seq):
    cost = lambda p: own_cost(seq[0][p[0]]) + sum(step_cost(a[i], b[j]) for a, b, i, j in zip(seq, seq[1:], p, p[1:]))
    return min(map(cost, itertools.product(*[range(len(s)) for s in seq])))


def test_path_is_cheapest():
    rng = random.Random(5)
    for _ in range(60):
        seq = [[{"form": rng.choice("abc"), "t": rng.randint(0, 9), "odd": rng.random() < 0.3} for _ in range(rng.randint(1, 3))] for _ in range(rng.randint(1, 7))]
        cost, path = viterbi(seq)
        assert cost == brute(seq)
        # A rule is never broken for the sake of order or format.
        assert all(not c[k]["odd"] or all(x["odd"] for x in c) for c, k in zip(seq, path))
    assert RULE > 4


def run(spark, values, block):
    df = spark.createDataFrame(values, "src string, source string, row_id bigint, value string, zone string, normal string")
    return sorted((r.src, r.row_id, r.normal) for r in normal_forms(df, block).collect())


@pytest.mark.parametrize("block", [3, 8, 1000])
def test_blocks_give_the_path_over_the_whole_source(spark, block):
    rng = random.Random(7)
    values = []
    for source in ("x", "y"):
        for i in range(40):
            fixed = source == "x" and rng.random() < 0.15
            m, d = rng.randint(1, 12), rng.randint(1, 12)
            values.append(("t", source, i + (100 if source == "y" else 0), f"13/{m}/2015" if fixed else f"{m:02d}/{d:02d}/{2000 + i // 4}", None, "clash"))
    got = dict((r, n) for _, r, n in run(spark, values, block))
    for source in ("x", "y"):
        seq = [(v[2], interpretations(v[3], None)) for v in values if v[1] == source]
        seq = [(i, [dict(zip(("form", "normal", "t", "odd"), r)) for r in c]) for i, c in seq if c]
        path = [next(x for x in c if x["normal"] == got[i]) for i, c in seq]
        cost = sum(min(step_cost(a, b) for a in [x for x in p if x["normal"] == path[k]["normal"]] for b in [x for x in q if x["normal"] == path[k + 1]["normal"]]) for k, (p, q) in enumerate(zip([c for _, c in seq], [c for _, c in seq][1:])))
        assert cost == viterbi([c for _, c in seq])[0]


def test_nulls_empties_and_repeats(spark):
    assert run(spark, [], 10) == []
    rows = [("t", None, 1, "115/8/11", None, ""), ("t", None, 2, "115/8/11", None, ""), ("t", "s", 3, None, "UTC", ""), ("t", "s", 4, "x" * 100_000, "UTC", ""), ("t", "s", 5, "2010-01-01 10:00", "No/Zone", "")]
    assert run(spark, rows, 10) == [("t", 1, "2026-08-11"), ("t", 2, "2026-08-11")]
