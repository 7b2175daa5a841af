import random

import pytest

from landloom.llm.components import connected_components, core_links


def union_find(pairs):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {x: find(x) for x in up}


def run(spark, pairs, **how):
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = connected_components(df, **how).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}


@pytest.mark.parametrize("hot", [3, 100_000])
def test_chains_stars_and_rings(spark, hot):
    rng = random.Random(2)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    star = [("中心", f"s{i}") for i in range(40)] + [(f"s{i}", f"t{i}") for i in range(0, 40, 3)]
    noise = [(f"n{rng.randint(0, 80)}", f"n{rng.randint(0, 80)}") for _ in range(50)]
    pairs = chain + star + noise + [(b, a) for a, b in star[:5]] + star[:5] + [("x", "x"), (None, "y"), ("z", None), (None, None)]
    rng.shuffle(pairs)
    assert run(spark, pairs, hot_degree=hot) == union_find(pairs)


def test_empty_and_self_links(spark):
    assert run(spark, []) == {} and run(spark, [("a", "a"), (None, "b")]) == {}


def test_links_of_the_register(spark):
    c = spark.createDataFrame(
        [(True, " 松濤段１地號", "松濤段2地號", 1), (False, "x", "y", 1), (None, "x", "y", 1), (True, "", "q", 1), (True, "松濤段2地號", "松濤段3 地號", 1)], "confirm_merge boolean, match_land_core string, with_land_core string, core int"
    )
    p = spark.createDataFrame([("松濤段3地號", [1, 2], [(1, 9, 0.5), (2, 77, 0.6), (None, 1, 0.5)]), ("松濤段9地號", [9], None), (None, [5], [])], "land_core string, member_recnos array<int>, borderline array<struct<a int, b int, score double>>")
    got = {r.node: r.component for r in connected_components(core_links(c, p)).collect()}
    assert got == {f"松濤段{i}地號": "松濤段1地號" for i in (1, 2, 3, 9)}
