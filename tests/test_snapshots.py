import random
import re
import unicodedata

import pytest

from landloom.operators.snapshots import snapshot_changes

SCHEMA = "release_id string, release_row bigint, iso_date string, land string, name string, change string, pair int"


def norm(s):
    return None if s is None else re.sub(r"[\s、,，]+", "", unicodedata.normalize("NFKC", s)) or None


def brute(rows):
    by = {}
    for rel, row, *v, _, _ in rows:
        if rel is not None:
            k = tuple(map(norm, v))
            by.setdefault(rel, {})
            by[rel][k] = min(row, by[rel].get(k, row))
    out, rels = set(), sorted(by)
    for a, b in zip(rels, rels[1:]):
        old, new = {k: r for k, r in by[a].items() if k not in by[b]}, {k: r for k, r in by[b].items() if k not in by[a]}
        for i, j in ((1, 2), (0, 2), (0, 1)):
            for key in {(k[i], k[j]) for k in old}:
                o = sorted(r for k, r in old.items() if (k[i], k[j]) == key)
                n = sorted(r for k, r in new.items() if (k[i], k[j]) == key)
                for x, y in zip(o, n):
                    out.add(("changed", x, y))
                    old = {k: r for k, r in old.items() if r != x}
                    new = {k: r for k, r in new.items() if r != y}
        out |= {("removed", r, 0) for r in old.values()} | {("added", 0, r) for r in new.values()}
    return out


def run(spark, rows, **how):
    df = snapshot_changes(spark.createDataFrame(rows, SCHEMA), **how)
    return {(r.change, r.prev_row, r.cur_row) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows, n = [], 0
    base = [[f"2020-01-{rng.randint(1, 9):02d}", f"松濤段{i}地號", f"案{i}"] for i in range(60)]
    for k in range(4):
        for v in base:
            for _ in range(1 + (rng.random() < 0.1)):
                n += 1
                land = v[1] if rng.random() < 0.5 else v[1].replace("段", "段 、")
                rows.append((f"R{k}", n, v[0] if rng.random() < 0.95 else None, land, v[2], "x", 1))
        base = [v for v in base if rng.random() > 0.1] + [[f"2021-02-{rng.randint(1, 9):02d}", f"新段{k}-{i}", f"新{k}-{i}"] for i in range(5)]
        for v in base:
            if rng.random() < 0.15:
                v[rng.randrange(3)] += "改"
    rng.shuffle(rows)
    assert run(spark, rows, chunk_rows=rng.choice([1, 3, 8]), rows_per_bucket=7) == brute(rows)


def test_defined_cases(spark):
    assert run(spark, []) == set()
    one = [("A", 1, None, None, None, "", 0), ("A", 2, "d", "l", "n", "", 0)]
    assert run(spark, one) == set()
    same = [*one, ("B", 3, None, "", " ", "", 0), ("B", 9, "d", "ｌ", "n", "", 0), ("B", 5, "d", "l", "n", "", 0), (None, 7, "q", "q", "q", "", 0)]
    assert run(spark, same) == set()
    ties = [("A", 1, "1", "l", "n", "", 0), ("A", 2, "2", "l", "n", "", 0), ("B", 3, "3", "l", "n", "", 0), ("B", 4, "4", "l", "n", "", 0), ("B", 5, "5", "l", "n", "", 0)]
    assert run(spark, ties) == {("changed", 1, 3), ("changed", 2, 4), ("added", 0, 5)}
    long = "長" * 200_000
    assert run(spark, [("A", 1, "1", long, "n", "", 0), ("B", 2, "1", long + "x", "n", "", 0)]) == {("changed", 1, 2)}
