"""Similarities and repairs without a built-in: gestalt ratio, fragment repair, list completion."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def gestalt_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp ratio of two texts; null if either is."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two arrays as sets; 0 if both are empty, null if either is null."""
    union = F.size(F.array_union(a, b))
    return F.when(a.isNull() | b.isNull(), None).when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def _key(p: str) -> tuple[int, int]:
    main, _, sub = p.partition("-")
    return int(main or 0), int(sub) if sub else -1


def _break(xs: list[str]) -> int | None:
    """The position of the only token that doesn't lie between its neighbours, though these ascend; None if there is none or several."""
    keys = [_key(x) for x in xs]
    bad = [i for i in range(1, len(xs) - 1) if keys[i - 1] < keys[i + 1] and not keys[i - 1] < keys[i] < keys[i + 1]]
    return bad[0] if len(bad) == 1 else None


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("old", T.StringType()), T.StructField("new", T.StringType())])))
def order_repairs(parcels: pd.Series) -> pd.Series:
    """The numbers that may stand where a printed list breaks its order: one digit more or less, between the neighbours, not in the list."""

    def options(xs):
        xs = [] if xs is None else list(xs)
        if (i := _break(xs)) is None:
            return []
        x, lo, hi = xs[i], _key(xs[i - 1]), _key(xs[i + 1])
        made = {x[:k] + x[k + 1 :] for k in range(len(x)) if x[k].isdigit()} | {x[:k] + d + x[k:] for k in range(len(x) + 1) for d in "0123456789"}
        return [{"at": i, "old": x, "new": o} for o in sorted(made) if o and o[0].isdigit() and o[-1].isdigit() and o not in xs and lo < _key(o) < hi]

    return pd.Series([options(x) for x in parcels])


@F.pandas_udf(T.ArrayType(T.StringType()))
def repair_order(parcels: pd.Series) -> pd.Series:
    """Printed parcels with one mistyped number put right.

    A list ascends. Where exactly one token breaks the order and exactly one removal of a single digit makes it fit
    between its neighbours, the token is replaced; a list without a break, with several, or with several possible
    repairs stays as it is. Null stays null.
    """

    def fix(xs):
        xs = None if xs is None else list(xs)
        if not xs or len(xs) < 3:
            return xs
        if (i := _break(xs)) is None:
            return xs
        keys = [_key(x) for x in xs]
        options = {xs[i][:k] + xs[i][k + 1 :] for k in range(len(xs[i])) if xs[i][k].isdigit()}
        fit = [o for o in options if o and o[0].isdigit() and o[-1].isdigit() and keys[i - 1] < _key(o) < keys[i + 1]]
        return xs[:i] + fit + xs[i + 1 :] if len(fit) == 1 else xs

    return pd.Series([fix(x) for x in parcels])


def complete_list(fragment: Column, candidates: Column, count: Column) -> Column:
    """The fragment with all candidates after its last, if it is part of them and the count then closes; else null.

    ``candidates`` must be in parcel order.
    """
    last = F.array_position(candidates, F.element_at(fragment, F.when(F.size(fragment) > 0, -1))).cast("int")
    whole = F.concat(fragment, F.slice(candidates, last + 1, F.greatest(F.size(candidates) - last, F.lit(0))))
    inside = F.size(F.array_except(fragment, candidates)) == 0
    return F.when((F.size(fragment) > 0) & inside & (F.size(whole) == count), whole)


@F.pandas_udf(T.DoubleType())
def vertex_fraction(polygon: pd.Series, within: pd.Series) -> pd.Series:
    """Share of a polygon's outer vertices inside another (rings of [x, y], holes cut out, even-odd rule); null without vertices."""

    def inside(x, y, rings):
        hit = False
        for ring in rings:
            n = len(ring)
            for i in range(n):
                (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    hit = not hit
        return hit

    def share(p, w):
        if p is None or w is None or len(p) == 0 or len(p[0]) == 0:
            return None
        ring = [tuple(v) for v in p[0]]
        rings = [[tuple(v) for v in r] for r in w]
        return sum(inside(x, y, rings) for x, y in ring) / len(ring)

    return pd.Series([share(p, w) for p, w in zip(polygon, within)], dtype="float64")
