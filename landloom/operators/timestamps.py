"""Mixed timestamp formats and zones brought to one unambiguous form.

Each value's interpretations are generated as an array; a path through the arrays of a source, in record order, is
chosen by Viterbi, each switch of format and each backward jump in time costing a penalty. An interpretation that
breaks a fixed rule of the data (``functions.moments``) costs more than any path can save by it, so it is chosen only
where nothing else is left; among the others order and format decide. A value with one interpretation is a fixed
point of the path, so the search falls into independent stretches.

A source may hold any share of the rows, so the path is computed in blocks of ``block`` consecutive record numbers:
every block gives the matrix of least costs from its first record's readings to its last record's (min-plus
algebra); the matrices of a source, one row a block, are chained to fix the ends of every block, and only records
between a block's end and its nearest fixed point are then decided. The result equals the path over the whole
source. Blocks never hold more than ``block`` rows, as record numbers are unique.

Defined cases: null, blank, incomplete and impossible values give no row; a value with a time but neither zone nor
clock gives none; ties take the reading listed first; repeated rows each give their own row; empty tables give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moments import interpretations
from ..runtime import materialize

SWITCH, BACK = 1.0, 1.0
#: More than a record can save: two switches and two jumps, at its step in and its step out.
RULE = 5.0
_CANDS = "cands array<struct<form string, normal string, t bigint, odd boolean>>"


def generate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pdf["cands"] = [[{"form": f, "normal": n, "t": t, "odd": o} for f, n, t, o in interpretations(v, z)] for v, z in zip(pdf.value, pdf.zone)]
        pdf = pdf[pdf.cands.map(len) > 0]
        yield pdf[["src", "source", "row_id", "cands"]]


def own_cost(a) -> float:
    return RULE if a.get("odd") else 0.0


def step_cost(a, b) -> float:
    """The cost of going from reading ``a`` to ``b``, with that of ``b`` itself."""
    return SWITCH * (a["form"] != b["form"]) + BACK * (b["t"] < a["t"]) + own_cost(b)


def viterbi(seq: list, first: int | None = None, last: int | None = None) -> tuple[float, list[int]]:
    """Least cost and path over ``seq`` (a list of readings per record), its ends fixed where given."""
    inf = float("inf")
    cost = [own_cost(seq[0][i]) if first is None or i == first else inf for i in range(len(seq[0]))]
    back = []
    for a, b in zip(seq, seq[1:]):
        row, best = [], []
        for y in b:
            c = [cost[i] + step_cost(x, y) for i, x in enumerate(a)]
            k = min(range(len(c)), key=c.__getitem__)
            best.append(k)
            row.append(c[k])
        back.append(best)
        cost = row
    k = last if last is not None else min(range(len(cost)), key=cost.__getitem__)
    total, path = cost[k], [k]
    for best in reversed(back):
        path.append(best[path[-1]])
    return total, path[::-1]


_NAMES = ["kind", "src", "source", "block", "row_id", "normal", "cands", "tail", "costs"]
_BLOCK = f"kind string, src string, source string, block bigint, row_id bigint, normal string, {_CANDS}, tail {_CANDS[6:]}, costs array<double>"


def solve_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows decided inside the block, the rows left open at its ends, and the block's matrix."""
    pdf = pdf.sort_values("row_id", kind="stable")
    src, source, block = pdf.src.iloc[0], pdf.source.iloc[0], int(pdf.block.iloc[0])
    ids, seq = pdf.row_id.tolist(), [list(c) for c in pdf.cands]
    fixed = [i for i, c in enumerate(seq) if len(c) == 1]
    out = []

    def put(kind, i=None, normal=None, cands=None, tail=None, costs=None):
        out.append((kind, src, source, block, ids[i] if i is not None else None, normal, cands, tail, costs))

    if len(fixed) == len(seq):
        for i, c in enumerate(seq):
            put("row", i, c[0]["normal"])
        put("block", cands=seq[0], tail=seq[-1], costs=[own_cost(seq[0][0]) + sum(step_cost(a[0], b[0]) for a, b in zip(seq, seq[1:]))])
        return pd.DataFrame(out, columns=_NAMES)
    lo, hi = (fixed[0], fixed[-1]) if fixed else (len(seq), -1)
    for a, b in zip(fixed, fixed[1:]):
        _, path = viterbi(seq[a : b + 1])
        for i, k in zip(range(a, b), path):
            put("row", i, seq[i][k]["normal"])
    if fixed:
        put("row", hi, seq[hi][0]["normal"])
        for i in range(lo + 1 if lo else 0):
            put("head", i, cands=seq[i])
        for i in range(hi, len(seq) if hi < len(seq) - 1 else hi):
            put("tail", i, cands=seq[i])
    else:
        for i in range(len(seq)):
            put("head", i, cands=seq[i])
    # An end with one reading costs one column, so this is a handful of passes.
    costs = [viterbi(seq, first=p, last=q)[0] for p in range(len(seq[0])) for q in range(len(seq[-1]))]
    put("block", cands=seq[0], tail=seq[-1], costs=costs)
    return pd.DataFrame(out, columns=_NAMES)



def chain_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    """The reading chosen at both ends of every block of one source."""
    pdf = pdf.sort_values("block")
    heads, tails, mats = [list(c) for c in pdf.cands], [list(c) for c in pdf["tail"]], [list(c) for c in pdf.costs]
    cost, back = None, []
    for i, (h, t, m) in enumerate(zip(heads, tails, mats)):
        # A block's matrix counts its first reading's own cost, so the step into it doesn't.
        enter = [(0.0, None)] * len(h) if cost is None else [min((cost[k] + step_cost(x, y) - own_cost(y), k) for k, x in enumerate(tails[i - 1])) for y in h]
        ends = [min((enter[p][0] + m[p * len(t) + q], p) for p in range(len(h))) for q in range(len(t))]
        back.append([(p, enter[p][1]) for _, p in ends])
        cost = [c for c, _ in ends]
    q = min(range(len(cost)), key=cost.__getitem__)
    chosen = []
    for row in reversed(back):
        p, before = row[q]
        chosen.append((p, q))
        q = before
    chosen.reverse()
    return pd.DataFrame({"src": pdf.src, "source": pdf.source, "block": pdf.block, "p": [c[0] for c in chosen], "q": [c[1] for c in chosen]})


def solve_open(pdf: pd.DataFrame) -> pd.DataFrame:
    """The open rows of one end of a block: the end is fixed, the other side is a fixed point or the other end."""
    pdf = pdf.sort_values("row_id", kind="stable")
    seq = [list(c) for c in pdf.cands]
    ids, p, q = pdf.row_id.tolist(), int(pdf.p.iloc[0]), int(pdf.q.iloc[0])
    if pdf.kind.iloc[0] == "tail":
        _, path = viterbi(seq, last=q)
        keep = range(1, len(seq))
    else:
        anchored = len(seq[-1]) == 1
        _, path = viterbi(seq, first=p, last=None if anchored else q)
        keep = range(len(seq) - 1 if anchored else len(seq))
    return pd.DataFrame({"src": pdf.src.iloc[0], "row_id": [ids[i] for i in keep], "normal": [seq[i][path[i]]["normal"] for i in keep]})


def normal_forms(values: DataFrame, block: int = 1 << 15) -> DataFrame:
    """(src, row_id, normal) of each value that names a date.

    ``values``: src string, source string (whose record order counts), row_id bigint, value string, zone string.
    """
    cands = values.select("src", F.coalesce("source", F.lit("")).alias("source"), "row_id", "value", "zone").mapInPandas(generate, f"src string, source string, row_id bigint, {_CANDS}")
    cands = cands.withColumn("block", F.floor(F.col("row_id") / F.lit(block)))
    solved = materialize(cands.groupBy("src", "source", "block").applyInPandas(solve_block, _BLOCK), "moments")
    rows = solved.where(F.col("kind") == "row").select("src", "row_id", "normal")
    unsettled = solved.where(F.col("kind").isin("head", "tail"))
    # Only sources with open rows need their blocks chained.
    blocks = solved.where(F.col("kind") == "block").join(unsettled.select("src", "source").distinct(), ["src", "source"], "left_semi")
    ends = blocks.select("src", "source", "block", "cands", "tail", "costs").groupBy("src", "source").applyInPandas(chain_blocks, "src string, source string, block bigint, p int, q int")
    rest = unsettled.select("kind", "src", "source", "block", "row_id", "cands").join(ends, ["src", "source", "block"])
    return rows.unionByName(rest.groupBy("src", "source", "block", "kind").applyInPandas(solve_open, "src string, row_id bigint, normal string"))
