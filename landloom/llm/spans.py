"""Long exact spans shared between records: prefix-partitioned, sparse suffix trees.

A span of ``length`` characters that two texts share holds the same ``prefix``-character strings at the same places,
so the place of the one with the least hash is chosen alike in both. Only the suffixes at those places are taken
(about one in 70 for 200 and 64), each with the stretch of text whose windows of ``length`` chose the place:

1. Suffixes are partitioned by their prefix. Prefixes of one document only are dropped: nothing of theirs is shared.
2. A stretch that occurs as a whole in two documents is shared as a whole.
3. The other distinct stretches of a prefix form one subtree: the suffix tree of what follows the place, as sorted
   suffixes with the lengths neighbours have in common, and the same of what stands before it, read backwards. A
   window is a node of the one at its depth behind the place, and a node of the other at its depth before it; where
   two documents lie below both, it is shared. The windows of a stretch all hold its place, so those shared make one
   span, a maximal repeat.
4. A prefix with more than ``subtree`` distinct stretches is lengthened: its windows are halved by their distance
   from the place, each half holds a longer string in common, and is partitioned by that. This is repeated until every
   group fits; at full length a group is one string, so it ends.
5. The spans of a document are merged in order and their characters counted once.

Defined cases: null, empty and shorter texts share nothing; a span repeated within one document only isn't shared;
whole repeated documents are shared in full; keys are unique (of rows with one key it isn't defined whose text
counts); characters are code points of the text as it is. Prefixes and whole stretches are told apart by hashes of
64 and 128 bits; within a subtree texts are compared by their characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import hot_join
from ..runtime import discard, materialize
from .tokens import slices

LENGTH, PREFIX, SUBTREE = 200, 64, 20_000
SLICE = 1_000_000
#: Bits of a place within a slice; a longer text is cut into overlapping pieces.
PLACE_BITS = 23
PIECE = (1 << PLACE_BITS) - 1
_U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(33))
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(29)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(32)
    return h


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, up to n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE + (1 << 16))
        have = tuple(np.concatenate([np.ones(1, _U), np.multiply.accumulate(np.full(size, b, _U))]) for b in (base, pow(base, -1, 1 << 64)))
        _powers[base] = have
    return have


class Hashes:
    """Hash of any stretch of a code point array in constant time."""

    def __init__(self, points: np.ndarray, base: int):
        n = len(points)
        pw, self.inv = powers(base, n + 1)
        self.sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(points + _U(base & 0xFFFF)) * pw[:n])])

    def of(self, start, stop) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.inv[start] + (stop - start).astype(_U))


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Least value of every window of w."""
    n = len(v) - w + 1
    pad = -len(v) % w
    full = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, _U)]).reshape(-1, w)
    head = np.minimum.accumulate(full, axis=1).ravel()
    tail = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[w - 1 : w - 1 + n])


def places(texts: list[str], length: int, prefix: int) -> tuple[np.ndarray, ...]:
    """(text, prefix hash, two stretch hashes, place, first window, last window) of each chosen place of the texts."""
    size = np.array([len(t) for t in texts], np.int64)
    start = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(_U)
    if len(points) < length:
        return tuple(np.empty(0, np.int64) for _ in range(7))
    one, two = (Hashes(points, b) for b in BASES)
    at = np.arange(len(points) - prefix + 1)
    grams = one.of(at, at + prefix)
    # The least hash, the leftmost of equal ones.
    mask = _U((1 << PLACE_BITS) - 1)
    least = (sliding_min((grams & ~mask) | at.astype(_U), length - prefix + 1) & mask).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), size)[: len(least)]
    whole = start[owner + 1] - np.arange(len(least)) >= length  # windows within one text
    first = whole.copy()
    first[1:] &= ~whole[:-1] | (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    last = whole.copy()
    last[:-1] &= ~whole[1:] | (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    place, text = least[lo], owner[lo]
    inside = mix((place - lo).astype(_U))
    c1, c2 = one.of(lo, hi + length) ^ inside, two.of(lo, hi + length) ^ inside
    base = start[text]
    return text, grams[place].view(np.int64), c1.view(np.int64), c2.view(np.int64), place - base, lo - base, hi - base


def pieces(text: str, length: int) -> Iterator[tuple[int, str]]:
    """Pieces of a long text that overlap so that each window lies in one."""
    step = PIECE - length + 1
    for a in range(0, max(1, len(text) - length + 1), step):
        yield a, text[a : a + PIECE]


_PLACES = "doc bigint, k bigint, c1 bigint, c2 bigint, at int, lo int, hi int"
_SCHEMA = pa.schema([("doc", pa.int64()), ("k", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("at", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])


def suffix_places(docs: DataFrame, length: int, prefix: int) -> DataFrame:
    """Step 1 over all documents: the chosen places with their prefix, stretch and range of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE):
                part = batch.slice(a, b - a)
                ids, texts, shift = [], [], []
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if t is not None and len(t) >= length:
                        for s, piece in pieces(t, length):
                            ids.append(d)
                            texts.append(piece)
                            shift.append(s)
                groups = [(ids, texts, shift)] if sum(map(len, texts)) <= PIECE else [([i], [t], [s]) for i, t, s in zip(ids, texts, shift)]
                for ids_, texts_, shift_ in groups:
                    if not texts_:
                        continue
                    text, k, c1, c2, at, lo, hi = places(texts_, length, prefix)
                    off = np.array(shift_, np.int64)[text]
                    cols = (np.array(ids_, np.int64)[text], k, c1, c2, *((x + off).astype(np.int32) for x in (at, lo, hi)))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=_SCHEMA)

    return docs.mapInArrow(run, _PLACES)


def longer_prefixes(docs: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """Step 4: each row twice, with its windows that begin nearer the place and those farther before it, under the string that all of them hold."""
    per_doc = rows.groupBy("doc").agg(F.collect_list(F.struct("k", "at", "lo", "hi", "near", "far")).alias("w"))  # bounded by the text's length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(_U)
                one, two = (Hashes(points, b) for b in BASES)
                out = []
                for w in wanted:
                    half = (w["near"] + w["far"]) // 2
                    for near, far in ((w["near"], half), (half + 1, w["far"])):
                        lo, hi = max(w["lo"], w["at"] - far), min(w["hi"], w["at"] - near)
                        if near <= far and lo <= hi and hi + length <= len(points):
                            out.append((w["k"], w["at"], lo, hi, near, far))
                if not out:
                    continue
                k, at, lo, hi, near, far = (np.array(c, np.int64) for c in zip(*out))
                inside = mix((at - lo).astype(_U))
                key = mix(one.of(at - near, at - far + length) ^ mix((near * length + far).astype(_U)) ^ k.astype(_U))
                c1, c2 = one.of(lo, hi + length) ^ inside, two.of(lo, hi + length) ^ inside
                cols = [np.full(len(k), doc, np.int64), *(x.view(np.int64) for x in (key, c1, c2)), *(x.astype(np.int32) for x in (at, lo, hi, near, far))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[*_SCHEMA.names, "near", "far"])

    return docs.join(per_doc, "doc").select("doc", "text", "w").mapInArrow(run, _PLACES + ", near int, far int")


def _cut(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted stretches with their text: (doc, k, c1, c2, many, at, windows, stretch); ``at`` counts from the stretch's beginning."""
    per_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("k", "c1", "c2", "many", "at", "lo", "hi")).alias("w"))  # bounded by the text's length
    return docs.join(per_doc, "doc").select("doc", "text", F.explode("w").alias("w")).select(
        "doc", "w.k", "w.c1", "w.c2", "w.many", (F.col("w.at") - F.col("w.lo")).alias("at"), (F.col("w.hi") - F.col("w.lo") + 1).alias("windows"), F.substring("text", F.col("w.lo") + 1, F.col("w.hi") - F.col("w.lo") + length).alias("stretch")
    )


def common(a: str, b: str) -> int:
    """How many first characters two texts have in common."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class SuffixTree:
    """Suffix tree of texts in groups: their sorted order and the length each has in common with the one before it.

    A node at a depth is a run of neighbours that have so much in common; no two groups share a node.
    """

    def __init__(self, group: list[int], texts: list[str]):
        order = sorted(range(len(texts)), key=lambda i: (group[i], texts[i]))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.shared = np.fromiter((-1 if i is None or group[i] != group[j] else common(texts[i], texts[j]) for i, j in zip([None, *order], order)), np.int64, len(order))

    def nodes(self, depth: int) -> np.ndarray:
        """The node above each text at a depth."""
        return np.cumsum(self.shared < depth)[self.place]


def shared_windows(group: list[int], doc: np.ndarray, at: np.ndarray, windows: np.ndarray, texts: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last shared window of each stretch (first > last where there is none)."""
    n = len(texts)
    behind = SuffixTree(group, [t[p:] for t, p in zip(texts, at.tolist())])
    before = SuffixTree(group, [t[:p][::-1] for t, p in zip(texts, at.tolist())])
    first, last = np.full(n, 1 << 30), np.full(n, -1)
    for back in range(int(at.max(initial=0)) + 1):  # windows that begin so far before the place
        w = at - back
        here = np.flatnonzero((w >= 0) & (w < windows))
        if not len(here):
            continue
        node = behind.nodes(length - back)[here] * (n + 1) + before.nodes(back)[here]
        order = np.argsort(node, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(node[order]) != 0])
        below = doc[here][order]
        several = np.minimum.reduceat(below, starts) != np.maximum.reduceat(below, starts)
        hit = here[order][np.repeat(several, np.diff(np.r_[starts, len(order)]))]
        first[hit], last[hit] = np.minimum(first[hit], w[hit]), np.maximum(last[hit], w[hit])
    return first, last


_RUN = pa.schema([("k", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])


def _subtrees(cut: DataFrame, length: int, batch_rows: int = 20_000) -> DataFrame:
    """Step 3: (k, c1, c2, first window, last window); whole groups are taken together until there are ``batch_rows`` stretches."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        doc, k, c1, c2, many, at, windows, text = zip(*rows)
        # A stretch of many documents differs from every document.
        below = np.where(np.array(many), -1 - np.arange(len(rows)), np.array(doc, np.int64))
        first, last = shared_windows(list(k), below, np.array(at, np.int64), np.array(windows, np.int64), list(text), length)
        ok = (first <= last) & ~np.array(many)
        return pa.RecordBatch.from_arrays([*(pa.array(np.array(c, np.int64)[ok]) for c in (k, c1, c2)), pa.array(first[ok].astype(np.int32)), pa.array(last[ok].astype(np.int32))], schema=_RUN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(rows) >= batch_rows and rows[-1][1] != row[1]:
                    yield solve(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield solve(rows)

    rows = cut.select("doc", "k", "c1", "c2", "many", "at", "windows", "stretch").repartition("k").sortWithinPartitions("k")
    return rows.mapInArrow(run, "k bigint, c1 bigint, c2 bigint, a int, b int")


def _span_rows(docs: DataFrame, length: int, prefix: int, subtree: int) -> DataFrame:
    """(doc, s, e) of every maximal repeat found in steps 1 to 4; ends are exclusive."""
    stretch = ["k", "c1", "c2"]
    found = materialize(suffix_places(docs, length, prefix).withColumns({"near": F.lit(0), "far": F.lit(length - prefix)}), "places")
    out: list[DataFrame] = []
    while True:
        two = found.groupBy("k").agg(F.min("doc").alias("d1"), F.max("doc").alias("d2"), F.count("*").alias("n")).where("d1 < d2").select("k", "n")
        # A boilerplate prefix may lie at a large share of the places.
        two = materialize(two, "prefixes")
        kept = materialize(hot_join(found, two, ["k"], "n", found.count(), "left_semi"), "kept")
        discard(found)
        discard(two)
        distinct = kept.groupBy(*stretch).agg((F.min("doc") < F.max("doc")).alias("many"), F.count("*").alias("copies"), F.min_by(F.struct("doc", "at", "lo", "hi"), F.struct("doc", "lo")).alias("r"))
        distinct = materialize(distinct, "stretches")
        size = materialize(distinct.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        wanted = distinct.join(size.where(F.col("n") <= subtree), "k").select("r.doc", *stretch, "many", "r.at", "r.lo", "r.hi")
        windows = _subtrees(materialize(_cut(docs, wanted, length), "cut"), length)
        many = distinct.where("many").select(*stretch, "copies")
        total = kept.count()
        out.append(hot_join(kept, many, stretch, "copies", total, "left_semi").select("doc", F.col("lo").alias("s"), (F.col("hi") + length).alias("e")))
        out.append(kept.join(windows, stretch).select("doc", (F.col("lo") + F.col("a")).alias("s"), (F.col("lo") + F.col("b") + length).alias("e")))
        large = size.where(F.col("n") > subtree)
        if large.isEmpty():
            return reduce(DataFrame.unionByName, out)
        # Stretches that are whole in two documents are done, but others may share a part with them.
        rows = hot_join(kept, large.join(kept.groupBy("k").agg(F.count("*").alias("copies")), "k").select("k", "copies"), ["k"], "copies", total, "left_semi")
        found = materialize(longer_prefixes(docs, rows, length), "places")


def _source(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    return docs.where(F.length(text) >= length).select(F.col(key).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"))


def _merged(rows: DataFrame) -> DataFrame:
    """Each span with ``p``, how far the spans before it reach."""
    before = Window.partitionBy("doc").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)  # bounded by the text's length
    return rows.withColumn("p", F.max("e").over(before))


def shared_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, prefix: int = PREFIX, subtree: int = SUBTREE) -> DataFrame:
    """(``key``, spans array<struct<start, end>>): the merged shared spans of each document that has one; ends are exclusive."""
    rows = _merged(_span_rows(_source(docs, key, text, length), length, prefix, subtree))
    upto = Window.partitionBy("doc").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, 0)
    island = rows.withColumn("i", F.sum(F.when(F.col("s") <= F.col("p"), 0).otherwise(1)).over(upto)).groupBy("doc", "i").agg(F.min("s").alias("start"), F.max("e").alias("end"))
    return island.groupBy(F.col("doc").alias(key)).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def shared_chars(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, prefix: int = PREFIX, subtree: int = SUBTREE) -> DataFrame:
    """(``key``, shared_chars) of each document with a shared span; each character counts once."""
    rows = _merged(_span_rows(_source(docs, key, text, length), length, prefix, subtree))
    new = F.greatest(F.col("e") - F.greatest("s", F.coalesce("p", "s")), F.lit(0))
    return rows.groupBy(F.col("doc").alias(key)).agg(F.sum(new).cast("bigint").alias("shared_chars"))
