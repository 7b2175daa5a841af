"""Evaluation texts leaking into training text.

The normalised test items are built into a generalised suffix automaton; the training texts stream through it, the
length of the longest match ending at each character is tracked, and where it reaches ``min_chars`` (or a whole
shorter item) the items of that substring are reported. Spans that exceed the limits can be removed.

Characters that no item has lead back to the start state, so only runs of at least the least needed length made of
the items' characters are walked one by one; a compiled character class finds them.

A state's first transition lies in flat lists, further ones of the few branching states in a dictionary, and items are
kept only at states that can report them: 220 bytes a character of the items, measured, and 450 while it is built. The items go to the workers in
the task closure; sets above ``automaton_chars`` are split into several automata, each of which streams the corpus
once, and whose findings and spans are united.

Defined cases: null, empty and blank texts and items match nothing; an item without letters or digits is never
found; a document is reported once per item; repeated documents each count; texts of any length are read whole; what
is found is what is removed, also where characters only compose into those of an item.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_CHARS = 40
#: Characters of items an automaton holds; more are split over several.
AUTOMATON_CHARS = 400_000
_NOT_ALNUM = re.compile(r"[\W_]+")


def compare_form(text: str | None) -> str:
    """NFKC, lower case, letters and digits only."""
    if not text:
        return ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return _NOT_ALNUM.sub("", text.lower())


def segments(text: str) -> Iterator[tuple[int, str]]:
    """(start, normal form) of the shortest pieces whose NFKC forms make up that of the text: characters that compose stay together."""
    start, piece, form = 0, "", ""
    for i, c in enumerate(text):
        if not piece:
            start, piece, form = i, c, unicodedata.normalize("NFKC", c)
            continue
        if c.isascii() and piece[-1].isascii():
            joined = apart = ""  # nothing in ASCII composes with ASCII
        else:
            joined, apart = unicodedata.normalize("NFKC", piece + c), form + unicodedata.normalize("NFKC", c)
        if joined == apart:
            yield start, form
            start, piece, form = i, c, unicodedata.normalize("NFKC", c)
        else:
            piece, form = piece + c, joined
    if piece:
        yield start, form


def placed_form(text: str) -> tuple[str, list[int], list[int]]:
    """``compare_form`` of a text with the start and end in the text of what each of its characters came from."""
    starts, forms = [], []
    for start, form in segments(text):
        starts.append(start)
        forms.append(form)
    ends = [*starts[1:], len(text)]
    if "".join(forms) != unicodedata.normalize("NFKC", text):  # pieces that act on each other across more than one: taken as one
        starts, ends, forms = [0], [len(text)], [unicodedata.normalize("NFKC", text)]
    lower = "".join(forms).lower()
    size = [sum(len(c.lower()) for c in f) for f in forms]
    if sum(size) != len(lower):
        starts, ends, size = [0], [len(text)], [len(lower)]
    begin = [a for a, n in zip(starts, size) for _ in range(n)]
    end = [b for b, n in zip(ends, size) for _ in range(n)]
    kept = [i for m in re.finditer(r"[^\W_]+", lower) for i in range(*m.span())]
    return "".join(lower[i] for i in kept), [begin[i] for i in kept], [end[i] for i in kept]


class SuffixAutomaton:
    """Generalised suffix automaton of several texts. A match is tracked by (state, length)."""

    def __init__(self, items: list[tuple[int, str]], min_chars: int = MIN_CHARS):
        self.min_chars = min_chars
        items = [(i, t) for i, t in items if t]
        # Of each state: its first transition, its suffix link and its longest length; further transitions in ``more``.
        self.by, self.to, self.link, self.length = list([-1]), list([-1]), list([-1]), list([0])
        self.more: dict[int, dict[int, int]] = {}
        last_of: list[tuple[int, int]] = []
        for item, text in items:
            last = 0
            for c in map(ord, text):
                last = self._extend(last, c)
                last_of.append((last, item))
        # An item's occurrences are those of every suffix-link ancestor, too; only states that can report them keep them.
        self.root = {c: t for c, t in [(self.by[0], self.to[0]), *self.more.get(0, {}).items()] if t >= 0}
        short = [(i, t) for i, t in items if len(t) < min_chars]
        owners: dict[int, set[int]] = {}
        for s, item in last_of:
            while s > 0 and self.length[s] >= min_chars and item not in owners.setdefault(s, set()):
                owners[s].add(item)
                s = self.link[s]
        self.owners = {s: tuple(sorted(o)) for s, o in owners.items() if self.length[self.link[s]] < min_chars}
        self.whole: dict[int, list[int]] = {}
        for item, text in short:
            s = 0
            for c in map(ord, text):
                s = self._step(s, c)
            self.whole.setdefault(s, []).append(item)
        self.least = min([min_chars, *(len(t) for _, t in short)])
        letters = "".join(sorted({c for _, t in items for c in t}))
        self.runs = re.compile(f"[{re.escape(letters)}]{{{self.least},}}") if letters else None

    def _state(self, length: int, link: int = 0) -> int:
        self.by.append(-1)
        self.to.append(-1)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _step(self, s: int, c: int) -> int:
        """The state behind ``c``, -1 if there is none."""
        if self.by[s] == c:
            return self.to[s]
        more = self.more.get(s)
        return more.get(c, -1) if more else -1

    def _set(self, s: int, c: int, t: int) -> None:
        if self.by[s] in (-1, c):
            self.by[s], self.to[s] = c, t
        else:
            self.more.setdefault(s, {})[c] = t

    def _split(self, p: int, c: int, q: int) -> int:
        """The part of q that is reached from p in one step, as a state of its own."""
        clone = self._state(self.length[p] + 1, self.link[q])
        self.by[clone], self.to[clone] = self.by[q], self.to[q]
        if q in self.more:
            self.more[clone] = dict(self.more[q])
        while p >= 0 and self._step(p, c) == q:
            self._set(p, c, clone)
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self._step(last, c)
        if q >= 0:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        cur = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and self._step(p, c) < 0:
            self._set(p, c, cur)
            p = self.link[p]
        if p >= 0:
            q = self._step(p, c)
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return cur

    def matches(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, item) of each match that counts, one for each end at which it does."""
        if self.runs is None:
            return
        by, to, more, link, length, owners, whole, least = self.by, self.to, self.more.get, self.link, self.length, self.owners, self.whole, self.min_chars
        root = self.root.get
        for run in self.runs.finditer(text):
            s = n = 0
            end = run.start()
            for c in map(ord, run[0]):
                end += 1
                if not s:
                    s = root(c, 0)
                    n = 1
                elif by[s] == c:
                    s = to[s]
                    n += 1
                else:
                    while True:
                        t = more(s)
                        if t is not None and (t := t.get(c)) is not None:
                            s = t
                            n += 1
                            break
                        s = link[s]
                        if not s:
                            s = root(c, 0)
                            n = 1
                            break
                        n = length[s]
                        if by[s] == c:
                            s = to[s]
                            n += 1
                            break
                if not s:
                    continue
                if n >= least:
                    # The ancestor of the last min_chars characters has all items that contain them.
                    a = s
                    while length[link[a]] >= least:
                        a = link[a]
                    for item in owners[a]:
                        yield end - least, end, item
                if whole:
                    a = s
                    while a > 0:
                        if a in whole and length[a] <= n:
                            for item in whole[a]:
                                yield end - length[a], end, item
                        a = link[a]

    def items_in(self, text: str) -> set[int]:
        return {item for _, _, item in self.matches(text)}

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Merged spans of the normalised text that lie in matches."""
        return merge_spans({(a, b) for a, b, _ in self.matches(text)})


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _automata(items: DataFrame, key: str, text: str, min_chars: int, automaton_chars: int) -> list[list[tuple[int, str]]]:
    """The items in as many parts as their size asks for; a part is what one automaton holds."""
    sized = items.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"))
    total = sized.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-total // automaton_chars)
    parts = []
    for k in range(n):
        rows = sized.where(F.pmod(F.xxhash64("k"), F.lit(n)) == k).collect()  # about automaton_chars characters
        parts.append([(r.k, compare_form(r.t)) for r in rows])
    return parts


_built: dict[tuple, SuffixAutomaton] = {}


def _built_once(part: list[tuple[int, str]], min_chars: int) -> SuffixAutomaton:
    key = (min_chars, hash(tuple(part)))
    if key not in _built:
        _built.clear()
        _built[key] = SuffixAutomaton(part, min_chars)
    return _built[key]


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", min_chars: int = MIN_CHARS, automaton_chars: int = AUTOMATON_CHARS) -> DataFrame:
    """(``key``, ``item_key``) of every document that holds ``min_chars`` consecutive characters of an item, or a whole shorter one."""
    source = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint"), F.col(text).cast("string"))
    out = None
    for part in _automata(items, item_key, item_text, min_chars, automaton_chars):

        def run(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
            auto = _built_once(part, min_chars)
            for batch in batches:
                docs_, items_ = [], []
                for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for i in sorted(auto.items_in(compare_form(t.as_py()))):
                        docs_.append(d)
                        items_.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(items_, pa.int64())], names=[key, item_key])

        found = source.mapInArrow(run, f"`{key}` bigint, `{item_key}` bigint")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], f"`{key}` bigint, `{item_key}` bigint")
    return out


def cut_spans(text: str, spans: list[tuple[int, int]], max_coverage: float) -> tuple[int, float, str | None]:
    """(removed characters, coverage, what is left) of a text whose normal form has these spans."""
    form, begin, end = placed_form(text)
    merged = merge_spans(spans)
    kept, at = [], 0
    for a, b in merged:
        kept.append(text[at : max(at, begin[a])])
        at = max(at, end[b - 1])
    kept.append(text[at:])
    cover = sum(b - a for a, b in merged) / len(form)
    return len(text) - sum(map(len, kept)), cover, None if cover > max_coverage else "".join(kept)


def remove_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", min_chars: int = MIN_CHARS, max_coverage: float = 0.5, automaton_chars: int = AUTOMATON_CHARS) -> DataFrame:
    """(``key``, removed_chars, coverage, text) of each document with leaked spans, which are those ``find_leaks`` finds.

    The spans are cut out of the text as it is; a document of which they cover more than ``max_coverage`` of its
    letters and digits gets a null text. Where the items need several automata, each gives its spans, which are united
    per document; only leaked documents are shuffled.
    """
    out_schema = f"`{key}` bigint, removed_chars bigint, coverage double, text string"
    out_types = (pa.int64(), pa.int64(), pa.float64(), pa.string())
    source = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint"), F.col(text).cast("string"))
    parts = _automata(items, item_key, item_text, min_chars, automaton_chars)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, out_types)], names=[key, "removed_chars", "coverage", "text"])

    def leaked(part: list, column: pa.Array) -> Iterator[tuple[int, str, list[tuple[int, int]]]]:
        auto = _built_once(part, min_chars)
        for i, t in enumerate(column):
            t = t.as_py()
            if spans := auto.spans(compare_form(t)):
                yield i, t, spans

    if len(parts) <= 1:
        part = parts[0] if parts else []

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                yield batch_of([(ids[i], *cut_spans(t, spans, max_coverage)) for i, t, spans in leaked(part, batch.column(1))])

        return source.mapInArrow(run, out_schema)

    found = None
    for part in parts:

        def spans_of(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[i], t, [x for s in spans for x in s]) for i, t, spans in leaked(part, batch.column(1))]
                cols = list(zip(*rows)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.list_(pa.int32())))], names=["k", "t", "s"])

        one = source.mapInArrow(spans_of, "k bigint, t string, s array<int>").groupBy("k", "t").agg(F.first("s").alias("s"), F.count("*").alias("n"))  # equal texts have equal spans
        found = one if found is None else found.unionByName(one)
    each = found.groupBy("k", "t").agg(F.flatten(F.collect_list("s")).alias("s"), F.max("n").alias("n"))  # a list for each automaton
    each = each.select("k", "t", "s", F.explode(F.sequence(F.lit(1), F.col("n"))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of([(k, *cut_spans(t, list(zip(s[::2], s[1::2])), max_coverage)) for k, t, s in zip(*(c.to_pylist() for c in batch.columns[:3]))])

    return each.select("k", "t", "s").mapInArrow(cut, out_schema)
