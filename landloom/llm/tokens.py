"""Encoding of a corpus by a tokenization automaton.

The merges of a byte-level BPE vocabulary are compiled, one merge gadget after the other, into a deterministic
automaton whose arcs are labelled with tokens and whose state after an arc depends on that token only. It begins with
one state behind each byte, which has an arc for each byte. The gadget of merge ``(a, b) -> c``

* makes the state behind ``c``, with the arcs of the state behind ``b``,
* gives an arc ``c`` to every state that has ``a`` (and there ``b`` behind it), and
* takes the arc ``b`` out of the state behind ``a``.

Written out, 50,000 states would have some billions of arcs. The table is kept factored instead: of each state the one
it was copied from and when, of each arc the one it was copied from and when, and the arcs that were taken out and
when. A gadget is one entry in each (``Automaton.gadget``), and whether a state has an arc is read by going back
through the gadgets that made the two (``Automaton.has_arc``); arcs once read stay in a table.

A pre-split word is read byte by byte through the table of the vocabulary's suffix trie; at each byte the one token
that ends there, and whose arc the state behind the token before it has, is the last token of that prefix's encoding.
Each distinct word is encoded once per worker; texts become lists of word numbers, and their ids are gathered by array
lookup. Decoding emits the labels of the arcs.

Defined cases: null and empty texts give an empty list; special tokens' strings are ordinary text; a text of any
length is encoded whole; repeated rows each give a row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Split of byte_bpe_50k, a fixed value of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters a slice of texts may hold; bounds a worker's memory, not the result.
SLICE_CHARS = 1_500_000
#: Distinct words and their bytes a worker keeps before it starts its table anew.
KEPT_WORDS, KEPT_BYTES = 400_000, 32_000_000


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """The file's place in the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_symbols() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: printable ones stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in own}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(own))})
    return out


class Automaton:
    """The compiled merges. ``label`` holds the bytes of each arc label (token)."""

    def __init__(self, vocab: dict[str, int], merges: list):
        symbols = _byte_symbols()
        size = max(vocab.values()) + 1
        self.label = [b""] * size
        #: Of each token the gadget that made it (-1: a byte), the state copied and the arc copied by it.
        self.made = [-1] * size
        self.state_like = [0] * size
        self.arc_like = [0] * size
        #: The gadget that took an arc out of a state.
        self.taken: dict[int, int] = {}
        for k, m in enumerate(merges):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.gadget(k, vocab[a], vocab[b], vocab[a + b])
        for text, t in vocab.items():
            if self.made[t] >= 0 or len(text) == 1 and text in symbols:
                self.label[t] = bytes(symbols[c] for c in text)
        self.arcs: dict[int, bool] = {}
        self._build_table()

    @classmethod
    def load(cls, path: str) -> Automaton:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        return cls(model["vocab"], model["merges"])

    def gadget(self, k: int, a: int, b: int, c: int) -> None:
        """The ``k``-th merge gadget, ``(a, b) -> c``; a token made before only loses its second way."""
        if self.made[c] < 0:
            self.made[c], self.state_like[c], self.arc_like[c] = k, b, a
        self.taken[a << 20 | b] = k

    def _build_table(self) -> None:
        """Trie of the labels with suffix links: for each node the longest token that is a suffix of its bytes."""
        go: dict[int, int] = {}
        own, depth = [-1], 1
        order: list[tuple[int, int, int]] = []
        for t, label in sorted(((t, x) for t, x in enumerate(self.label) if x), key=lambda p: p[1]):
            node = 0
            for b in label:
                k = node << 8 | b
                nxt = go.get(k)
                if nxt is None:
                    nxt = go[k] = depth
                    depth += 1
                    own.append(-1)
                    order.append((node, b, nxt))
                node = nxt
            own[node] = t
        level = [0] * depth
        for parent, _, node in order:
            level[node] = level[parent] + 1
        link, longest = [0] * depth, [-1] * depth
        shorter = [-1] * len(self.label)
        for parent, b, node in sorted(order, key=lambda e: level[e[2]]):
            f = link[parent]
            while parent and go.get(f << 8 | b) is None and f:
                f = link[f]
            link[node] = go.get(f << 8 | b, 0) if parent else 0
            below = longest[link[node]]
            if own[node] >= 0:
                longest[node] = own[node]
                shorter[own[node]] = below
            else:
                longest[node] = below
        self.go, self.link, self.longest, self.shorter = go, link, longest, shorter
        self.moves: dict[int, int] = {}
        self.length = [len(x) for x in self.label]

    def has_arc(self, x: int, y: int) -> bool:
        """Whether the state behind ``x`` has an arc ``y`` once all gadgets are in."""
        key = x << 20 | y
        known = self.arcs.get(key)
        if known is None:
            made, state_like, arc_like, taken = self.made, self.state_like, self.arc_like, self.taken
            limit = 1 << 60
            while True:
                if taken.get(x << 20 | y, limit) < limit:
                    known = False
                    break
                if made[x] < 0 and made[y] < 0:
                    known = True
                    break
                if made[x] > made[y]:
                    limit, x = made[x], state_like[x]
                else:
                    # The gadget of y took the arc away from its own left part first, hence the + 1.
                    limit, y = made[y] + 1, arc_like[y]
            if len(self.arcs) > 4_000_000:
                self.arcs.clear()
            self.arcs[key] = known
        return known

    def _move(self, node: int, b: int) -> int:
        go, link, f = self.go, self.link, node
        while (nxt := go.get(f << 8 | b)) is None and f:
            f = link[f]
        if len(self.moves) > 4_000_000:
            self.moves.clear()
        self.moves[node << 8 | b] = nxt = nxt or 0
        return nxt

    def encode_word(self, word: bytes) -> list[int]:
        moves, longest, length, shorter, arcs = self.moves, self.longest, self.length, self.shorter, self.arcs
        last = [0] * (len(word) + 1)
        node = 0
        for i, b in enumerate(word, 1):
            nxt = moves.get(node << 8 | b)
            node = self._move(node, b) if nxt is None else nxt
            t = longest[node]
            j = i - length[t]
            while j:
                ok = arcs.get(last[j] << 20 | t)
                if ok or ok is None and self.has_arc(last[j], t):
                    break
                t = shorter[t]
                j = i - length[t]
            last[i] = t
        out, i = [], len(word)
        while i:
            out.append(last[i])
            i -= length[last[i]]
        return out[::-1]

    def decode(self, ids) -> str:
        return b"".join(self.label[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton.load(path)


class WordTable(dict):
    """Number of each distinct word; its ids lie in one flat array at its offset."""

    def __init__(self, auto: Automaton):
        super().__init__()
        self.auto = auto
        self.new: list[str] = []
        self.bytes = 0
        self.flat = np.empty(0, np.int32)
        self.at = np.empty(0, np.int64)
        self.len = np.empty(0, np.int64)

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n

    def encode_new(self) -> None:
        if not self.new:
            return
        parts = []
        for w in self.new:
            data = w.encode("utf-8")
            self.bytes += len(data)
            parts.append(self.auto.encode_word(data))
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(n) - n])
        self.len = np.concatenate([self.len, n])
        self.flat = np.concatenate([self.flat, np.fromiter((t for p in parts for t in p), np.int32, int(n.sum()))])
        self.new = []


_tables: dict[str, WordTable] = {}


def _table(path: str) -> WordTable:
    t = _tables.get(path)
    if t is None or len(t) > KEPT_WORDS or t.bytes > KEPT_BYTES:
        t = _tables[path] = WordTable(automaton(path))
    return t


def encode_texts(texts: list[str | None], path: str) -> pa.ListArray:
    """The ids of each text as one Arrow list array."""
    import regex

    split = regex.compile(PATTERN).findall
    words = _table(path)
    number = words.__getitem__
    idx: list[int] = []
    ends = np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        if t:
            idx.extend(map(number, split(t)))
        ends[i] = len(idx)
    words.encode_new()
    w = np.array(idx, np.int64)
    n = words.len[w]
    stop = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
    where = np.arange(stop[-1], dtype=np.int64) + np.repeat(words.at[w] - stop[:-1], n)
    offsets = np.concatenate([np.zeros(1, np.int64), stop[ends]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(words.flat[where]))


def slices(column: pa.Array, chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``chars`` characters; a longer text is a run of its own."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(size):
        if total and total + n > chars:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(size):
        yield start, len(size)


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(``key``, ids array<int>) of every row. One pass, no shuffle. ``path``: the vocabulary file on every executor; by default that of the package installed there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path or vocabulary_path()  # where the worker has it
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), encode_texts(part.column(1).to_pylist(), file)], names=[key, "ids"])

    return docs.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{key}` bigint, ids array<int>")


def decode_ids(encoded: DataFrame, key: str = "doc_id", path: str | None = None) -> DataFrame:
    """(``key``, text) by emitting the labels of each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(path or vocabulary_path())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([auto.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], names=[key, "text"])

    return encoded.select(F.col(key), F.col("ids")).mapInArrow(run, f"`{key}` bigint, text string")
