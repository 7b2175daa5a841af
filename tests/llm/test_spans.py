import random

import pytest

from landloom.llm import spans as sp


def brute(docs, n):
    seen = {}
    for d, t in docs:
        for p in range(len(t or "") - n + 1):
            seen.setdefault(t[p : p + n], set()).add(d)
    out = {}
    for d, t in docs:
        cover = set()
        for p in range(len(t or "") - n + 1):
            if len(seen[t[p : p + n]]) > 1:
                cover |= set(range(p, p + n))
        if cover:
            out[d] = len(cover)
    return out


def run(spark, docs, **how):
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id bigint, text string, doc string, k int").repartition(5)
    rows = sp.shared_chars(df, **how).collect()
    assert len(rows) == len({r.doc_id for r in rows})
    return {r.doc_id: r.shared_chars for r in rows}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda k, a="abc字🎉": "".join(rng.choice(a) for _ in range(k))
    common = [word(rng.randint(20, 90)) for _ in range(6)]
    docs = []
    for i in range(60):
        t = word(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            c = rng.choice(common)
            a = rng.randint(0, 15)
            t += c[a : len(c) - rng.randint(0, 15)] + word(rng.randint(0, 30))
        docs.append((i, t))
    docs += [(100, docs[3][1]), (101, docs[3][1]), (102, "ab" * 80), (103, "ab" * 60 + "c"), (104, None), (105, ""), (106, "short")]
    docs += [(107, common[0] + word(50) + common[0])]
    return docs


@pytest.mark.parametrize("seed,subtree", [(0, 2000), (1, 2000), (2, 5), (3, 2)])
def test_equals_brute_force(spark, seed, subtree):
    docs = corpus(seed)
    assert run(spark, docs, length=20, prefix=8, subtree=subtree) == brute(docs, 20)


def test_texts_in_pieces(spark, monkeypatch):
    # A piece holds few characters here, so windows lie across many of them.
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh") for _ in range(3000))
    monkeypatch.setattr(sp, "PIECE", 100)
    assert list(sp.pieces(text, 20))[1][0] == 81
    covered = {a + p for a, piece in sp.pieces(text, 20) for p in range(len(piece) - 19)}
    assert covered == set(range(len(text) - 19))


def test_production_length_long_text_and_empty_table(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("都市更新計畫案地號土段") for _ in range(120_000))
    docs = [(1, long), (2, "x" + long[50_000:50_200] + "y"), (3, long[:199]), (4, "甲" + long[7:206])]
    assert run(spark, docs) == {1: 200, 2: 200}
    assert run(spark, []) == {}


def test_prefix_of_many_stretches_is_lengthened(spark):
    # One boilerplate stretch with other surroundings everywhere, some of which recur in part.
    rng = random.Random(8)
    word = lambda k: "".join(rng.choice("xyzw") for _ in range(k))
    common, sides = word(15), [word(4) for _ in range(5)]
    docs = [(i, word(9) + rng.choice(sides) + common + rng.choice(sides) + word(9)) for i in range(80)]
    assert run(spark, docs, length=20, prefix=8, subtree=3) == run(spark, docs, length=20, prefix=8) == brute(docs, 20)


def test_suffix_tree_nodes():
    texts = ["abcd", "abce", "abx", "b", "abcd"]
    tree = sp.SuffixTree([1, 1, 1, 1, 2], texts)
    same = lambda d: [tree.nodes(d)[0] == tree.nodes(d)[j] for j in range(5)]
    assert same(0) == [True, True, True, True, False] and same(2) == [True, True, True, False, False] and same(4) == [True, False, False, False, False]
    assert sp.common("", "a") == 0 and sp.common("aab", "aac") == 2 and sp.common("aa", "aab") == 2
