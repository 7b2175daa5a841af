import random
import unicodedata

import pytest

from landloom.llm.leaks import SuffixAutomaton, compare_form, cut_spans, find_leaks, placed_form, remove_leaks, segments


def brute(docs, items, n):
    out = set()
    forms = [(i, compare_form(t)) for i, t in items]
    for d, t in docs:
        f = compare_form(t)
        for i, x in forms:
            if x and (x in f if len(x) < n else any(x[p : p + n] in f for p in range(len(x) - n + 1))):
                out.add((d, i))
    return out


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, item_id string"), spark.createDataFrame(items, "item_id bigint, text string")


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(1)
    word = lambda k: "".join(rng.choice("ab字") for _ in range(k))
    items = [(i, word(rng.randint(2, 14))) for i in range(12)] + [(50, None), (51, ""), (52, "?! "), (53, "Ａb字a")]
    docs = [(i, word(rng.randint(0, 30)) + rng.choice(["", " ; X ", "\n"]) + word(5)) for i in range(200)] + [(900, None), (901, ""), (902, "、 "), (903, "ａＢ字A" * 3)]
    d, i = frames(spark, docs, items)
    for parts in (2_000_000, 20):
        got = [(r.doc_id, r.item_id) for r in find_leaks(d, i, min_chars=6, automaton_chars=parts).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(docs, items, 6)


def test_whole_long_text_repeats_and_empty_tables(spark):
    items = [(1, "The quick brown fox jumps over the lazy dog, and then it rests.")]
    doc = "過" * 300_000 + "the QUICK, brown fox jumps over the lazy dog; and THEN it rests" + "遠" * 1000
    d, i = frames(spark, [(7, doc), (7, doc), (8, doc[:300_020])], items)
    assert sorted(tuple(r) for r in find_leaks(d, i).collect()) == [(7, 1), (7, 1)]
    assert find_leaks(d, i.limit(0)).count() == 0 and find_leaks(d.limit(0), i).count() == 0
    cleaned = [r for r in remove_leaks(d, i).collect()]
    assert len(cleaned) == 2 and "quick" not in cleaned[0].text.lower() and cleaned[0].text.startswith("過") and cleaned[0].text.endswith("遠")
    short, _ = frames(spark, [(9, items[0][1])], items)
    assert remove_leaks(short, i).first().text is None


def test_matches_are_longest(spark):
    auto = SuffixAutomaton([(1, "abcde"), (2, "bcdef")], 3)
    assert auto.items_in("xxbcdxx") == {1, 2} and auto.items_in("abx") == set() and auto.spans("zabcdefz") == [(1, 7)]


def test_what_is_found_is_removed_whatever_its_form(spark):
    item = "Crème brûlée and 각 한글 text that is long enough for a match"
    items = [(1, item), (2, "ｈalf width ﬁgures of Ⅷ kinds in a passage that is long enough")]
    docs = [(1, "x " + unicodedata.normalize("NFD", item) + " y"), (2, "A " + items[1][1].upper() + " Z"), (3, "ΟΔΟΣ " + item), (4, unicodedata.normalize("NFKD", item) * 2 + "\u0301")]
    d, i = frames(spark, docs, items)
    for size in (400_000, 40):
        found = {r.doc_id for r in find_leaks(d, i, automaton_chars=size).collect()}
        rows = remove_leaks(d, i, max_coverage=1.0, automaton_chars=size).collect()
        assert found == {r.doc_id for r in rows} == {1, 2, 3, 4}
        left = {r.doc_id: r.text for r in rows}
        assert left[1] == "x  y" and left[2] == "A  Z" and left[3].strip() == "ΟΔΟΣ"


def test_pieces_make_up_the_normal_form():
    rng = random.Random(5)
    odd = "aé\u0301\u0323각ᄀ\u1161\u11a8ﬁⅧ字İΣ ½\u0344\u0f71\u0f72ｶﾞ"
    for _ in range(300):
        t = "".join(rng.choice(odd) for _ in range(rng.randint(0, 12)))
        form, begin, end = placed_form(t)
        assert form == compare_form(t) and len(form) == len(begin) == len(end) and all(a < b for a, b in zip(begin, end))
        assert [x for x, _ in segments(t)] == sorted(x for x, _ in segments(t))


@pytest.mark.parametrize("size", [400_000, 30])
def test_removal_with_any_number_of_automata(spark, size):
    rng = random.Random(3)
    word = lambda k: "".join(rng.choice("abcd") for _ in range(k))
    items = [(i, word(20)) for i in range(8)]
    docs = [(i, word(10) + " " + rng.choice(items)[1][rng.randint(0, 8) :] + "!" + word(10) + rng.choice(items)[1]) for i in range(40)] * 2
    d, i = frames(spark, docs, items)
    got = sorted(tuple(r) for r in remove_leaks(d, i, min_chars=9, automaton_chars=size, max_coverage=0.9).collect())
    auto = SuffixAutomaton([(k, compare_form(t)) for k, t in items], 9)
    want = sorted((k, *cut_spans(t, s, 0.9)) for k, t in docs if (s := auto.spans(compare_form(t))))
    assert got == want and len(got) == len(docs)
