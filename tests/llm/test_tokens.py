import base64
import random

import pytest

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from landloom.llm import tokens as tk  # noqa: E402


@pytest.fixture(scope="module")
def other():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", None, " ", "\n\n  x", "Hello, world's end!  ", "於114年5月19日會議紀錄", "<|endoftext|> a", "é🎉‍👩‍👩", "\x00​\r\n", "aaaaaaaaaaaaaaaaaaaaaaa", "ｆｕｌｌ", "１２３"]


def test_pattern_is_the_vocabularys():
    assert tk.PATTERN == P.PATTERN


def test_random_words_and_texts(other):
    auto = tk.automaton(tk.vocabulary_path())
    rng = random.Random(3)
    pieces = [x for x in other._mergeable_ranks if len(x) > 1]
    for _ in range(4000):
        w = b"".join(rng.choice(pieces) for _ in range(rng.randint(1, 4)))
        assert auto.encode_word(w) == other._encode_single_piece(w)
    alphabet = "ab the  ing\n éé中文字都更 aaaa's 123 <|endoftext|> 🎉"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    assert tk.encode_texts(texts, tk.vocabulary_path()).to_pylist() == [other.encode_ordinary(t) for t in texts]


def test_corpus_nulls_long_repeats_and_round_trip(spark, other):
    long = "都市更新事業計畫 the plan " * 60_000
    rows = [(i, t, "clash") for i, t in enumerate([*TEXTS, long, TEXTS[5], TEXTS[5]])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    enc = tk.encode_corpus(df)
    got = {r.doc_id: r.ids for r in enc.collect()}
    assert got == {i: other.encode_ordinary(t or "") for i, t, _ in rows}
    back = {r.doc_id: r.text for r in tk.decode_ids(enc).collect()}
    assert back == {i: t or "" for i, t, _ in rows}
    assert tk.encode_corpus(df.limit(0)).count() == 0


def test_a_small_word_table_gives_the_same(monkeypatch, other):
    monkeypatch.setattr(tk, "KEPT_WORDS", 3)
    for _ in range(3):
        assert tk.encode_texts(TEXTS, tk.vocabulary_path()).to_pylist() == [other.encode_ordinary(t or "") for t in TEXTS]


def written_out(rng, alphabet: str, n: int):
    """A random vocabulary and its automaton with all arcs, made by the gadgets themselves: which tokens each state has an arc for."""
    vocab = {w: i for i, w in enumerate(alphabet)}
    arcs = {t: set(range(len(alphabet))) for t in range(len(alphabet))}
    names, merges = list(alphabet), []
    while len(merges) < n:
        a = rng.randrange(len(names))
        if not arcs[a]:
            continue
        b = rng.choice(sorted(arcs[a]))  # a pair that occurs
        if names[a] + names[b] in vocab:
            continue
        c = vocab[names[a] + names[b]] = len(names)
        merges.append(f"{names[a]} {names[b]}")
        names.append(names[a] + names[b])
        arcs[c] = set(arcs[b])
        arcs[a].discard(b)
        for out in arcs.values():
            if a in out:
                out.add(c)
    return vocab, merges, arcs


@pytest.mark.parametrize("seed", range(6))
def test_factored_table_equals_the_automaton_written_out(seed):
    vocab, merges, arcs = written_out(random.Random(seed), "abcd", 60)
    auto = tk.Automaton(vocab, merges)
    assert {(x, y) for x, out in arcs.items() for y in out} == {(x, y) for x in vocab.values() for y in vocab.values() if auto.has_arc(x, y)}
