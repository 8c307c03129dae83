"""The token automaton against the tokenizers library, and as an exact round trip."""

import os
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparvane.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.DEFAULT_VOCABULARY), reason="no vocabulary")


@pytest.fixture(scope="module")
def automaton():
    return bpe.MergeAutomaton.load(bpe.DEFAULT_VOCABULARY)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.DEFAULT_VOCABULARY)
    t.encode_special_tokens = True
    return t


ODD = [
    None, "", " ", "   ", "\n\n  x \t", "<|endoftext|>", "a<|endoftext|>b", "aaaaaaaaaaaaaaaaaaaaaaa", "=" * 500, "日本語のテキスト、字", "🙂🙂👩‍👩‍👧", "é́​",
    "I'll we've don't IT'S", "x" * 3000, "\x00\x01\x7f", "ǅ ß İ ſ", "     a", "1234567890" * 9, "word " * 2000,
]


def test_against_library(automaton, library):
    got = bpe.TextEncoder(automaton).encode(ODD).to_pylist()
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in ODD]
    assert bpe.TextEncoder(automaton).count(ODD).to_pylist() == [len(x) for x in got]
    assert bpe.TextEncoder(automaton).encode([]).to_pylist() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text("abeth '\n", max_size=60), max_size=8))
def test_random_texts(automaton, library, texts):
    got = bpe.TextEncoder(automaton).encode(texts).to_pylist()
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_small_memory_gives_the_same(automaton, monkeypatch):
    texts = [f"w{k} {'ab' * (k % 30)} x{k * 7}" for k in range(300)] * 2
    want = bpe.TextEncoder(automaton).encode(texts).to_pylist()
    monkeypatch.setattr(bpe, "_REMEMBERED", 50)
    few = bpe.TextEncoder(automaton)
    monkeypatch.setattr(few, "_chunks", lambda t, n=0: ([x] for x in t))
    assert few.encode(texts).to_pylist() == want


def test_merge_order_of_repeats():
    """Of overlapping places the leftmost is merged first, also for a merge of two equal tokens."""
    symbols = bpe.printable_bytes()
    vocabulary = {c: k for k, c in enumerate(symbols)} | {"aa": 256, "aab": 257, "ba": 258}
    a = bpe.MergeAutomaton(vocabulary, [("a", "a"), ("aa", "b"), ("b", "a")])
    flat, start, number = a.encode_words([b"aaa", b"aaaa", b"aab", b"aaab", b"baa", b"aba"])
    got = [flat[s : s + n].tolist() for s, n in zip(start, number)]
    x, b = vocabulary["a"], vocabulary["b"]
    assert got == [[256, x], [256, 256], [257], [256, x, b], [b, 256], [x, 258]]
    with pytest.raises(ValueError):
        bpe.MergeAutomaton(vocabulary, [("a", "a"), ("aa", "b"), ("a", "a")])


def test_operator(spark):
    frame = spark.createDataFrame([(k, t, [1]) for k, t in enumerate(ODD)] + [(3, ODD[3], [1])], "doc_id long, text string, ids array<int>")
    out = bpe.encode_corpus(frame)
    rows = {r["doc_id"]: r["ids"] for r in out.collect()}
    assert rows[0] == [] and rows[1] == [] and 50256 not in rows[5]
    back = out.select("doc_id", bpe.decode(out["ids"], bpe.compiled(spark)).alias("t"))
    assert {r["doc_id"]: r["t"] for r in back.collect()} == {k: t or "" for k, t in enumerate(ODD)}
    assert bpe.encode_corpus(frame.limit(0)).count() == 0


def test_long_words(monkeypatch):
    """Few words of a length are read byte by byte, many side by side: the ids are the same, in a time that grows with the bytes."""
    automaton = bpe.MergeAutomaton.load(bpe.DEFAULT_VOCABULARY)
    rnd = random.Random(3)
    words = ["".join(rnd.choice("ab-=.é密xyz0") for _ in range(rnd.randint(1, 120))).encode() for _ in range(300)]
    words += [b"-" * 777, b"=" * 2500, ("aGVsbG8" * 300).encode(), "密码".encode() * 500, bytes(range(256))]
    out = []
    for few in (0, 1000):
        monkeypatch.setattr(bpe, "_FEW", few)
        flat, start, number = automaton.encode_words(words)
        out.append([flat[a : a + k].tolist() for a, k in zip(start, number)])
    assert out[0] == out[1]
    began = time.perf_counter()
    assert len(automaton._encode_long(b"-" * 300_000)) < 300_000 and time.perf_counter() - began < 10
