import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cdrflow.llm import periodic_runs as P
from cdrflow.llm import queries as Q


def brute(words):
    """Every period against the whole sequence."""
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    a, runs = np.array([names[w] for w in words], dtype=int), []
    for q in range(1, len(words) // 4 + 1):
        same = np.concatenate([[False], a[:-q] == a[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1]).tolist()
        for s, e in zip(edges[::2], edges[1::2]):
            n = e - s + q
            if n >= max(6, 4 * q) and not any(s0 <= s and s + n <= s0 + n0 for s0, n0, _ in runs):
                runs.append((s, n, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def repetitive(rnd):
    vocabulary, words = rnd.choice([1, 2, 2, 3, 4, 8, 30]), []
    for _ in range(rnd.randint(1, 6)):
        unit = [rnd.randrange(vocabulary) for _ in range(rnd.randint(1, 12))]
        if rnd.random() < 0.4:
            unit = unit * rnd.randint(1, 3) + [rnd.randrange(vocabulary)]
        words += unit * rnd.randint(1, 9)
        words = words[: rnd.randint(max(1, len(words) - 5), len(words))]
    return words


def test_equals_brute_force_on_repetitive_words():
    rnd = random.Random(1)
    for _ in range(3000):
        words = repetitive(rnd)
        assert P.runs_of(words) == brute(words), words


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=70) | st.lists(st.sampled_from("abc"), max_size=90))
def test_equals_brute_force_on_small_alphabets(words):
    assert P.runs_of(words) == brute(words)


@pytest.mark.parametrize("words", [
    ["a"] * 20_000, ["a"] * 8000 + ["b"] * 8000, (["a"] * 3000 + ["b"]) * 5, ["a", "b"] * 20_000,
    [random.Random(2).randrange(3000) for _ in range(3000)] * 4,
], ids=["one word", "two words", "nested", "pair", "long period"])
def test_long_runs_stay_quick(words):
    longest = max(n for _, n, _ in P.runs_of(words))
    assert longest >= len(words) // 2 - 1


def test_grammar_gives_back_the_sequence():
    rnd = random.Random(5)
    words = repetitive(rnd) * 3
    stretches = [(0, len(words))]
    grammar = P.Grammar(words, stretches, 2)
    assert grammar.rules
    for left, length, places in grammar.rules:
        assert 0 < left < length
        assert len({tuple(words[p : p + length]) for p in places}) == 1  # every place derives the same words
    starts = grammar.rest[0]
    assert starts[0] == 0 and starts[-1] == len(words) and starts == sorted(set(starts))


def tail(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_query_equals_brute_force(spark, tmp_path):
    rnd = random.Random(7)
    texts = [None, "", " \t\n", "one", "a " * 9, "x y " * 7 + "\x1cz"] + [
        "\n ".join(f"w{w}" for w in repetitive(rnd)) for _ in range(150)]
    rows = [*enumerate(texts), (None, "n " * 8), (3, "again " * 6), (3, "again " * 6)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, runs string, h int").repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, Q.op12_grammar_runs(spark, str(tmp_path)).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        words = tail(doc_id, words)
        runs = brute(words)
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)), len(words)))
    assert got == sorted(want, key=repr)
    assert sum(w[1] > 0 for w in want) > 50


def test_no_rows(spark):
    assert P.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
