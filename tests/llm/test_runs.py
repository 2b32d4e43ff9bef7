import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickerloom.llm import queries, runs
from tickerloom.llm.shared import word_hashes


def hashed(words):
    import pyarrow as pa

    parts = [h for _, h, _ in word_hashes(pa.array([" ".join(words)]), fold=False)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def smallest_period(words):
    return next(p for p in range(1, len(words) + 1) if words[p:] == words[: len(words) - p])


def brute(words):
    """By definition: every maximal stretch of every period, kept if that is its smallest period."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(24, 3 * q) and smallest_period(words[start: start + length]) == q:
                found.append((start, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]


def test_single_word_and_borders():
    assert runs.word_runs(hashed(["a"] * 23)) == []
    assert runs.word_runs(hashed(["a"] * 24)) == [(0, 24, 1)]
    assert runs.word_runs(hashed(["x", *["a"] * 30, "y"])) == [(1, 30, 1)]
    assert runs.word_runs(hashed(["a", "A"] * 12)) == [(0, 24, 2)]            # case counts
    assert runs.word_runs(hashed([])) == []
    line = [str(k) for k in range(9)]
    assert runs.word_runs(hashed(line * 3)) == [(0, 27, 9)]
    assert runs.word_runs(hashed((line * 3)[:-1])) == []


@pytest.mark.parametrize("q", [1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 40, 63, 64, 65, 100])
def test_every_width_at_its_border(q):
    rnd = random.Random(q)
    base = [rnd.choice("ab") + str(rnd.randrange(3)) for _ in range(q)]
    for length in (max(24, 3 * q) - 1, max(24, 3 * q), max(24, 3 * q) + 1, 5 * q + 3):
        words = ["l"] * 3 + (base * 6)[:length] * 1 + ["r"] * 3
        assert runs.word_runs(hashed(words)) == brute(words)


pieces = st.lists(
    st.tuples(st.lists(st.sampled_from("aab"), min_size=1, max_size=20), st.integers(1, 9), st.integers(0, 6)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_equals_brute_force(parts):
    words = [w for body, turns, cut in parts for w in (body * turns)[: len(body) * turns - cut]]
    found = runs.word_runs(hashed(words))
    assert found == brute(words)
    assert runs.collapsed([w.encode() for w in words], found).decode().split() == brute_collapsed(words, found)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_nested_repeats_equal_brute_force(seed):
    rnd = random.Random(seed)
    words = ["a", "b"]
    while len(words) < 150:                                   # repeats of repeats, with a word changed at times
        body = words[-rnd.randrange(1, min(len(words), 60) + 1):] * rnd.randrange(1, 5)
        if rnd.random() < 0.4:
            body[rnd.randrange(len(body))] = rnd.choice("abc")
        words += body
    assert runs.word_runs(hashed(words)) == brute(words)


def test_one_word_a_million_times_and_fibonacci():
    assert runs.word_runs(np.full(1_000_000, 7, np.uint64)) == [(0, 1_000_000, 1)]
    a, b = ["a"], ["a", "b"]
    while len(b) < 400:
        a, b = b, b + a
    assert runs.word_runs(hashed(b)) == brute(b)


ROWS = [
    (1, "x " + "ring the bell " * 20 + "y", 0), (2, None, 0), (3, "", 0), (4, " \t\n ", 0), (5, "no  repeats\there", 0),
    (5, "no  repeats\there", 0), (None, "é ü " * 12, 0), (6, "ring " * 23, 0), (7, "zwölf\nboxkämpfer\x0b" * 12, 0),
]


def test_periodic_runs_of_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, runs int").withColumnRenamed("runs", "collapsed")
    got = {}
    for r in runs.periodic_runs(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [(r.start, r.length, r.period) for r in got[1][0].runs] == [(1, 60, 3)]
    assert got[1][0].collapsed == "x ring the bell y" and got[1][0].n_words == 62
    for k in (2, 3, 4):
        assert (got[k][0].n_words, got[k][0].runs, got[k][0].collapsed) == (0, [], "")
    assert [r.collapsed for r in got[5]] == ["no repeats here"] * 2
    assert [tuple(x) for x in got[None][0].runs] == [(0, 24, 2)] and got[None][0].collapsed == "é ü"
    assert got[6][0].runs == [] and got[7][0].collapsed == "zwölf boxkämpfer"
    assert runs.periodic_runs(docs.limit(0)).collect() == []


def test_text_longer_than_a_block(spark):
    words = [f"w{k}" for k in range(150_000)] + ["lorem", "ipsum", "dolor"] * 100_000 + ["end"]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "after " * 30)], "doc_id long, text string")
    got = {r.doc_id: r for r in runs.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(150_000, 300_000, 3)] and len(got[1].collapsed.split()) == 150_004
    assert [tuple(x) for x in got[2].runs] == [(0, 30, 1)]


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    words = [w.decode() for w in words]
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(brute_collapsed(words, found)).encode()).hexdigest(),
    )


def test_query_equals_brute_force(spark, tmp_path):
    rnd = random.Random(11)
    rows = [(i, " ".join(rnd.choice("ab") * rnd.randrange(1, 3) for _ in range(rnd.randrange(150)))) for i in range(150)]
    rows += [(1000, "one two " * 30 + "x " * 40), (1001, None), (None, "q " * 50), (1000, "one two " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((expected(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 10
