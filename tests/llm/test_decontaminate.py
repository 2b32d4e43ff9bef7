import random

import pytest

from tests.conftest import SF
from tickerloom.llm import decontaminate as dc
from tickerloom.llm import queries


def fold(text):
    return " ".join(text.lower().split())


def fewest_edits(item, text):
    """Least edits between ``item`` and any passage of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def damaged(rnd, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rnd.randrange(len(chars))
        kind = rnd.randrange(3)
        chars[at:at + (kind != 2)] = [] if kind == 0 else [rnd.choice("abcxyz")] if kind == 1 else [rnd.choice("abcxyz")]
    return "".join(chars)


def test_edited_passages_against_full_alignment():
    rnd = random.Random(4)
    words = ["th", "er", "on", "the", "and", "re", "in", "at", "ed", "nd"]
    def prose(n):
        return " ".join("".join(rnd.choices(words, k=rnd.randrange(1, 4))) for _ in range(n))
    items = [(k, prose(25)) for k in range(12)] + [(50, "short it"), (51, "tiny"), (52, None), (53, "")]
    known = dc.Benchmark(items)
    texts, hits = [], 0
    for k in range(60):
        item = rnd.choice(items[:12])[1]
        texts.append(prose(20) + " " + damaged(rnd, item, rnd.randrange(0, 26)).upper().replace(" ", "\n  ", 2) + " " + prose(10))
    texts += ["", "a", items[3][1], items[0][1] + items[1][1]]
    for text, found in zip(texts, known.search(texts), strict=True):
        best = {}
        for item_id, lo, hi, edits in found:
            assert fewest_edits(fold(dict(items)[item_id]), fold(text[lo:hi])) <= edits
            best[item_id] = min(best.get(item_id, 99), edits)
        for item_id, item in items[:12]:
            truth = fewest_edits(fold(item), fold(text))
            if truth <= int(len(item) * dc.EDIT_SHARE):
                assert best[item_id] == truth
                hits += 1
            else:
                assert item_id not in best
    assert hits > 30


def test_short_items_and_places():
    known = dc.Benchmark([(1, "short it"), (2, "tiny")])
    assert known.search(["say SHORT \t it! tiny"]) == [[(1, 4, 14, 0)]]
    assert dc.Benchmark([]).search(["x"]) == [[]]


@pytest.mark.parametrize("chars", [1, 1 << 20])
def test_query_against_containment(spark, chars, monkeypatch):
    monkeypatch.setattr(dc, "BENCHMARK_CHARS", 3000 if chars == 1 else 1 << 22)
    monkeypatch.setattr(dc, "BLOCK_CHARS", chars)
    got = {(r.doc_id, r.item_id): r for r in queries.QUERIES["op4_qgram_decontamination"](spark, SF).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    exact = {(d, k) for d, t in docs.items() for k, item in items.items() if fold(item) in fold(t)}
    assert exact and exact <= set(got)
    for (d, k), r in got.items():
        assert r.distance <= len(items[k]) * dc.EDIT_SHARE and ((d, k) in exact) == (r.distance == 0)
        assert fewest_edits(fold(items[k]), fold(docs[d][r.start:r.end])) == r.distance
    kept = dc.without_matches(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert {r.doc_id for r in kept.collect()} == set(docs) - {d for d, _ in got}


def test_odd_rows(spark):
    item = "a passage of the benchmark that is long enough"
    docs = spark.createDataFrame([(None, item, 1), (1, None, 1), (2, "", 1), (3, f"x {item}", 1), (3, f"x {item}", 1)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(7, item, "x"), (7, item, "x"), (8, None, "x")], "item_id long, text string, start string")
    rows = dc.matches(docs, bench).collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 0, 3, 3, 3, 3]
    assert [r.doc_id for r in dc.without_matches(docs, bench).orderBy("doc_id").collect()] == [1, 2]
    assert dc.matches(docs.limit(0), bench).collect() == [] and dc.matches(docs, bench.limit(0)).collect() == []


def test_repeated_letters_take_bounded_memory():
    import tracemalloc

    known = dc.Benchmark([(1, "a" * 400), (2, "abcdefgh" * 30)])
    texts = ["a" * 40_000, "x" * 50 + "abcdefgh" * 2_000, "b" * 3_000]
    tracemalloc.start()
    found = known.search(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20
    assert {f[0] for f in found[0]} == {1} and {f[0] for f in found[1]} == {2} and found[2] == []
    assert min(f[3] for f in found[0]) == min(f[3] for f in found[1]) == 0


def test_hits_in_steps_give_the_same(monkeypatch):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcd") for _ in range(rnd.randrange(2, 7))) for _ in range(30)]
    items = [(n, " ".join(rnd.choice(words) for _ in range(20))) for n in range(8)]
    texts = [" ".join(rnd.choice(words) for _ in range(200)) + " " + items[n % 8][1] for n in range(12)]
    whole = dc.Benchmark(items).search(texts)
    monkeypatch.setattr(dc, "HITS", 50)
    assert dc.Benchmark(items).search(texts) == whole and all(whole)
