import random
import re

import pytest

from tests.conftest import SF
from tickerloom.llm import jaccard, queries
from tickerloom.llm.components import components


def shingle_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(rows, n, percent):
    """``doc_id -> (size, component)`` by all pairs that share a shingle."""
    sets = [shingle_set(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    holders = {}
    for k, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    pairs = {(a, b) for ks in holders.values() for i, a in enumerate(ks) for b in ks[i + 1:]}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if common * 100 >= percent * (len(sets[a]) + len(sets[b]) - common):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    least = {}
    for k, (d, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), d), d)
    return sorted((d, len(s), least[root(k)]) for k, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def near_copies(rnd, count):
    words = [f"w{k}" for k in range(40)]
    out = []
    for _ in range(12):
        base = rnd.choices(words, k=rnd.randrange(1, 90))
        for _ in range(count):
            copy = list(base)
            for _ in range(rnd.randrange(0, 5)):
                if copy:
                    at = rnd.randrange(len(copy))
                    copy[at:at + 1] = rnd.choice([[], ["NEW" + str(rnd.randrange(9))], [copy[at], "ins"]])
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80), (1, 60)])
def test_classes_equal_brute_force(spark, n, percent):
    rnd = random.Random(n)
    texts = near_copies(rnd, 14) + ["", None, " \t", "one", "ONE", "one two", "same same same same same same"] + ["common line " * 30] * 9
    rows = [(k * 3 + 1, t) for k, t in enumerate(texts)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, node string").coalesce(2)
    assert got(jaccard.near_duplicate_classes(docs, n, percent)) == brute(rows, n, percent)


def test_query_over_tables(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(queries.QUERIES["op7_ngram_jaccard"](spark, SF)) == brute(rows, 3, 90)


def test_shuffled_texts_when_too_many_for_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_NODES", 1)
    rows = list(enumerate(near_copies(random.Random(8), 4)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert got(jaccard.near_duplicate_classes(docs, 3, 90)) == brute(rows, 3, 90)


def test_one_per_class(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(5, long), (3, long + " more"), (9, long), (None, long), (7, "alone here with five words"), (7, "alone here with five words"),
            (7, "another text under the same id"), (8, ""), (2, None), (2, None)]
    docs = spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(rows)], "doc_id long, text string, extra int").coalesce(2)
    kept = jaccard.one_per_class(docs)
    assert kept.columns == docs.columns
    rows = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    assert [d for d, _ in rows] == [0, 2, 2, 3, 7, 7, 8]
    assert jaccard.one_per_class(docs.limit(0)).collect() == []
    assert jaccard.near_duplicate_classes(docs.limit(0)).collect() == []


def test_a_row_without_doc_id_hides_no_equal_row(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(None, long), (None, ""), (5, long), (None, long), (3, long + " more"), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = jaccard.near_duplicate_classes(docs, 5, 80).where("doc_id is not null")
    assert got(found) == [(3, 57, 3), (5, 56, 3), (8, 0, 8)]
    kept = jaccard.one_per_class(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, long), (0, ""), (0, long), (3, long + " more"), (8, "")])


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (5, 4)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == 61 + 60
    assert {r.node: r.root for r in rows} == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)}


def test_one_per_class_with_clashing_names(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, 5, "a", True, 7), (2, text, 6, "b", False, 8), (3, "quite another text of some words here", 1, "c", True, 9), (None, text, 0, "d", True, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int, _node string, some boolean, Least int")
    got = jaccard.one_per_class(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], rows[2], rows[3]], key=str)


def test_copies_far_from_one_another_make_no_pairs(spark, monkeypatch):
    """Of a common text there are near copies, linked with it, and far ones, linked with nothing."""
    base, fresh = [f"w{k}" for k in range(400)], iter(range(10**6))

    def copy(edits):
        out = list(base)
        for at in random.Random(edits).sample(range(9, 400, 10), edits):
            out[at] = f"own{next(fresh)}"
        return " ".join(out)

    rows = list(enumerate([" ".join(base), *[copy(3) for _ in range(25)], *[copy(10) for _ in range(25)]]))
    met, pairs = [], jaccard._pairs

    def counted(df):
        met.append(df.count())
        return pairs(df)

    monkeypatch.setattr(jaccard, "_pairs", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.near_duplicate_classes(df)) == brute(rows, 5, 80)
    assert sum(met[1:]) <= len(rows)
