import zlib

import numpy as np
import pyarrow as pa
import pytest

from tickerloom.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def grams_of(word):
    text = " " + word.lower() + " "
    return [text[max(0, k - toxicity.ORDER + 1): k + 1] for k in range(1, len(text))]


def unpack(key):
    return bytes(int(key).to_bytes(8, "big")).lstrip(b"\0").decode("latin1")


def test_grams_are_the_bytes_of_words():
    data = np.frombuffer(b"The idiot  a", np.uint8)
    keys, begin = toxicity._grams(data, np.array([0, 4, 11]), np.array([3, 9, 12]))
    assert [unpack(k) for k in keys] == grams_of("The") + grams_of("idiot") + grams_of("a")
    assert begin.tolist() == [0, 4, 10]


def test_class_models_are_probabilities():
    """Every context's chances, seen and unseen letters together, sum to one in both classes."""
    rnd = np.random.default_rng(1)
    words = ["".join(rnd.choice(list("abc"), rnd.integers(1, 7))) for _ in range(60)]
    def table(ws):
        out = {}
        for w in ws:
            for g in grams_of(w):
                out[g] = out.get(g, 0) + 1
        return out
    t, o = table(words[:30]), table(words[20:])
    every = sorted({*t, *o}, key=lambda g: int.from_bytes(g.encode(), "big"))
    keys = np.array([int.from_bytes(g.encode(), "big") for g in every], np.uint64)
    level = toxicity._level(keys)
    shared = toxicity._shared(keys, level)
    # chances of the shared model over all letters after a context, by the definition
    model = toxicity.Model.of_counts(keys, np.array([t.get(g, 0) for g in every]), np.array([o.get(g, 0) for g in every]))
    assert np.isfinite(model.evidence).all() and (shared > 0).all() and (shared <= 1).all()
    for counts in (t, o):
        n = np.array([counts.get(g, 0) for g in every], float)
        cut = toxicity._discount(n)
        for context in {g[:-1] for g in counts}:
            mine = [k for k, g in enumerate(every) if g[:-1] == context]
            total, kinds = n[mine].sum(), (n[mine] > 0).sum()
            seen = sum(max(n[k] - cut, 0) / total for k in mine)
            assert seen + cut * kinds / total == pytest.approx(1)
    assert model.of_words(*toxicity._grams(np.frombuffer(b"zzzz", np.uint8), np.array([0]), np.array([4]))).shape == (1,)


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op10_kneser_ney_toxicity"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) == docs and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if rows[r.doc_id].held_out]
    score, y = np.array([rows[d].score for d, _ in labels]), np.array([t for _, t in labels])
    rank = np.argsort(np.argsort(score)) + 1
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.93 and ((score >= 0.5) == y).mean() > 0.93 and (score[y == 0] >= 0.5).mean() < 0.02


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(k, f"words are fine number {k % 9}" + (" idiot moron scum idiot" if k % 3 == 0 else ""), 0.5) for k in range(400)]
                                 + [(None, "idiot moron", 0.1), (900, None, 0.1), (901, "", 0.1), (902, "x" * 3_000_000 + " idiot", 0.1)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(400)] + [(None, 1, 1), (900, 1, None), (77777, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    rows = {r.doc_id: r for r in toxicity.scores(docs, model).collect()}
    assert len(rows) == 404 and all(rows[k].predicted == int(k % 3 == 0) for k in range(400))
    assert rows[None].predicted == 1 and rows[900].score == rows[901].score < 0.5
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {k for k in range(400) if k % 3}
    assert toxicity.scores(docs.limit(0), model).collect() == []
    blank = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.scores(docs, blank).collect()} == {0.0}
    only = toxicity.fit(docs, labels.where("toxic = 1"))
    assert {r.score > 0.9 for r in toxicity.scores(docs, only).collect()} == {True}


def test_evidence_does_not_depend_on_blocks(monkeypatch):
    from tickerloom.llm import shared

    model = toxicity.Model(np.array([int.from_bytes(b" i", "big")], np.uint64), np.array([4.0]), np.empty(0, np.uint64), np.empty(0))
    column = pa.array(["idiot fine", "fine", None, "i " * 40 + "idiot"])
    whole = model.features(column)
    monkeypatch.setattr(shared, "BLOCK_BYTES", 9)
    assert np.allclose(model.features(column), whole)


def test_scale_does_not_depend_on_the_sample_size(spark):
    """A bound that binds both classes leaves the share of predicted rows and the scores about as they are."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = {}
    for most in (10_000, 300):
        rows = {r.doc_id: r for r in toxicity.scores(docs, toxicity.fit(docs, labels, most)).collect()}
        found[most] = sum(r.predicted for r in rows.values()), np.mean([r.score for r in rows.values()])
    (all_n, all_mean), (few_n, few_mean) = found[10_000], found[300]
    assert few_n == pytest.approx(all_n, rel=0.25) and few_mean == pytest.approx(all_mean, abs=0.05)


def test_shares_weigh_classes_like_repeated_rows():
    rnd = np.random.default_rng(2)
    x = np.column_stack([rnd.normal(size=(80, 6)), np.ones(80)])
    label = (x[:, 0] + rnd.normal(size=80) > 0).astype(float)
    model = lambda: toxicity.Model(np.empty(0, np.uint64), np.empty(0), np.empty(0, np.uint64), np.empty(0))
    repeated = np.concatenate([x, *[x[label == 0]] * 4]), np.concatenate([label, *[label[label == 0]] * 4])
    a, b = model().scaled(x, label, (5.0, 1.0)), model().scaled(*repeated)
    assert np.allclose(a.weights, b.weights, atol=1e-4) and np.allclose(a.mean, b.mean)


def brute_model(toxic, ordinary):
    """Class-conditional Kneser-Ney by definition, over strings: evidence of a gram, and of one not seen."""
    from collections import Counter, defaultdict
    from math import log

    def discount(counts):
        once, twice = (sum(c == n for c in counts) for n in (1, 2))
        return once / (once + 2 * twice) if once and twice else 0.75

    classes = [Counter(g for w in words for g in grams_of(w)) for words in (toxic, ordinary)]
    grams = set(classes[0]) | set(classes[1])
    # continuation counts: how many different bytes stood before a shorter gram
    longer, shorter = defaultdict(set), {}
    for k in range(toxicity.ORDER, 1, -1):
        longer[k] |= {g for g in grams if len(g) == k}
        before = defaultdict(set)
        for g in longer[k]:
            before[g[1:]].add(g[0])
        shorter[k - 1] = {g: len(b) for g, b in before.items()}
        longer[k - 1] |= set(before)

    def backoff(gram):
        if not gram:
            return 1 / 256
        counts = shorter[len(gram)]
        cut = discount(counts.values())
        mine = [c for g, c in counts.items() if g[:-1] == gram[:-1]]
        return max(counts[gram] - cut, 0) / sum(mine) + cut * len(mine) / sum(mine) * backoff(gram[1:])

    def evidence(gram):
        value = 0.0
        for sign, counts in ((1, classes[0]), (-1, classes[1])):
            cut = discount([counts[g] for g in grams])
            mine = [c for g, c in counts.items() if g[:-1] == gram[:-1]]
            if gram in grams:
                low = backoff(gram[1:])
                value += sign * log(max(counts[gram] - cut, 0) / sum(mine) + cut * len(mine) / sum(mine) * low if mine else low)
            elif mine:                        # what both back off to cancels
                value += sign * log(cut * len(mine) / sum(mine))
        return value

    return grams, evidence


def test_evidence_equals_the_definition():
    rnd = np.random.default_rng(7)
    words = ["".join(rnd.choice(list("abcd"), rnd.integers(1, 8))) for _ in range(70)]
    toxic, ordinary = words[:40], words[30:]
    grams, evidence = brute_model(toxic, ordinary)
    every = sorted(grams, key=lambda g: int.from_bytes(g.encode(), "big"))
    counts = [np.array([sum(grams_of(w).count(g) for w in ws) for g in every]) for ws in (toxic, ordinary)]
    model = toxicity.Model.of_counts(np.array([int.from_bytes(g.encode(), "big") for g in every], np.uint64), *counts)
    assert model.evidence == pytest.approx([evidence(g) for g in every])
    for word in [*words[:10], "abz", "zzz", "dcbadcba", "b"]:
        data = np.frombuffer(word.encode(), np.uint8)
        got = model.of_words(*toxicity._grams(data, np.array([0]), np.array([len(word)])))[0]
        assert got == pytest.approx(sum(evidence(g) for g in grams_of(word)), abs=1e-9)


def test_ties_repeats_and_missing_ids_in_scores(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(1, ""), (1, ""), (None, None), (2, None), (3, "you idiot " * 50_000)], "doc_id long, text string")
    rows = toxicity.scores(odd, model).collect()
    empty = {r.score for r in rows if r.doc_id in (1, 2, None)}
    assert len(rows) == 5 and len(empty) == 1 and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert toxicity.without_toxic(odd, model).count() + sum(r.predicted for r in rows) == 5
    assert toxicity.scores(odd.limit(0), model).collect() == [] and toxicity.without_toxic(odd.limit(0), model).collect() == []
