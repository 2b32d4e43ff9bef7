import math
import random
import re
import zlib
from collections import Counter

import pytest

from tests.conftest import SF
from tickerloom.llm import katz, queries


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "</s>"]


class Brute:
    def __init__(self, texts):
        self.uni, self.bi, self.ctx = Counter(), Counter(), Counter()
        for t in texts:
            w = tokens_of(t)
            self.uni.update(w)
            for a, b in zip(["<s>", *w], w, strict=False):
                self.bi[a, b] += 1
                self.ctx[a] += 1
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.d1, self.d2 = self.cuts(self.uni), self.cuts(self.bi)
        free = sum((1 - self.d1(c)) * c for c in self.uni.values())
        self.total, self.free = (self.n, free) if free > 0 else (self.n + 1, 1)
        self.after = {}
        for (a, b), c in self.bi.items():
            self.after.setdefault(a, {})[b] = c

    @staticmethod
    def cuts(counts):
        n = Counter(counts.values())
        def d(c):
            if c > 5 or not n[1] or not n[6]:
                return 1.0
            a = 6 * n[6] / n[1]
            if not n[c] or not n[c + 1] or a >= 1:
                return 1.0
            x = ((c + 1) * n[c + 1] / (c * n[c]) - a) / (1 - a)
            return x if 0 < x < 1 else 1.0
        return d

    def word(self, w):
        c = self.uni.get(w, 0)
        return self.d1(c) * c / self.total if c else self.free / self.total

    def chance(self, u, w):
        if not self.ctx.get(u):
            return self.word(w)
        after = self.after[u]
        free = sum((1 - self.d2(c)) * c for c in after.values())
        total = self.ctx[u] if free > 0 else self.ctx[u] + 1
        free = free if free > 0 else 1
        if w in after:
            return self.d2(after[w]) * after[w] / total
        return free / total / (1 - sum(self.word(x) for x in after)) * self.word(w)

    def score(self, text):
        w = tokens_of(text)
        return sum(math.log10(self.chance(a, b)) for a, b in zip(["<s>", *w], w, strict=False))


def compare(rows, got):
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    model = Brute([t for d, t in rows if not held(d)])
    assert len(got) == len(rows)
    want = sorted(((d is None, d or 0, len(tokens_of(t)), round(model.score(t), 6), held(d), sum(w in model.uni for w in tokens_of(t)),
                    round(sum(math.log10((model.uni.get(w, 0) + 1) / (model.n + model.v + 1)) for w in tokens_of(t)), 6)) for d, t in rows))
    have = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, round(r.score, 6), r.held_out, r.n_known, round(r.base_score, 6)) for r in got)
    for w, h in zip(want, have, strict=True):
        assert w == pytest.approx(h, abs=2e-5)
    assert {r.train_tokens for r in got} == {model.n}
    return model


def prose(rnd, n):
    return " ".join(rnd.choice(["the", "The", "of", "and", *(f"w{int(rnd.expovariate(0.004))}" for _ in range(6))]) for _ in range(n))


@pytest.mark.parametrize("block, bucket", [(3_000_000, 3_000_000), (400, 700)])
def test_scores_equal_brute_force(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", block)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", bucket)
    rnd = random.Random(2)
    rows = [(k, prose(rnd, rnd.randrange(0, 60))) for k in range(200)] + [(None, "the of and"), (300, None), (301, ""), (302, "the the the"), (302, "the the the"), (303, "pair pair " * 500)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, block int")
    model = compare(rows, katz.scores(docs).collect())
    assert any(model.d2(c) < 1 for c in range(1, 6)) and any(model.d1(c) < 1 for c in range(1, 6))
    for u in ["<s>", "the", "w1", "pair", "never seen"]:
        total = sum(model.chance(u, w) for w in model.uni) + model.chance(u, "unknown word")
        assert total == pytest.approx(1)


def test_query_over_tables(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    compare(rows, queries.QUERIES["op9_katz_backoff"](spark, SF).collect())


def test_tiny_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a c")], "doc_id long, text string")
    compare([(1, "a b"), (2, "a c")], katz.scores(docs).collect())
    assert katz.scores(docs.limit(0)).collect() == []


def test_a_text_over_many_blocks(spark, monkeypatch):
    from tickerloom.llm import shared

    monkeypatch.setattr(shared, "BLOCK_BYTES", 256)          # the words of a text come in pieces
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 100)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 300)
    rnd = random.Random(8)
    rows = [(1, prose(rnd, 3000)), (2, prose(rnd, 40)), (3, "x" * 5000 + " the"), (4, prose(rnd, 700))]
    compare(rows, katz.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect())
