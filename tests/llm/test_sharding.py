import itertools
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tickerloom.llm import sharding


def spread(sizes, shard, k, begun=None):
    sums = list(begun or [0] * k)
    for n, s in zip(sizes, shard, strict=True):
        sums[s] += n
    return max(sums) - min(sums)


def test_differencing_known_case():
    # the largest first: 8 and 7 apart, then 6 and 5, then 4: differencing ends with a spread of 2
    got = sharding.differenced([8, 7, 6, 5, 4], 2)
    assert spread([8, 7, 6, 5, 4], got, 2) == 2


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 500), max_size=7), st.integers(2, 4))
def test_every_item_gets_a_shard_and_spread_is_bounded(sizes, k):
    got = sharding.differenced(sizes, k)
    assert len(got) == len(sizes) and set(got) <= set(range(k))
    best = min((spread(sizes, p, k) for p in itertools.product(range(k), repeat=len(sizes))), default=0)
    assert best <= spread(sizes, got, k) <= max([*sizes, 0])


def test_begun_shards_are_filled_up():
    rnd = random.Random(3)
    sizes = [rnd.randrange(1, 3000) for _ in range(3000)]
    begun = [0, 50_000, 200_000, 0, 0, 1000, 0, 0]
    want = sharding.level(begun, sum(sizes))
    got = sharding.differenced(sizes, 8, [round(-w) for w in want])
    assert spread(sizes, got, 8, begun) <= 20


def test_level_leaves_a_hot_shard_alone():
    assert sharding.level([100, 0, 0], 50) == [0.0, 25.0, 25.0]


def test_shards_of_documents(spark):
    rnd = random.Random(5)
    texts = ["x" * rnd.randrange(0, 400) + str(i) for i in range(300)] + ["same " * 30] * 40 + [None, "", "é" * 10]
    rows = [(i, t, i, "q") for i, t in enumerate(texts)] + [(7, texts[7], 0, "q"), (None, "no id", 0, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard long, size string")
    got = sharding.shard_documents(docs).collect()
    assert len(got) == len(rows)
    by_shard = {s: [r for r in got if r.shard == s] for s in range(8)}
    for part in by_shard.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    byid = dict(enumerate(texts))
    for r in got:
        if r.doc_id is not None:
            body = (byid[r.doc_id] or "").encode()
            assert r["size"] == len(body) + 1 and r.text_crc32 == zlib.crc32(body)
    assert len({r.shard for r in got if r.doc_id is not None and 300 <= r.doc_id < 340}) == 1
    assert len({r.shard for r in got if r.doc_id in (340, 341)}) == 1      # null and empty are equal
    sums = [sum(r["size"] for r in part) for part in by_shard.values()]
    group = 40 * (len("same " * 30) + 1)
    assert max(sums) - min(sums) <= max(2, group - min(sums))
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_small_groups_are_dealt_in_tasks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FINE", 2)
    monkeypatch.setattr(sharding, "GROUPS_PER_TASK", 100)
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 50)
    rnd = random.Random(6)
    docs = spark.createDataFrame([(i, "t" * rnd.randrange(1, 90) + f" {i % 700}") for i in range(900)] + [(1000, "big" * 9000)],
                                 "doc_id long, text string")
    got = sharding.shard_documents(docs, 4).collect()
    hot = next(r.shard for r in got if r.doc_id == 1000)
    sums = sorted(sum(r["size"] for r in got if r.shard == s) for s in range(4) if s != hot)
    assert len(got) == 901 and sums[-1] - sums[0] <= 60
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_documents(docs).collect() == []


def test_very_long_missing_ids_and_repeats(spark):
    long = "é" * 2_000_000
    rows = [(1, long), (None, "a"), (None, "a"), (2, "a"), (2, "b"), (2, "b")]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()
    assert sorted((r.doc_id or 0, r["size"]) for r in got) == [(0, 2), (0, 2), (1, 4_000_001), (2, 2), (2, 2), (2, 2)]
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(b"a")}) == 1
    for s in range(3):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_differencing_of_small_sets_against_all_splits():
    """Two shards: never worse than the greedy rule, and the best split in most cases."""
    rnd = random.Random(12)
    best_hits = 0
    for _ in range(200):
        sizes = [rnd.randrange(1, 60) for _ in range(rnd.randrange(2, 9))]
        got = spread(sizes, sharding.differenced(sizes, 2), 2)
        greedy = [0, 0]
        for n in sorted(sizes, reverse=True):
            greedy[greedy.index(min(greedy))] += n
        best = min(spread(sizes, p, 2) for p in itertools.product(range(2), repeat=len(sizes)))
        assert best <= got <= abs(greedy[0] - greedy[1])
        best_hits += got == best
    assert best_hits > 120
