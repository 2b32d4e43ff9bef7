import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tests.compare import connect, difference
from tests.conftest import SF
from tickerloom.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(convs):
    """The nodes of ``{conv_id: [(role, text), ...]}`` by definition."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = []
    for node, inside in members.items():
        below = [u for u in members if u[: len(node)] == node]
        children = [u for u in below if len(u) == len(node) + 1]
        leaves = [u for u in below if not any(v[:-1] == u for v in members if v)]
        saved = sum((len(members[u]) - 1) * len(u[-1][1].encode()) for u in below if u)
        ends = ",".join(str(c) for c in sorted(inside) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(inside), len(node), parent, len(inside), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def ordered(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for *_, r, x in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def as_rows(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


def plain_trie(spark, rows):
    turns = trie.numbered_turns(spark.createDataFrame(rows, SCHEMA))
    lengths = turns.groupBy("conv_id").count().withColumnRenamed("count", "n_turns")
    return trie.prefix_trie(turns.join(lengths, "conv_id"), lengths)


def random_rows(seed, n, longest, words):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        base = random.Random(rnd.randrange(4))
        length = rnd.randrange(1, longest)
        rows += [(c * 3, t, base.choice("ua"), f"t{base.randrange(words)} é") for t in range(length)]
        if rnd.random() < 0.5:
            rows.append((c * 3, longest + 1, None, None))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,longest", [(1, 4), (2, 30), (3, 60)])
def test_trie_equals_brute_force(spark, seed, longest):
    rows = random_rows(seed, 25, longest, 3)
    assert as_rows(plain_trie(spark, rows)) == brute(ordered(rows))


def test_chunks_spans_and_heavy_parents(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 2)
    monkeypatch.setattr(trie, "BLOCK", 3)
    monkeypatch.setattr(trie, "ENDS_SPAN", 7)
    monkeypatch.setattr(trie, "max", lambda a, b: 5, raising=False)
    rows = random_rows(7, 40, 40, 2) + [(1000 + k, t, "u", f"same {t}") for k in range(30) for t in range(9)] \
        + [(2000 + k, t, "u", f"same {t}" if t < 2 else f"own {k} {t}") for k in range(20) for t in range(4)]
    assert as_rows(plain_trie(spark, rows)) == brute(ordered(rows))


ODD = [
    (5, None, "user", "hi"), (5, 0, None, "é"), (5, 1, "user", None), (6, 3, "user", "hi"), (6, None, "", "hi"), (7, 1, "user", "hi"),
    (7, 1, "user", "hi"), (None, 0, "user", "no id"), (8, 0, "assistant", "x" * 300_000), (9, 0, "assistant", "x" * 300_000),
    (10, 0, "", ""), (11, 0, None, None),
]


def test_odd_rows_and_clashing_names(spark):
    df = spark.createDataFrame([(*r, 1, 2, "p") for r in ODD], SCHEMA + ", pos int, chunk int, part string")
    turns = trie.numbered_turns(df)
    lengths = turns.groupBy("conv_id").count().withColumnRenamed("count", "n_turns")
    assert as_rows(trie.prefix_trie(turns.join(lengths, "conv_id"), lengths)) == brute(ordered(ODD))
    empty = trie.numbered_turns(df.limit(0))
    lengths = empty.groupBy("conv_id").count().withColumnRenamed("count", "n_turns")
    assert as_rows(trie.prefix_trie(empty.join(lengths, "conv_id"), lengths)) == []


def test_one_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 16)
    rows = [(1, t, "u", str(t % 7)) for t in range(3000)] + [(2, t, "u", str(t % 7)) for t in range(40)] + [(3, 0, "u", "0")]
    got = as_rows(plain_trie(spark, rows))
    assert len(got) == 3001
    assert (1, 0, None, 3, 1, 1, 1 * 2 + 39, hashlib.sha256(b"").hexdigest()) in got
    assert (1, 40, 1, 2, 1, 1, 1, hashlib.sha256(b"2").hexdigest()) in got


@pytest.mark.parametrize("rows", [random_rows(11, 60, 14, 3), ODD, [(c, t, "u", "same") for c in range(30) for t in range(c % 4 + 1)], []])
def test_query_equals_brute_force(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert as_rows(queries.op12_conversation_trie(spark, str(tmp_path))) == (brute(rebuilt(ordered(rows))) if rows else [])


def test_query_equals_sql(spark):
    name = "op12_conversation_trie"
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE[name]) is None
