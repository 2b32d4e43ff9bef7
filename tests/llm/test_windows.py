import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickerloom.llm import packing, queries, windows


def padding(length, window):
    return 0 if length & (length - 1) == 0 else window - length


def cost(cuts, penalty, window):
    return sum(padding(b - a, window) + penalty[b] for a, b in zip(cuts, cuts[1:], strict=False))


def least(places, penalty, window):
    """By definition: every predecessor within a window is tried."""
    best = {0: 0}
    for i, place in enumerate(places):
        best[place] = penalty[place] + min(
            best[j] + padding(place - j, window) for j in [0, *places[:i]] if place - window <= j < place and j in best)
    return best[places[-1]]


gaps = st.lists(st.tuples(st.integers(1, 16), st.sampled_from([0, 1, 3, 9])), min_size=1, max_size=60)


@settings(max_examples=300, deadline=None)
@given(gaps, st.sampled_from([16, 20, 33]), st.integers(1, 30))
def test_cuts_cost_as_little_as_brute_force(steps, window, every):
    places = np.cumsum([g for g, _ in steps]).tolist()
    penalties = [p for _, p in steps]
    state, got = windows.WindowCuts(window), [0]
    for at in range(0, len(places), every):
        state.add(places[at: at + every], penalties[at: at + every])
        got += state.settled()[1:]                        # settled in steps, the optimum stays that of the whole
    got += state.ended()[1:]
    penalty = dict(zip(places, penalties, strict=True))
    assert got[-1] == places[-1] and set(got[1:]) <= set(places)
    assert all(0 < b - a <= window for a, b in zip(got, got[1:], strict=False))
    assert cost(got, penalty, window) == least(places, penalty, window)


def test_power_of_two_needs_no_padding():
    state = windows.WindowCuts(16)
    state.add([4, 6], [0, 0])
    assert state.ended() == [0, 4, 6]


def test_sentence_ends():
    text = 'One. Two!" Three (four?) five.six 3.5 x\n\nsie. 。あ！い？ end.'
    data = text.encode()
    ends = windows.sentence_ends(np.frombuffer(data, np.uint8)).tolist()
    parts = [data[a:b].decode() for a, b in zip([0, *ends], [*ends, len(data)], strict=True)]
    assert parts == ["One.", ' Two!"', " Three (four?)", " five.six 3.5 x\n\n", "sie.", " 。", "あ！", "い？", " end.", ""]


def cuts_of(texts, **kwargs):
    ids = [packing.encode(t) for t in texts]
    places, kinds = windows.possible_cuts("".join(texts).encode(), np.concatenate(ids), np.cumsum([len(i) for i in ids]), **kwargs)
    return np.concatenate(ids), places, kinds


def test_possible_cuts_stand_at_sentence_ends():
    text = "First one here. Second, longer one!\nThird"
    ids, places, kinds = cuts_of([text])
    lengths = packing.token_bytes()
    before = [text.encode()[: int(lengths[ids[:p]].sum())].decode() for p in places[:-1]]
    assert before == ["First one here.", "First one here. Second, longer one!", "First one here. Second, longer one!\n"]
    assert kinds.tolist() == [1, 1, 1, 0] and places[-1] == len(ids)
    ids, places, kinds = cuts_of(["word " * 50], most=16)
    assert places.tolist() == [*range(16, len(ids), 16), len(ids)] and set(kinds[:-1]) == {2} and kinds[-1] == 0
    # several documents have the cuts of each, an end of a sentence at the end of a text is none of its own
    texts = ["One. Two.", "", " three. Four\n", "five.", "A. B"]
    _, places, kinds = cuts_of(texts)
    want, at = [], 0
    for t in texts:
        ids, p, k = cuts_of([t])
        want += list(zip((p + at).tolist(), k.tolist(), strict=True))
        at += len(ids)
    assert list(zip(places.tolist(), kinds.tolist(), strict=True)) == want


ROWS = [
    (1, "One two three. Four five. " * 40, 5), (2, None, 6), (3, "", 7), (4, "word " * 900, 8), (5, "same.", 9), (5, "same.", 9),
    (None, "no id.\n", 1), (6, "a<|endoftext|>b. c", 1), (7, "é。字！" * 60, 1),
]


def check_pieces(rows, texts, window):
    for r in rows:
        assert r.doc_tokens == len(packing.encode(texts[r.doc_id]))
        ids = packing.encode(texts[r.doc_id])[r.start: r.start + r.length]
        assert len(ids) == r.length > 0 and r.ids_crc32 == zlib.crc32(ids.astype("<u4").tobytes())
    lengths = []
    for sequence in {r.sequence_id for r in rows}:
        inside = sorted((r.offset, r.length) for r in rows if r.sequence_id == sequence)
        assert [o for o, _ in inside] == np.cumsum([0] + [n for _, n in inside]).tolist()[:-1]
        lengths.append(sum(n for _, n in inside))
        assert lengths[-1] <= window
    return sum(padding(n, window) for n in lengths)


@pytest.mark.parametrize("step", [3, 5_000])
def test_every_id_lies_in_one_piece(spark, monkeypatch, step):
    monkeypatch.setattr(windows, "CUTS_PER_STEP", step)
    monkeypatch.setattr(windows, "IDS_PER_STEP", step)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, start int")
    rows = windows.pack_in_order(docs, window=64).collect()
    check_pieces(rows, {i: t for i, t, _ in ROWS}, 64)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
    for doc_id, text, _ in ROWS:
        spans = sorted(by_doc[doc_id])
        copies = 2 if doc_id == 5 else 1
        assert sum(n for _, n in spans) == copies * len(packing.encode(text))
        if copies == 1:
            assert [s for s, _ in spans] == np.cumsum([0] + [n for _, n in spans]).tolist()[:-1]
    assert windows.pack_in_order(docs.limit(0)).collect() == []


def test_stream_without_an_agreed_cut_is_cut(monkeypatch):
    monkeypatch.setattr(windows, "CUTS_PER_STEP", 10)
    monkeypatch.setattr(windows, "IDS_PER_STEP", 10)
    monkeypatch.setattr(windows, "MOST_HELD", 100)
    stream = windows._Stream(64, (0, 4, 64), 7 << 40)
    ids = packing.encode("word " * 5000)
    batches = [*stream.add(1, "word " * 5000, ids), *stream.ended()]
    rows = [r for b in batches for r in b.to_pylist()]
    assert [r["start"] for r in rows] == np.cumsum([0] + [r["length"] for r in rows]).tolist()[:-1]
    assert sum(r["length"] for r in rows) == len(ids) and {r["sequence_id"] >> 40 for r in rows} == {7}


def test_query_pads_little_and_keeps_order(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op13_window_packing(spark, folder).collect()
    padded = check_pieces(rows, texts, 1024)
    total = sum(len(packing.encode(t)) for t in texts.values())
    assert sum(r.length for r in rows) == total
    streams = len({r.sequence_id >> 40 for r in rows})
    assert padded <= 0.01 * total + 1024 * streams
    order = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    for a, b in zip(order, order[1:], strict=False):
        assert b.doc_id != a.doc_id or b.start == a.start + a.length or a.sequence_id >> 40 != b.sequence_id >> 40
