import zlib

import numpy as np
import pytest

from tickerloom.llm import packing


def test_ids_equal_the_json_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    scripts = "".join(chr(c) for a in (0, 0x80, 0x370, 0x400, 0x590, 0x900, 0xE00, 0x3040, 0x4E00, 0xAC00, 0x1F600) for c in range(a, a + 96))
    special = ["<|endoftext|> x", "a<|endoftext|>", "<|endoftext|><|endoftext|>", " <|endoftext|>\n", "<|endoftext|", "<|END|>"]
    for text in [scripts, scripts[::-1], " ".join(scripts), *special, "", "a", "it's 'S we're\n\n x\t y  ", "<|endoftext|> é ñ 字 \U0001f600", "aaaa" * 500, "12 345\r\n\r\n  z" * 40]:
        assert packing.encode(text).tolist() == [*reader.encode(text, add_special_tokens=False).ids, 0]
    assert packing.encode(None).tolist() == [0]


def test_cuts():
    assert packing.cuts(5, 10) == [0]
    assert packing.cuts(10, 10) == [0]
    assert packing.cuts(23, 10) == [0, 3, 13]
    assert packing.cuts(20, 10) == [0, 10]


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0)      # 4 free
    assert bins.place(7) == (1, 0)      # 3 free
    assert bins.place(3) == (1, 7)      # tightest, now full and closed
    assert bins.place(5) == (2, 0)      # 5 free
    assert bins.place(9) == (3, 0)      # both open bins too full: bin 0 with 4 free closes
    assert bins.place(4) == (2, 5)
    assert bins.place(4) == (4, 0)
    assert bins.open == 2


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "one two three", 5), (2, None, 6), (3, "", 7), (4, "word " * 900, 8), (5, "same", 9), (5, "same", 9), (None, "no id", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, piece int")


def test_every_id_is_packed_once(spark, docs):
    rows = packing.pack_documents(docs, limit=64, open_bins=4).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert len(by_doc[5]) == 2 and len(by_doc[2]) == len(by_doc[3]) == len(by_doc[None]) == 1
    ids = packing.encode("word " * 900)
    long = sorted(by_doc[4], key=lambda r: r.piece)
    assert [r.start for r in long] == packing.cuts(len(ids), 64)
    assert [r.ids_crc32 for r in long] == [zlib.crc32(ids[r.start: r.start + r.length].astype("<u4").tobytes()) for r in long]
    for sequence in {r.sequence_id for r in rows}:
        inside = sorted((r.offset, r.length) for r in rows if r.sequence_id == sequence)
        assert [o for o, _ in inside] == np.cumsum([0] + [n for _, n in inside]).tolist()[:-1]
        assert sum(n for _, n in inside) <= 64
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // 64) + 3


def test_with_ids_and_empty_table(spark, docs):
    pieces = packing.tokenised_pieces(docs, 64, with_ids=True).where("doc_id = 4").collect()
    assert sum((p.ids for p in sorted(pieces, key=lambda p: p.piece)), []) == packing.encode("word " * 900).tolist()
    assert packing.pack_documents(docs.limit(0)).collect() == []


def plain_best_fit(lengths, capacity, most):
    """By definition, over a list of open bins: the tightest that fits, else a new one; the fullest closes."""
    open_bins, begun, out = [], 0, []
    for n in lengths:
        fitting = [b for b in open_bins if b[1] >= n]
        if fitting:
            tight = min(b[1] for b in fitting)
            mine = [b for b in open_bins if b[1] == tight][-1]
        else:
            if len(open_bins) == most:
                full = min(b[1] for b in open_bins)
                open_bins.remove([b for b in open_bins if b[1] == full][-1])
            mine = [begun, capacity]
            begun += 1
            open_bins.append(mine)
        open_bins.remove(mine)
        out.append((mine[0], capacity - mine[1]))
        mine[1] -= n
        if mine[1]:
            open_bins.append(mine)
    return out


def test_bitset_equals_plain_best_fit():
    import random

    rnd = random.Random(4)
    for capacity, most in ((10, 2), (64, 5), (2048, 40)):
        lengths = [rnd.choice([rnd.randrange(1, capacity + 1), 1 + capacity // 3]) for _ in range(600)]
        bins = packing.OpenBins(capacity, most)
        assert [bins.place(n) for n in lengths] == plain_best_fit(lengths, capacity, most)
