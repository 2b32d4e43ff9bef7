import base64
import hashlib
import re

import numpy as np
import pyarrow as pa

from tests.conftest import SF
from tickerloom.llm import fingerprints as fp
from tickerloom.llm import queries, shared


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text, n=5):
    w = words(text)
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_words_are_hashed_alike_wherever_they_stand(monkeypatch):
    texts = ["The cat  sat", None, "", "\tthe\x0bCAT\n", "éÉ sat", "x" * 50 + " cat " + "y" * 90, "sat"]
    def run():
        out = {}
        for row, hashes, at in shared.word_hashes(pa.array(texts)):
            for k in range(len(at) - 1):
                out[row + k] = hashes[at[k]:at[k + 1]].tolist()
        return out
    whole = run()
    assert [len(whole[k]) for k in range(len(texts))] == [len(words(t)) for t in texts]
    assert whole[0][0] == whole[3][0] and whole[0][2] == whole[6][0] == whole[4][1] and whole[0][1] == whole[3][1]
    assert len({h for row in whole.values() for h in row}) == len({w for t in texts for w in words(t)})
    monkeypatch.setattr(shared, "BLOCK_BYTES", 16)
    assert run() == whole
    sliced = list(shared.word_hashes(pa.array(texts).slice(3, 2)))
    assert np.concatenate([h for _, h, _ in sliced]).tolist() == whole[3] + whole[4]


def test_shingles_equal_sets():
    texts = ["a b c d e f g", "a b", "", "a b c d e", "f g a b c d e"]
    (_, hashes, at), = shared.word_hashes(pa.array(texts))
    rows, values = shared.shingles(hashes, at, 5)
    got = [set(values[rows == k].tolist()) for k in range(5)]
    assert [len(g) for g in got] == [3, 1, 0, 1, 3] and got[3] <= got[0] and len(got[0] & got[4]) == 1


def test_densified_bins_are_filled_from_filled_ones():
    table = np.full((3, fp.BINS), fp._FREE, np.uint64)
    table[0, 7], table[1, ::2] = 11, np.arange(fp.BINS // 2)
    out = fp.densified(table)
    assert (out[0] == 11).all() and (out[1, ::2] == table[1, ::2]).all() and (out[1] < fp.BINS).all() and (out[2] == fp._FREE).all()


def test_whole_tables_against_exact_shares(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    rows = {r.doc_id: r for r in fp.fingerprints_and_edits(docs, 20_000).collect()}
    assert len(rows) == len(texts)
    errors, by_text = [], {}
    for k, (doc_id, text) in enumerate(texts):
        following, r = texts[(k + 1) % len(texts)][1], rows[doc_id]
        n = len(text) // 4
        changed = text[:len(text) - n] + following[:n]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        errors += [(r.near_edited - jaccard(text, changed)), (r.near_next - jaccard(text, following))]
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint and len(base64.b64decode(r.fingerprint)) == fp.BINS // 2
    assert np.abs(errors).mean() < 0.02 and abs(np.mean(errors)) < 0.01
    one = {r.doc_id: r.fingerprint for r in fp.fingerprints(docs).collect()}
    assert one == {k: r.fingerprint for k, r in rows.items()}


def test_odd_rows(spark, tmp_path):
    rows = [(None, "no id here at all", 1), (1, None, 1), (1, "b same id", 1), (2, "", 1), (5, "one two three four five six", 1), (5, "one two three four five six", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket int")
    got = fp.fingerprints_and_edits(docs, 8).collect()
    assert len(got) == len(rows)
    empty = [r for r in got if r.n_chars == 0]
    assert len(empty) == 2 and all(r.fingerprint == "" for r in empty)
    last = [r for r in got if r.doc_id == 5]
    assert sorted(r.near_next for r in last) == [0.0, 1.0]
    assert fp.fingerprints_and_edits(docs.limit(0)).collect() == []
    one = fp.fingerprints_and_edits(docs.where("text like 'b%'")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    docs.drop("bucket").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES["op5_minhash_fingerprints"](spark, str(tmp_path)).count() == len(rows)
