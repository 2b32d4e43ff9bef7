import hashlib
import re

from hypothesis import example, given, settings
from hypothesis import strategies as st

from tickerloom.llm import pii, queries, spans

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(digits[::-1])) % 10 == 0


def brute(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(RULES).index(s[0])))


def base(text):
    return [(s["kind"], s["start"], s["end"]) for s in pii.find(text) if s["kind"] in RULES]


CHUNKS = st.sampled_from(["a", "Z", "@", ".", "-", "+", "1", "4", "25", "255", "256", "0", " ", "(", ")", "%", "_", "é", "字", "\n",
                          "4111 1111-1111 1111", "a@b.co", "+1 (988) 555-2485", "1.2.3.4", "00", "http://x.y", "IBAN "])


@settings(max_examples=600, deadline=None)
@given(st.lists(CHUNKS, max_size=24).map("".join))
@example("a@b.c@d.e.f@@g.h")
@example("1.2.3.4.5.6.7.8.9.1.2")
@example("x1.2.3.4 4111-1111 1111 1111+1 (2) 3456789012 ")
@example("é@a.b +12-3456-7890-.. 0.0.0.00000255")
def test_base_spans_equal_the_patterns(text):
    assert base(text) == brute(text)


def test_added_kinds():
    text = "see https://a.example/x?q=1. IBAN: GB82 WEST 1234 5698 7654 32, account no. 12345678; IBAN GB00 WEST 1234 5698 7654 32"
    found = [(s["kind"], text[s["start"]:s["end"]]) for s in pii.find(text) if s["kind"] not in RULES]
    assert found == [("url", "https://a.example/x?q=1"), ("iban", "GB82 WEST 1234 5698 7654 32"), ("account", "12345678")]


def test_masking_merges_overlaps():
    assert spans.masked("call a@b.co now", [("email", 5, 11), ("url", 7, 11)]) == "call [email] now"


def test_query_digests(spark, tmp_path):
    texts = ["mail a@b.co or 1.2.3.4", None, "", "clean words"] + ["x a@b.co"] * 2
    spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, spans int") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.QUERIES["op6_pii_anchors"](spark, str(tmp_path)).collect()}
    assert len(rows) == 6
    for i, t in enumerate(texts):
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(t or ""))
        assert rows[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest() and rows[i].spans == want
    assert (rows[0].n_email, rows[0].n_ip, rows[0].n_card, rows[0].n_phone) == (1, 1, 0, 0)


def test_whole_tables_equal_the_patterns(spark):
    from tests.conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.personal_data(docs).collect():
        assert [(s.kind, s.start, s.end) for s in r.spans if s.kind in RULES] == brute(texts[r.doc_id])


def test_odd_rows_and_a_very_long_text(spark):
    long = "clean words here. " * 120_000 + "a@b.co " + "0" * 300_000
    rows = [(None, "x@y.zz", 1), (1, long, 1), (1, "1.2.3.4", 1), (1, "1.2.3.4", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = pii.personal_data(docs).collect()
    assert [(s.kind, s.start) for r in got if r.doc_id is None for s in r.spans] == [("email", 0)]
    assert sorted(len(r.spans) for r in got if r.doc_id == 1) == [1, 1, 1]
    assert [(s.kind, s.start) for r in got for s in r.spans if s.kind == "email" and s.start] == [("email", len("clean words here. ") * 120_000)]
    assert pii.personal_data(docs.limit(0)).collect() == []
