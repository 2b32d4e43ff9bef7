import pytest

import corpus_pipeline
from tests.conftest import SF
from tests.llm.test_decontaminate import fold
from tests.llm.test_jaccard import brute as near_classes
from tests.llm.test_secrets import brute as secret_spans
from tickerloom.llm import packing, secrets, toxicity
from tickerloom.llm.shared import documents, stored


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = documents(spark, SF), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = (docs, stored(stage(spark, docs, SF), name))
        docs = out[name][1]
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_each_stage_on_its_own_input(spark, stages):
    columns = documents(spark, SF).columns
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages) and len(stages) == 5
    for before, after in list(stages.values())[:-1]:
        assert after.columns == before.columns == columns
    before, after = stages["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert set(texts(after)) == {r.doc_id for r in toxicity.scores(before, model).collect() if r.predicted == 0}

    before, after = map(texts, stages["ngram_jaccard"])
    assert set(after) == {d for d, _, root in near_classes(list(before.items()), 5, 80) if d == root}

    before, after = map(texts, stages["decontamination"])
    items = [fold(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(after) == {d for d, t in before.items() if not any(i in fold(t) for i in items)}

    before, after = map(texts, stages["secrets"])
    assert set(after) == set(before)
    for d, t in before.items():
        assert (after[d] == t) == (not secret_spans(t)) and not secret_spans(after[d])

    before, after = stages["packing"]
    rows = after.collect()
    assert {r.doc_id for r in rows} == set(texts(before))
    assert sum(r.length for r in rows) == sum(len(packing.encode(t)) for t in texts(before).values())


def test_run_gives_the_last_stage(spark, stages):
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, stages["packing"][1].collect()))


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "x token=abcdef1 y", 17, "a"), (2, None, 3, "b"), (3, "clean", 99, None), (None, "AKIA" + "A" * 16, 20, "")],
                                 "doc_id long, text string, n_chars long, source string")
    rows = {r.doc_id: r for r in secrets.redacted(docs).collect()}
    assert rows[1].text == "x [assign] y" and rows[1].n_chars == 12 and rows[1].source == "a"
    assert rows[2].text is None and rows[2].n_chars == 3 and rows[3].n_chars == 99 and rows[None].text == "[access]"


def test_odd_documents_pass_all_stages(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "one", None, None, 3), (3, "w " * 5000, "en", "s", 10000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {None, 1, 2, 3}


def test_extra_columns_and_odd_rows_pass_through(spark):
    rows = [(1, "one two three four five six seven", "x", 1), (2, None, "y", 2), (3, "", "z", 3), (None, "no id at all in this one", "w", 4), (4, "one two three four five six seven", "v", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _node string, spans int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, SF), name)
        assert after.columns == docs.columns
        docs = after
    assert {r.doc_id for r in docs.collect()} <= {1, 2, 3, None} and docs.where("doc_id is null").count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).where("doc_id = 2").count() == 1
    assert corpus_pipeline.STAGES[0][1](spark, docs.limit(0), SF).collect() == []
