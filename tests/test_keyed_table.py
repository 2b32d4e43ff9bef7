import pytest
from pyspark.sql import functions as F

from tickerloom.sources.keyed_table import KeyedTable
from tickerloom.sources.upsert import insert_ignore, upsert


def written(table, version):
    """Buckets that a version wrote."""
    return {b for b, v in table._manifest(version)[1].items() if v == version}


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    return KeyedTable.create(rows, str(tmp_path), ["k"], 32)


def replace(old, new):
    return upsert(old, new, ["k"])


def test_write_touches_only_its_buckets(spark, table):
    one = spark.createDataFrame([(7, "seven")], "k long, v string")
    assert table.merge(one, replace) == 1
    assert len(written(table, 1)) == 1 and len(table._manifest(1)[1]) == 32
    assert table.read().count() == 1000 and table.read().where("k = 7").first().v == "seven"
    assert table.read(0).where("k = 7").first().v == "7"          # the version before is still there


def test_bytes_written_follow_the_batch(spark, table, tmp_path):
    few = spark.range(3).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    table.merge(few, replace)
    size = {v: sum(p.stat().st_size for p in tmp_path.glob(f"data/version={v}/**/*.parquet")) for v in (0, 1)}
    assert size[1] < size[0] / 5


def test_repeated_write_gives_the_same_table(spark, table):
    rows = spark.createDataFrame([(1, "a"), (5000, "b")], "k long, v string")
    table.merge(rows, replace, 1)
    first = sorted(table.read().collect())
    table.merge(rows, replace, 1)
    assert sorted(table.read().collect()) == first and table.version() == 1


def test_failed_write_leaves_the_table(spark, table):
    def broken(old, new):
        return upsert(old, new, ["k"]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception):
        table.merge(spark.createDataFrame([(1, "a")], "k long, v string"), broken)
    assert table.version() == 0 and table.read().where("k = 1").first().v == "1"
    table.merge(spark.createDataFrame([(1, "a")], "k long, v string"), replace)
    assert table.version() == 1 and table.read().where("k = 1").first().v == "a"


def test_empty_table_empty_write_and_null_keys(spark, tmp_path):
    table = KeyedTable.create(spark.createDataFrame([], "k long, v string"), str(tmp_path), ["k"], 4)
    assert table.read().collect() == []
    insert = lambda old, new: insert_ignore(old, new, ["k"])
    table.merge(spark.createDataFrame([(1, "a"), (None, "n")], "k long, v string"), insert)
    table.merge(spark.createDataFrame([], "k long, v string"), insert)
    table.merge(spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string"), insert)
    assert sorted(table.read().collect(), key=str) == [(1, "a"), (2, "c"), (None, "n")]


def test_vacuum_keeps_what_newer_versions_read(spark, table, tmp_path):
    for n in range(5):
        table.merge(spark.createDataFrame([(n, f"new {n}")], "k long, v string"), replace)
    before = sorted(table.read().collect()), sorted(table.read(4).collect())
    files = len(list(tmp_path.glob("data/**/*.parquet")))
    table.vacuum(keep=2)
    assert (sorted(table.read().collect()), sorted(table.read(4).collect())) == before
    assert len(list(tmp_path.glob("data/**/*.parquet"))) < files
    table.merge(spark.createDataFrame([(9, "after")], "k long, v string"), replace)
    table.vacuum()
    assert table.read().where("v like 'new%' or v = 'after'").count() == 6


def test_rehash_and_default_buckets(spark, table, tmp_path):
    rows = sorted(table.read().collect())
    table.rehash(5)
    assert sorted(table.read().collect()) == rows and len(table._manifest(1)[1]) == 5
    own = KeyedTable.create(table.read(), f"{tmp_path}/own", ["k"])
    assert own._manifest(0)[0] == 1 and own.read().count() == 1000
