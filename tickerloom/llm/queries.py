"""Registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import decontaminate, fingerprints, jaccard, katz, packing, pii, runs, secrets, sharding, toxicity, trie, warc, windows
from tickerloom.llm.shared import documents, sliced, stored
from tickerloom.llm.spans import digest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    return packing.pack_documents(documents(spark, sf_dir))


@_query
def op3_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes, equal texts together."""
    return sharding.shard_documents(documents(spark, sf_dir))


@_query
def op6_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return digest(pii.personal_data(documents(spark, sf_dir)), pii.BASE_KINDS)


@_query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return digest(secrets.secrets(documents(spark, sf_dir)), secrets.BASE_KINDS)


@_query
def op5_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprints_and_edits(documents(spark, sf_dir))


@_query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back by byte ranges."""
    return warc.archive_round_trip(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))


@_query
def op4_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items: per pair the passage with the fewest edits."""
    found = decontaminate.matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    best = found.groupBy("doc_id", "item_id").agg(F.min(F.struct("distance", "start", "end")).alias("best"))
    return best.select("doc_id", "item_id", "best.start", "best.end", "best.distance")


@_query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose sets of 3-word shingles are alike by 0.9 or more."""
    found = jaccard.near_duplicate_classes(documents(spark, sf_dir), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


@_query
def op10_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = documents(spark, sf_dir)
    return toxicity.scores(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@_query
def op9_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz backoff score of every document, the model from six sevenths of them."""
    return katz.scores(documents(spark, sf_dir))


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` in which a tenth of the texts, chosen by the digest of doc_id, repeat a stretch from some
    word on to their end; the other texts, and rows without doc_id, stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            for row, doc_id in enumerate(batch.column(0).to_pylist()):
                h = zlib.crc32(str(doc_id).encode())
                if doc_id is None or h % 10 or not (words := (texts[row] or "").encode().split()):
                    continue
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words[a:] = (words[a: a + p] * -(-(n - a) // p))[: n - a]
                texts[row] = b" ".join(words).decode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, text string")


def _less_periodic(left: Column, right: Column) -> Column:
    """Order of runs: the greatest exact length / period, then the smallest start, then period."""
    ours, theirs = left["length"] * right["period"], right["length"] * left["period"]
    return (
        F.when(ours > theirs, -1).when(ours < theirs, 1)
        .when(left["start"] != right["start"], F.when(left["start"] < right["start"], -1).otherwise(1))
        .otherwise((left["period"] > right["period"]).cast("int") - (left["period"] < right["period"]).cast("int"))
    )


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, a tenth of them made periodic."""
    found = runs.periodic_runs(with_periods(documents(spark, sf_dir)))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    best = F.get(F.array_sort("runs", _less_periodic), F.lit(0))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query
def op13_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of at most 1024 ids, in their order."""
    return windows.pack_in_order(documents(spark, sf_dir))


def with_shared_starts(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt from the first turns of another one and their own later turns: their turns
    and their lengths, as ``trie.prefix_trie`` takes them."""
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    shared = F.crc32(F.col("conv_id").cast("string")) % 9
    plan = own.select("conv_id", "n", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base")) \
        .join(own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left") \
        .withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))) \
        .withColumn("n_turns", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long")))
    plan = stored(plan.select("conv_id", "base", "h", "n", "taken", "n_turns"), "plan")
    columns = ["conv_id", "pos", "a", "b", "n_bytes", "n_turns"]
    starts = turns.where("pos < 8").withColumnRenamed("conv_id", "base").join(plan, "base").where("pos < taken").select(*columns)
    rest = turns.withColumn("chunk", trie.chunk_of(F.col("pos"))).join(trie.per_chunk(plan, F.col("n")), ["conv_id", "chunk"]) \
        .where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken")).select(*columns)
    return starts.unionByName(rest), plan


@_query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt on the first turns of another."""
    turns = stored(trie.numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "numbered")
    return trie.prefix_trie(*with_shared_starts(turns))


ORACLE["op12_conversation_trie"] = """
WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
hashed AS (
  SELECT conv_id, xor(list_reduce(
    list_concat([4294967295::UBIGINT], list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
                LAMBDA i: ascii(substr(CAST(conv_id AS VARCHAR), i, 1))::UBIGINT)),
    LAMBDA c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8), LAMBDA k: 0::UBIGINT)),
      LAMBDA x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)), 4294967295::UBIGINT) % 9 AS h
  FROM ids),
numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
joined AS (
  SELECT h.conv_id, 0 AS part, n.pos, n.role, n.text
  FROM hashed h JOIN numbered n ON n.conv_id = h.conv_id - h.conv_id % 5 AND n.pos < h.h
  UNION ALL
  SELECT h.conv_id, 1, n.pos, n.role, n.text FROM hashed h JOIN numbered n ON n.conv_id = h.conv_id AND n.pos >= h.h),
rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth,
         md5(length(role) || ':' || role || text) AS turn_md5, strlen(text) AS n_bytes
  FROM joined),
paths AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS n_bytes FROM ids
  UNION ALL
  SELECT conv_id, depth, md5(string_agg(turn_md5, '') OVER (PARTITION BY conv_id ORDER BY depth)), n_bytes FROM rebuilt),
lengths AS (SELECT conv_id, max(depth) AS n_turns FROM paths GROUP BY conv_id),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n_bytes) AS own FROM paths GROUP BY depth, path),
parents AS (
  SELECT n.depth, n.path, p.path AS parent_path, q.conv_id AS parent_conv_id
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 JOIN nodes q ON q.depth = p.depth AND q.path = p.path),
children AS (SELECT depth - 1 AS depth, parent_path AS path, count(*) AS n_children FROM parents GROUP BY ALL),
below AS (
  SELECT p.depth, p.path, CAST(sum(u.own) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves
  FROM nodes u LEFT JOIN children c USING (depth, path) JOIN paths p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY ALL),
ends AS (
  SELECT p.depth, p.path, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids
  FROM paths p JOIN lengths l ON l.conv_id = p.conv_id AND l.n_turns = p.depth GROUP BY ALL)
SELECT n.conv_id, n.depth, r.parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n LEFT JOIN parents r USING (depth, path) LEFT JOIN children c USING (depth, path)
JOIN below b USING (depth, path) LEFT JOIN ends e USING (depth, path)
"""

ORACLE["op2_warc"] = """
SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN strlen(body) >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(body) >= 1000 AND page_id <> last THEN last END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
"""
