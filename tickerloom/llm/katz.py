"""Katz backoff scores of documents, with the model in partitioned tables.

A token's probability is the Good-Turing discounted share of its bigram; where the bigram is unseen,
the context's backoff weight times the token's probability without context; where the word is
unseen, the mass that discounting left to unknown words.  Weights are exact: every context's
probabilities sum to one over the known words and the unknown one.

Neither the counts nor the words are ever in one place.  Documents are read once into blocks of a few
million tokens, each with its own word list.  A block asks the count tables for its distinct words,
then for its distinct bigrams: the requests are packed arrays, dealt by hash into buckets, where
equal n-grams of all blocks are added up.  Bigrams are dealt by context, so a bucket has all that a
context's weight needs; contexts that would fill more than a quarter of a bucket are dealt by the whole
bigram and their sums added afterwards.  The answers are stored partitioned by block, and each block
reads its own partition.

Words are 64-bit hashes, and the second word of a bigram is 48 bits of one within its context.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.shared import mix64, stored, word_hashes
from tickerloom.llm.warc import file_system
from tickerloom.session import work_folder

BLOCK_TOKENS = 1_500_000
BUCKET_TOKENS = 1_500_000
LAST = 5                                # counts up to this are discounted
END = np.uint64(0xE0D0E0D0E0D0E0D0)     # hashes of the marks around a text
START = np.uint64(0x57A7057A7057A705)

BLOCKS = "block long, vocab binary, stream binary, ids array<long>, sizes array<int>, train array<boolean>, tokens long, train_docs long"
WORD_REQUEST = "bucket int, block long, keys binary, counts binary"
WORD_ANSWER = "block long, bucket int, counts binary, stats array<long>"
PAIR_REQUEST = "bucket int, block long, contexts binary, runs binary, split binary, words binary, counts binary, known binary"
PAIR_ANSWER = "block long, bucket int, counts binary, masks binary, sums binary, shares binary, stats array<long>, context long, share double"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("long").cast("string"), "utf-8")) % 7 == 2, F.lit(False))


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32()), "array<boolean>": pa.list_(pa.bool_())}
    columns = list(zip(*rows, strict=True)) or [()] * len(_names(schema))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[f.split()[1]]) for c, f in zip(columns, schema.split(", "), strict=True)], names=_names(schema))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets as ranges of the hash, so that a rising list of hashes has rising buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _blocks(docs: DataFrame) -> DataFrame:
    """Token blocks of all documents; A-Z lower-cased words, then one end mark per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pa.RecordBatch:
            tokens = np.concatenate([t for t, *_ in held])
            vocab, stream = np.unique(tokens, return_inverse=True)
            ids = [i for _, part, _, _ in held for i in part]
            sizes = np.concatenate([s for _, _, s, _ in held])
            train = np.concatenate([t for *_, t in held])
            return _batch([(number, _pack(vocab), _pack(stream.astype(np.uint32)), ids, sizes.tolist(), train.tolist(), len(tokens), int(train.sum()))], BLOCKS)

        for batch in batches:
            train = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for row, hashes, offsets in word_hashes(batch.column(1)):
                rows = len(offsets) - 1
                tokens = np.insert(hashes, offsets[1:], END)
                held.append((tokens, batch.column(0).slice(row, rows).to_pylist(), np.diff(offsets) + 1, train[row: row + rows]))
                size += len(tokens)
                if size >= BLOCK_TOKENS:
                    yield block()
                    number, held, size = number + 1, [], 0
        if held:
            yield block()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.withColumn("train", ~held_out(F.col("doc_id"))).mapInArrow(run, BLOCKS), "blocks")


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {n: c[k].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}


def _answers(answers: DataFrame, label: str) -> str:
    """Stores the answers partitioned by block, a file per block, and gives their folder."""
    path = work_folder(answers.sparkSession, label)
    answers.repartition("block").sortWithinPartitions("block", "bucket").write.partitionBy("block").parquet(path)
    return path


def _read_block(folder: str, block: int) -> list[dict]:
    from pyarrow.fs import FileSelector

    fs, base = file_system(folder)
    files = [f.path for f in fs.get_file_info(FileSelector(f"{base}/block={block}")) if f.base_name.startswith("part-")]
    rows = [r for f in files for r in pq.ParquetFile(fs.open_input_file(f)).read().to_pylist()]
    return sorted(rows, key=lambda r: r["bucket"])


def _count_words(blocks: DataFrame, buckets: int) -> str:
    """Training counts of the words of every block, asked from hashed buckets."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            vocab, stream = _unpack(row["vocab"], np.uint64), _unpack(row["stream"], np.uint32)
            train = np.repeat(np.array(row["train"], bool), row["sizes"])
            counts = np.bincount(stream[train], minlength=len(vocab)).astype(np.uint32)
            edge = np.searchsorted(_bucket(vocab, buckets), np.arange(buckets + 1))
            yield _batch([(b, row["block"], _pack(vocab[lo:hi]), _pack(counts[lo:hi]))
                          for b, (lo, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if lo < hi], WORD_REQUEST)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = list(_each(batches))
        if not asked:
            return
        keys = [_unpack(r["keys"], np.uint64) for r in asked]
        words, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate([_unpack(r["counts"], np.uint32) for r in asked]), len(words)).astype(np.int64)
        stats = [int(total.sum()), int((total > 0).sum()), *(int((total == r).sum()) for r in range(1, LAST + 2))]
        rows, done = [(-1, asked[0]["bucket"], None, stats)], 0
        for r, k in zip(asked, keys, strict=True):
            rows.append((r["block"], r["bucket"], _pack(total[at[done: done + len(k)]].astype(np.uint64)), None))
            done += len(k)
        yield _batch(rows, WORD_ANSWER)

    asked = blocks.select("block", "vocab", "stream", "sizes", "train").mapInArrow(ask, WORD_REQUEST)
    return _answers(asked.repartitionById(buckets, F.col("bucket")).mapInArrow(add, WORD_ANSWER), "words")


def discounts(kinds: list[int]) -> np.ndarray:
    """Good-Turing discounts of counts 1 to ``LAST`` from the numbers of n-grams seen once, twice, ...
    A discount that these numbers do not give (outside 0 to 1) is left out."""
    cut = np.ones(LAST + 1)
    if kinds[0] and kinds[LAST]:
        common = (LAST + 1) * kinds[LAST] / kinds[0]
        for r in range(1, LAST + 1):
            if kinds[r - 1] and kinds[r] and common < 1:
                d = ((r + 1) * kinds[r] / (r * kinds[r - 1]) - common) / (1 - common)
                cut[r] = d if 0 < d < 1 else 1.0
    return cut


@dataclass
class Words:
    """Numbers of the word model: what it takes to give a word's probability from its count."""
    tokens: int
    kinds: int
    cut: np.ndarray
    total: int = 0
    unknown: float = 0.0

    def __post_init__(self):
        self.total = self.tokens

    def finish(self, seen: list[int]) -> Words:
        freed = sum((1 - self.cut[r]) * r * seen[r - 1] for r in range(1, LAST + 1))
        if freed <= 0:                  # nothing discounted: one token is set aside
            freed, self.total = 1.0, self.tokens + 1
        self.unknown = freed / self.total
        return self

    def chance(self, counts: np.ndarray) -> np.ndarray:
        cut = np.where(counts <= LAST, self.cut[np.minimum(counts, LAST)], 1.0)
        return np.where(counts > 0, cut * counts / self.total, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.kinds + 1))


@dataclass
class Block:
    """A block's tokens, its distinct bigrams in the order they are asked for, and its words' counts."""
    vocab: np.ndarray
    stream: np.ndarray
    sizes: np.ndarray
    train: np.ndarray
    word_counts: np.ndarray             # by vocab, then the start mark's
    pair: np.ndarray                    # distinct bigrams: context * (V + 1) + word
    at: np.ndarray                      # bigram of every token
    order: np.ndarray                   # bigrams by bucket
    bucket: np.ndarray                  # in that order
    hot: np.ndarray

    @classmethod
    def of(cls, row: dict, words: str, start_count: int, buckets: int, hot_from: float) -> Block:
        vocab, stream = _unpack(row["vocab"], np.uint64), _unpack(row["stream"], np.uint32).astype(np.int64)
        counts = np.concatenate([_unpack(r["counts"], np.uint64) for r in _read_block(words, row["block"])]).astype(np.int64)
        counts = np.append(counts, start_count)
        sizes = np.array(row["sizes"], np.int64)
        context = np.empty_like(stream)
        context[1:] = stream[:-1]
        context[np.cumsum(sizes) - sizes] = len(vocab)
        pair, at = np.unique(context * (len(vocab) + 1) + stream, return_inverse=True)
        left, right = np.divmod(pair, len(vocab) + 1)
        hashes = np.append(vocab, START)
        hot = counts >= hot_from
        spot = mix64(hashes[left] + np.where(hot[left], mix64(hashes[right]), np.uint64(0)))
        bucket = _bucket(spot, buckets)
        order = np.argsort(bucket, kind="stable")
        return cls(vocab, stream, sizes, np.array(row["train"], bool), counts, pair, at, order, bucket[order], hot)

    def parts(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Bucket, its bigrams, its contexts and the number of bigrams of each."""
        edge = np.searchsorted(self.bucket, np.arange(buckets + 1))
        for b, (lo, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
            if lo < hi:
                mine = self.order[lo:hi]
                left = self.pair[mine] // (len(self.vocab) + 1)
                first = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]]))
                yield b, mine, left[first], np.diff(np.append(first, len(left)))


def _count_pairs(blocks: DataFrame, words: str, model: Words, start_count: int, buckets: int, hot_from: float) -> str:
    """Training counts of the bigrams of every block, and what the backoff weights of its contexts
    need: how many continuations were seen 1 to ``LAST`` times, and the word model's share of all seen."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block = Block.of(row, words, start_count, buckets, hot_from)
            train = np.repeat(block.train, block.sizes)
            seen = np.bincount(block.at[train], minlength=len(block.pair)).astype(np.uint32)
            hashes = np.append(block.vocab, START)
            for b, mine, contexts, runs in block.parts(buckets):
                right = block.pair[mine] % (len(block.vocab) + 1)
                six = hashes[right].astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]
                yield _batch([(b, row["block"], _pack(hashes[contexts]), _pack(runs.astype(np.uint32)), _pack(block.hot[contexts]),
                               np.ascontiguousarray(six).tobytes(), _pack(seen[mine]), _pack(block.word_counts[right].astype(np.uint64)))], PAIR_REQUEST)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, left, right, seen, known, split = [], [], [], [], [], []
        for r in _each(batches):
            runs = _unpack(r["runs"], np.uint32)
            left.append(np.repeat(_unpack(r["contexts"], np.uint64), runs))
            split.append(np.repeat(_unpack(r["split"], bool), runs))
            wide = np.zeros((len(r["words"]) // 6, 8), np.uint8)
            wide[:, 2:] = np.frombuffer(r["words"], np.uint8).reshape(-1, 6)
            right.append(wide.view("<u8").reshape(-1))
            seen.append(_unpack(r["counts"], np.uint32))
            known.append(_unpack(r["known"], np.uint64))
            asked.append((r["block"], r["bucket"], len(left[-1]), runs))
        if not asked:
            return
        left, right, seen, known, split = map(np.concatenate, (left, right, seen, known, split))
        order = np.lexsort((right, left))
        u, v = left[order], right[order]
        new = np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        total = np.bincount(group, seen[order]).astype(np.int64)
        contexts, of = np.unique(u[first], return_inverse=True)
        sums = np.stack([np.bincount(of, total == r, len(contexts)) for r in range(1, LAST + 1)], axis=1).astype(np.uint32)
        share = np.bincount(of, np.where(total > 0, model.chance(known[order][first].astype(np.int64)), 0.0), len(contexts))
        mask = ((sums > 0) << np.arange(LAST)).sum(axis=1).astype(np.uint8)
        stats = [int((total == r).sum()) for r in range(1, LAST + 2)]
        rows = [(-1, asked[0][1], None, None, None, None, stats, None, None)]
        hot = np.zeros(len(contexts), bool)
        hot[of[group[split[order]]]] = True
        rows += [(-1, asked[0][1], None, None, None, None, sums[k].tolist(), int(contexts[k:k + 1].view(np.int64)[0]), float(share[k])) for k in np.flatnonzero(hot)]
        back = np.empty(len(order), np.int64)
        back[order] = group
        done = 0
        for block, bucket, size, runs in asked:
            mine = back[done: done + size]
            done += size
            counts = total[mine]
            begin = np.cumsum(runs, dtype=np.int64) - runs
            its = of[mine[begin]]
            open_ = np.minimum.reduceat(counts, begin) == 0         # contexts with a bigram never seen
            rows.append((block, bucket, _pack(counts.astype(np.uint64)), _pack(mask[its]), _pack(sums[its[open_]]), _pack(share[its[open_]]), None, None, None))
        yield _batch(rows, PAIR_ANSWER)

    asked = blocks.select("block", "vocab", "stream", "sizes", "train").mapInArrow(ask, PAIR_REQUEST)
    return _answers(asked.repartitionById(buckets, F.col("bucket")).mapInArrow(add, PAIR_ANSWER), "pairs")


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def scores(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigrams) and ``score`` (log10 probability under the model).

    The model learns from the rows that are not held out.  Null and empty texts have the end mark
    alone; rows without doc_id are learned from; repeated rows count as often as they come.
    """
    spark = docs.sparkSession
    blocks = _blocks(docs)
    size = blocks.agg(F.sum("tokens"), F.sum("train_docs")).first()
    if not size[0]:
        return spark.createDataFrame([], SCORES).select(
            "doc_id", F.lit(False).alias("held_out"), "n_tokens", "n_known", F.lit(0).cast("long").alias("train_tokens"), "base_score", "score")
    buckets = max(1, -(-size[0] // BUCKET_TOKENS))
    start_count = size[1]
    words = _count_words(blocks, buckets)
    stats = spark.read.parquet(words).where("block = -1").select(*[F.sum(F.col("stats")[k]) for k in range(LAST + 3)]).first()
    tokens, kinds, seen = stats[0], stats[1], list(stats[2:])
    model = Words(tokens, kinds, discounts(seen)).finish(seen)
    # at most 4 * buckets contexts have so many tokens
    hot_from = max(1.0, tokens / (4 * buckets)) if buckets > 1 else math.inf
    pairs = _count_pairs(blocks, words, model, start_count, buckets, hot_from)
    notes = spark.read.parquet(pairs).where("block = -1")
    kinds_of_pairs = list(notes.where("context is null").select(*[F.sum(F.col("stats")[k]) for k in range(LAST + 1)]).first())
    cut = discounts(kinds_of_pairs)
    hot = {r.context: (np.array(r[1: 1 + LAST], float), r.share) for r in notes.where("context is not null").groupBy("context").agg(
        *[F.sum(F.col("stats")[k]).alias(f"m{k}") for k in range(LAST)], F.sum("share").alias("share")).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block = Block.of(row, words, start_count, buckets, hot_from)
            log, hashes = np.empty(len(block.pair)), np.append(block.vocab, START)
            answers = {r["bucket"]: r for r in _read_block(pairs, row["block"])}
            for b, mine, contexts, runs in block.parts(buckets):
                got = answers[b]
                counts = _unpack(got["counts"], np.uint64).astype(np.int64)
                masks = _unpack(got["masks"], np.uint8)
                begin = np.cumsum(runs, dtype=np.int64) - runs
                open_ = np.minimum.reduceat(counts, begin) == 0
                sums, share = np.zeros((len(contexts), LAST)), np.zeros(len(contexts))
                sums[open_] = _unpack(got["sums"], np.uint32).reshape(-1, LAST)
                share[open_] = _unpack(got["shares"], np.float64)
                for k in np.flatnonzero(block.hot[contexts]):       # its sums are spread over the buckets
                    whole, share[k] = hot[int(hashes[contexts[k]:contexts[k] + 1].view(np.int64)[0])]
                    sums[k], masks = whole, masks.copy()
                    masks[k] = ((whole > 0) << np.arange(LAST)).sum()
                of = block.word_counts[contexts].astype(float)
                freed = sums @ ((1 - cut[1:]) * np.arange(1, LAST + 1))
                discounted = np.zeros(len(contexts), bool)
                for r in range(1, LAST + 1):
                    if cut[r] < 1:
                        discounted |= masks >> (r - 1) & 1 == 1
                # where nothing is discounted one token is set aside; a context never seen has weight one
                total = np.where(discounted, of, of + 1)
                freed = np.where(discounted, freed, 1.0)
                weight = np.where(of > 0, freed / np.maximum(total, 1) / np.maximum(1 - share, model.unknown), 1.0)
                each = np.repeat(np.arange(len(contexts)), runs)
                right = block.pair[mine] % (len(block.vocab) + 1)
                direct = np.where(counts <= LAST, cut[np.minimum(counts, LAST)], 1.0) * counts / np.maximum(total[each], 1)
                log[mine] = np.log10(np.where(counts > 0, direct, weight[each] * model.chance(block.word_counts[right])))
            doc = np.repeat(np.arange(len(block.sizes)), block.sizes)
            count = block.word_counts[block.stream]
            n = len(block.sizes)
            yield pa.RecordBatch.from_arrays([
                pa.array(row["ids"], pa.int64()), pa.array(block.sizes), pa.array(np.bincount(doc, count > 0, n).astype(np.int64)),
                pa.array(np.bincount(doc, model.base(count), n)), pa.array(np.bincount(doc, log[block.at], n))], names=_names(SCORES))

    out = blocks.select("block", "vocab", "stream", "ids", "sizes", "train").mapInArrow(run, SCORES)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
