"""Finding companies and sectors in texts.

Every match rule looks for an anchor of the entry (a run of bytes or a token) and then tests exactly, so
no rule compares all texts with all names.  The anchor of a name is its run that is rarest in texts, then
among names, which keeps names with common words in them apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom import constants as K
from tickerloom.functions.text import fold_text, strip_index_prefix, tokens
from tickerloom.operators.keyed import fits
from tickerloom.session import stored

SMALL_ROWS = 20_000   # anchor tables up to this many rows may be broadcast


def _rarest(parts: DataFrame, item: str, part: str, keep: Column) -> DataFrame:
    """The ``keep`` least frequent parts of each item; ties by the part itself."""
    frequency = parts.groupBy(part).agg(F.count("*").alias("_freq"))
    ranked = parts.join(frequency, part).groupBy(item).agg(
        F.array_sort(F.collect_list(F.struct("_freq", part))).alias("_all"), F.max(keep).alias("_keep")
    )
    chosen = F.slice("_all", F.lit(1), F.col("_keep"))
    return ranked.select(item, F.explode(F.transform(chosen, lambda s: s[part])).alias(part))


RUN_BYTES = 4         # bytes of an anchor; shorter names are anchored whole
FILTER_BITS = 24      # bits of the filter of anchors, two megabytes at any number of names
SAMPLE_TEXTS = 2_000  # texts in which runs are counted: decides which anchors are used, never what matches
BLOCK_BYTES = 1 << 20


def _runs(data: np.ndarray, size: int) -> np.ndarray:
    """Every run of ``size`` bytes as a number that tells its length too."""
    n = len(data) - size + 1
    out = np.full(max(n, 0), size << 32, np.int64)
    for k in range(size):
        out |= data[k: k + len(out)].astype(np.int64) << (8 * k)
    return out


def _slot(runs: np.ndarray) -> np.ndarray:
    return (runs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)


def _name_runs(name: bytes) -> np.ndarray:
    return np.unique(_runs(np.frombuffer(name, np.uint8), min(RUN_BYTES, len(name))))


def _marked(bits: np.ndarray, runs: np.ndarray) -> np.ndarray:
    slot = _slot(runs)
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _hits(column: pa.Array, bits: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """``(row, text, runs)`` for the texts of a column that hold runs of the filter.

    Numbers are made for a block of bytes at a time, whatever the texts' lengths.
    """
    if not len(column):
        return
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for lo in range(int(offsets[0]), int(offsets[-1]), BLOCK_BYTES):
        for size in sizes:
            runs = _runs(data[lo: min(lo + BLOCK_BYTES + size - 1, int(offsets[-1]))], size)
            at = np.flatnonzero(_marked(bits, runs))
            # runs over the border of two texts go with the first; the exact test drops them
            found.append((np.searchsorted(offsets, at + lo, "right") - 1, runs[at]))
    rows, runs = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*found, strict=True) if found else ([], [])))
    order = np.lexsort((runs, rows))
    rows, runs = rows[order], runs[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (runs[1:] != runs[:-1])
    rows, begins = np.unique(rows[new], return_index=True)
    for row, runs in zip(rows.tolist(), np.split(runs[new], begins[1:]) if len(rows) else [], strict=True):
        yield row, data[offsets[row]: offsets[row + 1]].tobytes(), runs


def _bits(runs: np.ndarray) -> np.ndarray:
    """The filter with these runs."""
    bits, slot = np.zeros(1 << (FILTER_BITS - 6), np.uint64), _slot(runs)
    np.bitwise_or.at(bits, slot >> np.uint64(6), np.uint64(1) << (slot & np.uint64(63)))
    return bits


def _filter_of(runs: DataFrame) -> np.ndarray:
    """The filter with all ``runs(_run)``, combined in the tasks; what comes here has a fixed bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _bits(np.concatenate([np.empty(0, np.int64), *(np.asarray(b.column(0)) for b in batches)]))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits[at].view(np.int64))], names=["word", "bits"])

    words = runs.select("_run").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[np.asarray(words["word"])] = np.asarray(words["bits"])
    return out.view(np.uint64)


def _sizes(runs: DataFrame) -> list[int]:
    return sorted(r[0] for r in runs.select(F.shiftright("_run", 32)).distinct().collect())   # at most RUN_BYTES


def _frequencies(lowered: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """``(_run, _texts)``: in how many texts of a bounded sample each run of the filter occurs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [r for _, _, r in _hits(batch.column(0), bits, sizes)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *runs]))], names=["_run"])

    sample = lowered.select("_low").limit(SAMPLE_TEXTS)
    return sample.mapInArrow(count, "_run long").groupBy("_run").agg(F.count("*").alias("_texts"))


def _few_anchors(names: list[str], sample: DataFrame) -> dict[str, int]:
    """Of each name the run that is rarest in a sample of the texts, then among names."""
    parts = {n: _name_runs(n.encode()) for n in names}
    runs, in_names = np.unique(np.concatenate([np.empty(0, np.int64), *parts.values()]), return_counts=True)
    found = _frequencies(sample, _bits(runs), np.unique(runs >> 32).tolist()).toArrow() if names else None
    in_texts = dict(zip(found["_run"].to_pylist(), found["_texts"].to_pylist(), strict=True)) if names else {}
    in_names = dict(zip(runs.tolist(), in_names.tolist(), strict=True))
    return {n: min(r.tolist(), key=lambda x: (in_texts.get(x, 0), in_names[x], x)) for n, r in parts.items()}


def _anchors(names: DataFrame, sample: DataFrame) -> DataFrame:
    """``(_name, _run)``: the same for any number of names, by joins."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [_name_runs(n.encode()) for n in batch.column(0).to_pylist()]
            at = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(np.concatenate(runs))], names=["_name", "_run"])

    parts = stored(names.select("_name").distinct().mapInArrow(cut, "_name string, _run long"), "name-runs")
    in_texts = _frequencies(sample, _filter_of(parts), _sizes(parts))
    in_names = parts.groupBy("_run").agg(F.count("*").alias("_names"))
    rarest = F.min(F.struct(F.coalesce("_texts", F.lit(0)).alias("t"), F.col("_names").alias("n"), F.col("_run").alias("_run")))
    return parts.join(in_names, "_run").join(in_texts, "_run", "left").groupBy("_name").agg(rarest.getField("_run").alias("_run"))


def containment_join(
    texts: DataFrame, key: str, text: str, names: DataFrame, name: str, small_rows: int = SMALL_ROWS,
    sample: DataFrame | None = None,
) -> DataFrame:
    """(key, columns of ``names``) where the text contains the name, ignoring case.

    ``key`` must be unique in ``texts``.  A task marks the runs of its texts that are anchors in a filter
    of fixed size and nothing else leaves a text.  Up to ``small_rows`` names are sent to all tasks, where
    the exact test follows at once; more names meet the marked runs in a join, and the texts again.
    ``sample`` (with the column ``text``) is where rare runs are counted, by default ``texts``: a table
    that is cheaper to read spares computing ``texts`` twice.
    """
    named = names.withColumn("_name", F.lower(F.col(name))).where(F.length("_name") > 0)
    low = F.lower(F.col(text)).alias("_low")
    lowered = texts.where(F.col(text).isNotNull()).select(key, low)
    counted = (texts if sample is None else sample).where(F.col(text).isNotNull()).select(low)
    kind = lowered.schema[key].dataType.simpleString()
    known = [r["_name"] for r in named.select("_name").distinct().limit(small_rows + 1).collect()]
    small = len(known) <= small_rows
    by_run: dict[int, list[bytes]] = {}
    if small:
        for n, run in _few_anchors(known, counted).items():
            by_run.setdefault(run, []).append(n.encode())
        runs = np.array(list(by_run), np.int64)
        bits, sizes = _bits(runs), np.unique(runs >> 32).tolist()
    else:
        anchors = stored(_anchors(named, counted), "anchors")
        bits, sizes = _filter_of(anchors), _sizes(anchors)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = [], []
            for row, body, runs in _hits(batch.column(1), bits, sizes):
                inside = [n.decode() for r in runs.tolist() for n in by_run.get(r, ()) if n in body] if small else runs.tolist()
                rows += [row] * len(inside)
                values += inside
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(values, pa.string() if small else pa.int64())], names=[key, "_found"])

    if small:
        hits = lowered.mapInArrow(find, f"`{key}` {kind}, _found string").withColumnRenamed("_found", "_name")
    else:
        marked = lowered.mapInArrow(find, f"`{key}` {kind}, _found long").withColumnRenamed("_found", "_run")
        hits = marked.join(anchors, "_run").select(key, "_name").join(lowered, key) \
            .where(F.col("_low").contains(F.col("_name"))).select(key, "_name")
    return hits.join(named, "_name").drop("_name")


def overlap_join(
    texts: DataFrame, key: str, text_tokens: str, entries: DataFrame, entry: str, entry_tokens: str,
    threshold: float = 1.0, small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Distinct (key, entry) where at least ``threshold`` of the entry's tokens are in the text.

    With n tokens and m needed, any match holds one of the n - m + 1 rarest: only those are
    join keys.  ``threshold=1`` is the subset test.  Repeated tokens count once; rows that share
    a key are one text.  ``small_rows`` decides how the anchors are joined, never what matches.
    """
    usable = entries.select(entry, F.array_distinct(entry_tokens).alias("_toks")).where(F.size("_toks") > 0)
    usable = usable.withColumn("_id", F.to_json(F.struct(entry, "_toks")))
    need = F.ceil(F.size("_toks") * F.lit(threshold) - F.lit(1e-9))
    parts = usable.select("_id", (F.size("_toks") - need + 1).cast("int").alias("_keep"), F.explode("_toks").alias("_tok"))
    anchors = _rarest(parts, "_id", "_tok", F.col("_keep")).join(usable, "_id").select("_tok", "_id", entry, "_toks")
    anchors = F.broadcast(anchors) if fits(parts.select("_tok"), small_rows) else anchors
    words = texts.select(key, F.array_distinct(text_tokens).alias("_words"))
    candidates = words.select(key, F.explode("_words").alias("_tok")).join(anchors, "_tok").select(key, "_id", entry, "_toks").distinct()
    shared = candidates.join(words, key).select(
        key, "_id", entry, F.size("_toks").alias("_n"), F.explode(F.array_intersect("_words", "_toks")).alias("_tok"))
    # the set holds tokens of one entry, so it is bounded by the entry
    hits = shared.groupBy(key, "_id", entry, "_n").agg(F.size(F.collect_set("_tok")).alias("_hit"))
    return hits.where(F.col("_hit") / F.col("_n") >= F.lit(threshold)).select(key, entry).distinct()


def words_among(texts: DataFrame, key: str, words: str, known: DataFrame, small_rows: int = SMALL_ROWS) -> DataFrame:
    """``texts`` with only those of their words that are in ``known(_tok)``, stored: one pass over the texts
    for whatever is asked of these words.  Texts without any are left out."""
    known = known.select("_tok").distinct()
    known = F.broadcast(known) if fits(known, small_rows) else known
    found = texts.select(key, F.explode(words).alias("_tok")).join(known, "_tok", "left_semi").select(key, F.array("_tok").alias(words))
    return stored(found, "known-words")


def match_article_entities(
    articles: DataFrame, companies: DataFrame, key: str = "url", text: str = "text",
    ticker: str = "ticker", name: str = "company_name", sector: str = "sector",
    require_match: bool = False, fold=fold_text,
) -> DataFrame:
    """Per article: sorted matched tickers and sectors.

    A ticker matches as a token, a name when all its tokens (two letters or more) occur, a
    sector when 40 % of its tokens (three letters or more) occur.
    """
    texts = articles.select(key, tokens(fold(F.col(text))).alias("_words"))
    code, label = F.trim(F.col(ticker)), F.trim(F.col(name))
    by_code = companies.select(code.alias("ticker"), F.array(fold(code)).alias("_need")).where("ticker <> ''")
    by_name = companies.where(F.length(label) > 3).select(
        code.alias("ticker"), tokens(fold(label), 2).alias("_need")
    )
    needs = by_code.unionByName(by_name)
    groups = companies.select(strip_index_prefix(F.col(sector)).alias("sector")).dropna().distinct()
    groups = groups.withColumn("_need", tokens(fold(F.col("sector")), 3))
    known = needs.select("_need").unionByName(groups.select("_need")).select(F.explode("_need").alias("_tok"))
    texts = words_among(texts, key, "_words", known)
    tickers = overlap_join(texts, key, "_words", needs, "ticker", "_need")
    sectors = overlap_join(texts, key, "_words", groups, "sector", "_need", K.SECTOR_OVERLAP)
    kinds = tickers.select(key, F.lit("t").alias("_kind"), F.col("ticker").alias("_value")).unionByName(
        sectors.select(key, F.lit("s").alias("_kind"), F.col("sector").alias("_value"))
    )
    # lists are bounded by the company and sector dimensions
    found = kinds.groupBy(key).agg(
        F.array_sort(F.collect_set(F.when(F.col("_kind") == "t", F.col("_value")))).alias("tickers"),
        F.array_sort(F.collect_set(F.when(F.col("_kind") == "s", F.col("_value")))).alias("sectors"),
    )
    if require_match:
        return found
    none = F.array().cast("array<string>")
    return articles.select(key).join(found, key, "left").select(
        key, F.coalesce("tickers", none).alias("tickers"), F.coalesce("sectors", none).alias("sectors")
    )


def keyword_index(
    companies: DataFrame, ordinal: str, ticker: str = "ticker", name: str = "company_name",
    stop_words: list[str] | None = None,
) -> DataFrame:
    """(keyword, ticker): tickers and full names overwrite (last wins), single words only fill
    gaps (first wins)."""
    stop = K.NAME_STOP_WORDS if stop_words is None else stop_words
    low = F.lower(F.col(name))
    words = F.filter(F.split(low, r"[\s\-/&()']+"), lambda w: (F.length(w) > 4) & ~w.isin(stop))
    entries = F.concat(
        F.array(
            F.struct(F.lower(F.col(ticker)).alias("keyword"), F.lit(1).alias("step")),
            F.struct(low.alias("keyword"), F.lit(2).alias("step")),
        ),
        F.transform(words, lambda w: F.struct(w.alias("keyword"), F.lit(3).alias("step"))),
    )
    rows = companies.select(F.col(ticker).alias("ticker"), F.col(ordinal).alias("_ord"), F.inline(entries))
    fixed = F.col("step") < 3
    return rows.groupBy("keyword").agg(F.coalesce(
        F.max_by(F.when(fixed, F.col("ticker")), F.when(fixed, F.struct("_ord", "step"))),
        F.min_by("ticker", "_ord"),
    ).alias("ticker"))


def match_keywords(articles: DataFrame, key: str, text: str, index: DataFrame) -> DataFrame:
    """Distinct (key, ticker) for every keyword contained in the text."""
    return containment_join(articles, key, text, index, "keyword").select(key, "ticker").distinct()


def assign_details(
    companies: DataFrame, details: DataFrame, company_order: str, detail_order: str,
    ticker: str = "ticker", company_name: str = "company_name", detail_name: str = "detail_name",
) -> DataFrame:
    """(ticker, detail row order): name contained either way.

    Each detail goes to its first matching company; a later detail replaces an earlier one.
    """
    c = companies.select(F.col(company_order).alias("_c"), F.col(company_name).alias("_cname"))
    d = details.select(F.col(detail_order).alias("_d"), F.col(detail_name).alias("_dname"))
    inside = containment_join(c, "_c", "_cname", d, "_dname").select("_c", "_d")
    around = containment_join(d, "_d", "_dname", c, "_cname").select("_c", "_d")
    first = inside.unionByName(around).groupBy("_d").agg(F.min("_c").alias("_c"))
    owner = companies.select(F.col(company_order).alias("_c"), F.col(ticker).alias("ticker"))
    return first.join(owner, "_c").groupBy("ticker").agg(F.max("_d").alias(detail_order))
