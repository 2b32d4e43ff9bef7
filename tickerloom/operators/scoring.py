"""User functions: row scorers, functions per group, rows from rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.text import TextRules, lexicon_sentiment

Scorer = Callable[[pd.DataFrame], pd.DataFrame]


def score_with(
    df: DataFrame, scorer: Scorer, schema: T.StructType, key: str, retries: int = 2, delay: float = 1.0
) -> DataFrame:
    """Apply ``scorer`` to Arrow batches; a batch that keeps failing yields rows with ``error``.

    The scorer gets the input batch and returns one row per input row, in order, with the
    columns of ``schema``.  Waits double between attempts.  If every row of a partition fails
    the job stops, as nothing useful would be stored.
    """
    out_schema = T.StructType([df.schema[key], *schema.fields, T.StructField("error", T.StringType())])
    names = [f.name for f in schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scored = failed = 0
        problem = None
        for batch in batches:
            for attempt in range(retries + 1):
                try:
                    result = scorer(batch)[names].reset_index(drop=True)
                    result.insert(0, key, batch[key].to_numpy())
                    result["error"] = None
                    scored += len(batch)
                    break
                except Exception as caught:   # the scorer is foreign code
                    problem = caught
                    if attempt < retries:
                        time.sleep(delay * 2**attempt)
            else:
                failed += len(batch)
                result = pd.DataFrame({key: batch[key], **{n: None for n in names}, "error": str(problem)})
            yield result
        if failed and not scored:
            raise RuntimeError(f"scorer failed for all {failed} rows of a partition: {problem}")

    return df.mapInPandas(run, out_schema)


def score_by_lexicon(df: DataFrame, key: str, text: str, rules: TextRules = TextRules()) -> DataFrame:
    """Default scorer, as column expressions."""
    return df.select(key, F.inline(F.array(lexicon_sentiment(F.col(text), rules))))


MOST_GROUP_ROWS = 5_000_000


def per_group(
    df: DataFrame, keys: Sequence[str], function: Scorer, schema: str, most_rows: int = MOST_GROUP_ROWS
) -> DataFrame:
    """``keys`` and what ``function`` makes of each group's rows, a pandas frame at a time.

    A group is one frame in one task.  Groups are counted first, and one of more than ``most_rows`` rows
    is refused by name: such a group needs an aggregate or a window.  NULL keys are a group.
    """
    large = df.groupBy(*keys).count().where(F.col("count") > most_rows).limit(1).collect()
    if large:
        raise ValueError(f"group {large[0][:-1]} has {large[0][-1]} rows, more than {most_rows}")
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = function(rows)
        for at, (name, value) in enumerate(zip(keys, key, strict=True)):
            out.insert(at, name, value)
        return out

    return df.groupBy(*keys).applyInPandas(run, f"{kinds}, {schema}")


def rows_from(df: DataFrame, column: str, maker: type, schema: str) -> DataFrame:
    """Every row of ``df`` beside the rows that ``maker().eval(value of column)`` yields; a row that yields
    nothing goes.  The rows of one value leave the worker in batches as they are made."""
    made = F.udtf(maker, returnType=schema)
    return df.lateralJoin(made(F.col(column).outer()))
