"""Registered queries against their SQL.  TEST_ALL_QUERIES=1 runs every one."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tests.conftest import SF

QUICK = [
    "S11_upsert_newest", "S12_upsert_partial", "S17_reject_split", "B4_since_last_date", "B10_quantile_trim",
    "C6_text_contains_name", "C7_containment_either_way", "C8_token_subset", "C11_keyword_index", "C16_next_session",
    "D6_top_event_type", "D18_describe_by_label", "D25_histogram", "E7_latest_per_key", "E12_expected_return",
    "F4_lexicon_sentiment", "F9_fingerprint", "F28_published_time", "G6_people_summary", "I1_feed_dedup",
    "I3_stream_upsert", "I4_running_counts", "I5_daily_windows", "I7_pending_stream", "M2_time_split",
    "P2_enrich_articles", "P4_daily_signals", "P6_sentiment_weekly", "P9_event_impact", "P22_wide_returns",
    "P23_correlation_pairs", "P24_backtest", "P29_event_study", "P32_company_master", "U4_first_source_wins",
]
NAMES = list(entry.oracle_sql()) if os.environ.get("TEST_ALL_QUERIES") else QUICK


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert {"ticker", "date", "news_count", "next_day_return"} <= set(df.columns) and not df.isEmpty()
