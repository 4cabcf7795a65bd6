"""Driver contract: entry smoke, registry/oracle coverage, SQL parity for
a fast subset at sf0.001 (the full set is checked at sf0.01 by the gate)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tests.oracle_compare import compare

FAST = ["interval_counts", "dropped_merge", "metric_rollup", "metric_text", "liveness", "alert_rate",
        "alert_sustained", "file_inventory", "size_projection", "parse_pm_trades", "market_resolve",
        "subscription_delta", "alert_gap", "alert_not_ready", "alert_restarts", "next_parts", "file_growth", "text_helpers",
        "bindings_in_effect", "parse_pm_quotes", "book_best_per_message"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "snapshot_ts" in df.columns and "market_key" in df.columns


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - set(o) <= set(E.LLM_QUERIES)


@pytest.mark.parametrize("name", FAST)
def test_sql_parity(spark, con001, name):
    ok, msg = compare(E.queries()[name](spark, SF001), con001, E.oracle_sql()[name])
    assert ok, msg
