"""DuckDB SQL oracles keyed like ``catalog.registry()``."""

from __future__ import annotations

from marketfold.plans import sql_parts as P
from marketfold.plans.catalog import FLAGSHIP_INTERVAL_S


def oracles() -> dict[str, str]:
    return {
        "snapshots_dense": P.snapshots_sql(FLAGSHIP_INTERVAL_S),
        "parse_coinbase_trades": P.spot_parse_sql("trades"),
        "parse_coinbase_ticker": P.spot_parse_sql("ticker"),
        "parse_coinbase_heartbeat": P.spot_parse_sql("heartbeat"),
        "parse_pm_price_change": P.pred_parse_sql("price_change"),
        "parse_pm_book_top": P.pred_parse_sql("book"),
        "parse_pm_trades": P.pred_parse_sql("trades"),
        "binding_enrich": P.pred_parse_sql("enrich"),
        "market_resolve": P.refdata_sql("resolve"),
        "yes_no_pick": P.refdata_sql("pick"),
        "binding_unpivot": P.refdata_sql("unpivot"),
        "meta_upsert": P.refdata_sql("upsert"),
        "subscription_delta": P.refdata_sql("delta"),
        "batch_chunks": P.batch_sql("chunks"),
        "batch_validate": P.batch_sql("validate"),
        "silver_normalize": P.batch_sql("silver"),
        "partition_paths": P.batch_sql("paths"),
        "interval_counts": P.interval_counts_sql(FLAGSHIP_INTERVAL_S),
        "cb_quote_spread": P.snapshot_view_sql("cb_quote_spread"),
        "cb_last_trade": P.snapshot_view_sql("cb_last_trade"),
        "pm_side_pivot": P.snapshot_view_sql("pm_side_pivot"),
        "dropped_merge": P.dropped_merge_sql(FLAGSHIP_INTERVAL_S),
        "max_stale": P.snapshot_view_sql("max_stale"),
        "ledger_first_wins": P.ledger_sql("first_wins"),
        "ledger_new_only": P.ledger_sql("new_only"),
        "stage_lag": P.ledger_sql("stage_lag"),
        "alert_gap": P.ledger_sql("alert_gap"),
        "metric_rollup": P.ops_sql("metric_rollup"),
        "metric_text": P.ops_sql("metric_text"),
        "liveness": P.ops_sql("liveness"),
        "alert_sustained": P.ops_sql("alert_sustained"),
        "alert_rate": P.ops_sql("alert_rate"),
        "book_levels_lifetime": P.book_sql("lifetime"),
        "book_as_of": P.book_sql("as_of"),
        "file_inventory": P.inventory_sql("pending"),
        "stream_snapshots": P.snapshots_sql(FLAGSHIP_INTERVAL_S),
        "export_manifest_audit": P.batch_sql("audit"),
        "alert_not_ready": P.ops_sql("alert_not_ready"),
        "alert_restarts": P.ops_sql("alert_restarts"),
        "batch_defaults": P.batch_sql("defaults"),
        "decode_records": P.ledger_sql("decoded"),
        "next_parts": P.inventory_sql("next_parts"),
        "file_growth": P.inventory_sql("growth"),
        "parse_pm_quotes": P.pred_parse_sql("quotes"),
        "bindings_in_effect": P.refdata_sql("in_effect"),
        "text_helpers": P.text_helpers_sql(),
        "feed_to_snapshots": P.feed_snapshots_sql(FLAGSHIP_INTERVAL_S),
        "book_best_per_message": P.book_sql("best"),
        "stream_hops": P.batch_sql("hops"),
        "rolled_parts": P.inventory_sql("rolled"),
        "payload_audit": P.inventory_sql("payload_audit"),
        "stream_event_time": P.event_time_sql(FLAGSHIP_INTERVAL_S),
        "binding_asof": P.refdata_sql("asof"),
        "stream_book": P.book_sql("best"),
        "stream_feed": P.feed_snapshots_sql(FLAGSHIP_INTERVAL_S),
        "size_projection": P.inventory_sql("projection"),
    }
