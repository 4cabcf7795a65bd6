"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given tables (or data Spark derives from them) in
full, so its work grows with the input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketfold.functions import constants as C
from marketfold.operators import batches
from marketfold.operators import book
from marketfold.operators import inventory
from marketfold.operators import ledger
from marketfold.operators import observability as obs
from marketfold.operators import canonical as canon
from marketfold.operators import silver
from marketfold.operators import snapshots as snap
from marketfold.operators import prediction_parser
from marketfold.operators import reference_data as refdata
from marketfold.operators import spot_parser
from marketfold.session import cut_lineage
from marketfold.sources import derived, frames
from marketfold.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]

FLAGSHIP_INTERVAL_S = 300


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.events_to_canonical(read_table(spark, sf_dir, "events"))


def _drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.events_to_drop_notices(read_table(spark, sf_dir, "events"))


def q_snapshots_dense(spark: SparkSession, sf_dir: str, interval_s: int = FLAGSHIP_INTERVAL_S) -> DataFrame:
    return snap.snapshots_dense(_canonical(spark, sf_dir), canon.markets_frame(spark), interval_s,
                                drops=_drops(spark, sf_dir))


def _spot(spark: SparkSession, sf_dir: str, channel: str) -> DataFrame:
    return spot_parser.parse_spot_frames(frames.spot_frames(read_table(spark, sf_dir, "events")), (channel,))


def q_parse_coinbase_trades(spark, sf_dir):
    return _spot(spark, sf_dir, "market_trades").select(
        "seq", "pos", "market_key", "kind", "event_us", "product_id", "price", "size", "side")


def q_parse_coinbase_ticker(spark, sf_dir):
    return _spot(spark, sf_dir, "ticker").select(
        "seq", "pos", "market_key", "kind", "event_us", "product_id", "bid", "ask", "last_trade_px")


def q_parse_coinbase_heartbeat(spark, sf_dir):
    return _spot(spark, sf_dir, "heartbeats").select(
        "seq", "pos", "market_key", "kind", "event_us", "product_id")


_PRED_IDENT = ("seq", "pos", "market_key", "side", "asset_id", "slug", "bucket_start_ts", "condition_id", "event_us")


def _pred_inputs(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    bindings = refdata.bindings_from_canonical(canon.events_to_canonical(ev))
    return prediction_parser.messages(frames.prediction_frames(ev)), bindings


def q_parse_pm_price_change(spark, sf_dir):
    msgs, b = _pred_inputs(spark, sf_dir)
    return prediction_parser.parse_price_changes(msgs, b).select(*_PRED_IDENT, "kind", "bid", "ask", "price")


def q_parse_pm_book_top(spark, sf_dir):
    msgs, b = _pred_inputs(spark, sf_dir)
    return prediction_parser.parse_books(msgs, b).select(*_PRED_IDENT, "kind", "bid", "ask")


def q_parse_pm_trades(spark, sf_dir):
    msgs, b = _pred_inputs(spark, sf_dir)
    return prediction_parser.parse_last_trades(msgs, b).select(*_PRED_IDENT, "kind", "price", "size", "trade_side")


def q_binding_enrich(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    b = refdata.bindings_from_canonical(canon.events_to_canonical(ev))
    return prediction_parser.parse_prediction_frames(frames.prediction_frames(ev), b).select(*_PRED_IDENT, "kind")


def _resolved(spark, sf_dir):
    c = _canonical(spark, sf_dir)
    return refdata.resolve_markets(refdata.refresh_points(c), refdata.metadata_landing(c))


def q_market_resolve(spark, sf_dir):
    return _resolved(spark, sf_dir)


def q_yes_no_pick(spark, sf_dir):
    return _resolved(spark, sf_dir).filter(F.col("error").isNull()).select("slug", "yes_asset_id", "no_asset_id")


def q_binding_unpivot(spark, sf_dir):
    return refdata.meta_to_bindings(_resolved(spark, sf_dir))


def q_meta_upsert(spark, sf_dir):
    return refdata.meta_in_effect(_resolved(spark, sf_dir))


def q_subscription_delta(spark, sf_dir):
    return refdata.subscription_delta(refdata.meta_in_effect(_resolved(spark, sf_dir)))


def _snapshot_rows(spark, sf_dir):
    return batches.snapshot_row_json(q_snapshots_dense(spark, sf_dir))


def _batched(spark, sf_dir):
    return batches.chunk_batches(_snapshot_rows(spark, sf_dir), C.INGEST_BATCH_SIZE)


def q_batch_chunks(spark, sf_dir):
    return batches.batch_envelopes(_batched(spark, sf_dir))


def q_batch_validate(spark, sf_dir):
    """Batches cut per venue only (markets interleaved in time order) and
    declaring the first row's market: the homogeneity check rejects them."""
    b = batches.chunk_batches(_snapshot_rows(spark, sf_dir), C.INGEST_BATCH_SIZE, keys=("venue",),
                              tiebreak=("market_key",))
    w = Window.partitionBy("venue", "batch_no")
    b = b.withColumn("declared_source", F.col("venue")).withColumn(
        "declared_market", F.min_by(F.col("market_key"), F.col("rn")).over(w))
    return batches.validate_batches(b)


def _silver_rows(spark, sf_dir):
    return _batched(spark, sf_dir).withColumnRenamed("venue", "source").withColumn("market", F.col("market_key"))


def _silver(spark, sf_dir):
    return silver.normalize(silver.parse_row_text(_silver_rows(spark, sf_dir)), keep=("batch_id", "rn"))


def q_silver_normalize(spark, sf_dir):
    s = _silver(spark, sf_dir).drop("rn")
    micros = {"ts_utc", "last_event_ts_utc", "bucket_start_ts_utc"}
    return s.select(*[(F.unix_micros(F.col(c)).alias(f"{c}_us") if c in micros else F.col(c)) for c in s.columns])


def q_partition_paths(spark, sf_dir):
    per_batch = silver.batch_hours(_silver_rows(spark, sf_dir))
    d, so, m, b, h = (F.col(c) for c in ("snapshot_date", "source", "market", "batch_id", "hour"))
    rel = silver.export_relpath(b, d, so, m, h)
    return per_batch.select("batch_id", silver.bronze_path(d, so, m, b).alias("bronze_path"),
                            silver.silver_path(b, d, so, m, h).alias("silver_path"), rel.alias("target_relpath"),
                            silver.staged_path(rel).alias("staged_path"), silver.manifest_path(b).alias("manifest_path"))


def q_interval_counts(spark, sf_dir):
    a = snap.interval_aggregates(_canonical(spark, sf_dir), canon.markets_frame(spark), FLAGSHIP_INTERVAL_S)
    return a.select("market_key", F.col("snap_ts").alias("snapshot_ts"), "msg_count_1s", "trade_count_1s",
                    "book_update_count_1s")


def _venue_view(spark, sf_dir, venue, gauges):
    """Snapshots of one venue's markets with some of their gauges.  The run
    window is that of all events, hence the other venue's clock rows."""
    c, markets = _canonical(spark, sf_dir), canon.markets_frame(spark)
    span = snap.run_window(c, FLAGSHIP_INTERVAL_S, _drops(spark, sf_dir))
    own = markets.filter(F.col("venue") == venue)
    return snap.snapshots_dense(c, own, FLAGSHIP_INTERVAL_S, drops=_drops(spark, sf_dir), gauges=gauges, run=span)


def q_cb_quote_spread(spark, sf_dir):
    return _venue_view(spark, sf_dir, "coinbase", ("best_bid", "best_ask")).select(
        "market_key", "snapshot_ts", "best_bid", "best_ask", "mid", "spread_bps")


def q_cb_last_trade(spark, sf_dir):
    return _venue_view(spark, sf_dir, "coinbase", ("last_trade_px", "last_trade_size", "last_trade_side")).select(
        "market_key", "snapshot_ts", "last_trade_px", "last_trade_size", "last_trade_side")


def q_pm_side_pivot(spark, sf_dir):
    return _venue_view(spark, sf_dir, "polymarket", ("yes_best_bid", "yes_best_ask", "no_best_bid", "no_best_ask", "last_trade_px_yes", "last_trade_px_no", "slug",
                                              "bucket_start_ts", "condition_id")).select(
        "market_key", "snapshot_ts", "yes_best_bid", "yes_best_ask", "yes_mid", "no_best_bid", "no_best_ask", "no_mid",
        "last_trade_px_yes", "last_trade_px_no", "slug", "bucket_start_ts", "condition_id")


def q_dropped_merge(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    spot = canon.events_to_drop_notices(ev)
    pred = (ev.filter(F.col("event_type") == "error")
              .select(F.element_at(F.array(*[F.lit(m) for m in canon.ADAPTER_MARKET_ORDER]),
                                   (F.pmod(F.col("user_id"), F.lit(4)) + 1).cast("int")).alias("market_key"),
                      F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000)).cast("bigint").alias("recv_s"),
                      (F.pmod(F.floor(F.from_json("props", "k INT").getField("k") / F.lit(10)), F.lit(3)) - 1).cast("bigint").alias("n")))
    return snap.merge_drop_counts([spot, pred], canon.markets_frame(spark), FLAGSHIP_INTERVAL_S)


def q_max_stale(spark, sf_dir):
    return q_snapshots_dense(spark, sf_dir).groupBy("snapshot_ts").agg(
        F.max(F.coalesce(F.col("stale_ms"), F.lit(0.0))).alias("ws_stale_ms"))


def _claims(spark, sf_dir):
    """Control records; cut, as its readers use them more than once."""
    return cut_lineage(derived.claims_from_envelopes(q_batch_chunks(spark, sf_dir)), "claims")


def q_ledger_first_wins(spark, sf_dir):
    return ledger.first_wins(_claims(spark, sf_dir))


def q_ledger_new_only(spark, sf_dir):
    c = _claims(spark, sf_dir)
    existing = ledger.first_wins(c.filter((F.pmod(F.col("batch_no"), F.lit(2)) == 0) & (F.col("delivery") == 0)))
    return ledger.new_only(c, existing).select("stage", "id", "delivery", "produced_at")


def q_stage_lag(spark, sf_dir):
    return obs.stage_lags(ledger.first_wins(_claims(spark, sf_dir)))


def q_alert_gap(spark, sf_dir):
    fw = ledger.first_wins(_claims(spark, sf_dir)).filter(F.col("stage") == "persist")
    writes = fw.select(F.unix_micros(F.to_timestamp(F.regexp_replace("produced_at", "Z$", ""))).alias("ts_us"))
    return obs.freshness_gaps(writes)


def q_metric_rollup(spark, sf_dir):
    return obs.metric_rollup(derived.metric_samples(read_table(spark, sf_dir, "events")))


def q_metric_text(spark, sf_dir):
    return obs.metric_text(q_metric_rollup(spark, sf_dir))


def q_liveness(spark, sf_dir):
    return obs.liveness(derived.worker_ops(read_table(spark, sf_dir, "events")))


def q_alert_sustained(spark, sf_dir):
    return obs.sustained_above(derived.queue_depth(read_table(spark, sf_dir, "events")), "queue", "ts_us", "depth",
                               500.0, 600)


def q_alert_not_ready(spark, sf_dir):
    return obs.not_ready_runs(derived.probes(read_table(spark, sf_dir, "events")))


def q_alert_restarts(spark, sf_dir):
    """Workers that restart more than three times in a sliding window; the
    derived workers restart rarely, hence 12 hours instead of 15 minutes."""
    r = derived.restarts(read_table(spark, sf_dir, "events"))
    return obs.rate_alerts(r, "ts", "12 hours", "30 minutes", 4, ("worker",))


def q_alert_rate(spark, sf_dir):
    return obs.rate_alerts(derived.failures(read_table(spark, sf_dir, "events")), "ts")


def q_batch_defaults(spark, sf_dir):
    """Envelopes with some fields left out by batch number, and their defaults."""
    b = _batched(spark, sf_dir).groupBy("batch_id", "venue", "market_key", "snapshot_date", "batch_no").agg(
        F.min_by(F.struct(F.col("venue"), F.concat(F.lit(" "), F.col("market_key")).alias("market_key"), "ts_utc"), F.col("rn")).alias("first_row"),
        F.count(F.lit(1)).alias("n"))
    no = F.col("batch_no")
    return batches.batch_defaults(b.select(
        F.when(no % 7 != 3, F.col("batch_id")).alias("batch_id"), F.when(no % 2 == 0, F.col("venue")).otherwise(F.lit("  ")).alias("source"),
        F.when(no % 3 == 0, F.col("market_key")).alias("market"), F.when(no % 5 == 0, F.col("snapshot_date")).alias("snapshot_date"),
        F.when(no % 11 == 4, F.lit(0)).otherwise(F.col("n")).cast("bigint").alias("row_count"),
        F.when(no % 11 != 4, F.col("first_row")).alias("first_row")))


def q_decode_records(spark, sf_dir):
    """The records of all stages, each by its own codec."""
    c = _claims(spark, sf_dir)
    records = {"persist": "bronze_written", "transform": "bronze_written", "export": "export_intent", "relay": "relay_intent"}
    return c.select("stage", "delivery", *ledger.decode_records(F.col("handoff"), F.col("stage"), records))


def q_next_parts(spark, sf_dir):
    """New part files, one per order, numbered after the listed ones."""
    new = read_table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_str"),
        F.element_at(F.array(*map(F.lit, canon.ADAPTER_MARKET_ORDER)), (F.pmod("o_custkey", F.lit(4)) + 1).cast("int")).alias("market_key"),
        F.col("o_orderdate").cast("timestamp").alias("start"), F.col("o_orderkey").alias("k"))
    return inventory.next_parts(_listing(spark, sf_dir), new)


def q_file_growth(spark, sf_dir):
    listing = _listing(spark, sf_dir)
    return inventory.growth_rates(listing, derived.later_listing(listing))


def q_parse_pm_quotes(spark, sf_dir):
    msgs, b = _pred_inputs(spark, sf_dir)
    return prediction_parser.parse_best_bid_ask(msgs, b).select(*_PRED_IDENT, "kind", "bid", "ask")


def q_bindings_in_effect(spark, sf_dir):
    return refdata.bindings_in_effect(refdata.meta_in_effect(_resolved(spark, sf_dir)))


def q_text_helpers(spark, sf_dir):
    """The scalar text and number helpers over derived values of ``events``."""
    from marketfold.functions import exprs as X
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.from_json("props", "k INT").getField("k").alias("k"),
                                                    F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    hexed = F.sha2(F.col("event_id").cast("string"), 256)
    flag = F.element_at(F.array(*map(F.lit, (" Yes", "no", "ON", "1", "y ", "maybe"))), (F.col("k") % 6 + 1).cast("int"))
    folder = F.concat(F.lit(" \\\\"), F.col("event_type"), F.lit(" / a\\\\ "), F.col("k").cast("string"), F.lit("//"))
    return ev.select(
        "event_id", X.clean_path(folder).alias("folder"), X.sign_of(F.col("value") - 20).alias("sign"),
        X.sign_to_label(X.sign_of(F.col("value") - 20)).alias("label"), X.label_to_sign(F.upper(X.sign_to_label(X.sign_of(F.col("value") - 20)))).alias("sign_again"),
        X.safe_fmt("value").alias("fmt"), X.mask_addr(F.concat(F.lit("0x"), F.substring(hexed, 1, (F.col("k") % 20).cast("int")))).alias("masked"),
        X.compact_json(F.struct("event_type", "k"), 30).alias("compact"), X.parse_boolish(flag).alias("flag"),
        X.normalize_condition_id(F.when(F.col("k") % 3 == 0, F.concat(F.lit(" 0X"), F.upper(hexed))).when(F.col("k") % 3 == 1, hexed).otherwise(F.lit("0x12"))).alias("condition_id"),
        X.ts_floor(F.col("k") - 50, 30).alias("floored"), X.epoch_seconds(F.timestamp_micros("us")).alias("epoch"),
        X.utc_date(F.timestamp_micros("us")).alias("date"), X.compact_stamp(F.timestamp_micros("us")).alias("stamp"))


def q_feed_to_snapshots(spark, sf_dir):
    """The whole chain: raw frames -> parsers and order book, resolver metas as
    ``meta`` rows -> canonical events -> dense snapshots."""
    ev = read_table(spark, sf_dir, "events")
    spot = frames.spot_frames(ev)
    metas = cut_lineage(_resolved(spark, sf_dir), "feed-metas")
    prediction = prediction_parser.parse_prediction_frames(frames.prediction_frames(ev), refdata.bindings_by_asset(metas))
    feed = canon.conform(spot_parser.parse_spot_frames(spot)).unionByName(canon.conform(book.best_per_message(spot))) \
        .unionByName(canon.conform(prediction)).unionByName(refdata.meta_events(metas))
    return snap.snapshots_dense(feed, canon.markets_frame(spark), FLAGSHIP_INTERVAL_S)


def _l2_frames(spark, sf_dir):
    return frames.spot_frames(read_table(spark, sf_dir, "events"))


def q_book_levels_lifetime(spark, sf_dir):
    lt = book.level_lifetimes(book.book_ops(_l2_frames(spark, sf_dir))).filter(F.col("size") > 0)
    return lt.select("product", "side", "epoch", "price", "size", F.col("valid_from.seq").alias("from_seq"),
                     F.col("valid_to.ord.seq").alias("to_seq"))


def q_book_as_of(spark, sf_dir):
    return book.book_as_of_day_end(book.book_ops(_l2_frames(spark, sf_dir)))


def q_book_best_per_message(spark, sf_dir):
    return book.best_per_message(_l2_frames(spark, sf_dir)).select("seq", "pos", "market_key", "kind", "event_us",
                                                                   "product_id", "bid", "ask")


def _listing(spark, sf_dir):
    return derived.file_listing(read_table(spark, sf_dir, "orders"))


def q_file_inventory(spark, sf_dir):
    return inventory.pending_files(_listing(spark, sf_dir))


def q_size_projection(spark, sf_dir):
    return inventory.size_projection(inventory.market_day_sizes(_listing(spark, sf_dir), canon.markets_frame(spark)))


def q_export_manifest_audit(spark, sf_dir):
    """Bronze -> Silver -> export -> relay on files in the shared checkpoint
    folder, then the manifests' integrity audit, per partition."""
    import uuid

    from marketfold.session import checkpoint_dir
    from marketfold.sources.medallion import Medallion
    store = Medallion(spark, f"{checkpoint_dir(spark)}/tables/medallion-{uuid.uuid4().hex}")
    store.persist(_batched(spark, sf_dir))
    store.transform()
    store.export()
    store.relay()
    return store.audit().groupBy("snapshot_date", "source", "market", "hour", "status").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("row_count").alias("row_count"))


def q_stream_snapshots(spark, sf_dir):
    """The feed (events and drop notices) lands in four parts; after each the
    stream is started again from its checkpoint, runs on what is new and
    stops; then the feed has ended and the open boundary is flushed."""
    import uuid

    from marketfold.session import checkpoint_dir
    from marketfold.streaming.snapshots_stream import FEED_SCHEMA, SnapshotStream, feed_rows, slices
    base = f"{checkpoint_dir(spark)}/tables/stream-{uuid.uuid4().hex}"
    stream = SnapshotStream(spark, canon.markets_frame(spark), FLAGSHIP_INTERVAL_S, base)
    feed = feed_rows(_canonical(spark, sf_dir), _drops(spark, sf_dir))
    for part in slices(feed, 4):
        part.write.mode("append").parquet(f"{base}/landing")
        stream.start(spark.readStream.schema(FEED_SCHEMA).parquet(f"{base}/landing")).awaitTermination()
    stream.flush()
    return stream.output()


def _shared_token(asset):
    """Tokens that markets share: seven per side, moving on with every bucket."""
    part = F.split(asset, "-")
    slot = F.floor(F.get(part, F.lit(3)).cast("bigint") / F.lit(300)).cast("bigint") + F.when(asset.startswith("pm-eth-"), 3).otherwise(0)
    return F.when(F.size(part) == 4, F.concat(F.lit("tok-"), F.get(part, F.lit(2)), F.lit("-"), F.pmod(slot, F.lit(7)).cast("string"))).otherwise(asset)


def q_binding_asof(spark, sf_dir):
    """Replay: every message meets the binding in force when it arrived.  The
    derived tokens are shared out anew at every refresh, so they change hands
    between slugs and markets and are free in between."""
    effective = refdata.meta_in_effect(_resolved(spark, sf_dir))
    shared = effective.withColumns({c: _shared_token(F.col(c)) for c in ("yes_asset_id", "no_asset_id")})
    msgs = prediction_parser.message_events(prediction_parser.messages(frames.prediction_frames(read_table(spark, sf_dir, "events"))))
    msgs = cut_lineage(msgs.withColumn("asset_id", _shared_token(F.col("asset_id"))), "asof-messages")
    return prediction_parser.bound_as_of(msgs, refdata.binding_changes(shared)).select(
        "seq", "pos", "kind", "asset_id", "market_key", "side", "slug", "bucket_start_ts", "condition_id", "since")


def q_stream_hops(spark, sf_dir):
    """The file layer as streams: batches land in three parts, the middle one
    twice; each stage is started again after each part.  Every seventh batch
    holds a row without a time and is quarantined.  What is there in the end:
    intact payloads, refused batches, and how often each batch was claimed."""
    from marketfold.sources.medallion import Medallion
    base = _stream_root(spark, "hops")
    rows = _batched(spark, sf_dir)
    poison = (F.col("batch_no") % 7 == 3) & (F.col("rn") % 250 == 9)
    rows = cut_lineage(rows.withColumn("row_json", F.when(poison, F.lit('{"mid": 1}')).otherwise(F.col("row_json"))), "hops-batches")
    store = Medallion(spark, f"{base}/store")
    for k in (0, 1, 1, 2):
        rows.filter(F.col("batch_no") % 3 == k).write.mode("append").parquet(f"{base}/landing")
        store.start_persist(spark.readStream.schema(rows.schema).parquet(f"{base}/landing"), f"{base}/checkpoints").awaitTermination()
        for stage in ("transform", "export", "relay"):
            store.start_stage(stage, f"{base}/checkpoints").awaitTermination()
    place = ("snapshot_date", "source", "market")
    kept = store.audit().select(*place, "status", F.col("export_id").alias("batch_id"), "row_count")
    refused = store.quarantine().select(*place, F.col("error").alias("status"), "batch_id", "row_count")
    claims = store.ledger().groupBy(F.col("id").alias("batch_id")).agg(F.count(F.lit(1)).alias("claims"))
    return kept.unionByName(refused).join(claims, "batch_id").groupBy(*place, "status").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("row_count").alias("row_count"), F.sum("claims").alias("claims"))


def q_rolled_parts(spark, sf_dir):
    """Event lines rolled into parts of 2000 bytes, after the parts that are
    listed for their days."""
    from marketfold.sources import rolling
    ev = read_table(spark, sf_dir, "events")
    lines = derived.event_lines(ev)
    parts = rolling.part_table(rolling.rolled(lines, 2000, ("ts", "event_id")), derived.listed_parts(ev))
    return parts.drop("cut")


def q_payload_audit(spark, sf_dir):
    """Manifests of the listed files against what lies there: bytes that
    changed, files that were cut short, files that are gone."""
    from marketfold.sources.medallion import payload_status
    listing = _listing(spark, sf_dir)
    status = payload_status(derived.manifests_of(listing), derived.stored_bytes(listing))
    return status.select("export_id", "staged_blob_path", "content_sha256", "content_length", "actual_sha256", "actual_length", "status")


def q_stream_event_time(spark, sf_dir):
    """Events arrive up to an hour late, some many hours; four parts by arrival,
    a restart after each.  Per market and interval: rows in time and late ones."""
    from marketfold.streaming.event_time_stream import EventTimeStream, event_second
    from marketfold.streaming.snapshots_stream import FEED_SCHEMA, feed_rows, slices
    base = _stream_root(spark, "event-time")
    delay = F.pmod(F.col("seq") * F.lit(7919), F.lit(3600)) + F.when(F.pmod(F.col("seq"), F.lit(50)) == 7, F.lit(900_000)).otherwise(F.lit(0))
    feed = cut_lineage(feed_rows(_canonical(spark, sf_dir).withColumn("recv_s", F.col("recv_s") + delay)), "stream-feed")
    stream = EventTimeStream(spark, canon.markets_frame(spark), FLAGSHIP_INTERVAL_S, 3600, base)
    for part in slices(feed, 4):
        part.write.mode("append").parquet(f"{base}/landing")
        stream.start(spark.readStream.schema(FEED_SCHEMA).parquet(f"{base}/landing")).awaitTermination()
    stream.flush()
    in_time = stream.output().select("market_key", "snapshot_ts", F.col("msg_count_1s").alias("in_time"), F.col("trade_count_1s").alias("trades"), "best_bid")
    late = stream.late().groupBy("market_key", snap.boundary_of(event_second(), FLAGSHIP_INTERVAL_S).alias("snapshot_ts")).agg(F.count(F.lit(1)).alias("late"))
    both = in_time.join(late, ["market_key", "snapshot_ts"], "full")
    return both.select("market_key", "snapshot_ts", F.coalesce("in_time", F.lit(0)).alias("in_time"), F.coalesce("trades", F.lit(0)).alias("trades"),
                       F.coalesce("late", F.lit(0)).alias("late"), "best_bid")


def q_stream_book(spark, sf_dir):
    """Level-2 frames land in three parts; after each the stream of the keyed
    book is started again from its checkpoint."""
    from marketfold.session import conf_scope
    from marketfold.streaming import book_stream
    base = _stream_root(spark, "book")
    landed = _l2_frames(spark, sf_dir)
    for part in _frame_parts(landed, 3):
        part.write.mode("append").parquet(f"{base}/landing")
        with conf_scope(spark, book_stream.STATE_STORE):
            book_stream.best_per_message(frames.stream_frames(spark, f"{base}/landing")).writeStream.format("parquet") \
                .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(canon.CANONICAL_SCHEMA).parquet(f"{base}/out").select("seq", "pos", "market_key", "kind", "event_us", "product_id", "bid", "ask")


def q_stream_feed(spark, sf_dir):
    """The chain of ``feed_to_snapshots`` as a stream: raw frames and metas land
    in three parts by arrival, with a restart after each."""
    from marketfold.streaming import feed_stream
    from marketfold.streaming.snapshots_stream import SnapshotStream
    base = _stream_root(spark, "feed")
    ev = read_table(spark, sf_dir, "events")
    metas = cut_lineage(_resolved(spark, sf_dir), "feed-metas")
    landed = frames.spot_frames(ev).unionByName(frames.prediction_frames(ev))
    refdata.bindings_by_asset(metas).write.parquet(f"{base}/bindings")
    stream = SnapshotStream(spark, canon.markets_frame(spark), FLAGSHIP_INTERVAL_S, base)
    cuts = _arrival_cuts(landed, 3)
    for part, meta in zip(_between(landed, F.col("recv_us"), cuts), _between(refdata.meta_events(metas), F.col("recv_s") * F.lit(1_000_000), cuts)):
        meta.write.mode("append").parquet(f"{base}/metas")
        part.write.mode("append").parquet(f"{base}/landing")
        feed_stream.start(stream, frames.stream_frames(spark, f"{base}/landing"), spark.read.parquet(f"{base}/bindings"),
                          spark.readStream.schema(canon.CANONICAL_SCHEMA).parquet(f"{base}/metas")).awaitTermination()
    stream.flush()
    return stream.output()


def _stream_root(spark, name: str) -> str:
    import uuid

    from marketfold.session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/tables/stream-{name}-{uuid.uuid4().hex}"


def _arrival_cuts(landed, n: int) -> list[int]:
    """Bounds of ``n`` equal spans of arrival time, in whole seconds."""
    lo, hi = landed.agg(F.min("recv_us"), F.max("recv_us")).first()
    if lo is None:
        return []
    return [(lo + (hi - lo) * k // n) // 1_000_000 * 1_000_000 for k in range(1, n)]


def _between(rows, at, cuts: list[int]):
    """The rows cut at ``cuts``; the first and last part are open-ended."""
    bounds = [None, *cuts, None]
    return [rows.filter((at >= a if a is not None else F.lit(True)) & (at < b if b is not None else F.lit(True))) for a, b in zip(bounds, bounds[1:])]


def _frame_parts(landed, n: int):
    return _between(landed, F.col("recv_us"), _arrival_cuts(landed, n))


def registry() -> dict[str, QueryFn]:
    return {
        "snapshots_dense": q_snapshots_dense,
        "parse_coinbase_trades": q_parse_coinbase_trades,
        "parse_coinbase_ticker": q_parse_coinbase_ticker,
        "parse_coinbase_heartbeat": q_parse_coinbase_heartbeat,
        "parse_pm_price_change": q_parse_pm_price_change,
        "parse_pm_book_top": q_parse_pm_book_top,
        "parse_pm_trades": q_parse_pm_trades,
        "binding_enrich": q_binding_enrich,
        "market_resolve": q_market_resolve,
        "yes_no_pick": q_yes_no_pick,
        "binding_unpivot": q_binding_unpivot,
        "meta_upsert": q_meta_upsert,
        "subscription_delta": q_subscription_delta,
        "batch_chunks": q_batch_chunks,
        "batch_validate": q_batch_validate,
        "silver_normalize": q_silver_normalize,
        "partition_paths": q_partition_paths,
        "interval_counts": q_interval_counts,
        "cb_quote_spread": q_cb_quote_spread,
        "cb_last_trade": q_cb_last_trade,
        "pm_side_pivot": q_pm_side_pivot,
        "dropped_merge": q_dropped_merge,
        "max_stale": q_max_stale,
        "ledger_first_wins": q_ledger_first_wins,
        "ledger_new_only": q_ledger_new_only,
        "stage_lag": q_stage_lag,
        "alert_gap": q_alert_gap,
        "metric_rollup": q_metric_rollup,
        "metric_text": q_metric_text,
        "liveness": q_liveness,
        "alert_sustained": q_alert_sustained,
        "alert_rate": q_alert_rate,
        "book_levels_lifetime": q_book_levels_lifetime,
        "book_as_of": q_book_as_of,
        "book_best_per_message": q_book_best_per_message,
        "file_inventory": q_file_inventory,
        "export_manifest_audit": q_export_manifest_audit,
        "stream_snapshots": q_stream_snapshots,
        "size_projection": q_size_projection,
        "alert_not_ready": q_alert_not_ready,
        "alert_restarts": q_alert_restarts,
        "batch_defaults": q_batch_defaults,
        "decode_records": q_decode_records,
        "next_parts": q_next_parts,
        "file_growth": q_file_growth,
        "parse_pm_quotes": q_parse_pm_quotes,
        "bindings_in_effect": q_bindings_in_effect,
        "text_helpers": q_text_helpers,
        "feed_to_snapshots": q_feed_to_snapshots,
        "binding_asof": q_binding_asof,
        "stream_hops": q_stream_hops,
        "rolled_parts": q_rolled_parts,
        "payload_audit": q_payload_audit,
        "stream_event_time": q_stream_event_time,
        "stream_book": q_stream_book,
        "stream_feed": q_stream_feed,
    }
