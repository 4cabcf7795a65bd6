"""Parser edge cases on hand-written frames (FIXTURES F and G shapes)."""

from pyspark.sql import functions as F

from marketfold.operators import book, prediction_parser, spot_parser


def frames(spark, values, venue):
    rows = [(i + 1, 1_773_230_400_000_000 + i, venue, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "seq bigint, recv_us bigint, venue string, value string")


def test_spot_shapes(spark):
    vals = [
        '{"channel":"heartbeats","timestamp":"2026-03-11T12:00:00Z","events":[{"current_time":"2026-03-11 12:00:00.123456789 +0000 UTC m=+1"}]}',
        '{"channel":"ticker","timestamp":"2026-03-11T12:00:00Z","events":[{"tickers":[{"product_id":"BTC-USD","best_bid":"100.1","best_ask":"100.2","price":"100.15"}]}]}',
        '{"channel":"market_trades","timestamp":"2026-03-11T12:00:00Z","events":[{"trades":[{"product_id":"eth-usd","price":"2000.2","size":"0.01","side":"buy","time":"2026-03-11T12:00:00.5Z"}]}]}',
        'not json',
        '{"channel":"ticker","events":{"x":1}}',
        '{"channel":"market_trades","events":[5,"x",{"trades":[{"product_id":"DOGE-USD","price":"1"},{"product_id":"BTC-USD","price":"n/a"}]}]}',
        '{"channel":"ticker","events":[{"tickers":[{"product_id":"BTC-USD","best_bid":0,"bestBid":"7","best_ask":0}]}]}',
    ]
    out = {(r.seq, r.pos): r for r in spot_parser.parse_spot_frames(frames(spark, vals, "coinbase")).collect()}
    hb = [r for r in out.values() if r.kind == "heartbeat"]
    assert sorted(r.product_id for r in hb) == ["BTC-USD", "ETH-USD"]           # fan-out
    assert all(r.event_us == 1773230400123456 for r in hb)                        # 6-digit cut
    q = out[(2, 0)]
    assert (q.kind, q.market_key, q.bid, q.ask, q.last_trade_px) == ("quote", "cb-btcusd", 100.1, 100.2, 100.15)
    t = out[(3, 0)]
    assert (t.kind, t.market_key, t.price, t.size, t.side) == ("trade", "cb-ethusd", 2000.2, 0.01, "BUY")
    assert t.event_us == 1773230400500000
    assert not any(s in (4, 5, 6) for s, _ in out)                                 # junk yields nothing
    z = out[(7, 0)]
    assert z.bid == 7.0 and z.ask is None                                          # number 0 is falsy


def test_level2_fold_matches_sequential(spark):
    vals = [
        '{"channel":"level2","timestamp":"2026-03-11T12:00:00Z","events":[{"product_id":"BTC-USD","bids":[["100.1","2"]],"asks":[{"price":"100.3","size":"1"}]}]}',
        '{"channel":"level2","timestamp":"2026-03-11T12:00:01Z","events":[{"product_id":"BTC-USD","updates":[{"side":"bid","price_level":"100.2","new_quantity":"1"},{"side":"offer","price_level":"100.3","new_quantity":"0"}]}]}',
        '{"channel":"level2","timestamp":"2026-03-11T12:00:02Z","events":[{"product_id":"BTC-USD","updates":[{"side":"bid","price_level":"100.2","new_quantity":"0"},{"side":"bid","price_level":"100.1","new_quantity":"0"}]}]}',
        '{"channel":"level2","timestamp":"2026-03-11T12:00:03Z","events":[{"product_id":"BTC-USD","bids":[],"updates":[{"side":"sell","price_level":"101","new_quantity":"3"}]}]}',
    ]
    got = {r.seq: (r.bid, r.ask) for r in book.best_per_message(frames(spark, vals, "coinbase"), chunk_events=2).collect()}
    assert got == {1: (100.1, 100.3), 2: (100.2, None), 4: (None, 101.0)}        # message 3 empties the book


def test_prediction_shapes(spark):
    bindings = spark.createDataFrame(
        [("A", "btc", "pm-btc", "yes", "btc-updown-5m-1", 1, "c"), ("B", "btc", "pm-btc", "no", "btc-updown-5m-1", 1, "c")],
        "asset_id string, symbol string, market_key string, side string, slug string, bucket_start_ts bigint, condition_id string")
    vals = [
        '{"event_type":"price_change","price_changes":[{"asset_id":"A","best_bid":"0.51","best_ask":"0.52","price":"0.515","timestamp":"1773230400"}]}',
        '{"event_type":"best_bid_ask","asset_id":"A","best_bid":"0.51","best_ask":"0.52","timestamp":0}',
        '{"event_type":"last_trade_price","asset_id":"B","price":"0.49","size":"10","side":"sell","timestamp":"1773230401"}',
        '[{"event_type":"book","asset_id":"A","bids":[{"price":"0.5"},{"price":"0.51"}],"asks":[{"price":"0.53"}],"timestamp":"1773230402"}]',
        '{"event_type":"pong"}', '{"type":"status","asset_id":"A"}', '{"event_type":"best_bid_ask","asset_id":"Z","best_bid":"1"}',
    ]
    ev = prediction_parser.parse_prediction_frames(frames(spark, vals, "polymarket"), bindings)
    out = {r.seq: r for r in ev.collect()}
    assert set(out) == {1, 2, 3, 4}
    assert (out[1].kind, out[1].bid, out[1].side, out[1].event_us) == ("book_update", 0.51, "yes", 1773230400000000)
    assert out[2].kind == "quote" and out[2].event_us == 1773230400000001            # 0 -> arrival time
    assert (out[3].kind, out[3].price, out[3].trade_side, out[3].side) == ("trade", 0.49, "SELL", "no")
    assert (out[4].bid, out[4].ask) == (0.51, 0.53)
