import pytest

from marketfold.operators import canonical as canon
from marketfold.operators import snapshots as snap
from marketfold.plans import sql_parts as P
from marketfold.sources.tables import read_table
from tests.conftest import SF001
from tests.oracle_compare import compare


@pytest.mark.parametrize("interval", [97, 300, 3600])
def test_dense_snapshots_match_sql(spark, con001, interval):
    ev = read_table(spark, SF001, "events")
    df = snap.snapshots_dense(canon.events_to_canonical(ev), canon.markets_frame(spark), interval,
                              drops=canon.events_to_drop_notices(ev))
    ok, msg = compare(df, con001, P.snapshots_sql(interval))
    assert ok, msg


def _sequential_fold(rows, markets, interval, lo, hi):
    """Tiny sequential model of the collector's aggregator (test oracle)."""
    state = {m: {"last": None, "bid": None, "ask": None, "side": ""} for m, _ in markets}
    out = {}
    rows = sorted(rows, key=lambda r: r["seq"])
    idx = 0
    for t in range(lo, hi + 1, interval):
        counts = {m: 0 for m, _ in markets}
        while idx < len(rows) and rows[idx]["recv_s"] < t:
            r = rows[idx]
            idx += 1
            s = state[r["market_key"]]
            counts[r["market_key"]] += 1
            s["last"] = r["event_us"]
            if r["bid"] is not None:
                s["bid"] = r["bid"]
            if r["ask"] is not None:
                s["ask"] = r["ask"]
            if r["kind"] == "trade":
                s["side"] = (r["side"] or "").strip().upper()
        for m, v in markets:
            s = state[m]
            out[(m, t)] = (counts[m], s["last"], s["bid"] if v == "coinbase" else None,
                           s["ask"] if v == "coinbase" else None, (s["side"] or None) if v == "coinbase" else None)
    return out


def test_dense_snapshots_match_sequential_fold(spark):
    ev = read_table(spark, SF001, "events")
    c = canon.events_to_canonical(ev)
    markets = [("cb-btcusd", "coinbase"), ("cb-ethusd", "coinbase"), ("pm-btc", "polymarket"), ("pm-eth", "polymarket")]
    interval = 1800
    lo, hi = snap.run_window(c, interval)
    expected = _sequential_fold([r.asDict() for r in c.collect()], markets, interval, lo, hi)
    got = snap.snapshots_dense(c, canon.markets_frame(spark), interval).collect()
    assert len(got) == len(expected)
    for r in got:
        e = expected[(r.market_key, r.snapshot_ts)]
        last_iso = None
        assert r.msg_count_1s == e[0]
        assert (r.last_event_ts_utc is None) == (e[1] is None)
        assert r.best_bid == e[2] and r.best_ask == e[3] and r.last_trade_side == e[4]


def test_every_market_every_boundary(spark):
    ev = read_table(spark, SF001, "events")
    c = canon.events_to_canonical(ev).filter("market_key = 'cb-btcusd'")
    df = snap.snapshots_dense(c, canon.markets_frame(spark), 3600)
    per_market = {r[0]: r[1] for r in df.groupBy("market_key").count().collect()}
    assert len(per_market) == 4 and len(set(per_market.values())) == 1
    idle = df.filter("market_key = 'pm-eth'").agg({"msg_count_1s": "max"}).first()[0]
    assert idle == 0
