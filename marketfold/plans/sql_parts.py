"""SQL building blocks for the DuckDB oracle.

Written independently of the DataFrame code: the same definitions stated
again in plain SQL over the given tables, so a mismatch points at a bug
on one side.  Only fragments shared by several oracles live here.
"""

from __future__ import annotations

MARKETS_SQL = """markets AS (
  SELECT * FROM (VALUES ('cb-btcusd', 'coinbase', 'BTC-USD'), ('cb-ethusd', 'coinbase', 'ETH-USD'),
                        ('pm-btc', 'polymarket', 'btc'), ('pm-eth', 'polymarket', 'eth'))
         AS t(market_key, venue, instrument)
)"""

CANON_SQL = """ev0 AS (
  SELECT event_id, ts, event_type, value,
         CASE user_id % 4 WHEN 0 THEN 'cb-btcusd' WHEN 1 THEN 'cb-ethusd' WHEN 2 THEN 'pm-btc' ELSE 'pm-eth' END AS mk,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS es,
         epoch_us(ts) AS us
  FROM events
),
ev1 AS (
  SELECT *, es - es % 300 AS bucket,
         CASE WHEN event_id % 2 = 0 THEN 'yes' ELSE 'no' END AS pside,
         starts_with(mk, 'cb-') AS is_spot
  FROM ev0
),
canon AS (
  SELECT event_id AS seq, es AS recv_s,
         CASE WHEN is_spot THEN 'coinbase' ELSE 'polymarket' END AS venue,
         mk AS market_key,
         CASE event_type WHEN 'purchase' THEN 'trade' WHEN 'click' THEN 'book_update' WHEN 'view' THEN 'quote'
                         WHEN 'signup' THEN 'heartbeat' WHEN 'error' THEN 'status' END AS kind,
         us AS event_us,
         CASE mk WHEN 'cb-btcusd' THEN 'BTC-USD' WHEN 'cb-ethusd' THEN 'ETH-USD' END AS product_id,
         CASE WHEN event_type IN ('click', 'view') AND event_id % 10 <> 0 THEN value - 0.5 END AS bid,
         CASE WHEN event_type IN ('click', 'view') AND event_id % 10 <> 1 THEN value + 0.5 END AS ask,
         CASE WHEN event_type = 'view' AND k % 3 = 0 THEN value * 2.0 END AS last_trade_px,
         CASE WHEN event_type = 'purchase' THEN value END AS price,
         CASE WHEN event_type = 'purchase' AND k % 7 <> 0 THEN k / 10.0 END AS size,
         CASE WHEN is_spot THEN (CASE WHEN k % 5 = 0 THEN '' WHEN k % 2 = 0 THEN 'buy' ELSE 'SELL' END)
              ELSE pside END AS side,
         CASE WHEN NOT is_spot AND event_type = 'purchase' THEN (CASE WHEN k % 2 = 0 THEN 'BUY' ELSE 'SELL' END) END AS trade_side,
         CASE WHEN NOT is_spot THEN mk || '-' || pside || '-' || CAST(bucket AS VARCHAR) END AS asset_id,
         CASE WHEN NOT is_spot THEN (CASE WHEN mk = 'pm-btc' THEN 'btc-updown-5m' ELSE 'eth-updown-5m' END) || '-' || CAST(bucket AS VARCHAR) END AS slug,
         CASE WHEN NOT is_spot THEN bucket END AS bucket_start_ts,
         CASE WHEN NOT is_spot THEN '0x' || sha256((CASE WHEN mk = 'pm-btc' THEN 'btc-updown-5m' ELSE 'eth-updown-5m' END) || '-' || CAST(bucket AS VARCHAR)) END AS condition_id
  FROM ev1
)"""

DROPS_SQL = """drops AS (
  SELECT CASE user_id % 4 WHEN 0 THEN 'cb-btcusd' WHEN 1 THEN 'cb-ethusd' WHEN 2 THEN 'pm-btc' ELSE 'pm-eth' END AS market_key,
         CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS recv_s,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 - 1 AS BIGINT) AS n
  FROM events WHERE event_type = 'error'
)"""


def iso_from_micros(expr: str) -> str:
    """Python-isoformat text of a UTC instant given as epoch microseconds."""
    return (f"CASE WHEN ({expr}) IS NOT NULL THEN strftime(make_timestamp({expr}), '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN ({expr}) % 1000000 <> 0 THEN '.' || lpad(CAST(({expr}) % 1000000 AS VARCHAR), 6, '0') ELSE '' END "
            f"|| '+00:00' END")


def snapshots_sql(interval_s: int) -> str:
    """Dense snapshots, straightforward form: global grid, one carry window."""
    i = int(interval_s)
    return f"""WITH {MARKETS_SQL},
{CANON_SQL},
{DROPS_SQL},
ev AS (
  SELECT c.*, m.venue AS m_venue, c.recv_s - c.recv_s % {i} + {i} AS snap_ts,
         lower(trim(coalesce(c.kind, ''))) AS k2, lower(trim(coalesce(c.side, ''))) AS ps
  FROM canon c JOIN markets m USING (market_key)
),
dr AS (
  SELECT d.market_key, d.recv_s - d.recv_s % {i} + {i} AS snap_ts, d.n
  FROM drops d JOIN markets m USING (market_key)
),
bounds AS (
  SELECT min(snap_ts) AS lo, max(snap_ts) AS hi FROM (SELECT snap_ts FROM ev UNION ALL SELECT snap_ts FROM dr)
),
grid AS (
  SELECT m.market_key, m.venue AS m_venue, g.snap_ts
  FROM markets m CROSS JOIN (SELECT unnest(generate_series(lo, hi, {i})) AS snap_ts FROM bounds) g
),
agg AS (
  SELECT market_key, snap_ts,
    count(*) FILTER (WHERE k2 <> 'meta') AS msg,
    count(*) FILTER (WHERE k2 = 'trade') AS trades,
    count(*) FILTER (WHERE k2 IN ('book_update', 'book_snapshot', 'quote')) AS books,
    max_by(bid, seq) FILTER (WHERE m_venue = 'coinbase' AND bid IS NOT NULL) AS best_bid,
    max_by(ask, seq) FILTER (WHERE m_venue = 'coinbase' AND ask IS NOT NULL) AS best_ask,
    max_by(CASE WHEN k2 = 'trade' THEN price ELSE last_trade_px END, seq)
      FILTER (WHERE m_venue = 'coinbase' AND (CASE WHEN k2 = 'trade' THEN price ELSE last_trade_px END) IS NOT NULL) AS last_trade_px,
    max_by(size, seq) FILTER (WHERE m_venue = 'coinbase' AND k2 = 'trade' AND size IS NOT NULL) AS last_trade_size,
    max_by(upper(trim(coalesce(side, ''))), seq) FILTER (WHERE m_venue = 'coinbase' AND k2 = 'trade') AS last_trade_side,
    max_by(bid, seq) FILTER (WHERE m_venue = 'polymarket' AND ps = 'yes' AND bid IS NOT NULL) AS yes_best_bid,
    max_by(ask, seq) FILTER (WHERE m_venue = 'polymarket' AND ps = 'yes' AND ask IS NOT NULL) AS yes_best_ask,
    max_by(bid, seq) FILTER (WHERE m_venue = 'polymarket' AND ps = 'no' AND bid IS NOT NULL) AS no_best_bid,
    max_by(ask, seq) FILTER (WHERE m_venue = 'polymarket' AND ps = 'no' AND ask IS NOT NULL) AS no_best_ask,
    max_by(price, seq) FILTER (WHERE m_venue = 'polymarket' AND ps = 'yes' AND k2 = 'trade' AND price IS NOT NULL) AS last_trade_px_yes,
    max_by(price, seq) FILTER (WHERE m_venue = 'polymarket' AND ps = 'no' AND k2 = 'trade' AND price IS NOT NULL) AS last_trade_px_no,
    max_by(slug, seq) FILTER (WHERE m_venue = 'polymarket' AND coalesce(slug, '') <> '') AS slug,
    max_by(bucket_start_ts, seq) FILTER (WHERE m_venue = 'polymarket' AND bucket_start_ts IS NOT NULL) AS bucket_start_ts,
    max_by(condition_id, seq) FILTER (WHERE m_venue = 'polymarket' AND coalesce(condition_id, '') <> '') AS condition_id,
    max_by(coalesce(event_us, recv_s * 1000000), seq) FILTER (WHERE k2 <> 'meta') AS last_event_us
  FROM ev GROUP BY market_key, snap_ts
),
dagg AS (SELECT market_key, snap_ts, sum(n) AS dropped FROM dr GROUP BY market_key, snap_ts),
dense AS (
  SELECT g.market_key, g.m_venue, g.snap_ts,
         coalesce(a.msg, 0) AS msg, coalesce(a.trades, 0) AS trades, coalesce(a.books, 0) AS books,
         greatest(0, coalesce(d.dropped, 0)) AS dropped,
         a.best_bid, a.best_ask, a.last_trade_px, a.last_trade_size, a.last_trade_side,
         a.yes_best_bid, a.yes_best_ask, a.no_best_bid, a.no_best_ask, a.last_trade_px_yes, a.last_trade_px_no,
         a.slug, a.bucket_start_ts, a.condition_id, a.last_event_us
  FROM grid g LEFT JOIN agg a USING (market_key, snap_ts) LEFT JOIN dagg d USING (market_key, snap_ts)
),
carried AS (
  SELECT market_key, m_venue, snap_ts, msg, trades, books, dropped,
{",".join(f'''
    last_value({c} IGNORE NULLS) OVER w AS {c}''' for c in ("best_bid", "best_ask", "last_trade_px", "last_trade_size", "last_trade_side", "yes_best_bid", "yes_best_ask", "no_best_bid", "no_best_ask", "last_trade_px_yes", "last_trade_px_no", "slug", "bucket_start_ts", "condition_id", "last_event_us"))}
  FROM dense
  WINDOW w AS (PARTITION BY market_key ORDER BY snap_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT
  strftime(make_timestamp(snap_ts * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS ts_utc,
  CAST(snap_ts AS BIGINT) AS snapshot_ts,
  market_key, m_venue AS venue, CAST({i} AS INTEGER) AS snapshot_interval_s,
  CAST(msg AS BIGINT) AS msg_count_1s, CAST(trades AS BIGINT) AS trade_count_1s,
  CAST(books AS BIGINT) AS book_update_count_1s, CAST(dropped AS BIGINT) AS dropped_events_1s,
  {iso_from_micros('last_event_us')} AS last_event_ts_utc,
  CASE WHEN last_event_us IS NOT NULL THEN greatest(0.0, (snap_ts - last_event_us / 1000000.0) * 1000.0) END AS stale_ms,
  CASE WHEN m_venue = 'coinbase' THEN best_bid END AS best_bid,
  CASE WHEN m_venue = 'coinbase' THEN best_ask END AS best_ask,
  CASE WHEN m_venue = 'coinbase' THEN (best_bid + best_ask) / 2.0 END AS mid,
  CASE WHEN m_venue = 'coinbase' AND (best_bid + best_ask) / 2.0 > 0 THEN (best_ask - best_bid) / ((best_bid + best_ask) / 2.0) * 10000.0 END AS spread_bps,
  CASE WHEN m_venue = 'coinbase' THEN last_trade_px END AS last_trade_px,
  CASE WHEN m_venue = 'coinbase' THEN last_trade_size END AS last_trade_size,
  CASE WHEN m_venue = 'coinbase' AND last_trade_side <> '' THEN last_trade_side END AS last_trade_side,
  CASE WHEN m_venue = 'polymarket' AND slug <> '' THEN slug END AS slug,
  CASE WHEN m_venue = 'polymarket' THEN CAST(bucket_start_ts AS BIGINT) END AS bucket_start_ts,
  CASE WHEN m_venue = 'polymarket' AND condition_id <> '' THEN condition_id END AS condition_id,
  CASE WHEN m_venue = 'polymarket' THEN yes_best_bid END AS yes_best_bid,
  CASE WHEN m_venue = 'polymarket' THEN yes_best_ask END AS yes_best_ask,
  CASE WHEN m_venue = 'polymarket' THEN (yes_best_bid + yes_best_ask) / 2.0 END AS yes_mid,
  CASE WHEN m_venue = 'polymarket' THEN no_best_bid END AS no_best_bid,
  CASE WHEN m_venue = 'polymarket' THEN no_best_ask END AS no_best_ask,
  CASE WHEN m_venue = 'polymarket' THEN (no_best_bid + no_best_ask) / 2.0 END AS no_mid,
  CASE WHEN m_venue = 'polymarket' THEN last_trade_px_yes END AS last_trade_px_yes,
  CASE WHEN m_venue = 'polymarket' THEN last_trade_px_no END AS last_trade_px_no
FROM carried"""


SPOT_EV_SQL = """sp AS (
  SELECT c.*, e.event_type, e.value, TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k
  FROM canon c JOIN events e ON e.event_id = c.seq
  WHERE c.venue = 'coinbase'
)"""


def spot_parse_sql(which: str) -> str:
    head = f"WITH {CANON_SQL},\n{SPOT_EV_SQL}\n"
    if which == "trades":
        return head + """SELECT seq, CAST(0 AS BIGINT) AS pos, market_key, 'trade' AS kind, event_us, product_id,
       price, size, upper(trim(side)) AS side
FROM sp WHERE event_type = 'purchase' AND seq % 17 <> 0"""
    if which == "ticker":
        return head + """SELECT seq, CAST(0 AS BIGINT) AS pos, market_key, 'quote' AS kind, event_us, product_id,
       CASE WHEN seq % 5 <> 0 AND bid = 0 THEN NULL ELSE bid END AS bid,
       CASE WHEN seq % 5 <> 0 AND ask = 0 THEN NULL ELSE ask END AS ask,
       last_trade_px
FROM sp WHERE event_type = 'view'"""
    if which == "heartbeat":
        return head + """SELECT seq, CAST(0 AS BIGINT) AS pos, market_key, 'heartbeat' AS kind, event_us, product_id
FROM sp WHERE event_type = 'signup' AND seq % 2 = 0
UNION ALL
SELECT seq, CAST(p.j AS BIGINT) AS pos, p.mk AS market_key, 'heartbeat' AS kind, event_us, p.pid AS product_id
FROM sp, (VALUES (0, 'BTC-USD', 'cb-btcusd'), (1, 'ETH-USD', 'cb-ethusd')) AS p(j, pid, mk)
WHERE event_type = 'signup' AND seq % 2 = 1"""
    raise ValueError(which)


PRED_EV_SQL = """pe AS (
  SELECT c.*, e.event_type, e.value, TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
         CAST(round(CAST(CAST(c.event_us // 1000000 AS VARCHAR) || '.' || lpad(CAST(c.event_us % 1000000 AS VARCHAR), 6, '0') AS DOUBLE) * 1000000.0) AS BIGINT) AS feed_us
  FROM canon c JOIN events e ON e.event_id = c.seq
  WHERE c.venue = 'polymarket' AND c.seq % 19 <> 0
)"""


def pred_parse_sql(which: str) -> str:
    head = f"WITH {CANON_SQL},\n{PRED_EV_SQL}\n"
    ident = "seq, CAST(0 AS BIGINT) AS pos, market_key, side, asset_id, slug, bucket_start_ts, condition_id, feed_us AS event_us"
    if which == "price_change":
        return head + f"""SELECT {ident}, 'book_update' AS kind, bid, ask, value AS price
FROM pe WHERE event_type = 'click'"""
    if which == "book":
        return head + f"""SELECT {ident}, 'book_update' AS kind,
       CASE WHEN seq % 7 = 0 AND seq % 3 <> 0 THEN NULL ELSE value - 0.5 END AS bid, value + 0.5 AS ask
FROM pe WHERE event_type = 'signup'"""
    if which == "trades":
        return head + f"""SELECT {ident}, 'trade' AS kind, price, CAST(k AS DOUBLE) AS size,
       CASE WHEN k % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS trade_side
FROM pe WHERE event_type = 'purchase'"""
    if which == "quotes":
        return head + f"""SELECT {ident}, 'quote' AS kind, bid, ask FROM pe WHERE event_type = 'view'"""
    if which == "enrich":
        return head + f"""SELECT {ident},
       CASE event_type WHEN 'purchase' THEN 'trade' WHEN 'view' THEN 'quote' ELSE 'book_update' END AS kind
FROM pe WHERE event_type IN ('click', 'view', 'purchase', 'signup')"""
    raise ValueError(which)


RESOLVED_SQL = """pev AS (SELECT * FROM canon WHERE venue = 'polymarket'),
rng AS (SELECT min(recv_s) - min(recv_s) % 300 AS lo, max(recv_s) - max(recv_s) % 300 AS hi FROM pev),
pts AS (
  SELECT s.symbol, s.mk AS market_key, CAST(g.b AS BIGINT) AS bucket_start_ts,
         s.prefix || '-' || CAST(g.b AS VARCHAR) AS slug
  FROM (VALUES ('btc', 'pm-btc', 'btc-updown-5m'), ('eth', 'pm-eth', 'eth-updown-5m')) AS s(symbol, mk, prefix)
  CROSS JOIN (SELECT unnest(generate_series(lo, hi, 300)) AS b FROM rng) g
),
seen AS (SELECT DISTINCT market_key, bucket_start_ts, condition_id FROM pev),
res0 AS (
  SELECT p.*, s.condition_id AS cond, s.market_key IS NOT NULL AS found,
         CAST((p.bucket_start_ts // 300) % 6 AS INTEGER) AS r,
         p.market_key || '-yes-' || CAST(p.bucket_start_ts AS VARCHAR) AS ytok,
         p.market_key || '-no-' || CAST(p.bucket_start_ts AS VARCHAR) AS ntok
  FROM pts p LEFT JOIN seen s ON s.market_key = p.market_key AND s.bucket_start_ts = p.bucket_start_ts
),
resolved AS (
  SELECT symbol, market_key, bucket_start_ts, slug,
         CASE WHEN found AND r <> 4 THEN cond END AS condition_id,
         CASE WHEN NOT found OR r = 4 THEN NULL WHEN r = 5 THEN ntok ELSE ytok END AS yes_asset_id,
         CASE WHEN NOT found OR r = 4 THEN NULL ELSE ntok END AS no_asset_id,
         CASE WHEN NOT found THEN 'gamma_market_not_found:' || slug
              WHEN r = 4 THEN 'gamma_missing_token_ids:' || symbol || ':' || slug END AS error
  FROM res0
)"""


def refdata_sql(which: str) -> str:
    head = f"WITH {CANON_SQL},\n{RESOLVED_SQL}"
    if which == "resolve":
        return head + "\nSELECT * FROM resolved"
    if which == "pick":
        return head + "\nSELECT slug, yes_asset_id, no_asset_id FROM resolved WHERE error IS NULL"
    if which == "unpivot":
        return head + """
SELECT yes_asset_id AS asset_id, symbol, market_key, 'yes' AS side, slug, bucket_start_ts, condition_id FROM resolved WHERE error IS NULL
UNION ALL
SELECT no_asset_id AS asset_id, symbol, market_key, 'no' AS side, slug, bucket_start_ts, condition_id FROM resolved WHERE error IS NULL"""
    eff = head + """,
eff0 AS (
  SELECT market_key, bucket_start_ts AS refresh_ts,
    last_value(CASE WHEN error IS NULL THEN bucket_start_ts END IGNORE NULLS) OVER w AS meta_bucket,
    last_value(CASE WHEN error IS NULL THEN slug END IGNORE NULLS) OVER w AS meta_slug,
    last_value(CASE WHEN error IS NULL THEN condition_id END IGNORE NULLS) OVER w AS condition_id,
    last_value(CASE WHEN error IS NULL THEN yes_asset_id END IGNORE NULLS) OVER w AS yes_asset_id,
    last_value(CASE WHEN error IS NULL THEN no_asset_id END IGNORE NULLS) OVER w AS no_asset_id
  FROM resolved
  WINDOW w AS (PARTITION BY market_key ORDER BY bucket_start_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
eff AS (
  SELECT *, CASE WHEN meta_bucket IS NULL THEN NULL ELSE
    concat_ws('|', CAST(meta_bucket AS VARCHAR), meta_slug, condition_id, yes_asset_id, no_asset_id) END AS k
  FROM eff0
)"""
    if which == "upsert":
        return eff + """
, ch AS (
  SELECT *, coalesce(k IS NOT NULL AND k IS DISTINCT FROM lag(k) OVER (PARTITION BY market_key ORDER BY refresh_ts), false) AS meta_changed FROM eff),
sets AS (
  SELECT refresh_ts, list_sort(list(coalesce(market_key || '=' || k, ''))) AS bound FROM eff GROUP BY refresh_ts),
moved AS (SELECT refresh_ts, bound IS DISTINCT FROM coalesce(lag(bound) OVER (ORDER BY refresh_ts), [repeat('', n) FOR n IN [0, 0]]) AS bindings_changed FROM sets)
SELECT market_key, refresh_ts, meta_bucket, meta_slug, condition_id, yes_asset_id, no_asset_id, meta_changed, bindings_changed
FROM ch JOIN moved USING (refresh_ts)"""
    if which == "in_effect":
        return eff + """,
b AS (SELECT refresh_ts, market_key, 'yes' AS side, 0 AS o, yes_asset_id AS asset_id FROM eff WHERE yes_asset_id IS NOT NULL
      UNION ALL SELECT refresh_ts, market_key, 'no', 1, no_asset_id FROM eff WHERE yes_asset_id IS NOT NULL)
SELECT refresh_ts, asset_id, market_key, side FROM b
QUALIFY row_number() OVER (PARTITION BY refresh_ts, asset_id ORDER BY market_key DESC, o DESC) = 1"""
    if which == "asof":
        # Tokens are shared: seven per side, moving on with every bucket, so a token changes hands between markets.
        token = "'tok-' || split_part({0}, '-', 3) || '-' || CAST((CAST(split_part({0}, '-', 4) AS BIGINT) // 300 + CASE WHEN {0} LIKE 'pm-eth-%' THEN 3 ELSE 0 END) % 7 AS VARCHAR)"
        return eff + f""",
{PRED_EV_SQL},
b AS (SELECT refresh_ts, market_key, 0 AS o, {token.format('yes_asset_id')} AS asset_id, meta_slug, meta_bucket, condition_id FROM eff WHERE yes_asset_id IS NOT NULL
      UNION ALL SELECT refresh_ts, market_key, 1, {token.format('no_asset_id')}, meta_slug, meta_bucket, condition_id FROM eff WHERE yes_asset_id IS NOT NULL),
best AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY refresh_ts, asset_id ORDER BY market_key DESC, o DESC) = 1),
times AS (SELECT refresh_ts, lead(refresh_ts) OVER (ORDER BY refresh_ts) AS following FROM (SELECT DISTINCT refresh_ts FROM eff)),
marks AS (SELECT *, true AS bound FROM best
          UNION ALL SELECT t.following, NULL, NULL, best.asset_id, NULL, NULL, NULL, false FROM best JOIN times t USING (refresh_ts)
          WHERE t.following IS NOT NULL AND NOT EXISTS (SELECT 1 FROM best n WHERE n.refresh_ts = t.following AND n.asset_id = best.asset_id)),
msg AS (SELECT seq, recv_s, {token.format('asset_id')} AS asset_id,
               CASE event_type WHEN 'purchase' THEN 'trade' WHEN 'view' THEN 'quote' ELSE 'book_update' END AS kind
        FROM pe WHERE event_type IN ('click', 'view', 'purchase', 'signup'))
SELECT seq, CAST(0 AS BIGINT) AS pos, kind, msg.asset_id, marks.market_key, CASE WHEN o = 1 THEN 'no' ELSE 'yes' END AS side,
       meta_slug AS slug, meta_bucket AS bucket_start_ts, condition_id, refresh_ts AS since
FROM msg ASOF JOIN marks ON msg.asset_id = marks.asset_id AND msg.recv_s >= marks.refresh_ts WHERE bound"""
    if which == "delta":
        return eff + """,
des AS (SELECT DISTINCT refresh_ts, a AS asset_id FROM eff, unnest([yes_asset_id, no_asset_id]) t(a) WHERE yes_asset_id IS NOT NULL),
times AS (SELECT refresh_ts, lead(refresh_ts) OVER (ORDER BY refresh_ts) AS following FROM (SELECT DISTINCT refresh_ts FROM eff)),
prv AS (SELECT following AS refresh_ts, asset_id FROM des JOIN times USING (refresh_ts) WHERE following IS NOT NULL)
SELECT refresh_ts, asset_id, 'subscribe' AS op FROM (SELECT * FROM des EXCEPT SELECT * FROM prv)
UNION ALL
SELECT refresh_ts, asset_id, 'unsubscribe' AS op FROM (SELECT * FROM prv EXCEPT SELECT * FROM des)"""
    raise ValueError(which)


def _snap_cte(interval_s: int = 300) -> str:
    return f"snap AS (\n{snapshots_sql(interval_s)}\n)"


def batch_sql(which: str) -> str:
    head = "WITH " + _snap_cte() + """,
n AS (SELECT *, row_number() OVER (PARTITION BY venue, market_key ORDER BY snapshot_ts) AS rn FROM snap),
b AS (SELECT *, (rn - 1) // 250 AS batch_no FROM n),
f AS (SELECT *, first_value(ts_utc) OVER (PARTITION BY venue, market_key, batch_no ORDER BY rn) AS batch_first_ts FROM b),
g AS (SELECT *, sha256(venue || '|' || market_key || '|' || batch_first_ts || '|' || CAST(batch_no AS VARCHAR)) AS batch_id,
             substr(batch_first_ts, 1, 10) AS snapshot_date FROM f)
"""
    if which == "chunks":
        return head + """SELECT batch_id, venue AS source, market_key AS market, snapshot_date, CAST(batch_no AS BIGINT) AS batch_no,
       CAST(count(*) AS BIGINT) AS row_count, min(ts_utc) AS first_ts, max(ts_utc) AS last_ts
FROM g GROUP BY batch_id, venue, market_key, snapshot_date, batch_no"""
    if which == "silver":
        return head + """SELECT batch_id, snapshot_date, venue AS source, market_key AS market,
  CAST((snapshot_ts % 86400) // 3600 AS INTEGER) AS snapshot_hour,
  CAST(snapshot_ts * 1000000 AS BIGINT) AS ts_utc_us,
  epoch_us(CAST(last_event_ts_utc AS TIMESTAMPTZ)) AS last_event_ts_utc_us,
  CAST(bucket_start_ts * 1000000 AS BIGINT) AS bucket_start_ts_utc_us,
  snapshot_interval_s, msg_count_1s, trade_count_1s, book_update_count_1s, dropped_events_1s,
  stale_ms, best_bid, best_ask, mid, spread_bps, last_trade_px, last_trade_size, last_trade_side, slug, condition_id,
  yes_best_bid, yes_best_ask, yes_mid, no_best_bid, no_best_ask, no_mid, last_trade_px_yes, last_trade_px_no
FROM g"""
    if which == "paths":
        return head + """, p AS (
  SELECT DISTINCT batch_id, snapshot_date, venue AS source, market_key AS market,
         lpad(CAST(CAST(substr(batch_first_ts, 12, 2) AS INTEGER) AS VARCHAR), 2, '0') AS hh FROM g)
SELECT batch_id,
  'raw/ndjson-zstd/date=' || snapshot_date || '/source=' || source || '/market=' || market || '/' || batch_id || '.ndjson.zst' AS bronze_path,
  'silver/parquet/date=' || snapshot_date || '/source=' || source || '/market=' || market || '/hour=' || hh || '/' || batch_id || '.parquet' AS silver_path,
  snapshot_date || '/' || source || '/' || market || '/' || hh || '/' || batch_id || '.parquet' AS target_relpath,
  'relay/payloads/' || snapshot_date || '/' || source || '/' || market || '/' || hh || '/' || batch_id || '.parquet' AS staged_path,
  'relay/manifests/' || batch_id || '.json' AS manifest_path
FROM p"""
    if which == "defaults":
        return head + """, e AS (
  SELECT batch_id, venue, market_key, snapshot_date, batch_no, first(ts_utc ORDER BY rn) AS fts, count(*) AS n FROM g GROUP BY ALL)
SELECT CASE WHEN batch_no % 7 <> 3 THEN batch_id ELSE '' END AS batch_id,
  CASE WHEN batch_no % 2 = 0 OR batch_no % 11 <> 4 THEN venue ELSE 'unknown' END AS source,
  CASE WHEN batch_no % 3 = 0 OR batch_no % 11 <> 4 THEN market_key ELSE 'unknown' END AS market,
  CASE WHEN batch_no % 5 = 0 THEN snapshot_date WHEN batch_no % 11 <> 4 THEN substr(fts, 1, 10)
       ELSE strftime(now() AT TIME ZONE 'UTC', '%Y-%m-%d') END AS snapshot_date,
  CASE WHEN batch_no % 11 = 4 THEN 0 ELSE n END AS row_count,
  CASE WHEN batch_no % 11 = 4 THEN 'skipped' WHEN batch_no % 7 = 3 THEN 'error' ELSE 'accepted' END AS status,
  CASE WHEN batch_no % 11 <> 4 AND batch_no % 7 = 3 THEN 'batch_id_required' END AS error
FROM e"""
    if which == "audit":
        return head + """, p AS (
  SELECT batch_id, snapshot_date, venue AS source, market_key AS market, substr(batch_first_ts, 12, 2) AS hour, count(*) AS n
  FROM g GROUP BY ALL)
SELECT snapshot_date, source, market, hour, 'ok' AS status, CAST(count(*) AS BIGINT) AS batches, CAST(sum(n) AS BIGINT) AS row_count
FROM p GROUP BY ALL"""
    if which == "hops":
        return head + """, p AS (SELECT batch_id, snapshot_date, venue AS source, market_key AS market, bool_or(batch_no % 7 = 3 AND rn % 250 = 9) AS bad, count(*) AS n FROM g GROUP BY ALL)
SELECT snapshot_date, source, market, CASE WHEN bad THEN 'silver_row_missing_ts_utc' ELSE 'ok' END AS status, count(*) AS batches, CAST(sum(n) AS BIGINT) AS row_count,
       CAST(sum(CASE WHEN bad THEN 2 ELSE 4 END) AS BIGINT) AS claims
FROM p GROUP BY ALL"""
    if which == "validate":
        return "WITH " + _snap_cte() + """,
n AS (SELECT *, row_number() OVER (PARTITION BY venue ORDER BY snapshot_ts, market_key) AS rn FROM snap),
b AS (SELECT *, (rn - 1) // 250 AS batch_no FROM n),
f AS (SELECT *, first_value(ts_utc) OVER w AS fts, first_value(market_key) OVER w AS dm
      FROM b WINDOW w AS (PARTITION BY venue, batch_no ORDER BY rn)),
v AS (
  SELECT sha256(venue || '|' || fts || '|' || CAST(batch_no AS VARCHAR)) AS batch_id, venue AS source, dm AS market,
         CAST(count(*) AS BIGINT) AS row_count,
         arg_min(market_key, rn) FILTER (WHERE market_key <> dm) AS bad_market
  FROM f GROUP BY venue, batch_no, fts, dm)
SELECT batch_id, source, market, row_count,
  CASE WHEN bad_market IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
  CASE WHEN bad_market IS NOT NULL THEN 'mixed_snapshot_batch_detected:expected_source=' || source || ',expected_market=' || market
       || ',actual_source=' || source || ',actual_market=' || bad_market END AS error
FROM v"""
    raise ValueError(which)


def snapshot_view_sql(which: str) -> str:
    base = f"WITH {_snap_cte()}\n"
    if which == "cb_quote_spread":
        return base + "SELECT market_key, snapshot_ts, best_bid, best_ask, mid, spread_bps FROM snap WHERE venue = 'coinbase'"
    if which == "cb_last_trade":
        return base + "SELECT market_key, snapshot_ts, last_trade_px, last_trade_size, last_trade_side FROM snap WHERE venue = 'coinbase'"
    if which == "pm_side_pivot":
        return base + """SELECT market_key, snapshot_ts, yes_best_bid, yes_best_ask, yes_mid, no_best_bid, no_best_ask, no_mid,
       last_trade_px_yes, last_trade_px_no, slug, bucket_start_ts, condition_id FROM snap WHERE venue = 'polymarket'"""
    if which == "max_stale":
        return base + "SELECT snapshot_ts, max(coalesce(stale_ms, 0.0)) AS ws_stale_ms FROM snap GROUP BY snapshot_ts"
    raise ValueError(which)


def interval_counts_sql(i: int = 300) -> str:
    return f"""WITH {MARKETS_SQL},
{CANON_SQL}
SELECT c.market_key, c.recv_s - c.recv_s % {i} + {i} AS snapshot_ts,
       CAST(count(*) AS BIGINT) AS msg_count_1s,
       CAST(count(*) FILTER (WHERE c.kind = 'trade') AS BIGINT) AS trade_count_1s,
       CAST(count(*) FILTER (WHERE c.kind IN ('book_update', 'book_snapshot', 'quote')) AS BIGINT) AS book_update_count_1s
FROM canon c JOIN markets m USING (market_key)
GROUP BY 1, 2"""


def dropped_merge_sql(i: int = 300) -> str:
    return f"""WITH {MARKETS_SQL},
{DROPS_SQL},
pdrops AS (
  SELECT CASE user_id % 4 WHEN 0 THEN 'cb-btcusd' WHEN 1 THEN 'cb-ethusd' WHEN 2 THEN 'pm-btc' ELSE 'pm-eth' END AS market_key,
         CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS recv_s,
         CAST((TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) // 10) % 3 - 1 AS BIGINT) AS n
  FROM events WHERE event_type = 'error'
),
u AS (SELECT * FROM drops UNION ALL SELECT * FROM pdrops)
SELECT market_key, recv_s - recv_s % {i} + {i} AS snapshot_ts, CAST(greatest(0, sum(n)) AS BIGINT) AS dropped_events_1s
FROM u WHERE market_key IN (SELECT market_key FROM markets)
GROUP BY 1, 2"""


def _claims_cte() -> str:
    return batch_sql("chunks").replace("SELECT batch_id, venue AS source", ", env AS (SELECT batch_id, venue AS source", 1) + """),
st AS (SELECT * FROM (VALUES ('persist', 1), ('transform', 2), ('export', 3), ('relay', 4)) AS t(stage, off)),
cl0 AS (
  SELECT st.stage, env.batch_id AS id, d.delivery, env.batch_no, env.source, env.market, env.snapshot_date, env.row_count,
         strftime(CAST(substr(env.last_ts, 1, 19) AS TIMESTAMP) + to_seconds(st.off * (1 + env.batch_no % 7) + d.delivery * 60),
                  '%Y-%m-%dT%H:%M:%SZ') AS produced_at
  FROM env CROSS JOIN st
  JOIN (VALUES (0), (1)) AS d(delivery) ON d.delivery = 0 OR env.batch_no % 3 = 0
),
claims AS (
  SELECT *, '{"batch_id":"' || id || '","source":"' || source || '","market":"' || market || '","snapshot_date":"'
            || snapshot_date || '","row_count":' || CAST(row_count AS VARCHAR) || ',"produced_at":"' || produced_at || '"}' AS payload
  FROM cl0
),
fw AS (
  SELECT stage, id, arg_min(produced_at, delivery) AS produced_at, arg_min(payload, delivery) AS payload,
         CAST(count(*) AS BIGINT) AS deliveries, CAST(count(*) - 1 AS BIGINT) AS duplicates
  FROM claims GROUP BY stage, id
)"""


def ledger_sql(which: str) -> str:
    head = _claims_cte()
    if which == "first_wins":
        return head + "\nSELECT * FROM fw"
    if which == "decoded":
        return head + """
SELECT stage, delivery, CASE WHEN w THEN id END AS batch_id, CASE WHEN w THEN '' END AS bronze_blob_path, CASE WHEN stage <> 'relay' THEN source END AS source,
       CASE WHEN stage <> 'relay' THEN market END AS market, CASE WHEN stage <> 'relay' THEN snapshot_date END AS snapshot_date,
       CASE WHEN w THEN '' ELSE sha256(id) END AS content_sha256, CASE WHEN w THEN CAST(json_extract_string(payload, '$.row_count') AS BIGINT) END AS row_count,
       produced_at, CASE WHEN NOT w THEN id END AS export_id, CASE WHEN stage = 'export' THEN 'silver/' || id END AS silver_blob_path,
       CASE WHEN NOT w THEN 'out/' || id END AS target_relpath,
       CASE WHEN NOT w THEN CASE WHEN batch_no % 4 = 3 THEN 0 ELSE 100 * CAST(json_extract_string(payload, '$.row_count') AS BIGINT) END END AS content_length,
       CASE WHEN stage = 'relay' THEN CASE WHEN batch_no % 5 = 2 THEN '' ELSE 'staged/' || id END END AS staged_blob_path
FROM (SELECT *, stage IN ('persist', 'transform') AS w FROM claims)"""
    if which == "new_only":
        return head + """
SELECT stage, id, delivery, produced_at FROM claims c
WHERE NOT EXISTS (SELECT 1 FROM claims x WHERE x.batch_no % 2 = 0 AND x.delivery = 0 AND x.stage = c.stage AND x.id = c.id)"""
    if which == "stage_lag":
        return head + """,
p AS (
  SELECT id, max(CASE WHEN stage = 'persist' THEN epoch(CAST(replace(produced_at, 'Z', '') AS TIMESTAMP)) END) AS a,
             max(CASE WHEN stage = 'transform' THEN epoch(CAST(replace(produced_at, 'Z', '') AS TIMESTAMP)) END) AS b,
             max(CASE WHEN stage = 'export' THEN epoch(CAST(replace(produced_at, 'Z', '') AS TIMESTAMP)) END) AS c,
             max(CASE WHEN stage = 'relay' THEN epoch(CAST(replace(produced_at, 'Z', '') AS TIMESTAMP)) END) AS d
  FROM fw GROUP BY id)
SELECT id AS batch_id, CAST(coalesce(greatest(0, b - a), 0) AS BIGINT) AS transform_lag_s,
       CAST(coalesce(greatest(0, c - b), 0) AS BIGINT) AS export_lag_s, CAST(coalesce(greatest(0, d - c), 0) AS BIGINT) AS relay_lag_s
FROM p"""
    if which == "alert_gap":
        return head + """,
w AS (SELECT epoch_us(CAST(replace(produced_at, 'Z', '') AS TIMESTAMP)) AS ts_us FROM fw WHERE stage = 'persist'),
o AS (SELECT ts_us, lag(ts_us) OVER (ORDER BY ts_us) AS prev_us FROM w)
SELECT prev_us AS last_write_us, ts_us AS next_write_us, (ts_us - prev_us) / 1000000.0 AS gap_s
FROM o WHERE (ts_us - prev_us) / 1000000.0 > 300"""
    raise ValueError(which)


OPS_BASE_SQL = """b AS (
  SELECT event_id AS seq, user_id, event_type, value, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) AS ts_us, ts,
         CASE user_id % 4 WHEN 0 THEN 'cb-btcusd' WHEN 1 THEN 'cb-ethusd' WHEN 2 THEN 'pm-btc' ELSE 'pm-eth' END AS mk,
         CASE user_id % 5 WHEN 0 THEN 'ingest' WHEN 1 THEN 'persist' WHEN 2 THEN 'transform' WHEN 3 THEN 'export' ELSE 'relay' END AS worker
  FROM events
)"""


def ops_sql(which: str) -> str:
    if which in ("metric_rollup", "metric_text"):
        roll = f"""WITH {OPS_BASE_SQL},
s AS (
  SELECT seq,
    CASE event_type WHEN 'purchase' THEN 'ingest_batches_published_total' WHEN 'click' THEN 'persist_batches_total'
         WHEN 'view' THEN 'ws_stale_ms' WHEN 'signup' THEN 'worker_ready' ELSE 'mixed_metric_name' END AS name,
    CASE WHEN event_type IN ('purchase', 'click')
         THEN 'market="' || mk || '",source="' || (CASE WHEN starts_with(mk, 'cb-') THEN 'coinbase' ELSE 'polymarket' END) || '"'
         WHEN event_type IN ('view', 'signup') THEN 'worker="' || worker || '"'
         ELSE 'market_key="' || mk || '"' END AS label_text,
    CASE WHEN event_type IN ('purchase', 'click') THEN 'inc' WHEN event_type IN ('view', 'signup') THEN 'set'
         WHEN k % 2 = 0 THEN 'inc' ELSE 'set' END AS op,
    CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'click' THEN CAST(k AS DOUBLE) WHEN 'view' THEN value
         WHEN 'signup' THEN 1.0 ELSE CAST(k AS DOUBLE) END AS value
  FROM b
),
ls AS (
  SELECT name, label_text, max(seq) FILTER (WHERE op = 'set') AS set_seq, arg_max(value, seq) FILTER (WHERE op = 'set') AS set_value
  FROM s GROUP BY name, label_text
),
ia AS (
  SELECT s.name, s.label_text, sum(s.value) AS inc_after
  FROM s JOIN ls USING (name, label_text)
  WHERE s.op = 'inc' AND (ls.set_seq IS NULL OR s.seq > ls.set_seq)
  GROUP BY 1, 2
),
roll AS (
  SELECT ls.name, ls.label_text, CASE WHEN set_seq IS NOT NULL THEN 'gauge' ELSE 'counter' END AS kind,
         coalesce(set_value, 0.0) + coalesce(inc_after, 0.0) AS value
  FROM ls LEFT JOIN ia USING (name, label_text)
)"""
        if which == "metric_rollup":
            return roll + "\nSELECT * FROM roll"
        return roll + """
SELECT name, label_text, row_number() OVER (ORDER BY name, label_text) AS line_order, '# TYPE ' || name || ' ' || kind AS type_line,
       name || CASE WHEN label_text <> '' THEN '{' || label_text || '}' ELSE '' END || ' ' || CAST(value AS VARCHAR) AS sample_line
FROM roll"""
    if which == "liveness":
        return f"""WITH {OPS_BASE_SQL},
o AS (
  SELECT worker, seq, ts_us,
    CASE WHEN event_type IN ('signup', 'click') THEN 'heartbeat' WHEN event_type = 'view' THEN 'ready'
         WHEN event_type = 'error' THEN 'unhealthy' ELSE 'healthy' END AS op,
    CASE WHEN event_type = 'error' THEN 'error:' || CAST(k AS VARCHAR) END AS reason
  FROM b
),
per AS (
  SELECT worker,
    coalesce(max(ts_us) FILTER (WHERE op = 'heartbeat'), min(ts_us)) AS hb_us, max(ts_us) AS last_us,
    max(CASE WHEN op = 'ready' THEN 1 ELSE 0 END) AS ready_i,
    arg_max(op = 'healthy', seq) FILTER (WHERE op IN ('healthy', 'unhealthy')) AS ok,
    arg_max(coalesce(reason, ''), seq) FILTER (WHERE op IN ('healthy', 'unhealthy')) AS why
  FROM o GROUP BY worker
),
a AS (SELECT *, greatest(0.0, (max(last_us) OVER () - hb_us) / 1000000.0) AS age FROM per)
SELECT worker, coalesce(ok, true) AND NOT (age > 120.0) AS healthy, ready_i = 1 AS ready,
       CASE WHEN age > 120.0 THEN 'heartbeat_timeout' WHEN coalesce(ok, true) THEN '' ELSE why END AS reason,
       round(age, 3) AS heartbeat_age_seconds
FROM a"""
    if which == "alert_sustained":
        return f"""WITH {OPS_BASE_SQL},
q AS (
  SELECT CASE user_id % 4 WHEN 0 THEN 'ws-snapshot-batches' WHEN 1 THEN 'ws-bronze-written' WHEN 2 THEN 'ws-export-intents'
         ELSE 'ws-relay-intents' END AS queue, ts_us, value * 10.0 AS depth
  FROM b
),
f AS (SELECT *, depth > 500.0 AS hot, lag(depth > 500.0) OVER w AS ph, lag(ts_us) OVER w AS pt FROM q WINDOW w AS (PARTITION BY queue ORDER BY ts_us)),
g AS (SELECT *, sum(CASE WHEN hot AND (ph IS NULL OR NOT ph OR ts_us - pt > 1800000000) THEN 1 ELSE 0 END)
                  OVER (PARTITION BY queue ORDER BY ts_us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f)
SELECT queue, min(ts_us) AS start_us, max(ts_us) AS end_us, CAST(count(*) AS BIGINT) AS samples
FROM g WHERE hot GROUP BY queue, run HAVING max(ts_us) - min(ts_us) >= 600000000"""
    if which == "alert_not_ready":
        return f"""WITH {OPS_BASE_SQL},
p AS (SELECT worker, ts_us, event_type NOT IN ('signup', 'click') AS ready FROM b),
g AS (SELECT *, sum(CASE WHEN ready THEN 1 ELSE 0 END) OVER (PARTITION BY worker ORDER BY ts_us) AS run FROM p)
SELECT worker, min(ts_us) AS start_us, max(ts_us) AS end_us, CAST(count(*) AS BIGINT) AS probes
FROM g WHERE NOT ready GROUP BY worker, run HAVING count(*) > 3"""
    if which == "alert_restarts":
        return f"""WITH {OPS_BASE_SQL},
f AS (SELECT worker, ts_us FROM b WHERE event_type IN ('signup', 'error')),
w AS (SELECT worker, CAST(floor(ts_us / 1800000000.0) AS BIGINT) * 1800 - j * 1800 AS ws FROM f, range(0, 24) t(j))
SELECT worker, CAST(ws AS BIGINT) AS window_start_s, CAST(ws + 43200 AS BIGINT) AS window_end_s, CAST(count(*) AS BIGINT) AS failures
FROM w GROUP BY worker, ws HAVING count(*) >= 4"""
    if which == "alert_rate":
        return """WITH f AS (SELECT epoch_us(ts) AS us FROM events WHERE event_type = 'error'),
w AS (SELECT CAST(floor(us / 60000000.0) AS BIGINT) * 60 - j * 60 AS ws FROM f, range(0, 15) t(j))
SELECT CAST(ws AS BIGINT) AS window_start_s, CAST(ws + 900 AS BIGINT) AS window_end_s, CAST(count(*) AS BIGINT) AS failures
FROM w GROUP BY ws HAVING count(*) >= 3"""
    raise ValueError(which)


BOOK_OPS_SQL = """l2 AS (
  SELECT c.seq, c.recv_s, c.product_id AS product, e.value AS v,
         TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k
  FROM canon c JOIN events e ON e.event_id = c.seq
  WHERE c.venue = 'coinbase' AND e.event_type = 'click'
),
ops AS (
  SELECT product, seq, recv_s, 'bid' AS side, 0 AS phase, -1 AS j, NULL::DOUBLE AS price, NULL::DOUBLE AS size, true AS is_reset FROM l2 WHERE seq % 11 = 0
  UNION ALL SELECT product, seq, recv_s, 'bid', 0, 0, v - 0.5, 2.0, false FROM l2 WHERE seq % 11 = 0
  UNION ALL SELECT product, seq, recv_s, 'bid', 0, 1, (v - 0.5) - 1, 1.0, false FROM l2 WHERE seq % 11 = 0
  UNION ALL SELECT product, seq, recv_s, 'ask', 1, -1, NULL, NULL, true FROM l2 WHERE seq % 11 = 0
  UNION ALL SELECT product, seq, recv_s, 'ask', 1, 0, v + 0.5, 1.0, false FROM l2 WHERE seq % 11 = 0
  UNION ALL SELECT product, seq, recv_s, 'bid', 2, 0, v - 0.5, CASE WHEN k % 6 = 0 THEN 0.0 ELSE k / 10.0 END, false FROM l2 WHERE seq % 11 <> 0
  UNION ALL SELECT product, seq, recv_s, 'ask', 2, 1, v + 0.5, CASE WHEN k % 6 = 0 THEN 0.0 ELSE k / 10.0 END, false FROM l2 WHERE seq % 11 <> 0
),
ep AS (
  SELECT *, seq * 1000 + phase * 100 + j + 1 AS ok,
         sum(CASE WHEN is_reset THEN 1 ELSE 0 END) OVER (PARTITION BY product, side ORDER BY seq, phase, j
                                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch
  FROM ops
),
rs AS (SELECT product, side, epoch - 1 AS epoch, ok AS rok, seq AS rseq, recv_s AS rrecv FROM ep WHERE is_reset),
lv AS (
  SELECT e.*, lead(ok) OVER w AS nok, lead(seq) OVER w AS nseq, lead(recv_s) OVER w AS nrecv
  FROM ep e WHERE NOT is_reset
  WINDOW w AS (PARTITION BY product, side, epoch, price ORDER BY seq, phase, j)
),
lt AS (
  SELECT lv.product, lv.side, lv.epoch, lv.price, lv.size, lv.seq AS from_seq, lv.recv_s,
         CASE WHEN nok IS NULL THEN rs.rseq WHEN rs.rok IS NULL THEN nseq WHEN nok < rs.rok THEN nseq ELSE rs.rseq END AS to_seq,
         CASE WHEN nok IS NULL THEN rs.rrecv WHEN rs.rok IS NULL THEN nrecv WHEN nok < rs.rok THEN nrecv ELSE rs.rrecv END AS to_recv
  FROM lv LEFT JOIN rs ON rs.product = lv.product AND rs.side = lv.side AND rs.epoch = lv.epoch
)"""


def book_sql(which: str) -> str:
    head = f"WITH {CANON_SQL},\n{BOOK_OPS_SQL}"
    if which == "lifetime":
        return head + "\nSELECT product, side, CAST(epoch AS BIGINT) AS epoch, price, size, from_seq, to_seq FROM lt WHERE size > 0"
    if which == "best":
        return head + """,
marks AS (SELECT DISTINCT l2.seq, l2.product FROM l2),
lo AS (
  SELECT lv.product, lv.side, lv.price, lv.size, lv.ok AS from_ok,
         CASE WHEN nok IS NULL THEN rs.rok WHEN rs.rok IS NULL THEN nok ELSE least(nok, rs.rok) END AS to_ok
  FROM lv LEFT JOIN rs ON rs.product = lv.product AND rs.side = lv.side AND rs.epoch = lv.epoch WHERE lv.size > 0),
best AS (
  SELECT m.seq, m.product, max(price) FILTER (WHERE side = 'bid') AS bid, min(price) FILTER (WHERE side = 'ask') AS ask
  FROM marks m JOIN lo ON lo.product = m.product AND lo.from_ok <= m.seq * 1000 + 999 AND (lo.to_ok IS NULL OR lo.to_ok > m.seq * 1000 + 999)
  GROUP BY 1, 2)
SELECT b.seq, CAST(0 AS BIGINT) AS pos, c.market_key, 'book_update' AS kind, c.event_us, b.product AS product_id, b.bid, b.ask
FROM best b JOIN canon c ON c.seq = b.seq"""
    if which == "as_of":
        return head + """,
last AS (SELECT product, max(recv_s // 86400) AS last_day FROM ops GROUP BY product),
d AS (
  SELECT lt.product, lt.side, lt.price, lt.recv_s // 86400 AS fd,
         coalesce(lt.to_recv // 86400 - 1, last.last_day) AS td
  FROM lt JOIN last USING (product) WHERE lt.size > 0
),
x AS (SELECT product, side, price, unnest(generate_series(fd, td)) AS day FROM d WHERE td >= fd)
SELECT product, side, CAST(day AS BIGINT) AS day,
       CASE WHEN side = 'bid' THEN max(price) ELSE min(price) END AS best_price, CAST(count(*) AS BIGINT) AS levels
FROM x GROUP BY product, side, day"""
    raise ValueError(which)


LISTING_SQL = """l0 AS (
  SELECT o_orderkey AS k, o_orderdate AS d, o_totalprice AS p, strftime(o_orderdate, '%Y-%m-%d') AS ds,
         CASE o_custkey % 4 WHEN 0 THEN 'cb-btcusd' WHEN 1 THEN 'cb-ethusd' WHEN 2 THEN 'pm-btc' ELSE 'pm-eth' END AS mk
  FROM orders
),
l1 AS (
  SELECT 'landing/' || CASE WHEN k % 5 = 0 THEN 'misc' ELSE ds END || '/' ||
         CASE k % 7 WHEN 0 THEN mk || '.ndjson.zst' WHEN 1 THEN 'notes-' || CAST(k AS VARCHAR) || '.txt'
                    WHEN 2 THEN 'BAD NAME ' || CAST(k AS VARCHAR) || '.ndjson.zst'
                    ELSE mk || '__start_' || strftime(d, '%Y%m%dT%H%M%SZ') || '__part_' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') || '.ndjson.zst' END AS path,
         d + to_seconds(k % 86400) AS mtime, CAST(round(p * 10.0) AS BIGINT) AS length
  FROM l0
),
listing AS (
  SELECT path, max(mtime) AS mtime, max(length) AS length,
         regexp_extract(path, '([^/]+)$', 1) AS filename, regexp_extract(path, '([^/]+)/[^/]+$', 1) AS parent
  FROM l1 GROUP BY path
)"""


def inventory_sql(which: str) -> str:
    rot = "^([a-z0-9-]+)__start_(\\d{8}T\\d{6}Z)__part_(\\d{4})\\.ndjson\\.zst$"
    if which == "pending":
        return f"""WITH {LISTING_SQL},
m AS (
  SELECT *, CASE WHEN regexp_matches(filename, '{rot}') THEN regexp_extract(filename, '{rot}', 1)
                 WHEN suffix(filename, '.ndjson.zst') THEN regexp_extract(filename, '^(.*)\\.ndjson\\.zst$', 1) ELSE '' END AS market_key
  FROM listing WHERE suffix(filename, '.ndjson.zst')
)
SELECT path, CASE WHEN regexp_matches(parent, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN parent ELSE strftime(mtime, '%Y-%m-%d') END AS date_str,
       market_key, filename, CAST(coalesce(length, 0) AS BIGINT) AS size_bytes
FROM m WHERE market_key <> ''"""
    if which == "growth":
        return f"""WITH {LISTING_SQL},
g AS (SELECT path, length, (length % 9973) % 7200 * 500000 AS dt, (length % 9973) % 5000 AS dl FROM listing)
SELECT path, CAST(length + dl AS BIGINT) AS size_bytes, greatest(0.001, dt / 1000000.0) AS age_seconds, dl / greatest(0.001, dt / 1000000.0) AS growth_bps FROM g"""
    if which == "next_parts":
        return f"""WITH {LISTING_SQL},
h AS (SELECT parent AS date_str, regexp_extract(filename, '{rot}', 1) AS market_key, max(CAST(regexp_extract(filename, '{rot}', 3) AS INTEGER)) AS most
      FROM listing WHERE regexp_matches(filename, '{rot}') GROUP BY 1, 2),
n AS (SELECT ds AS date_str, mk AS market_key, d, k FROM l0),
p AS (SELECT n.date_str, n.market_key, n.k, n.d, CAST(coalesce(most, 0) + row_number() OVER (PARTITION BY n.date_str, n.market_key ORDER BY d, k) AS INTEGER) AS part
      FROM n LEFT JOIN h USING (date_str, market_key))
SELECT date_str, market_key, k, part, market_key || '__start_' || strftime(d, '%Y%m%dT%H%M%SZ') || '__part_' || printf('%04d', part) || '.ndjson.zst' AS filename
FROM p"""
    if which == "payload_audit":
        return f"""WITH {LISTING_SQL},
f AS (SELECT path, max(length) AS n FROM listing GROUP BY path),
m AS (SELECT sha256(path) AS export_id, path AS staged_blob_path, sha256(path || '|' || CAST(n AS VARCHAR)) AS content_sha256, n AS content_length FROM f),
a AS (SELECT *, CASE WHEN content_length % 11 <> 3 THEN CASE WHEN content_length % 13 = 5 THEN sha256(content_sha256) ELSE content_sha256 END END AS actual_sha256,
             CASE WHEN content_length % 11 <> 3 THEN CASE WHEN content_length % 17 = 2 THEN content_length - 1 ELSE content_length END END AS actual_length FROM m)
SELECT *, CASE WHEN actual_sha256 IS NULL THEN 'missing' WHEN actual_sha256 <> content_sha256 OR actual_length <> content_length THEN 'mismatch' ELSE 'ok' END AS status FROM a"""
    if which == "rolled":
        return f"""WITH {OPS_BASE_SQL},
l AS (SELECT strftime(ts, '%Y-%m-%d') AS date_str, mk AS market_key, CAST(floor(ts_us / 1000000.0) AS BIGINT) AS s, seq,
             strlen('{{"event_id":' || CAST(seq AS VARCHAR) || ',"event_type":"' || event_type || '","k":' || CAST(k AS VARCHAR) || '}}') + 1 AS n FROM b),
c AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY date_str, market_key ORDER BY s, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 2000 AS cut FROM l),
p AS (SELECT date_str, market_key, cut, min(s) AS start, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS size_bytes FROM c GROUP BY ALL),
h AS (SELECT strftime(ts, '%Y-%m-%d') AS date_str, mk AS market_key, max(k % 7 + 1) AS most FROM b WHERE event_type = 'error' GROUP BY ALL),
q AS (SELECT p.*, CAST(coalesce(most, 0) + row_number() OVER (PARTITION BY p.date_str, p.market_key ORDER BY cut) AS INTEGER) AS part FROM p LEFT JOIN h USING (date_str, market_key))
SELECT date_str, market_key, part, market_key || '__start_' || strftime(make_timestamp(start * 1000000), '%Y%m%dT%H%M%SZ') || '__part_' || printf('%04d', part) || '.ndjson.zst' AS filename,
       n_rows, size_bytes FROM q"""
    if which == "projection":
        return f"""WITH {MARKETS_SQL},
{LISTING_SQL},
c AS (
  SELECT DISTINCT path, parent AS date_str, length, mtime, x AS market_key
  FROM listing, unnest([regexp_extract(filename, '^(.*?)__start_.*__part_.*\\.ndjson\\.zst$', 1),
                        regexp_extract(filename, '^(.*)\\.ndjson\\.zst$', 1)]) t(x)
  WHERE regexp_matches(parent, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AND x IN (SELECT market_key FROM markets)
),
s AS (SELECT date_str, market_key, CAST(sum(coalesce(length, 0)) AS BIGINT) AS size_bytes, max(mtime) AS as_of FROM c GROUP BY 1, 2),
e AS (SELECT *, greatest(1.0, CAST(epoch(as_of) - epoch(CAST(date_str AS TIMESTAMP)) AS DOUBLE)) AS elapsed_s FROM s)
SELECT date_str, market_key, size_bytes, elapsed_s, size_bytes / elapsed_s * 86400.0 AS projected_bytes,
       5242880.0 AS target_bytes, size_bytes / elapsed_s * 86400.0 > 5242880.0 AS warning
FROM e"""
    raise ValueError(which)


def text_helpers_sql() -> str:
    return """WITH e AS (
  SELECT event_id, event_type, value, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) AS us, ts,
         sha256(CAST(event_id AS VARCHAR)) AS h,
         CASE WHEN value > 20 THEN 1 WHEN value < 20 THEN -1 ELSE 0 END AS sign FROM events),
f AS (SELECT *, '{"event_type":"' || event_type || '","k":' || CAST(k AS VARCHAR) || '}' AS j, '0x' || left(h, k % 20) AS addr FROM e)
SELECT event_id, event_type || '/a/' || CAST(k AS VARCHAR) AS folder, sign,
  CASE sign WHEN 1 THEN 'Up' WHEN -1 THEN 'Down' ELSE 'Flat' END AS label, sign AS sign_again,
  rtrim(rtrim(printf('%.10f', value), '0'), '.') AS fmt,
  CASE WHEN length(addr) <= 10 THEN addr ELSE left(addr, 6) || '...' || right(addr, 4) END AS masked,
  CASE WHEN length(j) <= 30 THEN j ELSE left(j, 27) || '...' END AS compact,
  k % 6 NOT IN (1, 5) AS flag,
  CASE WHEN k % 3 = 2 THEN '' ELSE '0x' || h END AS condition_id,
  CAST(floor((k - 50) / 30.0) * 30 AS INTEGER) AS floored, us / 1000000.0 AS epoch,
  strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp
FROM f"""


def event_time_sql(i: int = 300, delay: int = 3600, parts: int = 4) -> str:
    """Lateness by the parts' watermarks, then plain counts."""
    return f"""WITH {CANON_SQL},
a AS (SELECT *, event_us // 1000000 AS e, recv_s + (seq * 7919) % 3600 + CASE WHEN seq % 50 = 7 THEN 900000 ELSE 0 END AS arrived FROM canon),
s AS (SELECT min(arrived) AS lo, greatest(1, (max(arrived) - min(arrived) + {parts}) // {parts}) AS step FROM a),
p AS (SELECT a.*, (arrived - lo) // step AS part, e - e % {i} + {i} AS snapshot_ts FROM a, s),
w AS (SELECT part, max(max(e)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {delay} AS mark FROM p GROUP BY part),
r AS (SELECT p.*, coalesce(snapshot_ts <= mark, false) AS late FROM p JOIN w USING (part))
SELECT market_key, snapshot_ts, count(*) FILTER (NOT late) AS in_time, count(*) FILTER (NOT late AND lower(trim(kind)) = 'trade') AS trades, count(*) FILTER (late) AS late,
       max_by(bid, e * 1000000000 + seq) FILTER (NOT late AND venue = 'coinbase' AND bid IS NOT NULL) AS best_bid
FROM r GROUP BY market_key, snapshot_ts"""


def feed_snapshots_sql(i: int = 300) -> str:
    """Dense snapshots over the parsed feed: the parsers' oracles and the
    resolver's metas, in place of the adapted events."""
    def part(sql: str) -> str:
        return f"({sql})"
    columns = ("seq", "recv_s", "market_key", "kind", "event_us", "bid", "ask", "last_trade_px", "price", "size", "side", "slug", "bucket_start_ts", "condition_id")
    shapes = {
        "trades": (spot_parse_sql("trades"), {"price", "size", "side", "event_us"}),
        "ticker": (spot_parse_sql("ticker"), {"bid", "ask", "last_trade_px", "event_us"}),
        "heartbeat": (spot_parse_sql("heartbeat"), {"event_us"}),
        "best": (book_sql("best"), {"bid", "ask", "event_us"}),
        "pm_change": (pred_parse_sql("price_change"), {"bid", "ask", "price", "side", "slug", "bucket_start_ts", "condition_id", "event_us"}),
        "pm_quotes": (pred_parse_sql("quotes"), {"bid", "ask", "side", "slug", "bucket_start_ts", "condition_id", "event_us"}),
        "pm_book": (pred_parse_sql("book"), {"bid", "ask", "side", "slug", "bucket_start_ts", "condition_id", "event_us"}),
        "pm_trades": (pred_parse_sql("trades"), {"price", "size", "side", "slug", "bucket_start_ts", "condition_id", "event_us"}),
    }
    text = {"kind", "side", "slug", "condition_id"}
    rows = []
    for sql, own in shapes.values():
        bits = []
        for c in columns:
            if c == "recv_s":
                bits.append("CAST(floor(epoch_us(e.ts) / 1000000.0) AS BIGINT) AS recv_s")
            elif c in own or c in ("seq", "market_key", "kind"):
                bits.append(f"x.{c}")
            else:
                bits.append(f"CAST(NULL AS {'VARCHAR' if c in text else 'DOUBLE'}) AS {c}")
        rows.append(f"SELECT {', '.join(bits)} FROM {part(sql)} x JOIN events e ON e.event_id = x.seq")
    meta = refdata_sql("resolve").replace("SELECT * FROM resolved", "SELECT * FROM resolved WHERE error IS NULL")
    bound = f"SELECT bucket_start_ts, market_key, yes_asset_id = no_asset_id AS one FROM ({meta})"
    feed = " UNION ALL ".join(rows)
    feed = f"SELECT f.* FROM ({feed}) f LEFT JOIN ({bound}) b ON b.market_key = f.market_key AND b.bucket_start_ts = f.bucket_start_ts " \
           "WHERE f.bucket_start_ts IS NULL OR (b.market_key IS NOT NULL AND NOT (b.one AND f.side = 'yes'))"
    # Rows rank by arrival second, then frame; a meta comes ahead of its second's frames.
    rank = "recv_s * 1000000000 + seq"
    metas = "SELECT CAST(-1 AS BIGINT) AS seq, bucket_start_ts AS recv_s, market_key, 'meta' AS kind, CAST(NULL AS BIGINT) AS event_us, " \
            + ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in ("bid", "ask", "last_trade_px", "price", "size")) \
            + f", CAST(NULL AS VARCHAR) AS side, slug, bucket_start_ts, condition_id FROM ({meta})"
    canon = f"canon AS (SELECT * EXCLUDE (seq), {rank} AS seq FROM (SELECT * FROM ({feed}) UNION ALL SELECT * FROM ({metas})))"
    none = "drops AS (SELECT CAST(NULL AS VARCHAR) AS market_key, CAST(NULL AS BIGINT) AS recv_s, CAST(NULL AS BIGINT) AS n WHERE false)"
    return snapshots_sql(i).replace(CANON_SQL, canon).replace(DROPS_SQL, none)
