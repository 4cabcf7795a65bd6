"""Spot-exchange frames -> canonical events (heartbeat, quote, trade).

Level-2 frames become book events through ``operators.book``.  Semantics:
malformed JSON and non-object payloads yield nothing; ``channel`` is
trimmed and lower-cased; the frame ``timestamp`` (ISO) falls back to the
arrival time; a non-list ``events`` yields nothing; non-object elements
are skipped; unknown products are dropped; a heartbeat without a product
fans out to every configured product; a trade without a parsable price
is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketfold.functions import constants as C
from marketfold.functions import jsonv as J
from marketfold.functions.exprs import parse_heartbeat_time, parse_iso8601

POS_STRIDE = 1 << 20


def product_market_map(products: dict[str, str] | None = None) -> F.Column:
    items = []
    for k, v in (products or C.SPOT_PRODUCTS).items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def is_object_fast(v) -> F.Column:
    """Object check that does not walk nested values (shallow map cast)."""
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def frame_envelope(frames: DataFrame) -> DataFrame:
    """Parse once; expose channel, fallback time and the events list.
    Non-object payloads yield no channel and so no events.  Consumers
    filter channels with ``fenced_filter`` so the parse is not re-evaluated
    inside a pushed-down filter."""
    df = frames.select("seq", "recv_us", F.try_parse_json(F.col("value")).alias("v"))
    df = J.extract(df, "v", {"m_channel": "$.channel", "m_ts": "$.timestamp", "m_events": "$.events"})
    msg_ts = parse_iso8601(J.p_text(J.pair("m_ts")))
    return df.select(
        "seq", "recv_us",
        J.p_norm(J.pair("m_channel")).alias("channel"),
        F.coalesce(F.unix_micros(msg_ts), F.col("recv_us")).alias("fallback_us"),
        J.p_array(J.pair("m_events")).alias("events"))


_PID = {"x_pid": "$.product_id", "x_pidc": "$.productId"}
_EL_PATHS = {**_PID, "x_bid": "$.best_bid", "x_bidc": "$.bestBid", "x_ask": "$.best_ask", "x_askc": "$.bestAsk",
             "x_px": "$.price", "x_sz": "$.size", "x_side": "$.side", "x_time": "$.time", "x_hb": "$.current_time"}


# The channels read here.
CHANNELS = ("heartbeats", "ticker", "market_trades")


def parse_spot_frames(frames: DataFrame, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """Heartbeat, quote and trade events in ONE pass over the frames (book
    events: ``operators.book``); ``channels`` picks the ones wanted.  Per channel the inner list is: heartbeats
    -> the event itself (objects only, fanned out to every product when it
    names none); ticker -> ``tickers`` or the event itself; market_trades ->
    ``trades``.  Unknown products are dropped; trades need a price."""
    from marketfold.operators.canonical import conform
    env = J.fenced_filter(frame_envelope(frames), F.col("channel").isin(*channels))
    ev = env.select("seq", "recv_us", "fallback_us", "channel", F.posexplode("events").alias("i", "ev"))
    ev = J.extract(ev, "ev", {"x_tickers": "$.tickers", "x_trades": "$.trades"})
    ch = F.col("channel")
    inner = (F.when(ch == "heartbeats", F.when(is_object_fast(F.col("ev")), F.array(F.col("ev"))))
              .when(ch == "ticker", F.coalesce(J.p_array(J.pair("x_tickers")), F.array(F.col("ev"))))
              .otherwise(J.p_array(J.pair("x_trades"))))
    el = ev.select("seq", "recv_us", "fallback_us", "channel", "i", F.posexplode(inner).alias("j", "el"))
    el = J.extract(el, "el", _EL_PATHS)
    pid = J.p_norm(J.p_first(J.pair("x_pid"), J.pair("x_pidc")), upper=True)
    hb = F.unix_micros(parse_heartbeat_time(J.p_text(J.pair("x_hb"))))
    tt = F.unix_micros(parse_iso8601(J.p_text(J.pair("x_time"))))
    is_hb, is_tk, is_tr = ch == "heartbeats", ch == "ticker", ch == "market_trades"
    df = el.select(
        "seq", "recv_us", "channel", "i", "j", pid.alias("pid"),
        F.when(is_hb, F.coalesce(hb, F.col("fallback_us"))).when(is_tr, F.coalesce(tt, F.col("fallback_us")))
         .otherwise(F.col("fallback_us")).alias("event_us"),
        F.when(is_tk, J.p_float(J.p_first(J.pair("x_bid"), J.pair("x_bidc")))).alias("bid"),
        F.when(is_tk, J.p_float(J.p_first(J.pair("x_ask"), J.pair("x_askc")))).alias("ask"),
        F.when(is_tk, J.p_float(J.pair("x_px"))).alias("last_trade_px"),
        F.when(is_tr, J.p_float(J.pair("x_px"))).alias("price"),
        F.when(is_tr, J.p_float(J.pair("x_sz"))).alias("size"),
        F.when(is_tr, J.p_norm(J.pair("x_side"), upper=True)).alias("side"))
    df = J.fenced_filter(df, ~is_tr | F.col("price").isNotNull())
    all_products = F.array(*[F.lit(p) for p in C.SPOT_PRODUCTS])
    fan = F.when(is_hb & (F.col("pid") == ""), all_products).otherwise(F.array(F.col("pid")))
    df = df.select("*", F.posexplode(fan).alias("k", "product_id"))
    df = df.withColumn("pos", F.col("i") * F.lit(POS_STRIDE) + F.col("j") + F.col("k"))
    df = df.withColumn("kind", F.when(is_hb, F.lit("heartbeat")).when(is_tk, F.lit("quote")).otherwise(F.lit("trade")))
    df = J.fenced_filter(df.withColumn("market_key", F.element_at(product_market_map(), F.col("product_id"))),
                         F.col("market_key").isNotNull())
    df = (df.withColumn("venue", F.lit(C.SPOT_VENUE))
            .withColumn("recv_s", F.floor(F.col("recv_us") / F.lit(1_000_000)).cast("bigint")))
    return conform(df)
