"""Prediction-market frames -> canonical events, enriched by token bindings.

A payload is one object or a list of objects; ``event_type`` (alias
``type``) selects the branch; control messages (empty, subscribed,
unsubscribed, pong, status) and unknown types yield nothing.  Every
message is looked up by asset id in the bindings table (inner join: no
binding -> dropped).  ``timestamp`` is epoch seconds as sent (no unit
handling); missing or 0 falls back to the arrival time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketfold.functions import constants as C
from marketfold.functions import jsonv as J

POS_STRIDE = 1 << 20
BINDING_COLUMNS = ("asset_id", "symbol", "market_key", "side", "slug", "bucket_start_ts", "condition_id")
_ASSET_ALIASES = ("$.asset_id", "$.assetId", "$.asset", "$.token_id")


def messages(frames: DataFrame) -> DataFrame:
    """One row per message object: (seq, recv_us, i, event_type, item).
    Non-object messages have no type and are dropped with the control
    messages."""
    v = F.try_parse_json(F.col("value"))
    df = frames.select("seq", "recv_us", v.alias("v")).filter(F.col("v").isNotNull())
    lst = F.coalesce(J.as_array(F.col("v")), F.array(F.col("v")))
    df = df.select("seq", "recv_us", F.posexplode(lst).alias("i", "item"))
    df = J.extract(df, "item", {"x_et": "$.event_type", "x_type": "$.type"})
    etype = J.p_norm(J.p_first(J.pair("x_et"), J.pair("x_type")))
    return J.fenced_filter(df.select("seq", "recv_us", "i", "item", etype.alias("event_type")),
                           ~F.col("event_type").isin(*C.IGNORED_PREDICTION_TYPES))


_ASSET_PATHS = {"x_a1": "$.asset_id", "x_a2": "$.assetId", "x_a3": "$.asset", "x_a4": "$.token_id", "x_ts": "$.timestamp"}


def _event_us() -> F.Column:
    ts = J.p_float(J.pair("x_ts"))
    ts = F.when(ts != 0, ts)
    return F.coalesce((F.round(ts * F.lit(1_000_000.0))).try_cast("bigint"), F.col("recv_us"))


def _asset() -> F.Column:
    return J.p_text(J.p_first(*[J.pair(f"x_a{i}") for i in range(1, 5)]))


_PRICE_PATHS = {"x_bb": "$.best_bid", "x_b": "$.bid", "x_ba": "$.best_ask", "x_a": "$.ask", "x_px": "$.price",
                "x_ltp": "$.last_trade_price", "x_sz": "$.size", "x_side": "$.side", "x_bids": "$.bids", "x_asks": "$.asks"}
# Message types and the kind of event they become.
KINDS = {"price_change": "book_update", "best_bid_ask": "quote", "last_trade_price": "trade", "book": "book_update"}


def book_top(levels: F.Column, want_max: bool) -> F.Column:
    """Top of one side of a book message: object levels use
    ``price|price_level|px``, list levels their first element; levels
    without a parsable price are skipped; NULL when none remain."""
    arr = J.as_array(levels)
    px = F.transform(arr, lambda lv: F.when(J.is_object(lv), J.to_float(J.first_truthy(lv, "$.price", "$.price_level", "$.px")))
                     .when(J.is_array(lv) & (F.size(J.as_array(lv)) > 0), J.to_float(F.element_at(J.as_array(lv), 1))))
    px = F.filter(px, lambda x: x.isNotNull())
    return F.array_max(px) if want_max else F.array_min(px)


def message_events(msgs: DataFrame, types: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """Messages of the wanted types -> events by asset id, in one pass: a price
    change is its list of changes, any other message itself; every path is
    extracted once."""
    m = J.fenced_filter(msgs, F.col("event_type").isin(*types))
    is_change = F.col("event_type") == "price_change"
    m = J.extract(m, "item", {"x_pc": "$.price_changes"})
    inner = F.when(is_change, J.p_array(J.pair("x_pc"))).otherwise(F.array("item"))
    m = m.select("seq", "recv_us", "i", "event_type", F.posexplode(inner).alias("j", "el"))
    m = J.extract(m, "el", {**_ASSET_PATHS, **_PRICE_PATHS})
    et = F.col("event_type")
    is_book, is_trade = et == "book", et == "last_trade_price"
    bid, ask = J.p_float(J.p_first(J.pair("x_bb"), J.pair("x_b"))), J.p_float(J.p_first(J.pair("x_ba"), J.pair("x_a")))
    kind = F.lit(None).cast("string")
    for name, value in KINDS.items():
        kind = F.when(et == name, F.lit(value)).otherwise(kind)
    m = m.select(
        "seq", "recv_us", (F.col("i") * F.lit(POS_STRIDE) + F.col("j")).alias("pos"), _asset().alias("asset_id"), _event_us().alias("event_us"),
        F.when(is_book, book_top(F.col("x_bids"), True)).when(~is_trade, bid).alias("bid"),
        F.when(is_book, book_top(F.col("x_asks"), False)).when(~is_trade, ask).alias("ask"),
        F.when(is_trade, J.p_float(J.p_first(J.pair("x_px"), J.pair("x_ltp")))).when(is_change, J.p_float(J.pair("x_px"))).alias("price"),
        F.when(is_trade, J.p_float(J.pair("x_sz"))).alias("size"), F.when(is_trade, J.p_norm(J.pair("x_side"), upper=True)).alias("trade_side"),
        kind.alias("kind"))
    out = J.fenced_filter(m, F.col("asset_id").isNotNull() & (F.col("asset_id") != ""))
    return (out.withColumn("venue", F.lit(C.PREDICTION_VENUE))
               .withColumn("recv_s", F.floor(F.col("recv_us") / F.lit(1_000_000)).cast("bigint")))


def parse_messages(msgs: DataFrame, bindings: DataFrame, types: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """``message_events`` of bound assets: one binding lookup (inner equi-join
    on asset id).  The bindings table is a dimension (2 rows per market per
    5-minute bucket); the planner broadcasts it only when its measured size is
    under the threshold."""
    return message_events(msgs, types).join(bindings.select(*BINDING_COLUMNS), "asset_id", "inner")


def bound_as_of(events: DataFrame, changes: DataFrame) -> DataFrame:
    """Events (``message_events``, materialised) with the binding that was in
    force when they arrived (``reference_data.binding_changes``); events of
    assets that were free then are dropped."""
    from marketfold.operators.asof import asof_join
    met = asof_join(events, changes.withColumnRenamed("at", "recv_s"), "asset_id", "recv_s", "binding").filter("binding.bound")
    b = F.col("binding")
    return met.select("*", b["market_key"].alias("market_key"), F.when(b["no"] == 1, "no").otherwise("yes").alias("side"), b["slug"].alias("slug"),
                      b["bucket_start_ts"].alias("bucket_start_ts"), b["condition_id"].alias("condition_id"), b["since"].alias("since")).drop("binding")


def parse_price_changes(msgs: DataFrame, bindings: DataFrame) -> DataFrame:
    return parse_messages(msgs, bindings, ("price_change",))


def parse_best_bid_ask(msgs: DataFrame, bindings: DataFrame) -> DataFrame:
    return parse_messages(msgs, bindings, ("best_bid_ask",))


def parse_last_trades(msgs: DataFrame, bindings: DataFrame) -> DataFrame:
    return parse_messages(msgs, bindings, ("last_trade_price",))


def parse_books(msgs: DataFrame, bindings: DataFrame) -> DataFrame:
    return parse_messages(msgs, bindings, ("book",))


def parse_prediction_frames(frames: DataFrame, bindings: DataFrame) -> DataFrame:
    from marketfold.operators.canonical import conform
    return conform(parse_messages(messages(frames), bindings))
