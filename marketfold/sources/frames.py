"""Raw feed frames as a table: ``(seq, recv_us, venue, value)``.

A landing zone of raw websocket frames (one JSON text per frame) becomes this
shape by ``frames_from_text`` (batch), ``stream_text_frames`` (stream, bare
lines) or ``stream_frames`` (stream, frames stamped by their recorder).  ``spot_frames`` / ``prediction_frames`` derive frames from
the ``events`` table with column expressions (``to_json``), covering every
message shape the parsers accept plus malformed input, so the parsers run
on data that grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketfold.functions.exprs import epoch_whole_seconds
from marketfold.operators.canonical import events_to_canonical
from marketfold.session import cut_lineage

FRAME_COLUMNS = ("seq", "recv_us", "venue", "value")
FRAME_SCHEMA = "seq long, recv_us long, venue string, value string"


def frames_from_text(lines: DataFrame, venue: str) -> DataFrame:
    """Landed frame files -> frames.  ``lines`` is a ``spark.read.text`` frame
    of the landing zone: arrival time is the file's modification time; the
    order is that time, then the file's name, then the place in the file.

    ``seq`` numbers whole files by (time, name) -- a small table -- and lines
    inside each file, so it is the same however files are split."""
    df = lines.select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_modification_time").alias("_t"),
                      F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"))
    files = df.groupBy("_f", "_t").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_t", "_f").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_f", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_f").orderBy("_b", "_m"))
    return df.withColumn("_r", inside).join(files, "_f").select(
        (F.col("_off") + F.col("_r")).alias("seq"), F.unix_micros("_t").alias("recv_us"), F.lit(venue).alias("venue"), "value")


def stream_frames(spark: SparkSession, path: str, fmt: str = "parquet", files: int | None = None) -> DataFrame:
    """A landing zone of recorded frames as a stream.  The recorder stamps each
    frame with its number and arrival time (``FRAME_SCHEMA``), so the order needs
    no window; ``files`` bounds a micro-batch."""
    reader = spark.readStream.schema(FRAME_SCHEMA).format(fmt)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).load(path)


def stream_text_frames(spark: SparkSession, path: str, venue: str, files: int | None = None) -> DataFrame:
    """A landing zone of bare frame files (one frame a line) as a stream."""
    reader = spark.readStream
    return numbered_lines((reader.option("maxFilesPerTrigger", files) if files else reader).text(path, wholetext=True), venue)


def numbered_lines(texts: DataFrame, venue: str) -> DataFrame:
    """Whole landed files (``read.text`` or ``readStream.text`` with
    ``wholetext``) -> frames, without any window: ``seq`` is the file's time in
    milliseconds and the place of the line in the file (22 bits; landing files
    are rolled long before four million lines).  Files are closed one after the
    other by their recorder, so their times differ."""
    at = F.unix_micros(F.col("_metadata.file_modification_time"))
    lines = texts.select(at.alias("recv_us"), F.posexplode(F.split("value", "\r?\n")).alias("_p", "value"))
    return lines.filter(F.col("value") != "").select(
        (F.floor(F.col("recv_us") / F.lit(1000)).cast("bigint") * F.lit(1 << 22) + F.col("_p")).alias("seq"), "recv_us", F.lit(venue).alias("venue"), "value")


def land(frames: DataFrame) -> DataFrame:
    """Materialise derived frames into the checkpoint folder: the parsers
    then read a landed table of JSON text, as they would from a landing
    zone, instead of planning through the frame-building expressions."""
    return cut_lineage(frames)


def _iso_z(us: F.Column) -> F.Column:
    ts = F.timestamp_micros(us)
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."),
                    F.lpad(F.pmod(us, F.lit(1_000_000)).cast("string"), 6, "0"), F.lit("Z"))


def epoch_text(us: F.Column) -> F.Column:
    """Epoch seconds with 6 decimals as text (prediction-feed timestamps)."""
    return F.concat(F.floor(us / F.lit(1_000_000)).cast("string"), F.lit("."),
                    F.lpad(F.pmod(us, F.lit(1_000_000)).cast("string"), 6, "0"))


def _num_text(c: F.Column) -> F.Column:
    return c.cast("string")


def spot_frames(events: DataFrame) -> DataFrame:
    """Spot-exchange frames (channels heartbeats, ticker, market_trades,
    level2, plus malformed frames) from the spot rows of ``events``."""
    c = events_to_canonical(events, keep=("event_type", "value", "k")).filter(F.col("venue") == "coinbase")
    seq, us, k = F.col("seq"), F.col("event_us"), F.col("k")
    msg_ts = _iso_z(us)
    product = F.when(F.pmod(seq, F.lit(13)) == 0, F.concat(F.lit(" "), F.lower(F.col("product_id")), F.lit(" "))) \
        .otherwise(F.col("product_id"))
    # market_trades: price text; every 17th price unparsable; size omitted when NULL.
    trade = F.struct(
        product.alias("product_id"),
        F.when(F.pmod(seq, F.lit(17)) == 0, F.lit("n/a")).otherwise(_num_text(F.col("price"))).alias("price"),
        _num_text(F.col("size")).alias("size"),
        F.col("side").alias("side"),
        F.when(F.pmod(seq, F.lit(3)) != 0, msg_ts).alias("time"))
    trades_msg = F.to_json(F.struct(
        F.lit("market_trades").alias("channel"), msg_ts.alias("timestamp"),
        F.array(F.struct(F.lit("update").alias("type"), F.array(trade).alias("trades"))).alias("events")))
    # ticker: snake_case or camelCase; either inside tickers[] or the event itself.
    snake = F.struct(product.alias("product_id"), F.col("bid").alias("best_bid"), F.col("ask").alias("best_ask"),
                     _num_text(F.col("last_trade_px")).alias("price"))
    camel = F.struct(product.alias("productId"), _num_text(F.col("bid")).alias("bestBid"),
                     _num_text(F.col("ask")).alias("bestAsk"), _num_text(F.col("last_trade_px")).alias("price"))
    tk_json = F.when(F.pmod(seq, F.lit(5)) == 0, F.to_json(camel)).otherwise(F.to_json(snake))
    ticker_event = F.when(F.pmod(seq, F.lit(7)) == 0, tk_json).otherwise(
        F.concat(F.lit('{"type":"snapshot","tickers":['), tk_json, F.lit("]}")))
    ticker_msg = F.concat(F.lit('{"channel":"ticker","timestamp":"'), msg_ts, F.lit('","events":['), ticker_event, F.lit("]}"))
    # heartbeats: Go-style current_time; product omitted on odd seq (fan-out).
    hb_time = F.concat(F.date_format(F.timestamp_micros(us), "yyyy-MM-dd HH:mm:ss"), F.lit("."),
                       F.lpad(F.pmod(us, F.lit(1_000_000)).cast("string"), 6, "0"), F.lit("123 +0000 UTC m=+"),
                       k.cast("string"), F.lit(".5"))
    hb = F.struct(hb_time.alias("current_time"), k.cast("bigint").alias("heartbeat_counter"),
                  F.when(F.pmod(seq, F.lit(2)) == 0, F.col("product_id")).alias("product_id"))
    hb_msg = F.to_json(F.struct(F.lit("heartbeats").alias("channel"), msg_ts.alias("timestamp"),
                                F.array(hb).alias("events")))
    # level2: snapshot (bids/asks lists) every 11th message, otherwise updates.
    bid_px, ask_px = F.col("value") - 0.5, F.col("value") + 0.5
    qty = F.when(F.pmod(k, F.lit(6)) == 0, F.lit("0")).otherwise((k / F.lit(10.0)).cast("string"))
    upd = F.array(
        F.struct(F.lit("bid").alias("side"), bid_px.cast("string").alias("price_level"), qty.alias("new_quantity")),
        F.struct(F.lit("offer").alias("side"), ask_px.cast("string").alias("price_level"), qty.alias("new_quantity")))
    l2_update = F.struct(F.lit("update").alias("type"), F.col("product_id").alias("product_id"), upd.alias("updates"))
    l2_snapshot = F.struct(
        F.lit("snapshot").alias("type"), F.col("product_id").alias("product_id"),
        F.array(F.array(bid_px.cast("string"), F.lit("2")), F.array((bid_px - 1).cast("string"), F.lit("1"))).alias("bids"),
        F.array(F.array(ask_px.cast("string"), F.lit("1"))).alias("asks"))
    l2_msg = F.when(F.pmod(seq, F.lit(11)) == 0, F.to_json(F.struct(
        F.lit("level2").alias("channel"), msg_ts.alias("timestamp"), F.array(l2_snapshot).alias("events")))
    ).otherwise(F.to_json(F.struct(F.lit("level2").alias("channel"), msg_ts.alias("timestamp"),
                                   F.array(l2_update).alias("events"))))
    junk = (F.when(F.pmod(seq, F.lit(3)) == 0, F.lit('{"channel": "ticker", "events": [ not json'))
             .when(F.pmod(seq, F.lit(3)) == 1, F.lit('{"channel":"ticker","events":{"x":1}}'))
             .otherwise(F.lit('{"channel":"market_trades","events":[5,"x",{"trades":[{"product_id":"DOGE-USD","price":"1"}]}]}')))
    et = F.col("event_type")
    value = (F.when(et == "purchase", trades_msg).when(et == "view", ticker_msg)
              .when(et == "signup", hb_msg).when(et == "click", l2_msg).otherwise(junk))
    return land(c.select("seq", (F.col("recv_s") * F.lit(1_000_000)).alias("recv_us"), F.lit("coinbase").alias("venue"),
                         value.alias("value")))


def prediction_frames(events: DataFrame) -> DataFrame:
    """Prediction-market frames (price_change, best_bid_ask, last_trade_price,
    book, control messages) from the prediction rows of ``events``."""
    c = events_to_canonical(events, keep=("event_type", "value", "k")).filter(F.col("venue") == "polymarket")
    seq, us, k = F.col("seq"), F.col("event_us"), F.col("k")
    asset = F.when(F.pmod(seq, F.lit(19)) == 0, F.lit("unknown-asset")).otherwise(F.col("asset_id"))
    ts_txt = epoch_text(us)
    alias = F.pmod(seq, F.lit(4))
    change = F.to_json(F.struct(
        F.when(alias == 0, asset).alias("asset_id"), F.when(alias == 1, asset).alias("assetId"),
        F.when(alias == 2, asset).alias("asset"), F.when(alias == 3, asset).alias("token_id"),
        F.when(F.pmod(seq, F.lit(3)) == 0, _num_text(F.col("bid"))).alias("bid"),
        F.when(F.pmod(seq, F.lit(3)) != 0, _num_text(F.col("bid"))).alias("best_bid"),
        _num_text(F.col("ask")).alias("best_ask"), F.col("value").cast("string").alias("price"),
        ts_txt.alias("timestamp")))
    price_change = F.concat(F.lit('{"event_type":"price_change","market":"'), F.col("condition_id"),
                            F.lit('","price_changes":['), change, F.lit("]}"))
    bba = F.to_json(F.struct(F.lit("best_bid_ask").alias("event_type"), asset.alias("asset_id"),
                             _num_text(F.col("bid")).alias("best_bid"), F.col("ask").alias("best_ask"),
                             ts_txt.alias("timestamp")))
    ltp = F.to_json(F.struct(
        F.lit("last_trade_price").alias("event_type"), asset.alias("asset_id"),
        F.when(F.pmod(seq, F.lit(3)) != 0, _num_text(F.col("price"))).alias("price"),
        F.when(F.pmod(seq, F.lit(3)) == 0, _num_text(F.col("price"))).alias("last_trade_price"),
        _num_text(k.cast("double")).alias("size"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.lit("buy")).otherwise(F.lit(" sell ")).alias("side"),
        ts_txt.alias("timestamp")))
    v = F.col("value")
    obj_levels_b = F.array(F.struct((v - 1).cast("string").alias("price")), F.struct((v - 0.5).cast("string").alias("price")))
    obj_levels_a = F.array(F.struct((v + 1).cast("string").alias("price")), F.struct((v + 0.5).cast("string").alias("price")))
    book_obj = F.to_json(F.struct(F.lit("book").alias("event_type"), asset.alias("asset_id"),
                                  F.when(F.pmod(seq, F.lit(7)) == 0, F.array().cast("array<struct<price:string>>"))
                                   .otherwise(obj_levels_b).alias("bids"),
                                  obj_levels_a.alias("asks"), ts_txt.alias("timestamp")))
    arr_levels_b = F.array(F.array((v - 1).cast("string"), F.lit("5")), F.array((v - 0.5).cast("string"), F.lit("5")))
    arr_levels_a = F.array(F.array((v + 1).cast("string"), F.lit("5")), F.array((v + 0.5).cast("string"), F.lit("5")))
    book_arr = F.to_json(F.struct(F.lit("book").alias("event_type"), asset.alias("asset_id"),
                                  arr_levels_b.alias("bids"), arr_levels_a.alias("asks"), ts_txt.alias("timestamp")))
    book = F.concat(F.lit("["), F.when(F.pmod(seq, F.lit(3)) == 0, book_arr).otherwise(book_obj), F.lit("]"))
    junk = (F.when(F.pmod(seq, F.lit(4)) == 0, F.lit('{"event_type":"pong"}'))
             .when(F.pmod(seq, F.lit(4)) == 1, F.lit('[{"type":"status","asset_id":"x"}, 7]'))
             .when(F.pmod(seq, F.lit(4)) == 2, F.lit('{"event_type":"tick_size_change","asset_id":"x"}'))
             .otherwise(F.lit("garbage")))
    et = F.col("event_type")
    value = (F.when(et == "click", price_change).when(et == "view", bba).when(et == "purchase", ltp)
              .when(et == "signup", book).otherwise(junk))
    return land(c.select("seq", (F.col("recv_s") * F.lit(1_000_000)).alias("recv_us"), F.lit("polymarket").alias("venue"),
                         value.alias("value")))
