"""Silver normalisation: untyped snapshot rows -> fixed 30-column schema.

One ``select`` of column expressions over a VARIANT read (no UDF), so JSON
numbers, booleans and text are told apart: blank/whitespace -> NULL;
unparsable float -> NULL; unparsable int -> 0; numbers truncate to ints;
``ts_utc`` mandatory (a batch with any row lacking it is quarantined with
``silver_row_missing_ts_utc``); date/source/market come from the batch,
not from the row; ``snapshot_hour`` from the row's ``ts_utc``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.functions import constants as C
from marketfold.functions import exprs as X

RAW_KEYS = ("ts_utc", "market_key", "venue", "snapshot_interval_s", "msg_count_1s", "trade_count_1s",
            "book_update_count_1s", "dropped_events_1s", "last_event_ts_utc", "stale_ms", "best_bid",
            "best_ask", "mid", "spread_bps", "last_trade_px", "last_trade_size", "last_trade_side", "slug",
            "bucket_start_ts", "condition_id", "yes_best_bid", "yes_best_ask", "yes_mid", "no_best_bid",
            "no_best_ask", "no_mid", "last_trade_px_yes", "last_trade_px_no")

SILVER_SCHEMA = T.StructType([
    T.StructField("snapshot_date", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("market", T.StringType(), False),
    T.StructField("snapshot_hour", T.IntegerType()),
    T.StructField("ts_utc", T.TimestampType(), False),
    T.StructField("last_event_ts_utc", T.TimestampType()),
    T.StructField("bucket_start_ts_utc", T.TimestampType()),
    T.StructField("snapshot_interval_s", T.IntegerType(), False),
    *[T.StructField(c, T.LongType(), False) for c in ("msg_count_1s", "trade_count_1s", "book_update_count_1s",
                                                         "dropped_events_1s")],
    *[T.StructField(c, T.DoubleType()) for c in ("stale_ms", "best_bid", "best_ask", "mid", "spread_bps",
                                                  "last_trade_px", "last_trade_size")],
    *[T.StructField(c, T.StringType()) for c in ("last_trade_side", "slug", "condition_id")],
    *[T.StructField(c, T.DoubleType()) for c in ("yes_best_bid", "yes_best_ask", "yes_mid", "no_best_bid",
                                                  "no_best_ask", "no_mid", "last_trade_px_yes", "last_trade_px_no")],
])

_FLOATS = ("stale_ms", "best_bid", "best_ask", "mid", "spread_bps", "last_trade_px", "last_trade_size",
           "yes_best_bid", "yes_best_ask", "yes_mid", "no_best_bid", "no_best_ask", "no_mid",
           "last_trade_px_yes", "last_trade_px_no")
_COUNTS = ("msg_count_1s", "trade_count_1s", "book_update_count_1s", "dropped_events_1s")


def parse_row_text(df: DataFrame, col: str = "row_json", keys: tuple[str, ...] = tuple(RAW_KEYS)) -> DataFrame:
    """Row text -> per key ``raw_<key>`` (its text) and ``kind_<key>``
    (``s`` text, ``n`` number, ``b`` boolean, NULL otherwise), so that the
    number 1.0 and the text "1.0" stay apart."""
    df = df.withColumn("_v", F.try_parse_json(F.col(col)))
    df = df.select("*", *[F.try_variant_get("_v", f"$.{k}", "variant").alias(f"_v_{k}") for k in keys]).drop("_v")
    out = [F.col(c) for c in df.columns if not c.startswith("_v_")]
    for k in keys:
        t = F.schema_of_variant(F.col(f"_v_{k}"))
        kind = F.when(t == "STRING", F.lit("s")).when(t == "BOOLEAN", F.lit("b")).when(
            t.isin("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE") | t.startswith("DECIMAL"), F.lit("n"))
        out += [F.try_variant_get(F.col(f"_v_{k}"), "$", "string").alias(f"raw_{k}"), kind.alias(f"kind_{k}")]
    return df.select(*out)


def silver_columns(include_hour: bool = True, date="snapshot_date", source="source", market="market") -> list:
    """The 30 typed Silver columns over ``raw_*`` / ``kind_*`` columns."""
    def read(coerce, key):
        return coerce(F.col(f"raw_{key}"), F.col(f"kind_{key}"))
    ts = read(X.silver_timestamp, "ts_utc")
    out = [F.col(date).cast("string").alias("snapshot_date"), F.col(source).cast("string").alias("source"),
           F.col(market).cast("string").alias("market"),
           (F.hour(ts) if include_hour else F.lit(None)).cast("int").alias("snapshot_hour"),
           ts.alias("ts_utc"),
           read(X.silver_timestamp, "last_event_ts_utc").alias("last_event_ts_utc"),
           read(X.silver_epoch_seconds, "bucket_start_ts").alias("bucket_start_ts_utc"),
           read(X.silver_int, "snapshot_interval_s").cast("int").alias("snapshot_interval_s")]
    out += [read(X.silver_int, c).alias(c) for c in _COUNTS]
    for name in SILVER_SCHEMA.fieldNames()[12:]:
        out.append(read(X.silver_float if name in _FLOATS else X.silver_text, name).alias(name))
    return out


def normalize(rows: DataFrame, include_hour: bool = True, keep: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """``raw_*`` rows with batch columns ``snapshot_date, source, market`` ->
    Silver rows (+ ``keep`` columns)."""
    return rows.select(*[F.col(k) for k in keep], *silver_columns(include_hour))


def with_batch_check(silver: DataFrame) -> DataFrame:
    """Add ``bad``: some row of the batch lacks a parsable ``ts_utc`` (window
    per batch: bounded by the batch size)."""
    return silver.withColumn("bad", F.max(F.col("ts_utc").isNull()).over(Window.partitionBy("batch_id")))


def split_valid(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined batches); a batch goes as a whole.  Rows
    that were checked before (``with_batch_check``) are not checked again."""
    flagged = silver if "bad" in silver.columns else with_batch_check(silver)
    rejected = (flagged.filter("bad").groupBy("batch_id", "snapshot_date", "source", "market")
                .agg(F.count(F.lit(1)).alias("row_count"))
                .withColumn("error", F.lit("silver_row_missing_ts_utc")))
    return flagged.filter(~F.col("bad")).drop("bad"), rejected


def batch_hours(rows: DataFrame, col: str = "row_json") -> DataFrame:
    """(batch_id, snapshot_date, source, market, hour) per batch: where its
    files go, from the one key of the row text that decides it."""
    ts = X.silver_timestamp(F.col("raw_ts_utc"), F.col("kind_ts_utc"))
    return parse_row_text(rows, col, ("ts_utc",)).groupBy("batch_id", "snapshot_date", "source", "market").agg(F.min_by(F.hour(ts), F.col("rn")).alias("hour"))


def partition_hour(silver: DataFrame, placement: str = "first_row") -> DataFrame:
    """``hour`` partition value: the hour of the batch's first row (smallest
    ``rn``) for all of its rows (``first_row``, as the upstream writer places
    files), or each row's own hour (``per_row``)."""
    if placement == "per_row":
        return silver.withColumn("hour", F.col("snapshot_hour"))
    w = Window.partitionBy("batch_id")
    return silver.withColumn("hour", F.min_by(F.col("snapshot_hour"), F.col("rn")).over(w))


def _hour_seg(h) -> F.Column:
    return F.when(h.isNotNull(), F.format_string("%02d", h))


def bronze_path(date, source, market, batch_id) -> F.Column:
    return F.concat(F.lit("raw/ndjson-zstd/date="), date, F.lit("/source="), source, F.lit("/market="), market,
                    F.lit("/"), batch_id, F.lit(".ndjson.zst"))


def silver_path(batch_id, date, source, market, hour) -> F.Column:
    return F.concat_ws("/", F.concat(F.lit("silver/parquet/date="), date), F.concat(F.lit("source="), source),
                       F.concat(F.lit("market="), market), F.when(hour.isNotNull(), F.concat(F.lit("hour="), _hour_seg(hour))),
                       F.concat(batch_id, F.lit(".parquet")))


def export_relpath(batch_id, date, source, market, hour) -> F.Column:
    return F.concat_ws("/", date, source, market, _hour_seg(hour), F.concat(batch_id, F.lit(".parquet")))


def staged_path(relpath) -> F.Column:
    """Outer slashes stripped, backslashes turned into slashes."""
    cleaned = F.regexp_replace(F.regexp_replace(relpath, "^/+|/+$", ""), "\\\\", "/")
    return F.concat(F.lit("relay/payloads/"), cleaned)


def manifest_path(export_id) -> F.Column:
    return F.concat(F.lit("relay/manifests/"), export_id, F.lit(".json"))
