"""Snapshot rows -> ingest batches (chunking, envelopes, validation).

Rows are numbered per (source, market) in time order with a two-level
scheme: row counts per (source, market, day) give day offsets (a small
table), and ``row_number`` runs only inside one (source, market, day)
window partition -- no task ever sorts a whole market's history.  Chunks
of ``size`` rows then follow from the global position; batch ids are
content-derived (re-ingesting the same rows yields the same ids).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketfold.functions import constants as C
from marketfold.functions.exprs import parse_iso8601, strip_ws, utc_date


def snapshot_row_json(snapshots: DataFrame) -> DataFrame:
    """Typed dense snapshots -> the collector's untyped row text (28 keys;
    masked venue columns are ``""``, unset gauges ``null``, unset text
    gauges ``""``).  Adds ``row_json`` next to ``market_key, venue,
    snapshot_ts, ts_utc``."""
    spot = F.col("venue") == C.SPOT_VENUE

    def jstr(c):
        t = F.to_json(F.array(F.col(c) if isinstance(c, str) else c))
        return F.regexp_extract(t, "^\\[(.*)\\]$", 1)

    def jnum(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("null"))

    def masked_num(c, own_spot: bool):
        own = spot if own_spot else ~spot
        return F.when(own, jnum(c)).otherwise(F.lit('""'))

    def masked_text(c, own_spot: bool):
        own = spot if own_spot else ~spot
        return F.when(own, jstr(F.coalesce(F.col(c), F.lit("")))).otherwise(F.lit('""'))

    parts = [
        ("ts_utc", jstr("ts_utc")), ("market_key", jstr("market_key")), ("venue", jstr("venue")),
        ("snapshot_interval_s", jnum("snapshot_interval_s")), ("msg_count_1s", jnum("msg_count_1s")),
        ("trade_count_1s", jnum("trade_count_1s")), ("book_update_count_1s", jnum("book_update_count_1s")),
        ("dropped_events_1s", jnum("dropped_events_1s")),
        ("last_event_ts_utc", jstr(F.coalesce(F.col("last_event_ts_utc"), F.lit("")))),
        ("stale_ms", F.coalesce(F.col("stale_ms").cast("string"), F.lit('""'))),
        ("best_bid", masked_num("best_bid", True)), ("best_ask", masked_num("best_ask", True)),
        ("mid", masked_num("mid", True)), ("spread_bps", masked_num("spread_bps", True)),
        ("last_trade_px", masked_num("last_trade_px", True)), ("last_trade_size", masked_num("last_trade_size", True)),
        ("last_trade_side", masked_text("last_trade_side", True)),
        ("slug", masked_text("slug", False)), ("bucket_start_ts", masked_num("bucket_start_ts", False)),
        ("condition_id", masked_text("condition_id", False)),
        ("yes_best_bid", masked_num("yes_best_bid", False)), ("yes_best_ask", masked_num("yes_best_ask", False)),
        ("yes_mid", masked_num("yes_mid", False)), ("no_best_bid", masked_num("no_best_bid", False)),
        ("no_best_ask", masked_num("no_best_ask", False)), ("no_mid", masked_num("no_mid", False)),
        ("last_trade_px_yes", masked_num("last_trade_px_yes", False)),
        ("last_trade_px_no", masked_num("last_trade_px_no", False)),
    ]
    pieces = []
    for i, (k, v) in enumerate(parts):
        pieces += [F.lit(("{" if i == 0 else ",") + '"' + k + '":'), v]
    pieces.append(F.lit("}"))
    return snapshots.select("market_key", "venue", "snapshot_ts", "ts_utc", F.concat(*pieces).alias("row_json"))


def number_rows(df: DataFrame, keys: list[str], ts_col: str, day_seconds: int = 86400,
                tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Add ``rn`` (1-based position per ``keys`` in ``(ts_col, *tiebreak)``
    order; ``ts_col`` in epoch seconds) with bounded window partitions (one
    day per partition)."""
    d = df.withColumn("_day", F.floor(F.col(ts_col) / F.lit(day_seconds)).cast("bigint"))
    counts = d.groupBy(*keys, "_day").agg(F.count(F.lit(1)).alias("_n"))
    w_days = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_day", F.coalesce(F.sum("_n").over(w_days), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*keys, "_day").orderBy(ts_col, *tiebreak)
    d = d.withColumn("_rn_day", F.row_number().over(w))
    return d.join(offsets, [*keys, "_day"], "left").withColumn("rn", F.col("_off") + F.col("_rn_day")) \
            .drop("_day", "_off", "_rn_day")


def chunk_batches(rows: DataFrame, size: int = C.INGEST_BATCH_SIZE, keys=("venue", "market_key"),
                  ts_col: str = "snapshot_ts", tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Assign ``batch_no`` / ``batch_id`` / envelope fields to every row."""
    keys = list(keys)
    n = number_rows(rows, keys, ts_col, tiebreak=tiebreak)
    n = n.withColumn("batch_no", F.floor((F.col("rn") - 1) / F.lit(int(size))).cast("bigint"))
    w = Window.partitionBy(*keys, "batch_no")
    first_ts = F.min_by(F.col("ts_utc"), F.col("rn")).over(w)
    n = n.withColumn("batch_first_ts", first_ts)
    n = n.withColumn("batch_id", F.sha2(F.concat_ws("|", *[F.col(k) for k in keys], F.col("batch_first_ts"),
                                                    F.col("batch_no").cast("string")), 256))
    return n.withColumn("snapshot_date", F.substring(F.col("batch_first_ts"), 1, 10))


def batch_envelopes(batched: DataFrame) -> DataFrame:
    """One row per batch: id, source, market, date, row count, first/last ts."""
    return batched.groupBy("batch_id", F.col("venue").alias("source"), "market_key", "snapshot_date", "batch_no").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("ts_utc").alias("first_ts"), F.max("ts_utc").alias("last_ts")
    ).withColumnRenamed("market_key", "market")


def validate_batches(batched: DataFrame, declared_source: str = "declared_source",
                     declared_market: str = "declared_market") -> DataFrame:
    """Homogeneity check per batch: every row must carry the batch's source
    and market.  Output: (batch_id, source, market, row_count, status,
    error) with the first offending row (in batch order) in the message."""
    bad = (strip_ws(F.coalesce(F.col("venue"), F.lit(""))) != F.col(declared_source)) | \
          (strip_ws(F.coalesce(F.col("market_key"), F.lit(""))) != F.col(declared_market))
    agg = batched.groupBy("batch_id", F.col(declared_source).alias("source"), F.col(declared_market).alias("market")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min_by(F.struct(strip_ws(F.coalesce(F.col("venue"), F.lit(""))).alias("s"),
                          strip_ws(F.coalesce(F.col("market_key"), F.lit(""))).alias("m")),
                 F.when(bad, F.col("rn"))).alias("first_bad"))
    err = F.when(F.col("first_bad").isNotNull(), F.concat(
        F.lit("mixed_snapshot_batch_detected:expected_source="), F.col("source"),
        F.lit(",expected_market="), F.col("market"), F.lit(",actual_source="), F.col("first_bad.s"),
        F.lit(",actual_market="), F.col("first_bad.m")))
    return agg.select("batch_id", "source", "market", "row_count",
                      F.when(err.isNull(), F.lit("accepted")).otherwise(F.lit("rejected")).alias("status"),
                      err.alias("error"))


def batch_defaults(envelopes: DataFrame) -> DataFrame:
    """Envelope fields (batch_id, source, market, snapshot_date, first_row,
    row_count; any of them blank) with their defaults: the first row's venue,
    market and date, else ``unknown`` and today.  A batch without rows is
    ``skipped``, one without an id is an ``error``.  ``first_row``: struct of
    venue, market_key, ts_utc."""
    def text(c):
        return strip_ws(F.coalesce(c, F.lit("")))

    def first_of(*columns):
        return F.coalesce(*[F.when(text(c) != "", text(c)) for c in columns])
    own_date = utc_date(parse_iso8601(F.col("first_row.ts_utc")))
    today = F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    status = F.when(F.coalesce("row_count", F.lit(0)) == 0, F.lit("skipped")).when(text(F.col("batch_id")) == "", F.lit("error")).otherwise(F.lit("accepted"))
    return envelopes.select(
        text(F.col("batch_id")).alias("batch_id"), F.coalesce(first_of(F.col("source"), F.col("first_row.venue")), F.lit("unknown")).alias("source"),
        F.coalesce(first_of(F.col("market"), F.col("first_row.market_key")), F.lit("unknown")).alias("market"),
        F.coalesce(first_of(F.col("snapshot_date")), own_date, today).alias("snapshot_date"), "row_count", status.alias("status"),
        F.when(status == "error", F.lit("batch_id_required")).alias("error"))
