"""Canonical event table and the deterministic adapter from ``events``.

Canonical events (one wide, sparse row per feed event):

``seq BIGINT`` arrival order, ``recv_s BIGINT`` arrival second,
``venue``, ``market_key``, ``kind`` (heartbeat | quote | trade | book_update |
book_snapshot | status | meta), ``event_us BIGINT`` event time in epoch
microseconds (``event_ts`` DOUBLE seconds is derived), ``product_id``,
``bid``, ``ask``, ``last_trade_px``, ``price``, ``size`` DOUBLE, ``side``,
``trade_side``, ``asset_id``, ``slug``, ``bucket_start_ts BIGINT``,
``condition_id``.

The adapter maps the driver's ``events`` table onto that shape with pure
column expressions, so the same mapping is written once more in SQL for
the DuckDB oracle (see ``plans/oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.functions import constants as C
from marketfold.functions.exprs import epoch_whole_seconds

CANONICAL_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("pos", T.LongType()),
    T.StructField("recv_s", T.LongType()),
    T.StructField("venue", T.StringType()),
    T.StructField("market_key", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("event_us", T.LongType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("bid", T.DoubleType()),
    T.StructField("ask", T.DoubleType()),
    T.StructField("last_trade_px", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("size", T.DoubleType()),
    T.StructField("side", T.StringType()),
    T.StructField("trade_side", T.StringType()),
    T.StructField("asset_id", T.StringType()),
    T.StructField("slug", T.StringType()),
    T.StructField("bucket_start_ts", T.LongType()),
    T.StructField("condition_id", T.StringType()),
])

CANONICAL_COLUMNS = [f.name for f in CANONICAL_SCHEMA.fields]

# Adapter: user_id % 4 picks the market in this order.
ADAPTER_MARKET_ORDER = ("cb-btcusd", "cb-ethusd", "pm-btc", "pm-eth")
# Adapter: event_type -> kind.
ADAPTER_KIND = {"purchase": "trade", "click": "book_update", "view": "quote",
                "signup": "heartbeat", "error": "status"}


def markets_frame(spark: SparkSession) -> DataFrame:
    """The market universe as a dimension (4 rows here; any N works)."""
    return local_rows(spark, C.MARKETS, ("market_key", "venue", "instrument"))


def local_rows(spark: SparkSession, rows, names) -> DataFrame:
    """Small constant table as a JVM-side local relation (no Python RDD)."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _k(props) -> F.Column:
    return F.from_json(props, "k INT").getField("k")


def _kind(event_type) -> F.Column:
    out = F.lit(None).cast("string")
    for src, dst in ADAPTER_KIND.items():
        out = F.when(event_type == src, F.lit(dst)).otherwise(out)
    return out


def events_to_canonical(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``events(event_id, ts, user_id, event_type, value, props)`` ->
    canonical events.  Projection only: no shuffle, fully codegen'd.

    Written as two projections so that the per-row parses (``props`` JSON,
    epoch conversion, market pick) are computed once and referenced, not
    inlined into every CASE branch.  ``keep`` passes source columns
    (``event_type``, ``value``, ``k``) through for frame synthesis."""
    base = events.select(
        "event_id", "event_type", "value",
        F.element_at(F.array(*[F.lit(m) for m in ADAPTER_MARKET_ORDER]),
                     (F.pmod(F.col("user_id"), F.lit(4)) + 1).cast("int")).alias("mk"),
        _k(F.col("props")).alias("k"),
        epoch_whole_seconds(F.col("ts")).alias("es"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
    )
    base = base.withColumn("bucket", F.col("es") - F.pmod(F.col("es"), F.lit(C.SLUG_BUCKET_SECONDS)))
    base = base.withColumn("is_spot", F.col("mk").startswith("cb-"))
    base = base.withColumn("pside", F.when(F.pmod(F.col("event_id"), F.lit(2)) == 0, F.lit("yes")).otherwise(F.lit("no")))
    mk, k, is_spot = F.col("mk"), F.col("k"), F.col("is_spot")
    prefix = F.when(mk == "pm-btc", F.lit(C.SLUG_PREFIX["btc"])).otherwise(F.lit(C.SLUG_PREFIX["eth"]))
    base = base.withColumn("slug0", F.concat_ws("-", prefix, F.col("bucket").cast("string")))
    kind = _kind(F.col("event_type"))
    quoteish = F.col("event_type").isin("click", "view")
    spot_side = (F.when(F.pmod(k, F.lit(5)) == 0, F.lit(""))
                 .when(F.pmod(k, F.lit(2)) == 0, F.lit("buy")).otherwise(F.lit("SELL")))
    side = F.when(is_spot, spot_side).otherwise(F.col("pside"))
    is_trade = F.col("event_type") == "purchase"
    return base.select(
        F.col("event_id").alias("seq"),
        F.lit(0).cast("bigint").alias("pos"),
        F.col("es").alias("recv_s"),
        F.when(is_spot, F.lit(C.SPOT_VENUE)).otherwise(F.lit(C.PREDICTION_VENUE)).alias("venue"),
        mk.alias("market_key"),
        kind.alias("kind"),
        F.col("us").alias("event_us"),
        F.when(mk == "cb-btcusd", F.lit("BTC-USD")).when(mk == "cb-ethusd", F.lit("ETH-USD")).alias("product_id"),
        F.when(quoteish & (F.pmod(F.col("event_id"), F.lit(10)) != 0), F.col("value") - 0.5).alias("bid"),
        F.when(quoteish & (F.pmod(F.col("event_id"), F.lit(10)) != 1), F.col("value") + 0.5).alias("ask"),
        F.when((F.col("event_type") == "view") & (F.pmod(k, F.lit(3)) == 0), F.col("value") * 2.0).alias("last_trade_px"),
        F.when(is_trade, F.col("value")).alias("price"),
        F.when(is_trade & (F.pmod(k, F.lit(7)) != 0), k / F.lit(10.0)).alias("size"),
        side.alias("side"),
        F.when(~is_spot & is_trade, F.when(F.pmod(k, F.lit(2)) == 0, F.lit("BUY")).otherwise(F.lit("SELL"))).alias("trade_side"),
        F.when(~is_spot, F.concat_ws("-", mk, F.col("pside"), F.col("bucket").cast("string"))).alias("asset_id"),
        F.when(~is_spot, F.col("slug0")).alias("slug"),
        F.when(~is_spot, F.col("bucket")).alias("bucket_start_ts"),
        F.when(~is_spot, F.concat(F.lit("0x"), F.sha2(F.col("slug0"), 256))).alias("condition_id"),
        *[F.col(c) for c in keep],
    )


def conform(df: DataFrame) -> DataFrame:
    """Project any event-shaped frame onto the canonical column set
    (missing columns are NULL, types cast)."""
    cols = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in cols else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in CANONICAL_SCHEMA.fields])


def events_to_drop_notices(events: DataFrame) -> DataFrame:
    """Feed drop counters derived from ``error`` events: one notice per
    error, ``n = k % 4 - 1`` (so negative notices exist and are clipped by
    the merge).  Shape: ``(market_key, recv_s, n)``."""
    e = events.select("event_id", "ts", "user_id", "event_type", "props").filter(F.col("event_type") == "error")
    mk = F.element_at(F.array(*[F.lit(m) for m in ADAPTER_MARKET_ORDER]),
                      (F.pmod(F.col("user_id"), F.lit(4)) + 1).cast("int"))
    return e.select(mk.alias("market_key"), epoch_whole_seconds(F.col("ts")).alias("recv_s"),
                    (F.pmod(_k(F.col("props")), F.lit(4)) - 1).cast("bigint").alias("n"))
