"""Dense interval snapshots (flagship).

Semantics (one row per known market per interval boundary ``T``):

* interval ``T`` covers events that *arrived* in ``[T - i, T)``;
* counters (messages, trades, book updates, dropped) reset every interval;
* gauges carry forward the last non-NULL value in arrival (``seq``) order
  and are never cleared; mid / spread are derived from the carried sides;
* every market of the universe emits every boundary of the run window,
  including boundaries without events (counters 0, gauges carried);
* spot columns are NULL on prediction rows and vice versa.

Plan shape (what ``explain`` shows):

1. canonical events ⋈ markets (broadcast only when the planner's size
   check allows) -> project measures -> UNION drop notices and the grid;
2. ``groupBy(market, block, T)`` with map-side partial aggregation
   (``count``/``sum``/``max_by`` are all partial-capable, so a hot market
   is combined before the shuffle);
3. in-block carry: window ``partitionBy(market, block).orderBy(T)`` -- a
   block is ``i * floor(86400 / i)`` seconds, so every window partition is
   bounded by one day of boundaries whatever the history length;
4. carry across blocks: the last value of every earlier block, computed
   on the (markets x days) summary, joined back on ``(market, block)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketfold.functions import constants as C
from marketfold.session import cut_lineage
from marketfold.functions.exprs import compute_mid, compute_spread_bps, iso_utc_from_epoch, iso_utc_from_micros, strip_ws

DAY = 86400


def block_seconds(interval_s: int) -> int:
    return int(interval_s) * max(1, DAY // int(interval_s))


def boundary_of(recv_s, interval_s: int) -> F.Column:
    """Arrival second -> the boundary ``T`` that reports it: ``[T-i, T)``."""
    i = F.lit(int(interval_s))
    return recv_s - F.pmod(recv_s, i) + i


@dataclass(frozen=True)
class Gauge:
    name: str
    value: F.Column
    cond: F.Column


def _gauges() -> list[Gauge]:
    """Gauge inputs over a row that already has ``kind_n`` / ``side_n``
    (lower-cased, trimmed) and the market's venue ``m_venue``."""
    kind = F.col("kind_n")
    spot = F.col("m_venue") == C.SPOT_VENUE
    pred = F.col("m_venue") == C.PREDICTION_VENUE
    trade = kind == "trade"
    meta = kind == "meta"
    event = ~meta
    yes, no = F.col("side_n") == "yes", F.col("side_n") == "no"
    arrival_us = F.coalesce(F.col("event_us"), F.col("recv_s") * F.lit(1_000_000))
    return [
        Gauge("best_bid", F.col("bid"), spot & event),
        Gauge("best_ask", F.col("ask"), spot & event),
        Gauge("last_trade_px", F.when(trade, F.col("price")).otherwise(F.col("last_trade_px")), spot & event),
        Gauge("last_trade_size", F.col("size"), spot & trade),
        Gauge("last_trade_side", F.upper(F.col("side_t")), spot & trade),
        Gauge("yes_best_bid", F.col("bid"), pred & event & yes),
        Gauge("yes_best_ask", F.col("ask"), pred & event & yes),
        Gauge("no_best_bid", F.col("bid"), pred & event & no),
        Gauge("no_best_ask", F.col("ask"), pred & event & no),
        Gauge("last_trade_px_yes", F.col("price"), pred & trade & yes),
        Gauge("last_trade_px_no", F.col("price"), pred & trade & no),
        Gauge("slug", F.col("slug"), pred & (meta | (F.coalesce(F.col("slug"), F.lit("")) != ""))),
        Gauge("bucket_start_ts", F.col("bucket_start_ts"), pred),
        Gauge("condition_id", F.col("condition_id"), pred & (meta | (F.coalesce(F.col("condition_id"), F.lit("")) != ""))),
        Gauge("last_event_us", arrival_us, event),
    ]


GAUGE_NAMES = ["best_bid", "best_ask", "last_trade_px", "last_trade_size", "last_trade_side",
               "yes_best_bid", "yes_best_ask", "no_best_bid", "no_best_ask", "last_trade_px_yes",
               "last_trade_px_no", "slug", "bucket_start_ts", "condition_id", "last_event_us"]
_EVENT_COLS = ["seq", "pos", "recv_s", "kind", "event_us", "bid", "ask", "last_trade_px", "price", "size", "side",
               "slug", "bucket_start_ts", "condition_id"]


def run_window(canonical: DataFrame, interval_s: int, drops: DataFrame | None = None) -> tuple[int, int]:
    """First and last boundary touched by the input: one scalar aggregate."""
    src = canonical.select("recv_s")
    if drops is not None:
        src = src.unionByName(drops.select("recv_s"))
    row = src.agg(F.min("recv_s").alias("lo"), F.max("recv_s").alias("hi")).first()
    if row is None or row["lo"] is None:
        return 0, -1
    i = int(interval_s)
    lo = int(row["lo"]) - int(row["lo"]) % i + i
    hi = int(row["hi"]) - int(row["hi"]) % i + i
    return lo, hi


def grid_blocks(markets: DataFrame, lo: int, hi: int, interval_s: int) -> DataFrame:
    """(market_key, m_venue, block) for every block of the run window."""
    b = block_seconds(interval_s)
    return markets.select(F.col("market_key"), F.col("venue").alias("m_venue"),
                          F.explode(F.sequence(F.lit(lo // b), F.lit(hi // b))).alias("block"))


def boundary_grid(markets: DataFrame, lo: int, hi: int, interval_s: int, parts: int | None = None) -> DataFrame:
    """(market_key, m_venue, block, snap_ts) for every boundary in [lo, hi].

    Generated per (market, block) so no task explodes more than one day of
    boundaries, and without any join: each market row explodes its own
    block ids, the (market, block) rows are spread over ``parts`` tasks
    (an explicit count, so the adaptive planner does not fold the tiny
    block table back into one task), then each explodes its boundaries."""
    i, b = int(interval_s), block_seconds(interval_s)
    blocks = grid_blocks(markets, lo, hi, interval_s)
    n = parts or int(markets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks.repartition(max(1, n), "market_key", "block")
    # b is a multiple of i, so every block starts on a boundary.
    start = F.greatest(F.lit(lo), F.col("block") * F.lit(b))
    end = F.least(F.lit(hi), F.col("block") * F.lit(b) + F.lit(b - i))
    return blocks.select("market_key", "m_venue", "block",
                         F.explode(F.sequence(start.cast("bigint"), end.cast("bigint"), F.lit(i).cast("bigint"))).alias("snap_ts"))


def interval_aggregates(canonical: DataFrame, markets: DataFrame, interval_s: int,
                        drops: DataFrame | None = None, gauges: tuple[str, ...] = tuple(GAUGE_NAMES),
                        not_before: int | None = None, with_order: bool = False, late_at: int | None = None) -> DataFrame:
    """Per (market, boundary) counters and last-in-interval gauge values.

    The last value is that of the latest arrival second; inside a second a
    ``meta`` row comes ahead of the feed rows, which go by ``(seq, pos)``.
    ``not_before``: rows that arrive for an earlier boundary count in this
    one (late rows of a stream), as arrived in second ``late_at`` at the
    earliest.  ``with_order`` adds per gauge the order key of its value, so
    that partial results can be merged."""
    feed = canonical.select("market_key", *_EVENT_COLS, F.lit("e").alias("row_type"), F.lit(None).cast("bigint").alias("n"))
    if drops is not None:
        feed = feed.unionByName(drops.select("market_key", "recv_s", F.col("n").cast("bigint"), F.lit("d").alias("row_type")), allowMissingColumns=True)
    return feed_aggregates(feed, markets, interval_s, gauges, not_before, with_order, late_at)


def feed_aggregates(feed: DataFrame, markets: DataFrame, interval_s: int, gauges: tuple[str, ...] = tuple(GAUGE_NAMES),
                    not_before: int | None = None, with_order: bool = False, late_at: int | None = None) -> DataFrame:
    """``interval_aggregates`` of rows that are one feed already: events
    (``row_type`` e) and drop notices (d, with ``n``), read once."""
    b = block_seconds(interval_s)
    mk = markets.select("market_key", F.col("venue").alias("m_venue"))
    rows = feed.filter(F.col("row_type").isin("e", "d")).select("market_key", *_EVENT_COLS, "row_type", "n").join(mk, "market_key", "inner")
    rows = rows.withColumn("snap_ts", boundary_of(F.col("recv_s"), interval_s)).withColumn("arrived", F.col("recv_s"))
    if not_before is not None:
        if late_at is not None:
            rows = rows.withColumn("arrived", F.when(F.col("snap_ts") < int(not_before), F.greatest(F.col("recv_s"), F.lit(int(late_at)).cast("bigint")))
                                   .otherwise(F.col("recv_s")))
        rows = rows.withColumn("snap_ts", F.greatest(F.col("snap_ts"), F.lit(int(not_before)).cast("bigint")))
    rows = rows.withColumn("block", F.floor(F.col("snap_ts") / F.lit(b)).cast("bigint"))
    # Kind and side are trimmed and folded to lower case here, once per row.
    rows = rows.withColumn("side_t", strip_ws(F.coalesce(F.col("side"), F.lit(""))))
    rows = (rows.withColumn("kind_n", F.when(F.col("row_type") == "e", F.lower(strip_ws(F.coalesce(F.col("kind"), F.lit(""))))))
                .withColumn("side_n", F.lower(F.col("side_t"))))
    is_event = (F.col("row_type") == "e") & (F.col("kind_n") != "meta")
    rows = rows.withColumn("ord", F.struct("arrived", (F.col("kind_n") != "meta").alias("feed"), "seq", F.coalesce(F.col("pos"), F.lit(0)).alias("pos")))
    aggs = [
        F.count(F.when(is_event, F.lit(1))).alias("msg_count_1s"),
        F.count(F.when(is_event & (F.col("kind_n") == "trade"), F.lit(1))).alias("trade_count_1s"),
        F.count(F.when(is_event & F.col("kind_n").isin(*C.BOOK_KINDS), F.lit(1))).alias("book_update_count_1s"),
        F.sum(F.when(F.col("row_type") == "d", F.col("n"))).alias("dropped_raw"),
    ]
    # A gauge is the greatest (order, value) of the rows that set it.  Made inside
    # the aggregate functions: the rows that are sorted hold one order key.
    wanted = [g for g in _gauges() if g.name in gauges]
    last = {g.name: F.when((F.col("row_type") == "e") & g.cond & g.value.isNotNull(), F.struct("ord", g.value.alias("value"))) for g in wanted}
    # The time goes first: rows come about in its order, so they are sorted fast.
    found = rows.groupBy("snap_ts", "market_key", "m_venue", "block").agg(*aggs, *[F.max(last[n]).alias(n) for n in gauges])
    keep = [c for c in found.columns if c not in gauges]
    orders = [F.col(f"{n}.ord").alias(f"{n}__o") for n in gauges] if with_order else []
    return found.select(*keep, *[F.col(f"{n}.value").alias(n) for n in gauges], *orders)


def snapshots_dense(canonical: DataFrame, markets: DataFrame, interval_s: int,
                    drops: DataFrame | None = None, window: tuple[int, int] | None = None,
                    gauges: tuple[str, ...] = tuple(GAUGE_NAMES), run: tuple[int, int] | None = None) -> DataFrame:
    """Dense per-market interval snapshots (typed; blanks are NULL).

    ``window`` (first and last boundary wanted) limits the output only: the
    carried gauges still see the whole history.  ``gauges`` limits which
    gauges are aggregated and carried; the others come out NULL.  ``run``
    (first and last boundary) replaces the span of the given rows."""
    # Two consumers below (in-block carry and the per-block summary): cut
    # the lineage once so the events are aggregated exactly once.  The
    # aggregate is sparse: at most one row per (market, boundary) with events.
    agg = cut_lineage(interval_aggregates(canonical, markets, interval_s, drops, gauges=gauges), "interval_agg")
    # run window = first..last boundary touched, read from the small
    # materialised aggregate instead of another pass over the events
    if run is None:
        row = agg.agg(F.min("snap_ts").alias("lo"), F.max("snap_ts").alias("hi")).first()
        run = (int(row["lo"]), int(row["hi"])) if row and row["lo"] is not None else (0, -1)
    lo, hi = run
    full = densify(agg, markets, lo, hi, interval_s, gauges)
    if window is not None:
        full = full.filter(F.col("snap_ts").between(*window))
    g = {name: F.col(name) if name in gauges else F.lit(None) for name in GAUGE_NAMES}
    return finalize_snapshots(full, g, interval_s)


def densify(agg: DataFrame, markets: DataFrame, lo: int, hi: int, interval_s: int, carried_cols=tuple(GAUGE_NAMES)) -> DataFrame:
    """Sparse per-(market, boundary) aggregates -> one row per market and
    boundary of [lo, hi] with counters and the carried columns."""
    grid = boundary_grid(markets, lo, hi, interval_s).select(
        "market_key", "m_venue", "block", "snap_ts",
        *[F.lit(0).cast("bigint").alias(c) for c in ("msg_count_1s", "trade_count_1s", "book_update_count_1s")],
        F.lit(None).cast("bigint").alias("dropped_raw"),
        F.lit(1).alias("is_grid"))
    # Dense rows: the grid is UNIONed (not joined) with the sparse aggregate;
    # inside each (market, block) window partition a boundary that has an
    # aggregate row sorts before its grid row, the carried gauges flow
    # through both, and the grid row is dropped when its boundary had events.
    rows = agg.withColumn("is_grid", F.lit(0)).unionByName(grid, allowMissingColumns=True)
    w_in = Window.partitionBy("market_key", "block").orderBy("snap_ts", "is_grid")
    w_run = w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = rows.select(
        "market_key", "m_venue", "block", "snap_ts", "msg_count_1s", "trade_count_1s",
        "book_update_count_1s", "dropped_raw", "is_grid",
        F.lag("snap_ts").over(w_in).alias("prev_snap"),
        *[F.last(g, ignorenulls=True).over(w_run).alias(g) for g in carried_cols])
    carried = carried.filter((F.col("is_grid") == 0) | F.col("prev_snap").isNull()
                             | (F.col("prev_snap") != F.col("snap_ts")))

    # Carry across blocks: last value of every block (from the sparse
    # aggregate), then of all earlier blocks -- a (markets x days) table.
    per_block = agg.groupBy("market_key", "block").agg(
        *[F.max_by(F.col(g), F.when(F.col(g).isNotNull(), F.col("snap_ts"))).alias(g) for g in carried_cols])
    w_prev = (Window.partitionBy("market_key").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    per_block = grid_blocks(markets, lo, hi, interval_s).select("market_key", "block").join(
        per_block, ["market_key", "block"], "left")
    carry_in = per_block.select("market_key", "block",
                                *[F.last(g, ignorenulls=True).over(w_prev).alias(f"{g}__in") for g in carried_cols])
    full = carried.join(carry_in, ["market_key", "block"], "left")
    kept = ("market_key", "m_venue", "block", "snap_ts", "msg_count_1s", "trade_count_1s", "book_update_count_1s", "dropped_raw")
    return full.select(*kept, *[F.coalesce(F.col(name), F.col(f"{name}__in")).alias(name) for name in carried_cols])


def finalize_snapshots(df: DataFrame, g: dict, interval_s: int) -> DataFrame:
    spot = F.col("m_venue") == C.SPOT_VENUE
    pred = F.col("m_venue") == C.PREDICTION_VENUE
    last_us = g["last_event_us"]
    snap = F.col("snap_ts")
    stale = F.when(last_us.isNotNull(),
                   F.greatest(F.lit(0.0), (snap - last_us / F.lit(1_000_000.0)) * F.lit(1000.0)))
    side = g["last_trade_side"]

    def spot_only(c):
        return F.when(spot, c)

    def pred_only(c):
        return F.when(pred, c)

    return df.select(
        iso_utc_from_epoch(snap).alias("ts_utc"),
        snap.alias("snapshot_ts"),
        F.col("market_key"),
        F.col("m_venue").alias("venue"),
        F.lit(int(interval_s)).alias("snapshot_interval_s"),
        F.col("msg_count_1s").cast("bigint").alias("msg_count_1s"),
        F.col("trade_count_1s").cast("bigint").alias("trade_count_1s"),
        F.col("book_update_count_1s").cast("bigint").alias("book_update_count_1s"),
        F.greatest(F.lit(0), F.coalesce(F.col("dropped_raw"), F.lit(0))).cast("bigint").alias("dropped_events_1s"),
        iso_utc_from_micros(last_us).alias("last_event_ts_utc"),
        stale.alias("stale_ms"),
        spot_only(g["best_bid"]).alias("best_bid"),
        spot_only(g["best_ask"]).alias("best_ask"),
        spot_only(compute_mid(g["best_bid"], g["best_ask"])).alias("mid"),
        spot_only(compute_spread_bps(g["best_bid"], g["best_ask"])).alias("spread_bps"),
        spot_only(g["last_trade_px"]).alias("last_trade_px"),
        spot_only(g["last_trade_size"]).alias("last_trade_size"),
        spot_only(F.when(side != "", side)).alias("last_trade_side"),
        pred_only(F.when(g["slug"] != "", g["slug"])).alias("slug"),
        pred_only(g["bucket_start_ts"]).cast("bigint").alias("bucket_start_ts"),
        pred_only(F.when(g["condition_id"] != "", g["condition_id"])).alias("condition_id"),
        pred_only(g["yes_best_bid"]).alias("yes_best_bid"),
        pred_only(g["yes_best_ask"]).alias("yes_best_ask"),
        pred_only(compute_mid(g["yes_best_bid"], g["yes_best_ask"])).alias("yes_mid"),
        pred_only(g["no_best_bid"]).alias("no_best_bid"),
        pred_only(g["no_best_ask"]).alias("no_best_ask"),
        pred_only(compute_mid(g["no_best_bid"], g["no_best_ask"])).alias("no_mid"),
        pred_only(g["last_trade_px_yes"]).alias("last_trade_px_yes"),
        pred_only(g["last_trade_px_no"]).alias("last_trade_px_no"),
    )


def merge_drop_counts(feeds: list[DataFrame], markets: DataFrame, interval_s: int) -> DataFrame:
    """Drop counters of several feed drivers, merged per (market, boundary):
    UNION, sum, clip at 0 (a negative total counts as 0).  Unknown markets
    are ignored (left-semi against the universe)."""
    u = feeds[0].select("market_key", "recv_s", "n")
    for f in feeds[1:]:
        u = u.unionByName(f.select("market_key", "recv_s", "n"))
    u = u.join(markets.select("market_key"), "market_key", "left_semi")
    return (u.groupBy("market_key", boundary_of(F.col("recv_s"), interval_s).alias("snapshot_ts"))
             .agg(F.greatest(F.lit(0), F.sum("n")).cast("bigint").alias("dropped_events_1s")))
