"""Streaming dense snapshots: landed feed rows -> one row per market per
completed interval boundary, with nothing lost.

The stream's rows are canonical events, drop notices and clock ticks
(``feed_rows``).  Each micro-batch is folded with the batch operator's own
DataFrame code (``foreachBatch``), never row by row:

1. rows are aggregated per (market, boundary), map-side first; a row that
   arrives late, for a boundary already emitted, counts in the open one;
2. the aggregate is merged with the state, one row per market: the open
   boundary's counters, the carried gauges and the order keys of both;
3. the clock is the latest arrival of any feed row or tick, so every market of
   the universe -- idle, or never seen -- emits every boundary up to the clock;
4. one write makes the micro-batch's folder: completed boundaries
   (``part=done``) and the open one (``part=open``), which is the next state.

Folders are named by the micro-batch and overwritten when Spark replays it
after a failure, so a replay leaves the same data.  A restart resumes from the
checkpoint and the last folder.  ``flush`` gives out the boundary that is still
open when a feed has ended; when the feed goes on after all, that boundary is
open again and comes out once, when it completes.

Every ``COMPACT`` micro-batches the completed rows of the folders but the last
``KEEP`` become one sealed folder and the small ones are deleted, so the number
of files is bounded by the number of sealed folders plus ``COMPACT + KEEP``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.operators.canonical import CANONICAL_SCHEMA
from marketfold.operators.snapshots import GAUGE_NAMES, block_seconds, densify, feed_aggregates, finalize_snapshots, interval_aggregates
from marketfold.sources.files import FileSystem

FEED_SCHEMA = T.StructType([*CANONICAL_SCHEMA.fields, T.StructField("row_type", T.StringType()), T.StructField("n", T.LongType())])
KEEP, COMPACT = 8, 32
_COUNTERS = ("msg_count_1s", "trade_count_1s", "book_update_count_1s", "dropped_raw")
_ORDERS = tuple(f"{g}__o" for g in GAUGE_NAMES)


def feed_rows(events: DataFrame, drops: DataFrame | None = None, ticks: DataFrame | None = None) -> DataFrame:
    """Events (canonical), drop notices (market_key, recv_s, n) and clock
    ticks (recv_s) as rows of one feed."""
    rows = events.withColumn("row_type", F.lit("e"))
    if drops is not None:
        rows = rows.unionByName(drops.select("market_key", "recv_s", F.col("n").cast("bigint"), F.lit("d").alias("row_type")), allowMissingColumns=True)
    if ticks is not None:
        rows = rows.unionByName(ticks.select("recv_s", F.lit("t").alias("row_type")), allowMissingColumns=True)
    if "n" not in rows.columns:
        rows = rows.withColumn("n", F.lit(None).cast("bigint"))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in FEED_SCHEMA.fields])


def clock_ticks(spark: SparkSession, source: str = "rate", **options) -> DataFrame:
    """A stream of ticks (recv_s) from Spark's rate source: with it a feed's
    boundaries appear while nothing arrives."""
    reader = spark.readStream.format(source).options(**{"rowsPerSecond": 1} if source == "rate" else {}, **options)
    return reader.load().select(F.floor(F.unix_micros("timestamp") / F.lit(1_000_000)).cast("bigint").alias("recv_s"))


class SnapshotStream:
    """Streaming snapshots under ``root`` (a folder all executors share):
    ``folds/batch=<n>/part=done|open``, ``sealed/upto=<n>`` and Spark's own
    ``checkpoint``."""

    def __init__(self, spark: SparkSession, markets: DataFrame, interval_s: int, root: str, keep: int = KEEP, compact: int = COMPACT):
        if keep < 2:
            raise ValueError("a replayed micro-batch needs the state before it: keep at least 2")
        self.spark, self.markets, self.interval_s, self.root = spark, markets, int(interval_s), root.rstrip("/")
        self.keep, self.compact, self.files = keep, compact, FileSystem(spark)

    # -- state ----------------------------------------------------------------

    def _numbers(self, name: str) -> list[int]:
        """Numbers of the complete folders ``name``=<n>."""
        names = self.files.list(f"{self.root}/{name}")
        return sorted(int(n.split("=")[1]) for n in names if "=" in n and self.files.exists(f"{self.root}/{name}/{n}/_SUCCESS"))

    def _part(self, batch: int, part: str) -> DataFrame | None:
        path = f"{self.root}/folds/batch={batch}/part={part}"
        return self.spark.read.parquet(path) if self.files.exists(path) else None

    def _state_before(self, batch: int) -> DataFrame | None:
        older = [v for v in self._numbers("folds") if v < batch]
        return self._part(older[-1], "open") if older else None

    # -- one micro-batch ---------------------------------------------------------

    def fold(self, rows: DataFrame, batch: int) -> None:
        """Fold the rows of micro-batch ``batch`` into its folder."""
        i, state = self.interval_s, self._state_before(batch)
        span = rows.agg(F.min("recv_s").alias("lo"), F.max("recv_s").alias("hi")).first()
        if span["hi"] is None:
            return
        clock = int(span["hi"]) - int(span["hi"]) % i + i
        lo, late_at = int(span["lo"]) - int(span["lo"]) % i + i, None
        if state is not None:
            latest = F.greatest(*[F.col(f"{o}.arrived") for o in _ORDERS])
            lo, late_at = state.agg(F.max("snap_ts"), F.max(latest)).first()
        clock = max(clock, lo)
        new = feed_aggregates(rows, self.markets, i, not_before=lo, with_order=True, late_at=late_at)
        # The sparse aggregate has several readers; the micro-batch's rows are read once.
        path = f"{self.root}/aggregates/batch={batch}"
        self._merge(new, state).write.mode("overwrite").parquet(path)
        agg = self.spark.read.parquet(path)
        dense = densify(agg, self.markets, lo, clock, i).withColumn("part", F.when(F.col("snap_ts") < clock, F.lit("done")).otherwise(F.lit("open")))
        # Only the open boundary is merged again, so only it holds the order keys.
        last = agg.groupBy("market_key").agg(*[F.max_by(o, F.when(F.col(o).isNotNull(), F.col("snap_ts"))).alias(o) for o in _ORDERS])
        dense = dense.join(last, "market_key", "left").withColumns({o: F.when(F.col("part") == "open", F.col(o)) for o in _ORDERS})
        dense.write.mode("overwrite").partitionBy("part").parquet(f"{self.root}/folds/batch={batch}")
        self.files.delete(f"{self.root}/aggregates")
        self._seal()

    def fold_once(self, rows: DataFrame, batch: int) -> None:
        """``fold`` for a feed whose rows must be computed once (keyed state
        before the fold): they are written first."""
        path = f"{self.root}/feed/batch={batch}"
        rows.write.mode("overwrite").parquet(path)
        self.fold(self.spark.read.schema(FEED_SCHEMA).parquet(path), batch)
        for name in self.files.list(f"{self.root}/feed"):
            if int(name.split("=")[1]) < batch:
                self.files.delete(f"{self.root}/feed/{name}")

    def _merge(self, new: DataFrame, state: DataFrame | None) -> DataFrame:
        if state is None:
            return new
        both = new.unionByName(state.withColumn("block", F.floor(F.col("snap_ts") / F.lit(block_seconds(self.interval_s))).cast("bigint")))
        return both.groupBy("market_key", "m_venue", "block", "snap_ts").agg(
            *[F.sum(c).alias(c) for c in _COUNTERS],
            *[F.max_by(g, F.when(F.col(g).isNotNull(), F.col(f"{g}__o"))).alias(g) for g in GAUGE_NAMES],
            *[F.max(o).alias(o) for o in _ORDERS])

    # -- retention ----------------------------------------------------------------

    def _seal(self) -> None:
        """Completed rows of old folders become one sealed folder.  A folder
        counts as sealed once the sealed one is complete, and is deleted then or
        by the next call."""
        upto = max(self._numbers("sealed"), default=-1)
        done = self._numbers("folds")
        for n in done:
            if n <= upto:
                self.files.delete(f"{self.root}/folds/batch={n}")
        old = [n for n in done if n > upto][:-self.keep]
        if len(old) < self.compact:
            return
        paths = [p for p in (f"{self.root}/folds/batch={n}/part=done" for n in old) if self.files.exists(p)]
        if paths:
            self.spark.read.parquet(*paths).repartition("market_key").write.mode("overwrite").parquet(f"{self.root}/sealed/upto={old[-1]}")
            for n in old:
                self.files.delete(f"{self.root}/folds/batch={n}")

    # -- running ---------------------------------------------------------------

    def start(self, feed: DataFrame, once: bool = False, **trigger):
        """Run the streaming frame ``feed`` (FEED_SCHEMA); ``once`` if its rows
        pass through keyed state."""
        return feed.writeStream.foreachBatch(self.fold_once if once else self.fold).option("checkpointLocation", f"{self.root}/checkpoint") \
                   .trigger(**(trigger or {"availableNow": True})).start()

    def flush(self) -> None:
        """Give out the open boundary of an ended feed, until the feed goes on."""
        folds = self._numbers("folds")
        if folds:
            self.files.create(f"{self.root}/ended/batch={folds[-1]}", b"")

    def _rows(self) -> DataFrame | None:
        """Rows of all completed boundaries (and the open ones after ``flush``)."""
        sealed = self._numbers("sealed")
        folds = [n for n in self._numbers("folds") if n > max(sealed, default=-1)]
        paths = [f"{self.root}/sealed/upto={n}" for n in sealed] + [f"{self.root}/folds/batch={n}/part=done" for n in folds]
        if folds and self.files.exists(f"{self.root}/ended/batch={folds[-1]}"):
            paths.append(f"{self.root}/folds/batch={folds[-1]}/part=open")
        paths = [p for p in paths if self.files.exists(p)]
        return self.spark.read.parquet(*paths) if paths else None

    def output(self) -> DataFrame:
        """Snapshots of all completed boundaries (and the open one after ``flush``)."""
        rows = self._rows()
        if rows is None:
            nothing = interval_aggregates(self.spark.createDataFrame([], FEED_SCHEMA), self.markets, self.interval_s)
            rows = densify(nothing, self.markets, 0, 0, self.interval_s).limit(0)
        return finalize_snapshots(rows, {g: F.col(g) for g in GAUGE_NAMES}, self.interval_s)


def slices(feed: DataFrame, n: int) -> list[DataFrame]:
    """The feed cut into ``n`` parts by arrival (a replay in landing order).  The
    parts are ranges of arrival, so a feed that is derived and not stored yet
    is worked out for the rows of the part that is read."""
    span = feed.agg(F.min("recv_s").alias("lo"), F.max("recv_s").alias("hi")).first()
    if span["lo"] is None:
        return [feed]
    step = max(1, -(-(span["hi"] - span["lo"] + 1) // n))
    at = F.col("recv_s")
    return [feed.filter((at >= F.lit(span["lo"] + k * step)) & (at < F.lit(span["lo"] + (k + 1) * step))) for k in range(n)]
