"""Intervals by event time, with a watermark and nothing dropped in silence.

A row belongs to the interval of its event time (its arrival where it has
none).  After each micro-batch the watermark is the latest event time seen less
``delay_s``; intervals that end at or before it are final and come out, later
ones stay open in the state -- as many as the delay spans.  A row for an
interval that was final when its micro-batch began is late: it goes whole to
the side table ``late/`` (Spark's own watermark aggregation would drop it).

Folders, replays, restarts and sealing are those of ``SnapshotStream``; the
watermark is kept with the micro-batch's folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketfold.operators.snapshots import GAUGE_NAMES, boundary_of, interval_aggregates
from marketfold.streaming.snapshots_stream import FEED_SCHEMA, SnapshotStream

MICRO = 1_000_000


def event_second() -> Column:
    return F.floor(F.coalesce(F.col("event_us"), F.col("recv_s") * F.lit(MICRO)) / F.lit(MICRO)).cast("bigint")


def by_event_time(events: DataFrame) -> DataFrame:
    """Canonical events with the event second in the place of the arrival second."""
    return events.withColumn("recv_s", event_second())


def intervals(events: DataFrame, markets: DataFrame, interval_s: int, with_order: bool = False) -> DataFrame:
    """The batch aggregate: counters and last values per market and interval of event time."""
    return interval_aggregates(by_event_time(events), markets, interval_s, with_order=with_order)


class EventTimeStream(SnapshotStream):
    """Feed rows (events only) -> final intervals under ``folds`` and late rows
    under ``late/batch=<n>``."""

    def __init__(self, spark, markets, interval_s: int, delay_s: int, root: str, **retention):
        super().__init__(spark, markets, interval_s, root, **retention)
        self.delay_s = int(delay_s)

    def watermark(self, before: int | None = None) -> int | None:
        """The watermark after the last micro-batch (before number ``before``)."""
        done = [n for n in self._numbers("folds") if before is None or n < before]
        marks = [int(m.split("=")[1]) for m in self.files.list(f"{self.root}/folds/batch={done[-1]}") if m.startswith("_watermark=")] if done else []
        return max(marks, default=None)

    def fold(self, rows: DataFrame, batch: int) -> None:
        events = by_event_time(rows.filter("row_type = 'e'"))
        highest = events.agg(F.max("recv_s")).first()[0]
        if highest is None:
            return
        before = self.watermark(batch)
        final = before if before is not None else -(1 << 62)
        boundary = boundary_of(F.col("recv_s"), self.interval_s)
        events.filter(boundary <= final).write.mode("overwrite").parquet(f"{self.root}/late/batch={batch}")
        new = interval_aggregates(events.filter(boundary > final), self.markets, self.interval_s, with_order=True)
        mark = max(final, int(highest) - self.delay_s)
        part = F.when(F.col("snap_ts") <= mark, F.lit("done")).otherwise(F.lit("open"))
        path = f"{self.root}/folds/batch={batch}"
        self._merge(new, self._state_before(batch)).drop("block").withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(path)
        self.files.create(f"{path}/_watermark={mark}", b"")
        self._seal()

    def _numbers(self, name: str) -> list[int]:
        """A folder counts when its watermark is there too."""
        return [n for n in super()._numbers(name) if name != "folds" or any(m.startswith("_watermark=") for m in self.files.list(f"{self.root}/folds/batch={n}"))]

    def late(self) -> DataFrame:
        names = [n for n in self.files.list(f"{self.root}/late") if self.files.exists(f"{self.root}/late/{n}/_SUCCESS")]
        return self.spark.read.schema(FEED_SCHEMA).parquet(*[f"{self.root}/late/{n}" for n in names]) if names else self.spark.createDataFrame([], FEED_SCHEMA)

    def output(self) -> DataFrame:
        """Final intervals (and the open ones after ``flush``): counters and last values."""
        rows = self._rows()
        columns = ("market_key", F.col("snap_ts").alias("snapshot_ts"), "msg_count_1s", "trade_count_1s", "book_update_count_1s", *GAUGE_NAMES)
        return (rows if rows is not None else intervals(self.spark.createDataFrame([], FEED_SCHEMA), self.markets, self.interval_s)).select(*columns)
