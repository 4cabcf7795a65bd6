"""The whole chain as one stream: landed raw frames -> parsers and keyed order
book -> canonical feed -> dense snapshots.

All branches read the same landing zone, and Spark gives them the same files in
each micro-batch as they are one source of one query.  Resolved market metas
land as files of their own and join the feed as ``meta`` rows; prediction
messages look their asset up in the bindings table, which is read again in
every micro-batch.  A clock (``clock_ticks``) can be added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketfold.operators.canonical import conform
from marketfold.operators.prediction_parser import parse_prediction_frames
from marketfold.operators.spot_parser import parse_spot_frames
from marketfold.session import conf_scope
from marketfold.streaming.book_stream import STATE_STORE, best_per_message
from marketfold.streaming.snapshots_stream import SnapshotStream, feed_rows


def canonical_stream(frames: DataFrame, bindings: DataFrame, metas: DataFrame | None = None) -> DataFrame:
    """Streamed frames of both venues (and streamed meta rows) -> canonical rows."""
    spot, prediction = frames.filter("venue = 'coinbase'"), frames.filter("venue = 'polymarket'")
    rows = conform(parse_spot_frames(spot)).unionByName(best_per_message(spot)).unionByName(parse_prediction_frames(prediction, bindings))
    return rows.unionByName(conform(metas)) if metas is not None else rows


def start(stream: SnapshotStream, frames: DataFrame, bindings: DataFrame, metas: DataFrame | None = None, ticks: DataFrame | None = None, **trigger):
    """Run ``stream`` on raw frames; the book's state is in the checkpoint."""
    with conf_scope(stream.spark, STATE_STORE):
        return stream.start(feed_rows(canonical_stream(frames, bindings, metas), ticks=ticks), once=True, **trigger)
