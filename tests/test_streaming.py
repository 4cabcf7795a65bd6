"""Streaming snapshots against the batch operator: order of arrival, restarts, idle markets, drops."""

import pytest
from pyspark.sql import functions as F

from marketfold.operators import canonical as canon
from marketfold.operators import snapshots as snap
from marketfold.sources.tables import read_table
from marketfold.streaming.snapshots_stream import FEED_SCHEMA, SnapshotStream, feed_rows, slices
from tests.conftest import SF001

INTERVAL = 3600


def run_parts(spark, root, parts, interval=INTERVAL, markets=None):
    stream = SnapshotStream(spark, markets if markets is not None else canon.markets_frame(spark), interval, str(root))
    for part in parts:  # each part: started again from the checkpoint
        part.coalesce(1).write.mode("append").parquet(f"{root}/landing")
        stream.start(spark.readStream.schema(FEED_SCHEMA).parquet(f"{root}/landing")).awaitTermination()
    stream.flush()
    return stream


def same(a, b):
    return a.select(*b.columns).exceptAll(b).isEmpty() and b.exceptAll(a.select(*b.columns)).isEmpty()


def test_stream_with_restarts_equals_batch(spark, tmp_path):
    ev = canon.events_to_canonical(read_table(spark, SF001, "events"))
    drops = canon.events_to_drop_notices(read_table(spark, SF001, "events"))
    stream = run_parts(spark, tmp_path, slices(feed_rows(ev, drops), 3))
    assert same(stream.output(), snap.snapshots_dense(ev, canon.markets_frame(spark), INTERVAL, drops=drops))


def event(spark, rows):
    """(seq, recv_s, market, kind, price)"""
    df = spark.createDataFrame(rows, "seq long, recv_s long, market_key string, kind string, price double")
    return feed_rows(canon.conform(df.withColumn("pos", F.lit(0).cast("long"))))


def test_late_rows_count_in_the_open_boundary_and_idle_markets_emit(spark, tmp_path):
    parts = [[(1, 1000, "cb-btcusd", "trade", 1.0), (2, 1130, "cb-btcusd", "trade", 2.0), (3, 1010, "cb-btcusd", "trade", 3.0)],
             [(4, 1005, "cb-btcusd", "trade", 4.0)], [(5, 1250, "cb-ethusd", "trade", 5.0)]]
    stream = run_parts(spark, tmp_path, [event(spark, p) for p in parts], 60)
    out = stream.output().collect()
    btc = {r["snapshot_ts"]: (r["trade_count_1s"], r["last_trade_px"]) for r in out if r["market_key"] == "cb-btcusd"}
    assert btc == {1020: (2, 3.0), 1080: (0, 3.0), 1140: (2, 4.0), 1200: (0, 4.0), 1260: (0, 4.0)}
    for market in ("cb-ethusd", "pm-btc", "pm-eth"):
        assert sorted(r["snapshot_ts"] for r in out if r["market_key"] == market) == [1020, 1080, 1140, 1200, 1260]


def test_replayed_micro_batch_leaves_the_same_output(spark, tmp_path):
    rows = [event(spark, [(1, 1000, "cb-btcusd", "trade", 1.0)]), event(spark, [(2, 1300, "cb-btcusd", "trade", 2.0)])]
    stream = run_parts(spark, tmp_path, rows, 60)
    before = sorted(map(str, stream.output().collect()))
    stream.fold(rows[1], 1)
    assert sorted(map(str, stream.output().collect())) == before


def test_window_keeps_the_history_of_gauges(spark):
    ev = canon.events_to_canonical(read_table(spark, SF001, "events"))
    whole = snap.snapshots_dense(ev, canon.markets_frame(spark), INTERVAL)
    lo, hi = whole.agg(F.min("snapshot_ts") + 40 * INTERVAL, F.min("snapshot_ts") + 90 * INTERVAL).first()
    part = snap.snapshots_dense(ev, canon.markets_frame(spark), INTERVAL, window=(lo, hi))
    assert same(part, whole.filter(F.col("snapshot_ts").between(lo, hi)))


def test_meta_rows_set_the_identity_gauges(spark):
    rows = [(1, 1000, "pm-btc", "meta", None), (2, 1100, "pm-btc", "trade", 0.5)]
    df = spark.createDataFrame(rows, "seq long, recv_s long, market_key string, kind string, price double")
    df = canon.conform(df.withColumn("pos", F.lit(0).cast("long")).withColumn("slug", F.when(F.col("kind") == "meta", F.lit("s-1")))
                       .withColumn("condition_id", F.when(F.col("kind") == "meta", F.lit("0xab"))).withColumn("bucket_start_ts", F.lit(900).cast("long")))
    out = {r["snapshot_ts"]: r for r in snap.snapshots_dense(df, canon.markets_frame(spark), 60).collect() if r["market_key"] == "pm-btc"}
    assert out[1020]["slug"] == "s-1" and out[1020]["msg_count_1s"] == 0 and out[1140]["condition_id"] == "0xab" and out[1140]["msg_count_1s"] == 1


def test_a_meta_wins_over_earlier_feed_rows_of_its_interval(spark, tmp_path):
    """feed slug A at 100 s, meta slug B at 1800 s, feed without a slug at 1800 s."""
    rows = [(7, 100, "pm-btc", "trade", "A", "0xa"), (-1, 1800, "pm-btc", "meta", "B", "0xb"), (8, 1800, "pm-btc", "quote", None, None)]
    df = spark.createDataFrame(rows, "seq long, recv_s long, market_key string, kind string, slug string, condition_id string")
    df = canon.conform(df.withColumn("pos", F.lit(0).cast("long")).withColumn("bucket_start_ts", F.when(F.col("slug").isNotNull(), F.floor(F.col("recv_s") / 300) * 300)))
    batch = snap.snapshots_dense(df, canon.markets_frame(spark), INTERVAL)
    assert [(r["slug"], r["bucket_start_ts"], r["condition_id"]) for r in batch.collect() if r["market_key"] == "pm-btc"] == [("B", 1800, "0xb")]
    for k, part in enumerate(([0, 1, 2], [0], [1, 2])):  # in one micro-batch, and with the boundary open in between
        if k < 2:
            stream = SnapshotStream(spark, canon.markets_frame(spark), INTERVAL, str(tmp_path / f"s{k}"))
        stream.fold(feed_rows(df.filter(F.col("seq").isin([rows[i][0] for i in part]))), k)
        stream.flush()
        if k != 1:
            assert same(stream.output(), batch)
    later = feed_rows(df.filter("seq = 8").withColumn("recv_s", F.lit(1801).cast("long")).withColumn("seq", F.lit(9).cast("long")).withColumn("slug", F.lit("C")))
    stream.fold(later, 5)
    stream.flush()
    assert [r["slug"] for r in stream.output().collect() if r["market_key"] == "pm-btc"] == ["C"]


def test_hourly_snapshots_of_the_whole_chain(spark, con001, monkeypatch):
    from marketfold.plans import catalog
    from marketfold.plans.sql_parts import feed_snapshots_sql
    from tests.oracle_compare import compare
    monkeypatch.setattr(catalog, "FLAGSHIP_INTERVAL_S", INTERVAL)
    ok, what = compare(catalog.q_feed_to_snapshots(spark, SF001), con001, feed_snapshots_sql(INTERVAL))
    assert ok, what


def test_a_flushed_feed_that_goes_on_gives_each_boundary_once(spark, tmp_path):
    rows = [(1, 1000, "cb-btcusd", "trade", 1.0), (2, 1010, "cb-btcusd", "trade", 2.0), (3, 1100, "cb-btcusd", "trade", 3.0)]
    stream = SnapshotStream(spark, canon.markets_frame(spark), 60, str(tmp_path))
    seen = []
    for k, row in enumerate(rows):
        stream.fold(event(spark, [row]), k)
        stream.flush()
        stream.flush()
        seen.append({(r["snapshot_ts"], r["trade_count_1s"]) for r in stream.output().collect() if r["market_key"] == "cb-btcusd"})
        keys = [(r["market_key"], r["snapshot_ts"]) for r in stream.output().collect()]
        assert len(keys) == len(set(keys))
    assert seen == [{(1020, 1)}, {(1020, 2)}, {(1020, 2), (1080, 0), (1140, 1)}]


def test_folders_stay_bounded_and_any_kept_version_restarts(spark, tmp_path):
    import os

    def run(root, n, **kw):
        stream = SnapshotStream(spark, canon.markets_frame(spark), 60, str(root), **kw)
        for k in range(n):
            stream.fold(event(spark, [(k, 1000 + 45 * k, "cb-btcusd", "trade", float(k))]), k)
        return stream
    small, plain = run(tmp_path / "a", 24, keep=2, compact=4), run(tmp_path / "b", 24)
    assert len(os.listdir(tmp_path / "a" / "folds")) <= 6 and len(os.listdir(tmp_path / "b" / "folds")) == 24
    assert len(os.listdir(tmp_path / "a" / "sealed")) <= 6
    for stream in (small, plain):
        stream.flush()
    assert same(small.output(), plain.output())
    # The last micro-batch is replayed from the version before it.
    small.fold(event(spark, [(23, 1000 + 45 * 23, "cb-btcusd", "trade", 23.0)]), 23)
    assert same(small.output(), plain.output())
    # A crash after a folder was sealed, before it was deleted.
    sealed = small._numbers("sealed")[-1]
    plain_fold = tmp_path / "b" / "folds" / f"batch={sealed}"
    import shutil
    shutil.copytree(plain_fold, tmp_path / "a" / "folds" / f"batch={sealed}")
    assert same(small.output(), plain.output())


def test_a_clock_emits_while_nothing_arrives(spark, tmp_path):
    from marketfold.streaming.snapshots_stream import clock_ticks
    ticks = clock_ticks(spark, "rate-micro-batch", rowsPerBatch=1, startTimestamp=1_700_000_000_000, advanceMillisPerBatch=45_000)
    (tmp_path / "landing").mkdir()
    nothing = spark.readStream.schema(FEED_SCHEMA).parquet(str(tmp_path / "landing"))
    stream = SnapshotStream(spark, canon.markets_frame(spark), 60, str(tmp_path / "s"))
    tick_rows = ticks.select(*[(F.col("recv_s") if f.name == "recv_s" else F.lit("t") if f.name == "row_type" else F.lit(None)).cast(f.dataType).alias(f.name)
                               for f in FEED_SCHEMA.fields])
    query = stream.start(nothing.unionByName(tick_rows), processingTime="0 seconds")
    import time
    end = time.time() + 90
    while time.time() < end and len(stream._numbers("folds")) < 5:
        time.sleep(0.5)
    query.stop()
    rows = stream.output().collect()
    assert {r["market_key"] for r in rows} == {"cb-btcusd", "cb-ethusd", "pm-btc", "pm-eth"}
    boundaries = sorted({r["snapshot_ts"] for r in rows})
    assert len(boundaries) >= 3 and all(b - a == 60 for a, b in zip(boundaries, boundaries[1:]))
    assert all(r["msg_count_1s"] == 0 and r["last_event_ts_utc"] is None for r in rows)


def test_bare_frame_files_stream_in_landing_order(spark, tmp_path):
    import os

    from marketfold.session import conf_scope
    from marketfold.sources.frames import numbered_lines, stream_text_frames
    from marketfold.streaming import book_stream
    level = '{{"channel":"level2","events":[{{"product_id":"BTC-USD","updates":[{{"side":"{}","price_level":"{}","new_quantity":"{}"}}]}}]}}'
    files = {"b": [level.format("bid", 10, 1), level.format("offer", 12, 1), "not json"], "a": [level.format("bid", 11, 2), level.format("bid", 11, 0)]}
    (tmp_path / "in").mkdir()
    for at, (name, lines) in enumerate(files.items()):
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
        os.utime(tmp_path / "in" / name, (1_700_000_000 + at, 1_700_000_000 + at))
    with conf_scope(spark, book_stream.STATE_STORE):
        rows = book_stream.best_per_message(stream_text_frames(spark, str(tmp_path / "in"), "coinbase", files=1))
        rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = [(r["bid"], r["ask"], r["recv_s"]) for r in spark.read.schema(canon.CANONICAL_SCHEMA).parquet(str(tmp_path / "out")).orderBy("seq").collect()]
    assert got == [(10.0, None, 1_700_000_000), (10.0, 12.0, 1_700_000_000), (11.0, 12.0, 1_700_000_001), (10.0, 12.0, 1_700_000_001)]
    batch = numbered_lines(spark.read.text(str(tmp_path / "in"), wholetext=True), "coinbase")
    assert [r["value"] for r in batch.orderBy("seq").collect()] == files["b"] + files["a"]


def test_streamed_book_resets_and_a_replay_from_the_checkpoint(spark, tmp_path):
    from marketfold.operators import book
    from marketfold.session import conf_scope
    from marketfold.sources import frames
    from marketfold.streaming import book_stream
    landed = frames.spot_frames(read_table(spark, SF001, "events"))
    want = book.best_per_message(landed)
    for part in (landed.filter("seq < 300"), landed.filter("seq >= 300 AND seq < 301"), landed.filter("seq > 300")):
        part.repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        with conf_scope(spark, book_stream.STATE_STORE):
            book_stream.best_per_message(frames.stream_frames(spark, str(tmp_path / "in"))).writeStream.format("parquet").option("path", str(tmp_path / "out")) \
                .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert same(spark.read.schema(canon.CANONICAL_SCHEMA).parquet(str(tmp_path / "out")), want)


def test_checkpoint_folder_is_required_off_a_local_master():
    from marketfold.session import require_local_master
    require_local_master("local[4]")
    require_local_master("local")
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077", "k8s://https://host"):
        with pytest.raises(ValueError):
            require_local_master(master)


def event_rows(spark, rows):
    """(seq, event second, arrival second, market, price)"""
    df = spark.createDataFrame(rows, "seq long, event_s long, recv_s long, market_key string, price double")
    return feed_rows(canon.conform(df.withColumn("pos", F.lit(0).cast("long")).withColumn("kind", F.lit("trade")).withColumn("event_us", F.col("event_s") * 1_000_000)))


def test_event_time_intervals_equal_the_batch_whatever_the_order(spark, tmp_path):
    from marketfold.streaming.event_time_stream import EventTimeStream, intervals
    ev = canon.events_to_canonical(read_table(spark, SF001, "events"))
    markets = canon.markets_frame(spark)
    span = ev.agg((F.max("recv_s") - F.min("recv_s")).alias("s")).first()["s"]
    stream = EventTimeStream(spark, markets, INTERVAL, span + INTERVAL, str(tmp_path / "s"), keep=2, compact=2)
    shuffled = feed_rows(ev.withColumn("event_us", F.col("recv_s") * 1_000_000))
    for k in range(4):  # parts without any order in time
        stream.fold(shuffled.filter(F.pmod(F.hash("seq"), F.lit(4)) == k), k)
    assert stream.output().count() == 0 and stream.late().count() == 0
    stream.flush()
    want = intervals(ev.withColumn("event_us", F.col("recv_s") * 1_000_000), markets, INTERVAL).withColumnRenamed("snap_ts", "snapshot_ts")
    got = stream.output()
    assert same(want.select(*got.columns), got)


def test_rows_behind_the_watermark_go_to_the_side_table(spark, tmp_path):
    from marketfold.streaming.event_time_stream import EventTimeStream
    stream = EventTimeStream(spark, canon.markets_frame(spark), 60, 120, str(tmp_path))
    parts = [[(1, 1000, 1000, "cb-btcusd", 1.0), (2, 1290, 1290, "cb-btcusd", 2.0)],          # watermark 1170
             [(3, 1139, 1300, "cb-btcusd", 3.0), (4, 1200, 1300, "cb-btcusd", 4.0), (5, 1100, 1310, "cb-ethusd", 5.0)],  # 3 and 5 are late
             [(6, 1600, 1600, "cb-btcusd", 6.0)]]
    for k, part in enumerate(parts):
        stream.fold(event_rows(spark, part), k)
        stream.fold(event_rows(spark, part), k)  # a replay

    def counts():
        return {(r["market_key"], r["snapshot_ts"]): (r["trade_count_1s"], r["last_trade_px"]) for r in stream.output().collect()}
    final = {("cb-btcusd", 1020): (1, 1.0), ("cb-btcusd", 1260): (1, 4.0), ("cb-btcusd", 1320): (1, 2.0)}
    assert counts() == final and stream.watermark() == 1480
    assert sorted(r["seq"] for r in stream.late().collect()) == [3, 5]
    stream.flush()
    assert counts() == {**final, ("cb-btcusd", 1620): (1, 6.0)}


def test_a_micro_batch_is_aggregated_once(spark, tmp_path):
    from pyspark.sql.functions import udf
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x
    counted = udf(count, "string").asNondeterministic()
    rows = event(spark, [(k, 1000 + 7 * k, "cb-btcusd", "trade", float(k)) for k in range(20)]).withColumn("kind", counted("kind"))
    stream = SnapshotStream(spark, canon.markets_frame(spark), 60, str(tmp_path))
    stream.fold(rows, 0)
    stream.flush()
    assert seen.value == 20
    # Completed rows hold no order keys; the open ones do.
    done, left = (spark.read.parquet(f"{tmp_path}/folds/batch=0/part={p}") for p in ("done", "open"))
    assert done.filter("last_trade_px__o is not null").isEmpty() and left.filter("market_key = 'cb-btcusd'").first()["last_trade_px__o"]["seq"] == 19
    assert sum(r["trade_count_1s"] for r in stream.output().collect()) == 20


def test_slices_of_a_derived_feed_are_ranges_of_arrival(spark):
    rows = [(k, t, "cb-btcusd", "trade", 1.0) for k, t in enumerate((100, 101, 104, 107, 108, 110, 111, None))]
    parts = [sorted(r["recv_s"] for r in p.collect()) for p in slices(event(spark, rows), 4)]
    assert parts == [[100, 101], [104], [107, 108], [110, 111]]


def test_book_ops_travel_packed():
    import pyarrow as pa
    from marketfold.streaming.book_stream import pack_ops
    rows = [{"product": p, "seq": s, "price": x} for p, s, x in (("A", 1, 1.5), ("B", 2, None), ("A", None, 2.5), ("A", 1 << 60, float("nan")))]
    packed = [r for b in pack_ops(iter([pa.RecordBatch.from_pylist(rows), pa.RecordBatch.from_pylist(rows[:2])])) for r in b.to_pylist()]
    back = [(r["product"], pa.ipc.open_stream(r["ops"]).read_all().to_pylist()) for r in packed]
    assert [(p, len(ops)) for p, ops in back] == [("A", 3), ("B", 1), ("A", 1), ("B", 1)]
    assert [o["seq"] for o in back[0][1]] == [1, None, 1 << 60] and back[1][1] == [{"seq": 2, "price": None}]
