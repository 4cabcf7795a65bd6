"""Operational input tables derived from ``events`` with column
expressions: metric samples, worker health ops, queue depth samples and
failure events.  Each is a projection of the whole table (grows with it)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketfold.operators.ledger import STAGES as LEDGER_STAGES

# Worker and queue names of the five-stage pipeline.
WORKERS = ("ingest", "persist", "transform", "export", "relay")
QUEUES = ("ws-snapshot-batches", "ws-bronze-written", "ws-export-intents", "ws-relay-intents")


def _base(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("seq"), "user_id", "event_type", "value",
                      F.from_json("props", "k INT").getField("k").alias("k"),
                      F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
                      F.element_at(F.array(*[F.lit(m) for m in ("cb-btcusd", "cb-ethusd", "pm-btc", "pm-eth")]),
                                   (F.pmod(F.col("user_id"), F.lit(4)) + 1).cast("int")).alias("mk"))


def _pick(names, idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (idx + 1).cast("int"))


def metric_samples(events: DataFrame) -> DataFrame:
    """(seq, name, labels MAP, op, value)."""
    b = _base(events)
    et = F.col("event_type")
    venue = F.when(F.col("mk").startswith("cb-"), F.lit("coinbase")).otherwise(F.lit("polymarket"))
    worker = _pick(WORKERS, F.pmod(F.col("user_id"), F.lit(5)))
    mkt = F.create_map(F.lit("market"), F.col("mk"), F.lit("source"), venue)
    name = (F.when(et == "purchase", F.lit("ingest_batches_published_total"))
             .when(et == "click", F.lit("persist_batches_total"))
             .when(et == "view", F.lit("ws_stale_ms"))
             .when(et == "signup", F.lit("worker_ready"))
             .otherwise(F.lit("mixed.metric-name")))
    labels = (F.when(et.isin("purchase", "click"), mkt)
               .when(et.isin("view", "signup"), F.create_map(F.lit("worker"), worker))
               .otherwise(F.create_map(F.lit("market-key"), F.col("mk"))))
    op = (F.when(et.isin("purchase", "click"), F.lit("inc")).when(et.isin("view", "signup"), F.lit("set"))
           .when(F.pmod(F.col("k"), F.lit(2)) == 0, F.lit("inc")).otherwise(F.lit("set")))
    value = (F.when(et == "purchase", F.lit(1.0)).when(et == "click", F.col("k").cast("double"))
              .when(et == "view", F.col("value")).when(et == "signup", F.lit(1.0)).otherwise(F.col("k").cast("double")))
    return b.select("seq", name.alias("name"), labels.alias("labels"), op.alias("op"), value.alias("value"))


def worker_ops(events: DataFrame) -> DataFrame:
    """(worker, seq, ts_us, op, reason)."""
    b = _base(events)
    et = F.col("event_type")
    op = (F.when(et.isin("signup", "click"), F.lit("heartbeat")).when(et == "view", F.lit("ready"))
           .when(et == "error", F.lit("unhealthy")).otherwise(F.lit("healthy")))
    return b.select(_pick(WORKERS, F.pmod(F.col("user_id"), F.lit(5))).alias("worker"), "seq", "ts_us", op.alias("op"),
                    F.when(et == "error", F.concat(F.lit("error:"), F.col("k").cast("string"))).alias("reason"))


def queue_depth(events: DataFrame) -> DataFrame:
    """(queue, ts_us, depth) samples."""
    b = _base(events)
    return b.select(_pick(QUEUES, F.pmod(F.col("user_id"), F.lit(4))).alias("queue"), "ts_us",
                    (F.col("value") * F.lit(10.0)).alias("depth"))


def failures(events: DataFrame) -> DataFrame:
    """Export failures: the ``error`` events."""
    return events.filter(F.col("event_type") == "error").select(F.col("ts").cast("timestamp").alias("ts"))


def file_listing(orders: DataFrame, root: str = "landing") -> DataFrame:
    """A listing-shaped table ``(path, modificationTime, length)`` derived
    from ``orders``: rotated part files, legacy per-market files, foreign
    files and unparsable names, in date directories or a ``misc`` folder
    (mtime fallback).  Same columns as ``binaryFile`` metadata."""
    k = F.col("o_orderkey")
    mk = _pick(("cb-btcusd", "cb-ethusd", "pm-btc", "pm-eth"), F.pmod(F.col("o_custkey"), F.lit(4)))
    d = F.col("o_orderdate").cast("timestamp")
    ds = F.date_format(d, "yyyy-MM-dd")
    dir_ = F.when(F.pmod(k, F.lit(5)) == 0, F.lit("misc")).otherwise(ds)
    r = F.pmod(k, F.lit(7))
    name = (F.when(r == 0, F.concat(mk, F.lit(".ndjson.zst")))
             .when(r == 1, F.concat(F.lit("notes-"), k.cast("string"), F.lit(".txt")))
             .when(r == 2, F.concat(F.lit("BAD NAME "), k.cast("string"), F.lit(".ndjson.zst")))
             .otherwise(F.concat(mk, F.lit("__start_"), F.date_format(d, "yyyyMMdd'T'HHmmss'Z'"), F.lit("__part_"),
                                 F.lpad(F.pmod(k, F.lit(10000)).cast("string"), 4, "0"), F.lit(".ndjson.zst"))))
    df = orders.select(F.concat_ws("/", F.lit(root), dir_, name).alias("path"),
                       F.timestamp_seconds(F.unix_seconds(d) + F.pmod(k, F.lit(86400))).alias("modificationTime"),
                       F.round(F.col("o_totalprice") * F.lit(10.0)).cast("bigint").alias("length"))
    return df.groupBy("path").agg(F.max("modificationTime").alias("modificationTime"), F.max("length").alias("length"))


def event_lines(events: DataFrame) -> DataFrame:
    """(date_str, market_key, ts, event_id, row_json): a line per event."""
    b = _base(events)
    day = F.date_format(F.timestamp_micros("ts_us"), "yyyy-MM-dd")
    line = F.concat(F.lit('{"event_id":'), F.col("seq").cast("string"), F.lit(',"event_type":"'), F.col("event_type"), F.lit('","k":'), F.col("k").cast("string"), F.lit("}"))
    return b.select(day.alias("date_str"), F.col("mk").alias("market_key"), F.floor(F.col("ts_us") / F.lit(1_000_000)).cast("bigint").alias("ts"),
                    F.col("seq").alias("event_id"), line.alias("row_json"))


def listed_parts(events: DataFrame) -> DataFrame:
    """A listing (path, length) of part files, one per error event's day and market."""
    b = _base(events).filter("event_type = 'error'")
    at = F.timestamp_micros("ts_us")
    name = F.concat(F.col("mk"), F.lit("__start_"), F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"), F.lit("__part_"), F.lpad((F.col("k") % 7 + 1).cast("string"), 4, "0"), F.lit(".ndjson.zst"))
    return b.select(F.concat_ws("/", F.lit("landing"), F.date_format(at, "yyyy-MM-dd"), name).alias("path"), F.lit(1).cast("bigint").alias("length"))


def manifests_of(listing: DataFrame) -> DataFrame:
    """Manifests that describe the listed files."""
    digest = F.sha2(F.concat_ws("|", "path", F.col("length").cast("string")), 256)
    return listing.select(F.sha2("path", 256).alias("export_id"), F.col("path").alias("staged_blob_path"), digest.alias("content_sha256"), F.col("length").alias("content_length"))


def stored_bytes(listing: DataFrame) -> DataFrame:
    """What lies there now: by length some files are gone, some have other
    bytes, some are one byte short under an unchanged digest."""
    m = manifests_of(listing)
    n = F.col("content_length")
    return m.filter(n % 11 != 3).select("staged_blob_path", F.when(n % 13 == 5, F.sha2("content_sha256", 256)).otherwise(F.col("content_sha256")).alias("actual_sha256"),
                                        F.when(n % 17 == 2, n - 1).otherwise(n).alias("actual_length"))


def probes(events: DataFrame) -> DataFrame:
    """(worker, ts_us, ready): every health operation is one probe."""
    return worker_ops(events).select("worker", "ts_us", (F.col("op") != "heartbeat").alias("ready"))


def restarts(events: DataFrame) -> DataFrame:
    """(worker, ts): the ``signup`` and ``error`` events."""
    w = _pick(WORKERS, F.pmod(F.col("user_id"), F.lit(5)))
    return events.filter(F.col("event_type").isin("signup", "error")).select(w.alias("worker"), F.col("ts").cast("timestamp").alias("ts"))


def later_listing(listing: DataFrame) -> DataFrame:
    """The same files some time later: each has grown by its own amount."""
    h = F.col("length") % 9973
    return listing.select("path", F.timestamp_micros(F.unix_micros("modificationTime") + (h % 7200) * 500_000).alias("modificationTime"),
                          (F.col("length") + h % 5000).alias("length"))


def claims_from_envelopes(envelopes: DataFrame, redeliver_every: int = 3) -> DataFrame:
    """Control records each stage would claim for every batch; batches with
    ``batch_no % redeliver_every == 0`` are delivered twice (the second a
    minute later), as an at-least-once queue does after a lost ack."""
    st = F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(i + 1).alias("offset")) for i, s in enumerate(LEDGER_STAGES)])
    e = envelopes.select("batch_id", "source", "market", "snapshot_date", "batch_no", "row_count", "last_ts",
                         F.explode(st).alias("s"))
    dup = F.when(F.pmod(F.col("batch_no"), F.lit(redeliver_every)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    e = e.withColumn("delivery", F.explode(dup))
    base = F.to_timestamp(F.substring(F.col("last_ts"), 1, 19))
    step = F.col("s.offset") * (F.lit(1) + F.pmod(F.col("batch_no"), F.lit(7)))
    produced = F.timestamp_seconds(F.unix_seconds(base) + step + F.col("delivery") * F.lit(60))
    produced_at = F.date_format(produced, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    written = F.to_json(F.struct(F.col("batch_id"), F.col("source"), F.col("market"), F.col("snapshot_date"),
                                 F.col("row_count"), produced_at.alias("produced_at")))
    # Hand-offs of a file: blank and missing fields, a length as text, digests with white space around.
    digest, no = F.sha2("batch_id", 256), F.col("batch_no")
    shared = [F.col("batch_id").alias("export_id"), F.concat(F.lit("out/"), F.col("batch_id")).alias("target_relpath"),
              F.when(F.pmod(no, F.lit(3)) == 1, F.concat(F.lit(" "), digest, F.lit(" "))).otherwise(digest).alias("content_sha256"),
              F.when(F.pmod(no, F.lit(4)) != 3, (F.col("row_count") * 100).cast("string")).alias("content_length"), produced_at.alias("produced_at")]
    intent = F.to_json(F.struct(*shared, F.concat(F.lit("silver/"), F.col("batch_id")).alias("silver_blob_path"), "snapshot_date", "source", "market"))
    relay = F.to_json(F.struct(*shared, F.when(F.pmod(no, F.lit(5)) == 2, F.lit("  ")).otherwise(F.concat(F.lit("staged/"), F.col("batch_id"))).alias("staged_blob_path")))
    handoff = F.when(F.col("s.stage") == "export", intent).when(F.col("s.stage") == "relay", relay).otherwise(written)
    return e.select(F.col("s.stage").alias("stage"), F.col("batch_id").alias("id"), "delivery",
                    produced_at.alias("produced_at"), written.alias("payload"), handoff.alias("handoff"), "batch_no", "source", "market")
