"""Operational queries: metric registry rollup and text exposition,
worker liveness, stage lag and the documented alert rules.

Everything is a grouped aggregate, or a window per hour joined with a
summary of the hours, never an ordered scan over all rows in one partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketfold.operators.ordering import with_positions
from marketfold.session import cut_lineage
from marketfold.functions.exprs import sanitize_label_name, sanitize_metric_name


def python_float_text(c) -> F.Column:
    """Python ``str(float)`` (shortest repr; scientific only below 1e-4 or
    from 1e16) from Spark's shortest-digit text."""
    s = F.col(c).cast("double").cast("string") if isinstance(c, str) else c.cast("double").cast("string")
    pat = "^(-?)(\\d)\\.(\\d+)E(-?\\d+)$"
    sign, d0, frac, e = (F.regexp_extract(s, pat, i) for i in (1, 2, 3, 4))
    frac = F.regexp_replace(frac, "0+$", "")
    digits = F.concat(d0, frac)
    ei = e.cast("int")
    nd = F.length(digits)
    # shift the point right by e places (pad with zeros), ".0" when integral
    after = F.when(nd > ei + 1, digits.substr(ei + 2, F.lit(400))).otherwise(F.lit("0"))
    plain_big = F.concat(sign, F.rpad(digits, ei + 1, F.lit("0")).substr(F.lit(1), ei + 1), F.lit("."), after)
    plain_small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -ei - 1), digits)
    sci = F.concat(sign, d0, F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(F.lit("")), F.lit("e"),
                   F.when(ei < 0, F.lit("-")).otherwise(F.lit("+")), F.lpad(F.abs(ei).cast("string"), 2, "0"))
    conv = F.when((ei >= 0) & (ei < 16), plain_big).when((ei >= -4) & (ei < 0), plain_small).otherwise(sci)
    return (F.when(s == "NaN", F.lit("nan")).when(s == "Infinity", F.lit("inf")).when(s == "-Infinity", F.lit("-inf"))
             .when(s.contains("E"), conv).otherwise(s))


def series_key(samples: DataFrame) -> DataFrame:
    """Sanitised metric name and sorted label text ``k="v",...``."""
    lab = F.array_sort(F.transform(F.map_entries(F.col("labels")),
                                   lambda e: F.struct(sanitize_label_name(e["key"]).alias("k"), e["value"].alias("v"))))
    text = F.array_join(F.transform(lab, lambda e: F.concat(e["k"], F.lit('="'), e["v"], F.lit('"'))), ",")
    return samples.withColumn("name", sanitize_metric_name(F.col("name"))).withColumn("label_text", text)


SEQ_BLOCK = 1_000_000


def metric_rollup(samples: DataFrame) -> DataFrame:
    """Registry semantics over ``(seq, name, labels MAP, op inc|set, value)``:
    a series is a gauge once any ``set`` happened (a later ``inc`` keeps it a
    gauge); value = last set (by seq) + increments after it, or the sum of
    increments for a counter.

    Samples are reduced map-side per (series, block of ``seq``): the block's
    last set and a map-side sum of its increments.  Only the blocks that hold
    a series' last set are read again, for the increments after it."""
    s = series_key(samples).select("name", "label_text", "seq", "op", "value", F.floor(F.col("seq") / F.lit(SEQ_BLOCK)).alias("blk"))
    key = ["name", "label_text"]
    is_set = F.col("op") == "set"
    per = cut_lineage(s.groupBy(*key, "blk").agg(
        F.max(F.when(is_set, F.struct("seq", "value"))).alias("last_set"), F.sum(F.when(F.col("op") == "inc", F.col("value"))).alias("inc")), "metric-blocks")
    last = per.groupBy(*key).agg(F.max("last_set").alias("last_set"))
    last = cut_lineage(last.withColumn("set_blk", F.floor(F.col("last_set.seq") / F.lit(SEQ_BLOCK))), "metric-last")
    later = per.join(last.select(*key, "set_blk"), key).filter(F.col("set_blk").isNull() | (F.col("blk") > F.col("set_blk")))
    inside = s.filter("op = 'inc'").join(last.filter("set_blk IS NOT NULL").select(*key, F.col("set_blk").alias("blk"), "last_set.seq"), [*key, "blk"], "left_semi")
    inside = inside.join(last.select(*key, F.col("last_set.seq").alias("set_seq")), key).filter("seq > set_seq")
    incs = later.select(*key, "inc").unionByName(inside.select(*key, F.col("value").alias("inc"))).groupBy(*key).agg(F.sum("inc").alias("inc_after"))
    return last.join(incs, key, "left").select(
        *key, F.when(F.col("last_set").isNotNull(), F.lit("gauge")).otherwise(F.lit("counter")).alias("kind"),
        (F.coalesce(F.col("last_set.value"), F.lit(0.0)) + F.coalesce(F.col("inc_after"), F.lit(0.0))).alias("value"))


def metric_text(rollup: DataFrame) -> DataFrame:
    """Text exposition lines per series: ``# TYPE name kind`` and
    ``name{k="v"} value``; ``line_order`` gives the global sort order."""
    sample = F.concat(F.col("name"), F.when(F.col("label_text") != "", F.concat(F.lit("{"), F.col("label_text"), F.lit("}")))
                      .otherwise(F.lit("")), F.lit(" "), python_float_text(F.col("value")))
    return with_positions(rollup, ("name", "label_text"), "line_order").select("name", "label_text", "line_order", F.concat(F.lit("# TYPE "), F.col("name"), F.lit(" "), F.col("kind")).alias("type_line"),
                         sample.alias("sample_line"))


def liveness(ops: DataFrame, stale_after_s: int = 120) -> DataFrame:
    """Worker health as of ``now`` = the last op time in the data.

    ``ops``: (worker, seq, ts_us, op, reason) with op in heartbeat | ready |
    unhealthy | healthy.  A worker is healthy unless its last health op
    flagged it or its last heartbeat (its first op when it never beat) is
    older than the threshold -> reason ``heartbeat_timeout``.  One hash
    aggregate per worker; ``now`` is a max over the per-worker rows."""
    per = ops.groupBy("worker").agg(
        F.coalesce(F.max(F.when(F.col("op") == "heartbeat", F.col("ts_us"))), F.min("ts_us")).alias("hb_us"),
        F.max("ts_us").alias("last_us"),
        F.max((F.col("op") == "ready").cast("int")).alias("ready_i"),
        F.max_by(F.struct((F.col("op") == "healthy").alias("ok"), F.coalesce(F.col("reason"), F.lit("")).alias("reason")),
                 F.when(F.col("op").isin("healthy", "unhealthy"), F.col("seq"))).alias("health"))
    now = F.max("last_us").over(Window.partitionBy())
    age = F.greatest(F.lit(0.0), (now - F.col("hb_us")) / F.lit(1_000_000.0))
    timed_out = age > F.lit(float(max(1, stale_after_s)))
    flagged_ok = F.coalesce(F.col("health.ok"), F.lit(True))
    reason = F.when(timed_out, F.lit("heartbeat_timeout")).otherwise(
        F.when(flagged_ok, F.lit("")).otherwise(F.col("health.reason")))
    return per.select("worker", (flagged_ok & ~timed_out).alias("healthy"), (F.col("ready_i") == 1).alias("ready"),
                      reason.alias("reason"), F.round(age, 3).alias("heartbeat_age_seconds"))


def stage_lags(claims_first: DataFrame) -> DataFrame:
    """Per batch: seconds between consecutive stage records (max 0;
    unparsable -> 0) -- a pivot by stage in one hash aggregate."""
    ts = F.unix_seconds(F.to_timestamp(F.regexp_replace(F.col("produced_at"), "Z$", "")))
    p = claims_first.groupBy("id").agg(*[F.max(F.when(F.col("stage") == s, ts)).alias(s)
                                          for s in ("persist", "transform", "export", "relay")])

    def lag(a, b):
        return F.coalesce(F.greatest(F.lit(0), F.col(b) - F.col(a)), F.lit(0)).cast("bigint")

    return p.select(F.col("id").alias("batch_id"), lag("persist", "transform").alias("transform_lag_s"),
                    lag("transform", "export").alias("export_lag_s"), lag("export", "relay").alias("relay_lag_s"))


HOUR_US = 3_600_000_000


def with_previous(df: DataFrame, keys: list[str], ts_us: str, value: str, out: str) -> DataFrame:
    """Add ``out``: ``value`` of the row before, per ``keys`` in time order.

    The ordered scan runs per (keys, hour); an hour's first row takes the last
    value of the hour with rows before it from a (keys x hours) summary."""
    d = df.withColumn("_blk", F.floor(F.col(ts_us) / F.lit(HOUR_US)).cast("bigint"))
    w = Window.partitionBy(*keys, "_blk").orderBy(ts_us, value)
    d = d.withColumn("_lag", F.lag(value).over(w))
    ends = d.groupBy(*keys, "_blk").agg(F.max(F.struct(F.col(ts_us), F.col(value).alias("v")))["v"].alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_blk")
    ends = ends.select(*keys, "_blk", F.lag("_end").over(before).alias("_before"))
    return d.join(ends, [*keys, "_blk"]).withColumn(out, F.coalesce("_lag", "_before")).drop("_lag", "_before", "_blk")


def with_run(df: DataFrame, keys: list[str], ts_us: str, starts: F.Column, out: str) -> DataFrame:
    """Add ``out``: running count of ``starts`` per ``keys`` in time order, in
    the same two levels."""
    d = df.withColumn("_blk", F.floor(F.col(ts_us) / F.lit(HOUR_US)).cast("bigint")).withColumn("_s", starts.cast("int"))
    per = d.groupBy(*keys, "_blk").agg(F.sum("_s").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, "_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*keys, "_blk").orderBy(ts_us).rangeBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_in", F.sum("_s").over(w))
    return d.join(per, [*keys, "_blk"]).withColumn(out, F.col("_off") + F.col("_in")).drop("_blk", "_s", "_in", "_off")


def freshness_gaps(writes: DataFrame, ts_us: str = "ts_us", threshold_s: float = 300) -> DataFrame:
    """Gaps longer than ``threshold_s`` between consecutive writes."""
    g = with_previous(writes.select(F.lit(0).alias("k"), F.col(ts_us).alias("at"), F.col(ts_us).alias("v")), ["k"], "at", "v", "prev_us")
    gap = (F.col("at") - F.col("prev_us")) / F.lit(1_000_000.0)
    return g.filter(gap > threshold_s).select(F.col("prev_us").alias("last_write_us"), F.col("at").alias("next_write_us"), gap.alias("gap_s"))


def sustained_above(samples: DataFrame, key: str, ts_us: str, value: str, limit: float, min_seconds: int, max_gap_s: int = 1800) -> DataFrame:
    """Runs of consecutive samples (per ``key``) whose value stays above
    ``limit``, reported when the run spans at least ``min_seconds``.  A run
    ends at a sample at or below the limit and where no sample came for
    ``max_gap_s`` (nothing is known about the time between)."""
    s = samples.select(key, F.col(ts_us).alias("at"), (F.col(value) > limit).alias("hot"))
    s = s.withColumn("state", F.struct("at", "hot"))
    s = with_previous(s, [key], "at", "state", "prev")
    silent = (F.col("at") - F.col("prev.at")) > F.lit(int(max_gap_s) * 1_000_000)
    starts = F.col("hot") & (F.col("prev").isNull() | ~F.col("prev.hot") | silent)
    runs = with_run(s, [key], "at", starts, "run").filter("hot").groupBy(key, "run").agg(
        F.min("at").alias("start_us"), F.max("at").alias("end_us"), F.count(F.lit(1)).alias("samples"))
    return runs.filter((F.col("end_us") - F.col("start_us")) >= F.lit(int(min_seconds) * 1_000_000)).drop("run")


def not_ready_runs(probes: DataFrame, more_than: int = 3) -> DataFrame:
    """Workers not ready for more than ``more_than`` probes in a row:
    ``probes`` (worker, ts_us, ready)."""
    runs = with_run(probes, ["worker"], "ts_us", F.col("ready"), "run").filter(~F.col("ready"))
    runs = runs.groupBy("worker", "run").agg(F.min("ts_us").alias("start_us"), F.max("ts_us").alias("end_us"), F.count(F.lit(1)).alias("probes"))
    return runs.filter(F.col("probes") > more_than).drop("run")


def rate_alerts(failures: DataFrame, ts: str, window: str = "15 minutes", slide: str = "1 minute", at_least: int = 3,
                keys: tuple[str, ...] = ()) -> DataFrame:
    """Sliding-window failure counts (each failure lands in every window
    covering it; partial aggregation per window) at or above a threshold,
    overall or per ``keys``."""
    w = failures.groupBy(*keys, F.window(F.col(ts), window, slide).alias("w")).agg(F.count(F.lit(1)).alias("failures"))
    return w.filter(F.col("failures") >= at_least).select(
        *keys, F.unix_seconds(F.col("w.start")).alias("window_start_s"), F.unix_seconds(F.col("w.end")).alias("window_end_s"), "failures")
