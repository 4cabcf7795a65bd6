"""As-of join: each left row meets the last right row of its key at or before
its time.

Both sides are one table ordered by time inside (key, block of time); what a
block starts with comes from a (keys x blocks) summary.  So a key with a third
of all rows is spread over its blocks, and no row meets more than one other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_S = 3600


def asof_join(left: DataFrame, right: DataFrame, on: str, at: str, value: str, block: int = BLOCK_S) -> DataFrame:
    """``left`` plus ``value`` of the last ``right`` row (``on``, ``at``,
    ``value``) with the same key and ``right.at <= left.at``; null without one.
    ``right`` has one row per key and time, with a value; ``left`` is read
    twice, so it should be materialised.  Rows of ``left`` without a key or
    time meet nothing."""
    b = F.floor(F.col(at) / F.lit(block)).cast("bigint").alias("_b")
    rows = left.select(F.col(on).alias("_k"), F.col(at).alias("_t"), b, F.struct(*left.columns).alias("_left"), F.lit(True).alias("_is_left"))
    marks = right.select(F.col(on).alias("_k"), F.col(at).alias("_t"), b, F.lit(False).alias("_is_left"), F.col(value).alias("_v"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    inside = Window.partitionBy("_k", "_b").orderBy("_t", "_is_left").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_v", F.last("_v", ignorenulls=True).over(inside)).filter("_is_left")
    ends = marks.groupBy("_k", "_b").agg(F.max_by("_v", "_t").alias("_end"))
    blocks = rows.select("_k", "_b").distinct().unionByName(ends, allowMissingColumns=True).groupBy("_k", "_b").agg(F.first("_end", ignorenulls=True).alias("_end"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    start = blocks.select("_k", "_b", F.last("_end", ignorenulls=True).over(before).alias("_start")).filter(F.col("_start").isNotNull())
    return found.join(start, ["_k", "_b"], "left").select("_left.*", F.coalesce("_v", "_start").alias(value))


def next_time(times: DataFrame, at: str, block: int = 86_400) -> DataFrame:
    """(``at``, ``next_at``): for every time the next one there is (null for
    the last), by blocks of time."""
    t = times.select(at).distinct().withColumn("_b", F.floor(F.col(at) / F.lit(block)).cast("bigint"))
    inside = F.lead(at).over(Window.partitionBy("_b").orderBy(at))
    firsts = t.groupBy("_b").agg(F.min(at).alias("_f")).select("_b", F.lead("_f").over(Window.orderBy("_b")).alias("_next"))
    return t.withColumn("_in", inside).join(firsts, "_b").select(at, F.coalesce("_in", "_next").alias("next_at"))
