"""Ordered outputs: a global order with positions, by ranges of the sort key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketfold.session import cut_lineage


def with_positions(df: DataFrame, order: tuple[str, ...], position: str = "position", parts: int | None = None) -> DataFrame:
    """``df`` in ``order`` (which must tell all rows apart), with each row's
    place from 1.  Rows are dealt out by ranges of the key and numbered range by
    range; the ranges' sizes, a row each, give where a range begins.  Written
    out, the files follow the order."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The ranges come from a sample, so they are fixed by writing them down.
    ranged = cut_lineage(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_nth", nth).join(offsets, "_part").select(*df.columns, (F.col("_off") + F.col("_nth")).cast("bigint").alias(position))
