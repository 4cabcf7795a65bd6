"""Rolling NDJSON files: per market and UTC day, a new part whenever the last
one has reached the byte limit.

A part takes rows until its bytes reach the limit, so no part is larger than
the limit and one row.  Where parts begin follows from running byte sums: totals
per (date, market, block of time) first, then sums inside a block, so a market's
day is never sorted by one task.  Part numbers go on after the largest one that
is there.

A call writes under ``commit=<its name>`` and replaces what an earlier attempt
with that name wrote, so a retry leaves one copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketfold.functions import constants as C
from marketfold.functions.exprs import compact_stamp
from marketfold.sources.files import FileSystem

BLOCK_S = 3600


def rolled(rows: DataFrame, max_bytes: int = C.ROTATE_THRESHOLD_BYTES, order: tuple[str, ...] = ("ts",), block: int = BLOCK_S) -> DataFrame:
    """``rows`` (date_str, market_key, ts in seconds, row_json, ...) plus
    ``cut``: the stretch of ``max_bytes`` in which the row begins.  ``order``
    must tell all rows of a market's day apart."""
    size = (F.octet_length("row_json") + 1).cast("bigint")
    day = ["date_str", "market_key"]
    d = rows.withColumn("_size", size).withColumn("_b", F.floor(F.col("ts") / F.lit(block)).cast("bigint"))
    before = Window.partitionBy(*day).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = d.groupBy(*day, "_b").agg(F.sum("_size").alias("_n")).select(*day, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*day, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.coalesce(F.sum("_size").over(inside), F.lit(0))).join(offsets, [*day, "_b"])
    return d.withColumn("cut", F.floor((F.col("_off") + F.col("_in")) / F.lit(int(max_bytes))).cast("bigint")).drop("_size", "_b", "_off", "_in")


def part_table(cut_rows: DataFrame, listing: DataFrame) -> DataFrame:
    """(date_str, market_key, cut, part, filename, n_rows, size_bytes) of the
    parts, numbered after those listed."""
    day = ["date_str", "market_key"]
    parts = cut_rows.groupBy(*day, "cut").agg(F.min("ts").alias("start"), F.count(F.lit(1)).alias("n_rows"), F.sum(F.octet_length("row_json") + 1).alias("size_bytes"))
    number = F.regexp_extract("name", C.ROTATED_FILE_RE, 3)
    named = listing.select(F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("date_str"), F.regexp_extract("path", "([^/]+)$", 1).alias("name")).filter(number != "")
    most = named.groupBy("date_str", F.regexp_extract("name", C.ROTATED_FILE_RE, 1).alias("market_key")).agg(F.max(number.cast("int")).alias("most"))
    # One row per part: a day's parts are as many as its bytes hold the limit.
    nth = F.row_number().over(Window.partitionBy(*day).orderBy("cut"))
    p = parts.join(most, day, "left").withColumn("part", F.coalesce("most", F.lit(0)) + nth)
    name = F.format_string("%s__start_%s__part_%04d.ndjson.zst", F.col("market_key"), compact_stamp(F.timestamp_seconds("start")), F.col("part"))
    return p.select(*day, "cut", "part", name.alias("filename"), "n_rows", F.col("size_bytes").cast("bigint").alias("size_bytes"))


class RollingStore:
    """Parts as folders ``commit=<c>/date=<day>/name=<filename>`` with one file
    each (Spark names the file inside)."""

    def __init__(self, spark, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), FileSystem(spark)

    def listing(self, but: str | None = None) -> DataFrame:
        """(path, length) of the parts, ``path`` ending in day and file name;
        without those of the commit ``but``."""
        paths = [f"{self.root}/{c}" for c in self.files.list(self.root) if c.startswith("commit=") and c != f"commit={but}" and self.files.exists(f"{self.root}/{c}/_SUCCESS")]
        if not paths:
            return self.spark.createDataFrame([], "path string, length long")
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(paths).select("path", "length")
        at = "date=([^/]+)/name=([^/]+)/"
        return found.select(F.concat_ws("/", F.regexp_extract("path", at, 1), F.regexp_extract("path", at, 2)).alias("path"), "length")

    def write(self, rows: DataFrame, commit: str, max_bytes: int = C.ROTATE_THRESHOLD_BYTES, order: tuple[str, ...] = ("ts",), compression: str = "gzip") -> DataFrame:
        """Write ``rows`` as parts and return their table.  ``rows`` is read
        twice, so it should be materialised."""
        cut_rows = rolled(rows, max_bytes, order)
        parts = part_table(cut_rows, self.listing(but=commit))
        out = cut_rows.join(parts.select("date_str", "market_key", "cut", "filename"), ["date_str", "market_key", "cut"])
        out = out.select(F.col("date_str").alias("date"), F.col("filename").alias("name"), F.col("row_json").alias("value"), *order)
        out.repartition("date", "name").sortWithinPartitions("date", "name", *order).select("date", "name", "value") \
           .write.mode("overwrite").partitionBy("date", "name").option("compression", compression).text(f"{self.root}/commit={commit}")
        return parts
