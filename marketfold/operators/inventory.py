"""Storage inventory: pending-file discovery, market-day sizes, daily
size projection, file growth.  Inputs are file listings -- the
``binaryFile`` source (``path, modificationTime, length``; content is
never read here) or any table with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketfold.functions import constants as C
from marketfold.functions.exprs import compact_stamp, projected_daily_bytes


def list_files(spark, root: str, glob: str = "*.ndjson.zst") -> DataFrame:
    """Recursive listing of ``root`` (metadata only: content is dropped
    before anything is read)."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob).load(root))
    return df.select("path", "modificationTime", "length")


def market_from_filename(name) -> F.Column:
    """Rotated name -> its market; legacy ``{market}.ndjson.zst`` -> stem;
    anything else -> ''."""
    rot = F.regexp_extract(name, C.ROTATED_FILE_RE, 1)
    legacy = F.when(name.endswith(C.LEGACY_FILE_SUFFIX), F.regexp_extract(name, "^(.*)\\.ndjson\\.zst$", 1))
    return F.when(rot != "", rot).otherwise(F.coalesce(legacy, F.lit("")))


def pending_files(listing: DataFrame) -> DataFrame:
    """Discovery: every ``*.ndjson.zst`` file with a market in its name;
    date = parent directory when it is ``YYYY-MM-DD``, else the file's
    modification date (UTC)."""
    name = F.regexp_extract(F.col("path"), "([^/]+)$", 1)
    parent = F.regexp_extract(F.col("path"), "([^/]+)/[^/]+$", 1)
    df = listing.select("path", "modificationTime", "length", name.alias("filename"), parent.alias("parent"))
    df = df.filter(F.col("filename").endswith(C.LEGACY_FILE_SUFFIX))
    df = df.withColumn("market_key", market_from_filename(F.col("filename"))).filter(F.col("market_key") != "")
    date = F.when(F.col("parent").rlike(C.DATE_DIR_RE), F.col("parent")).otherwise(
        F.date_format(F.col("modificationTime").cast("timestamp"), "yyyy-MM-dd"))
    return df.select("path", date.alias("date_str"), "market_key", "filename",
                     F.coalesce(F.col("length"), F.lit(0)).cast("bigint").alias("size_bytes"))


def market_day_sizes(listing: DataFrame, markets: DataFrame) -> DataFrame:
    """Bytes per (date dir, market): rotated parts plus the legacy file,
    counting only files that sit directly in a ``YYYY-MM-DD`` directory."""
    name = F.regexp_extract(F.col("path"), "([^/]+)$", 1)
    parent = F.regexp_extract(F.col("path"), "([^/]+)/[^/]+$", 1)
    df = listing.select(name.alias("filename"), parent.alias("date_str"), "length", "modificationTime")
    df = df.filter(F.col("date_str").rlike(C.DATE_DIR_RE))
    mk = markets.select("market_key")
    # rotated: "{market}__start_*__part_*.ndjson.zst"; legacy: "{market}.ndjson.zst"
    rot_mk = F.regexp_extract(F.col("filename"), "^(.*?)__start_.*__part_.*\\.ndjson\\.zst$", 1)
    leg_mk = F.regexp_extract(F.col("filename"), "^(.*)\\.ndjson\\.zst$", 1)
    cand = df.select("date_str", "length", "modificationTime",
                     F.explode(F.array_distinct(F.array(rot_mk, leg_mk))).alias("market_key"))
    cand = cand.join(mk, "market_key", "left_semi")
    return cand.groupBy("date_str", "market_key").agg(
        F.sum(F.coalesce(F.col("length"), F.lit(0))).cast("bigint").alias("size_bytes"),
        F.max("modificationTime").alias("as_of"))


def size_projection(day_sizes: DataFrame, target_mb_per_day: float = C.SIZE_TARGET_MB_PER_DAY) -> DataFrame:
    """Project each market-day to a full day at the rate seen so far (as of
    the day's last modification; elapsed >= 1 s) and flag days above the
    target (MB x 1024^2)."""
    day_start = F.unix_seconds(F.to_timestamp(F.col("date_str")))
    elapsed = F.greatest(F.lit(1.0), (F.unix_seconds(F.col("as_of").cast("timestamp")) - day_start).cast("double"))
    target = float(target_mb_per_day) * 1024.0 * 1024.0
    proj = projected_daily_bytes(F.col("size_bytes"), elapsed)
    return day_sizes.select("date_str", "market_key", "size_bytes", elapsed.alias("elapsed_s"),
                            proj.alias("projected_bytes"), F.lit(target).alias("target_bytes"),
                            (proj > F.lit(target)).alias("warning"))


def growth_rates(snap_a: DataFrame, snap_b: DataFrame) -> DataFrame:
    """File growth between two listings of the same files: (size delta) /
    (time delta), the age floored at 1 ms."""
    a = snap_a.select("path", F.col("length").alias("len_a"), F.col("modificationTime").alias("t_a"))
    b = snap_b.select("path", F.col("length").alias("len_b"), F.col("modificationTime").alias("t_b"))
    j = a.join(b, "path", "inner")
    age = F.greatest(F.lit(0.001), (F.unix_micros(F.col("t_b").cast("timestamp")) - F.unix_micros(F.col("t_a").cast("timestamp"))) / F.lit(1e6))
    return j.select("path", F.col("len_b").alias("size_bytes"), age.alias("age_seconds"),
                    ((F.col("len_b") - F.col("len_a")) / age).alias("growth_bps"))


def next_parts(listing: DataFrame, new_files: DataFrame) -> DataFrame:
    """Names of new part files ``new_files`` (date_str, market_key, start, k):
    per (date, market) the parts go on after the largest one listed."""
    have = listing.select(F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("date_str"), F.regexp_extract("path", "([^/]+)$", 1).alias("name"))
    part = F.regexp_extract("name", C.ROTATED_FILE_RE, 3)
    most = have.filter(part != "").groupBy("date_str", F.regexp_extract("name", C.ROTATED_FILE_RE, 1).alias("market_key")).agg(
        F.max(part.cast("int")).alias("most"))
    order = Window.partitionBy("date_str", "market_key").orderBy("start", "k")
    n = new_files.join(most, ["date_str", "market_key"], "left").withColumn(
        "part", F.coalesce("most", F.lit(0)) + F.row_number().over(order))
    name = F.format_string("%s__start_%s__part_%04d.ndjson.zst", F.col("market_key"), compact_stamp("start"), F.col("part"))
    return n.select("date_str", "market_key", "k", "part", name.alias("filename"))
