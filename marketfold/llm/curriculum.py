"""Mixing sources to target weights along a training curriculum.

Every source has a target (words the mix takes from it) and a weight schedule
over training time.  Integrating a schedule gives the share of the source's
target that is due by time t; a document's place in its source's queue (a
running sum of sizes in a pseudo-random order, repeated as often as the target
asks) is a cumulative demand, and inverting the integral gives the training
position at which the mix reaches it.  Documents are range-sorted by position.

DataFrame functions only.  Running sums never gather a source: documents are
cut into (source, bucket) groups by a digest of their id, bucket totals are
summed up first, and the sum inside a bucket starts from there.

Defined results: null or empty text has size 0 and is never taken; a null
source is a source of its own, ordered last; equal ids are ordered by text;
with no words at all every target is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketfold.llm.common import SPACE_CLASS, text_or_empty, unpacked
from marketfold.session import cut_lineage

# Fixed values of the mix: weights repeat over the ordered sources, the mix is
# 150 % of all words, and no source is taken more than twice.
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2


@dataclass(frozen=True)
class Schedule:
    """Piecewise-linear weight over training time 0 .. 1, as (time, weight) knots."""
    knots: tuple[tuple[float, float], ...]

    def pieces(self) -> list[tuple[float, float, float, float, float]]:
        """(share due at the piece's start, its end, start time, start weight, slope), shares of the whole integral."""
        area = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:])]
        whole, done, out = sum(area), 0.0, []
        for (t0, w0), (t1, w1), a in zip(self.knots, self.knots[1:], area):
            out.append((done / whole, (done + a) / whole, t0, w0 / whole, (w1 - w0) / (t1 - t0) / whole))
            done += a
        return out

    def time_of(self, share: Column) -> Column:
        """Inverse of the integral: the time by which ``share`` is due."""
        pieces = self.pieces()
        when = None
        for k, (lo, hi, t0, w0, slope) in enumerate(pieces):
            due = F.greatest(share - F.lit(lo), F.lit(0.0))
            # w0 * x + slope * x^2 / 2 = due, in the form that also holds for slope 0
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * due, F.lit(0.0)))
            t = F.lit(t0) + F.when(due > 0, 2 * due / (F.lit(w0) + root)).otherwise(F.lit(0.0))
            if k == len(pieces) - 1:
                when = t if when is None else when.otherwise(t)
            else:
                when = F.when(share < hi, t) if when is None else when.when(share < hi, t)
        return F.least(when, F.lit(1.0))


# The curriculum: heavy sources first and fading, middle ones steady, light ones rising.
SCHEDULES = (Schedule(((0.0, 2.0), (0.6, 1.0), (1.0, 0.5))),
             Schedule(((0.0, 1.0), (1.0, 1.0))),
             Schedule(((0.0, 0.5), (0.5, 1.0), (1.0, 2.0))))


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row per source of the table (source, size): ``source_size``,
    ``rank`` (by code point, null last), ``weight`` and ``target``.

    Sharing by weight with caps and resharing the excess until none is above
    ends at targets ``min(cap, level * weight)``.  Sources are taken in the
    order of cap / weight; the level is (what is left after the full ones)
    over (the weight of the rest) at the first source that it does not fill."""
    per = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))  # one row per source
    per = per.withColumn("rank", F.row_number().over(order) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double"))
    cap = F.col("source_size") * F.lit(repeats)
    fill = Window.orderBy(cap / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(share)
    per = per.withColumn("cap", cap).withColumn("total", total)
    per = per.withColumn("full", F.coalesce(F.sum("cap").over(fill), F.lit(0)))
    per = per.withColumn("rest", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fill), F.lit(0.0)))
    per = per.withColumn("level", (F.col("total") - F.col("full")) / F.col("rest"))
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level").alias("level")))).over(everything)
    per = per.withColumn("level", level["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
    return per.select("source", "source_size", "rank", "weight", target.alias("target"))


def _key_of_source() -> Column:
    """The source as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select(F.col("source").alias("_source"), _key_of_source().alias("_s"), size_of(text_or_empty()).alias("_size"), key.alias("_key"),
                       F.col("doc_id").cast("long").alias("_doc"), F.xxhash64(text_or_empty()).alias("_tie"), *more)


def _row_of(columns: list[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")


class MixPlan:
    """Targets of the sources and the queue places of their documents.

    ``sizes`` holds a narrow row per document; sources and buckets are summed
    up from it once, for any number of tables to be placed."""

    def __init__(self, docs: DataFrame):
        self.sizes = cut_lineage(_sized(docs, _row_of(["doc_id"])), "mix-sizes")
        n = self.sizes.count()
        # About as many buckets as a bucket has rows: hexadecimal digits of the digest.
        digits = max(1, math.ceil(math.log(max(n, 1), 16) / 2))
        self.bucket = F.substring("_key", 1, digits)
        targets = cut_lineage(source_targets(self.sizes.select(F.col("_source").alias("source"), F.col("_size").alias("size"))), "mix-targets")
        totals = self.sizes.groupBy("_s", self.bucket.alias("_bucket")).agg(F.sum("_size").alias("_sum"))
        before = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = totals.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
        self.starts = cut_lineage(starts.join(targets.withColumn("_s", _key_of_source()).drop("source"), "_s"), "mix-buckets")

    def placed(self, sized: DataFrame) -> DataFrame:
        """``_row`` of the documents (``_sized``) plus ``_m``: size,
        source_size, target, rank, start (words of its source queued before it)."""
        # The join and the window share one partitioning, so the rows are shuffled once.
        joined = sized.withColumn("_bucket", self.bucket).join(self.starts, ["_s", "_bucket"])
        inside = Window.partitionBy("_s", "_bucket").orderBy("_key", F.col("_doc").asc_nulls_last(), "_tie") \
                       .rowsBetween(Window.unboundedPreceding, -1)
        start = F.col("_before") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
        return joined.withColumn("_start", start).select("_row", F.struct(
            F.col("_size").alias("size"), "source_size", "target", "rank", F.col("_start").alias("start")).alias("_m"))


def _words_due() -> Column:
    """Words that the mix owes this source: its target as a whole number."""
    return F.round(F.col("_m.target")).cast("long")


def _taken_in(lap: int) -> Column:
    """Words of the document taken on the given lap through its source."""
    left = _words_due() - F.lit(lap) * F.col("_m.source_size") - F.col("_m.start")
    return F.greatest(F.lit(0), F.least(F.col("_m.size"), left)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: sizes, its source's target, the words that the mix
    holds of it, counted in the texts of its rows, and the training position of
    its first row (null if never taken)."""
    docs = docs.select("doc_id", "text", "source")
    plan = MixPlan(docs)
    rows = training_rows(plan, docs)
    # The rows are in training order, so the lowest place is a document's first take.
    takes = rows.select("_m.rank", "_m.start", size_of(taken_text()).alias("words"), F.col("_take.at").alias("at"), F.monotonically_increasing_id().alias("place"))
    mixed = takes.groupBy("rank", "start").agg(F.sum("words").alias("words"), F.min_by("at", "place").alias("at"))
    # Documents with words differ in their start; one without words is not in the mix.
    m = plan.placed(plan.sizes).select("*", "_m.rank", F.when(F.col("_m.size") > 0, F.col("_m.start")).alias("start"))
    return unpacked(m.join(mixed, ["rank", "start"], "left"), ["doc_id"], F.col("_m.size").alias("size"), F.col("_m.source_size").alias("source_size"),
                    F.col("_m.target").alias("target"), F.coalesce("words", F.lit(0)).cast("long").alias("taken"), F.col("at").alias("position"))


def position(lap: int, schedules: tuple[Schedule, ...] = SCHEDULES) -> Column:
    """Training position (0 .. 1) of the document's take on the given lap."""
    share = F.try_divide(F.lit(lap) * F.col("_m.source_size") + F.col("_m.start"), F.col("_m.target"))
    kind = F.col("_m.rank") % len(schedules)
    out = F.when(kind == 0, schedules[0].time_of(share))
    for k, s in enumerate(schedules[1:], 1):
        out = out.when(kind == k, s.time_of(share))
    return out


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({SPACE_CLASS}*[^\\x20\\x09-\\x0D]+)"), F.lit(1)), F.lit(1), n.cast("int")), "")


def _is_part() -> Column:
    return F.col("_take.words") < F.col("_m.size")


def taken_text() -> Column:
    """The text of a row of the mix: the document's, cut at the words still due."""
    whole = F.col("_row.text")
    return F.when(_is_part(), first_words(whole, F.col("_take.words"))).otherwise(whole)


def training_rows(plan: MixPlan, docs: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES) -> DataFrame:
    """(_row, _m, _take): one row per take, range-partitioned and sorted by
    training position."""
    m = plan.placed(_sized(docs, _row_of(docs.columns)))
    takes = F.array(*[F.struct(_taken_in(lap).alias("words"), position(lap, schedules).alias("at"), F.lit(lap).alias("lap")) for lap in range(REPEATS)])
    rows = m.withColumn("_take", F.explode(F.filter(takes, lambda t: t["words"] > 0)))
    order = [F.col("_take.at"), F.col("_m.rank"), F.col("_take.lap"), F.col("_m.start"), F.col("_row.doc_id")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES) -> DataFrame:
    """Documents in training order: one row per take, columns as in ``docs``.

    The take at which a source's demand runs out holds only the words still
    due.  Rows are range-partitioned and sorted by position."""
    rows = training_rows(MixPlan(docs), docs, schedules)
    instead = {"text": taken_text()}
    if "n_chars" in docs.columns:
        instead["n_chars"] = F.when(_is_part(), F.length(instead["text"]).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
    return unpacked(rows, docs.columns, **instead)
