"""Level-2 order book (per product and side) as set operations.

Level-2 frames become *book ops*: ``(product, side, ord, price, size,
is_reset)`` where ``ord = (seq, i, phase, j)`` orders ops inside a frame
(bids snapshot, asks snapshot, then updates).  A snapshot list clears its
side (a reset row) and loads its levels (size > 0 only); an update sets a
level's absolute size, size <= 0 / missing deletes it; update side
``bid|buy|bids`` is the bid book, anything else the ask book.

* **epoch**: running count of resets per (product, side);
* **lifetime** of a level op: from its ``ord`` to the next op on the same
  (product, side, price) or the next reset, whichever comes first;
* **book as of t**: lifetimes containing t with size > 0 -> best = max bid
  / min ask.

Running counts and "next op" lookups are computed per (key, day) window
partition plus a small per-(key, day) summary carried across days, so a
busy product or price level is split by day, never one task for all time.
The per-message best bid/ask (a fold) runs in ``applyInPandas`` over
(product, chunk of messages) groups seeded with the levels alive at the
chunk start.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.functions import constants as C
from marketfold.functions import jsonv as J
from marketfold.operators.spot_parser import frame_envelope, product_market_map
from marketfold.session import NO_WHOLE_STAGE, cut_lineage

DAY_US = 86_400_000_000
# Window partitions of the book are cut per hour of arrival: a busy product
# (even one holding a third of all updates) is spread over many tasks.
BLOCK_US = 3_600_000_000


_OP_COLS = ["product", "market_key", "seq", "i", "recv_us", "event_us", "side", "phase", "j", "price", "size", "is_reset"]


def _finish_ops(df: DataFrame) -> DataFrame:
    return df.select(*_OP_COLS).select(
        "*", F.struct("seq", "i", "phase", "j").alias("ord"),
        F.floor(F.col("recv_us") / F.lit(DAY_US)).cast("bigint").alias("day"),
        F.floor(F.col("recv_us") / F.lit(BLOCK_US)).cast("bigint").alias("blk"))


_ELEM = "struct<side:string,phase:int,j:int,el:variant,is_reset:boolean>"


# Phase of the row that closes an event: where its best prices are read.
MARK = 9


def book_ops(frames: DataFrame, materialize: bool = True, marks: bool = False) -> DataFrame:
    """Level-2 frames -> ops (one row per reset / level / update), with
    ``marks`` also one row of phase ``MARK`` per event, after its ops.

    One pass: each event's snapshot lists and updates are tagged and
    concatenated into one element list, exploded once, and every JSON path
    is extracted once per element.  The ops table feeds several consumers
    (epoch counts, next-op lookups, resets), so it is materialised once into
    the checkpoint folder instead of re-parsing the frames per consumer."""
    # Only frames whose text can name the channel are parsed: it is spelled out
    # (in any case), or hidden in an escape.
    likely = F.lower("value").contains("level2") | F.col("value").contains("\\")
    env = J.fenced_filter(frame_envelope(frames.filter(likely)), F.col("channel") == "level2")
    ev = env.select("seq", "recv_us", F.col("fallback_us").alias("event_us"), F.posexplode("events").alias("i", "ev"))
    ev = J.extract(ev, "ev", {"x_pid": "$.product_id", "x_pidc": "$.productId", "x_bids": "$.bids",
                              "x_asks": "$.asks", "x_upd": "$.updates"})
    ev = ev.withColumn("product", J.p_norm(J.p_first(J.pair("x_pid"), J.pair("x_pidc")), upper=True))
    ev = J.fenced_filter(ev.withColumn("market_key", F.element_at(product_market_map(), F.col("product"))),
                         F.col("market_key").isNotNull())

    def tagged(name: str, side, phase: int, with_reset: bool):
        arr = J.p_array(J.pair(name))
        items = F.transform(F.coalesce(arr, F.array().cast("array<variant>")), lambda x, j: F.struct(
            F.lit(side).cast("string").alias("side"), F.lit(phase).alias("phase"), j.cast("int").alias("j"),
            x.alias("el"), F.lit(False).alias("is_reset")))
        if not with_reset:
            return items
        reset = F.array(F.struct(F.lit(side).alias("side"), F.lit(phase).alias("phase"), F.lit(-1).alias("j"),
                                 F.lit(None).cast("variant").alias("el"), F.lit(True).alias("is_reset")))
        return F.when(arr.isNotNull(), F.concat(reset, items)).otherwise(F.array().cast(f"array<{_ELEM}>"))

    elems = F.concat(tagged("x_bids", "bid", 0, True), tagged("x_asks", "ask", 1, True), tagged("x_upd", None, 2, False))
    if marks:
        elems = F.concat(elems, F.array(F.struct(F.lit(None).cast("string").alias("side"), F.lit(MARK).alias("phase"), F.lit(0).alias("j"),
                                                 F.lit(None).cast("variant").alias("el"), F.lit(False).alias("is_reset"))))
    base = ["product", "market_key", "seq", "i", "recv_us", "event_us"]
    x = ev.select(*base, F.explode(elems).alias("e")).select(*base, "e.*")
    x = x.withColumn("el_t", J.vtype(F.col("el")))
    x = J.extract(x, "el", {"l_p": "$.price", "l_pl": "$.price_level", "l_px": "$.px", "l_s": "$.size",
                            "l_nq": "$.new_quantity", "l_q": "$.qty", "l_0": "$[0]", "l_1": "$[1]",
                            "u_sd": "$.side", "u_bs": "$.book_side"})
    is_obj = F.coalesce(F.col("el_t").startswith("OBJECT"), F.lit(False))
    is_pair = F.coalesce(F.col("el_t").startswith("ARRAY"), F.lit(False)) & F.col("l_1").isNotNull()
    snap, mark = F.col("phase") < 2, F.col("phase") == MARK
    # snapshot levels: price|price_level, size|new_quantity|qty (or [px, qty]);
    # updates: price_level|price|px, new_quantity|size|qty.
    price = (F.when(snap & is_obj, J.p_float(J.p_first(J.pair("l_p"), J.pair("l_pl"))))
              .when(snap & is_pair, J.p_float(J.pair("l_0")))
              .when(~snap & is_obj, J.p_float(J.p_first(J.pair("l_pl"), J.pair("l_p"), J.pair("l_px")))))
    size = (F.when(snap & is_obj, J.p_float(J.p_first(J.pair("l_s"), J.pair("l_nq"), J.pair("l_q"))))
             .when(snap & is_pair, J.p_float(J.pair("l_1")))
             .when(~snap & is_obj, J.p_float(J.p_first(J.pair("l_nq"), J.pair("l_s"), J.pair("l_q")))))
    upd_side = F.when(J.p_norm(J.p_first(J.pair("u_sd"), J.pair("u_bs"))).isin(*C.BID_SIDES), F.lit("bid")).otherwise(F.lit("ask"))
    x = x.select(*base, F.when(snap, F.col("side")).when(~mark, upd_side).alias("side"), "phase", "j", "is_reset",
                 price.alias("price"), size.alias("size"))
    keep = (F.col("is_reset") | mark
            | (snap & F.col("price").isNotNull() & F.col("size").isNotNull() & (F.col("size") > 0))
            | (~snap & F.col("price").isNotNull()))
    x = J.fenced_filter(x, keep).withColumn("size", F.when(F.col("size") > 0, F.col("size")).otherwise(F.lit(0.0)))
    x = x.withColumn("price", F.when(~F.col("is_reset"), F.col("price")))
    ops = _finish_ops(x)
    return cut_lineage(ops, "book_ops", NO_WHOLE_STAGE) if materialize else ops


def running_count(df: DataFrame, keys: list[str], flag: str, out: str) -> DataFrame:
    """Running count of ``flag`` rows per ``keys`` in ``ord`` order, split by
    ``blk`` (hour): in-day window + offsets from a (keys x days) summary."""
    per_day = df.groupBy(*keys, "blk").agg(F.sum(F.col(flag).cast("int")).alias("_n"))
    w_days = Window.partitionBy(*keys).orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    per_day = per_day.select(*keys, "blk", F.coalesce(F.sum("_n").over(w_days), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*keys, "blk").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("_in", F.sum(F.col(flag).cast("int")).over(w))
    return d.join(per_day, [*keys, "blk"], "left").withColumn(out, F.col("_off") + F.col("_in")).drop("_off", "_in")


def next_in_key(df: DataFrame, keys: list[str], out: str, carry: tuple[str, ...] = ("recv_us",)) -> DataFrame:
    """For each row: the next row with the same ``keys`` in ``ord`` order, as
    a struct ``(ord, *carry)`` (NULL for the last).  In-day ``lead`` plus,
    for each day's last row, the first row of the key's next active day
    (from a keys x days summary)."""
    nx = F.struct(F.col("ord").alias("ord"), *[F.col(c).alias(c) for c in carry])
    w = Window.partitionBy(*keys, "blk").orderBy("ord")
    d = df.withColumn("_lead", F.lead(nx).over(w))
    firsts = df.groupBy(*keys, "blk").agg(F.min(nx).alias("_first"))
    w_days = Window.partitionBy(*keys).orderBy("blk")
    nxt = firsts.select(*keys, "blk", F.lead("_first").over(w_days).alias("_next_day_first"))
    d = d.join(nxt, [*keys, "blk"], "left")
    return d.withColumn(out, F.coalesce(F.col("_lead"), F.col("_next_day_first"))).drop("_lead", "_next_day_first")


def level_lifetimes(ops: DataFrame, carry: tuple[str, ...] = ("recv_us",)) -> DataFrame:
    """Lifetime of every level op: [valid_from, valid_to) in ``ord`` terms,
    cut at the next reset of its side (``valid_to`` is a struct with the
    ending op's ``ord`` and ``carry`` columns).  Deletions are kept
    (size 0); consumers filter ``size > 0``."""
    keys = ["product", "side"]
    e = running_count(ops, keys, "is_reset", "epoch")
    nx = F.struct(F.col("ord").alias("ord"), *[F.col(c).alias(c) for c in carry])
    resets = e.filter("is_reset").select(*keys, (F.col("epoch") - 1).alias("epoch"), nx.alias("next_reset"))
    lv = e.filter(~F.col("is_reset"))
    lv = next_in_key(lv, keys + ["epoch", "price"], "next_same", carry)
    lv = lv.join(resets, keys + ["epoch"], "left")
    valid_to = F.when(F.col("next_same").isNull(), F.col("next_reset")).when(
        F.col("next_reset").isNull(), F.col("next_same")).otherwise(F.least("next_same", "next_reset"))
    return lv.select("product", "market_key", "side", "epoch", "price", "size", "seq", *carry,
                     F.col("ord").alias("valid_from"), valid_to.alias("valid_to"))


def book_as_of_day_end(ops: DataFrame) -> DataFrame:
    """Book at the end of every UTC day from a product's first to its last
    day with level-2 traffic: a level is alive at the end of day ``d`` when
    it arrived on or before ``d`` and the op ending it arrived after ``d``
    (or never).  Each lifetime is exploded over the day ends it covers
    (bounded by its own length).  Output per (product, side, day): best
    price (max bid / min ask) and level count."""
    lt = level_lifetimes(ops).filter(F.col("size") > 0)
    last = ops.groupBy("product").agg(F.max("day").alias("last_day"))
    lt = lt.join(last, "product", "left")
    from_day = F.floor(F.col("recv_us") / F.lit(DAY_US)).cast("bigint")
    to_day = F.coalesce(F.floor(F.col("valid_to.recv_us") / F.lit(DAY_US)).cast("bigint") - 1, F.col("last_day"))
    lt = lt.filter(to_day >= from_day).select("product", "side", "price",
                                              F.explode(F.sequence(from_day, to_day)).alias("day"))
    return lt.groupBy("product", "side", "day").agg(
        F.when(F.first("side") == "bid", F.max("price")).otherwise(F.min("price")).alias("best_price"),
        F.count(F.lit(1)).alias("levels"))


# --- per-message fold ---------------------------------------------------------

FOLD_SCHEMA = T.StructType([
    T.StructField("product", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("i", T.IntegerType()),
    T.StructField("bid", T.DoubleType()), T.StructField("ask", T.DoubleType()),
])


class _Side:
    """One side of a book: sizes by price, and a heap whose dead entries are
    dropped when they come to its top."""

    def __init__(self, sign: int):
        self.sign, self.sizes, self.heap = sign, {}, []

    def put(self, price: float, size: float) -> None:
        if price not in self.sizes:
            heapq.heappush(self.heap, self.sign * price)
        self.sizes[price] = size

    def clear(self) -> None:
        self.sizes, self.heap = {}, []

    def best(self):
        while self.heap and self.sign * self.heap[0] not in self.sizes:
            heapq.heappop(self.heap)
        return self.sign * self.heap[0] if self.heap else None


def _fold(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sequential book fold inside one (product, chunk) group."""
    pdf = pdf.sort_values(["kind_order", "seq", "i", "phase", "j"], kind="mergesort")
    books = {"bid": _Side(-1), "ask": _Side(1)}
    out = []
    for kind, side, price, size, seq, i in zip(*(pdf[c].tolist() for c in ("kind", "side", "price", "size", "seq", "i"))):
        if kind == "mark":
            b, a = books["bid"].best(), books["ask"].best()
            if b is not None or a is not None:
                out.append((seq, i, b, a))
        elif kind == "reset":
            books[side].clear()
        elif size > 0:
            books[side].put(price, size)
        else:
            books[side].sizes.pop(price, None)
    seqs, places, bids, asks = zip(*out) if out else ((), (), (), ())
    product = pdf["product"].iloc[0] if len(pdf) else None
    return pd.DataFrame({"product": [product] * len(out), "seq": pd.Series(seqs, dtype="int64"), "i": pd.Series(places, dtype="int32"),
                         "bid": pd.Series(bids, dtype="float64"), "ask": pd.Series(asks, dtype="float64")})


def best_per_message(frames: DataFrame, chunk_events: int = 50_000) -> DataFrame:
    """Best bid/ask after every level-2 event (book_update canonical rows;
    events leaving both sides empty emit nothing).

    Events are numbered per product (bounded per-day windows) and cut into
    chunks of ``chunk_events``; each (product, chunk) group is folded in
    pandas, seeded with the levels alive at the chunk start (lifetimes that
    cross the boundary), so no group holds more than one chunk of events
    plus the resting book."""
    from marketfold.operators.batches import number_rows
    from marketfold.operators.canonical import conform

    ops = book_ops(frames, marks=True)
    evs = ops.filter(F.col("phase") == MARK).select("product", "market_key", "seq", "i", "recv_us", F.col("event_us").alias("fallback_us"))
    ops = ops.filter(F.col("phase") < MARK)
    # Numbered, like the ops, by seq: in blocks of a million frames.
    evs = number_rows(evs, ["product"], "seq", day_seconds=1_000_000, tiebreak=("i",))
    evs = cut_lineage(evs.withColumn("chunk", F.floor((F.col("rn") - 1) / F.lit(int(chunk_events))).cast("bigint")))
    chunk_of = evs.select("product", "seq", "i", "chunk")
    ops = ops.join(chunk_of, ["product", "seq", "i"], "inner")
    lt = level_lifetimes(ops, carry=("recv_us", "chunk")).filter(F.col("size") > 0)
    # seed rows: a level alive across the start of chunk c (c after its own
    # chunk, up to the chunk of the op ending it)
    lt = lt.withColumn("c_from", F.col("chunk") + 1).withColumn(
        "c_to", F.coalesce(F.col("valid_to.chunk"), F.lit(None)))
    last_chunk = chunk_of.groupBy("product").agg(F.max("chunk").alias("last_chunk"))
    lt = lt.join(last_chunk, "product", "left").withColumn("c_to", F.coalesce(F.col("c_to"), F.col("last_chunk")))
    seeds = lt.filter(F.col("c_to") >= F.col("c_from")).select(
        "product", F.explode(F.sequence("c_from", "c_to")).alias("chunk"), "side", "price", "size")
    cols = ["product", "chunk", "kind", "kind_order", "seq", "i", "phase", "j", "side", "price", "size"]
    seed_rows = seeds.select("product", "chunk", F.lit("init").alias("kind"), F.lit(0).alias("kind_order"),
                             F.lit(-1).cast("bigint").alias("seq"), F.lit(-1).alias("i"), F.lit(-1).alias("phase"),
                             F.lit(-1).alias("j"), "side", "price", "size")
    op_rows = ops.select("product", "chunk", F.when(F.col("is_reset"), F.lit("reset")).otherwise(F.lit("level")).alias("kind"),
                         F.lit(1).alias("kind_order"), "seq", "i", "phase", "j", "side", "price", "size")
    marks = evs.select("product", "chunk", F.lit("mark").alias("kind"), F.lit(1).alias("kind_order"), "seq", "i",
                       F.lit(MARK).alias("phase"), F.lit(0).alias("j"), F.lit(None).cast("string").alias("side"),
                       F.lit(None).cast("double").alias("price"), F.lit(None).cast("double").alias("size"))
    rows = seed_rows.select(*cols).unionByName(op_rows.select(*cols)).unionByName(marks.select(*cols))
    best = rows.groupBy("product", "chunk").applyInPandas(_fold, FOLD_SCHEMA)
    meta = evs.select("product", "market_key", "seq", "i", "recv_us", F.col("fallback_us").alias("event_us"))
    out = best.join(meta, ["product", "seq", "i"], "inner")
    out = out.select(F.col("seq"), (F.col("i").cast("bigint") * F.lit(1 << 20)).alias("pos"),
                     F.floor(F.col("recv_us") / F.lit(1_000_000)).cast("bigint").alias("recv_s"),
                     F.lit(C.SPOT_VENUE).alias("venue"), "market_key", F.lit("book_update").alias("kind"), "event_us",
                     F.col("product").alias("product_id"), "bid", "ask")
    return conform(out)
