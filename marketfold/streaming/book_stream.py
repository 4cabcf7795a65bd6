"""Level-2 order book of a stream, in keyed state.

Book ops (``operators.book.book_ops`` with marks) are grouped by product; a
product's state is two maps, price -> size, one per side, in the RocksDB state
store.  A snapshot list clears its side and loads its levels, an update sets or
deletes a level, a mark reads the best prices of both sides.  Only levels that
changed in a micro-batch are written back; a restart goes on from the store.
Ops travel to the fold packed by the batch (``pack_ops``), so that it takes
columns of them, not one row after the other.

One product's messages depend on each other, so a product is folded by one
task; its work is what the micro-batch holds (``maxFilesPerTrigger`` on the
landing) plus the resting book.  Frames must land in order: a frame that lands
in a later micro-batch than its successors is applied when it lands.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marketfold.functions import constants as C
from marketfold.operators.book import MARK, _Side, book_ops
from marketfold.operators.canonical import conform
from marketfold.operators.spot_parser import product_market_map
from marketfold.session import NO_WHOLE_STAGE

# A micro-batch saves what it changed; whole copies of the state follow in the background.
# As in the batch, the frames are parsed without fused methods: they would be too large to be compiled.
STATE_STORE = {**NO_WHOLE_STAGE,
               "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
BEST_SCHEMA = "product string, seq long, i int, recv_us long, event_us long, bid double, ask double"
PACKED_SCHEMA = "product string, ops binary"
_ORDER = ["seq", "i", "phase", "j"]
# Ops of a product that are Python values at a time.
_SLICE = 50_000


class StoredSide(_Side):
    """A side of the book that is loaded from, and saved to, a map state."""

    def __init__(self, sign: int, state):
        super().__init__(sign)
        self.state = state
        self.stored = {price: size for (price,), (size,) in state.iterator()}
        for price, size in self.stored.items():
            self.put(price, size)

    def save(self) -> None:
        for price in self.stored.keys() - self.sizes.keys():
            self.state.removeKey((price,))
        for price, size in self.sizes.items():
            if self.stored.get(price) != size:
                self.state.updateValue((price,), (size,))


class BookProcessor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.states = [handle.getMapState(name, "price double", "size double") for name in ("bids", "asks")]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ops = pa.concat_tables(pa.ipc.open_stream(packed).read_all() for pdf in rows for packed in pdf["ops"])
        ops = ops.take(pc.sort_indices(ops, sort_keys=[(c, "ascending") for c in _ORDER]))
        bid_side, ask_side = StoredSide(-1, self.states[0]), StoredSide(1, self.states[1])
        for part in ops.to_batches(max_chunksize=_SLICE):
            at, bids, asks = [], [], []
            columns = (part[c].to_numpy(zero_copy_only=False).tolist() for c in ("phase", "is_bid", "price", "size", "is_reset"))
            for n, (phase, is_bid, price, size, reset) in enumerate(zip(*columns)):
                if phase == MARK:
                    bid, ask = bid_side.best(), ask_side.best()
                    if bid is not None or ask is not None:
                        at.append(n)
                        bids.append(bid)
                        asks.append(ask)
                    continue
                side = bid_side if is_bid else ask_side
                if reset:
                    side.clear()
                elif size > 0:
                    side.put(price, size)
                else:
                    side.sizes.pop(price, None)
            # Int64: numbers stay whole where some are missing.
            out = part.select(["seq", "i", "recv_us", "event_us"]).take(pa.array(at, pa.int64())).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
            out.insert(0, "product", key[0])
            yield out.assign(bid=pd.Series(bids, index=out.index, dtype="float64"), ask=pd.Series(asks, index=out.index, dtype="float64"))
        for side in (bid_side, ask_side):
            side.save()

    def close(self) -> None:
        pass


def pack_ops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each product's ops in a batch -> one row, an Arrow stream of them."""
    for batch in batches:
        for product in pc.unique(batch["product"]):
            part = batch.filter(pc.equal(batch["product"], product)).drop_columns(["product"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
                writer.write_batch(part)
            yield pa.record_batch([pa.array([product.as_py()]), pa.array([sink.getvalue().to_pybytes()])], names=["product", "ops"])


def best_per_message(frames: DataFrame) -> DataFrame:
    """Streaming counterpart of ``operators.book.best_per_message``: the same
    canonical ``book_update`` rows from streamed frames."""
    # Landed files differ in size and parsing costs most: frames are dealt out evenly.
    ops = book_ops(frames.repartition("seq", "value"), materialize=False, marks=True).select(
        "product", "seq", "i", "phase", "j", "recv_us", "event_us", F.coalesce(F.col("side") == "bid", F.lit(False)).alias("is_bid"), "price", "size", "is_reset")
    best = ops.mapInArrow(pack_ops, PACKED_SCHEMA).groupBy("product").transformWithStateInPandas(BookProcessor(), BEST_SCHEMA, "Append", "None")
    return conform(best.select(
        "seq", (F.col("i").cast("bigint") * F.lit(1 << 20)).alias("pos"), F.floor(F.col("recv_us") / F.lit(1_000_000)).cast("bigint").alias("recv_s"),
        F.lit(C.SPOT_VENUE).alias("venue"), F.element_at(product_market_map(), F.col("product")).alias("market_key"), F.lit("book_update").alias("kind"),
        "event_us", F.col("product").alias("product_id"), "bid", "ask"))
