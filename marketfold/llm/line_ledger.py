"""Line dedup that can be extended and undone.

A line's key is the line without white space at both ends, A-Z lower-cased;
keys of at least ``MIN_CHARS`` code points count.  The ledger keeps, sharded by
key digest:

* ``postings``  (key, id, row): which document, and which text of it, holds which key;
* ``filters``   one cuckoo filter per shard with an entry for every held key;
* ``refs``      exact reference counts (key, refs, first) of the keys that two
  or more documents hold.  A key that the filter knows but this table does not
  has one reference.

Inserting documents asks the shard's filter for every key (once per
key, not once per document): unknown keys are new; known ones are looked up in
the postings, and those held there are recounted exactly.  Every new key gets
an entry of its own, also where the filter has an equal one.  Deleting documents takes
their postings away, recounts the keys of ``refs`` they held and
deletes from the filters the keys that nobody holds any more.  So a filter's
false positive costs a look-up and never changes a result.

Postings of a key that very many documents hold are only ever aggregated (map
side first) or joined by sort-merge, where Spark splits skewed partitions.

Defined results: null or empty text is one empty line and loses nothing; rows
that repeat a ``doc_id`` are one holder; documents without an id are one
holder, ranked last; lines of white space only have the empty key and stay.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.llm.common import ASCII_LOWER, SPACE, byte_texts, id_back, id_key, packed, rebatched, row_mark, row_texts, unpacked
from marketfold.session import cut_lineage

MIN_CHARS = 10
KEYS_PER_SHARD = 50_000


class CuckooFilter:
    """Set of 128-bit keys as 16-bit fingerprints, four to a bucket.

    No false negatives; entries can be deleted.  An entry that finds no place
    after ``KICKS`` moves goes to a list of its own (``stash``)."""

    WAYS, KICKS = 4, 200

    def __init__(self, capacity: int = 0, data: bytes | None = None):
        if data is not None:
            self.buckets = int.from_bytes(data[:4], "little")
            n = int.from_bytes(data[4:8], "little")
            self.stash = [(int.from_bytes(data[8 + 6 * i:12 + 6 * i], "little"), int.from_bytes(data[12 + 6 * i:14 + 6 * i], "little")) for i in range(n)]
            self.slots = array("H")
            self.slots.frombytes(data[8 + 6 * n:])
        else:
            self.buckets = 1 << max(1, (int(capacity / (self.WAYS * 0.85)) | 1).bit_length())
            self.stash: list[tuple[int, int]] = []
            self.slots = array("H", bytes(2 * self.WAYS * self.buckets))
        self.turn = 0

    def to_bytes(self) -> bytes:
        stash = b"".join(i.to_bytes(4, "little") + f.to_bytes(2, "little") for i, f in self.stash)
        return self.buckets.to_bytes(4, "little") + len(self.stash).to_bytes(4, "little") + stash + self.slots.tobytes()

    def _place(self, key: bytes) -> tuple[int, int]:
        fingerprint = int.from_bytes(key[4:6], "little") or 1
        return int.from_bytes(key[6:10], "little") & (self.buckets - 1), fingerprint

    def _other(self, i: int, fingerprint: int) -> int:
        return (i ^ (fingerprint * 0x5BD1E995 & 0xFFFFFFFF)) & (self.buckets - 1)

    def _home(self, i: int, f: int) -> tuple[int, int]:
        """The stash names an entry by the smaller of its two buckets."""
        return min(i, self._other(i, f)), f

    def __contains__(self, key: bytes) -> bool:
        i, f = self._place(key)
        j, w, s = self._other(i, f), self.WAYS, self.slots
        return f in s[w * i:w * i + w] or f in s[w * j:w * j + w] or (bool(self.stash) and self._home(i, f) in self.stash)

    def _put(self, i: int, f: int) -> bool:
        for at in range(self.WAYS * i, self.WAYS * (i + 1)):
            if not self.slots[at]:
                self.slots[at] = f
                return True
        return False

    def add(self, key: bytes) -> None:
        i, f = self._place(key)
        if self._put(i, f) or self._put(i := self._other(i, f), f):
            return
        for _ in range(self.KICKS):
            self.turn = (self.turn * 1103515245 + 12345) & 0x7FFFFFFF
            at = self.WAYS * i + (self.turn >> 16) % self.WAYS
            f, self.slots[at] = self.slots[at], f
            i = self._other(i, f)
            if self._put(i, f):
                return
        self.stash.append(self._home(i, f))

    def remove(self, key: bytes) -> None:
        """Delete one entry of a key that has been added."""
        i, f = self._place(key)
        for b in (i, self._other(i, f)):
            for at in range(self.WAYS * b, self.WAYS * (b + 1)):
                if self.slots[at] == f:
                    self.slots[at] = 0
                    return
        if self._home(i, f) in self.stash:
            self.stash.remove(self._home(i, f))


def line_key(line: bytes) -> bytes | None:
    """128-bit digest of the line's key, None if the key is too short to count."""
    key = line.strip(SPACE.encode()).translate(ASCII_LOWER)
    if len(key) < MIN_CHARS or len(key) < 4 * MIN_CHARS and len(key.decode()) < MIN_CHARS:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, row, text) -> one row per text and distinct key."""
    for b in rebatched(batches):
        ids, rows, keys = [], [], []
        for doc, row, text in zip(b.column("id").to_pylist(), b.column("row").to_pylist(), byte_texts(b)):
            own = {k for line in text.split(b"\n") if (k := line_key(line))}
            ids += [doc] * len(own)
            rows += [row] * len(own)
            keys += sorted(own)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(rows, pa.int64())], names=["key", "id", "row"])


def postings_of(docs: DataFrame) -> DataFrame:
    slim = docs.select(id_key().alias("id"), row_mark().alias("row"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_postings, "key binary, id long, row long")


def _known(group: pa.Table) -> pa.Table:
    """One shard: the keys that its filter (if there is one) knows."""
    keys, slots = (group.column(c).to_pylist() for c in ("key", "slots"))
    old = next((s for s in slots if s is not None), None)
    kept = CuckooFilter(data=old) if old else ()
    return pa.table({"key": pa.array([k for k in keys if k is not None and k in kept], pa.binary())})


def _enter(group: pa.Table) -> pa.Table:
    """One shard: its filter (if there is one) with an entry for each of the
    given keys, which nobody held."""
    shard = group.column("shard")[0].as_py()
    keys, slots = (group.column(c).to_pylist() for c in ("key", "slots"))
    old = next((s for s in slots if s is not None), None)
    new = [k for k in keys if k is not None]
    kept = CuckooFilter(data=old) if old else CuckooFilter(capacity=max(2 * len(new), KEYS_PER_SHARD))
    for k in new:
        kept.add(k)
    return pa.table({"shard": pa.array([shard], pa.int32()), "slots": pa.array([kept.to_bytes()], pa.binary())})


def _forget(group: pa.Table) -> pa.Table:
    """One shard: its filter without the given keys."""
    shard = group.column("shard")[0].as_py()
    keys, slots = (group.column(c).to_pylist() for c in ("key", "slots"))
    kept = CuckooFilter(data=next(s for s in slots if s is not None))
    for k in keys:
        if k is not None:
            kept.remove(k)
    return pa.table({"shard": pa.array([shard], pa.int32()), "slots": pa.array([kept.to_bytes()], pa.binary())})


class LineLedger:
    """Ledger of the lines of a growing set of documents.  ``insert`` and
    ``delete`` return the next version; earlier versions stay readable."""

    def __init__(self, spark: SparkSession, shards: int | None = None):
        self.spark, self.shards = spark, shards
        self.postings: DataFrame | None = None  # key, id, row
        self.filters: DataFrame | None = None   # shard, slots
        self.refs: DataFrame | None = None      # key, refs, first

    def _next(self, postings: DataFrame, filters: DataFrame, refs: DataFrame) -> "LineLedger":
        new = LineLedger(self.spark, self.shards)
        new.postings, new.filters, new.refs = postings, filters, refs
        return new

    def _shard(self):
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard")

    def _count(self, postings: DataFrame, keys: DataFrame) -> DataFrame:
        """Exact references of the given keys, where two or more hold them
        (a document whose rows repeat counts once a row)."""
        held = postings.join(keys, "key").groupBy("key").agg(F.count("id").alias("refs"), F.min("id").alias("first"), F.max("id").alias("last"))
        return held.filter("first < last").select("key", "refs", "first")

    def insert(self, docs: DataFrame) -> "LineLedger":
        new = cut_lineage(postings_of(docs), "ledger-postings")
        per_key = new.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
        if self.shards is None:
            self.shards = max(1, -(-new.count() // KEYS_PER_SHARD))
        per_key = cut_lineage(per_key, "ledger-keys")
        asked = per_key.select(self._shard(), "key", F.lit(None).cast("binary").alias("slots"))
        entered, known = asked, per_key.filter("first < last").select("key")
        if self.filters is not None:
            with_filters = self.filters.select("shard", F.lit(None).cast("binary").alias("key"), "slots")
            seen = cut_lineage(asked.unionByName(with_filters).groupBy("shard").applyInArrow(_known, "key binary"), "ledger-seen")
            held = cut_lineage(self.postings.join(seen, "key", "left_semi").select("key").distinct(), "ledger-held")
            entered = asked.join(held, "key", "left_anti").select("shard", "key", "slots").unionByName(with_filters)
            known = known.unionByName(held).distinct()
        filters = cut_lineage(entered.groupBy("shard").applyInArrow(_enter, "shard int, slots binary"), "ledger-filters")
        postings = new if self.postings is None else self.postings.unionByName(new)
        counted = cut_lineage(self._count(postings, known), "ledger-refs")
        refs = counted if self.refs is None else cut_lineage(
            self.refs.join(known, "key", "left_anti").unionByName(counted), "ledger-refs")
        return self._next(postings, filters, refs)

    def delete(self, ids: DataFrame) -> "LineLedger":
        """Without the documents of the table ``ids`` (doc_id)."""
        gone = ids.select(id_key().alias("id")).distinct()
        left = cut_lineage(self.postings.join(gone, "id", "left_anti").select("key", "id", "row"), "ledger-postings")
        touched = cut_lineage(self.postings.join(gone, "id", "left_semi").select("key").distinct(), "ledger-touched")
        still = left.join(touched, "key", "left_semi").select("key").distinct()
        unheld = touched.join(still, "key", "left_anti")
        asked = unheld.select(self._shard(), "key", F.lit(None).cast("binary").alias("slots")).unionByName(
            self.filters.select("shard", F.lit(None).cast("binary").alias("key"), "slots"))
        filters = cut_lineage(asked.groupBy("shard").applyInArrow(_forget, "shard int, slots binary"), "ledger-filters")
        recount = self._count(left, self.refs.join(touched, "key", "left_semi").select("key"))
        refs = cut_lineage(self.refs.join(touched, "key", "left_anti").unionByName(recount), "ledger-refs")
        return self._next(left, filters, refs)

    def dropped_keys(self, docs: DataFrame | None = None) -> DataFrame:
        """(id, row, keys): the keys that each text loses, because its document
        holds them in the ledger and a smaller id does too; of the inserted
        texts, or of ``docs``.  Gathered per text, as all rows without an id are
        one holder."""
        held = self.postings if docs is None else postings_of(docs).join(self.postings.select("key", "id"), ["key", "id"], "left_semi")
        lost = held.join(self.refs, "key").filter("id > first").select("id", "row", "key")
        return lost.groupBy("id", "row").agg(F.collect_set("key").alias("keys"))

    def clean(self, docs: DataFrame, as_inserted: bool = False) -> DataFrame:
        """The documents as ``_row`` plus ``_kept`` (its text without repeated
        lines), ``_lines`` and ``_dropped`` (counts).  ``as_inserted``: their
        texts are the inserted ones, so their keys need not be taken again."""
        drops = self.dropped_keys(None if as_inserted else docs).select(F.col("id").alias("_id"), F.col("row").alias("_mark"), F.col("keys").alias("_keys"))
        rows = packed(docs, id_key().alias("_id"), row_mark().alias("_mark"))
        added = [T.StructField("_kept", T.StringType()), T.StructField("_lines", T.LongType()), T.StructField("_dropped", T.LongType())]
        return rows.join(drops, ["_id", "_mark"], "left").mapInArrow(_drop_lines, T.StructType([rows.schema["_row"], *added]))

    def remove_repeats(self, docs: DataFrame) -> DataFrame:
        """``docs`` without their repeated lines, columns as they were."""
        text = F.when(F.col("_row.text").isNotNull(), F.col("_kept"))
        return unpacked(self.clean(docs), docs.columns, text=text)


def _drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in rebatched(batches):
        kept, n_lines, n_dropped = [], [], []
        for text, keys in zip(row_texts(b), b.column("_keys").to_pylist()):
            lines = text.split(b"\n")
            stay = lines
            if keys:
                gone = set(keys)
                stay = [x for x in lines if line_key(x) not in gone]
            kept.append((text if len(stay) == len(lines) else b"\n".join(stay)).decode())
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                                         names=["_row", "_kept", "_lines", "_dropped"])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: lines, lines dropped, digest of the kept text."""
    docs = docs.select(id_back(id_key()).alias("doc_id"), "text")
    cleaned = LineLedger(docs.sparkSession).insert(docs).clean(docs, as_inserted=True)
    return unpacked(cleaned, ["doc_id"], F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
                          F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))
