"""Filter interaction audit on a sparse document-term matrix.

How much does each of several filters remove, alone and after the others, in
every order of application?

1. Documents are read in blocks of ``BLOCK_BYTES`` of text.  A block numbers
   its own words and becomes a CSR matrix over these numbers; only its distinct
   words travel, one row each, however often they occur.
2. The words of all blocks are numbered globally (dense, in (shard, word) order,
   shards by hash), and each block's numbers are replaced: CSR shards over one
   dictionary.  A word that is in every block has one row per block.
3. Row sums (words) and nonzero counts (distinct words) decide filters A and B;
   C, D and the text's digest were taken when the text was read.
4. E (an identical text under a smaller id) needs the table-wide smallest id per
   digest: copies are counted per (digest, part, labels) before that, so a group
   of copies with a third of the rows is summed up map-side.
5. Documents become counts per part and pattern of failed filters, at most 32
   patterns for five filters; every order's steps follow from these.

Texts are identical when their 128-bit digests are.

Defined results: null text is empty (A fails, B and C and D do not: 0 of 0); a
null source is the part ``""``; a null id ranks after all others, so a row
without an id fails E if a row with an id has its text, and never because of
another row without an id; rows that repeat an id and a text do not fail E for
each other and count each; a document is good (toxic) if any of its label rows
says so, rows without an id have no labels; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.llm.common import SMALL_BATCHES, UPPER, byte_slices, id_key, row_texts
from marketfold.session import cut_lineage

BLOCK_BYTES = 16 << 20
SHARD_ROWS = 20_000      # (block, word) rows that share a shard of the dictionary
WORD_ROWS = 1 << 16      # of a batch of words
LETTERS = "ABCDE"
# Fixed values of the filters.
MIN_WORDS, MIN_DISTINCT, MAX_UPPER, SYMBOLS = 50, 65, 5, b"#$%&*|"
_CAPITALS, _CONTINUATION = UPPER.encode(), bytes(range(0x80, 0xC0))

_FACTS = [("upper", T.LongType()), ("chars", T.LongType()), ("symbol", T.BooleanType()), ("digest", T.BinaryType())]
_CSR = [T.StructField(c, T.BinaryType()) for c in ("indptr", "indices", "counts")]


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(a.tobytes(), 1)


def _unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), dtype=kind)


def facts(text: bytes) -> tuple[int, int, bool, bytes]:
    """Capitals, code points, whether a symbol occurs, digest."""
    return (len(text) - len(text.translate(None, _CAPITALS)), len(text.translate(None, _CONTINUATION)),
            len(text.translate(None, SYMBOLS)) < len(text), hashlib.blake2b(text, digest_size=16).digest())


def sparse_rows(texts: list[bytes]) -> tuple[pa.StringArray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of the texts, and row lengths, column numbers and counts
    of their CSR rows over these words (Arrow's ASCII white space is that of
    ``bytes.split``)."""
    pieces = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
    owner, words = np.repeat(np.arange(len(texts), dtype=np.int64), pc.list_value_length(pieces).to_numpy()), pieces.flatten()
    full = pc.greater(pc.binary_length(words), 0)  # empty pieces at the ends of a text are no words
    encoded = words.filter(full).dictionary_encode()
    width = max(len(encoded.dictionary), 1)
    cells, counts = np.unique(owner[full.to_numpy(zero_copy_only=False)] * width + encoded.indices.to_numpy(), return_counts=True)
    return encoded.dictionary, np.bincount(cells // width, minlength=len(texts)), (cells % width).astype(np.int32), counts.astype(np.int32)


class _Block:
    """A block under construction: only distinct words and numbers are held, as
    arrays, not texts."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.size = schema, 0
        self.words, self.lengths, self.indices, self.counts, self.docs = [], [], [], [], []

    def add(self, batch: pa.RecordBatch) -> None:
        texts = row_texts(batch)
        self.size += sum(map(len, texts))
        for held, new in zip((self.words, self.lengths, self.indices, self.counts), sparse_rows(texts)):
            held.append(new)
        doc = self.schema.field("docs").type.value_type
        known = [pa.array(list(c), doc.field(name).type) for c, (name, _) in zip(zip(*map(facts, texts)), _FACTS)]
        self.docs.append(pa.StructArray.from_arrays([batch.column("_key"), *known], fields=list(doc)))

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        """The block's words, a row each, and then its matrix."""
        encoded = pa.concat_arrays(self.words).dictionary_encode()
        words, places = encoded.dictionary, np.split(encoded.indices.to_numpy(), np.cumsum([len(w) for w in self.words])[:-1])
        indices = np.concatenate([place[own] for place, own in zip(places, self.indices)])
        del encoded, places, self.words, self.indices
        for at in range(0, len(words), WORD_ROWS):
            part = words.slice(at, WORD_ROWS)
            yield self._batch(len(part), block=pa.array(np.full(len(part), number)), local=pa.array(np.arange(at, at + len(part), dtype=np.int32)), word=part)
        indptr = np.concatenate(([0], np.cumsum(np.concatenate(self.lengths)))).astype(np.int64)
        packed = {k: pa.array([_pack(a)], pa.binary()) for k, a in (("indptr", indptr), ("indices", indices), ("counts", np.concatenate(self.counts)))}
        docs = pa.concat_arrays(self.docs)
        docs = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs).cast(self.schema.field("docs").type)
        yield self._batch(1, block=pa.array([number], pa.int64()), docs=docs, **packed)

    def _batch(self, rows: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)) for f in self.schema], schema=self.schema)


def _block_rows(schema: pa.Schema):
    """Map packed rows to blocks: CSR over the block's own word numbers."""
    def run(batches):
        first, done, block = TaskContext.get().partitionId() << 32, 0, _Block(schema)
        for b in byte_slices(batches, BLOCK_BYTES // 16):
            block.add(b)
            if block.size >= BLOCK_BYTES:
                yield from block.rows(first + done)
                done, block = done + 1, _Block(schema)
                pa.default_memory_pool().release_unused()
        if block.docs:
            yield from block.rows(first + done)
            block = None
            pa.default_memory_pool().release_unused()
    return run


def encoded_blocks(docs: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Per block a row with its CSR arrays and per document the key columns and
    facts, and a row (``local``, ``word``) for each of its words; materialised,
    as block numbers must not change."""
    from pyspark.sql.pandas.types import to_arrow_schema
    rows = docs.select(F.struct(F.col("text").cast("string").alias("text")).alias("_row"), F.struct(*keys).alias("_key"))
    doc = T.StructType([rows.schema["_key"], *[T.StructField(n, t) for n, t in _FACTS]])
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("local", T.IntegerType()), T.StructField("word", T.StringType()), *_CSR,
                           T.StructField("docs", T.ArrayType(doc))])
    return cut_lineage(rows.mapInArrow(_block_rows(to_arrow_schema(schema)), schema), "term-blocks", SMALL_BATCHES)


def word_ids(blocks: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(block, local, id): the global number of every block's words."""
    words = blocks.filter(F.col("local").isNotNull()).select("block", "local", "word")
    shards = max(1, -(-words.count() // shard_rows))
    words = words.withColumn("shard", F.pmod(F.xxhash64("word"), F.lit(shards)))
    ranked = words.withColumn("rank", F.dense_rank().over(Window.partitionBy("shard").orderBy("word")))
    ranked = cut_lineage(ranked.select("block", "local", "shard", "rank"), "term-ranks")
    # Running sums of the shards' sizes, in groups of shards and over the groups.
    sizes = ranked.groupBy("shard").agg(F.max("rank").cast("long").alias("n")).withColumn("g", F.floor(F.col("shard") / 4096))
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy("g").agg(F.sum("n").alias("n")).select("g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("off", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(groups, "g").select("shard", (F.col("base") + F.col("off")).alias("off"))
    return ranked.join(offsets, "shard").select("block", "local", (F.col("off") + F.col("rank") - 1).alias("id"))


def csr_shards(docs: DataFrame, keys: tuple[str, ...], shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The document-term matrix in shards of rows: ``docs`` (one entry per row:
    key columns as ``_key``, facts, row sum ``n_words``, nonzero count
    ``n_distinct``), ``indptr`` (int64), ``indices`` (global word numbers, int64,
    ascending in a row) and ``counts`` (int32)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    rows = encoded_blocks(docs, keys)
    blocks = rows.filter(F.col("local").isNull()).drop("local", "word")
    summed = T.StructType([*blocks.schema["docs"].dataType.elementType.fields, T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType())])
    schema = T.StructType([f if f.name != "docs" else T.StructField("docs", T.ArrayType(summed)) for f in blocks.schema.fields])
    arrow = to_arrow_schema(schema)

    def renumber(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = np.empty(right.num_rows, dtype=np.int64)
        ids[right.column("local").to_numpy()] = right.column("id").to_numpy()
        indptr = _unpack(left.column("indptr")[0].as_py(), np.int64)
        indices = ids[_unpack(left.column("indices")[0].as_py(), np.int32)]
        row = np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))
        by = np.argsort(row * (ids.max(initial=0) + 1) + indices)  # (row, number) as one integer
        counts = _unpack(left.column("counts")[0].as_py(), np.int32)[by]
        sums = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))[indptr]
        known = left.column("docs").combine_chunks().flatten()
        doc = arrow.field("docs").type.value_type
        full = pa.StructArray.from_arrays([*known.flatten(), pa.array(np.diff(sums)), pa.array(np.diff(indptr))], fields=list(doc))
        return pa.Table.from_arrays(
            [left.column("block").combine_chunks(), left.column("indptr").combine_chunks(), pa.array([_pack(indices[by])], pa.binary()), pa.array([_pack(counts)], pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, len(full)], pa.int32()), full).cast(arrow.field("docs").type)], schema=arrow)
    return blocks.groupBy("block").cogroup(word_ids(rows, shard_rows).groupBy("block")).applyInArrow(renumber, schema)


def failing(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, A, B, C, D) per document."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
    d = csr_shards(keyed, ("doc_id", "part")).select(F.inline("docs"))
    return d.select("_key.doc_id", "_key.part", "digest", (F.col("n_words") < MIN_WORDS).alias("A"),
                    (100 * F.col("n_distinct") < MIN_DISTINCT * F.col("n_words")).alias("B"),
                    (100 * F.col("upper") > MAX_UPPER * F.col("chars")).alias("C"), F.col("symbol").alias("D"))


def patterns(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, pattern, n, good, toxic): documents by the set of filters that
    they fail, bit ``k`` for the ``k``-th letter."""
    said = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flags = cut_lineage(flags, "filter-flags", SMALL_BATCHES)
    has = flags.filter(F.col("doc_id").isNotNull()).join(said, "doc_id", "left")
    rows = has.unionByName(flags.filter(F.col("doc_id").isNull()), allowMissingColumns=True).fillna(0, ["good", "toxic"])
    bits = sum((F.col(c).cast("int") * (1 << k) for k, c in enumerate("ABCD")), F.lit(0))
    group = ["digest", "part", "good", "toxic", "bits"]
    copies = rows.select(id_key().alias("id"), bits.alias("bits"), "digest", "part", "good", "toxic").groupBy("id", *group).agg(F.count(F.lit(1)).alias("n"))
    copies = copies.groupBy(*group).agg(F.sum("n").alias("n"), F.min("id").alias("lowest"), F.min_by("n", "id").alias("n_lowest"))
    first = copies.groupBy("digest").agg(F.min("lowest").alias("first"))
    stay = F.when(F.col("lowest") == F.col("first"), F.col("n_lowest")).otherwise(F.lit(0))
    split = F.array(F.struct(F.col("bits").alias("pattern"), stay.alias("n")),
                    F.struct((F.col("bits") + 16).alias("pattern"), (F.col("n") - stay).alias("n")))
    return copies.join(first, "digest").select("part", "good", "toxic", F.inline(split)).filter(F.col("n") > 0).groupBy("part", "pattern").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every step of every order, per part, from the counts by pattern."""
    orders = ["".join(p) for p in permutations(letters)]
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(1 << letters.index(c)).alias("own"),
                               F.lit(sum(1 << letters.index(e) for e in o[:k])).alias("earlier")) for o in orders for k, c in enumerate(o)])
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("pattern", "n", "good", "toxic")).alias("cells"))
    rows = by_part.select("part", "cells", F.inline(steps))
    own, earlier = F.col("own"), F.col("earlier")

    def total(value, when) -> Column:
        return F.aggregate(F.filter("cells", when), F.lit(0).cast("long"), lambda acc, c: acc + value(c))

    def hits(c, mask) -> Column:
        return c["pattern"].bitwiseAND(mask) != 0

    def removed(c) -> Column:
        return hits(c, own) & ~hits(c, earlier)
    orders_each = F.lit(len(orders))
    return rows.select(
        "part", "filter_order", "step", total(lambda c: c["n"], lambda c: ~hits(c, own) & ~hits(c, earlier)).alias("kept"),
        total(lambda c: c["n"], removed).alias("removed"), total(lambda c: c["n"], lambda c: hits(c, own) & hits(c, earlier)).alias("redundant"),
        total(lambda c: c["n"], lambda c: c["pattern"] == own).alias("unique_fails"), total(lambda c: c["good"], removed).alias("good_lost"),
        total(lambda c: c["toxic"], removed).alias("toxic_lost"),
        # Among the f filters that a document fails, each comes first in 1/f of all orders.
        total(lambda c: c["n"] * (orders_each / F.bit_count(c["pattern"])).cast("long"), lambda c: hits(c, own)).alias("shapley"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(patterns(failing(docs), labels))
