"""Substring dedup by content-defined chunking.

A gear hash rolls over a text's UTF-8 bytes (its window is the last 16); a
chunk ends where the hash is the smallest among its ``REACH`` neighbours on
either side.  A cut so depends on a few dozen bytes around it only: what is
inserted elsewhere moves no other cut, and the inside of a repeated passage is
cut alike in every document.  Chunks (49 bytes on average) are compared by a
128-bit digest: a chunk that two or more documents hold belongs to the
smallest ``doc_id`` among them.  Runs of neighbouring chunks that belong to
other documents, of at least ``MIN_WORDS`` words, are repeated passages and are
removed; shorter runs are chance and stay.  In scripts without spaces two
characters are a word.

Scale: digests are reduced map-side (smallest and largest id), so a chunk that
a third of all documents hold costs one row per task; holders meet the table
of shared digests in a sort-merge join whose skewed partitions Spark splits.
A text's own shared digests are gathered, bounded by its length (rows
without an id are one document for the choice of who keeps a passage, but each
of their texts is cleaned by itself).

Defined results: null and empty text has no chunks and stays as it is; repeats
inside one document stay; rows that repeat a ``doc_id`` are one document;
documents without an id are one document, ranked last.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.llm.common import byte_texts, id_back, id_key, packed, rebatched, row_mark, row_texts, unpacked
from marketfold.session import cut_lineage

REACH, MIN_WORDS = 24, 12
# Gear table by rule: the hash of each byte value.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], dtype=np.uint32)
STEP = 2  # bits that the hash moves per byte: 32 / 2 = 16 bytes of window


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = (h[i-1] << STEP) + GEAR[data[i]] mod 2^32, summed by doubling."""
    h = GEAR[data]
    reach = 1
    while reach * STEP < 32 and reach < len(h):
        h[reach:] += h[:-reach] << np.uint32(reach * STEP)  # the right side is evaluated first
        reach *= 2
    return h


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of h[i] .. h[i+n-1] for every i with all of them."""
    m, size = h, 1
    while 2 * size <= n:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:len(h) - n + 1], m[n - size:n - size + len(h) - n + 1]) if size < n else m


def cuts(text: bytes) -> np.ndarray:
    """Ends of the chunks of a text (the last is its length)."""
    n = len(text)
    if n <= 2 * REACH + 1:
        return np.array([n] if n else [], dtype=np.int64)
    h = gear_hashes(np.frombuffer(text, dtype=np.uint8))
    least = _least(h, REACH)
    here = h[REACH:n - REACH]
    before, after = least[:n - 2 * REACH], least[REACH + 1:]
    ends = np.flatnonzero((here < before) & (here <= after)) + REACH + 1
    return np.append(ends, n)


def chunks(text: bytes) -> tuple[list[int], list[bytes]]:
    ends = cuts(text).tolist()
    digest = xxhash.xxh3_128_digest
    return ends, [digest(text[a:b]) for a, b in zip([0, *ends], ends)]


HELD = "d1 long, d2 long, id long, row long"


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, row, text) -> (d1, d2, id, row), a row per distinct digest of a text."""
    for b in rebatched(batches):
        counts, joined = [], []
        for text in byte_texts(b):
            own = set(chunks(text)[1])
            counts.append(len(own))
            joined += own
        d = np.frombuffer(b"".join(joined), dtype="<i8").reshape(-1, 2)
        ids = np.repeat(np.array(b.column("id").to_pylist(), dtype=np.int64), counts)
        rows = np.repeat(np.array(b.column("row").to_pylist(), dtype=np.int64), counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(d[:, 0])), pa.array(np.ascontiguousarray(d[:, 1])), pa.array(ids), pa.array(rows)],
                                         names=["d1", "d2", "id", "row"])


def shared_digests(docs: DataFrame) -> DataFrame:
    """(d1, d2, first): digests that two or more documents hold."""
    held = docs.mapInArrow(_holders, HELD).drop("row")
    return held.groupBy("d1", "d2").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("d1", "d2", "first")


ADDED = ("_chunks", "_shared_words", "_removed", "_spans", "_from", "_clean")


def _judge(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rebatched(batches):
            out = []
            for me, text, held in zip(b.column("_id").to_pylist(), row_texts(b), b.column("_held").to_pylist()):
                out.append(judge_text(me, text, held, min_words))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string())
            yield pa.RecordBatch.from_arrays([b.column("_row"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names=["_row", *ADDED])
    return run


def judge_text(me: int, text: bytes, held: list[dict] | None, min_words: int = MIN_WORDS) -> tuple:
    """(chunks, words in shared runs, words removed, spans removed, documents
    that keep them, text that stays)."""
    ends, digests = chunks(text)
    if not held:
        return len(ends), 0, 0, 0, [], text.decode()
    first = {np.array([r["d1"], r["d2"]], dtype="<i8").tobytes(): r["first"] for r in held}
    owner = [first.get(d) for d in digests]
    starts = [0, *ends]
    shared = sum(w for _, _, w in _runs(text, starts, [o is not None for o in owner], min_words))
    removed, spans, sources, out, done = 0, 0, set(), [], 0
    for i, j, words in _runs(text, starts, [o is not None and o < me for o in owner], min_words):
        # Whole characters only: a cut may lie inside one.
        a, b = _char_start(text, starts[i]), _char_start(text, starts[j])
        out.append(text[done:a])
        done = b
        removed += words
        spans += 1
        sources.update(owner[i:j])
    out.append(text[done:])
    return len(ends), shared, removed, spans, sorted(sources), b"".join(out).decode()


def _runs(text: bytes, starts: list[int], flags: list[bool], min_words: int) -> Iterator[tuple[int, int, int]]:
    """Runs [i, j) of flagged chunks with at least ``min_words`` words, and the words."""
    i = 0
    while i < len(flags):
        if flags[i]:
            j = i
            while j < len(flags) and flags[j]:
                j += 1
            words = count_words(text[starts[i]:starts[j]], min_words)
            if words >= min_words:
                yield i, j, words
            i = j
        else:
            i += 1


# Scripts that are written without spaces (Thai to Khmer, Han and kana, their further planes).
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u31ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def count_words(passage: bytes, enough: int) -> int:
    """Words of a passage by white space; where these are fewer than ``enough``,
    two characters of a script without spaces count as a word."""
    words = len(passage.split())
    return words if words >= enough else words + len(UNSPACED.findall(passage.decode(errors="ignore"))) // 2


def _char_start(text: bytes, at: int) -> int:
    """The next place at or after ``at`` where a character starts."""
    while at < len(text) and text[at] & 0xC0 == 0x80:
        at += 1
    return at


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents as ``_row`` plus ``_chunks``, ``_shared_words``,
    ``_removed``, ``_spans``, ``_from`` and ``_clean`` (the text without its
    repeated passages)."""
    slim = docs.select(id_key().alias("id"), row_mark().alias("row"), F.col("text").cast("string").alias("text"))
    shared = cut_lineage(shared_digests(slim), "chunks-shared")
    held = slim.mapInArrow(_holders, HELD).join(shared, ["d1", "d2"])
    # Gathered per text, not per id: all rows without an id are one holder.
    own = held.groupBy("id", "row").agg(F.collect_set(F.struct("d1", "d2", "first")).alias("_held")).withColumnsRenamed({"id": "_id", "row": "_mark"})
    kinds = (T.LongType(), T.LongType(), T.LongType(), T.LongType(), T.ArrayType(T.LongType()), T.StringType())
    rows = packed(docs, id_key().alias("_id"), row_mark().alias("_mark"))
    out = T.StructType([rows.schema["_row"], *(T.StructField(n, k) for n, k in zip(ADDED, kinds))])
    return rows.join(own, ["_id", "_mark"], "left").mapInArrow(_judge(min_words), out)


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the repeated passages, columns as they were."""
    text = F.when(F.col("_row.text").isNotNull(), F.col("_clean"))
    return unpacked(dedup(docs, min_words), docs.columns, text=text)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: chunks, words it shares with other documents in
    repeated passages, words and passages removed, the documents that keep
    them, digest of the text that stays."""
    d = dedup(docs.select(id_back(id_key()).alias("doc_id"), "text"))
    return unpacked(d, ["doc_id"], F.col("_chunks").alias("n_chunks"), F.col("_shared_words").alias("n_shared_words"),
                    F.col("_removed").alias("n_removed_words"), F.col("_spans").alias("n_removed_spans"),
                    F.col("_from").alias("kept_in"), F.sha2(F.col("_clean").cast("binary"), 256).alias("kept_sha256"))
