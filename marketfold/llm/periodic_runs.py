"""Periodic runs of words, found by seeding and extending diagonals.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
identical) of at least ``min_length`` words and ``exponent`` periods that no
neighbouring word extends.  On the diagonal of lag ``q`` (word ``i`` against
word ``i + q``) it is a stretch of equal pairs of at least
``max(min_length - q, (exponent - 1) * q)`` words; the least of these numbers
over all lags is the guaranteed overlap, 16 words for 24 and 3.

1. All texts of a batch are indexed by the hash of their grams of the
   guaranteed overlap; a text in which no gram occurs twice has no run.
2. In the others lags are taken in classes [k, 2k).  Grams of k words are
   indexed by (hash, place).  Anchors stand k words apart, so every stretch
   that belongs to a run holds a whole anchor gram; each is paired with its
   occurrences at the class's lags only -- at most k of them, so a class has no
   more pairs than the text has words, whatever repeats in it.
3. A pair inside a run known for a divisor of its lag is that run again and is
   left out; the others are extended both ways, lag by lag.  How far a lag is
   covered is kept, and pairs before that place are not extended again.

Hashes only propose pairs; the extension compares the words themselves.  One
map over the documents, no shuffle; a batch is bounded by bytes, a long text
costs n log n.

Defined results: null or empty text has no words, no runs and an empty
collapsed text; repeated rows are judged one by one; a null id is a row like
any other; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.llm.common import WordNumbers, byte_slices, packed, row_texts, unpacked, words_of

MIN_LENGTH, EXPONENT = 24, 3
BATCH_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

Run = tuple[int, int, int]  # start, length, period


def guaranteed_overlap(min_length: int, exponent: int) -> int:
    """Equal pairs that every run has on the diagonal of its period."""
    return min(max(min_length - q, (exponent - 1) * q) for q in range(1, min_length + 1))


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` ids from every place on."""
    x = ids.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    n = max(len(ids) - k + 1, 0)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        h = h * np.uint64(_BASE) + x[j:j + n]
    return h


def repeating_texts(ids: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the texts (``ids`` cut at ``starts``) in which a gram of
    ``k`` words occurs twice."""
    h = gram_hashes(ids, k)
    text = np.searchsorted(starts, np.arange(len(h)), side="right") - 1
    ends = np.append(starts[1:], len(ids))
    inside = np.arange(len(h)) + k <= ends[text]
    h, text = h[inside] ^ (text[inside].astype(np.uint64) * np.uint64(0x94D049BB133111EB)), text[inside]
    order = np.argsort(h, kind="stable")
    again = order[1:][h[order[1:]] == h[order[:-1]]]
    return np.unique(text[again])


def _stretch(ids: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The widest [l, r) around ``i`` with ids[t] == ids[t + q]."""
    limit, r, size = len(ids) - q, i, 64
    while r < limit:
        e = min(limit, r + size)
        off = np.flatnonzero(ids[r:e] != ids[r + q:e + q])
        if off.size:
            r += int(off[0])
            break
        r, size = e, size * 2
    left, size = i, 64
    while left > 0:
        s = max(0, left - size)
        off = np.flatnonzero(ids[s:left] != ids[s + q:left + q])
        if off.size:
            left = s + int(off[-1]) + 1
            break
        left, size = s, size * 2
    return left, r


def _seeds(h: np.ndarray, step: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, lag) with equal grams and ``lo <= lag < hi``, by lag and place."""
    n = len(h) + 1
    group = np.unique(h, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(group, kind="stable")
    keys = group[order] * n + order
    anchors = np.arange(0, len(h), step)
    at = group[anchors] * n
    first = np.searchsorted(keys, at + np.minimum(anchors + lo, n - 1), side="left")
    last = np.searchsorted(keys, at + np.minimum(anchors + hi, n - 1), side="left")
    counts = last - first
    place = np.repeat(anchors, counts)
    lag = order[np.arange(int(counts.sum())) + np.repeat(first - (np.cumsum(counts) - counts), counts)] - place
    by = np.lexsort((place, lag))
    return place[by], lag[by]


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[Run]:
    """All runs of a sequence of word ids, by start, then period."""
    if exponent < 3:
        raise ValueError("runs of fewer than three periods are not supported")
    n, runs = len(ids), []
    k = guaranteed_overlap(min_length, exponent) // 2
    # Per place the end and period of the known run that reaches furthest.
    reach, period = np.zeros(n, dtype=np.int64), np.ones(n, dtype=np.int64)
    h = gram_hashes(ids, k)
    lo, step = 1, k + 1
    while lo <= n // exponent and len(h):
        place, lag = _seeds(h, step, lo, min(2 * k, n // exponent + 1))
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(lag)) + 1, [len(lag)])) if len(lag) else np.zeros(1, dtype=np.int64)
        for a, b in pairwise(cuts.tolist()):
            q, at = int(lag[a]), place[a:b]
            known = (q % period[at] == 0) & (at + q + k <= reach[at])
            covered = 0  # of this lag
            for i in at[~known].tolist():
                if i < covered:
                    continue
                left, right = _stretch(ids, i, q)
                covered = right
                length = right - left + q
                if left < right and length >= max(min_length, exponent * q):
                    runs.append((left, length, q))
                    end = left + length
                    further = np.flatnonzero(reach[left:end] < end) + left
                    reach[further], period[further] = end, q
        # Grams twice as long, for lags twice as large.
        h = h[:-k] * np.uint64(pow(_BASE, k, 1 << 64)) + h[k:] if len(h) > k else h[:0]
        k *= 2
        lo = step = k
    return sorted(runs, key=lambda r: (r[0], r[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run with most periods; ties: smallest start, then period."""
    best = None
    for r in runs:  # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words outside runs and those of each run's first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), dtype=bool)
    for start, length, q in runs:
        gone[start + q:start + length] = True
    return b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])


_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
FOUND = [T.StructField("_words", T.LongType()), T.StructField("_runs", T.ArrayType(_RUN)), T.StructField("_top", _RUN),
         T.StructField("_collapsed", T.StringType())]


def with_runs(rows: DataFrame, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """``rows`` (packed, with a text in ``_row.text``) plus the number of
    words, the runs, the strongest run and the collapsed text."""
    overlap = guaranteed_overlap(min_length, exponent)
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def named(r: Run | None):
        return None if r is None else {"start": r[0], "length": r[1], "period": r[2]}

    def scan(batches):
        for b in byte_slices(batches, BATCH_BYTES):
            texts, numbers = [t.split() for t in row_texts(b)], WordNumbers()
            ids = [numbers.of(words, np.int64) for words in texts]
            starts = np.concatenate(([0], np.cumsum([len(x) for x in ids])[:-1])).astype(np.int64)
            found: list[list[Run]] = [[] for _ in texts]
            for t in repeating_texts(np.concatenate(ids), starts, overlap).tolist():
                found[t] = find_runs(ids[t], min_length, exponent)
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.array([len(w) for w in texts], pa.int64()),
                 pa.array([[named(r) for r in f] for f in found], pa.list_(run_type)), pa.array([named(strongest(f)) for f in found], run_type),
                 pa.array([collapsed(w, f) for w, f in zip(texts, found)], pa.binary()).cast(pa.string())],
                names=["_row", "_words", "_runs", "_top", "_collapsed"])
    return rows.mapInArrow(scan, T.StructType([rows.schema["_row"], *FOUND]))


def collapse(docs: DataFrame, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """The documents with every run cut to its first period.  A text without
    a run stays as it is.  Columns as in ``docs``."""
    found = with_runs(packed(docs), min_length, exponent)
    return unpacked(found, docs.columns, text=F.when(F.size("_runs") > 0, F.col("_collapsed")).otherwise(F.col("_row.text")))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text), with a periodic end given to the texts that the
    query's rule names by id."""
    h, text = F.crc32(F.col("doc_id").cast("string")), F.col("text").cast("string")
    g = F.floor(h / 10).cast("long")

    def with_periodic_end(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        unit = F.slice(words, (a + 1).cast("int"), p.cast("int"))
        tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
        head = F.when(a > 0, F.slice(words, F.lit(1), a.cast("int"))).otherwise(F.array().cast("array<string>"))
        return F.when(n > 0, F.array_join(F.concat(head, tail), " ")).otherwise(text)
    # A lambda's variable: the words are split once for all their uses, and only where the id names the text.
    split_once = F.element_at(F.transform(F.array(words_of(text)), with_periodic_end), 1)
    return docs.select("doc_id", F.when(h % 10 == 0, split_once).otherwise(text).alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document of the planted table: runs, the strongest one and
    digests of all runs and of the collapsed text."""
    found = with_runs(packed(planted(docs)))
    line = F.transform("_runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    top = F.col("_top")
    return unpacked(found, ["doc_id"], F.size("_runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"),
                    top["period"].alias("period"), F.floor(F.lit(1000) * top["length"] / top["period"]).cast("long").alias("exponent_milli"),
                    F.sha2(text, 256).alias("runs_sha256"), F.sha2("_collapsed", 256).alias("collapsed_sha256"), F.col("_words").alias("n_words"))
