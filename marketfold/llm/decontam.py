"""Benchmark decontamination with a generalised suffix automaton.

The normalised items become one automaton over word ids.  Documents stream
through it: every step knows the longest suffix of the text read so far that
occurs in some item, so a window of ``window`` words ends here exactly when
that length reaches ``window``.  Items shorter than the window are windows
themselves.  One map over the documents, no shuffle.

The automaton is broadcast, so its size is checked first: items are divided
into shards of at most ``max_words`` words, each shard has an automaton of
its own, and a larger benchmark means more scans (combined per document),
never a larger broadcast.

Defined results: null or empty text has no words, hits or items and is never
contaminated; items without words have no window; rows that repeat an
``item_id`` are one item; a null ``item_id`` cannot be named and is left out;
repeated documents are judged one by one.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.llm.common import packed, rebatched, row_texts, unpacked
from marketfold.session import cut_lineage

# A word is a run of [0-9a-z] (after A-Z is lower-cased) and of anything outside ASCII.
WORD_MAP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COVERAGE_NUM, COVERAGE_DEN = 1, 20
MAX_WORDS = 200_000  # of a shard's items: an automaton of some hundred megabytes at most


def item_words(text: bytes) -> list[bytes]:
    return text.translate(WORD_MAP).split()


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the window states marked.

    ``window_items[s]``: items holding the window whose state is ``s``;
    ``short_items[s]``: items that, as a whole, are the string of state ``s``.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(name, [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]) for name, words in items if words]
        for _, seq in sequences:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.shortest = min((min(len(s), window) for _, s in sequences), default=0)
        self.window_items: dict[int, set[str]] = {}
        self.short_items: dict[int, set[str]] = {}
        for name, seq in sequences:
            state = 0
            for n, c in enumerate(seq, 1):
                state = self.next[state][c]  # the whole item is in the automaton
                if n >= window:
                    self.window_items.setdefault(self._shrink(state), set()).add(name)
            if len(seq) < window:
                self.short_items.setdefault(state, set()).add(name)

    def _new(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state of the strings of ``q`` no longer than ``p`` + ``c``."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c, self.next[last][c])
        cur = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            self.link[cur] = self._split(p, c, self.next[p][c])
        return cur

    def _shrink(self, state: int) -> int:
        """The suffix state that holds the string of exactly ``window`` words."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Hit flag per word, and the items with an occurring window."""
        hit = np.zeros(len(words), dtype=bool)
        found: set[str] = set()
        if not self.shortest or len(words) < self.shortest:
            return hit, found
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), dtype=np.int32, count=len(words))
        # A word that no item has sends the automaton back to its start state,
        # so only runs of item words as long as the shortest window are read.
        known = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).view(np.int8), [0]))))
        for start, end in zip(known[::2].tolist(), known[1::2].tolist()):
            if end - start >= self.shortest:
                self._scan_run(ids[start:end].tolist(), hit[start:end], found)
        return hit, found

    def _scan_run(self, ids: list[int], hit: np.ndarray, found: set[str]) -> None:
        edges, link, length, window, short = self.next, self.link, self.length, self.window, self.short_items
        state = size = 0
        for at, c in enumerate(ids):
            while state and c not in edges[state]:
                state = link[state]
                size = length[state]
            if c in edges[state]:
                state = edges[state][c]
                size += 1
            if size >= window:
                found |= self.window_items[self._shrink(state)]
                hit[at + 1 - window:at + 1] = True
            if short:
                s = state
                while s > 0:
                    if s in short and length[s] <= size:
                        found |= short[s]
                        hit[at + 1 - length[s]:at + 1] = True
                    s = link[s]


def item_shards(benchmark: DataFrame, max_words: int) -> tuple[DataFrame, int]:
    """Items (item_id, text) that can have windows, and how many shards they
    need: a shard has about ``max_words`` words at most (or is one longer item)."""
    items = benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    n_words = items.agg(F.sum(F.ceil(F.length("text") / 2))).first()[0] or 0  # words are at most half the characters
    return items, max(1, -(-int(n_words) // max_words))


def shard_automaton(items: DataFrame, shards: int, k: int, window: int) -> ItemAutomaton:
    part = items if shards == 1 else items.filter(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == k)
    rows = sorted({(r["item_id"], r["text"]) for r in part.toLocalIterator()})
    return ItemAutomaton([(name, item_words(text.encode())) for name, text in rows], window)


def _scanner(shared):
    """Map documents (one row in, one row out) to words, hit spans and items."""
    def run(batches):
        automaton = shared.value
        for b in rebatched(batches):
            n_words, n_hit, spans, items = [], [], [], []
            for text in row_texts(b):
                words = item_words(text)
                hit, found = automaton.scan(words)
                n_words.append(len(words))
                n_hit.append(int(hit.sum()))
                spans.append(np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))).tolist() if n_hit[-1] else [])
                items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                names=["_row", "_words", "_hit", "_spans", "_items"])
    return run


def _merge_spans(batches):
    """Sum up the spans that several shards found in the same document."""
    for b in rebatched(batches):
        hit, spans = [], []
        for n, lists in zip(b.column("_words").to_pylist(), b.column("_all_spans").to_pylist()):
            flags = np.zeros(n, dtype=np.int8)
            for one in lists or []:
                for s, e in zip(one[::2], one[1::2]):
                    flags[s:e] = 1
            hit.append(int(flags.sum()))
            spans.append(np.flatnonzero(np.diff(np.concatenate(([0], flags, [0])))).tolist())
        keep = [i for i, c in enumerate(b.schema.names) if c not in ("_all_spans",)]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(hit, pa.int64()), pa.array(spans, pa.list_(pa.int32()))],
                                         names=[*(b.schema.names[i] for i in keep), "_hit", "_spans"])


FOUND = [T.StructField("_words", T.LongType()), T.StructField("_hit", T.LongType()),
         T.StructField("_spans", T.ArrayType(T.IntegerType())), T.StructField("_items", T.ArrayType(T.StringType()))]


def match_items(docs: DataFrame, benchmark: DataFrame, window: int = 13, max_words: int = MAX_WORDS) -> DataFrame:
    """The documents as ``_row`` plus ``_words`` (count), ``_hit`` (words
    inside occurrences), ``_spans`` (word positions start, end, start, end
    ...) and ``_items`` (sorted ids)."""
    share = docs.sparkSession.sparkContext.broadcast
    items, shards = item_shards(benchmark, max_words)
    if shards == 1:
        rows = packed(docs)
        return rows.mapInArrow(_scanner(share(shard_automaton(items, 1, 0, window))), T.StructType([rows.schema["_row"], *FOUND]))
    # Several shards: give rows a key once, scan that table shard by shard (one
    # automaton at a time), combine.
    rows = cut_lineage(packed(docs, F.expr("uuid()").alias("_key")), "decontam-rows")
    slim = rows.select(F.struct("_key", F.col("_row.text").alias("text")).alias("_row"))
    scanned = None
    for k in range(shards):
        held = share(shard_automaton(items, shards, k, window))
        part = slim.mapInArrow(_scanner(held), T.StructType([slim.schema["_row"], *FOUND])).select("_row._key", "_words", "_spans", "_items")
        part = cut_lineage(part, "decontam-shard")
        held.destroy()
        scanned = part if scanned is None else scanned.unionByName(part)
    match = scanned.groupBy("_key").agg(F.first("_words").alias("_words"), F.collect_list("_spans").alias("_all_spans"),
                                        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_items"))
    merged = match.mapInArrow(_merge_spans, "_key string, _words long, _items array<string>, _hit long, _spans array<int>")
    return rows.join(merged, "_key").select("_row", "_words", "_hit", "_spans", "_items")


def contaminated(num: int = COVERAGE_NUM, den: int = COVERAGE_DEN):
    return (F.col("_hit") > 0) & (F.lit(den) * F.col("_hit") >= F.lit(num) * F.col("_words"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """One row per document: counts, digest of the item ids, verdict."""
    m = match_items(docs.select("doc_id", "text"), benchmark, window)
    return unpacked(m, ["doc_id"], F.col("_words").alias("n_words"), F.col("_hit").alias("n_hit"),
                    F.size("_items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def cut_spans(text: bytes, spans: list[int], min_words: int) -> bytes:
    """``text`` without the word spans of at least ``min_words`` words."""
    wanted = [(s, e) for s, e in zip(spans[::2], spans[1::2]) if e - s >= min_words]
    if not wanted:
        return text
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORD_MAP))]
    out, done = [], 0
    for s, e in wanted:
        out.append(text[done:at[s][0]])
        done = at[e - 1][1]
    out.append(text[done:])
    return b"".join(out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, min_span: int | None = None, length_column: str | None = None) -> DataFrame:
    """Documents whose hit words reach the coverage limit go.  With
    ``min_span``, the others lose their hit spans of at least that many words
    (else they stay as they are); ``length_column`` is then set to the length
    of the texts that were cut.  Columns as in ``docs``."""
    kept = match_items(docs, benchmark, window).filter(~contaminated())
    if min_span is None:
        return unpacked(kept, docs.columns)

    def cut(batches):
        for b in rebatched(batches):
            texts = [cut_spans(raw, spans or [], min_span).decode() for raw, spans in zip(row_texts(b), b.column("_spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(texts, pa.string())], names=["_row", "_clean"])
    cleaned = kept.select("_row", "_spans").mapInArrow(cut, T.StructType([kept.schema["_row"], T.StructField("_clean", T.StringType())]))
    instead = {"text": F.when(F.col("_row.text").isNotNull(), F.col("_clean"))}
    if length_column in docs.columns:
        old = F.col("_row").getField(length_column)
        instead[length_column] = F.when(F.col("_row.text") != F.col("_clean"), F.length("_clean").cast(docs.schema[length_column].dataType)).otherwise(old)
    return unpacked(cleaned, docs.columns, **instead)
