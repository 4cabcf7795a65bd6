"""Near-duplicate documents by b-bit MinHash.

Per document: the set of distinct word shingles, 128 minima of hashed
shingles, band keys for candidate generation (25 bands of 5 minima) and the
low 4 bits of every minimum, packed as bit planes.  The collision-corrected
similarity of two documents is a count of differing bits.  Candidates whose
estimate is far below the threshold go; the others are confirmed on their
full shingle sets.

Scale: exact copies (equal word sequences) are one class and only the class
enters the search.  Inside a bucket nobody meets everybody: all members meet
the bucket's smallest class (its head), by estimate and then exactly.  That
links a family whose texts are all near its head in linear work.  A family
that this leaves in several components (its texts are near each other, but not
all near the head) is compared in blocks: its documents are dealt into blocks
of bounded bytes, each pair of blocks is one group that counts intersections
exactly and returns a spanning forest of its links, never all of them.  Links
become components by repeated star contraction.

Defined results: null text, empty text and text without words have no set,
link with nothing and are kept; every row is a document of its own, also
where ids repeat or are null; a ``doc_id`` only ranks (null last), and of each
component one row stays, with those equal to it in id and words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.llm.common import SMALL_BATCHES, byte_texts, id_back, id_key, lower_words, packed, rebatched, row_texts, unpacked, worker_memory
from marketfold.session import cut_lineage

PERMUTATIONS, BANDS, BAND_ROWS, LOW_BITS = 128, 25, 5, 4
_SEEDS = np.random.default_rng(20).integers(1, 2**63, size=(2, PERMUTATIONS), dtype=np.uint64)
_MULTIPLY, _ADD = _SEEDS[0] | np.uint64(1), _SEEDS[1]
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """64-bit hash of a word, remembered; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(words: list[bytes], k: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words than
    ``k`` but not none are one shingle."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(k, len(words))
    acc = np.full(len(words) - n + 1, np.uint64(n))
    for j in range(n):
        acc = _mixed(acc * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - n + 1 + j])
    return np.unique(acc)


def minima(shingles: np.ndarray) -> np.ndarray:
    """128 minima of multiply-add hashes, in slices that stay in cache."""
    out = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        part = shingles[at:at + 1024]
        np.minimum(out, (part[None, :] * _MULTIPLY[:, None] + _ADD[:, None]).min(axis=1), out=out)
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of ``BAND_ROWS`` minima."""
    rows = mins[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
    acc = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(BAND_ROWS):
        acc = _mixed(acc * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return acc.view(np.int64)


def packed_bits(mins: np.ndarray) -> np.ndarray:
    """Low bits of the (mixed) minima as bit planes: two 64-bit words per plane."""
    low = _mixed(mins)
    planes = [np.packbits(((low >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)).view(np.int64) for b in range(LOW_BITS)]
    return np.concatenate(planes)


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("minhash")
        memo = WordHashes()
        for b in rebatched(batches):
            copies, sizes, bands, bits = [], [], [], []
            for text in byte_texts(b):
                words = lower_words(text)
                shingles = shingle_hashes(words, k, memo)
                copies.append(xxhash.xxh3_128_digest(b" ".join(words)))
                sizes.append(len(shingles))
                if len(shingles):
                    mins = minima(shingles)
                    bands.append(band_keys(mins).tolist())
                    bits.append(packed_bits(mins).tolist())
                else:
                    bands.append(None)
                    bits.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(copies, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                names=["id", "copy", "n", "bands", "bits"])
    return run


def _with_copy(texts, at: str, once: bool):
    """Rows plus ``copy``, the digest of their words (null without words).  With
    ``once``, of rows equal in the column ``at`` and in it a task passes on the
    first (and more when it has emptied its memory)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("minhash")
        seen: set = set()
        for b in rebatched(batches):
            copies, first = [], []
            for row, text in zip(b.column(at).to_pylist(), texts(b)):
                words = lower_words(text)
                copies.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                first.append(not once or not words or (row, copies[-1]) not in seen)
                if once:
                    seen.add((row, copies[-1]))
            if len(seen) > 200_000:
                seen.clear()
            out = pa.RecordBatch.from_arrays([*b.columns, pa.array(copies, pa.binary())], names=[*b.schema.names, "copy"])
            yield out if all(first) else out.filter(pa.array(first))
    return run


def estimate(a: str, b: str) -> Column:
    """Similarity from the packed low bits: share of equal ``LOW_BITS``-bit
    values, corrected for the share that agrees by chance."""
    differing = []
    for word in range(PERMUTATIONS // 64):
        at = [2 * p + word for p in range(LOW_BITS)]
        xor = [F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i))) for i in at]
        any_bit = xor[0]
        for x in xor[1:]:
            any_bit = any_bit.bitwiseOR(x)
        differing.append(F.bit_count(any_bit))
    equal = 1 - sum(differing[1:], differing[0]) / F.lit(float(PERMUTATIONS))
    chance = 2.0 ** -LOW_BITS
    return (equal - F.lit(chance)) / F.lit(1 - chance)


def _confirm(k: int):
    """(a, b, text_a, text_b) -> size of intersection and union of the full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, held_set = WordHashes(), None, None
        for b in rebatched(batches, 256):
            both, either = [], []
            for of, ta, tb in zip(b.column("b").to_pylist(), byte_texts(b, "text_a"), byte_texts(b, "text_b")):
                if held != of:  # rows of one task come in runs of b
                    held, held_set = of, shingle_hashes(lower_words(tb), k, memo)
                mine = shingle_hashes(lower_words(ta), k, memo)
                common = len(np.intersect1d(mine, held_set, assume_unique=True))
                both.append(common)
                either.append(len(mine) + len(held_set) - common)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(both, pa.int64()), pa.array(either, pa.int64())],
                                             names=["a", "b", "both", "either"])
    return run


def confirmed(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Exact intersection and union sizes of the pairs (a, b); ``texts`` is (id, text)."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b") \
                .mapInArrow(_confirm(k), "a long, b long, both long, either long")


# Five standard deviations of an estimate from 128 values near similarity 0.85.
MARGIN = 0.17
# A family holds what is this near its head; what may be 1 - similarity nearer
# to such a member than to the head (and noise) also meets the bucket's rest.
FAMILY, FAMILY_REST = 0.30, 0.60
BLOCK_DOCS, BLOCK_BYTES = 1000, 4_000_000


def linked_forest(sets: list[np.ndarray], threshold: int, columns: int = 2048) -> list[tuple[int, int]]:
    """Spanning forest (child, parent) of the link graph of some shingle sets.

    Intersections of all pairs are counted by products of 0/1 matrices over
    the shingles that two or more sets have, a slice of shingles at a time."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    owner = np.repeat(np.arange(n), sizes.astype(np.int64))
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[at] > 1
    owner, at = owner[common], np.unique(at[common], return_inverse=True)[1]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    both = np.zeros((n, n), dtype=np.float32)
    for lo in range(0, int(at[-1]) + 1 if len(at) else 0, columns):
        i, j = np.searchsorted(at, (lo, lo + columns))
        m = np.zeros((n, columns), dtype=np.float32)
        m[owner[i:j], at[i:j] - lo] = 1.0
        both += m @ m.T
    forest, left = [], np.ones(n, dtype=bool)
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            at_node = queue.pop()
            union = sizes[at_node] + sizes - both[at_node]
            new = np.flatnonzero(left & (100.0 * both[at_node] >= threshold * union))
            left[new] = False
            forest += [(int(x), at_node) for x in new]
            queue += new.tolist()
    return forest


def _block_links(k: int, threshold: int):
    def run(group: pa.Table) -> pa.Table:
        memo = WordHashes()
        ids = group.column("id").to_pylist()
        order = sorted(range(len(ids)), key=ids.__getitem__)
        texts = group.column("text").cast(pa.binary()).to_pylist()
        forest = linked_forest([shingle_hashes(lower_words(texts[i]), k, memo) for i in order], threshold) if len(ids) > 1 else []
        return pa.table({"a": pa.array([ids[order[x]] for x, _ in forest], pa.int64()), "b": pa.array([ids[order[y]] for _, y in forest], pa.int64())})
    return run


class NearDuplicates:
    """Near-duplicate classes, links and components of ``docs`` (doc_id, text).

    Rows of equal words are one class, named by its row of the smallest id
    (``rep``, a number of the row).  ``links``: (a, b) between classes, enough
    to connect all that are linked; ``components()``: (id, n, component, kept),
    one row per document."""

    def __init__(self, docs: DataFrame, k: int = 5, similarity: float = 0.8):
        self.k, self.threshold = k, round(similarity * 100)
        self.docs = docs.select(id_key().alias("id"), F.col("text").cast("string").alias("text"))
        signed = self.docs.mapInArrow(_sign(k), "id long, copy binary, n long, bands array<long>, bits array<long>")
        signed = cut_lineage(signed.withColumn("row", F.monotonically_increasing_id()), "minhash-signed", SMALL_BATCHES)
        self.signed, sets = signed, signed.filter("n > 0")
        classes = sets.groupBy("copy").agg(F.min(F.struct("id", "row", "bands", "bits")).alias("s"))
        classes = cut_lineage(classes.select("copy", "s.id", F.col("s.row").alias("rep"), "s.bands", "s.bits"), "minhash-classes")
        self.classes, self.bits = classes.select("copy", "id", "rep"), classes.select("rep", "bits")
        spread = classes.select("rep", F.posexplode("bands").alias("band", "key"))
        heads = spread.groupBy("band", "key").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).filter("b < last").drop("last")
        self.met = cut_lineage(spread.join(cut_lineage(heads, "minhash-heads"), ["band", "key"]).withColumnRenamed("rep", "a")
                               .filter("a > b"), "minhash-met")
        self.links = None if self.met.isEmpty() else self._search()

    def _estimated(self, pairs: DataFrame) -> DataFrame:
        one = self.bits.select(F.col("rep").alias("a"), F.col("bits").alias("bits_a"))
        other = self.bits.select(F.col("rep").alias("b"), F.col("bits").alias("bits_b"))
        return pairs.distinct().join(one, "a").join(other, "b").select("a", "b", estimate("bits_a", "bits_b").alias("near"))

    def _search(self) -> DataFrame:
        wanted = self.met.select(F.col("a").alias("id")).unionByName(self.met.select(F.col("b").alias("id"))).distinct()
        wanted = self.classes.join(wanted.withColumnRenamed("id", "rep"), "rep")
        texts = self.docs.mapInArrow(_with_copy(byte_texts, "id", True), "id long, text string, copy binary")
        texts = texts.join(wanted, ["id", "copy"]).groupBy(F.col("rep").alias("id")).agg(F.min("text").alias("text"))
        texts = cut_lineage(texts, "minhash-texts", SMALL_BATCHES)
        pairs = cut_lineage(self._estimated(self.met.select("a", "b")), "minhash-pairs")
        sure = confirmed(pairs.filter(F.col("near") >= self.threshold / 100 - MARGIN), texts, self.k) \
            .filter(100 * F.col("both") >= self.threshold * F.col("either")).select("a", "b")
        sure = cut_lineage(sure, "minhash-links", SMALL_BATCHES)
        # Families: near the head, and the rest of a bucket around its own smallest member.
        rest = self.met.join(pairs.filter(F.col("near") < FAMILY_REST), ["a", "b"]).select("band", "key", "a")
        rest_heads = rest.groupBy("band", "key").agg(F.min("a").alias("b"), F.max("a").alias("last")).filter("b < last").drop("last")
        rest_met = rest.join(cut_lineage(rest_heads, "minhash-heads"), ["band", "key"]).filter("a > b").select("a", "b")
        family = connected(pairs.filter(F.col("near") >= FAMILY).select("a", "b").unionByName(rest_met.distinct()))
        inside = connected(sure).withColumnRenamed("root", "part")
        placed = family.join(inside, "id", "left").withColumn("part", F.coalesce("part", "id"))
        placed = placed.join(texts.select("id", F.octet_length("text").alias("bytes")), "id")
        placed = cut_lineage(placed, "minhash-families")
        open_ = placed.groupBy("root").agg(F.min("part").alias("least"), F.max("part").alias("most"), F.count(F.lit(1)).alias("docs"),
                                           F.sum("bytes").alias("bytes")).filter("least < most")
        blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
        open_ = cut_lineage(open_.select("root", blocks.alias("blocks")), "minhash-open")
        dealt = placed.select("id", "root").join(open_, "root").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("id", "root", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
        found = dealt.join(texts, "id").select("id", "root", "i", "j", "text").groupBy("root", "i", "j") \
                     .applyInArrow(_block_links(self.k, self.threshold), "a long, b long")
        return sure.unionByName(cut_lineage(found, "minhash-block-links", SMALL_BATCHES))

    def leaders(self) -> DataFrame:
        """(copy, component, keeper_copy) of every class: the smallest id of its
        component, and the class that stays for it."""
        if self.links is None:
            return self.classes.select("copy", F.col("id").alias("component"), F.col("copy").alias("keeper_copy"))
        roots = connected(self.links).withColumnRenamed("id", "rep")
        placed = cut_lineage(self.classes.join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep")), "minhash-placed")
        least = placed.groupBy("root").agg(F.min(F.struct("id", "rep", "copy")).alias("least"))
        return placed.select("copy", "root").join(least, "root").select(
            "copy", F.col("least.id").alias("component"), F.col("least.copy").alias("keeper_copy"))

    def components(self) -> DataFrame:
        alone = self.signed.filter("n = 0").select("id", "n", F.col("id").alias("component"), F.lit(True).alias("kept"))
        return self.signed.filter("n > 0").select("id", "n", "copy").join(self.leaders(), "copy") \
                   .select("id", "n", "component", ((F.col("id") == F.col("component")) & (F.col("copy") == F.col("keeper_copy"))).alias("kept")).unionByName(alone)


def connected(links: DataFrame) -> DataFrame:
    """(id, root) for every end of the links (a, b): root is the smallest id
    reachable.  Star contraction: every node points to the smallest root
    among its neighbours, then pointers are followed; repeated until stable."""
    both = cut_lineage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links-both")
    roots = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("root"))
    roots = cut_lineage(roots, "links-roots")
    while True:
        near = both.join(roots.select(F.col("id").alias("b"), F.col("root").alias("via")), "b").groupBy(F.col("a").alias("id")).agg(F.min("via").alias("via"))
        step = roots.join(near, "id").select("id", F.col("root").alias("old"), F.least("root", "via").alias("root"))
        # A lower root found by one node is offered to everything under its old root.
        offer = step.groupBy(F.col("old").alias("old")).agg(F.min("root").alias("best"))
        step = cut_lineage(step.join(cut_lineage(offer, "links-offer"), "old").select("id", "old", F.least("root", "best").alias("root")), "links-step")
        # Pointer jump: the root's own root.
        roots_of = step.select(F.col("id").alias("root"), F.col("root").alias("up"))
        new = cut_lineage(step.join(roots_of, "root", "left").select("id", "old", F.least("root", F.coalesce("up", "root")).alias("root")), "links-roots")
        if new.filter("root <> old").isEmpty():
            return new.select("id", "root")
        roots = new.select("id", "root")


def report(docs: DataFrame, k: int = 3, similarity: float = 0.85) -> DataFrame:
    """One row per document: size of its set, component, whether it stays: by
    the contract every row whose id is the component's (``keep_one`` keeps one
    row of rows that share an id)."""
    c = NearDuplicates(docs, k, similarity).components()
    return c.select(id_back("id").alias("doc_id"), F.col("n").alias("n_shingles"), id_back("component").alias("component_id"),
                    (F.col("id") == F.col("component")).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, similarity: float = 0.8) -> DataFrame:
    """Of each component the row of the smallest id (and rows equal to it in id
    and words), columns as in ``docs``; and all rows without words.  Written
    here, since whole rows go through Python in batches set for the job."""
    stay = NearDuplicates(docs, k, similarity).leaders().filter("copy = keeper_copy").select(F.col("component").alias("_id"), "copy", F.lit(True).alias("_stays"))
    rows = packed(docs, id_key().alias("_id"))
    rows = rows.mapInArrow(_with_copy(row_texts, "_id", False), T.StructType([*rows.schema, T.StructField("copy", T.BinaryType())]))
    rows = rows.join(stay, ["_id", "copy"], "left").filter("_stays OR copy IS NULL")
    return cut_lineage(unpacked(rows, docs.columns), "minhash-kept", SMALL_BATCHES)
