"""Language-model scoring with a hierarchical Pitman-Yor model.

Restaurants: one per context, that is for every token that another follows, and
the unigram restaurant that they share as parent, whose base is uniform over
the training words and one unknown word.  Each training token is a customer; a
table of a context's restaurant is a customer of the parent.  Seating is
sampled by Gibbs: a sweep seats all customers of every dish (a word in a
restaurant) anew.  Probabilities need only how many tables a dish has, so that
number is drawn from its law under the Chinese restaurant rule
(``table_counts``).  The predictive probabilities of the samples are averaged.

Scale: counts live in pair shards (the dishes, by hash of their word; the pairs
of very frequent words by both words, so no shard holds all that follows or
precedes "the") and word shards (per word its tokens, its customers and tables
in the unigram restaurant, and the tables of its own restaurant).  A shard is
one row of packed arrays, a pair or word shard grows no larger with the corpus,
there are more of them.  A dish with one customer has one table for ever; only
the others are seated.  In a round every pair shard seats its dishes and sends
the sums of tables by word and by context to the word shards, which add them
up, seat the unigram restaurant and answer: two shuffles of small integers, in
an order that both sides know.  Scoring works on blocks of documents: the
distinct pairs and words of a block are asked for shard by shard, and answers
meet the block's texts.  The driver holds a few numbers per round.

Defined results: null text is empty, one end token; a null ``doc_id`` hashes
as empty text; repeated documents are counted and scored one by one; without
training tokens every probability is 1 over one word.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketfold.llm.common import SMALL_BATCHES, byte_texts, id_back, id_key, lower_words, rebatched, text_or_empty
from marketfold.session import conf_scope, cut_lineage, cuts, drop_cuts

END = b""  # the end token; it is also the context of a text's first word
BLOCK_BITS = 11            # a block has up to 2**11 documents
PAIRS_PER_SHARD = 500_000  # about so many of the blocks' distinct pairs meet in one group
FREQUENT, LOOK = 0.002, 64  # words of this share, in one text of so many, have their pairs dealt out by both words
FLUSH = 1_500_000          # distinct pairs that a counting task holds
STRENGTH = 1.0
BURN_IN, SAMPLES = 2, 2
_STEP = np.uint64(0x9E3779B97F4A7C15)
LISTED, NODES = 2048, 160  # up to so many customers a dish's law is listed in a table; points of an integral beyond that


# ---- packing ----------------------------------------------------------------

def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a), 3)


def _unpack(raw: bytes, kind=np.int32) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), dtype=kind)


def _pack_small(a: np.ndarray) -> bytes:
    """Numbers from 0 on, in as few bytes each as the largest needs."""
    most = int(a.max(initial=0))
    kind = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + _pack(a.astype(kind))


def _unpack_small(raw: bytes) -> np.ndarray:
    return _unpack(raw[1:], f"<u{raw[0]}").astype(np.int64)


def _pack_pairs(w: np.ndarray, u: np.ndarray) -> tuple[bytes, bytes]:
    """Pairs in ascending order: the steps of the word, and the context."""
    return _pack_small(np.diff(w, prepend=0)), _pack_small(u)


def _unpack_pairs(w: bytes, u: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_unpack_small(w)), _unpack_small(u)


def _pack_names(names: pa.BinaryArray) -> bytes:
    """Words as their sizes and their bytes; no Python objects are made of them."""
    offsets = np.frombuffer(names.buffers()[1], dtype=np.int32, count=len(names) + 1, offset=4 * names.offset) if len(names) else np.zeros(1, dtype=np.int32)
    sizes = _pack_small(np.diff(offsets))
    data = memoryview(names.buffers()[2])[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else b""
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.compress(data, 3)


def _unpack_names(raw: bytes) -> pa.BinaryArray:
    n = int.from_bytes(raw[:4], "little")
    offsets = np.concatenate(([0], np.cumsum(_unpack_small(raw[4:4 + n])))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(zstandard.decompress(raw[4 + n:]))])


def _merged(lists: list[pa.BinaryArray]) -> tuple[pa.BinaryArray, list[np.ndarray]]:
    """The distinct words of several lists in order, and where each list's words are there."""
    encoded = pa.concat_arrays(lists).dictionary_encode()
    order = pc.sort_indices(encoded.dictionary)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    place = rank[encoded.indices.to_numpy()]
    return encoded.dictionary.take(order), np.split(place, np.cumsum([len(x) for x in lists])[:-1])


def _rows(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table({name: pa.array(list(c), kind) for c, (name, kind) in zip(columns, schema.items())})


# ---- where a pair and a word live -------------------------------------------

def name_hashes(names: pa.BinaryArray) -> np.ndarray:
    """A polynomial of the bytes, mixed; for all names at once.  It says where
    words are kept, not what they are."""
    offsets = np.frombuffer(names.buffers()[1], dtype=np.int32, count=len(names) + 1, offset=4 * names.offset).astype(np.int64) if len(names) else np.zeros(1, dtype=np.int64)
    sizes, starts = np.diff(offsets), offsets[:-1] - offsets[0]
    raw = names.buffers()[2] if offsets[-1] > offsets[0] else b""
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    powers = np.full(int(sizes.max(initial=0)) + 1, _STEP, dtype=np.uint64)
    powers[0] = 1
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(data * np.cumprod(powers)[place], dtype=np.uint64)))
    h = sums[starts + sizes] - sums[starts] + sizes.astype(np.uint64)
    for shift in (33, 29, 32):
        h = (h ^ (h >> np.uint64(shift))) * _STEP
    return h ^ (h >> np.uint64(31))


@dataclass(frozen=True)
class Places:
    shards: int
    frequent: frozenset[bytes]

    def hashes(self, names: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Per word its hash, and whether it is frequent."""
        often = pc.is_in(names, value_set=pa.array(sorted(self.frequent), pa.binary()))
        return name_hashes(names), often.to_numpy(zero_copy_only=False)

    def words(self, h: np.ndarray) -> np.ndarray:
        return (h % np.uint64(self.shards)).astype(np.int32)

    def pairs(self, h: np.ndarray, often: np.ndarray, w: np.ndarray, u: np.ndarray) -> np.ndarray:
        both = h[w] * np.uint64(0x9E3779B97F4A7C15) + h[u] * np.uint64(0xC2B2AE3D27D4EB4F)
        both ^= both >> np.uint64(31)
        return (np.where(often[w], both, h[w]) % np.uint64(self.shards)).astype(np.int32)


def tokens_of(texts: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray]:
    """Distinct words of the texts, and the number of every token: each text's
    words (Arrow's ASCII white space is that of ``lower_words``) and its end."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).cast(pa.string())))
    encoded = words.flatten().dictionary_encode()
    names, index = encoded.dictionary.cast(pa.binary()), encoded.indices.to_numpy()
    end = pc.index(names, b"").as_py()  # empty pieces at the ends of a text are no words
    if end < 0:
        end, names = len(names), pa.concat_arrays([names, pa.array([END], pa.binary())])
    kept = index != end
    ends = np.concatenate(([0], np.cumsum(kept)))[words.offsets.to_numpy()[1:] - words.offsets.to_numpy()[0]]
    return names, np.insert(index[kept].astype(np.int64), ends, end)


def contexts_of(ids: np.ndarray, end: int) -> np.ndarray:
    """The token before each token; before a text's first word that is the end
    of the text before it."""
    ctx = np.empty(len(ids), dtype=np.int64)
    ctx[:1] = end
    ctx[1:] = ids[:-1]
    return ctx


def _segments(key: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, places) for every value of ``key``, by value; ``order`` sorts by it."""
    ends = np.flatnonzero(np.diff(key[order], append=-1)) + 1
    start = 0
    for end in ends.tolist():
        yield int(key[order[start]]), order[start:end]
        start = end


# ---- counting ---------------------------------------------------------------

def frequent_words(texts: DataFrame) -> frozenset[bytes]:
    """Words that hold ``FREQUENT`` of the tokens of one text in ``LOOK``; what
    is found decides where pairs are kept, never a result."""
    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in rebatched(batches):
            for text in byte_texts(b):
                counts.update(lower_words(text))
        total = sum(counts.values())
        kept = [(None, total), *((w, n) for w, n in counts.items() if n >= FREQUENT / 2 * total)]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])
    some = texts.filter(F.pmod(F.xxhash64("text"), F.lit(LOOK)) == 0)
    # At most 2 / FREQUENT words a task; added up before they come here.
    rows = some.mapInArrow(often, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    with conf_scope(texts.sparkSession, SMALL_BATCHES):
        total = rows.filter("word IS NULL").agg(F.sum("n")).first()[0] or 0
        found = rows.filter(F.col("word").isNotNull() & (F.col("n") >= FREQUENT / 2 * total)).collect()
    return frozenset([END, *(bytes(r["word"]) for r in found)])


PAIRS = "shard int, names binary, w binary, u binary, n binary"
_PAIRS = {"shard": pa.int32(), "names": pa.binary(), "w": pa.binary(), "u": pa.binary(), "n": pa.binary()}


def _local(names: pa.BinaryArray, w: np.ndarray, u: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """The words that the pairs use, and the pairs over them."""
    used = np.zeros(len(names), dtype=bool)
    used[w] = used[u] = True
    at = np.cumsum(used) - 1
    return names.take(pa.array(np.flatnonzero(used))), at[w], at[u]


def give_back() -> None:
    """What Arrow holds ready for later goes back, as a worker lives on."""
    pa.default_memory_pool().release_unused()


Counted = tuple[pa.BinaryArray, np.ndarray, np.ndarray, np.ndarray]  # words, and pairs over them with their counts


def add_up(parts: list[Counted]) -> Counted:
    """One count of several, words and pairs in order."""
    names, places = _merged([p[0] for p in parts])
    keys, at = np.unique(np.concatenate([x[w] << 32 | x[u] for x, (_, w, u, _) in zip(places, parts)]), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([p[3] for p in parts])).astype(np.int64)
    return names, keys >> 32, keys & 0xFFFFFFFF, total


def _count_pairs(places: Places):
    def counted(texts: list[bytes]) -> Counted:
        names, ids = tokens_of(texts)
        keys, n = np.unique(ids << 32 | contexts_of(ids, pc.index(names, END).as_py()), return_counts=True)
        return names, (keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), n.astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def out() -> pa.RecordBatch:
            names, w, u, n = add_up(parts)
            shard, rows = places.pairs(*places.hashes(names), w, u), []
            for p, own in _segments(shard, np.argsort(shard, kind="stable")):
                used, lw, lu = _local(names, w[own], u[own])
                rows.append((p, _pack_names(used), *_pack_pairs(lw, lu), _pack_small(n[own])))
            return _rows(_PAIRS, rows).to_batches()[0]
        for b in rebatched(batches):
            if b.num_rows:
                parts.append(counted(byte_texts(b)))
                size += len(parts[-1][1])
                if size > FLUSH:
                    yield out()
                    parts, size = [], 0
                    give_back()
        if parts:
            yield out()
            parts = []
            give_back()
    return run


DISHES = "shard int, names binary, w binary, u binary, n binary, listed binary, listed_q binary, listed_n binary, pairs long, ones long, twos long"
_DISHES = {**_PAIRS, "listed": pa.binary(), "listed_q": pa.binary(), "listed_n": pa.binary(), "pairs": pa.int64(), "ones": pa.int64(), "twos": pa.int64()}


def _add_pairs(places: Places):
    """One pair shard: its dishes, by word and context.  ``listed``: the words
    of dishes with two customers or more, by word shard (``listed_q``, so many
    of them: ``listed_n``) and then by name."""
    def run(group: pa.Table) -> pa.Table:
        give_back()
        names, w, u, total = add_up([(_unpack_names(names), *_unpack_pairs(w, u), _unpack_small(n))
                                     for names, w, u, n in zip(*(group.column(c).to_pylist() for c in ("names", "w", "u", "n")))])
        several = total > 1
        used = np.unique(np.concatenate([w[several], u[several]]))
        q = places.words(places.hashes(names)[0])[used] if len(used) else np.empty(0, dtype=np.int32)
        order = np.argsort(q, kind="stable")
        at_q, per_q = np.unique(q, return_counts=True)
        return _rows(_DISHES, [(group.column("shard")[0].as_py(), _pack_names(names), *_pack_pairs(w, u), _pack_small(total),
                                _pack(used[order].astype(np.int32)), _pack(at_q), _pack(per_q.astype(np.int32)), len(total), int((total == 1).sum()), int((total == 2).sum()))])
    return run


TOLD = "q int, shard int, names binary, sums binary, listed binary"
_TOLD = {"q": pa.int32(), "shard": pa.int32(), "names": pa.binary(), "sums": pa.binary(), "listed": pa.binary()}
# Per word: tokens, dishes with one customer and with more, and as a context dishes with one and with more.
SUMS = ("c", "ones", "many", "ctx_ones", "ctx_many")


def _tell_words(places: Places):
    """Pair shards -> what word shards must know of them, once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                names, (w, u), n = _unpack_names(r["names"]), _unpack_pairs(r["w"], r["u"]), _unpack_small(r["n"])
                one, size = n == 1, len(names)
                c = np.bincount(w, weights=n, minlength=size)
                sums = np.stack([c, *(np.bincount(x[m], minlength=size) for x in (w, u) for m in (one, ~one))], axis=1).astype(np.int64)
                listed = np.zeros(size, dtype=np.uint8)
                listed[_unpack(r["listed"])] = 1
                q, rows = places.words(places.hashes(names)[0]), []
                for k, own in _segments(q, np.argsort(q, kind="stable")):
                    rows.append((k, r["shard"], _pack_names(names.take(pa.array(own))), _pack_small(sums[own].T), _pack(listed[own])))
                yield from _rows(_TOLD, rows).to_batches()
    return run


WORDS = "q int, names binary, sums binary, route_shard binary, route_n binary, route binary, words long, tokens long, ones long, twos long, customers long"
_WORDS = {"q": pa.int32(), "names": pa.binary(), "sums": pa.binary(), "route_shard": pa.binary(), "route_n": pa.binary(), "route": pa.binary(),
          "words": pa.int64(), "tokens": pa.int64(), "ones": pa.int64(), "twos": pa.int64(), "customers": pa.int64()}


def _add_words(group: pa.Table) -> pa.Table:
    """One word shard: its words and, per pair shard that listed some of them,
    which ones (in that shard's order)."""
    rows = sorted(zip(*(group.column(c).to_pylist() for c in ("shard", "names", "sums", "listed"))), key=lambda r: r[0])
    told = [(p, _unpack_names(names), _unpack_small(sums).reshape(len(SUMS), -1).T, _unpack(listed, np.uint8)) for p, names, sums, listed in rows]
    names, at = _merged([own for _, own, _, _ in told])
    total, routes = np.zeros((len(names), len(SUMS)), dtype=np.int64), []
    for place, (p, _, sums, listed) in zip(at, told):
        total[place] += sums  # a shard tells a word once
        routes.append((p, place[listed == 1].astype(np.int32)))
    routes = [(p, x) for p, x in routes if len(x)]
    dishes = total[:, 1] + total[:, 2]
    return _rows(_WORDS, [(group.column("q")[0].as_py(), _pack_names(names), _pack_small(total.T), _pack(np.array([p for p, _ in routes], dtype=np.int32)),
                           _pack(np.array([len(x) for _, x in routes], dtype=np.int32)), _pack(np.concatenate([x for _, x in routes]) if routes else np.empty(0, np.int32)),
                           len(names), int(total[:, 0].sum()), int((dishes == 1).sum()), int((dishes == 2).sum()), int(dishes.sum()))])


# ---- seating ----------------------------------------------------------------

@dataclass(frozen=True)
class Totals:
    """What the unigram restaurant of a sample sums up to, and the discounts."""
    customers: float
    tables: float
    vocabulary: int          # training words
    discount: float
    top_discount: float

    def top_base(self) -> float:
        """Mass per word that the unigram restaurant takes from the uniform base."""
        if not self.customers:
            return 1.0 / (self.vocabulary + 1)
        return (STRENGTH + self.top_discount * self.tables) / (STRENGTH + self.customers) / (self.vocabulary + 1)

    def top(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        return (customers - self.top_discount * tables) / (STRENGTH + self.customers) + self.top_base()

    def open_weight(self, ctx_tables: np.ndarray, top: np.ndarray) -> np.ndarray:
        """Weight of a new table for a dish: of its restaurant's tables and its word."""
        return (STRENGTH + self.discount * ctx_tables) * top

    def predictive(self, n, tables, ctx_customers, ctx_tables, top) -> np.ndarray:
        backoff = (STRENGTH + self.discount * ctx_tables) / (STRENGTH + ctx_customers)
        return (n - self.discount * tables) / (STRENGTH + ctx_customers) + backoff * top


@lru_cache(maxsize=2)
def _log_seatings(discount: float) -> np.ndarray:
    """[n, t]: log of the summed weight of the ways to seat n customers at t
    tables (generalised Stirling numbers)."""
    out = np.full((LISTED + 1, LISTED + 2), -np.inf)
    out[1, 1] = 0.0
    for n in range(1, LISTED):
        joins = np.log(n - discount * np.arange(1, n + 1))
        out[n + 1, 1:n + 1] = np.logaddexp(out[n, :n], joins + out[n, 1:n + 1])
        out[n + 1, n + 1] = 0.0
    return out


def _large_law(n: int, new_weight: float, discount: float) -> tuple[int, np.ndarray]:
    """First number of tables and weights from there on, for a dish of many
    customers.

    A table's size has the generating function 1 - (1 - x)**discount, so the
    weight of t tables is (new_weight / discount)**t / t! times a coefficient
    of its t-th power, here an integral through the saddle point over a circle, or
    over a parabola around the cut where the circle comes near it.  What is
    left out is below the rounding of doubles."""
    rate = new_weight / discount
    low, high = -700.0, 0.0
    for _ in range(60):
        mid = (low + high) / 2
        if math.log(new_weight) + (discount - 1) * mid + math.log(-math.expm1(mid)) > math.log(n + 1):
            low = mid
        else:
            high = mid
    saddle = max(math.exp(low), 3.0 / (n + 1))
    centre = rate * -math.expm1(discount * math.log(saddle))
    start, end = max(1, int(centre - 12 * math.sqrt(centre) - 40)), min(n, int(centre + 12 * math.sqrt(centre) + 60))
    t = np.arange(start, end + 1)
    log_rate = t * math.log(rate) - np.concatenate(([0.0], np.cumsum(np.log(t[1:]))))

    def exponents(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms of what is taken to the power t, and of what is not."""
        if saddle > 0.5:
            x = -math.expm1(low) * np.exp(1j * u)
            return np.log(-np.expm1(discount * np.log1p(-x))), -n * np.log(x)
        v = 0.3 * np.sinh(u)
        s = saddle * (1 + 1j * v) ** 2
        return np.log1p(-s ** discount), -(n + 1) * np.log1p(-s) + np.log((1 + 1j * v) * np.cosh(u))
    first, second = (z[0].real for z in exponents(np.zeros(1)))
    # How far the integral goes: until it is e**-40 of its height for every t.
    reach = np.geomspace(1e-7, math.pi if saddle > 0.5 else 10.0, 200)
    power, rest = exponents(reach)
    some = np.unique(np.linspace(0, len(t) - 1, 9).astype(int))
    height = log_rate + t * first
    height -= height.max()
    seen = np.flatnonzero((height[some, None] + t[some, None] * (power.real - first)).max(axis=0) + rest.real - second > -40)
    upto = reach[min(seen[-1] + 1, 199)] if len(seen) else reach[0]
    power, rest = exponents(upto * (np.arange(NODES) + 0.5) / NODES)
    powers = np.empty((len(t), NODES), dtype=np.complex128)
    powers[0], powers[1:] = np.exp(start * (power - first) + (rest - second)), np.exp(power - first)
    integral = np.multiply.accumulate(powers, axis=0).real.sum(axis=1)
    return start, np.maximum(integral, 0.0) * np.exp(height)


def table_counts(customers: np.ndarray, new_weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """How many tables each dish has after all its customers are seated anew:
    drawn from the law that seating them one by one converges to, where an old
    table draws by its size less the discount and a new one by ``new_weight``."""
    tables, log_new = np.ones(len(customers), dtype=np.int64), np.log(new_weight)
    for dish in np.flatnonzero(customers > LISTED).tolist():
        start, weight = _large_law(int(customers[dish]), float(new_weight[dish]), discount)
        upto = np.cumsum(weight)
        tables[dish] = start + np.searchsorted(upto, rng.random() * upto[-1], side="right")
    order = np.argsort(customers, kind="stable")
    order = order[np.searchsorted(customers[order], 2):np.searchsorted(customers[order], LISTED, side="right")]
    # Dishes of about as many customers together: a column each.
    alike = np.flatnonzero(np.diff((np.log(customers[order]) * 5).astype(np.int64))) + 1
    for dishes in np.split(order, alike) if len(order) else ():
        most = int(customers[dishes[-1]])
        t, step = np.arange(1, most + 1)[:, None], max(1, 200_000 // most)
        for at in range(0, len(dishes), step):
            some = dishes[at:at + step]
            log = _log_seatings(discount)[customers[some], 1:most + 1].T + t * log_new[some]
            upto = np.cumsum(np.exp(log - log.max(axis=0)), axis=0)
            tables[some] = 1 + (upto <= rng.random(len(some)) * upto[-1]).sum(axis=0)
    return tables


def seat(dishes: dict, numbers: np.ndarray, totals: Totals, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """One sweep of a pair shard.  ``numbers``: per listed word the tables of
    its restaurant, and its customers and tables in the unigram restaurant.
    Returns the tables of the dishes with more than one customer, and per listed
    word their sums as dishes and as contexts."""
    listed, (w, u), n = _unpack(dishes["listed"]), _unpack_pairs(dishes["w"], dishes["u"]), _unpack_small(dishes["n"])
    several = n > 1
    place = np.zeros(int(max(w.max(initial=0), u.max(initial=0))) + 1, dtype=np.int64)
    place[listed] = np.arange(len(listed))
    w, u, n = place[w[several]], place[u[several]], n[several]
    top = totals.top(numbers[:, 1], numbers[:, 2])
    tables = table_counts(n, totals.open_weight(numbers[u, 0], top[w]), totals.discount, rng)
    return tables, np.stack([np.bincount(x, weights=tables, minlength=len(listed)).astype(np.int64) for x in (w, u)], axis=1)


SEATED = "kind int, shard int, q int, numbers binary"
_SEATED = {"kind": pa.int32(), "shard": pa.int32(), "q": pa.int32(), "numbers": pa.binary()}


def _seat_dishes(totals: Totals, seed: int):
    """A pair shard and the word shards' answers -> its tables (kind 0), and
    the sums for the word shards (kind 1)."""
    def run(dishes: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        for r in dishes.to_pylist():
            at_q, per_q = _unpack(r["listed_q"]), _unpack(r["listed_n"])
            told = dict(zip(answers.column("q").to_pylist(), answers.column("numbers").to_pylist()))
            numbers = np.concatenate([np.empty((0, 3), dtype=np.int64), *(_unpack_small(told[q]).reshape(3, -1).T for q in at_q.tolist())])
            tables, sums = seat(r, numbers, totals, np.random.default_rng([seed, r["shard"]]))
            rows.append((0, r["shard"], None, _pack_small(tables)))
            rows += [(1, r["shard"], q, _pack_small(part.T)) for q, part in zip(at_q.tolist(), np.split(sums, np.cumsum(per_q)[:-1]))]
        return _rows(_SEATED, rows)
    return run


ADDED = "kind int, shard int, q int, numbers binary, customers long, tables long"
_ADDED = {**_SEATED, "customers": pa.int64(), "tables": pa.int64()}


def _answers(word_row: dict, numbers: np.ndarray) -> list[tuple]:
    """Rows for the pair shards that listed words of this word shard, and its
    own (kind 2) with what the unigram restaurant sums up to."""
    q, at = word_row["q"], _unpack(word_row["route"])
    parts = np.split(at, np.cumsum(_unpack(word_row["route_n"]))[:-1]) if len(at) else []
    rows = [(1, p, q, _pack_small(numbers[part].T), None, None) for p, part in zip(_unpack(word_row["route_shard"]).tolist(), parts)]
    return [*rows, (2, None, q, _pack_small(numbers.T), int(numbers[:, 1].sum()), int(numbers[:, 2].sum()))]


def _start(words: pa.Table) -> Iterator[pa.RecordBatch]:
    """Word shards at the start: every dish has one table."""
    for b in words:
        for r in b.to_pylist():
            c, ones, many, ctx_ones, ctx_many = _unpack_small(r["sums"]).reshape(len(SUMS), -1)
            yield from _rows(_ADDED, _answers(r, np.stack([ctx_ones + ctx_many, ones + many, np.ones_like(c)], axis=1))).to_batches()


def _add_tables(totals: Totals, seed: int):
    """A word shard and the pair shards' sums -> its numbers and answers."""
    def run(words: pa.Table, sums: pa.Table) -> pa.Table:
        rows = []
        for r in words.to_pylist():
            c, ones, many, ctx_ones, ctx_many = _unpack_small(r["sums"]).reshape(len(SUMS), -1)
            as_dish, as_context = ones.copy(), ctx_ones.copy()
            told = dict(zip(sums.column("shard").to_pylist(), sums.column("numbers").to_pylist()))
            at = _unpack(r["route"])
            for p, part in zip(_unpack(r["route_shard"]).tolist(), np.split(at, np.cumsum(_unpack(r["route_n"]))[:-1]) if len(at) else []):
                new = _unpack_small(told[p]).reshape(2, -1)
                as_dish[part] += new[0]
                as_context[part] += new[1]
            weight = np.full(len(c), (STRENGTH + totals.top_discount * totals.tables) / (totals.vocabulary + 1))
            top = table_counts(as_dish, weight, totals.top_discount, np.random.default_rng([seed, r["q"], 1]))
            rows += _answers(r, np.stack([as_context, as_dish, top], axis=1))
        return _rows(_ADDED, rows)
    return run


@dataclass
class Model:
    """Shards of dishes and words, and per sample their tables and totals."""
    dishes: DataFrame
    words: DataFrame
    seated: list[DataFrame]  # per sample: (shard, numbers) tables of the dishes with several customers
    numbers: list[DataFrame]  # per sample: (q, numbers) of the words
    samples: list[Totals]
    places: Places
    tokens: int

    def rows(self) -> DataFrame:
        """All of it as (kind, at, piece, names, a, b, n): kind 0 dishes, 1
        words; piece -1 the counts, 0 and on the samples."""
        none = F.lit(None).cast("binary")

        def row(df: DataFrame, kind: int, at: str, piece: int, names, a, b, n) -> DataFrame:
            return df.select(F.lit(kind).alias("kind"), F.col(at).alias("at"), F.lit(piece).alias("piece"), *[c.alias(x) for c, x in zip((names, a, b, n), ("names", "a", "b", "n"))])
        out = row(self.dishes, 0, "shard", -1, F.col("names"), F.col("w"), F.col("u"), F.col("n")).unionByName(
            row(self.words, 1, "q", -1, F.col("names"), none, none, F.col("sums")))
        for s, (tables, numbers) in enumerate(zip(self.seated, self.numbers)):
            out = out.unionByName(row(tables, 0, "shard", s, none, none, none, F.col("numbers"))).unionByName(row(numbers, 1, "q", s, none, none, none, F.col("numbers")))
        return out


def _discount(ones: int | None, twos: int | None) -> float:
    """From how many dishes have one and two customers; within 0.1 .. 0.95."""
    ones, twos = ones or 0, twos or 0
    return min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5


def shards_for(docs: DataFrame) -> int:
    """Blocks have about one distinct (word, context) per 24 characters."""
    n = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, int(n // (24 * PAIRS_PER_SHARD)))


def train(docs: DataFrame, shards: int | None = None, burn_in: int = BURN_IN, samples: int = SAMPLES, seed: int = 11) -> Model:
    """Model of the texts of ``docs``."""
    spark, texts = docs.sparkSession, docs.select(text_or_empty().alias("text"))
    places = Places(shards or shards_for(texts), frequent_words(texts))
    dishes = cut_lineage(texts.mapInArrow(_count_pairs(places), PAIRS).groupBy("shard").applyInArrow(_add_pairs(places), DISHES), "py-dishes", SMALL_BATCHES)
    words = cut_lineage(dishes.mapInArrow(_tell_words(places), TOLD).groupBy("q").applyInArrow(_add_words, WORDS), "py-words")
    kinds = words.agg(*[F.sum(c).alias(c) for c in ("words", "tokens", "ones", "twos", "customers")]).first()
    pairs = dishes.agg(F.sum("ones").alias("ones"), F.sum("twos").alias("twos")).first()
    vocabulary, discounts = int(kinds["words"] or 0), (_discount(pairs["ones"], pairs["twos"]), _discount(kinds["ones"], kinds["twos"]))
    totals = Totals(float(kinds["customers"] or 0), float(vocabulary), vocabulary, *discounts)
    told, old = cut_lineage(words.mapInArrow(_start, ADDED), "py-numbers"), []
    model = Model(dishes, words, [], [], [], places, int(kinds["tokens"] or 0))
    for turn in range(burn_in + samples):
        first = len(cuts(spark)) - 1
        seated = cut_lineage(dishes.groupBy("shard").cogroup(told.filter("kind = 1").groupBy("shard")).applyInArrow(_seat_dishes(totals, seed + turn), SEATED), "py-seated")
        told = cut_lineage(words.groupBy("q").cogroup(seated.filter("kind = 1").groupBy("q")).applyInArrow(_add_tables(totals, seed + turn), ADDED), "py-numbers")
        sums = told.filter("kind = 2").agg(F.sum("customers"), F.sum("tables")).first()
        totals = Totals(float(sums[0] or 0), float(sums[1] or 0), vocabulary, *discounts)
        if turn >= burn_in:
            model.seated.append(seated.filter("kind = 0").select("shard", "numbers"))
            model.numbers.append(told.filter("kind = 2").select("q", "numbers"))
            model.samples.append(totals)
        else:  # what the round before wrote is not read again
            drop_cuts(spark, old)
            old = cuts(spark)[first + 1:]
    return model


# ---- scoring ----------------------------------------------------------------

@dataclass
class Block:
    """The distinct words and pairs of a block's texts, in an order that
    follows from them alone."""
    names: pa.BinaryArray    # in order; the end token is the first
    tokens: np.ndarray       # word of every token
    pair: np.ndarray         # distinct pair of every token
    w: np.ndarray
    u: np.ndarray
    shard: np.ndarray        # of every distinct pair
    q: np.ndarray            # of every word

    @classmethod
    def of(cls, texts: list[bytes], places: Places) -> "Block":
        parts = [tokens_of(texts[at:at + 1024]) for at in range(0, len(texts), 1024)]
        names, at = _merged([own for own, _ in parts])
        ids = np.concatenate([x[own] for x, (_, own) in zip(at, parts)])
        keys, pair = np.unique(ids << 32 | contexts_of(ids, 0), return_inverse=True)
        h, often = places.hashes(names)
        w, u = keys >> 32, keys & 0xFFFFFFFF
        return cls(names, ids.astype(np.int32), pair.astype(np.int32), w, u, places.pairs(h, often, w, u), places.words(h))

    def pairs_by_shard(self) -> Iterator[tuple[int, np.ndarray]]:
        return _segments(self.shard, np.argsort(self.shard, kind="stable"))

    def words_by_shard(self) -> Iterator[tuple[int, np.ndarray]]:
        return _segments(self.q, np.argsort(self.q, kind="stable"))


ASKED = "kind int, at int, block long, names binary, w binary, u binary"
_ASKED = {"kind": pa.int32(), "at": pa.int32(), "block": pa.int64(), "names": pa.binary(), "w": pa.binary(), "u": pa.binary()}


def _ask(places: Places):
    """Texts of blocks -> what they ask of the pair shards (kind 0) and word shards (kind 1)."""
    def asked(block: int, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        own, rows = Block.of(texts, places), []
        for p, at in own.pairs_by_shard():
            names, w, u = _local(own.names, own.w[at], own.u[at])
            rows.append((0, p, block, _pack_names(names), *_pack_pairs(w, u)))
        for q, at in own.words_by_shard():
            rows.append((1, q, block, _pack_names(own.names.take(pa.array(at))), None, None))
        del own
        yield from _rows(_ASKED, rows).to_batches()
        give_back()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = None, []
        for b in rebatched(batches, 256):
            for block, text in zip(b.column("block").to_pylist(), byte_texts(b)):
                if block != held:
                    if texts:
                        yield from asked(held, texts)
                    held, texts = block, []
                texts.append(text)
        if texts:
            yield from asked(held, texts)
    return run


TOLD_BLOCKS = "block long, kind int, at int, numbers binary"
_TOLD_BLOCKS = {"block": pa.int64(), "kind": pa.int32(), "at": pa.int32(), "numbers": pa.binary()}


def _pack_found(table: np.ndarray) -> bytes:
    """Columns of numbers: the first for every row, the others only where it is
    above 1 (a single customer or token has one table of everything)."""
    first = _pack_small(table[0])
    return len(first).to_bytes(4, "little") + first + _pack_small(table[1:, table[0] > 1])


def _unpack_found(raw: bytes, columns: int) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    first = _unpack_small(raw[4:4 + n])
    out = np.empty((columns, len(first)), dtype=np.int64)
    out[:] = np.minimum(first, 1)
    out[0] = first
    out[1:, first > 1] = _unpack_small(raw[4 + n:]).reshape(columns - 1, -1)
    return out


def _answer_blocks(samples: int):
    """One shard and what blocks ask of it.  Pairs: customers, and tables per
    sample.  Words: tokens, and per sample the tables of the word's restaurant
    and its customers and tables in the unigram restaurant."""
    def run(asked: pa.Table, model: pa.Table) -> pa.Table:
        pieces = {r["piece"]: r for r in model.to_pylist()}
        known, rows = pieces.get(-1), []
        kind = asked.column("kind")[0].as_py() if asked.num_rows else 0
        width, keys = 1 + samples * (1 if kind == 0 else 3), np.empty(0, dtype=np.int64)
        table = np.zeros((width, 1), dtype=np.int64)  # the last column: what is not there
        if known and kind == 0:
            w, u = _unpack_pairs(known["a"], known["b"])
            n, keys = _unpack_small(known["n"]), w << 32 | u
            table = np.ones((width, len(n) + 1), dtype=np.int64)
            table[0, :-1], table[:, -1] = n, 0
            for s in range(samples):
                table[1 + s, :-1][n > 1] = _unpack_small(pieces[s]["n"])
        elif known:
            parts = [_unpack_small(known["n"]).reshape(len(SUMS), -1)[:1], *(_unpack_small(pieces[s]["n"]).reshape(3, -1) for s in range(samples))]
            table = np.concatenate([np.concatenate(parts), table], axis=1)
        questions = list(zip(*(asked.column(c).to_pylist() for c in ("block", "at", "names", "w", "u"))))
        lists = [_unpack_names(q[2]) for q in questions]
        # All questions' words are looked up together.
        found_at = pc.index_in(pa.concat_arrays(lists), value_set=_unpack_names(known["names"])) if known and lists else pa.nulls(sum(map(len, lists)), pa.int32())
        found_at = np.split(pc.fill_null(found_at, -1).to_numpy().astype(np.int64), np.cumsum([len(x) for x in lists])[:-1]) if lists else []
        for place, (block, shard, _, w, u) in zip(found_at, questions):
            if kind == 0:
                a, b = (place[x] for x in _unpack_pairs(w, u))
                key = a << 32 | b
                found = np.searchsorted(keys, key)
                place = np.where((a >= 0) & (b >= 0) & (np.append(keys, -1)[found] == key), found, -1)
            rows.append((block, kind, shard, _pack_found(table[:, place])))
        give_back()
        return _rows(_TOLD_BLOCKS, rows)
    return run


SCORES = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
PACKED = "block long, ids binary, held binary, sizes binary, texts binary"


def _pack_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a block (of one batch) as one row."""
    for b in rebatched(batches):
        block, texts = b.column("block").to_numpy(), byte_texts(b)
        ids, held = b.column("id").to_numpy(), np.array(b.column("held_out").to_pylist(), dtype=np.uint8)
        ends = (np.flatnonzero(np.diff(block)) + 1).tolist()
        rows = [(int(block[i]), _pack(ids[i:j]), _pack(held[i:j]), _pack(np.array([len(t) for t in texts[i:j]], dtype=np.int64)), zstandard.compress(b"".join(texts[i:j]), 1))
                for i, j in zip([0, *ends], [*ends, len(block)]) if j > i]
        yield from _rows({"block": pa.int64(), **dict.fromkeys(("ids", "held", "sizes", "texts"), pa.binary())}, rows).to_batches()


def _score(places: Places, samples: list[Totals], tokens: int, vocabulary: int):
    """One block: its documents, and the answers for its words and pairs."""
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, held, texts = [], [], []
        for r in docs.to_pylist():
            raw, ends = zstandard.decompress(r["texts"]), np.cumsum(_unpack(r["sizes"], np.int64)).tolist()
            texts += [raw[i:j] for i, j in zip([0, *ends], ends)]
            ids.append(_unpack(r["ids"], np.int64))
            held.append(_unpack(r["held"], np.uint8))
        own = Block.of(texts, places)
        told = {(k, at): raw for k, at, raw in zip(*(answers.column(c).to_pylist() for c in ("kind", "at", "numbers")))}
        pairs, words = np.zeros((1 + len(samples), len(own.w)), dtype=np.int64), np.zeros((1 + 3 * len(samples), len(own.names)), dtype=np.int64)
        for kind, whole, parts in ((0, pairs, own.pairs_by_shard()), (1, words, own.words_by_shard())):
            for shard, at in parts:
                whole[:, at] = _unpack_found(told[kind, shard], len(whole))
        p = np.zeros(len(own.w))
        for s, totals in enumerate(samples):
            ctx_tables, customers, tables = words[1 + 3 * s:4 + 3 * s]
            p += totals.predictive(pairs[0], pairs[1 + s], words[0][own.u], ctx_tables[own.u], totals.top(customers, tables)[own.w])
        score = np.log10(p / len(samples))[own.pair]
        base, known = np.log10((words[0] + 1) / (tokens + vocabulary + 1))[own.tokens], (words[0] > 0)[own.tokens]
        ends = np.flatnonzero(own.tokens == 0) + 1
        begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
        n, k, b, x = (ends - begins, *(np.add.reduceat(v, begins) for v in (known.astype(np.int64), base, score)))
        return pa.table({"id": pa.array(np.concatenate(ids)), "held_out": pa.array(np.concatenate(held).astype(bool)),
                         "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(k, pa.int64()), "base_score": pa.array(b, pa.float64()), "score": pa.array(x, pa.float64())})
    return run


def with_blocks(docs: DataFrame) -> DataFrame:
    """``docs`` in a shared table, with blocks of neighbouring rows."""
    return cut_lineage(docs.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)), "py-blocks")


def file_blocks(files: DataFrame) -> Column:
    """Blocks of neighbouring rows of a Parquet table, named by file, row and
    task (the same whenever the table is read, so no copy of it is needed)."""
    return F.xxhash64(F.col("_metadata.file_path"), F.shiftright(F.col("_metadata.row_index"), BLOCK_BITS), F.spark_partition_id()).alias("block")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(id, held_out, n_tokens, n_known, base_score, score) of (id, held_out,
    text, block)."""
    asked = docs.select("block", "text").mapInArrow(_ask(model.places), ASKED)
    told = asked.groupBy("kind", "at").cogroup(model.rows().groupBy("kind", "at")).applyInArrow(_answer_blocks(len(model.samples)), TOLD_BLOCKS)
    packed = docs.select("block", "id", "held_out", "text").mapInArrow(_pack_docs, PACKED)
    vocabulary = model.samples[0].vocabulary
    return packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_score(model.places, model.samples, model.tokens, vocabulary), SCORES)


def report(docs: DataFrame, folds: int = 7, held_out: int = 2, blocks: Column | None = None) -> DataFrame:
    """One row per document: fold, token counts, add-one base and model score.
    ``blocks`` names each row's block (see ``file_blocks``); without it the
    documents are copied into blocks."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    columns = [id_key().alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
               (F.crc32(name.cast("binary")) % folds == held_out).alias("held_out")]
    docs = with_blocks(docs.select(*columns)) if blocks is None else docs.select(*columns, blocks)
    model = train(docs.filter(~F.col("held_out")), shards_for(docs))
    scored = score(docs, model)
    return scored.select(id_back("id").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                         "base_score", "score")
