"""Token ids in patched frame-of-reference blocks.

Documents are encoded, each followed by an end id, and form one stream of ids
in document order.  The stream is cut into blocks of up to ``BLOCK`` ids; a
block stores its minimum, every id's distance from it at a width chosen from
percentiles of the distances, and an exception list of the ids that are wider.
A block also says where it starts and which documents it holds, so any range
of ids can be read without touching other blocks.

The files are a Parquet table of blocks (one row per block, binary payload),
written by Spark's own committers: they land in any store Spark can write to
and a lost executor only repeats its tasks.  Each range partition of document
ids is a shard, numbered in document order; block starts count from the
shard's first id, and the (small) table of shard sizes places the shards.

Payload, little-endian: bits packed ``width`` per id, 64 ids to ``width``
words of 64 bits; then for each exception its place (unsigned 16 bits), then
for each exception its distance (unsigned 32 bits).

Defined results: null text is the empty text, one end id; a null ``doc_id``
comes last; rows that repeat an id are separate documents (neighbours, ordered
by text, when the order is ``doc_id``); an empty table gives an empty result.
"""

from __future__ import annotations

import binascii
import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketfold.llm.common import SMALL_BATCHES, byte_texts, id_back, id_key, rebatched, text_or_empty, worker_memory
from marketfold.session import checkpoint_dir, conf_scope

VOCABULARY, END_ID = "word_bpe_49k.json", 1
BLOCK = 16_384
PERCENTILES = (90.0, 95.0, 98.0, 99.0, 100.0)


# ---- encoding ---------------------------------------------------------------

# A word of ASCII and Latin-1 letters, then ASCII marks: two pre-tokens at most,
# nothing to normalise but case.
PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!#$%&()*,./:;?@|_~+=^\"-]*)")
# Lower case of those letters' bytes (a byte of 0x80 .. 0x9E only follows 0xC3 there).
PLAIN_LOWER = bytes(c + 32 if 65 <= c <= 90 or 0x80 <= c <= 0x9E else c for c in range(256))


class _Packers(dict):
    """Packers of n unsigned 32-bit integers."""

    def __missing__(self, n: int):
        packer = struct.Struct(f"<{n}I").pack
        if n < 1000:
            self[n] = packer
        return packer


PACK = _Packers()


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet, by its rule: printable Latin-1 stands for itself,
    every other byte for the next letter from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordEncoder(dict):
    """Ids of a word, as little-endian bytes, through the tokenizers library.

    For vocabularies whose pre-tokenizer drops white space and never matches
    across it: a text's ids are then its words' ids in a row.  Plain words go
    straight to the vocabulary's BPE model if a set of probes shows that this
    gives what the whole tokenizer gives; all others, and all words of other
    vocabularies, take the whole tokenizer.  Words are remembered, by a worker
    also from task to task; the memory is emptied when it has grown large."""

    LIMIT = 600_000
    PROBES = ("a", "The", "Zwölf", "straße", "ÀÉÎÕÜÞ", "ÿïñ", "word.", "and,", "x***", "fin!!", "A-", "e%%%", "ab|", "Ça;", 'q"', "end/", "n_", "o~", "p+=", "s@^", "t(#)$&:?")

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = {b: c for b, c in byte_letters().items() if chr(b) != c}
        self.marks: dict[bytes, bytes] = {b"": b""}
        self.direct = all(self.plain(w.encode()) == self._bytes(self._whole(w)) for w in self.PROBES)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return PACK[len(ids)](*ids)

    def plain(self, word: bytes) -> bytes | None:
        """Ids of a plain word, None for any other."""
        if word.isalpha():  # ASCII letters spell themselves
            return PACK[len(t := self.tokenize(word.lower().decode()))](*[x.id for x in t])
        m = PLAIN.fullmatch(word)
        if m is None:
            return None
        letters, marks = m.groups()
        tail = self.marks.get(marks)
        if tail is None:
            tail = self._bytes(self._whole(marks.decode()))
            if len(self.marks) < 10_000:
                self.marks[marks] = tail
        spelled = letters.lower().decode() if letters.isascii() else letters.translate(PLAIN_LOWER).decode("latin-1").translate(self.letters)
        return PACK[len(t := self.tokenize(spelled))](*[x.id for x in t]) + tail

    def __missing__(self, word: bytes) -> bytes:
        ids = self.plain(word) if self.direct else None
        if ids is None:
            ids = self._bytes(self._whole(word.decode()))
        self[word] = ids
        return ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self) > self.LIMIT:
            self.clear()
        return [b"".join(map(self.__getitem__, t.split())) for t in texts]


def encoder_for(vocabulary: str) -> WordEncoder:
    """The worker's encoder of a vocabulary file."""
    encoders = worker_memory("token encoders")
    if vocabulary not in encoders:
        encoders[vocabulary] = WordEncoder(vocabulary)
    return encoders[vocabulary]


# ---- blocks -----------------------------------------------------------------

def pack(values: np.ndarray, width: int) -> bytes:
    """``width`` bits of each value, 64 values to ``width`` 64-bit words."""
    if not width or not len(values):
        return b""
    rows = np.zeros((-(-len(values) // 64), 64), dtype=np.uint64)
    rows.reshape(-1)[:len(values)] = values
    out = np.zeros((len(rows), width), dtype="<u8")
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[:, word] |= rows[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= rows[:, j] >> np.uint64(64 - shift)
    return out.tobytes()


def unpack(payload: bytes, n: int, width: int) -> np.ndarray:
    if not width or not n:
        return np.zeros(n, dtype=np.uint64)
    words = np.frombuffer(payload, dtype="<u8").reshape(-1, width)
    words = words.astype(np.uint64)
    out = np.empty((len(words), 64), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = value & mask
    return out.reshape(-1)[:n]


def packed_bytes(n: int, width: int) -> int:
    return -(-n // 64) * width * 8


def encode_block(ids: np.ndarray) -> tuple[int, int, int, bytes]:
    """(base, width, exceptions, payload) of up to 65,536 ids."""
    base = int(ids.min()) if len(ids) else 0
    far = ids.astype(np.int64) - base
    best = None
    for top in np.percentile(far, PERCENTILES, method="higher") if len(far) else (0,):
        width = int(top).bit_length()
        outliers = int((far >> width > 0).sum())
        size = packed_bytes(len(far), width) + 6 * outliers
        if best is None or size < best[0]:
            best = (size, width)
    width = best[1]
    places = np.flatnonzero(far >> width > 0)
    inside = far & ((1 << width) - 1)
    payload = pack(inside, width) + places.astype("<u2").tobytes() + far[places].astype("<u4").tobytes()
    return base, width, len(places), payload


def decode_block(n: int, base: int, width: int, exceptions: int, payload: bytes) -> np.ndarray:
    at = packed_bytes(n, width)
    far = unpack(payload[:at], n, width)
    if exceptions:
        places = np.frombuffer(payload, dtype="<u2", count=exceptions, offset=at)
        far[places] = np.frombuffer(payload, dtype="<u4", count=exceptions, offset=at + 2 * exceptions)
    return (far + np.uint64(base)).astype("<u4")


# ---- writing ----------------------------------------------------------------

BLOCK_SCHEMA = ("shard int, start long, n int, base long, width int, exceptions int, payload binary, "
                "doc_ids array<long>, doc_counts array<int>, doc_before array<long>, doc_after array<long>")


def _blocks_of(vocabulary: str, end_id: int, block: int):
    """One task: its documents, already in order, as rows of blocks."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, rows, held = encoder_for(vocabulary), [], []
        shard, start, filled = None, 0, 0
        for b in rebatched(batches, 512):
            for doc, part, ids in zip(b.column("id").to_pylist(), b.column("shard").to_pylist(), encoder.encode(byte_texts(b))):
                shard = part
                stream, done = np.frombuffer(ids + end, dtype="<u4"), 0
                while done < len(stream):
                    piece = stream[done:done + block - filled]
                    held.append((doc, piece, done, len(stream) - done - len(piece)))
                    done += len(piece)
                    filled += len(piece)
                    if filled == block:
                        rows.append(_row(shard, start, held))
                        start, filled, held = start + filled, 0, []
            if len(rows) >= 64:
                yield _batch(rows)
                rows = []
        if held:
            rows.append(_row(shard, start, held))
        if rows:
            yield _batch(rows)
    return run


def _row(shard: int, start: int, held: list) -> tuple:
    docs, pieces, before, after = zip(*held)
    ids = np.concatenate(pieces)
    return (shard, start, len(ids), *encode_block(ids), docs, [len(p) for p in pieces], before, after)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(),
             pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
    names = [x.split()[0] for x in BLOCK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, order: tuple[str, ...] = ("doc_id",), end_id: int = END_ID,
                 block: int = BLOCK) -> None:
    """Write the ids of ``docs`` (doc_id, text and the columns of ``order``) to
    the block files under ``path``, documents in ascending ``order``."""
    keys = [id_key().alias("id") if c == "doc_id" else F.col(c) for c in order]
    keyed = docs.select(id_key().alias("id"), text_or_empty().alias("text"), *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    # Rows equal in ``order`` go on by a hash of their text, so that they are not one range.
    keyed = keyed.withColumn("_tie", F.xxhash64("text"))
    by = [*[F.col(f"_k{i}").asc_nulls_last() for i in range(len(keys))], F.col("_tie")]
    ranged = keyed.repartitionByRange(*by).sortWithinPartitions(*by, "id", "text")
    blocks = ranged.select("id", "text", F.spark_partition_id().alias("shard")).mapInArrow(_blocks_of(vocabulary, end_id, block), BLOCK_SCHEMA)
    with conf_scope(docs.sparkSession, SMALL_BATCHES):
        blocks.write.mode("overwrite").option("compression", "none").parquet(path)


# ---- reading ----------------------------------------------------------------

def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


def shard_starts(blocks: DataFrame) -> DataFrame:
    """(shard, first): ids in all shards before it.  One row per shard."""
    sizes = blocks.groupBy("shard").agg(F.sum("n").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))


# CRC-32 of A followed by B is (CRC of A carried over len(B) zero bytes) xor (CRC of B).
_POLYNOMIAL = 0xEDB88320


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    while vector:
        bit = vector & -vector
        out ^= matrix[bit.bit_length() - 1]
        vector ^= bit
    return out


def _zero_byte_powers() -> list[list[int]]:
    """Operators that carry a CRC over 1, 2, 4, 8 ... zero bytes."""
    bit = [_POLYNOMIAL] + [1 << i for i in range(31)]
    for _ in range(3):
        bit = [_times(bit, row) for row in bit]
    powers = [bit]
    for _ in range(62):
        powers.append([_times(powers[-1], row) for row in powers[-1]])
    return powers


_POWERS: list[list[int]] = []


def carried(crc: int, n_bytes: int) -> int:
    if not _POWERS:
        _POWERS.extend(_zero_byte_powers())
    k = 0
    while n_bytes:
        if n_bytes & 1:
            crc = _times(_POWERS[k], crc)
        n_bytes >>= 1
        k += 1
    return crc


PIECE_SCHEMA = "id long, shard int, start long, n long, crc long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decode blocks; per piece of a document the document's start in its
    shard, the piece's length and its share of the document's CRC."""
    for b in rebatched(batches, 16):
        out = []
        for r in b.to_pylist():
            ids = decode_block(r["n"], r["base"], r["width"], r["exceptions"], r["payload"])
            at = 0
            for doc, n, before, after in zip(r["doc_ids"], r["doc_counts"], r["doc_before"], r["doc_after"]):
                out.append((doc, r["shard"], r["start"] + at - before, n, carried(binascii.crc32(ids[at:at + n].tobytes()), 4 * after)))
                at += n
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["id", "shard", "start", "n", "crc"])


def read_range(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """Ids ``start`` .. ``start + n`` of the stream: only the blocks that hold
    them are read (the range must fit the driver)."""
    blocks = read_blocks(spark, path)
    placed = blocks.join(shard_starts(blocks), "shard").withColumn("at", F.col("first") + F.col("start"))
    hit = placed.filter((F.col("at") < start + n) & (F.col("at") + F.col("n") > start)).orderBy("at")
    out = [np.empty(0, dtype="<u4")]
    for r in hit.select("at", "n", "base", "width", "exceptions", "payload").toLocalIterator():
        ids = decode_block(r["n"], r["base"], r["width"], r["exceptions"], bytes(r["payload"]))
        out.append(ids[max(0, start - r["at"]):start + n - r["at"]])
    return np.concatenate(out)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: first id, number of ids, CRC-32 of them."""
    blocks = read_blocks(spark, path)
    pieces = blocks.select("shard", "start", "n", "base", "width", "exceptions", "payload", "doc_ids", "doc_counts", "doc_before", "doc_after") \
                   .mapInArrow(_pieces, PIECE_SCHEMA)
    whole = pieces.groupBy("shard", "start").agg(F.min("id").alias("id"), F.sum("n").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32"))
    # Two numbers per shard, and no more shards than range partitions: bounded.
    return whole.join(F.broadcast(shard_starts(blocks)), "shard") \
                .select(id_back("id").alias("doc_id"), (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def fresh_path(spark: SparkSession) -> str:
    """A new folder for block files in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/tables/tokens-{uuid.uuid4().hex}"


def report(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode, write in ascending ``doc_id``, read the files back."""
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession)
    write_tokens(docs, path, vocabulary)
    return token_index(spark, path)
