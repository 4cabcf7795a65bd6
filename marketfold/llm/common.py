"""Small helpers shared by the training-data operators.

Conventions used by all of them:

* a null text counts as the empty text;
* a null ``doc_id`` ranks after every other id, and all rows without an id
  count as one document (``ID_LAST`` stands for it inside the jobs and is
  turned back into null in results);
* operators read only the columns they name; where rows pass through, all of
  their columns travel in one struct (``packed``), so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that separates words, and ASCII lower-casing of bytes.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ID_LAST = 2**63 - 1


# For jobs whose tasks hand whole texts to Python: batches of fewer rows than
# Spark's default keep the memory of a task and its worker small.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(ID_LAST))


def id_back(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != F.lit(ID_LAST), c)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of the contract class (runs of anything but ASCII white space)."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """All columns of ``docs`` as the struct ``_row``, and further columns."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *more)


def unpacked(df: DataFrame, columns: list[str], *more: Column | str, **instead: Column) -> DataFrame:
    """The columns back from ``_row``, some replaced, and further columns."""
    return df.select(*[instead.get(c, F.col("_row").getField(c)).alias(c) for c in columns], *more)


def row_texts(batch: pa.RecordBatch) -> list[bytes]:
    """``byte_texts`` of the packed rows."""
    return _bytes(batch.column("_row").field("text"))


def byte_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return _bytes(batch.column(name))


def _bytes(column: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def row_mark(col: str = "text") -> Column:
    """A number that tells the texts of one id apart (64-bit hash; texts that
    share it are only worked on together)."""
    return F.xxhash64(F.col(col).cast("string"))


def lower_words(text: bytes) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space (``bytes.split`` splits at
    exactly the six characters of ``SPACE``)."""
    return text.translate(ASCII_LOWER).split()


def rebatched(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Slices of bounded row count, so per-batch working memory stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


_kept: dict[str, dict] = {}


def worker_memory(owner: str) -> dict:
    """What the tasks of ``owner`` remember in their Python worker from task to
    task.  Workers outlive a stage: what the tasks of others left goes first."""
    others = [name for name in _kept if name != owner]
    for name in others:
        _kept.pop(name).clear()
    if others:
        pa.default_memory_pool().release_unused()
    return _kept.setdefault(owner, {})


class WordNumbers(dict):
    """Numbers words in order of appearance: a new word gets the next number."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def of(self, words: list[bytes], kind) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=kind, count=len(words))


def byte_slices(batches: Iterator[pa.RecordBatch], max_bytes: int, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows whose packed texts have at most
    ``max_bytes`` bytes (or that are one longer row)."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column("_row").field("text").cast(pa.binary())), 0).to_pylist()
        at = held = 0
        for i, size in enumerate(sizes):
            if i > at and (held + size > max_bytes or i - at >= rows):
                yield b.slice(at, i - at)
                at, held = i, 0
            held += size
        if len(sizes) > at:
            yield b.slice(at)
