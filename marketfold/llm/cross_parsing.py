"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of labelled text.  A document is parsed
with it greedily: a phrase is the longest match from here on that occurs in the
language's text, then the next phrase begins (a symbol that the language does
not have is a phrase of its own).  A phrase costs the bits of a pointer into
the language's text, log2 of its length, so languages with more or less
labelled text compare; bits per symbol are the cross-entropy estimate.  The
language whose phrases cost least wins.

Learning: ``PIECES`` pieces of at most ``PIECE`` bytes per language, each from
another labelled text, chosen by hash (a documented bound; counting is over all
labelled rows).  The pieces, some tens of kilobytes per language, are
broadcast; every Python worker builds the automata once, as tables (state x
symbol) of the parse.  Many languages are parsed in groups of ``GROUP``, one
group at a time, so the tables a worker holds do not grow with their number.

Texts are whole: a text is cut into stretches of ``STRETCH`` symbols which are
parsed side by side as numpy vectors.  No phrase crosses the cut; the cuts are
the same for all languages.  One map over the documents, no shuffle.

Symbols are the bytes of the lower-cased text; runs of ASCII characters that
are no letters count as one space.

Defined results: ``und`` with score 0 for null, empty and letterless texts, and
for all if nothing could be learned; ties go to the language with more labelled
rows, then by name; letters that no language has seen decide nothing, such a
text is a tie.  The score is the winner's posterior probability when a bit of
code length counts as a factor of two.  A row with a null id is in no fold of
the query: it is not learned from and its ``held_out`` is null.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.llm.common import byte_slices, packed, row_texts, unpacked
from marketfold.session import cut_lineage

PIECES, PIECE = 256, 192
GROUP = 16
STRETCH = 256
LANES = 8192          # stretches parsed side by side
BATCH_BYTES = 2 << 20
UNKNOWN = "und"
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def symbols(text: bytes) -> bytes:
    """Lower-cased bytes, other ASCII characters than letters as single spaces."""
    return b" ".join(text.decode().lower().encode().translate(_LETTERS).split())


def has_letter(text: bytes, flat: bytes) -> bool:
    return flat.translate(None, bytes(range(128, 256)) + b" ") != b"" or any(c.isalpha() for c in text.decode())


class Parser:
    """Greedy parse against one language's text.

    ``table[state * width + symbol]`` is twice the next state (times
    ``width``), plus one where a new phrase begins with this symbol."""

    def __init__(self, pieces: list[bytes]):
        self.size = sum(map(len, pieces))
        edges, root = suffix_automaton(pieces)
        seen = sorted({c for e in edges for c in e})
        self.code = np.zeros(256, dtype=np.uint32)  # 0: not in the language
        self.code[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1
        # One state more, after a symbol that the language does not have.
        lost = len(edges)
        begin = np.full(self.width, lost, dtype=np.int64)
        for c, to in edges[root].items():
            begin[self.code[c]] = to
        fresh = (begin * self.width * 2 + 1).astype(np.uint32)
        self.table = np.tile(fresh, lost + 1)
        states = np.repeat(np.arange(lost), [len(e) for e in edges])
        codes = self.code[np.array([c for e in edges for c in e], dtype=np.int64)].astype(np.int64)
        to = np.array([t for e in edges for t in e.values()], dtype=np.int64)
        self.table[states * self.width + codes] = (to * self.width * 2).astype(np.uint32)
        self.start = lost * self.width

    def phrases(self, columns: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Phrases per stretch.  ``columns[t]``: symbol ``t`` of every stretch,
        longest first; ``live[t]``: how many stretches have one."""
        coded = self.code[columns]
        state = np.full(columns.shape[1], self.start, dtype=np.uint32)
        count = np.zeros(columns.shape[1], dtype=np.uint32)
        one = np.uint32(1)
        for t, n in enumerate(live.tolist()):
            step = self.table.take(state[:n] + coded[t, :n])
            count[:n] += step & one
            np.right_shift(step, one, out=state[:n])
        return count


def suffix_automaton(pieces: list[bytes]) -> tuple[list[dict[int, int]], int]:
    """Edges per state of the generalised suffix automaton, and its root.
    States are numbered by distance from the root, as most parses stay near."""
    edges, link, length = [{}], [-1], [0]

    def split(p: int, c: int, q: int) -> int:
        if length[p] + 1 == length[q]:
            return q
        edges.append(dict(edges[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        clone = len(edges) - 1
        link[q] = clone
        while p != -1 and edges[p].get(c) == q:
            edges[p][c] = clone
            p = link[p]
        return clone

    for piece in pieces:
        last = 0
        for c in piece:
            if c in edges[last]:
                last = split(last, c, edges[last][c])
                continue
            edges.append({})
            link.append(0)
            length.append(length[last] + 1)
            current, p = len(edges) - 1, last
            while p != -1 and c not in edges[p]:
                edges[p][c] = current
                p = link[p]
            if p != -1:
                link[current] = split(p, c, edges[p][c])
            last = current
    rank = np.argsort(np.argsort(np.array(length), kind="stable")).tolist()
    renumbered: list[dict[int, int]] = [{}] * len(edges)
    for s, out in enumerate(edges):
        renumbered[rank[s]] = {c: rank[t] for c, t in out.items()}
    return renumbered, rank[0]


def stretches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts cut into stretches: (text number, start, length) in the joined bytes, longest first."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = -(-sizes // STRETCH)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    length = np.minimum(sizes[owner] - nth * STRETCH, STRETCH)
    start = (np.cumsum(sizes) - sizes)[owner] + nth * STRETCH
    by = np.argsort(-length, kind="stable")
    return owner[by], start[by], length[by]


def count_phrases(texts: list[bytes], parsers: list[Parser]) -> np.ndarray:
    """Phrases per text (rows) and parser (columns)."""
    out = np.zeros((len(texts), len(parsers)), dtype=np.int64)
    data = np.frombuffer(b"".join(texts) + bytes(STRETCH), dtype=np.uint8)
    owner, start, length = stretches(texts)
    for at in range(0, len(owner), LANES):
        o, s, n = owner[at:at + LANES], start[at:at + LANES], length[at:at + LANES]
        columns = data[s[None, :] + np.arange(int(n[0]))[:, None]]
        live = np.searchsorted(-n, -np.arange(int(n[0])), side="left")
        for k, parser in enumerate(parsers):
            out[:, k] += np.bincount(o, weights=parser.phrases(columns, live), minlength=len(texts)).astype(np.int64)
    return out


# -- learning -----------------------------------------------------------------

def labelled_pieces(labelled: DataFrame, pieces: int = PIECES, piece: int = PIECE) -> DataFrame:
    """(lang, n_rows, part): at most ``pieces`` pieces of about ``piece``
    symbols per language, from texts and places chosen by hash.

    Rows are thinned to four times the wanted number before anything is
    shuffled, so a language with most of the rows is not one large group;
    identical texts have one hash and give one piece.  The labels and their
    row counts are few (the driver holds a model of each)."""
    rows = labelled.filter(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return rows.select("lang", F.lit(0).cast("long").alias("n_rows"), F.col("text").alias("part")).limit(0)
    n_rows = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("lang")).cast("long")
    # The text's hash chooses both the text and the place of its piece.
    rows = rows.filter(F.col("text").isNotNull()).withColumn("_h", F.pmod(F.xxhash64("text"), F.lit(1 << 48)))
    place = F.col("_h") % F.greatest(F.length("text") - piece, F.lit(1)) + 1
    chosen = rows.filter(F.col("_h").cast("double") * n_rows < 4.0 * pieces * float(1 << 48)).groupBy("lang", "_h").agg(
        F.min(F.substring(F.col("text"), place.cast("int"), F.lit(piece))).alias("part"))
    order = Window.partitionBy("lang").orderBy("_h", "part")
    return chosen.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= pieces).select("lang", n_rows.alias("n_rows"), "part")


Model = list[tuple[str, int, list[bytes]]]  # language, labelled rows, pieces


def learn(labelled: DataFrame, pieces: int = PIECES, piece: int = PIECE) -> list[Model]:
    """Pieces by language, languages by labelled rows, in groups."""
    rows = cut_lineage(labelled_pieces(labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")), pieces, piece),
                       "language-pieces")
    by_lang: dict[str, tuple[int, list[bytes]]] = {}
    for r in rows.orderBy("lang", "part").toLocalIterator():
        flat = symbols(r["part"].encode())
        if flat:
            by_lang.setdefault(r["lang"], (r["n_rows"], []))[1].append(flat)
    model = sorted(((lang, n, parts) for lang, (n, parts) in by_lang.items()), key=lambda m: (-m[1], m[0]))
    return [model[at:at + GROUP] for at in range(0, len(model), GROUP)]


# -- prediction ----------------------------------------------------------------

_built: dict[str, list[Parser]] = {}


def parsers_of(key: str, model: Model) -> list[Parser]:
    """The group's parsers, built once per worker; a worker holds one group."""
    if key not in _built:
        _built.clear()
        _built[key] = [Parser(parts) for _, _, parts in model]
    return _built[key]


BEST = [T.StructField("_lang", T.StringType()), T.StructField("_bits", T.DoubleType()), T.StructField("_mass", T.DoubleType()),
        T.StructField("_symbols", T.LongType())]


def _parse(shared, key: str, first: bool):
    """Map rows to the best language so far: ``_bits`` of it, and ``_mass``,
    the sum of 2 ** (_bits - bits) over the languages seen."""
    def run(batches):
        from marketfold.llm import cross_parsing as own  # the worker's module keeps the parsers
        model = shared.value
        parsers = own.parsers_of(key, model)
        names, pointer = [m[0] for m in model], np.array([math.log2(p.size + 1) for p in parsers])
        for b in byte_slices(batches, BATCH_BYTES):
            raw = row_texts(b)
            flat = [symbols(t) for t in raw]
            bits = count_phrases(flat, parsers) * pointer
            best = bits.argmin(axis=1)
            least = bits[np.arange(len(raw)), best]
            mass = np.exp2(least[:, None] - bits).sum(axis=1)
            langs = [names[k] if has_letter(t, f) else None for k, t, f in zip(best.tolist(), raw, flat)]
            if not first:
                old_bits, old_mass = (np.array(b.column(c).to_pylist(), dtype=float) for c in ("_bits", "_mass"))
                old_lang = b.column("_lang").to_pylist()
                low = np.minimum(old_bits, least)
                mass = old_mass * np.exp2(low - old_bits) + mass * np.exp2(low - least)
                langs = [o if ob <= nb else n for o, n, ob, nb in zip(old_lang, langs, old_bits.tolist(), least.tolist())]
                least = low
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(langs, pa.string()), pa.array(least), pa.array(mass),
                                              pa.array([len(f) for f in flat], pa.int64())], names=["_row", *[f.name for f in BEST]])
    return run


def identify(docs: DataFrame, groups: list[Model]) -> DataFrame:
    """``_row`` plus ``lang_pred``, ``score``, ``n_symbols`` and ``entropy``
    (bits per symbol of the best language)."""
    rows = packed(docs)
    schema = T.StructType([rows.schema["_row"], *BEST])
    for k, model in enumerate(groups):
        key = uuid.uuid4().hex
        out = rows.mapInArrow(_parse(docs.sparkSession.sparkContext.broadcast(model), key, k == 0), schema)
        rows = cut_lineage(out, "languages") if k < len(groups) - 1 else out
    if not groups:
        rows = rows.select("_row", *[F.lit(None).cast(f.dataType).alias(f.name) for f in BEST])
    return rows.select("_row", F.coalesce("_lang", F.lit(UNKNOWN)).alias("lang_pred"),
                       F.when(F.col("_lang").isNull(), 0.0).otherwise(1.0 / F.col("_mass")).alias("score"),
                       F.coalesce("_symbols", F.lit(0)).cast("long").alias("n_symbols"),
                       F.when(F.col("_lang").isNotNull(), F.col("_bits") / F.col("_symbols")).alias("entropy"))


def fold(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def report(docs: DataFrame) -> DataFrame:
    """Prediction for every document, learned from those outside fold 1 of 3."""
    groups = learn(docs.filter(fold(3) != 1))
    return unpacked(identify(docs.select("doc_id", "text"), groups), ["doc_id"],
                    (F.crc32(F.col("_row.doc_id").cast("string")) % 3 == 1).alias("held_out"), "lang_pred", "score", "n_symbols", "entropy")
