"""Periodic runs, filter audit and cross-parsing against plain versions, and on odd rows."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction
from itertools import permutations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from marketfold.llm import cross_parsing, filter_audit, periodic_runs, queries
from marketfold.llm.oracle_sql import ORACLES
from tests.conftest import SF001
from tests.llm.conftest import ODD, prose
from tests.oracle_compare import compare

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# ---- op11 ---------------------------------------------------------------------

def plain_runs(words, min_length=24, exponent=3):
    found = set()
    for q in range(1, len(words) // exponent + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            stretch = words[at:end + q]
            if len(stretch) >= max(min_length, exponent * q) and not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                found.add((at, len(stretch), q))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


pieces = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=20), st.integers(1, 9), st.integers(0, 5)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(pieces, st.sampled_from([(24, 3), (10, 3), (30, 4)]))
def test_runs_are_those_of_all_lags(parts, limits):
    words = [w for unit, times, extra in parts for w in unit * times + list(range(9, 9 + extra))]
    assert periodic_runs.find_runs(np.array(words, dtype=np.int64), *limits) == plain_runs(words, *limits)


def test_one_repeated_word_and_a_fibonacci_word_stay_cheap():
    assert periodic_runs.find_runs(np.zeros(200_000, dtype=np.int64)) == [(0, 200_000, 1)]
    a, b = "a", "ab"
    while len(b) < 1500:
        a, b = b, b + a
    assert periodic_runs.find_runs(np.frombuffer(b.encode(), dtype=np.uint8).astype(np.int64)) == plain_runs(list(b))


def plain_row(doc_id, text):
    words = WORD.findall((text or "").encode())
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    text = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *(top or (None, None, None)), top and 1000 * top[1] // top[2], hashlib.sha256(text.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(), n)


def test_run_report_equals_the_plain_version(make_docs):
    rnd = random.Random(3)
    rows = [(k, prose(k, rnd.randint(0, 250))) for k in range(300)]  # a tenth get a periodic end
    rows += [(1000 + k, " ".join(prose(k, rnd.randint(1, 9)).split() * rnd.randint(3, 40)) + "\n\t" + prose(k, 30)) for k in range(40)]
    rows += [r for r in ODD if len(r[1] or "") < 100_000] + [(2000, "x " * 3000), (2000, "x " * 3000)]
    got = sorted(map(tuple, periodic_runs.report(make_docs(rows)).collect()), key=repr)
    assert got == sorted((plain_row(*r) for r in rows), key=repr)
    assert periodic_runs.report(make_docs([])).count() == 0


def test_collapse_keeps_columns_and_texts_without_runs(make_docs):
    docs = make_docs([(1, "a  b " * 20), (2, "a  b\n"), (None, None)])
    out = periodic_runs.collapse(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "a b", 2: "a  b\n", None: None}


# ---- op12 ---------------------------------------------------------------------

def plain_audit(rows, labels):
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good, toxic = ({d for d, *flags in labels if flags[k] == 1 and d is not None} for k in (0, 1))
    parts = {}
    for doc_id, text, source in rows:
        raw = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", raw)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", raw)) > 5 * len(raw),
                 "D": bool(re.search(r"[#$%&*|]", raw)), "E": raw in first and (doc_id is None or first[raw] < doc_id)}
        parts.setdefault(source or "", []).append(({f for f, x in fails.items() if x}, doc_id in good, doc_id in toxic))
    out = set()
    for part, docs in parts.items():
        removed = {}
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                removed[order, k + 1] = (f, len(left), len(gone), sum(f in d[0] for d in docs) - len(gone), sum(d[0] == {f} for d in docs),
                                         sum(d[1] for d in gone), sum(d[2] for d in gone))
        total = Counter()
        for f, _, gone, *_ in removed.values():
            total[f] += gone
        out |= {(part, order, step, *r[1:], total[r[0]]) for (order, step), r in removed.items()}
    return out


def audit_rows():
    rnd = random.Random(5)
    texts = [prose(k, rnd.choice([5, 49, 50, 80, 200])) for k in range(40)] + ["A B C " * 30, "# " + prose(1, 60), "w " * 100, "É" * 10 + " A", "", None]
    rows = [(rnd.choice([None, k, k // 2]), rnd.choice(texts), rnd.choice(["s1", "s2", "", None])) for k in range(250)]
    labels = [(k, rnd.randint(0, 1), rnd.randint(0, 1)) for k in range(0, 200, 2)] + [(4, 1, 1), (None, 1, 1), (6, None, None)]
    return rows, labels


def test_audit_equals_the_plain_version(spark, make_docs):
    rows, labels = audit_rows()
    got = filter_audit.report(make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {tuple(r) for r in got.collect()} == plain_audit(rows, labels)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.report(make_docs([]), empty).count() == 0


def test_matrix_has_one_dictionary_and_every_cell(make_docs, monkeypatch):
    rows = [(k, prose(k % 30, 40 + k)) for k in range(60)] + [(100, None), (101, " ")]
    shards = filter_audit.csr_shards(make_docs(rows), ("doc_id",), shard_rows=50).collect()
    cells, ids = {}, set()
    for s in shards:
        indptr, indices, counts = (filter_audit._unpack(s[c], t) for c, t in (("indptr", np.int64), ("indices", np.int64), ("counts", np.int32)))
        for i, d in enumerate(s["docs"]):
            row = indices[indptr[i]:indptr[i + 1]]
            assert (np.diff(row) > 0).all()
            ids |= set(row.tolist())
            cells[d["_key"]["doc_id"]] = sorted(counts[indptr[i]:indptr[i + 1]].tolist())
    vocabulary = {w for _, t in rows for w in (t or "").split()}
    assert ids == set(range(len(vocabulary)))
    assert cells == {k: sorted(Counter((t or "").split()).values()) for k, t in rows}


def test_block_holds_its_words_as_arrays():
    doc = pa.struct([("_key", pa.struct([("doc_id", pa.int64())])), ("upper", pa.int64()), ("chars", pa.int64()), ("symbol", pa.bool_()), ("digest", pa.binary())])
    schema = pa.schema([("block", pa.int64()), ("local", pa.int32()), ("word", pa.string()), *[(c, pa.binary()) for c in ("indptr", "indices", "counts")], ("docs", pa.list_(doc))])
    texts = [" ".join(f"w{k}x{j}" for j in range(1000)) for k in range(100)]
    batch = pa.RecordBatch.from_arrays([pa.array([{"text": t} for t in texts]), pa.array([{"doc_id": k} for k in range(100)], doc.field("_key").type)], names=["_row", "_key"])
    block, arrow = filter_audit._Block(schema), pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        block.add(batch)
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    finally:
        tracemalloc.stop()
    assert held < 60 * 100_000  # bytes for each distinct word, all told
    words = [w for b in block.rows(7) for w in b.column("word").to_pylist() if w is not None]
    assert len(words) == 100_000 and set(words) == {w for t in texts for w in t.split()}


def test_words_of_a_block_are_those_of_split():
    texts = [b"", b" \t", b"b a\x0bb\x1cc\r\n", "\u3000x \x85y z\x0c".encode(), b"a\x1f"]
    words, lengths, indices, counts = filter_audit.sparse_rows(texts)
    names, ends = words.to_pylist(), np.cumsum(lengths)
    for t, n, end in zip(texts, lengths, ends):
        assert {names[i].encode(): c for i, c in zip(indices[end - n:end], counts[end - n:end].tolist())} == Counter(t.split())


def test_audit_oracle(spark, con001):
    ok, what = compare(queries.op12_filter_audit(spark, SF001), con001, ORACLES["op12_filter_audit"])
    assert ok, what


# ---- op13 ---------------------------------------------------------------------

def plain_phrases(text, pieces):
    """Greedy longest matches in any of the pieces, stretch by stretch."""
    n = 0
    for at in range(0, len(text), cross_parsing.STRETCH):
        part, i = text[at:at + cross_parsing.STRETCH], 0
        while i < len(part):
            size = 1
            while i + size < len(part) and any(part[i:i + size + 1] in p for p in pieces) and any(part[i:i + size] in p for p in pieces):
                size += 1
            i += size
            n += 1
    return n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab ", min_size=1, max_size=30), min_size=1, max_size=4), st.lists(st.text("abc ", max_size=700), max_size=5))
def test_phrases_are_greedy_longest_matches(parts, texts):
    pieces, raw = [p.encode() for p in parts], [t.encode() for t in texts]
    got = cross_parsing.count_phrases(raw, [cross_parsing.Parser(pieces), cross_parsing.Parser([b"zz"])])
    assert got[:, 0].tolist() == [plain_phrases(t, pieces) for t in raw]
    assert got[:, 1].tolist() == [len(t) for t in raw]


LETTERS = {"aa": "abcdefgh", "bb": "efghijklm", "cc": "klmnopqrst", "dd": "äöüßabcs"}


def languages(spark, extra=()):
    rows = [(k, prose(k, 30, LETTERS[lang]), lang) for k, lang in ((k, sorted(LETTERS)[k % 4]) for k in range(240))]
    return spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string").selectExpr("*", "'x' AS _row", "1 AS _h", "2 AS _lang")


def test_held_out_languages_are_found(spark, shipped):
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 ?! \n", "bb"), (1003, "ЖЖ", None), (None, prose(1, 20, LETTERS["cc"]), "cc"),
           (1004, prose(2, 20, LETTERS["cc"]), None), (1005, "x" * 100_000 + " " + prose(3, 30_000, LETTERS["bb"]), None)]
    docs = languages(spark, odd)
    got = {r["doc_id"]: r for r in cross_parsing.report(docs).collect()}
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] < 1000]
    assert len(held) > 50 and all(r["lang_pred"] == sorted(LETTERS)[r["doc_id"] % 4] for r in held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[k]["lang_pred"] for k in (1000, 1001, 1002)] == ["und"] * 3
    assert got[1003]["lang_pred"] in LETTERS and got[1004]["lang_pred"] == "cc" and got[1005]["lang_pred"] == "bb" and got[None]["lang_pred"] == "cc"
    assert {r["lang_pred"] for r in cross_parsing.report(docs.filter("lang IS NULL")).collect()} == {"und"}
    assert cross_parsing.report(docs.limit(0)).count() == 0


def test_groups_of_languages_give_what_one_group_gives(spark, shipped, monkeypatch):
    docs = languages(spark)
    groups = cross_parsing.learn(docs, pieces=20)
    assert len(groups) == 1 and all(len(p) <= 20 for _, _, p in groups[0])

    def rows(model):
        return sorted((r["_row"]["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in cross_parsing.identify(docs, model).collect())
    assert rows(groups) == rows([groups[0][:1], groups[0][1:3], groups[0][3:]])
