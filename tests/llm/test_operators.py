"""Each operator against a plain version on small fixtures, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketfold.llm import (bbit_minhash, chat_tools, curriculum, decontam, gear_chunks, line_ledger, pfor_tokens, pitman_yor,
                            quality_votes, queries, url_templates)
from marketfold.llm.common import ID_LAST, id_key, lower_words
from tests.llm.conftest import ODD, prose
from tests.llm.plain_seats import Seats


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# ---- op1 ----------------------------------------------------------------------

def test_gear_hash_rolls_and_cuts_ignore_what_is_elsewhere():
    text = prose(5, 400).encode()
    h, v = gear_chunks.gear_hashes(np.frombuffer(text, dtype=np.uint8)), 0
    for i, b in enumerate(text):
        v = ((v << gear_chunks.STEP) + int(gear_chunks.GEAR[b])) & 0xFFFFFFFF
        assert v == h[i]
    moved = prose(6, 7).encode() + text
    shift = len(moved) - len(text)
    late = [c for c in gear_chunks.cuts(text).tolist() if c > 100]
    assert set(late) <= {c - shift for c in gear_chunks.cuts(moved).tolist()}


def test_repeated_passages_go_and_clean_documents_stay(make_docs):
    passages = [prose(100 + k, 51) for k in range(30)]
    rows = [(k, f"{prose(k, 60)} {passages[k]} {prose(300 + k, 60)}") for k in range(30)]
    rows += [(1000 + k, f"{prose(500 + k, 20)} {passages[k]} {prose(700 + k, 40)}") for k in range(30)]
    rows += [(2000 + k, prose(900 + k, 150)) for k in range(10)]
    got = by_id(gear_chunks.report(make_docs(rows)))
    assert all(got[1000 + k]["kept_in"] == [k] and got[k]["n_removed_spans"] == 0 and got[k]["n_shared_words"] > 0 for k in range(30))
    assert all(got[2000 + k]["n_shared_words"] == 0 for k in range(10))
    assert got[2000]["kept_sha256"] == hashlib.sha256(prose(900, 150).encode()).hexdigest()


def test_chunks_on_odd_rows(make_docs):
    rows = gear_chunks.report(make_docs(ODD)).collect()
    assert len(rows) == len(ODD)
    kept = {(r["doc_id"], r["n_removed_spans"]) for r in rows}
    assert (904, 0) in kept and (905, 1) in kept and (None, 0) in kept
    assert gear_chunks.report(make_docs([])).count() == 0


# ---- op2 ----------------------------------------------------------------------

def plain_hits(text, items, window=13):
    words = decontam.item_words((text or "").encode())
    hit, found = set(), set()
    for name, item in items:
        w = decontam.item_words((item or "").encode())
        n = min(window, len(w))
        wanted = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in wanted:
                hit |= set(range(i, i + n))
                found.add(str(name))
    return len(words), len(hit), found


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=0, max_size=9), max_size=5), st.lists(st.sampled_from("abcd"), max_size=40), st.integers(1, 4))
def test_automaton_finds_what_windows_find(items, doc, window):
    named = [(str(i), " ".join(w)) for i, w in enumerate(items)]
    machine = decontam.ItemAutomaton([(n, decontam.item_words(t.encode())) for n, t in named], window)
    hit, found = machine.scan([w.encode() for w in doc])
    assert (len(doc), int(hit.sum()), found) == plain_hits(" ".join(doc), named, window)


@pytest.mark.parametrize("max_words", [2_000_000, 40])
def test_decontamination_rows_with_one_and_several_shards(make_docs, shipped, max_words):
    items = [(i, prose(40 + i, 20)) for i in range(8)] + [(8, "only three words"), (9, None), (10, ""), (None, prose(1, 20)), (2, prose(77, 15))]
    bench = shipped.createDataFrame(items, "item_id long, text string")
    rows = [(i, f"{prose(i, 40 * (i + 1))} {prose(40 + i, 20)} Only THREE, words {prose(60 + i, 30)}") for i in range(8)] + ODD
    got = decontam.match_items(make_docs(rows), bench, max_words=max_words).collect()
    assert len(got) == len(rows)
    named = [(n, t) for n, t in items if n is not None]
    for r in got:
        n, hit, found = plain_hits(r["_row"]["text"], named)
        assert (r["_words"], r["_hit"], set(r["_items"])) == (n, hit, found)
    kept = decontam.decontaminate(make_docs(rows), bench)
    assert kept.columns == make_docs(rows).columns
    want = [t for _, t in rows if not (lambda n, h, _: h > 0 and 20 * h >= n)(*plain_hits(t, named))]
    assert sorted(str(r["text"]) for r in kept.collect()) == sorted(map(str, want))


def test_spans_are_cut_and_empty_benchmark_hits_nothing(make_docs, shipped):
    bench = shipped.createDataFrame([(1, prose(9, 20))], "item_id long, text string")
    text = f"{prose(1, 900)}, {prose(9, 20)}; {prose(2, 900)}"
    out = decontam.decontaminate(make_docs([(1, text)]), bench, min_span=13).collect()[0]["text"]
    assert out == f"{prose(1, 900)}, ; {prose(2, 900)}"
    none = decontam.report(make_docs(ODD), shipped.createDataFrame([], "item_id long, text string")).collect()
    assert len(none) == len(ODD) and all(r["n_items"] == 0 and not r["contaminated"] for r in none)


# ---- op3 ----------------------------------------------------------------------

def plain_base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    three = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times, inside, seen, again = Counter(three), set(), set(), 0
    for i, t in enumerate(three):
        if times[t] > 1:
            inside |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(inside)


def test_quality_counts_and_verdicts(make_docs):
    rnd = random.Random(4)
    rows = [(i, "\n".join(" ".join(rnd.choice(["of", "the", "a#", "b|c", "é"]) for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 9)))) for i in range(60)]
    good = [(100 + i, ". ".join(prose(1000 * i + j, 12).capitalize() for j in range(15)) + ".") for i in range(80)]
    junk = [(300 + i, " ".join(w + "###" for w in prose(i, 90).split())) for i in range(8)]
    out = quality_votes.report(make_docs(rows + good + junk + ODD)).collect()
    assert len(out) == len(rows + good + junk + ODD)
    texts = {i: t for i, t in rows + good + junk + ODD if i is not None}
    for r in out:
        if r["doc_id"] is not None:
            base = tuple(r[c] for c in quality_votes.FEATURES)
            assert base == plain_base(texts[r["doc_id"]])
            assert r["base_failed"] == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r["base_failed"] and r["kept"])
    kept = {r["doc_id"] for r in out if r["kept"]}
    assert {i for i, _ in good} <= kept and not kept & {i for i, _ in junk}
    assert quality_votes.report(make_docs([])).count() == 0
    assert quality_votes.keep_good(make_docs(good)).columns == make_docs(good).columns


# ---- op4 ----------------------------------------------------------------------

def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, full, pot = dict.fromkeys(order, 0.0), set(), 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        left = pot - sum(2 * sizes[s] for s in full)
        for s in open_:
            target[s] = left * weight[s] / sum(weight[x] for x in open_)
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over
        target.update({s: 2.0 * sizes[s] for s in over})


def test_mix_reaches_targets_in_training_order(make_docs):
    rnd = random.Random(8)
    rows = [(i, prose(i, rnd.randint(1, 60)), rnd.choice(["a", "b", "c", "d", None, "Z"])) for i in range(300)] + [(i, t, "odd") for i, t in ODD]
    docs = make_docs(rows)
    out = curriculum.report(docs).collect()
    assert len(out) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = Counter(), Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    want = plain_targets(sizes)
    source = {i: s for i, _, s in rows}
    for r in out:
        s = source[r["doc_id"]] if r["doc_id"] is not None else "odd"
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    mixed = curriculum.mix(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["source"]] += size(r["text"])
    assert all(abs(words[s] - want[s]) <= 1 for s in sizes)
    again = curriculum.mix(docs).select("doc_id", "text").collect()
    assert again == mixed.select("doc_id", "text").collect()
    assert curriculum.report(make_docs([])).count() == 0
    assert curriculum.mix(make_docs([(1, None), (2, "")])).count() == 0


def test_report_reads_the_training_rows(make_docs, monkeypatch):
    """``taken`` counts the words of the mix's rows, ``position`` is the place of the first one."""
    rows = [(i, prose(i, 20), "abc"[i % 3]) for i in range(60)] + [(7, prose(7, 20), "b"), (None, prose(70, 9), None), (None, None, "a"), (61, "", "c")]
    docs = make_docs(rows)
    words = Counter()
    for r in curriculum.mix(docs).collect():
        words[r["doc_id"]] += len(r["text"].split())
    got, taken = curriculum.report(docs), Counter()
    assert "rangepartitioning" in got._jdf.queryExecution().executedPlan().toString()
    for r in got.collect():
        taken[r["doc_id"]] += r["taken"]
        assert (r["position"] is None) == (r["taken"] == 0)
    assert len(got.collect()) == len(rows) and +taken == words
    whole = curriculum.first_words
    monkeypatch.setattr(curriculum, "first_words", lambda text, n: whole(text, n - 1))
    assert sum(r["taken"] for r in curriculum.report(docs).collect()) < sum(words.values())


def test_schedule_inverse(shipped):
    from pyspark.sql import functions as F
    for s in curriculum.SCHEDULES:
        xs = [i / 50 for i in range(51)]
        t = [r[0] for r in shipped.createDataFrame([(x,) for x in xs], "x double").select(s.time_of(F.col("x"))).collect()]

        def due(at):
            return sum(np.trapezoid(np.interp(g, *zip(*s.knots)), g) for g in [np.linspace(0, at, 4001)])
        assert all(abs(due(b) / due(1.0) - a) < 1e-4 for a, b in zip(xs, t))


# ---- op5 ----------------------------------------------------------------------

def plain_lines(rows):
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)})
    holder, out = {}, []
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                holder.setdefault(key(x), set()).add(math.inf if i is None else i)
    for i, t in rows:
        lines = (t or "").split("\n")
        me = math.inf if i is None else i
        stay = [x for x in lines if not (len(key(x)) >= 10 and len(holder[key(x)]) > 1 and min(holder[key(x)]) != me)]
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_ledger_grows_and_shrinks(make_docs, shipped):
    rnd = random.Random(2)
    pool = [prose(i, rnd.randint(1, 4)) for i in range(40)] + ["  \t", "É" * 9, "É" * 10, "MiXed Case line", " mixed case LINE\r"]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 9)))) for i in range(80)] + ODD
    rows_of = lambda df: sorted(map(tuple, df.select("_row.doc_id", "_lines", "_dropped", "_kept").collect()), key=str)
    assert sorted(map(tuple, line_ledger.report(make_docs(rows)).collect()), key=str) == plain_lines(rows)
    first, later = make_docs(rows[:50]), make_docs(rows[50:])
    ledger = line_ledger.LineLedger(shipped)
    grown = ledger.insert(first).insert(later)
    everything = make_docs(rows)
    whole = ledger.insert(everything)
    assert rows_of(grown.clean(everything)) == rows_of(whole.clean(everything))
    gone = shipped.createDataFrame([(i,) for i in range(50)], "doc_id long")
    shrunk, alone = grown.delete(gone), line_ledger.LineLedger(shipped).insert(later)
    assert rows_of(shrunk.clean(later)) == rows_of(alone.clean(later))
    back = shrunk.insert(first)
    assert rows_of(back.clean(everything)) == rows_of(whole.clean(everything))
    assert line_ledger.report(make_docs([])).count() == 0


def test_a_false_positive_keeps_its_own_entry(make_docs, shipped):
    # Two keys with one fingerprint and the same buckets: the filter says of the second that it knows it.
    place, other = line_ledger.CuckooFilter(capacity=line_ledger.KEYS_PER_SHARD), {}
    for line in (f"some line {i}" for i in range(400_000)):
        home = place._home(*place._place(line_ledger.line_key(line.encode())))
        if home in other:
            break
        other[home] = line
    a, b = other[home], line
    ledger = line_ledger.LineLedger(shipped, shards=1).insert(make_docs([(1, a)])).insert(make_docs([(2, b)]))
    ledger = ledger.delete(shipped.createDataFrame([(2,)], "doc_id long")).insert(make_docs([(3, a)]))
    left = ledger.remove_repeats(make_docs([(1, a), (3, a + "\nother words")])).collect()
    assert a != b and {r["doc_id"]: r["text"] for r in left} == {1: a, 3: "other words"}


def test_cuckoo_filter_has_no_false_negatives_and_forgets():
    keys = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(6000)]
    f = line_ledger.CuckooFilter(capacity=2000)  # overfilled: the stash holds the rest
    for k in keys:
        f.add(k)
    f = line_ledger.CuckooFilter(data=f.to_bytes())
    assert all(k in f for k in keys)
    for k in keys[:5000]:
        f.remove(k)
    assert all(k in f for k in keys[5000:]) and sum(k in f for k in keys[:5000]) < 100


# ---- op6 ----------------------------------------------------------------------

def test_urls_rules_and_templates(shipped):
    urls = ["https://A.Example.ORG/es/1?x", "http://org/en", "x://sub.com/de/9#f", "http://b.com", None, "no scheme", "", "h://example.org/en/12/a",
            "h://host.net/a/b", "h://Xcom/de/1", "h://h.com/fr", "y://z?q=1"]
    pages = shipped.createDataFrame([(i, u, "<p>", "r", 1.0) for i, u in enumerate(urls)], "page_id long, url string, html string, rule string, purity double")
    got = {r["page_id"]: r for r in url_templates.judge(pages).collect()}
    want = [("a.example.org", "/es/1", "example.org/es/", "block"), ("org", "/en", "org/", "allow"), ("sub.com", "/de/9", "com/de/", "block"),
            ("b.com", "", None, None), ("", "", None, None), ("", "", None, None), ("", "", None, None), ("example.org", "/en/12/a", "example.org/en/1", "block"),
            ("host.net", "/a/b", None, None), ("xcom", "/de/1", None, None), ("h.com", "/fr", None, None), ("z", "", None, None)]
    for i, (host, path, rule, verdict) in enumerate(want):
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ("allow", "block")
        assert verdict is None or r["verdict"] == verdict
    assert url_templates.judge(pages.limit(0)).count() == 0


def test_template_tree_learns_blocked_branches(shipped):
    pages = [(i, f"h://s.net/{'spam' if i % 2 else 'news'}/{i}/x.html") for i in range(400)]
    labels = [("s.net", f"/{'spam' if i % 2 else 'news'}/{i}/x.html", i % 2) for i in range(0, 200)]
    got = url_templates.judge(shipped.createDataFrame(pages, "page_id long, url string"), (), shipped.createDataFrame(labels, "host string, path string, blocked int")).collect()
    assert {(r["template"], r["verdict"]) for r in got} == {("/spam/*/x.html", "block"), ("/news/*/x.html", "allow")} or \
        {(r["template"], r["verdict"]) for r in got} == {("/spam/*/*", "block"), ("/news/*/*", "allow")}


def test_small_and_deep_branches_that_differ_stay(shipped):
    deep = "/a/b/c/d/e/f/g/h/i"
    pages = [f"/s{i % 40}/{i}" for i in range(1600)] + [f"{deep}/{'spam' if i % 2 else 'news'}/{i}" for i in range(200)]
    labels = [("s.net" if p[1] == "s" else "d.net", p, int(p.startswith("/s7/") or "spam" in p)) for p in pages[:800] + pages[1600:1700]]
    df = shipped.createDataFrame([(i, f"h://{'s' if p[1] == 's' else 'd'}.net{p}") for i, p in enumerate(pages)], "page_id long, url string")
    got = url_templates.judge(df, (), shipped.createDataFrame(labels, "host string, path string, blocked int")).collect()
    assert {r["page_id"] for r in got if r["verdict"] == "block"} == {i for i, p in enumerate(pages) if p.startswith("/s7/") or "spam" in p}


# ---- op7 ----------------------------------------------------------------------

def test_pitman_yor_sums_to_one_and_beats_the_base(make_docs, shipped):
    rnd = random.Random(3)
    follow = {w: [prose(1000 + 7 * i + j, 1) for j in range(3)] for i, w in enumerate(prose(5, 40).split())}
    vocab = list(follow)

    def text(n):
        out = [rnd.choice(vocab)]
        while len(out) < n:
            out.append(rnd.choice(follow.get(out[-1], vocab)))
        return " ".join(out)
    rows = [(i, text(120)) for i in range(150)] + ODD
    docs = make_docs(rows)
    got = pitman_yor.report(docs).collect()
    assert len(got) == len(rows)
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    c = Counter(x for i, t in rows if not fold(i) for x in [*lower_words((t or "").encode()), b""])
    n, v = sum(c.values()), len(c)
    texts = {i: t for i, t in rows if i is not None}
    held = [0.0, 0.0]
    for r in got:
        if r["doc_id"] is None:
            continue
        w = [*lower_words((texts[r["doc_id"]] or "").encode()), b""]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (fold(r["doc_id"]), len(w), sum(c[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        if r["held_out"] and r["doc_id"] < 150:
            held = [held[0] + r["base_score"], held[1] + r["score"]]
    assert held[1] > held[0]
    assert pitman_yor.report(make_docs([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=["a", "B", "É", " ", "\x1c", "\x85", "\u2003", "\t", "\n", "\x0b", "\x0c", "\r", "z", "Ж", "\x00"], max_size=30), min_size=1, max_size=9))
def test_tokens_are_lower_words_and_ends(texts):
    names, ids = pitman_yor.tokens_of([t.encode() for t in texts])
    names = names.to_pylist()
    assert len(set(names)) == len(names)
    assert [names[i] for i in ids.tolist()] == [w for t in texts for w in [*lower_words(t.encode()), b""]]
    packed = pitman_yor._unpack_names(pitman_yor._pack_names(pitman_yor.tokens_of([t.encode() for t in texts])[0]))
    assert packed.to_pylist() == names


def plain_model(model):
    """The shards as dictionaries: dishes (word, context) -> customers and
    tables per sample; words -> tokens and, per sample, tables of the word's
    restaurant, customers and tables in the unigram restaurant."""
    dishes, words, rows = {}, {}, {}
    for r in model.rows().collect():
        rows.setdefault((r["kind"], r["at"]), {})[r["piece"]] = r
    for (kind, _), pieces in rows.items():
        names = pitman_yor._unpack_names(pieces[-1]["names"]).to_pylist()
        n = pitman_yor._unpack_small(pieces[-1]["n"])
        if kind == 0:
            w, u = pitman_yor._unpack_pairs(pieces[-1]["a"], pieces[-1]["b"])
            tables = np.ones((len(model.samples), len(n)), dtype=np.int64)
            for k in range(len(model.samples)):
                tables[k][n > 1] = pitman_yor._unpack_small(pieces[k]["n"])
            for i in range(len(n)):
                assert (names[w[i]], names[u[i]]) not in dishes
                dishes[names[w[i]], names[u[i]]] = int(n[i]), tables[:, i].tolist()
        else:
            c = n.reshape(len(pitman_yor.SUMS), -1)[0]
            numbers = [pitman_yor._unpack_small(pieces[k]["n"]).reshape(3, -1).T for k in range(len(model.samples))]
            for i, name in enumerate(names):
                words[name] = int(c[i]), [x[i].tolist() for x in numbers]
    return dishes, words


@pytest.mark.parametrize("shards", [1, 7])
def test_every_previous_word_has_its_restaurant(make_docs, shipped, shards, monkeypatch):
    monkeypatch.setattr(pitman_yor, "LOOK", 1)
    monkeypatch.setattr(pitman_yor, "FLUSH", 50)
    rnd = random.Random(6)
    vocab = prose(5, 30).split()
    rows = [(i, " ".join(rnd.choice(vocab[:rnd.randint(1, 30)]) for _ in range(rnd.randint(0, 90)))) for i in range(80)] + [(900, None), (901, "ODD Words x"), (None, vocab[0]), (5, "a b")]
    docs = make_docs(rows)
    model = pitman_yor.train(docs.filter("doc_id < 60 OR doc_id = 900"), shards)
    dishes, words = plain_model(model)
    train = [[*lower_words((t or "").encode()), b""] for i, t in rows if i is not None and (i < 60 or i == 900)]
    pairs = Counter((w, u) for t in train for u, w in zip([b"", *t], t))
    assert {k: n for k, (n, _) in dishes.items()} == pairs
    assert {w: c for w, (c, _) in words.items()} == Counter(w for t in train for w in t) and model.tokens == sum(map(len, train))
    for k, totals in enumerate(model.samples):  # what restaurants share adds up
        as_dish, as_context = Counter(), Counter()
        for (w, u), (n, tables) in dishes.items():
            assert 1 <= tables[k] <= n
            as_dish[w] += tables[k]
            as_context[u] += tables[k]
        assert all((as_context[w], as_dish[w]) == tuple(x[k][:2]) and 1 <= x[k][2] <= x[k][1] for w, (_, x) in words.items())
        assert (totals.customers, totals.tables, totals.vocabulary) == (sum(as_dish.values()), sum(x[k][2] for _, x in words.values()), len(words))

    def p(w, u):
        out = 0.0
        for k, t in enumerate(model.samples):
            customers, tables = words[w][1][k][1:] if w in words else (0, 0)
            base = (1 + t.top_discount * t.tables) / (1 + t.customers) / (t.vocabulary + 1)
            top = (customers - t.top_discount * tables) / (1 + t.customers) + base
            c, open_ = (words[u][0], words[u][1][k][0]) if u in words else (0, 0)
            n, tables = (dishes[w, u][0], dishes[w, u][1][k]) if (w, u) in dishes else (0, 0)
            out += ((n - t.discount * tables) + (1 + t.discount * open_) * top) / (1 + c) / len(model.samples)
        return out
    for u in [b"", *map(str.encode, vocab[:5]), b"never seen"]:
        assert sum(p(w, u) for w in [*words, b"-new-"]) == pytest.approx(1.0)
    from pyspark.sql import functions as F
    asked = pitman_yor.with_blocks(docs.select(id_key().alias("id"), F.lit(False).alias("held_out"), F.coalesce("text", F.lit("")).alias("text")))
    got = sorted((r["id"] == ID_LAST, r["id"] % ID_LAST, round(r["score"], 6), r["n_tokens"]) for r in pitman_yor.score(asked, model).collect())
    texts = [(i, [*lower_words((t or "").encode()), b""]) for i, t in rows]
    assert got == sorted((i is None, i or 0, round(sum(math.log10(p(w, u)) for u, w in zip([b"", *t], t)), 6), len(t)) for i, t in texts)


def test_seats_keep_every_customer():
    rng = np.random.default_rng(1)
    n = np.array([1, 2, 5, 40, 3])
    seats = Seats(n, np.ones(5))
    for _ in range(300):
        seats.reseat(np.array([0.5, 0.1, 3.0, 20.0, 1e-9]), 0.6, rng)
        first = np.concatenate(([0], np.cumsum(seats.count)[:-1]))
        assert (seats.size > 0).all() and (np.add.reduceat(seats.size, first) == n).all()
    seats.follow(np.array([4, 1, 5, 10, 3]), 2.0, 0.6, rng)
    first = np.concatenate(([0], np.cumsum(seats.count)[:-1]))
    assert np.add.reduceat(seats.size, first).tolist() == [4, 1, 5, 10, 3]


def test_a_sweep_seats_all_customers_of_a_dish():
    # The law of one sweep is the one that reseating customers one by one converges to, wherever a dish started.
    rng, d, many = np.random.default_rng(2), 0.6, 4000
    drawn = pitman_yor.table_counts(np.full(many, 40), np.full(many, 0.8), d, rng)
    seats = Seats(np.full(many, 40), np.ones(many))
    for _ in range(3000):
        seats.reseat(np.full(many, 0.8), d, rng)
    assert drawn.mean() == pytest.approx(seats.count.mean(), rel=0.04) and drawn.std() == pytest.approx(seats.count.std(), rel=0.08)
    # One sweep from the model's start has that law too, whatever a dish's size.
    totals, pack = pitman_yor.Totals(9.0, 1.0, 1, d, 0.5), pitman_yor._pack
    zero, dish = np.zeros(1, dtype=np.int32), {}
    small = pitman_yor._pack_small
    dish.update(listed=pack(zero), w=small(zero), u=small(zero), n=small(np.array([4_000_000])))
    numbers, ends = np.array([[9, 9, 1]]), set()
    for seed in range(12):
        rng = np.random.default_rng(seed)
        for _ in range(4):
            tables, sums = pitman_yor.seat(dish, numbers, totals, rng)
            numbers = np.array([[sums[0, 1], sums[0, 0], 1]])
        ends.add(int(tables[0]))
    assert len(ends) > 8 and max(ends) - min(ends) > 50


@pytest.mark.parametrize("d", [0.1, 0.5, 0.8, 0.95])
@pytest.mark.parametrize("new", [1e-6, 0.02, 1.0, 40.0, 3000.0, 1e6])
def test_law_of_large_dishes_is_the_listed_one(d, new):
    for n in (60, 1024):
        listed = pitman_yor._log_seatings(d)[n, 1:n + 1] + np.log(new) * np.arange(1, n + 1)
        listed = np.exp(listed - listed.max())
        start, weight = pitman_yor._large_law(n, new, d)
        got = np.zeros(n + 1)
        got[start:start + len(weight)] = weight
        assert np.abs(got[1:] / got.sum() - listed / listed.sum()).max() < 1e-7


# ---- op8 ----------------------------------------------------------------------

def plain_components(rows, k=3, percent=85):
    sets, low = {}, {}
    for i, t in rows:
        w = lower_words((t or "").encode())
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
        low[i] = i
    def root(x):
        while low[x] != x:
            x = low[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                low[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def family(seed, base, n, share):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(int(len(w) * share)):
            w[rnd.randrange(len(w))] = "x%d" % rnd.randrange(10**6)
        out.append(" ".join(w))
    return out


def test_components_match_all_pairs(make_docs, monkeypatch):
    rows = [(7, prose(3, 200).upper()), (5, prose(3, 200)), (4, "one"), (9, "ONE"), (6, "two words"), (3, ""), (2, None), (1, "two words x")]
    texts = [t for s in range(4) for t in family(s, prose(50 + s, 150), 40, 0.02 + 0.01 * s)] + [prose(500 + i, 100) for i in range(30)]
    rows += [(100 + i, t) for i, t in enumerate(texts)]
    want = plain_components(rows)
    for docs_per_block in (2000, 15):
        monkeypatch.setattr(bbit_minhash, "BLOCK_DOCS", docs_per_block)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in bbit_minhash.report(make_docs(rows), 3, 0.85).collect()}
        assert got == want
    odd = bbit_minhash.report(make_docs(ODD)).collect()
    assert len(odd) == len(ODD) and {(r["doc_id"], r["component_id"]) for r in odd if r["doc_id"] in (904, 905)} == {(904, 904), (905, 904)}
    assert bbit_minhash.report(make_docs([])).count() == 0
    kept = bbit_minhash.keep_one(make_docs(rows), 3, 0.85)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_one_class_of_a_component_stays_whatever_its_ids(make_docs):
    near = prose(70, 200)
    rows = [(None, prose(71, 200)), (None, prose(72, 200)), (5, prose(71, 200)), (None, near + " x"), (3, near), (None, near + " y"), (8, prose(73, 200)),
            (8, prose(73, 200)), (8, prose(73, 200)), (9, prose(74, 200)), (9, prose(75, 200)), (9, near + " z"), (None, prose(76, 200)), (None, prose(76, 200)),
            (7, ""), (7, ""), (None, None), (None, None)]
    want = sorted([(5, rows[0][1]), (None, rows[1][1]), (3, near), *rows[6:9], (9, rows[9][1]), (9, rows[10][1]), *rows[12:14],
                   (7, ""), (7, ""), (None, None), (None, None)], key=repr)
    kept = bbit_minhash.keep_one(make_docs(rows), 3, 0.85)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == want
    told = bbit_minhash.report(make_docs(rows), 3, 0.85).collect()
    assert len(told) == len(rows) and sorted((r["doc_id"] for r in told if r["kept"]), key=repr) == sorted((i for i, _ in want), key=repr)
    assert Counter(r["component_id"] for r in told) == {None: 5, 3: 4, 5: 2, 7: 2, 8: 3, 9: 2}


def test_estimate_is_near_the_similarity(shipped):
    from pyspark.sql import functions as F
    memo, rows, want = bbit_minhash.WordHashes(), [], []
    for s in range(40):
        a = prose(s, 300)
        b = family(s, a, 1, 0.01 * (s % 12))[0]
        x, y = (bbit_minhash.shingle_hashes(t.encode().split(), 3, memo) for t in (a, b))
        want.append(len(np.intersect1d(x, y)) / len(np.union1d(x, y)))
        rows.append((s, *(bbit_minhash.packed_bits(bbit_minhash.minima(z)).tolist() for z in (x, y))))
    df = shipped.createDataFrame(rows, "i int, a array<long>, b array<long>")
    got = [r[0] for r in df.orderBy("i").select(bbit_minhash.estimate("a", "b")).collect()]
    assert max(abs(g - w) for g, w in zip(got, want)) < 0.17 and abs(np.mean(np.array(got) - want)) < 0.02


# ---- op9 ----------------------------------------------------------------------

def test_calls_are_linked_ordered_and_validated(shipped):
    calls = shipped.createDataFrame([
        (1, 5, "b", "search", '{"limit": 3, "query": "é x"}', "a"), (1, 9, "a", "count", '{"words": ["x"], "unique": 1}', None),
        (1, 2, "c", "nope", "{}", "b"), (1, 3, "d", "search", "{bad", "zz"), (1, 4, "e", "search", '{"query": ""}', "f"), (1, 4, "f", "translate", "[]", "e"),
        (1, 6, "a", "search", "{}", None), (None, None, "a", None, None, None)], "conv_id long, turn long, call_id string, name string, arguments string, after string")
    results = shipped.createDataFrame([(1, 10, "a", "r1"), (1, 11, "a", "r2"), (1, 12, "o", None), (1, 6, "b", "rb")], "conv_id long, turn long, call_id string, content string")
    messages = shipped.createDataFrame([(1, 0, "user", "hi"), (1, 1, None, None), (None, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    rows = chat_tools.format_chats(messages, calls, results).collect()
    one = {r["call_id"]: r for r in rows if r["conv"] == "1" and r["kind"] == 1}
    assert {k: (r["status"], r["depth"], r["ready"]) for k, r in one.items()} == {
        "a": ("invalid", 0, 6), "b": ("ok", 1, 10), "c": ("invalid", 2, 10), "d": ("invalid", 0, 3), "e": ("invalid", -1, 4), "f": ("invalid", -1, 4), "o": ("orphan", 0, 12)}
    assert one["b"]["line"] == '{"after":"a","arguments":{"limit":3,"query":"é x"},"id":"b","result":"rb","result_turn":6,"status":"ok","tool":"search","turn":5}'
    assert one["d"]["errors"] == ["not JSON"] and one["c"]["errors"] == ["unknown tool"]
    assert one["a"]["errors"] == ["$.query: missing", "$.limit: missing"]
    order = [r["call_id"] for r in rows if r["conv"] == "1" and r["kind"] == 1]
    assert order.index("a") < order.index("b") < order.index("c")
    assert [r["line"] for r in rows if r["conv"] == "1" and r["kind"] == 0] == ['{"content":"hi","role":"user","turn":0}', '{"content":"","role":"","turn":1}']


def test_calls_and_results_without_an_id_are_reported(shipped):
    calls = shipped.createDataFrame([("c", t, i, "count", '{"words":[]}', None) for t, i in ((1, None), (1, None), (3, "a"))],
                                    "conv_id string, turn long, call_id string, name string, arguments string, after string")
    results = shipped.createDataFrame([("c", 2, None, "x"), ("c", 4, "a", "y")], "conv_id string, turn long, call_id string, content string")
    messages = shipped.createDataFrame([], "conv_id string, turn long, role string, text string")
    got = [(r["turn"], r["call_id"], r["status"], r["errors"]) for r in chat_tools.format_chats(messages, calls, results).collect()]
    assert sorted(got, key=str) == [(1, None, "invalid", ["no call id"])] * 2 + [(2, None, "orphan", []), (3, "a", "ok", [])]


def test_long_dependency_chain_and_empty_tables(shipped):
    n = 300
    calls = shipped.createDataFrame([(1, n - i, f"c{i}", "search", '{"query":"q","limit":1}', f"c{i - 1}" if i else None) for i in range(n)],
                                    "conv_id long, turn long, call_id string, name string, arguments string, after string")
    none = shipped.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    got = chat_tools.topological(chat_tools.link_calls(calls, none)).collect()
    assert {r["call_id"]: (r["depth"], r["ready"]) for r in got} == {f"c{i}": (i, n) for i in range(n)}
    empty = shipped.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_tools.report(empty).count() == 0


def test_schema_errors():
    s = chat_tools.TOOLS["search"]
    assert chat_tools.schema_errors({"query": "a", "limit": 3.0}, s) == []
    assert chat_tools.schema_errors({"query": "", "limit": True, "x": 1}, s) == ["$.limit: not integer", "$.query: too short", "$.x: not allowed"]
    assert chat_tools.schema_errors([], s) == ["$: not object"]


# ---- op10 ---------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**32 - 1)), min_size=1, max_size=400))
def test_blocks_round_trip(ids):
    x = np.array(ids, dtype="<u4")
    assert (pfor_tokens.decode_block(len(x), *pfor_tokens.encode_block(x)) == x).all()


@given(st.binary(max_size=40), st.binary(max_size=40))
def test_crc_parts(a, b):
    assert pfor_tokens.carried(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("zqÉÀßÞ×÷*#|.,_-(\"@aAé \t\n\x0b\x0c\r\x1c\x85\u0301\u2003\u3000'st<|>endofx1Σİ漢🙂\u200d!")) , max_size=60))
def test_word_by_word_equals_whole_text(text):
    encoder = getattr(test_word_by_word_equals_whole_text, "encoder", None) or pfor_tokens.WordEncoder(queries.vocabulary_path())
    test_word_by_word_equals_whole_text.encoder = encoder
    assert encoder.direct
    text = text + "<|endoftext|>" + text
    ids = np.frombuffer(encoder.encode([text.encode()])[0], dtype="<u4").tolist()
    assert ids == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files_and_ranges(make_docs, shipped):
    rows = [(i, prose(i, 30 * (i % 9))) for i in range(60)] + ODD
    path = pfor_tokens.fresh_path(shipped)
    pfor_tokens.write_tokens(make_docs(rows), path, queries.vocabulary_path(), block=640)
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.vocabulary_path())
    stream, want = [], []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((i, len(stream), len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        stream += ids
    got = sorted(map(tuple, pfor_tokens.token_index(shipped, path).collect()), key=lambda r: r[1])
    assert got == want
    for start, n in ((0, 5), (600, 1500), (len(stream) - 3, 50)):
        assert pfor_tokens.read_range(shipped, path, start, n).tolist() == stream[start:start + n]
    assert pfor_tokens.report(make_docs([]), queries.vocabulary_path()).count() == 0


def test_near_dedup_hands_texts_over_in_small_batches(make_docs, monkeypatch):
    """Every job that gives whole texts to Python sets its batch size, and its
    tasks drop what the tasks of other operators left in their worker."""
    import pyarrow as pa

    from marketfold.llm import common
    written, cut = {}, bbit_minhash.cut_lineage
    monkeypatch.setattr(bbit_minhash, "cut_lineage", lambda df, name="stage", settings=None: (written.update({name: settings}), cut(df, name, settings))[1])
    rows = [(i, prose(i // 2, 60) + (" end" if i % 2 else "")) for i in range(20)]
    assert bbit_minhash.keep_one(make_docs(rows)).count() == 10
    assert all(written[name] == common.SMALL_BATCHES for name in ("minhash-signed", "minhash-texts", "minhash-kept"))
    left = common.worker_memory("token encoders")
    left["file"] = "a large table of words"
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1], pa.int64()), "text": ["a b c d e f"]})
    assert next(bbit_minhash._sign(5)(iter([batch]))).num_rows == 1
    assert not left and "token encoders" not in common._kept
