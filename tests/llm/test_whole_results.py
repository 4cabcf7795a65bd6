"""Whole results of queries that SQL cannot state, against brute force; rows without an id."""

import hashlib
import json
import math
import random
import zlib

import pytest
import regex

from marketfold.llm import bbit_minhash, chat_tools, gear_chunks, line_ledger, pfor_tokens, queries, url_templates
from marketfold.llm.common import ID_LAST
from marketfold.session import conf_scope
from tests.conftest import SF001
from tests.llm.conftest import ODD, prose


# ---- op1 ----------------------------------------------------------------------

def plain_chunks(text):
    h, v, reach = [], 0, gear_chunks.REACH
    for b in text:
        v = ((v << gear_chunks.STEP) + int(gear_chunks.GEAR[b])) & 0xFFFFFFFF
        h.append(v)
    if len(text) <= 2 * reach + 1:
        ends = [len(text)] if text else []
    else:
        ends = [i + 1 for i in range(reach, len(text) - reach) if h[i] < min(h[i - reach:i]) and h[i] <= min(h[i + 1:i + reach + 1])] + [len(text)]
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def plain_repeats(rows):
    """Per row (id, text): what the query reports."""
    docs = [(ID_LAST if i is None else i, (t or "").encode()) for i, t in rows]
    parts = [plain_chunks(t) for _, t in docs]
    holders = {}
    for (i, _), own in zip(docs, parts):
        for c in own:
            holders.setdefault(c, set()).add(i)
    owner = {c: min(ids) for c, ids in holders.items() if len(ids) > 1}

    def runs(own, flags):
        i = 0
        while i < len(own):
            j = i
            while j < len(own) and flags[j]:
                j += 1
            n = len(b"".join(own[i:j]).split())
            if n >= gear_chunks.MIN_WORDS:
                yield i, j, n
            i = max(j, i + 1)
    out = []
    for (me, text), own in zip(docs, parts):
        first = [owner.get(c) for c in own]
        shared = sum(n for *_, n in runs(own, [f is not None for f in first]))
        gone = list(runs(own, [f is not None and f < me for f in first]))
        keep = b"".join(c for k, c in enumerate(own) if not any(i <= k < j for i, j, _ in gone))
        out.append((None if me == ID_LAST else me, len(own), shared, sum(n for *_, n in gone), len(gone), sorted({f for i, j, _ in gone for f in first[i:j]}),
                    hashlib.sha256(keep).hexdigest()))
    return out


def repeating_rows(n, some_without_id):
    rnd = random.Random(8)
    passages = [prose(60 + k, rnd.choice([8, 14, 40])) for k in range(12)]
    rows = []
    for k in range(n):
        text = " ".join(prose(1000 + 10 * k + j, rnd.randint(0, 30)) + " " + rnd.choice([*passages, ""]) for j in range(rnd.randint(0, 4)))
        rows.append((None if some_without_id and k % 2 else rnd.choice([k, k, k // 2]), text))
    return rows


def test_repeats_equal_brute_force(make_docs):
    rows = repeating_rows(150, False) + repeating_rows(60, True) + [r for r in ODD if len(r[1] or "") < 100_000]
    got = gear_chunks.report(make_docs(rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_repeats(rows)))


def test_passages_in_scripts_without_spaces_go(make_docs):
    rnd = random.Random(3)
    han = lambda n: "".join(chr(rnd.randint(0x4E00, 0x9FA0)) for _ in range(n))
    passage, rows = han(120), [(1, None), (2, None), (3, han(150))]
    rows[0], rows[1] = (1, han(60) + passage + han(60)), (2, han(70) + passage + han(30))
    got = {r["doc_id"]: r for r in gear_chunks.report(make_docs(rows)).collect()}
    assert got[2]["n_removed_spans"] == 1 and got[2]["n_removed_words"] >= 30 and got[2]["kept_in"] == [1]
    assert got[1]["n_removed_spans"] == got[3]["n_shared_words"] == 0 < got[1]["n_shared_words"]


def test_rows_without_an_id_are_cleaned_text_by_text(make_docs):
    """Many rows without an id that all lose something: the work is per text."""
    rows = repeating_rows(80, False)
    twins = [(None, f"{t} {prose(5000 + k, 3)}") for k, (_, t) in enumerate(rows)]
    all_rows = rows + twins + twins[:20]
    assert sorted(map(str, map(tuple, gear_chunks.report(make_docs(all_rows)).collect()))) == sorted(map(str, plain_repeats(all_rows)))
    lines = [(k, f"line number {k % 30} of all\nown {k} and more words") for k in range(60)] + [(None, f"line number {k % 40} of all\nown {k} too, without id") for k in range(200)]
    got = sorted((r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in line_ledger.report(make_docs(lines)).collect() if r["doc_id"] is None)
    want = sorted((2, int(k % 40 < 30), hashlib.sha256((t.split("\n", 1)[1] if k % 40 < 30 else t).encode()).hexdigest())
                  for k, (_, t) in enumerate(lines[60:]))
    assert got == want


def test_rows_without_an_id_are_spread_over_token_ranges(shipped, make_docs):
    rows = [(None, prose(k, 20)) for k in range(300)] + [(7, prose(400, 5))]
    path = pfor_tokens.fresh_path(shipped)
    with conf_scope(shipped, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        pfor_tokens.write_tokens(make_docs(rows), path, queries.vocabulary_path())
    assert pfor_tokens.read_blocks(shipped, path).select("shard").distinct().count() > 2
    got = pfor_tokens.token_index(shipped, path).collect()
    assert len(got) == 301 and min(got, key=lambda r: r["start"])["doc_id"] == 7


# ---- op6 ----------------------------------------------------------------------

def plain_verdicts(pages, rules=url_templates.RULES):
    """Tree by dictionaries, level by level."""
    cells = {}
    for host, path, blocked in pages:
        n = cells.setdefault((host, path), [0, 0, 0])
        n[0] += 1
        n[1] += blocked is not None
        n[2] += bool(blocked)
    template, segs = {c: "" for c in cells}, {c: c[1].split("/")[1:] for c in cells}
    deepest, depth = max(map(len, segs.values()), default=0), 0

    def sums(keys):
        return [sum(cells[c][i] for c in keys) for i in range(3)]
    while depth < deepest:
        nodes = {}
        for c in cells:
            if len(segs[c]) > depth:
                nodes.setdefault((c[0], template[c]), {}).setdefault(segs[c][depth], []).append(c)
        open_ = [sums([c for b in node.values() for c in b]) for node in nodes.values()]
        if depth >= url_templates.LEVELS and not any(n[1] >= url_templates.MIN_LABELS and 0 < n[2] < n[1] for n in open_):
            break
        for node, (_, labels, bad) in zip(nodes.values(), open_):
            for seg, keys in node.items():
                n, l, b = sums(keys)
                share = bad / labels if labels else 0.0
                far = labels and abs(b - l * share) > url_templates.SIGNIFICANT * math.sqrt(max(l * share * (1 - share), 1e-12))
                literal = len(node) == 1 and n >= 2 or l >= url_templates.MIN_LABELS and far
                for c in keys:
                    template[c] += f"/{seg}" if literal else "/*"
        depth += 1
    for c in cells:
        template[c] += "/**" if len(segs[c]) > depth else ""

    def smooth(keys, wider):
        _, l, b = sums(keys)
        return (b + url_templates.SMOOTHING * wider) / (l + url_templates.SMOOTHING)
    _, labels, bad = sums(cells)
    out = {}
    for c in cells:
        domain = ".".join(c[0].split(".")[-2:])
        near = [k for k in cells if ".".join(k[0].split(".")[-2:]) == domain]
        p = smooth([k for k in cells if k[0] == c[0] and template[k] == template[c]], smooth([k for k in cells if k[0] == c[0]], smooth(near, bad / labels if labels else 0.0)))
        out[c] = (template[c], p, p >= url_templates.REJECT and sums(near)[2] > 0)
    return out


def test_verdicts_equal_brute_force(shipped):
    rnd = random.Random(2)
    hosts = ["example.org", "a.example.org", "shop.com", "x.net", "y.x.net", "z.io"]
    urls = [f"https://{rnd.choice(hosts)}/{rnd.choice(['en', 'de', 'fr', 'es', 'a'])}/{rnd.choice(['1', '2', 'x', 'y'])}{rnd.choice(['', '/p', '/q/r'])}?{k}" for k in range(500)] + [None, "", "no url"] * 3
    pages = shipped.createDataFrame([(rnd.choice([k, k, None, 5]), u, "p", 1) for k, u in enumerate(urls)], "page_id long, url string, html string, purity int")
    got = url_templates.judge(pages).collect()
    rule = {r.name: not r.allow for r in url_templates.RULES}
    want = plain_verdicts([(r["host"], r["path"], rule.get(r["rule"])) for r in got])
    assert len(got) == len(urls) and len({r["verdict"] for r in got}) == 2
    for r in got:
        template, purity, bad = want[r["host"], r["path"]]
        assert r["template"] == template and r["purity"] == pytest.approx(purity)
        assert r["verdict"] == ("block" if rule.get(r["rule"], bad) else "allow")


def test_without_evidence_nothing_is_blocked(shipped):
    urls = ["h://bad.example.org/es/1", None, "", "h://elsewhere.net/a", "h://elsewhere.net/b", "h://third.io/"]
    got = url_templates.judge(shipped.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    assert {r["page_id"] for r in got if r["verdict"] == "block"} == {0}


# ---- op8 ----------------------------------------------------------------------

def test_kept_is_by_component_also_for_repeated_ids(make_docs):
    text = prose(3, 60)
    rows = [(1, text), (1, text + " more"), (2, text), (3, prose(9, 30)), (3, prose(10, 30)), (None, text), (4, None)]
    for r in bbit_minhash.report(make_docs(rows)).collect():
        assert r["kept"] == (r["doc_id"] == r["component_id"]) or r["doc_id"] is None


# ---- op9 ----------------------------------------------------------------------

def plain_lines(rows):
    """(conv, turn, role, text) rows -> (conv, ready, kind, depth, turn, id, status, errors, line)."""
    out, calls, results = [], {}, {}
    for conv, turn, role, text in rows:
        turn, said = turn or 0, text or ""
        out.append((conv, turn, 0, 0, turn, None, "message", (), chat_tools.canonical({"role": role or "", "content": said, "turn": turn})))
        h, words = zlib.crc32(said.encode()), [w for w in regex.split(r"[^\p{L}]+", said) if w]
        if role == "user":
            name = ("search", "translate", "count", "search", "translate", "count", "browse")[h % 7]
            value = {"translate": {"target": "fr", "text": words[0] if words else ""}, "count": {"unique": h % 2 == 0, "words": words[:5]}}.get(
                name, {"query": " ".join(words[:3]), "limit": (h >> 5) % 60})
            text = json.dumps(value, separators=(",", ":"), ensure_ascii=False) + ("}" if (h >> 9) % 23 == 0 else "")
            after = f"call-{turn - 2}" if h % 2 == 0 and turn >= 2 else None
            calls.setdefault((conv, f"call-{turn}"), []).append((turn, name, text, after))
        if role == "assistant" and h % 11:
            results.setdefault((conv, f"call-{turn - 1}"), []).append((turn, said))

    def place(key):
        turn, _, _, after = min(calls[key], key=lambda c: (*c[:3], c[3] is not None, c[3] or ""))
        ahead = (key[0], after)
        if after is None or ahead not in calls:
            return 0, turn, after is not None
        depth, ready, _ = place(ahead)
        return depth + 1, max(turn, ready, min(results[ahead])[0] if ahead in results else turn), False
    for key in calls.keys() | results.keys():
        answer = min(results[key]) if key in results else None
        if key not in calls:
            line = {"id": key[1], "status": "orphan", "result": answer[1], "result_turn": answer[0]}
            out.append((key[0], answer[0], 1, 0, answer[0], key[1], "orphan", (), chat_tools.canonical(line)))
            continue
        turn, name, text, after = min(calls[key], key=lambda c: (*c[:3], c[3] is not None, c[3] or ""))
        value, errors = chat_tools.check_arguments(name, text, chat_tools.TOOLS)
        depth, ready, missing = place(key)
        status = "invalid" if errors else "pending" if answer is None else "ok"
        line = {"id": key[1], "status": status, "tool": name, "arguments": value, "turn": turn}
        line |= {"result": answer[1], "result_turn": answer[0]} if answer else {}
        line |= ({"after": after} if after else {}) | ({"errors": errors} if errors else {}) | ({"order": "missing_after"} if missing else {})
        out.append((key[0], ready, 1, depth, turn, key[1], status, tuple(errors), chat_tools.canonical(line)))
    return out


def same_lines(got, rows):
    got = [(*(r[c] for c in ("conv_id", "ready", "kind", "depth", "turn", "call_id", "status")), tuple(r["errors"]), r["line"]) for r in got]
    assert sorted(got, key=repr) == sorted(plain_lines(rows), key=repr)


def test_chat_lines_equal_brute_force(shipped):
    table = shipped.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in table.collect()]
    same_lines(queries.op9_chat_tools(shipped, SF001).collect(), rows)
    rnd = random.Random(4)
    odd = [(rnd.choice([None, 1, 2]), rnd.choice([None, 0, 1, 2, 3, 4, 5]), rnd.choice(["user", "assistant", "assistant", "system", None]),
            rnd.choice([None, "", prose(rnd.randint(0, 60), rnd.randint(1, 9)), 'quote " and \\ and é'])) for _ in range(60)]
    df = shipped.createDataFrame(odd + odd[:10], "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS call_id", "1 AS depth")
    same_lines(chat_tools.report(df).collect(), odd + odd[:10])
