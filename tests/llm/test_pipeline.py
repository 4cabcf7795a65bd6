"""The pipeline, stage by stage on what its predecessor kept, against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from marketfold.llm import quality_votes, queries
from tests.llm.conftest import DOCS, ODD, prose
from tests.llm.test_operators import family, plain_base, plain_components, plain_hits, plain_targets


def plain_features(text):
    text = text or ""
    n, chars, symbols, dup, repeat = plain_base(text)
    space = r"[\x20\x09-\x0D]"
    return {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat,
            "n_lines": sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n")),
            "n_upper": len(re.findall("[A-Z]", text)), "n_digits": len(re.findall("[0-9]", text)),
            "n_ends": len(re.findall(rf"[.!?](?:{space}|$)", text)), "n_shouts": text.count("!!"),
            "n_plain": sum(bool(re.fullmatch(r"[^\W\d_][^\W\d_'’-]*(?:['’-]+[^\W\d_'’-]*)*[.,;:!?]?", w)) for w in re.findall(r"[^\x20\x09-\x0D]+", text))}


def plain_votes(text):
    f = plain_features(text)

    def holds(condition):
        c = re.sub(r"(\w+) BETWEEN (.+?) AND (.+)$", r"(\2) <= \1 <= (\3)", condition)
        c = re.sub(r"(?<![<>!=])=(?!=)", "==", c.replace(" AND ", " and ").replace(" OR ", " or "))
        return eval(c, {}, f)
    return tuple(-1 if holds(r.bad) else 1 if holds(r.good) else 0 for r in quality_votes.RULES)


def plain_verdicts(texts):
    """EM over the votes, document by document."""
    votes = np.array([plain_votes(t) for t in texts])
    prior = quality_votes.PRIOR_GOOD
    good = np.tile(quality_votes.PRIOR_ON_GOOD, (votes.shape[1], 1))
    bad = np.tile(quality_votes.PRIOR_ON_BAD, (votes.shape[1], 1))
    rule = np.arange(votes.shape[1])

    def posterior():
        odds = math.log(prior / (1 - prior)) + np.log(good[rule, votes + 1] / bad[rule, votes + 1]).sum(axis=1)
        return 1 / (1 + np.exp(-odds))
    extra = 1.0 + 0.02 * len(texts)
    for _ in range(12):
        p = posterior()
        g = np.array([[(p * (votes[:, j] == k - 1)).sum() for k in range(3)] for j in rule])
        b = np.array([[((1 - p) * (votes[:, j] == k - 1)).sum() for k in range(3)] for j in rule])
        prior = (p.sum() + quality_votes.PRIOR_GOOD * extra) / (len(texts) + extra)
        new_good = (g + np.array(quality_votes.PRIOR_ON_GOOD) * extra) / (p.sum() + extra)
        new_bad = (b + np.array(quality_votes.PRIOR_ON_BAD) * extra) / ((1 - p).sum() + extra)
        moved = max(np.abs(new_good - good).max(), np.abs(new_bad - bad).max())
        good, bad = new_good, new_bad
        if moved < 1e-4:
            break
    base = [plain_base(t) for t in texts]
    return [q >= 0.5 and x[0] >= 50 and 100 * x[4] <= 50 * x[0] for q, x in zip(posterior(), base)]


def without_passages(text, items, window=13):
    """``text`` without the words of windows that occur in an item."""
    at = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    words = [text[a:b].lower() for a, b in at]
    known = {tuple(w[i:i + window]) for _, item in items for w in [item.lower().split()] for i in range(len(w) - window + 1)}
    hit = {j for i in range(len(words) - window + 1) if tuple(words[i:i + window]) in known for j in range(i, i + window)}
    for first in sorted((j for j in hit if j - 1 not in hit), reverse=True):
        last = next(j for j in range(first, len(words) + 1) if j + 1 not in hit)
        text = text[:at[first][0]] + text[at[last][1]:]
    return text


def sentences(seed, n):
    return ". ".join(prose(1000 * seed + j, 11).capitalize() for j in range(n)) + "."


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(5)
    items = [(i, prose(9000 + i, 18)) for i in range(10)]
    rows = [(i, sentences(i, rnd.randint(6, 20))) for i in range(120)]
    rows += [(200 + i, " ".join(w + "%%%" for w in sentences(i, 9).split())) for i in range(9)]
    rows += [(300 + i, t + ".") for s in range(3) for i, t in enumerate(family(s, sentences(400 + s, 14), 6, 0.03), 20 * s)]
    rows += [(400 + i, sentences(i, 12)) for i in range(5)]
    rows += [(500 + i, f"{sentences(600 + i, 8)} {items[i][1]} {sentences(700 + i, 4)}") for i in range(8)]
    rows += [(600, f"{sentences(800, 90)} {items[3][1]} {sentences(801, 90)}"), *ODD]
    return [(i, t, "en", rnd.choice(["a", "b", "c", None]), len(t or "")) for i, t in rows], items


def test_stages_match_plain_versions(shipped, corpus, tmp_path):
    rows, items = corpus
    spark, root = shipped, str(tmp_path)
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    named = [(str(i), t) for i, t in items]
    docs, outs = spark.read.parquet(f"{root}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, root)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == [c.split()[0] for c in DOCS.split(", ")], name
        out.write.parquet(f"{root}/out{k}")
        docs = spark.read.parquet(f"{root}/out{k}")
        outs.append([tuple(r) for r in docs.collect()])
    key = str
    good = [r for r, kept in zip(rows, plain_verdicts([r[1] for r in rows])) if kept]
    assert sorted(outs[0], key=key) == sorted(good, key=key)
    root_of = plain_components([(math.inf if r[0] is None else r[0], r[1]) for r in outs[0]], 5, 80)
    alone = [r for r in outs[0] if root_of[math.inf if r[0] is None else r[0]][1] == (math.inf if r[0] is None else r[0])]
    assert sorted(outs[1], key=key) == sorted(alone, key=key)
    clean = [r for r in outs[1] if not (lambda n, h, _: h > 0 and 20 * h >= n)(*plain_hits(r[1], named))]
    cut = [(r[0], without_passages(r[1], named), *r[2:4], r[4]) for r in clean]
    cut = [(*c[:4], len(c[1]) if c[1] != r[1] else r[4]) for c, r in zip(cut, clean)]
    assert sorted(outs[2], key=key) == sorted(cut, key=key) and len(clean) < len(outs[1])
    # One passage in a long document is below the limit: the document stays, the passage goes.
    long = next(r[1] for r in outs[2] if r[0] == 600)
    assert items[3][1] not in long and sentences(800, 90) in long and sentences(801, 90) in long
    assert [r for r in outs[2] if r[0] != 600] == [r for r in outs[2] if r in clean]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    have, mixed = Counter(), Counter()
    for r in outs[2]:
        have[r[3]] += size(r[1])
    for r in outs[3]:
        mixed[r[3]] += size(r[1])
    want = plain_targets(have)
    assert all(abs(mixed[s] - want[s]) <= 1 for s in have)
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.vocabulary_path())
    at, stream = 0, []
    for r in outs[3]:
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 1]
        stream.append((r[0], at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert sorted(outs[4], key=lambda r: r[1]) == stream
    whole = sorted((tuple(r) for r in corpus_pipeline.run(spark, root).collect()), key=lambda r: r[1])
    assert sorted((r[0], r[2], r[3]) for r in whole if r[0]) == sorted((r[0], r[2], r[3]) for r in stream if r[0])


def test_empty_documents(shipped, tmp_path):
    shipped.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    shipped.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(shipped, str(tmp_path)).count() == 0
