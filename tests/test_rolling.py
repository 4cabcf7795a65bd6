"""Rolling parts: sizes, names, days, retries."""

import gzip
import random

from pyspark.sql import functions as F

from marketfold.sources import rolling


def lines(spark, seed=1, n=600):
    rnd = random.Random(seed)
    rows = [(f"2025-02-0{1 + i % 2}", rnd.choice(["m1", "m1", "m2"]), 1_738_368_000 + 86_400 * (i % 2) + rnd.randint(0, 86_399), i, f'{{"i":{i},"x":"{"y" * rnd.randint(0, 120)}"}}')
            for i in range(n)]
    rows.append(("2025-02-01", "m1", 1_738_368_000 + 50_000, n, "z" * 5000))  # larger than a part
    return rows, spark.createDataFrame(rows, "date_str string, market_key string, ts long, k long, row_json string")


def plain_parts(rows, limit):
    """Per (day, market) the rows of each part, in order."""
    out = {}
    for day, market, ts, k, text in sorted(rows, key=lambda r: (r[2], r[3])):
        out.setdefault((day, market), []).append((ts, k, text))
    parts = {}
    for key, items in out.items():
        at = 0
        for ts, k, text in items:
            parts.setdefault(key, {}).setdefault(at // limit, []).append((ts, k, text))
            at += len(text) + 1
    return {key: [p[c] for c in sorted(p)] for key, p in parts.items()}


def stored(root):
    """Lines of every part folder, by day and file name."""
    out = {}
    for f in root.rglob("part-*.gz"):
        name, day = f.parent.name.split("=")[1], f.parent.parent.name.split("=")[1]
        assert (day, name) not in out  # one file a part
        out[day, name] = gzip.decompress(f.read_bytes()).decode().splitlines()
    return out


def test_parts_hold_the_limit_and_one_row_and_a_retry_changes_nothing(spark, tmp_path):
    rows, df = lines(spark)
    store = rolling.RollingStore(spark, str(tmp_path / "r"))
    table = store.write(df, "first", 2000, ("ts", "k")).collect()
    want = plain_parts(rows, 2000)
    got = stored(tmp_path / "r")
    longest = max(len(r[4]) + 1 for r in rows)
    for (day, market), parts in want.items():
        mine = sorted((r for r in table if (r["date_str"], r["market_key"]) == (day, market)), key=lambda r: r["part"])
        assert [r["part"] for r in mine] == list(range(1, len(parts) + 1))
        for r, part in zip(mine, parts):
            text = [x for _, _, x in part]
            assert got[day, r["filename"]] == text and r["n_rows"] == len(text) and r["size_bytes"] == sum(len(x) + 1 for x in text) < 2000 + longest
            assert r["filename"].startswith(f"{market}__start_") and r["filename"].endswith(f"__part_{r['part']:04d}.ndjson.zst")
    assert sum(map(len, got.values())) == len(rows)
    again = store.write(df, "first", 2000, ("ts", "k")).collect()
    assert stored(tmp_path / "r") == got and sorted(map(str, again)) == sorted(map(str, table))


def test_numbers_go_on_after_what_is_there(spark, tmp_path):
    _, df = lines(spark)
    store = rolling.RollingStore(spark, str(tmp_path / "r"))
    before = store.write(df, "a", 3000, ("ts", "k")).groupBy("date_str", "market_key").agg(F.max("part").alias("n")).collect()
    _, more = lines(spark, 2, 100)
    later = store.write(more, "b", 3000, ("ts", "k")).groupBy("date_str", "market_key").agg(F.min("part").alias("n")).collect()
    last = {(r["date_str"], r["market_key"]): r["n"] for r in before}
    assert all(r["n"] == last[r["date_str"], r["market_key"]] + 1 for r in later)
