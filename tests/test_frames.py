"""Landed frame files: order and numbering do not depend on how files are split."""

import os

from marketfold.session import conf_scope
from marketfold.sources.frames import frames_from_text


def test_numbering_is_the_same_however_files_are_split(spark, tmp_path):
    for k, at in (("b", 1_700_000_000), ("a", 1_700_000_050), ("c", 1_700_000_050)):
        path = tmp_path / f"{k}.txt"
        path.write_text("".join(f'{{"file":"{k}","line":{i}}}\n' for i in range(300)))
        os.utime(path, (at, at))
    want = [f'{{"file":"{k}","line":{i}}}' for k in "bac" for i in range(300)]
    seen = []
    for size in ("128m", "700b"):
        with conf_scope(spark, {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1"}):
            rows = frames_from_text(spark.read.text(str(tmp_path)), "v").orderBy("seq").collect()
        assert [r["value"] for r in rows] == want and [r["seq"] for r in rows] == list(range(1, 901))
        assert rows[0]["recv_us"] == 1_700_000_000_000_000
        seen.append(rows)
    assert seen[0] == seen[1]


def test_listing_of_real_files_finds_pending_ones(spark, tmp_path):
    from marketfold.operators import inventory
    day = tmp_path / "2025-02-03"
    day.mkdir()
    for name, size in (("pm-btc__start_20250203T000000Z__part_0007.ndjson.zst", 30), ("pm-eth.ndjson.zst", 5), ("notes.txt", 9)):
        (day / name).write_bytes(b"x" * size)
    got = inventory.pending_files(inventory.list_files(spark, str(tmp_path))).collect()
    assert {(r["date_str"], r["market_key"], r["size_bytes"]) for r in got} == {("2025-02-03", "pm-btc", 30), ("2025-02-03", "pm-eth", 5)}
