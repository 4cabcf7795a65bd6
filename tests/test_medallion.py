"""File layer: running a stage twice, at the same time as another, or again after a crash leaves the same data."""

import threading

import pytest
from pyspark.sql import functions as F

from marketfold.operators import ledger, observability
from marketfold.plans import catalog
from marketfold.session import cut_lineage
from marketfold.sources.files import CommitLog, FileSystem
from marketfold.sources.medallion import STAGES, Medallion
from tests.conftest import SF001


def contents(store):
    tables = {"bronze": store.bronze().select("batch_id", "rn", "value"), "silver": store.silver().drop("file"), "payloads": store.payloads().drop("file"),
              "manifests": store.manifests().select("export_id", "target_relpath", "row_count"), "quarantine": store.quarantine(),
              "claims": store.ledger().select("stage", "id")}
    return {k: sorted(map(str, t.collect())) for k, t in tables.items()}


def run_all(store, rows):
    return store.persist(rows)[:2], store.transform(), store.export(), store.relay()


@pytest.fixture(scope="module")
def batched(spark):
    """Three batches a market, and one a market that Silver must refuse."""
    rows = cut_lineage(catalog._batched(spark, SF001).filter("batch_no < 4"), "test-batches")
    broken = rows.filter("batch_no = 3").withColumn("row_json", F.when(F.col("rn") % 250 == 5, F.lit('{"mid": 1}')).otherwise(F.col("row_json")))
    return cut_lineage(rows.filter("batch_no < 3").unionByName(broken), "test-batches")


@pytest.fixture(scope="module")
def clean(spark, batched, tmp_path_factory):
    """One undisturbed run."""
    store = Medallion(spark, str(tmp_path_factory.mktemp("clean")))
    return store, run_all(store, batched)


def test_stages_write_once(spark, batched, clean):
    store, ((written, duplicates), t, e, r) = clean
    n = batched.select("batch_id").distinct().count()
    bad = batched.filter("batch_no = 3").select("batch_id").distinct().count()
    assert (written, duplicates) == (n, 0) and t == {"transformed": n - bad, "quarantined": bad} and e == {"exported": n - bad} and r == {"relayed": n - bad}
    first = contents(store)
    assert len(first["bronze"]) == batched.count() and len(first["manifests"]) == n - bad
    again = store.persist(batched.filter("batch_no < 2"))
    k = batched.filter("batch_no < 2").select("batch_id").distinct().count()
    assert again[:2] == (0, k)
    # A second call returns what the first one recorded.
    held = {r["id"]: (r["payload"], r["produced_at"]) for r in store.ledger().filter("stage = 'persist'").collect()}
    assert {r["id"]: (r["payload"], r["produced_at"]) for r in again.records.collect()}.items() <= held.items() and again.records.count() == k
    assert (store.transform(), store.export(), store.relay()) == ({"transformed": 0, "quarantined": 0}, {"exported": 0}, {"relayed": 0})
    assert contents(store) == first
    assert {s: store.claimed(s).count() for s in STAGES} == {"persist": n, "transform": n, "export": n - bad, "relay": n - bad}


def test_records_decode_to_the_contracts_fields(spark, clean):
    store, _ = clean
    for stage, record in (("persist", "bronze_written"), ("export", "export_intent"), ("relay", "relay_intent")):
        rows = store.ledger().filter(F.col("stage") == stage).select("id", *ledger.decode_record(F.col("payload"), record)).collect()
        for r in rows:
            assert all(v not in ("", 0, None) for v in r.asDict().values()), r
    files = {f for (f,) in store.bronze().select("file").distinct().collect()}
    assert {r[0] for r in store.ledger().filter("stage = 'persist'").select(F.get_json_object("payload", "$.bronze_blob_path")).distinct().collect()} == files


def test_a_crash_before_the_log_entry_leaves_nothing(spark, batched, clean, tmp_path, monkeypatch):
    store, n = Medallion(spark, str(tmp_path)), 0
    for call in (lambda: store.persist(batched), store.transform, store.export, store.relay):
        with monkeypatch.context() as m:
            m.setattr(CommitLog, "append", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                call()
        call()
        n += 1
        assert len(store.log.entries()) == n
    assert contents(store) == contents(clean[0])
    left = store.vacuum(older_than_s=0)
    assert left >= 4 and store.vacuum(older_than_s=0) == 0 and contents(store) == contents(clean[0])


def test_concurrent_calls_leave_one_copy_and_one_claim(spark, batched, clean, tmp_path):
    for stage in STAGES:
        stores = [Medallion(spark, str(tmp_path)) for _ in range(3)]
        results, barrier = [], threading.Barrier(3)

        def call(store):
            barrier.wait()
            results.append(sum(store.persist(batched)[:1]) if stage == "persist" else sum(getattr(store, stage)().values()))
        threads = [threading.Thread(target=call, args=(s,)) for s in stores]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert sorted(results)[:2] == [0, 0] and results.count(0) == 2, (stage, results)
    assert contents(stores[0]) == contents(clean[0])


def test_overlapping_writers_share_the_batches(spark, batched, clean, tmp_path):
    """The second writer of some of the batches takes out what the first has claimed."""
    one, two = Medallion(spark, str(tmp_path)), Medallion(spark, str(tmp_path))
    real, done = CommitLog.append, []

    def late(self, *args):
        if not done:
            done.append(one.persist(batched.filter("batch_no < 2")))
        return real(self, *args)
    two.log.append = late.__get__(two.log)
    result = two.persist(batched.filter("batch_no >= 1"))
    both = batched.filter("batch_no = 1").select("batch_id").distinct().count()
    assert result.duplicates == both and done[0].written + result.written == batched.select("batch_id").distinct().count()
    assert contents(two)["bronze"] == contents(clean[0])["bronze"]


def test_log_numbers_are_taken_once(spark, tmp_path):
    files, won = FileSystem(spark), []

    def take(k):
        if files.create(f"{tmp_path}/x.json", f"{k}".encode() * 1000):
            won.append(k)
    threads = [threading.Thread(target=take, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and files.read(f"{tmp_path}/x.json") == f"{won[0]}" * 1000 and files.list(str(tmp_path)) == ["x.json"]


def test_a_later_day_reads_no_file_of_an_earlier_one(spark, batched, tmp_path):
    days = [r[0] for r in batched.select("snapshot_date").distinct().orderBy("snapshot_date").collect()]
    assert len(days) >= 2
    store = Medallion(spark, str(tmp_path))
    run_all(store, batched.filter(F.col("snapshot_date") == days[0]))
    for table in ("raw", "silver", "quarantine", "payloads", "manifests", "ledger"):  # no longer readable
        for f in (tmp_path / table).rglob("*.*"):
            if f.is_file() and not f.name.startswith((".", "_")):
                f.write_bytes(b"broken")
        for f in (tmp_path / table).rglob(".*.crc"):
            f.unlink()
    later = batched.filter(F.col("snapshot_date") == days[1])
    n = later.select("batch_id").distinct().count()
    p, t, e, r = run_all(store, later)
    assert p == (n, 0) and t["transformed"] + t["quarantined"] == n and e["exported"] == t["transformed"] == r["relayed"]
    assert store.persist(later)[:2] == (0, n)


def test_audit_compares_stored_bytes(spark, batched, tmp_path):
    store = Medallion(spark, str(tmp_path))
    store.persist(batched.filter("batch_no = 0"))
    store.transform()
    store.export()
    assert {r["status"] for r in store.audit().collect()} == {"ok"}
    for m in store.manifests().collect():
        assert m["content_length"] == (tmp_path / m["staged_blob_path"]).stat().st_size and (tmp_path / m["silver_blob_path"]).exists()
    files = sorted(p for p in (tmp_path / "payloads").rglob("*.parquet"))
    for sums in (tmp_path / "payloads").rglob(".*.crc"):
        sums.unlink()  # the local file system's own check
    flipped, gone, cut = files[:3]
    raw = bytearray(flipped.read_bytes())
    raw[len(raw) // 2] ^= 1
    flipped.write_bytes(raw)
    gone.unlink()
    cut.write_bytes(cut.read_bytes()[:-1])
    status = {tmp_path / r["staged_blob_path"]: r["status"] for r in store.audit().collect()}
    assert status[flipped] == status[cut] == "mismatch" and status[gone] == "missing"
    n = store.audit().filter("status = 'ok'").count()
    assert store.relay() == {"relayed": n} and store.relay() == {"relayed": 0}
    raw[len(raw) // 2] ^= 1
    flipped.write_bytes(raw)  # repaired: only what was held back is handed on
    assert store.relay()["relayed"] == store.audit().filter("status = 'ok'").count() - n > 0


def test_unreadable_bronze_fails_with_its_file(spark, batched, tmp_path):
    store = Medallion(spark, str(tmp_path))
    store.persist(batched.filter("batch_no = 0"), compression="none")
    victim = next(p for p in (tmp_path / "raw").rglob("*.txt"))
    victim.write_text(victim.read_text().replace('{"batch_id"', "{batch_id", 1))
    (victim.parent / f".{victim.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match=f"bronze_line_unreadable:raw/commit=.*{victim.name}"):
        store.transform()


def test_metrics_of_a_run_equal_its_ledger(spark, batched, clean, tmp_path):
    store = Medallion(spark, str(tmp_path))
    run_all(store, batched)
    store.persist(batched.filter("batch_no = 0"))
    got = {(r["name"], r["label_text"]): r["value"] for r in observability.metric_rollup(store.metric_samples()).collect()}
    counts = {s: store.claimed(s).count() for s in STAGES}
    assert got["persist_batches_total", 'worker="persist"'] == counts["persist"] and got["relay_upload_total", 'worker="relay"'] == counts["relay"]
    assert got["export_dispatch_total", 'worker="export"'] == counts["export"]
    assert got["persist_rows_total", 'worker="persist"'] == batched.count()
    assert got["persist_bytes_total", 'worker="persist"'] == store.bronze().agg(F.sum(F.octet_length("value") + 1)).first()[0]
    assert got["persist_duplicate_batch_total", 'worker="persist"'] == batched.filter("batch_no = 0").select("batch_id").distinct().count()


def test_streamed_stages_survive_redelivery_crash_and_poison(spark, batched, clean, tmp_path, monkeypatch):
    """Batches land in parts, some twice; the first persist crashes before its entry; a part is poison."""
    store, landing = Medallion(spark, str(tmp_path / "m")), str(tmp_path / "landing")
    parts = [batched.filter("batch_no < 2"), batched.filter("batch_no >= 1"), batched.filter("batch_no = 0").unionByName(batched.filter("batch_no = 0"))]
    real, calls = CommitLog.append, []

    def crash(self, *args):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return real(self, *args)
    monkeypatch.setattr(CommitLog, "append", crash)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(landing)
        source = spark.readStream.schema(batched.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        try:
            store.start_persist(source, str(tmp_path / "c")).awaitTermination()
        except Exception as error:
            assert "lost" in str(error)
            store.start_persist(source, str(tmp_path / "c")).awaitTermination()
        for stage in STAGES[1:]:
            store.start_stage(stage, str(tmp_path / "c")).awaitTermination()
    assert contents(store) == contents(clean[0])
