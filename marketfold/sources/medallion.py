"""Bronze -> Silver -> export -> relay on files, exactly once per batch.

Layout under one root that every executor can reach (any Hadoop path); each
call of a stage is one commit with folders of its own:

* ``raw/commit=/date=/source=/market=/``     Bronze: one JSON row per line, with
  its ``batch_id`` and row number; batches share files;
* ``silver/commit=/date=/source=/market=/hour=/``  typed Parquet;
* ``quarantine/commit=/``                    batches that Silver refused, and why;
* ``payloads/commit=/date=/source=/market=/hour=/``, ``manifests/commit=/``  the export;
* ``ledger/commit=/``                        claims with their records;
* ``log/<n>.json``                           the commits, in order.

A stage writes its folders and then its log entry, in one step that fails if
another writer took the number.  So a batch's data and its claim appear
together or not at all: what a crash leaves behind is in no entry and nobody
reads it, and of two writers of the same batches the second takes out what the
first has claimed and writes again.

Nothing depends on the length of the history: ``persist`` compares batches with
the claims of their own dates, the other stages take the commits of the stage
before that no commit of theirs covers.  A batch id belongs to one date.
Tasks use Spark's readers and writers only.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketfold.operators import silver as S
from marketfold.session import NO_WHOLE_STAGE, cut_lineage
from marketfold.sources.files import CommitLog, FileSystem

LEDGER_SCHEMA = "stage string, id string, date string, source string, market string, produced_at string, payload string, commit string"
BRONZE_SCHEMA = "value string, commit string, date string, source string, market string"
QUARANTINE_SCHEMA = "batch_id string, snapshot_date string, source string, market string, row_count long, error string, commit string"
MANIFEST_SCHEMA = ("export_id string, silver_blob_path string, staged_blob_path string, target_relpath string, content_sha256 string, content_length long, "
                   "row_count long, snapshot_date string, source string, market string, hour string, produced_at string, commit string")
METRIC_SCHEMA = "seq long, name string, labels map<string,string>, op string, value double"
LOG_SCHEMA = "n long, stage string, commit string, dates array<string>, covers array<string>, tables array<string>, observed map<string,long>"
STAGES = ("persist", "transform", "export", "relay")
PLACES = ("date", "source", "market", "hour")


class Persisted(NamedTuple):
    written: int
    duplicates: int
    records: DataFrame  # of every batch asked for, as first recorded


def _now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


class Medallion:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = FileSystem(spark)
        self.log = CommitLog(self.files, f"{self.root}/log")

    # -- commits --------------------------------------------------------------

    def _read(self, table: str, schema, fmt: str = "parquet", entries: list[dict] | None = None) -> DataFrame:
        """A table's committed rows (of some commits) and their ``file``."""
        entries = self.log.entries() if entries is None else entries
        paths = [f"{self.root}/{table}/commit={e['commit']}" for e in entries if table in e["tables"]]
        if not paths:
            return self.spark.createDataFrame([], schema).withColumn("file", F.lit(None).cast("string"))
        stored = F.regexp_extract(F.col("_metadata.file_path"), f"({table}/commit=.*)$", 1)
        return self.spark.read.schema(schema).format(fmt).option("basePath", f"{self.root}/{table}").load(paths).select("*", stored.alias("file"))

    def _write(self, rows: DataFrame, table: str, commit: str, places: tuple[str, ...] = (), fmt: str = "parquet", order: tuple[str, ...] = (), **options) -> None:
        if places:
            rows = rows.repartition(*places).sortWithinPartitions(*places, *order)
        writer = rows.write.mode("overwrite").options(**options).format(fmt)
        (writer.partitionBy(*places) if places else writer).save(f"{self.root}/{table}/commit={commit}")

    def _claims(self, stage: str, records: DataFrame, commit: str) -> None:
        """The ledger rows of a commit; payload: the record."""
        fields = [c for c in records.columns if c != "id"]
        claims = records.withColumn("produced_at", _now())
        self._write(claims.select(F.lit(stage).alias("stage"), "id", F.col("snapshot_date").alias("date"), "source", "market", "produced_at",
                                  F.to_json(F.struct(*fields, "produced_at")).alias("payload")), "ledger", commit)

    def _discard(self, tables: list[str], commit: str) -> None:
        for t in tables:
            self.files.delete(f"{self.root}/{t}/commit={commit}")

    def _pending(self, stage: str) -> tuple[int, list[dict]]:
        """The log's length, and the commits of the stage before that no commit of ``stage`` covers."""
        entries = self.log.entries()
        covered = {c for e in entries if e["stage"] == stage for c in e["covers"]}
        before = STAGES[STAGES.index(stage) - 1]
        return len(entries), [e for e in entries if e["stage"] == before and e["tables"] and e["commit"] not in covered]

    def _commit(self, stage: str, since: int, commit: str, tables: list[str], covers: list[dict], **more) -> bool:
        mine = [e["commit"] for e in covers]
        dates = sorted({d for e in covers for d in e["dates"]})
        entry = {"stage": stage, "commit": commit, "dates": dates, "covers": mine, "tables": tables, **more}
        if self.log.append(entry, since, lambda e: e["stage"] == stage and bool(set(e["covers"]) & set(mine))):
            return True
        self._discard(tables, commit)
        return False

    def vacuum(self, older_than_s: float = 86_400.0) -> int:
        """Delete folders that crashed writers left behind long ago."""
        known, gone = {e["commit"] for e in self.log.entries()}, 0
        for table in ("raw", "silver", "quarantine", "payloads", "manifests", "ledger"):
            for name in self.files.list(f"{self.root}/{table}"):
                if name.split("=")[-1] not in known and self.files.age_seconds(f"{self.root}/{table}/{name}") >= older_than_s:
                    self.files.delete(f"{self.root}/{table}/{name}")
                    gone += 1
        return gone

    # -- ledger ---------------------------------------------------------------

    def ledger(self, entries: list[dict] | None = None) -> DataFrame:
        return self._read("ledger", LEDGER_SCHEMA, entries=entries).drop("commit", "file")

    def claimed(self, stage: str) -> DataFrame:
        return self.ledger([e for e in self.log.entries() if e["stage"] == stage]).select(F.col("id").alias("batch_id"))

    def metric_samples(self) -> DataFrame:
        """What the commits counted, as samples of the metric registry: rows and
        bytes were observed while they were written, batches are the claims."""
        names = {"persist": "persist_batches_total", "transform": "transform_batches_total", "export": "export_dispatch_total", "relay": "relay_upload_total"}
        samples = []
        for e in self.log.entries():
            for k, v in sorted(e.get("observed", {}).items()):
                name = names[e["stage"]] if k == "batches" else "persist_duplicate_batch_total" if k == "duplicates" else f"{e['stage']}_{k}_total"
                samples.append((len(samples), name, {"worker": e["stage"]}, "inc", float(v)))
        return self.spark.createDataFrame(samples, METRIC_SCHEMA)

    # -- Bronze -----------------------------------------------------------------

    def bronze(self, entries: list[dict] | None = None) -> DataFrame:
        """Stored lines with their file, batch and row number.  A line that is
        no JSON row fails the read, with its file's name."""
        head = F.from_json("value", "batch_id string, rn long")
        unreadable = F.raise_error(F.concat(F.lit("bronze_line_unreadable:"), F.coalesce("file", F.lit("")))).cast("string")
        return self._read("raw", BRONZE_SCHEMA, "text", entries).select(
            "*", F.coalesce(head.getField("batch_id"), unreadable).alias("batch_id"), head.getField("rn").alias("rn")).drop("commit")

    def persist(self, rows: DataFrame, compression: str = "gzip") -> Persisted:
        """Batches (operators.batches columns) -> Bronze lines.  A batch that
        was persisted before, or is in ``rows`` twice, is written once; its
        record is the first one."""
        tail = F.regexp_replace("row_json", "^\\s*\\{\\s*", "")
        value = F.concat(F.lit('{"batch_id":"'), F.col("batch_id"), F.lit('","rn":'), F.col("rn").cast("string"), F.when(tail == "}", F.lit("")).otherwise(F.lit(",")), tail)
        todo = cut_lineage(rows.select("batch_id", "rn", F.col("snapshot_date").alias("date"), F.col("venue").alias("source"),
                                       F.col("market_key").alias("market"), value.alias("value")).dropDuplicates(["batch_id", "rn"]), "bronze-todo")
        asked = cut_lineage(todo.select("batch_id", "date").distinct(), "bronze-asked")
        n_asked, dates = asked.count(), sorted(r[0] for r in asked.select("date").distinct().collect())

        def near(entry: dict) -> bool:
            return entry["stage"] == "persist" and bool(set(entry["dates"]) & set(dates))
        while True:
            entries = self.log.entries()
            written = self._persist_new(todo, asked, [e for e in entries if near(e)], compression)
            if written is None:  # only the count of duplicates is left to record
                n_written = 0
                self.log.append({"stage": "persist", "commit": uuid.uuid4().hex, "dates": [], "covers": [], "tables": [], "observed": {"duplicates": n_asked}},
                                len(entries), lambda e: False)
                break
            commit, observed = written
            n_written = observed["batches"]
            entry = {"stage": "persist", "commit": commit, "dates": dates, "covers": [], "tables": ["raw", "ledger"],
                     "observed": {**observed, "duplicates": n_asked - n_written}}
            if self.log.append(entry, len(entries), near):
                break
            self._discard(["raw", "ledger"], commit)
        held = self.ledger([e for e in self.log.entries() if near(e)])
        return Persisted(n_written, n_asked - n_written, held.join(asked.select(F.col("batch_id").alias("id")), "id", "left_semi"))

    def _persist_new(self, todo: DataFrame, asked: DataFrame, held: list[dict], compression: str) -> tuple[str, dict] | None:
        """Write the batches that no commit of ``held`` has claimed."""
        if held:
            ids = self.ledger(held).select(F.col("id").alias("batch_id"))
            asked = asked.join(ids, "batch_id", "left_anti")
            todo = todo.join(asked.select("batch_id"), "batch_id", "left_semi")
        n = asked.count()
        if not n:
            return None
        commit, seen = uuid.uuid4().hex, Observation()
        todo = todo.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("value") + 1).alias("bytes"))
        out = todo.repartition(*PLACES[:3]).sortWithinPartitions(*PLACES[:3], "batch_id", "rn").select("value", *PLACES[:3])
        out.write.partitionBy(*PLACES[:3]).option("compression", compression).text(f"{self.root}/raw/commit={commit}")
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "value"))), lambda x: x["value"]), "\n")
        stored = self.bronze([{"commit": commit, "tables": ["raw"]}]).groupBy("batch_id", F.col("date").alias("snapshot_date"), "source", "market").agg(
            F.count(F.lit(1)).alias("row_count"), F.min("file").alias("bronze_blob_path"), F.sha2(F.concat(text, F.lit("\n")), 256).alias("content_sha256"))
        self._claims("persist", stored.withColumn("id", F.col("batch_id")), commit)
        return commit, {"batches": n, **{k: int(v) for k, v in seen.get.items()}}

    # -- Silver -------------------------------------------------------------------

    SILVER_STORED = T.StructType([f for f in S.SILVER_SCHEMA.fields if f.name not in ("source", "market")]
                                 + [T.StructField("batch_id", T.StringType()), T.StructField("rn", T.LongType())]
                                 + [T.StructField(p, T.StringType()) for p in ("commit", *PLACES)])

    def silver(self, entries: list[dict] | None = None) -> DataFrame:
        return self._read("silver", self.SILVER_STORED, entries=entries).drop("commit")

    def quarantine(self, entries: list[dict] | None = None) -> DataFrame:
        return self._read("quarantine", QUARANTINE_SCHEMA, entries=entries).drop("commit", "file")

    def transform(self) -> dict:
        """Bronze commits that are not transformed yet -> Silver rows, or
        quarantine of whole batches."""
        since, todo = self._pending("transform")
        if not todo:
            return {"transformed": 0, "quarantined": 0}
        commit, tables = uuid.uuid4().hex, ["silver", "quarantine", "ledger"]
        raw = self.bronze(todo).withColumnRenamed("date", "snapshot_date")
        rows = S.normalize(S.parse_row_text(raw, "value"), keep=("batch_id", "rn"))
        checked = cut_lineage(S.with_batch_check(rows), "silver-checked", NO_WHOLE_STAGE)
        good, refused = S.split_valid(checked)
        out = S.partition_hour(good).withColumn("date", F.col("snapshot_date")).withColumn("hour", F.lpad(F.col("hour").cast("string"), 2, "0"))
        self._write(out, "silver", commit, PLACES, order=("batch_id", "rn"), compression="zstd")
        head = ("batch_id", "snapshot_date", "source", "market")
        self._write(refused, "quarantine", commit)
        mine = [{"commit": commit, "tables": tables}]
        done = self.silver(mine).groupBy(*head).agg(F.count(F.lit(1)).alias("row_count"), F.min("file").alias("silver_blob_path"), F.lit("silver").alias("status"))
        kept_out = self.quarantine(mine).withColumn("status", F.lit("quarantined"))
        self._claims("transform", done.unionByName(kept_out, allowMissingColumns=True).withColumn("id", F.col("batch_id")), commit)
        n = {r["error"] is None: r["n"] for r in self.ledger(mine).groupBy(F.get_json_object("payload", "$.error").alias("error")).agg(F.count(F.lit(1)).alias("n")).collect()}
        counts = {"transformed": n.get(True, 0), "quarantined": n.get(False, 0)}
        if self._commit("transform", since, commit, tables, todo, observed={"batches": counts["transformed"], "quarantined": counts["quarantined"]}):
            return counts
        return {"transformed": 0, "quarantined": 0}

    # -- export and relay -----------------------------------------------------------

    def payloads(self, entries: list[dict] | None = None) -> DataFrame:
        return self._read("payloads", self.SILVER_STORED, entries=entries).drop("commit")

    def manifests(self, entries: list[dict] | None = None) -> DataFrame:
        return self._read("manifests", MANIFEST_SCHEMA, "json", entries).drop("commit", "file")

    def _stored_bytes(self, entries: list[dict]) -> DataFrame:
        """(staged_blob_path, actual_sha256, actual_length) of the payload files as they lie there."""
        paths = [f"{self.root}/payloads/commit={e['commit']}" for e in entries if "payloads" in e["tables"]]
        if not paths:
            return self.spark.createDataFrame([], "staged_blob_path string, actual_sha256 string, actual_length long")
        stored = F.regexp_extract("path", "(payloads/commit=.*)$", 1)
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(paths)
        return files.select(stored.alias("staged_blob_path"), F.sha2("content", 256).alias("actual_sha256"), F.col("length").alias("actual_length"))

    def export(self) -> dict:
        """Silver commits that are not exported yet -> staged payloads and a
        manifest per batch: which Silver file it comes from, which payload file
        it is in, and that file's digest and length, read from its bytes."""
        since, todo = self._pending("export")
        if not todo:
            return {"exported": 0}
        commit, tables = uuid.uuid4().hex, ["payloads", "manifests", "ledger"]
        rows = self.silver(todo)
        self._write(rows.drop("file"), "payloads", commit, PLACES, order=("batch_id", "rn"), compression="zstd")
        mine = [{"commit": commit, "tables": tables}]
        staged = self.payloads(mine).groupBy("batch_id", *PLACES).agg(F.count(F.lit(1)).alias("row_count"), F.min("file").alias("staged_blob_path"))
        origin = rows.groupBy("batch_id").agg(F.min("file").alias("silver_blob_path"))
        target = S.export_relpath(F.col("batch_id"), F.col("date"), F.col("source"), F.col("market"), F.col("hour").cast("int"))
        made = staged.join(origin, "batch_id").join(self._stored_bytes(mine), "staged_blob_path").select(
            F.col("batch_id").alias("export_id"), "silver_blob_path", "staged_blob_path", target.alias("target_relpath"), F.col("actual_sha256").alias("content_sha256"),
            F.col("actual_length").alias("content_length"), "row_count", F.col("date").alias("snapshot_date"), "source", "market", "hour", _now().alias("produced_at"))
        self._write(made, "manifests", commit, fmt="json")
        records = self.manifests(mine).drop("produced_at").withColumn("id", F.col("export_id"))
        self._claims("export", records, commit)
        n = records.count()
        return {"exported": n if self._commit("export", since, commit, tables, todo, observed={"batches": n}) else 0}

    def audit(self, entries: list[dict] | None = None) -> DataFrame:
        """Manifests against the bytes of the staged payloads: ok, mismatch or missing."""
        entries = [e for e in self.log.entries() if e["stage"] == "export"] if entries is None else entries
        return payload_status(self.manifests(entries), self._stored_bytes(entries))

    def relay(self) -> dict:
        """Exports whose payload is intact are handed on once.  A commit with a
        payload that is not stays pending; what it had intact is not handed on
        again."""
        since, todo = self._pending("relay")
        if not todo:
            return {"relayed": 0}
        dates = {d for e in todo for d in e["dates"]}
        before = [e for e in self.log.entries()[:since] if e["stage"] == "relay" and set(e["dates"]) & dates]
        checked = cut_lineage(self.audit(todo), "relay-audit")
        ready = checked.filter("status = 'ok'").join(self.ledger(before).select(F.col("id").alias("export_id")), "export_id", "left_anti")
        commit, tables = uuid.uuid4().hex, ["ledger"]
        fields = ("export_id", "staged_blob_path", "target_relpath", "content_sha256", "content_length", "snapshot_date", "source", "market")
        self._claims("relay", ready.select(*fields, F.col("export_id").alias("id")), commit)
        broken = {r[0] for r in checked.filter("status <> 'ok'").select(F.regexp_extract("staged_blob_path", "commit=([^/]*)", 1)).distinct().collect()}
        n = self.ledger([{"commit": commit, "tables": tables}]).count()
        whole = [e for e in todo if e["commit"] not in broken]
        if not n and not whole:
            self._discard(tables, commit)
            return {"relayed": 0}
        # Conflicts are looked for among all of the commits that were read.
        entry = {"stage": "relay", "commit": commit, "dates": sorted(dates), "covers": [e["commit"] for e in whole], "tables": tables, "observed": {"batches": n}}
        read = {e["commit"] for e in todo}
        if self.log.append(entry, since, lambda e: e["stage"] == "relay" and bool(set(e["dates"]) & dates or set(e["covers"]) & read)):
            return {"relayed": n}
        self._discard(tables, commit)
        return {"relayed": 0}

    # -- as streams ---------------------------------------------------------------

    def start_persist(self, batches: DataFrame, checkpoint: str, **trigger):
        """Landed batches (a file stream; ``maxFilesPerTrigger`` bounds a
        micro-batch) -> Bronze.  A redelivered batch is written once."""
        return self._start(batches, lambda rows, n: self.persist(rows), f"{checkpoint}/persist", trigger)

    def start_stage(self, stage: str, checkpoint: str, files: int = 100, **trigger):
        """A later stage as a stream over the log: it runs when commits arrive."""
        run = {"transform": self.transform, "export": self.export, "relay": self.relay}[stage]
        arrivals = self.spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files).option("pathGlobFilter", "*.json").json(f"{self.root}/log")
        return self._start(arrivals, lambda rows, n: run(), f"{checkpoint}/{stage}", trigger)

    def _start(self, rows: DataFrame, run, checkpoint: str, trigger: dict):
        return rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def payload_status(manifests: DataFrame, stored: DataFrame) -> DataFrame:
    """``manifests`` plus the stored bytes' digest and length
    (``staged_blob_path, actual_sha256, actual_length``) and ``status``."""
    status = F.when(F.col("actual_sha256").isNull(), F.lit("missing")).when(
        (F.col("content_sha256") != F.col("actual_sha256")) | (F.col("content_length") != F.col("actual_length")), F.lit("mismatch")).otherwise(F.lit("ok"))
    return manifests.join(stored, "staged_blob_path", "left").withColumn("status", status)
