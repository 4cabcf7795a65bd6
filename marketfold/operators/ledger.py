"""Idempotency ledger: first-write-wins claims, scoped by stage.

Claims are ``(stage, id, delivery, produced_at, payload)``.  A stage key
is processed once: the first claim wins, later deliveries of the same key
only count as duplicates.  A hash aggregate per (stage, id) -- partial
aggregation collapses redeliveries map-side, so a hot key never lands
whole on one task.  ``new_only`` is an anti-join against the ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketfold.functions.exprs import strip_ws

# Ledger stages in pipeline order.
STAGES = ("persist", "transform", "export", "relay")


def first_wins(claims: DataFrame, order: str = "delivery") -> DataFrame:
    return claims.groupBy("stage", "id").agg(
        F.min_by(F.col("produced_at"), F.col(order)).alias("produced_at"),
        F.min_by(F.col("payload"), F.col(order)).alias("payload"),
        F.count(F.lit(1)).alias("deliveries"),
    ).withColumn("duplicates", F.col("deliveries") - 1)


def new_only(claims: DataFrame, ledger: DataFrame) -> DataFrame:
    """Claims whose (stage, id) is not in the ledger yet."""
    return claims.join(ledger.select("stage", "id"), ["stage", "id"], "left_anti")


# Fields of the hand-off records, in order, with their kind.
RECORDS = {
    "bronze_written": (("batch_id", "text"), ("bronze_blob_path", "text"), ("source", "text"), ("market", "text"), ("snapshot_date", "text"),
                       ("content_sha256", "text"), ("row_count", "int"), ("produced_at", "text")),
    "export_intent": (("export_id", "text"), ("silver_blob_path", "text"), ("target_relpath", "text"), ("content_sha256", "text"),
                      ("content_length", "int"), ("produced_at", "text"), ("snapshot_date", "text"), ("source", "text"), ("market", "text")),
    "relay_intent": (("export_id", "text"), ("staged_blob_path", "text"), ("target_relpath", "text"), ("content_sha256", "text"),
                     ("content_length", "int"), ("produced_at", "text")),
}


def decode_records(payload: Column, kind: Column, records: dict[str, str]) -> list[Column]:
    """Fields of records of several kinds in one table: ``records`` names the
    record of each value of ``kind``; a field that a record lacks is null."""
    columns: dict[str, Column] = {}
    for value, record in records.items():
        for name, field in zip([n for n, _ in RECORDS[record]], decode_record(payload, record)):
            own = F.when(kind == value, field)
            columns[name] = F.coalesce(columns[name], own) if name in columns else own
    return [c.alias(name) for name, c in columns.items()]


def decode_record(payload: Column, record: str) -> list[Column]:
    """Fields of a record's JSON payload: missing text is empty, text is
    trimmed, a missing count is 0 (a count that is no number fails)."""
    out = []
    for name, kind in RECORDS[record]:
        raw = F.get_json_object(payload, f"$.{name}")
        text = strip_ws(F.coalesce(raw, F.lit("")))
        out.append((F.when(text == "", F.lit(0)).otherwise(text.cast("bigint")) if kind == "int" else text).alias(name))
    return out
