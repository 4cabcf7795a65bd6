"""Silver normalisation: how JSON numbers, booleans, text and blanks become typed columns."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marketfold.operators import silver as S


def silver_rows(spark, rows, batch="b1"):
    text = [(batch, i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(rows)]
    df = spark.createDataFrame(text, "batch_id string, rn long, row_json string")
    df = df.withColumn("snapshot_date", F.lit("2025-02-03")).withColumn("source", F.lit("src")).withColumn("market", F.lit("mkt"))
    return S.normalize(S.parse_row_text(df), keep=("batch_id", "rn"))


def row(**values):
    return {"ts_utc": "2025-02-03T04:05:06Z", **values}


TIMES = [("2025-02-03T04:05:06Z", dt.datetime(2025, 2, 3, 4, 5, 6)), ("2025-02-03 04:05", dt.datetime(2025, 2, 3, 4, 5)),
         ("2025-02-03", dt.datetime(2025, 2, 3)), ("20250203T040506Z", dt.datetime(2025, 2, 3, 4, 5, 6)),
         ("2025-02-03T04:05:06.25+01:30", dt.datetime(2025, 2, 3, 2, 35, 6, 250000)), (1738555506, dt.datetime(2025, 2, 3, 4, 5, 6)),
         (1738555506.5, dt.datetime(2025, 2, 3, 4, 5, 6, 500000)), ("1738555506", None), ("soon", None), ("  ", None), (None, None)]


@pytest.mark.parametrize("value, want", TIMES)
def test_times(spark, value, want):
    assert silver_rows(spark, [row(last_event_ts_utc=value)]).first()["last_event_ts_utc"] == want


def test_numbers_text_and_booleans_are_told_apart(spark):
    ints = [(1.0, 1), (2.9, 2), (-2.9, -2), ("1.0", 0), ("1_000", 1000), (" 7 ", 7), ("", 0), (None, 0), (True, 1), ("x", 0), (12345678901, 12345678901)]
    floats = [(4, 4.0), ("4.25", 4.25), (" 1_0.5 ", 10.5), (True, 1.0), ("abc", None), ("  ", None), (None, None), ("1e3", 1000.0), ("5d", None)]
    texts = [(" Sell ", "Sell"), (" \t", None), (12, "12"), (True, "True"), (None, None)]
    got = silver_rows(spark, [row(msg_count_1s=v) for v, _ in ints]).orderBy("rn").collect()
    assert [r["msg_count_1s"] for r in got] == [w for _, w in ints]
    got = silver_rows(spark, [row(mid=v) for v, _ in floats]).orderBy("rn").collect()
    assert [r["mid"] for r in got] == [w for _, w in floats]
    got = silver_rows(spark, [row(last_trade_side=v) for v, _ in texts]).orderBy("rn").collect()
    assert [r["last_trade_side"] for r in got] == [w for _, w in texts]


def test_schema_and_epoch_column(spark):
    out = silver_rows(spark, [row(bucket_start_ts="1738555500"), row(bucket_start_ts=1738555500.0), row(bucket_start_ts="x"), row()])
    assert out.columns[2:] == [f.name for f in S.SILVER_SCHEMA.fields]
    at = dt.datetime(2025, 2, 3, 4, 5)
    assert [r["bucket_start_ts_utc"] for r in out.orderBy("rn").collect()] == [at, at, None, None]
    assert out.first()["snapshot_hour"] == 4 and out.first()["source"] == "src"


def test_batch_goes_to_quarantine_as_a_whole(spark):
    both = silver_rows(spark, [row(), {"mid": 1}], "bad").unionByName(silver_rows(spark, [row()], "good"))
    ok, rejected = S.split_valid(both)
    assert [r["batch_id"] for r in ok.collect()] == ["good"]
    assert [(r["batch_id"], r["row_count"], r["error"]) for r in rejected.collect()] == [("bad", 2, "silver_row_missing_ts_utc")]
    assert S.split_valid(silver_rows(spark, ["not json"]))[1].count() == 1


def test_placement_follows_the_first_row_not_the_earliest(spark):
    rows = [row(ts_utc="2025-02-03T13:00:00Z"), row(ts_utc="2025-02-03T12:00:00Z")]
    placed = S.partition_hour(silver_rows(spark, rows)).collect()
    assert {r["hour"] for r in placed} == {13} and {r["snapshot_hour"] for r in placed} == {12, 13}
