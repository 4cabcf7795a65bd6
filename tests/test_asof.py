"""As-of joins against plain versions, and bindings that change hands."""

import random

from pyspark.sql import functions as F

from marketfold.operators import reference_data as refdata
from marketfold.operators.asof import asof_join, next_time
from marketfold.operators.prediction_parser import bound_as_of
from marketfold.plans import catalog
from marketfold.plans.oracle import oracles
from tests.conftest import SF001
from tests.oracle_compare import compare


def test_asof_join_equals_a_search_per_row(spark):
    rnd = random.Random(1)
    right = {(rnd.choice("abc"), rnd.randint(0, 500)): n for n in range(120)}
    left = [(n, rnd.choice(["a", "a", "a", "b", "c", "d", None]), rnd.choice([None, *range(0, 520)])) for n in range(600)]
    got = asof_join(spark.createDataFrame(left, "n int, key string, at long"), spark.createDataFrame([(k, t, v) for (k, t), v in right.items()], "key string, at long, v int"),
                    "key", "at", "v", block=50).collect()
    assert len(got) == len(left)
    for r in got:
        known = [(t, v) for (k, t), v in right.items() if k == r["key"] and r["at"] is not None and t <= r["at"]]
        assert r["v"] == (max(known)[1] if known else None), r


def test_next_time_crosses_blocks_and_gaps(spark):
    got = {r["at"]: r["next_at"] for r in next_time(spark.createDataFrame([(t,) for t in (5, 5, 7, 99, 100, 901)], "at long"), "at", block=10).collect()}
    assert got == {5: 7, 7: 99, 99: 100, 100: 901, 901: None}


def effective(spark, rows):
    """(refresh, market, yes, no) rows; refreshes 300 and 900 s apart."""
    return spark.createDataFrame([(t, m, t, f"{m}-{t}", "0x", y, n) for t, m, y, n in rows],
                                 "refresh_ts long, market_key string, meta_bucket long, meta_slug string, condition_id string, yes_asset_id string, no_asset_id string")


def test_a_rebound_asset_resolves_to_the_market_in_force(spark):
    eff = effective(spark, [(300, "m1", "A", "B"), (300, "m2", "C", "D"), (600, "m1", "E", "B"), (600, "m2", "A", "D"),
                            (1500, "m1", "E", "F"), (1500, "m2", "E", "G")])
    events = spark.createDataFrame([(k, a, t) for k, (a, t) in enumerate([("A", 299), ("A", 300), ("A", 599), ("A", 600), ("A", 1499), ("A", 1500), ("A", 99_999),
                                                                            ("E", 700), ("E", 1500), ("Z", 700), ("B", 1000), ("B", 1501)])], "k int, asset_id string, recv_s long")
    got = {r["k"]: (r["market_key"], r["side"], r["since"]) for r in bound_as_of(events, refdata.binding_changes(eff)).collect()}
    assert got == {1: ("m1", "yes", 300), 2: ("m1", "yes", 300), 3: ("m2", "yes", 600), 4: ("m2", "yes", 600), 7: ("m1", "yes", 600), 8: ("m2", "yes", 1500),
                   10: ("m1", "no", 600)}


def test_a_missing_refresh_is_no_change(spark):
    eff = effective(spark, [(300, "m1", "A", "B"), (1500, "m1", "A", "C")])
    got = {tuple(r) for r in refdata.subscription_delta(eff).collect()}
    assert got == {(300, "A", "subscribe"), (300, "B", "subscribe"), (1500, "B", "unsubscribe"), (1500, "C", "subscribe")}


def test_asof_oracle_has_tokens_that_change_hands(spark, con001):
    df = catalog.q_binding_asof(spark, SF001)
    ok, what = compare(df, con001, oracles()["binding_asof"])
    assert ok, what
    assert df.groupBy("asset_id").agg(F.countDistinct("market_key").alias("n")).agg(F.max("n")).first()[0] == 2
