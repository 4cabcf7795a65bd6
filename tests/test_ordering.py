"""Global order with positions."""

import random

from marketfold.operators.ordering import with_positions


def test_positions_follow_the_order(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice("abcd"), rnd.randint(0, 9), k) for k in range(500)]
    df = spark.createDataFrame(rows, "name string, n int, k int").repartition(7)
    got = with_positions(df, ("name", "n", "k"), parts=5).collect()
    assert [(r["name"], r["n"], r["k"]) for r in sorted(got, key=lambda r: r["position"])] == sorted(rows)
    assert sorted(r["position"] for r in got) == list(range(1, 501))
    assert with_positions(df.limit(0), ("name", "n", "k")).count() == 0
