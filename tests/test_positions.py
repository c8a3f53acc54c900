"""The split (hot-group) path of ranked_within equals a plain window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from covisit_spark.operators.positions import ranked_within


def _data(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for g in range(4):
        size = [1, 3, 40, 200][g]
        for p in range(size):
            ts = None if rnd.random() < 0.05 else rnd.randrange(0, 50)  # heavy ties, some nulls
            rows.append((g, p, ts))
    return spark.createDataFrame(rows, "g long, p long, ts long")


def _plain(df, desc):
    d = (lambda c: F.col(c).desc_nulls_last()) if desc else (lambda c: F.col(c).asc_nulls_last())
    w = Window.partitionBy("g").orderBy(d("ts"), d("p"))
    return {(r.g, r.p): (r.rn, r.n) for r in df.select("g", "p", F.row_number().over(w).alias("rn"),
                                                         F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n")).collect()}


def test_split_path_equals_window(spark):
    for seed, desc in ((1, False), (2, True), (3, False)):
        df = _data(spark, seed)
        for bucket in (2, 7, 1000):
            got = {(r.g, r.p): (r.rn, r.n) for r in ranked_within(df, ["g"], "ts", ["p"], descending=desc,
                                                                   bucket_rows=bucket).collect()}
            assert got == _plain(df, desc), (seed, desc, bucket)


def test_split_path_without_broadcast(spark):
    df = _data(spark, 4)
    got = {(r.g, r.p): (r.rn, r.n) for r in ranked_within(df, ["g"], "ts", ["p"], bucket_rows=5,
                                                           max_broadcast_groups=0).collect()}
    assert got == _plain(df, False)


def test_oracle_queries_through_split_path(spark, monkeypatch):
    from oracle_check import compare, duck

    import __spark_entry__ as E
    from covisit_spark.operators import positions

    monkeypatch.setattr(positions, "BUCKET_ROWS", 5)
    sf = "/root/testdata/sf0.001"
    from covisit_spark.sources.feeds import ev_5d, ev_user

    assert positions.hot_group_count(ev_user(spark, sf), ["session"]) > 0  # the split path is taken
    assert positions.hot_group_count(ev_5d(spark, sf), ["session"]) > 0
    con = duck(sf)
    for name in ("val_history", "val_labels", "ground_truth", "session_lists", "recency_features", "history_unique",
                 "history_weights"):
        r = compare(spark, sf, name, E.queries()[name], E.oracle_sql()[name], con)
        assert r["status"] == "ok", r
