"""Null keys, large ids, empty sides, the stage-table key and whole sessions."""

from conftest import events_df

from covisit_spark.functions import hash_cutoff
from covisit_spark.operators import profile, ranker
from covisit_spark.operators.positions import ranked_within
from covisit_spark.plans.offline import Offline
from covisit_spark.sources.feeds import ev_5d
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_split_path_keeps_null_sessions(spark):
    rows = [(None if i % 3 == 0 else 7, i, i // 4, 0, 1) for i in range(40)]
    df = spark.createDataFrame(rows, "session long, pos long, ts long, type int, aid int")
    plain = ranked_within(df, ["session"], "ts", ["pos"], rank_col="r", count_col="n", bucket_rows=1000).collect()
    cut = ranked_within(df, ["session"], "ts", ["pos"], rank_col="r", count_col="n", bucket_rows=5).collect()
    assert sorted(map(str, plain)) == sorted(map(str, cut)) and len(cut) == 40


def test_large_and_negative_ids_do_not_overflow(spark):
    ids = [2**62, 2**53 + 1, -(2**62), 0]
    df = spark.createDataFrame([(i, 5) for i in ids], "user long, n long")
    got = ranker.group_folds(df.withColumn("c", hash_cutoff(F.col("user"), F.col("n"))), 5).collect()
    for r in got:
        assert r["fold"] == (r["user"] * 7919 + 42) % 5 and r["c"] == 1 + (r["user"] * 7919 + 42) % 4


def test_empty_side_has_no_share(spark):
    e = events_df(spark, [(1, 0, 0, 0, 1)])
    r = profile.missing_items(e.where("aid < 0"), e, "x").first()
    assert (r["n_missing"], r["n_a"], r["pct_missing"]) == (0, 0, None)


def test_other_train_frame_builds_other_tables(spark):
    e = ev_5d(spark, SF)
    a = Offline(spark, SF, feed="ev_5d", train=e.where("type = 0"))
    b = Offline(spark, SF, feed="ev_5d", train=e.where("type >= 0"))
    assert a._prefix != b._prefix != Offline(spark, SF, feed="ev_5d")._prefix


def test_whole_sessions_get_lists_down_to_one_event(spark):
    o = Offline(spark, SF, feed="ev_5d", time_split=True, cutoff=False)
    sessions = o.events.select("session").distinct()
    assert o.predictions().select("session").distinct().count() == sessions.count() > 0
