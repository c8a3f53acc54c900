"""Parts of a join that multiplies its rows follow the input's size, and give the same rows."""

import time

import pytest
from conftest import events_df, matrix_df

import __spark_entry__ as E
from covisit_spark.operators import candidates as cand
from covisit_spark.operators import lambdarank as lr
from covisit_spark.session import FILE_CLEANUP
from covisit_spark.sources import sinks

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["covisit_b2b_orders", "predictions_orders", "weighted_recall_orders"])
def test_parts_follow_the_input_and_rows_stay(spark, monkeypatch, name):
    plain = E.queries()[name](spark, SF)
    want = sorted(map(str, plain.collect()))
    assert "REPARTITION_BY_NUM" not in _plan(plain)
    counts = []
    for size in (2000, 1000):
        monkeypatch.setattr(sinks, "PART_BYTES", size)
        many = E.queries()[name](spark, SF)
        plan = _plan(many)
        assert "REPARTITION_BY_NUM" in plan
        counts.append(max(int(p.split("REPARTITION_BY_NUM")[0].rsplit(", ", 2)[1].rstrip(")")) for p in plan.splitlines() if "REPARTITION_BY_NUM" in p))
        assert sorted(map(str, many.collect())) == want
    assert 1.8 * counts[0] <= counts[1] <= 2.2 * counts[0]


def test_votes_reach_a_session_as_lists(spark):
    items = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 10, 1), (2, None, 2), (None, 11, 1)], "session long, aid int, rec_rank int")
    lists = cand.neighbour_lists(items, matrix_df(spark, {10: [20, 21, 22], 11: [20, 10]}), 0)
    assert lists.count() == 4
    got = sorted((r["session"] or 0, r["aid"], r["hist_rank"], r["nbr_rank"]) for r in cand.votes_of(lists, items).collect())
    assert got == [(0, 10, 1, 2), (0, 20, 1, 1), (1, 10, 2, 2), (1, 20, 1, 1), (1, 20, 2, 1), (1, 21, 1, 2), (1, 22, 1, 3), (2, 20, 1, 1), (2, 21, 1, 2), (2, 22, 1, 3)]


def test_history_and_new_items_score_together(spark):
    si = cand.session_items(events_df(spark, [(1, k, 100 + k, 0, k % 3 + 10) for k in range(6)]))
    matrix = matrix_df(spark, {10: [11, 30], 12: [30]})
    own = {r["aid"]: (r["score_carts"], r["first_i"]) for r in si.collect()}
    got = {r["aid"]: (r["score"], r["tie"]) for r in cand.carts_rerank_scores(None, matrix, items=si).collect()}
    assert got[10] == own[10] and got[12] == own[12]
    assert got[11] == (own[11][0] + cand.BONUS_UNITS, own[11][1])
    assert got[30][0] == 2 * cand.BONUS_UNITS and got[30][1] > cand.NEW_ITEM


def test_users_without_a_positive_take_no_part_in_training(spark):
    rows = [(1, 0, 5, 1, 1.0, 1), (1, 0, 6, 2, 2.0, 0), (2, 1, 5, 1, 3.0, 0), (2, 1, 7, 2, 4.0, 0), (None, 1, 7, 2, 4.0, 1)]
    frame = spark.createDataFrame(rows, "user long, fold int, item int, origOrder int, x double, carts int")
    got = {r["user"]: len(r["c"]) for r in lr.grouped(frame, "carts", {"x": [1.5]}).collect()}
    assert got == {1: 2, None: 1}


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(k).getName() for k in range(files.size())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_stage_tables_leave_no_shuffle_files(spark, tmp_path):
    from covisit_spark.llm.common import stage

    rows = spark.range(2000).selectExpr("id % 70 as k", "id")
    for write in (
        lambda df: sinks.build_if_absent(spark, str(tmp_path / "t"), lambda: df),
        lambda df: sinks.write_table(df, f"test-{tmp_path.name}"),
        lambda df: stage(df, "test"),
    ):
        before, plain = _shuffle_files(spark), spark.conf.get(FILE_CLEANUP)
        df = rows.groupBy("k").count()
        assert write(df).count() == 70
        for _ in range(20):  # they are removed in the background
            left = _shuffle_files(spark) - before
            if len(left) <= 1:  # that of the count just above
                break
            time.sleep(0.5)
        assert len(left) <= 1 and spark.conf.get(FILE_CLEANUP) == plain


def test_lists_are_tables_and_sums_of_pairs_are_dropped(spark, tmp_path):
    import shutil

    from covisit_spark.plans.offline import Offline

    shutil.copy(f"{SF}/events.parquet", tmp_path / "events.parquet")
    o = Offline(spark, str(tmp_path))
    want = Offline(spark, str(tmp_path), materialize=False)
    for got, plain in ((o.clicks(), want.clicks()), (o.carts(), want.carts()), (o.stored_predictions(), want.predictions())):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    fs, folder = sinks._fs(spark, sinks.table_path(spark, o._prefix))
    names = {s.getPath().getName() for s in fs.listStatus(folder)}
    assert {"clicks_20", "carts_short_20", "carts_20", "top_pairs_1d"} <= names and not any(n.startswith("pair_sums") for n in names)
