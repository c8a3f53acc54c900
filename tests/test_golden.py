"""Hand-computed fixtures (FIXTURES.md section 3)."""

import pytest
from conftest import events_df, lists, matrix_df, popular_df

from covisit_spark.operators import candidates as cand
from covisit_spark.operators import covisit as cv
from covisit_spark.operators import evaluate as ev
from covisit_spark.operators import features as ft
from covisit_spark.operators import split
from covisit_spark.sources import jsonl

# (session, pos, ts, type, aid)
S1 = [(1, 0, 0, 0, 1), (1, 1, 100, 1, 2), (1, 2, 200, 2, 3)]
S2 = [(2, 0, 0, 0, 1), (2, 1, 90000, 0, 2), (2, 2, 90100, 1, 2)]


def weights(df):
    return {(r.aid_x, r.aid_y): r.wgt for r in df.collect()}


def test_pairs_within_one_day(spark):
    e = events_df(spark, S1 + S2)
    d = cv.distinct_session_pairs(cv.session_pairs(cv.recent_events(e, keep_rank=True), 1))
    got = sorted((r.session, r.aid_x, r.aid_y) for r in d.collect())
    assert got == sorted((1, x, y) for x in (1, 2, 3) for y in (1, 2, 3) if x != y)


def test_carts_type_weights(spark):
    w = weights(cv.covisit_carts(events_df(spark, S1 + S2)))
    assert w == {(1, 2): 9.0, (1, 3): 0.5, (2, 1): 0.5, (2, 3): 0.5, (3, 1): 0.5, (3, 2): 9.0}


def test_b2b_buy_pairs(spark):
    w = weights(cv.covisit_b2b(events_df(spark, S1 + S2)))
    assert w == {(2, 3): 1.0, (3, 2): 1.0}


def test_band_is_strict(spark):
    e = events_df(spark, [(5, 0, 0, 0, 1), (5, 1, 86400, 0, 2)])
    assert cv.covisit_clicks(e).count() == 0
    e = events_df(spark, [(5, 0, 0, 0, 1), (5, 1, 86399, 0, 2)])
    assert cv.covisit_clicks(e).count() == 2


def test_time_weight_ends(spark):
    e = events_df(spark, [(7, 0, 1000, 0, 1), (7, 1, 1000, 0, 2), (8, 0, 5000, 0, 3), (8, 1, 5000, 0, 4)])
    w = weights(cv.covisit_clicks(e))
    assert w[(1, 2)] == 1.0 and w[(3, 4)] == 4.0


def test_topk_ties_lowest_aid_first(spark):
    rows = [(s, 0, 0, 0, 1) for s in range(3)] + [(s, 1, 1, 0, 10 + s) for s in range(3)]
    m = cv.covisit_clicks(events_df(spark, rows), num_cand=2)
    got = [r.aid_y for r in m.where("aid_x = 1").orderBy("rank").collect()]
    assert got == [10, 11]


def test_short_history_clicks(spark):
    h = events_df(spark, [(1, 0, 0, 0, 1), (1, 1, 1, 0, 2), (1, 2, 2, 0, 1)])
    m = matrix_df(spark, {1: [3, 4], 2: [4, 5]})
    pop = popular_df(spark, {0: [9, 1, 8]})
    assert lists(cand.suggest_clicks(h, m, pop, 4))[1] == [1, 2, 4, 3]
    assert lists(cand.suggest_clicks(h, m, pop, 6))[1] == [1, 2, 4, 3, 5, 9]


def test_recency_features(spark):
    h = events_df(spark, [(1, 0, 5, 0, 1), (2, 0, 1, 0, 1), (2, 1, 2, 0, 2), (2, 2, 3, 0, 3)])
    r = {(x.session, x.pos): x for x in ft.recency_features(h).collect()}
    assert r[(1, 0)].action_num_reverse_chrono == 0 and r[(1, 0)].log_recency_score == 1.0
    assert [r[(2, p)].action_num_reverse_chrono for p in range(3)] == [2, 1, 0]
    assert [r[(2, p)].log_recency_score for p in range(3)] == pytest.approx([0.0717735, 0.4640857, 1.0], abs=1e-6)


def test_recall_example(spark):
    preds = spark.createDataFrame(
        [(1, "clicks", a, i + 1) for i, a in enumerate([1, 2, 3])]
        + [(1, "carts", a, i + 1) for i, a in enumerate([1, 2])]
        + [(1, "orders", 7, 1)],
        "session long, type string, aid int, rank int",
    )
    gt = spark.createDataFrame(
        [(1, "clicks", 1, 2), (1, "carts", 1, 4), (1, "carts", 2, 2), (1, "carts", 3, 2), (1, "orders", 1, 8)],
        "session long, type string, label_rank int, aid int",
    )
    r = ev.weighted_recall(ev.recall_by_type(ev.recall_hits(preds, gt))).first()
    assert (r.r_clicks, r.r_carts, r.r_orders) == (1.0, pytest.approx(1 / 3), 0.0)
    assert r.recall == pytest.approx(0.2)


def test_item_features(spark):
    e = events_df(spark, [(1, 0, 0, 0, 5), (2, 0, 0, 1, 5), (3, 0, 0, 2, 5), (3, 1, 1, 2, 5)])
    r = ft.item_features(e).first()
    assert (r.item_item_count, r.item_user_count, r.item_buy_ratio) == (4, 3, 1.25)
    assert (r.item_clicks, r.item_carts, r.item_orders, r.item_events) == (0.25, 0.25, 0.5, 4)


def test_one_event_session_dropped(spark):
    e = events_df(spark, [(1, 0, 0, 0, 1), (2, 0, 0, 0, 1), (2, 1, 1, 0, 2)])
    hist, lab = split.cutoff_split(e)
    assert {r.session for r in hist.collect()} == {2} and {r.session for r in lab.collect()} == {2}
    assert hist.count() + lab.count() == 2


def test_overlap_sessions_removed(spark):
    train = events_df(spark, [(1, 0, 0, 0, 1)])
    val = events_df(spark, [(1, 1, 9, 0, 1), (2, 0, 9, 0, 1)])
    assert [r.session for r in split.remove_overlap(val, train).collect()] == [2]


def test_duplicate_truth_does_not_multiply(spark):
    cands = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "user long, item int, rank int")
    truth = spark.createDataFrame([(1, "carts", 1, 5), (1, "carts", 2, 5)], "session long, type string, label_rank int, aid int")
    out = ft.candidate_labels(cands, truth, "carts")
    assert sorted((r.item, r.carts) for r in out.collect()) == [(5, 1), (6, 0)]


def test_unseen_item_and_missing_recency(spark):
    cands = ft.rank_features(spark.createDataFrame([(1, 99, 1)], "user long, item int, rank int"))
    h = events_df(spark, [(1, 0, 0, 0, 5)])
    f = ft.candidate_features(cands, ft.item_features(h), ft.user_features(h))
    r = ft.ranker_frame(f, ft.last_typed_event(ft.recency_features(h), "carts")).first()
    assert r.item_item_count == 0 and r.item_buy_ratio == 0.0 and r.user_user_count == 1
    assert (r.session_length, r.action_num_reverse_chrono, r.log_recency_score) == (-1, -1, -1.0)
    assert r.ts is None


def test_same_second_pos_decides(spark):
    e = events_df(spark, [(1, 1, 10, 0, 7), (1, 0, 10, 0, 8)])
    r = cv.recent_events(e, 1).first()
    assert r.aid == 7


def test_unknown_type_raises(spark):
    lines = spark.createDataFrame([('{"session":1,"events":[{"aid":5,"ts":1000,"type":"views"}]}',)], "value string")
    with pytest.raises(Exception):
        jsonl.flatten_sessions(jsonl.parse_session_lines(lines)).collect()


def test_short_list_when_catalogue_small(spark):
    h = events_df(spark, [(1, 0, 0, 0, 1)])
    m = matrix_df(spark, {1: [2]})
    pop = popular_df(spark, {0: [3]})
    assert lists(cand.suggest_clicks(h, m, pop, 20))[1] == [1, 2, 3]


def test_jsonl_line(spark, tmp_path):
    p = tmp_path / "s.jsonl"
    p.write_text(
        '{"session":1,"events":[{"aid":5,"ts":1659304800025,"type":"clicks"},'
        '{"aid":6,"ts":1659304900025,"type":"carts"}]}\n'
    )
    got = [tuple(r) for r in jsonl.flatten_sessions(jsonl.read_sessions_jsonl(spark, str(p))).orderBy("pos").collect()]
    assert got == [(1, 0, 1659304800, 0, 5), (1, 1, 1659304900, 1, 6)]


def test_session_sample_nested_and_exact(spark):
    e = events_df(spark, [(s, 0, 0, 0, 1) for s in range(1, 201)])
    s = split.session_sample(e, (0.05, 0.1, 0.25, 0.5, 1.0))
    by = {}
    for r in s.collect():
        by.setdefault(r.frac, set()).add(r.session)
    assert [len(by[f]) for f in (0.05, 0.1, 0.25, 0.5, 1.0)] == [10, 20, 50, 100, 200]
    assert by[0.05] <= by[0.1] <= by[0.25] <= by[0.5] <= by[1.0]
