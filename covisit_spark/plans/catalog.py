"""Query catalogue: one Spark query per operator of the inventory.

Every callable takes ``(spark, sf_dir)``, reads the driver's tables through a
feed adapter and returns a lazy ``DataFrame``; the matching DuckDB statement
lives in :mod:`covisit_spark.plans.oracle` under the same key.

Feeds: ``ev_user`` (one session per user) drives co-visitation, candidates,
features and evaluation; ``ev_5d`` (user x 5-day bucket) drives the time
split, because whole-user sessions would all straddle the split point.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covisit_spark.functions import POSITION_WEIGHT_START, type_id_to_name, type_name_to_id
from covisit_spark.operators import candidates as cand
from covisit_spark.operators import covisit as cv
from covisit_spark.operators import evaluate as ev
from covisit_spark.operators import features as ft
from covisit_spark.operators import lambdarank as lr
from covisit_spark.operators import ranker as rk
from covisit_spark.operators import profile as pf
from covisit_spark.operators import split
from covisit_spark.plans.offline import Offline
from covisit_spark.sources import jsonl, sinks
from covisit_spark.sources.feeds import ev_5d, ev_user, ol_cust

Query = Callable[[SparkSession, str], DataFrame]
Q: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        Q[name] = fn
        return fn

    return deco


# --- A: sources and sinks --------------------------------------------------
@query("events_canonical")
def _events_canonical(spark, sf):
    return ev_user(spark, sf)


@query("flatten_sessions")
def _flatten_sessions(spark, sf):
    lines = jsonl.sessions_to_json_lines(ev_user(spark, sf), chunk=64)
    return jsonl.flatten_sessions(jsonl.parse_session_lines(lines), pos_offset="offset")


@query("event_type_encode")
def _event_type_encode(spark, sf):
    e = ev_user(spark, sf).select("pos", type_id_to_name("type").alias("type_name"))
    return e.select("pos", "type_name", type_name_to_id("type_name").alias("type"))


@query("events_union")
def _events_union(spark, sf):
    return _split5(spark, sf)["train"].unionByName(_split5(spark, sf)["history"])


@query("submission_format")
def _submission_format(spark, sf):
    return sinks.submission_frame(Offline(spark, sf).predictions())


# --- B: profiling ----------------------------------------------------------
@query("event_time_range")
def _event_time_range(spark, sf):
    return pf.event_time_range(ev_user(spark, sf))


def _split5(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    e = ev_5d(spark, sf)
    train, val = split.time_split(e)
    clean = split.remove_overlap(val, train)
    hist, labels = split.cutoff_split(clean)
    return {
        "train": train,
        "val": val,
        "val_clean": clean,
        "history": hist,
        "labels": labels,
        "train_recent": split.recent_window(e),
    }


@query("split_profile")
def _split_profile(spark, sf):
    return pf.split_profile(_split5(spark, sf))


@query("aid_coverage")
def _aid_coverage(spark, sf):
    s = _split5(spark, sf)
    return pf.aid_coverage(
        {
            "val_not_in_train": (s["val_clean"], s["train"]),
            "labels_not_in_train": (s["labels"], s["train"]),
            "history_not_in_train": (s["history"], s["train"]),
            "val_not_in_recent": (s["val"], s["train_recent"]),
        }
    )


@query("aid_coverage_orders")
def _aid_coverage_orders(spark, sf):
    """Coverage where catalogues differ: parts ordered in the last week, the weeks before it, and the last three weeks."""
    e = ol_cust(spark, sf)
    train, val = split.time_split(e)
    recent = split.recent_window(e)
    return pf.aid_coverage(
        {"train_not_in_val": (train, val), "val_not_in_train": (val, train), "train_not_in_recent": (train, recent), "recent_not_in_val": (recent, val)}
    )


@query("session_overlap")
def _session_overlap(spark, sf):
    s = _split5(spark, sf)
    return pf.session_overlap(s["train"], s["val"])


# --- C: split and sampling -------------------------------------------------
@query("time_split")
def _time_split(spark, sf):
    return split.tag_time_split(ev_5d(spark, sf))


@query("train_recent_weeks")
def _train_recent_weeks(spark, sf):
    return split.recent_window(ev_5d(spark, sf))


@query("val_clean")
def _val_clean(spark, sf):
    return _split5(spark, sf)["val_clean"]


@query("val_history")
def _val_history(spark, sf):
    return _split5(spark, sf)["history"]


@query("val_labels")
def _val_labels(spark, sf):
    return _split5(spark, sf)["labels"]


@query("session_cutoffs")
def _session_cutoffs(spark, sf):
    return split.session_cutoffs(_split5(spark, sf)["val_clean"])


@query("ground_truth")
def _ground_truth(spark, sf):
    return split.ground_truth(_split5(spark, sf)["labels"])


@query("session_sample")
def _session_sample(spark, sf):
    return split.session_sample(ev_5d(spark, sf))


@query("session_lists")
def _session_lists(spark, sf):
    sl = split.session_lists(_split5(spark, sf)["history"], chunk_size=4)
    return sl.select(
        "session",
        "chunk",
        F.array_join(F.col("aids").cast("array<string>"), " ").alias("aids"),
        F.array_join(F.col("types").cast("array<string>"), " ").alias("types"),
    )


@query("val_subset")
def _val_subset(spark, sf):
    e = ev_5d(spark, sf)
    sample = split.session_sample(e, fractions=(0.25,))
    return split.restrict_sessions(e, sample)


# --- D: co-visitation ------------------------------------------------------
@query("recent_events")
def _recent_events(spark, sf):
    return cv.recent_events(ev_user(spark, sf)).select("session", "pos", "ts", "type", "aid")


@query("session_pairs")
def _session_pairs(spark, sf):
    p = cv.session_pairs(cv.recent_events(ev_user(spark, sf)), 1)
    return p.select("session", "aid_x", "aid_y", "pos_x", "pos_y", "ts_x", "ts_y", "type_x", "type_y")


@query("session_pairs_distinct")
def _session_pairs_distinct(spark, sf):
    return cv.distinct_session_pairs(cv.session_pairs(cv.recent_events(ev_user(spark, sf)), 1))


@query("covisit_clicks")
def _covisit_clicks(spark, sf):
    return cv.covisit_clicks(ev_user(spark, sf))


@query("covisit_carts")
def _covisit_carts(spark, sf):
    return cv.covisit_carts(ev_user(spark, sf))


@query("covisit_b2b")
def _covisit_b2b(spark, sf):
    return cv.covisit_b2b(ev_user(spark, sf))


@query("covisit_lists")
def _covisit_lists(spark, sf):
    lists = cv.covisit_lists(cv.covisit_clicks(ev_user(spark, sf)))
    return lists.select("aid_x", F.array_join(F.col("neighbours").cast("array<string>"), " ").alias("neighbours"))


@query("covisit_pair_weights")
def _covisit_pair_weights(spark, sf):
    return cv.pair_weights(ev_user(spark, sf))


@query("covisit_b2b_orders")
def _covisit_b2b_orders(spark, sf):
    return cv.covisit_b2b(ol_cust(spark, sf))


# --- E: candidates ---------------------------------------------------------
@query("popular_items")
def _popular_items(spark, sf):
    return Offline(spark, sf).popular


@query("history_unique")
def _history_unique(spark, sf):
    return cand.history_unique(Offline(spark, sf).history).select("session", "aid", "rec_rank", "n_unique")


@query("history_weights")
def _history_weights(spark, sf):
    hw = cand.history_weights(Offline(spark, sf).history, POSITION_WEIGHT_START["clicks"])
    return hw.select("session", "pos", "aid", "type", "i", "n", "w_units", "term")


@query("rerank_history_clicks")
def _rerank_history_clicks(spark, sf):
    return cand.rerank_history(Offline(spark, sf).history, POSITION_WEIGHT_START["clicks"]).select("session", "aid", "score")


@query("rerank_history_carts")
def _rerank_history_carts(spark, sf):
    o = Offline(spark, sf)
    return cand.carts_rerank_scores(o.history, o.carts_matrix).select("session", "aid", "score")


@query("candidate_votes_clicks")
def _candidate_votes_clicks(spark, sf):
    o = Offline(spark, sf)
    return cand.neighbour_votes(cand.history_unique(o.history), o.clicks_matrix, 0)


def _carts_votes(o: Offline) -> DataFrame:
    uniq = cand.history_unique(o.history)
    buys = cand.history_unique(o.history, types=(0, 1))
    return (
        cand.neighbour_votes(uniq, o.carts_matrix, 0)
        .unionByName(cand.neighbour_votes(buys, o.clicks_matrix, 1))
        .unionByName(cand.neighbour_votes(buys, o.b2b_matrix, 2))
    )


@query("candidate_votes_carts")
def _candidate_votes_carts(spark, sf):
    return _carts_votes(Offline(spark, sf))


def _topn(o: Offline, votes: DataFrame, n: int) -> DataFrame:
    return cand.vote_top_n(votes, cand.history_unique(o.history), n)


@query("candidate_topn_clicks")
def _candidate_topn_clicks(spark, sf):
    o = Offline(spark, sf)
    return _topn(o, cand.neighbour_votes(cand.history_unique(o.history), o.clicks_matrix, 0), 20)


@query("candidate_topn_carts")
def _candidate_topn_carts(spark, sf):
    o = Offline(spark, sf)
    return _topn(o, _carts_votes(o), 20)


@query("suggest_clicks")
def _suggest_clicks(spark, sf):
    return Offline(spark, sf).clicks()


@query("suggest_carts")
def _suggest_carts(spark, sf):
    return Offline(spark, sf).carts()


@query("candidates_top20")
def _candidates_top20(spark, sf):
    return cand.truncate_lists(Offline(spark, sf, num_cands=50).predictions(), 20)


@query("predictions_all")
def _predictions_all(spark, sf):
    return Offline(spark, sf).predictions()


# --- H: evaluation ---------------------------------------------------------
def _hits(spark, sf, n=20, depth=None):
    o = Offline(spark, sf, num_cands=n)
    return ev.recall_hits(o.predictions(), o.truth, depth=depth)


@query("recall_hits")
def _recall_hits(spark, sf):
    return _hits(spark, sf)


@query("recall_by_type")
def _recall_by_type(spark, sf):
    return ev.recall_by_type(_hits(spark, sf))


@query("weighted_recall")
def _weighted_recall(spark, sf):
    return ev.weighted_recall(ev.recall_by_type(_hits(spark, sf)))


@query("recall_at_depths")
def _recall_at_depths(spark, sf):
    o = Offline(spark, sf, num_cands=50)
    preds = o.predictions()
    out = None
    for depth in (50, 20):
        r = ev.weighted_recall(ev.recall_by_type(ev.recall_hits(preds, o.truth, depth=depth)))
        r = r.select(F.lit(depth).alias("depth"), "*")
        out = r if out is None else out.unionByName(r)
    return out


@query("predictions_orders")
def _predictions_orders(spark, sf):
    """The same flow over order lines: customers as sessions, parts as items."""
    return Offline(spark, sf, feed="ol_cust").predictions()


@query("weighted_recall_orders")
def _weighted_recall_orders(spark, sf):
    o = Offline(spark, sf, feed="ol_cust")
    return ev.weighted_recall(ev.recall_by_type(ev.recall_hits(o.stored_predictions(), o.truth)))


@query("predictions_time_split")
def _predictions_time_split(spark, sf):
    """Last week held out; matrices from the earlier weeks plus the histories."""
    return Offline(spark, sf, feed="ev_5d", time_split=True).predictions()


@query("predictions_full_sessions")
def _predictions_full_sessions(spark, sf):
    """Lists for the whole, unlabelled sessions of the last week, one-event sessions
    included; matrices from the earlier weeks plus those sessions."""
    return Offline(spark, sf, feed="ev_5d", time_split=True, cutoff=False).predictions()


@query("submission_full_sessions")
def _submission_full_sessions(spark, sf):
    return sinks.submission_frame(Offline(spark, sf, feed="ev_5d", time_split=True, cutoff=False).predictions())


@query("weighted_recall_time_split")
def _weighted_recall_time_split(spark, sf):
    o = Offline(spark, sf, feed="ev_5d", time_split=True)
    return ev.weighted_recall(ev.recall_by_type(ev.recall_hits(o.predictions(), o.truth)))


# --- F: features and labels -----------------------------------------------
def _cands50(spark, sf):
    return Offline(spark, sf, num_cands=50)


@query("candidate_rows")
def _candidate_rows(spark, sf):
    return ft.candidate_rows(_cands50(spark, sf).carts())


@query("candidate_rank_feats")
def _candidate_rank_feats(spark, sf):
    return ft.rank_features(ft.candidate_rows(_cands50(spark, sf).carts()))


@query("item_features")
def _item_features(spark, sf):
    return ft.item_features(Offline(spark, sf).matrix_source)


@query("user_features")
def _user_features(spark, sf):
    return ft.user_features(Offline(spark, sf).history)


@query("candidate_features")
def _candidate_features(spark, sf):
    o = _cands50(spark, sf)
    cands = ft.rank_features(ft.candidate_rows(o.carts()))
    return ft.candidate_features(cands, ft.item_features(o.matrix_source), ft.user_features(o.history))


@query("candidate_labels")
def _candidate_labels(spark, sf):
    o = _cands50(spark, sf)
    return ft.candidate_labels(ft.candidate_rows(o.carts()), o.truth, "carts")


@query("recency_features")
def _recency_features(spark, sf):
    r = ft.recency_features(Offline(spark, sf).history)
    return r.select("session", "pos", "aid", "type", *ft.RECENCY_FEATURES)


@query("last_typed_event")
def _last_typed_event(spark, sf):
    return ft.last_typed_event(ft.recency_features(Offline(spark, sf).history), "carts")


@query("ranker_frame")
def _ranker_frame(spark, sf):
    return _cands50(spark, sf).candidate_frame("carts")


@query("ranker_frame_orders")
def _ranker_frame_orders(spark, sf):
    return _cands50(spark, sf).candidate_frame("orders")


@query("downsample_negatives")
def _downsample_negatives(spark, sf):
    f = _cands50(spark, sf).candidate_frame("carts")
    return ft.downsample_negatives(f, "carts", 0.3).select("user", "item", "carts")


@query("label_density")
def _label_density(spark, sf):
    f = _cands50(spark, sf).candidate_frame("carts")
    before = ft.label_density(f, "carts").select(F.lit("before").alias("stage"), "*")
    after = ft.label_density(ft.downsample_negatives(f, "carts", 0.3), "carts").select(F.lit("after").alias("stage"), "*")
    return before.unionByName(after)


# --- G: ranker ---------------------------------------------------------------
# Fixed integer score used where the oracle must reproduce the ranking:
# recently acted-on items first, then the co-visitation order.
FIXED_SCORE = (
    "(CASE WHEN action_num_reverse_chrono >= 0 THEN 1000 - action_num_reverse_chrono ELSE 0 END)"
    " + (CASE WHEN origOrder > 0 THEN 21 - origOrder ELSE 0 END)"
)


def _folded(spark, sf, target="carts"):
    return rk.group_folds(_cands50(spark, sf).candidate_frame(target))


@query("group_folds")
def _group_folds(spark, sf):
    return _folded(spark, sf).select("user", "fold").distinct()


@query("group_sizes")
def _group_sizes(spark, sf):
    return rk.group_sizes(_folded(spark, sf))


def _fixed_ranked(spark, sf, target="carts"):
    f = _cands50(spark, sf).candidate_frame(target)
    return f, rk.rank_top(f.withColumn("score", F.expr(FIXED_SCORE)), 20)


@query("rank_top20")
def _rank_top20(spark, sf):
    return _fixed_ranked(spark, sf)[1]


@query("map_at_20")
def _map_at_20(spark, sf):
    f, ranked = _fixed_ranked(spark, sf)
    return rk.map_at_k(ranked, f, "carts", 20)


def _ranked_predictions(spark, sf, ranked_carts, ranked_orders):
    o = Offline(spark, sf)
    clicks = o.clicks(20).select("session", F.lit("clicks").alias("type"), "aid", "rank")
    rc = ranked_carts.select(F.col("user").alias("session"), F.lit("carts").alias("type"), F.col("item").alias("aid"), "rank")
    ro = ranked_orders.select(F.col("user").alias("session"), F.lit("orders").alias("type"), F.col("item").alias("aid"), "rank")
    return clicks.unionByName(rc).unionByName(ro)


@query("predictions_ranked")
def _predictions_ranked(spark, sf):
    return _ranked_predictions(spark, sf, _fixed_ranked(spark, sf, "carts")[1], _fixed_ranked(spark, sf, "orders")[1])


@query("ranker_scores")
def _ranker_scores(spark, sf):
    """Train on down-sampled negatives (fold 0 validates), score every candidate."""
    f = _cands50(spark, sf).ranker_inputs("carts")
    model = rk.train_ranker(ft.downsample_negatives(f, "carts", 0.3), "carts", params={"maxIter": 20})
    return rk.score([model], f).select("user", "item", "score")


# Fixed trees over the candidate features: what they score, SQL can follow. Values are multiples of 1/8, so sums are exact.
FIXED_TREES = [
    {1: ("action_num_reverse_chrono", -0.5, 1.0), 2: ("item_item_count", 40.5, 1.0), 3: ("action_num_reverse_chrono", 3.5, 1.0),
     4: -0.5, 5: -0.25, 6: 0.75, 7: 0.25},
    {1: ("origOrder", 0.5, 1.0), 2: -0.375, 3: ("origOrder", 5.5, 1.0), 6: 0.5, 7: 0.125},
    {1: ("item_carts", 0.2, 1.0), 2: -0.125, 3: 0.125},
    {1: ("session_length", 4.5, 1.0), 2: ("log_recency_score", 0.5, 1.0), 3: ("item_orders", 0.15, 1.0), 4: -0.25, 5: 0.25, 6: 0.0, 7: 0.5},
]


@query("map_at_20_by_round")
def _map_at_20_by_round(spark, sf):
    """Validation curve of a fixed model: MAP@20 after each of its trees."""
    frame = _cands50(spark, sf).ranker_inputs("carts")
    return lr.curve(lr.RankModel(list(ft.FEATURES), FIXED_TREES), frame, "carts", 20)


@query("ranker_lambdarank")
def _ranker_lambdarank(spark, sf):
    """Train the list-wise ranker on down-sampled negatives (fold 0 validates), score every candidate."""
    f = _cands50(spark, sf).ranker_inputs("carts")
    model = lr.train(ft.downsample_negatives(f, "carts", 0.3), "carts", params={"rounds": 6, "max_depth": 3, "min_rows": 20})
    return lr.score([model], f).select("user", "item", "score")


@query("ranker_sweep")
def _ranker_sweep(spark, sf):
    """Results table of a (one-point) configuration sweep: recall and MAP@20."""
    from covisit_spark.plans.offline import ranker_sweep

    grid = rk.param_grid({"maxIter": [10], "maxDepth": [5], "stepSize": [0.1]})
    return ranker_sweep(Offline(spark, sf, num_cands=50), grid)


@query("feature_importance")
def _feature_importance(spark, sf):
    o = Offline(spark, sf, num_cands=50)
    frame = o.ranker_inputs("carts")
    feats = [c for c in ft.FEATURES if c in frame.columns]
    model = rk.train_ranker(ft.downsample_negatives(frame, "carts", 0.3), "carts", feats, params={"maxIter": 10})
    return spark.createDataFrame(rk.feature_importance(model, feats), "feature string, importance double")


def queries() -> dict[str, Query]:
    return dict(Q)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Full co-visitation recommendation: predictions for the three targets."""
    return Offline(spark, sf).predictions()
