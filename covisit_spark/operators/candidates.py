"""Candidate lists per session: history re-ranking and co-visitation votes.

Lists are flat ``(session, aid, rank)`` frames. Ordered-list rules become
sort keys: every candidate source (history, co-visitation votes, popular
items) emits ``(session, aid, key)`` where ``key`` is a ``BIGINT`` whose order
is the list order; one ``groupBy(session, aid).min(key)`` removes items
already placed by an earlier source, and one ``row_number`` window per
session cuts the list to ``N``.

Because the vote section is only cut when it alone fills the list, the
popular-item fill never competes with an unselected vote, so the union-then-
cut form returns exactly the sequential list (history, then votes, then
popular items).

All keys, ties and scores are primitive ``BIGINT`` (no struct min/max), so
every aggregate is a hash aggregate and every top-N window with a constant
bound gets a partial group limit before its shuffle. Scores are fixed-point:
position weights in micro-units times type weights in milli-units.

Packed keys (bit budget): list section ``< 4`` times ``2^40`` plus a rank
``< 2^31``; first-seen vote position = ``src * 2^60 + hist_rank * 2^29 +
nbr_rank`` with ``src <= 2``, ``hist_rank < 2^31`` (an INT rank) and
``nbr_rank < 2^29`` (matrices keep far fewer neighbours).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covisit_spark.functions import (
    COVISIT_BONUS,
    MICRO,
    MILLI,
    POSITION_WEIGHT_START,
    TYPE_WEIGHTS,
    milli_weight_map,
    position_weight,
    to_micro,
)
from covisit_spark.operators.positions import ranked_within
from covisit_spark.sources.sinks import spread

BONUS_UNITS = int(round(COVISIT_BONUS * MICRO * MILLI))
SECTION = 1 << 40
NEW_ITEM = 1 << 62


def _section_key(section: int, rank: Column) -> Column:
    return (F.lit(section * SECTION) + rank.cast("long")).alias("key")


def _first_seen(src: Column, hist_rank: Column, nbr_rank: Column) -> Column:
    return src.cast("long") * F.lit(1 << 60) + hist_rank.cast("long") * F.lit(1 << 29) + nbr_rank.cast("long")


def popular_items(history: DataFrame, top: int = 20) -> DataFrame:
    """Top items per event type by count: ``(type, aid, cnt, rank)``.

    Ties by ``aid`` ascending. The window per type sees one row per item;
    Spark runs a partial top-``top`` group limit before the shuffle, so each
    type ships at most ``top`` rows per map task.
    """
    c = history.groupBy("type", "aid").agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.partitionBy("type").orderBy(F.col("cnt").desc(), F.col("aid").asc())
    return c.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= top)


def _positions(history: DataFrame, bound_by: DataFrame | None = None) -> DataFrame:
    """Events with ``i`` (0-based time position) and ``n`` (session length).

    ``bound_by``: a frame whose sessions are at least as large (e.g. the events
    the history was cut from), whose hot-session check is reused."""
    e = ranked_within(history, ["session"], "ts", ["pos"], rank_col="_rn", count_col="n", bound_by=bound_by)
    return e.withColumn("i", (F.col("_rn") - 1).cast("long")).drop("_rn")


def history_unique(history: DataFrame, types: tuple[int, ...] | None = None) -> DataFrame:
    """Distinct items of each session, most recent first.

    ``(session, aid, rec_rank, n_unique, first_i)``; ``types`` restricts the
    events considered (e.g. clicks and carts). Recency is the item's largest
    time position ``i``, so the aggregate is over integers.
    """
    e = _positions(history)
    if types is not None:
        e = e.where(F.col("type").isin(list(types)))
    g = e.groupBy("session", "aid").agg(F.max("i").alias("_li"), F.min("i").alias("first_i"))
    r = ranked_within(g, ["session"], "_li", descending=True, rank_col="rec_rank", count_col="n_unique",
                      bound_by=history)
    return r.select("session", "aid", F.col("rec_rank").cast("int").alias("rec_rank"), "n_unique", "first_i")


def history_weights(history: DataFrame, start: float, type_weights: Mapping[int, float] = TYPE_WEIGHTS) -> DataFrame:
    """Per event: log-spaced position weight and its fixed-point score term.

    ``i`` is the 0-based time position, ``n`` the session's event count;
    ``w_units = round(w * 1e6)``, ``term = w_units * type_weight_milli``.
    """
    e = _positions(history)
    w_units = to_micro(position_weight(F.col("i"), F.col("n"), start))
    return e.withColumn("w_units", w_units).withColumn("term", F.col("w_units") * milli_weight_map("type", type_weights))


def rerank_history(history: DataFrame, start: float, type_weights: Mapping[int, float] = TYPE_WEIGHTS) -> DataFrame:
    """History score per ``(session, aid)`` with its first time position."""
    hw = history_weights(history, start, type_weights)
    return hw.groupBy("session", "aid").agg(F.sum("term").alias("score"), F.min("i").alias("first_i"))


def session_items(
    history: DataFrame, type_weights: Mapping[int, float] = TYPE_WEIGHTS, bound_by: DataFrame | None = None
) -> DataFrame:
    """Everything the list rules need per ``(session, item)``.

    ``(session, aid, rec_rank, n_unique, buy_rank, first_i, score_clicks,
    score_carts)``. ``buy_rank`` ranks the items with a click or cart event,
    most recent first (null for the others). Positions and ranks come from
    :func:`ranked_within`, so a hot session is split across tasks; for
    ordinary data they are plain windows, and the per-item aggregate is a hash
    aggregate over integer positions.
    """
    bound = bound_by if bound_by is not None else history
    e = _positions(history, bound)
    tw = milli_weight_map("type", type_weights)
    is_buy = F.col("type").isin(0, 1)
    g = e.groupBy("session", "aid").agg(
        F.max("i").alias("_li"),
        F.min("i").alias("first_i"),
        F.max(F.when(is_buy, F.col("i"))).alias("_bi"),
        F.sum(to_micro(position_weight(F.col("i"), F.col("n"), POSITION_WEIGHT_START["clicks"])) * tw).alias("score_clicks"),
        F.sum(to_micro(position_weight(F.col("i"), F.col("n"), POSITION_WEIGHT_START["carts"])) * tw).alias("score_carts"),
    )
    g = ranked_within(g, ["session"], "_li", descending=True, rank_col="rec_rank", count_col="n_unique",
                      bound_by=bound)
    g = ranked_within(g, ["session"], "_bi", descending=True, rank_col="_br", count_col=None, bound_by=bound)
    return g.select(
        "session",
        "aid",
        F.col("rec_rank").cast("int").alias("rec_rank"),
        "n_unique",
        F.when(F.col("_bi").isNotNull(), F.col("_br")).cast("int").alias("buy_rank"),
        "first_i",
        "score_clicks",
        "score_carts",
    )


def neighbour_lists(items: DataFrame, matrix: DataFrame, src: int, rank_col: str = "rec_rank") -> DataFrame:
    """Items with their neighbours, few a row of the matrix: ``(session, src, hist_rank, aids, ranks)``.

    Lists are shuffled whole, so what reaches a session is one row an item and source, not one a vote.
    """
    pair = F.struct(F.col("aid_y"), F.col("rank"))
    m = matrix.where(F.col("aid_x").isNotNull()).groupBy(F.col("aid_x").alias("aid")).agg(F.collect_list(pair).alias("_n"))
    m = m.select("aid", F.transform("_n", lambda x: x["aid_y"]).alias("aids"), F.transform("_n", lambda x: x["rank"]).alias("ranks"))
    j = items.select("session", "aid", F.col(rank_col).alias("hist_rank")).join(m, "aid")
    return j.select("session", F.lit(src).alias("src"), "hist_rank", "aids", "ranks")


def votes_of(lists: DataFrame, items: DataFrame) -> DataFrame:
    """The votes of :func:`neighbour_lists`, dealt by session into parts by the size of ``items``' files before they are expanded."""
    each = F.inline(F.arrays_zip(F.col("aids").alias("aid"), F.col("ranks").alias("nbr_rank")))
    votes = spread(lists, "session", items).select("session", "src", "hist_rank", each)
    return votes.select("session", "aid", "src", "hist_rank", "nbr_rank")


def neighbour_votes(items: DataFrame, matrix: DataFrame, src: int, rank_col: str = "rec_rank") -> DataFrame:
    """Expand items by their neighbour lists: ``(session, aid, src, hist_rank, nbr_rank)``."""
    return votes_of(neighbour_lists(items, matrix, src, rank_col), items)


def vote_keys(votes: DataFrame) -> DataFrame:
    """Vote count and first-seen list position per candidate:
    ``(session, aid, votes, first_seen)``."""
    return votes.groupBy("session", "aid").agg(
        F.count(F.lit(1)).alias("votes"),
        F.min(_first_seen(F.col("src"), F.col("hist_rank"), F.col("nbr_rank"))).alias("first_seen"),
    )


def _vote_order() -> list[Column]:
    return [F.col("votes").desc(), F.col("first_seen").asc()]


def vote_top_n(votes: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """Vote winners not already in the history, cut to the free slots
    ``n - n_unique``: ``(session, aid, votes, rank)``.

    The constant bound ``rank <= n`` comes first so Catalyst plans a partial
    group limit before the shuffle; the per-session bound follows.
    """
    vk = vote_keys(votes).join(items.select("session", "aid"), ["session", "aid"], "left_anti")
    w = Window.partitionBy("session").orderBy(*_vote_order())
    r = vk.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= n)
    free = items.where(F.col("rec_rank") == 1).select("session", "n_unique")
    return r.join(free, "session").where(F.col("rank") <= F.lit(n) - F.col("n_unique")).select(
        "session", "aid", "votes", "rank"
    )


def _cut(keyed: DataFrame, n: int) -> DataFrame:
    """Keep each item's smallest key, then the ``n`` smallest keys per session."""
    best = keyed.groupBy("session", "aid").agg(F.min("key").alias("key"))
    w = Window.partitionBy("session").orderBy("key")
    return best.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= n).select(
        "session", "aid", "rank"
    )


def _top_unique(scored: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """``n`` best rows per session of a frame already unique per (session, aid)."""
    w = Window.partitionBy("session").orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= n).select(
        "session", "aid", "rank"
    )


def _short_list(uniq_short: DataFrame, votes: DataFrame, pop: DataFrame, n: int, pop_type: int) -> DataFrame:
    hist = uniq_short.select("session", "aid", _section_key(0, F.col("rec_rank")))
    # Vote order over all candidates, history items included: at most n_unique
    # of the first n are history items, so the first n always hold the
    # n - n_unique winners that the list needs (constant bound: partial limit).
    w = Window.partitionBy("session").orderBy(*_vote_order())
    ranked = vote_keys(votes).withColumn("_vr", F.row_number().over(w)).where(F.col("_vr") <= n)
    vk = ranked.select("session", "aid", _section_key(1, F.col("_vr")))
    sessions = uniq_short.where(F.col("rec_rank") == 1).select("session")
    # popular list of the target type: at most ``top`` rows (20) by
    # construction, fetched once as a sorted array (scalar subquery) and
    # expanded per short session - a bounded fan-out, no join
    top = pop.where(F.col("type") == pop_type).agg(
        F.sort_array(F.collect_list(F.struct("rank", "aid"))).alias("_p")
    ).scalar()
    fill = sessions.select("session", F.inline(top)).select("session", "aid", _section_key(2, F.col("rank")))
    return _cut(hist.unionByName(vk).unionByName(fill), n)


def suggest_clicks(
    history: DataFrame,
    clicks_matrix: DataFrame,
    popular: DataFrame,
    num_cands: int = 20,
    type_weights: Mapping[int, float] = TYPE_WEIGHTS,
    items: DataFrame | None = None,
) -> DataFrame:
    """Click candidates per session: ``(session, aid, rank)``.

    Sessions with at least ``num_cands`` distinct items re-rank their own
    history; the others list their history (most recent first), then items
    voted by the clicks matrix, then popular clicked items. ``items`` is a
    precomputed :func:`session_items` frame (built from ``history`` if absent).
    """
    si = items if items is not None else session_items(history, type_weights)
    long_list = _top_unique(
        si.where(F.col("n_unique") >= num_cands), num_cands, [F.col("score_clicks").desc(), F.col("first_i").asc()]
    )
    uniq_short = si.where(F.col("n_unique") < num_cands)
    votes = neighbour_votes(uniq_short, clicks_matrix, 0)
    return long_list.unionByName(_short_list(uniq_short, votes, popular, num_cands, 0))


def _carts_scores(si: DataFrame, carts_matrix: DataFrame) -> DataFrame:
    """History score plus bonus; ``tie``: history items by first position,
    then new items (offset ``2^62``) by first-seen list position."""
    buys = si.where(F.col("buy_rank").isNotNull())
    # history items go as lists of one, so that they meet the votes in the one exchange by session
    hist = si.select(
        "session", F.lit(0).alias("src"), F.lit(None).cast("int").alias("hist_rank"), F.array("aid").alias("aids"),
        F.lit(None).cast("array<int>").alias("ranks"), F.col("score_carts").alias("score"), F.col("first_i").alias("tie"),
    )
    new = neighbour_lists(buys, carts_matrix, 0, "buy_rank")
    both = spread(hist.unionByName(new, allowMissingColumns=True), "session", si)
    is_new = F.col("ranks").isNotNull()
    pairs = F.arrays_zip(F.col("aids").alias("aid"), F.when(is_new, F.col("ranks")).otherwise(F.array(F.lit(0))).alias("nbr_rank"))
    each = both.select("session", "hist_rank", "score", "tie", is_new.alias("_new"), F.inline(pairs))
    score = F.when(F.col("_new"), F.lit(BONUS_UNITS)).otherwise(F.col("score"))
    tie = F.when(F.col("_new"), F.lit(NEW_ITEM) + _first_seen(F.lit(0), F.col("hist_rank"), F.col("nbr_rank"))).otherwise(F.col("tie"))
    return each.groupBy("session", "aid").agg(F.sum(score).alias("score"), F.min(tie).alias("tie"))


def carts_rerank_scores(
    history: DataFrame,
    carts_matrix: DataFrame,
    type_weights: Mapping[int, float] = TYPE_WEIGHTS,
    items: DataFrame | None = None,
) -> DataFrame:
    """History score (exponent start 0.5) plus 0.03 per occurrence of an item
    in the carts-matrix lists of the session's clicked or carted items.

    ``(session, aid, score, tie)``: ``tie`` orders equal scores - history
    items by first occurrence, then new items in first-seen list order.
    """
    si = items if items is not None else session_items(history, type_weights)
    return _carts_scores(si, carts_matrix)


def long_carts(
    items: DataFrame, carts_matrix: DataFrame, num_cands: int = 20, long_threshold: int = 20
) -> DataFrame:
    """The part of :func:`suggest_carts` for sessions with ``long_threshold`` distinct items or more."""
    total = _carts_scores(items.where(F.col("n_unique") >= long_threshold), carts_matrix)
    return _top_unique(total, num_cands, [F.col("score").desc(), F.col("tie").asc()])


def short_carts(
    items: DataFrame,
    clicks_matrix: DataFrame,
    carts_matrix: DataFrame,
    b2b_matrix: DataFrame,
    popular: DataFrame,
    num_cands: int = 20,
    long_threshold: int = 20,
) -> DataFrame:
    """The part of :func:`suggest_carts` for the other sessions."""
    uniq_short = items.where(F.col("n_unique") < long_threshold)
    buys_short = uniq_short.where(F.col("buy_rank").isNotNull())
    lists = (
        neighbour_lists(uniq_short, carts_matrix, 0)
        .unionByName(neighbour_lists(buys_short, clicks_matrix, 1, "buy_rank"))
        .unionByName(neighbour_lists(buys_short, b2b_matrix, 2, "buy_rank"))
    )
    return _short_list(uniq_short, votes_of(lists, items), popular, num_cands, 1)


def suggest_carts(
    history: DataFrame,
    clicks_matrix: DataFrame,
    carts_matrix: DataFrame,
    b2b_matrix: DataFrame,
    popular: DataFrame,
    num_cands: int = 20,
    long_threshold: int = 20,
    type_weights: Mapping[int, float] = TYPE_WEIGHTS,
    items: DataFrame | None = None,
) -> DataFrame:
    """Cart / order candidates per session: ``(session, aid, rank)``.

    Long sessions (``>= long_threshold`` distinct items): history score plus a
    bonus of 0.03 per occurrence in the carts-matrix lists of the session's
    clicked or carted items; new items rank after history items on ties.
    Short sessions: history, then votes from carts matrix x history, clicks
    matrix x clicked/carted items, b2b matrix x clicked/carted items, then
    popular carted items.
    """
    si = items if items is not None else session_items(history, type_weights)
    short = short_carts(si, clicks_matrix, carts_matrix, b2b_matrix, popular, num_cands, long_threshold)
    return long_carts(si, carts_matrix, num_cands, long_threshold).unionByName(short)


def truncate_lists(lists: DataFrame, n: int = 20) -> DataFrame:
    return lists.where(F.col("rank") <= n)


def assemble_predictions(clicks: DataFrame, carts: DataFrame) -> DataFrame:
    """One frame for the three targets; the carts list serves orders too."""
    return (
        clicks.select("session", F.lit("clicks").alias("type"), "aid", "rank")
        .unionByName(carts.select("session", F.lit("carts").alias("type"), "aid", "rank"))
        .unionByName(carts.select("session", F.lit("orders").alias("type"), "aid", "rank"))
    )
