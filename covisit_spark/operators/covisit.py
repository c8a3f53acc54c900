"""Item-to-item co-visitation matrices (self-join with a time band).

Plan shape, per matrix::

    events --(window: 30 most recent per session; partial group-limit runs
              before the shuffle, so a hot session ships <= 30 rows per map task)
           --> exchange(session)
           --> large inputs: exchange(session) of the recent events, into parts
               by the input's size (pairs are many times the events)
           --> self-join on session (no new exchange: both sides keep the
               partitioning) + band and self-pair residual
           --> per-session de-duplication of (aid_x, aid_y) (no new exchange)
           --> partial aggregate, exchange(aid_x, aid_y), final aggregate
           --> partial top-k group limit, exchange(aid_x), final top-k

Weights are summed as fixed-point ``BIGINT`` so results do not depend on
summation order; ``wgt`` is reported as ``sum / 1e6``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covisit_spark.functions import DAY_SECONDS, MICRO, RECENT_EVENTS, TYPE_WEIGHTS, weight_map
from covisit_spark.sources.sinks import spread


def recent_events(events: DataFrame, n: int = RECENT_EVENTS, keep_rank: bool = False) -> DataFrame:
    """The ``n`` most recent events of every session (order ``ts, pos`` desc).

    With ``keep_rank`` the recency rank (1 = most recent) is kept as ``rk``.
    """
    w = Window.partitionBy("session").orderBy(F.col("ts").desc(), F.col("pos").desc())
    r = events.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= n)
    return r if keep_rank else r.drop("rk")


def session_pairs(recent: DataFrame, day_range: float) -> DataFrame:
    """Ordered item pairs of a session within ``day_range`` days (strict).

    Self pairs (same item) are excluded. One row per pair of events.
    """
    cols = ["session", "pos", "ts", "type", "aid"] + (["rk"] if "rk" in recent.columns else [])
    x = recent.select(*cols).toDF(*["session"] + [f"{c}_x" for c in cols[1:]])
    y = recent.select(*cols).toDF(*["session"] + [f"{c}_y" for c in cols[1:]])
    band = int(day_range * DAY_SECONDS) if float(day_range * DAY_SECONDS).is_integer() else float(day_range) * DAY_SECONDS
    return x.join(y, "session").where(
        (F.abs(F.col("ts_x") - F.col("ts_y")) < F.lit(band)) & (F.col("aid_x") != F.col("aid_y"))
    )


def distinct_session_pairs(pairs: DataFrame, recent_n: int = RECENT_EVENTS) -> DataFrame:
    """One row per ``(session, aid_x, aid_y)``: the most recent x event, then
    the most recent y event, decide ``ts_x`` and ``type_y``.

    When the pairs carry recency ranks (``rk_x``, ``rk_y`` from
    :func:`recent_events`), "most recent" is the smallest integer
    ``rk_x * (n + 1) + rk_y`` - a primitive ordering key, so Spark uses a hash
    aggregate instead of sorting the pairs.
    """
    if "rk_x" in pairs.columns:
        order = F.col("rk_x") * F.lit(recent_n + 1) + F.col("rk_y")
        return pairs.groupBy("session", "aid_x", "aid_y").agg(
            F.min_by("ts_x", order).alias("ts_x"), F.min_by("type_y", order).alias("type_y")
        )
    order = F.struct("ts_x", "pos_x", "ts_y", "pos_y")
    return pairs.groupBy("session", "aid_x", "aid_y").agg(
        F.max_by(F.struct("ts_x", "type_y"), order).alias("_k")
    ).select("session", "aid_x", "aid_y", "_k.ts_x", "_k.type_y")


def top_k_from_units(summed: DataFrame, units_col: str, k: int) -> DataFrame:
    """Keep the ``k`` best ``aid_y`` per ``aid_x`` by an already summed
    ``units_col``; ties by ``aid_y`` ascending (a total order).

    ``row_number <= k`` is planned as a partial group limit before the shuffle
    by ``aid_x`` and a final one after it.
    """
    w = Window.partitionBy("aid_x").orderBy(F.col(units_col).desc(), F.col("aid_y").asc())
    return (
        summed.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select(
            "aid_x",
            "aid_y",
            (F.col(units_col).cast("double") / F.lit(float(MICRO))).alias("wgt"),
            F.col("rank").cast("int").alias("rank"),
        )
    )


def top_pairs(summed: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """The best pairs of each ``aid_x`` by each of several sums: ``limits`` (column -> k), with ``<column>_rank``.

    A row is there for one sum, the ranks by the others being null: at most
    ``sum(limits)`` rows an item. Every ranking has a partial group limit
    before its shuffle, so an item that goes with very many others sends k
    rows a task; all rankings read the same shuffled sums.
    """
    tops = []
    for c, k in limits.items():
        w = Window.partitionBy("aid_x").orderBy(F.col(c).desc(), F.col("aid_y").asc())
        top = summed.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
        ranks = [F.when(F.lit(x == c), F.col("_rank")).alias(f"{x}_rank") for x in limits]
        tops.append(top.select("aid_x", "aid_y", *limits, *ranks))
    return reduce(DataFrame.unionByName, tops)


def matrix_of(pairs: DataFrame, units_col: str, k: int) -> DataFrame:
    """The matrix of one of the sums of :func:`top_pairs`."""
    rank = F.col(f"{units_col}_rank").cast("int")
    wgt = F.col(units_col).cast("double") / F.lit(float(MICRO))
    return pairs.where(rank <= k).select("aid_x", "aid_y", wgt.alias("wgt"), rank.alias("rank"))


def top_k_neighbours(weighted: DataFrame, k: int) -> DataFrame:
    """Sum ``wgt_units`` per pair and keep the ``k`` best ``aid_y`` per ``aid_x``."""
    summed = weighted.groupBy("aid_x", "aid_y").agg(F.sum("wgt_units").alias("wgt_units"))
    return top_k_from_units(summed, "wgt_units", k)


def _pairs(events: DataFrame, day_range: float, recent_n: int) -> DataFrame:
    recent = spread(recent_events(events, recent_n, keep_rank=True), "session", events)
    return distinct_session_pairs(session_pairs(recent, day_range), recent_n)


def _with_bounds(d: DataFrame, events: DataFrame, t0: int | None, t1: int | None) -> DataFrame:
    """Attach ``t0``/``t1`` (min / max ``ts`` of ``events`` unless given) as a
    scalar subquery: computed once, no join."""
    if t0 is None or t1 is None:
        b = events.agg(F.struct(F.min("ts").alias("t0"), F.max("ts").alias("t1"))).scalar()
        return d.withColumn("t0", b["t0"]).withColumn("t1", b["t1"])
    return d.withColumn("t0", F.lit(t0).cast("long")).withColumn("t1", F.lit(t1).cast("long"))


def _time_units() -> Column:
    # 1 + 3 * (ts_x - t0) / (t1 - t0) in micro-units; exact integer division
    return F.expr(f"{MICRO} + ({3 * MICRO} * (ts_x - t0)) div greatest(t1 - t0, 1)")


def _type_units(type_weights: Mapping[int, float]) -> Column:
    return weight_map("type_y", {k: int(round(v * MICRO)) for k, v in type_weights.items()}, default=0).cast("long")


def pair_weights(
    events: DataFrame,
    day_range: float = 1,
    t0: int | None = None,
    t1: int | None = None,
    type_weights: Mapping[int, float] = TYPE_WEIGHTS,
    recent_n: int = RECENT_EVENTS,
) -> DataFrame:
    """Both 1-day weight sums from one pair pass: ``(aid_x, aid_y,
    clicks_units, carts_units)``.

    The clicks (time-weighted) and carts (type-weighted) matrices share the
    recent-event cap, the band and the per-session de-duplication; only the
    weight differs. One self-join and one aggregation shuffle serve both.
    """
    d = _with_bounds(_pairs(events, day_range, recent_n), events, t0, t1)
    return d.groupBy("aid_x", "aid_y").agg(
        F.sum(_time_units()).alias("clicks_units"), F.sum(_type_units(type_weights)).alias("carts_units")
    )


def covisit_clicks(
    events: DataFrame,
    num_cand: int = 20,
    day_range: float = 1,
    t0: int | None = None,
    t1: int | None = None,
    recent_n: int = RECENT_EVENTS,
) -> DataFrame:
    """Time-weighted matrix: ``wgt = 1 + 3 * (ts_x - t0) / (t1 - t0)``.

    ``t0``/``t1`` default to the min / max ``ts`` of ``events`` (one scalar
    subquery).
    """
    d = _with_bounds(_pairs(events, day_range, recent_n), events, t0, t1)
    return top_k_neighbours(d.select("aid_x", "aid_y", _time_units().alias("wgt_units")), num_cand)


def covisit_carts(
    events: DataFrame,
    num_cand: int = 15,
    day_range: float = 1,
    type_weights: Mapping[int, float] = TYPE_WEIGHTS,
    recent_n: int = RECENT_EVENTS,
) -> DataFrame:
    """Type-weighted matrix: weight by the type of the ``aid_y`` event."""
    d = _pairs(events, day_range, recent_n)
    return top_k_neighbours(d.select("aid_x", "aid_y", _type_units(type_weights).alias("wgt_units")), num_cand)


def covisit_b2b(
    events: DataFrame,
    num_cand: int = 15,
    day_range: float = 14,
    buy_types: tuple[int, ...] = (1, 2),
    recent_n: int = RECENT_EVENTS,
) -> DataFrame:
    """Buy-to-buy matrix: cart/order events only, unit weight per session pair."""
    buys = events.where(F.col("type").isin(list(buy_types)))
    d = _pairs(buys, day_range, recent_n)
    return top_k_neighbours(d.select("aid_x", "aid_y", F.lit(MICRO).cast("long").alias("wgt_units")), num_cand)


def covisit_lists(matrix: DataFrame) -> DataFrame:
    """Neighbour list per item, best first (``k`` entries at most)."""
    return matrix.groupBy("aid_x").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "aid_y"))), lambda s: s["aid_y"]).alias("neighbours")
    )
