"""Candidate features and labels for the ranker.

All features are aggregates or windows joined back on keys:

* item features: ``groupBy(aid)`` over the feature source (partial aggregate,
  one row per item);
* user features: ``groupBy(session)`` over the validation history;
* recency features: windows per session over the history, reduced to the
  last event of the target type per ``(user, item)``.

Joins are equi-joins on ``item`` / ``user`` / ``(user, item)``; Spark picks
broadcast or sort-merge by measured size (AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covisit_spark.functions import MICRO, TYPE_IDS, hash_unit, position_weight, to_micro
from covisit_spark.operators.positions import ranked_within

ITEM_FEATURES = [
    "item_item_count",
    "item_user_count",
    "item_buy_ratio",
    "item_clicks",
    "item_carts",
    "item_orders",
    "item_events",
]
USER_FEATURES = ["user_user_count", "user_item_count", "user_buy_ratio", "num_events"]
RECENCY_FEATURES = ["session_length", "action_num_reverse_chrono", "log_recency_score"]
FEATURES = ["orig20", "origOrder"] + ITEM_FEATURES + USER_FEATURES + RECENCY_FEATURES


def candidate_rows(lists: DataFrame) -> DataFrame:
    """Candidate lists -> ``(user, item, rank)``."""
    return lists.select(F.col("session").alias("user"), F.col("aid").alias("item"), "rank")


def rank_features(cands: DataFrame, top: int = 20) -> DataFrame:
    """``orig20`` = 1 within the first ``top`` else -1; ``origOrder`` = rank or -1."""
    inside = F.col("rank") <= top
    return cands.withColumn("orig20", F.when(inside, F.lit(1)).otherwise(F.lit(-1))).withColumn(
        "origOrder", F.when(inside, F.col("rank")).otherwise(F.lit(-1))
    )


def item_features(events: DataFrame) -> DataFrame:
    """Per item: events, distinct sessions, mean type id ("buy ratio") and
    the share of each event type."""
    n = F.count(F.lit(1))
    g = events.groupBy("aid").agg(
        n.alias("item_item_count"),
        F.count_distinct("session").alias("item_user_count"),
        (F.sum("type").cast("double") / n.cast("double")).alias("item_buy_ratio"),
        F.count_if(F.col("type") == TYPE_IDS["clicks"]).alias("_c0"),
        F.count_if(F.col("type") == TYPE_IDS["carts"]).alias("_c1"),
        F.count_if(F.col("type") == TYPE_IDS["orders"]).alias("_c2"),
    )
    share = lambda c: (F.col(c).cast("double") / F.col("item_item_count").cast("double"))
    return g.select(
        F.col("aid").alias("item"),
        "item_item_count",
        "item_user_count",
        "item_buy_ratio",
        share("_c0").alias("item_clicks"),
        share("_c1").alias("item_carts"),
        share("_c2").alias("item_orders"),
        F.col("item_item_count").alias("item_events"),
    )


def user_features(history: DataFrame) -> DataFrame:
    """Per session: events, distinct items, mean type id, events again."""
    n = F.count(F.lit(1))
    return history.groupBy("session").agg(
        n.alias("user_user_count"),
        F.count_distinct("aid").alias("user_item_count"),
        (F.sum("type").cast("double") / n.cast("double")).alias("user_buy_ratio"),
        n.alias("num_events"),
    ).withColumnRenamed("session", "user")


def candidate_features(cands: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Left join item and user features; unmatched features become 0."""
    j = cands.join(items, "item", "left").join(users, "user", "left")
    return j.fillna(0, subset=ITEM_FEATURES + USER_FEATURES)


def candidate_labels(cands: DataFrame, truth: DataFrame, target: str) -> DataFrame:
    """Add a 0/1 column named ``target``: 1 when the item is in the user's
    truth for that type. Truth is de-duplicated first, so candidate rows never
    multiply."""
    pos = (
        truth.where(F.col("type") == target)
        .select(F.col("session").alias("user"), F.col("aid").alias("item"))
        .distinct()
        .withColumn(target, F.lit(1))
    )
    return cands.join(pos, ["user", "item"], "left").withColumn(target, F.coalesce(F.col(target), F.lit(0)))


def recency_features(history: DataFrame, bound_by: DataFrame | None = None) -> DataFrame:
    """Per history event: session length, reverse position and a log-spaced
    recency score ``2^(0.1 + 0.9 * (L - a - 1) / (L - 1)) - 1`` (1 when L = 1).

    The score is rounded to micro-units so it is identical across engines.
    """
    e = ranked_within(history, ["session"], "ts", ["pos"], rank_col="_rn", count_col="session_length",
                      bound_by=bound_by)
    e = e.withColumn("action_num_reverse_chrono", F.col("session_length") - F.col("_rn"))
    L, a = F.col("session_length"), F.col("action_num_reverse_chrono")
    score = F.when(L == 1, F.lit(1.0)).otherwise(position_weight(L - a - 1, L, 0.1))
    return e.withColumn("log_recency_score", to_micro(score).cast("double") / F.lit(float(MICRO))).drop("_rn")


def last_typed_event(recency: DataFrame, target: str) -> DataFrame:
    """Last event of the target type per ``(user, item)`` with its recency
    features: ``(user, item, ts, type, session_length, action_num_reverse_chrono, log_recency_score)``."""
    r = recency.where(F.col("type") == TYPE_IDS[target])
    # the last event is the one nearest the end of the session; one
    # ``max_by`` per column with an integer ordering keeps a hash aggregate
    last = F.col("action_num_reverse_chrono")
    cols = ["ts", "type", *RECENCY_FEATURES]
    g = r.groupBy("session", "aid").agg(*[F.min_by(c, last).alias(c) for c in cols])
    return g.select(F.col("session").alias("user"), F.col("aid").alias("item"), *cols)


def ranker_frame(cands: DataFrame, last: DataFrame) -> DataFrame:
    """Join the recency features; missing ones become -1 (``ts``/``type`` stay null)."""
    j = cands.join(last, ["user", "item"], "left")
    return j.fillna(-1, subset=["session_length", "action_num_reverse_chrono"]).fillna(-1.0, subset=["log_recency_score"])


def downsample_negatives(frame: DataFrame, target: str, neg_frac: float, seed: int = 42) -> DataFrame:
    """All positives plus the negatives whose ``(user, item)`` hash falls
    below ``neg_frac`` - a repeatable, per-row decision (no shuffle)."""
    m = 1_000_003
    key = F.pmod(F.col("user"), F.lit(m)) * F.lit(7919) + F.pmod(F.col("item").cast("long"), F.lit(m))
    keep = (F.col(target) == 1) | (hash_unit(key, seed=seed) < F.lit(float(neg_frac)))
    return frame.where(keep)


def label_density(frame: DataFrame, target: str) -> DataFrame:
    return frame.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(target).cast("long").alias("n_pos"),
        (F.sum(target).cast("double") / F.count(F.lit(1)).cast("double")).alias("density"),
    )
