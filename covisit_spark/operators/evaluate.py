"""Recall@k of candidate lists against ground truth (flat, set-based).

``hits`` = distinct predicted items that are among the first 20 *distinct*
truth items; ``gt_count`` = ``min(len(truth), 20)`` with duplicates counted.
Recall per type is a ratio of sums; the overall score weights the three
types 0.1 / 0.3 / 0.6.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covisit_spark.functions import RECALL_WEIGHTS, TYPE_NAMES


def truth_top(gt: DataFrame, k: int = 20) -> DataFrame:
    """First ``k`` distinct truth items per ``(session, type)``."""
    first = gt.groupBy("session", "type", "aid").agg(F.min("label_rank").alias("_r"))
    w = Window.partitionBy("session", "type").orderBy("_r")
    return first.withColumn("_d", F.row_number().over(w)).where(F.col("_d") <= k).select("session", "type", "aid")


def recall_hits(preds: DataFrame, gt: DataFrame, k: int = 20, depth: int | None = None) -> DataFrame:
    """``(session, type, hits, gt_count)`` for every predicted key with truth.

    ``depth`` cuts the predicted lists first (``None`` = use them whole).
    """
    p = preds if depth is None else preds.where(F.col("rank") <= depth)
    keys = preds.select("session", "type").distinct()
    counts = (
        gt.groupBy("session", "type")
        .agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("gt_count"))
        .join(keys, ["session", "type"], "left_semi")
    )
    hit = (
        p.select("session", "type", "aid").distinct()
        .join(truth_top(gt, k), ["session", "type", "aid"], "left_semi")
        .groupBy("session", "type")
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    return counts.join(hit, ["session", "type"], "left").select(
        "session", "type", F.coalesce("hits", F.lit(0)).cast("long").alias("hits"), F.col("gt_count").cast("long")
    )


def recall_by_type(hits: DataFrame) -> DataFrame:
    """``(type, hits, gt_count, recall)`` as a ratio of sums."""
    return hits.groupBy("type").agg(F.sum("hits").alias("hits"), F.sum("gt_count").alias("gt_count")).select(
        "type", "hits", "gt_count", F.try_divide(F.col("hits").cast("double"), F.col("gt_count").cast("double")).alias("recall")
    )


def weighted_recall(by_type: DataFrame, weights: Mapping[str, float] = RECALL_WEIGHTS) -> DataFrame:
    """One row: recall per type (0 when a type has no truth) and the weighted sum."""
    piv = by_type.groupBy().pivot("type", TYPE_NAMES).agg(F.first("recall"))
    cols = {t: F.coalesce(F.col(t), F.lit(0.0)) for t in TYPE_NAMES}
    total = None
    for t in TYPE_NAMES:
        term = F.lit(float(weights[t])) * cols[t]
        total = term if total is None else total + term
    return piv.select(
        cols["clicks"].alias("r_clicks"), cols["carts"].alias("r_carts"), cols["orders"].alias("r_orders"), total.alias("recall")
    )
