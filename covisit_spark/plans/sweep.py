"""Ranker sweeps over nested configurations, with a result table that a stopped sweep goes on from.

A configuration has data options (``neg_frac``, ``num_avg``, ``eval_at``) and, under ``model``, one combination of
model options. Its row in the result table is a partition named by a hash of the configuration, written once all its models are
trained; a configuration whose partition is complete is not run again. The fold models are stored beside it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covisit_spark.operators import evaluate as ev
from covisit_spark.operators import features as ft
from covisit_spark.operators import lambdarank as lr
from covisit_spark.operators import ranker as rk
from covisit_spark.plans.offline import Offline
from covisit_spark.sources import sinks

DEFAULTS = {"num_avg": 1, "neg_frac": 0.3, "eval_at": 20}
TARGETS = ("carts", "orders")
RESULT = (
    "params string, r_clicks double, r_carts double, r_orders double, recall double, "
    "map_carts double, map_orders double, rounds_carts int, rounds_orders int"
)


def nested_grid(options: Mapping[str, Sequence], model: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of data options with every combination of model options."""
    inner = rk.param_grid(model)
    return [{**DEFAULTS, **outer, "model": m} for outer in rk.param_grid(options) for m in inner]


def config_key(config: Mapping) -> str:
    """The same for equal configurations, whatever the order of their options."""
    return hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()[:16]


def _model_path(path: str, config: Mapping, target: str, fold: int) -> str:
    return f"{path}/models/{config_key(config)}/{target}-{fold}"


def rerank(offline: Offline, path: str, config: Mapping, depth: int = 20) -> DataFrame:
    """Predictions (session, type, aid, rank) with carts and orders ranked by the stored models of ``config``."""
    out = offline.clicks(depth).select("session", F.lit("clicks").alias("type"), "aid", "rank")
    for target in TARGETS:
        paths = [_model_path(path, config, target, f) for f in range(config["num_avg"])]
        ranked = rk.rank_top(lr.score_stored(offline.spark, paths, offline.ranker_inputs(target)), depth)
        out = out.unionByName(ranked.select(F.col("user").alias("session"), F.lit(target).alias("type"), F.col("item").alias("aid"), "rank"))
    return out


def evaluate_config(offline: Offline, path: str, config: Mapping) -> tuple:
    """Train and store the fold models of ``config``; its result row.

    MAP is the mean over folds of the last 20 rounds of the validation curve; recall is that of the lists ranked by the mean of
    the fold models.
    """
    maps, rounds = {}, {}
    for target in TARGETS:
        frame = ft.downsample_negatives(offline.ranker_inputs(target), target, config["neg_frac"])
        models = lr.train_folds(frame, target, config["num_avg"], params={**config["model"], "k": config["eval_at"]})
        for f, m in enumerate(models):
            lr.save_model(offline.spark, m, _model_path(path, config, target, f))
        maps[target] = sum(lr.last_mean(m.curve) for m in models) / len(models)
        rounds[target] = max(len(m.trees) for m in models)
    r = ev.weighted_recall(ev.recall_by_type(ev.recall_hits(rerank(offline, path, config), offline.truth))).first()
    recall = (float(x or 0.0) for x in (r["r_clicks"], r["r_carts"], r["r_orders"], r["recall"]))
    return (json.dumps(config, sort_keys=True), *recall, maps["carts"], maps["orders"], rounds["carts"], rounds["orders"])


def run_sweep(
    offline: Offline, configs: Sequence[Mapping], path: str, evaluate: Callable[[Offline, str, Mapping], tuple] = evaluate_config
) -> DataFrame:
    """The result table at ``path``, after running every one of ``configs`` that it does not hold yet."""
    spark = offline.spark
    for config in configs:
        at = f"{path}/results/config={config_key(config)}"
        sinks.build_if_absent(spark, at, lambda c=config: spark.createDataFrame([evaluate(offline, path, c)], RESULT))
    return results(spark, path)


def results(spark: SparkSession, path: str) -> DataFrame:
    """One row a finished configuration: ``config`` (its key), options and metrics."""
    return spark.read.schema(f"{RESULT}, config string").parquet(f"{path}/results")
