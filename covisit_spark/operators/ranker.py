"""Learning to rank candidates with Spark ML.

The learner is MLlib's ``GBTClassifier`` (pointwise), trained distributed on
the candidate frame; all rows of a user fall into one fold. Scoring, top-k
cut and MAP@k are DataFrame windows.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covisit_spark.operators.features import FEATURES



def group_folds(frame: DataFrame, k: int = 5, mult: int = 7919, seed: int = 42) -> DataFrame:
    """``fold = pmod(user * mult + seed, k)``: every row of a user in one fold."""
    return frame.withColumn("fold", F.pmod(F.pmod(F.col("user").cast("long"), F.lit(k)) * F.lit(mult) + F.lit(seed), F.lit(k)).cast("int"))


def group_sizes(frame: DataFrame) -> DataFrame:
    """Rows per user (ranking group size) with the user's fold."""
    return frame.groupBy("user", "fold").agg(F.count(F.lit(1)).alias("n_rows"))


def param_grid(options: Mapping[str, Sequence]) -> list[dict]:
    """Cartesian product of option lists, keys in the given order."""
    keys = list(options)
    return [dict(zip(keys, values)) for values in itertools.product(*(options[k] for k in keys))]


def param_grid_frame(spark: SparkSession, options: Mapping[str, Sequence]) -> DataFrame:
    """The grid as a (small) configuration table, one row per combination."""
    return spark.createDataFrame([tuple(g.values()) for g in param_grid(options)], list(options))


DEFAULT_GBT = {"maxIter": 40, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8, "minInstancesPerNode": 20, "seed": 42}


def train_ranker(
    frame: DataFrame,
    target: str,
    features: Sequence[str] | None = None,
    valid_fold: int = 0,
    params: Mapping | None = None,
) -> PipelineModel:
    """Fit ``VectorAssembler + GBTClassifier``; the rows of ``valid_fold``
    drive early stopping (``validationIndicatorCol``)."""
    feats = list(features or [c for c in FEATURES if c in frame.columns])
    p = dict(DEFAULT_GBT)
    p.update(params or {})
    data = frame.withColumn("_valid", F.col("fold") == valid_fold).withColumn("_label", F.col(target).cast("double"))
    asm = VectorAssembler(inputCols=feats, outputCol="_features", handleInvalid="keep")
    gbt = GBTClassifier(
        featuresCol="_features", labelCol="_label", validationIndicatorCol="_valid", validationTol=0.001, **p
    )
    return Pipeline(stages=[asm, gbt]).fit(data)


def score(models: Sequence[PipelineModel], frame: DataFrame) -> DataFrame:
    """Mean positive-class probability over ``models``: adds ``score``."""
    out = frame
    cols = []
    for i, m in enumerate(models):
        name = f"_s{i}"
        out = m.transform(out).withColumn(name, vector_to_array("probability")[1]).drop(
            "_features", "rawPrediction", "probability", "prediction"
        )
        cols.append(F.col(name))
    mean = sum(cols[1:], cols[0]) / F.lit(float(len(cols)))
    return out.withColumn("score", mean).drop(*[f"_s{i}" for i in range(len(cols))])


def rank_top(scored: DataFrame, k: int = 20, score_col: str = "score") -> DataFrame:
    """Best ``k`` items per user: ``score`` desc, then ``origOrder`` (unranked
    last), then ``item``."""
    oo = F.when(F.col("origOrder") > 0, F.col("origOrder")).otherwise(F.lit(1 << 30))
    w = Window.partitionBy("user").orderBy(F.col(score_col).desc(), oo.asc(), F.col("item").asc())
    return scored.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k).select(
        "user", "item", "rank"
    )


def map_at_k(ranked: DataFrame, frame: DataFrame, target: str, k: int = 20) -> DataFrame:
    """MAP@k over users with at least one positive.

    ``AP = sum(precision@i at each hit i <= k) / min(positives, k)``, in exact
    1e-9 fixed-point units (integer division), so the mean does not depend on
    summation order. Returns one row ``(n_users, map)``.
    """
    unit = 1_000_000_000
    lab = ranked.join(frame.select("user", "item", target), ["user", "item"], "left").withColumn(
        "_hit", F.coalesce(F.col(target), F.lit(0))
    )
    w = Window.partitionBy("user").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lab = lab.where(F.col("rank") <= k).withColumn("_cum", F.sum("_hit").over(w))
    prec = lab.where(F.col("_hit") == 1).groupBy("user").agg(
        F.sum(F.expr(f"(_cum * {unit}) div rank")).alias("_sp")
    )
    npos = frame.groupBy("user").agg(F.sum(target).alias("_np")).where(F.col("_np") > 0)
    ap = npos.join(prec, "user", "left").select(
        "user", F.expr(f"coalesce(_sp, 0) div least(_np, {k})").alias("ap_units")
    )
    return ap.agg(
        F.count(F.lit(1)).alias("n_users"),
        (F.sum("ap_units").cast("double") / F.count(F.lit(1)).cast("double") / F.lit(float(unit))).alias("map"),
    )


def feature_importance(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Split-gain importances of the fitted trees, best first."""
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(zip(features, map(float, imp)), key=lambda t: -t[1])
