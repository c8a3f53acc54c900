"""Profiling aggregates: time range, split sizes, catalogue coverage, overlap."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_time_range(events: DataFrame) -> DataFrame:
    """Min / max ``ts``, span in seconds and days, and the ``aid`` range."""
    return events.agg(
        F.min("ts").alias("t_min"),
        F.max("ts").alias("t_max"),
        F.min("aid").alias("aid_min"),
        F.max("aid").alias("aid_max"),
    ).select(
        "t_min",
        "t_max",
        (F.col("t_max") - F.col("t_min")).alias("span_s"),
        ((F.col("t_max") - F.col("t_min")).cast("double") / F.lit(86400.0)).alias("span_days"),
        "aid_min",
        "aid_max",
    )


def split_profile(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and distinct sessions of each named frame: ``(part, n_rows, n_sessions)``."""
    out = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("session").alias("n_sessions")).select(
            F.lit(name).alias("part"), "n_rows", "n_sessions"
        )
        out = one if out is None else out.unionByName(one)
    return out


def missing_items(a: DataFrame, b: DataFrame, label: str) -> DataFrame:
    """Distinct items of ``a`` absent from ``b``: counts and percentage."""
    da = a.select("aid").distinct()
    miss = da.join(b.select("aid").distinct(), "aid", "left_anti")
    n_a = da.agg(F.count(F.lit(1))).scalar()
    return miss.agg(F.count(F.lit(1)).alias("n_missing")).select(
        F.lit(label).alias("pair"),
        "n_missing",
        n_a.alias("n_a"),
        F.try_divide(F.lit(100.0) * F.col("n_missing"), n_a).alias("pct_missing"),
    )


def aid_coverage(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    out = None
    for label, (a, b) in pairs.items():
        one = missing_items(a, b, label)
        out = one if out is None else out.unionByName(one)
    return out


def session_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Number of sessions present in both frames."""
    both = a.select("session").distinct().join(b.select("session").distinct(), "session", "left_semi")
    return both.agg(F.count(F.lit(1)).alias("n_overlap"))
