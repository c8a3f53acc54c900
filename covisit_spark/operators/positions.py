"""Exact rank of each row within its group, without one task per hot group.

A plain ``row_number() OVER (PARTITION BY session ORDER BY ts, pos)`` sends a
whole session to one task; a session holding a third of the log would make
that task a third of the job. ``ranked_within`` splits such groups:

1. one partial aggregate gives every group's size and time range;
2. groups larger than ``bucket_rows`` get a time-bucket width so that a bucket
   holds about ``bucket_rows`` rows on average (the number of such groups is
   at most ``rows / bucket_rows``; it is counted, and the table is broadcast
   by the engine below its own limit, else joined by shuffle);
3. rows are counted per ``(group, bucket)``; a running sum over the buckets of
   a group gives each bucket's offset;
4. the rank is ``offset + row_number`` within ``(group, bucket)``, so the
   window's partitions are buckets, not groups.

Buckets follow the order key, so the result equals the plain window. When no
group exceeds ``bucket_rows`` the plain window is used directly.
"""

from __future__ import annotations

import os
import weakref
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# rows per bucket of a split group; the environment override lets tests force
# the split path on small tables
BUCKET_ROWS = int(os.environ.get("COVISIT_BUCKET_ROWS", 2_000_000))
_LAST_BUCKET = 1 << 62
_CHECKS: "weakref.WeakKeyDictionary[DataFrame, dict]" = weakref.WeakKeyDictionary()


def hot_group_count(df: DataFrame, keys: Sequence[str], bucket_rows: int | None = None) -> int:
    """Number of groups of ``df`` with more than ``bucket_rows`` rows.

    One partial aggregate and a count of a small result; memoised per frame,
    so several rankings over the same (or a derived, never larger) input pay
    for one check.
    """
    bucket_rows = bucket_rows or BUCKET_ROWS
    memo = _CHECKS.setdefault(df, {})
    k = (tuple(keys), bucket_rows)
    if k not in memo:
        memo[k] = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bucket_rows).count()
    return memo[k]


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_k_{k}" for k in keys})


def _same(keys: list[str]) -> Column:
    """Null-safe equality of the keys with the renamed ones."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return out


def ranked_within(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tiebreak: Sequence[str] = (),
    descending: bool = False,
    rank_col: str = "rn",
    count_col: str | None = "n",
    bucket_rows: int | None = None,
    bound_by: DataFrame | None = None,
    max_broadcast_groups: int | None = None,
) -> DataFrame:
    """Add ``rank_col`` (1-based, by ``order_col`` then ``tiebreak``; nulls
    last) and optionally ``count_col`` (rows of the group).

    ``order_col`` must be an integer column (epoch seconds, positions).
    ``bound_by`` is a frame whose group sizes bound those of ``df`` (e.g. the
    events a per-item table was aggregated from); the hot-group check runs on
    it once and is reused.
    """
    keys = list(keys)
    bucket_rows = bucket_rows or BUCKET_ROWS
    direction = (lambda c: F.col(c).desc_nulls_last()) if descending else (lambda c: F.col(c).asc_nulls_last())
    order = [direction(order_col)] + [direction(c) for c in tiebreak]
    by_key = Window.partitionBy(*keys)

    if hot_group_count(bound_by if bound_by is not None else df, keys, bucket_rows) == 0:
        out = df.withColumn(rank_col, F.row_number().over(by_key.orderBy(*order)))
        if count_col:
            out = out.withColumn(count_col, F.count(F.lit(1)).over(by_key))
        return out

    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(order_col).alias("_t0"), F.max(order_col).alias("_t1")
    )
    big = stats.where(F.col("_n") > bucket_rows).select(
        *keys,
        "_t0",
        "_t1",
        F.greatest(F.lit(1), F.expr(f"((_t1 - _t0 + 1) * {int(bucket_rows)}) div _n")).alias("_w"),
    )
    cols = df.columns
    # no hint: the engine broadcasts the table of large groups only below its own measured limit
    side = _renamed(big, keys)
    if max_broadcast_groups == 0:  # a caller can rule the broadcast out
        side = side.hint("merge")
    e = df.alias("e").join(side, _same(keys), "left").select("e.*", "_t0", "_t1", "_w")
    # bucket index along the order: ascending from t0, or descending from t1
    dist = (F.col("_t1") - F.col(order_col)) if descending else (F.col(order_col) - F.col("_t0"))
    bucket = F.when(F.col("_w").isNull(), F.lit(0)).when(F.col(order_col).isNull(), F.lit(_LAST_BUCKET)).otherwise(
        F.floor(dist / F.col("_w")).cast("long")
    )
    e = e.withColumn("_b", bucket.cast("long"))
    per_bucket = e.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = by_key.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *keys,
        "_b",
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
        F.sum("_c").over(by_key).alias("_n"),
    )
    e = e.select(*cols, "_b")
    # null keys are a group like any other
    e = e.join(_renamed(offsets, [*keys, "_b"]), _same([*keys, "_b"])).select(*cols, "_b", "_off", "_n")
    local = Window.partitionBy(*keys, "_b").orderBy(*order)
    out = e.withColumn(rank_col, (F.col("_off") + F.row_number().over(local)).cast("int"))
    if count_col:
        out = out.withColumn(count_col, F.col("_n"))
    return out.drop("_b", "_off", "_n")
