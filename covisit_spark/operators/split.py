"""Time split, leak removal, per-session cutoff, ground truth and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covisit_spark.functions import hash_cutoff, type_id_to_name
from covisit_spark.operators.positions import ranked_within

WEEK_SECONDS = 7 * 86400


def _split_point(events: DataFrame, seconds: int):
    """``max(ts) - seconds`` as a scalar subquery (computed once, no join)."""
    return events.agg(F.max("ts")).scalar() - F.lit(seconds)


def time_split(events: DataFrame, holdout_seconds: int = WEEK_SECONDS) -> tuple[DataFrame, DataFrame]:
    """Train = ``ts <= max(ts) - holdout``, validation = the rest."""
    t = _split_point(events, holdout_seconds)
    return events.where(F.col("ts") <= t), events.where(F.col("ts") > t)


def tag_time_split(events: DataFrame, holdout_seconds: int = WEEK_SECONDS) -> DataFrame:
    """Events with a ``part`` column, ``train`` or ``val``."""
    t = _split_point(events, holdout_seconds)
    return events.select(
        *events.columns, F.when(F.col("ts") > t, F.lit("val")).otherwise(F.lit("train")).alias("part")
    )


def recent_window(events: DataFrame, seconds: int = 3 * WEEK_SECONDS) -> DataFrame:
    """Rolling training window ``ts > max(ts) - seconds``."""
    return events.where(F.col("ts") > _split_point(events, seconds))


def remove_overlap(val: DataFrame, train: DataFrame) -> DataFrame:
    """Drop validation sessions that also occur in train (anti join)."""
    return val.join(train.select("session").distinct(), "session", "left_anti")


def with_cutoff(events: DataFrame, seed: int = 42, mult: int = 7919) -> DataFrame:
    """Attach ``n``, ``rn`` (1-based time order) and the hash cutoff.

    Sessions with fewer than two events have no valid cutoff and are dropped
    from both history and labels.
    """
    e = ranked_within(events, ["session"], "ts", ["pos"], rank_col="rn", count_col="n")
    e = e.where(F.col("n") >= 2)
    return e.withColumn("cutoff", hash_cutoff(F.col("session"), F.col("n"), seed, mult))


def cutoff_split(events: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """History = the first ``cutoff`` events of a session; labels = the rest."""
    e = with_cutoff(events, seed)
    cols = events.columns
    return e.where(F.col("rn") <= F.col("cutoff")).select(*cols), e.where(F.col("rn") > F.col("cutoff")).select(*cols)


def session_cutoffs(events: DataFrame, seed: int = 42) -> DataFrame:
    """``(session, n, cutoff)`` for reproducibility."""
    return with_cutoff(events, seed).where(F.col("rn") == 1).select("session", "n", "cutoff")


def ground_truth(labels: DataFrame, clicks_first_only: bool = True) -> DataFrame:
    """Flat truth ``(session, type, label_rank, aid)`` in time order.

    Duplicates are kept (a label list may repeat an item). For clicks only
    the first label is kept.
    """
    gt = ranked_within(labels, ["session", "type"], "ts", ["pos"], rank_col="label_rank", count_col=None)
    gt = gt.withColumn("label_rank", F.col("label_rank").cast("int"))
    if clicks_first_only:
        gt = gt.where((F.col("type") != 0) | (F.col("label_rank") == 1))
    return gt.select("session", type_id_to_name("type").alias("type"), "label_rank", "aid")


def session_hash(session_col: str = "session", modulus: int = 1_000_003, mult: int = 2654435761, seed: int = 42):
    return F.pmod(F.pmod(F.col(session_col), F.lit(modulus)) * F.lit(mult) + F.lit(seed), F.lit(modulus))


# ranges of the hash that sessions are counted by
HASH_RANGES = 1024


def session_sample(
    events: DataFrame, fractions: Sequence[float] = (0.05, 0.1, 0.25, 0.5, 1.0), modulus: int = 1_000_003
) -> DataFrame:
    """Exact-size, nested session samples: ``(session, frac)`` rows.

    Sessions are ordered by an arithmetic hash then id; a sample of fraction
    ``f`` is the first ``round_half_even(f * N)`` sessions. One read of the
    events: the distinct sessions are counted by coarse ranges of the hash
    (``HASH_RANGES`` of them, whatever the data size; the counts and their
    prefix sums are one scalar) and ranked within each range, and a session is
    given out once for every fraction that its place is within.
    """
    width = -(-modulus // HASH_RANGES)
    s = events.select("session").distinct().withColumn("h", session_hash(modulus=modulus))
    s = s.withColumn("range", F.floor(F.col("h") / width).cast("int"))
    counts = s.groupBy("range").agg(F.count(F.lit(1)).alias("c"))
    listed = F.collect_list(F.struct("range", "c"))
    add = lambda acc, x: acc + x["c"]
    zero = F.lit(0).cast("long")
    before = F.transform(
        F.sequence(F.lit(0), F.lit(HASH_RANGES)), lambda i: F.aggregate(F.filter("l", lambda x: x["range"] < i), zero, add)
    )
    prefix = counts.agg(listed.alias("l")).select(before.alias("before")).scalar()
    place = F.get(prefix, F.col("range")) + F.row_number().over(Window.partitionBy("range").orderBy("h", "session"))
    total = F.get(prefix, F.lit(HASH_RANGES))
    each = F.explode(F.array(*[F.lit(float(f)) for f in fractions])).alias("frac")
    out = s.withColumn("_place", place).select("session", "_place", each)
    return out.where(F.col("_place") <= F.bround(F.col("frac") * total).cast("long")).select("session", "frac")


def session_lists(events: DataFrame, chunk_size: int = 1024) -> DataFrame:
    """Per-session aligned ``aids`` / ``types`` lists in time order.

    Lists are cut into chunks of ``chunk_size`` events so that no row holds an
    unbounded array: ``(session, chunk, aids, types)``.
    """
    e = ranked_within(events, ["session"], "ts", ["pos"], rank_col="_r", count_col=None)
    e = e.withColumn("_i", F.col("_r") - 1).withColumn("chunk", F.expr(f"CAST(_i div {int(chunk_size)} AS INT)"))
    g = e.groupBy("session", "chunk").agg(F.array_sort(F.collect_list(F.struct("_i", "aid", "type"))).alias("_l"))
    return g.select(
        "session",
        "chunk",
        F.transform("_l", lambda x: x["aid"]).alias("aids"),
        F.transform("_l", lambda x: x["type"]).alias("types"),
    )


def restrict_sessions(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events of the given sessions only (semi join)."""
    return events.join(sessions.select("session"), "session", "left_semi")
