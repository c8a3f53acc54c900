"""Adapters from the driver's tables to the canonical event table.

Canonical events: ``session BIGINT, pos BIGINT, ts BIGINT (s), type INT, aid INT``.

* ``ev_user``  - ``events`` with one session per user.
* ``ev_5d``    - ``events`` with one session per user and 5-day bucket; used
  by the time-split operators, where whole-user sessions would all overlap
  the split point.
* ``ol_cust``  - ``orders`` joined with ``lineitem``; one session per
  customer, the volume feed of the bench.

Each adapter is a projection of a Parquet scan, so Catalyst prunes columns and
pushes the filters into the reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covisit_spark.functions import epoch_seconds

EVENT_COLUMNS = ["session", "pos", "ts", "type", "aid"]

# How the driver's ``events.event_type`` maps onto the three
# event types; ``error`` rows are not events of the session log.
EVENT_TYPE_MAP = {"view": 0, "click": 0, "signup": 1, "purchase": 2}
DROPPED_EVENT_TYPES = ["error"]
# Fixed values: ``lineitem.l_returnflag`` to event type.
RETURNFLAG_MAP = {"N": 0, "A": 1, "R": 2}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map_or_raise(c: Column, mapping: dict[str, int], what: str) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.raise_error(F.concat(F.lit(f"unknown {what}: "), c))).cast("int")


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.where(~F.col("event_type").isin(DROPPED_EVENT_TYPES))


def ev_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per user: ``session = user_id``, ``pos = event_id``."""
    ev = _event_rows(spark, sf_dir)
    return ev.select(
        F.col("user_id").cast("long").alias("session"),
        F.col("event_id").cast("long").alias("pos"),
        epoch_seconds("ts").alias("ts"),
        _map_or_raise(F.col("event_type"), EVENT_TYPE_MAP, "event_type").alias("type"),
        F.get_json_object("props", "$.k").cast("int").alias("aid"),
    )


def ev_5d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per user and 5-day bucket of the epoch day."""
    ev = ev_user(spark, sf_dir)
    return ev.withColumn(
        "session", F.expr("session * 1000 + pmod(ts div 86400, 1000) div 5")
    ).select(*EVENT_COLUMNS)


def ol_cust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as events: one session per customer, item = part.

    ``lineitem`` has no unique key, so ``pos`` is built from the columns that
    distinguish two lines of the same day: rows that tie on ``(ts, pos)``
    carry the same item and type and are interchangeable.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    typ = _map_or_raise(F.col("l_returnflag"), RETURNFLAG_MAP, "l_returnflag")
    return j.select(
        F.col("o_custkey").cast("long").alias("session"),
        ((F.col("l_partkey").cast("long") * 8 + F.col("l_linenumber")) * 4 + typ).alias("pos"),
        epoch_seconds("o_orderdate").alias("ts"),
        typ.alias("type"),
        F.col("l_partkey").cast("int").alias("aid"),
    )


FEEDS = {"ev_user": ev_user, "ev_5d": ev_5d, "ol_cust": ol_cust}


def load_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FEEDS[name](spark, sf_dir)
