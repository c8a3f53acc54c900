"""Nested session logs (one JSON object per line) to canonical events.

Line format: ``{"session": 1, "events": [{"aid": 5, "ts": <ms>, "type": "clicks"}, ...]}``.
The reader uses a fixed schema (no inference pass) and FAILFAST parsing; the
line-delimited files split across tasks. ``posexplode`` keeps the position
of each event inside its line as ``pos``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covisit_spark.functions import TYPE_IDS, type_id_to_name, type_name_to_id

# ``offset`` is the position of a line's first event, where a session is on several lines; absent otherwise
SESSION_SCHEMA = "session BIGINT, offset BIGINT, events ARRAY<STRUCT<aid: INT, ts: BIGINT, type: STRING>>"


def read_sessions_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Nested sessions ``(session, offset, events)`` from JSON-lines files."""
    return spark.read.schema(SESSION_SCHEMA).option("mode", "FAILFAST").json(path)


def parse_session_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Nested sessions from a string column holding one JSON object each.

    Other columns of ``lines`` are kept."""
    keep = [c for c in lines.columns if c != col]
    p = lines.select(*keep, F.from_json(F.col(col), SESSION_SCHEMA, {"mode": "FAILFAST"}).alias("_s"))
    return p.select(*[c for c in keep if c != "offset"], "_s.session", "_s.offset", "_s.events")


def flatten_sessions(sessions: DataFrame, pos_offset: str | None = None) -> DataFrame:
    """One row per event: ``(session, pos, ts, type, aid)``.

    ``ts`` goes from milliseconds to whole seconds; the cast to a 32-bit
    integer raises (ANSI) if a value would not fit, which is the range guard.
    The type name is encoded (unknown names raise). A position counts from the line's ``offset`` (0 where it has none), or
    from another column, ``pos_offset``.
    """
    start = pos_offset or ("offset" if "offset" in sessions.columns else None)
    base = sessions.select("session", *([start] if start else []), F.posexplode("events").alias("_i", "_e"))
    first = F.coalesce(F.col(start).cast("long"), F.lit(0).cast("long")) if start else F.lit(0).cast("long")
    pos = F.col("_i").cast("long") + first
    return base.select(
        F.col("session").cast("long").alias("session"),
        pos.alias("pos"),
        F.expr("CAST(_e.ts div 1000 AS INT)").cast("long").alias("ts"),
        type_name_to_id(F.col("_e.type")).alias("type"),
        F.col("_e.aid").cast("int").alias("aid"),
    )


def sessions_to_json_lines(events: DataFrame, chunk: int = 64) -> DataFrame:
    """Nest canonical events back into JSON lines (``value`` column).

    Lines carry at most ``chunk`` consecutive ``pos`` values of a session (the
    line's ``offset`` field is the first position), so no line grows with the
    session; :func:`flatten_sessions` puts them together again. ``ts`` is written in milliseconds (with a 25 ms remainder).
    """
    e = events.withColumn("offset", F.expr(f"(pos div {int(chunk)}) * {int(chunk)}"))
    g = e.groupBy("session", "offset").agg(
        F.array_sort(F.collect_list(F.struct("pos", "aid", "ts", "type"))).alias("_l")
    )
    ev = F.transform(
        "_l",
        lambda x: F.struct(
            x["aid"].alias("aid"), (x["ts"] * F.lit(1000) + F.lit(25)).alias("ts"), type_id_to_name(x["type"]).alias("type")
        ),
    )
    return g.select("offset", F.to_json(F.struct(F.col("session"), F.col("offset"), ev.alias("events"))).alias("value"))


__all__ = ["SESSION_SCHEMA", "TYPE_IDS", "read_sessions_jsonl", "parse_session_lines", "flatten_sessions", "sessions_to_json_lines"]
