"""Session-event co-visitation and next-item ranking on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, joins, aggregates and windows. The canonical event table is::

    events(session BIGINT, pos BIGINT, ts BIGINT, type INT, aid INT)

where ``ts`` is epoch seconds and ``(ts, pos)`` orders the events of a session.

Layout:
    sources/    readers for the driver tables, JSONL session logs, sinks
    functions/  column-expression helpers (weights, fixed-point scores, hashes)
    operators/  profiling, split, co-visitation, candidates, features, ranker,
                evaluation
    plans/      end-to-end flows and the query catalogue (Spark + SQL oracle)
    streaming/  incremental JSONL ingestion with Structured Streaming
"""

from covisit_spark.session import ensure_checkpoint_dir, get_spark

__all__ = ["get_spark", "ensure_checkpoint_dir"]
