"""Benchmark the headline queries.

Runs each query to completion (``noop`` sink, so every column is computed and
nothing is collected) on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from covisit_spark.operators import covisit as cv  # noqa: E402
from covisit_spark.operators import evaluate as ev  # noqa: E402
from covisit_spark.operators import split  # noqa: E402
from covisit_spark.plans.offline import Offline  # noqa: E402
from covisit_spark.session import get_spark  # noqa: E402
from covisit_spark.sources.feeds import ev_5d, ol_cust  # noqa: E402


def headline(spark, sf):
    """name -> DataFrame factory."""
    return {
        "covisit_clicks_orders": lambda: cv.covisit_clicks(ol_cust(spark, sf)),
        "covisit_carts_orders": lambda: cv.covisit_carts(ol_cust(spark, sf)),
        "covisit_b2b_orders": lambda: cv.covisit_b2b(ol_cust(spark, sf)),
        "val_split_5d": lambda: split.cutoff_split(
            split.remove_overlap(*reversed(split.time_split(ev_5d(spark, sf))))
        )[0],
        "predictions_user": lambda: Offline(spark, sf).predictions(),
        "predictions_orders": lambda: Offline(spark, sf, feed="ol_cust").predictions(),
        "weighted_recall_user": lambda: ev.weighted_recall(
            ev.recall_by_type(ev.recall_hits(Offline(spark, sf).predictions(), Offline(spark, sf).truth))
        ),
        "ranker_frame_user": lambda: Offline(spark, sf, num_cands=50).candidate_frame("carts"),
        "weighted_recall_time_split": lambda: ev.weighted_recall(
            ev.recall_by_type(
                ev.recall_hits(
                    Offline(spark, sf, feed="ev_5d", time_split=True).predictions(),
                    Offline(spark, sf, feed="ev_5d", time_split=True).truth,
                )
            )
        ),
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # JVM / code-generation warm-up, not timed: the same queries once on the
    # smallest tables (a different input path, so no stage output is reused)
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf):
        for make in headline(spark, warm).values():
            make().write.format("noop").mode("overwrite").save()
    times = {}
    for name, make in headline(spark, sf).items():
        t = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
