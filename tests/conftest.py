import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from covisit_spark.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark(master="local[4]", shuffle_partitions=4, extra_conf={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def events_df(spark, rows):
    """rows: (session, pos, ts, type, aid)."""
    return spark.createDataFrame(rows, "session long, pos long, ts long, type int, aid int")


def matrix_df(spark, nbrs):
    """nbrs: {aid_x: [aid_y, ...]} best first."""
    rows = [(x, y, 1.0, r + 1) for x, ys in nbrs.items() for r, y in enumerate(ys)]
    return spark.createDataFrame(rows, "aid_x int, aid_y int, wgt double, rank int")


def popular_df(spark, by_type):
    """by_type: {type: [aid, ...]} best first."""
    rows = [(t, a, 100 - r, r + 1) for t, aids in by_type.items() for r, a in enumerate(aids)]
    return spark.createDataFrame(rows, "type int, aid int, cnt long, rank int")


def lists(df, key="session"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append((r["rank"], r["aid"]))
    return {k: [a for _, a in sorted(v)] for k, v in out.items()}
