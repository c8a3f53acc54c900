"""Sources and sinks: streaming ingestion, build-if-absent, submission CSV."""

import gzip
import json
import os

from conftest import events_df
from pyspark.sql import functions as F

from covisit_spark.sources import sinks
from covisit_spark.streaming import ingest_sessions


def _line(session, events):
    return json.dumps({"session": session, "events": [{"aid": a, "ts": t, "type": y} for a, t, y in events]})


def test_stream_ingest_is_incremental(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.jsonl").write_text(_line(1, [(5, 1_000_000, "clicks"), (6, 2_000_000, "orders")]) + "\n")
    q = ingest_sessions(spark, str(src), str(out), name=f"t{os.getpid()}a")
    q.awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(str(out)).collect()) == [(1, 0, 1000, 0, 5), (1, 1, 2000, 2, 6)]
    (src / "b.jsonl").write_text(_line(2, [(7, 3_000_000, "carts")]) + "\n")
    q = ingest_sessions(spark, str(src), str(out), name=f"t{os.getpid()}a")
    q.awaitTermination()
    assert spark.read.parquet(str(out)).count() == 3  # first file not re-read


def test_build_if_absent_reuses(spark, tmp_path):
    path = str(tmp_path / "t")
    calls = []

    def build():
        calls.append(1)
        return events_df(spark, [(1, 0, 0, 0, 1)])

    assert sinks.build_if_absent(spark, path, build).count() == 1
    assert sinks.build_if_absent(spark, path, build).count() == 1
    assert len(calls) == 1


def test_submission_csv(spark, tmp_path):
    preds = spark.createDataFrame([(3, "carts", 9, 2), (3, "carts", 8, 1)], "session long, type string, aid int, rank int")
    out = tmp_path / "sub"
    sinks.write_submission(preds, str(out))
    part = [f for f in os.listdir(out) if f.endswith(".csv.gz")][0]
    text = gzip.open(out / part, "rt").read().splitlines()
    assert text == ["session_type,labels", "3_carts,8 9"]


def test_build_matrices_writes_three_tables(spark, tmp_path):
    from covisit_spark.plans.offline import build_matrices

    e = events_df(spark, [(1, 0, 0, 0, 1), (1, 1, 100, 1, 2), (1, 2, 200, 2, 3)])
    m = build_matrices(spark, e, str(tmp_path / "cv"))
    assert sorted(m) == ["b2b", "carts", "clicks"]
    assert {n: t.count() for n, t in m.items()} == {"clicks": 6, "carts": 6, "b2b": 2}
    assert all(list((tmp_path / "cv" / n).glob("*/_SUCCESS")) for n in m)


def test_param_grid(spark):
    from covisit_spark.operators.ranker import param_grid, param_grid_frame

    opts = {"maxIter": [10, 20], "maxDepth": [4], "stepSize": [0.1, 0.2]}
    grid = param_grid(opts)
    assert len(grid) == 4 and grid[0] == {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1}
    rows = {tuple(r) for r in param_grid_frame(spark, opts).collect()}
    assert rows == {tuple(g.values()) for g in grid}


def test_long_sessions_come_back_from_files(spark, tmp_path):
    from covisit_spark.sources import jsonl

    rows = [(s, p, 1000 + p, p % 3, 7 * p % 50) for s, n in ((1, 200), (2, 64), (3, 65), (4, 1)) for p in range(n)]
    jsonl.sessions_to_json_lines(events_df(spark, rows)).select("value").write.text(f"{tmp_path}/lines")
    back = jsonl.flatten_sessions(jsonl.read_sessions_jsonl(spark, f"{tmp_path}/lines"))
    assert sorted(map(tuple, back.collect())) == rows


def test_stage_tables_are_keyed_by_what_they_are_built_from(spark, tmp_path):
    import shutil

    from covisit_spark.plans.offline import Offline

    data = tmp_path / "data"
    data.mkdir()
    shutil.copy("/root/testdata/sf0.001/events.parquet", data / "events.parquet")
    first = Offline(spark, str(data))
    rows = first.top_pairs.groupBy("aid_x").count().agg({"count": "max"}).first()[0]
    assert rows <= 35
    # another application, in effect: a new instance and a new session find the same tables
    path = sinks.table_path(spark, f"{Offline(spark.newSession(), str(data))._prefix}/top_pairs_1d")
    assert path == sinks.table_path(spark, f"{first._prefix}/top_pairs_1d") and sinks._fs_exists(spark, f"{path}/_SUCCESS")
    assert "app" not in first._prefix and spark.sparkContext.applicationId not in path
    (data / "events.parquet").chmod(0o644)
    shutil.copy("/root/testdata/sf0.01/events.parquet", data / "events.parquet")
    spark.catalog.refreshByPath(str(data / "events.parquet"))
    other = Offline(spark, str(data))
    assert other._prefix != first._prefix
    assert other.top_pairs.count() != first.top_pairs.count()
    assert other.drop_old_versions() == [first._version]
    assert not sinks._fs_exists(spark, path)


def test_sample_has_no_window_without_partition(spark):
    from covisit_spark.operators import split

    ev = spark.range(5000).select(F.col("id").alias("session"))
    plan = split.session_sample(ev, (0.05, 0.5))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("Subquery")[0]
    got = {r["frac"]: r["count"] for r in split.session_sample(ev, (0.05, 0.5, 1.0)).groupBy("frac").count().collect()}
    assert got == {0.05: 250, 0.5: 2500, 1.0: 5000}
