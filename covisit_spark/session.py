"""Spark session settings used by the library, the tests and the bench."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import SparkSession

# Settings every job of this library relies on. UTC pins any timestamp
# rendering; AQE re-plans joins at run time (broadcast conversion by measured
# size, partition coalescing, skew-join splitting).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


# Spark then removes the shuffle files of a query as soon as it ends
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "covisit-spark",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    Without ``master`` the submitted one is kept (``spark-submit --master``, or
    all local cores where none was given).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and SparkContext._active_spark_context is None:
        # only a JVM that starts here can take it
        conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "16g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the deployment (a shared file
    system path). Only a local-mode session without it gets a private scratch
    folder, so tests and the bench can run.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            path = None
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "that every executor can reach"
            )
        path = tempfile.mkdtemp(prefix="covisit-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside go as each ends, not when the driver next collects its garbage.

    For writes of stage tables: a later query reads the table, not the shuffles it was made by.
    """
    before = spark.conf.get(FILE_CLEANUP, "false")
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(FILE_CLEANUP, before)
