"""Sinks: Parquet tables, build-if-absent materialisation, submission CSV."""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covisit_spark.session import ensure_checkpoint_dir, shuffles_dropped

# Input a part that is multiplied by a join: some 100,000 events, a few million pairs or votes.
PART_BYTES = 2 << 20


def _fs(spark: SparkSession, path: str):
    """(Hadoop file system, path) of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _fs_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def fingerprint(df: DataFrame, *parameters: object) -> str:
    """A key of what ``df`` reads and of ``parameters``: path, size and time of each input file. Runs no job."""
    spark = df.sparkSession
    seen = []
    for f in sorted(df.inputFiles()):
        fs, p = _fs(spark, f)
        status = fs.getFileStatus(p)
        seen.append((f, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr((seen, parameters)).encode()).hexdigest()[:16]


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads. Runs no job."""
    total = 0
    for f in df.inputFiles():
        fs, p = _fs(df.sparkSession, f)
        total += fs.getFileStatus(p).getLen()
    return total


def spread(df: DataFrame, key: str, source: DataFrame) -> DataFrame:
    """``df`` dealt by ``key`` into a part for every ``PART_BYTES`` of the files of ``source``.

    For rows that are multiplied afterwards: the engine sizes parts by what is shuffled, so that a task would hold ever
    more of the products. Small inputs are left to it.
    """
    parts = -(-input_bytes(source) // PART_BYTES)
    return df.repartition(parts, key) if parts > df.sparkSession.sparkContext.defaultParallelism else df


def drop_versions(spark: SparkSession, name: str, keep: str) -> list[str]:
    """Remove all folders of the stored table set ``name`` but ``keep``; their names."""
    fs, p = _fs(spark, table_path(spark, name))
    gone = []
    for status in fs.listStatus(p) if fs.exists(p) else []:
        version = status.getPath().getName()
        if version != keep:
            fs.delete(status.getPath(), True)
            gone.append(version)
    return gone


def table_path(spark: SparkSession, name: str) -> str:
    """A table folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as the table ``name``, replacing any, and read it back: cuts the lineage."""
    path = table_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove the table ``name`` from the shared folder."""
    fs, p = _fs(spark, table_path(spark, name))
    fs.delete(p, True)


_LOCKS: dict[str, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def _lock(path: str) -> threading.Lock:
    with _LOCKS_GUARD:
        return _LOCKS.setdefault(path, threading.Lock())


def build_if_absent(spark: SparkSession, path: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None) -> DataFrame:
    """Read ``path`` when a complete table (``_SUCCESS``) is there, else build,
    write and read it back. Re-running after a lost job rebuilds only tables
    whose write did not finish; reading back cuts the lineage. A table is written
    aside and renamed, so another application sees all of it or nothing."""
    path = path.rstrip("/")
    with _lock(path):  # queries of one driver may run on several threads
        if not _fs_exists(spark, f"{path}/_SUCCESS"):
            aside = f"{path}.{uuid.uuid4().hex}"
            w = build().write
            if partition_by:
                w = w.partitionBy(*partition_by)
            with shuffles_dropped(spark):
                w.parquet(aside)
            fs, target = _fs(spark, path)
            source = _fs(spark, aside)[1]
            if not _fs_exists(spark, f"{path}/_SUCCESS"):
                fs.delete(target, True)
                fs.rename(source, target)
            else:  # another application was first
                fs.delete(source, True)
    return spark.read.parquet(path)


def submission_frame(preds: DataFrame) -> DataFrame:
    """``session_type = session_type``, ``labels`` = items joined by spaces in rank order.

    Lists are at most ``num_cands`` long, so the per-key collect is bounded.
    """
    g = preds.groupBy("session", "type").agg(F.array_sort(F.collect_list(F.struct("rank", "aid"))).alias("_l"))
    return g.select(
        F.concat_ws("_", F.col("session").cast("string"), F.col("type")).alias("session_type"),
        F.array_join(F.transform("_l", lambda x: x["aid"].cast("string")), " ").alias("labels"),
    )


def write_submission(preds: DataFrame, path: str) -> None:
    """CSV with a header, gzip-compressed part files."""
    submission_frame(preds).write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)
