"""Helpers shared by the training-data operators: stage tables, word columns, labels."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covisit_spark.session import shuffles_dropped

# The six white-space characters that separate words.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a private one only for a local session that has none."""
    try:
        path = spark.conf.get("spark.checkpoint.dir")
    except PySparkException:
        path = None
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-stage-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table or folder ``name`` in the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table, partitioned by column ``by`` if given, in the shared folder and read it back.

    Cuts the lineage: an executor that is lost later costs no rows of the table, and shuffles made for it are removed.
    """
    path = new_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stage_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``stage`` that no later job reads."""
    for table in tables:
        spark, path = table.sparkSession, getattr(table, "stage_path", None)
        if path:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound the Arrow batches that Python tasks get, as one text may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def words(text: Column) -> Column:
    """Words of a text, split at white space; none for null and blank texts."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words of a text, in order."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, y): one row per labelled document; the smaller label where rows disagree, none where null."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.col(column)).cast("int").alias("y"))
    )


def fold(doc_id: Column, folds: int = 4) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def bounded_sample(df: DataFrame, limit: int, key: str = "doc_id", seed: int = 0) -> DataFrame:
    """At most about ``limit`` rows of ``df``, chosen by a hash of ``key``: all rows while there are no more.

    Only for fitting models; the bound is the caller's documented parameter.
    """
    n = df.count()
    if n <= limit:
        return df
    buckets = 1 << 30
    return df.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(buckets)) < int(buckets * limit / n))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
