"""Staging: materialise an intermediate result as a Parquet table in the
cluster's shared checkpoint folder (``spark.checkpoint.dir``) and continue from
the written copy.

Used to parse documents once before fanning out into many tables, and to cut
lineage before a table is overwritten by a result derived from it. A written
table survives executor loss (unlike a local checkpoint or a cache).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def _configured(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    return spark.conf.get(CONF, None) or sc.getConf().get(CONF, None) or sc.getCheckpointDir()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session's ``spark.checkpoint.dir`` (or
    the context's checkpoint folder)."""
    root = _configured(spark)
    if not root:
        raise RuntimeError(
            f"{CONF} is not set: set it to a folder every executor can reach "
            "(a distributed file system or object store path)"
        )
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the configured checkpoint folder; only where none is configured
    (tests, local runs) set ``fallback``."""
    if not _configured(spark):
        try:
            spark.conf.set(CONF, fallback)
        except Exception:  # noqa: BLE001 - some sessions refuse core settings at runtime
            pass
        spark.sparkContext.setCheckpointDir(fallback)
    return checkpoint_root(spark)


def _app_folder(spark: SparkSession) -> str:
    """This application's staging folder (so applications sharing a
    checkpoint folder never touch each other's copies)."""
    return f"{checkpoint_root(spark)}/unnestor-staging/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` in this application's staging area."""
    return f"{_app_folder(spark)}/{uuid.uuid4().hex}/{name}"


_new_path = staging_path


def stage_at(df: DataFrame, name: str, compression: str | None = None) -> tuple[DataFrame, str]:
    """``stage`` that also returns the folder, for ``unstage`` once every
    consumer of the staged copy has run. ``compression``: another codec than
    the session's."""
    spark = df.sparkSession
    path = _new_path(spark, name)
    write = df.write.mode("errorifexists")
    (write.option("compression", compression) if compression else write).parquet(path)
    return spark.read.parquet(path), path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and return a DataFrame that
    reads the written copy (column pruning and filter push-down apply to it)."""
    return stage_at(df, name)[0]


def unstage(spark: SparkSession, path: str) -> None:
    """Delete a staged copy (through the cluster's file system client, so
    any shared file system or object store works)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p.getParent(), True)


def stage_text(df: DataFrame, name: str) -> str:
    """Write a one-column text DataFrame as text files (one line per row) in
    the checkpoint folder; returns the folder path."""
    path = _new_path(df.sparkSession, name)
    df.write.mode("errorifexists").text(path)
    return path


def clear_staging(spark: SparkSession) -> None:
    """Delete the staged copies this application left in the checkpoint
    folder (intermediates of lazily returned results; call once they are
    consumed). Other applications' copies are not touched."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(_app_folder(spark))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
