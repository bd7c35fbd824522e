"""Spark session defaults and the shared scratch location.

Everything that writes intermediate data (cut lineage, period reloads in the
bindings) goes under the folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent (local tests) do we pick a folder ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # generated methods beyond this many bytes are never compiled by the JVM, only
    # interpreted: such a stage runs operator by operator, in methods of bounded size
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "wardflow",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Session-level settings the operators rely on (runtime-settable ones)."""
    for k in ("spark.sql.session.timeZone",
              "spark.sql.sources.partitionOverwriteMode",
              "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(k, DEFAULT_CONF[k])


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint folder) from
    the session.  Only in local mode, where driver and executors are one
    process, may neither be set: a local folder is then chosen.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="wardflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder (or at
    ``path``) and read it back: cuts the lineage like ``checkpoint()`` (the
    data survives executor loss) with a columnar, compressed copy."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


#: Rows of a few short columns that one task of a keyed aggregation takes, about.
ROWS_A_TASK = 250_000


def spread(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """``df`` hashed by ``keys`` into tasks of some ``ROWS_A_TASK`` rows, however many
    there are (``rows``, or a count of ``df``).  An aggregation by the keys needs no other
    shuffle then, and its memory follows neither the size of a file split nor that of a
    merged shuffle partition.  For keys that hardly repeat: nothing is combined before."""
    n = df.count() if rows is None else rows
    return df.repartition(max(1, -(-n // ROWS_A_TASK)), *keys)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing will read again."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
