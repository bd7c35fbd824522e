"""Control tables of the lake: small facts that batches write about themselves,
each batch in a folder of its own, so that a repeated batch replaces what it wrote
before and adds nothing; and claims, of which only one writer gets each."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Sequence
from functools import lru_cache
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import checkpoint_root
from wardflow.sources.reports import read_or_empty

WRITER, EPOCH = "escritor", "lote"


def control_path(root: str, table: str) -> str:
    return os.path.join(root, "_controle", table)


def record(rows: DataFrame, root: str, table: str, writer: str, epoch: int) -> DataFrame:
    """Store what batch ``epoch`` of ``writer`` says, in place of what it said before; returns it as stored."""
    path = os.path.join(control_path(root, table), f"{WRITER}={writer}", f"{EPOCH}={epoch}")
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def recorded(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """All batches of all writers: ``schema`` and the columns ``escritor`` and ``lote``."""
    return read_or_empty(spark, control_path(root, table), f"{schema}, {WRITER} string, {EPOCH} long")


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def content(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        return bytes(stream.readNBytes(1 << 12)).decode()
    finally:
        stream.close()


def claim(spark: SparkSession, path: str, owner: str) -> bool:
    """Whether the file ``path`` is now, or was before, created by ``owner``.  A
    finished file is renamed into place, which fails if one is there (atomic on HDFS
    and in stores with such a rename), so of claims at one time one succeeds, and a
    writer that died right after it still owns what it claimed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    if not fs.exists(target):
        fs.mkdirs(target.getParent())
        draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(owner.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), conf)
        no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(target), no_overwrite)
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
    return content(spark, path) == owner


def claims(spark: SparkSession, folder: str) -> DataFrame:
    """(path, owner) of the claims in ``folder``."""
    try:
        held = spark.read.text(folder, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, owner string")
    return held.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("owner"))


# ---------------------------------------------------------------- derived tables

@lru_cache(maxsize=None)
def _code_version() -> str:
    """Of the package's modules; the training-data part uses none of this."""
    top = Path(__file__).resolve().parents[1]
    files = sorted(p for p in top.rglob("*.py") if "llm" not in p.relative_to(top).parts)
    return hashlib.sha256(b"".join(p.read_bytes() for p in files)).hexdigest()


def _files(spark: SparkSession, path: str) -> list[str]:
    """Name, size and time of every file of a table."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs, found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), []
    each = fs.listFiles(where, True)
    while each.hasNext():
        f = each.next()
        found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return sorted(found)


def derived(spark: SparkSession, name: str, inputs: Sequence[str], build: Callable[[str], None]) -> str:
    """The folder of tables that ``build(folder)`` derives from the tables ``inputs``.

    Built once for the same input files (names, sizes, times), session time zone and
    code, in the shared folder; a note that names the folder is put there when it is
    whole, so a build that was broken off is never read.  Of builds at one time
    one is noted.
    """
    facts = [_code_version(), spark.conf.get("spark.sql.session.timeZone"), *(f for i in inputs for f in _files(spark, i))]
    key = hashlib.sha256("\n".join(facts).encode()).hexdigest()[:24]
    note = os.path.join(checkpoint_root(spark), "derived", f"{name}-{key}")
    if not exists(spark, note):
        folder = f"{note}.{uuid.uuid4().hex[:12]}"
        build(folder)
        claim(spark, note, folder)
    return content(spark, note)
