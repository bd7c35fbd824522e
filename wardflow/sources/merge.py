"""Keyed merge into a stored table, by copy of the partitions it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.tables import same_hash
from wardflow.session import materialize
from wardflow.sources.reports import read_or_empty


def merge_by_key(updates: DataFrame, path: str, schema: str, keys: Sequence[str], partition: str = "competencia") -> DataFrame:
    """Rows of ``updates`` replace the stored rows of their ``keys`` (a null is a key
    too; the partition column is one of them) or are added; returns those that
    changed anything.

    Only partitions with a change are written, each whole, so the same updates
    again write nothing, and a job that is repeated ends in the same table.  Of
    updates with one key the greatest row (by its columns in order) is taken.
    """
    if partition not in keys:
        raise ValueError("a key must not move between partitions")
    spark = updates.sparkSession
    stored = read_or_empty(spark, path, schema)
    types = {f.name: f.dataType for f in read_or_empty(spark, path + "-none", schema).schema.fields}
    cols = list(types)
    stored = stored.select(*cols)
    rest = [c for c in cols if c not in keys]
    # dealt and sorted by a 64-bit hash of the keys: text keys and their nulls are
    # compared where hashes are equal only
    key = F.xxhash64(*[F.col(k).cast(types[k]) for k in keys]).alias("__h")
    new = (updates.select(*cols, key).repartition("__h").groupBy("__h", *keys).agg(F.max(F.struct(*rest)).alias("__r"))
                  .select("__h", *keys, "__r.*").select(*cols, "__h"))

    def same(a: DataFrame, b: DataFrame, names: Sequence[str]) -> Column:
        return same_hash(a["__h"], b["__key"], [(a[c], b[f"__{c}"]) for c in names])

    marked = stored.select(*[F.col(c).alias(f"__{c}") for c in cols], key.alias("__key"))
    changed = materialize(new.join(marked, same(new, marked, cols), "left_anti"), "merge-changed")
    if changed.isEmpty():
        return changed.drop("__h")
    periods = changed.select(F.col(partition).alias("__p")).distinct()
    touched = stored.join(periods, stored[partition].eqNullSafe(periods["__p"]), "left_semi").withColumn("__h", key)
    keyed = changed.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__h").alias("__key"))
    kept = touched.join(keyed, same(touched, keyed, keys), "left_anti")
    # a partition is replaced when all tasks have ended, so the stored rows are read to their end
    whole = kept.unionByName(changed).drop("__h")
    (whole.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(partition).parquet(path))
    return changed.drop("__h")
