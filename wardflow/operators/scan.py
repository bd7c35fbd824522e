"""Forward fill ("carry the last header value down") as a parallel scan.

A plain ``last_value(x) IGNORE NULLS OVER (PARTITION BY file ORDER BY row)``
puts a whole file (or a whole user) in one task.  Instead the rows are cut
into blocks that are monotone in the row order (the file split, a day, …):

1. inside each (partition, block): running ``last_value`` — bounded by the
   block size;
2. per block: its last non-NULL value (a map-side combined aggregate);
3. per partition: the value carried into each block = last non-NULL summary
   of the earlier blocks — a window over *block summaries* only;
4. join the carry back on (partition, block) and ``coalesce``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.session import materialize


def range_blocks(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                 num_blocks: int | None = None, name: str = "__blk") -> DataFrame:
    """Size-bounded blocks that are monotone in ``(partition_by, order_by)``:
    range-partition on that order and use the partition index as the block.
    A key holding a third of all rows is spread over many ordered blocks.

    The blocked rows are stored in the shared folder and read back: bounds are
    sampled anew each time a range partitioning runs, so a plan that ran it
    twice could give one row two blocks."""
    n = num_blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *partition_by, *order_by)
                         .withColumn(name, F.spark_partition_id()), "blocks")


def forward_fill(df: DataFrame, values: Sequence[str], *, partition_by: Sequence[str],
                 order_by: Sequence[str], block_by: str | None = None,
                 suffix: str = "") -> DataFrame:
    """Replace each of ``values`` (or add ``<value><suffix>``) with the last
    non-NULL value at or before the row in ``order_by`` order, per
    ``partition_by``.  ``block_by`` must be non-decreasing along ``order_by``
    within a partition; when given, the work is split by block."""
    keys = list(partition_by) + ([block_by] if block_by else [])
    w = (Window.partitionBy(*keys).orderBy(*order_by)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = df.withColumns({f"__ff_{v}": F.last(F.col(v), ignorenulls=True).over(w) for v in values})
    if block_by:
        # last non-NULL value of each block: max over (order…, value) structs
        summ = df.groupBy(*keys).agg(*[
            F.max(F.when(F.col(v).isNotNull(), F.struct(*[F.col(o) for o in order_by], F.col(v).alias("__v"))))
             .getField("__v").alias(f"__blk_{v}") for v in values])
        wb = (Window.partitionBy(*partition_by).orderBy(block_by)
              .rowsBetween(Window.unboundedPreceding, -1))
        carry = summ.select(*keys, *[F.last(F.col(f"__blk_{v}"), ignorenulls=True).over(wb).alias(f"__carry_{v}")
                                     for v in values])
        out = out.join(carry, keys, "left")
        out = out.withColumns({f"__ff_{v}": F.coalesce(F.col(f"__ff_{v}"), F.col(f"__carry_{v}"))
                               for v in values}).drop(*[f"__carry_{v}" for v in values])
    for v in values:
        target = v + suffix
        out = out.withColumn(target, F.col(f"__ff_{v}")).drop(f"__ff_{v}")
    return out


def next_in_order(df: DataFrame, values: Sequence[str], *, partition_by: Sequence[str],
                  order_by: Sequence[str], block_by: str, prefix: str = "prox_") -> DataFrame:
    """``lead`` by one row per ``partition_by`` in ``order_by`` order, computed
    per bounded block: inside a block the next row is a window ``lead``; the
    last row of a block takes the first row of the next non-empty block of the
    same partition (block heads are aggregated, then a window runs over the
    heads only).  ``block_by`` must be non-decreasing along ``order_by``."""
    keys = list(partition_by) + [block_by]
    w = Window.partitionBy(*keys).orderBy(*order_by)
    out = df.withColumns({f"__ld_{v}": F.lead(F.col(v)).over(w) for v in values})
    out = out.withColumn("__last", F.lead(F.lit(1)).over(w).isNull())
    heads = df.groupBy(*keys).agg(
        F.min(F.struct(*[F.col(o) for o in order_by], *[F.col(v).alias(f"__h_{v}") for v in values])).alias("__h"))
    wb = Window.partitionBy(*partition_by).orderBy(block_by)
    nxt = heads.select(*keys, *[F.lead(F.col("__h").getField(f"__h_{v}")).over(wb).alias(f"__nb_{v}") for v in values])
    out = out.join(nxt, keys, "left")
    out = out.withColumns({prefix + v: F.when(F.col("__last"), F.col(f"__nb_{v}")).otherwise(F.col(f"__ld_{v}"))
                           for v in values})
    return out.drop("__last", *[f"__ld_{v}" for v in values], *[f"__nb_{v}" for v in values])
