"""Small table-level operators: keep-first dedup, calendar dimension,
share-of-total and period-over-period variation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.columns import month_abbrev
from wardflow.operators.link import top1


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row per key in ``order`` (row position or a full
    tie-break).  Partial top-1 runs before the shuffle, so hot keys are cheap."""
    return top1(df, keys, order)


def same_hash(a: Column, b: Column, pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Join condition: equal hashes ``a`` and ``b``, by which the rows are dealt and sorted,
    and ``pairs`` of values alike (a null is like a null), which are compared where the
    hashes are equal only (within ``least`` the planner doesn't take them for keys)."""
    return (a == b) & F.least(*[x.eqNullSafe(y) for x, y in pairs], F.lit(True))


def row_loss(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Rows in, rows out and rows lost by a step, as one small row (one
    aggregate over both inputs, tagged by side)."""
    both = (before.select(F.lit(1).alias("__antes")).unionByName(after.select(F.lit(0).alias("__antes"))))
    return (both.agg(F.sum("__antes").cast("long").alias("linhas_antes"),
                     F.count(F.when(F.col("__antes") == 0, F.lit(1))).alias("linhas_depois"))
                .select(F.lit(label).alias("etapa"), "linhas_antes", "linhas_depois",
                        (F.col("linhas_antes") - F.col("linhas_depois")).alias("linhas_removidas")))


def calendar_dim(df: DataFrame, period: str = "competencia") -> DataFrame:
    """One row per distinct period: year, month, month name, quarter, label."""
    p = F.col(period)
    return (df.select(period).distinct()
              .select(p.alias(period),
                      F.year(p).cast("long").alias("ano"),
                      F.month(p).cast("long").alias("mes"),
                      month_abbrev(F.month(p)).alias("nome_mes"),
                      F.quarter(p).cast("long").alias("trimestre"))
              .withColumn("competencia_label",
                          F.concat(F.col("nome_mes"), F.lit("/"), F.col("ano").cast("string"))))


def share_of_total(df: DataFrame, count_col: str, within: Sequence[str], name: str = "share") -> DataFrame:
    """``count / sum(count) over (within) * 100`` on an aggregated table."""
    w = Window.partitionBy(*within) if within else Window.partitionBy()
    return df.withColumn(name, F.col(count_col) / F.sum(count_col).over(w) * F.lit(100.0))


def variation_vs_previous(df: DataFrame, value: str, order: str, partition: Sequence[str] = (),
                          name: str | None = None) -> DataFrame:
    """Relative change against the previous period, in percent."""
    w = Window.partitionBy(*partition).orderBy(order) if partition else Window.orderBy(order)
    prev = F.lag(value).over(w)
    name = name or f"var_{value}"
    return (df.withColumn(f"{value}_anterior", prev)
              .withColumn(name, F.try_divide(F.col(value) - F.col(f"{value}_anterior"),
                                             F.col(f"{value}_anterior")) * F.lit(100.0)))
