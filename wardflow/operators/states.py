"""Mergeable states of step durations: how often each value occurs in each detail group.

A state table is made from the visits once (and, by period, again where visits
change); every percentile of every subset of the keys and every filter on them is
then read off it, exactly, since counts of values add up.  Durations are whole
minutes, so a group has no more rows than it has distinct minutes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.operators.journey import ALL_LABEL, wide_to_long

STEP, ORDER, VALUE, COUNT = "nome_etapa", "ordem", "valor", "n"
#: Bit k is set where key k is rolled up (a key may have the label as a value of its own).
ROLLED = "agregado"


def duration_states(df: DataFrame, keys: Sequence[str], steps: Sequence[tuple]) -> DataFrame:
    """``keys, nome_etapa, ordem, valor, n`` of ``steps`` = [(label, column, ordinal), ...];
    missing durations are counted under a NULL value."""
    rows = wide_to_long(df, list(keys), steps, STEP, [VALUE], ORDER)
    return rows.groupBy(*keys, STEP, ORDER, VALUE).agg(F.count(F.lit(1)).alias(COUNT))


def merged(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The states of coarser groups."""
    return states.groupBy(*keys, STEP, ORDER, VALUE).agg(F.sum(COUNT).alias(COUNT))


def rolled_up(states: DataFrame, keys: Sequence[str], all_label: str = ALL_LABEL) -> DataFrame:
    """States of all combinations of kept and rolled-up keys (``agregado``: which).

    One key after the other: each step adds the groups without that key to those
    there are, and adds their counts up, so a step at most doubles a table that is
    already aggregated, and the visits are read once, not 2^keys times.
    """
    out = states.select(*[F.col(k).cast("string").alias(k) for k in keys], STEP, ORDER, VALUE, COUNT, F.lit(0).alias(ROLLED))
    for i, k in enumerate(keys):
        both = F.explode(F.array(F.struct(F.col(k).alias("k"), F.lit(0).alias("b")), F.struct(F.lit(all_label).alias("k"), F.lit(1 << i).alias("b"))))
        out = (out.withColumn("__both", both).withColumn(k, F.col("__both.k")).withColumn(ROLLED, F.col(ROLLED) + F.col("__both.b"))
                  .groupBy(*keys, STEP, ORDER, VALUE, ROLLED).agg(F.sum(COUNT).alias(COUNT)))
    return out


def percentiles(states: DataFrame, keys: Sequence[str], probs: dict[str, float], method: str = "discrete") -> DataFrame:
    """``keys, nome_etapa, <names of probs>, ordem`` from states of those groups (see
    ``merged``).  ``discrete``: the least value with that share of the group at or
    below it; ``interpolated``: between the two neighbouring ranks.  Groups of
    missing durations only have NULL."""
    if method not in ("discrete", "interpolated"):
        raise ValueError("method must be 'discrete' or 'interpolated'")
    group = [*keys, STEP, ORDER]
    known = F.when(F.col(VALUE).isNotNull(), F.col(COUNT)).otherwise(0)
    whole = Window.partitionBy(*group)
    upto = whole.orderBy(F.asc_nulls_first(VALUE)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = states.withColumns({"__upto": F.sum(known).over(upto), "__all": F.sum(known).over(whole)})

    def first(reached: Column) -> Column:
        return F.min(F.when(reached, F.col(VALUE))).cast("double")
    aggs = []
    for name, p in probs.items():
        if method == "discrete":
            aggs.append(first(F.col("__upto") / F.col("__all") >= p).alias(name))
        else:
            rank = F.lit(p) * (F.col("__all") - 1)
            aggs += [first(F.col("__upto") > F.floor(rank)).alias(f"__lo_{name}"), first(F.col("__upto") > F.ceil(rank)).alias(f"__hi_{name}"),
                     F.max(rank - F.floor(rank)).alias(f"__at_{name}")]
    out = run.where(F.col("__all") > 0).groupBy(*group).agg(*aggs) if aggs else run
    none = run.where(F.col("__all") == 0).select(*group).distinct()
    if method == "interpolated":
        out = out.select(*group, *[(F.col(f"__lo_{n}") + F.col(f"__at_{n}") * (F.col(f"__hi_{n}") - F.col(f"__lo_{n}"))).alias(n) for n in probs])
    out = out.unionByName(none.select(*group, *[F.lit(None).cast("double").alias(n) for n in probs]))
    return out.select(*keys, STEP, *probs, ORDER)
