"""Journey marts: wide→long reshape, milestone volumes, step percentiles.

Percentiles over ``GROUPING SETS ((detail keys), (period), ())`` are computed
by two aggregations (an Expand for the few groups of periods), not three unions.  Both percentile flavours
are mergeable per group: the exact one keeps a value→count map (durations are
whole minutes, so the map is bounded by the number of distinct minutes, not
by rows); the approximate one keeps a fixed-size sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALL_LABEL = "Todas"  # fixed label for the rolled-up keys


def wide_to_long(df: DataFrame, keys: Sequence[str], items: Sequence[tuple],
                 name_col: str, value_cols: Sequence[str], order_col: str = "ordem") -> DataFrame:
    """Unnest ``items`` = [(label, value_col or [value cols], ordinal), ...]
    into one row per item: ``keys + name_col + value_cols + order_col``."""
    structs = []
    for label, cols, ordinal in items:
        cols = [cols] if isinstance(cols, str | Column) else list(cols)
        fields = [F.lit(label).alias(name_col)]
        fields += [(F.col(c) if isinstance(c, str) else c).alias(v) for c, v in zip(cols, value_cols)]
        fields.append(F.lit(ordinal).alias(order_col))
        structs.append(F.struct(*fields))
    return df.select(*keys, F.inline(F.array(*structs)))


def step_volumes(df: DataFrame, keys: Sequence[str], milestones: Sequence[tuple],
                 name_col: str = "nome_etapa", value_col: str = "volume",
                 order_col: str = "ordem") -> DataFrame:
    """Count of non-NULL milestone timestamps per group, one row per milestone.

    ``milestones`` = [(label, column, ordinal), ...].
    """
    aggs = [F.count(F.col(c)).alias(f"__v{i}") for i, (_, c, _) in enumerate(milestones)]
    wide = df.groupBy(*keys).agg(*aggs)
    items = [(label, f"__v{i}", o) for i, (label, _, o) in enumerate(milestones)]
    return wide_to_long(wide, keys, items, name_col, [value_col], order_col)


def _pct(col: str, p: float, method: str, accuracy: int) -> Column:
    if method == "exact":
        return F.expr(f"percentile_disc({p}) within group (order by `{col}`)").cast("double")
    if method == "interpolated":
        return F.percentile(F.col(col), F.lit(p)).cast("double")
    return F.percentile_approx(F.col(col), F.lit(p), accuracy).cast("double")


def _pcts(col: str, probs: Sequence[float], method: str, accuracy: int) -> Column:
    """The percentiles of a column as an array.  A sketch is made once for all of them."""
    if method in ("exact", "interpolated"):
        return F.array(*[_pct(col, p, method, accuracy) for p in probs])
    return F.percentile_approx(F.col(col), list(probs), accuracy).cast("array<double>")


def step_percentiles(df: DataFrame, detail_keys: Sequence[str], period: str,
                     steps: Sequence[tuple], probs: Sequence[float] = (0.5, 0.9),
                     names: Sequence[str] = ("p50", "p90"), method: str = "exact",
                     accuracy: int = 10000, all_label: str = ALL_LABEL,
                     name_col: str = "nome_etapa", order_col: str = "ordem",
                     cube: bool = False) -> DataFrame:
    """Percentiles of each step per detail group, per period, and overall.

    ``detail_keys`` must include ``period``; the others are labelled
    ``all_label`` when rolled up (decided by ``grouping()``, never by NULL,
    since keys can be NULL themselves).  The overall row has period NULL.
    ``steps`` = [(label, duration column, ordinal), ...].  ``cube=True`` adds
    every combination of rolled-up keys within each period (an ``all_label``
    row per dimension); it multiplies the rows by 2^(keys) before the
    aggregation, so it is an option, not the default.
    """
    others = [k for k in detail_keys if k != period]
    aggs = [_pcts(c, probs, method, accuracy).alias(f"__s{i}") for i, (_, c, _) in enumerate(steps)]
    if cube:
        from itertools import combinations
        sets = [[period, *c] for r in range(len(others) + 1) for c in combinations(others, r)] + [[]]
        grouped = df.groupingSets(sets, *detail_keys).agg(*aggs, *[F.grouping(k).alias(f"__g_{k}") for k in others])
    else:
        # apart: the few groups of periods are held in memory, only those of detail are sorted
        detail = df.groupBy(*detail_keys).agg(*aggs, *[F.lit(0).alias(f"__g_{k}") for k in others])
        few = df.groupingSets([[period], []], period).agg(*aggs, *[F.lit(1).alias(f"__g_{k}") for k in others])
        grouped = detail.unionByName(few, allowMissingColumns=True)
    labelled = grouped.select(
        *[F.when(F.col(f"__g_{k}") == 1, F.lit(all_label)).otherwise(F.col(k).cast("string")).alias(k)
          if k != period else F.col(k) for k in detail_keys],
        *[f"__s{i}" for i in range(len(steps))])
    items = [(label, [F.get(f"__s{i}", j) for j in range(len(probs))], o)
             for i, (label, _, o) in enumerate(steps)]
    return wide_to_long(labelled, list(detail_keys), items, name_col, list(names), order_col)


def ranked_percentiles(df: DataFrame, group: str, value: str, probs: dict[str, float], num_blocks: int | None = None) -> DataFrame:
    """Interpolated percentiles of a continuous value, without a buffer of a
    group's values: counts per (group, value), running counts inside ordered
    blocks, block totals carried across blocks, and the two neighbouring ranks
    picked from them.  NULL values are left out; a group of NULLs gives NULL."""
    from wardflow.operators.scan import range_blocks
    counts = df.groupBy(group, value).agg(F.count(value).alias("__c"))
    blocks = range_blocks(counts.where(F.col("__c") > 0), [group], [value], num_blocks)
    inside = Window.partitionBy(group, "__blk").orderBy(value)
    totals = blocks.groupBy(F.col(group).alias("__g"), F.col("__blk").alias("__b")).agg(F.sum("__c").alias("__t"))
    totals = totals.select("__g", "__b", F.coalesce(F.sum("__t").over(Window.partitionBy("__g").orderBy("__b").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"), F.sum("__t").over(Window.partitionBy("__g")).alias("__n"))
    run = blocks.withColumn("__cum", F.sum("__c").over(inside))
    run = run.join(totals, run[group].eqNullSafe(totals["__g"]) & (run["__blk"] == totals["__b"]))
    end = F.col("__base") + F.col("__cum")
    aggs = []
    for name, p in probs.items():
        rank = F.lit(p) * (F.col("__n") - 1)
        for side, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            aggs.append(F.max(F.when((end - F.col("__c") <= at) & (at < end), F.col(value))).alias(f"__{side}_{name}"))
    picked = run.groupBy(group).agg(F.max("__n").alias("__n"), *aggs)
    out = picked.select(group, *[
        (F.col(f"__lo_{n}") + (F.lit(p) * (F.col("__n") - 1) - F.floor(F.lit(p) * (F.col("__n") - 1)))
         * (F.col(f"__hi_{n}") - F.col(f"__lo_{n}"))).alias(n) for n, p in probs.items()])
    groups = df.select(F.col(group).alias("__g")).distinct()
    return groups.join(out, groups["__g"].eqNullSafe(out[group]), "left").drop(group).withColumnRenamed("__g", group)
