"""Service indicators and the weighted ranking built on them.

The indicator table is the output of one aggregation (services × periods), so
the rank windows run on a tiny input; they partition by period only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.columns import hours_whole, minutes_whole, rank_points

# fixed values: rank → points, for ranks 1..6
DEFAULT_POINTS = (100, 90, 70, 50, 30, 10)


@dataclass(frozen=True)
class Metric:
    column: str          # indicator column
    rank_name: str       # output rank column
    ascending: bool      # True: smaller is better
    weight: float
    points_name: str     # output points column


# fixed values: the five indicators of the specialty ranking and their weights
DEFAULT_METRICS = (
    Metric("tx_conversao", "conversao", False, 0.25, "pontos_conversao"),
    Metric("tx_alta_na_meta", "alta_na_meta", False, 0.20, "pontos_alta_meta"),
    Metric("tempo_inicio_medico", "tempo_atend_medico", True, 0.25, "pontos_atend_medico"),
    Metric("tx_evasao", "evasao", True, 0.10, "pontos_evasao"),
    Metric("tx_retorno48h", "retorno48h", True, 0.20, "pontos_retorno48h"),
)


def rate(flag: str | Column) -> Column:
    """``sum(flag) / count(*) * 100``."""
    f = F.col(flag) if isinstance(flag, str) else flag
    return F.sum(f) / F.count(F.lit(1)) * F.lit(100.0)


def positive_mean_minutes(start: str, end: str) -> Column:
    """Mean whole minutes over rows where end > start; NULL otherwise."""
    s, e = F.col(start), F.col(end)
    return F.avg(F.when(e > s, minutes_whole(e, s)))


def target_rate(start: str, end: str, target_hours: int = 6) -> Column:
    """Share of rows discharged within ``target_hours`` whole hours.

    NULL discharge counts as 0; rows with end < start are excluded from both
    numerator and denominator.  An empty denominator gives NULL.
    """
    s, e = F.col(start), F.col(end)
    num = F.sum(F.when(e.isNull(), F.lit(0))
                 .when(e < s, F.lit(None))
                 .when(hours_whole(e, s) <= target_hours, F.lit(1))
                 .otherwise(F.lit(0)))
    den = F.count(F.when(e < s, F.lit(None)).otherwise(F.lit(1)))
    return F.try_divide(num, den) * F.lit(100.0)


def service_indicators(df: DataFrame, group: str, period: str, *,
                       conversion: str = "fl_conversao", returns: str = "fl_retorno_48h",
                       evasion: str = "fl_evasao", arrival: str = "DT_HR_TOTEM_RECEP",
                       doctor: str = "INI_ATD_MEDICO", discharge: str = "DT_HR_ALTA",
                       target_hours: int = 6, exclude: Sequence[str] = ("OUTROS",)) -> DataFrame:
    """Per (group, period): conversion / return / evasion rates, mean wait to
    doctor and in-target rate.  Rows of the excluded groups (and NULL groups,
    as ``!=`` drops them) are left out."""
    keep = F.col(group).isNotNull()
    for x in exclude:
        keep = keep & (F.col(group) != x)
    return (df.where(keep).groupBy(group, period).agg(
        rate(conversion).alias("tx_conversao"),
        rate(returns).alias("tx_retorno48h"),
        rate(evasion).alias("tx_evasao"),
        positive_mean_minutes(arrival, doctor).alias("tempo_inicio_medico"),
        target_rate(arrival, discharge, target_hours).alias("tx_alta_na_meta")))


def weighted_ranking(ind: DataFrame, period: str, metrics: Sequence[Metric] = DEFAULT_METRICS,
                     points: Sequence[int] = DEFAULT_POINTS, round_to: int | None = None,
                     total_name: str = "total_pontos") -> DataFrame:
    """``dense_rank`` per period for each metric (ascending ranks put NULL
    first, descending ranks put NULL last), rank → points × weight, and the
    total (NULL when any part is NULL).

    Ranks are those of the unrounded metrics; ``round_to`` rounds only what is
    returned.
    """
    out = ind
    ranks = {}
    for m in metrics:
        order = F.col(m.column).asc_nulls_first() if m.ascending else F.col(m.column).desc_nulls_last()
        ranks[m.rank_name] = F.dense_rank().over(Window.partitionBy(period).orderBy(order)).cast("long")
    out = out.withColumns(ranks)
    out = out.withColumns({m.points_name: rank_points(m.rank_name, points).cast("double") * F.lit(float(m.weight))
                           for m in metrics})
    total = None
    for m in metrics:
        total = F.col(m.points_name) if total is None else total + F.col(m.points_name)
    out = out.withColumn(total_name, total)
    if round_to is not None:
        out = out.withColumns({m.column: F.round(F.col(m.column).cast("double"), round_to) for m in metrics})
    return out
