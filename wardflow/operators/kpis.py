"""Documented measures (KPIs) over the visit mart, as aggregations.

All of them are mergeable aggregates (counts, sums, Welford moments), so the
partial aggregation runs map-side and a hot group costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.columns import in_target_flag, minutes_between
from wardflow.operators.ranking import rate
from wardflow.operators.tables import share_of_total, variation_vs_previous

# fixed values: maximum wait to the doctor by risk colour, in minutes
COLOUR_TARGET_MINUTES = {"VERMELHO": 0, "LARANJA": 10, "AMARELO": 60, "VERDE": 120, "AZUL": 240}


def period_kpis(df: DataFrame, keys: Sequence[str], *, arrival: str = "DT_HR_TOTEM_RECEP",
                doctor: str = "INI_ATD_MEDICO", discharge: str = "DT_HR_ALTA",
                conversion: str = "fl_conversao", returns: str = "fl_retorno_48h",
                evasion: str = "fl_evasao", target_minutes: int = 360) -> DataFrame:
    """K1 visits, K2 conversion, K3 in-target over all visits (NULL discharge
    = 0), K4 wait mean / sample deviation (NULL and negative waits excluded),
    K6 return and K7 evasion rates, per ``keys`` (K10: keys = period)."""
    wait = minutes_between(arrival, doctor)
    ok_wait = F.when(wait >= 0, wait)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("visitas"),
        rate(conversion).alias("tx_conversao"),
        rate(returns).alias("tx_retorno48h"),
        rate(evasion).alias("tx_evasao"),
        (F.avg(in_target_flag(arrival, discharge, target_minutes)) * F.lit(100.0)).alias("tx_alta_na_meta"),
        F.avg(ok_wait).alias("espera_media"),
        F.stddev_samp(ok_wait).alias("espera_desvio"))


def wait_target_share(df: DataFrame, keys: Sequence[str], *, colour: str = "COR_CLASSIF",
                      arrival: str = "DT_HR_TOTEM_RECEP", doctor: str = "INI_ATD_MEDICO",
                      targets: Mapping[str, int] = COLOUR_TARGET_MINUTES) -> DataFrame:
    """K5: share of visits seen by the doctor within their colour's maximum
    wait.  Only visits with a known colour target and a valid (non-NULL,
    non-negative) wait count.  The targets are a literal map: no join."""
    tmap = F.create_map(*[x for k, v in targets.items() for x in (F.lit(k), F.lit(int(v)))])
    target = F.try_element_at(tmap, F.col(colour))
    wait = minutes_between(arrival, doctor)
    evaluable = target.isNotNull() & wait.isNotNull() & (wait >= 0)
    return df.groupBy(*keys).agg(
        F.count(F.when(evaluable, F.lit(1))).alias("avaliados"),
        F.count(F.when(evaluable & (wait <= target), F.lit(1))).alias("na_meta"),
    ).withColumn("tx_na_meta", F.try_divide(F.col("na_meta"), F.col("avaliados")) * F.lit(100.0))


def shift_share(df: DataFrame, period: str, shift: str = "turno") -> DataFrame:
    """K11: visits per shift and their share of the period."""
    g = df.groupBy(period, shift).agg(F.count(F.lit(1)).alias("visitas"))
    return share_of_total(g, "visitas", [period], "participacao")


def monthly_trend(df: DataFrame, period: str, conversion: str = "fl_conversao") -> DataFrame:
    """K9 + K10: volume and conversion per period with the change against the
    previous period (window over the per-period aggregate only)."""
    g = df.groupBy(period).agg(F.count(F.lit(1)).alias("visitas"), rate(conversion).alias("tx_conversao"))
    return variation_vs_previous(g, "visitas", period, name="var_visitas")
