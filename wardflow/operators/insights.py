"""Analyses the original plan describes without code, as
aggregations over the visit mart.  Each is a grouped count or a window over
an already aggregated table, so none holds a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.columns import minutes_whole
from wardflow.operators.scan import next_in_order, range_blocks


def pyramid(mart: DataFrame, keys: Sequence[str] = ("competencia",), age_band: str = "faixa_etaria",
            sex: str = "SEXO") -> DataFrame:
    """Demographic pyramid: visits by age band and sex."""
    return mart.groupBy(*keys, age_band, sex).agg(F.count(F.lit(1)).alias("visitas"))


def top_codes(mart: DataFrame, period: str, code: str, k: int = 10) -> DataFrame:
    """Top-k codes per period by visits (ties broken by code).  The window
    runs on the (period, code) counts, not on visits; the limit is the
    feature (a top-k report)."""
    g = mart.groupBy(period, code).agg(F.count(F.lit(1)).alias("visitas"))
    w = Window.partitionBy(period).orderBy(F.col("visitas").desc(), F.col(code).asc_nulls_first())
    return g.withColumn("posicao", F.row_number().over(w).cast("long")).where(F.col("posicao") <= k)


def demand_by_locality(mart: DataFrame, keys: Sequence[str] = ("competencia",),
                       locality: Sequence[str] = ("UF", "CIDADE")) -> DataFrame:
    return mart.groupBy(*keys, *locality).agg(F.count(F.lit(1)).alias("visitas"))


def hour_weekday(mart: DataFrame, ts: str = "DT_HR_TOTEM_RECEP", keys: Sequence[str] = ()) -> DataFrame:
    """Heat map: visits by weekday (1 = Sunday … 7 = Saturday) and hour."""
    return (mart.where(F.col(ts).isNotNull())
                .groupBy(*keys, F.dayofweek(ts).cast("long").alias("dia_semana"), F.hour(ts).cast("long").alias("hora"))
                .agg(F.count(F.lit(1)).alias("visitas")))


def destination_by_severity(mart: DataFrame, colour: str = "COR_CLASSIF", bed_type: str = "Tipo",
                            converted: str = "fl_conversao", keys: Sequence[str] = ()) -> DataFrame:
    """Converted visits by risk colour and destination type."""
    return (mart.where(F.col(converted) == 1)
                .groupBy(*keys, colour, bed_type).agg(F.count(F.lit(1)).alias("conversoes")))


def load_health(sources: Mapping[str, DataFrame], period: str, as_of: Column, sigmas: float = 2.0) -> DataFrame:
    """Per source: last period loaded, its rows, the expected band from the
    earlier periods (mean ± sigmas · sample deviation), whether the last
    volume is inside it, and days from the end of the last period to
    ``as_of``.  Windows run over per-period counts only."""
    u = None
    for name, df in sources.items():
        part = df.groupBy(F.col(period).alias("__p")).agg(F.count(F.lit(1)).alias("linhas")) \
                 .withColumn("fonte", F.lit(name))
        u = part if u is None else u.unionByName(part)
    w = Window.partitionBy("fonte").orderBy("__p")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    x = u.withColumns({
        "media_anterior": F.avg("linhas").over(earlier),
        "desvio_anterior": F.stddev_samp("linhas").over(earlier),
        "__last": F.row_number().over(Window.partitionBy("fonte").orderBy(F.col("__p").desc())),
    }).where(F.col("__last") == 1)
    lo = F.col("media_anterior") - F.lit(sigmas) * F.col("desvio_anterior")
    hi = F.col("media_anterior") + F.lit(sigmas) * F.col("desvio_anterior")
    p_end = F.last_day(F.col("__p").cast("date"))
    return x.select(
        "fonte", F.col("__p").alias("ultima_competencia"), "linhas", "media_anterior", "desvio_anterior",
        F.when(F.col("desvio_anterior").isNull(), F.lit(None).cast("int"))
         .when((F.col("linhas") >= lo) & (F.col("linhas") <= hi), F.lit(1)).otherwise(F.lit(0)).alias("dentro_faixa"),
        F.datediff(as_of.cast("date"), p_end).cast("long").alias("dias_desde_fim"))


def return_analysis(visits: DataFrame, *, patient: str, visit_id: str, arrival: str, code: str,
                    window_hours: int = 48, blocks: int | None = None) -> DataFrame:
    """Each visit with the patient's next visit: its id, code, whole minutes
    to it, whether the code is the same and whether it falls within
    ``window_hours``.  The "next visit" is a block-parallel lead, so a patient
    with a third of all visits is still spread over many tasks."""
    b = range_blocks(visits.where(F.col(patient).isNotNull()), [patient], [arrival, visit_id], blocks)
    n = next_in_order(b, [visit_id, arrival, code], partition_by=[patient], order_by=[arrival, visit_id],
                      block_by="__blk")
    # visits without a patient have no next visit, but stay in the result
    orphans = visits.where(F.col(patient).isNull()).select(
        patient, visit_id, arrival, code, *[F.lit(None).cast(visits.schema[c].dataType).alias("prox_" + c)
                                            for c in (visit_id, arrival, code)])
    n = n.select(patient, visit_id, arrival, code, *["prox_" + c for c in (visit_id, arrival, code)]) \
         .unionByName(orphans)
    mins = minutes_whole(F.col("prox_" + arrival), F.col(arrival))
    return n.select(
        patient, visit_id, arrival, code,
        F.col("prox_" + visit_id).alias("proxima_visita"), F.col("prox_" + code).alias("proximo_codigo"),
        mins.alias("minutos_ate_retorno"),
        F.when(F.col("prox_" + visit_id).isNull(), F.lit(None).cast("int"))
         .when(F.col("prox_" + code) == F.col(code), F.lit(1)).otherwise(F.lit(0)).alias("mesmo_codigo"),
        F.when(F.col("prox_" + visit_id).isNull(), F.lit(None).cast("int"))
         .when(mins <= window_hours * 60, F.lit(1)).otherwise(F.lit(0)).alias("dentro_janela"))
