"""One test per decided quirk of SURVEY §8 not covered elsewhere."""
import datetime as dt

from pyspark.sql import functions as F

from wardflow.operators import ranking
from wardflow.plans import domain

D = dt.date(2025, 3, 10)


def _visits(spark, rows):
    return spark.createDataFrame(rows, "atend_PA long, CD_PACIENTE long, DT_ATENDIMENTO date, "
                                       "DT_HR_TOTEM_RECEP timestamp_ntz, CID string, MOTIVO_ALTA string")


def test_q1_q2_visit_grain(spark):
    v = _visits(spark, [(1, 10, D, dt.datetime(2025, 3, 10, 8), "A", "ALTA"),
                        (2, 20, D, dt.datetime(2025, 3, 10, 9), "A", "ALTA")])
    links = spark.createDataFrame([(1, 100, "EMERGENCIA ADULTO"), (1, 101, "EMERGENCIA INFANTIL"),
                                   (1, 102, "AMBULATORIO")],
                                  "CD_ATENDIMENTO long, ATENDIMENTO long, ORIGEM_ATEND string")
    m = domain.assemble_visit_mart(v, None, links, None, None).collect()
    rows1 = sorted((r.atend_internacao, r.fl_conversao, r.fl_suspeito_conversao) for r in m if r.atend_PA == 1)
    assert rows1 == [(100, 1, 1), (101, 1, 1)]                 # Q2: one row per valid admission, Q18 both flags
    rows2 = [(r.atend_internacao, r.fl_conversao, r.fl_suspeito_conversao) for r in m if r.atend_PA == 2]
    assert rows2 == [(None, 0, 0)]                             # Q1: unmatched visit is not a suspect


def test_q3_movement_order(spark):
    mov = spark.createDataFrame([
        (1, "23:00:00", dt.date(2025, 3, 10), "L-EARLY", "T"), (1, "08:00:00", dt.date(2025, 3, 11), "L-LATE", "T"),
    ], "ATENDIMENTO long, HORA string, DATA date, DESTINO string, TIPO string").withColumn("UNIDADE", F.lit("U"))
    beds = spark.createDataFrame([], "Leito string, Unidade string, Tipo string")
    by_time = domain.last_movement(mov, beds).collect()[0].DESTINO
    by_date_time = domain.last_movement(mov, beds, (("DATA", "desc"), ("HORA", "desc"))).collect()[0].DESTINO
    assert (by_time, by_date_time) == ("L-EARLY", "L-LATE")


def test_q12_q21_ranking(spark):
    ind = spark.createDataFrame(
        [("S%d" % i, "p", float(i % 3), 1.0, None if i == 6 else float(i), 1.0, 1.0) for i in range(7)],
        "SERVICO string, competencia string, tx_conversao double, tx_alta_na_meta double, "
        "tempo_inicio_medico double, tx_evasao double, tx_retorno48h double")
    r = {x.SERVICO: x for x in ranking.weighted_ranking(ind, "competencia").collect()}
    assert r["S0"].conversao == r["S3"].conversao == 3                  # ties share a dense rank
    assert r["S6"].tempo_atend_medico == 1                              # NULL wait ranks first ascending
    assert r["S5"].tempo_atend_medico == 7 and r["S5"].pontos_atend_medico is None
    assert r["S5"].total_pontos is None                                 # any NULL part → NULL total
    assert r["S6"].pontos_atend_medico == 25.0


def test_q6_target_definitions_differ(spark):
    t0 = dt.datetime(2025, 3, 1, 0, 0)
    df = spark.createDataFrame([("x", "p", t0, t0 - dt.timedelta(minutes=10), 0, 0, 0),
                                ("x", "p", t0, t0 + dt.timedelta(minutes=400), 0, 0, 0)],
                               "SERVICO string, competencia string, DT_HR_TOTEM_RECEP timestamp_ntz, "
                               "DT_HR_ALTA timestamp_ntz, fl_conversao int, fl_retorno_48h int, fl_evasao int"
                               ).withColumn("INI_ATD_MEDICO", F.lit(None).cast("timestamp_ntz"))
    ind = ranking.service_indicators(df, "SERVICO", "competencia").collect()[0]
    assert ind.tx_alta_na_meta == 100.0       # ranking: negative stay excluded, 400 min = 6 whole hours
    from wardflow.functions.columns import in_target_flag
    flags = [x.f for x in df.select(in_target_flag("DT_HR_TOTEM_RECEP", "DT_HR_ALTA").alias("f")).collect()]
    assert flags == [1, 0]                    # mart flag: negative counts as met, 400 > 360 minutes
