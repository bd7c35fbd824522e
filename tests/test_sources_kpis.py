"""Writers, curation sources, KPIs."""
import datetime as dt
import os

from pyspark.sql import functions as F

from wardflow.operators import kpis, tables
from wardflow.sources import reports


def test_write_mart_partitions_and_clusters(spark, tmp_dir):
    df = spark.createDataFrame(
        [(dt.date(2025, m, 1), s, i) for m in (1, 2) for s in ("B", "A") for i in range(5)],
        "competencia date, SERVICO string, v long")
    root = os.path.join(tmp_dir, "mart")
    reports.write_mart(df, root, cluster_by=["SERVICO"])
    parts = sorted(p for p in os.listdir(root) if p.startswith("competencia="))
    assert parts == ["competencia=2025-01-01", "competencia=2025-02-01"]
    back = spark.read.parquet(root)
    assert back.count() == 20
    # reload of one period leaves the other untouched
    reports.write_mart(df.where(F.col("competencia") == dt.date(2025, 1, 1)).limit(3), root)
    assert spark.read.parquet(root).count() == 13


def test_read_curation_missing_tables_are_empty(spark, tmp_dir):
    t = reports.read_curation(spark, tmp_dir)
    assert set(t) == set(reports.CURATION_SCHEMAS) and all(df.count() == 0 for df in t.values())


def test_route_and_period(spark):
    paths = ["s3://b/atendimentos_2025_03.xlsx", "x/internacoes_2025_04.csv", "x/movimentacoes_2025_05.csv",
             "x/locks/atendimentos_2025_03.lock", "x/outro_2025_03.csv", "x/atendimentos_internacoes_2025_03.csv",
             "x/atendimentos.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [(r.d, r.c) for r in df.select(reports.route_source("p").alias("d"),
                                         reports.period_from_path("p").alias("c")).collect()]
    assert got == [("atendimentos", "2025-03"), ("internacoes", "2025-04"), ("movimentacoes", "2025-05"),
                   (None, "2025-03"), (None, "2025-03"), ("atendimentos", "2025-03"), ("atendimentos", None)]


def test_wait_target_share_default_targets(spark):
    t0 = dt.datetime(2025, 3, 1, 8, 0)
    rows = [("VERMELHO", 0), ("VERMELHO", 1), ("LARANJA", 10), ("LARANJA", 11), ("AMARELO", 60),
            ("VERDE", 121), ("AZUL", 240), ("AZUL", -5), ("AZUL", None), ("SEM", 1)]
    df = spark.createDataFrame(
        [(c, t0, None if m is None else t0 + dt.timedelta(minutes=m)) for c, m in rows],
        "COR_CLASSIF string, DT_HR_TOTEM_RECEP timestamp_ntz, INI_ATD_MEDICO timestamp_ntz")
    r = kpis.wait_target_share(df, []).collect()[0]
    assert (r.avaliados, r.na_meta) == (7, 4)


def test_period_kpis_and_row_loss(spark):
    t0 = dt.datetime(2025, 3, 1, 8, 0)
    df = spark.createDataFrame([
        ("p", t0, t0 + dt.timedelta(minutes=10), t0 + dt.timedelta(minutes=100), 1, 0, 0),
        ("p", t0, t0 + dt.timedelta(minutes=30), None, 0, 1, 0),
        ("p", t0, t0 - dt.timedelta(minutes=5), t0 + dt.timedelta(minutes=400), 0, 0, 1),
    ], "competencia string, DT_HR_TOTEM_RECEP timestamp_ntz, INI_ATD_MEDICO timestamp_ntz, "
       "DT_HR_ALTA timestamp_ntz, fl_conversao int, fl_retorno_48h int, fl_evasao int")
    r = kpis.period_kpis(df, ["competencia"]).collect()[0]
    assert r.visitas == 3 and round(r.tx_conversao, 4) == 33.3333
    assert round(r.tx_alta_na_meta, 4) == 33.3333           # NULL discharge counts as out of target
    assert r.espera_media == 20 and round(r.espera_desvio, 6) == round((200 ** 0.5), 6)
    loss = tables.row_loss(df, df.where(F.col("fl_conversao") == 1), "filtro").collect()[0]
    assert (loss.linhas_antes, loss.linhas_depois, loss.linhas_removidas) == (3, 1, 2)
