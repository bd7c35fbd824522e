"""Curation tables and the file-arrival stream."""
import datetime as dt
import os

from pyspark.sql import functions as F

from wardflow.operators import curation
from wardflow.streaming.ingest import ingest_available, ready_from_raw


def test_corrections_wide_and_apply(spark):
    inc = spark.createDataFrame([("i1", 1), ("i2", 2), ("i3", 3)], "id_inconsistencia string, nr_atendimento long")
    imp = spark.createDataFrame([
        ("i1", "IDADE", "abc"),                     # bad integer text → original kept
        ("i1", "CONVENIO", "AAA"), ("i1", "CONVENIO", "BBB"),   # two corrections: text max
        ("i2", "DT_HR_ALTA", "11/03/2025 10:30:00"),
    ], "id_inconsistencia string, campo_afetado string, valor_imputado string")
    logic = spark.createDataFrame([
        ("d1", "i3", "conversao", dt.datetime(2025, 1, 1)),     # decision without correction
        ("d2", "i3", "evasao", dt.datetime(2025, 1, 2)),        # latest wins
    ], "id_decisao string, id_inconsistencia string, flag_prevalece string, decidido_em timestamp")
    wide = {r.nr_atendimento: r for r in curation.corrections_wide(inc, imp, logic).collect()}
    assert set(wide) == {1, 2, 3}
    assert wide[1].CONVENIO_corrigido == "BBB" and wide[3].flag_prevalece == "evasao" and wide[2].flag_prevalece is None
    visits = spark.createDataFrame([(1, 40, "SUS", None), (2, 50, "X", dt.datetime(2025, 3, 11)), (4, 1, "Y", None)],
                                   "id long, IDADE long, CONVENIO string, DT_HR_ALTA timestamp_ntz")
    out = {r.id: r for r in curation.apply_corrections(visits, curation.corrections_wide(inc, imp, logic),
                                                       id_col="id").collect()}
    assert out[1].IDADE == 40 and out[1].CONVENIO == "BBB"
    assert out[2].DT_HR_ALTA == dt.datetime(2025, 3, 11, 10, 30)
    assert out[4].CONVENIO == "Y" and out[4].flag_prevalece is None


def test_tag_decisions(spark):
    dec = spark.createDataFrame([
        ("a", "conversao", "ana", "confirmado", "9", "L1", "U", "UTI"),
        ("b", "conversao", "ana", "confirmado", "9", "", "U", "UTI"),      # missing bed
        ("c", "integridade", " ", None, None, None, None, None),          # no author
        ("d", "sequencia_temporal", "ana", None, None, None, None, None),  # imputed like integrity cases
        ("f", "nao_mapeado", "ana", None, None, None, None, None),         # class without a table
        ("e", "logica_negocio", "ana", None, None, None, None, None),
    ], "id_decisao string, tipo string, decidido_por string, decisao string, atend_internacao string, "
       "destino string, unidade string, tipo_leito string")
    got = {r.id_decisao: r.destino for r in curation.tag_decisions(dec).collect()}
    assert got == {"a": "curadoria_conversao", "b": "rejeitadas", "c": "rejeitadas", "f": "rejeitadas",
                   "d": "curadoria_imputacao_integridade", "e": "curadoria_decisao_logica"}
    probs = {(r.id_decisao, r.problema) for r in curation.validate_decisions(dec).collect()}
    assert probs == {("b", "destino_ausente"), ("c", "autor_ausente")}


def test_pending_queue(spark):
    reg = spark.createDataFrame([
        ("1", dt.date(2025, 1, 1), "pendente"), ("2", dt.date(2025, 2, 1), "pendente"),
        ("3", dt.date(2025, 3, 1), "revisado"), ("4", dt.date(2025, 2, 1), "pendente"),
    ], "id_inconsistencia string, competencia date, status string")
    newest = sorted(r.id_inconsistencia for r in curation.pending_cases(reg).collect())
    asked = sorted(r.id_inconsistencia for r in curation.pending_cases(reg, F.lit(dt.date(2025, 1, 1))).collect())
    absent = sorted(r.id_inconsistencia for r in curation.pending_cases(reg, F.lit(dt.date(2025, 3, 1))).collect())
    assert newest == ["2", "4"] and asked == ["1"] and absent == ["2", "4"]
    assert [r.competencia for r in curation.pending_periods(reg).collect()] == [dt.date(2025, 2, 1), dt.date(2025, 1, 1)]


def test_ingest_stream_is_incremental(spark, tmp_dir):
    landing, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "raw", "ckpt"))
    schema = "id long, v string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(f"{landing}/atendimentos_2025_03")
    spark.createDataFrame([(3, "c")], schema).write.parquet(f"{landing}/internacoes_2025_03")
    spark.createDataFrame([(4, "d")], schema).write.parquet(f"{landing}/locks/atendimentos_2025_03")
    spark.createDataFrame([(5, "e")], schema).write.parquet(f"{landing}/relatorio_2025_03")
    st = spark.createDataFrame([], schema).schema
    ingest_available(spark, landing, sink, ckpt, st)
    v = spark.read.parquet(f"{sink}/atendimentos")
    assert sorted(r.id for r in v.collect()) == ["1", "2"] and {r.competencia for r in v.collect()} == {"2025-03"}
    rejected = {r["__path"].split("/")[-2] for r in spark.read.parquet(f"{sink}/_rejeitados").collect()}
    assert spark.read.parquet(f"{sink}/_rejeitados").select("lote").distinct().count() == 1
    assert rejected == {"atendimentos_2025_03", "relatorio_2025_03"}   # lock file and unknown name
    # a corrected file for the same period replaces the period; old files are not read again
    spark.createDataFrame([(7, "z")], schema).write.parquet(f"{landing}/atendimentos_2025_03_v2")
    ingest_available(spark, landing, sink, ckpt, st)
    v = spark.read.parquet(f"{sink}/atendimentos")
    assert sorted(r.id for r in v.collect()) == ["7"]
    ready = ready_from_raw(spark, sink).collect()
    assert [(r.competencia, r.pronto) for r in ready] == [("2025-03", 0)]    # movements missing


def test_ingest_csv_reports(spark, tmp_dir):
    landing, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "raw", "ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "atendimentos_2025_05.csv"), "w") as f:
        f.write("CD_ATENDIMENTO,CD_PACIENTE\n1,10\n2,20\n")
    with open(os.path.join(landing, "movimentacoes_2025_05.csv"), "w") as f:
        f.write("CD_ATENDIMENTO,CD_PACIENTE\n3,30\n")
    schema = spark.createDataFrame([], "CD_ATENDIMENTO string, CD_PACIENTE string").schema
    ingest_available(spark, landing, sink, ckpt, schema, fmt="csv", options={"header": "true"})
    v = spark.read.parquet(f"{sink}/atendimentos").collect()
    assert sorted((r.CD_ATENDIMENTO, r.competencia) for r in v) == [("1", "2025-05"), ("2", "2025-05")]
    ready = {r.competencia: r.pronto for r in ready_from_raw(spark, sink).collect()}
    assert ready == {"2025-05": 0}


def test_newest_file_of_a_period_wins_within_a_batch(spark, tmp_dir):
    import time
    landing, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "raw", "ckpt"))
    schema = "id long"
    spark.createDataFrame([(1,), (2,)], schema).write.parquet(f"{landing}/atendimentos_2025_06")
    time.sleep(1.1)
    spark.createDataFrame([(9,)], schema).write.parquet(f"{landing}/atendimentos_2025_06_corrigido")
    ingest_available(spark, landing, sink, ckpt, spark.createDataFrame([], schema).schema)
    assert [r.id for r in spark.read.parquet(f"{sink}/atendimentos").collect()] == ["9"]


def test_pii_never_stored_and_movement_reports_stream(spark, tmp_dir):
    from wardflow.streaming.ingest import ingest_movement_reports
    landing, sink = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "raw")
    os.makedirs(landing)
    with open(os.path.join(landing, "atendimentos_2025_07.csv"), "w") as f:
        f.write("EMPRESA,CD_ATENDIMENTO,NM_PACIENTE,DT_NASC\nHSR,1,ANA,2000-01-01\nOUTRA,2,BIA,2001-01-01\n"
                "HSR,1,ANA2,1999-01-01\n")   # repeated id: the first row in the file is kept
    schema = spark.createDataFrame([], "EMPRESA string, CD_ATENDIMENTO string, NM_PACIENTE string, "
                                       "DT_NASC string").schema
    ingest_available(spark, landing, sink, os.path.join(tmp_dir, "ck1"), schema, fmt="csv",
                     options={"header": "true", "pathGlobFilter": "atendimentos_*"})
    v = spark.read.parquet(f"{sink}/atendimentos")
    assert "NM_PACIENTE" not in v.columns and "DT_NASC" not in v.columns
    assert [r.CD_ATENDIMENTO for r in v.collect()] == ["1"]
    assert set(v.columns) == {"EMPRESA", "CD_ATENDIMENTO", "competencia"}
    def cells(**kv):
        c = [""] * 20
        for k, x in kv.items():
            c[int(k[1:])] = x
        return ",".join(c)
    with open(os.path.join(landing, "movimentacoes_2025_07.csv"), "w") as f:
        f.write("\n".join([cells(c0="Unidade de Internação: A", c6="UTI"), cells(c0="Data:", c2="2025-07-01"),
                           cells(c1="77", c3="NOME", c10="08:00:00", c15="L1"),
                           cells(c1="78", c3="NOME", c7="09:00:00", c12="L2")]) + "\n")
    ingest_movement_reports(spark, landing, sink, os.path.join(tmp_dir, "ck2"))
    m = {r.ATEND: r for r in spark.read.parquet(f"{sink}/movimentacoes").collect()}
    assert set(m) == {"77", "78"} and m["78"].DESTINO == "L2" and m["77"].UNIDADE == "UTI"
    assert m["78"].DATA == "2025-07-01" and m["77"].competencia == "2025-07"
    assert "NM_PACIENTE" not in spark.read.parquet(f"{sink}/movimentacoes").columns
