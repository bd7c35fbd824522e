"""End to end on golden mini-fixtures: reports → staging → visit mart → marts
→ rules → register."""
import csv
import os

import pytest
from pyspark.sql import functions as F

from wardflow.operators import tables
from wardflow.plans import domain
from wardflow.sources import reports

TS_COLS = list(domain.JOURNEY_TS)
VISIT_COLS = (["EMPRESA", "CD_ATENDIMENTO", "CD_PACIENTE", "IDADE", "SEXO", "CEP", "CIDADE", "UF", "CONVENIO",
               "ESPECIALIDADE", "DT_ATENDIMENTO"] + TS_COLS
              + ["CLASSIFICACAO", "COR_CLASSIF", "PRESTADOR", "CID", "MOTIVO_ALTA", "NM_PACIENTE"])


def visit(vid, pat, age, esp, day, arr, doc=None, alta=None, cor="AZUL", cid="A10 - GRIPE", motivo="ALTA",
          prestador="123 - DR X", empresa="HSR", cls=None):
    ts = dict.fromkeys(TS_COLS, "")
    ts["DT_HR_TOTEM_RECEP"] = arr
    if cls:
        ts["INICIO_CLASSIFICACAO"], ts["DT_HR_CLASSIF_RISCO"] = cls
    if doc:
        ts["INI_ATD_MEDICO"], ts["FIM_ATD_MEDICO"] = doc
    if alta:
        ts["DT_HR_ALTA"] = alta
    row = {"EMPRESA": empresa, "CD_ATENDIMENTO": str(vid), "CD_PACIENTE": str(pat), "IDADE": "" if age is None else str(age),
           "SEXO": "F", "CEP": "0", "CIDADE": "C", "UF": "SP", "CONVENIO": "SUS", "ESPECIALIDADE": esp,
           "DT_ATENDIMENTO": day, "CLASSIFICACAO": "x", "COR_CLASSIF": cor, "PRESTADOR": prestador, "CID": cid,
           "MOTIVO_ALTA": motivo, "NM_PACIENTE": "NOME"}
    row.update(ts)
    return [row[c] for c in VISIT_COLS]


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        if header:
            w.writerow(header)
        w.writerows(rows)


def cells(**kv):
    c = [""] * 20
    for k, v in kv.items():
        c[int(k[1:])] = v
    return c


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("ed"))
    vrows = [
        visit(1, 100, 40, "CLINICA MEDICA", "2025-03-10", "2025-03-10 08:00:00",
              doc=("2025-03-10 08:30:00", "2025-03-10 09:00:00"), alta="2025-03-10 13:00:00",
              cls=("2025-03-10 08:05:00", "2025-03-10 08:10:00")),
        visit(1, 100, 40, "CLINICA MEDICA", "2025-03-10", "2025-03-10 23:00:00"),        # duplicate id: dropped
        visit(2, 100, 40, "CLINICA MEDICA", "2025-03-11", "45727.5", cor="AMARELO1",     # Excel serial
              alta="2025-03-11 07:00:00"),                                               # discharge < arrival
        visit(3, 200, 14, "CLINICA MEDICA", "2025-03-10", "2025-03-10 19:00:00", prestador="SEM SEPARADOR",
              motivo="EVASAO"),
        visit(4, 300, 15, "GENERALISTA", "2025-03-10", "2025-03-10 02:00:00", cor=""),
        visit(5, 400, -1, "CIRURGIA GERAL", "2025-03-12", "2025-03-12 10:00:00", cid="A10 - GRIPE"),
        visit(6, 400, None, "CLINICA MEDICA", "2025-03-13", "2025-03-13 10:00:00", cid="A10 - GRIPE"),
        visit(7, 500, 30, "CLINICA MEDICA", "2025-03-10", "2025-03-10 10:00:00", empresa="OUTRA"),
    ]
    write_csv(f"{root}/landing/atendimentos_2025_03.csv", VISIT_COLS, vrows)
    arows = [  # COD_PACIENTE, ATENDIMENTO, ORIGEM_ATEND, DT_HR_ATENDIMENTO, LEITO, UNIDADE, PACIENTE
        ["100", "9001", "EMERGENCIA ADULTO", "2025-03-11 10:00:00", "L-OLD", "U-OLD", "N"],
        ["300", "9002", "AMBULATORIO", "2025-03-10 05:00:00", "L2", "U2", "N"],
        ["200", "9003", "EMERGENCIA INFANTIL", "2025-03-13 05:00:00", "L3", "U3", "N"],   # D+3: no link
    ]
    write_csv(f"{root}/landing/internacoes_2025_03.csv",
              ["COD_PACIENTE", "ATENDIMENTO", "ORIGEM_ATEND", "DT_HR_ATENDIMENTO", "LEITO", "UNIDADE", "PACIENTE"], arows)
    mrows = [
        cells(c0="Unidade de Internação: UTI", c6="UTI ADULTO"),
        cells(c0="Data:", c2="2025-03-11"),
        cells(c1="9001", c3="NOME", c10="10:00:00", c11="ADM", c13="PA", c15="LEITO-1"),    # layout A
        cells(c1="9001", c3="NOME", c7="18:00:00", c8="TRF", c10="UTI", c12="LEITO-2"),     # layout B, later
        cells(c1="9002", c3="NOME", c8="06:00:00", c9="ADM", c11="PA", c13="LEITO-3"),      # layout C
        cells(c1="9002", c3="NOME", c11="ADM"),                                            # no time: dropped
        cells(c1="Atend.", c10="10:00:00"),                                                # not numeric: dropped
    ]
    write_csv(f"{root}/landing/movimentacoes_2025_03.csv", None, mrows)
    write_csv(f"{root}/landing/movimentacoes_2025_04.csv", None,
              [cells(c1="9100", c3="N", c10="09:00:00", c15="LEITO-9")])   # no headers: nothing leaks in
    with open(f"{root}/dim_leitos.csv", "w") as f:
        f.write("Leito;Unidade;Tipo\nLEITO-1;UNID A;UTI\nLEITO-2;UNID B;UTI\nLEITO-2;UNID B;UTI\nLEITO-3;UNID C;Unidade de Internação\n")

    raw_v = reports.drop_pii(reports.read_report(spark, f"{root}/landing/atendimentos_*.csv"), list(reports.VISIT_PII))
    raw_a = reports.drop_pii(reports.read_report(spark, f"{root}/landing/internacoes_*.csv"), list(reports.ADMISSION_PII))
    # the loaders keep the first row of an id within a period before it is stored
    raw_v = tables.dedup_first(raw_v, ["competencia", "CD_ATENDIMENTO"], ["__row"])
    raw_a = tables.dedup_first(raw_a, ["competencia", "ATENDIMENTO"], ["__row"])
    raw_m = domain.movements_from_cells(reports.read_cells(spark, f"{root}/landing/movimentacoes_*.csv"))
    beds = reports.read_seed(spark, f"{root}/dim_leitos.csv", "Leito string, Unidade string, Tipo string")
    stg_v, stg_a, stg_m = domain.stage_visits(raw_v), domain.stage_admissions(raw_a), domain.stage_movements(raw_m)
    mart = domain.build_visit_mart(stg_v, stg_a, stg_m, beds).cache()
    return {"root": root, "raw_v": raw_v, "raw_a": raw_a, "raw_m": raw_m, "stg_v": stg_v, "stg_m": stg_m,
            "mart": mart, "beds": beds}


def test_movement_report(built):
    rows = {(r.ATEND, r.HORA): r for r in built["raw_m"].collect()}
    assert set(rows) == {("9001", "10:00:00"), ("9001", "18:00:00"), ("9002", "06:00:00"), ("9100", "09:00:00")}
    assert rows[("9001", "18:00:00")].DESTINO == "LEITO-2" and rows[("9002", "06:00:00")].DESTINO == "LEITO-3"
    assert rows[("9001", "10:00:00")].UNIDADE == "UTI ADULTO" and rows[("9001", "10:00:00")].DATA == "2025-03-11"
    assert rows[("9100", "09:00:00")].UNIDADE is None and rows[("9100", "09:00:00")].DATA is None
    assert {r.competencia for r in built["raw_m"].collect()} == {"2025-03", "2025-04"}
    assert "NM_PACIENTE" not in built["raw_m"].columns


def test_staging(built):
    v = {r.CD_ATENDIMENTO: r for r in built["stg_v"].collect()}
    assert sorted(v) == [1, 2, 3, 4, 5, 6]                            # other company and duplicate gone
    assert str(v[1].DT_HR_TOTEM_RECEP) == "2025-03-10 08:00:00"        # first row of the duplicate kept
    assert str(v[2].DT_HR_TOTEM_RECEP) == "2025-03-11 12:00:00"        # Excel serial
    assert v[2].COR_CLASSIF == "AMARELO" and v[3].PRESTADOR is None and v[1].PRESTADOR == "DR X"
    assert (v[3].SERVICO, v[4].SERVICO, v[5].SERVICO, v[6].SERVICO) == (
        "PEDIATRIA", "CLINICA MEDICA", "CIRURGIA GERAL", "OUTROS")


def test_visit_mart(built):
    m = {r.atend_PA: r for r in built["mart"].collect()}
    # admission 9001 (03-11 10:00): visit 2 (03-11 12:00, -120 min) beats visit 1 (03-10 08:00, +1560 min)
    assert m[2].atend_internacao == 9001 and m[2].fl_conversao == 1
    assert m[2].Destino == "LEITO-2" and m[2].Unidade == "UNID B" and m[2].Tipo == "UTI"   # last movement
    assert m[1].atend_internacao is None and m[1].fl_conversao == 0
    assert m[4].fl_suspeito_conversao == 1 and m[4].fl_conversao == 0  # non-emergency origin
    assert m[3].fl_evasao == 1 and m[3].atend_internacao is None       # D+3 is out of range
    assert m[5].fl_retorno_48h == 1 and m[6].fl_retorno_48h == 0
    assert m[1].fl_retorno_48h == 1                                    # same CID the next day
    assert m[4].COR_CLASSIF == "Ausência de Classificação" and m[5].faixa_etaria == "60 ou mais"
    assert m[1].faixa_sla == "Dentro da meta" and m[2].faixa_sla == "Registro inconsistente"
    assert m[2].minutos_permanencia_total < 0 and m[1].minutos_duracao_atendimento_medico == 30
    assert m[4].turno == "Madrugada" and m[3].turno == "Noite"


def test_marts_and_metamorphic(built):
    mart = built["mart"]
    vol = domain.volumes_mart(mart)
    totem = vol.where(F.col("nome_etapa") == "Totem").agg(F.sum("volume")).collect()[0][0]
    assert totem == mart.where(F.col("DT_HR_TOTEM_RECEP").isNotNull()).count()
    pct = domain.percentiles_mart(mart, method="exact")
    assert domain.percentile_rule(pct).count() == 0
    assert pct.where(F.col("competencia").isNull()).select("SERVICO").distinct().collect()[0][0] == "Todas"
    rk = domain.ranking_mart(mart).collect()
    assert {r.SERVICO for r in rk} <= {"PEDIATRIA", "CLINICA MEDICA", "CIRURGIA GERAL", "CARDIOLOGIA",
                                       "ORTOPEDIA/TRAUMATOLOGIA"}
    cal = domain.calendar_mart(mart).collect()
    assert [r.competencia_label for r in cal] == ["Mar/2025"]


def test_rules_and_register_idempotent(built):
    mart = built["mart"]
    viol = domain.run_mart_rules(mart).unionByName(domain.movement_rule(built["stg_m"]))
    names = {r.teste for r in viol.collect()}
    assert "permanencia_nao_negativa" in names and "idade_nao_negativa" in names
    batch = domain.register_batch(mart, viol, "2026-01-01 00:00:00")
    from wardflow.operators import curation
    first = curation.register_new(batch, batch.limit(0))
    again = curation.register_new(batch, first)
    assert first.count() > 0 and again.count() == 0
    statuses = {(r.teste, r.status) for r in first.collect()}
    assert ("permanencia_nao_negativa", "pendente") in statuses


def test_overwrite_period_is_idempotent(spark, built, tmp_path):
    root = str(tmp_path / "raw")
    raw = built["raw_m"]
    reports.write_raw(raw, root)
    before = sorted(map(repr, spark.read.parquet(root).collect()))
    reports.overwrite_period(raw.where(F.col("competencia") == "2025-03"), root)
    after = sorted(map(repr, spark.read.parquet(root).collect()))
    assert before == after                                          # reload changes nothing
    reports.overwrite_period(raw.where((F.col("competencia") == "2025-03") & (F.col("HORA") == "10:00:00")), root)
    back = spark.read.parquet(root)
    assert back.where(F.col("competencia") == "2025-04").count() == 1   # other period survived
    assert back.where(F.col("competencia") == "2025-03").count() == 1


def test_seed_dedup(built):
    assert built["beds"].count() == 3


def test_transform_ready_periods(spark, built, tmp_path):
    root = str(tmp_path / "lake")
    raw_v = built["raw_v"].drop("__row")
    raw_a = built["raw_a"].drop("__row")
    reports.write_raw(raw_v, reports.layer_path(root, "raw", "atendimentos"))
    reports.write_raw(raw_a, reports.layer_path(root, "raw", "internacoes"))
    reports.write_raw(built["raw_m"], reports.layer_path(root, "raw", "movimentacoes"))
    out = domain.transform_ready_periods(spark, root, built["beds"], detected_at="2026-01-01 00:00:00")
    assert [r.competencia for r in out["ready"].collect()] == ["2025-03"]       # 2025-04 lacks two sources
    mart = spark.read.parquet(out["atendimentos_pa"])
    assert {str(r.competencia) for r in mart.select("competencia").distinct().collect()} == {"2025-03-01"}
    assert sorted(r.atend_PA for r in mart.select("atend_PA").distinct().collect()) == [1, 2, 3, 4, 5, 6]
    for name in ("percentis_jornada", "volume_jornada", "ranking_especialidades", "dim_competencia"):
        assert spark.read.parquet(out[name]).count() > 0
    reg = spark.read.parquet(out["curadoria_inconsistencias"]).count()
    assert reg > 0
    domain.transform_ready_periods(spark, root, built["beds"], detected_at="2026-02-01 00:00:00")
    assert spark.read.parquet(out["curadoria_inconsistencias"]).count() == reg     # nothing new registered
