"""Arrival of reports: any batching, repeated batches and parallel streams give one
raw table, one start per period and one account of the rows."""
import os

import pytest
from pyspark.sql import functions as F

from wardflow.sources import control
from wardflow.sources.contracts import ADMISSIONS, VISITS, Contract, plain
from wardflow.streaming import ingest

VISIT_HEADER = "EMPRESA,CD_ATENDIMENTO,CD_PACIENTE,DT_ATENDIMENTO,DT_HR_TOTEM_RECEP,NM_PACIENTE"
ADMISSION_HEADER = "COD_PACIENTE,ATENDIMENTO,ORIGEM_ATEND,DT_HR_ATENDIMENTO,PACIENTE"


def cells(**kv):
    c = [""] * 20
    for k, x in kv.items():
        c[int(k[1:])] = x
    return ",".join(c)


def movement_lines(*ids):
    return [cells(c0="Unidade de Internação: A", c6="UTI"), cells(c0="Data:", c2="2025-07-01"),
            *[cells(c1=str(i), c3="NOME", c10="08:00:00", c15="L1") for i in ids]]


def put(folder, name, lines, when):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (when, when))
    return path


def batch(spark, *paths):
    return ingest._with_file(spark.read.text(list(paths)))


def rows(spark, sink, name, *cols):
    return sorted(tuple(r) for r in spark.read.parquet(f"{sink}/{name}").select(*cols).collect())


@pytest.mark.parametrize("runs", [[(0, 1, 2)], [(2,), (0,), (1,)], [(1, 2), (0,)]])
def test_movement_files_in_any_batches(spark, tmp_dir, runs):
    """The newest report of a period is the one stored, whichever comes first."""
    paths = [put(f"{tmp_dir}/landing", f"movimentacoes_2025_07{v}.csv", movement_lines(*ids), t)
             for v, ids, t in (("", (1, 2, 3), 1000), ("_v2", (4,), 3000), ("_v3", (5, 6), 2000))]
    sink = f"{tmp_dir}/raw"
    load = ingest.text_arrivals(sink, f"{tmp_dir}/ck")
    for epoch, run in enumerate(runs):
        load(batch(spark, *[paths[i] for i in run]), epoch)
    assert rows(spark, sink, "movimentacoes", "ATEND") == [("4",)]
    assert {r.relatorio.rsplit("/", 1)[1] for r in ingest.report_versions(spark, sink).where("vigente").collect()} == {"movimentacoes_2025_07_v2.csv"}


def test_contracts(spark):
    def problems(contract: Contract, *names):
        one = spark.range(1).select(plain(F.array(*[F.lit(n) for n in names])).alias("n"))
        return one.select(contract.problems(F.col("n"))).first()[0]
    assert problems(VISITS, *VISIT_HEADER.split(",")) == []
    assert problems(VISITS, " empresa", "Cd_Atendimento", "CD_PACIENTE ", "DT_ATENDIMENTO", "DT_HR_TOTEM_RECEP") == []
    assert problems(ADMISSIONS, "ATENDIMENTO", "ORIGEM_ATEND", "DT_HR_ATENDIMENTO", "NOME", "ATENDIMENTO") == [
        "falta COD_PACIENTE", "desconhecida NOME", "repetida ATENDIMENTO"]


def test_refused_reports_load_nothing_and_columns_go_by_name(spark, tmp_dir):
    landing, sink = f"{tmp_dir}/landing", f"{tmp_dir}/raw"
    good = put(landing, "atendimentos_2025_03.csv", [VISIT_HEADER, 'HSR,1,10,2025-03-01,2025-03-01 08:00:00,"ANA, B"',
                                                     "OUTRA,2,11,2025-03-01,2025-03-01 08:00:00,BIA", "HSR,1,12,2025-03-01,2025-03-01 09:00:00,CAIO"], 1000)
    turned = put(landing, "atendimentos_2025_04.csv", ["NM_PACIENTE,DT_HR_TOTEM_RECEP,CD_PACIENTE,DT_ATENDIMENTO,CD_ATENDIMENTO,EMPRESA,UF",
                                                       "ANA,2025-04-01 08:00:00,10,2025-04-01,5,HSR,SP"], 1000)
    renamed = put(landing, "atendimentos_2025_03_v2.csv", [VISIT_HEADER.replace("NM_PACIENTE", "NOME"), "HSR,9,10,2025-03-01,2025-03-01 08:00:00,ANA"], 9000)
    short = put(landing, "internacoes_2025_03.csv", ["COD_PACIENTE,ATENDIMENTO", "1,2"], 1000)
    load = ingest.text_arrivals(sink, f"{tmp_dir}/ck")
    for _ in range(2):  # the second time as after a failure
        load(batch(spark, good, turned, renamed, short), 0)
        assert rows(spark, sink, "atendimentos", "CD_ATENDIMENTO", "CD_PACIENTE", "competencia") == [("1", "10", "2025-03"), ("5", "10", "2025-04")]
        stored = spark.read.parquet(f"{sink}/atendimentos")
        assert set(stored.columns) == {*VISITS.stored, "competencia"}
        assert not os.path.exists(f"{sink}/internacoes")
        refused = {r.relatorio.rsplit("/", 1)[1]: r.recusa for r in ingest.report_versions(spark, sink).where("recusa IS NOT NULL").collect()}
        assert refused == {"atendimentos_2025_03_v2.csv": "desconhecida NOME", "internacoes_2025_03.csv": "falta ORIGEM_ATEND; falta DT_HR_ATENDIMENTO"}
        audit = {(r.relatorio.rsplit("/", 1)[1], r.motivo): r.linhas for r in ingest.load_audit(spark, sink).collect()}
        assert audit[("atendimentos_2025_03.csv", "lidas")] == 4
        parts = {m: n for (name, m), n in audit.items() if name == "atendimentos_2025_03.csv" and m != "lidas"}
        assert parts == {"gravadas": 1, "outra_empresa": 1, "repetidas": 1, "cabecalho": 1}
        assert audit[("atendimentos_2025_03_v2.csv", "recusado")] == 2
        for name in {n for n, _ in audit}:   # every row read is accounted for
            assert audit[(name, "lidas")] == sum(n for (x, m), n in audit.items() if x == name and m != "lidas")


def test_one_start_per_period(spark, tmp_dir):
    landing, sink = f"{tmp_dir}/landing", f"{tmp_dir}/raw"
    v = put(landing, "atendimentos_2025_05.csv", [VISIT_HEADER, "HSR,1,10,2025-05-01,2025-05-01 08:00:00,ANA"], 1000)
    a = put(landing, "internacoes_2025_05.csv", [ADMISSION_HEADER, "10,7,EMERGENCIA ADULTO,2025-05-01 10:00:00,ANA"], 1000)
    m = put(landing, "movimentacoes_2025_05.csv", movement_lines(7), 1000)
    m2 = put(landing, "movimentacoes_2025_05_v2.csv", movement_lines(7, 8), 2000)
    begun, broken = [], [True]

    def start(session, periods):
        begun.append(tuple(periods))
        if broken:
            broken.pop()
            raise RuntimeError("the transform failed")
    one = ingest.text_arrivals(sink, f"{tmp_dir}/ck1", on_ready=start)
    other = ingest.text_arrivals(sink, f"{tmp_dir}/ck2", on_ready=start)
    one(batch(spark, v, a), 0)
    assert begun == []
    with pytest.raises(RuntimeError):
        one(batch(spark, m), 1)
    one(batch(spark, m), 1)      # the batch is repeated, and the start it did not end too
    one(batch(spark, m), 1)      # once more: it has ended
    other(batch(spark, m2), 0)   # another stream finds the period complete
    assert begun == [("2025-05",), ("2025-05",)]
    assert [r.competencia for r in ingest.starts(spark, sink).collect()] == ["2025-05"]
    assert rows(spark, sink, "movimentacoes", "ATEND") == [("7",), ("8",)]


def test_claims_and_derived_tables(spark, tmp_dir):
    path = f"{tmp_dir}/claims/p"
    assert [control.claim(spark, path, o) for o in ("a 0", "b 0", "a 0", "a 1")] == [True, False, True, False]
    spark.range(3).write.parquet(f"{tmp_dir}/t")
    built = []

    def build(folder):
        built.append(folder)
        spark.range(len(built)).write.parquet(f"{folder}/x")
    first = control.derived(spark, "test", [f"{tmp_dir}/t"], build)
    assert control.derived(spark, "test", [f"{tmp_dir}/t"], build) == first and len(built) == 1
    spark.range(4).write.mode("append").parquet(f"{tmp_dir}/t")   # the input changed
    assert control.derived(spark, "test", [f"{tmp_dir}/t"], build) != first and len(built) == 2

    def fails(folder):
        spark.range(1).write.parquet(f"{folder}/x")
        raise ValueError
    spark.range(5).write.mode("append").parquet(f"{tmp_dir}/t")
    with pytest.raises(ValueError):
        control.derived(spark, "test", [f"{tmp_dir}/t"], fails)
    whole = control.derived(spark, "test", [f"{tmp_dir}/t"], build)   # what broke off is not read
    assert whole == built[-1] and spark.read.parquet(f"{whole}/x").count() == 3
