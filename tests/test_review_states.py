"""Decisions stored once, marts rebuilt where decisions reach, percentiles from states."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardflow.operators import curation, journey, states
from wardflow.plans import domain, lake, review
from wardflow.sources import reports
from wardflow.sources.merge import merge_by_key

SF = "/root/testdata/sf0.001"


def test_merge_rewrites_touched_periods_only(spark, tmp_dir):
    schema, path = "id string, v string, competencia date", f"{tmp_dir}/t"
    a, b = dt.date(2025, 1, 1), dt.date(2025, 2, 1)

    def merge(*rows):
        return sorted([tuple(r) for r in merge_by_key(spark.createDataFrame(list(rows), schema), path, schema, ["id", "competencia"]).collect()], key=str)

    def files():
        return {r.f for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}

    def stored():
        return sorted(((r.id, r.v, r.competencia) for r in spark.read.schema(schema).parquet(path).collect()), key=str)
    first = [("1", "x", a), ("2", "y", b), (None, "n", a), ("9", "null period", None)]
    assert len(merge(*first)) == 4 and stored() == sorted(first, key=str)
    before = files()
    assert merge(*first) == [] and files() == before          # the same again: nothing is written
    assert merge(("1", "z", a), ("3", "new", a), ("3", "older", a), ("2", "y", b)) == [("1", "z", a), ("3", "older", a)]
    assert stored() == sorted([("1", "z", a), ("3", "older", a), (None, "n", a), ("2", "y", b), ("9", "null period", None)], key=str)
    assert {f for f in before if "2025-02-01" in f or "DEFAULT" in f} <= files()   # other periods' files are the same
    with pytest.raises(ValueError):
        merge_by_key(spark.createDataFrame(first, schema), path, schema, ["id"])


def register(spark, root):
    rows = [(f"i{k}", tipo, "r", k, dt.date(2025, 1 + k % 2, 1), "S", dt.datetime(2025, 1, 1), "pendente")
            for k, tipo in enumerate(["integridade", "logica_negocio", "conversao", "sequencia_temporal", "conversao"])]
    reg = spark.createDataFrame(rows, reports.CURATION_SCHEMAS["curadoria_inconsistencias"])
    reg.write.partitionBy("competencia").parquet(reports.layer_path(root, "curadoria", "curadoria_inconsistencias"))


def decision(ident, case, tipo, **more):
    row = {"id_decisao": ident, "id_inconsistencia": case, "tipo": tipo, "decidido_por": "ana", "decidido_em": dt.datetime(2025, 2, 1),
           "campo_afetado": None, "valor_original": "old", "valor_imputado": " ", "flag_prevalece": None, "justificativa": None,
           "decisao": None, "atend_internacao": None, "leito": None, "unidade": None, "tipo_leito": None, **more}
    return tuple(row.values())


def test_decisions_are_checked_and_stored_once(spark, tmp_dir):
    register(spark, tmp_dir)
    bed = {"atend_internacao": "7", "leito": "L1", "unidade": "U", "tipo_leito": "UTI"}
    rows = [decision("d0", "i0", "integridade", campo_afetado="IDADE"), decision("d1", "i1", "logica_negocio", flag_prevalece="evasao"),
            decision("d2", "i2", "conversao", decisao="confirmado", **bed), decision("d3", "i3", "sequencia_temporal", campo_afetado="SENHA"),
            decision("d4", "i4", "conversao", decisao="confirmado", **{**bed, "leito": ""}), decision("d5", "i99", "integridade", campo_afetado="UF"),
            decision("d6", "i4", "integridade", campo_afetado="UF")]
    frame = spark.createDataFrame(rows, review.DECISION)
    review.store_decisions(spark, tmp_dir, frame)
    cur = reports.read_curation(spark, tmp_dir)
    assert [(r.id_imputacao, r.valor_imputado) for r in cur["curadoria_imputacao_integridade"].collect()] == [("d0", "old")]   # blank: the original
    assert [(r.id_decisao, r.flag_prevalece) for r in cur["curadoria_decisao_logica"].collect()] == [("d1", "evasao")]
    assert [(r.CD_ATENDIMENTO, r.destino, r.unidade, r.tipo) for r in cur["curadoria_conversao"].collect()] == [("2", "L1", "U", "UTI")]
    status = {r.id_inconsistencia: r.status for r in cur["curadoria_inconsistencias"].collect()}
    assert status == {"i0": "revisado", "i1": "revisado", "i2": "revisado", "i3": "pendente", "i4": "pendente"}
    rejected = {r.id_decisao: r.problemas for r in spark.read.parquet(f"{tmp_dir}/curadoria/rejeitadas").collect()}
    assert rejected == {"d3": "campo_desconhecido", "d4": "destino_ausente", "d5": "caso_desconhecido", "d6": "classe_diferente"}
    assert {r.id_inconsistencia for r in curation.pending_cases(cur["curadoria_inconsistencias"], F.lit(dt.date(2025, 1, 1))).collect()} == {"i4"}
    again = review.store_decisions(spark, tmp_dir, frame)
    assert all(x.isEmpty() for x in again.values())
    changed = review.store_decisions(spark, tmp_dir, spark.createDataFrame([decision("d1", "i1", "logica_negocio", flag_prevalece="conversao")], review.DECISION))
    assert changed["curadoria_decisao_logica"].count() == 1 and changed["curadoria_inconsistencias"].isEmpty()
    assert [r.flag_prevalece for r in reports.read_curation(spark, tmp_dir)["curadoria_decisao_logica"].collect()] == ["conversao"]


def test_refresh_equals_the_whole_job(spark, tmp_dir):
    part, full = f"{tmp_dir}/part", f"{tmp_dir}/full"
    lake.review_round(spark, SF, part)
    lake.review_round(spark, SF, full, refresh=False)
    for layer, name in (("marts", "atendimentos_pa"), ("marts", "estados_jornada"), ("marts", "volume_jornada"),
                        ("marts", "ranking_especialidades"), ("curadoria", "curadoria_inconsistencias")):
        a, b = (spark.read.parquet(reports.layer_path(root, layer, name)) for root in (part, full))
        b = b.select(*a.columns)
        assert a.count() == b.count() and a.exceptAll(b).isEmpty(), name
    # nothing changed since: nothing is rebuilt
    _, _, _, beds, cid = lake.ed_raw_tables(spark, SF, lake.period_of("ts"))
    assert domain.refresh_after_decisions(spark, part, beds, cid).isEmpty()


def test_only_reached_periods_are_touched(spark):
    day = dt.date
    rows = [(1, 10, day(2025, 1, 31), day(2025, 1, 1)), (2, 10, day(2025, 2, 1), day(2025, 2, 1)), (3, 10, day(2025, 3, 9), day(2025, 3, 1)),
            (4, 11, day(2025, 4, 2), day(2025, 4, 1)), (2, 12, day(2025, 6, 1), day(2025, 6, 1)), (5, 12, day(2025, 5, 30), day(2025, 5, 1))]
    stg = spark.createDataFrame(rows, "CD_ATENDIMENTO long, CD_PACIENTE long, DT_ATENDIMENTO date, competencia date")
    fields = ", ".join(f"{f}_corrigido string" for f in curation.CORRECTABLE_FIELDS)
    schema = f"nr_atendimento long, flag_prevalece string, {fields}, decisao string"
    none = (None,) * len(curation.CORRECTABLE_FIELDS)
    old = spark.createDataFrame([], schema)
    new = spark.createDataFrame([(1, "evasao", *none, None)], schema)
    ids = curation.changed_visits(old, new)
    assert [r.id for r in ids.collect()] == [1] and curation.changed_visits(new, new).isEmpty()
    got = {r.competencia.month for r in domain.touched_periods(stg, old, new, ids).collect()}
    assert got == {1, 2, 6}     # its own, the neighbour's, and the other row of the neighbour's id
    moved = spark.createDataFrame([(4, None, "12", *none[1:], None)], schema)   # patient 11 becomes 12 (field order: CD_PACIENTE first)
    got = {r.competencia.month for r in domain.touched_periods(stg, old, moved, curation.changed_visits(old, moved)).collect()}
    assert got == {4}


@pytest.mark.parametrize("method, exact", [("discrete", "exact"), ("interpolated", "interpolated")])
def test_states_give_the_percentiles_of_a_scan(spark, method, exact):
    rows = [(s, t, p, None if (i * 7) % 5 == 0 else (i * 13) % 17, i % 3 or None)
            for i, (s, t, p) in enumerate((s, t, p) for s in ("a", "b", None, "Todas") for t in ("x", "y") for p in (1, 2) for _ in range(9))]
    df = spark.createDataFrame(rows + [("z", "x", 1, None, None)], "s string, t string, p int, d int, e int")
    steps = (("D", "d", 1), ("E", "e", 2))
    held = states.duration_states(df, ["s", "t", "p"], steps)
    probs = {"p50": 0.5, "p90": 0.9}

    def rows_of(frame, keys):
        return sorted((tuple(str(r[k]) for k in keys), r.nome_etapa, None if r.p50 is None else round(r.p50, 9), None if r.p90 is None else round(r.p90, 9))
                      for r in frame.collect())
    for keys in (["s", "t", "p"], ["p"], ["s"], ["t", "p"]):
        got = rows_of(states.percentiles(states.merged(held.where("t <> 'q'"), keys), keys, probs, method), keys)
        whole = journey.wide_to_long(df, keys, steps, "nome_etapa", ["v"]).groupBy(*keys, "nome_etapa").agg(
            *[journey._pct("v", p, exact, 100).alias(n) for n, p in probs.items()])
        assert got == rows_of(whole, keys)
    rolled = states.percentiles(states.rolled_up(held, ["s", "t"]), ["s", "t", "agregado"], probs, method)
    cube = journey.wide_to_long(df, ["s", "t"], steps, "nome_etapa", ["v"]).cube("s", "t", "nome_etapa").agg(
        *[journey._pct("v", p, exact, 100).alias(n) for n, p in probs.items()], F.grouping("s").alias("gs"), F.grouping("t").alias("gt"),
        F.grouping("nome_etapa").alias("gn")).where("gn = 0")
    cube = cube.select(F.when(F.col("gs") == 1, "Todas").otherwise(F.col("s")).alias("s"), F.when(F.col("gt") == 1, "Todas").otherwise(F.col("t")).alias("t"),
                       (F.col("gs").cast("int") + 2 * F.col("gt").cast("int")).alias("agregado"), "nome_etapa", "p50", "p90")
    assert rows_of(rolled, ["s", "t", "agregado"]) == rows_of(cube, ["s", "t", "agregado"])


def test_every_declared_check_finds_its_fault(spark):
    got = {r.teste: r.casos for r in lake.rule_faults(spark, SF).collect()}
    assert len(got) == 53 and all(n > 0 for n in got.values())


def test_interleaved_order_skips_on_every_key(spark, tmp_dir):
    rows = [(a, b, c, "2025-01") for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx"] + [(None, "i", "q", "2025-01")]
    df = spark.createDataFrame(rows, "a string, b string, c string, competencia string")

    def shares(path):
        back = spark.read.parquet(path).withColumn("f", F.col("_metadata.file_path"))
        assert sorted(map(str, back.select("a", "b", "c").collect())) == sorted(map(str, df.select("a", "b", "c").collect()))
        total = back.select("f").distinct().count()
        spans = {k: [tuple(r) for r in back.groupBy("f").agg(F.min(k), F.max(k)).select(f"min({k})", f"max({k})").collect()] for k in "abc"}
        return {k: sum(sum(lo <= v <= hi for lo, hi in s) for v in {r["abc".index(k)] for r in rows} - {None}) / 8 / total for k, s in spans.items()}
    reports.write_mart(df, f"{tmp_dir}/sorted", cluster_by=["a", "b", "c"], parts=16)
    reports.write_mart(df, f"{tmp_dir}/woven", cluster_by=["a", "b", "c"], interleave=True, parts=16)
    plain, woven = shares(f"{tmp_dir}/sorted"), shares(f"{tmp_dir}/woven")
    assert max(plain.values()) > 0.9 and max(woven.values()) <= 0.6
