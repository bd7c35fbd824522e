"""What the review round's time grows with: rows read once, shuffles and sorts by numbers, no interpreted code."""

import datetime as dt

from pyspark.sql import functions as F

from wardflow import session
from wardflow.functions import columns as C
from wardflow.operators import curation, journey, tables
from wardflow.plans import domain, review
from wardflow.sources import merge, reports


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _sorted(df) -> list:
    return sorted(map(str, df.collect()))


# ---------------------------------------------------------------- the mart (F4)

def test_code_the_jvm_would_interpret_is_not_generated(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        session.apply_defaults(spark)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)


def test_minutes_come_from_date_and_clock(spark):
    times = [dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1), dt.datetime(2024, 2, 29, 23, 59, 0, 1), dt.datetime(2024, 3, 1, 0, 0, 59), None]
    df = spark.createDataFrame([(a, b) for a in times for b in times], "a timestamp_ntz, b timestamp_ntz")
    got = df.select("a", "b", C.minutes_boundary("b", "a").alias("m"), C.step_minutes("a", "b").alias("s"))
    assert "trunc" not in _plan(got) and "timestampdiff" not in _plan(got).lower()
    assert dict(got.dtypes)["m"] == "bigint"
    for r in got.collect():
        want = None if r.a is None or r.b is None else (r.b.replace(second=0, microsecond=0) - r.a.replace(second=0, microsecond=0)) // dt.timedelta(minutes=1)
        assert r.m == want and r.s == (None if want is None or r.b < r.a else want)


def test_times_are_converted_once_a_row(spark):
    row = spark.createDataFrame([(30, "VERDE")], "IDADE long, COR_CLASSIF string").select("*", *[F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias(c) for c in domain.JOURNEY_TS])
    row = session.materialize(row, "test-journey")
    assert _plan(domain.journey_columns(row)).count("unix_date(") == 8   # times that steps begin or end with


def _visits(spark):
    rows = [(i, i % 3, dt.date(2024, 1, 1 + i % 5), dt.datetime(2024, 1, 1 + i % 5, i), "c - d", "ALTA") for i in range(8)] + [(None, 1, dt.date(2024, 1, 1), None, None, None)]
    return session.materialize(spark.createDataFrame(rows, "atend_PA long, CD_PACIENTE long, DT_ATENDIMENTO date, DT_HR_TOTEM_RECEP timestamp_ntz, CID string, MOTIVO_ALTA string"), "test-visits")


def test_visits_are_read_once_and_crowded_ones_apart(spark, monkeypatch):
    links = spark.createDataFrame([(1, 90, "EMERGENCIA ADULTO"), (2, 91, "EMERGENCIA ADULTO"), (2, 92, "EMERGENCIA INFANTIL"), (2, 93, "AMBULATORIO"), (3, 94, "X"), (99, 95, "EMERGENCIA ADULTO")],
                                  "CD_ATENDIMENTO long, ATENDIMENTO long, ORIGEM_ATEND string")
    whole = domain.assemble_visit_mart(_visits(spark), None, links, None, None)
    assert sum("FileScan" in line and "MOTIVO_ALTA" in line for line in _plan(whole).splitlines()) == 1
    assert "Union" not in _plan(whole)
    assert whole.count() == 10 and whole.where("atend_PA = 2").count() == 2 and whole.where("atend_internacao IS NOT NULL").count() == 3
    monkeypatch.setattr(domain, "MANY_ADMISSIONS", 1)
    apart = domain.assemble_visit_mart(_visits(spark), None, links, None, None)
    assert "Union" in _plan(apart) and apart.columns == whole.columns and _sorted(apart) == _sorted(whole)


def test_a_rebuild_of_most_visits_reads_all_of_them(spark):
    day = dt.date
    stg = spark.createDataFrame([(i, i, day(2024, m, 1), day(2024, m, 1)) for i, m in enumerate((1, 1, 2, 3))] + [(None, 5, day(2024, 1, 1), day(2024, 1, 1))],
                                "CD_ATENDIMENTO long, CD_PACIENTE long, DT_ATENDIMENTO date, competencia date")
    adm = spark.createDataFrame([(1, 70, dt.datetime(2024, 1, 1, 5)), (9, 71, dt.datetime(2024, 7, 1))], "COD_PACIENTE long, ATENDIMENTO long, DT_HR_ATENDIMENTO timestamp_ntz")
    mov = adm.select("ATENDIMENTO", F.lit("L1").alias("DESTINO"))
    fields = ", ".join(f"{f}_corrigido string" for f in domain.curation.CORRECTABLE_FIELDS)
    state = spark.createDataFrame([], f"nr_atendimento long, flag_prevalece string, {fields}, decisao string")

    def inputs(*months):
        return domain.rebuild_inputs(stg, adm, mov, state, spark.createDataFrame([(day(2024, m, 1),) for m in months], "competencia date"))
    v, a, m = inputs(1, 2)
    assert "Join" not in _plan(v) + _plan(a) + _plan(m) and sorted(r.CD_ATENDIMENTO for r in v.collect()) == [0, 1, 2, 3]
    v, a, m = inputs(2)
    assert [r.CD_ATENDIMENTO for r in v.collect()] == [2] and a.isEmpty() and m.isEmpty()
    # where the decided visits are in every period, none is left to be reached
    ids = spark.createDataFrame([(0,), (2,), (3,)], "id long")
    got = domain.touched_periods(stg, state, state, ids)
    assert "Join" not in _plan(got) and sorted(r.competencia.month for r in got.collect()) == [1, 2, 3]


# ---------------------------------------------------------------- the register (F1)

def test_cases_are_looked_up_where_a_period_is_missing(spark):
    mart = spark.createDataFrame([(1, "2024-02-01"), (1, "2024-01-01"), (2, "2024-02-01"), (2, None)], "atend_PA long, competencia string").withColumn("competencia", F.to_date("competencia"))
    cases = spark.createDataFrame([("r", 1, "2024-03-01"), ("r", 2, "2024-03-01"), ("q", None, None)], "teste string, nr_atendimento long, competencia string").withColumn("competencia", F.to_date("competencia"))
    assert curation.with_period(cases, mart) is cases
    some = cases.unionByName(cases.select("teste", F.lit(1).cast("long").alias("nr_atendimento"), F.lit(None).cast("date").alias("competencia")))
    some = some.unionByName(cases.select(F.lit("u").alias("teste"), F.lit(7).cast("long").alias("nr_atendimento"), F.lit(None).cast("date").alias("competencia")).limit(1))
    got = sorted((r.teste, str(r.nr_atendimento), str(r.competencia)) for r in curation.with_period(some, mart).distinct().collect())
    assert got == [("q", "1", "2024-01-01"), ("q", "None", "None"), ("r", "1", "2024-01-01"), ("r", "1", "2024-03-01"), ("r", "2", "2024-03-01"), ("u", "7", "None")]


def test_new_cases_are_dealt_by_a_number(spark):
    batch = spark.createDataFrame([("a", 1, "2024-01-01", "s"), ("a", 1, "2024-01-01", "s"), ("a", None, None, "s"), ("a", None, None, "s"), ("b", 1, None, "s"), ("b", 2, "2024-01-01", "s")],
                                  "teste string, nr_atendimento long, competencia string, servico string").withColumn("competencia", F.to_date("competencia"))
    held = batch.where("teste = 'b' AND nr_atendimento = 1").unionByName(batch.where("nr_atendimento IS NULL").limit(1)).drop("servico")
    new = curation.register_new(batch, held)
    exchanges = [line for line in _plan(new).splitlines() if "Exchange" in line]
    assert exchanges and all("hashpartitioning(__h" in line or "hashpartitioning(__eh" in line for line in exchanges if "hashpartitioning" in line)
    assert new.columns == batch.columns
    want = [("a", 1, "2024-01-01"), ("b", 2, "2024-01-01")]
    assert sorted((r.teste, r.nr_atendimento, str(r.competencia)) for r in new.collect()) == want
    text = held.select("teste", F.col("nr_atendimento").cast("string").alias("nr_atendimento"), F.col("competencia").cast("string").alias("competencia"))
    assert sorted((r.teste, r.nr_atendimento, str(r.competencia)) for r in curation.register_new(batch, text).collect()) == want


def test_equal_hashes_are_not_equal_keys(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (1, None)], "h long, k string")
    b = spark.createDataFrame([(1, "x"), (1, None), (2, "y")], "g long, l string")
    got = a.join(b, tables.same_hash(a["h"], b["g"], [(a["k"], b["l"])]), "left_anti")
    assert [r.k for r in got.collect()] == ["y"]


# ---------------------------------------------------------------- decisions (F5)

def test_a_merge_writes_what_changed_and_the_table_once(spark, tmp_dir, monkeypatch):
    stored = []
    keep = merge.materialize
    monkeypatch.setattr(merge, "materialize", lambda df, name: stored.append((name, _plan(df))) or keep(df, name))
    schema = "id string, v string, competencia date"

    def put(*rows):
        stored.clear()
        up = spark.createDataFrame(rows, "id string, v string, competencia string").withColumn("competencia", F.to_date("competencia"))
        changed = merge.merge_by_key(up, f"{tmp_dir}/t", schema, ["id", "competencia"])
        assert changed.columns == ["id", "v", "competencia"]
        return sorted((r.id or "-", r.v) for r in changed.collect())
    assert put(("a", "1", "2024-01-01"), (None, "2", "2024-01-01"), ("a", "0", "2024-01-01"), ("b", None, "2024-02-01")) == [("-", "2"), ("a", "1"), ("b", None)]
    assert put((None, "2", "2024-01-01"), ("b", None, "2024-02-01")) == []
    assert put((None, "3", "2024-01-01"), ("b", None, "2024-02-01")) == [("-", "3")]
    assert [name for name, _ in stored] == ["merge-changed"]
    assert not [line for line in stored[0][1].splitlines() if "hashpartitioning(" in line and "__h" not in line and "__key" not in line]
    assert sorted((r.id or "-", r.v or "-", r.competencia.month) for r in spark.read.parquet(f"{tmp_dir}/t").collect()) == [("-", "3", 1), ("a", "1", 1), ("b", "-", 2)]


def test_decisions_meet_their_cases_by_a_number(spark):
    register = spark.createDataFrame([("i1", "integridade", 7, dt.date(2024, 1, 1))], "id_inconsistencia string, tipo string, nr_atendimento long, competencia date")
    decisions = spark.createDataFrame([], review.DECISION).unionByName(spark.createDataFrame(
        [("d1", "i1", "integridade", "ana", "IDADE", "3"), ("d2", None, "integridade", "ana", "IDADE", "3"), ("d3", "i9", "integridade", "ana", "IDADE", "3")],
        "id_decisao string, id_inconsistencia string, tipo string, decidido_por string, campo_afetado string, valor_imputado string"), allowMissingColumns=True)
    got = review.routed(decisions, register)
    assert "xxhash64(id_inconsistencia" in _plan(got)
    assert sorted((r.id_decisao, r.nr_atendimento, r.problemas) for r in got.collect()) == [("d1", 7, []), ("d2", None, ["caso_desconhecido"]), ("d3", None, ["caso_desconhecido"])]


# ---------------------------------------------------------------- percentiles behind the rule counts (F3)

def test_a_sketch_serves_all_percentiles(spark):
    rows = [(s, p, i % 7, None if i % 4 == 0 else i) for i, (s, p) in enumerate((s, p) for s in ("a", None, "Todas") for p in (1, 2, None) for _ in range(6))]
    df = spark.createDataFrame(rows, "s string, p int, d int, e int")
    steps = (("D", "d", 1), ("E", "e", 2))
    got = journey.step_percentiles(df, ["s", "p"], "p", steps, method="approx")
    plan = _plan(got)
    assert "[0.5,0.9]" in plan.replace(" ", "") and ", 0.9," not in plan
    # the rows of detail groups are not multiplied by the groupings
    assert all("d#" not in line or "Todas" not in line for line in plan.splitlines() if "Expand" in line)
    want = []
    for keys in (["s", "p"], ["p"], []):
        for label, c, o in steps:
            part = df.groupBy(*keys).agg(*[F.percentile_approx(c, q, 10000).cast("double").alias(n) for q, n in ((0.5, "p50"), (0.9, "p90"))])
            want += [(str(r["s"]) if "s" in keys else "Todas", str(r["p"]) if keys else "None", label, r.p50, r.p90, o) for r in part.collect()]
    assert sorted(map(str, want)) == sorted(str((str(r.s), str(r.p), r.nome_etapa, r.p50, r.p90, r.ordem)) for r in got.collect())


# ---------------------------------------------------------------- staging before the states (F2, F6)

def test_staged_periods_are_written_without_a_shuffle(spark, tmp_dir, monkeypatch):
    spark.createDataFrame([(i, f"2024-0{1 + i % 3}") for i in range(30)], "v long, competencia string").repartition("competencia").write.partitionBy("competencia").parquet(f"{tmp_dir}/raw")
    raw = spark.read.parquet(f"{tmp_dir}/raw")

    def shuffled(*_):
        raise AssertionError("a shuffle by period")
    monkeypatch.setattr(type(raw), "hint", shuffled)
    reports.write_mart(raw, f"{tmp_dir}/staged", by_period=True)
    back = spark.read.parquet(f"{tmp_dir}/staged")
    assert _sorted(back) == _sorted(raw) and len(back.inputFiles()) <= len(raw.inputFiles())


def test_only_texts_without_a_dash_are_held_against_the_serial_pattern(spark):
    texts = ["45979.6125", "45979", "2024-01-02 03:04:05", "2024-01-02", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(C.excel_or_datetime("t").alias("x"))
    plan = _plan(spark.read.schema("t string").json(spark.sparkContext.emptyRDD()).select(C.excel_or_datetime("t").alias("x")))
    assert "Contains(t" in plan or "contains(t" in plan.lower()
    assert [r.x for r in got.collect()] == [dt.datetime(2025, 11, 18, 14, 42), dt.datetime(2025, 11, 18), dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2), None]
