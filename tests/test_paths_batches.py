"""Results do not depend on how paths are written, how files arrive, how blocks
fall, or on missing keys."""
import os

import pytest
from pyspark.sql import functions as F

from wardflow.functions import columns as C
from wardflow.operators import curation, journey, ranking, scan
from wardflow.plans import domain
from wardflow.session import checkpoint_root
from wardflow.sources import reports
from wardflow.streaming.ingest import ingest_available, ready_from_raw


def test_tables_are_found_by_any_path(spark, tmp_dir):
    row = spark.createDataFrame([("d1", "i1", "evasao", None, "ana", None)],
                                reports.CURATION_SCHEMAS["curadoria_decisao_logica"])
    reports.append_records(row, reports.layer_path(tmp_dir, "curadoria", "curadoria_decisao_logica"))
    for name in ("atendimentos", "internacoes", "movimentacoes"):
        reports.write_raw(spark.createDataFrame([(1, "2025-01")], "x int, competencia string"), f"{tmp_dir}/raw/{name}")
    for root in (tmp_dir, f"file:{tmp_dir}", f"file://{tmp_dir}"):
        got = {k: v.count() for k, v in reports.read_curation(spark, root).items()}
        assert got["curadoria_decisao_logica"] == 1 and sum(got.values()) == 1
        assert [(r.competencia, r.pronto) for r in ready_from_raw(spark, f"{root}/raw").collect()] == [("2025-01", 1)]
    with open(os.path.join(tmp_dir, "broken"), "w") as f:
        f.write("not a table")
    with pytest.raises(Exception):  # any error but a missing path is raised
        reports.read_or_empty(spark, os.path.join(tmp_dir, "broken"), "x int").collect()


def write(spark, folder, ids, part):
    spark.createDataFrame([(i,) for i in ids], "CD_ATENDIMENTO string").coalesce(1).write.mode("overwrite").parquet(f"{folder}-tmp")
    os.makedirs(folder, exist_ok=True)
    name = next(x for x in os.listdir(f"{folder}-tmp") if x.startswith("part-"))
    os.rename(f"{folder}-tmp/{name}", f"{folder}/part-{part:05d}.parquet")
    for x in os.listdir(f"{folder}-tmp"):
        os.remove(f"{folder}-tmp/{x}")
    os.rmdir(f"{folder}-tmp")


def stored(spark, sink):
    return sorted((r.competencia, r.CD_ATENDIMENTO) for r in spark.read.parquet(f"{sink}/atendimentos").collect())


def test_backfill_equals_loads_of_one_report_each(spark, tmp_dir):
    schema = spark.createDataFrame([], "CD_ATENDIMENTO string").schema
    landing, one, many = (f"{tmp_dir}/{x}" for x in ("landing", "one", "many"))
    write(spark, f"{landing}/atendimentos_2025_01", ["1", "2", "2"], 0)
    ingest_available(spark, landing, many, f"{tmp_dir}/ck-many", schema)
    write(spark, f"{landing}/atendimentos_2025_02", ["2", "3"], 0)
    ingest_available(spark, landing, many, f"{tmp_dir}/ck-many", schema)
    ingest_available(spark, landing, one, f"{tmp_dir}/ck-one", schema)
    want = [("2025-01", "1"), ("2025-01", "2"), ("2025-02", "2"), ("2025-02", "3")]
    assert stored(spark, many) == want == stored(spark, one)
    write(spark, f"{landing}/atendimentos_2025_02", ["4"], 1)   # a part file of a report loaded before
    ingest_available(spark, landing, many, f"{tmp_dir}/ck-many", schema)
    assert stored(spark, many) == [*want, ("2025-02", "4")]


def test_blocks_are_stable_for_wide_rows(spark):
    wide = spark.range(6000).select(
        (F.col("id") % 3).alias("k"), F.col("id").alias("t"), F.when(F.col("id") % 11 == 0, F.col("id")).alias("v"),
        *[F.concat(F.lit(f"pad{i}-"), "id").alias(f"p{i}") for i in range(12)]).repartition(7)
    blocked = scan.range_blocks(wide, ["k"], ["t"], 8)
    got = scan.forward_fill(blocked, ["v"], partition_by=["k"], order_by=["t"], block_by="__blk").select("k", "t", "v").collect()
    filled = {r.t: r.v for r in got}
    state = {}
    for t in range(6000):
        state[t % 3] = t if t % 11 == 0 else state.get(t % 3)
        assert filled[t] == state[t % 3]


def test_missing_keys_are_registered_once(spark):
    schema = "nr_atendimento long, teste string, competencia string"
    batch = spark.createDataFrame([(None, "r", None), (1, "r", None), (None, "r", "2025-01"), (None, "r", None)], schema)
    first = curation.register_new(batch, spark.createDataFrame([], schema))
    assert first.count() == 3
    assert curation.register_new(batch, first).count() == 0


def test_numbers_ranks_and_private_columns(spark):
    texts = spark.createDataFrame([("12",), ("1.5",), ("NaN",), ("nan",), ("x",), (None,)], "t string")
    assert [r[0] for r in texts.select(C.is_numeric("t")).collect()] == [True, True, False, False, False, False]
    close = spark.createDataFrame([("a", 10.0000001), ("b", 10.0000002)], "s string, v double").select(
        "s", F.lit("2025-01").alias("competencia"), *[F.col("v").alias(m.column) for m in ranking.DEFAULT_METRICS])
    got = {r.s: r.conversao for r in ranking.weighted_ranking(close, "competencia").collect()}
    assert got == {"a": 2, "b": 1}
    frame = spark.createDataFrame([(1, "n", "d")], "id int, `Nm_Paciente ` string, DT_NASC string")
    assert reports.drop_pii(frame, reports.VISIT_PII).columns == ["id"]
    with pytest.raises(ValueError):
        reports.drop_pii(frame, reports.VISIT_PII, required=True)


def test_admission_without_origin_is_no_suspect(spark):
    visits = spark.createDataFrame([(1, 10, "2025-01-01", "2025-01-01 10:00:00", "A - x", "ALTA"), (2, 11, "2025-01-01", "2025-01-01 10:00:00", "A - x", "ALTA"),
                                    (1, 10, "2025-02-01", "2025-02-01 10:00:00", "A - x", "ALTA")],
                                   "atend_PA long, CD_PACIENTE long, d string, t string, CID string, MOTIVO_ALTA string").select(
        "atend_PA", "CD_PACIENTE", F.to_date("d").alias("DT_ATENDIMENTO"), F.to_timestamp("t").alias("DT_HR_TOTEM_RECEP"), "CID", "MOTIVO_ALTA")
    links = spark.createDataFrame([(1, 100, None), (2, 200, "AMBULATORIO")], "CD_ATENDIMENTO long, ATENDIMENTO long, ORIGEM_ATEND string")
    got = domain.assemble_visit_mart(visits, None, links, None, None).collect()
    assert sorted((r.atend_PA, r.fl_suspeito_conversao, r.atend_internacao) for r in got) == [(1, 0, None), (1, 0, None), (2, 1, None)]
    hot = spark.createDataFrame([(1, k, "EMERGENCIA ADULTO") for k in range(40)], "CD_ATENDIMENTO long, ATENDIMENTO long, ORIGEM_ATEND string")
    assert domain.assemble_visit_mart(visits, None, hot, None, None).count() == 81   # a row per valid admission and period, and visit 2


def test_ranked_percentiles(spark):
    rows = [("a", float(v)) for v in (5, 1, 9, 9, 2, 7, 3)] + [("b", 4.0), ("c", None), (None, 1.0), (None, 2.0)]
    frame = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.p50, r.p90) for r in journey.ranked_percentiles(frame, "g", "v", {"p50": 0.5, "p90": 0.9}, 3).collect()}
    want = {r.g: (r.p50, r.p90) for r in frame.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("p50"), F.percentile("v", F.lit(0.9)).alias("p90")).collect()}
    assert set(got) == set(want)
    for g, pair in want.items():
        assert got[g] == pair or all(abs(a - b) < 1e-9 for a, b in zip(got[g], pair))


def test_shared_folder_is_required_off_local_mode(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)
    with pytest.raises(RuntimeError):
        checkpoint_root(Session())
