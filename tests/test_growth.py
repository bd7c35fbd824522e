"""What a query's time, memory and shuffle grow with, read from plans and small runs."""

from pyspark.sql import functions as F

from wardflow import session
from wardflow.operators import link, quality
from wardflow.plans import domain
from wardflow.sources.contracts import Contract
from wardflow.streaming import ingest


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_lines_are_parsed_to_the_widest_header(spark):
    """Columns are looked up once a file, and a line is parsed as far as a header goes."""
    contract = Contract(stored=("A", "B", "C"), required=("A",))
    lines = spark.createDataFrame([("f", 0, 0, "p", "B,A"), ("f", 0, 1, "p", 'x,"y,z"'), ("g", 0, 0, "p", "C,A,B"), ("g", 0, 1, "p", "1,2"), ("g", 0, 2, "p", "")],
                                  "__path string, __blk long, __pos long, competencia string, value string")
    headers = spark.createDataFrame([("f", 0, ["B", "A"]), ("g", 0, ["C", "A", "B"])], "__path string, __first long, names array<string>")
    rows = ingest._by_name(lines, headers, contract)
    assert sorted(map(tuple, rows.select("A", "B", "C").fillna("-").collect())) == [("-", "-", "-"), ("2", "-", "1"), ("y,z", "x", "-")]
    plan = _plan(rows)
    assert "_c2" in plan and "_c3" not in plan
    assert "array_position" not in plan


def test_arriving_files_are_read_as_text_once(spark, tmp_dir):
    """After the names of a batch's files, its lines are read once; the rest reads what was stored."""
    report = f"{tmp_dir}/landing/internacoes_2024_01.csv"
    spark.createDataFrame([("1", "7", "X", "2024-01-01 00:00:00")], "COD_PACIENTE string, ATENDIMENTO string, ORIGEM_ATEND string, DT_HR_ATENDIMENTO string").coalesce(1).write.option("header", True).csv(report)
    read = spark.sparkContext.accumulator(0)

    def counted(v):
        read.add(1)
        return v
    seen = F.udf(counted, "string").asNondeterministic()
    batch = ingest._with_file(spark.read.option("recursiveFileLookup", "true").text(report))
    load = ingest.text_arrivals(f"{tmp_dir}/raw", f"{tmp_dir}/stream")
    load.read_folders = lambda s, folders: ingest._with_file(s.read.option("recursiveFileLookup", "true").text(folders)).withColumn("value", seen("value"))
    load(batch, 0)
    assert read.value == 2   # a header and a row
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/raw/internacoes").select("ATENDIMENTO", "ORIGEM_ATEND").collect()] == [("7", "X")]


def _tasks(df) -> int:
    return df.rdd.getNumPartitions()


def test_spread_follows_the_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_A_TASK", 100)
    rows = spark.range(1050)
    assert _tasks(session.spread(rows, "id")) == 11
    assert _tasks(session.spread(rows, "id", rows=0)) == 1
    assert session.spread(rows, "id").agg(F.sum("id"), F.count("id")).first() == (1050 * 1049 // 2, 1050)


def _combined_first(df) -> bool:
    """Whether rows are aggregated in the tasks that read them, before any shuffle."""
    lines = _plan(df).splitlines()
    return any("partial_" in x for i, x in enumerate(lines) if not any("Exchange" in y for y in lines[i:]))


def test_unique_rule_holds_no_split_of_keys(spark, monkeypatch):
    """The keys are shuffled into tasks of bounded size before they are counted."""
    monkeypatch.setattr(session, "ROWS_A_TASK", 2)
    rows = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1), (2, None), (3, 3)], "a int, b int")
    got = quality.duplicate_keys(rows, ["a", "b"], "u")
    assert "hashpartitioning(a#" in _plan(got) and ", 4), REPARTITION_BY_NUM" in _plan(got)
    assert not _combined_first(got)
    assert [tuple(r) for r in got.collect()] == [("u", "1|1", 2)]


def test_register_batch_holds_no_split_of_visits(spark, monkeypatch):
    """The grain rule and the lookup of periods aggregate tasks of bounded size."""
    monkeypatch.setattr(session, "ROWS_A_TASK", 2)
    mart = spark.createDataFrame([(1, "2024-01-01", "A", 0), (1, "2024-01-01", "A", 0), (2, "2024-01-01", "B", 1), (3, "2024-02-01", None, 0), (3, "2024-01-01", None, 0)],
                                 "atend_PA long, competencia string, SERVICO string, fl_suspeito_conversao int").withColumn("competencia", F.col("competencia").cast("date"))
    none = mart.select(F.lit("regra").alias("teste"), F.col("atend_PA").alias("nr_atendimento"), F.lit(None).cast("date").alias("competencia"), F.lit(None).cast("string").alias("servico"))
    got = domain.register_batch(mart, none.where("nr_atendimento = 3").limit(1), "2026-01-01 00:00:00")
    assert _plan(got).count("REPARTITION_BY_NUM") == 2
    found = sorted((r.teste[:4], r.nr_atendimento, str(r.competencia), r.servico) for r in got.collect())
    assert found == [("dbt_", 1, "2024-01-01", "A"), ("fl_s", 2, "2024-01-01", "B"), ("regr", 3, "2024-01-01", "NAO_IDENTIFICADO")]


def test_return_days_are_spread(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_A_TASK", 2)
    rows = spark.createDataFrame([(1, 7, "a", "2024-01-01"), (2, 7, "a", "2024-01-03"), (3, 7, "b", "2024-01-02"), (4, None, "a", "2024-01-02")],
                                 "id long, p long, c string, d string").withColumn("d", F.col("d").cast("date"))
    got = link.returning_ids(rows, id_col="id", patient="p", code="c", day="d")
    assert "REPARTITION_BY_NUM" in _plan(got)
    assert [r[0] for r in got.collect()] == [1]
