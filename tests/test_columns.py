import datetime as dt

from pyspark.sql import functions as F

from wardflow.functions import columns as C


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).collect()[0]["x"]


def test_minute_rules(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 1)
    df = spark.createDataFrame([(a, b)], "s timestamp_ntz, e timestamp_ntz")
    r = df.select(C.minutes_boundary("e", "s").alias("b"), C.minutes_whole("e", "s").alias("w")).collect()[0]
    assert (r.b, r.w) == (1, 0)


def test_excel_serial_and_plain_text(spark):
    df = spark.createDataFrame([("45979.6125",), ("2025-11-18 14:42:00",), (None,)], "t string")
    got = [r.x for r in df.select(C.excel_or_datetime("t").alias("x")).collect()]
    assert got == [dt.datetime(2025, 11, 18, 14, 42), dt.datetime(2025, 11, 18, 14, 42), None]


def test_service_category(spark):
    rows = [(14, "CLINICA MEDICA"), (15, "CLINICA MEDICA"), (-1, "GENERALISTA"), (None, "CLINICA MEDICA"),
            (10, "CIRURGIA GERAL"), (40, "ORTOPEDIA/TRAUMATOLOGIA"), (40, "MEDICO CARDIOLOGISTA"),
            (5, "CIRURGIA CARDIOVASCULAR"), (30, "OFTALMO")]
    df = spark.createDataFrame(rows, "age long, esp string")
    got = [r.x for r in df.select(C.service_category("age", "esp").alias("x")).collect()]
    assert got == ["PEDIATRIA", "CLINICA MEDICA", "PEDIATRIA", "OUTROS", "CIRURGIA GERAL",
                   "ORTOPEDIA/TRAUMATOLOGIA", "CARDIOLOGIA", "PEDIATRIA", "OUTROS"]


def test_age_band_and_shift(spark):
    df = spark.createDataFrame([(a,) for a in (0, 2, 3, 14, 15, 19, 59, 60, -1, None)], "a long")
    got = [r.x for r in df.select(C.age_band("a").alias("x")).collect()]
    assert got == ["0 a 2", "0 a 2", "3 a 5", "12 a 14", "15 a 19", "15 a 19", "50 a 59",
                   "60 ou mais", "60 ou mais", None]
    hours = [dt.datetime(2024, 1, 1, h) for h in (6, 7, 11, 12, 17, 18, 23, 0)] + [None]
    df = spark.createDataFrame([(h,) for h in hours], "t timestamp_ntz")
    got = [r.x for r in df.select(C.shift_of_day("t").alias("x")).collect()]
    assert got == ["Madrugada", "Manhã", "Manhã", "Tarde", "Tarde", "Noite", "Noite", "Madrugada", None]


def test_sla_band_and_target(spark):
    start = dt.datetime(2024, 1, 1, 0, 0)
    rows = [(start, start + dt.timedelta(minutes=m)) for m in (-1, 0, 360, 361, 720, 721)] + [(start, None)]
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz")
    r = df.select(C.sla_band("s", "e").alias("b"), C.in_target_flag("s", "e").alias("f"),
                  C.step_minutes("s", "e").alias("g"), C.minutes_between("s", "e").alias("u")).collect()
    assert [x.b for x in r] == ["Registro inconsistente", "Dentro da meta", "Dentro da meta", "Fora da meta",
                                "Fora da meta", "Muito fora da meta", "Alta não registrada"]
    assert [x.f for x in r] == [1, 1, 1, 0, 0, 0, 0]          # negative stays count as met
    assert [x.g for x in r] == [None, 0, 360, 361, 720, 721, None]   # guarded
    assert [x.u for x in r] == [-1, 0, 360, 361, 720, 721, None]     # unguarded keeps negatives


def test_text_helpers(spark):
    df = spark.createDataFrame([("123 - DR. ANA ",), ("SEM SEPARADOR",), (None,)], "p string")
    assert [r.x for r in df.select(C.token("p").alias("x")).collect()] == ["DR. ANA", None, None]
    df = spark.createDataFrame([("NaT",), ("nan",), ("x",)], "v string")
    assert [r.x for r in df.select(C.null_sentinels("v").alias("x")).collect()] == [None, None, "x"]
    df = spark.createDataFrame([(" 12:30:00 ",), ("12:30",), ("1",), (None,)], "v string")
    assert [r.x for r in df.select(C.is_time("v").alias("x")).collect()] == [True, False, False, False]
    assert [r.x for r in df.select(C.is_numeric("v").alias("x")).collect()] == [False, False, True, False]
    df = spark.createDataFrame([("",), (None,), ("AZUL",)], "c string")
    assert [r.x for r in df.select(C.default_if_blank("c").alias("x")).collect()] == [
        "Ausência de Classificação", "Ausência de Classificação", "AZUL"]
    df = spark.createDataFrame([(dt.date(2025, 3, 1),)], "d date")
    assert df.select(C.period_label("d").alias("x")).collect()[0].x == "Mar/2025"
    df = spark.createDataFrame([(1,), (6,), (7,), (None,)], "r long")
    assert [r.x for r in df.select(C.rank_points("r", (100, 90, 70, 50, 30, 10)).alias("x")).collect()] == [
        100, 10, None, None]


def test_time_text_lookup_and_ids(spark):
    df = spark.createDataFrame([("07:30",), ("7:30",), (None,)], "h string")
    assert [r.x for r in df.select(C.hhmm_to_time_text("h").alias("x")).collect()] == ["07:30:00", None, None]
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    got = [r.x for r in df.select(C.lookup("k", {"a": "A"}, "nao_mapeado").alias("x")).collect()]
    assert got == ["A", "nao_mapeado", "nao_mapeado"]
    df = spark.createDataFrame([("r", 1, "2025-01")], "t string, n long, p string")
    import hashlib
    assert df.select(C.stable_id("t", "n", "p").alias("x")).collect()[0].x == hashlib.sha256(b"r|1|2025-01").hexdigest()
    df = spark.createDataFrame([(" ", "orig"), ("novo", "orig"), (None, "orig")], "a string, b string")
    assert [r.x for r in df.select(C.blank_to("a", "b").alias("x")).collect()] == ["orig", "novo", "orig"]
