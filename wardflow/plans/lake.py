"""Bindings of the lake's flows to the driver's test tables: arrival of reports in
several runs, and the review round trip with what it changes.

The reports are those of ``bindings.ed_raw_tables``; a report's period follows from
the events' days, eight days being a period, so returns and links cross periods.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.operators import layouts, quality, states
from wardflow.plans import domain, review
from wardflow.plans.bindings import DETECTED_AT, ED_INPUTS, ED_MART_COLS, _stored_ed_mart, ed_raw_tables
from wardflow.session import materialize, scratch_path
from wardflow.sources import control, reports
from wardflow.streaming import ingest


def period_of(ts: str) -> Column:
    """Eight days a period: days 1 to 8 are 01, days 9 to 16 are 02, and so on."""
    part = F.floor((F.dayofmonth(ts) - 1) / 8) + 1
    return F.concat(F.date_format(ts, "yyyy-"), F.lpad(part.cast("string"), 2, "0"))


PERIODS = ("2024-01", "2024-02", "2024-03", "2024-04")


# ----------------------------------------------------------------- arrivals

def _movement_lines(movements: DataFrame) -> DataFrame:
    """Movements as lines of a positional report: unit and date headers, then the
    rows of the date, in the first layout."""
    places = {place: F.col(name) for name, place in layouts.MOVEMENT_LAYOUTS[0][1].items() if name in movements.columns}

    def line(cells: dict[int, Column]) -> Column:
        return F.concat_ws(",", *[F.coalesce(cells.get(i, F.lit("")), F.lit("")) for i in range(20)])

    days = movements.select("UNIDADE", "DATA").distinct()
    rows = (days.select("UNIDADE", "DATA", F.lit(0).alias("kind"),
                        line({0: F.lit(reports.UNIT_MARKER), reports.UNIT_CELL: F.col("UNIDADE")}).alias("value"))
            .unionByName(days.select("UNIDADE", "DATA", F.lit(1).alias("kind"),
                                     line({0: F.lit(reports.DATE_MARKER), reports.DATE_CELL: F.col("DATA")}).alias("value")))
            .unionByName(movements.select("UNIDADE", "DATA", F.lit(2).alias("kind"), line(places).alias("value"))))
    # a file may begin with any unit and date: the headers sort before their rows
    return rows.repartitionByRange("UNIDADE", "DATA").sortWithinPartitions("UNIDADE", "DATA", "kind", "value").select("value")


def _arrive(spark, sf, folder: str) -> None:
    """A landing folder filled in two runs, in no order of datasets or periods, with
    superseded, refused, undated and unknown reports and one batch repeated.  Under
    ``folder``: the sink (``raw``), and a row for each start of a transform (``started``)."""
    visits, admissions, movements, _, _ = ed_raw_tables(spark, sf, period_of("ts"))
    val = F.col("IDADE").cast("int")
    visits = visits.withColumn("EMPRESA", F.when(val % 10 == 3, "OUTRA").otherwise("HSR"))
    visits = materialize(visits.unionByName(visits.where(val % 10 == 5)), "render-visits")   # ids come twice
    admissions = materialize(admissions, "render-admissions")
    movements = materialize(movements, "render-movements")
    landing, sink, started, checkpoint = (os.path.join(folder, x) for x in ("landing", "raw", "started", "stream"))

    def land(df: DataFrame, name: str, period: str, version: str = "") -> str:
        path = os.path.join(landing, f"{name}_{period.replace('-', '_')}{version}.csv")
        mine = df.where(F.col("competencia") == period).drop("competencia")
        if name == "movimentacoes":
            _movement_lines(mine).write.text(path)
        else:
            mine.write.option("header", True).csv(path)
        return path

    def start(session, periods: list[str]) -> None:
        session.createDataFrame([(p,) for p in periods], "competencia string").coalesce(1).write.mode("append").parquet(started)

    def run() -> None:
        ingest.ingest_reports(spark, landing, sink, checkpoint, on_ready=start)

    p1, p2, p3, p4 = PERIODS
    land(movements, "movimentacoes", p2)
    land(visits, "atendimentos", p3)
    land(visits.where(val < 20), "atendimentos", p1)                       # replaced by a later report
    land(visits.withColumnRenamed("SEXO", "NOME COMPLETO"), "atendimentos", p2)   # breaks its contract
    visits.where(val < 0).drop("competencia").write.option("header", True).csv(os.path.join(landing, "atendimentos.csv"))
    land(movements.where(F.col("DESTINO") < "L3"), "movimentacoes", p1)      # two files of a period in one run
    land(movements, "movimentacoes", p1, "_v2")
    land(admissions, "internacoes", p3)
    run()
    last = [land(visits, "atendimentos", p1, "_v2"), land(admissions, "internacoes", p1), land(visits, "atendimentos", p2, "_v2"),
            land(admissions, "internacoes", p2), land(movements, "movimentacoes", p3)]
    last += [land(df, name, p4) for name, df in (("atendimentos", visits), ("internacoes", admissions))]   # never complete
    unknown = os.path.join(landing, "relatorio_2024_01.csv")
    admissions.drop("competencia").write.option("header", True).csv(unknown)
    run()
    # the last batch comes again, as after a failure before its commit
    again = ingest._with_file(spark.read.option("recursiveFileLookup", "true").text([*last, unknown]))
    ingest.text_arrivals(sink, checkpoint, on_ready=start)(again, 1)


def _arrived(spark, sf) -> tuple[str, str]:
    """The sink and the folder of starts of ``_arrive``."""
    inputs = [f"{sf.rstrip('/')}/{t}.parquet" for t in ED_INPUTS]
    folder = control.derived(spark, "arrivals", inputs, lambda folder: _arrive(spark, sf, folder))
    return os.path.join(folder, "raw"), os.path.join(folder, "started")


def gate_starts(spark, sf):
    """Starts of the transform by period (each once, whatever the order of the
    reports and however often a batch runs), with the rows of its sources."""
    sink, started = _arrived(spark, sf)
    times = spark.read.parquet(started).groupBy("competencia").agg(F.count(F.lit(1)).alias("inicios"))
    claimed = ingest.starts(spark, sink).select("competencia", F.lit(1).alias("reservas"))
    gate = ingest.ready_from_raw(spark, sink).withColumn("competencia", F.col("competencia").cast("string"))
    out = gate.join(times, "competencia", "left").join(claimed, "competencia", "left")
    return out.select("competencia", "n_atendimentos", "n_internacoes", "n_movimentacoes", "pronto",
                      F.coalesce("inicios", F.lit(0)).cast("int").alias("inicios"), F.coalesce("reservas", F.lit(0)).alias("reservas"))


def load_audit(spark, sf):
    """Rows read, stored and left out by report and reason, and whether the report is
    the one in force; the repeated batch adds nothing."""
    sink, _ = _arrived(spark, sf)
    name = F.element_at(F.split("relatorio", "/"), -1).alias("relatorio")
    versions = ingest.report_versions(spark, sink).select("relatorio", "vigente", "recusa")
    # lines of movement reports depend on how many files they were cut into
    audit = ingest.load_audit(spark, sink).where("motivo IN ('gravadas', 'outra_empresa') OR dataset <> 'movimentacoes' AND motivo NOT IN ('lidas', 'cabecalho') "
                                                 "OR dataset IS NULL AND motivo <> 'lidas'")
    kept = audit.where("motivo NOT IN ('recusado', 'substituido', 'sem_competencia', 'sem_destino')")
    lost = audit.where("motivo IN ('recusado', 'substituido', 'sem_competencia', 'sem_destino')").withColumn("linhas", F.lit(-1).cast("long"))
    return kept.unionByName(lost).join(versions, "relatorio").select(name, "motivo", "linhas", "vigente", F.coalesce("recusa", F.lit("")).alias("recusa"))


def arrivals_raw(spark, sf):
    """All raw rows after the three runs, by source."""
    sink, _ = _arrived(spark, sf)
    ids = {"atendimentos": ("CD_ATENDIMENTO", "CD_PACIENTE", "DT_HR_TOTEM_RECEP"), "internacoes": ("ATENDIMENTO", "LEITO", "DT_HR_ATENDIMENTO"),
           "movimentacoes": ("ATEND", "DESTINO", "HORA")}
    out = None
    for name, (own, other, when) in ids.items():
        raw = spark.read.parquet(os.path.join(sink, name))
        part = raw.select(F.lit(name).alias("fonte"), F.col(own).cast("long").alias("id"), F.col(other).alias("outro"), F.col(when).alias("quando"),
                          F.col("competencia").cast("string").alias("competencia"))
        out = part if out is None else out.unionByName(part)
    return out


# ----------------------------------------------------------------- review

def _second(c: str) -> Column:
    """Second of the day, which the bindings' reviewers decide by."""
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def _reviews(root: str, spark) -> DataFrame:
    """A decision on every pending case, derived from its visit's arrival: each of the
    19 fields, both flags, both conversion decisions, and some that are rejected."""
    register = reports.read_curation(spark, root)["curadoria_inconsistencias"].where("status = 'pendente'")
    visits = spark.read.parquet(reports.layer_path(root, "staging", "stg_atendimentos")).select(
        F.col("CD_ATENDIMENTO").alias("v"), F.col("CD_PACIENTE").alias("p"), F.col("DT_HR_TOTEM_RECEP").alias("t"), F.col("DT_ATENDIMENTO").alias("d"))
    cases = register.join(visits, register["nr_atendimento"] == visits["v"]).withColumn("k", _second("t"))

    def later(minutes: int) -> Column:
        return F.date_format(F.col("t") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0)), "dd/MM/yyyy HH:mm:ss")
    values = {
        "CD_PACIENTE": (F.col("p") + 1).cast("string"), "IDADE": F.when(F.col("k") % 2 == 0, "33").otherwise("abc"), "SEXO": F.lit("X"),
        "CEP": F.lit("01000"), "CIDADE": F.lit("OUTRA"), "UF": F.lit("RJ"), "CONVENIO": F.lit("CORRIGIDO"), "SERVICO": F.lit("CARDIOLOGIA"),
        "COR_CLASSIF": F.lit("VERDE"), "PRESTADOR": F.lit("DR C"), "ESPECIALIDADE": F.lit("GERAL"), "CID": F.lit("view - DESCRICAO"),
        "MOTIVO_ALTA": F.lit("EVASAO"), "DT_ATENDIMENTO": F.date_add("d", 1).cast("string"), "DT_HR_TOTEM_RECEP": later(-3),
        "DT_HR_CLASSIF_RISCO": later(9), "INI_ATD_MEDICO": later(31), "FIM_ATD_MEDICO": later(44), "DT_HR_ALTA": later(200)}
    field = F.get(F.array(*[F.lit(f) for f in values]), (F.col("k") % len(values)).cast("int"))
    value = F.get(F.array(*values.values()), (F.col("k") % len(values)).cast("int"))
    conversion = F.col("tipo") == "conversao"
    return cases.select(
        F.sha2(F.concat(F.lit("d|"), "id_inconsistencia"), 256).alias("id_decisao"), "id_inconsistencia", "tipo",
        F.when(F.col("k") % 23 == 0, " ").otherwise("ana").alias("decidido_por"),
        (F.lit("2026-01-02 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("k"))).cast("timestamp").alias("decidido_em"),
        field.alias("campo_afetado"), F.lit("?").alias("valor_original"), value.alias("valor_imputado"),
        F.when(F.col("k") % 2 == 0, "conversao").otherwise("evasao").alias("flag_prevalece"), F.lit("revisto").alias("justificativa"),
        F.when(conversion, F.get(F.array(*[F.lit(x) for x in ("confirmado", "descartado", "talvez")]), (F.col("k") % 3).cast("int"))).alias("decisao"),
        F.when(conversion, F.col("nr_atendimento").cast("string")).alias("atend_internacao"), F.lit("L1").alias("leito"),
        F.lit("U1").alias("unidade"), F.lit("UTI").alias("tipo_leito"))


def review_round(spark, sf, root: str, refresh: bool = True) -> None:
    """Raw reports of several periods under ``root``, the transform job, decisions on
    its cases stored twice, and the marts brought up to them: in the touched
    periods, or (``refresh`` False) by the whole job again."""
    visits, admissions, movements, beds, cid = ed_raw_tables(spark, sf, period_of("ts"))
    for name, raw in (("atendimentos", visits), ("internacoes", admissions), ("movimentacoes", movements)):
        reports.write_raw(raw, reports.layer_path(root, "raw", name))
    domain.transform_ready_periods(spark, root, beds, cid, detected_at=DETECTED_AT)
    decisions = materialize(_reviews(root, spark), "reviews")
    review.store_decisions(spark, root, decisions)
    again = review.store_decisions(spark, root, decisions)
    if not all(rows.isEmpty() for rows in again.values()):
        raise AssertionError("the same decisions changed something")
    if refresh:
        domain.refresh_after_decisions(spark, root, beds, cid, detected_at=REVIEWED_AT)
    else:
        domain.transform_ready_periods(spark, root, beds, cid, detected_at=REVIEWED_AT)


REVIEWED_AT = "2026-01-03 00:00:00"   # fixed detection time of the run after the decisions


def _reviewed(spark, sf) -> str:
    inputs = [f"{sf.rstrip('/')}/{t}.parquet" for t in ED_INPUTS]
    return control.derived(spark, "review", inputs, lambda folder: review_round(spark, sf, folder))


CURATED_COLS = ("SEXO", "CEP", "CIDADE", "UF", "CONVENIO", "ESPECIALIDADE", "CID", "MOTIVO_ALTA", "DT_ATENDIMENTO", "DT_HR_CLASSIF_RISCO",
                "INI_ATD_MEDICO", "FIM_ATD_MEDICO")


def ed_curated_mart(spark, sf):
    """The visit mart after the review: corrections of all 19 fields, both override
    flags and confirmed conversions, in several periods, rebuilt where they reach."""
    mart = spark.read.parquet(reports.layer_path(_reviewed(spark, sf), "marts", "atendimentos_pa"))
    nullable_ints = {"atend_internacao", "minutos_espera_medica", "minutos_duracao_classificacao",
                     "minutos_duracao_atendimento_medico", "minutos_permanencia_total", "IDADE"}
    # nullable integers leave as DOUBLE, so every engine hands pandas one dtype
    return mart.select(*[F.col(c).cast("double").alias(c) if c in nullable_ints else F.col(c) for c in ED_MART_COLS],
                       *[F.col(c).cast("timestamp_ntz").alias(c) if c == "DT_ATENDIMENTO" else F.col(c) for c in CURATED_COLS],
                       F.col("competencia").cast("timestamp_ntz").alias("competencia"))


def review_register(spark, sf):
    """The register after the round trip: decided cases reviewed, rejected decisions'
    cases still pending, and the cases that the corrected rows brought."""
    reg = reports.read_curation(spark, _reviewed(spark, sf))["curadoria_inconsistencias"]
    return reg.select("id_inconsistencia", "tipo", "teste", "nr_atendimento", F.col("competencia").cast("timestamp_ntz").alias("competencia"),
                      "servico", F.col("detectado_em").cast("timestamp_ntz").alias("detectado_em"), "status")


def review_decisions(spark, sf):
    """The stored decisions of the round trip, by table, with what they decide."""
    root = _reviewed(spark, sf)
    cur = reports.read_curation(spark, root)
    rejected = spark.read.parquet(reports.layer_path(root, "curadoria", "rejeitadas"))

    def rows(table: str, df: DataFrame, what: Column, value: Column) -> DataFrame:
        return df.select(F.lit(table).alias("tabela"), what.alias("sobre"), value.alias("valor"), F.col("competencia").cast("timestamp_ntz").alias("competencia"))
    return (rows("imputacao", cur["curadoria_imputacao_integridade"], F.col("id_inconsistencia"), F.concat_ws("=", "campo_afetado", "valor_imputado"))
            .unionByName(rows("logica", cur["curadoria_decisao_logica"], F.col("id_inconsistencia"), F.col("flag_prevalece")))
            .unionByName(rows("conversao", cur["curadoria_conversao"], F.col("CD_ATENDIMENTO"), F.concat_ws("/", "decisao", "destino", "unidade", "tipo")))
            .unionByName(rows("rejeitadas", rejected, F.col("id_inconsistencia"), F.col("problemas"))))


# ----------------------------------------------------------------- percentiles of any subset

def _states(spark, sf) -> DataFrame:
    """The stored states of the reviewed lake: those of the first run, replaced in
    the periods that the decisions touched."""
    return spark.read.parquet(reports.layer_path(_reviewed(spark, sf), "marts", "estados_jornada"))


def states_cube(spark, sf):
    """P50 and P90 of the 7 steps for every combination of kept and rolled-up keys
    (a ``Todas`` row per dimension), from the stored states; the payer, of which there
    are very many, is merged away."""
    keys = [k for k in domain.PERCENTILE_KEYS if k != "CONVENIO"]
    rolled = states.rolled_up(states.merged(_states(spark, sf), keys), keys)
    return states.percentiles(rolled, [*keys, states.ROLLED], {"p50": 0.5, "p90": 0.9})


def states_filtered(spark, sf):
    """Interpolated percentiles (K8) by colour and period of two services outside the
    night, from the same states."""
    some = _states(spark, sf).where("SERVICO IN ('CLINICA MEDICA', 'CARDIOLOGIA') AND turno <> 'Madrugada'")
    out = states.percentiles(states.merged(some, ["COR_CLASSIF", "competencia"]), ["COR_CLASSIF", "competencia"], {"p50": 0.5, "p90": 0.9}, "interpolated")
    return out.withColumns({"competencia": F.col("competencia").cast("timestamp_ntz"), "p50": F.round("p50", 6), "p90": F.round("p90", 6)})


# ----------------------------------------------------------------- clustered marts

def mart_skipping(spark, sf):
    """The domain mart written on a space-filling order of its three filter keys: for each
    key its values and rows read back, and whether the least and greatest values
    of the files leave out at least a quarter of them for a value, on average."""
    mart, _ = _stored_ed_mart(spark, sf)
    path = scratch_path(spark, "clustered")
    reports.write_mart(mart, path, cluster_by=domain.MART_CLUSTER, interleave=True, parts=64)
    back = spark.read.parquet(path).withColumn("__file", F.col("_metadata.file_path"))
    out = None
    for key in domain.MART_CLUSTER:
        files = back.groupBy("__file").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
        # a file admits the values from its least to its greatest: their number is a difference of ranks
        values = back.groupBy(F.col(key).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        ranked = values.withColumn("r", F.row_number().over(Window.partitionBy(F.lit(key)).orderBy("v")))   # a key's values
        low, high = ranked.select(F.col("v").alias("lo"), F.col("r").alias("a")), ranked.select(F.col("v").alias("hi"), F.col("r").alias("b"))
        admits = files.join(low, "lo").join(high, "hi").agg(F.sum(F.col("b") - F.col("a") + 1).alias("s"), F.count(F.lit(1)).alias("f"))
        share = admits.select(F.lit(key).alias("chave"), (F.col("s") / F.col("f")).alias("s"))
        total = values.groupBy(F.lit(key).alias("chave")).agg(F.count(F.lit(1)).alias("valores"), F.sum("n").alias("linhas"))
        both = total.withColumn("s", F.lit(None).cast("double")).unionByName(share, allowMissingColumns=True)
        part = both.groupBy("chave").agg(F.max("valores").alias("valores"), F.max("linhas").alias("linhas"), F.max("s").alias("s"))
        part = part.select("chave", "valores", "linhas", (F.col("s") / F.col("valores") <= 0.75).cast("int").alias("pula"))
        out = part if out is None else out.unionByName(part)
    return out


# ----------------------------------------------------------------- rules

def rule_history(spark, sf):
    """Stored counts of the mart's checks by rule and period after the review; the
    periods that the decisions touched were counted again, the others kept."""
    held = spark.read.parquet(reports.layer_path(_reviewed(spark, sf), "qualidade", "historico"))
    return held.where("casos > 0").select("teste", F.col("competencia").cast("timestamp_ntz").alias("competencia"), "casos")


def _minus(c: str) -> Column:
    return F.col(c) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1), F.lit(0))


def rule_faults(spark, sf):
    """All 53 declared checks on tables into which a fault for each was put, by the
    minute of a row's time: every rule finds cases."""
    visits, admissions, _, _, _ = ed_raw_tables(spark, sf)
    mart, stg_m = _stored_ed_mart(spark, sf)

    def spoil(df: DataFrame, minute: Column, n: int, faults: dict[int, dict[str, Column]], twice: int | None) -> DataFrame:
        """Rows of minute % n = i get the values of fault i; those of ``twice`` come twice."""
        df = materialize(df.withColumn("k", minute % n), "rule-faults")
        changes: dict[str, Column] = {}
        for i, values in faults.items():
            for c, v in values.items():
                changes[c] = F.when(F.col("k") == i, v).otherwise(changes.get(c, F.col(c)))
        out = df.select(*[changes.get(c, F.col(c)).alias(c) for c in df.columns])
        return (out if twice is None else out.unionByName(out.where(F.col("k") == twice))).drop("k")

    none = F.lit(None)
    visit_cols = ("CD_PACIENTE", "CD_ATENDIMENTO", "DT_ATENDIMENTO", "ESPECIALIDADE", "competencia", "DT_HR_TOTEM_RECEP")
    stg_v = spoil(domain.stage_visits(visits), F.minute("DT_HR_TOTEM_RECEP"), 7, {i: {c: none} for i, c in enumerate(visit_cols)}, 6)
    adm_cols = ("COD_PACIENTE", "ATENDIMENTO", "DT_HR_ATENDIMENTO", "ORIGEM_ATEND", "competencia")
    stg_a = spoil(domain.stage_admissions(admissions), F.minute("DT_HR_ATENDIMENTO"), 6, {i: {c: none} for i, c in enumerate(adm_cols)}, 5)
    moves = spoil(stg_m, F.substring("HORA", 4, 2).cast("int"), 3, {0: {"ATENDIMENTO": none}, 1: {"COMPETENCIA": none}, 2: {"DESTINO": none}}, None)
    flags = list(domain.FLAGS)
    before = {11: ("INI_ATD_MEDICO", "DT_HR_CLASSIF_RISCO"), 12: ("INI_ATD_MEDICO", "FIM_CAD_RECEP"), 13: ("DH_CADASTRO_RECEPCAO", "DT_HR_CLASSIF_RISCO"),
              14: ("DT_HR_CLASSIF_RISCO", "INICIO_CLASSIFICACAO"), 15: ("DT_HR_CLASSIF_RISCO", "DT_HR_TOTEM_RECEP"), 16: ("INICIO_CLASSIFICACAO", "DT_HR_TOTEM_RECEP"),
              18: ("FIM_ATD_MEDICO", "INI_ATD_MEDICO"), 19: ("FIM_CAD_RECEP", "DH_CADASTRO_RECEPCAO"), 21: ("DT_HR_ALTA", "DT_HR_TOTEM_RECEP")}
    faults = {0: {"atend_PA": none}, **{i + 1: {c: none} for i, c in enumerate(flags)}, 4: {"competencia": none}, **{i + 5: {c: F.lit(2)} for i, c in enumerate(flags)},
              8: {"turno": F.lit("X")}, 9: {"faixa_etaria": F.lit("X")}, 17: {c: F.lit(1) for c in ("fl_conversao", "fl_evasao")}, 20: {"IDADE": F.lit(-1).cast("long")},
              **{i: {late: _minus(early)} for i, (late, early) in before.items()}}
    faults[11]["COR_CLASSIF"] = F.lit("VERDE")
    spoilt = spoil(mart, F.minute("DT_HR_TOTEM_RECEP"), 22, faults, 10)
    rank = materialize(domain.ranking_mart(mart), "ranking")
    own = list(domain.RANKS)
    changed = {**{c: F.when(F.col("SERVICO") == "CARDIOLOGIA", none).when(F.col("SERVICO") == "PEDIATRIA", 99).otherwise(F.col(c)) for c in own},
               "total_pontos": F.when(F.col("SERVICO") != "CARDIOLOGIA", F.col("total_pontos")),
               "competencia": F.when(F.col("SERVICO") != "CIRURGIA GERAL", F.col("competencia")),
               "SERVICO": F.when(F.col("SERVICO") != "CLINICA MEDICA", F.col("SERVICO"))}
    rank = rank.select(*[changed.get(c, F.col(c)).alias(c) for c in rank.columns])
    rank = rank.unionByName(rank.where("SERVICO = 'ORTOPEDIA/TRAUMATOLOGIA'"))
    pct = domain.percentiles_mart(mart, method="exact").withColumn("p90", F.when(F.col("ordem") == 2, F.col("p50") - 1).otherwise(F.col("p90")))
    return quality.count_violations({"stg_atendimentos": stg_v, "stg_internacoes": stg_a, "stg_movimentacoes": moves, "atendimentos_pa": spoilt,
                                     "ranking_especialidades": rank, "percentis_jornada": pct}, domain.declared_rules())


QUERIES = {f.__name__: f for f in (mart_skipping, rule_history, rule_faults, gate_starts, load_audit, arrivals_raw, ed_curated_mart, review_register, review_decisions,
                                states_cube, states_filtered)}
