"""The emergency-department model composed from the library operators:
raw (all-string) → staged → visit mart → aggregated marts → rules → register.

Column names of the domain appear here only; the operators take names as
arguments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import columns as C
from wardflow.operators import curation, journey, link, quality, ranking, states, tables
from wardflow.session import materialize, spread

# fixed values: admission origins that count as a conversion of the ED visit
VALID_ORIGINS = ("EMERGENCIA ADULTO", "EMERGENCIA INFANTIL")
JOURNEY_TS = ("DT_HR_TOTEM_RECEP", "CHAMADA_CLASSIFICACAO", "INICIO_CLASSIFICACAO",
              "DT_HR_CLASSIF_RISCO", "CHAMADA_CAD_RECEP", "DH_CADASTRO_RECEPCAO",
              "FIM_CAD_RECEP", "DH_ATEND_MEDICO", "INI_ATD_MEDICO", "FIM_ATD_MEDICO", "DT_HR_ALTA")
# fixed values: step names and order of the percentile and volume marts
PERCENTILE_STEPS = (
    ("Espera classificação", "minutos_espera_classificacao", 1),
    ("Duração classificação", "minutos_duracao_classificacao", 2),
    ("Espera cadastro", "minutos_espera_cadastro", 3),
    ("Duração cadastro", "minutos_duracao_cadastro", 4),
    ("Espera atendimento médico", "minutos_espera_medica_pos_cadastro", 5),
    ("Duração atendimento médico", "minutos_duracao_atendimento_medico", 6),
    ("Tempo permanência", "minutos_permanencia_total", 7),
)
VOLUME_MILESTONES = (
    ("Totem", "DT_HR_TOTEM_RECEP", 1), ("Início Classificação", "INICIO_CLASSIFICACAO", 2),
    ("Fim Classificação", "DT_HR_CLASSIF_RISCO", 3), ("Início Cadastro", "DH_CADASTRO_RECEPCAO", 4),
    ("Fim Cadastro", "FIM_CAD_RECEP", 5), ("Início Médico", "INI_ATD_MEDICO", 6),
    ("Fim Médico", "FIM_ATD_MEDICO", 7), ("Alta", "DT_HR_ALTA", 8),
)
PERCENTILE_KEYS = ("SERVICO", "competencia", "turno", "CONVENIO", "COR_CLASSIF", "grupo_cid")
VOLUME_KEYS = PERCENTILE_KEYS + ("faixa_sla",)


# ----------------------------------------------------------------- staging

def stage_visits(raw: DataFrame, company: str | None = "HSR") -> DataFrame:
    """Raw visits (all text) → typed visits, service and colour cleaned.

    Every raw row stays: an id that comes back in another period is a row of
    that period (the mart's grain is visit and period), and an id repeated
    inside one is what the ``unique`` rules report."""
    df = raw
    if company is not None and "EMPRESA" in df.columns:
        df = df.where(F.col("EMPRESA") == company)
    typed = df.select(
        C.strict_long("CD_PACIENTE").alias("CD_PACIENTE"),
        C.strict_long("CD_ATENDIMENTO").alias("CD_ATENDIMENTO"),
        C.strict_long("IDADE").alias("IDADE"),
        "SEXO", "CEP", "CIDADE", "UF", "CONVENIO", "ESPECIALIDADE", "CLASSIFICACAO", "COR_CLASSIF",
        "PRESTADOR", "CID", "MOTIVO_ALTA",
        C.strict_date("DT_ATENDIMENTO").alias("DT_ATENDIMENTO"),
        *[C.excel_or_datetime(c).alias(c) for c in JOURNEY_TS],
        C.period_date("competencia").alias("competencia"))
    return typed.select(
        "CD_PACIENTE", "CD_ATENDIMENTO", "IDADE", "SEXO", "CEP", "CIDADE", "UF", "CONVENIO",
        C.service_category("IDADE", "ESPECIALIDADE").alias("SERVICO"),
        "DT_ATENDIMENTO", "DT_HR_TOTEM_RECEP", "CHAMADA_CLASSIFICACAO", "INICIO_CLASSIFICACAO",
        "DT_HR_CLASSIF_RISCO", "CLASSIFICACAO",
        F.replace(F.col("COR_CLASSIF"), F.lit("AMARELO1"), F.lit("AMARELO")).alias("COR_CLASSIF"),
        "CHAMADA_CAD_RECEP", "DH_CADASTRO_RECEPCAO", "FIM_CAD_RECEP", "DH_ATEND_MEDICO",
        "INI_ATD_MEDICO", "FIM_ATD_MEDICO",
        C.token("PRESTADOR", " - ", 1).alias("PRESTADOR"),
        "ESPECIALIDADE", "CID", "DT_HR_ALTA", "MOTIVO_ALTA", "competencia")


def stage_admissions(raw: DataFrame) -> DataFrame:
    return raw.select(
        C.strict_long("COD_PACIENTE").alias("COD_PACIENTE"),
        C.strict_long("ATENDIMENTO").alias("ATENDIMENTO"),
        "ORIGEM_ATEND",
        C.excel_or_datetime("DT_HR_ATENDIMENTO").alias("DT_HR_ATENDIMENTO"),
        "LEITO", "UNIDADE",
        C.period_date("competencia").alias("competencia"))


def stage_movements(raw: DataFrame) -> DataFrame:
    s = {c: C.null_sentinels(c) for c in raw.columns}
    return raw.select(
        C.strict_long(s["ATEND"]).alias("ATENDIMENTO"),
        C.time_text(s["HORA"]).alias("HORA"),
        *[s[c].alias(c) for c in ("TIPO", "ORIGEM", "DESTINO", "TIP_ACOM", "CID", "CONVENIO",
                                  "MOTIVO_ALTA", "UNIDADE")],
        C.safe_date(s["DATA"]).alias("DATA"),
        C.period_date("competencia").alias("COMPETENCIA"))


def movements_from_cells(cells: DataFrame, period: str | None = None, keep_file: bool = False) -> DataFrame:
    """Positional movement report rows → raw movements (all text); with
    ``keep_file`` the file each row came from stays."""
    from wardflow.operators.layouts import normalise_layouts
    from wardflow.sources.reports import MOVEMENT_PII, carry_headers, drop_pii, period_from_path
    withhdr = carry_headers(cells)
    rows = normalise_layouts(withhdr, "cells", keep=["file", "UNIDADE", "DATA"])
    rows = drop_pii(rows, list(MOVEMENT_PII))
    per = F.lit(period) if period else period_from_path("file")
    rows = rows.withColumn("competencia", per)
    return rows if keep_file else rows.drop("file")


# ----------------------------------------------------------------- visit mart

def last_movement(movements: DataFrame, beds: DataFrame, order_by: Sequence = (("HORA", "desc"),)) -> DataFrame:
    """Last movement per admission (default: by time of day only, as the
    reference; pass ``(("DATA","desc"),("HORA","desc"))`` for the intended
    order), with the unit replaced by the bed dimension's."""
    order = list(order_by) + [(c, "desc") for c in ("DATA", "HORA", "DESTINO", "TIPO")
                              if (c, "desc") not in order_by]
    last = link.top1(movements, ["ATENDIMENTO"], order)
    b = beds.select(F.col("Leito").alias("__leito"), F.col("Unidade").alias("__unidade"))
    return (last.drop("UNIDADE").join(b, F.col("DESTINO") == F.col("__leito"), "left")
                .withColumnRenamed("__unidade", "Unidade").drop("__leito"))


def admissions_with_bed(adm: DataFrame, last_mov: DataFrame, beds: DataFrame) -> DataFrame:
    m = last_mov.select(F.col("ATENDIMENTO").alias("__at"), F.col("DESTINO").alias("__dest"),
                        F.col("Unidade").alias("__uni"))
    j = adm.join(m, adm["ATENDIMENTO"] == m["__at"], "left")
    j = j.withColumns({"LEITO": F.coalesce("__dest", "LEITO"), "UNIDADE": F.coalesce("__uni", "UNIDADE")})
    b = beds.select(F.col("Leito").alias("__leito"), F.col("Tipo").alias("Tipo"))
    j = j.join(b, j["LEITO"] == b["__leito"], "left")
    return j.select("ATENDIMENTO", "COD_PACIENTE", "ORIGEM_ATEND", "DT_HR_ATENDIMENTO", "LEITO", "UNIDADE", "Tipo")


def link_admissions(visits: DataFrame, adm_bed: DataFrame) -> DataFrame:
    """Best visit per admission (one interval join for both origin classes)."""
    last = link.top1(visits, ["CD_PACIENTE", "DT_ATENDIMENTO"],
                     [("DT_HR_TOTEM_RECEP", "desc"), ("CD_ATENDIMENTO", "desc")])
    return link.interval_link(last.select("CD_ATENDIMENTO", "CD_PACIENTE", "DT_ATENDIMENTO", "DT_HR_TOTEM_RECEP"),
                              adm_bed, visit_id="CD_ATENDIMENTO", visit_patient="CD_PACIENTE",
                              visit_day="DT_ATENDIMENTO", visit_ts="DT_HR_TOTEM_RECEP",
                              adm_id="ATENDIMENTO", adm_patient="COD_PACIENTE",
                              adm_ts="DT_HR_ATENDIMENTO", max_days=1)


#: Valid admissions of one visit beyond which its rows are made apart from the others'.
MANY_ADMISSIONS = 10_000


def assemble_visit_mart(visits: DataFrame, logic: DataFrame | None, links: DataFrame,
                        curated: DataFrame | None, cid_seed: DataFrame | None, *,
                        valid_origins: Sequence[str] = VALID_ORIGINS, link_visit: str = "CD_ATENDIMENTO",
                        link_adm: str = "ATENDIMENTO", link_origin: str = "ORIGEM_ATEND",
                        link_extra: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Visit ⟕ {decision, linked admission, 48h return, suspect, curated
    conversion, CID chapter} and the derived flags.  ``visits`` needs
    ``atend_PA, CD_PACIENTE, DT_ATENDIMENTO, DT_HR_TOTEM_RECEP, CID,
    MOTIVO_ALTA``."""
    v = visits
    # 48h return: the (patient, code, day) shuffles run on a narrow projection;
    # the wide table only ever shuffles on the visit id (shared by all joins)
    ret = (link.returning_ids(v, id_col="atend_PA", patient="CD_PACIENTE", code="CID", day="DT_ATENDIMENTO")
               .select(F.col("atend_PA").alias("__rid")))
    v = (v.join(ret, v["atend_PA"] == ret["__rid"], "left")
          .withColumn("fl_retorno_48h", F.when(F.col("__rid").isNotNull(), 1).otherwise(0)).drop("__rid"))
    if logic is not None and "flag_prevalece" not in v.columns:
        lg = logic.select(F.col("nr_atendimento").alias("__lid"), "flag_prevalece")
        v = v.join(lg, v["atend_PA"] == lg["__lid"], "left").drop("__lid")
    elif "flag_prevalece" not in v.columns:
        v = v.withColumn("flag_prevalece", F.lit(None).cast("string"))
    # Suspects: the distinct ids of visits linked to an admission of another,
    # known origin (no origin is neither valid nor suspect).
    lk = links.select(F.col(link_visit).alias("__lv"), F.col(link_adm).alias("atend_internacao"),
                      F.col(link_origin).alias("ORIGEM_ATEND"), *[F.col(a).alias(b) for a, b in link_extra])
    lk = materialize(lk, "links")
    is_valid = F.col("ORIGEM_ATEND").isin(list(valid_origins))
    suspects = lk.where(~is_valid).select(F.col("__lv").alias("__sus")).distinct()
    v = (v.join(suspects, v["atend_PA"] == suspects["__sus"], "left")
          .withColumn("fl_suspeito_conversao", F.when(F.col("__sus").isNotNull(), 1).otherwise(0)).drop("__sus"))
    # Q2 grain: a visit row per valid admission, else the row as it is; the wide rows
    # are read once.  Visits of very many admissions go by an inner join, of which
    # either side can be split.
    good = lk.where(is_valid)
    crowded = (good.groupBy(F.col("__lv").alias("__many")).agg(F.count(F.lit(1)).alias("n"))
                   .where(F.col("n") > MANY_ADMISSIONS).select("__many"))
    if crowded.isEmpty():
        v = v.join(good, v["atend_PA"] == good["__lv"], "left").drop("__lv")
    else:
        crowded = materialize(crowded, "crowded-visits")
        few, many = (good.join(crowded, good["__lv"] == crowded["__many"], how) for how in ("left_anti", "left_semi"))
        rest = v.join(crowded, v["atend_PA"] == crowded["__many"], "left_anti")
        v = (rest.join(few, rest["atend_PA"] == few["__lv"], "left").drop("__lv")
                 .unionByName(v.join(many, v["atend_PA"] == many["__lv"]).drop("__lv")))
    if curated is not None:
        cur = curated.select(C.safe_long("CD_ATENDIMENTO").alias("__cid"), "decisao",
                             *(["decidido_em"] if "decidido_em" in curated.columns else []))
        if "decidido_em" in cur.columns:
            cur = cur.groupBy("__cid").agg(F.max_by("decisao", F.struct("decidido_em", "decisao")).alias("decisao"))
        else:
            cur = cur.groupBy("__cid").agg(F.max("decisao").alias("decisao"))
        v = v.join(cur, v["atend_PA"] == cur["__cid"], "left").drop("__cid")
    else:
        v = v.withColumn("decisao", F.lit(None).cast("string"))
    if cid_seed is not None:
        seed = cid_seed.select(F.col("codigo_cid").alias("__code"), "capitulo_cid").dropDuplicates(["__code"])
        v = v.join(seed, C.token("CID", " - ", 0) == seed["__code"], "left").drop("__code")
        v = v.withColumn("grupo_cid", F.trim(F.initcap("capitulo_cid"))).drop("capitulo_cid")
    else:
        v = v.withColumn("grupo_cid", F.lit(None).cast("string"))
    fp = F.col("flag_prevalece")
    return v.withColumns({
        "turno": C.shift_of_day("DT_HR_TOTEM_RECEP"),
        "fl_conversao": (F.when(fp == "conversao", 1).when(fp == "evasao", 0)
                         .when(F.col("atend_internacao").isNotNull(), 1)
                         .when(F.col("decisao") == "confirmado", 1).otherwise(0)),
        "fl_evasao": (F.when(fp == "evasao", 1).when(fp == "conversao", 0)
                      .when(F.col("MOTIVO_ALTA") == "EVASAO", 1).otherwise(0)),
    })


def journey_columns(df: DataFrame) -> DataFrame:
    """Colour default, age band, in-target flag, SLA band and the 8 step
    durations of the visit mart."""
    a, stay = "DT_HR_TOTEM_RECEP", "minutos_permanencia_total"
    steps = {
        "minutos_espera_classificacao": (a, "INICIO_CLASSIFICACAO"),
        "minutos_duracao_classificacao": ("INICIO_CLASSIFICACAO", "DT_HR_CLASSIF_RISCO"),
        "minutos_espera_cadastro": ("DT_HR_CLASSIF_RISCO", "DH_CADASTRO_RECEPCAO"),
        "minutos_duracao_cadastro": ("DH_CADASTRO_RECEPCAO", "FIM_CAD_RECEP"),
        "minutos_espera_medica_pos_cadastro": ("FIM_CAD_RECEP", "INI_ATD_MEDICO"),
        "minutos_duracao_atendimento_medico": ("INI_ATD_MEDICO", "FIM_ATD_MEDICO"),
    }
    # minutes of a time are made once a row, not once a use
    minute = {c: f"__m_{c}" for c in (a, "DT_HR_ALTA", *dict.fromkeys(c for pair in steps.values() for c in pair))}
    timed = df.withColumns({m: C.minute_number(c) for c, m in minute.items()})

    def between(start: str, end: str) -> Column:
        return F.col(minute[end]) - F.col(minute[start])
    out = timed.withColumns({
        "COR_CLASSIF": C.default_if_blank("COR_CLASSIF"),
        "faixa_etaria": C.age_band("IDADE"),
        "fl_alta_na_meta": C.stay_in_target("DT_HR_ALTA", between(a, "DT_HR_ALTA")),
        "faixa_sla": C.stay_band("DT_HR_ALTA", between(a, "DT_HR_ALTA")),
        "minutos_espera_medica": between(a, "INI_ATD_MEDICO"),
        **{name: C.step_of(start, end, between(start, end)) for name, (start, end) in steps.items()},
        stay: between(a, "DT_HR_ALTA"),
    })
    return out.drop(*minute.values())


def build_visit_mart(stg_visits: DataFrame, stg_adm: DataFrame, stg_mov: DataFrame, beds: DataFrame,
                     corrections: DataFrame | None = None, curated: DataFrame | None = None,
                     cid_seed: DataFrame | None = None,
                     movement_order: Sequence = (("HORA", "desc"),)) -> DataFrame:
    v = stg_visits
    if corrections is not None:
        v = curation.apply_corrections(v, corrections, id_col="CD_ATENDIMENTO")
    else:
        v = v.withColumn("flag_prevalece", F.lit(None).cast("string"))
    beds = beds.dropDuplicates(["Leito"])
    last = last_movement(stg_mov, beds, movement_order)
    adm = admissions_with_bed(stg_adm, last, beds)
    links = link_admissions(v, adm)
    v = v.withColumnRenamed("CD_ATENDIMENTO", "atend_PA")
    mart = assemble_visit_mart(v, None, links, curated, cid_seed,
                               link_extra=(("LEITO", "Destino"), ("UNIDADE", "Unidade"), ("Tipo", "Tipo")))
    return journey_columns(mart).drop("decisao", "flag_prevalece", "CLASSIFICACAO")


# ----------------------------------------------------------------- marts

def percentiles_mart(mart: DataFrame, method: str = "approx", cube: bool = False) -> DataFrame:
    """P50/P90 per 6 keys, per period and overall (``cube=True``: also an
    ``Todas`` row per dimension, as the documentation describes)."""
    return journey.step_percentiles(mart, list(PERCENTILE_KEYS), "competencia", PERCENTILE_STEPS,
                                    method=method, cube=cube)


def states_mart(mart: DataFrame) -> DataFrame:
    """Counts of every duration per six keys and step: any percentile of any subset or
    filter of the keys follows from them (``operators.states``), and a period's are made
    again without the others'."""
    return states.duration_states(mart, PERCENTILE_KEYS, PERCENTILE_STEPS)


def volumes_mart(mart: DataFrame) -> DataFrame:
    return journey.step_volumes(mart, list(VOLUME_KEYS), VOLUME_MILESTONES)


def ranking_mart(mart: DataFrame) -> DataFrame:
    ind = ranking.service_indicators(mart, "SERVICO", "competencia")
    return ranking.weighted_ranking(ind, "competencia")


def calendar_mart(mart: DataFrame) -> DataFrame:
    return tables.calendar_dim(mart, "competencia")


# ----------------------------------------------------------------- rules

def mart_rules() -> list[quality.Rule]:
    R, b = quality.Rule, quality.before
    return [
        R("atend_medico_apos_classif_risco",
          b("INI_ATD_MEDICO", "DT_HR_CLASSIF_RISCO") & F.col("COR_CLASSIF").isNotNull()
          & (F.col("COR_CLASSIF") != "VERMELHO")),
        R("atend_medico_apos_fim_cadastro", b("INI_ATD_MEDICO", "FIM_CAD_RECEP")),
        R("cadastro_apos_classif_risco", b("DH_CADASTRO_RECEPCAO", "DT_HR_CLASSIF_RISCO")),
        R("classif_risco_apos_inicio_classificacao", b("DT_HR_CLASSIF_RISCO", "INICIO_CLASSIFICACAO")),
        R("classif_risco_apos_totem", b("DT_HR_CLASSIF_RISCO", "DT_HR_TOTEM_RECEP")),
        R("classificacao_apos_totem_inicio", b("INICIO_CLASSIFICACAO", "DT_HR_TOTEM_RECEP")),
        R("conversao_evasao_exclusivos", (F.col("fl_conversao") == 1) & (F.col("fl_evasao") == 1)),
        R("fim_atend_medico_apos_inicio", b("FIM_ATD_MEDICO", "INI_ATD_MEDICO")),
        R("fim_cadastro_apos_inicio", b("FIM_CAD_RECEP", "DH_CADASTRO_RECEPCAO")),
        R("idade_nao_negativa", F.col("IDADE") < 0),
        R("permanencia_nao_negativa", b("DT_HR_ALTA", "DT_HR_TOTEM_RECEP")),
    ]


def run_mart_rules(mart: DataFrame) -> DataFrame:
    return quality.run_row_rules(mart, mart_rules(), id_col="atend_PA", period_col="competencia",
                                 service_col="SERVICO")


def movement_rule(stg_mov: DataFrame) -> DataFrame:
    bad = F.col("ATENDIMENTO").isNotNull() & (F.col("HORA").isNull() | F.col("DESTINO").isNull())
    return quality.run_row_rules(stg_mov, [quality.Rule("movimentacoes_nulos_invalidos", bad)],
                                 id_col="ATENDIMENTO", period_col="COMPETENCIA", service_col=None)


# fixed values: the declared checks of each table
RANKS = ("conversao", "alta_na_meta", "tempo_atend_medico", "evasao", "retorno48h")
FLAGS = ("fl_conversao", "fl_evasao", "fl_retorno_48h")
SHIFTS = ("Manhã", "Tarde", "Noite", "Madrugada")
AGE_BANDS = ("0 a 2", "3 a 5", "6 a 8", "9 a 11", "12 a 14", "15 a 19", "20 a 29", "30 a 39", "40 a 49", "50 a 59", "60 ou mais")
GRAIN_RULE = "dbt_utils_unique_combination_of_columns_atendimentos_pa_atend_PA__competencia"


def declared_rules() -> dict[str, quality.TableRules]:
    """All 53 checks: 40 declared per table and 13 of their own."""
    R = quality.TableRules
    bad_move = F.col("ATENDIMENTO").isNotNull() & (F.col("HORA").isNull() | F.col("DESTINO").isNull())
    return {
        "stg_atendimentos": R(not_null=("CD_PACIENTE", "CD_ATENDIMENTO", "DT_ATENDIMENTO", "DT_HR_TOTEM_RECEP",
                                        "ESPECIALIDADE", "competencia"),
                              unique={"unique_stg_atendimentos_CD_ATENDIMENTO": ("CD_ATENDIMENTO",)}),
        "stg_internacoes": R(not_null=("COD_PACIENTE", "ATENDIMENTO", "DT_HR_ATENDIMENTO", "ORIGEM_ATEND", "competencia"),
                             unique={"unique_stg_internacoes_ATENDIMENTO": ("ATENDIMENTO",)}),
        "stg_movimentacoes": R(not_null=("ATENDIMENTO", "COMPETENCIA"),
                               own=[quality.Rule("movimentacoes_nulos_invalidos", bad_move)]),
        "atendimentos_pa": R(not_null=("atend_PA", *FLAGS, "competencia"),
                             accepted={**{c: (0, 1) for c in FLAGS}, "turno": SHIFTS, "faixa_etaria": AGE_BANDS},
                             unique={GRAIN_RULE: ("atend_PA", "competencia")}, own=mart_rules()),
        "ranking_especialidades": R(
            not_null=("SERVICO", "competencia", "total_pontos", *RANKS), accepted={c: tuple(range(1, 7)) for c in RANKS},
            unique={"dbt_utils_unique_combination_of_columns_ranking_especialidades_SERVICO__competencia": ("SERVICO", "competencia")}),
        "percentis_jornada": R(own=[quality.Rule("p90_maior_igual_p50", F.col("p90") < F.col("p50"))]),
    }


def percentile_rule(pct: DataFrame) -> DataFrame:
    """P90 < P50, keyed by group (no visit id: kept out of the register)."""
    return pct.where(F.col("p90") < F.col("p50"))


def register_cases(mart: DataFrame, violations: DataFrame) -> DataFrame:
    """The violations, the suspects of conversion and the visits that come twice in a
    period, as ``quality.VIOLATION_COLS``."""
    suspects = mart.where(F.col("fl_suspeito_conversao") == 1).select(
        F.lit("fl_suspeito_conversao").alias("teste"), F.col("atend_PA").alias("nr_atendimento"),
        "competencia", F.col("SERVICO").alias("servico"))
    # a group is a row, or few; counted without the service, so by hashing and not by sorting
    keyed = spread(mart.select("atend_PA", "competencia"), "atend_PA", "competencia")
    twice = (keyed.groupBy(F.col("atend_PA").alias("__id"), F.col("competencia").alias("__per")).agg(F.count(F.lit(1)).alias("n"))
                  .where(F.col("n") > 1))
    dup = (mart.join(twice, mart["atend_PA"].eqNullSafe(twice["__id"]) & mart["competencia"].eqNullSafe(twice["__per"]))
               .groupBy("__id", "__per").agg(F.first("SERVICO").alias("servico"))
               .select(F.lit(GRAIN_RULE).alias("teste"), F.col("__id").alias("nr_atendimento"), F.col("__per").alias("competencia"), "servico"))
    return violations.unionByName(suspects).unionByName(dup)


def register_batch(mart: DataFrame, violations: DataFrame, detected_at: Column | str) -> DataFrame:
    return curation.register_rows(register_cases(mart, violations), detected_at, period_lookup=mart)


# ----------------------------------------------------------------- the job

def transform_ready_periods(spark, root: str, beds: DataFrame, cid_seed: DataFrame | None = None,
                            detected_at: str = "1970-01-01 00:00:00", percentile_method: str = "approx") -> dict:
    """The transform job: raw → staged → marts → rules → register, for the
    periods present in all three raw sources only.

    Raw tables live under ``root/raw/<name>`` partitioned by ``competencia``;
    the ready periods are a semi join on that partition column, so only their
    partitions are read (dynamic partition pruning).  Marts are written under
    ``root/marts`` with dynamic partition overwrite (other periods survive);
    staged tables under ``root/staging``; new register rows are appended to
    ``root/curadoria/curadoria_inconsistencias``.  Returns the written paths.
    """
    from wardflow.sources import reports
    names = ("atendimentos", "internacoes", "movimentacoes")
    raw = {n: reports.read_raw(spark, root, n) for n in names}
    ready = (reports.ready_periods({n: df.select("competencia") for n, df in raw.items()}, "competencia")
             .where(F.col("pronto") == 1).select("competencia"))
    sel = {n: df.join(ready, "competencia", "left_semi") for n, df in raw.items()}
    out: dict = {}
    stg_v = _store(spark, root, out, stage_visits(sel["atendimentos"]), "staging", "stg_atendimentos", by_period=True)
    stg_a = _store(spark, root, out, stage_admissions(sel["internacoes"]), "staging", "stg_internacoes", by_period=True)
    stg_m = _store(spark, root, out, stage_movements(sel["movimentacoes"]), "staging", "stg_movimentacoes", period="COMPETENCIA", by_period=True)
    cur = reports.read_curation(spark, root)
    state = materialize(curation.curation_state(cur), "curation-state")
    mart = build_visit_mart(stg_v, stg_a, stg_m, beds, corrections=state.drop("decisao"),
                            curated=cur["curadoria_conversao"], cid_seed=cid_seed)
    mart = materialize(mart, "visit-mart")   # the clustered write reads it twice, for its ranges first
    mart = _store(spark, root, out, mart, "marts", "atendimentos_pa", cluster=MART_CLUSTER)
    _dependents(spark, root, out, mart, mart, stg_v, stg_a, stg_m, cur, detected_at, percentile_method)
    _applied(state, root)
    out["ready"] = ready
    return out


MART_CLUSTER = ("SERVICO", "CONVENIO", "COR_CLASSIF")


def _store(spark, root: str, out: dict, df: DataFrame, layer: str, name: str, period: str = "competencia", cluster=(), by_period: bool = False) -> DataFrame:
    from wardflow.sources import reports
    path = reports.layer_path(root, layer, name)
    reports.write_mart(df, path, partition=period, cluster_by=cluster, by_period=by_period)
    out[name] = path
    return spark.read.parquet(path)


def _dependents(spark, root: str, out: dict, mart: DataFrame, rebuilt: DataFrame, stg_v: DataFrame, stg_a: DataFrame,
                stg_m: DataFrame, cur: dict, detected_at: str, percentile_method: str) -> None:
    """What is made from the stored visit mart: by-period marts of the ``rebuilt``
    periods, percentiles and rule counts of all, and new cases for the register."""
    from wardflow.sources import reports
    from wardflow.sources.merge import merge_by_key
    pct = _store(spark, root, out, percentiles_mart(mart, percentile_method), "marts", "percentis_jornada")
    _store(spark, root, out, states_mart(rebuilt), "marts", "estados_jornada")
    _store(spark, root, out, volumes_mart(rebuilt), "marts", "volume_jornada")
    _store(spark, root, out, ranking_mart(rebuilt), "marts", "ranking_especialidades")
    _store(spark, root, out, calendar_mart(rebuilt), "marts", "dim_competencia")
    rank = spark.read.parquet(out["ranking_especialidades"])
    counts = quality.count_violations({"stg_atendimentos": stg_v, "stg_internacoes": stg_a, "stg_movimentacoes": stg_m, "atendimentos_pa": mart,
                                       "ranking_especialidades": rank, "percentis_jornada": pct}, declared_rules())
    out["regras"] = reports.layer_path(root, "qualidade", "regras")
    counts.write.mode("overwrite").parquet(out["regras"])
    # the history keeps a row per rule and period; those of other periods stay as they are
    history = quality.count_by_period({"atendimentos_pa": rebuilt, "ranking_especialidades": rank.join(rebuilt.select("competencia").distinct(), "competencia", "left_semi")},
                                      declared_rules(), {"atendimentos_pa": "competencia", "ranking_especialidades": "competencia"})
    out["historico"] = reports.layer_path(root, "qualidade", "historico")
    merge_by_key(history, out["historico"], "teste string, competencia date, casos long", ["teste", "competencia"])
    violations = run_mart_rules(rebuilt).unionByName(movement_rule(stg_m))
    cases = curation.with_period(register_cases(rebuilt, violations), rebuilt)
    reg_path = reports.layer_path(root, "curadoria", "curadoria_inconsistencias")
    # ids and classes follow from a case: made last, for the new ones only, behind the shuffles
    new = curation.register_new(cases, cur["curadoria_inconsistencias"]).hint("rebalance", "competencia")
    # by period, so that a decision rewrites the period of its case and no other
    curation.register_rows(new, detected_at).write.mode("append").partitionBy("competencia").parquet(reg_path)
    out["curadoria_inconsistencias"] = reg_path


# ----------------------------------------------------------------- after decisions

def _state_path(root: str) -> str:
    from wardflow.sources import reports
    return reports.layer_path(root, "curadoria_aplicada", "estado")


def _applied(state: DataFrame, root: str) -> None:
    """Note the decisions that the stored marts hold (after the marts, so a job that
    broke off before it applies them again)."""
    state.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(_state_path(root))


#: Days within which one visit can change another's flags: returns of 48 hours
#: (two days), the best visit of an admission (one).
REACH_DAYS = 2


def _placed(stg_visits: DataFrame, state: DataFrame) -> DataFrame:
    """(id, patient, day, competencia) of visits with their corrections."""
    narrow = stg_visits.select("CD_ATENDIMENTO", "CD_PACIENTE", "DT_ATENDIMENTO", "competencia")
    fixed = curation.apply_corrections(narrow, state, id_col="CD_ATENDIMENTO")
    return fixed.select(F.col("CD_ATENDIMENTO").alias("id"), F.col("CD_PACIENTE").alias("patient"), F.col("DT_ATENDIMENTO").alias("day"), "competencia")


def _around(placed: DataFrame, before: int = REACH_DAYS, after: int = REACH_DAYS) -> DataFrame:
    """Distinct (patient, day) within reach of some visits."""
    days = F.explode(F.sequence(F.date_sub("day", before), F.date_add("day", after)))
    return placed.select("patient", "day").distinct().where("patient IS NOT NULL AND day IS NOT NULL").select("patient", days.alias("day")).distinct()


def touched_periods(stg_visits: DataFrame, old: DataFrame, new: DataFrame, ids: DataFrame) -> DataFrame:
    """Periods whose mart rows can differ: of the visits ``ids`` (id) whose decisions
    changed, and of visits of the same patient within reach of them, before and after."""
    changed = stg_visits.join(ids, stg_visits["CD_ATENDIMENTO"] == ids["id"], "left_semi")
    own = materialize(changed.select("competencia").distinct(), "own-periods")
    if _but(stg_visits.select("competencia").distinct(), own).isEmpty():   # no other period to reach
        return own
    places = _around(_placed(changed, old).union(_placed(changed, new)))
    every = _placed(stg_visits, new)
    reached = every.join(places, ["patient", "day"], "left_semi").select("id").union(ids.select("id")).distinct()
    return every.join(reached, "id", "left_semi").select("competencia").distinct()


def _but(periods: DataFrame, some: DataFrame) -> DataFrame:
    return periods.join(some.withColumnRenamed("competencia", "__p"), F.col("competencia").eqNullSafe(F.col("__p")), "left_anti")


def rebuild_inputs(stg_visits: DataFrame, stg_adm: DataFrame, stg_mov: DataFrame, state: DataFrame,
                   periods: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The staged rows that the mart rows of ``periods`` follow from: their visits, rows of
    the same ids, visits of their patients within reach, and the admissions of all
    these with their movements.  Where that is most of the visits, all staged rows: to
    choose among them takes longer than to link the others too."""
    inside = stg_visits.join(periods, "competencia", "left_semi").count()
    if 2 * inside > stg_visits.count():
        return stg_visits.where("CD_ATENDIMENTO IS NOT NULL AND competencia IS NOT NULL"), stg_adm, stg_mov
    every = _placed(stg_visits, state)
    own = every.join(every.join(periods, "competencia", "left_semi").select("id").distinct(), "id", "left_semi")
    places = materialize(_around(own), "rebuild-places")
    chosen = own.unionByName(every.join(places, ["patient", "day"], "left_semi"))
    chosen = materialize(chosen.distinct(), "rebuild-visits")
    keys = chosen.select(F.col("id").alias("CD_ATENDIMENTO"), "competencia").distinct()
    visits = stg_visits.join(keys, ["CD_ATENDIMENTO", "competencia"], "left_semi")
    days = _around(chosen, 0, 1)
    admissions = stg_adm.join(days, (stg_adm["COD_PACIENTE"] == days["patient"]) & (F.to_date(stg_adm["DT_HR_ATENDIMENTO"]) == days["day"]), "left_semi")
    return visits, admissions, stg_mov.join(admissions.select("ATENDIMENTO").distinct(), "ATENDIMENTO", "left_semi")


def refresh_after_decisions(spark, root: str, beds: DataFrame, cid_seed: DataFrame | None = None,
                            detected_at: str = "1970-01-01 00:00:00", percentile_method: str = "approx") -> DataFrame:
    """Bring the stored marts up to the stored decisions; returns the periods rebuilt.

    What changed is the difference between the decisions the marts were built with
    and those stored now, so it does not matter how often or when decisions were
    stored.  Only ``touched_periods`` are rebuilt (dynamic partition overwrite); the
    result is that of a full rebuild.
    """
    from wardflow.sources import reports
    cur = reports.read_curation(spark, root)
    state = materialize(curation.curation_state(cur), "curation-state")
    old = reports.read_or_empty(spark, _state_path(root), state.schema)
    ids = materialize(curation.changed_visits(old, state), "changed-visits")
    stg_v, stg_a, stg_m = (spark.read.parquet(reports.layer_path(root, "staging", f"stg_{n}")) for n in ("atendimentos", "internacoes", "movimentacoes"))
    periods = materialize(touched_periods(stg_v, old, state, ids), "touched-periods")
    if periods.isEmpty():
        return periods
    out: dict = {}
    visits, admissions, movements = rebuild_inputs(stg_v, stg_a, stg_m, state, periods)
    part = build_visit_mart(visits, admissions, movements, beds, corrections=state.drop("decisao"),
                            curated=cur["curadoria_conversao"], cid_seed=cid_seed)
    # read to its end before the partitions it replaces are written
    part = materialize(part.join(periods, "competencia", "left_semi"), "rebuilt-mart")
    mart = _store(spark, root, out, part, "marts", "atendimentos_pa", cluster=MART_CLUSTER)
    _dependents(spark, root, out, mart, mart.join(periods, "competencia", "left_semi"), stg_v, stg_a, stg_m, cur, detected_at, percentile_method)
    _applied(state, root)
    return periods
