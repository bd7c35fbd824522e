"""Inconsistency register and human decisions, as tables.

Decisions are append-only DataFrames; statuses are *derived* by joins instead
of being updated in place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.columns import (blank_to, first_non_empty, safe_date, safe_datetime,
                                        safe_long, stable_id)
from wardflow.operators.quality import STATUS_PENDING, STATUS_REVIEWED, classify
from wardflow.operators.tables import same_hash
from wardflow.session import materialize, spread

# fixed values: the 19 correctable fields and how a correction is typed
CORRECTABLE_FIELDS = {
    "CD_PACIENTE": "long", "IDADE": "long", "SEXO": "string", "CEP": "string",
    "CIDADE": "string", "UF": "string", "CONVENIO": "string", "SERVICO": "string",
    "COR_CLASSIF": "string", "PRESTADOR": "string", "ESPECIALIDADE": "string",
    "CID": "string", "MOTIVO_ALTA": "string", "DT_ATENDIMENTO": "date",
    "DT_HR_TOTEM_RECEP": "datetime", "DT_HR_CLASSIF_RISCO": "datetime",
    "INI_ATD_MEDICO": "datetime", "FIM_ATD_MEDICO": "datetime", "DT_HR_ALTA": "datetime",
}
SUFFIX = "_corrigido"
REGISTER_COLS = ("id_inconsistencia", "tipo", "teste", "nr_atendimento", "competencia",
                 "servico", "detectado_em", "status")
# fixed values: decision classes and their target tables
DECISION_TARGETS = {
    "integridade": "curadoria_imputacao_integridade",
    "sequencia_temporal": "curadoria_imputacao_integridade",
    "logica_negocio": "curadoria_decisao_logica",
    "conversao": "curadoria_conversao",
}
NOT_IDENTIFIED = "NAO_IDENTIFICADO"


def corrections_wide(inconsistencies: DataFrame, imputations: DataFrame,
                     logic: DataFrame, fields: Sequence[str] = tuple(CORRECTABLE_FIELDS)) -> DataFrame:
    """One row per visit: ``nr_atendimento, flag_prevalece, <field>_corrigido…``.

    Several corrections of one field resolve by text ``max``; several logic
    decisions of one visit resolve to the latest ``decidido_em`` (ties by
    decision id), so the grain holds.
    """
    ids = inconsistencies.select("id_inconsistencia", "nr_atendimento")
    imp = imputations.join(ids, "id_inconsistencia", "inner")
    wide = (imp.groupBy("nr_atendimento")
               .pivot("campo_afetado", list(fields))
               .agg(F.max("valor_imputado")))
    wide = wide.select("nr_atendimento", *[F.col(f).alias(f + SUFFIX) for f in fields])
    dec = logic.join(ids, "id_inconsistencia", "inner")
    dec = (dec.groupBy("nr_atendimento")
              .agg(F.max_by("flag_prevalece", F.struct("decidido_em", "id_decisao")).alias("flag_prevalece")))
    merged = dec.alias("d").join(wide.alias("w"), F.col("d.nr_atendimento") == F.col("w.nr_atendimento"), "full")
    return merged.select(
        F.coalesce(F.col("d.nr_atendimento"), F.col("w.nr_atendimento")).alias("nr_atendimento"),
        F.col("d.flag_prevalece").alias("flag_prevalece"),
        *[F.col("w." + f + SUFFIX) for f in fields])


def _typed(text: Column, kind: str) -> Column:
    if kind == "long":
        return safe_long(text)
    if kind == "date":
        return safe_date(text)
    if kind == "datetime":
        return safe_datetime(text)
    return text


def apply_corrections(df: DataFrame, corrections: DataFrame, *, id_col: str,
                      spec: Mapping[str, str] = CORRECTABLE_FIELDS,
                      key: str = "nr_atendimento") -> DataFrame:
    """Left join the wide corrections and override each field with its typed
    correction (``coalesce(try-typed correction, original)``).  Keeps
    ``flag_prevalece``.  Fields of ``spec`` absent from ``df`` are skipped."""
    present = [f for f in spec if f in df.columns]
    corr = corrections.select(F.col(key).alias("__key"), "flag_prevalece",
                              *[F.col(f + SUFFIX) for f in present])
    j = df.join(corr, df[id_col] == corr["__key"], "left")
    return (j.withColumns({f: F.coalesce(_typed(F.col(f + SUFFIX), spec[f]), F.col(f)) for f in present})
             .drop("__key", *[f + SUFFIX for f in present]))


def with_period(violations: DataFrame, period_lookup: DataFrame, lookup_id: str = "atend_PA",
                lookup_period: str = "competencia") -> DataFrame:
    """Violations with a missing period looked up by visit id (the least, if there are
    several).  Only the visits that lack one are looked up; mostly there are none."""
    undated = materialize(violations.where(F.col("competencia").isNull() & F.col("nr_atendimento").isNotNull())
                          .select(F.col("nr_atendimento").alias("__undated")).distinct(), "register-undated")
    if undated.isEmpty():
        return violations
    ids = period_lookup.select(F.col(lookup_id).cast("long").alias("__id"), F.col(lookup_period).alias("__per"))
    ids = ids.join(undated, ids["__id"] == undated["__undated"], "left_semi")
    lk = spread(ids, "__id").groupBy("__id").agg(F.min("__per").alias("__per"))
    return (violations.join(lk, violations["nr_atendimento"] == lk["__id"], "left")
            .withColumn("competencia", F.coalesce("competencia", "__per"))
            .drop("__id", "__per"))


def register_rows(violations: DataFrame, detected_at: Column | str, *,
                  period_lookup: DataFrame | None = None, lookup_id: str = "atend_PA",
                  lookup_period: str = "competencia") -> DataFrame:
    """Violations → register rows (8 columns).  A missing period is looked up
    by visit id with one left join; a missing service becomes
    NAO_IDENTIFICADO; the id is a hash of (rule, visit, period)."""
    v = violations if period_lookup is None else with_period(violations, period_lookup, lookup_id, lookup_period)
    det = F.lit(detected_at) if isinstance(detected_at, str) else detected_at
    v = classify(v).withColumns({
        "servico": first_non_empty(["servico"], NOT_IDENTIFIED),
        "detectado_em": det.cast("timestamp"),
        "id_inconsistencia": stable_id("teste", "nr_atendimento", "competencia"),
    })
    return v.select(*REGISTER_COLS)


def register_new(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose (visit, rule, period) is neither registered yet
    nor repeated inside the batch.  Keys compare as text, like the reference; columns
    of one type need not become text for that.

    Both sides are dealt and sorted by a 64-bit hash of the key, not by the key."""
    names = ("nr_atendimento", "teste", "competencia")
    alike = [dict(batch.dtypes)[c] == dict(existing.dtypes)[c] for c in names]

    def keys(df: DataFrame) -> list[Column]:
        return [F.col(c) if same else F.col(c).cast("string") for c, same in zip(names, alike)]
    own, held = ([f"__{x}{i}" for i in (1, 2, 3)] for x in "ke")
    b = batch.withColumns({"__h": F.xxhash64(*keys(batch)), **dict(zip(own, keys(batch)))})
    b = b.repartition("__h").dropDuplicates(["__h", *own])
    e = existing.select(F.xxhash64(*keys(existing)).alias("__eh"), *[k.alias(c) for c, k in zip(held, keys(existing))])
    # a missing visit or period is a key too
    return b.join(e, same_hash(b["__h"], e["__eh"], [(b[x], e[y]) for x, y in zip(own, held)]), "left_anti").drop("__h", *own)


def pending_periods(register: DataFrame) -> DataFrame:
    """Distinct periods with pending cases, newest first."""
    return (register.where(F.col("status") == STATUS_PENDING)
                    .select("competencia").distinct()
                    .orderBy(F.col("competencia").desc()))


def pending_cases(register: DataFrame, period: Column | None = None) -> DataFrame:
    """Pending cases of the requested period when it has any, else of the
    newest pending period.  Chosen with a one-row aggregate, not a collect."""
    pend = register.where(F.col("status") == STATUS_PENDING)
    agg = [F.max("competencia").alias("__newest")]
    if period is not None:
        agg.append(F.max(F.when(F.col("competencia") == period, F.lit(1))).alias("__has"))
    choice = pend.agg(*agg)
    if period is not None:
        choice = choice.select(F.when(F.col("__has") == 1, period).otherwise(F.col("__newest")).alias("__sel"))
    else:
        choice = choice.select(F.col("__newest").alias("__sel"))
    return pend.join(F.broadcast(choice), pend["competencia"] == choice["__sel"], "inner").drop("__sel")


def decision_status(register: DataFrame, decided_ids: DataFrame) -> DataFrame:
    """Status after decisions: a decided ``id_inconsistencia`` → revisado."""
    d = decided_ids.select(F.col("id_inconsistencia").alias("__d")).distinct()
    j = register.join(d, register["id_inconsistencia"] == d["__d"], "left")
    return (j.withColumn("status", F.when(F.col("__d").isNotNull(), F.lit(STATUS_REVIEWED))
                                    .otherwise(F.col("status")))
             .drop("__d"))


def _decision_checks(decisions: DataFrame) -> Column:
    """Array of the problems of a decision row (empty when valid): author
    required; a confirmed conversion needs admission, bed, unit and type."""
    def blank(c: str) -> Column:
        return F.col(c).isNull() | (F.trim(F.col(c)) == "")
    checks = [("autor_ausente", blank("decidido_por"))]
    conv = (F.col("tipo") == "conversao") & (F.col("decisao") == "confirmado")
    for c in ("atend_internacao", "destino", "unidade", "tipo_leito"):
        checks.append((f"{c}_ausente", conv & blank(c)))
    arr = F.array(*[F.struct(F.lit(n).alias("problema"), F.coalesce(cond, F.lit(False)).alias("__hit"))
                    for n, cond in checks])
    return F.transform(F.filter(arr, lambda x: x["__hit"]), lambda x: x["problema"])


def validate_decisions(decisions: DataFrame) -> DataFrame:
    """Problems of decision rows as ``(id_decisao, problema)``."""
    return (decisions.select("id_decisao", F.explode(_decision_checks(decisions)).alias("problema")))


REJECTED = "rejeitadas"


def tag_decisions(decisions: DataFrame, targets: Mapping[str, str] = DECISION_TARGETS) -> DataFrame:
    """One pass: each decision row gets its destination table (``destino``)
    — the target of its class, or ``rejeitadas`` for an unknown class or an
    invalid row — and the list of its problems.  A blank imputed value falls
    back to the original one."""
    dest = None
    for cls, table in targets.items():
        dest = (F.when(F.col("tipo") == cls, F.lit(table)) if dest is None
                else dest.when(F.col("tipo") == cls, F.lit(table)))
    out = decisions.withColumn("problemas", _decision_checks(decisions))
    out = out.withColumn("destino", F.when(F.size("problemas") > 0, F.lit(REJECTED))
                                      .otherwise(F.coalesce(dest.otherwise(F.lit(None)), F.lit(REJECTED))))
    if "valor_imputado" in decisions.columns and "valor_original" in decisions.columns:
        out = out.withColumn("valor_imputado", blank_to("valor_imputado", "valor_original"))
    return out


def route_decisions(decisions: DataFrame, targets: Mapping[str, str] = DECISION_TARGETS) -> dict:
    """Decision rows split by destination table (views of one tagged pass)."""
    tagged = tag_decisions(decisions, targets)
    return {t: tagged.where(F.col("destino") == t) for t in [*dict.fromkeys(targets.values()), REJECTED]}


# ---------------------------------------------------------------- what decisions amount to

def curation_state(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per visit that any decision concerns: the wide corrections, the
    prevailing flag, and the latest conversion decision (``decisao``)."""
    wide = corrections_wide(tables["curadoria_inconsistencias"], tables["curadoria_imputacao_integridade"], tables["curadoria_decisao_logica"])
    conv = (tables["curadoria_conversao"].groupBy(safe_long("CD_ATENDIMENTO").alias("__id"))
            .agg(F.max_by("decisao", F.struct("decidido_em", "decisao")).alias("decisao")))
    both = wide.join(conv, wide["nr_atendimento"] == conv["__id"], "full")
    return both.select(F.coalesce("nr_atendimento", "__id").alias("nr_atendimento"), *[c for c in wide.columns if c != "nr_atendimento"], "decisao")


def changed_visits(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id) of the visits whose row differs between two ``curation_state`` tables."""
    facts = [c for c in new.columns if c != "nr_atendimento"]
    was = old.select(F.col("nr_atendimento").alias("__id"), F.struct(*facts).alias("__was"))
    both = new.select("nr_atendimento", F.struct(*facts).alias("__is")).join(was, F.col("nr_atendimento") == F.col("__id"), "full")
    return both.where(~F.col("__was").eqNullSafe(F.col("__is"))).select(F.coalesce("nr_atendimento", "__id").alias("id")).where("id IS NOT NULL")
