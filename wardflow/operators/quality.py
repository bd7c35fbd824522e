"""Data-quality rules that return their violations as rows.

Every row rule yields the uniform columns ``(teste, nr_atendimento,
competencia, servico)`` so the register needs no special cases.  All row rules
over one table run in a single pass: each row carries an array of
``(rule, hit)`` structs, filtered and inlined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.columns import lookup
from wardflow.session import spread

VIOLATION_COLS = ("teste", "nr_atendimento", "competencia", "servico")

# fixed values: rule name → class; unknown rules are "nao_mapeado"
RULE_CLASS = {
    "conversao_evasao_exclusivos": "logica_negocio",
    "idade_nao_negativa": "integridade",
    "movimentacoes_nulos_invalidos": "integridade",
    "atend_medico_apos_classif_risco": "sequencia_temporal",
    "classif_risco_apos_totem": "sequencia_temporal",
    "fim_atend_medico_apos_inicio": "sequencia_temporal",
    "permanencia_nao_negativa": "sequencia_temporal",
    "dbt_utils_unique_combination_of_columns_atendimentos_pa_atend_PA__competencia": "integridade",
    "classificacao_apos_totem_inicio": "sequencia_temporal",
    "classif_risco_apos_inicio_classificacao": "sequencia_temporal",
    "cadastro_apos_classif_risco": "sequencia_temporal",
    "fim_cadastro_apos_inicio": "sequencia_temporal",
    "atend_medico_apos_fim_cadastro": "sequencia_temporal",
    # suspects of conversion are registered with their own class
    "fl_suspeito_conversao": "conversao",
}
UNMAPPED = "nao_mapeado"
# fixed values: rules whose cases cannot be corrected
NOT_FIXABLE = (
    "classificacao_apos_totem_inicio",
    "classif_risco_apos_inicio_classificacao",
    "cadastro_apos_classif_risco",
    "fim_cadastro_apos_inicio",
    "atend_medico_apos_fim_cadastro",
)
STATUS_PENDING = "pendente"
STATUS_NOT_FIXABLE = "nao_corrigivel"
STATUS_REVIEWED = "revisado"


@dataclass(frozen=True)
class Rule:
    name: str
    violation: Column    # TRUE marks a violating row; NULL counts as passing


def run_row_rules(df: DataFrame, rules: Sequence[Rule], *, id_col: str,
                  period_col: str | None, service_col: str | None) -> DataFrame:
    """Evaluate all ``rules`` in one pass; one output row per (row, failed rule)."""
    hits = F.array(*[F.struct(F.lit(r.name).alias("teste"),
                              F.coalesce(r.violation, F.lit(False)).alias("__hit"))
                     for r in rules])
    period = F.col(period_col) if period_col else F.lit(None)
    service = F.col(service_col).cast("string") if service_col else F.lit(None).cast("string")
    return (df.select(F.col(id_col).cast("long").alias("nr_atendimento"),
                      period.alias("competencia"), service.alias("servico"),
                      F.inline(F.filter(hits, lambda x: x["__hit"])))
              .select(*VIOLATION_COLS))


def before(later: str, earlier: str) -> Column:
    """Sequence rule: ``later`` happened before ``earlier`` (both set)."""
    return F.col(later) < F.col(earlier)


def not_null_rule(col: str, table: str) -> Rule:
    return Rule(f"not_null_{table}_{col}", F.col(col).isNull())


def accepted_values_rule(col: str, values: Sequence, table: str) -> Rule:
    """NULL passes, as in the reference's generic rule."""
    return Rule(f"accepted_values_{table}_{col}", ~F.col(col).isin(list(values)))


def duplicate_keys(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Group + HAVING count > 1: ``(teste, chave, n)`` per duplicated key.
    NULL keys are skipped (the reference's unique rule ignores them).  Almost every key
    of a table that holds what it should occurs once, so the rows are spread first."""
    nonnull = F.lit(True)
    for k in keys:
        nonnull = nonnull & F.col(k).isNotNull()
    return (spread(df.select(*dict.fromkeys(keys)).where(nonnull), *keys, rows=df.count()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1)
              .select(F.lit(rule).alias("teste"),
                      F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("chave"),
                      "n"))


def classify(violations: DataFrame, class_map: Mapping[str, str] = RULE_CLASS,
             not_fixable: Sequence[str] = NOT_FIXABLE) -> DataFrame:
    """Add ``tipo`` (class, unknown → nao_mapeado) and initial ``status``."""
    return violations.withColumns({
        "tipo": lookup("teste", class_map, UNMAPPED),
        "status": F.when(F.col("teste").isin(list(not_fixable)), F.lit(STATUS_NOT_FIXABLE))
                   .otherwise(F.lit(STATUS_PENDING)),
    })


@dataclass(frozen=True)
class TableRules:
    """What holds for one table: columns never NULL, columns with a fixed set of
    values (NULL passes), keys that are unique, and rules of its own."""
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence] | None = None
    unique: Mapping[str, Sequence[str]] | None = None   # rule name → key columns
    own: Sequence[Rule] = ()


def count_violations(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> DataFrame:
    """``(teste, casos)`` for every rule of every table, passing ones with 0: one
    aggregation per table for its row rules, and one per key for duplicated keys."""
    parts = []
    for table, r in rules.items():
        df = tables[table]
        checks = ([not_null_rule(c, table) for c in r.not_null]
                  + [accepted_values_rule(c, v, table) for c, v in (r.accepted or {}).items()] + list(r.own))
        if checks:
            counts = df.agg(*[F.count_if(F.coalesce(x.violation, F.lit(False))).alias(f"c{i}") for i, x in enumerate(checks)])
            listed = F.array(*[F.struct(F.lit(x.name).alias("teste"), F.col(f"c{i}").alias("casos")) for i, x in enumerate(checks)])
            parts.append(counts.select(F.inline(listed)))
        for name, keys in (r.unique or {}).items():
            parts.append(duplicate_keys(df, keys, name).agg(F.count(F.lit(1)).alias("casos"))
                         .select(F.lit(name).alias("teste"), "casos"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_by_period(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules], periods: Mapping[str, str]) -> DataFrame:
    """``(teste, competencia, casos)`` for every rule of every table and each period
    it holds (``periods``: the period column by table).  Counts of one period follow from
    its rows alone, so they are made again only where a period was; repeated keys
    are those repeated inside a period."""
    out = None
    for table, r in rules.items():
        if table not in periods:
            continue
        period = periods[table]
        df = tables[table]
        checks = ([not_null_rule(c, table) for c in r.not_null if c != period]
                  + [accepted_values_rule(c, v, table) for c, v in (r.accepted or {}).items()] + list(r.own))
        counted = df.groupBy(F.col(period).alias("competencia")).agg(
            *[F.count_if(F.coalesce(x.violation, F.lit(False))).alias(f"c{i}") for i, x in enumerate(checks)])
        listed = F.array(*[F.struct(F.lit(x.name).alias("teste"), F.col(f"c{i}").alias("casos")) for i, x in enumerate(checks)])
        parts = [counted.select("competencia", F.inline(listed)).select("teste", "competencia", "casos")]
        for name, keys in (r.unique or {}).items():
            inside = list(dict.fromkeys([*keys, period]))
            some = F.lit(True)
            for k in keys:
                some = some & F.col(k).isNotNull()
            groups = df.where(some).groupBy(*inside).agg((F.count(F.lit(1)) > 1).cast("long").alias("t"))
            parts.append(groups.groupBy(F.col(period).alias("competencia")).agg(F.sum("t").alias("casos")).select(F.lit(name).alias("teste"), "competencia", "casos"))
        for p in parts:
            out = p if out is None else out.unionByName(p)
    return out
