"""The review round trip: decisions of reviewers on registered cases are checked,
stored in their tables, and the cases leave the queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators import curation
from wardflow.operators.quality import STATUS_REVIEWED
from wardflow.operators.tables import same_hash
from wardflow.session import materialize
from wardflow.sources import reports
from wardflow.sources.merge import merge_by_key

#: Columns of a decision; ``tipo`` is the class of its case, ``leito``, ``unidade`` and
#: ``tipo_leito`` are the bed of a confirmed conversion.
DECISION = ("id_decisao string, id_inconsistencia string, tipo string, decidido_por string, decidido_em timestamp, "
            "campo_afetado string, valor_original string, valor_imputado string, flag_prevalece string, justificativa string, "
            "decisao string, atend_internacao string, leito string, unidade string, tipo_leito string")
REJECTED = "id_decisao string, id_inconsistencia string, problemas string, competencia date"


def _same_case(a: Column, b: Column) -> Column:
    """Equal ids, sorted and dealt as numbers: an id is 64 characters."""
    return same_hash(F.xxhash64(a), F.xxhash64(b), [(a, b)]) & a.isNotNull()


def routed(decisions: DataFrame, register: DataFrame) -> DataFrame:
    """Decisions with the visit and period of their case, their table (``destino``)
    and their problems.  A decision without a registered case, of another class than
    its case, or with a field or flag that does not exist, is rejected."""
    case = register.select(F.col("id_inconsistencia").alias("__case"), F.col("tipo").alias("__class"), "nr_atendimento", "competencia")
    known = decisions.join(case, _same_case(decisions["id_inconsistencia"], case["__case"]), "left")
    tagged = curation.tag_decisions(known.withColumn("destino", F.col("leito")))
    table = curation.DECISION_TARGETS
    target = F.col("destino")
    more = F.array_compact(F.array(
        F.when(F.col("__case").isNull(), "caso_desconhecido"),
        F.when(F.col("__class") != F.col("tipo"), "classe_diferente"),
        F.when((target == table["integridade"]) & ~F.coalesce(F.col("campo_afetado").isin(list(curation.CORRECTABLE_FIELDS)), F.lit(False)), "campo_desconhecido"),
        F.when((target == table["logica_negocio"]) & ~F.coalesce(F.col("flag_prevalece").isin("conversao", "evasao"), F.lit(False)), "flag_desconhecida"),
        F.when((target == table["conversao"]) & ~F.coalesce(F.col("decisao").isin("confirmado", "descartado"), F.lit(False)), "decisao_desconhecida")))
    checked = tagged.withColumn("problemas", F.concat("problemas", more))
    return checked.withColumn("destino", F.when(F.size("problemas") > 0, curation.REJECTED).otherwise(target)).drop("__case", "__class")


def store_decisions(spark: SparkSession, root: str, decisions: DataFrame) -> dict[str, DataFrame]:
    """Check, route and store decisions and mark their cases reviewed; returns the
    rows that changed, by table.

    Everything is a keyed merge that rewrites the touched periods only: the same
    decisions again change nothing, a decision that comes again with other values
    replaces itself, and a call that broke off is simply repeated.  The register
    comes last, so no case leaves the queue before its decision is stored.
    """
    schemas = reports.CURATION_SCHEMAS
    register = reports.read_curation(spark, root)["curadoria_inconsistencias"]
    rows = materialize(routed(decisions, register), "decisions")
    targets = curation.DECISION_TARGETS

    def merged(table: str, part: DataFrame, schema: str, key: str | list[str]) -> DataFrame:
        keys = [*([key] if isinstance(key, str) else key), "competencia"]
        return merge_by_key(part, reports.layer_path(root, "curadoria", table), schema, keys)

    def to(table: str) -> DataFrame:
        return rows.where(F.col("destino") == table)

    imputed, logic, conversion = targets["integridade"], targets["logica_negocio"], targets["conversao"]
    changed = {
        imputed: merged(imputed, to(imputed).withColumn("id_imputacao", F.col("id_decisao")), schemas[imputed] + ", competencia date", "id_imputacao"),
        logic: merged(logic, to(logic), schemas[logic] + ", competencia date", "id_decisao"),
        # the bed's type is the table's ``tipo``; the decision's is the class of the case
        conversion: merged(conversion, to(conversion).select(
            F.col("nr_atendimento").cast("string").alias("CD_ATENDIMENTO"), "decisao", "competencia", "atend_internacao",
            F.col("leito").alias("destino"), "unidade", F.col("tipo_leito").alias("tipo"), "decidido_por", "decidido_em"),
            schemas[conversion], ["CD_ATENDIMENTO", "decidido_em"]),
        curation.REJECTED: merged(curation.REJECTED, to(curation.REJECTED).withColumn("problemas", F.array_join("problemas", ",")), REJECTED, "id_decisao"),
    }
    decided = rows.where(F.col("destino") != curation.REJECTED).select(F.col("id_inconsistencia").alias("__d"))
    left = register.where(~F.col("status").eqNullSafe(F.lit(STATUS_REVIEWED)))   # of the others nothing would change
    reviewed = (left.join(decided, _same_case(left["id_inconsistencia"], decided["__d"]), "left_semi")
                        .withColumn("status", F.lit(STATUS_REVIEWED)))
    name = "curadoria_inconsistencias"
    changed[name] = merged(name, reviewed, schemas[name], "id_inconsistencia")
    return changed
