"""What the columns of a report may be.  Only columns on the list are stored, so a
personal column cannot reach a table under a new name; a report with a column that
nobody knows, or without one that is needed, is refused."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow.sources.reports import ADMISSION_PII, VISIT_PII


@dataclass(frozen=True)
class Contract:
    """``stored``: the columns kept, in this order; ``required``: those of them a report
    must have; ``dropped``: known columns that are never stored."""

    stored: tuple[str, ...]
    required: tuple[str, ...]
    dropped: tuple[str, ...] = ()

    def problems(self, names: Column) -> Column:
        """Array of texts, empty if a report with these column names (an array, see
        ``plain``) may be loaded."""
        def array(values: Sequence[str]) -> Column:
            return F.array(*[F.lit(v) for v in values]).cast("array<string>")
        twice = F.array_distinct(F.filter(names, lambda n: F.size(F.filter(names, lambda m: m == n)) > 1))
        return F.concat(
            F.transform(F.array_except(array(self.required), names), lambda n: F.concat(F.lit("falta "), n)),
            F.transform(F.array_except(names, array(self.stored + self.dropped)), lambda n: F.concat(F.lit("desconhecida "), n)),
            F.transform(twice, lambda n: F.concat(F.lit("repetida "), n)))


def plain(names: Column) -> Column:
    """Column names without padding and case."""
    return F.transform(names, lambda n: F.upper(F.trim(n)))


# fixed values: the columns of the two tabular reports
VISITS = Contract(
    stored=("EMPRESA", "CD_ATENDIMENTO", "CD_PACIENTE", "IDADE", "SEXO", "CEP", "CIDADE", "UF", "CONVENIO", "ESPECIALIDADE",
            "DT_ATENDIMENTO", "DT_HR_TOTEM_RECEP", "CHAMADA_CLASSIFICACAO", "INICIO_CLASSIFICACAO", "DT_HR_CLASSIF_RISCO",
            "CHAMADA_CAD_RECEP", "DH_CADASTRO_RECEPCAO", "FIM_CAD_RECEP", "DH_ATEND_MEDICO", "INI_ATD_MEDICO",
            "FIM_ATD_MEDICO", "DT_HR_ALTA", "CLASSIFICACAO", "COR_CLASSIF", "PRESTADOR", "CID", "MOTIVO_ALTA"),
    required=("EMPRESA", "CD_ATENDIMENTO", "CD_PACIENTE", "DT_ATENDIMENTO", "DT_HR_TOTEM_RECEP"),
    dropped=VISIT_PII)
ADMISSIONS = Contract(
    stored=("COD_PACIENTE", "ATENDIMENTO", "ORIGEM_ATEND", "DT_HR_ATENDIMENTO", "LEITO", "UNIDADE"),
    required=("COD_PACIENTE", "ATENDIMENTO", "ORIGEM_ATEND", "DT_HR_ATENDIMENTO"),
    dropped=ADMISSION_PII)
CONTRACTS = {"atendimentos": VISITS, "internacoes": ADMISSIONS}
