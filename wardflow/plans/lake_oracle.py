"""DuckDB SQL for the bindings of ``plans.lake``, from the definitions."""

from __future__ import annotations

import re

from wardflow.plans import oracle as _oracle
from wardflow.plans.oracle import _ED_RULES, ED_BASE, ED_COLS, ED_DOUBLE, ED_PCT_STEPS, STATUS_CASE, TIPO_CASE

#: The rendered reports by period; visits are those of the company, each once.
LAKE = """
e AS (SELECT *, CAST(floor(value / 5) AS BIGINT) - 2 AS idade,
        strftime(ts, '%Y-') || lpad(CAST((day(ts) - 1) // 8 + 1 AS VARCHAR), 2, '0') AS competencia FROM events),
a AS (SELECT * FROM e WHERE event_type <> 'purchase'),
i AS (SELECT * FROM e WHERE event_type = 'purchase'),
m AS (SELECT event_id, 'L' || CAST(CAST(floor(value / 7) AS BIGINT) AS VARCHAR) AS destino, strftime(ts + INTERVAL 30 MINUTE, '%H:%M:%S') AS hora, competencia FROM i
      UNION ALL
      SELECT event_id, 'L' || CAST(CAST(floor(value / 3) AS BIGINT) AS VARCHAR), strftime(ts + INTERVAL 90 MINUTE, '%H:%M:%S'), competencia FROM i WHERE value > 200)"""

SQL = {
    "gate_starts": f"""
WITH {LAKE.strip()},
p AS (SELECT competencia FROM e WHERE competencia <= '2024-04' GROUP BY 1),
g AS (SELECT p.competencia,
  (SELECT count(DISTINCT event_id) FROM a WHERE a.competencia = p.competencia AND idade % 10 <> 3) AS n_atendimentos,
  (SELECT count(DISTINCT event_id) FROM i WHERE i.competencia = p.competencia) AS n_internacoes,
  (SELECT count(*) FROM m WHERE m.competencia = p.competencia AND p.competencia <= '2024-03') AS n_movimentacoes FROM p)
SELECT *, (n_atendimentos > 0 AND n_internacoes > 0 AND n_movimentacoes > 0)::INT AS pronto,
  (n_atendimentos > 0 AND n_internacoes > 0 AND n_movimentacoes > 0)::INT AS inicios,
  (n_atendimentos > 0 AND n_internacoes > 0 AND n_movimentacoes > 0)::INT AS reservas
FROM g WHERE n_atendimentos + n_internacoes + n_movimentacoes > 0""",
    "arrivals_raw": f"""
WITH {LAKE.strip()}
SELECT DISTINCT 'atendimentos' AS fonte, event_id AS id, CAST(user_id AS VARCHAR) AS outro, strftime(ts, '%Y-%m-%d %H:%M:%S') AS quando, competencia
FROM a WHERE idade % 10 <> 3 AND competencia <= '2024-04'
UNION ALL SELECT 'internacoes', event_id, 'L' || CAST(CAST(floor(value / 5) AS BIGINT) AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S'), competencia
FROM i WHERE competencia <= '2024-04'
UNION ALL SELECT 'movimentacoes', event_id, destino, hora, competencia FROM m WHERE competencia <= '2024-03'""",
    "load_audit": f"""
WITH {LAKE.strip()},
v AS (SELECT competencia, count(*) + count(*) FILTER (idade % 10 = 5) AS lidas, count(*) FILTER (idade % 10 = 3) AS outra,
        count(*) FILTER (idade % 10 = 5) AS vezes, count(*) FILTER (idade % 10 <> 3) AS boas,
        count(*) FILTER (idade < 20 AND idade % 10 <> 3) AS boas20, count(*) FILTER (idade < 20 AND idade % 10 = 3) AS outra20,
        count(*) FILTER (idade < 20 AND idade % 10 = 5) AS vezes20 FROM a GROUP BY competencia),
own AS (SELECT *, 'atendimentos_' || replace(competencia, '-', '_') || CASE WHEN competencia IN ('2024-01', '2024-02') THEN '_v2' ELSE '' END || '.csv' AS r
        FROM v WHERE competencia <= '2024-04')
SELECT r AS relatorio, motivo, linhas, true AS vigente, '' AS recusa FROM own,
  LATERAL (VALUES ('gravadas', boas), ('outra_empresa', outra), ('repetidas', vezes)) AS t(motivo, linhas) WHERE linhas > 0
UNION ALL SELECT 'atendimentos_2024_01.csv', motivo, linhas, false, '' FROM v,
  LATERAL (VALUES ('gravadas', boas20), ('outra_empresa', outra20), ('repetidas', vezes20)) AS t(motivo, linhas) WHERE linhas > 0 AND competencia = '2024-01'
UNION ALL SELECT 'internacoes_' || replace(competencia, '-', '_') || '.csv', 'gravadas', count(*), true, '' FROM i WHERE competencia <= '2024-04' GROUP BY competencia
UNION ALL SELECT 'movimentacoes_' || replace(competencia, '-', '_') || CASE WHEN competencia = '2024-01' THEN '_v2' ELSE '' END || '.csv', 'gravadas', count(*), true, ''
  FROM m WHERE competencia <= '2024-03' GROUP BY competencia
UNION ALL SELECT 'atendimentos_2024_02.csv', 'recusado', -1, false, 'desconhecida NOME COMPLETO'
UNION ALL SELECT 'atendimentos.csv', 'sem_competencia', -1, false, ''
UNION ALL SELECT 'relatorio_2024_01.csv', 'sem_destino', -1, false, ''""",
}


# ------------------------------------------------------------------ review

def _by_date(sql: str) -> str:
    """The domain CTEs with the period of the events' days and the plain fields."""
    sql = sql.replace("  SELECT event_id AS atend_PA, user_id AS CD_PACIENTE,",
                      "  SELECT CAST(make_date(year(ts), (day(ts) - 1) // 8 + 1, 1) AS TIMESTAMP) AS per, NULL AS flag, NULL AS decisao,\n"
                      "    CASE WHEN value < 250 THEN 'F' ELSE 'M' END AS SEXO, '0' AS CEP, 'CIDADE' AS CIDADE, 'SP' AS UF,\n"
                      "    event_id AS atend_PA, user_id AS CD_PACIENTE,")
    sql = sql.replace("TIMESTAMP '2024-01-01 00:00:00' AS competencia", "x.per AS competencia, x.SEXO, x.CEP, x.CIDADE, x.UF, x.CID, x.esp AS ESPECIALIDADE,\n"
                      "  x.MOTIVO_ALTA, CAST(x.DT_ATENDIMENTO AS TIMESTAMP) AS DT_ATENDIMENTO")
    sql = sql.replace("CASE WHEN va.ATENDIMENTO IS NOT NULL THEN 1 ELSE 0 END AS fl_conversao",
                      "CASE x.flag WHEN 'conversao' THEN 1 WHEN 'evasao' THEN 0\n"
                      "    ELSE (va.ATENDIMENTO IS NOT NULL OR coalesce(x.decisao = 'confirmado', false))::INT END AS fl_conversao")
    return sql.replace("CASE WHEN x.MOTIVO_ALTA = 'EVASAO' THEN 1 ELSE 0 END AS fl_evasao",
                       "CASE x.flag WHEN 'evasao' THEN 1 WHEN 'conversao' THEN 0 ELSE coalesce(x.MOTIVO_ALTA = 'EVASAO', false)::INT END AS fl_evasao")


FIRST = _by_date(ED_BASE.strip())
#: The CTEs from the visits on, over corrected visits.
_SECOND_NAMES = ("lastvis", "links", "valid", "susp", "seen", "later", "ret", "mart", "vs")
SECOND = FIRST[FIRST.index("lastvis AS ("):]
for _n in _SECOND_NAMES:
    SECOND = re.sub(rf"\b{_n}\b", f"{_n}2", SECOND)

_FIELDS = {
    "CD_PACIENTE": "CAST(p + 1 AS VARCHAR)", "IDADE": "CASE WHEN k % 2 = 0 THEN '33' ELSE 'abc' END", "SEXO": "'X'", "CEP": "'01000'", "CIDADE": "'OUTRA'",
    "UF": "'RJ'", "CONVENIO": "'CORRIGIDO'", "SERVICO": "'CARDIOLOGIA'", "COR_CLASSIF": "'VERDE'", "PRESTADOR": "'DR C'", "ESPECIALIDADE": "'GERAL'",
    "CID": "'view - DESCRICAO'", "MOTIVO_ALTA": "'EVASAO'", "DT_ATENDIMENTO": "CAST(d + 1 AS VARCHAR)",
    **{f: f"strftime(t + INTERVAL ({m}) MINUTE, '%d/%m/%Y %H:%M:%S')" for f, m in
       (("DT_HR_TOTEM_RECEP", -3), ("DT_HR_CLASSIF_RISCO", 9), ("INI_ATD_MEDICO", 31), ("FIM_ATD_MEDICO", 44), ("DT_HR_ALTA", 200))}}


def _cases(mart: str, detected: str) -> str:
    rules = "\nUNION ALL\n".join(f"SELECT '{n}' AS teste, atend_PA AS nr_atendimento, competencia, SERVICO AS servico FROM {mart} WHERE {c}" for n, c in _ED_RULES)
    return f"""SELECT DISTINCT sha256(concat_ws('|', teste, CAST(nr_atendimento AS VARCHAR), CAST(CAST(competencia AS DATE) AS VARCHAR))) AS id_inconsistencia,
  {TIPO_CASE} AS tipo, teste, nr_atendimento, competencia, coalesce(nullif(servico, ''), 'NAO_IDENTIFICADO') AS servico,
  TIMESTAMP '{detected}' AS detectado_em, {STATUS_CASE} AS status FROM ({rules}
UNION ALL SELECT 'fl_suspeito_conversao', atend_PA, competencia, SERVICO FROM {mart} WHERE fl_suspeito_conversao = 1
UNION ALL SELECT 'dbt_utils_unique_combination_of_columns_atendimentos_pa_atend_PA__competencia', atend_PA, competencia, min(SERVICO)
  FROM {mart} GROUP BY atend_PA, competencia HAVING count(*) > 1)"""


def _fixed(column: str, field: str, typed: str) -> str:
    return f"coalesce({typed.format(f'c.{field}')}, vs.{column}) AS {column}"


_STAMP = "try_strptime({}, '%d/%m/%Y %H:%M:%S')"
_CORRECTED = ", ".join(_fixed(column, field, typed) for column, field, typed in (
    ("CD_PACIENTE", "CD_PACIENTE", "try_cast({} AS BIGINT)"), ("IDADE", "IDADE", "try_cast({} AS BIGINT)"), ("SEXO", "SEXO", "{}"), ("CEP", "CEP", "{}"),
    ("CIDADE", "CIDADE", "{}"), ("UF", "UF", "{}"), ("CONVENIO", "CONVENIO", "{}"), ("SERVICO", "SERVICO", "{}"), ("cor", "COR_CLASSIF", "{}"),
    ("prest", "PRESTADOR", "('x - ' || {})"), ("esp", "ESPECIALIDADE", "{}"), ("CID", "CID", "{}"), ("code", "CID", "split_part({}, ' - ', 1)"),
    ("MOTIVO_ALTA", "MOTIVO_ALTA", "{}"), ("DT_ATENDIMENTO", "DT_ATENDIMENTO", "try_cast({} AS DATE)"), ("arr", "DT_HR_TOTEM_RECEP", _STAMP),
    ("fim_cls", "DT_HR_CLASSIF_RISCO", _STAMP), ("ini_med", "INI_ATD_MEDICO", _STAMP), ("fim_med", "FIM_ATD_MEDICO", _STAMP), ("alta", "DT_HR_ALTA", _STAMP)))
_KEPT = "vs.per, vs.atend_PA, vs.ini_cls, vs.cad_ini, vs.cad_fim"

REVIEW = f"""{FIRST},
reg1 AS MATERIALIZED ({_cases("mart", "2026-01-01 00:00:00")}),
seen1 AS (SELECT reg1.*, vs.CD_PACIENTE AS p, vs.arr AS t, vs.DT_ATENDIMENTO AS d, hour(vs.arr) * 3600 + minute(vs.arr) * 60 + second(vs.arr) AS k
  FROM reg1 JOIN vs ON reg1.nr_atendimento = vs.atend_PA WHERE status = 'pendente'),
said AS MATERIALIZED (SELECT *, CASE k % 19 {" ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(_FIELDS))} END AS campo,
  CASE k % 19 {" ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_FIELDS.values()))} END AS valor,
  CASE WHEN k % 2 = 0 THEN 'conversao' ELSE 'evasao' END AS flag, CASE k % 3 WHEN 0 THEN 'confirmado' WHEN 1 THEN 'descartado' ELSE 'talvez' END AS decisao,
  concat_ws(',', CASE WHEN k % 23 = 0 THEN 'autor_ausente' END,
    CASE WHEN k % 23 <> 0 AND tipo = 'conversao' AND k % 3 = 2 THEN 'decisao_desconhecida' END) AS problemas FROM seen1),
good AS (SELECT * FROM said WHERE problemas = ''),
c AS (SELECT nr_atendimento, {", ".join(f"max(CASE WHEN campo = '{f}' THEN valor END) FILTER (tipo IN ('integridade', 'sequencia_temporal')) AS {f}" for f in _FIELDS)},
  max(flag) FILTER (tipo = 'logica_negocio') AS flag, max(decisao) FILTER (tipo = 'conversao') AS decisao FROM good GROUP BY nr_atendimento),
vs2 AS (SELECT {_KEPT}, c.flag, c.decisao, {_CORRECTED} FROM vs LEFT JOIN c ON vs.atend_PA = c.nr_atendimento),
{SECOND}"""

_WITH = "WITH " + REVIEW + "\n"
SQL["ed_curated_mart"] = _WITH + "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in ED_DOUBLE else c for c in ED_COLS) + (
    ", SEXO, CEP, CIDADE, UF, CONVENIO, ESPECIALIDADE, CID, MOTIVO_ALTA, DT_ATENDIMENTO, DT_HR_CLASSIF_RISCO, INI_ATD_MEDICO, FIM_ATD_MEDICO FROM mart2")
SQL["review_register"] = _WITH + f"""SELECT id_inconsistencia, tipo, teste, nr_atendimento, competencia, servico, detectado_em,
  CASE WHEN id_inconsistencia IN (SELECT id_inconsistencia FROM good) THEN 'revisado' ELSE status END AS status FROM reg1
UNION ALL SELECT * FROM ({_cases("mart2", "2026-01-03 00:00:00")}) WHERE id_inconsistencia NOT IN (SELECT id_inconsistencia FROM reg1)"""
SQL["review_decisions"] = _WITH + """SELECT 'imputacao' AS tabela, id_inconsistencia AS sobre, campo || '=' || valor AS valor, competencia
FROM good WHERE tipo IN ('integridade', 'sequencia_temporal')
UNION ALL SELECT 'logica', id_inconsistencia, flag, competencia FROM good WHERE tipo = 'logica_negocio'
UNION ALL SELECT 'conversao', CAST(nr_atendimento AS VARCHAR), decisao || '/L1/U1/UTI', competencia FROM good WHERE tipo = 'conversao'
UNION ALL SELECT 'rejeitadas', id_inconsistencia, problemas, competencia FROM said WHERE problemas <> ''"""

# ------------------------------------------------------------------ percentiles of any subset

_KEYS = ("SERVICO", "competencia", "turno", "COR_CLASSIF", "grupo_cid")
SQL["states_cube"] = (_WITH.rstrip() + ",\nk AS (SELECT * REPLACE (strftime(competencia, '%Y-%m-%d') AS competencia) FROM mart2),\ng AS (SELECT "
    + ", ".join(_KEYS) + ", " + ", ".join(f"grouping({k}) AS g_{k}" for k in _KEYS) + ", "
    + ", ".join(f"quantile_disc({c}, 0.5) AS a{i}, quantile_disc({c}, 0.9) AS b{i}" for i, (_, c) in enumerate(ED_PCT_STEPS, 1))
    + " FROM k GROUP BY CUBE (" + ", ".join(_KEYS) + "))\n"
    + "\nUNION ALL\n".join("SELECT " + ", ".join(f"CASE WHEN g_{k} = 1 THEN 'Todas' ELSE {k} END AS {k}" for k in _KEYS)
        + ", (" + " + ".join(f"{1 << j} * g_{k}" for j, k in enumerate(_KEYS)) + f")::INT AS agregado, '{n}' AS nome_etapa, "
        + f"CAST(a{i} AS DOUBLE) AS p50, CAST(b{i} AS DOUBLE) AS p90, {i} AS ordem FROM g" for i, (n, _) in enumerate(ED_PCT_STEPS, 1)))
SQL["states_filtered"] = (_WITH.rstrip() + ",\nk AS (SELECT * FROM mart2 WHERE SERVICO IN ('CLINICA MEDICA', 'CARDIOLOGIA') AND turno <> 'Madrugada')\n"
    + "\nUNION ALL\n".join(f"SELECT COR_CLASSIF, competencia, '{n}' AS nome_etapa, round(quantile_cont({c}, 0.5), 6) AS p50, "
                            f"round(quantile_cont({c}, 0.9), 6) AS p90, {i} AS ordem FROM k GROUP BY COR_CLASSIF, competencia"
                            for i, (n, c) in enumerate(ED_PCT_STEPS, 1)))

# ------------------------------------------------------------------ rules

_LATE = ((11, "INI_ATD_MEDICO", "DT_HR_CLASSIF_RISCO"), (12, "INI_ATD_MEDICO", "FIM_CAD_RECEP"), (13, "DH_CADASTRO_RECEPCAO", "DT_HR_CLASSIF_RISCO"),
         (14, "DT_HR_CLASSIF_RISCO", "INICIO_CLASSIFICACAO"), (15, "DT_HR_CLASSIF_RISCO", "DT_HR_TOTEM_RECEP"), (16, "INICIO_CLASSIFICACAO", "DT_HR_TOTEM_RECEP"),
         (18, "FIM_ATD_MEDICO", "INI_ATD_MEDICO"), (19, "FIM_CAD_RECEP", "DH_CADASTRO_RECEPCAO"), (21, "DT_HR_ALTA", "DT_HR_TOTEM_RECEP"))
_FAULTS: dict[str, dict[int, str]] = {"atend_PA": {0: "NULL"}, "competencia": {4: "NULL"}, "turno": {8: "'X'"}, "faixa_etaria": {9: "'X'"}, "IDADE": {20: "-1"},
                                      "COR_CLASSIF": {11: "'VERDE'"}, "fl_conversao": {1: "NULL", 5: "2", 17: "1"}, "fl_evasao": {2: "NULL", 6: "2", 17: "1"},
                                      "fl_retorno_48h": {3: "NULL", 7: "2"}}
for _i, _later, _earlier in _LATE:
    _FAULTS.setdefault(_later, {})[_i] = f"{_earlier} - INTERVAL 1 MINUTE"
_RANKS = ("conversao", "alta_na_meta", "tempo_atend_medico", "evasao", "retorno48h")
SQL["rule_faults"] = f"""WITH {ED_BASE.strip()},
vf0 AS (SELECT *, minute(arr) % 7 AS k, 1 AS period FROM vs),
vf AS (SELECT * REPLACE ({", ".join(f"CASE WHEN k <> {i} THEN {c} END AS {c}" for i, c in enumerate(("CD_PACIENTE", "atend_PA", "DT_ATENDIMENTO", "esp", "period", "arr")))})
  FROM (SELECT * FROM vf0 UNION ALL SELECT * FROM vf0 WHERE k = 6)),
af0 AS (SELECT *, minute(adm_ts) % 6 AS k, 1 AS period FROM adm),
af AS (SELECT * REPLACE ({", ".join(f"CASE WHEN k <> {i} THEN {c} END AS {c}" for i, c in enumerate(("COD_PACIENTE", "ATENDIMENTO", "adm_ts", "ORIGEM_ATEND", "period")))})
  FROM (SELECT * FROM af0 UNION ALL SELECT * FROM af0 WHERE k = 5)),
mf0 AS (SELECT *, CAST(substr(HORA, 4, 2) AS INT) % 3 AS k, 1 AS period FROM mov),
mf AS (SELECT * REPLACE (CASE WHEN k <> 0 THEN ATENDIMENTO END AS ATENDIMENTO, CASE WHEN k <> 1 THEN period END AS period, CASE WHEN k <> 2 THEN DESTINO END AS DESTINO) FROM mf0),
tf AS (SELECT * REPLACE ({", ".join(f"CASE k {' '.join(f'WHEN {i} THEN {v}' for i, v in values.items())} ELSE {c} END AS {c}" for c, values in _FAULTS.items())})
  FROM (SELECT *, minute(DT_HR_TOTEM_RECEP) % 22 AS k FROM mart UNION ALL SELECT *, 10 FROM mart WHERE minute(DT_HR_TOTEM_RECEP) % 22 = 10)),
rk0 AS ({_oracle.SQL["ed_ranking"]}),
rkf AS (SELECT * REPLACE ({", ".join(f"CASE SERVICO WHEN 'CARDIOLOGIA' THEN NULL WHEN 'PEDIATRIA' THEN 99 ELSE {c} END AS {c}" for c in _RANKS)},
    CASE WHEN SERVICO <> 'CARDIOLOGIA' THEN total_pontos END AS total_pontos, CASE WHEN SERVICO <> 'CIRURGIA GERAL' THEN competencia END AS competencia,
    CASE WHEN SERVICO <> 'CLINICA MEDICA' THEN SERVICO END AS SERVICO)
  FROM (SELECT * FROM rk0 UNION ALL SELECT * FROM rk0 WHERE SERVICO = 'ORTOPEDIA/TRAUMATOLOGIA')),
pcf AS (SELECT * REPLACE (CASE WHEN ordem = 2 THEN p50 - 1 ELSE p90 END AS p90) FROM ({_oracle.SQL["ed_percentiles"]}))
""" + _oracle.rule_parts("vf", "af", "mf", "tf", "rkf", "pcf", "period IS NULL")

_MART = [(n, c) for n, c in _ED_RULES]
SQL["rule_history"] = _WITH.rstrip() + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS teste, competencia, count(*) AS casos FROM mart2 WHERE {c} GROUP BY competencia" for n, c in _MART) + """
UNION ALL SELECT 'dbt_utils_unique_combination_of_columns_atendimentos_pa_atend_PA__competencia', competencia, count(*)
FROM (SELECT atend_PA, competencia FROM mart2 GROUP BY atend_PA, competencia HAVING count(*) > 1) GROUP BY competencia"""

SQL["mart_skipping"] = "WITH " + ED_BASE.strip() + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{k}' AS chave, count(DISTINCT {k}) AS valores, count(*) AS linhas, 1 AS pula FROM mart" for k in ("SERVICO", "CONVENIO", "COR_CLASSIF"))
