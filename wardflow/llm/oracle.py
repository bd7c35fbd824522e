"""DuckDB SQL for the registered queries that SQL can express, written from the
definitions."""

_STOP = """the of and to is in that it for with on as at by this be are was from or an a not
le la les de des et un une en du que qui pour dans par sur au est avec il elle
der die das und ist in den von zu mit ein eine nicht auf für sich auch dem des im
el la los las de y que en un una del por con para es no se su al lo como""".split()

OP4 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT r, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
seen AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(ws[i:i + 4], ' ')) AS c FROM win),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM seen, range(5) AS o(k) WHERE c >= 2 GROUP BY r),
ln AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
lc AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM ln
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
       len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
       coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
       len(regexp_extract_all(t, '[A-Z]')) AS n_upper,
       len(list_filter(ws, lambda x: lower(x) IN (STOP))) AS n_stop
      FROM w LEFT JOIN rep USING (r) LEFT JOIN lc USING (r)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       list_filter([
        CASE WHEN n_words = 0 OR word_chars / n_words < 3 OR word_chars / n_words > 10 THEN 'mean_word_chars' END,
        CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbol_ratio' END,
        CASE WHEN n_words = 0 OR n_stop / n_words < 0.06 THEN 'stop_word_ratio' END,
        CASE WHEN word_chars > 0 AND n_upper / word_chars > 0.3 THEN 'upper_ratio' END,
        CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.3 THEN 'dup_line_ratio' END,
        CASE WHEN n_lines = 0 OR n_words / n_lines < 1.5 THEN 'words_per_line' END], lambda x: x IS NOT NULL) AS broken FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       array_to_string(broken, ',') AS broken, NOT base_failed AND len(broken) = 0 AS kept
FROM v""".replace("STOP", ", ".join(f"'{w}{tail}'" for w in sorted(set(_STOP)) for tail in ("", ",", ".")))

OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS head FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((('0x' || substr(x, 1 + 10 * (k // 8), 10))::BIGINT >> (35 - 5 * (k % 8))::INT) & 31))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM g"""

OP7 = r"""
WITH b AS (SELECT min(item_id) AS item_id, count(*) AS item_copies, ws FROM
       (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws FROM benchmark) GROUP BY ws),
bs AS (SELECT DISTINCT item_id, item_copies, array_to_string(ws[i:i + 4], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS i FROM b WHERE len(ws) >= 5)),
bn AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws FROM documents),
ds AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
f AS (SELECT doc_id, item_id, item_copies, count(*) AS shared FROM ds JOIN bs USING (s) GROUP BY ALL)
SELECT doc_id, item_id, item_copies, n AS item_shingles, shared AS shared_shingles, shared / n AS containment
FROM f JOIN bn USING (item_id) WHERE 10 * shared >= 8 * n
UNION ALL SELECT DISTINCT doc_id, item_id, item_copies, 1, 1, 1.0 FROM d
JOIN b ON len(b.ws) BETWEEN 1 AND 4 AND contains(' ' || array_to_string(d.ws, ' ') || ' ', ' ' || array_to_string(b.ws, ' ') || ' ')"""



def _op11(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """One assignment and one replacement of the entries a round, written out."""
    ctes = [f"""
kept AS (SELECT row_number() OVER () AS r, vec_id, label, embedding, len(embedding) // {parts} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT r, (i - 1) // w AS p, (i - 1) % w AS pos, floor(4096 * embedding[i]::DOUBLE)::BIGINT AS x
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
book0 AS (SELECT p, e, pos, x AS v FROM c
  JOIN (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}) USING (r))"""]
    for k in range(rounds + 1):
        ctes.append(f"""
near{k} AS (SELECT r, p, min(far) AS far, arg_min(e, far * {entries} + e) AS e FROM
  (SELECT r, p, e, sum((x - v) * (x - v))::BIGINT AS far FROM c JOIN book{k} USING (p, pos) GROUP BY r, p, e) GROUP BY r, p)""")
        if k < rounds:
            ctes.append(f"""
book{k + 1} AS (SELECT b.p, b.e, b.pos, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN
  (SELECT p, e, pos, floor(sum(x) / count(*))::BIGINT AS v FROM c JOIN near{k} USING (r, p) GROUP BY p, e, pos) m USING (p, e, pos))""")
    return "WITH" + ",".join(ctes) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, pos)) FROM book{rounds}) AS codebooks_sha256
FROM (SELECT r, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(far)::BIGINT AS error FROM near{rounds} GROUP BY r)
JOIN kept USING (r)"""


#: The state of a repair is {c: cost, a: audit, r: repaired rows}; the least of some
#: states is the cheapest, then that of the ASCII-least audit.
def _least(*states: str) -> str:
    return f"list_sort(list_filter([{', '.join(states)}], lambda z: z IS NOT NULL))[1]"


def _edit(state: str, cost: str, letter: str, line: str | None = None) -> str:
    rows = f"{state}.r" if line is None else f"{state}.r || CASE WHEN {state}.r = '' THEN '' ELSE chr(10) END || {line}"
    return (f"CASE WHEN {state} IS NOT NULL THEN {{'c': ({state}.c + {cost})::BIGINT, 'a': {state}.a || {letter}, 'r': {rows}}} END")


def _stay(state: str, role: str) -> str:
    keep = f"initial = '{role[0]}'"
    edit = _edit(state, f"CASE WHEN {keep} THEN 0 ELSE 2 END + cut", f"CASE WHEN {keep} THEN 'K' ELSE 'R' END",
                 f"CASE WHEN {keep} THEN role ELSE '{role}' END || ':' || text")
    return f"CASE WHEN NOT gone THEN {edit} END"


_STATE = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR)"
_SYSTEM = "CASE WHEN NOT gone AND initial = 's' THEN " + _edit("s0", "cut", "'K'", "role || ':' || text") + " END"
#: One byte of CRC-32: eight steps of the reversed polynomial.
_BYTE = "xor(c >> 8, list_reduce(list_concat([xor(c & 255, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))"

OP13 = rf"""
WITH RECURSIVE coded AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_concat([4294967295], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                                             lambda x: ascii(x)::BIGINT)) AS bytes FROM conversations),
hit AS (SELECT conv_id, turn, role, text,
    xor(list_reduce(bytes, lambda c, b: {_BYTE}), 4294967295) % 20 AS k FROM coded),
rows AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM hit, range(2) AS t(copy) WHERE k <> 0 AND (copy = 0 OR k = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM rows),
seen AS (SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
         WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' END AS fault FROM placed),
f AS (SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS gone, (coalesce(fault, '') = 'truncated')::INT AS cut FROM seen),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
dp(conv_id, i, s0, s1, su, sa) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0, 'a': '', 'r': ''}}::{_STATE}, NULL::{_STATE}, {{'c': 2, 'a': 'I', 'r': 'user:'}}::{_STATE},
    {{'c': 4, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:'}}::{_STATE} FROM stats
  UNION ALL
  SELECT conv_id, i, n0, n1, yu, {_least("na", _edit("yu", "2", "'I'", "'assistant:'"))} FROM
   (SELECT *, {_least("nu", _edit("n0", "2", "'I'", "'user:'"), _edit("n1", "2", "'I'", "'user:'"), _edit("na", "2", "'I'", "'user:'"))} AS yu FROM
    (SELECT f.conv_id, f.i, {_edit("s0", "3", "'D'")} AS n0, {_least(_edit("s1", "3", "'D'"), _SYSTEM)} AS n1,
      {_least(_edit("su", "3", "'D'"), _stay("s0", "user"), _stay("s1", "user"), _stay("sa", "user"))} AS nu,
      {_least(_edit("sa", "3", "'D'"), _stay("su", "assistant"))} AS na
     FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1))),
best AS (SELECT dp.conv_id, {_least("s0", "sa")} AS z FROM dp JOIN stats ON dp.conv_id IS NOT DISTINCT FROM stats.conv_id AND dp.i = n)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(z.c, 0) AS cost, coalesce(z.a, '') AS audit,
  sha256(coalesce(z.r, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats ON c.conv_id IS NOT DISTINCT FROM stats.conv_id
LEFT JOIN best ON c.conv_id IS NOT DISTINCT FROM best.conv_id"""

SQL: dict[str, str] = {"op1_warc_bundles": OP1, "op4_quality_rules": OP4,
                        "op7_benchmark_decontamination": OP7,
                        "op11_vector_codes": _op11(), "op13_conversation_repair": OP13}
