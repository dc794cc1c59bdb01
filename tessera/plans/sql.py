"""DuckDB oracle SQL fragments mirroring the Spark operators (used only to
check results; the library itself never parses SQL)."""

from __future__ import annotations

from tessera.functions.text import ABBREVIATIONS, CODIFY_PHRASE
from tessera.plans.views import CODE_LISTS_SQL, PART_DIM_SQL, RESPONSE_IDS, simple_view_sql, xw_dim_sql


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def parse_list(x: str) -> str:
    return (f"list_filter(regexp_split_to_array(replace(replace({x}, ' ', ''), '.', ''), '[;\\s]+'), "
            f"lambda e: e <> '')")


def clean(x: str) -> str:
    return (f"coalesce(replace(replace(regexp_replace({x}, '\\b[A-Z]\\d{{2}}\\b', '', 'g'), "
            f"{q(CODIFY_PHRASE)}, ''), ' ; ', '; '), '')")


def expand(x: str) -> str:
    for k, v in ABBREVIATIONS:
        x = f"replace({x}, {q(k)}, {q(v)})"
    return x


def strip_dot(x: str) -> str:
    return f"CASE WHEN ends_with({x}, '.') THEN substr({x}, 1, length({x}) - 1) ELSE {x} END"


def md5k(x: str, seed: int = 42) -> str:
    return f"md5(CAST({x} AS VARCHAR) || ':{seed}')"


TERMS = f"({simple_view_sql('terms')})"
CODE_SYSTEM = f"({simple_view_sql('code_system')})"
AUG = f"({simple_view_sql('augmentation')})"
XW = xw_dim_sql()

# processed code system: parsed ICD list crosswalked (first dimension row per
# key by ord, misses dropped, order kept) and joined with '; '.
PROCESSED = f"""(WITH cs AS (SELECT *, {parse_list('icd10')} AS codes FROM {CODE_SYSTEM}),
dim1 AS (SELECT code AS xk, arg_min(long_desc, ord) AS xv FROM {XW} GROUP BY code),
ex AS (SELECT row_key, unnest(codes) AS elem, generate_subscripts(codes, 1) AS pos FROM cs),
xw AS (SELECT ex.row_key, string_agg(dim1.xv, '; ' ORDER BY ex.pos) AS j FROM ex JOIN dim1 ON ex.elem = dim1.xk
       GROUP BY ex.row_key)
SELECT cs.* EXCLUDE (codes), coalesce(xw.j, '') AS icd10_description FROM cs LEFT JOIN xw USING (row_key))"""

STACKED = f"""(SELECT cod AS code, nome AS text, 'icpc2_description' AS origin FROM {PROCESSED}
UNION ALL SELECT cod, nome_curto, 'icpc2_short' FROM {PROCESSED}
UNION ALL SELECT cod, unnest(string_split(incl, '; ')), 'icpc2_inclusion' FROM {PROCESSED}
  WHERE incl IS NOT NULL AND cod IS NOT NULL
UNION ALL SELECT cod, unnest(string_split(icd10_description, '; ')), 'icd10_description' FROM {PROCESSED}
  WHERE icd10_description IS NOT NULL AND cod IS NOT NULL)"""


def shadow(src: str) -> str:
    return f"""(WITH u AS (SELECT * FROM {src}),
dups AS (SELECT text FROM u GROUP BY text HAVING count(*) > 1)
SELECT * FROM u WHERE NOT (coalesce(origin = 'icpc2_short', FALSE)
  AND EXISTS (SELECT 1 FROM dups d WHERE d.text IS NOT DISTINCT FROM u.text)))"""


ACCEPTED_UNION = f"""(SELECT code, text, origin FROM {STACKED} WHERE NOT starts_with(code, '-')
UNION ALL SELECT code, text, origin FROM {AUG} WHERE include)"""

CORPUS = f"""(WITH f AS (SELECT code, text, origin, substr(code, 1, 1) AS chapter FROM {shadow(ACCEPTED_UNION)}),
c AS (SELECT * FROM f WHERE nullif(code, '') IS NOT NULL AND nullif(text, '') IS NOT NULL
      AND nullif(origin, '') IS NOT NULL AND nullif(chapter, '') IS NOT NULL),
lab AS (SELECT code, CAST(row_number() OVER (ORDER BY code) - 1 AS INTEGER) AS label FROM (SELECT DISTINCT code FROM c))
SELECT c.code, c.text, c.origin, c.chapter, lab.label FROM c JOIN lab USING (code))"""

TERMS_LABELS = f"""(WITH c AS (SELECT DISTINCT code FROM {TERMS} WHERE code IS NOT NULL)
SELECT code, CAST(row_number() OVER (ORDER BY code) - 1 AS INTEGER) AS label FROM c)"""

# label dimension of the terms: label, code, first text (by id)
LABEL_DIM = f"""(SELECT l.label, l.code, t.text FROM {TERMS_LABELS} l
JOIN (SELECT code, arg_min(text, id) AS text FROM {TERMS} GROUP BY code) t USING (code))"""

CODE_LISTS = CODE_LISTS_SQL
PART_DIM = PART_DIM_SQL

GENERATED = f"""(SELECT code, id // {RESPONSE_IDS} AS part, array_to_string(list_sort(list_distinct(list_concat(list(text), list(split_part(text, ' ', 1)
  || ' ' || split_part(text, ' ', 2))))), '; ') || '.' AS response, 'generator-v2' AS model, 'synonyms' AS context,
  'prompt ' || code AS prompt FROM {AUG} GROUP BY code, id // {RESPONSE_IDS})"""

PARSED = f"""(SELECT code, unnest(list_distinct(string_split({strip_dot('response')}, '; '))) AS text, model AS origin,
  TRUE AS include, context, prompt FROM {GENERATED})"""

# deterministic "model runs" over documents: a predicts 'en' everywhere, b
# predicts the true language for short documents.
RUN_A = "(SELECT doc_id, text, lang AS code, 'en' AS top_prediction FROM documents)"
RUN_B = ("(SELECT doc_id, text, lang AS code, CASE WHEN n_chars > 2000 THEN 'en' ELSE lang END AS top_prediction "
         "FROM documents)")
