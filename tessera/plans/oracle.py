"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables ``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations`` are views in DuckDB.
"""

from __future__ import annotations

from tessera.functions.text import PROMPT_CONTEXT
from tessera.operators.augment import NAMES_PER_PROMPT
from tessera.plans import sql as S
from tessera.plans.catalog import SEARCHES, SELECTOR, SELECTORS
from tessera.operators.split import hash_threshold

T = S.TERMS
RARE10 = f"(SELECT t.*, c.count FROM {T} t JOIN (SELECT code, count(*) AS count FROM {T} GROUP BY code) c USING (code) WHERE c.count <= 10)"
CLASS_COUNT = f"(SELECT t.*, c.count FROM {T} t JOIN (SELECT code, count(*) AS count FROM {T} GROUP BY code) c USING (code))"
TERM_PRED = f"(SELECT text AS input, arg_min(code, id) AS top_prediction FROM {T} GROUP BY text)"
CORRECT_TERMS = f"(SELECT t.* FROM {T} t JOIN {TERM_PRED} p ON t.text = p.input WHERE p.top_prediction = t.code)"
EMB_PRED = ("(SELECT vec_id, CAST((list_position(embedding, list_max(embedding)) - 1) * 5 AS INTEGER) AS label "
            "FROM embeddings)")
STRAT = f"""(SELECT doc_id, lang, CASE WHEN rn < floor(0.2 * n + 0.5) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {S.md5k('doc_id')}, doc_id) - 1 AS rn,
         count(*) OVER (PARTITION BY lang) AS n FROM documents))"""
KFOLD_B = f"""(SELECT b.*, CAST((row_number() OVER (ORDER BY {S.md5k('doc_id')}, doc_id) - 1) % 5 AS INTEGER) AS fold
  FROM {S.RUN_B} b)"""
SOFTMAX = """(WITH u AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS idx
  FROM embeddings),
m AS (SELECT vec_id, max(x) AS mx FROM u GROUP BY vec_id),
e AS (SELECT u.vec_id, u.idx, u.x, exp(u.x - m.mx) AS ex FROM u JOIN m USING (vec_id)),
s AS (SELECT vec_id, sum(ex) AS tot FROM e GROUP BY vec_id)
SELECT e.vec_id, e.idx AS label, e.ex / s.tot AS value,
  row_number() OVER (PARTITION BY e.vec_id ORDER BY e.x DESC, e.idx) AS rank FROM e JOIN s USING (vec_id))"""
ML_TRUTH = """(SELECT doc_id AS id, 'quality' AS label FROM labels WHERE quality = 1
  UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1)"""
ML_PRED = """(SELECT doc_id AS id, 'quality' AS label FROM documents WHERE n_chars > 1000
  UNION ALL SELECT doc_id, 'toxic' FROM documents WHERE contains(text, '!'))"""


def _prompt_sql() -> str:
    labels = S.expand("n.names")
    i, x, c, e = S.clean("f.incl"), S.clean("f.icd10_description"), S.clean("f.crit"), S.clean("f.excl")

    def piece(v, pre, suf=""):
        return f"CASE WHEN {v} <> '' THEN {S.q(pre)} || {v} || {S.q(suf)} ELSE '' END"
    return f"""WITH p AS (SELECT * FROM {S.PROCESSED}),
r AS (SELECT cod, nome, row_key, (row_number() OVER (PARTITION BY cod ORDER BY row_key, nome) - 1) // {NAMES_PER_PROMPT}
        AS part FROM p),
n AS (SELECT cod, part, string_agg(nome, '; ' ORDER BY row_key, nome) AS names FROM r GROUP BY cod, part),
f AS (SELECT cod, incl, excl, crit, icd10_description FROM (
        SELECT *, row_number() OVER (PARTITION BY cod ORDER BY row_key) AS rn FROM p) WHERE rn = 1)
SELECT n.cod AS code, CAST(n.part AS INTEGER) AS part, {labels} || {piece(i, '; ', ', ')} || {piece(x, ', ')}
  || {piece(c, '; Critérios: ')} || {piece(e, '. Exclui: ')} AS prompt, {S.q(PROMPT_CONTEXT)} AS context
FROM n JOIN f USING (cod)"""


def report(run: str, average: str = "macro") -> str:
    """AGG8 over the confusion counts of a run."""
    f1 = "CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END"
    accuracy = "round(sum(tp) / sum(su), 6)"
    if average == "micro":
        cols = ", ".join(f"{accuracy} AS {c}" for c in ("precision", "recall", "f1_score"))
    else:
        mean = (lambda x: f"avg({x})") if average == "macro" else (lambda x: f"sum(({x}) * su) / sum(su)")
        cols = (f"round({mean('prec')}, 6) AS precision, round({mean('rec')}, 6) AS recall, "
                f"round({mean(f1)}, 6) AS f1_score")
    return f"""WITH b AS (SELECT code AS y, top_prediction AS p, count(*) AS n FROM {run} GROUP BY ALL),
      cls AS (SELECT y AS c FROM b UNION SELECT p FROM b WHERE p IS NOT NULL),
      per AS (SELECT c, coalesce((SELECT sum(n) FROM b WHERE y = c AND p = c), 0) AS tp,
                 coalesce((SELECT sum(n) FROM b WHERE p = c), 0) AS pr,
                 coalesce((SELECT sum(n) FROM b WHERE y = c), 0) AS su FROM cls),
      m AS (SELECT *, CASE WHEN pr > 0 THEN tp / pr ELSE 0.0 END AS prec, CASE WHEN su > 0 THEN tp / su ELSE 0.0 END AS rec
            FROM per)
      SELECT {accuracy} AS accuracy, {cols} FROM m"""


ORACLES: dict[str, str] = {
    "corpus_build": f"SELECT * FROM {S.CORPUS}",
    "corpus_labels": f"SELECT code, text, chapter, label FROM {S.CORPUS} WHERE origin = 'icpc2_description'",
    "parse_code_list": f"""SELECT o_orderkey, c IS NULL AS list_is_null, CAST(coalesce(len(c), 0) AS INTEGER) AS n_codes,
        array_to_string(c, ',') AS codes
      FROM (SELECT o_orderkey, {S.parse_list('icd10')} AS c FROM {S.CODE_LISTS})""",
    # the lists hold l_partkey || '.0', which TXT1 (checked by parse_code_list)
    # reads as l_partkey || '0': the same look-up without the text round trip
    "crosswalk": f"""WITH dim1 AS (SELECT k, arg_min(v, ord) AS v FROM {S.PART_DIM} GROUP BY k),
      m AS (SELECT l_orderkey, count(*) AS n, string_agg(dim1.v, '; ' ORDER BY l_linenumber, l_partkey) AS j
            FROM lineitem JOIN dim1 ON dim1.k = CAST(l_partkey AS VARCHAR) || '0' GROUP BY l_orderkey)
      SELECT o_orderkey, CAST(coalesce(m.n, 0) AS INTEGER) AS n_matched, coalesce(m.j, '') AS descriptions
      FROM orders LEFT JOIN m ON l_orderkey = o_orderkey""",
    "split_rows": f"""SELECT row_key, cod AS code, unnest(string_split(incl, '; ')) AS text
      FROM {S.CODE_SYSTEM} WHERE incl IS NOT NULL""",
    "stack_origins": f"SELECT * FROM {S.STACKED}",
    "drop_shadowed": f"SELECT * FROM {S.shadow(T)}",
    "encode_labels": f"""SELECT t.id, t.code, l.label FROM {T} t JOIN {S.TERMS_LABELS} l USING (code)
      WHERE nullif(t.text, '') IS NOT NULL AND nullif(t.origin, '') IS NOT NULL AND nullif(t.code, '') IS NOT NULL""",
    "merge_augmentation": f"""WITH u AS (
        SELECT code, text, origin, include, context, prompt, 0 AS prio, id AS pos FROM {S.AUG}
        UNION ALL SELECT code, text, origin, include, context, prompt, 1, 0 FROM {S.PARSED})
      SELECT code, text, origin, CAST(include AS VARCHAR) AS include, context, prompt FROM (
        SELECT *, row_number() OVER (PARTITION BY code, text ORDER BY prio, pos) AS rn FROM u) WHERE rn = 1""",
    "parse_generated": f"SELECT * FROM {S.PARSED}",
    "accepted_union": f"SELECT * FROM {S.ACCEPTED_UNION}",
    "rare_codes": f"SELECT id, code, text, count FROM {RARE10}",
    "class_count": f"SELECT id, code, count FROM {CLASS_COUNT}",
    "slice_counts": f"SELECT count(*) AS n_rows, count(DISTINCT code) AS n_codes FROM {RARE10}",
    "augmentation_stats": f"""WITH a AS (SELECT * FROM {S.AUG}),
      r AS (SELECT count(DISTINCT code) AS rare FROM {RARE10}),
      s AS (SELECT count(DISTINCT code) AS n_codes, count(*) AS n_rows, CAST(count_if(coalesce(include, FALSE)) AS BIGINT) AS n_accepted
            FROM a)
      SELECT n_codes, n_rows, n_accepted,
        CAST(round_even(100.0 * n_accepted / nullif(n_rows, 0), 1) AS DOUBLE) AS accepted_pct,
        CAST(round_even(CAST(n_rows AS DOUBLE) / nullif(n_codes, 0), 1) AS DOUBLE) AS rows_per_code,
        CAST(round_even(100.0 * n_codes / nullif(n_codes + rare, 0), 1) AS DOUBLE) AS augmented_share_pct
      FROM s, r""",
    "rare_share": f"""SELECT count(DISTINCT code) AS n_codes,
        CAST(round_even(-100.0 * count(DISTINCT code) / (SELECT count(DISTINCT code) FROM {T}), 1) AS DOUBLE) AS share_pct
      FROM {RARE10}""",
    "frequency_table": f"SELECT code, count(*) AS count, round(log2(count(*)), 6) AS count_log2 FROM {T} GROUP BY code",
    "class_distribution": """SELECT lang, count(*) AS count, round(count(*) / (SELECT count(*) FROM documents), 6) AS share
      FROM documents GROUP BY lang""",
    "class_weights": """SELECT lang, round(1.0 - count(*) / (SELECT count(*) FROM documents), 6) AS weight
      FROM documents GROUP BY lang""",
    "num_classes": f"SELECT count(DISTINCT code) AS num_classes FROM {S.CORPUS}",
    "audit_filter": f"""SELECT id, code, text, substr(code, 1, 1) AS chapter FROM {T}
      WHERE regexp_matches(text, 'RING|bolt', 'i') AND substr(code, 1, 1) IN ('S', 'E')""",
    "apply_selectors": f"""WITH t AS (SELECT id, code, substr(code, 1, 1) AS chapter FROM {T}),
      req AS (SELECT DISTINCT upper(trim(x)) AS v FROM (SELECT unnest(regexp_split_to_array({S.q(SELECTOR)}, '[,\\s]+')) AS x)
              WHERE trim(x) <> ''),
      ch AS (SELECT v FROM req WHERE length(v) = 1 AND v IN (SELECT chapter FROM t)),
      cd AS (SELECT v FROM req WHERE length(v) = 3 AND v IN (SELECT code FROM t))
      SELECT id, code, chapter FROM t WHERE chapter IN (SELECT v FROM ch) OR code IN (SELECT v FROM cd)
        OR NOT EXISTS (SELECT 1 FROM ch UNION ALL SELECT 1 FROM cd)""",
    "existing_values": f"""WITH v AS (SELECT DISTINCT 'chapter' AS kind, upper(substr(p_name, 1, 1)) AS value FROM part
        UNION SELECT DISTINCT 'code', upper(substr(p_name, 1, 1)) || lpad(CAST(p_size AS VARCHAR), 2, '0') FROM part),
      t AS (SELECT code, substr(code, 1, 1) AS chapter FROM {T})
      SELECT kind, value FROM v WHERE (kind = 'chapter' AND value IN (SELECT chapter FROM t))
        OR (kind = 'code' AND value IN (SELECT code FROM t))""",
    "cards": f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY cod ORDER BY row_key) AS rn FROM {S.PROCESSED}),
      w AS (SELECT code FROM {T} GROUP BY code HAVING count(*) <= 3)
      SELECT cod, nome, incl, excl, crit, icd10_description FROM p WHERE rn = 1 AND cod IN (SELECT code FROM w)""",
    "clean_description": f"""SELECT row_key, {S.clean('excl')} AS excl_clean, {S.clean('crit')} AS crit_clean
      FROM {S.CODE_SYSTEM}""",
    "expand_abbreviations": f"""SELECT p_partkey, {S.expand("p_name || ' NE (' || upper(substr(p_type, 1, 1)) || ')'")}
      AS expanded FROM part""",
    "build_prompts": _prompt_sql(),
    "search_text": f"""SELECT row_key, cod || ' ' || nome || ' ' || coalesce(incl, '') || ' ' || icd10_description AS search_text
      FROM {S.PROCESSED} WHERE (cod || ' ' || nome || ' ' || coalesce(incl, '') || ' ' || icd10_description) IS NOT NULL""",
    "rewrite_dash": f"""WITH t AS (SELECT id, CASE WHEN id % 5 = 0 THEN '-' || code || '-x' ELSE code END AS code FROM {T})
      SELECT id, code, replace(code, '-', 'A') AS all_dashes, regexp_replace(code, '^-', 'A') AS leading_dash FROM t""",
    "attach_labels_inner": f"SELECT p.vec_id, p.label, d.code, d.text FROM {EMB_PRED} p JOIN {S.LABEL_DIM} d USING (label)",
    "attach_labels_left": f"SELECT p.vec_id, p.label, d.code, d.text FROM {EMB_PRED} p LEFT JOIN {S.LABEL_DIM} d USING (label)",
    "merge_predictions": f"SELECT t.*, p.top_prediction FROM {T} t JOIN {TERM_PRED} p ON t.text = p.input",
    "lookup_last": f"SELECT code, arg_max(text, id) AS last_text FROM {T} GROUP BY code",
    "with_flag": f"""SELECT f.code, f.count, (c.code IS NOT NULL) AS is_correct
      FROM (SELECT code, count(*) AS count FROM {T} GROUP BY code) f
      LEFT JOIN (SELECT DISTINCT code FROM {CORRECT_TERMS}) c USING (code)""",
    "code_coverage": f"""WITH f AS (SELECT DISTINCT code FROM {T}), c AS (SELECT DISTINCT code FROM {CORRECT_TERMS})
      SELECT count(c.code) AS n_correct_codes, count(*) AS n_codes,
        CAST(round_even(100.0 * avg(CASE WHEN c.code IS NOT NULL THEN 1.0 ELSE 0.0 END), 2) AS DOUBLE) AS coverage_pct
      FROM f LEFT JOIN c USING (code)""",
    "compare_runs": f"""WITH a AS (SELECT doc_id, code, text FROM {S.RUN_A} WHERE top_prediction = code),
      b AS (SELECT doc_id, code, text FROM {S.RUN_B} WHERE top_prediction = code),
      sa AS (SELECT DISTINCT code, text FROM a), sb AS (SELECT DISTINCT code, text FROM b),
      j AS (SELECT sa.code AS ac, sb.code AS bc FROM sa FULL OUTER JOIN sb ON sa.code = sb.code AND sa.text = sb.text),
      pa AS (SELECT row_number() OVER (ORDER BY doc_id) AS pos, code, text FROM a),
      pb AS (SELECT row_number() OVER (ORDER BY doc_id) AS pos, code, text FROM b),
      d AS (SELECT count(*) AS nd FROM pa FULL OUTER JOIN pb ON pa.pos = pb.pos
            WHERE NOT coalesce(pa.code = pb.code AND pa.text = pb.text, FALSE)),
      c AS (SELECT CAST(count_if(ac IS NOT NULL AND bc IS NOT NULL) AS BIGINT) AS n_both,
                   CAST(count_if(ac IS NOT NULL AND bc IS NULL) AS BIGINT) AS n_only_a,
                   CAST(count_if(ac IS NULL AND bc IS NOT NULL) AS BIGINT) AS n_only_b FROM j)
      SELECT n_both, n_only_a, n_only_b, round(n_both / (n_both + n_only_a + n_only_b), 6) AS jaccard,
        (d.nd = 0) AS identical FROM c, d""",
    "validate_run": f"""SELECT round(avg(CASE WHEN top_prediction = code THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
      CAST(count_if(top_prediction = code) AS BIGINT) AS n_correct, count(*) AS n_rows FROM {S.RUN_B}""",
    "classification_report": report(S.RUN_B),
    "classification_report_weighted": report(S.RUN_B, "weighted"),
    "classification_report_micro": report(S.RUN_B, "micro"),
    "run_ledger": f"""SELECT run_id, count(*) AS n_rows, CAST(count_if(top_prediction = code) AS BIGINT) AS n_correct,
        round(avg(CASE WHEN top_prediction = code THEN 1.0 ELSE 0.0 END), 6) AS accuracy
      FROM (SELECT *, 'run_a' AS run_id FROM {S.RUN_A} UNION ALL SELECT *, 'run_b' FROM {S.RUN_B}) GROUP BY run_id""",
    "stratified_split": f"SELECT * FROM {STRAT}",
    "random_split": f"""SELECT doc_id, CASE WHEN substr({S.md5k('doc_id')}, 1, 8) < '{hash_threshold(0.2)}'
      THEN 'test' ELSE 'train' END AS split FROM documents""",
    "kfold": f"""SELECT doc_id, CAST((row_number() OVER (ORDER BY {S.md5k('doc_id')}, doc_id) - 1) % 5 AS INTEGER) AS fold
      FROM documents""",
    "split_sizes": f"SELECT split, count(*) AS n_rows FROM {STRAT} GROUP BY split",
    "cv_mean": f"""SELECT round(avg(acc), 6) AS cv_accuracy, count(*) AS n_folds FROM (
      SELECT fold, avg(CASE WHEN code = top_prediction THEN 1.0 ELSE 0.0 END) AS acc FROM {KFOLD_B} GROUP BY fold)""",
    "row_ids": f"SELECT id, row_number() OVER (ORDER BY code, origin, text, id) - 1 AS row_id FROM {T}",
    "softmax_topk": f"SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(label AS INTEGER) AS label, round(value, 6) AS value FROM {SOFTMAX} WHERE rank <= 5",
    "topk_wide": f"""WITH s AS (SELECT x.vec_id, x.rank, d.code, x.value FROM {SOFTMAX} x LEFT JOIN {S.LABEL_DIM} d
        ON d.label = x.label WHERE x.rank <= 3)
      SELECT vec_id,
        max(CASE WHEN rank = 1 THEN code END) AS prediction_1_code, round(max(CASE WHEN rank = 1 THEN value END), 6) AS prediction_1_value,
        max(CASE WHEN rank = 2 THEN code END) AS prediction_2_code, round(max(CASE WHEN rank = 2 THEN value END), 6) AS prediction_2_value,
        max(CASE WHEN rank = 3 THEN code END) AS prediction_3_code, round(max(CASE WHEN rank = 3 THEN value END), 6) AS prediction_3_value
      FROM s GROUP BY vec_id""",
    "vector_topk": """WITH u AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos
        FROM embeddings WHERE label IS NOT NULL),
      m AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM u GROUP BY label, pos),
      q AS (SELECT label, list(x ORDER BY pos) AS v FROM m GROUP BY label),
      p AS (SELECT CAST(q.label AS BIGINT) AS query_id, i.vec_id AS item_id,
          list_cosine_similarity(q.v, CAST(i.embedding AS DOUBLE[])) AS score FROM q, embeddings i),
      r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM p)
      SELECT query_id, item_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM r WHERE rank <= 5""",
    "oversample": f"""WITH c AS (SELECT code, count(*) AS n FROM {T} GROUP BY code), m AS (SELECT max(n) AS mx FROM c)
      SELECT t.id, t.code, CAST(unnest(range(1, CAST(ceil(m.mx / c.n) AS BIGINT) + 1)) AS INTEGER) AS copy
      FROM {T} t JOIN c USING (code), m""",
    "undersample": f"""SELECT id, code FROM (SELECT id, code,
        row_number() OVER (PARTITION BY code ORDER BY {S.md5k('id')}, id) AS rn FROM {T}) WHERE rn <= 3""",
    "multilabel_metrics": f"""WITH t AS (SELECT DISTINCT * FROM {ML_TRUTH}),
      ids AS (SELECT DISTINCT doc_id AS id FROM labels),
      p AS (SELECT DISTINCT * FROM {ML_PRED} WHERE id IN (SELECT id FROM ids)),
      j AS (SELECT coalesce(t.id, p.id) AS id, coalesce(t.label, p.label) AS label, t.id IS NOT NULL AS ti,
                   p.id IS NOT NULL AS pi FROM t FULL OUTER JOIN p ON t.id = p.id AND t.label = p.label),
      per_id AS (SELECT id, count_if(NOT (ti AND pi)) AS wrong FROM j GROUP BY id),
      per_l AS (SELECT label, count_if(ti AND pi) AS tp, count_if(pi AND NOT ti) AS fp, count_if(ti AND NOT pi) AS fn
                FROM j GROUP BY label)
      SELECT round((SELECT avg(CASE WHEN coalesce(w.wrong, 0) = 0 THEN 1.0 ELSE 0.0 END) FROM ids LEFT JOIN per_id w
               USING (id)), 6) AS subset_accuracy,
        round((SELECT (sum(fp) + sum(fn)) / ((SELECT count(*) FROM ids) * 2.0) FROM per_l), 6) AS hamming_loss,
        round((SELECT 2.0 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) FROM per_l), 6) AS micro_f1,
        round((SELECT avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END) FROM per_l), 6)
          AS macro_f1""",
    "stream_append_distinct": "SELECT DISTINCT event_type AS code, CAST(user_id AS VARCHAR) AS text FROM events",
    "stream_acceptance": """WITH e AS (SELECT *, time_bucket(INTERVAL '1 day', ts) AS ws FROM events),
      g AS (SELECT ws, ws + INTERVAL '1 day' AS we, count(*) AS n_rows,
                   CAST(count_if(event_type IN ('click', 'purchase')) AS BIGINT) AS n_accepted FROM e GROUP BY ws)
      SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(we, '%Y-%m-%d %H:%M:%S') AS window_end,
        n_rows, n_accepted, CAST(round_even(100.0 * n_accepted / n_rows, 1) AS DOUBLE) AS accepted_pct
      FROM g WHERE we <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'""",
}


ORACLES.update({
    "stream_append_distinct_exact": "SELECT DISTINCT event_type AS code, CAST(user_id AS VARCHAR) AS text FROM events",
    "hybrid_sample": f"""WITH u AS (SELECT id, code FROM (SELECT id, code,
        row_number() OVER (PARTITION BY code ORDER BY {S.md5k('id')}, id) AS rn FROM {T}) WHERE rn <= 5),
      c AS (SELECT code, count(*) AS n FROM u GROUP BY code)
      SELECT u.id, u.code, CAST(unnest(range(1, CAST(ceil(5 / c.n) AS BIGINT) + 1)) AS INTEGER) AS copy
      FROM u JOIN c USING (code)""",
    "tune_thresholds": """WITH u AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
          CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS cls FROM embeddings),
      m AS (SELECT *, max(x) OVER (PARTITION BY vec_id) AS mx FROM u),
      s AS (SELECT vec_id, label, cls, exp(x - mx) / sum(exp(x - mx)) OVER (PARTITION BY vec_id) AS score FROM m),
      g AS (SELECT CAST(unnest([0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]) AS DOUBLE) AS t),
      a AS (SELECT cls, t, count_if(score >= t AND label = cls) AS tp, count_if(score >= t AND label <> cls) AS fp,
                   count_if(score < t AND label = cls) AS fn FROM s, g GROUP BY cls, t),
      f AS (SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM a)
      SELECT cls AS class, t AS threshold, round(f1, 6) AS f1 FROM (
        SELECT *, row_number() OVER (PARTITION BY cls ORDER BY f1 DESC, t) AS rn FROM f) WHERE rn = 1""",
    "label_powerset": """WITH t AS (SELECT doc_id AS id, 'quality' AS label FROM labels WHERE quality = 1
        UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1
        UNION ALL SELECT doc_id, NULL FROM labels),
      s AS (SELECT id, coalesce(string_agg(DISTINCT label, '|' ORDER BY label), '') AS labelset FROM t GROUP BY id)
      SELECT id, labelset, CAST(dense_rank() OVER (ORDER BY labelset) - 1 AS INTEGER) AS powerset_label FROM s""",
    "replace_synonyms": """WITH d AS (SELECT DISTINCT w AS word, '<' || w || '>' AS synonym FROM (
          SELECT unnest(string_split(text, ' ')) AS w FROM benchmark)),
      ex AS (SELECT doc_id, unnest(string_split(text, ' ')) AS tok, generate_subscripts(string_split(text, ' '), 1) AS pos
             FROM documents)
      SELECT ex.doc_id, string_agg(coalesce(d.synonym, ex.tok), ' ' ORDER BY ex.pos) AS augmented
      FROM ex LEFT JOIN d ON ex.tok = d.word GROUP BY ex.doc_id""",
})


ORACLES.update({
    "io_csv_roundtrip": f"""SELECT id, code, ' say "' || text || '", a\\b ' || CASE WHEN id % 7 = 0 THEN chr(10) || 'next' ELSE '' END
        AS text, CASE WHEN id % 5 = 0 THEN '' WHEN id % 5 <> 1 THEN origin END AS origin FROM {T}""",
    "io_jsonl_roundtrip": f"SELECT * FROM {S.PARSED}",
    "io_corpus_roundtrip": f"""SELECT chapter, count(*) AS n_rows, count(DISTINCT label) AS n_labels,
        (SELECT count(DISTINCT code) FROM {S.CORPUS}) AS n_label_table FROM {S.CORPUS} GROUP BY chapter""",
    "io_runs_roundtrip": f"""WITH a AS (SELECT run_id, CAST(count_if(top_prediction = code) AS BIGINT) AS n_correct_partitioned,
        count(*) AS n_rows, CAST(count_if(top_prediction = code) AS BIGINT) AS n_correct_dirs,
        CAST(count_if(top_prediction = code) AS BIGINT) AS n_correct_csv
      FROM (SELECT *, 'run_a' AS run_id FROM {S.RUN_A} UNION ALL SELECT *, 'run_b' FROM {S.RUN_B}) GROUP BY run_id),
      m AS (SELECT 'run_a' AS run_id, * FROM ({report(S.RUN_A)}) UNION ALL SELECT 'run_b', * FROM ({report(S.RUN_B)}))
      SELECT * FROM a JOIN m USING (run_id)""",
    "io_append_log": f"SELECT code, 2 * count(*) AS n_records FROM {S.GENERATED} GROUP BY code",
})


ORACLES.update({
    "corpus_medium": f"SELECT code, text, origin, label, chapter FROM {S.CORPUS} WHERE chapter IN ('M')",
    "label_maps": f"SELECT DISTINCT label, code FROM {S.CORPUS}",
    "distinct_codes": f"SELECT DISTINCT code FROM {T}",
    "dimension_first": f"""SELECT code, arg_min(section, ord) AS section, arg_min(long_desc, ord) AS long_desc,
        arg_min(short_desc, ord) AS short_desc FROM {S.XW} GROUP BY code""",
    "top_docs_per_lang": """SELECT doc_id, lang, n_chars, CAST(rank AS INTEGER) AS rank FROM (
        SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rank
        FROM documents) WHERE rank <= 3""",
    "ordered_terms": f"SELECT * FROM {T} ORDER BY code, origin, text, id",
})


def _selector_sql() -> str:
    rows = ", ".join(f"({i}, {S.q(t)})" for i, t in SELECTORS)
    return f"""WITH t AS (SELECT id, code, substr(code, 1, 1) AS chapter FROM {T}),
      s(selector_id, text) AS (VALUES {rows}),
      req AS (SELECT DISTINCT selector_id, upper(trim(x)) AS v FROM (
        SELECT selector_id, unnest(regexp_split_to_array(text, '[,\\s]+')) AS x FROM s) WHERE trim(x) <> ''),
      hit AS (SELECT * FROM req WHERE (length(v) = 1 AND v IN (SELECT chapter FROM t))
                                   OR (length(v) = 3 AND v IN (SELECT code FROM t)))
      SELECT t.id, t.code, t.chapter, s.selector_id FROM t, s
      WHERE EXISTS (SELECT 1 FROM hit h WHERE h.selector_id = s.selector_id AND h.v IN (t.chapter, t.code))
        OR NOT EXISTS (SELECT 1 FROM hit h WHERE h.selector_id = s.selector_id)"""


PRED_EVEN = f"(SELECT * FROM {TERM_PRED} WHERE length(input) % 2 = 0)"

ORACLES.update({
    "vector_lsh_neighbours": "SELECT count(*) AS n_queries, TRUE AS recall_ok FROM embeddings WHERE vec_id % 20 = 0",
    "vector_lsh_recall": "SELECT count(*) AS n_queries, TRUE AS recall_ok, TRUE AS candidates_ok FROM embeddings",
    "merge_predictions_left": f"""SELECT t.*, p.top_prediction, FALSE AS fan_out FROM {T} t LEFT JOIN {PRED_EVEN} p
        ON t.text = p.input
      UNION ALL SELECT t.*, p.top_prediction, TRUE FROM {T} t LEFT JOIN (SELECT * FROM {PRED_EVEN} UNION ALL
        SELECT * FROM {PRED_EVEN}) p ON t.text = p.input""",
    "audit_code_literal": f"""SELECT id, code, origin, 'code' AS leg FROM {T} WHERE regexp_matches(code, '^[se]1', 'i')
        AND origin IN ('icpc2_short', 'icpc2_inclusion')
      UNION ALL SELECT id, code, origin, 'literal' FROM {T} WHERE contains(lower(text), 'brand#1')""",
    "apply_selector_table": _selector_sql(),
    "materialize": f"SELECT * FROM {T}",
    "pr_auc": """WITH s AS (SELECT round(n_chars % 97 / 97.0, 6) AS score, CAST(lang = 'en' AS INTEGER) AS y FROM documents),
      g AS (SELECT score, sum(y) AS p, count(*) AS n FROM s WHERE score IS NOT NULL AND y IS NOT NULL GROUP BY score),
      c AS (SELECT score, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS np,
                   sum(p) OVER () AS pos FROM g),
      k AS (SELECT score, tp / pos AS r, tp / np AS pr FROM c),
      j AS (SELECT r, pr, coalesce(lag(r) OVER (ORDER BY score DESC), 0) AS r0,
                   coalesce(lag(pr) OVER (ORDER BY score DESC), pr) AS pr0 FROM k)
      SELECT round(sum((r - r0) * (pr + pr0) / 2), 6) AS pr_auc FROM j""",
    "check_train_score": f"""SELECT doc_id, CAST(3 AS INTEGER) AS n_ranks, TRUE AS falls, TRUE AS in_range, TRUE AS mass_one
      FROM {STRAT} WHERE split = 'test'""",
    "check_cross_validate": f"""SELECT fold, count(*) AS n_rows, TRUE AS beats_majority FROM (
      SELECT CAST((row_number() OVER (ORDER BY {S.md5k('doc_id')}, doc_id) - 1) % 5 AS INTEGER) AS fold FROM documents
        WHERE lang IS NOT NULL) GROUP BY fold""",
    "check_grid_search": """SELECT CAST(s AS DOUBLE) AS smoothing, CAST(f AS INTEGER) AS num_features, TRUE AS beats_majority,
        CAST(2 AS INTEGER) AS n_drawn FROM (VALUES (0.5), (1.0)) a(s), (VALUES (4096), (65536)) b(f)""",
    "check_evaluate_model": "SELECT * FROM (VALUES ('test', TRUE), ('all', TRUE)) t(split, ok)",
    "check_weighted_rf": """SELECT lang, count(*) AS n_rows, round(1.0 - count(*) / (SELECT count(*) FROM documents), 6) AS weight,
        round(1.0 - count(*) / (SELECT count(*) FROM documents), 6) AS least FROM documents GROUP BY lang""",
    "check_one_vs_rest": "SELECT count(*) AS n_rows, TRUE AS in_range, TRUE AS fits FROM documents WHERE lang IS NOT NULL",
    "check_pseudo_label": """SELECT TRUE AS within_test, TRUE AS most_accepted, TRUE AS codes_known,
        'pseudo_label' AS origin""",
    "check_stream_score": """SELECT CAST(r AS INTEGER) AS rank, (SELECT count(*) FROM documents) AS n_rows, TRUE AS in_range,
        TRUE AS is_share FROM (VALUES (1), (2), (3)) t(r)""",
})


# Naive Bayes on words. ``rows``: (doc_id, text, lang, fold); the model for fold
# f is fitted on the other folds.
def _words(rows: str) -> str:
    return f"""d AS (SELECT * FROM {rows}),
  t AS (SELECT doc_id, lang, fold, term, count(*) AS n FROM (SELECT doc_id, lang, fold,
          unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS term FROM d) GROUP BY ALL),
  f AS (SELECT DISTINCT fold AS f FROM d),
  nw AS (SELECT f, lang, term, sum(n) AS m FROM t, f WHERE fold <> f GROUP BY ALL),
  voc AS (SELECT f, count(DISTINCT term) AS v FROM nw GROUP BY f),
  known AS (SELECT DISTINCT f, term FROM nw),
  pr AS (SELECT f, lang, count(*) AS docs FROM d, f WHERE fold <> f GROUP BY ALL),
  cls AS (SELECT pr.f, pr.lang, ln(docs / sum(docs) OVER (PARTITION BY pr.f)) AS prior, coalesce(w, 0) AS w, v
          FROM pr JOIN voc USING (f) LEFT JOIN (SELECT f, lang, sum(m) AS w FROM nw GROUP BY ALL) USING (f, lang))"""


def _nb_predictions(rows: str, smoothing: str, model: str) -> str:
    """(doc_id, lang, fold, a, prediction); ``model``: the fold left out for a row."""
    return f"""(WITH {_words(rows)}, al AS (SELECT unnest({smoothing}) AS a),
  x AS (SELECT t.doc_id, cls.lang AS c, al.a, sum(t.n * (ln(coalesce(nw.m, 0) + al.a) - ln(cls.w + al.a * cls.v))) AS s
        FROM (SELECT *, {model} AS g FROM t) t JOIN known ON known.f = t.g AND known.term = t.term
        JOIN cls ON cls.f = t.g CROSS JOIN al LEFT JOIN nw ON nw.f = t.g AND nw.lang = cls.lang AND nw.term = t.term
        GROUP BY ALL),
  y AS (SELECT d.doc_id, d.lang, d.fold, al.a, cls.lang AS c, cls.prior + coalesce(x.s, 0) AS score
        FROM (SELECT *, {model} AS g FROM d) d JOIN cls ON cls.f = d.g CROSS JOIN al
        LEFT JOIN x ON x.doc_id = d.doc_id AND x.c = cls.lang AND x.a = al.a)
  SELECT doc_id, lang, fold, a, c AS prediction FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, a ORDER BY score DESC, c) AS rn FROM y) WHERE rn = 1)"""


_NB_FOLDS = f"""(SELECT doc_id, text, lang, CAST((row_number() OVER (ORDER BY {S.md5k('doc_id')}, doc_id) - 1) % 5 AS INTEGER)
  AS fold FROM documents WHERE lang IS NOT NULL)"""
_NB_SPLIT = f"""(SELECT doc_id, text, lang, CAST(split = 'test' AS INTEGER) AS fold FROM documents JOIN (
  SELECT doc_id, split FROM {STRAT} WHERE lang IS NOT NULL) USING (doc_id))"""
_NB_RUN = "(SELECT lang AS code, prediction AS top_prediction FROM {} {})"
_NB_PRED = _nb_predictions(_NB_SPLIT, "[1.0::DOUBLE]", "1")

ORACLES.update({
    "nb_cross_validate": f"""SELECT a AS smoothing, fold, count(*) AS n_rows, count_if(lang = prediction) AS n_correct,
        round(count_if(lang = prediction) / count(*), 6) AS accuracy
      FROM {_nb_predictions(_NB_FOLDS, "[0.5::DOUBLE, 1.0::DOUBLE]", "fold")} GROUP BY a, fold""",
    "nb_word_model": f"""WITH {_words(_NB_SPLIT)}
      SELECT nw.lang AS label, term, round(ln(m + 1.0) - ln(w + 1.0 * v), 6) AS log_prob
      FROM nw JOIN cls USING (f, lang) WHERE f = 1""",
    "nb_evaluate": f"""SELECT 'test' AS split, * FROM ({report(_NB_RUN.format(_NB_PRED, "WHERE fold = 1"))})
      UNION ALL SELECT 'all', * FROM ({report(_NB_RUN.format(_NB_PRED, ""))})""",
    "corpus_incremental": f"SELECT * FROM {S.CORPUS}",
    "best_thresholds": """WITH u AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
          CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS cls FROM embeddings),
      m AS (SELECT *, max(x) OVER (PARTITION BY vec_id) AS mx FROM u),
      s AS (SELECT label, cls, round(exp(x - mx) / sum(exp(x - mx)) OVER (PARTITION BY vec_id), 9) AS score FROM m),
      g AS (SELECT cls, score, count_if(coalesce(label = cls, FALSE)) AS p, count_if(NOT coalesce(label = cls, FALSE)) AS n
            FROM s GROUP BY cls, score),
      r AS (SELECT cls, score, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp,
                   CAST(sum(p) OVER (PARTITION BY cls) - sum(p) OVER w AS BIGINT) AS fn
            FROM g WINDOW w AS (PARTITION BY cls ORDER BY score DESC)),
      f AS (SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM r)
      SELECT cls AS class, score AS threshold, round(f1, 6) AS f1, tp, fp, fn FROM (
        SELECT *, row_number() OVER (PARTITION BY cls ORDER BY f1 DESC, score) AS rn FROM f) WHERE rn = 1""",
    "check_weighted_forest": f"""SELECT doc_id, CAST(10 AS INTEGER) AS n_trees, TRUE AS within_depth, TRUE AS known_class,
        TRUE AS mass_one FROM {STRAT} WHERE split = 'test'""",
})

ORACLES.update({
    "text_index_search": " UNION ALL ".join(
        f"SELECT id, text, CAST({i} AS INTEGER) AS leg FROM {T} WHERE " +
        (f"contains(lower(text), {S.q(p.lower())})" if literal else f"regexp_matches(text, {S.q(p)}, 'i')")
        for i, (p, literal) in enumerate(SEARCHES)),
    "vector_ivf_neighbours": """SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS rank, count(*) AS n_queries,
        TRUE AS recall_reached, TRUE AS bounds_exact FROM embeddings WHERE label IS NOT NULL AND vec_id % 20 = 0""",
    "distinct_sketches": f"""SELECT substr(code, 1, 1) AS chapter, count(*) AS n_rows, count(DISTINCT text) AS n_distinct,
        TRUE AS within FROM {T} GROUP BY 1""",
})
