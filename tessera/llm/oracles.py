"""DuckDB SQL for the registered queries whose result SQL can express."""

from __future__ import annotations

from tessera.llm import filter_audit, mixing

WORD = r"[^\x20\x09-\x0D]+"

TOP_K = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
  SELECT query_id, CAST(rn AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s) WHERE rn <= 5"""


def _base32(hexadecimal: str) -> str:
    """Base32 of 40 hexadecimal digits: five of them are four characters."""
    part = "CAST('0x' || substr({h}, {i}, 5) AS BIGINT)"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return " || ".join(f"substr('{letters}', CAST(({part.format(h=hexadecimal, i=i)} >> {shift}) & 31 AS INTEGER) + 1, 1)"
                       for i in range(1, 41, 5) for shift in (15, 10, 5, 0))


WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
  g AS (SELECT h, max(page_id) AS top, count(*) AS n FROM p GROUP BY h),
  r AS (SELECT p.*, n > 1 AND page_id <> top AS again, top FROM p JOIN g USING (h))
  SELECT page_id, strlen(html) AS payload_bytes, {_base32('h')} AS payload_digest,
    CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to FROM r"""

NEAR_DUPLICATES = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)),
      lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
  classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM s) GROUP BY s),
  x AS (SELECT rep, n, unnest(s) AS e FROM classes),
  c AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS hits FROM x a JOIN x b USING (e)
    WHERE a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.rep, b.rep),
  near AS (SELECT a, b FROM c WHERE 100 * hits >= 80 * (na + nb - hits)),
  edge AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
  reach(a, b) AS (SELECT rep, rep FROM classes UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b),
  part AS (SELECT a AS rep, min(b) AS component FROM reach GROUP BY a)
  SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
    CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE part.component END AS component_id,
    CASE WHEN len(s.s) = 0 THEN TRUE ELSE s.doc_id = part.component END AS kept
  FROM s JOIN classes ON classes.s = list_sort(s.s) JOIN part USING (rep)"""

SOURCE_MIX = f"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
      md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key FROM documents),
  w AS (SELECT source, sum(size) AS has, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM d GROUP BY source),
  o AS (SELECT *, sum(has) OVER () - 3 * coalesce(sum(has) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
      sum(weight) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM w WINDOW up AS (ORDER BY has / weight, source)),
  stop AS (SELECT *, weight * rest > 3 * has * weights AS stopped FROM o),
  level AS (SELECT (SELECT sum(has) FROM w) - coalesce(sum(CASE WHEN stopped THEN 3 * has END), 0) AS rest,
      sum(CASE WHEN NOT stopped THEN weight END) AS weights FROM stop),
  t AS (SELECT stop.source, CAST(has AS BIGINT) AS has, CASE WHEN stopped THEN CAST(3 * has AS DOUBLE)
      ELSE CAST(level.rest AS DOUBLE) * stop.weight / level.weights END AS target FROM stop, level),
  b AS (SELECT *, CAST(round(target) AS BIGINT) // greatest(has, 1) AS epochs, CAST(round(target) AS BIGINT) % greatest(has, 1) AS part FROM t),
  r AS (SELECT d.*, b.*, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS before
    FROM d JOIN b ON b.source IS NOT DISTINCT FROM d.source)
  SELECT doc_id, size, has AS source_size, target, epochs * size + greatest(0, least(part - before, size)) AS taken, source FROM r"""

_ORDERS = "SELECT a.l || b.l || c.l || d.l || e.l AS o FROM l a, l b, l c, l d, l e WHERE " + " AND ".join(
    f"{x}.l <> {y}.l" for i, x in enumerate("abcde") for y in "abcde"[i + 1:])

FILTER_AUDIT = f"""WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
  m AS (SELECT t, min(doc_id) AS first_id FROM t GROUP BY t),
  w AS (SELECT t.*, first_id, regexp_extract_all(t, '{WORD}') AS w FROM t JOIN m USING (t)),
  f AS (SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
      || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
      || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(t, '{filter_audit.MARKS}') THEN 'D' ELSE '' END
      || CASE WHEN coalesce(doc_id > first_id, FALSE) THEN 'E' ELSE '' END AS fails FROM w),
  lab AS (SELECT doc_id, max(CAST(coalesce(quality = 1, FALSE) AS INTEGER)) AS good,
      max(CAST(coalesce(toxic = 1, FALSE) AS INTEGER)) AS bad FROM labels GROUP BY doc_id),
  c AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad
    FROM f LEFT JOIN lab USING (doc_id) GROUP BY part, fails),
  l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
  s AS (SELECT o, k, substr(o, k, 1) AS x, substr(o, 1, k - 1) AS done FROM ({_ORDERS}), range(1, 6) r(k)),
  g AS (SELECT part, o, k, x,
      sum(CASE WHEN translate(fails, done || x, '') = fails THEN n ELSE 0 END) AS kept,
      sum(CASE WHEN contains(fails, x) AND translate(fails, done, '') = fails THEN n ELSE 0 END) AS removed,
      sum(CASE WHEN contains(fails, x) AND translate(fails, done, '') <> fails THEN n ELSE 0 END) AS redundant,
      sum(CASE WHEN fails = x THEN n ELSE 0 END) AS unique_fails,
      sum(CASE WHEN contains(fails, x) AND translate(fails, done, '') = fails THEN good ELSE 0 END) AS good_lost,
      sum(CASE WHEN contains(fails, x) AND translate(fails, done, '') = fails THEN bad ELSE 0 END) AS toxic_lost
    FROM c, s GROUP BY ALL)
  SELECT part, o AS filter_order, CAST(k AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
    CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM g"""

ORACLES = {"op2_exact_topk": TOP_K, "op8_warc": WARC, "op9_near_duplicates": NEAR_DUPLICATES, "op12_source_mix": SOURCE_MIX,
           "op13_filter_audit": FILTER_AUDIT}
