"""Logical tables of the label-corpus model, derived from the supplied test
tables (TPC-H-ish parquet). Each simple view is a list of SQL expressions that
Spark (``selectExpr``) and the DuckDB oracle both evaluate, so the two sides
read exactly the same logical rows.

Mapping (see SURVEY 7.3):

* ``code_system``  one row per ``part``: code = type initial + 2-digit size
  (the letter+2-digit code shape), names from ``p_name``/``p_brand``, a
  ``;``-separated inclusion list, and a code list of neighbouring part keys in
  the ``"H54.0; H54.1"`` format for the crosswalk.
* ``xw_dim``       crosswalk dimension from ``part``: key ``p_partkey || '0'``
  (what TXT1 makes of ``"511.0"``) for non-promotional parts (promotional
  keys miss), plus a later, losing second description for large parts.
* ``code_lists``   one row per ``orders`` row with the ordered list of its
  lineitem part keys (NULL when the order has no lines).
* ``terms``        ``(code, text, origin, id)`` rows straight from ``part``.
* ``augmentation`` generated synonyms from ``part`` with a reviewed flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Ids per generated response: a code's rows are cut into ranges of ids.
RESPONSE_IDS = 256
PART_CODE = "upper(substr(p_type, 1, 1)) || lpad(CAST(p_size AS STRING), 2, '0')"
ORIGIN_BY_KEY = ("CASE p_partkey % 4 WHEN 0 THEN 'icpc2_description' WHEN 1 THEN 'icpc2_short' "
                 "WHEN 2 THEN 'icpc2_inclusion' ELSE 'icd10_description' END")

SIMPLE_VIEWS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "code_system": ("part", [
        ("row_key", "p_partkey"),
        ("cod", PART_CODE),
        ("nome", "p_name || ' ' || p_brand"),
        ("nome_curto", "p_name"),
        ("incl", "CASE WHEN p_partkey % 5 = 0 THEN CAST(NULL AS STRING) "
                 "WHEN p_partkey % 7 = 0 THEN p_name || '; ; ' || p_brand "
                 "ELSE p_name || '; ' || lower(p_type) || ' ' || p_brand END"),
        ("excl", "CASE WHEN p_partkey % 2 = 0 THEN 'ver ' || " + PART_CODE + " || ' ; ' || p_type "
                 "ELSE CAST(NULL AS STRING) END"),
        ("crit", "CASE WHEN p_size > 25 THEN 'size ' || CAST(p_size AS STRING) "
                 "ELSE CAST(NULL AS STRING) END"),
        ("cons", "CAST(NULL AS STRING)"),
        ("nota", "p_brand"),
        ("icd10", "CASE WHEN p_partkey % 11 = 0 THEN CAST(NULL AS STRING) ELSE "
                  "CAST(p_partkey AS STRING) || '.0; ' || CAST(p_partkey + 1 AS STRING) || '.0; ' "
                  "|| CAST(p_partkey + 2 AS STRING) || '.0' END"),
        ("componente", "p_type"),
    ]),
    "xw_dim_first": ("part", [
        ("code", "CAST(p_partkey AS STRING) || '0'"),
        ("section", "p_type"),
        ("long_desc", "p_name || ' ' || p_type"),
        ("short_desc", "p_name"),
        ("ord", "p_partkey * 2"),
    ]),
    "xw_dim_second": ("part", [
        ("code", "CAST(p_partkey AS STRING) || '0'"),
        ("section", "p_type"),
        ("long_desc", "p_brand || ' alt'"),
        ("short_desc", "p_brand"),
        ("ord", "p_partkey * 2 + 1"),
    ]),
    "terms": ("part", [
        ("id", "p_partkey"),
        ("code", PART_CODE),
        ("text", "p_name || ' ' || p_brand"),
        ("origin", ORIGIN_BY_KEY),
    ]),
    "augmentation": ("part", [
        ("id", "p_partkey"),
        ("code", PART_CODE),
        ("text", "p_name || ' ' || lower(p_type)"),
        ("origin", "'generator'"),
        ("include", "CASE p_partkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE CAST(NULL AS BOOLEAN) END"),
        ("context", "'synonyms'"),
        ("prompt", "'prompt ' || " + PART_CODE),
    ]),
}
# The dimension does not cover every key (promotional parts have no entry,
# so their codes miss), and large parts carry a second, later description
# that must lose to the first.
FILTERS = {
    "xw_dim_first": "p_type <> 'PROMO'",
    "xw_dim_second": "p_type <> 'PROMO' AND p_size > 25",
}


# Schemas of the supplied tables, given explicitly so a scan needs no
# footer-reading job to infer them (and a changed file fails loudly).
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def simple_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    src, cols = SIMPLE_VIEWS[name]
    df = table(spark, sf_dir, src)
    if name in FILTERS:
        df = df.filter(F.expr(FILTERS[name]))
    return df.selectExpr(*[f"{expr} AS {alias}" for alias, expr in cols])


def simple_view_sql(name: str) -> str:
    src, cols = SIMPLE_VIEWS[name]
    where = f" WHERE {FILTERS[name]}" if name in FILTERS else ""
    return "SELECT " + ", ".join(f"{expr} AS {alias}" for alias, expr in cols) + f" FROM {src}{where}"


def code_system(spark, sf_dir):
    return simple_view(spark, sf_dir, "code_system")


def xw_dim(spark, sf_dir):
    return simple_view(spark, sf_dir, "xw_dim_first").unionByName(simple_view(spark, sf_dir, "xw_dim_second"))


def xw_dim_sql() -> str:
    return f"({simple_view_sql('xw_dim_first')} UNION ALL {simple_view_sql('xw_dim_second')})"


def terms(spark, sf_dir):
    return simple_view(spark, sf_dir, "terms")


def augmentation(spark, sf_dir):
    return simple_view(spark, sf_dir, "augmentation")


def code_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, ``'; '``-joined ``l_partkey || '.0'`` in (line number, part key)
    order; orders without lines get NULL.

    One shuffle, no join: order keys and line items are unioned and grouped
    by order key once (an order key marks the group as a real order; the
    lines' list skips the order's NULL entry). The result stays
    hash-partitioned on the order key, so the crosswalk's explode -> lookup
    -> regroup chain runs in the stage after this shuffle, with no further
    exchange."""
    entry = "struct<l_linenumber:int,l_partkey:bigint>"
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.struct("l_linenumber", "l_partkey").alias("_e"),
        F.lit(False).alias("_is_order"))
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lit(None).cast(entry).alias("_e"), F.lit(True).alias("_is_order"))
    g = li.unionByName(od).groupBy("o_orderkey").agg(
        F.max("_is_order").alias("_is_order"), F.sort_array(F.collect_list("_e")).alias("_l"))
    icd10 = F.when(F.size("_l") > 0, F.array_join(
        F.transform("_l", lambda s: F.concat(s["l_partkey"].cast("string"), F.lit(".0"))), "; "))
    return g.filter("_is_order").select("o_orderkey", icd10.alias("icd10"))


CODE_LISTS_SQL = """(SELECT o.o_orderkey, l.icd10 FROM orders o LEFT JOIN (
  SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR) || '.0', '; ' ORDER BY l_linenumber, l_partkey) AS icd10
  FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey)"""


def part_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crosswalk dimension for the order code lists: every non-promotional
    part (promotional ones miss) with a first description and, for large
    parts, a later losing one."""
    p = table(spark, sf_dir, "part").filter("p_type <> 'PROMO'")
    first = p.selectExpr("CAST(p_partkey AS STRING) || '0' AS k", "p_name || ' #' || CAST(p_partkey AS STRING) AS v",
                         "p_partkey * 2 AS ord")
    second = p.filter("p_size > 25").selectExpr("CAST(p_partkey AS STRING) || '0' AS k", "p_brand AS v",
                                                "p_partkey * 2 + 1 AS ord")
    return first.unionByName(second)


PART_DIM_SQL = """(SELECT CAST(p_partkey AS STRING) || '0' AS k, p_name || ' #' || CAST(p_partkey AS STRING) AS v,
  p_partkey * 2 AS ord FROM part WHERE p_type <> 'PROMO'
  UNION ALL SELECT CAST(p_partkey AS STRING) || '0', p_brand, p_partkey * 2 + 1 FROM part
  WHERE p_type <> 'PROMO' AND p_size > 25)"""
