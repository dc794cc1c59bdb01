"""Slicing and auditing: FIL3 FIL4 FIL5 FIL8 FIL10 JOI4 JOI5 SET5."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.common import first_per_key, small_side


def audit(df: DataFrame, code: str | None = None, text: str | None = None, chapters=None,
          origins=None, literal: bool = False) -> DataFrame:
    """FIL3 + FIL4. Case-insensitive regex containment on code and/or text,
    conjunctive with IN-lists on chapter and origin (an empty list = no
    filter). Plain ``Column`` predicates, so they reach the scan."""
    cond = F.lit(True)
    for col, pat in (("code", code), ("text", text)):
        if pat:
            if literal:
                cond = cond & F.lower(F.col(col)).contains(pat.lower())
            else:
                cond = cond & F.col(col).rlike("(?iu)" + pat)
    if chapters:
        cond = cond & F.col("chapter").isin(list(chapters))
    if origins:
        cond = cond & F.col("origin").isin(list(origins))
    return df.filter(cond)


def selector_tokens(selectors: DataFrame, text: str = "text", sid: str = "selector_id") -> DataFrame:
    """Selector text -> ``(selector_id, kind, value)`` rows: split on
    ``[,\\s]+``, upper-case, de-duplicate; length 1 = chapter, 3 = code,
    anything else ignored."""
    toks = selectors.select(sid, F.explode(F.array_distinct(F.transform(
        F.filter(F.split(F.col(text), r"[,\s]+"), lambda x: x != F.lit("")),
        lambda x: F.upper(F.trim(x))))).alias("value"))
    kind = F.when(F.length("value") == 1, F.lit("chapter")).when(F.length("value") == 3, F.lit("code"))
    return toks.select(sid, kind.alias("kind"), "value").filter(F.col("kind").isNotNull())


def existing(values: DataFrame, labels: DataFrame, kind_col: str = "kind", value_col: str = "value") -> DataFrame:
    """JOI4. Keep requested chapters/codes that exist in the label table
    (chapters against chapters, codes against codes)."""
    known = (labels.select(F.lit("chapter").alias(kind_col), F.col("chapter").alias(value_col))
             .unionByName(labels.select(F.lit("code").alias(kind_col), F.col("code").alias(value_col)))
             .distinct())
    return values.join(small_side(known), [kind_col, value_col], "left_semi")


def parse_selector(selector: str) -> tuple[list[str], list[str]]:
    """FIL5 parsing of one selector string (a parameter, not data): split on
    ``[,\\s]+``, upper-case, de-duplicate; length 1 -> chapters, 3 -> codes,
    other lengths ignored."""
    toks = sorted({t.strip().upper() for t in re.split(r"[,\s]+", selector or "") if t.strip()})
    return [t for t in toks if len(t) == 1], [t for t in toks if len(t) == 3]


def apply_selectors(df: DataFrame, selector: str, labels: DataFrame) -> DataFrame:
    """FIL5 + JOI4 + SET5. Rows whose chapter is one of the selector's chapters
    or whose code is one of its codes, each row once. Values absent from the
    label table are dropped; if nothing survives there is no filter and every
    row is returned.

    Plan: the surviving values are a tiny table (semi-joined against the
    labels); the rows are matched by two broadcast equi left joins with a
    flag each, and the "nothing survived" case is an ``EXISTS`` subquery, so
    there is no union to de-duplicate and no cross join.
    """
    chapters, codes_ = parse_selector(selector)
    spark = df.sparkSession
    req = spark.createDataFrame([("chapter", v) for v in chapters] + [("code", v) for v in codes_],
                                "kind string, value string")
    vals = existing(req, labels)
    ch = vals.filter("kind = 'chapter'").select(F.col("value").alias("chapter"), F.lit(True).alias("_by_ch"))
    cd = vals.filter("kind = 'code'").select(F.col("value").alias("code"), F.lit(True).alias("_by_cd"))
    # with literals known now, a plain predicate also reaches the scan (partition
    # pruning on chapter); it only holds if something survives, which the tiny
    # request tells (at most its own rows reach the driver)
    if vals.limit(1).count():
        df = df.filter(F.col("chapter").isin(chapters) | F.col("code").isin(codes_))
    out = df.join(F.broadcast(ch), "chapter", "left").join(F.broadcast(cd), "code", "left")
    cond = F.coalesce("_by_ch", F.lit(False)) | F.coalesce("_by_cd", F.lit(False)) | ~vals.exists()
    return out.filter(cond).select(*df.columns)


def apply_selector_table(df: DataFrame, selectors: DataFrame, labels: DataFrame, text: str = "text",
                         sid: str = "selector_id") -> DataFrame:
    """FIL5 over a table ``(selector_id, text)``: per selector, the rows of
    ``df`` that :func:`apply_selectors` returns, tagged with ``selector_id``,
    in one job.

    Values that exist in the label table match rows by two equi-joins (chapter,
    code); a row that matches twice counts once. Selectors of which nothing
    survives take every row: their ids, a table of request size, are attached
    to each row as one array and exploded.
    """
    toks = selector_tokens(selectors, text, sid)
    vals = existing(toks, labels)
    ch = vals.filter("kind = 'chapter'").select(sid, F.col("value").alias("chapter"))
    cd = vals.filter("kind = 'code'").select(sid, F.col("value").alias("code"))
    by_ch = df.join(small_side(ch), "chapter").select(*df.columns, sid)
    # a row whose chapter the selector names already is not taken again by its code
    by_cd = df.join(small_side(cd), "code").join(small_side(ch), [sid, "chapter"], "left_anti").select(
        *df.columns, sid)
    unmatched = selectors.select(sid).distinct().join(vals.select(sid).distinct(), sid, "left_anti")
    ids = unmatched.agg(F.sort_array(F.collect_list(sid))).scalar()
    every = df.withColumn(sid, F.explode(ids)).select(*df.columns, sid)
    return by_ch.unionByName(by_cd).unionByName(every)


def subset(df: DataFrame, size: str = "full", medium_chapters=("K",)) -> DataFrame:
    """FIL8. ``medium`` = the rows of ``medium_chapters`` (chapter K by
    default), anything else = all rows. On a corpus written partitioned by
    chapter the predicate prunes partitions at the scan."""
    return df.filter(F.col("chapter").isin(list(medium_chapters))) if size == "medium" else df


def cards(df: DataFrame, codes_df: DataFrame, code: str = "cod", order: str = "row_key",
          fields=("nome", "incl", "excl", "crit", "icd10_description")) -> DataFrame:
    """FIL10. Descriptive fields of the requested codes, first row per code,
    for every requested code in one job."""
    fields = [f for f in fields if f in df.columns]
    wanted = df.join(small_side(codes_df.select(F.col(codes_df.columns[0]).alias(code)).distinct()),
                     code, "left_semi")
    return first_per_key(wanted.select(code, order, *fields), code, order, cols=fields)


def with_flag(df: DataFrame, right: DataFrame, keys, flag: str = "flag") -> DataFrame:
    """JOI5. Left join against the distinct keys of ``right`` with a boolean
    membership flag (missing -> false). Distinct keys first, so duplicated
    right rows never fan out."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    r = right.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return df.join(small_side(r), keys, "left").withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_hit")
