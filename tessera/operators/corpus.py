"""Corpus shaping: normalise, stack origins, filter, de-duplicate, encode.

PRJ1 PRJ2 PRJ3 SET1 SET2 SET4 TXT2 FIL1 FIL2 FIL6 FIL9 WIN2 WIN3 ORD1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import chapter, nullify_empty, split_parts
from tessera.operators.common import null_safe_key, small_side, with_row_id

DESCRIPTION, SHORT, INCLUSION, CROSSWALK = (
    "icpc2_description", "icpc2_short", "icpc2_inclusion", "icd10_description")
ORIGINS = [DESCRIPTION, SHORT, INCLUSION, CROSSWALK]

# code_system column -> corpus origin tag, and whether the field is a '; ' list.
DEFAULT_SLICES = [
    ("nome", DESCRIPTION, False),
    ("nome_curto", SHORT, False),
    ("incl", INCLUSION, True),
    ("icd10_description", CROSSWALK, True),
]


def normalize_code_system(df: DataFrame) -> DataFrame:
    """PRJ1. Drop the component column and the fields the corpus does not use,
    rename the code column."""
    keep = [c for c in df.columns if c not in ("componente", "excl", "crit", "cons", "nota",
                                                 "icd10", "icd10_codes", "icd10_list")]
    return df.select(*keep).withColumnRenamed("cod", "code")


def split_rows(df: DataFrame, col: str, sep: str = "; ") -> DataFrame:
    """TXT2. One row per ``sep``-separated part of ``col``; rows whose value is
    NULL are dropped; a value without the delimiter stays one row; empty parts
    are kept (FIL6 removes them later)."""
    return (df.filter(F.col(col).isNotNull())
              .withColumn(col, F.explode(split_parts(col, sep))))


def stack_origins(df: DataFrame, code: str = "code", slices=None, sep: str = "; ") -> DataFrame:
    """PRJ2 + TXT2 + SET1 in one pass over ``df``.

    Each ``(column, origin, is_list)`` slice contributes rows
    ``(code, text, origin)``; list slices are split on ``sep`` and drop NULL
    values (and NULL codes), plain slices keep NULL texts. Built as a single
    ``explode`` of an array of tagged arrays, so the source is scanned once
    rather than once per slice.
    """
    slices = slices or DEFAULT_SLICES
    tagged = []
    for col, origin, is_list in slices:
        if is_list:
            texts = F.when(F.col(code).isNotNull(), split_parts(col, sep))
        else:
            texts = F.array(F.col(col).cast("string"))
        tagged.append(F.struct(F.lit(origin).alias("origin"), texts.alias("texts")))
    s = df.select(F.col(code).alias("code"), F.explode(F.array(*tagged)).alias("_s"))
    return s.select("code", F.explode(F.col("_s.texts")).alias("text"), F.col("_s.origin").alias("origin"))


def drop_prefixed(df: DataFrame, prefix: str = "-", col: str = "code") -> DataFrame:
    """FIL1. Remove rows whose code starts with ``prefix``."""
    return df.filter(~F.col(col).startswith(prefix))


def accepted(aug: DataFrame) -> DataFrame:
    """FIL2. Accepted augmentation rows (``include`` true; NULL excluded)
    without the review columns."""
    return aug.filter(F.col("include") == F.lit(True)).drop("include", "context", "prompt")


def with_augmentation(corpus: DataFrame, aug: DataFrame) -> DataFrame:
    """SET2. UNION ALL of the corpus and the accepted augmentation rows."""
    return corpus.unionByName(accepted(aug).select(*corpus.columns))


def drop_shadowed(df: DataFrame, origins=(SHORT,), text: str = "text", origin: str = "origin") -> DataFrame:
    """WIN2. Drop rows whose ``text`` occurs more than once anywhere (NULL equals
    NULL) *and* whose origin is in ``origins``. Two short rows sharing a text
    both go.

    Plan: texts seen twice come from a partial ``groupBy(text).count`` (a hot
    text collapses map-side), and only rows with a shadowable origin are
    anti-joined against them; every other row passes untouched. No window, so
    a text held by a third of the rows is never sorted in one task.
    """
    key = null_safe_key(text)
    names = ["_k_null", "_k_val"]
    dup = df.select(*key).groupBy(*names).count().filter(F.col("count") > 1).drop("count")
    shadowable = F.coalesce(F.col(origin).isin(list(origins)), F.lit(False))
    keep = df.filter(~shadowable)
    cand = df.filter(shadowable).select("*", *key)
    kept = cand.join(dup, names, "left_anti").drop(*names)
    return keep.unionByName(kept)


def with_chapter(df: DataFrame, code: str = "code", name: str = "chapter") -> DataFrame:
    """PRJ3."""
    return df.withColumn(name, chapter(code))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """FIL6. ``'' -> NULL`` on string columns, then drop rows with any NULL."""
    cols = [nullify_empty(c).alias(c) if isinstance(t, T.StringType) else F.col(c)
            for c, t in ((f.name, f.dataType) for f in df.schema.fields)]
    return df.select(*cols).na.drop()


def canonical(df: DataFrame) -> DataFrame:
    """FIL9. Canonical descriptions only (origin = icpc2_description)."""
    return df.filter(F.col("origin") == DESCRIPTION).drop("origin")


def codes(df: DataFrame, col: str = "code") -> DataFrame:
    """SET4. Distinct values."""
    return df.select(col).distinct()


def label_dimension(df: DataFrame, code: str = "code", label: str = "label") -> DataFrame:
    """Dense 0-based rank of each distinct code in code-point order, as a
    ``(code, label)`` table. Distinct codes are range-partitioned, never
    gathered into a single partition."""
    distinct = df.select(code).filter(F.col(code).isNotNull()).distinct()
    return with_row_id(distinct, [code], name=label).withColumn(label, F.col(label).cast("int"))


def encode_labels(df: DataFrame, code: str = "code", label: str = "label",
                  reference_order: bool = False):
    """WIN3. Add an integer ``label`` = dense rank of ``code``; returns
    ``(df, labels)``.

    Default: incomplete rows are dropped first so labels are dense.
    ``reference_order=True`` encodes before the drop, so a code whose rows
    are all incomplete leaves a gap.
    """
    if not reference_order:
        df = drop_incomplete(df)
    labels = label_dimension(df, code, label)
    out = df.join(small_side(labels), code)
    if reference_order:
        out = drop_incomplete(out)
    return out, labels


def ordered(df: DataFrame, *cols) -> DataFrame:
    """ORD1. Total order at a sink (code, origin, text, ...)."""
    cols = cols or tuple(c for c in ("code", "origin", "text") if c in df.columns)
    return df.orderBy(*cols)
