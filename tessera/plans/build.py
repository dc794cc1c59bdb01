"""Corpus build as one lazy DAG:

PRJ1 -> TXT1 -> JOI1 -> TXT2/PRJ2/SET1 -> FIL1 -> FIL2/SET2 -> WIN2 -> PRJ3 -> FIL6 -> WIN3

Shuffles: the crosswalk regroup (none when the code table arrives partitioned
on its key), the dimension de-dup, the duplicate-text count of WIN2 (partial
aggregation) and the distinct-code ranking of WIN3. Lookups broadcast only
after a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.functions.text import parse_code_list
from tessera.operators.common import cut
from tessera.operators.corpus import (
    drop_incomplete, drop_prefixed, drop_shadowed, encode_labels, normalize_code_system, stack_origins,
    with_augmentation, with_chapter)
from tessera.operators.crosswalk import crosswalk


def process_code_system(code_system: DataFrame, dim: DataFrame, key: str = "row_key",
                        dim_key: str = "code", dim_val: str = "long_desc", dim_order: str = "ord") -> DataFrame:
    """``processed``: code system + parsed ICD list + crosswalked descriptions."""
    cs = code_system.withColumn("icd10_codes", parse_code_list("icd10"))
    return crosswalk(cs, "icd10_codes", dim, dim_key, dim_val, dim_order,
                     out_list="icd10_list", out_join="icd10_description", key=key)


def corpus_rows(code_system: DataFrame, dim: DataFrame, augmentation: DataFrame, key: str = "row_key") -> DataFrame:
    """``code, text, origin`` of every source, before shadowing and labels."""
    processed = process_code_system(code_system, dim, key=key)
    return with_augmentation(drop_prefixed(stack_origins(normalize_code_system(processed))), augmentation)


def build_corpus(code_system: DataFrame, dim: DataFrame, augmentation: DataFrame,
                 key: str = "row_key", reference_order: bool = False, materialize: bool = True):
    """Returns ``(corpus, labels)`` with corpus columns
    ``code, text, origin, chapter, label``.

    With ``materialize`` (default) the two intermediates that feed several
    branches are written once under ``spark.checkpoint.dir``: the unioned
    rows (read by the duplicate-text count and both sides of the shadow
    filter) and the filtered corpus (read by the label ranking and the label
    join). Without it every branch replays the crosswalk DAG."""
    corpus = corpus_rows(code_system, dim, augmentation, key)
    if materialize:
        corpus = cut(corpus, "corpus_union")
    corpus = with_chapter(drop_shadowed(corpus))
    if not reference_order:
        corpus = drop_incomplete(corpus)
        if materialize:
            corpus = cut(corpus, "corpus_filtered")
    corpus, labels = encode_labels(corpus, reference_order=reference_order)
    return corpus.select("code", "text", "origin", "chapter", "label"), labels
