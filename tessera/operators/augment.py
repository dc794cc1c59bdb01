"""Augmentation loop: prompts, parsing generated lists, merging the store.

TXT6 TXT7 SET3 WIN6 IMB9.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import PROMPT_CONTEXT, clean_description, expand_abbreviations, parse_generated_list
from tessera.operators.common import cut, first_per_key, not_in, small_side


def _piece(value, prefix: str, suffix: str = ""):
    return F.when(value != F.lit(""), F.concat(F.lit(prefix), value, F.lit(suffix))).otherwise(F.lit(""))


# Names that one prompt lists at most.
NAMES_PER_PROMPT = 64


def build_prompts(processed: DataFrame, code: str = "cod", order: str = "row_key", name: str = "nome",
                  incl: str = "incl", excl: str = "excl", crit: str = "crit",
                  crosswalk_text: str = "icd10_description", names_per_prompt: int = NAMES_PER_PROMPT) -> DataFrame:
    """TXT6. One prompt per code, every code in one job:
    ``labels{"; incl, "}{", icd10"}{"; Critérios: crit"}{". Exclui: excl"}``.

    ``labels`` are the code's names in source order joined by ``'; '`` with
    abbreviations expanded; the other fields come from the code's first row,
    cleaned (TXT4), and a piece is left out when it is empty. A code with more
    than ``names_per_prompt`` rows gets several prompts, numbered by ``part``
    from 0, each with the next names: no row or task holds all names of a
    code. Codes with at most ``names_per_prompt`` names, usually all, are
    grouped as they are; only the names of the others are ranked, in a range
    layout of (code, order, name). Rows without a code have no prompt.
    """
    from tessera.operators.split import rank_within
    names = processed.select(code, order, name).filter(F.col(code).isNotNull())
    many = names.groupBy(F.col(code).alias("_many")).agg(F.count(F.lit(1)).alias("_n")).filter(
        F.col("_n") > names_per_prompt).select("_many")
    listed = F.sort_array(F.collect_list(F.struct(F.col(order).alias("_rank"), name))).alias("_names")
    some = cut(many, "long-codes")
    few = names.join(some, F.col(code) == F.col("_many"), "left_anti") if (any_many := some.limit(1).count()) else names
    lists = few.groupBy(code).agg(listed).select(code, F.lit(0).alias("part"), F.transform("_names", lambda s: s[name]).alias("_names"))
    if any_many:
        ranked = rank_within(names.join(some, F.col(code) == F.col("_many"), "left_semi"), code, F.col(order), name)
        ranked = ranked.withColumn("part", F.floor(F.col("_rank") / names_per_prompt).cast("int"))
        parts = ranked.groupBy(code, "part").agg(F.sort_array(F.collect_list(F.struct("_rank", name))).alias("_names"))
        lists = lists.unionByName(parts.select(code, "part", F.transform("_names", lambda s: s[name]).alias("_names")))
    first = first_per_key(processed.select(code, order, incl, excl, crit, crosswalk_text), code, order,
                          cols=[incl, excl, crit, crosswalk_text])
    agg = lists.join(small_side(first), code)
    labels = expand_abbreviations(F.array_join("_names", "; "))
    i, x = clean_description(F.col(incl)), clean_description(F.col(crosswalk_text))
    c, e = clean_description(F.col(crit)), clean_description(F.col(excl))
    prompt = F.concat(labels, _piece(i, "; ", ", "), _piece(x, ", "), _piece(c, "; Critérios: "),
                      _piece(e, ". Exclui: "))
    return agg.select(F.col(code).alias("code"), "part", prompt.alias("prompt"), F.lit(PROMPT_CONTEXT).alias("context"))


def parse_generated(gen: DataFrame, code: str = "code", response: str = "response", model: str = "model",
                    context: str = "context", prompt: str = "prompt", sep: str = "; ") -> DataFrame:
    """TXT7. Generated ``sep``-lists -> one accepted row per distinct item:
    ``(code, text, origin=model, include=true, context, prompt)``. One final
    ``.`` is stripped first."""
    return gen.select(
        F.col(code).alias("code"),
        F.explode(parse_generated_list(response, sep)).alias("text"),
        F.col(model).alias("origin"),
        F.lit(True).alias("include"),
        F.col(context).alias("context"),
        F.col(prompt).alias("prompt"),
    )


dedupe_keep_first = first_per_key  # WIN6


def merge_augmentation(existing: DataFrame, new: DataFrame, keys=("code", "text"),
                       order: str | None = None, assume_existing_distinct: bool = False) -> DataFrame:
    """SET3. Append-distinct upsert: union, then keep the first row per
    ``keys`` where every existing row beats every new row and, inside a side,
    the earlier row (``order``) wins. Idempotent:
    ``merge(merge(a, b), b) == merge(a, b)``.

    ``assume_existing_distinct=True`` is the large-store form: the store is
    left untouched and only new rows whose key is absent (``left_anti``),
    first per key, are appended; no shuffle of the store's payload.
    """
    keys = list(keys)
    cols = existing.columns
    new = new.select(*cols)

    def ordered(df, prio):
        pos = F.col(order) if order else F.monotonically_increasing_id()
        return df.withColumn("_prio", F.lit(prio)).withColumn("_pos", pos)

    if assume_existing_distinct:
        fresh = not_in(new, existing, keys)
        fresh = first_per_key(ordered(fresh, 1), keys, ["_prio", "_pos"]).select(*cols)
        return existing.unionByName(fresh)
    both = ordered(existing, 0).unionByName(ordered(new, 1))
    return first_per_key(both, keys, ["_prio", "_pos"]).select(*cols)


def pseudo_label(scored: DataFrame, min_value: float, corpus_cols=("code", "text", "origin"),
                 origin: str = "pseudo_label") -> DataFrame:
    """IMB9. Confident top-1 predictions as new corpus rows (union with the
    corpus via SET2)."""
    return (scored.filter(F.col("value") >= min_value)
            .select(F.col("code"), F.col("input").alias("text"), F.lit(origin).alias("origin"))
            .select(*corpus_cols))
