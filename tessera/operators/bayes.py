"""Multinomial naive Bayes on a word vocabulary by sufficient statistics: MLD5,
MLD7, MLD8, MLD9.

Word counts per (label, word, fold) are all that training needs, and they add
up: the model of "all folds but f" is the total minus fold f, and candidates of
the smoothing share the counts. So texts are read and cut into words once, and
five folds times any number of candidates are fitted and evaluated from one table
of (row, word) counts. No model passes through the driver.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.common import cut, small_side

WORD = r"[\p{L}\p{N}]+"
SMOOTHING = (0.5, 1.0)


class Statistics(NamedTuple):
    """``rows`` (id, label, fold), ``terms`` (id, label, fold, term, n), both
    one row per document (and word); ``words`` (label, term, others), ``classes``
    (label, docs, words) and ``totals`` (docs, vocabulary), whose arrays have
    one entry per fold: what all other folds hold."""
    rows: DataFrame
    terms: DataFrame
    words: DataFrame
    classes: DataFrame
    totals: DataFrame
    folds: int


def _others(n: Column, folds: int) -> Column:
    """Per fold, the sum of ``n`` over all other folds."""
    return F.array(*[F.sum(F.when(F.col("fold") != f, n).otherwise(0)) for f in range(folds)])


def statistics(df: DataFrame, folds: int, id_col: str = "doc_id", label: str = "label", text: str = "text",
               fold: str = "fold") -> Statistics:
    """Count the words of ``df`` by label and fold (0 to ``folds`` - 1). Words:
    runs of letters and digits of the lower-case text. A NULL text has no word;
    rows without id, label or fold take no part; rows that share an id are one
    document. A text's words are sorted and counted in its own row, so the (row,
    word) counts need no shuffle; they are written once, the rest derives from
    them by partial aggregation (a frequent word collapses map-side). All that
    is made of them are sums, so rows that share an id need not be merged."""
    known = df.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & F.col(fold).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(fold).cast("int").alias("fold"), F.col(text).alias("_t"))
    found = F.regexp_extract_all(F.lower(F.coalesce(F.col("_t"), F.lit(""))), F.lit(WORD), F.lit(0))
    known = known.select("id", "label", "fold", F.sort_array(found).alias("_w"))
    first = F.filter(F.sequence(F.lit(0), F.size("_w") - 1), lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", i - 1)))
    known = known.select("*", F.when(F.size("_w") > 0, first).alias("_first"))
    runs = F.transform("_first", lambda i, k: F.struct(F.get("_w", i).alias("term"), (
        F.coalesce(F.get("_first", k + 1), F.size("_w")) - i).cast("long").alias("n")))
    # a row without a word keeps one entry, of no word
    terms = known.select("id", "label", "fold", F.explode_outer(runs).alias("_r"))
    terms = cut(terms.select("id", "label", "fold", "_r.term", F.coalesce("_r.n", F.lit(0)).alias("n")), "nb-terms")
    rows = terms.select("id", "label", "fold").distinct()
    terms = terms.filter("n > 0")
    words = cut(terms.groupBy("label", "term").agg(_others(F.col("n"), folds).alias("others")), "nb-words")
    held = words.groupBy("label").agg(*[F.sum(F.col("others")[f]).alias(f"w{f}") for f in range(folds)])
    docs = rows.groupBy("label").agg(_others(F.lit(1), folds).alias("docs"))
    zero = F.array(*[F.lit(0).cast("long")] * folds)
    classes = cut(docs.join(held, "label", "left").select(
        "label", "docs", F.coalesce(F.when(F.col("w0").isNotNull(), F.array(*[f"w{f}" for f in range(folds)])),
                                    zero).alias("words")), "nb-classes")
    seen = words.groupBy("term").agg(*[F.max(F.col("others")[f]).alias(f"m{f}") for f in range(folds)])
    vocabulary = seen.agg(F.array(*[F.count_if(F.col(f"m{f}") > 0) for f in range(folds)]).alias("vocabulary"))
    n_docs = classes.agg(F.array(*[F.sum(F.col("docs")[f]) for f in range(folds)]).alias("all_docs"))
    # one row of two short arrays
    totals = df.sparkSession.range(1).select(        n_docs.scalar().alias("all_docs"), vocabulary.scalar().alias("vocabulary"))
    return Statistics(rows, terms, words, classes, cut(totals, "nb-totals"), folds)


def class_models(s: Statistics, smoothing, without: int | None = None) -> DataFrame:
    """``(without, label, prior, unseen)`` of the models fitted on all folds
    but one (each, or ``without``): log-probabilities of the class, and per
    candidate those of a word that the class never had. Labels without a row in
    the other folds are not classes of that model."""
    folds = F.sequence(F.lit(0), F.lit(s.folds - 1)) if without is None else F.array(F.lit(without))
    total = s.totals.select(F.struct("all_docs", "vocabulary")).scalar()
    rows = s.classes.select("label", "docs", "words", F.explode(folds).alias("without")).withColumn("_t", total)
    docs, words, all_docs, known = (F.element_at(c, F.col("without") + 1)
                                    for c in ("docs", "words", "_t.all_docs", "_t.vocabulary"))
    unseen = [F.ln(F.lit(float(a))) - F.ln(words + F.lit(float(a)) * known) for a in smoothing]
    return rows.filter(docs > 0).select("without", "label", F.ln(docs / all_docs).alias("prior"), F.array(*unseen).alias("unseen"))


def word_model(s: Statistics, smoothing: float, without: int) -> DataFrame:
    """MLD5. ``(label, term, log_prob)`` of the words each class has, fitted on
    all folds but ``without``; :func:`class_models` has the rest of the model."""
    n = F.element_at("others", without + 1)
    rows = s.words.filter(n > 0).join(small_side(class_models(s, [smoothing], without)), "label")
    return rows.select("label", "term", (F.ln(n + F.lit(float(smoothing))) - F.ln(F.lit(float(smoothing)))
                                         + F.col("unseen")[0]).alias("log_prob"))


def predict(s: Statistics, smoothing=SMOOTHING, without: int | None = None) -> DataFrame:
    """MLD6. ``(id, label, fold, smoothing, prediction)``: each row by the model
    of all folds but its own (or but ``without``), for every candidate. Words
    unknown to that model are ignored; equal scores go to the smallest label.

    A row's score for a class is its prior, plus its known words times the
    "unseen" term, plus what the class's own counts add: the last two are sums
    over (row, word) pairs, joined with the counts by word."""
    smoothing = [float(a) for a in smoothing]
    f = F.col("fold") if without is None else F.lit(without)
    by_word = s.words.groupBy(F.col("term").alias("_term")).agg(F.collect_list(F.struct("label", "others")).alias("by"))
    pairs = s.terms.select("id", "fold", "term", "n").join(small_side(by_word), F.col("term") == F.col("_term"))
    known = F.filter("by", lambda e: F.element_at(e["others"], f + 1) > 0)
    # one entry per class that has the word, and one (no class) that counts the known word itself
    entry = F.transform(known, lambda e: F.struct(e["label"].alias("cls"), F.element_at(e["others"], f + 1).alias("m")))
    entry = F.when(F.size(known) > 0, F.array_append(entry, F.struct(F.lit(None).alias("cls"), F.lit(0).cast("long").alias("m"))))
    own = pairs.select("id", "fold", "n", F.explode(entry).alias("e")).select("id", "fold", "n", "e.cls", "e.m")
    gain = [F.sum(F.col("n") * (F.ln(F.col("m") + a) - F.ln(F.lit(a)))).alias(f"g{i}") for i, a in enumerate(smoothing)]
    own = own.groupBy("id", "fold", "cls").agg(F.sum("n").alias("n"), *gain)
    length = own.filter("cls IS NULL").select("id", "fold", F.col("n").alias("len"))
    base = s.rows.join(length, ["id", "fold"], "left").withColumn("len", F.coalesce("len", F.lit(0)))
    models = class_models(s, smoothing, without).withColumnRenamed("label", "cls")  # folds x classes rows
    base = base.withColumn("without", f).join(small_side(models), "without").select(
        "id", "fold", "cls", *[(F.col("prior") + F.col("len") * F.col("unseen")[i]).alias(f"s{i}") for i in range(len(smoothing))])
    n = range(len(smoothing))
    every = base.unionByName(own.filter("cls IS NOT NULL").select("id", "fold", "cls", *[F.col(f"g{i}").alias(f"s{i}") for i in n]))
    score = every.groupBy("id", "fold", "cls").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in n])
    # of equal scores the smallest class: maxima first, then its least class
    top = score.groupBy("id", "fold").agg(F.array(*[
        F.struct(F.lit(a).alias("smoothing"), F.min_by("cls", F.struct(-F.col(f"s{i}"), F.col("cls"))).alias("prediction"))
        for i, a in enumerate(smoothing)]).alias("p"))
    return s.rows.join(top, ["id", "fold"]).select("id", "label", "fold", F.explode("p").alias("p")).select(
        "id", "label", "fold", "p.smoothing", "p.prediction")


def accuracy(predicted: DataFrame, *by: str) -> DataFrame:
    """``(*by, n_rows, n_correct, accuracy)``."""
    hit = F.count_if(F.col("label") == F.col("prediction"))
    return predicted.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), hit.alias("n_correct"),
                                      (hit / F.count(F.lit(1))).alias("accuracy"))


def cross_validate_words(df: DataFrame, folds: int = 5, smoothing=SMOOTHING, id_col: str = "doc_id",
                         label: str = "label", text: str = "text", fold: str = "fold") -> DataFrame:
    """MLD7 + MLD8. Accuracy per candidate and fold, all from one pass over
    the texts: ``(smoothing, fold, n_rows, n_correct, accuracy)``."""
    s = statistics(df, folds, id_col, label, text, fold)
    return accuracy(predict(s, smoothing), "smoothing", "fold")


def train_and_evaluate(df: DataFrame, smoothing=(1.0,), split: str | None = "test", id_col: str = "doc_id",
                       label: str = "label", text: str = "text", split_col: str = "split") -> DataFrame:
    """MLD5 + MLD9. Fitted on the rows whose ``split_col`` is not ``test``;
    predictions of the test rows, or of all rows (``split=None``): ``(id,
    label, fold, smoothing, prediction)``, fold 1 being the test rows."""
    part = df.withColumn("_fold", (F.col(split_col) == "test").cast("int"))
    out = predict(statistics(part, 2, id_col, label, text, "_fold"), smoothing, without=1)
    return out if split is None else out.filter(F.col("fold") == int(split == "test"))
