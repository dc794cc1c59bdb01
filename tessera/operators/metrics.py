"""Validation and run comparison: JOI3 JOI7 AGG7-AGG11 IMB8."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.audit import with_flag
from tessera.operators.common import first_per_key, spread_join


def merge_predictions(corpus: DataFrame, pred: DataFrame, how: str = "inner", text: str = "text",
                      key: str = "input", dedupe_inputs: bool = True) -> DataFrame:
    """JOI3. Join predictions back to the corpus on the text (inner or left).
    By default the prediction side is made distinct per input first (identical
    inputs have identical predictions), so duplicated texts do not fan out d x d;
    ``dedupe_inputs=False`` reproduces the fan-out.

    Rows meet by a 256-bit digest, and the texts are compared only where digests
    match; a text held by many corpus rows is dealt over several tasks. NULL
    texts match nothing. Both sides grow with the corpus and neither is
    broadcast, whatever their compressed files suggest."""
    others = [c for c in pred.columns if c != key]
    right = pred.filter(F.col(key).isNotNull()).select(F.sha2(key, 256).alias("_digest"), F.col(key).alias("_input"),
                                                       *[F.col(c).alias(f"_p{i}") for i, c in enumerate(others)])
    if dedupe_inputs:
        right = first_per_key(right, "_digest", F.struct(*[f"_p{i}" for i in range(len(others))]) if others else F.col("_input"))
    left = corpus.withColumn("_digest", F.sha2(text, 256))
    # equal texts, said so that Spark does not make them a join key
    same = F.col(text).startswith(F.col("_input")) & (F.octet_length(text) <= F.octet_length("_input"))
    out = spread_join(left, right, "_digest", how, same, grows=True)
    return out.select(*corpus.columns, *[F.col(f"_p{i}").alias(c) for i, c in enumerate(others)])


def validate(pred: DataFrame, code: str = "code", top: str = "top_prediction") -> DataFrame:
    """AGG7. Accuracy = mean(top prediction == code), number correct, rows."""
    hit = F.coalesce(F.col(top) == F.col(code), F.lit(False))
    return pred.agg(F.avg(hit.cast("double")).alias("accuracy"),
                    F.count_if(hit).alias("n_correct"),
                    F.count(F.lit(1)).alias("n_rows"))


def correct_rows(pred: DataFrame, code: str = "code", top: str = "top_prediction") -> DataFrame:
    """AGG7. The rows predicted correctly (the ``correct_predictions`` table)."""
    return pred.filter(F.col(top) == F.col(code))


def per_class_report(pred: DataFrame, y: str = "label", yhat: str = "prediction") -> DataFrame:
    """Per class: support, tp, fp, fn, precision, recall, f1 (0 when undefined).

    Built from the confusion counts ``groupBy(y, yhat)`` (partial aggregation;
    at most classes^2 rows), never from per-row state."""
    conf = pred.groupBy(F.col(y).alias("y"), F.col(yhat).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    true_tot = conf.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"),
                                                           F.sum(F.when(F.col("y") == F.col("p"), F.col("n"))
                                                                 .otherwise(0)).alias("tp"))
    pred_tot = conf.filter(F.col("p").isNotNull()).groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    per = true_tot.join(pred_tot, "cls", "full").select(
        "cls",
        F.coalesce("support", F.lit(0)).alias("support"),
        F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("predicted", F.lit(0)).alias("predicted"))
    per = per.withColumn("fp", F.col("predicted") - F.col("tp")).withColumn("fn", F.col("support") - F.col("tp"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    return per.withColumn("f1", f1)


def classification_report(pred: DataFrame, y: str = "label", yhat: str = "prediction",
                          average: str = "macro") -> DataFrame:
    """AGG8. One row: accuracy, precision, recall, f1_score under ``average``
    (``macro``, ``weighted`` or ``micro``; micro equals accuracy for
    single-label data). Classes are those seen as truth or prediction."""
    per = per_class_report(pred, y, yhat)
    if average == "micro":
        tot = per.agg((F.sum("tp") / F.sum("support")).alias("a"))
        return tot.select(F.col("a").alias("accuracy"), F.col("a").alias("precision"),
                          F.col("a").alias("recall"), F.col("a").alias("f1_score"))
    if average == "weighted":
        w = lambda c: F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support"))
        agg = [w("precision").alias("precision"), w("recall").alias("recall"), w("f1").alias("f1_score")]
    else:
        agg = [F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1_score")]
    return per.agg((F.sum("tp") / F.sum("support")).alias("accuracy"), *agg)


def cv_mean(fold_pred: DataFrame, fold: str = "fold", y: str = "label", yhat: str = "prediction") -> DataFrame:
    """AGG9. Mean of per-fold accuracies (two-level aggregation)."""
    hit = F.coalesce(F.col(y) == F.col(yhat), F.lit(False))  # no prediction is a miss, as in validate
    per_fold = fold_pred.groupBy(fold).agg(F.avg(hit.cast("double")).alias("acc"))
    return per_fold.agg(F.avg("acc").alias("cv_accuracy"), F.count(F.lit(1)).alias("n_folds"))


def code_coverage(freq: DataFrame, correct: DataFrame, code: str = "code") -> DataFrame:
    """AGG10. Share (%, 2 dp) of codes predicted correctly at least once."""
    flagged = with_flag(freq.select(code).distinct(), correct, code, "is_correct")
    return flagged.agg(F.count_if("is_correct").alias("n_correct_codes"),
                       F.count(F.lit(1)).alias("n_codes"),
                       F.bround(100.0 * F.avg(F.col("is_correct").cast("double")), 2).alias("coverage_pct"))


def run_ledger(preds: DataFrame, run: str = "run_id", code: str = "code", top: str = "top_prediction") -> DataFrame:
    """AGG11. Per run: rows, correct, accuracy; all runs in one job."""
    hit = F.coalesce(F.col(top) == F.col(code), F.lit(False))
    return preds.groupBy(run).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(hit).alias("n_correct"),
                                  F.avg(hit.cast("double")).alias("accuracy"))


def compare_runs(a: DataFrame, b: DataFrame, keys=("code",), order: str | None = None) -> DataFrame:
    """JOI7. Overlap of two runs' correct sets: in both, only in a, only in b,
    Jaccard, and ``identical`` (ordered, position-wise equality of the key
    columns, the reference's check). ``order`` gives row positions; without it
    rows are ordered by the keys.

    Keys may be whole texts: a 256-bit digest stands for them in both joins
    and in the written layout, so no text is shuffled more than a scan does."""
    keys, names = ["_digest"], list(keys)
    sort_by = [order] if order else names
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in names]), {"ignoreNullFields": "false"}), 256)
    # a row with a NULL key is in no overlap: its side becomes part of its key
    known = F.lit(True)
    for c in names:
        known = known & F.col(c).isNotNull()

    def narrow(df, side):
        return df.select(F.when(known, digest).otherwise(F.concat(F.lit(side), digest)).alias("_key"),
                         digest.alias("_digest"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(sort_by)])
    a, b = narrow(a, "a"), narrow(b, "b")
    sa = a.select("_key").distinct().withColumn("_a", F.lit(True))
    sb = b.select("_key").distinct().withColumn("_b", F.lit(True))
    both = sa.join(sb, "_key", "full")
    counts = both.agg(
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_both"),
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNull()).alias("n_only_a"),
        F.count_if(F.col("_a").isNull() & F.col("_b").isNotNull()).alias("n_only_b"),
    )
    from tessera.operators.common import with_row_id
    # positions of both runs from one numbering of their union, ordered by
    # (run, order): run b's positions start after run a's rows
    extra = [f"_o{i}" for i in range(len(sort_by))]
    both_runs = (a.select(*keys, *extra).withColumn("_run", F.lit(0))
                 .unionByName(b.select(*keys, *extra).withColumn("_run", F.lit(1))))
    ids = with_row_id(both_runs, ["_run", *extra], "_gid")
    n_a = ids.filter(F.col("_run") == 0).agg(F.count(F.lit(1))).scalar()
    pa = ids.filter(F.col("_run") == 0).select(F.col("_gid").alias("_pos"), F.col("_digest").alias("_ka"))
    pb = ids.filter(F.col("_run") == 1).select((F.col("_gid") - n_a).alias("_pos"), F.col("_digest").alias("_kb"))
    diff = pa.join(pb, "_pos", "full").agg(
        F.count_if(~F.coalesce(F.col("_ka") == F.col("_kb"), F.lit(False))).alias("_n_diff"))
    out = counts.withColumn("_n_diff", diff.scalar())
    union = F.col("n_both") + F.col("n_only_a") + F.col("n_only_b")
    return out.select("n_both", "n_only_a", "n_only_b",
                      F.try_divide(F.col("n_both").cast("double"), union.cast("double")).alias("jaccard"),
                      (F.col("_n_diff") == 0).alias("identical"))


def multilabel_metrics(truth: DataFrame, pred: DataFrame, id_col: str = "id", label: str = "label",
                       n_labels: int | None = None) -> DataFrame:
    """IMB8. Multi-label metrics from long ``(id, label)`` tables of true and
    predicted labels: subset accuracy, Hamming loss, micro and macro F1.
    Ids are those present in ``truth`` (an id with no true labels should
    appear with a NULL label)."""
    t = truth.select(id_col, label).filter(F.col(label).isNotNull()).distinct().withColumn("_t", F.lit(True))
    p = pred.select(id_col, label).filter(F.col(label).isNotNull()).distinct().withColumn("_p", F.lit(True))
    ids = truth.select(id_col).distinct()
    pairs = t.join(p, [id_col, label], "full").join(ids, id_col, "left_semi")
    tp = F.col("_t").isNotNull() & F.col("_p").isNotNull()
    fp = F.col("_t").isNull() & F.col("_p").isNotNull()
    fn = F.col("_t").isNotNull() & F.col("_p").isNull()
    per_id = pairs.groupBy(id_col).agg(F.count_if(~tp).alias("_wrong"))
    per_label = pairs.groupBy(label).agg(F.count_if(tp).alias("tp"), F.count_if(fp).alias("fp"),
                                         F.count_if(fn).alias("fn"))
    labels_seen = per_label.agg(F.count(F.lit(1))).scalar() if n_labels is None else F.lit(n_labels)
    n_ids = ids.agg(F.count(F.lit(1))).scalar()
    exact = ids.join(per_id, id_col, "left").agg(
        F.avg((F.coalesce(F.col("_wrong"), F.lit(0)) == 0).cast("double")).alias("subset_accuracy"))
    f1c = F.coalesce(F.try_divide((2 * F.col("tp")).cast("double"),
                                  (2 * F.col("tp") + F.col("fp") + F.col("fn")).cast("double")), F.lit(0.0))
    lab = per_label.agg(
        F.try_divide((2 * F.sum("tp")).cast("double"), (2 * F.sum("tp") + F.sum("fp") + F.sum("fn")).cast("double"))
        .alias("micro_f1"),
        F.avg(f1c).alias("macro_f1"),
        F.try_divide((F.sum("fp") + F.sum("fn")).cast("double"), (n_ids * labels_seen).cast("double"))
        .alias("hamming_loss"))
    # Both sides are single-row aggregates: combine them with scalar subqueries.
    return exact.select("subset_accuracy", *[lab.select(c).scalar().alias(c)
                                             for c in ("hamming_loss", "micro_f1", "macro_f1")])
