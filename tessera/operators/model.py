"""Corpus-to-model operators as Spark ML jobs: MLD4-MLD9.

The reference fine-tunes a transformer on one GPU; here the same contract
(text in, n-way label, top-k codes out) is a distributed Spark ML pipeline.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import topk_array
from tessera.operators.common import cut
from tessera.operators.topk import attach_prediction_labels

NUM_FEATURES = 1 << 16


def featurize(text: str = "text", max_tokens: int | None = None, num_features: int = NUM_FEATURES):
    """MLD4. Stages: tokenise (lower-case, split on non-word), hashed term
    frequencies, IDF. Every token of the whole text counts; ``max_tokens``
    (the reference's transformer input limit was 512) truncates only when a
    caller asks for it."""
    tokens = "_tokens" if max_tokens is None else "_tokens_all"
    stages = [RegexTokenizer(inputCol=text, outputCol=tokens, pattern=r"(?U)\W+", toLowercase=True)]
    if max_tokens is not None:
        stages.append(SQLTransformer(
            statement=f"SELECT *, slice(_tokens_all, 1, {int(max_tokens)}) AS _tokens FROM __THIS__"))
    return stages + [
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="features"),
    ]


def weigh(num_features: int = NUM_FEATURES):
    """MLD4, second half: the stages from a table of :func:`term_frequencies` on."""
    return [IDF(inputCol=f"_tf{num_features}", outputCol="features")]


def classifier(kind: str = "nb", label: str = "label", weight: str | None = None, **params):
    """``nb`` multinomial naive Bayes (default), ``lr`` multinomial logistic
    regression, ``rf`` random forest over sparse rows (IMB7 with ``weight``),
    ``rf_dense`` Spark's own, for few columns, ``ovr`` one-vs-rest logistic
    regression (IMB5 binary relevance)."""
    if kind == "lr":
        est = LogisticRegression(labelCol=label, featuresCol="features", family="multinomial", **params)
    elif kind == "rf":
        from tessera.operators.forest import SparseForest
        est = SparseForest(labelCol=label, featuresCol="features", seed=42, **params)
    elif kind == "rf_dense":
        from pyspark.ml.classification import RandomForestClassifier
        est = RandomForestClassifier(labelCol=label, featuresCol="features", seed=42, **params)
    elif kind == "ovr":
        from pyspark.ml.classification import OneVsRest
        base = LogisticRegression(featuresCol="features", maxIter=20)
        if weight:
            base.setWeightCol(weight)
        return OneVsRest(classifier=base, labelCol=label, featuresCol="features", **params)
    else:
        est = NaiveBayes(labelCol=label, featuresCol="features", modelType="multinomial", **params)
    if weight:
        est.setWeightCol(weight)
    return est


def train_classifier(df: DataFrame, label: str = "label", text: str = "text", kind: str = "nb",
                     weight: str | None = None, counted: bool = False, **params) -> PipelineModel:
    """MLD5. Fit featurisation + multinomial classifier (optionally weighted
    by AGG6 class weights). ``counted``: ``df`` is a table of
    :func:`term_frequencies`, so that texts are not cut into words again for
    each pass of the fit and of what follows."""
    pipe = Pipeline(stages=(weigh() if counted else featurize(text)) + [classifier(kind, label, weight, **params)])
    return pipe.fit(df)


def score(model: PipelineModel, df: DataFrame, k: int = 5, text: str = "text", labels: DataFrame | None = None,
          model_name: str = "model") -> DataFrame:
    """MLD6. Batch scoring to ``(input, model, prediction)`` where prediction
    is ``array<struct<rank, label, [code, text,] value>>`` of the ``k`` most
    probable classes (already softmax-normalised by the model)."""
    scored = model.transform(df.select(F.col(text).alias("input")).withColumnRenamed("input", text))
    out = scored.select(F.col(text).alias("input"), F.lit(model_name).alias("model"),
                        topk_array(vector_to_array("probability"), k, apply_softmax=False).alias("prediction"))
    if labels is not None:
        out = attach_prediction_labels(out, labels)
    return out


def evaluate(model: PipelineModel, df: DataFrame, label: str = "label", split: str | None = "test",
             split_col: str = "split") -> DataFrame:
    """MLD9. Accuracy and macro F1 on ``split`` (``None`` = all rows, the
    reference's leaky full-set number). Each row is predicted once: the pairs of
    label and prediction are written, and the report reads them twice."""
    from tessera.operators.metrics import classification_report
    part = df if split is None else df.filter(F.col(split_col) == split)
    pred = model.transform(part).select(F.col(label).cast("int").alias("label"),
                                        F.col("prediction").cast("int").alias("prediction"))
    return classification_report(cut(pred, "predictions"), "label", "prediction")


def term_frequencies(df: DataFrame, num_features, text: str = "text", keep=("label",)) -> DataFrame:
    """``keep`` and one column ``_tf<n>`` of hashed term frequencies per width:
    texts are read and cut into words once, and the table is written."""
    tokens, *_ = featurize(text)
    rows = tokens.transform(df.withColumn(text, F.coalesce(F.col(text), F.lit(""))))
    for n in num_features:
        rows = HashingTF(inputCol="_tokens", outputCol=f"_tf{n}", numFeatures=n).transform(rows)
    return cut(rows.select(*keep, *[f"_tf{n}" for n in num_features]), "term-frequencies")


def cross_validate(df: DataFrame, fold: str = "fold", label: str = "label", text: str = "text",
                   kind: str = "nb", parallelism: int = 2) -> DataFrame:
    """MLD7. k-fold evaluation with a precomputed fold column (MLD3, folds 0 to
    k - 1); one row per candidate with its mean accuracy over folds, none for a
    table without a fold. Texts are cut into words once: the folds share a
    written table of term frequencies (:func:`bayes.cross_validate_words` needs
    no refits either, for naive Bayes on words)."""
    spark = df.sparkSession
    df = df.withColumn(fold, F.col(fold).cast("int"))
    last = df.agg(F.max(fold)).first()[0]
    if last is None:
        return spark.createDataFrame([], "cv_accuracy double, cv_std double")
    k = last + 1
    df = term_frequencies(df, [NUM_FEATURES], text, [label, fold])
    pipe = Pipeline(stages=weigh() + [classifier(kind, label)])
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=[{}], evaluator=ev, foldCol=fold,
                        numFolds=k, parallelism=parallelism)
    m = cv.fit(df)
    return spark.createDataFrame([(float(a), float(s)) for a, s in zip(m.avgMetrics, m.stdMetrics)],
                                 "cv_accuracy double, cv_std double")


def grid_search(df: DataFrame, label: str = "label", text: str = "text", id_col: str = "doc_id",
                smoothing=(0.5, 1.0), num_features=(1 << 12, 1 << 16), test_frac: float = 0.2, seed: int = 42,
                n_candidates: int | None = None, parallelism: int = 2) -> DataFrame:
    """MLD8. Hyper-parameter search with one train/validation split by
    ``md5(id:seed)`` (MLD2: the same rows however the table is stored), the
    candidates fitted in parallel from one written table of term frequencies
    (texts are cut into words once); one row per candidate. ``n_candidates``
    draws that many points of the grid, by the same seed."""
    import random

    from tessera.operators.split import random_split
    grid = [(float(a), int(n)) for a in smoothing for n in num_features]
    if n_candidates is not None and n_candidates < len(grid):
        grid = [grid[i] for i in sorted(random.Random(seed).sample(range(len(grid)), n_candidates))]
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    split = random_split(df, id_col, test_frac, seed, "_split")
    rows = term_frequencies(split, sorted({n for _, n in grid}), text, [label, "_split"])
    train, test = rows.filter("_split = 'train'"), rows.filter("_split = 'test'")

    def one(candidate):
        a, n = candidate
        pipe = Pipeline(stages=[IDF(inputCol=f"_tf{n}", outputCol="features"), classifier("nb", label, smoothing=a)])
        return float(ev.evaluate(pipe.fit(train).transform(test)))

    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        metrics = list(pool.map(one, grid))
    rows = [(a, n, metric) for (a, n), metric in zip(grid, metrics)]
    return df.sparkSession.createDataFrame(rows, "smoothing double, num_features int, accuracy double")


def pr_auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """IMB8. Area under the precision-recall curve of ``(score, 0/1 label)``
    rows, over all distinct scores (Spark ML's distributed evaluator)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, metricName="areaUnderPR", numBins=0)
    rows = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        F.col(score).cast("double").alias(score), F.col(label).cast("double").alias(label))
    return scored.sparkSession.createDataFrame([(float(ev.evaluate(rows)),)], "pr_auc double")


def score_with(df: DataFrame, score_fn, num_classes: int, k: int = 5, text: str = "text",
               apply_softmax: bool = True, labels: DataFrame | None = None, model_name: str = "model") -> DataFrame:
    """MLD6 hook for foreign models (e.g. an ONNX or transformer scorer):
    ``score_fn(texts: pandas.Series) -> numpy array (n, num_classes)`` of
    logits or probabilities runs inside tasks on Arrow batches
    (``mapInPandas``); the top-k selection, softmax and label lookup stay in
    the JVM. The model is loaded by ``score_fn`` once per Python worker (cache
    it in a closure or module global), never collected to the driver. Rows per
    call follow the session's ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    import numpy as np
    import pandas as pd

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            scores = np.asarray(score_fn(pdf[text]), dtype=np.float64)
            if scores.shape != (len(pdf), num_classes):
                raise ValueError(f"score_fn returned {scores.shape}, expected ({len(pdf)}, {num_classes})")
            yield pd.DataFrame({"input": pdf[text].to_numpy(), "scores": list(scores)})

    raw = df.select(text).mapInPandas(run, "input string, scores array<double>")
    out = raw.select("input", F.lit(model_name).alias("model"),
                     topk_array("scores", k, apply_softmax).alias("prediction"))
    if labels is not None:
        out = attach_prediction_labels(out, labels)
    return out
