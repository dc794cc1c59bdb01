"""Imbalance techniques: IMB3 IMB4 IMB5 IMB6.

IMB1/IMB2 live in ``balance`` (oversample / undersample), IMB7 is
``model.classifier('rf', weight=...)``, IMB8 is ``metrics.multilabel_metrics``
and IMB9 is ``augment.pseudo_label``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.balance import oversample, undersample
from tessera.operators.common import cut, first_per_key, fits, running_sums, small_side
from tessera.operators.corpus import label_dimension


def hybrid_sample(df: DataFrame, target: int, id_col: str = "id", col: str = "label", seed: int = 42) -> DataFrame:
    """IMB3. Undersample classes above ``target`` (md5 order, exact cap) and
    oversample classes below it (``ceil(target / n_c)`` copies)."""
    capped = undersample(df, target, id_col, col, seed)
    return oversample(capped, col, target)


DEFAULT_THRESHOLDS = [round(0.05 * i, 2) for i in range(1, 20)]


def tune_thresholds(scores: DataFrame, thresholds=None, id_col: str = "id", truth: str = "label",
                    cls: str = "class", score: str = "score") -> DataFrame:
    """IMB4. Per class, the decision threshold with the best F1 (ties to the
    lower threshold) from a long ``(id, truth, class, score)`` table.

    Each score is counted once, under the number of thresholds it reaches
    (``groupBy(class, reached)``, partial aggregation): at most one row per
    class and threshold is left. Counts at a threshold are sums over that small
    table; ``max_by`` picks the best per class.
    """
    cuts = sorted(float(t) for t in (thresholds or DEFAULT_THRESHOLDS))
    pos = F.coalesce(F.col(truth) == F.col(cls), F.lit(False))
    reached = sum((F.coalesce(F.col(score) >= t, F.lit(False)).cast("int") for t in cuts), F.lit(0))
    cells = scores.groupBy(cls, reached.alias("_reached")).agg(
        F.count_if(pos).alias("_p"), F.count_if(~pos).alias("_n"))
    grid = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(t).alias("t")) for i, t in enumerate(cuts)])
    fan = cells.select("*", F.explode(grid).alias("_g")).withColumn("_hit", F.col("_reached") >= F.col("_g.i"))
    agg = fan.groupBy(cls, F.col("_g.t").alias("threshold")).agg(
        F.sum(F.when(F.col("_hit"), F.col("_p")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("_hit"), F.col("_n")).otherwise(0)).alias("fp"),
        F.sum(F.when(~F.col("_hit"), F.col("_p")).otherwise(0)).alias("fn"))
    f1 = F.coalesce(F.try_divide((2 * F.col("tp")).cast("double"),
                                 (2 * F.col("tp") + F.col("fp") + F.col("fn")).cast("double")), F.lit(0.0))
    agg = agg.withColumn("f1", f1)
    best = agg.groupBy(cls).agg(F.max_by(F.struct("threshold", "f1"),
                                         F.struct(F.col("f1"), -F.col("threshold"))).alias("_b"))
    return best.select(cls, F.col("_b.threshold").alias("threshold"), F.col("_b.f1").alias("f1"))


def best_thresholds(scores: DataFrame, id_col: str = "id", truth: str = "label", cls: str = "class",
                    score: str = "score") -> DataFrame:
    """IMB4, exact. Per class, the decision threshold with the best F1 among
    all its distinct scores (a row is positive when its score is at least the
    threshold; ties to the lower one): ``(class, threshold, f1, tp, fp, fn)``.

    Rows are counted per class and score first (partial aggregation), then
    running sums from the highest score down give tp and fp at every score, over
    range partitions, so one class may hold all rows. NULL and NaN scores are
    never positive; a class without a usable score has no row."""
    pos = F.coalesce(F.col(truth) == F.col(cls), F.lit(False))
    usable = F.col(score).isNotNull() & ~F.isnan(F.col(score))
    cells = scores.select(cls, F.when(usable, F.col(score).cast("double") + F.lit(0.0)).alias("threshold"), pos.alias("_pos"))
    cells = cut(cells.groupBy(cls, "threshold").agg(F.count_if("_pos").alias("p"), F.count_if(~F.col("_pos")).alias("n")),
                "score-cells")
    total = cells.groupBy(F.col(cls).alias("_cls")).agg(F.sum("p").alias("_all"))
    run = running_sums(cells.filter("threshold IS NOT NULL"), cls, [F.desc("threshold")], ["p", "n"])
    rows = run.join(small_side(total), F.col(cls).eqNullSafe(F.col("_cls")))
    rows = rows.select(cls, "threshold", F.col("run_p").alias("tp"), F.col("run_n").alias("fp"),
                       (F.col("_all") - F.col("run_p")).alias("fn"))
    f1 = F.coalesce(F.try_divide((2 * F.col("tp")).cast("double"),
                                 (2 * F.col("tp") + F.col("fp") + F.col("fn")).cast("double")), F.lit(0.0))
    rows = rows.withColumn("f1", f1)
    best = rows.groupBy(cls).agg(F.max_by(F.struct("threshold", "f1", "tp", "fp", "fn"),
                                          F.struct(F.col("f1"), -F.col("threshold"))).alias("_b"))
    return best.select(cls, "_b.threshold", "_b.f1", "_b.tp", "_b.fp", "_b.fn")


def label_powerset(df: DataFrame, id_col: str = "id", label: str = "label", sep: str = "|"):
    """IMB5. Multi-label rows ``(id, label)`` -> one multi-class label per id:
    the sorted label set joined by ``sep`` (``''`` for none), encoded as a
    dense integer (WIN3). Returns ``(per_id, dimension)``."""
    sets = df.groupBy(id_col).agg(F.array_join(F.array_sort(F.collect_set(label)), sep).alias("labelset"))
    dim = label_dimension(sets.withColumnRenamed("labelset", "code"), "code", "powerset_label") \
        .withColumnRenamed("code", "labelset")
    return sets.join(small_side(dim), "labelset"), dim


# Words of a dictionary that is broadcast, at most.
DICTIONARY_WORDS = 100_000


def _replace_within(src: DataFrame, known: DataFrame, text: str, key: str, out: str) -> DataFrame:
    """Texts gathered by key and replaced token by token, from a broadcast
    dictionary. A key without a text comes out as NULL."""
    import pyarrow as pa
    spark = src.sparkSession
    words = spark.sparkContext.broadcast({r["_w"]: r["_s"] for r in known.collect()})

    def replaced(texts):
        get = words.value.get
        tokens = [[get(t, t) for t in one.split(" ")] for one in texts]
        if len(tokens) > 1:  # rows that share the key
            tokens = [[t for _, t in sorted(((i, t) for one in tokens for i, t in enumerate(one)),
                                            key=lambda e: (e[0], e[1].encode()))]]
        return " ".join(tokens[0]) if tokens else None

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, SLICE_ROWS):
                part = b.slice(lo, SLICE_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([replaced(t) for t in part.column(1).to_pylist()], pa.string())],
                    names=["_key", "_out"])

    kind = src.schema[key].dataType.simpleString()
    texts = src.groupBy(F.col(key).alias("_key")).agg(F.collect_list(text).alias("_texts"))
    done = texts.mapInArrow(run, f"_key {kind}, _out string")
    return done.select(F.col("_key").alias(key), F.col("_out").alias(out))


# Texts held as Python objects at once.
SLICE_ROWS = 256


def replace_synonyms(df: DataFrame, dictionary: DataFrame, text: str = "text", key: str = "id",
                     word: str = "word", synonym: str = "synonym", order: str | None = None,
                     out: str = "augmented", partitioned: bool = False) -> DataFrame:
    """IMB6. Dictionary synonym replacement over whole texts: split on single
    spaces, replace every token found in the dictionary (first synonym per
    word by ``order``), re-join in token order.

    The texts are hash-partitioned on the row key (one shuffle of the raw text;
    none with ``partitioned=True``, for a ``df`` already partitioned so) and
    rows that share a key are taken together, their tokens in (position, token)
    order. A dictionary of up to ``DICTIONARY_WORDS`` words, measured, is
    broadcast and every token is looked up within its text, so that no token
    becomes a row. Beyond that tokens are exploded with their position,
    looked up by an equi left join and regrouped by the key.
    """
    d = first_per_key(dictionary.select(word, synonym, *([order] if order else [])), word,
                      order or synonym, cols=[synonym])
    d = d.select(F.col(word).alias("_w"), F.col(synonym).alias("_s"))
    src = df.select(key, text) if partitioned else df.select(key, text).repartition(key)
    known = d.filter(F.col("_w").isNotNull() & F.col("_s").isNotNull())
    if fits(known, DICTIONARY_WORDS):
        return _replace_within(src, known, text, key, out)
    # a NULL text keeps one row without a token, and comes out as NULL
    ex = src.select(key, F.posexplode_outer(F.split(F.col(text), " ", -1)).alias("_pos", "_tok"))
    j = ex.join(small_side(d), ex["_tok"] == d["_w"], "left")
    token = F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce("_s", "_tok").alias("_t")))
    agg = j.groupBy(key).agg(F.sort_array(F.collect_list(token)).alias("_toks"))
    # (key, augmented text); the original row is not re-joined here so the
    # full text is never carried through the shuffle twice
    joined = F.array_join(F.transform("_toks", lambda s: s["_t"]), " ")
    return agg.select(key, F.when(F.size("_toks") > 0, joined).alias(out))
