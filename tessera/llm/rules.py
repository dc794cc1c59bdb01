"""Quality rules with risk-controlled cutoffs.

A document's counts give a few ratios. For each stratum (language) and rule, a
fixed ladder of cutoffs is tested from lenient to strict on labelled documents
of good quality: a cutoff passes if the exact binomial test rejects "this rule
rejects more than ``max_risk`` / rules of the good documents" at level
``error`` / (strata x rules). Testing stops at the first cutoff that does not
pass (fixed-sequence testing needs no correction within a ladder; Bonferroni
covers ladders and strata), and the strictest that passed is used. So with
probability 1 - ``error``, in every stratum at once, all rules together reject
at most ``max_risk`` of the good documents. A stratum with too few labels
passes no cutoff and keeps its documents. Rules are then taken in order, and one
is used only if, of the labelled documents that the rules before it leave, it
rejects a larger share of the bad than of the good ones: a rule that finds
nothing more would only cost good documents. (Dropping rules can't raise the
number of rejected documents, so the guarantee stands.)
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, map_batches, with_slices

MAX_RISK = 0.02
ERROR = 0.05
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = "#*$%&|<>"
NO_STRATUM = "\u0000"

# name, numerator, denominator, whether large values are bad, cutoffs from
# lenient to strict. A document fails at cutoff c if numerator > c * denominator
# (large bad) or numerator < c * denominator.
RULES: list[tuple[str, str, str, bool, list[Fraction]]] = [
    ("symbols", "n_symbols", "n_words", True,
     [Fraction(x) for x in ("2", "1", "1/2", "3/10", "1/5", "1/10")]),
    ("dup_lines", "n_dup_lines", "n_lines", True,
     [Fraction(x) for x in ("9/10", "3/4", "3/5", "1/2", "2/5", "3/10", "1/5")]),
    ("repeats", "n_repeat_words", "n_words", True,
     [Fraction(x) for x in ("2/5", "3/10", "1/4", "1/5")]),
    ("long_words", "word_chars", "n_words", True, [Fraction(x) for x in ("30", "20", "15", "12", "10")]),
    ("short_words", "word_chars", "n_words", False, [Fraction(x) for x in ("1", "3/2", "2", "5/2", "3")]),
]
FEATURES = COUNTS + ["n_lines"]


def text_counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    """``FEATURES`` of one whole text (null: no words). ``bytes.split`` cuts
    at exactly the white space of ``[\\x20\\x09-\\x0D]``."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()
    symbols = len(raw) - len(raw.translate(None, SYMBOLS.encode()))
    chars = len(b"".join(words).decode())
    seen, dups, lines = set(), 0, 0
    if b"\n" in raw:
        for line in raw.split(b"\n"):
            if line and not line.isspace():
                lines += 1
                if line in seen:
                    dups += 1
                else:
                    seen.add(line)
    elif words:
        lines = 1
    return len(words), chars, symbols, dups, _repeated(words), lines


def _repeated(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    first: dict[tuple, int] = {}
    again = []
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        j = first.setdefault(w, i)
        if j != i:
            again.append(i)
            again.append(j)
    if not again:
        return 0
    at = np.array(again)
    hit = np.zeros(n, bool)
    hit[at] = True
    hit[at + 1] = True
    hit[at + 2] = True
    return int(hit.sum())


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: str | None = "lang") -> DataFrame:
    """``(id, stratum, FEATURES...)`` of each row; one pass, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    part = F.coalesce(F.col(stratum).cast("string"), F.lit(NO_STRATUM)) if stratum else F.lit(NO_STRATUM)

    def run(batches):
        for b in with_slices(batches):
            cols = list(zip(*map(text_counts, b.column(2).to_pylist()))) or [()] * len(FEATURES)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1)] + [pa.array(c, pa.int64()) for c in cols],
                names=[id_col, "stratum"] + FEATURES)

    schema = f"`{id_col}` {kind}, stratum string, " + ", ".join(f"{c} long" for c in FEATURES)
    return docs.select(F.col(id_col), part.alias("stratum"), F.col(text_col)).mapInArrow(run, schema)


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fails(rule: tuple, cutoff: Fraction):
    _, num, den, large, _ = rule
    a, b = F.col(num) * cutoff.denominator, F.col(den) * cutoff.numerator
    return (F.col(den) > 0) & ((a > b) if large else (a < b))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed in log space."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
            + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def certified(k: int, n: int, risk: float, error: float) -> bool:
    """Whether k rejections among n good documents show that the rejection
    probability is at most ``risk``, at level ``error``."""
    if n == 0 or k >= risk * n:
        return False
    return binomial_tail(k, n, risk) <= error


def calibrate(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
              max_risk: float = MAX_RISK, error: float = ERROR) -> dict[str, dict[str, Fraction]]:
    """Chosen cutoffs by stratum and rule.

    The holdout is every labelled document that passes the base rule;
    nothing else is fitted on it. Repeated labels of an id count once (bad if
    any says so), null labels don't count. Counts are aggregated in Spark: one
    row per stratum reaches the driver, and only of strata large enough to
    certify anything.
    """
    marks = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(
        (F.min(label_col) == 1).alias("_good"))
    risk = max_risk / len(RULES)
    held = cut(feats.filter(~base_failed()).join(marks, id_col).select("stratum", "_good", *FEATURES), "holdout")
    least = math.ceil(math.log(error / len(RULES)) / math.log1p(-risk))
    good = F.col("_good")
    cells = [F.count_if(fails(r, c) & good).alias(f"{r[0]}_{i}") for r in RULES for i, c in enumerate(r[4])]
    rows = held.groupBy("stratum").agg(F.count_if(good).alias("n"), *cells).filter(F.col("n") >= least).collect()
    level = error / (max(1, len(rows)) * len(RULES))
    out: dict[str, dict[str, Fraction]] = {}
    for r in RULES:
        passed = {}
        for row in rows:
            for i, c in enumerate(r[4]):
                if not certified(row[f"{r[0]}_{i}"], row["n"], risk, level):
                    break
                passed[row["stratum"]] = {r[0]: c}
        hit = rejected(passed)
        left = held.filter(~rejected(out)).groupBy("stratum").agg(
            F.count_if(good).alias("n"), F.count_if(~good).alias("n_bad"),
            F.count_if(good & hit).alias("k"), F.count_if(~good & hit).alias("k_bad"))
        for row in left.filter(F.col("k_bad") * F.col("n") > F.col("k") * F.col("n_bad")).collect() if passed else ():
            out.setdefault(row["stratum"], {}).update(passed[row["stratum"]])
    return out


def rejected(cutoffs: dict[str, dict[str, Fraction]]):
    """Column: some chosen cutoff rejects the row. Cutoffs are literals, so
    there is no join."""
    bad = F.lit(False)
    for stratum, chosen in sorted(cutoffs.items()):
        hit = F.lit(False)
        for r in RULES:
            if r[0] in chosen:
                hit = hit | fails(r, chosen[r[0]])
        bad = bad | ((F.col("stratum") == stratum) & hit)
    return bad


def verdict(cutoffs: dict[str, dict[str, Fraction]]):
    """Column: kept."""
    return ~base_failed() & ~rejected(cutoffs)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum: str | None = "lang") -> DataFrame:
    """Per row: id, stratum, the counts, ``base_failed``, ``kept``.

    Null and empty texts have no words and fail the base rule. Repeated rows
    and null ids are judged like any row. Only the three named columns are
    read, so others can't clash; without labels only the base rule decides; an
    empty table gives no row. The counts are written once (no text among them)
    and used for calibration and result.
    """
    feats = cut(features(docs, id_col, text_col, stratum), "features")
    kept = verdict(calibrate(feats, labels, id_col))
    return feats.withColumn("base_failed", base_failed()).withColumn("kept", kept)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` (all their columns) that :func:`judge` keeps: the
    cutoffs are chosen in one pass, and a second pass filters in place, so no
    text is shuffled."""
    cutoffs = calibrate(cut(features(docs, id_col, text_col, stratum), "features"), labels, id_col)
    names = docs.columns
    text_at, part_at = names.index(text_col), names.index(stratum)
    chosen = {s: [(r[1], r[2], r[3], c[r[0]].numerator, c[r[0]].denominator) for r in RULES if r[0] in c]
              for s, c in cutoffs.items()}

    def run(batches):
        for b in with_slices(batches):
            keep = []
            for text, s in zip(b.column(text_at).to_pylist(), b.column(part_at).to_pylist()):
                f = dict(zip(FEATURES, text_counts(text)))
                ok = f["n_words"] >= 50 and 100 * f["n_repeat_words"] <= 50 * f["n_words"]
                if ok:
                    for num, den, large, p, q in chosen.get(NO_STRATUM if s is None else str(s), ()):
                        a, c = f[num] * q, f[den] * p
                        if f[den] > 0 and (a > c if large else a < c):
                            ok = False
                            break
                keep.append(ok)
            yield b.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, run)
