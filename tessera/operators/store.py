"""Incremental corpus build: PRJ3 SET2 FIL6 WIN2 WIN3 over a stored corpus.

A full build decides two things from all rows at once: which short-name rows are
shadowed (their text occurs more than once, WIN2) and the labels (dense ranks of
the codes, WIN3). The store keeps what these decisions need, as tables to which
a batch of accepted rows is added:

* ``rows``: the rows that were visible when they came, without labels; those
  that can be shadowed later lie apart (``short=true``);
* ``counts``: occurrences per text digest, summed over versions;
* ``gone``: digests whose count went from one to more: their short rows left;
* ``codes``: visible rows per code, as changes; the labels rank the codes that
  have any.

Texts' counts only grow, so a row leaves at most once. A batch reads the narrow
count table and, of the rows, only the short ones whose text crossed one; no
earlier text is read, moved or written again. A version counts when its entry in
``versions`` is written, last; a repeated append of a version replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.common import checked_side, cut, with_row_id
from tessera.operators.corpus import SHORT, accepted, drop_incomplete, with_chapter

SCHEMAS = {
    "rows": "code string, text string, origin string, chapter string, digest string, version int, short boolean",
    "counts": "digest string, n long, version int",
    "gone": "digest string, version int",
    "codes": "code string, n long, version int",
}


def text_digest(text: str = "text"):
    """SHA-256 of a text; NULL has a digest of its own."""
    return F.sha2(F.coalesce(F.concat(F.lit("="), F.col(text)), F.lit("")), 256)


class CorpusStore:
    """A corpus under a folder of shared storage."""

    def __init__(self, spark: SparkSession, path: str, origins=(SHORT,)):
        self.spark, self.path, self.origins = spark, path.rstrip("/"), list(origins)

    def version(self) -> int:
        """The last complete version, -1 for an empty store."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions")
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return max((int(n) for n in names if n.isdigit()), default=-1)

    def _commit(self, version: int) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{version}")
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()

    def table(self, name: str, before: int) -> DataFrame:
        """The rows of a table that versions below ``before`` wrote."""
        read = self.spark.read.schema(SCHEMAS[name]).option("basePath", f"{self.path}/{name}")
        if not before:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return read.parquet(*[f"{self.path}/{name}/version={v}" for v in range(before)])

    def _write(self, df: DataFrame, name: str, version: int, *by: str) -> None:
        w = df.write.mode("overwrite")
        (w.partitionBy(*by) if by else w).parquet(f"{self.path}/{name}/version={version}")

    def append(self, rows: DataFrame) -> int:
        """Add ``(code, text, origin)`` rows as the next version and return its
        number. NULL texts equal each other; incomplete rows shadow like any
        row and are then dropped; an empty batch is a version without rows."""
        v = self.version() + 1
        short = F.coalesce(F.col("origin").isin(self.origins), F.lit(False))
        new = cut(rows.select("code", "text", "origin").withColumn("digest", text_digest()).withColumn("short", short),
                  "store-batch")
        fresh = new.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
        fresh = cut(fresh, "store-fresh")
        known = self.table("counts", v).join(checked_side(fresh.select("digest")), "digest", "left_semi")
        known = known.groupBy("digest").agg(F.sum("n").alias("before"))
        change = fresh.join(known, "digest", "left").withColumn("before", F.coalesce("before", F.lit(0)))
        change = cut(change, "store-change")
        gone = change.filter((F.col("before") == 1)).select("digest")
        hidden = change.filter(F.col("before") + F.col("n") > 1).select("digest")
        shadowed = new.filter("short").join(checked_side(hidden), "digest", "left_anti").select(*new.columns)
        kept = drop_incomplete(with_chapter(new.filter("NOT short").unionByName(shadowed)))
        self._write(kept.select("code", "text", "origin", "chapter", "digest", "short"), "rows", v, "short")
        self._write(fresh.select("digest", "n"), "counts", v)
        self._write(gone, "gone", v)
        left = self.table("rows", v).filter("short").select("code", "digest").join(
            checked_side(gone), "digest", "left_semi")
        added = self.spark.read.schema("code string").parquet(f"{self.path}/rows/version={v}")
        self._write(added.groupBy("code").agg(F.count(F.lit(1)).alias("n")).unionByName(
            left.groupBy("code").agg((-F.count(F.lit(1))).alias("n"))), "codes", v)
        self._commit(v)
        return v

    def append_accepted(self, augmentation: DataFrame) -> int:
        """:meth:`append` of the accepted rows of an augmentation batch."""
        return self.append(accepted(augmentation).select("code", "text", "origin"))

    def labels(self) -> DataFrame:
        """``(code, label)``: dense ranks, in code-point order, of the codes
        that have a visible row."""
        n = self.table("codes", self.version() + 1).groupBy("code").agg(F.sum("n").alias("n"))
        return with_row_id(n.filter("n > 0").select("code"), ["code"], "label").withColumn("label", F.col("label").cast("int"))

    def corpus(self) -> DataFrame:
        """``code, text, origin, chapter, label``: what a full build of all
        versions' rows gives."""
        v = self.version() + 1
        rows, gone = self.table("rows", v), self.table("gone", v).select("digest").distinct()
        left = rows.filter("short").join(gone, "digest", "left_anti").select(*rows.columns)
        rows = rows.filter("NOT short").unionByName(left)
        return rows.join(checked_side(self.labels()), "code").select("code", "text", "origin", "chapter", "label")
