"""Sources and sinks: SRC1-SRC4, SNK1-SNK5.

Explicit schemas everywhere (no ``inferSchema``). Paths are whatever the
cluster uses (shared storage); nothing is staged on a machine-local folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
CORPUS_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("code", S), ("text", S), ("origin", S), ("chapter", S), ("label", T.IntegerType()))])
AUGMENTATION_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("code", S), ("text", S), ("origin", S), ("include", T.BooleanType()), ("context", S), ("prompt", S))])
RUN_METRICS_SCHEMA = T.StructType([T.StructField("model_version", S)] + [
    T.StructField(n, T.DoubleType()) for n in ("accuracy", "f1_score", "precision", "recall")])


# The same on both sides: quotes doubled inside quoted fields, blanks kept,
# NULL as an empty field and the empty string as "".
CSV_OPTIONS = {"header": "true", "encoding": "UTF-8", "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "nullValue": ""}
EMPTY = "\u0001"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str | None = None,
               multi_line: bool = False) -> DataFrame:
    """SRC1. CSV (header, UTF-8, quoted fields) or Parquet by extension; CSV
    always with an explicit schema. Fields that hold line breaks need
    ``multi_line``, which reads each file in one task; without it large files
    are split."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        r = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).option("emptyValue", EMPTY)
        df = r.schema(schema).csv(path) if schema is not None else r.csv(path)
        # the reader takes an empty value equal to nullValue for NULL, so ""
        # is read as a control character and set back
        return df.withColumns({f.name: F.when(F.col(f.name) == EMPTY, "").otherwise(F.col(f.name))
                               for f in df.schema.fields if f.dataType == S})
    return spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)


def materialize(spark: SparkSession, build, path: str, force: bool = False) -> DataFrame:
    """SRC2. Load-or-build cache: reuse the Parquet at ``path`` if it can be
    read, else build (``build()`` returns a DataFrame), write and read back.
    Writing a table also cuts lineage for whatever comes after."""
    from pyspark.errors import AnalysisException
    if not force:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_runs(spark: SparkSession, root: str, name: str = "results", fmt: str = "parquet",
              schema: T.StructType | None = None) -> DataFrame:
    """SRC3. Every run's result table, ``root/<run_id>/<name>`` (a folder of
    part files) or ``root/<run_id>/<name>.csv`` (one file), tagged with
    ``run_id``: the path segment that follows ``root``."""
    root = root.rstrip("/")
    path = f"{root}/*/{name}*"
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    base = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(base).toUri().getRawPath()
    df = read_table(spark, path, schema, fmt)
    inside = F.substring_index(F.col("_metadata.file_path"), base + "/", -1)
    return df.withColumn("run_id", F.url_decode(F.replace(F.split_part(inside, F.lit("/"), F.lit(1)),
                                                          F.lit("+"), F.lit("%2B"))))


def load_corpus(spark: SparkSession, path: str, size: str = "full", medium_chapters=("K",)) -> DataFrame:
    """SRC4. Named corpus with a size selector (``medium`` = chapter K, or
    ``medium_chapters``)."""
    from tessera.operators.audit import subset
    df = spark.read.schema(CORPUS_SCHEMA).parquet(path)
    return subset(df, size, medium_chapters)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK1. CSV with header, no index column; :func:`read_table` gets the
    same values back (quotes, commas, blanks, empty or NULL strings)."""
    df.write.mode(mode).options(**CSV_OPTIONS | {"emptyValue": '""'}).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK2. JSON lines, non-ASCII characters kept as is."""
    df.write.mode(mode).json(path)


def write_corpus(corpus: DataFrame, labels: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK3. Typed corpus partitioned by chapter (17 values: prunable) plus
    its label dictionary ``(code, label, ...)`` as a side table, so readers
    get the class names with a join instead of through the driver."""
    corpus.select(*[F.col(f.name).cast(f.dataType) for f in CORPUS_SCHEMA.fields]) \
        .write.mode(mode).partitionBy("chapter").parquet(f"{path}/corpus")
    labels.write.mode(mode).parquet(f"{path}/labels")


def write_run(results: DataFrame, metrics: DataFrame, root: str, run_id) -> None:
    """SNK4. Results and metrics of a run under ``root``, partitioned by
    ``run_id`` (``<timestamp>_<model>``). A run's partition is replaced as a
    whole, other runs stay: a retried write never doubles rows."""
    rid = F.lit(run_id) if isinstance(run_id, str) else run_id
    for df, name in ((results, "results"), (metrics, "metrics")):
        df.withColumn("run_id", rid).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("run_id").parquet(f"{root}/{name}")


def run_id(model_version, ts=None):
    """``<yyyy-MM-dd_HH-mm-ss>_<last path segment of the model>``."""
    from tessera.functions.text import short_name
    t = F.current_timestamp() if ts is None else ts
    return F.concat(F.date_format(t, "yyyy-MM-dd_HH-mm-ss"), F.lit("_"), short_name(model_version))


def append_log(records: DataFrame, path: str) -> None:
    """SNK5. Append generation records (date, code, context, prompt, origin,
    text) to the log table. A failed write leaves no row, but a caller that
    repeats an append after it succeeded doubles its rows: merge by SET3
    (``merge_augmentation``) where that matters."""
    records.write.mode("append").parquet(path)
