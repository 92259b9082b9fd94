"""Sources and sinks.

Everything here is a thin use of ``spark.read`` / ``df.write``; the value is in
the error messages and in the dataset resolver the dashboards need.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.sources.schemas import RAW_CUSTOMER_COLUMNS, RAW_CUSTOMER_SCHEMA


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str, hint: str = "") -> DataFrame:
    """Read ``<root>/<name>.parquet``; a missing table names the upstream step."""
    path = table_path(root, name)
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "Path does not exist" in str(error):
            message = f"Missing required table: {path}."
            if hint:
                message += f" {hint}"
            raise FileNotFoundError(message) from error
        raise


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Overwrite a Parquet table (S3).  Parents are created by the writer."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_raw_customers(spark: SparkSession, path: str) -> DataFrame:
    """Read the raw customer CSV.

    The header is checked first (V1 needs the real column set; a fixed schema
    alone would hide extra or missing columns), then the file is read with the
    typed raw schema; ``TotalCharges`` stays text so blanks survive.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = sorted(set(RAW_CUSTOMER_COLUMNS) - set(header))
    unexpected = sorted(set(header) - set(RAW_CUSTOMER_COLUMNS))
    if missing or unexpected:
        raise ValueError(
            f"Source schema mismatch. Missing: {missing}; Unexpected: {unexpected}"
        )
    ordered = {f.name: f for f in RAW_CUSTOMER_SCHEMA.fields}
    schema = T.StructType([ordered[name] for name in header])
    return (
        spark.read.option("header", True)
        .option("mode", "FAILFAST")
        # columns by header name, file by file: another order is an error, not a swap
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .schema(schema)
        .csv(path)
    )


def report_frame(spark: SparkSession, report: dict) -> DataFrame:
    """Long-form (key, value_json) frame of a small report dict, keys sorted."""
    rows = [(key, json.dumps(report[key], sort_keys=True)) for key in sorted(report)]
    return spark.createDataFrame(rows, "key string, value string")


def write_json_report(df: DataFrame, path: str) -> str:
    """Write a report DataFrame as JSON lines (S4), one small file."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def save_model(model, path: str) -> str:
    """Persist a fitted Spark ML model or PipelineModel."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Load a PipelineModel saved by :func:`save_model`."""
    from pyspark.ml import PipelineModel

    try:
        return PipelineModel.load(path)
    except Exception as error:  # Spark raises a Py4J / Analysis error
        if not _exists_hint(error):
            raise
        raise FileNotFoundError(
            f"Missing model artifact: {path}. Train the churn model first."
        ) from error


def _exists_hint(error: Exception) -> bool:
    text = str(error)
    return "does not exist" in text or "PATH_NOT_FOUND" in text or "No such file" in text


def resolve_dataset(
    spark: SparkSession,
    roots: Iterable[str],
    required: Sequence[str],
    optional: Sequence[str] = (),
) -> tuple[str, dict[str, DataFrame]]:
    """Use the first root in which every required table loads.

    Returns ``(root, tables)``; optional tables are included only when present.
    Raises ``FileNotFoundError`` naming every root tried.
    """
    tried = []
    for root in roots:
        tables: dict[str, DataFrame] = {}
        try:
            for name in required:
                tables[name] = read_table(spark, root, name)
        except FileNotFoundError:
            tried.append(root)
            continue
        for name in optional:
            try:
                tables[name] = read_table(spark, root, name)
            except FileNotFoundError:
                pass
        return root, tables
    raise FileNotFoundError(
        f"No dataset has all of {list(required)}; tried {tried}"
    )


# Schemes that the workers open themselves, with the name Arrow has for them.
_ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
_CHUNK = 8 << 20


def _sha256_of(uri: str) -> str:
    """SHA-256 of a file, read in chunks of fixed size."""
    from pyarrow import fs

    scheme, rest = uri.split(":", 1)
    place = quote(rest.removeprefix("//"), safe="/:@")
    system, path = fs.FileSystem.from_uri(f"{_ARROW_SCHEMES[scheme]}://{place}")
    digest = hashlib.sha256()
    with system.open_input_stream(path) as stream:
        while chunk := stream.read(_CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def file_fingerprints(spark: SparkSession, path_glob: str) -> DataFrame:
    """One row per file: path, length, SHA-256 of the content.

    Spark lists the files (their content is not read for that) and deals them
    over the tasks; a task streams each of its files through the digest, so its
    memory does not depend on a file's size.  Empty files have no row, as Spark's
    readers leave them out.  In a store that only Spark's
    readers open, a file is one value of at most 2 GB.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path_glob)
    scheme = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme()
    files = spark.read.format("binaryFile").load(path_glob)
    length = F.col("length").cast("bigint").alias("length")
    if scheme not in _ARROW_SCHEMES:
        return files.select("path", length, F.sha2(F.col("content"), 256).alias("sha256"))

    def digests(batches):
        for batch in batches:
            yield batch.assign(sha256=[_sha256_of(p) for p in batch["path"]])

    # a count of partitions: small as the rows are, they must not be put together
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = files.select("path", length).repartition(tasks, "path")
    return listed.mapInPandas(digests, "path string, length long, sha256 string")
