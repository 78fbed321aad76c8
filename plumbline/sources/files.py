"""Table files: load, save, layout and reuse."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Options of csv files.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quote": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
ROWS_PER_PARTITION = 10_000
MAX_PARTITIONS = 200


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Csv with header row. A schema saves the extra pass that inference needs."""
    reader = spark.read.option("header", "true")
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    return reader.schema(schema).csv(path)


def load_table(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: Any,
) -> DataFrame:
    """Load any format; csv gets the usual options and infers only without schema."""
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    if format == "csv":
        infer = {"inferSchema": "false" if schema is not None else "true"}
        options = {**CSV_OPTIONS, **infer, **options}
    return reader.options(**options).load(path)


def save_table(
    df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite", **options: Any
) -> None:
    """Save any format with mode overwrite, append, ignore or error."""
    defaults: dict[str, Any] = {}
    if format == "csv":
        defaults = CSV_OPTIONS
    elif format == "parquet":
        defaults = {"compression": "snappy"}
    df.write.format(format).mode(mode).options(**{**defaults, **options}).save(path)


def partition_target(n_rows: int, per_partition: int = ROWS_PER_PARTITION, most: int = MAX_PARTITIONS) -> int:
    """Partitions for a table: one per ``per_partition`` rows, between 1 and ``most``."""
    return max(1, min(most, n_rows // per_partition))


def write_split(
    df: DataFrame,
    path: str,
    split_column: str = "split",
    rows_per_file: int | None = None,
    mode: str = "overwrite",
) -> None:
    """One parquet dataset with a folder per split; reading one split prunes the other.

    Rows stay where they are, so the write needs no shuffle; ``rows_per_file``
    bounds the file size.
    """
    writer = df.write.mode(mode).partitionBy(split_column)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Has a committed job left its success marker at the path?"""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def publish(spark: SparkSession, staged: str, path: str) -> bool:
    """Moves a finished folder to its place in one step; false if another one is there already.

    What an interrupted job without success marker left at the place is removed.
    The store must rename folders atomically, as distributed file systems do.
    """
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs
    source, target = fs.Path(staged), fs.Path(path.rstrip("/"))
    conf = spark._jsc.hadoopConfiguration()
    store = target.getFileSystem(conf)
    if store.exists(target) and not is_complete(spark, path):
        store.delete(target, True)
    store.mkdirs(target.getParent())
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        fs.FileContext.getFileContext(store.getUri(), conf).rename(store.makeQualified(source), store.makeQualified(target), options)
        return True
    except Py4JJavaError:
        if not is_complete(spark, path):
            raise
        store.delete(source, True)
        return False


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame], *partition_by: str) -> DataFrame:
    """Read the table at ``path`` when complete, else build and write it first.

    Put a fingerprint of the settings into the path, so changed settings build
    anew. The table is written beside its place and then moved there, so nobody
    reads half of it; of several builds at once the first to finish stays and
    the others read it.
    """
    if not is_complete(spark, path):
        staged = f"{path.rstrip('/')}.building-{uuid.uuid4().hex}"
        build().write.partitionBy(*partition_by).parquet(staged)
        publish(spark, staged, path)
    return spark.read.parquet(path)


def save_sized(df: DataFrame, path: str, per_partition: int = ROWS_PER_PARTITION, most: int = MAX_PARTITIONS) -> int:
    """Save as parquet in as many files as :func:`partition_target` says for the number of rows; returns that number."""
    files = partition_target(df.count(), per_partition, most)
    save_table(df.repartition(files), path)
    return files


def with_partition_rows(df: DataFrame) -> DataFrame:
    """Rows per input partition, to judge the layout of a table."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def input_version(df: DataFrame) -> str | None:
    """Short digest of the files a frame reads, with sizes and times; none if it reads no files."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    known = []
    for name in sorted(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        known.append(f"{name}|{status.getLen()}|{status.getModificationTime()}")
    return hashlib.md5("\n".join(known).encode()).hexdigest()[:12] if known else None
