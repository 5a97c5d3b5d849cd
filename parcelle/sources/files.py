"""File sources and sinks (S1-S7, S13, S17 helpers).

Raw sale files are read with an explicit all-string schema: inference would
drop leading zeros from codes and guess types per file.  Year-sharded data is
written partitioned by year so that a date-range read prunes whole folders.
Scratch output goes under the cluster's shared checkpoint folder, never a
machine-local temp folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.session import ensure_checkpoint_dir

BOM = "﻿"


def raw_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                   sep: str = "|", header: bool = True) -> DataFrame:
    """Delimited text scan, every column a string.  Undecodable bytes
    become U+FFFD (Spark's UTF-8 decoder), a UTF-8 BOM on the first header is
    dropped."""
    reader = spark.read.option("header", header).option("sep", sep).option("encoding", "UTF-8") \
                       .option("mode", "PERMISSIVE")
    if columns is not None:
        reader = reader.schema(raw_schema(columns))
    else:
        reader = reader.option("inferSchema", False)
    df = reader.csv(path)
    first = df.columns[0] if df.columns else None
    if first and first.startswith(BOM):
        df = df.withColumnRenamed(first, first[len(BOM):])
    return df


def _matches(spark: SparkSession, pattern: str) -> list[str]:
    """Files matching a pattern, greatest name first.  Only names are listed; no data
    goes through the driver."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    statuses = p.getFileSystem(conf).globStatus(p)
    return sorted((s.getPath().toString() for s in statuses or [] if s.isFile()), reverse=True)


def newest_file(spark: SparkSession, patterns: Sequence[str]) -> str | None:
    """The file with the greatest name among the first pattern that
    matches anything (reverse lexical order, fallback patterns after)."""
    return next((names[0] for names in (_matches(spark, p) for p in patterns) if names), None)


def newest_files(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """S4 for deliveries of several files: all files in the folder of ``newest_file``
    that match the same pattern."""
    for pattern in patterns:
        names = _matches(spark, pattern)
        if names:
            folder = names[0].rsplit("/", 1)[0]
            return [n for n in names if n.rsplit("/", 1)[0] == folder]
    return []


def write_by(df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str = "parquet",
             mode: str = "overwrite", **options) -> None:
    """One folder per partition value (e.g. per department or year)."""
    w = df.write.mode(mode).partitionBy(*partition_cols).format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def read_years(spark: SparkSession, path: str, first_year: int, last_year: int, fmt: str = "parquet",
               year_col: str = "annee", **options) -> DataFrame:
    """Read a year-partitioned dataset for a year range; the filter on the
    partition column prunes the folders of other years."""
    r = spark.read.format(fmt)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(path)
    return df.where(F.col(year_col).between(first_year, last_year))


def save_view(df: DataFrame, table: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Materialized view refresh = recompute and overwrite the table
    (``path`` places it in a shared folder as an external table)."""
    w = df.write.mode("overwrite").format(fmt)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(table)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex}"


def save_bucketed(df: DataFrame, table: str, key: str | Sequence[str], buckets: int, path: str | None = None,
                  mode: str = "overwrite") -> None:
    """A table bucketed and sorted on ``key``: later joins on that key (e.g.
    the insert-new anti-join, S8) read it already partitioned and shuffle only
    the other side.  ``path`` makes it an external table in a shared folder."""
    keys = [key] if isinstance(key, str) else list(key)
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(table)
