"""Merge into a partitioned table that is stored as files.

The table is partitioned by a hash bucket of its key, so a key never changes its
partition.  A merge reads and rewrites the buckets that hold incoming keys and no
others, by dynamic partition overwrite: new files are staged, and a bucket's old
ones go when the job commits.  The merged rows are written to the shared scratch
folder first, so the table is never read while it is replaced, and a merge that was
cut short can be run again: with the same input it gives the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions import derive as D
from parcelle.operators import extract as X
from parcelle.operators import link as L
from parcelle.operators.ranks import number_rows
from parcelle.plans.sizing import broadcast_if_small
from parcelle.session import write_once

BUCKETS = 64
#: Column of the partition folders.
BUCKET = "_bucket"
COMMUNE_COLUMNS = ["nom_commune", "code_postal", "departement", "region", "population", "superficie_km2", "latitude", "longitude"]


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def create_table(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Write a table in the layout that ``merge_table`` keeps."""
    df.withColumn(BUCKET, bucket_of(key, buckets)).repartition(F.col(BUCKET)).write.partitionBy(BUCKET).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def replace_partitions(rows: DataFrame, path: str, part: str) -> None:
    """Dynamic overwrite: partitions that ``rows`` holds are replaced, others stay."""
    rows.repartition(F.col(part)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def merge_table(spark: SparkSession, path: str, incoming: DataFrame, key: str, columns: list[str], now: str,
                buckets: int = BUCKETS, finish=None) -> DataFrame:
    """S9 on a stored table: incoming rows replace ``columns`` of the row with their
    key or are added; all other columns and rows stay.

    Returns the rows of the touched buckets with ``row_source`` ('inserted',
    'updated', 'kept'); rows of other buckets are 'kept' and are not read.
    ``updated_at`` is ``now`` on inserted and updated rows, else as it was.  Of
    incoming rows that share a key the greatest in all columns counts; rows without
    a key are left out.  ``finish`` may compute further columns of the merged rows."""
    place = F.max(F.struct(*columns)).alias("_row")
    incoming = incoming.where(F.col(key).isNotNull()).groupBy(key).agg(place).select(key, *[F.col("_row")[c].alias(c) for c in columns])
    incoming = write_once(incoming.withColumn(BUCKET, bucket_of(key, buckets)), "merge-in")
    touched = sorted(r[0] for r in incoming.select(BUCKET).distinct().collect())      # at most ``buckets`` numbers
    target = spark.read.parquet(path)
    schema = target.drop(BUCKET).schema
    stored = target.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = L.upsert(stored, incoming.drop(BUCKET), key, columns, now=F.lit(now).cast("timestamp"))
    merged = finish(merged) if finish else merged
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    merged = write_once(merged.select(*fields, "row_source").withColumn(BUCKET, bucket_of(key, buckets)), "merge-out")
    replace_partitions(merged.drop("row_source"), path, BUCKET)
    return merged.drop(BUCKET)


def refresh_communes(spark: SparkSession, path: str, payloads: DataFrame, now: str, json_col: str = "payload") -> DataFrame:
    """E10 on the stored commune table: flatten the API's answers (S11), merge by
    code, number inserted communes on from the largest id in code order, recompute
    the density (P30).  Returns the touched rows with their ``row_source``."""
    top = read_table(spark, path).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]

    def finish(merged: DataFrame) -> DataFrame:
        new, _ = number_rows(merged.where("row_source = 'inserted'").select("code_commune"), "code_commune", name="_nth")
        new = new.select(F.col("code_commune").alias("_code"), (F.col("_nth") + F.lit(top + 1)).alias("_id"))
        out = merged.join(new, F.col("code_commune") == F.col("_code"), "left").withColumn("id", F.coalesce("id", "_id"))
        area = F.col("superficie_km2") > 0
        density = F.when(F.col("population").isNotNull() & area, D.density("population", "superficie_km2"))
        return out.withColumn("densite_pop", F.coalesce(density, F.col("densite_pop"))).drop("_code", "_id")

    return merge_table(spark, path, X.flatten_communes(payloads, json_col), "code_commune", COMMUNE_COLUMNS, now, finish=finish)


def link_waiting(spark: SparkSession, path: str, communes: DataFrame, part: str = "annee") -> DataFrame:
    """E10's last step on a stored sales table partitioned by ``part``: sales without
    a commune get the one with their code.  Only partitions with a newly linked sale
    are rewritten.  Returns the newly linked rows."""
    sales = spark.read.parquet(path)
    codes = communes.where(F.col("code_commune").isNotNull()).groupBy(F.col("code_commune").alias("_code")).agg(F.min("id").alias("_id"))
    waiting = sales.where(F.col("commune_id").isNull() & F.col("code_commune").isNotNull())
    found = waiting.join(broadcast_if_small(codes), F.col("code_commune") == F.col("_code"))
    found = write_once(found.withColumn("commune_id", F.col("_id").cast(sales.schema["commune_id"].dataType)).select(*sales.columns), "linked")
    touched = [r[0] for r in found.select(part).distinct().collect()]                 # partitions of the table
    if touched:
        rows = sales.where(F.col(part).isin(touched)).join(broadcast_if_small(codes), F.col("code_commune") == F.col("_code"), "left")
        rows = rows.withColumn("commune_id", F.coalesce("commune_id", F.col("_id").cast(sales.schema["commune_id"].dataType))).select(*sales.columns)
        replace_partitions(write_once(rows, "relinked"), path, part)
    return found
