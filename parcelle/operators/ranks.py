"""Exact row numbers and running totals over a table of any size.

Rows are range-partitioned and sorted by a total order of their content and written
once; a count per partition gives offsets, and a row's number is its partition's
offset plus its place in it.  All in 64-bit integers, no window over the table, and
no key, however common, ends in one task: rows equal in the whole order are told
apart by their place in the written input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelle.session import write_once


def number_rows(df: DataFrame, *order: str, name: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with ``name`` = 0, 1, ... in the order of the columns ``order`` (nulls
    first), ties by the content of all columns; and the number of rows."""
    spark = df.sparkSession
    kept = write_once(df.withColumns({"_n_hash": F.xxhash64(*df.columns), "_n_place": F.monotonically_increasing_id()}), "number-in")
    keys = [*order, "_n_hash", "_n_place"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = kept.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_n_hash", "_n_place")
    ranged = write_once(ranged.withColumn("_n_spot", F.monotonically_increasing_id()), "number-sorted")
    part = F.shiftright("_n_spot", 33)            # partition << 33 | place in it
    sizes = ranged.groupBy(part.alias("_n_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_n_part").rowsBetween(Window.unboundedPreceding, -1))   # a row a partition
    offsets = write_once(sizes.withColumn("_n_before", F.coalesce(before, F.lit(0))), "number-offsets")
    total = offsets.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    spot = F.col("_n_spot").bitwiseAND(F.lit((1 << 33) - 1))
    out = ranged.join(F.broadcast(offsets), part == F.col("_n_part"))
    return out.withColumn(name, (F.col("_n_before") + spot).cast("long")).select(*df.columns, name), int(total)


def running_totals(df: DataFrame, key: str, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name`` = the sum of ``value`` over the key's rows before this one
    in the order of the columns ``order`` (nulls first), 0 for the first.  ``key`` and
    ``order`` together are unique.

    Rows are range-partitioned by (key, order) and written once, so that a key of any
    size lies in neighbouring partitions and is summed by many tasks.  Only the first
    and the last key of a partition can go on in another: two sums a partition, carried
    from one to the next, are all that is broadcast."""
    ranged = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    ranged = write_once(ranged.withColumn("_t_spot", F.monotonically_increasing_id()), "totals-sorted")
    ranged = ranged.withColumn("_t_part", F.shiftright("_t_spot", 33))
    ends = ranged.groupBy("_t_part").agg(F.min(key).alias("_t_low"), F.max(key).alias("_t_high"))
    at_end = ranged.join(F.broadcast(ends), "_t_part").where(F.col(key).eqNullSafe(F.col("_t_low")) | F.col(key).eqNullSafe(F.col("_t_high")))
    sums = at_end.groupBy(F.col(key).alias("_t_key"), F.col("_t_part").alias("_t_in")).agg(F.sum(value).alias("_t_sum"))
    earlier = Window.partitionBy("_t_key").orderBy("_t_in").rowsBetween(Window.unboundedPreceding, -1)     # two rows a partition
    carry = sums.select("_t_key", "_t_in", F.sum("_t_sum").over(earlier).alias("_t_carry")).where("_t_carry IS NOT NULL")
    inside = Window.partitionBy("_t_part", key).orderBy("_t_spot").rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumn("_t_own", F.sum(value).over(inside))
    out = out.join(F.broadcast(carry), (F.col("_t_part") == F.col("_t_in")) & F.col(key).eqNullSafe(F.col("_t_key")), "left")
    total = F.coalesce("_t_own", F.lit(0)) + F.coalesce("_t_carry", F.lit(0))
    return out.withColumn(name, total.cast("long")).select(*df.columns, name)
