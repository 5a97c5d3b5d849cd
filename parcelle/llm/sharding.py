"""Sharding by a Feistel permutation over global row numbers.

Rows are numbered 0 to n - 1 by a total order of their content (id, digests), so
the number does not depend on files or partitions.  A keyed Feistel network
permutes the smallest even power of two that holds n; numbers that leave the
range walk on along their cycle until they are back in it, which makes it a
permutation of 0 to n - 1.  Position p goes to shard p % shards, slot p // shards:
shards differ by at most one row, slots are gapless, both are computable from the
row number alone, and ``row_at`` is the way back.

Numbering is one range-partitioned sort, a count per partition and an offset: no
window over the table.  Equal rows are told apart by their place in the written
input, so a row repeated any number of times spreads over many ranges.

Defined results: null text counts no bytes; null ids come first; repeated rows are
interchangeable and each get a place; the permutation has no groups: equal texts
are spread like any others; an empty table gives no rows; columns asked for with
``carry`` pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from parcelle.llm.common import mix64, spill

SHARDS = 40
SEED = 20
ROUNDS = 6


def _half_bits(n: int) -> int:
    """Bits of one half: the smallest h with 4**h >= n."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round(x: np.ndarray, seed: int, turn: int, mask: np.uint64) -> np.ndarray:
    key = np.uint64((seed * 0x9E3779B97F4A7C15 + (turn + 1) * 0xD6E8FEB86659FD93) % (1 << 64))
    return mix64(x + key) & mask


def _network(x: np.ndarray, h: int, seed: int, back: bool) -> np.ndarray:
    bits, mask = np.uint64(h), np.uint64((1 << h) - 1)
    a, b = x >> bits, x & mask
    for turn in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
        if back:
            a, b = b ^ _round(a, seed, turn, mask), a
        else:
            a, b = b, a ^ _round(b, seed, turn, mask)
    return (a << bits) | b


def permute(numbers: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """Positions of row numbers in [0, n) (``back``: row numbers of positions)."""
    h = _half_bits(n)
    x = _network(numbers.astype(np.uint64), h, seed, back)
    out = np.flatnonzero(x >= n)
    while len(out):                       # cycle walking
        x[out] = _network(x[out], h, seed, back)
        out = out[x[out] >= n]
    return x.astype(np.int64)


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Row number that holds a place."""
    return permute(np.asarray(slot) * shards + np.asarray(shard), n, seed, back=True)


def number_rows(rows: DataFrame, *keys: str) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` from 0 in the order of ``keys``, and their
    count.  What is sorted is written once with each row's place, the last key."""
    kept = spill(rows.withColumn("__place", F.monotonically_increasing_id()), "shard-rows")
    parts = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*keys, "__place"]
    ranged = kept.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = spill(ranged.withColumn("__spot", F.monotonically_increasing_id()), "shard-sorted")   # partition << 33 | place in it
    part = F.shiftright("__spot", 33)
    sizes = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # one row a partition of the sort: small whatever the table
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = spill(sizes.withColumn("before", before), "shard-offsets")
    total = offsets.agg(F.sum("n")).first()[0] or 0
    offsets = F.broadcast(offsets.select(F.col("part").alias("__part"), F.col("before").alias("__before")))
    numbered = ranged.join(offsets, part == F.col("__part"))
    spot = F.col("__spot").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn("row_number", (F.col("__before") + spot).cast("long")).drop("__part", "__before", "__spot", "__place"), int(total)


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, row_number, shard, slot) of every row; ``carry``
    names columns of ``docs`` to return as well, in a struct ``row``."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # the digest covers the id and the text only: rows equal in both are interchangeable here
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(F.col("text")).alias("digest"),
                       *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []))
    rows, n = number_rows(rows, "doc_id", "text_crc32", "digest", "size")
    out = rows.select("doc_id", "size", "text_crc32", "row_number", *(["row"] if carry else []))
    schema = T.StructType([*out.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def place(batches):
        for b in batches:
            at = permute(b.column(3).to_numpy(zero_copy_only=False), n, seed)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at % shards, pa.int32()), pa.array(at // shards, pa.int64())],
                                             names=[*b.schema.names, "shard", "slot"])

    return out.mapInArrow(place, schema)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, slots_a_file: int = 1_000_000) -> None:
    """The rows themselves as Parquet, a folder a shard, in slot order; a shard is
    written by as many tasks as it has blocks of ``slots_a_file`` slots."""
    placed = assign(docs, shards, seed, carry=docs.columns).select("row", "shard", "slot")
    block = F.floor(F.col("slot") / F.lit(slots_a_file)).alias("block")
    placed = placed.repartition(F.col("shard"), block).sortWithinPartitions("shard", "slot")
    # the place's columns lead, so a column of the same name in the row stays inside its struct
    placed.select("shard", "slot", "row").write.partitionBy("shard").parquet(path)


def shard_report(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Contract columns: the law that holds is ``rows`` (counts at most one apart)."""
    return assign(docs, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")
