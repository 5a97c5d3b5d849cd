"""Size checks in front of broadcast joins.

A broadcast hint bypasses Spark's own size threshold, so it is given only behind a check.

* ``broadcast_if_small`` asks the optimizer's estimate.  It is right for scans and far off
  behind joins (it multiplies the sides).
* ``measured_side`` writes the side once into the shared scratch folder and counts its
  rows and bytes; what is computed for the check is what the join reads.
* ``lookup`` left-joins a fact to a lookup side.  A side whose estimate is far under the
  bound is broadcast at once, any other is measured first.  Beyond the bound both sides
  are shuffled on (key, salt), the fact's rows dealt over the salts by their hash and the
  side copied to each salt, so neither a hot key nor the rows without a key end in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.session import write_once

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: Rows up to which a measured lookup side is broadcast.
DEFAULT_MAX_BROADCAST_ROWS = 500_000
#: How far under the bound an estimate must lie to be taken without measuring (files are
#: compressed, the broadcast is not).
ESTIMATE_MARGIN = 8
LOOKUP_SALTS = 16


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` (no job is run); None where the session
    has no JVM plan to ask (Spark Connect)."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast only when its estimated size is below ``max_bytes``."""
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def measured_side(df: DataFrame, label: str, max_rows: int | None = None,
                  max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df`` written once and read back, and whether it may be broadcast: at most
    ``max_rows`` rows (default ``DEFAULT_MAX_BROADCAST_ROWS``) and, by the bytes
    of their values as text, at most ``max_bytes``."""
    max_rows = DEFAULT_MAX_BROADCAST_ROWS if max_rows is None else max_rows
    side = write_once(df, label)
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in side.columns), F.lit(0))
    m = side.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return side, m["n"] <= max_rows and (m["b"] or 0) <= max_bytes


def lookup(fact: DataFrame, side: DataFrame, key: Column, side_key: str, label: str = "lookup",
           max_bytes: int | None = None, salts: int = LOOKUP_SALTS) -> DataFrame:
    """Left join of ``fact`` with ``side`` on ``key`` = ``side_key`` (a name ``fact`` does not
    have; it stays in the result).  A NULL key finds nothing."""
    max_bytes = DEFAULT_MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    side = side.where(F.col(side_key).isNotNull())
    size = estimated_bytes(side)
    small = size is not None and size * ESTIMATE_MARGIN <= max_bytes
    if not small:
        side, small = measured_side(side, label, max_bytes=max_bytes)
    if small:
        return fact.join(F.broadcast(side), key == F.col(side_key), "left")
    salted = fact.withColumn("_lookup_salt", F.pmod(F.xxhash64(*fact.columns), F.lit(salts)))
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    copies = side.withColumn("_lookup_copy", F.explode(every))
    on = (key == F.col(side_key)) & (F.col("_lookup_salt") == F.col("_lookup_copy"))
    return salted.join(copies, on, "left").drop("_lookup_salt", "_lookup_copy")
