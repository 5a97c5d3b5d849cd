"""Key rules on write: unique and foreign keys as reject reasons.

Together with the row predicates of ``clean.sales_rules`` they stand for the
table's constraints: a row that breaks any goes to the rejects with all its reasons.
As in SQL, a NULL key conflicts with nothing and refers to nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.operators.ranks import number_rows


@dataclass
class Unique:
    """Rows of a load share no key, and none is stored already (``stored``)."""
    reason: str
    key: Sequence[str]
    stored: DataFrame | None = None
    stored_reason: str = ""


@dataclass
class Foreign:
    """A key is NULL or a value of ``parent_key``."""
    reason: str
    key: str
    parent: DataFrame = field(repr=False)
    parent_key: str = "id"


def _present(key: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in key:
        out = out & F.col(k).isNotNull()
    return out


def check_keys(df: DataFrame, unique: Sequence[Unique] = (), foreign: Sequence[Foreign] = (), order: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``key_reasons``: names of the key rules that a row breaks.

    Of rows that share a unique key the first in ``order`` stays (ties by content);
    a row that breaks a rule still takes its key, as the load would have met it
    first.  The first row of a key is a hash aggregate of row numbers, reduced
    before the shuffle, so a key of a third of all rows is no hot task; rows are
    numbered once (see ``ranks``), which writes the load and is the one eager step."""
    cols = df.columns
    out = df
    reasons: list[Column] = []
    if unique:
        out, _ = number_rows(df, *order, name="_k_number")
    for i, rule in enumerate(unique):
        first = out.where(_present(rule.key)).groupBy(*[F.col(k).alias(f"_u{i}_{j}") for j, k in enumerate(rule.key)]).agg(F.min("_k_number").alias(f"_u{i}"))
        same = F.lit(True)
        for j, k in enumerate(rule.key):
            same = same & (F.col(k) == F.col(f"_u{i}_{j}"))
        out = out.join(first, same, "left").drop(*[f"_u{i}_{j}" for j in range(len(rule.key))])
        reasons.append(F.when(F.col("_k_number") > F.col(f"_u{i}"), F.lit(rule.reason)))
        if rule.stored is not None:
            known = rule.stored.select(*[F.col(k).alias(f"_s{i}_{j}") for j, k in enumerate(rule.key)]).distinct().withColumn(f"_s{i}", F.lit(True))
            same = F.lit(True)
            for j, k in enumerate(rule.key):
                same = same & (F.col(k) == F.col(f"_s{i}_{j}"))
            out = out.join(known, same, "left").drop(*[f"_s{i}_{j}" for j in range(len(rule.key))])
            reasons.append(F.when(F.col(f"_s{i}"), F.lit(rule.stored_reason)))
    for i, rule in enumerate(foreign):
        parent = rule.parent.select(F.col(rule.parent_key).alias(f"_f{i}_k")).distinct().withColumn(f"_f{i}", F.lit(True))
        out = out.join(parent, F.col(rule.key) == F.col(f"_f{i}_k"), "left").drop(f"_f{i}_k")
        reasons.append(F.when(F.col(rule.key).isNotNull() & F.col(f"_f{i}").isNull(), F.lit(rule.reason)))
    return out.select(*cols, F.array_compact(F.array(*reasons)).alias("key_reasons"))
