"""Mix sources to target weights: hash-random order, prefix sums, exact cuts.

Every row gets a hash-random key.  A source's budget is ``epochs`` whole passes
plus a part of one more: its rows are put into ranges of the key, the ranges'
word counts are summed up (a prefix sum over about sqrt(rows) ranges), and only
the one range that holds the cut is sorted row by row.  So no source, however
large, is ever sorted or collected in one task.

Defined results: null text has no words; null source is a source of its own,
last in order; rows with the same key (repeated rows) at a cut share it evenly;
a source without words gets nothing; an empty table gives an empty result;
further columns pass through in ``mix_rows``.  Keys depend on doc_id and size
only, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from parcelle.llm.common import WS_CLASS, spill

WEIGHTS = (3.0, 1.0, 2.0)   # by order of the source's code points, repeating
SHARE = 1.5                 # of all words
MAX_EPOCHS = 2
SEED = "mix-1"
#: Rows of the per-source plan up to which it is broadcast.
BROADCAST_SOURCES = 20_000
_TRIM = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(_TRIM))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, WS_CLASS + "+"))).cast("long")


def mix_key(doc_id: Column, size: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), size.cast("string")).cast("binary"))


def source_targets(narrow: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = MAX_EPOCHS) -> tuple[DataFrame, int]:
    """(source, source_size, target): weights by code-point order of the source,
    targets capped at ``cap`` times the size, the excess reshared by weight until
    none is above.  Each round is one aggregate over the table of sources."""
    spark = narrow.sparkSession
    totals = spill(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-totals")
    ranked = totals.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1]))
    schema = T.StructType([totals.schema["source"], T.StructField("source_size", T.LongType()), T.StructField("place", T.LongType())])
    src = spark.createDataFrame(ranked, schema)
    src = src.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    src = spill(src.withColumn("most", F.col("source_size") * F.lit(float(cap))), "mix-sources")
    n, words, free = src.agg(F.count("*"), F.sum("source_size"), F.sum("weight")).first()
    budget = share * float(words or 0)
    level, capped = (budget / free if free else 0.0), -1
    while n:
        above = F.col("weight") * F.lit(level) > F.col("most")
        k, held, free = src.agg(F.sum(above.cast("int")), F.sum(F.when(above, F.col("most"))), F.sum(F.when(~above, F.col("weight")))).first()
        if k == capped or not free:
            break
        capped, level = k, (budget - float(held or 0.0)) / float(free)
    target = F.least(F.col("most"), F.col("weight") * F.lit(level))
    return src.select("source", "source_size", target.alias("target")), n


def cut_plan(narrow: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole epochs, and where the last one is cut (``cut_key``; rows
    below it are taken whole, rows at it give ``cut_words`` each)."""
    budget = F.floor(F.col("target") + F.lit(0.5))
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    src = targets.withColumn("epochs", whole).withColumn("rest", (budget - F.col("epochs") * F.col("source_size")).cast("long"))
    n = narrow.count()
    ranges = max(1, math.isqrt(n))
    cell = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(ranges) / F.lit(float(1 << 32))).cast("long")
    rows = narrow.withColumn("range", cell)
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    order = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = sums.withColumn("upto", F.sum("words").over(order))
    need = src.where("rest > 0").select(F.col("source").alias("s"), "rest")
    at = sums.join(need, F.col("source").eqNullSafe(F.col("s"))).where("upto > rest AND upto - words <= rest")
    at = spill(at.select(F.col("s").alias("cs"), F.col("range").alias("cr"), (F.col("rest") - F.col("upto") + F.col("words")).alias("left")), "mix-ranges")
    inside = rows.join(at, F.col("source").eqNullSafe(F.col("cs")) & (F.col("range") == F.col("cr")))
    keys = inside.groupBy("cs", "key").agg(F.sum("size").alias("words"), F.count("*").alias("copies"), F.first("left").alias("left"))
    upto = F.sum("words").over(W.partitionBy("cs").orderBy("key").rowsBetween(W.unboundedPreceding, W.currentRow))
    cut = keys.withColumn("upto", upto).where("upto > left AND upto - words <= left").select(
        "cs", F.col("key").alias("cut_key"), F.floor((F.col("left") - F.col("upto") + F.col("words")) / F.col("copies")).cast("long").alias("cut_words"))
    return src.join(cut, F.col("source").eqNullSafe(F.col("cs")), "left").drop("cs", "rest")


def _with_plan(rows: DataFrame, docs_source: str, docs: DataFrame, weights, share) -> DataFrame:
    narrow = spill(rows.select("source", "size", "key"), "mix-keys")
    targets, n_sources = source_targets(narrow, weights, share)
    plan = spill(cut_plan(narrow, targets).withColumnRenamed("source", "__m_src"), "mix-plan")
    if n_sources <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    return docs.join(plan, F.col(docs_source).eqNullSafe(F.col("__m_src")), "left").drop("__m_src")


def _taken(size: Column, key: Column) -> tuple[Column, Column]:
    part = F.when(F.col("cut_key").isNull(), F.lit(0)).when(key < F.col("cut_key"), size).when(
        key == F.col("cut_key"), F.col("cut_words")).otherwise(F.lit(0)).cast("long")
    return F.col("epochs") * size, part


def mix_report(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, seed: str = SEED) -> DataFrame:
    """Contract columns of every document."""
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    rows = spill(rows.withColumn("key", mix_key(F.col("doc_id"), F.col("size"), seed)), "mix-docs")
    out = _with_plan(rows, "source", rows, weights, share)
    whole, part = _taken(F.col("size"), F.col("key"))
    return out.select("doc_id", "size", "source_size", "target", (whole + part).alias("taken"))


def mix_rows(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, seed: str = SEED) -> DataFrame:
    """The mixed corpus itself, in the columns of ``docs``: a document once per
    whole epoch, and the document at a source's cut up to its last taken word
    (its ``n_chars``, where there is such a column, follows the cut text)."""
    cols = docs.columns
    size = n_words(F.col("text"))
    work = docs.withColumn("__m_size", size).withColumn("__m_key", mix_key(F.col("doc_id"), F.col("__m_size"), seed))
    narrow = docs.select("doc_id", "source", size.alias("size")).withColumn("key", mix_key(F.col("doc_id"), F.col("size"), seed))
    plain = work.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(cols)], "__m_size", "__m_key")
    named = {c: f"__c{i}" for i, c in enumerate(cols)}
    out = _with_plan(narrow, named["source"], plain, weights, share)
    _, part = _taken(F.col("__m_size"), F.col("__m_key"))
    out = out.withColumn("__m_part", part)
    takes = F.concat(F.array_repeat(F.lit(-1).cast("long"), F.col("epochs").cast("int")),
                     F.when(F.col("__m_part") > 0, F.array("__m_part")).otherwise(F.array().cast("array<bigint>")))
    # a document without words has nothing to take
    out = out.where("__m_size > 0").withColumn("__m_take", F.explode(takes))
    text = F.col(named["text"])
    cut = (F.col("__m_take") >= 0) & (F.col("__m_take") < F.col("__m_size"))
    pieces = F.split(text, f"(?<=[^ \\t-\\r])(?={WS_CLASS})", -1)
    first = F.concat_ws("", F.slice(pieces, F.lit(1), F.col("__m_take").cast("int")))
    out = out.withColumn("__m_text", F.when(cut, first).otherwise(text))
    final = {"text": F.col("__m_text")}
    if "n_chars" in cols:
        final["n_chars"] = F.when(cut, F.length("__m_text")).otherwise(F.col(named["n_chars"])).cast(docs.schema["n_chars"].dataType)
    return out.select(*[final.get(c, F.col(named[c])).alias(c) for c in cols])
