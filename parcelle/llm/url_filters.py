"""URL filters as a temporal list join.

A list is a log of dated entries (pattern, day, action).  The entries of a
pattern become validity intervals that do not overlap; an as-of join evaluates
every capture against the entries active on its day.  A pattern holds for its
host and all hosts below it; the longest pattern with an active entry decides,
``allow`` lifting a shorter ``block``.

The verdict depends on host and day alone, so captures are first reduced to
their distinct (host, day) pairs: a host with a third of all captures is at most
one row a day in the join.  Intervals are entered under every 32-day cell they
cover, so the join is an equi-join with a check; an open interval (the last of
its pattern) has one entry whatever its length.

Defined results: a null or unreadable URL has no host and is not blocked; null
days match nothing; entries without pattern, day or action are ignored, of
several on one day ``block`` wins over ``allow``; repeated captures are judged alike, each
row its own; empty tables give empty or unmatched results; further columns of
the captures pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

CELL_DAYS = 32


def host_of(url: Column) -> Column:
    h = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(h != "", h)


def validity(entries: DataFrame) -> DataFrame:
    """(pattern, action, from_day, to_day): ``to_day`` exclusive, null while open."""
    good = entries.where("pattern IS NOT NULL AND day IS NOT NULL AND action IS NOT NULL")
    one = good.groupBy("pattern", "day").agg(F.max("action").alias("action"))      # 'block' > 'allow'
    after = F.lead("day").over(W.partitionBy("pattern").orderBy("day"))
    return one.select("pattern", "action", F.col("day").alias("from_day"), after.alias("to_day"))


def apply_list(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """``captures`` plus ``host``, ``matched`` (pattern), ``action`` and ``blocked``."""
    cell = lambda c: F.floor(c / F.lit(CELL_DAYS)).cast("int")
    spans = validity(entries)
    closed = spans.where("to_day IS NOT NULL").withColumn("cell", F.explode(F.sequence(cell(F.col("from_day")), cell(F.col("to_day") - 1))))
    spans = closed.unionByName(spans.where("to_day IS NULL").withColumn("cell", F.lit(None).cast("int")))
    spans = spans.withColumn("cell", F.coalesce("cell", F.lit(-(1 << 30))))
    keep = captures.drop("host", "matched", "action", "blocked")
    rows = keep.withColumn("__u_host", host_of(F.col(f"`{url}`"))).withColumn("__u_day", F.col(f"`{day}`").cast("int"))
    asked = rows.where("__u_host IS NOT NULL AND __u_day IS NOT NULL").select(F.col("__u_host").alias("h"), F.col("__u_day").alias("d")).distinct()
    labels = F.split("h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = asked.withColumn("suffix", F.explode(suffixes)).withColumn("c", F.explode(F.array(cell(F.col("d")), F.lit(-(1 << 30)))))
    hit = keys.join(spans, (keys["suffix"] == spans["pattern"]) & (keys["c"] == spans["cell"]) & (F.col("d") >= F.col("from_day"))
                    & (F.col("to_day").isNull() | (F.col("d") < F.col("to_day"))))
    verdict = hit.groupBy("h", "d").agg(F.max_by(F.struct("pattern", "action"), F.length("pattern")).alias("v"))
    out = rows.join(verdict, (rows["__u_host"] == verdict["h"]) & (rows["__u_day"] == verdict["d"]), "left")
    return out.select(*[F.col(f"`{c}`") for c in keep.columns], F.col("__u_host").alias("host"), F.col("v.pattern").alias("matched"),
                      F.col("v.action").alias("action"), F.coalesce(F.col("v.action") == "block", F.lit(False)).alias("blocked"))


# -- the given tables as captures and a list ---------------------------------
FIRST_DAY, DAYS = 19723, 366      # 2024, days since 1970


def captures_of(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url) with a fetch day of 2024 derived from the id."""
    return pages.select("page_id", "url", (F.pmod(F.col("page_id") * 7919, F.lit(DAYS)) + FIRST_DAY).cast("int").alias("day"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of ``pages``: for hosts and their last two
    labels whose digest says so, one to four entries that block and allow in turn."""
    host = pages.select(host_of(F.col("url")).alias("h")).where("h IS NOT NULL").distinct()
    names = host.select(F.explode(F.array("h", F.substring_index("h", ".", -3))).alias("pattern")).distinct()
    num = lambda c, a: F.conv(F.substring(c, a, 4), 16, 10).cast("int")
    digest = F.md5(F.col("pattern").cast("binary"))
    listed = names.withColumn("m", digest).where(num(F.col("m"), 1) % 8 < 5)
    each = listed.withColumn("i", F.explode(F.sequence(F.lit(0), num(F.col("m"), 5) % 4)))
    return each.select("pattern", (num(F.col("m"), F.lit(9) + 4 * F.col("i")) % DAYS + FIRST_DAY).cast("int").alias("day"),
                       F.when(F.col("i") % 2 == 0, "block").otherwise("allow").alias("action"))
