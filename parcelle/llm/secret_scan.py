"""Secret scan with multipart credential linking (DataFrame functions only).

Base kinds are found by pattern in every whole text.  Weak candidates (account
names, long opaque strings, service addresses) are common in clean text, so they
are reported only when complementary parts stand in one scope: an interval join
of the parts of a document, scope = ``scope`` code points to either side.  A
weak identifier needs a secret part in scope, a weak secret an identifier part,
an endpoint both.

Defined results: null text counts as empty; positions are code points, end
exclusive; identical rows get identical results, each row its own; no match
gives counts 0 and empty strings; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import spill

#: Fixed values of the contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Weak parts; reported only where complementary parts co-occur.
WEAK_ID = r"""(?i:access_?key_?id|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
WEAK_SECRET = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}+"
ENDPOINT = r"""[a-z][a-z0-9+]{1,9}://[A-Za-z0-9._:@/?&=%+-]+"""


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    part: str          # id, secret or endpoint
    weak: bool = False
    need: str | None = None    # Java pattern that every match holds: a cheap first test
    value_group: int | None = None
    least: int = 0     # code points of the value group at least


KINDS = (
    Kind("assign", ASSIGN, "secret", need="[:=]", value_group=2, least=8),
    Kind("access", ACCESS, "id", need="AKIA"),
    Kind("hex", HEX, "secret"),
    Kind("ident", WEAK_ID, "id", weak=True, need="[:=]"),
    Kind("opaque", WEAK_SECRET, "secret", weak=True),
    Kind("endpoint", ENDPOINT, "endpoint", weak=True, need="://"),
)
SCOPE = 300
_SPAN = "array<struct<start:int,rank:int,end:int>>"


def _match_spans(df: DataFrame, kind: Kind, rank: int) -> DataFrame:
    """Adds ``s_<rank>``: the kind's spans, leftmost and non-overlapping.

    The gaps between matches (``split``) and the matches themselves alternate
    and add up to the text, so running sums of code points give positions."""
    t, m, g, v = F.col("__t"), f"__m{rank}", f"__g{rank}", f"__v{rank}"
    none = F.array().cast("array<string>")
    found = F.regexp_extract_all(t, F.lit(kind.pattern), F.lit(0))
    df = df.withColumn(m, F.when(t.rlike(kind.need), found).otherwise(none) if kind.need else found)
    df = df.withColumn(g, F.when(F.size(m) > 0, F.split(t, kind.pattern, -1)))
    if kind.value_group:
        df = df.withColumn(v, F.when(F.size(m) > 0, F.regexp_extract_all(t, F.lit(kind.pattern), F.lit(kind.value_group))))
    else:
        df = df.withColumn(v, F.lit(None).cast("array<string>"))
    steps = F.transform(m, lambda x, i: F.struct(
        F.length(F.get(g, i)).alias("gap"), F.length(x).alias("len"),
        F.coalesce(F.length(F.get(v, i)), F.lit(kind.least)).alias("value")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + x["len"]).alias("end"))
        return F.struct((start + x["len"]).alias("at"),
                        F.when(x["value"] >= kind.least, F.concat(a["out"], F.array(span))).otherwise(a["out"]).cast(_SPAN).alias("out"))

    df = df.withColumn(f"__x{rank}", steps)
    return df.withColumn(f"s_{rank}", F.when(F.size(f"__x{rank}") > 0, F.aggregate(f"__x{rank}", empty, step)["out"])
                         .otherwise(F.array().cast(_SPAN))).drop(m, g, v, f"__x{rank}")


def find_parts(docs: DataFrame, kinds=KINDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, weak, row_key) of every row: spans of the base kinds, weak
    candidates outside them, and for rows with weak candidates that could be
    linked a key of their content."""
    df = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__t"))
    for i, k in enumerate(kinds):
        df = _match_spans(df, k, i)
    base = F.concat(*[F.col(f"s_{i}") for i, k in enumerate(kinds) if not k.weak])
    weak = F.concat(F.array().cast(_SPAN), *[F.col(f"s_{i}") for i, k in enumerate(kinds) if k.weak])
    df = df.withColumn("base", F.sort_array(base)).withColumn("weak", weak)
    df = df.withColumn("weak", F.when(F.size("weak") > 0, F.filter("weak", lambda x: ~F.exists(
        "base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))).otherwise(F.col("weak")))
    every = F.concat("base", "weak")
    n = {}
    for part in ("id", "secret"):
        ranks = [i for i, k in enumerate(kinds) if k.part == part]
        n[part] = F.size(F.filter(every, lambda x: x["rank"].isin(ranks)))
    # a weak part is reported only beside an id or secret part: both must occur
    can = (F.size("weak") > 0) & (n["id"] > 0) & (n["secret"] > 0)
    return df.select("doc_id", "base", "weak", F.when(can, F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), "__t").cast("binary"))).alias("row_key"))


def link_parts(found: DataFrame, kinds=KINDS, scope: int = SCOPE) -> DataFrame:
    """(row_key, linked): weak spans with complementary parts in scope.

    Interval join: positions are cut into cells of ``scope`` code points; a part
    is entered in every cell that its scope touches, a candidate in the cells it
    covers; semi-joins on (row, cell) never make a pair."""
    rows = found.where(F.col("row_key").isNotNull())
    parts = rows.select("row_key", F.explode(F.concat("base", "weak")).alias("p")).select("row_key", "p.*")
    part_of = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(kinds) for x in (i, k.part)]), F.col("rank"))
    parts = parts.withColumn("part", part_of)
    cell = lambda c: F.floor(c / F.lit(scope))
    near = parts.select("row_key", "part", (F.col("start") - scope).alias("lo"), (F.col("end") + scope).alias("hi"))
    near = near.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    weak = parts.where(F.col("rank").isin([i for i, k in enumerate(kinds) if k.weak]))
    weak = weak.withColumn("cell", F.explode(F.sequence(cell(F.col("start")), cell(F.col("end")))))

    def beside(a: DataFrame, part: str) -> DataFrame:
        b = near.where(F.col("part") == part).select(F.col("row_key").alias("k"), F.col("cell").alias("c"), "lo", "hi").distinct()
        return a.join(b, (a["row_key"] == b["k"]) & (a["cell"] == b["c"]) & (a["start"] <= b["hi"]) & (a["end"] >= b["lo"]), "left_semi")

    ids = beside(weak.where("part = 'id'"), "secret")
    secrets = beside(weak.where("part = 'secret'"), "id")
    # an endpoint may have its two partners in different cells
    cols = ["row_key", "start", "rank", "end"]
    ends = weak.where("part = 'endpoint'")
    ends = beside(ends, "id").select(cols).intersect(beside(ends, "secret").select(cols))
    linked = ids.select(cols).union(secrets.select(cols)).union(ends).distinct()
    return linked.groupBy("row_key").agg(F.collect_list(F.struct("start", "rank", "end")).alias("linked"))


def _as_text(spans: Column, kinds) -> Column:
    names = F.array(*[F.lit(k.name) for k in kinds])
    return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat(
        F.get(names, x["rank"]), F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, kinds=KINDS, scope: int = SCOPE) -> DataFrame:
    """Contract columns of every row of ``docs`` plus ``n_linked``."""
    found = spill(find_parts(docs, kinds), "secrets")
    linked = link_parts(found, kinds, scope)
    none = F.array().cast(_SPAN)
    keyed = found.where(F.col("row_key").isNotNull()).join(linked, "row_key", "left").select(
        "doc_id", "base", F.coalesce(F.col("linked").cast(_SPAN), none).alias("linked"))
    rest = found.where(F.col("row_key").isNull()).select("doc_id", "base", none.alias("linked"))
    out = keyed.unionAll(rest)
    count = lambda r: F.size(F.filter("base", lambda x: x["rank"] == r)).cast("long")
    return out.select("doc_id", *[count(i).alias("n_" + k.name) for i, k in enumerate(kinds) if not k.weak],
                      F.sha2(_as_text(F.col("base"), kinds).cast("binary"), 256).alias("base_sha256"),
                      _as_text(F.concat("base", "linked"), kinds).alias("spans"), F.size("linked").cast("long").alias("n_linked"))
