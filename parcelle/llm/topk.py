"""Exact top-k by inner product with vector-approximation (VA) blocks.

Components become integers floor(256 x).  Each dimension is cut into cells; a
block of vectors is first scanned by its cells alone, which gives an upper and a
lower bound of every score.  The k-th largest lower bound rules out most rows;
the exact vectors of the rest are read in falling order of their upper bound
until the next bound is below the k-th exact score.

Queries and candidates meet in blocks of bounded size (one co-group of a query
block and a candidate block per task); a block returns at most k rows a query,
and a final ranking joins the blocks.  No pair of rows is ever emitted.

Defined results: vectors that are null, or hold null or non-finite components,
and rows without an id take no part; rows that share an id are rows of their own,
as queries and as candidates (a row only never meets itself); vectors of different
length do not meet; ties go to the smaller id; fewer than k candidates give all;
scores beyond a long saturate; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from parcelle.llm.common import spill

CELLS = 16            # cells a dimension: 4 bits
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 2048
_TILE = 128           # queries bounded at a time
_READ = 32            # exact vectors read at a time
_LONG = (1 << 63) - 1


def integer_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, v array<long>, dim) of the rows that take part; ``row`` names a
    row once the result is written."""
    x = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    good = rows.select(F.col(f"`{key}`").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull()).where(
        F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    v = F.transform("x", lambda c: F.floor(c * F.lit(256.0)).cast("long"))
    return good.select(F.monotonically_increasing_id().alias("row"), "vec_id", v.alias("v")).withColumn("dim", F.size("v"))


def _matrix(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.chunked_array(col).combine_chunks() if not isinstance(col, pa.ChunkedArray) else col.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def block_topk(qrow, q, crow, cid, c, lo, hi, k: int):
    """(query row, candidate id, score): the k best of one candidate block for each
    query, ties to the smaller id, by bounds first and exact reads after."""
    width = np.maximum(1, -(-(hi - lo + 1) // CELLS))
    cell = (c - lo) // width                      # the approximation: 4 bits a component
    low, high = lo + cell * width, np.minimum(lo + cell * width + width - 1, hi)
    most = float(max(abs(float(c.max(initial=0))), abs(float(c.min(initial=0))), abs(float(lo.min(initial=0))), abs(float(hi.max(initial=0)))))
    mostq = float(max(abs(float(q.max(initial=0))), abs(float(q.min(initial=0)))))
    kind = np.float64 if most * mostq * max(1, c.shape[1]) < 2.0 ** 52 else object
    low, high, exact = low.astype(kind), high.astype(kind), c.astype(kind)
    out_q, out_c, out_s = [], [], []
    for a in range(0, len(qrow), _TILE):
        ids, t = qrow[a:a + _TILE], q[a:a + _TILE].astype(kind)
        pos, neg = np.where(t > 0, t, 0), np.where(t < 0, t, 0)
        upper, lower = pos @ high.T + neg @ low.T, pos @ low.T + neg @ high.T
        own = ids[:, None] == crow[None, :]
        for i in range(len(ids)):
            others = np.flatnonzero(~own[i])
            if not len(others):
                continue
            if len(others) > k:
                sure = np.partition(lower[i, others], len(others) - k)[len(others) - k]
                others = others[upper[i, others] >= sure]
            others = others[np.argsort(-upper[i, others], kind="stable")]
            ub, best = upper[i, others], []
            for b in range(0, len(others), _READ):
                if len(best) == k and ub[b] < best[-1][0]:
                    break
                some = others[b:b + _READ]
                best = sorted(best + list(zip((exact[some] @ t[i]).tolist(), cid[some].tolist())), key=lambda p: (-p[0], p[1]))[:k]
            for s, cand in best:
                out_q.append(int(ids[i]))
                out_c.append(cand)
                out_s.append(max(-_LONG - 1, min(_LONG, int(s))))
    return out_q, out_c, out_s


def exact_topk(rows: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding",
               every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by
    ``every`` the k best other rows."""
    v = spill(integer_vectors(rows, key, vector), "topk")
    is_query = F.col("vec_id") % every == 0
    n, nq = v.agg(F.count("*"), F.sum(is_query.cast("int"))).first()
    nc, nqb = max(1, -(-n // CANDIDATE_BLOCK)), max(1, -(-(nq or 0) // QUERY_BLOCK))
    # bounds of each dimension over all rows: as many as the vectors have components
    marks: dict[int, tuple] = {}
    got = v.select("dim", F.posexplode("v").alias("pos", "c")).groupBy("dim", "pos").agg(F.min("c"), F.max("c")).collect()
    for dim in {r[0] for r in got}:
        own = sorted((r[1], r[2], r[3]) for r in got if r[0] == dim)
        marks[dim] = (np.array([r[1] for r in own], np.int64), np.array([r[2] for r in own], np.int64))
    cand = v.withColumn("cb", F.pmod(F.xxhash64("row"), F.lit(nc))).withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nqb - 1).cast("long"))))
    query = v.where(is_query).withColumn("qb", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(nqb))).withColumn(
        "cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nc - 1).cast("long"))))
    schema = "row long, vec_id long, score long"

    def meet(c: pa.Table, q: pa.Table) -> pa.Table:
        got = ([], [], [])
        if c.num_rows and q.num_rows:
            dim = c.column("dim")[0].as_py()
            lo, hi = marks.get(dim, (np.zeros(dim, np.int64),) * 2)
            got = block_topk(q.column("row").to_numpy(), _matrix(q.column("v"), dim), c.column("row").to_numpy(),
                             c.column("vec_id").to_numpy(), _matrix(c.column("v"), dim), lo, hi, k)
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("row", "vec_id", "score"), got)})

    keys = ("dim", "cb", "qb")
    best = cand.groupBy(*keys).cogroup(query.groupBy(*keys)).applyInArrow(meet, schema)
    rank = F.row_number().over(W.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    best = best.withColumn("rank", rank).where(F.col("rank") <= k)
    ids = v.where(is_query).select("row", F.col("vec_id").alias("query_id"))
    return best.join(ids, "row").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
