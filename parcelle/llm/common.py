"""Helpers shared by the operators: scratch tables, word hashing, components."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word definition ``[^\x20\x09-\x0D]+`` (fixed value).
WS_CLASS = "[ \\t-\\r]"

# ---------------------------------------------------------------------------
# scratch tables in the folder that all machines share


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only where that is unset, the
    session's own checkpoint folder (tests set one)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        from parcelle.session import ensure_checkpoint_dir
        path = ensure_checkpoint_dir(spark)
    return path.rstrip("/")


def spill(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    It cuts the lineage: a lost executor costs a re-read of files that every
    machine sees, never a second run of the stages above."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/parcelle-llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Arrow batches of at most ``rows`` rows for the jobs that run inside: rows
    that carry whole token sets are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def hash_sample(df: DataFrame, rows: int, total: int, *by: str) -> DataFrame:
    """At most ``rows`` rows of ``df``, those with the smallest hashes of ``by``.
    A cutoff lets about four times as many through, so what is sorted does not
    grow with the table or its partitions."""
    share = min(1.0, 4.0 * rows / max(1, total))
    h = F.xxhash64(*by)
    if share < 1.0:
        df = df.where(h < F.lit(int(-(1 << 63) + share * float(1 << 64))).cast("long"))
    return df.orderBy(h, *by).limit(rows)


# ---------------------------------------------------------------------------
# words as 64-bit hashes, whole buffers at a time

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_MAXW = 1 << 16


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _B, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_POW = _powers(4096)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def separators(letters_only: bool) -> np.ndarray:
    """Per byte: does it end a word?  Either ASCII white space, or every ASCII
    byte that is neither a letter nor a digit."""
    t = np.zeros(256, dtype=bool)
    if letters_only:
        t[:128] = True
        for a, b in ((48, 58), (65, 91), (97, 123)):
            t[a:b] = False
    else:
        t[[32, 9, 10, 11, 12, 13]] = True
    return t


_WS, _NONALNUM = separators(False), separators(True)


def word_hashes(texts: list[bytes], letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of each text, A-Z lower-cased.

    Returns (hashes of all words in order, offsets of each text in them; one
    more offset than texts).  Words never run over from one text to the next."""
    sep = b" "
    buf = np.frombuffer(sep + sep.join(texts) + sep, dtype=np.uint8)
    upper = (buf >= 65) & (buf <= 90)
    buf = buf + (upper.astype(np.uint8) << 5)
    blank = (_NONALNUM if letters_only else _WS)[buf]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    at = np.concatenate(([1], np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) + 1))
    offsets = np.searchsorted(starts, at)
    if not len(starts):
        return np.empty(0, np.uint64), offsets
    length = ends - starts
    keep = np.flatnonzero(~blank)
    rel = keep - np.repeat(starts, length)
    longest = int(length.max())
    pw = _POW if longest <= len(_POW) else _powers(longest)
    terms = (buf[keep].astype(np.uint64) + np.uint64(1)) * pw[rel]
    first = np.concatenate(([0], np.cumsum(length)[:-1]))
    return mix64(np.add.reduceat(terms, first) + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), offsets


def in_chunks(texts: list, limit: int = 1 << 19):
    """Slices of a list of byte strings holding about ``limit`` bytes each (one
    longer text is a slice of its own), so that work arrays stay small."""
    lo, total = 0, 0
    for i, t in enumerate(texts):
        if i > lo and total + len(t) > limit:
            yield lo, i
            lo, total = i, 0
        total += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def slices(batch, column: int, limit: int = 1 << 22):
    """Slices of a record batch whose texts hold about ``limit`` bytes, so that
    only these become Python objects at a time."""
    import pyarrow as pa
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // limit
    cut = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [batch.num_rows])) if batch.num_rows else np.zeros(1, int)
    for lo, hi in zip(cut[:-1], cut[1:]):
        yield batch.slice(int(lo), int(hi - lo))


# ---------------------------------------------------------------------------
# connected components, distributed


#: Edges of a piece that one task contracts, about; larger inputs have more pieces.
PIECE_EDGES = 50_000


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges (u, v), ascending, and for each the smallest node it
    can reach.  Every round hooks roots below their smallest neighbouring root and
    then doubles the pointers until they end in roots."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return nodes, nodes[root]
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _contract(edges: DataFrame, pieces: int) -> DataFrame:
    """Each piece's nodes as stars (u, v): v the smallest node that u reaches in the
    piece.  No shuffle: pieces are whole partitions of the written edges."""
    import pyarrow as pa

    def run(batches):
        u, v = np.empty(0, np.int64), np.empty(0, np.int64)
        held, size = [], 0

        def stars():
            cols = [np.concatenate(x) for x in zip((u, v), *held)]
            return smallest_reachable(*cols)

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size > 4 * PIECE_EDGES + len(u):       # what is held stays near the piece's nodes
                (u, v), held, size = stars(), [], 0
        u, v = stars()
        for lo in range(0, len(u), PIECE_EDGES):
            yield pa.RecordBatch.from_arrays([pa.array(u[lo:lo + PIECE_EDGES]), pa.array(v[lo:lo + PIECE_EDGES])], names=["u", "v"])

    return edges.coalesce(pieces).mapInArrow(run, "u long, v long")


def _edge_state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v longs), as a written table;
    component is the smallest node that can be reached.

    First each piece of some ``PIECE_EDGES`` written edges is contracted to stars by
    its own task, again while that leaves far fewer pieces.  Where several stay, "large
    star" and "small star" steps join them: each is one shuffle over the edges with
    map-side minima, and the edge list never grows.  Every round is written to the
    shared folder; edges never come to the driver."""
    e = spill(edges.select("u", "v"), label)
    count = e.count()
    while True:
        pieces = max(1, -(-count // PIECE_EDGES))
        e = spill(_contract(e, pieces), label)
        if pieces == 1:                 # one piece: its stars are the answer
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before, count = pieces, e.count()
        if -(-count // PIECE_EDGES) * 4 > before * 3:
            break                       # fewer pieces would not help much any more
    nodes, e = e, e.where("u <> v")
    state = _edge_state(e)
    while state[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select("v", "m").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("u", F.col("m").alias("v")))).distinct()
        e = spill(small, label)
        now = _edge_state(e)
        if now == state:
            break
        state = now
    roots = nodes.select(F.col("v").alias("u")).distinct().join(e.select("u"), "u", "left_anti").select("u", F.col("u").alias("v"))
    return spill(e.select("u", "v").union(roots).toDF("node", "component"), label)
