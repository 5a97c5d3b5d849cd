"""Pack documents into sequences: dominance reduction, then best fit.

Lengths are integers up to the capacity, so the instance is a histogram with at
most ``capacity`` counts, whatever the number of documents; only that reaches
the driver.  Martello-Toth reduction fixes patterns that provably dominate every
other way of packing their largest item; what is left is packed best-fit
decreasing.  Both work on counts ("this pattern, so many times").  Documents get
their places in Spark: an item is the j-th of its length (prefix counts over
hash ranges, so that one length may hold any share of the rows), and the plan
says where the j-th item of a length goes.

Defined results: null text counts as empty (one token, the end mark); an empty
table gives no rows; repeated rows are items of their own; texts of any length
are tokenized whole; the string of a special token in a text is that token; further
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from parcelle.llm.common import spill

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
#: Runs without white space beyond this many characters go to the slower library,
#: whose time does not grow with the square of a run.
LONG_RUN = 2000
BROADCAST_PLAN_ROWS = 500_000


def special_tokens(vocabulary: str = VOCABULARY) -> list[str]:
    """Strings of a vocabulary's special tokens."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return [t.content for t in Tokenizer.from_file(public_tokenizers.path(vocabulary + ".json")).get_added_tokens_decoder().values()]


def make_encoder(vocabulary: str = VOCABULARY, special: list[str] | None = None):
    """text -> ids, as ``tokenizers`` gives them without adding special tokens.
    Two libraries read the same public vocabulary and give the same ids (tests
    compare them); the faster one takes ordinary text.  A text that holds one of the
    ``special`` strings goes to ``tokenizers``, which gives that token's id; without
    ``special``, such strings are ordinary text."""
    import base64
    import re

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary + ".tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    long_run = re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))
    slow = []

    def encode(text: str) -> list[int]:
        if not any(s in text for s in special or ()) and (len(text) < LONG_RUN or not long_run.search(text)):
            return fast.encode_ordinary(text)
        if not slow:
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(public_tokenizers.path(vocabulary + ".json"))
            t.encode_special_tokens = special is None
            slow.append(t)
        return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids plus the
    end mark; only longer ones are cut, the first piece taking the remainder."""

    special = special_tokens(vocabulary)

    def run(batches):
        encode = make_encoder(vocabulary, special)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            cols: tuple[list, ...] = ([], [], [], [], [])
            for doc, t in zip(ids, texts):
                toks = np.array(encode(t.as_py() or "") + [END_ID], dtype="<u4")
                start = 0
                stop = len(toks) % capacity or min(capacity, len(toks))
                piece = 0
                while start < len(toks):
                    for c, x in zip(cols, (doc, piece, start, stop - start, zlib.crc32(toks[start:stop].tobytes()))):
                        c.append(x)
                    start, stop, piece = stop, stop + capacity, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# ---------------------------------------------------------------------------
# the plan, over counts by length


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Martello-Toth reduction.  ``counts[s]`` items of size s; fixed items are
    taken off.  Returns (times, {size: items}) of the fixed sequences.

    For the largest item j (free space f) a set is fixed when it dominates every
    feasible set that holds j:
      - {j} if nothing else fits;
      - {j, f} if an item fills f exactly;
      - {j, k}, k the largest that fits, if no two others fit, or if no three fit
        and no two fill more than k;
      - {j, a, b}, a the largest that fits and b the largest beside it, if no three
        others fit and no size in (b, f/2] exists: any other set then has its
        larger item at most a and its smaller at most b.
    Removing items keeps each condition true, so a set is fixed as often as its
    items last.  Passes repeat until none fixes anything."""
    fixed: list[tuple[int, dict[int, int]]] = []

    def fix(items: tuple[int, ...]) -> None:
        need: dict[int, int] = defaultdict(int)
        for s in items:
            need[s] += 1
        times = min(int(counts[s]) // q for s, q in need.items())
        for s, q in need.items():
            counts[s] -= q * times
        fixed.append((times, dict(need)))

    again = True
    while again:
        again = False
        for j in range(capacity, 0, -1):
            while counts[j]:
                f = capacity - j
                counts[j] -= 1
                sizes = np.flatnonzero(counts[:f + 1])
                have = counts[sizes]
                counts[j] += 1
                items = None
                if not len(sizes):
                    items = (j,)
                else:
                    least: list[int] = []
                    for s, c in zip(sizes[:3], have[:3]):
                        least += [int(s)] * min(3, int(c))
                    top = int(sizes[-1])
                    if top == f or len(least) < 2 or least[0] + least[1] > f:
                        items = (j, top)
                    elif len(least) < 3 or sum(least[:3]) > f:
                        partner = np.searchsorted(sizes, f - sizes, side="right") - 1
                        same = (partner >= 0) & (sizes[np.maximum(partner, 0)] == sizes) & (have < 2)
                        partner = np.where(same, partner - 1, partner)
                        ok = partner >= 0
                        pair = int((sizes[ok] + sizes[partner[ok]]).max()) if ok.any() else 0
                        if top >= pair:
                            items = (j, top)
                        else:
                            i = len(sizes) - 1
                            if partner[i] >= 0:
                                b = int(sizes[partner[i]])
                                if not ((sizes > b) & (sizes <= f // 2)).any():
                                    items = (j, top, b)
                if items is None or min(int(counts[s]) // items.count(s) for s in items) == 0:
                    break
                fix(items)
                again = True
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best-fit decreasing over counts: an item goes where the least space is
    left; sequences with the same content are one group with a multiplicity."""
    open_: dict[int, list[list]] = defaultdict(list)   # space left -> [times, pattern]
    for s in range(capacity, 0, -1):
        c = int(counts[s])
        while c:
            space = min((r for r, g in open_.items() if g and r >= s), default=None)
            times, pattern = open_[space].pop() if space is not None else (c, {})
            space = capacity if space is None else space
            fits = space // s
            full = min(times, c // fits)
            if full:
                open_[space - fits * s].append([full, {**pattern, s: fits}])
                c -= full * fits
            left = times - full
            if left and 0 < c < fits:
                open_[space - c * s].append([1, {**pattern, s: c}])
                c, left = 0, left - 1
            if left and pattern:
                open_[space].append([left, pattern])
    return [(t, p) for groups in open_.values() for t, p in groups]


def pack_plan(counts: np.ndarray, capacity: int) -> tuple[list[tuple], int]:
    """Rows (length, first, items, each, sequence, offset): items number ``first``
    and on of a length go ``each`` to a sequence, from ``offset`` on."""
    work = counts.copy()
    patterns = reduce_by_dominance(work, capacity)
    patterns += best_fit(work, capacity)
    given: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for times, pattern in patterns:
        offset = 0
        for s, q in sorted(pattern.items(), reverse=True):
            rows.append((int(s), given[s], q * times, q, sequence, offset))
            given[s] += q * times
            offset += s * q
        sequence += times
    return rows, sequence


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Contract columns of every piece; ``sequence_id`` from 0 without gaps."""
    spark = docs.sparkSession
    pieces = spill(token_pieces(docs, capacity, vocabulary), "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in pieces.groupBy("length").count().collect():   # at most `capacity` rows
        counts[length] = n
    plan, _ = pack_plan(counts, capacity)
    plan_df = spark.createDataFrame(plan, "l long, first long, items long, each long, sequence long, place long")
    if len(plan) <= BROADCAST_PLAN_ROWS:
        plan_df = F.broadcast(plan_df)
    ranges = max(1, math.isqrt(int(counts.sum())))
    item = pieces.withColumn("range", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(ranges)))
    sizes = item.groupBy("length", "range").count()
    before = F.sum("count").over(W.partitionBy("length").orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select(F.col("length").alias("sl"), F.col("range").alias("sr"), F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("length", "range").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = item.withColumn("j", inside).join(sizes, (F.col("length") == F.col("sl")) & (F.col("range") == F.col("sr")))
    ranked = ranked.withColumn("j", F.col("j") - 1 + F.col("before"))
    placed = ranked.join(plan_df, (F.col("length") == F.col("l")) & (F.col("j") >= F.col("first")) & (F.col("j") < F.col("first") + F.col("items")))
    k = F.col("j") - F.col("first")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("sequence") + F.floor(k / F.col("each"))).cast("long").alias("sequence_id"),
                         (F.col("place") + (k % F.col("each")) * F.col("length")).cast("long").alias("offset"))
