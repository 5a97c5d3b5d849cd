"""Periodic runs of words: Baier grouping, Lyndon roots, extension into runs.

Phase one of Baier's suffix sorter puts the places of a text into groups of equal
longest Lyndon word.  Done under an order of the words and under its reverse, it
gives both Lyndon arrays directly (no suffix array).  A run of exponent e holds,
under one of the two orders, e - 1 or more neighbouring copies of its Lyndon root,
all in one group; every such chain of copies is extended to both sides by its
longest common extensions, and that is the run (Bannai et al., "runs theorem").

Before that, a lemma leaves out words that no wanted run can hold: in a run of
exponent e (an integer, 3 or more) every window of three words occurs e - 1 times
or more, so a text is cut where a window is rarer within its part, until nothing
changes.  Runs lie whole inside the parts that remain, which are exactly those
that are grouped.

A text is one row of one task and nothing is shuffled: work and memory are linear
in it (its words as integers; sorting windows costs a logarithm more).

Defined results: null, empty and blank texts have no words and no runs; a text of
any length is taken whole; repeated rows each give a row; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import WS_CLASS, slices

MIN_WORDS = 6
MIN_EXPONENT = 4
RUNS = "array<struct<start:long,length:long,period:long>>"


def lyndon_groups(seq: list[int], reverse: bool = False) -> tuple[list[int], list[int]]:
    """(length of the longest Lyndon word that starts at each place, its group);
    places share a group where that word is the same.  Linear time.

    Groups start as the places of one letter.  From the highest group down, each
    of its places finds the nearest place to the left in a lower group: that
    place's Lyndon word goes on with this group's, once for each such finder, and
    it moves into a new group right above its old one (more finders, higher).
    Places of finished groups are unlinked from the text, so the nearest lower
    place is always the left neighbour; all lists stay in text order."""
    n = len(seq)
    first: dict[int, list[int]] = {}
    for i, c in enumerate(seq):
        first.setdefault(c, []).append(i)
    letters = sorted(first, reverse=reverse)
    members = [first[c] for c in letters]
    k = len(members)
    length = [1] * k
    below, above = list(range(-1, k - 1)), list(range(1, k)) + [-1]
    number = {c: g for g, c in enumerate(letters)}
    group = [number[c] for c in seq]
    left, right = list(range(-1, n)), list(range(1, n + 2))
    g = k - 1
    while g >= 0:
        size = length[g]
        moved: dict[tuple[int, int], list[int]] = {}
        last, hits = -1, 0
        for i in members[g]:
            if group[i] != g:
                continue
            a, b = left[i], right[i]
            left[b] = a
            if a < 0:
                continue
            right[a] = b
            if a == last:
                hits += 1
            else:
                if last >= 0:
                    moved.setdefault((hits, group[last]), []).append(last)
                last, hits = a, 1
        if last >= 0:
            moved.setdefault((hits, group[last]), []).append(last)
        for key in sorted(moved, reverse=True):
            old, new, places, up = key[1], len(members), moved[key], above[key[1]]
            members.append(places)
            length.append(length[old] + key[0] * size)
            below.append(old)
            above.append(up)
            above[old] = new
            below[up] = new
            for p in places:
                group[p] = new
        g = below[g]
    return [length[x] for x in group], group


def repeat_parts(ids: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int]]:
    """Parts (start, end) of at least ``min_words`` words in which every window of
    three words occurs as often as a wanted run would have it."""
    need = min(min_exponent - 1, max(min_words, min_exponent) - 2)
    done, todo = [], [(0, len(ids))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < min_words:
            continue
        part = ids[lo:hi].astype(np.int64)
        top = int(part.max()) + 1
        pair = part[:-1] * top + part[1:]
        if top >= 1 << 20:
            pair = np.unique(pair, return_inverse=True)[1]
        _, where, times = np.unique(pair[:-1] * top + part[2:], return_inverse=True, return_counts=True)
        fine = np.concatenate(([False], times[where] >= need, [False]))
        edge = np.flatnonzero(fine[1:] != fine[:-1])
        found = [(lo + int(a), lo + int(b) + 2) for a, b in zip(edge[0::2], edge[1::2])]
        if found == [(lo, hi)]:
            done.append((lo, hi))
        else:
            todo += found
    return sorted(done)


def runs_of(seq: list[int], min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> set[tuple[int, int, int]]:
    """All runs (start, length, smallest period) of ``seq`` with at least
    ``min_words`` words and ``min_exponent`` periods."""
    n, found = len(seq), set()
    for reverse in (False, True):
        length, group = lyndon_groups(seq, reverse)
        lam, grp = np.array(length), np.array(group)
        at = np.arange(n)
        after, before = at + lam, at - lam
        again = (after < n) & (grp[np.minimum(after, n - 1)] == grp)
        again &= ~((before >= 0) & (grp[np.maximum(before, 0)] == grp))     # the first copy of a chain
        for f in np.flatnonzero(again).tolist():
            p, g, e = length[f], group[f], f + length[f]
            while e < n and group[e] == g:
                e += p
            if e - f < (min_exponent - 1) * p:
                continue
            s = f
            while s and seq[s - 1] == seq[s - 1 + p]:
                s -= 1
            while e < n and seq[e] == seq[e - p]:
                e += 1
            if e - s >= max(min_words, min_exponent * p):
                found.add((s, e - s, p))
    return found


def text_runs(words: list[bytes], min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """Runs of a list of words, by start, then period."""
    n = len(words)
    if n < min_words:
        return []
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, n)
    found = [(lo + s, m, p) for lo, hi in repeat_parts(ids, min_words, min_exponent)
             for s, m, p in runs_of(ids[lo:hi].tolist(), min_words, min_exponent)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds beyond its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for s, m, p in runs:
        drop[s + p] += 1
        drop[s + m] -= 1
    gone = np.cumsum(drop)[:-1].tolist()
    return b" ".join([w for w, d in zip(words, gone) if not d])


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT, text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): every run of each text by start, then
    period, and the text with each run cut down to its first period."""
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")
    shape = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches):
        for whole in batches:
            for b in slices(whole, 1):
                n_words, runs, left = [], [], []
                for t in b.column(1).cast(pa.binary()).to_pylist():
                    words = (t or b"").split()      # bytes split at the six ASCII white spaces
                    found = text_runs(words, min_words, min_exponent)
                    n_words.append(len(words))
                    runs.append([{"start": s, "length": m, "period": p} for s, m, p in found])
                    left.append(collapse(words, found))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n_words, pa.int64()), pa.array(runs, shape), pa.array(left, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t")).mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def repeat_endings(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one text in ten ends in a repetition.  With h = crc32 of the
    decimal id and g = h // 10, where h is divisible by 10 each word i >= a = g % n
    becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8); without an id a
    text stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    plain = F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    long = (F.col("h") % 10 == 0) & (plain != "")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), h.alias("h"))
    d = d.select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), F.when(long, F.split(plain, WS_CLASS + "+")).alias("w"))
    n = F.size("w")
    d = d.select("doc_id", "text", "g", "w", F.when(n > 0, F.col("g") % n).alias("a"))
    d = d.select("doc_id", "text", "w", "a", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    place = F.transform(F.sequence(F.lit(0).cast("long"), (n - 1).cast("long")),
                        lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    words = F.transform(place, lambda i: F.get(F.col("w"), i.cast("int")))
    return d.select("doc_id", F.when(F.col("w").isNotNull(), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Contract columns out of ``find_runs``: the longest run (ties: smallest
    start, then period) and digests of all runs and of the collapsed text."""
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    d = found.withColumn("top", top)
    return d.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"), F.floor(1000 * F.col("top.length") / -F.col("top.p")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
