"""Exact Jaccard self-join on word shingles, with set-relation skipping.

A document is the set of its distinct 5-word shingles.  Two documents link when
their sets' Jaccard similarity reaches the threshold; documents fall into the
connected components of the links.

1. Sets.  One pass over the texts gives each set's size and 128-bit fingerprint
   and counts all shingles into 2^22 cells.  Equal sets are one class from here.
2. Index.  All sets are ordered by (cell count, hash), rare first.  Similar sets
   share one of their first n - ceil(t n) + 1 shingles, so only those enter the
   index lists.  A member's position says how much overlap is still possible:
   pairs, and in long lists whole blocks, that cannot reach it are skipped.
3. Answers by relation.  In a long list the members are compared with a few
   pivots at a time, those first that stand in most lists (linear in the list).
   The answers for the rest are derived from the pivots': members in one component
   are connected already and need no comparison; as Jaccard distance is a metric,
   members whose distances to a pivot differ by more than 1 - t cannot link.
   Rounds go on with new pivots, four times as many each time, until what is left is
   linear in the list and is compared pair by pair.  What a round holds of a list
   is linear in its members: distances to the pivots of the first ``_KEEP`` rounds
   and, of the later pivots, only that all their open pairs were asked for.
4. Links are verified on whole sets; components are computed in Spark.

The result is exact: cells and positions steer the order, never what links
(64-bit shingle hashes and 128-bit set fingerprints stand for their values; a class
goes by the first half of its fingerprint, and where two classes share that half, by
a number made of both).
A list is as long as the number of different sets that hold a rare shingle;
copies enter it at most once per input partition.

Defined results: null or blank text is the empty set, linked with nothing;
with fewer than 5 words the whole sequence is the one shingle; repeated rows
link with each other; rows that share an id but not their text are documents of
their own in ``keep_one``; an empty table gives an empty result; further columns
pass through in ``keep_one``.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import components, in_chunks, mix64, slices, small_batches, spill, word_hashes

WORDS = 5
THRESHOLD = 80          # percent
CELL_BITS = 22
_CHUNK_BITS = 16
BUCKET_ROWS = 400_000   # index entries a bucket, about
_FLUSH = 800_000      # index entries a task holds before it deals them out
_BLOCK = 64             # members of a list that are skipped together
PIVOTS = 8              # new pivots of a list in the first round
_GROWTH = 2             # each round has 2^_GROWTH times the pivots of the one before
_KEEP = 2               # rounds whose pivots' distances are kept
_ROUND_PAIRS = 1 << 21  # pairs of a list in a round, about (16 a member in longer lists)
_OPEN_EACH = 4          # open pairs a member that are compared one by one
BLOOM_BITS = 23

_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, joined, and their offsets."""
    h, at = word_hashes(texts)
    n = np.diff(at)
    steps = _STEP if words == WORDS else [mix64(np.array([k + 1], np.uint64))[0] | np.uint64(1) for k in range(words)]
    total = len(h)
    if total >= words:
        s = np.zeros(total - words + 1, np.uint64)
        for k in range(words):
            s += mix64(h[k:total - words + 1 + k] ^ steps[k]) * steps[k]
        s = mix64(s)
    else:
        s = np.empty(0, np.uint64)
    out, sizes = [], np.zeros(len(texts), np.int64)
    for i in range(len(texts)):
        a, b = at[i], at[i + 1]
        if n[i] >= words:
            u = np.sort(s[a:b - words + 1])
            u = u[np.concatenate(([True], u[1:] != u[:-1]))]
        elif n[i]:
            u = np.zeros(1, np.uint64)
            for k in range(n[i]):
                u = mix64(u * steps[k % len(steps)] + h[a + k])
            u = mix64(u + np.uint64(n[i]))
        else:
            continue
        out.append(u)
        sizes[i] = len(u)
    tokens = np.concatenate(out) if out else np.empty(0, np.uint64)
    return tokens, np.concatenate(([0], np.cumsum(sizes)))


def _fingerprints(tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(at)
    full = np.flatnonzero(n)
    fa, fb = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    if len(full):
        fa[full] = np.add.reduceat(mix64(tokens ^ np.uint64(0xA0761D6478BD642F)), at[full])
        fb[full] = np.add.reduceat(mix64(tokens * np.uint64(0xE7037ED1A0B428DB) + np.uint64(0x8EBC6AF09C88C6E3)), at[full])
    return fa, fb


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _texts(batch) -> list[bytes]:
    col = batch.column(1)
    col = col.cast(pa.large_binary()) if not pa.types.is_large_binary(col.type) else col
    return [x or b"" for x in col.to_pylist()]


def _set_table(docs: DataFrame, words: int) -> DataFrame:
    """Rows of documents (doc_id, n, fa, fb; chunk null) and, from each task, its
    shingle counts by cell (chunk, counts)."""

    def run(batches):
        counts = np.zeros(1 << CELL_BITS, np.uint32)
        for b in (x for whole in batches for x in slices(whole, 1)):
            ids, texts = b.column(0).to_pylist(), _texts(b)
            for lo, hi in in_chunks(texts):
                tokens, at = shingle_sets(texts[lo:hi], words)
                cells, c = np.unique(_cells(tokens), return_counts=True)
                counts[cells] += c.astype(np.uint32)
                fa, fb = _fingerprints(tokens, at)
                m = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi], pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(fa.view(np.int64)),
                     pa.array(fb.view(np.int64)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                    names=["doc_id", "n", "fa", "fb", "chunk", "counts"])
        step = 1 << _CHUNK_BITS
        for i in range(len(counts) // step):
            part = counts[i * step:(i + 1) * step]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64())] * 4 + [pa.array([i], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                    names=["doc_id", "n", "fa", "fb", "chunk", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, fa long, fb long, chunk int, counts binary")


def _levels(counted: DataFrame) -> bytes:
    """One byte a cell: its count over all documents on a log scale.  The size is
    fixed (4 MB), whatever the number of documents."""
    step = 1 << _CHUNK_BITS

    def level(c: np.ndarray) -> bytes:
        return np.minimum(255, 8 * np.log2(c + 1.0)).astype(np.uint8).tobytes()

    sums = (counted.rdd.map(lambda r: (r[0], np.frombuffer(zlib.decompress(r[1]), np.uint32).astype(np.int64)))
            .reduceByKey(lambda a, b: a + b).mapValues(level).collect())
    out = bytearray(1 << CELL_BITS)
    for i, x in sums:
        out[i * step:(i + 1) * step] = x
    return bytes(out)


def _labels(fa: np.ndarray, fb: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Labels of sets by their fingerprints; ``shared`` are the first halves that
    several classes have (sorted)."""
    if not len(shared):
        return fa
    at = np.searchsorted(shared, fa)
    at[at == len(shared)] = 0
    return np.where(shared[at] == fa, mix64(fa + fb * np.uint64(0x9E3779B97F4A7C15)), fa)


def _index(docs: DataFrame, levels, buckets: int, words: int, t: int, shared: np.ndarray) -> DataFrame:
    """(bucket, token, label, n, pos): index entries, packed by task and bucket."""

    def run(batches):
        rank = np.frombuffer(levels.value, np.uint8)
        seen: set[int] = set()
        held: list[tuple] = []
        count = 0

        def deal():
            tok, lab, n, pos = (np.concatenate(x) for x in zip(*held))
            b = (mix64(tok) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(b, kind="stable")
            tok, lab, n, pos, b = tok[order], lab[order], n[order], pos[order], b[order]
            cut = np.concatenate(([0], np.flatnonzero(b[1:] != b[:-1]) + 1, [len(b)]))
            for lo in range(0, len(cut) - 1, 64):
                parts = [(cut[i], cut[i + 1]) for i in range(lo, min(lo + 64, len(cut) - 1))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(b[x]) for x, _ in parts], pa.int64())]
                    + [pa.array([col[x:y].tobytes() for x, y in parts], pa.binary()) for col in (tok, lab, n, pos)],
                    names=["bucket", "token", "label", "n", "pos"])

        for batch in (x for whole in batches for x in slices(whole, 1)):
            texts = _texts(batch)
            for lo, hi in in_chunks(texts):
                tokens, at = shingle_sets(texts[lo:hi], words)
                labels = _labels(*_fingerprints(tokens, at), shared)
                order = (rank[_cells(tokens)].astype(np.uint64) << np.uint64(56)) | (mix64(tokens) >> np.uint64(8))
                for i in range(hi - lo):
                    a, b = at[i], at[i + 1]
                    if a == b or int(labels[i]) in seen:
                        continue
                    seen.add(int(labels[i]))
                    n = int(b - a)
                    p = n - (t * n + 99) // 100 + 1
                    first = np.sort(order[a:b] if p * 3 > n else np.partition(order[a:b], p - 1)[:p])[:p]
                    held.append((first, np.full(p, labels[i]), np.full(p, n, np.int32), np.arange(p, dtype=np.int32)))
                    count += p
                if count > _FLUSH:
                    yield from deal()
                    held, count = [], 0
        if held:
            yield from deal()

    return docs.mapInArrow(run, "bucket long, token binary, label binary, n binary, pos binary")


def _can_link(nx, px, ny, py, t: int):
    """Could sets of these sizes link whose first common shingle has these positions?"""
    small, large = np.minimum(nx, ny), np.maximum(nx, ny)
    return (100 * small >= t * large) & ((100 + t) * np.minimum(nx - px, ny - py) >= t * (nx + ny))


def _walk_bucket(t: int):
    """Lists of one bucket -> pairs to compare (a, b) and lists of three or more
    members (list_id, members); equal lists of a bucket once."""

    def run(table: pa.Table) -> pa.Table:
        cols = [np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(c)])
                for c, kind in (("token", np.uint64), ("label", np.uint64), ("n", np.int32), ("pos", np.int32))]
        order = np.lexsort((cols[1], cols[0]))
        tok, lab, n, pos = (c[order] for c in cols)
        fresh = np.concatenate(([True], (tok[1:] != tok[:-1]) | (lab[1:] != lab[:-1])))
        tok, lab, n, pos = tok[fresh], lab[fresh], n[fresh].astype(np.int64), pos[fresh].astype(np.int64)
        start = np.concatenate(([0], np.flatnonzero(tok[1:] != tok[:-1]) + 1))
        size = np.diff(np.concatenate((start, [len(tok)])))
        two = start[size == 2]
        two = two[_can_link(n[two], pos[two], n[two + 1], pos[two + 1], t)]
        pairs = [np.stack((lab[two], lab[two + 1]), 1)]
        lists: dict[bytes, bytes] = {}
        for a, m in zip(start[size > 2], size[size > 2]):
            members = _linkable(n[a:a + m], pos[a:a + m], t)
            if not len(members):
                continue
            own = lab[a + members]
            if len(own) == 2:
                pairs.append(own[None, :])
                continue
            key = own.tobytes()
            name = hashlib.blake2b(key, digest_size=16).digest()
            if name not in lists:
                lists[name] = key
        two_cols = np.unique(np.concatenate(pairs), axis=0).view(np.int64)
        k, m = len(two_cols), len(lists)
        got = list(lists.items())
        return pa.table({
            "a": pa.concat_arrays([pa.array(two_cols[:, 0]), pa.nulls(m, pa.int64())]),
            "b": pa.concat_arrays([pa.array(two_cols[:, 1]), pa.nulls(m, pa.int64())]),
            "list_id": pa.concat_arrays([pa.nulls(k, pa.binary()), pa.array([x[0] for x in got], pa.binary())]),
            "members": pa.concat_arrays([pa.nulls(k, pa.binary()), pa.array([x[1] for x in got], pa.binary())])})

    return run


def _linkable(n: np.ndarray, pos: np.ndarray, t: int) -> np.ndarray:
    """Members of a list (in its order) that could link with another one here.
    Blocks of members, ordered by size, are skipped by their best positions."""
    m = len(n)
    order = np.argsort(n, kind="stable")
    ns, left = n[order], (n - pos)[order]
    hit = np.zeros(m, bool)
    edges = list(range(0, m, _BLOCK))
    for x in edges:
        nx, lx = ns[x:x + _BLOCK], left[x:x + _BLOCK]
        for y in range(x, m, _BLOCK):
            ny, ly = ns[y:y + _BLOCK], left[y:y + _BLOCK]
            if 100 * nx[-1] < t * ny[0]:
                break                       # all later blocks are larger still
            if (100 + t) * min(lx.max(), ly.max()) < t * (nx[0] + ny[0]):
                continue                    # no position in these blocks can reach it
            if hit[x:x + _BLOCK].all() and hit[y:y + _BLOCK].all():
                continue
            ok = (100 * np.minimum(nx[:, None], ny) >= t * np.maximum(nx[:, None], ny)) & (
                (100 + t) * np.minimum(lx[:, None], ly) >= t * (nx[:, None] + ny))
            if x == y:
                np.fill_diagonal(ok, False)
            hit[x:x + _BLOCK] |= ok.any(1)
            hit[y:y + _BLOCK] |= ok.any(0)
    return np.sort(order[hit])


def _next_pairs(t: int, turn: int):
    """Members of a list with their components, and the comparisons made in it so
    far (b null: a was a pivot, all its open pairs were asked for) -> the pairs to
    compare next and the new pivots (list_id, a, b, more)."""

    def run(members: pa.Table, known: pa.Table) -> pa.Table:
        order = np.lexsort((members.column("label").to_numpy(), -members.column("score").to_numpy()))
        label = members.column("label").to_numpy()[order]
        comp, n = members.column("comp").to_numpy()[order], members.column("n").to_numpy()[order]
        size = len(label)
        by_label = np.argsort(label)

        def places(column) -> np.ndarray:
            return by_label[np.searchsorted(label, column.to_numpy(), sorter=by_label)]

        done = np.zeros(size, bool)
        done[places(known.filter(pc.is_null(known.column("b"))).column("a"))] = True
        known = known.filter(pc.is_valid(known.column("d")))
        ka, kb, kd = places(known.column("a")), places(known.column("b")), known.column("d").to_numpy()
        # only members with many comparisons say something about the others: the
        # pivots of the first rounds, so these vectors are few
        pivots = []
        for x in np.flatnonzero((np.bincount(ka, minlength=size) + np.bincount(kb, minlength=size)) * 4 >= size) if len(kd) else ():
            v = np.full(size, np.nan)
            v[kb[ka == x]], v[ka[kb == x]], v[x] = kd[ka == x], kd[kb == x], 0.0
            pivots.append(v)

        def open_pairs(x: int) -> np.ndarray:
            """Which members is member x still to be compared with?"""
            ok = (comp != comp[x]) & ~done & (100 * np.minimum(n, n[x]) >= t * np.maximum(n, n[x]))
            for v in pivots:
                if np.isfinite(v[x]):       # a shade of slack for the rounding of the distances
                    ok &= ~(np.abs(v - v[x]) > (100 - t) / 100 + 1e-9)
            return np.flatnonzero(ok)

        names, counts = np.unique(comp, return_counts=True)
        out, asked, more = [], [], False
        if len(names) > 1:
            # every open pair has a member outside the largest component
            small = np.flatnonzero((comp != names[counts.argmax()]) & ~done)
            before, limit, got = done.copy(), _OPEN_EACH * size, 0
            for x in small:
                y = open_pairs(x)
                done[x] = True              # a pair of two outsiders is met once
                out.append(np.stack((np.full(len(y), x), y), 1))
                got += len(y)
                if got > limit and size > 2 * _OPEN_EACH:
                    more = True
                    break
            if more:
                # new pivots are members with open pairs, those of the best scores first,
                # then the outsiders, so no list ends with pairs open
                done, out, found, got = before, [], 0, 0
                for x in np.concatenate((np.flatnonzero(~done)[:PIVOTS * 2], small)):
                    if found == PIVOTS << min(_GROWTH * turn, 30) or got > max(_ROUND_PAIRS, 16 * size):
                        break
                    if done[x]:
                        continue
                    y = open_pairs(x)
                    done[x] = True
                    asked.append(x)
                    out.append(np.stack((np.full(len(y), x), y), 1))
                    found, got = found + (len(y) > 0), got + len(y)
        p = label[np.concatenate(out)].view(np.uint64) if out else np.empty((0, 2), np.uint64)
        lo, hi = p.min(1).view(np.int64), p.max(1).view(np.int64)
        rows, list_id = len(lo) + len(asked), members.column("list_id")[0].as_py() if size else b""
        return pa.table({"list_id": pa.array([list_id] * rows, pa.binary()), "a": pa.array(np.concatenate((lo, label[asked] if asked else lo[:0]))),
                         "b": pa.concat_arrays([pa.array(hi), pa.nulls(len(asked), pa.int64())]), "more": pa.array([more] * rows, pa.bool_())})

    return run


def _bloom(ids: DataFrame):
    """A bitmap of fixed size (1 MB) that holds every id; it only spares work."""
    def bits(rows):
        m = np.zeros(1 << BLOOM_BITS, bool)
        x = np.array([r[0] for r in rows], np.int64).view(np.uint64)
        for h in (mix64(x), mix64(x ^ np.uint64(0xA0761D6478BD642F))):
            m[(h >> np.uint64(64 - BLOOM_BITS)).astype(np.int64)] = True
        yield np.packbits(m)

    # one bitmap a task of the (compact) id table
    return ids.rdd.mapPartitions(bits).treeReduce(lambda a, b: a | b).tobytes() if ids.take(1) else b""


def _contents(docs: DataFrame, classes: DataFrame, words: int, shared: np.ndarray) -> DataFrame:
    """(label, rep, n, tokens) of the given classes' first documents."""
    spark = docs.sparkSession
    held = _bloom(classes.select("rep"))
    bits = spark.sparkContext.broadcast(held)

    def run(batches):
        m = np.unpackbits(np.frombuffer(bits.value, np.uint8)).astype(bool) if bits.value else None
        for b in (x for whole in batches for x in slices(whole, 1)):
            if m is None:
                continue
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = ids.view(np.uint64)
            hit = np.ones(len(ids), bool)
            for h in (mix64(x), mix64(x ^ np.uint64(0xA0761D6478BD642F))):
                hit &= m[(h >> np.uint64(64 - BLOOM_BITS)).astype(np.int64)]
            if not hit.any():
                continue
            b = b.filter(pa.array(hit))
            ids, texts = ids[hit], _texts(b)
            for lo, hi in in_chunks(texts):
                tokens, at = shingle_sets(texts[lo:hi], words)
                fa, fb = _fingerprints(tokens, at)
                fa = _labels(fa, fb, shared)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi]), pa.array(fa.view(np.int64)), pa.array(fb.view(np.int64)),
                     pa.array([tokens[at[i]:at[i + 1]].tobytes() for i in range(hi - lo)], pa.binary())],
                    names=["rep", "label", "fb", "tokens"])

    got = docs.where("doc_id IS NOT NULL").mapInArrow(run, "rep long, label long, fb long, tokens binary")
    return got.join(classes.select("label", "fb", "rep").hint("merge"), ["label", "fb", "rep"], "left_semi").dropDuplicates(["label", "fb", "rep"]).drop("fb")


def _compare(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """(a, b, ra, rb, na, nb, both): exact intersection sizes of pairs of labels."""
    one = contents.select(F.col("label").alias("a"), F.col("rep").alias("ra"), F.col("tokens").alias("ta"))
    two = contents.select(F.col("label").alias("b"), F.col("rep").alias("rb"), F.col("tokens").alias("tb"))

    def run(batches):
        for batch in batches:
            out = []
            for x, y in zip(batch.column(4), batch.column(5)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                out.append((len(x.as_buffer()) // 8, len(y.as_buffer()) // 8, int((q[at] == p).sum())))
            na, nb, both = (pa.array([o[i] for o in out], pa.int64()) for i in range(3))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(4)] + [na, nb, both], names=["a", "b", "ra", "rb", "na", "nb", "both"])

    joined = pairs.hint("merge").join(one, "a").join(two.hint("merge"), "b").select("a", "b", "ra", "rb", "ta", "tb")
    return joined.mapInArrow(run, "a long, b long, ra long, rb long, na long, nb long, both long")


def similar_components(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    with small_batches(docs.sparkSession):      # every job with Python ends inside
        return _components_of(docs, words, threshold, text)


def _components_of(docs: DataFrame, words: int, threshold: int, text: str) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    table = spill(_set_table(rows, words), "sets")
    sets = table.where("chunk IS NULL").select("doc_id", "n", "fa", "fb")
    levels = spark.sparkContext.broadcast(_levels(table.where("chunk IS NOT NULL").select("chunk", "counts")))
    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total * (100 - threshold) // 100 // BUCKET_ROWS))
    classes = sets.where("n > 0").groupBy("fa", "fb").agg(F.min("doc_id").alias("rep"))
    # of 64-bit halves, equal ones are n * n / 2^65: a handful at 10^10 classes
    twice = classes.groupBy("fa").agg(F.count("*").alias("c")).where("c > 1").select("fa").collect()
    shared = np.sort(np.array([r[0] for r in twice], np.int64).view(np.uint64))
    index = _index(rows, levels, buckets, words, threshold, shared)
    walked = spill(index.groupBy("bucket").applyInArrow(_walk_bucket(threshold), "a long, b long, list_id binary, members binary"), "lists")
    pairs = spill(walked.where("b IS NOT NULL").select("a", "b").distinct(), "pairs")
    label = F.col("fa")
    if len(shared):
        def relabel(batches):
            for b in batches:
                fa, fb = (b.column(i).to_numpy().view(np.uint64) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_labels(fa, fb, shared).view(np.int64))], names=["fa", "fb", "label"])

        several = sets.where(F.col("fa").isin([r[0] for r in twice])).select("fa", "fb").distinct()
        named = several.mapInArrow(relabel, "fa long, fb long, label long")
        classes = classes.join(named, ["fa", "fb"], "left")
        label = F.coalesce("label", "fa")
    classes = classes.where("rep IS NOT NULL").select(label.alias("label"), "fb", "rep", "fa")
    lists = walked.where("b IS NULL").select("list_id", "members").dropDuplicates(["list_id"])

    def unpack(batches):
        for b in batches:
            for i in range(b.num_rows):
                own = np.frombuffer(b.column(1)[i].as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[i].as_py()] * len(own), pa.binary()), pa.array(own)],
                                                 names=["list_id", "label"])

    members = spill(lists.mapInArrow(unpack, "list_id binary, label long"), "members")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("label")).union(members.select("label")).distinct()
    own = spill(classes.drop("fa").join(wanted, "label", "left_semi"), "classes")
    contents = spill(_contents(rows, own, words, shared), "contents")
    compared = spill(_compare(pairs, contents), "compared")
    link = F.expr(f"100 * both >= {threshold} * (na + nb - both)")
    ends = [F.col("ra").alias("u"), F.col("rb").alias("v")]
    links = compared.where(link).select(*ends)
    final = components(links)
    score = members.groupBy("label").agg(F.count("*").alias("score"))
    size = spill(contents.select("label", "rep", (F.length("tokens") / 8).cast("long").alias("n")).join(score, "label"), "sizes")
    active, asked, done = members, None, compared
    for turn in count():
        state = size.join(final, size["rep"] == final["node"], "left").select("label", F.coalesce("component", "rep").alias("comp"), "n", "score")
        state = active.join(state, "label").select("list_id", "label", "comp", "n", "score")
        if asked is None:
            known = spark.createDataFrame([], "list_id binary, a long, b long, d double")
        else:
            d = done.select("a", "b", (1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("d"))
            known = asked.join(d, ["a", "b"], "left").select("list_id", "a", "b", "d")
        step = _next_pairs(threshold, turn)
        new = spill(state.groupBy("list_id").cogroup(known.groupBy("list_id")).applyInArrow(step, "list_id binary, a long, b long, more boolean"), "asked")
        fresh = spill(new.where("b IS NOT NULL").select("a", "b").distinct().join(done.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        if not new.take(1):
            break
        # few sets are met again: only their contents are dealt out
        again = fresh.select(F.explode(F.array("a", "b")).alias("label")).distinct()
        got = spill(_compare(fresh, contents.join(again, "label", "left_semi")), "compared")
        final = components(final.select(F.col("node").alias("u"), F.col("component").alias("v")).union(got.where(link).select(*ends)))
        done = spill(done.union(got), "compared")
        going = new.where("more").select("list_id").distinct()
        if not going.take(1):
            break
        active = spill(active.join(going, "list_id", "left_semi"), "members")
        new = (new if turn < _KEEP else new.where("b IS NULL")).select("list_id", "a", "b")
        asked = new if asked is None else asked.union(new)
        asked = spill(asked.join(going, "list_id", "left_semi").distinct(), "asked")
    reps = sets.where("n > 0").join(classes.drop("label"), ["fa", "fb"], "left")
    reps = reps.join(final, reps["rep"] == final["node"], "left")
    out = reps.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    alone = sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionAll(alone)


def keep_one(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD, text: str = "text") -> DataFrame:
    """One row of each component stays, columns as they were: the one with the
    smallest id (rows without one last), ties by the content of all columns.  Every
    row is a document of its own, whatever its id."""
    rows = spill(docs.withColumn("__k_row", F.monotonically_increasing_id()), "keep")
    found = similar_components(rows.select(F.col("__k_row").alias("doc_id"), F.col(f"`{text}`").alias("text")), words, threshold)
    found = found.select(F.col("doc_id").alias("__k_id"), "component_id")
    each = rows.select("__k_row", F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("id"),
                                           F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("hash"), F.col("__k_row").alias("row")).alias("place"))
    # neither side has a proven bound: dealt out at every size, never broadcast
    first = each.hint("merge").join(found.hint("merge"), F.col("__k_row") == F.col("__k_id")).groupBy("component_id").agg(F.min("place").alias("place"))
    first = spill(first.select(F.col("place.row").alias("__k_row")), "kept")
    return rows.join(first.hint("merge"), "__k_row", "left_semi").drop("__k_row")
