"""Cross-tokenizer alignment by pointer jumping over overlapping tokens.

Two tokenizers cut the same bytes; byte offsets where tokens of both end cut the
tokens into groups.  Every token points to the token of the other side that
overlaps it and reaches farthest right (a token that no other outreaches points to
itself), and doubling the successors, all tokens of a block of texts at once, ends
at the last token of each group after as many steps as the logarithm of the longest
chain.  That token labels the group.

Texts are handled in blocks of about ``BLOCK_BYTES`` (a longer text is a block of
its own).  A block is one row: its texts' ids, compressed, and its distinct linked
id pairs with their numbers of links.  These are summed over the corpus, and the
sums come back to the block by a join and a co-group on the block.  So no task holds
more than a block at a time, and a pair that every block holds costs one row a block.

Defined results: texts that are null or empty, or that a tokenizer does not give
back byte for byte, have no tokens and zeros; strings of special tokens are plain
text; repeated rows each count and each get a row; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from array import array
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import slices, spill
from parcelle.llm.packing import make_encoder

VOCABULARY_A = "byte_bpe_50k"
VOCABULARY_B = "piece_bpe_32k"
BLOCK_BYTES = 1 << 21
BLOCK = "block long, doc_id array<long>, n_a array<int>, n_b array<int>, ids binary, pair array<long>, n array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def entry_bytes_a(vocabulary: str = VOCABULARY_A) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary: its entries write each byte as
    a printable character, the unprintable ones moved past 255 in order."""
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = sorted(set(range(256)) - set(plain))
    byte = {b: b for b in plain} | {256 + i: b for i, b in enumerate(moved)}
    vocab = Tokenizer.from_file(public_tokenizers.path(vocabulary + ".json")).get_vocab()
    out = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        out[i] = piece.translate(byte).encode("latin-1")
    return out


def load_b(vocabulary: str = VOCABULARY_B):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary + ".model"))


def entry_bytes_b(vocabulary: str = VOCABULARY_B) -> list[bytes]:
    sp = load_b(vocabulary)
    return [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(sp.id_to_piece(list(range(sp.get_piece_size()))))]


class Lengths:
    """Bytes of every id of both vocabularies, and what follows from their sizes."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        self.a, self.b = (np.array([len(x) for x in v], dtype=np.int64) for v in (a, b))
        self.code = "H" if max(len(a), len(b)) <= 1 << 16 else "I"

    def ends(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(self.a[x]), np.cumsum(self.b[y])

    def pairs(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """One number for each pair of an A and a B id."""
        return x * len(self.b) + y


def group_labels(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For tokens that tile the same bytes (ends ascending): the last B token of
    each A token's group and of each B token's group."""
    n = len(a_end)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    reach = np.searchsorted(b_end, a_end)              # the B token that reaches an A token's end or beyond
    back = np.searchsorted(a_end, b_end)
    succ = np.concatenate((n + reach, np.where(a_end[back] > b_end, back, n + np.arange(len(b_end)))))
    while True:
        twice = succ[succ]
        if np.array_equal(twice, succ):
            return succ[:n] - n, succ[n:] - n
        succ = twice


def links_of(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping pairs (A place, B place), in A's order."""
    if not len(a_end):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a_start = np.concatenate(([0], a_end[:-1]))
    lo = np.searchsorted(b_end, a_start, side="right")
    many = np.searchsorted(b_end, a_end) - lo + 1
    first = np.cumsum(many) - many
    return np.repeat(np.arange(len(a_end)), many), np.arange(int(many.sum())) + np.repeat(lo - first, many)


def encode_blocks(docs: DataFrame, a: str = VOCABULARY_A, b: str = VOCABULARY_B, text: str = "text") -> DataFrame:
    """A row a block: ids of its documents, their numbers of tokens, all A ids and
    all B ids (compressed), and how many links hold each linked id pair."""

    def run(batches):
        bytes_a, bytes_b, encode, sp = entry_bytes_a(a), entry_bytes_b(b), make_encoder(a), load_b(b)
        size = Lengths(bytes_a, bytes_b)
        block = TaskContext.get().partitionId() << 33
        for whole in batches:
            for part in slices(whole, 1, BLOCK_BYTES):
                texts = [t or "" for t in part.column(1).to_pylist()]
                n, ids = ([], []), (array(size.code), array(size.code))
                for t, y in zip(texts, sp.encode(texts, num_threads=1)):
                    x, data = (encode(" " + t), (" " + t).encode()) if t else ([], b"")
                    if b"".join(map(bytes_b.__getitem__, y)) != data or b"".join(map(bytes_a.__getitem__, x)) != data:
                        x, y = [], []
                    for side, more in enumerate((x, y)):
                        ids[side].extend(more)
                        n[side].append(len(more))
                x, y = (np.frombuffer(v, size.code).astype(np.int64) for v in ids)
                i, j = links_of(*size.ends(x, y))
                pair, times = np.unique(size.pairs(x[i], y[j]), return_counts=True)
                packed = pa.Codec("zstd", compression_level=3).compress(ids[0].tobytes() + ids[1].tobytes(), asbytes=True)
                lists = [(part.column(0).to_pylist(), pa.int64()), (n[0], pa.int32()), (n[1], pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), *(pa.array([v], pa.list_(t)) for v, t in lists), pa.array([packed], pa.binary()),
                     *(pa.array([v.astype(np.int64)], pa.list_(pa.int64())) for v in (pair, times))],
                    names=["block", "doc_id", "n_a", "n_b", "ids", "pair", "n"])
                block += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t")).mapInArrow(run, BLOCK)


def _ends_last(label: np.ndarray) -> np.ndarray:
    return np.concatenate((label[1:] != label[:-1], [True])) if len(label) else np.empty(0, bool)


def _sums(values: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """Sums of stretches of ``values`` that end before the places ``upto``."""
    run = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[upto]
    return np.diff(run, prepend=0)


class Writer:
    """Groups of tokens as text, as arrays of bytes: a row of decimal digits and a
    mark for each id and each mark that may follow it."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        said = [f"{i}{c}".encode() for c in ",|" for i in range(n_a)] + [f"{i}{c}".encode() for c in (",", ";", "") for i in range(n_b)]
        self.width = np.array([len(x) for x in said])
        wide = int(self.width.max())
        self.bytes = np.frombuffer(b"".join(x.ljust(wide, b"\0") for x in said), np.uint8).reshape(-1, wide)
        self.used = np.arange(wide) < self.width[:, None]

    def write(self, x, y, la, lb, upto_x, upto_y) -> list[bytes]:
        """A text's groups: in each the A ids, then the B ids."""
        last = np.zeros(len(y), bool)
        last[upto_y[np.diff(upto_y, prepend=0) > 0] - 1] = True
        code = np.empty(len(x) + len(y), np.int64)
        code[np.arange(len(x)) + np.searchsorted(lb, la)] = x + _ends_last(la) * self.n_a
        code[np.arange(len(y)) + np.searchsorted(la, lb, side="right")] = y + 2 * self.n_a + np.where(last, 2, _ends_last(lb)) * self.n_b
        text = self.bytes[code][self.used[code]].tobytes()
        stop = np.concatenate(([0], np.cumsum(self.width[code])))[upto_x + upto_y].tolist()
        return [text[lo:hi] for lo, hi in zip([0, *stop], stop)]


def align(docs: DataFrame, a: str = VOCABULARY_A, b: str = VOCABULARY_B, text: str = "text", digest: bool = False) -> DataFrame:
    """Per document: token counts, groups, links, how many links hold their B id's
    most frequent pair, the sum of the links' corpus-wide counts, and the groups
    themselves as text (`a1,a2|b1;a3|b2,b3`; with ``digest`` its SHA-256, '' for
    documents without tokens)."""
    size = Lengths(entry_bytes_a(a), entry_bytes_b(b))
    n_b = len(size.b)
    blocks = spill(encode_blocks(docs, a, b, text), "align-blocks")
    pairs = blocks.select("block", F.inline(F.arrays_zip("pair", "n")))
    counts = spill(pairs.groupBy("pair").agg(F.sum("n").alias("total")), "align-counts")
    most = counts.groupBy((F.col("pair") % n_b).alias("b_id")).agg(F.max("total").alias("most"))   # a row an id of B at most
    best = counts.join(F.broadcast(most), F.col("pair") % n_b == F.col("b_id")).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    known = pairs.select(F.col("block").alias("holder"), "pair").join(best, "pair").select("holder", "pair", "total", "best")
    writers: list[Writer] = []

    def run(block: pa.Table, seen: pa.Table) -> pa.Table:
        if not writers:
            writers.append(Writer(len(size.a), n_b))
        doc, n_x, n_y = (block.column(c).combine_chunks().flatten() for c in ("doc_id", "n_a", "n_b"))
        upto_x, upto_y = (np.cumsum(v.to_numpy(), dtype=np.int64) for v in (n_x, n_y))
        n = int(upto_x[-1])
        kind = np.dtype(size.code)
        ids = pa.Codec("zstd").decompress(block.column("ids")[0].as_buffer(), (n + int(upto_y[-1])) * kind.itemsize)
        ids = np.frombuffer(ids, kind).astype(np.int64)
        x, y = ids[:n], ids[n:]
        a_end, b_end = size.ends(x, y)
        la, lb = group_labels(a_end, b_end)
        i, j = links_of(a_end, b_end)
        upto_links = np.searchsorted(i, upto_x)
        pair = seen.column("pair").to_numpy()
        order = np.argsort(pair)
        at = order[np.searchsorted(pair[order], size.pairs(x[i], y[j]))]
        total, best_of = seen.column("total").to_numpy()[at], seen.column("best").to_numpy()[at]
        said = writers[0].write(x, y, la, lb, upto_x, upto_y)
        said = [sha256(g).hexdigest() if g else "" for g in said] if digest else [g.decode() for g in said]
        return pa.table([doc, *(pa.array(v, pa.int64()) for v in (
            n_x.to_numpy(), n_y.to_numpy(), _sums(_ends_last(lb), upto_y), np.diff(upto_links, prepend=0),
            _sums(best_of, upto_links), _sums(total, upto_links))), pa.array(said, pa.string())],
            names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    block = blocks.select("block", "doc_id", "n_a", "n_b", "ids")
    return block.groupBy("block").cogroup(known.groupBy("holder")).applyInArrow(run, RESULT)


def alignment_digests(docs: DataFrame) -> DataFrame:
    """Contract columns."""
    return align(docs, digest=True).withColumnRenamed("groups", "groups_sha256")
