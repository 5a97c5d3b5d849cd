"""Toxicity grades by cumulative-link ordinal regression.

P(grade <= k) = sigmoid(theta_k - w.x) with one weight vector for all ordered
thresholds; the score is the expected grade, the sum of P(grade >= k).  Features
are the distinct words of the whole text (letters and digits, A-Z lower-cased,
as 64-bit hashes), each scaled by its log odds between graded and ungraded
documents.  The model is fitted with numpy on a bounded sample of labelled
documents: at most ``SAMPLE_PER_CLASS`` of each class (smallest id hashes), class
weights undoing the imbalance; it keeps at most ``MAX_FEATURES`` words.  All
documents are then scored in one pass without a shuffle.

The labels say toxic or not.  ``graded_sample`` splits the toxic ones by the
number of distinct marker words (words whose share differs significantly), which
gives the ordered grades 0, 1 and 2; any other integer grades can be passed.

Defined results: null or blank text has no features and gets the model's base
score; labels that are null, or without a document, are ignored, of several
labels of a document the highest counts, of several texts under one labelled id the last
in byte order trains (all are scored); without both classes in the sample
every score is 0; repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import hash_sample, in_chunks, spill, word_hashes

SAMPLE_PER_CLASS = 2500
MAX_FEATURES = 50_000
MIN_Z = 4.0          # significance of a word's difference in share
MIN_DOCS = 3         # sample documents that hold it
ITERATIONS = 200
L2 = 1e-3
FLAG_AT = 0.5        # P(grade >= 1)


def _features(texts: list[bytes]) -> list[np.ndarray]:
    out = []
    for lo, hi in in_chunks(texts):
        h, at = word_hashes(texts[lo:hi], letters_only=True)
        out += [np.unique(h[at[i]:at[i + 1]]) for i in range(hi - lo)]
    return out


def word_statistics(docs: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, log odds) of the words whose share differs significantly between
    the classes, the most significant ``MAX_FEATURES``, sorted by hash."""
    words, inv = np.unique(np.concatenate(docs), return_inverse=True) if docs else (np.empty(0, np.uint64), np.empty(0, np.int64))
    owner = np.repeat(toxic, [len(d) for d in docs])
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    c1 = np.bincount(inv[owner], minlength=len(words))
    c0 = np.bincount(inv[~owner], minlength=len(words))
    p1, p0, p = c1 / n1, c0 / n0, (c1 + c0) / (n1 + n0)
    z = (p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    keep = np.flatnonzero((np.abs(z) >= MIN_Z) & (c1 + c0 >= MIN_DOCS))
    keep = np.sort(keep[np.argsort(-np.abs(z[keep]), kind="stable")][:MAX_FEATURES])
    odds = np.log((c1 + 0.5) / (n1 - c1 + 0.5)) - np.log((c0 + 0.5) / (n0 - c0 + 0.5))
    return words[keep], odds[keep]


def _lookup(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places in ``words`` of the hashes that are there."""
    if not len(words):
        return np.empty(0, np.int64)
    at = np.searchsorted(words, h)
    at[at == len(words)] = 0
    return at[words[at] == h]


def fit_ordinal(rows: list[np.ndarray], scale: np.ndarray, grades: np.ndarray, weight: np.ndarray,
                iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds by Adam on the weighted likelihood.
    ``rows``: feature places of each document; a feature's value is ``scale``.
    Thresholds are theta_0 and the logarithms of the steps between them."""
    k = int(grades.max())
    owner, idx = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows) if rows else np.empty(0, np.int64)
    v = np.full(len(scale), 0.1)
    theta = np.concatenate(([0.0], np.zeros(k - 1)))
    m, s, total = np.zeros(len(v) + k), np.zeros(len(v) + k), weight.sum()
    for step in range(1, iterations + 1):
        score = np.bincount(owner, (v * scale)[idx], minlength=len(rows))
        cut = theta[0] + np.concatenate(([0.0], np.cumsum(np.exp(theta[1:]))))
        f = 1 / (1 + np.exp(-np.clip(cut[None, :] - score[:, None], -35, 35)))       # P(grade <= j)
        full = np.concatenate((np.zeros((len(rows), 1)), f, np.ones((len(rows), 1))), 1)
        slope = np.concatenate((np.zeros((len(rows), 1)), f * (1 - f), np.zeros((len(rows), 1))), 1)
        i = np.arange(len(rows))
        p = np.maximum(full[i, grades + 1] - full[i, grades], 1e-9)
        hi, lo = slope[i, grades + 1] / p, slope[i, grades] / p
        g_score = weight * (hi - lo) / total
        g_cut = np.zeros(k)
        np.add.at(g_cut, np.minimum(grades, k - 1), np.where(grades < k, -weight * hi, 0) / total)
        np.add.at(g_cut, np.maximum(grades - 1, 0), np.where(grades > 0, weight * lo, 0) / total)
        g_v = np.bincount(idx, g_score[owner], minlength=len(v)) * scale + L2 * v
        tail = np.cumsum(g_cut[::-1])[::-1]
        g_t = np.concatenate(([tail[0]], np.exp(theta[1:]) * tail[1:]))
        g = np.concatenate((g_v, g_t))
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        v, theta = v - move[:len(v)], theta - move[len(v):]
    return v * scale, theta[0] + np.concatenate(([0.0], np.cumsum(np.exp(theta[1:]))))


def grades_of(docs: list[np.ndarray], toxic: np.ndarray, words: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """0 for clean documents; of the toxic ones 2 where they hold more distinct
    marker words than their median, else 1."""
    marks = words[odds > 0]
    hits = np.array([len(_lookup(marks, d)) for d in docs])
    if not toxic.any():
        return np.zeros(len(docs), np.int64)
    return np.where(~toxic, 0, np.where(hits > np.median(hits[toxic]), 2, 1))


def train(docs: list[np.ndarray], toxic: np.ndarray, prior: float) -> dict | None:
    """``prior``: the share of toxic documents among all labels."""
    if not toxic.any() or toxic.all():
        return None
    words, odds = word_statistics(docs, toxic)
    grade = grades_of(docs, toxic, words, odds)
    if grade.max() < 1:
        return None
    weight = np.where(toxic, prior / toxic.mean(), (1 - prior) / (1 - toxic.mean()))
    w, cut = fit_ordinal([_lookup(words, d) for d in docs], odds, grade, weight)
    return {"words": words, "weights": w, "cuts": cut}


def score(model: dict, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and P(grade >= 1)."""
    s = np.array([model["weights"][_lookup(model["words"], d)].sum() for d in docs])
    above = 1 - 1 / (1 + np.exp(-np.clip(model["cuts"][None, :] - s[:, None], -35, 35)))
    return above.sum(1), above[:, 0] if len(s) else np.empty(0)


def _texts(batch, i: int) -> list[bytes]:
    return [x or b"" for x in batch.column(i).cast(pa.binary()).to_pylist()]


def graded_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[list[np.ndarray], np.ndarray, float]:
    """Word sets and classes of the bounded sample, and the share of toxic documents
    among those with a label."""
    one = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    # labels of documents that are there, one a document id
    one = spill(docs.select("doc_id").join(one, "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    n, n1 = one.agg(F.count("*"), F.sum(F.col("toxic").cast("int"))).first()
    picked = [hash_sample(one.where(c), per_class, k, "doc_id") for c, k in (("toxic", n1 or 0), ("NOT toxic", n - (n1 or 0)))]
    few = F.broadcast(picked[0].union(picked[1]))       # at most 2 per_class ids

    def run(batches):
        for b in batches:
            f = _features(_texts(b, 0))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in f], pa.binary()), b.column(1)], names=["words", "toxic"])

    texts = docs.select("doc_id", "text").join(few, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
    got = texts.select("text", "toxic").mapInArrow(run, "words binary, toxic boolean").toArrow()      # a row an id
    rows = [np.frombuffer(x.as_py(), np.uint64) for x in got.column("words")]
    order = sorted(range(len(rows)), key=lambda i: (rows[i].tobytes()))     # the fit doesn't depend on arrival
    toxic = np.array(got.column("toxic").to_pylist(), bool)
    return [rows[i] for i in order], toxic[order] if len(order) else toxic, (n1 or 0) / max(1, n)


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, severity, p_toxic, toxic) of every row of ``docs``."""
    model = train(*graded_sample(docs, labels, per_class))

    def run(batches):
        for b in batches:
            if model:
                f = _features(_texts(b, 1))
                sev, p = score(model, f)
            else:
                sev = p = np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sev, pa.float64()), pa.array(p, pa.float64()), pa.array(p >= FLAG_AT)],
                                             names=["doc_id", "severity", "p_toxic", "toxic"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, severity double, p_toxic double, toxic boolean")
