"""Personal data: patterns plus a character BiLSTM-CRF.

Patterns give the base spans.  A small bidirectional LSTM over character classes
with CRF transitions, trained here in numpy on spans labelled by the patterns,
adds spans that the patterns miss (other separators, missing prefix).  It reads
every neighbourhood of a digit or an ``@`` in every whole text, out to the ends of
the runs of address characters (and dots between spaces) at its edges.  The
neighbourhoods are cut into overlapping windows; the windows' decoded spans are
reconciled over the whole neighbourhood (parts cut by a window's edge are joined
with the next window's, an address goes out to the ends of its runs, equal kinds that overlap are joined, and among
rivals the set with the largest total score is kept).

An added span must also hold up as its kind (check digit, parts, digits), so
clean text with numbers stays alone.

Training takes at most ``SAMPLE_DOCS`` documents with spans and as many with
digits but no span (smallest id hashes), and of each ``SAMPLE_REGIONS`` neighbourhoods,
``SAMPLE_CHARS`` characters long; everything else covers all rows and whole texts.

Defined results: null text counts as empty; positions are code points, end
exclusive; repeated rows are judged alike; an empty table, or one without any
base span, trains nothing and returns the base spans; further columns pass
through in ``redact``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import hash_sample, spill

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 200
SAMPLE_REGIONS = 4
SAMPLE_CHARS = 256      # of a training neighbourhood, from its start
CONTEXT = 24      # characters to either side of a digit or @
WINDOW, STRIDE = 64, 32
MIN_PROBABILITY = 0.8
HIDDEN, EMBED = 16, 12
EPOCHS, BATCH, RATE = 8, 48, 0.04
TAGS = 1 + 2 * len(KINDS)   # outside, then begin and inside of each kind

# -- base spans -------------------------------------------------------------
#: Fixed values of the contract.
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_TRIGGER = re.compile(r"[0-9@]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(t: str):
    """Leftmost matches of the address pattern, found from each ``@``: the local
    part is the run before it, back to the end of the last match."""
    end, at = 0, t.find("@")
    while at >= 0:
        a = at
        while a > end and t[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(t, at) if a < at else None
        if m:
            end = m.end()
            yield a, end
        at = t.find("@", max(at + 1, end))


def base_spans(t: str, checked: bool = True) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base kinds, by kind, then start.  Unchecked spans
    (any check digit, any part) are what the model is trained on: it learns a
    kind's shape, and the arithmetic is left to ``plausible``."""
    out = [(0, a, b) for a, b in _emails(t)] if "@" in t else []
    if _TRIGGER.search(t):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(t) if not checked or all(_at_most(p, 255) for p in m[0].split("."))]
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 13:
                d = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(d) <= 19 and (not checked or luhn(d)):
                    out.append((2, m.start(), m.end()))
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(t) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


def _at_most(part: str, most: int) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= most


def _run_start(t: str, a: int, least: int = 0) -> int:
    """Start of the run of address characters that ends before ``a``; a dot
    between spaces does not end it."""
    while a > least:
        if t[a - 1] in _LOCAL:
            a -= 1
            continue
        i = a
        while i > least and t[i - 1] == " ":
            i -= 1
        if i == a or i == least or not (t[i - 1] == "." or t[a:a + 1] == ".") or t[i - 1] not in _LOCAL:
            break
        a = i - 1
    return a


def _run_end(t: str, b: int) -> int:
    """End of the run of address characters from ``b`` on, likewise."""
    while b < len(t):
        if t[b] in _LOCAL:
            b += 1
            continue
        i = b
        while i < len(t) and t[i] == " ":
            i += 1
        if i == b or i == len(t) or not (t[i] == "." or (b and t[b - 1] == ".")) or t[i] not in _LOCAL:
            break
        b = i + 1
    return b


def whole_address(t: str, a: int, b: int) -> tuple[int, int]:
    """A found address out to the ends of its local part and of its host's words."""
    while a > 0 and t[a - 1] in _LOCAL and t[a] in _LOCAL:
        a -= 1
    while b < len(t) and (t[b].isascii() and t[b].isalnum() or t[b] == "-" or (
            t[b] == "." and t[b + 1:b + 2].isascii() and t[b + 1:b + 2].isalnum())):
        b += 1
    return a, b


def regions(t: str) -> list[tuple[int, str]]:
    """(start, text) of the merged neighbourhoods of all digits and ``@``."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(t):
        if out and m.start() + 1 + CONTEXT <= out[-1][1]:
            continue
        a = _run_start(t, max(0, m.start() - CONTEXT), out[-1][1] if out else 0)
        b = _run_end(t, min(len(t), m.start() + 1 + CONTEXT))
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, t[a:b]) for a, b in out]


# -- the model --------------------------------------------------------------
_PUNCT = "@.-_+%() ,:/\n#=*\"'<>[]{}!?;&|$~\\"
N_CLASSES = 6 + len(_PUNCT)


def classes(t: str) -> np.ndarray:
    """Character classes: digits, small letters, capitals, other letters, each
    mark of its own, the rest."""
    table = {c: 6 + i for i, c in enumerate(_PUNCT)}
    return np.array([1 if "0" <= c <= "9" else 2 if "a" <= c <= "z" else 3 if "A" <= c <= "Z" else
                     table[c] if c in table else 4 if c.isalpha() else 5 for c in t], np.int64)


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def init_model(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    p = {"E": r.normal(0, 0.3, (N_CLASSES, EMBED))}
    for d in "fb":
        p["W" + d] = r.normal(0, 1 / np.sqrt(EMBED + HIDDEN), (EMBED + HIDDEN, 4 * HIDDEN))
        p["c" + d] = np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)))
    p["O"], p["o"] = r.normal(0, 0.3, (2 * HIDDEN, TAGS)), np.zeros(TAGS)
    p["A"], p["s"] = np.zeros((TAGS, TAGS)), np.zeros(TAGS)
    return p


def _lstm(x, w, c0, mask, keep=None):
    """Hidden states over time (batch, time, HIDDEN); padding leaves the state."""
    n, steps, _ = x.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    out = np.empty((n, steps, HIDDEN))
    xw = x @ w[:EMBED] + c0
    for t in range(steps):
        z = xw[:, t] + h @ w[EMBED:]
        i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = mask[:, t:t + 1]
        c2 = f * c + i * g
        tc = np.tanh(c2)
        if keep is not None:
            keep.append((h, c, i, f, o, g, tc, m))
        h, c = m * (o * tc) + (1 - m) * h, m * c2 + (1 - m) * c
        out[:, t] = h
    return out


def _lstm_back(dout, x, w, keep):
    n, steps, _ = x.shape
    dw, db, dx = np.zeros_like(w), np.zeros(4 * HIDDEN), np.zeros_like(x)
    dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, tc, m = keep[t]
        dh = dh + dout[:, t]
        a = m * dh
        dct = m * dc + a * o * (1 - tc * tc)
        dz = np.concatenate((dct * g * i * (1 - i), dct * c * f * (1 - f), a * tc * o * (1 - o), dct * i * (1 - g * g)), 1)
        dw[:EMBED] += x[:, t].T @ dz
        dw[EMBED:] += h.T @ dz
        db += dz.sum(0)
        dx[:, t] = dz @ w[:EMBED].T
        dh = (1 - m) * dh + dz @ w[EMBED:].T
        dc = (1 - m) * dc + dct * f
    return dx, dw, db


def _flip(x, length):
    """Reverse each row's first ``length`` steps, padding stays behind."""
    t = x.shape[1]
    at = np.arange(t)[None, :]
    at = np.where(at < length[:, None], length[:, None] - 1 - at, at)
    return np.take_along_axis(x, at[:, :, None] if x.ndim == 3 else at, 1)


def emissions(p, ids, length, keep=None):
    mask = (np.arange(ids.shape[1])[None, :] < length[:, None]).astype(float)
    x = p["E"][ids]
    kf, kb = ([], []) if keep is not None else (None, None)
    hf = _lstm(x, p["Wf"], p["cf"], mask, kf)
    xb = _flip(x, length)
    hb = _flip(_lstm(xb, p["Wb"], p["cb"], mask, kb), length)
    h = np.concatenate((hf, hb), 2)
    if keep is not None:
        keep.update(x=x, xb=xb, kf=kf, kb=kb, h=h)
    return h @ p["O"] + p["o"], mask


def _lse(x, axis):
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def forward_backward(p, e, mask):
    """Log partition, tag marginals and expected transitions of a linear chain."""
    n, steps, k = e.shape
    a, b = np.empty((n, steps, k)), np.zeros((n, steps, k))
    a[:, 0] = p["s"] + e[:, 0]
    for t in range(1, steps):
        m = mask[:, t:t + 1]
        a[:, t] = m * (_lse(a[:, t - 1][:, :, None] + p["A"], 1) + e[:, t]) + (1 - m) * a[:, t - 1]
    for t in range(steps - 2, -1, -1):
        m = mask[:, t + 1:t + 2]
        b[:, t] = m * _lse(p["A"] + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2) + (1 - m) * b[:, t + 1]
    z = _lse(a[:, -1], 1)
    marg = np.exp(a + b - z[:, None, None]) * mask[:, :, None]
    return z, marg, a, b


def loss_and_gradient(p, ids, tags, length):
    keep: dict = {}
    e, mask = emissions(p, ids, length, keep)
    n, steps, _ = e.shape
    z, marg, a, b = forward_backward(p, e, mask)
    rows = np.arange(n)
    gold = p["s"][tags[:, 0]] + (np.take_along_axis(e, tags[:, :, None], 2)[:, :, 0] * mask).sum(1)
    gold += (p["A"][tags[:, :-1], tags[:, 1:]] * mask[:, 1:]).sum(1)
    de = marg.copy()
    hot = np.zeros_like(de)
    np.put_along_axis(hot, tags[:, :, None], 1.0, 2)
    de -= hot * mask[:, :, None]
    da = np.zeros_like(p["A"])
    for t in range(1, steps):
        m = mask[:, t]
        joint = np.exp(a[:, t - 1][:, :, None] + p["A"] + (e[:, t] + b[:, t])[:, None, :] - z[:, None, None])
        da += (joint * m[:, None, None]).sum(0)
        np.add.at(da, (tags[:, t - 1], tags[:, t]), -m)
    ds = marg[:, 0].sum(0)
    np.add.at(ds, tags[rows, 0], -1.0)
    g = {"A": da, "s": ds, "O": np.einsum("nth,ntk->hk", keep["h"], de), "o": de.sum((0, 1))}
    dh = de @ p["O"].T
    dxf, g["Wf"], g["cf"] = _lstm_back(dh[:, :, :HIDDEN], keep["x"], p["Wf"], keep["kf"])
    dxb, g["Wb"], g["cb"] = _lstm_back(_flip(dh[:, :, HIDDEN:], length), keep["xb"], p["Wb"], keep["kb"])
    dx = dxf + _flip(dxb, length)
    g["E"] = np.zeros_like(p["E"])
    np.add.at(g["E"], ids, dx * mask[:, :, None])
    return float((z - gold).sum()), {k: v / n for k, v in g.items()}


def _windows(length: int) -> list[int]:
    """Starts of the overlapping windows over a text of this length."""
    if length <= WINDOW:
        return [0]
    starts = list(range(0, length - WINDOW, STRIDE))
    return starts + [length - WINDOW]


def training_windows(sample: list[tuple[list[tuple[int, int, int]], list[tuple[int, str]]]], seed: int = 7):
    """(ids, tags, length) of the sample's windows; digits count as one class, so
    no value is learnt.  Variants (other separators, no prefix) of the labelled
    spans and look-alikes without label are added by rule."""
    rng = np.random.default_rng(seed)
    rows: list[tuple[np.ndarray, np.ndarray]] = []

    def add(text: str, spans):
        c, tag = classes(text), np.zeros(len(text), np.int64)
        for k, a, b in spans:
            a, b = max(a, 0), min(b, len(text))
            if a < b:
                tag[a:b] = 2 + 2 * k
                tag[a] = 1 + 2 * k
        for w in _windows(len(text)):
            if tag[w] and not tag[w] % 2 == 1:
                continue                       # cut at the edge: not a whole example
            rows.append((c[w:w + WINDOW], tag[w:w + WINDOW]))

    negatives = ("2024-01-17 08:30", "12.5%", "v3.14.15", "no. 4711", "1789", "10,000", "3/4", "20240117", "@home", "16 x 24", "(1999)", "00:15:42", "7-11")
    for spans, regs in sample:
        for start, text in regs:
            inside = [(k, a - start, b - start) for k, a, b in spans if a >= start and b <= start + len(text)]
            add(text, inside)
            for k, a, b in inside[:2]:
                value = text[a:b]
                other = {0: value.replace("@", " @ ").replace(".", " . ", 1), 1: value.replace(".", " . "),
                         2: "-".join(value[i:i + 4] for i in range(0, len(value), 4)) if value.isdigit() else value.replace("-", "."),
                         3: value[value.find("("):] if "(" in value else value.replace("+", "00", 1)}[k]
                add(text[:a] + other + text[b:], [(k, a, a + len(other))])
                plain = negatives[int(rng.integers(len(negatives)))]
                add(text[:a] + plain + text[b:], [])
    if not rows:
        return None
    n = len(rows)
    ids, tags, length = np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), np.int64), np.zeros(n, np.int64)
    for i, (c, t) in enumerate(rows):
        ids[i, :len(c)], tags[i, :len(t)], length[i] = c, t, len(c)
    return ids, tags, np.maximum(length, 1)


def train(sample, epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray] | None:
    """Adam on the CRF likelihood; deterministic for a given sample."""
    made = training_windows(sample, seed)
    if made is None:
        return None
    ids, tags, length = made
    rng, p = np.random.default_rng(seed), init_model(seed)
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(ids))
        for a in range(0, len(order), BATCH):
            i = order[a:a + BATCH]
            _, g = loss_and_gradient(p, ids[i], tags[i], length[i])
            norm = np.sqrt(sum((x * x).sum() for x in g.values()))
            step += 1
            rate = RATE * min(1.0, 2 * (1 - epoch / epochs)) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k in p:
                x = g[k] * min(1.0, 5.0 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.999 * v[k] + 0.001 * x * x
                p[k] -= rate * m[k] / (np.sqrt(v[k]) + 1e-8)
    return p


def viterbi(p, e, mask):
    n, steps, k = e.shape
    best, back = p["s"] + e[:, 0], np.zeros((n, steps, k), np.int64)
    for t in range(1, steps):
        s = best[:, :, None] + p["A"]
        back[:, t] = s.argmax(1)
        m = mask[:, t:t + 1]
        back[:, t] = np.where(m > 0, back[:, t], np.arange(k)[None, :])
        best = np.where(m > 0, s.max(1) + e[:, t], best)
    path = np.zeros((n, steps), np.int64)
    path[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        path[:, t - 1] = np.take_along_axis(back[:, t], path[:, t][:, None], 1)[:, 0]
    return path


def plausible(kind: int, s: str) -> bool:
    """Does an added span hold up as its kind?"""
    d = "".join(c for c in s if "0" <= c <= "9")
    if kind == 0:
        local, at, host = s.partition("@")
        return bool(at and local.strip() and re.fullmatch(r"\x20*[A-Za-z0-9-]+(\x20*\.\x20*[A-Za-z0-9-]+)+\x20*", host))
    if kind == 1:
        parts = re.split(r"\x20*\.\x20*", s.strip())
        return len(parts) == 4 and all(re.fullmatch("[0-9]+", x) and _at_most(x, 255) for x in parts)
    if kind == 2:
        return 13 <= len(d) <= 19 and luhn(d) and not re.search("[A-Za-z]", s)
    return 9 <= len(d) <= 15 and bool(re.match(r"\+|\(|00", s)) and not re.search("[A-Za-z]", s)


def join_parts(cands: list[tuple[int, int, int, float]]) -> list[list]:
    """Equal kinds that overlap become one span."""
    joined: list[list] = []
    for k in range(len(KINDS)):
        last = None
        for _, a, b, s in sorted(c for c in cands if c[0] == k):
            if last and a < last[2]:
                last[2], last[3] = max(last[2], b), max(last[3], s)
            else:
                last = [k, a, b, s]
                joined.append(last)
    return joined


def reconcile(cands: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """(kind, start, end, mean probability) of all windows -> spans that do not
    overlap: equal kinds that overlap are joined, then the set of largest total
    score (probability times length) is chosen."""
    joined = join_parts(cands)
    joined.sort(key=lambda c: (c[2], c[1], c[0]))
    best: list[tuple[float, list]] = [(0.0, [])]
    ends = [0]
    for k, a, b, s in joined:
        i = int(np.searchsorted(ends, a, side="right")) - 1
        take = best[i][0] + s * (b - a)
        best.append((take, best[i][1] + [(k, a, b)]) if take > best[-1][0] else best[-1])
        ends.append(b)
    return best[-1][1]


def model_spans(p, regs: list[list[tuple[int, str]]]) -> list[list[tuple[int, int, int]]]:
    """Spans the model finds in each document's neighbourhoods."""
    jobs, c = [], {}
    for d, rs in enumerate(regs):
        for r, (_, text) in enumerate(rs):
            c[d, r] = classes(text)
            jobs += [(d, r, w) for w in _windows(len(text))]
    found: dict[tuple[int, int], list] = {}
    cut: set[tuple[int, int, int, int]] = set()     # window edges that cut a part: start, or -end
    for lo in range(0, len(jobs), 512):
        part = jobs[lo:lo + 512]
        ids, length = np.zeros((len(part), WINDOW), np.int64), np.zeros(len(part), np.int64)
        for i, (d, r, w) in enumerate(part):
            x = c[d, r][w:w + WINDOW]
            ids[i, :len(x)], length[i] = x, max(1, len(x))
        e, mask = emissions(p, ids, length)
        _, marg, _, _ = forward_backward(p, e, mask)
        path = viterbi(p, e, mask)
        prob = np.take_along_axis(marg, path[:, :, None], 2)[:, :, 0]
        for i in np.flatnonzero((path > 0).any(1)):
            d, r, w = part[i]
            size = len(c[d, r])
            tag, t, stop = path[i], 0, int(length[i])
            while t < stop:
                if not tag[t]:
                    t += 1
                    continue
                k, a = (tag[t] - 1) // 2, t
                t += 1
                while t < stop and tag[t] == 2 + 2 * k:
                    t += 1
                # a span at a window's inner edge may be cut: it is joined with the next window's part
                mean = float(prob[i, a:t].mean())
                if mean >= MIN_PROBABILITY:
                    if a == 0 and w > 0:
                        cut.add((d, r, int(k), w))
                    if t == stop and w + t < size:
                        cut.add((d, r, int(k), -(w + t)))
                    found.setdefault((d, r), []).append((int(k), w + a, w + t, mean))
    out: list[list[tuple[int, int, int]]] = [[] for _ in regs]
    for (d, r), cands in found.items():
        start, text = regs[d][r]
        whole = []
        for k, a, b, score in join_parts(cands):
            if k == 0 and "@" in text[a:b]:
                a, b = whole_address(text, a, b)
            elif (d, r, k, a) in cut or (d, r, k, -b) in cut:
                continue
            whole.append((k, a, b, score))
        out[d] += [(k, start + a, start + b) for k, a, b in reconcile(whole) if plausible(k, text[a:b])]
    return out


# -- Spark ------------------------------------------------------------------
_SPANS = "array<struct<kind:int,start:int,end:int>>"
_REGIONS = "array<struct<start:int,text:string>>"
_SPAN_T = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_REGION_T = pa.list_(pa.struct([("start", pa.int32()), ("text", pa.string())]))


def scan_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, base, regions) of every row."""

    def run(batches):
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            base = pa.array([[{"kind": k, "start": a, "end": e} for k, a, e in base_spans(t)] for t in texts], _SPAN_T)
            regs = pa.array([[{"start": a, "text": x} for a, x in regions(t)] for t in texts], _REGION_T)
            yield pa.RecordBatch.from_arrays([b.column(0), base, regs], names=["doc_id", "base", "regions"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(
        run, f"doc_id long, base {_SPANS}, regions {_REGIONS}")


def _fit(scanned: DataFrame, docs: int) -> dict[str, np.ndarray] | None:
    few = scanned.where(F.size("regions") > 0).select("doc_id", "base", F.slice("regions", 1, SAMPLE_REGIONS).alias("regions"))
    few = few.withColumn("regions", F.transform("regions", lambda r: F.struct(r["start"].alias("start"), F.substring(r["text"], 1, SAMPLE_CHARS).alias("text"))))
    few = few.withColumn("key", F.to_json("regions"))
    n, n1 = few.agg(F.count("*"), F.sum((F.size("base") > 0).cast("int"))).first()
    if not n1:
        return None
    rows = hash_sample(few.where(F.size("base") > 0), docs, n1, "doc_id", "key").collect()
    rows += hash_sample(few.where(F.size("base") == 0), docs, n - n1, "doc_id", "key").collect()
    return train([labelled([tuple(x) for x in r.regions]) for r in rows])


def labelled(regs: list[tuple[int, str]]) -> tuple[list[tuple[int, int, int]], list[tuple[int, str]]]:
    """Neighbourhoods and the spans that the patterns label in them."""
    return [(k, start + a, start + b) for start, x in regs for k, a, b in base_spans(x, checked=False)], regs


def find_personal_data(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, base, added) spans of every row, ``base`` by kind, then start."""
    scanned = spill(scan_base(docs, text), "pii")
    model = _fit(scanned, sample_docs)

    def run(batches):
        for b in batches:
            base = [[(s["kind"], s["start"], s["end"]) for s in x] for x in b.column(1).to_pylist()]
            regs = [[(r["start"], r["text"]) for r in x] for x in b.column(2).to_pylist()]
            added = model_spans(model, regs) if model else [[] for _ in base]
            added = [[x for x in sorted(new) if not any(x[1] < s[2] and s[1] < x[2] for s in old)] for new, old in zip(added, base)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([[{"kind": k, "start": a, "end": e} for k, a, e in x] for x in added], _SPAN_T)],
                names=["doc_id", "base", "added"])

    return scanned.mapInArrow(run, f"doc_id long, base {_SPANS}, added {_SPANS}")


def pii_report(docs: DataFrame) -> DataFrame:
    """Contract columns of every row, and the number of added spans."""
    found = find_personal_data(docs)
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat(
            F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")

    counts = [F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias("n_" + k) for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def mask(t: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span's text replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    merged: list[list[int]] = []
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([k, a, b])
    for k, a, b in merged:
        out += [t[at:a], f"<{KINDS[k].upper()}>"]
        at = b
    return "".join(out) + t[at:]


def redact(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``docs`` with every span masked in ``text`` (null stays null); ``n_chars``,
    where there is such a column, follows the text.  One pass trains on a sample,
    one pass masks each text where it stands: no text is shuffled."""
    model = _fit(spill(scan_base(docs), "pii"), sample_docs)
    cols = docs.columns
    at = cols.index("text")
    chars = cols.index("n_chars") if "n_chars" in cols else None

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            full = [x or "" for x in texts]
            base = [base_spans(t) for t in full]
            added = model_spans(model, [regions(t) for t in full]) if model else [[] for _ in full]
            new = []
            for t, old, more in zip(texts, base, added):
                spans = old + [x for x in more if not any(x[1] < s[2] and s[1] < x[2] for s in old)]
                new.append(mask(t, spans) if t and spans else t)
            arrays = [b.column(i) for i in range(len(cols))]
            if chars is not None:
                old = b.column(chars).to_pylist()
                arrays[chars] = pa.array([len(x) if x is not t and x is not None else n for x, t, n in zip(new, texts, old)], b.column(chars).type)
            arrays[at] = pa.array(new, b.column(at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=list(b.schema.names))

    return docs.mapInArrow(run, docs.schema)


def digest(spans: list[tuple[int, int, int]]) -> str:
    """The contract's digest of base spans (for tests)."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
