"""``corpus_pipeline`` against brute force, each stage on what the one before kept."""

import re
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from parcelle.llm import mixing, pii
from parcelle.llm.common import spill
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"


def good(t):
    w = WORD.findall(t or "")
    win = list(zip(w, w[1:], w[2:]))
    times = Counter(win)
    covered = {k + j for k, x in enumerate(win) if times[x] > 1 for j in range(3)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    n, dup = len(w), len(lines) - len(set(lines))
    return not (n < 50 or 100 * len(covered) > 50 * n or 3 * sum((t or "").count(x) for x in "#*$%&|<>") > n or 2 * dup > len(lines)
                or 2 * (t or "").count("!") > n or sum(map(len, w)) < 2 * n)


def one_of_each(rows):
    sets = []
    for r in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    holders = defaultdict(list)
    for x, s in enumerate(sets):
        for g in s:
            holders[g].append(x)
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for x, s in enumerate(sets):
        shared = Counter(y for g in s for y in holders[g] if y < x)
        for y, c in shared.items():
            if 100 * c >= 80 * len(s | sets[y]):
                top[root(x)] = root(y)
    best = {}
    for x, r in enumerate(rows):
        best[root(x)] = min(best.get(root(x), (True, 0)), (r.doc_id is None, r.doc_id or 0))
    return Counter(i for _, i in best.values())


def test_stages_and_run(spark, tmp_path):
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    rows = [tuple(r) for r in given]
    long = " ".join(f"mot{i % 701} x{i}" for i in range(3000))
    private = " ".join(f"word{i}" for i in range(60)) + " write to a.b@c.example or +33 1 23 45 67 89, card 4111 1111 1111 1111, host 10.0.0.1"
    extra = [long, long, private, None, "", "short", "! " * 300]
    rows += [(10_000 + i, t, "fr", None if i % 2 else "src0", len(t or "")) for i, t in enumerate(extra)]
    rows += [rows[3], rows[3], (None, private + " more", None, None, None), (rows[5][0], long + " other end", "en", "src1", 3)]
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    before, states = docs, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = spill(stage(spark, before, str(tmp_path)), f"test-{name}")
        kept[name] = before.collect()
        states.append(kept[name])
        assert before.columns == docs.columns or name == "pack_sequences"
    assert list(kept) == ["quality_rules", "near_duplicates", "personal_data", "mix_sources", "pack_sequences"]
    first, second, third, fourth, last = states[1:]
    assert Counter(map(tuple, first)) == Counter(tuple(r) for r in states[0] if good(r.text))
    assert Counter(r.doc_id or 0 for r in second) == one_of_each(first) and set(map(tuple, second)) <= set(map(tuple, first))
    assert 0 < len(second) < len(first) < len(states[0])
    # personal data: texts without a span stay as they are, spans are gone
    old = {(r.doc_id, r.source): r.text for r in second}
    assert Counter((r.doc_id, r.lang, r.source) for r in third) == Counter((r.doc_id, r.lang, r.source) for r in second)
    masked = 0
    for r in third:
        spans = pii.base_spans(old[r.doc_id, r.source])
        masked += bool(spans)
        assert (r.text == old[r.doc_id, r.source]) or spans or "@" in old[r.doc_id, r.source]
        assert not pii.base_spans(r.text) and (not spans or r.n_chars == len(r.text))
    assert masked > 3
    # mixing: every source comes near its target, in whole documents and one cut
    whole = {(r.doc_id, r.source): r.text for r in third}
    size, taken = Counter(), Counter()
    for r in third:
        size[r.source] += len(WORD.findall(r.text))
    for r in fourth:
        text = whole[r.doc_id, r.source]
        assert text.startswith(r.text) and r.n_chars <= max(len(text), r.n_chars)
        taken[r.source] += len(WORD.findall(r.text))
    times = Counter(r.doc_id for r in third)
    of = {r.doc_id: r.source for r in third if times[r.doc_id] == 1}
    goal = {of[r.doc_id]: r.target for r in mixing.mix_report(spark.createDataFrame(third, COLUMNS)).collect() if r.doc_id in of}
    assert set(goal) == set(size)
    assert abs(sum(goal.values()) - 1.5 * sum(size.values())) < 1 and all(abs(taken[s] - goal[s]) <= 3 and goal[s] <= 2 * size[s] + 1e-6 for s in goal)
    assert max(Counter((r.doc_id, r.source) for r in fourth).values()) <= 2
    assert sum(r.text != whole[r.doc_id, r.source] for r in fourth) <= len(goal)
    # packing: the mixed rows' ids, whole and in place
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = Counter((r.doc_id, len(tok.encode(r.text, add_special_tokens=False).ids) + 1) for r in fourth)
    want = Counter()
    for (i, n), times in ids.items():
        want[i] += n * times
    got, used = Counter(), {}
    for r in sorted(last, key=lambda r: (r.sequence_id, r.offset)):
        got[r.doc_id] += r.length
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    space: list[int] = []                         # plain best-fit decreasing, item by item
    for r in sorted(last, key=lambda r: -r.length):
        fits = min((x for x in space if x >= r.length), default=None)
        if fits is not None:
            space.remove(fits)
        space.append((1024 if fits is None else fits) - r.length)
    assert got == want
    assert max(used.values()) <= 1024 and len(used) <= len(space)
    # the whole run: the same pieces in as many sequences
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    digest = lambda rows: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert digest(out) == digest(last) and len({r.sequence_id for r in out}) == len(used) and np.isfinite(len(out))
