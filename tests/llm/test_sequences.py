"""Periodic runs, Feistel sharding and token alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from parcelle.llm import alignment, periodic, sharding
from parcelle.llm.common import spill
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, period string, row string, block long, shard int"
LONG = " ".join(f"w{i % 300}" for i in range(3_000))
TEXTS = [None, "", " \t\n", "a", "a a a a a a", "x\x0by\x1c z a " * 9, "a b a b a b a b a", "b " + "a b c " * 5 + "d", LONG,
         "<|endoftext|> x <s> <0x41> </s>", "▁a b", "😀 tab\tnew\n\n  spaces   é̂ 漢字 \x00 end ", "q" * 3000, "the " * 40 + "end", " lead"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "p", "r", 7, 1) for i, t in enumerate(TEXTS)]
    rows += [rows[6], rows[6], rows[11], (None, "no id here", None, None, None, None), (None, None, None, None, None, None)]
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(110).collect()
    rows += [(1000 + r.doc_id, r.text, None, None, None, None) for r in given]
    return spill(spark.createDataFrame(rows, SCHEMA).repartition(3), "fixture")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(none):
    for df in (periodic.run_digests(periodic.find_runs(periodic.repeat_endings(none))), sharding.shard_report(none),
               alignment.alignment_digests(none)):
        assert df.collect() == []


# ---------------------------------------------------------------------------
# runs


def plain_lyndon(s, reverse):
    """Longest Lyndon prefix of every suffix, by its definition."""
    key = [-c for c in s] if reverse else list(s)
    out = []
    for i in range(len(s)):
        best = 1
        for e in range(i + 1, len(s) + 1):
            w = key[i:e]
            if all(w < w[k:] for k in range(1, len(w))):
                best = e - i
        out.append(best)
    return out


def plain_runs(w, least=6, exponent=4):
    """Every (start, length, smallest period) of a maximal repetition, by its definition."""
    n, out = len(w), set()
    covered = set()
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            e = i + p
            if e - s >= 2 * p and (s, e) not in covered:
                covered.add((s, e))        # a smaller period of the same stretch comes first
                if e - s >= max(least, exponent * p):
                    out.add((s, e - s, p))
    return out


def test_lyndon_groups():
    rnd = random.Random(3)
    for _ in range(300):
        s = [rnd.randrange(rnd.choice([1, 2, 3, 5])) for _ in range(rnd.randrange(1, 16))]
        for reverse in (False, True):
            length, group = periodic.lyndon_groups(s, reverse)
            assert length == plain_lyndon(s, reverse), (s, reverse)
            words = {i: tuple(s[i:i + length[i]]) for i in range(len(s))}
            assert all((words[i] == words[j]) == (group[i] == group[j]) for i in words for j in words)


def test_runs_of_small_alphabets():
    rnd = random.Random(4)
    for turn in range(600):
        w = [rnd.randrange(rnd.choice([1, 2, 3])) for _ in range(rnd.randrange(0, 60))]
        if turn % 2:
            root = [rnd.randrange(3) for _ in range(rnd.randrange(1, 9))]
            w = w[:8] + root * rnd.randrange(2, 7) + root[:rnd.randrange(0, len(root))] + w[8:16]
        for least, exponent in ((6, 4), (1, 3), (9, 5)):
            got = periodic.text_runs([b"%d" % c for c in w], least, exponent)
            assert set(got) == plain_runs(w, least, exponent) and len(set(got)) == len(got), w


def test_run_digests(docs):
    want = Counter()
    for r in docs.collect():
        w = WORD.findall(r.text or "")
        n = len(w)
        h = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        number = {x: i for i, x in enumerate(dict.fromkeys(w))}
        runs = sorted(plain_runs([number[x] for x in w]), key=lambda x: (x[0], x[2]))
        gone = {k for s, m, p in runs for k in range(s + p, s + m)}
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        said = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[(r.doc_id, len(runs), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in (said, left)))] += 1
    found = periodic.find_runs(periodic.repeat_endings(docs))
    got = Counter(tuple(r) for r in periodic.run_digests(found).collect())
    assert got == want and sum(r[1] > 0 for r in want) > 5
    plain = {r.doc_id: r for r in periodic.find_runs(docs).collect()}
    assert [tuple(x) for x in plain[7].runs] == [(1, 15, 3)] and plain[7].collapsed == "b a b c d"


# ---------------------------------------------------------------------------
# sharding


def test_permutation():
    for n in (1, 2, 3, 4, 5, 16, 17, 1000, 4097):
        at = sharding.permute(np.arange(n), n, 5)
        assert sorted(at.tolist()) == list(range(n))
        assert (sharding.row_at(at % 7, at // 7, n, 7, 5) == np.arange(n)).all()
    big = 10 ** 13 + 7
    x = np.random.default_rng(1).integers(0, big, 2000)
    at = sharding.permute(x, big)
    assert (at >= 0).all() and (at < big).all() and (sharding.permute(at, big, back=True) == x).all()
    assert (sharding.permute(np.arange(4097), 4097, 5) != sharding.permute(np.arange(4097), 4097, 6)).mean() > 0.9
    # neighbours land in shards as if drawn: no shard pair of neighbours stands out
    near = Counter(zip((at := sharding.permute(np.arange(40_000), 40_000)) [:-1] % 40, at[1:] % 40))
    assert max(near.values()) < 70 and len(near) > 1550


def test_shards(spark, docs):
    got = sharding.shard_report(docs).collect()
    text = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == text
    slots = defaultdict(list)
    for r in got:
        assert r.law == "rows" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(slots) == set(range(40)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    place = sharding.permute(np.array([r.row_number for r in got]), len(got))
    assert [(p % 40, p // 40) for p in place.tolist()] == [(r.shard, r.slot) for r in got]
    # the same places from other partitions in another order
    again = sharding.shard_report(docs.orderBy(docs.text.desc()).repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_shards_of_one_repeated_row(spark):
    df = spark.range(3000).selectExpr("cast(null as long) doc_id", "if(id < 2000, 'same', cast(id as string)) text")
    got = sharding.assign(df, 7).collect()
    assert sorted(r.row_number for r in got) == list(range(3000))
    assert len({(r.shard, r.slot) for r in got}) == 3000


def test_written_shards_hold_the_rows(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    rows = back.collect()
    assert Counter(tuple(r["row"]) for r in rows) == Counter(tuple(r) for r in docs.collect())
    assert {r["shard"] for r in rows} == {0, 1, 2, 3}


# ---------------------------------------------------------------------------
# alignment


def plain_alignment(rows):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    # the byte of each printable character, from the library itself
    char = {}
    probes = [*range(0x800), *(c for c in range(0x800, 0x110000, 0x800) if not 0xD800 <= c <= 0xDFFF)]
    for c in map(chr, probes):
        char.update(zip(ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0], c.encode()))
    each = []
    for i, text in rows:
        if not text:
            each.append((i, [], []))
            continue
        x, y = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        bx = [bytes(char[c] for c in t.id_to_token(k)) for k in x]
        by = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(sp.id_to_piece, y)]
        if not b"".join(bx) == b"".join(by) == (" " + text).encode():
            each.append((i, [], []))
            continue
        spans = []
        for ids, parts in ((x, bx), (y, by)):
            at, out = 0, []
            for k, p in zip(ids, parts):
                out.append((k, at, at + len(p)))
                at += len(p)
            spans.append(out)
        each.append((i, *spans))
    links, count = [], Counter()
    for i, x, y in each:
        found, lo = [], 0
        for k, s, e in x:
            while y[lo][2] <= s:
                lo += 1
            j = lo
            while j < len(y) and y[j][1] < e:
                found.append((k, y[j][0]))
                j += 1
        links.append(found)
        count.update(found)
    most = defaultdict(int)
    for (k, m), c in count.items():
        most[m] = max(most[m], c)
    out = Counter()
    for (i, x, y), found in zip(each, links):
        cuts = sorted({e for _, _, e in x} & {e for _, _, e in y})
        said = []
        for lo, hi in zip([0, *cuts], cuts):
            said.append("|".join(",".join(str(k) for k, s, e in side if lo < e <= hi) for side in (x, y)))
        out[(i, len(x), len(y), len(cuts), len(found), sum(count[f] == most[f[1]] for f in found), sum(count[f] for f in found), ";".join(said))] += 1
    return out


def test_alignment(docs):
    want = plain_alignment([(r.doc_id, r.text) for r in docs.collect() if r.text != LONG])
    docs = docs.where(docs.text.isNull() | (docs.text != LONG))
    got = alignment.align(docs)
    assert Counter(tuple(r) for r in got.collect()) == want
    zeros = [r for r in want if r[0] in (0, 1, 10)]
    assert len(zeros) == 3 and all(r[1:] == (0, 0, 0, 0, 0, 0, "") for r in zeros)
    said = {(r[0], hashlib.sha256(r[7].encode()).hexdigest() if r[1] else "") for r in want}
    assert {(r.doc_id, r.groups_sha256) for r in alignment.alignment_digests(docs).collect()} == said


def test_pointer_jumping():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends = [np.array(sorted({*rng.integers(1, n + 1, rng.integers(0, n + 1)).tolist(), n})) for _ in "ab"]
        la, lb = alignment.group_labels(*ends)
        cuts = np.intersect1d(*ends)
        assert (np.searchsorted(cuts, ends[0]) == np.searchsorted(cuts, ends[1][la])).all()
        assert (np.searchsorted(cuts, ends[1]) == np.searchsorted(cuts, ends[1][lb])).all() and len(set(lb.tolist())) == len(cuts)
        i, j = alignment.links_of(*ends)
        start = [np.concatenate(([0], e[:-1])) for e in ends]
        assert set(zip(i.tolist(), j.tolist())) == {
            (x, y) for x in range(len(ends[0])) for y in range(len(ends[1])) if start[0][x] < ends[1][y] and start[1][y] < ends[0][x]}
