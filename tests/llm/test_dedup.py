"""Exact, SimHash, line and suffix-array dedup against brute force."""

import hashlib
import os
import random
import re
import sys
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from support import CLASHING, corpus, frame, prose  # noqa: E402

from orbis.llm import exact_dedup, line_dedup, simhash, suffix_dedup
from orbis.llm.common import connected_components

SPACE = " \t\n\x0b\x0c\r"


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def as_counter(df):
    return Counter(tuple(r) for r in df.collect())


# ------------------------------------------------------------------ exact

def exact_brute(docs):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in docs]
    groups = defaultdict(list)
    for (d, _), t in zip(docs, norm):
        groups[t].append(d)
    least = {t: min(ids, key=lambda x: (x is None, x or 0)) for t, ids in groups.items()}
    return Counter((d, least[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest())
                   for (d, _), t in zip(docs, norm))


@pytest.mark.parametrize("radix,rounds", [(16, 2), (2, 3)])
def test_exact_against_brute_force(spark, radix, rounds):
    docs = corpus()
    got = exact_dedup.exact_dedup(frame(spark, docs, clashing=True), radix=radix, rounds=rounds)
    rows = got.collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == exact_brute(docs)
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert set(kept) == {r.text_sha256 for r in rows} and set(kept.values()) == {1}
    assert all(r.keep_id == r.doc_id for r in rows if r.kept)


def test_exact_hot_group_and_empty(spark):
    docs = [(i, "copy" if i % 3 else f"text {i}") for i in range(900)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(20))
    rows = got.collect()
    assert {(r.keep_id, r.group_size) for r in rows if r.doc_id % 3} == {(1, 600)}
    assert sum(r.kept for r in rows) == 301
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ simhash

def fp_brute(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text or ""))
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) > k else \
        ([" ".join(words)] if words else [])
    bits = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(grams))


def components(fps, most):
    nodes = sorted(fps)
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= most:
                parent[find(a)] = find(b)
    return {x: find(x) for x in nodes}


def test_simhash_against_brute_force(spark):
    docs = corpus(2, 120)
    fps = [fp_brute(t) for _, t in docs]
    root = components(set(fps), 2)
    least = {}
    for (d, _), f in zip(docs, fps):
        r = root[f]
        if d is not None:
            least[r] = min(least.get(r, d), d)
    want = Counter((d, f, least.get(root[f])) for (d, _), f in zip(docs, fps))
    got = simhash.simhash_groups(frame(spark, docs, clashing=True))
    assert Counter((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in got.collect()) == want
    assert simhash.simhash_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("most,probe", [(2, None), (2, 2), (3, None), (1, 1), (0, None), (5, None)])
def test_links_connect_all_near_fingerprints(spark, monkeypatch, most, probe):
    if probe:                                       # buckets are probed, not compared pairwise
        monkeypatch.setattr(simhash, "_probe_from", lambda bits: probe)
    r = random.Random(most)
    centres = [r.getrandbits(64) for _ in range(8)]
    fps = set(centres)
    for c in centres:
        for _ in range(60):
            fps.add(c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 7))))
    df = spark.createDataFrame([(f - 2 ** 64 if f >= 2 ** 63 else f,) for f in fps], "fp long")
    got = connected_components(simhash.links(df, most)).collect()
    mine = {f: f for f in fps} | {x.node % 2 ** 64: x.root % 2 ** 64 for x in got}
    want = components(fps, most)
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
    assert groups(mine) == groups(want)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    docs = corpus(3)
    df = frame(spark, docs, clashing=True)
    got = simhash.near_dedup(df)
    assert got.columns == ["doc_id", "text", *CLASHING]
    root = components({fp_brute(t) for _, t in docs}, 2)
    kept = [root[fp_brute(x.text)] for x in got.collect()]
    assert sorted(kept) == sorted({root[fp_brute(t)] for _, t in docs})
    assert simhash.near_dedup(frame(spark, [], clashing=True)).count() == 0


def test_connected_components_long_path_and_hub(spark):
    path = [(i, i + 1) for i in range(0, 80)]
    hub = [(1000, 1000 + i) for i in range(1, 400)]
    mixed = [(5000 + (i * 37) % 101, 5000 + ((i + 1) * 37) % 101) for i in range(100)]
    df = spark.createDataFrame(path + hub + mixed + [(9, 9)], "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert {got[i] for i in range(81)} == {0}
    assert {got[1000 + i] for i in range(400)} == {1000}
    assert {v for k, v in got.items() if k >= 5000} == {5000}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ lines

def lines_brute(docs):
    order = lambda d: (d is not None, d or 0)
    holders = defaultdict(set)
    for d, t in docs:
        for x in (t or "").split("\n"):
            k = low(x.strip(SPACE))
            if len(k) >= 10:
                holders[k].add(d)
    out = []
    for d, t in docs:
        keep, ls = [], (t or "").split("\n")
        for x in ls:
            h = holders.get(low(x.strip(SPACE)), ())
            if len(h) < 2 or d == min(h, key=order):
                keep.append(x)
        out.append((d, len(ls), len(ls) - len(keep), "\n".join(keep)))
    return Counter(out)


def test_lines_against_brute_force(spark):
    docs = corpus(4)
    got = line_dedup.line_dedup(frame(spark, docs, clashing=True))
    assert as_counter(got.select("doc_id", "n_lines", "n_dropped", "text")) == lines_brute(docs)
    assert got.select("row.*").columns == ["doc_id", "text", *CLASHING]
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


def test_bitmaps_name_only_words_with_dropped_lines(spark):
    many = "\n".join(f"own line number {i}" for i in range(500))
    docs = [(1, "a line that is shared"), (2, many + "\na line that is shared\n" + many)]
    got = line_dedup.keep_bitmaps(frame(spark, docs)).collect()
    assert [(r.doc_id, list(r.keep)) for r in got] == [(2, [500 // 64])]
    assert got[0].keep[7] % 2 ** 64 == 2 ** 64 - 1 - (1 << 500 % 64)


# ------------------------------------------------------------------ suffixes

def suffix_brute(docs, length):
    seen = Counter()
    for _, t in docs:
        b = (t or "").encode()
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return Counter(out)


def suffixes(df, **how):
    got = suffix_dedup.suffix_dedup(df, **how)
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in
                   got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect())


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_suffixes_of_the_corpus(spark, hot):
    docs = corpus(5)
    assert suffixes(frame(spark, docs, clashing=True), hot=hot) == suffix_brute(docs, 200)


@pytest.mark.parametrize("length,gram,letters", [(12, 5, "ab"), (20, 7, "abcdé\n"), (9, 9, "abc")])
def test_suffixes_of_small_alphabets(spark, length, gram, letters):
    r = random.Random(length)
    parts = ["".join(r.choice(letters) for _ in range(r.randint(1, 4 * length))) for _ in range(8)]
    docs = []
    for i in range(50):
        text = ""
        for _ in range(r.randint(0, 4)):
            p = r.choice(parts)
            a = r.randint(0, len(p))
            text += p[a:a + r.randint(0, 2 * length)] + r.choice(letters) * r.randint(0, 3)
        docs.append((i, text))
    docs += [(98, letters[0] * 3 * length), (99, (letters[0] + letters[1]) * length)]
    assert suffixes(frame(spark, docs), length=length, gram=gram) == suffix_brute(docs, length)


def test_suffixes_across_blocks_and_grams_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "BLOCK_CONTEXTS", 3)
    r = random.Random(9)
    shared = prose(r, 400)
    docs = [(i, prose(r, r.randint(0, 300)) + shared[i * 40:i * 40 + 900] + prose(r, 30)) for i in range(12)]
    assert suffixes(frame(spark, docs)) == suffix_brute(docs, 200)


def test_suffixes_empty_table_and_whole_characters(spark):
    assert suffix_dedup.suffix_dedup(frame(spark, [])).count() == 0
    cut = spark.createDataFrame([(bytearray(b"\xa9ok\xc3"),), (bytearray(b""),), (None,)], "kept binary")
    got = [x[0] for x in cut.select(suffix_dedup.whole_characters(F.col("kept"))).collect()]
    assert got == ["ok", "", None]
