"""BPE and packing against the tokenizers library."""

import hashlib
import os
import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
from support import corpus, frame  # noqa: E402

from orbis.llm import bpe, packing
from orbis.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    with open(tokenizer_path(), encoding="utf-8") as f:
        return bpe.Encoder(f.read())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encode_and_decode_like_the_library(spark, library):
    docs = corpus(6)
    got = bpe.encode_decode(frame(spark, docs, clashing=True), tokenizer_path()).collect()
    want = Counter((d, tuple(i := ids_of(library, t)), library.decode(i, skip_special_tokens=False))
                   for d, t in docs)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in got) == want
    digests = bpe.encode_digests(frame(spark, docs), tokenizer_path()).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert Counter(tuple(r) for r in digests) == Counter(
        {(d, len(i), sha(np.array(i, "<u4").tobytes()), sha(x.encode())): n for (d, i, x), n in want.items()})
    assert bpe.encode_decode(frame(spark, []), tokenizer_path()).count() == 0


def test_random_words(library, encoder):
    r = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz" * 2 + "ABC éßäöü0123 ..''!--😀日本\u0301İΣςẞ\x1c’"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 50))) for _ in range(3000)]
    texts += [c * k for c in ("a", "ha", "!", "é", "1") for k in range(40)]
    texts += ["<|endoftext|>x<|startoftext|>", "<|x|>", "</w> a</w>", "it's 'S 'LL we'Re"]
    for t, mine in zip(texts, encoder.encode(texts)):
        ids = ids_of(library, t)
        assert np.frombuffer(mine, "<u4").tolist() == ids, t
        assert encoder.decode(mine) == library.decode(ids, skip_special_tokens=False)


def test_refuted_guesses_are_merged_exactly(encoder):
    v = encoder.vocab
    words = sorted({w.encode() for w in "thththe hahehe ononing ationtion estings reedned".split()})
    for w, ids in zip(words, v.encode_words(words)):
        assert ids == v.exact([w])[0]
    rank = v.rank
    made = [int(t) for t in np.flatnonzero(rank >= 0)[:200]]
    pairs = [(a, b) for a in made[::7] for b in made[::11]]
    a, b = (np.array(x) for x in zip(*pairs))
    holds = v.border_holds(a, b, np.full(len(a), bpe.NEVER))

    def letters(t):
        return [t] if rank[t] < 0 else letters(v.left[t]) + letters(v.right[t])
    merges = {int(k): (int(r), int(v.made[r])) for k, r in zip(v.pair_key, v.pair_rank)}
    for x, y, ok in zip(a.tolist(), b.tolist(), holds):
        ids = [int(t) for t in letters(x) + letters(y)]
        while True:
            best = min(((merges[p * v.size + q][0], i) for i, (p, q) in enumerate(zip(ids, ids[1:]))
                        if p * v.size + q in merges), default=None)
            if best is None:
                break
            i = best[1]
            ids[i:i + 2] = [merges[ids[i] * v.size + ids[i + 1]][1]]
            if len(ids) == 2 and ids == [x, y]:
                pass
        merged = merges.get(x * v.size + y)
        assert (ids == [x, y]) == bool(ok) or (merged and not ok)


@pytest.mark.parametrize("most", [4096, 16])
def test_pieces_cover_every_document_once(spark, library, most):
    docs = corpus(7)
    got = packing.pack(frame(spark, docs, clashing=True), tokenizer_path(), max_length=most).collect()
    by_doc = defaultdict(list)
    for r in got:
        assert r.length & (r.length - 1) == 0 and r.length <= most and r.offset == 0
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_doc[r.doc_id, r.doc_tokens].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    want = Counter((d, tuple(ids_of(library, t) + [2])) for d, t in docs)
    for (d, ids), n in want.items():
        pieces = sorted(x for x in by_doc[d, len(ids)])
        same = [p for p in pieces if list(ids[p[0]:p[0] + len(p[1])]) == p[1]]
        covered = Counter(i for s, p in same for i in range(s, s + len(p)))
        assert set(covered) == set(range(len(ids))) and min(covered.values()) >= n
    assert sum(r.length for r in got) == sum(len(i) * n for (_, i), n in want.items())
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    lengths = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths, reverse=True)                # equal lengths lie together


def test_piece_lengths_and_empty_table(spark):
    assert packing.piece_lengths(1) == [1]
    assert packing.piece_lengths(4096 * 2 + 5) == [4096, 4096, 4, 1]
    assert all(sum(packing.piece_lengths(n, 8)) == n for n in range(1, 100))
    assert packing.pack(frame(spark, []), tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(frame(spark, []), tokenizer_path(), max_length=1000)
