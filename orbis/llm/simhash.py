"""SimHash near-dedup by deletion-variant signatures (operator 2).

A 64-bit fingerprint is cut into as few segments as still leave one that differs
by at most one bit: ``max_bits // 2 + 1`` (two 32-bit halves for the default
of two bits).  A segment's signatures are its variants with one bit wiped out
(the wildcard); two segments that differ by at most one bit agree in at least one
variant.  So an equality join on (segment, wildcard, wiped value) finds every
pair, and each found pair is verified on the whole fingerprint.

Only distinct fingerprints are indexed: a group of exact copies is one row from the
first (map-side) aggregation on.  Signatures are hash-partitioned, sorted, and
streamed; a task looks at one bucket after the other.  Small buckets are compared
directly, larger ones by probing their sorted values with all bit flips that
are still allowed, so a bucket costs in proportion to its size, and a task hands on
a spanning forest of its links instead of all pairs.  The number of fingerprints
in a bucket is bounded by the bits the bucket leaves open, not by copies.

Components: ``common.connected_components`` over links between fingerprints.

Defined results: null text counts as empty; texts without a word have
fingerprint 0 and link like any other; fewer words than the shingle length give one
shingle of all words; a null doc_id sorts after all others; repeated rows are
returned as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbis.llm.common import connected_components, doc_view, drop_caches, shuffle_width, ship, written

ship(__name__)

BITS = 64
LINKS_PER_FLUSH = 1 << 18


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a UTF-8 text over XXH64 (seed 42) of its word shingles."""
    from xxhash import xxh64_intdigest
    words = text.lower().split()                 # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(line, 42)]
    else:
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        starts = [0, *(gaps + 1).tolist()]
        ends = [*gaps.tolist(), len(line)]
        hashes = [xxh64_intdigest(line[s:e], 42) for s, e in zip(starts, ends[shingle - 1:])]
    ones = np.zeros(BITS, np.int64)
    h = np.array(hashes, dtype=">u8")
    for at in range(0, len(h), 4096):            # bounded working memory for long texts
        block = h[at:at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(h))
    return int.from_bytes(packed.tobytes(), "big")


def _fingerprint_column(shingle: int):
    """Arrow UDF over texts: the fingerprint's 64 bits as a long."""
    def run(texts: pa.Array) -> pa.Array:
        drop_caches()
        fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts.cast(pa.binary())),
                          np.uint64, len(texts))
        return pa.array(fps.view(np.int64))
    return F.arrow_udf(run, "long")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``(doc_id, fp long)``; the long holds the 64 bits as they are."""
    return doc_view(docs, id_col, text_col) \
        .select("doc_id", _fingerprint_column(shingle)(F.col("text")).alias("fp"))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the fewest segments of which one differs by <= 1 bit."""
    n = max_bits // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def _signatures(max_bits: int):
    """mapInArrow: fp -> (seg, wild, rest, fp), one row for each segment and wildcard."""
    parts = segments(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, (shift, width) in enumerate(parts):
                seg = (fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)
                wild = np.arange(width, dtype=np.uint64)
                rest = seg[:, None] & ~(np.uint64(1) << wild)[None, :]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.int16(k * BITS) + wild.astype(np.int16)[None, :],
                                        len(fp), axis=0).ravel()),
                     pa.array(rest.ravel().view(np.int64)),
                     pa.array(np.repeat(fp, width).view(np.int64))],
                    names=["slot", "rest", "fp"])
    return run


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _flips(width_bits: list[int], most: int) -> np.ndarray:
    """XOR masks of 0..most flipped bits among ``width_bits``."""
    from itertools import combinations
    masks = [0]
    for n in range(1, most + 1):
        masks += [sum(1 << b for b in c) for c in combinations(width_bits, n)]
    return np.array(masks, np.uint64)


def _probe_from(max_bits: int) -> int:
    """Buckets of more rows are probed: from here on the flips are fewer than the rows."""
    free = BITS - segments(max_bits)[0][1] + 1
    return sum(comb(free, n) for n in range(max_bits + 1))


def _bucket_links(fp: np.ndarray, slot: int, parts: list[tuple[int, int]], max_bits: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) with a < b inside one large bucket, by probing bit flips in
    sorted order: cost is the bucket's size times a constant."""
    shift, width = parts[slot // BITS]
    wild = shift + slot % BITS
    inside = {b for b in range(shift, shift + width)}
    free = [b for b in range(BITS) if b not in inside] + [wild]
    fp = np.sort(fp)
    found_a, found_b = [], []
    for m in _flips(free, max_bits)[1:]:
        other = fp ^ m
        at = np.minimum(np.searchsorted(fp, other), len(fp) - 1)
        hit = (fp[at] == other) & (fp < other)
        if hit.any():
            found_a.append(fp[hit])
            found_b.append(other[hit])
    none = np.zeros(0, np.uint64)
    return (np.concatenate(found_a) if found_a else none, np.concatenate(found_b) if found_b else none)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the same components, one per node that is not a root."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = flat[:len(a)], flat[len(a):]
    parent = np.arange(len(nodes))
    while True:
        pa_, pb = parent[ia], parent[ib]
        lo, hi = np.minimum(pa_, pb), np.maximum(pa_, pb)
        if (lo == hi).all():
            break
        np.minimum.at(parent, hi, lo)
        while (parent != parent[parent]).any():
            parent = parent[parent]
    child = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[parent[child]], nodes[child]


def _links(max_bits: int):
    """mapInArrow over signatures sorted by (slot, rest): verified links."""
    parts, probe_from = segments(max_bits), _probe_from(max_bits)

    def canonical(a, b, slot):
        """Is this the first (segment, wildcard) under which a and b meet?"""
        d = a ^ b
        ok = np.zeros(len(d), bool)
        settled = np.zeros(len(d), bool)
        for k, (shift, width) in enumerate(parts):
            in_seg = (d >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            first = _popcount(in_seg) <= 1
            wild = np.where(in_seg == 0, 0, np.log2(np.maximum(in_seg, 1).astype(np.float64)).astype(np.int64))
            ok |= first & ~settled & (slot == k * BITS + wild)
            settled |= first
        return ok

    def of_block(slot, rest, fp):
        """Links of whole buckets that lie one after the other."""
        out_a, out_b = [], []
        new = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | (rest[1:] != rest[:-1])])
        sizes = np.diff(np.r_[new, len(slot)])
        for i in np.flatnonzero(sizes > probe_from):
            lo, hi = new[i], new[i] + sizes[i]
            a, b = _bucket_links(fp[lo:hi], int(slot[lo]), parts, max_bits)
            keep = canonical(a, b, np.full(len(a), slot[lo]))
            out_a.append(a[keep])
            out_b.append(b[keep])
        small = np.repeat(sizes <= probe_from, sizes) & np.repeat(sizes > 1, sizes)
        slot, rest, fp = slot[small], rest[small], fp[small]
        for lag in range(1, probe_from):
            if lag >= len(fp):
                break
            same = (slot[lag:] == slot[:-lag]) & (rest[lag:] == rest[:-lag])
            if not same.any():
                break
            i = np.flatnonzero(same)
            x, y = fp[i], fp[i + lag]
            near = (_popcount(x ^ y) <= max_bits) & (x != y)
            i, x, y = i[near], x[near], y[near]
            keep = canonical(x, y, slot[i])
            out_a.append(np.minimum(x, y)[keep])
            out_b.append(np.maximum(x, y)[keep])
        return out_a, out_b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                                   # the rows of a bucket still open
        got_a, got_b, n = [], [], 0

        def flush():
            a, b = _forest(np.concatenate(got_a), np.concatenate(got_b))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                              names=["a", "b"])
        def blocks():
            nonlocal held
            for batch in batches:
                cols = [batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64),
                        batch.column(1).to_numpy(zero_copy_only=False),
                        batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)]
                if not len(cols[0]):
                    continue
                if held is not None:
                    cols = [np.concatenate(x) for x in zip(held, cols)]
                edge = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))
                cut = int(edge[-1]) + 1 if len(edge) else 0
                held = [c[cut:] for c in cols]
                if cut:
                    yield [c[:cut] for c in cols]
            if held is not None and len(held[0]):
                yield held

        for block in blocks():
            a, b = of_block(*block)
            got_a += a
            got_b += b
            n += sum(map(len, a))
            if n >= LINKS_PER_FLUSH:
                yield flush()
                got_a, got_b, n = [], [], 0
        if n:
            yield flush()
    return run


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints ``fp`` (distinct) at
    ``max_bits`` or fewer differing bits into their components."""
    sig = fps.select("fp").mapInArrow(_signatures(max_bits), "slot short, rest long, fp long")
    dealt = sig.repartition(shuffle_width(fps.sparkSession), "slot", "rest") \
        .sortWithinPartitions("slot", "rest")
    return dealt.mapInArrow(_links(max_bits), "a long, b long")


def _groups(base: DataFrame, max_bits: int) -> DataFrame:
    """``base (.., fp)`` -> ``(fp, root)``: of each distinct fingerprint, the smallest
    fingerprint that links reach (as a signed long)."""
    distinct = written(base.select("fp").distinct(), "op2-distinct")
    comp = connected_components(links(distinct, max_bits), "op2-cc")
    # written, so that AQE can split a hot fingerprint where documents join it
    return written(distinct.join(comp, distinct["fp"] == comp["node"], "left")
                   .select("fp", F.coalesce("root", "fp").alias("root")), "op2-groups")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (long), component_id (the smallest
    doc_id that links reach)."""
    base = written(fingerprints(docs, id_col, text_col, shingle), "op2-fp")
    named = base.join(_groups(base, max_bits), "fp")
    # written, so that AQE can split the join on a root of very many documents
    smallest = written(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "op2-smallest")
    return named.join(smallest, "root").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest doc_id (null: last),
    among equals the one with the smallest hash of its text, and of repeated rows one."""
    version = F.xxhash64("text").alias("version")
    view = doc_view(docs, id_col, text_col)
    print_ = _fingerprint_column(shingle)(F.col("text")).alias("fp")
    base = written(view.select("doc_id", version, print_), "op2-fp")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "version")
    keep = base.join(_groups(base, max_bits), "fp").groupBy("root").agg(F.min(place).alias("at")) \
        .select("at.doc_id", "at.version").alias("k")
    rows = doc_view(docs, id_col, text_col, F.struct(F.col("*")).alias("row")) \
        .select("row", "doc_id", version).alias("d")
    kept = rows.join(keep, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
                     & (F.col("d.version") == F.col("k.version")), "left_semi")
    one = Window.partitionBy("doc_id", "version").orderBy("version")
    return kept.select("row", F.row_number().over(one).alias("n")).where("n = 1").select("row.*")
