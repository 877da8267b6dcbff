r"""Suffix-array dedup by external induced sorting (operator 8).

Every byte is removed that lies in a string of ``length`` (T) bytes which also starts
anywhere else, in this document or another.

*Sampling.*  Of the hashes of all ``gram``-byte strings that begin in a window of
T - gram + 1 places, the smallest one (the rightmost of equals) is the window's sampled
suffix.  Which one that is depends on the T bytes of the window alone, so equal T-byte
strings sample the same place.  About 1.5 % of all suffixes are sampled; the windows of
one sample follow each other without gaps.  Samples whose gram occurs once in
the corpus end here: none of their windows can repeat.

*Naming.*  A sample's context is the text its windows cover.  Contexts are named by
128 bits of hashes; one that occurs twice or more is removed whole, and one occurrence
stands for it from here on.  Equal contexts of an Arrow batch are one row with a list of
places as soon as they are found; across batches they are counted by map-side aggregation.
The places of the contexts that go meet again batch by batch (a batch bounds the
group) and leave as the runs they cover in each document, not one by one.

*Sorting and induction.*  What is left -- contexts that differ although they share their
gram, at the borders of repeats -- is sorted as suffixes.  Spark's external sorter (runs on
disk, merged by a priority queue) brings the sampled suffixes of a gram into order; their
common prefixes with their neighbours (LCP) are measured.  Then the order is induced
leftwards, one byte at a time, from suffix i to suffix i - 1: a stable distribution by the
byte before, LCP = 1 + the least LCP between two that were in line and share that byte,
0 where it differs.  Tuples (suffix, LCP) go through at most T - gram induction steps and leave as
soon as no later step can reach T.  A window is repeated where its suffix has LCP >= T
with a neighbour.  Grams are taken a block at a time, so a shard may be far larger
than memory.

A gram with more than ``hot`` different contexts (a passage that a large part of all
documents quote, each with other text around it) is not brought into one task: its
windows are named by 128-bit hashes and counted with map-side combining, which is exact too.

Defined results: null text is no bytes; texts shorter than T keep all, and a text of T bytes
or more is judged whole, however long (it is read in overlapping pieces); a null doc_id is an
id of its own; rows that repeat id and text are two places each, so both lose what they
share; an empty table gives no rows; other columns, whatever their names, come back in
``rest`` (which is left out if there are none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbis.llm.common import doc_view, drop_caches, release_memory, ship, shuffle_width, written

ship(__name__)

LENGTH = 200
GRAM = 64
HOT = 50_000
BLOCK_BYTES = 1 << 19
BLOCK_CONTEXTS = 10_000
_BASE = 0x5851F42D4C957F2D                 # odd, so it has an inverse modulo 2**64


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random 64-bit letters for bytes; powers of the base and of its inverse."""
    letters = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64)
    power = np.full(n, _BASE, np.uint64)
    inverse = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    power[0] = inverse[0] = 1
    return letters, np.multiply.accumulate(power), np.multiply.accumulate(inverse)


def sample(buf: np.ndarray, ends: np.ndarray, length: int, gram: int, tables
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sampled suffixes of the texts that end at ``ends`` in ``buf``: for each the first
    and last window start, its place and its gram's hash."""
    letters, power, inverse = tables
    w, n = length - gram + 1, len(buf)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.view(np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(letters[buf] * power[:n], out=total[1:])
    h = (total[gram:] - total[:-gram]) * inverse[:n - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    m = len(h)
    place = np.arange(m, dtype=np.uint64)
    rank = (h & ~np.uint64(0xFFFFFFFF)) | (np.uint64(0xFFFFFFFF) - place)
    # least rank of every w places in line, from least ranks of blocks of w
    padded = np.full(-(-m // w) * w, ~np.uint64(0), np.uint64)
    padded[:m] = rank
    grid = padded.reshape(-1, w)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    least = np.minimum(tail[:starts], head[w - 1:w - 1 + starts])
    at = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)
    inside = np.ones(starts, bool)                     # windows that do not cross texts
    for e in ends[:-1]:
        inside[max(e - length + 1, 0):e] = False
    valid = np.flatnonzero(inside)
    if not len(valid):
        return none, none, none, none.view(np.uint64)
    p = at[valid]
    first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
    last = np.r_[first[1:], len(p)] - 1
    return valid[first], valid[last], p[first], h[p[first]]


def _blocks(texts: pa.Array, length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Blocks of pieces (row, offset, bytes).  A text longer than a block is cut into
    pieces that overlap by length - 1 bytes, so every window is in exactly one piece."""
    held, size = [], 0
    for i, t in enumerate(texts):
        raw = t.as_py()
        for at in range(0, max(len(raw) - length + 1, 1), BLOCK_BYTES):
            held.append((i, at, raw[at:at + BLOCK_BYTES + length - 1]))
            size += len(held[-1][2])
            if size >= BLOCK_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _samples(length: int, gram: int):
    """mapInArrow (doc_id, text, version): one row for each different context of an Arrow
    batch, with the list of its places there.  A batch bounds the list; a context that
    all documents share is one row per batch from the start.  ``row`` of a place is its
    document's row in the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from xxhash import xxh3_64_intdigest
        tables = _tables(2 * BLOCK_BYTES + length)
        drop_caches()
        task = TaskContext.get()
        first_batch = (task.partitionId() if task else 0) << 32
        for number, b in enumerate(batches, first_batch):
            release_memory()
            found = []
            for pieces in _blocks(b.column(1).cast(pa.binary()), length):
                row, shift, held = zip(*pieces)
                raw = b"".join(held)
                ends = np.cumsum([len(t) for t in held])
                lo, hi, at, h = sample(np.frombuffer(raw, np.uint8), ends, length, gram, tables)
                if not len(lo):
                    continue
                names = np.fromiter((xxh3_64_intdigest(raw[s:e]) for s, e in
                                     zip(lo.tolist(), (hi + length).tolist())), np.uint64, len(lo))
                doc = np.searchsorted(ends, lo, side="right")
                own = (np.r_[0, ends[:-1]] - np.array(shift))[doc]
                found.append((h.view(np.int64), names.view(np.int64), (hi - lo).astype(np.int16),
                              (at - lo).astype(np.int16), np.array(row)[doc], (lo - own).astype(np.int32)))
            if not found:
                continue
            h, names, span, left, row, lo = map(np.concatenate, zip(*found))
            order = np.lexsort((names, h))
            h, names, span, left, row, lo = (x[order] for x in (h, names, span, left, row, lo))
            first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (names[1:] != names[:-1])])
            rows = pa.array(row)
            places = pa.StructArray.from_arrays(
                [b.column(0).take(rows), b.column(2).take(rows), pa.array(lo), pa.array(row.astype(np.int32))],
                names=["doc_id", "version", "lo", "row"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(first), number)), pa.array(h[first]), pa.array(names[first]),
                 pa.array(span[first]), pa.array(left[first]),
                 pa.ListArray.from_arrays(pa.array(np.r_[first, len(h)].astype(np.int32)), places)],
                names=["batch", "gram", "name", "span", "left", "places"])
    return run


def _runs(length: int):
    """mapInArrow (found): a batch's contexts that go, with their places.  One row for
    each run of bytes that they cover in a document."""
    def of_batch(found: pa.Array) -> pa.RecordBatch:
        lists = found.field("places")
        places = lists.flatten()
        span = np.repeat(found.field("span").to_numpy(zero_copy_only=False).astype(np.int64),
                         lists.value_lengths().to_numpy(zero_copy_only=False))
        start = places.field("lo").to_numpy(zero_copy_only=False).astype(np.int64)
        row = places.field("row").to_numpy(zero_copy_only=False)
        order = np.lexsort((start, row))
        start, row, end = start[order], row[order], (start + span + length)[order]
        # a later start never has an earlier end within a context, but contexts may overlap
        reach = np.maximum.accumulate(end + row.astype(np.int64) * (1 << 32)) - row.astype(np.int64) * (1 << 32)
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (start[1:] > reach[:-1])])
        last = np.r_[first[1:], len(row)] - 1
        own = pa.array(order[first])
        return pa.RecordBatch.from_arrays(
            [places.field("doc_id").take(own), places.field("version").take(own),
             pa.array(start[first]), pa.array(reach[last])], names=["doc_id", "version", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                yield of_batch(b.column(0).slice(k, 1).flatten())
    return run


def _matrix(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join([x.ljust(width, b"\0") for x in parts]), np.uint8).reshape(-1, width)


def induce(gram: np.ndarray, left: list[bytes], right: list[bytes], length: int
           ) -> tuple[np.ndarray, np.ndarray]:
    """Contexts in the order of (gram, right): ``right`` is the sampled suffix as far as
    the context goes, ``left`` the bytes before it.  Returns (context, bytes before the
    sample) of every window that equals another context's window."""
    n = len(gram)
    reach = np.fromiter(map(len, left), np.int64, n)
    size = np.fromiter(map(len, right), np.int64, n)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    r = _matrix(right, length)
    before = _matrix([x[::-1] for x in left], max(int(reach.max()), 1))
    same = r[1:] == r[:-1]
    common = np.where(same.all(axis=1), length, same.argmin(axis=1))
    common = np.minimum(common, np.minimum(size[1:], size[:-1]))
    common[gram[1:] != gram[:-1]] = 0
    group = np.cumsum(np.r_[0, gram[1:] != gram[:-1]])
    idx = np.arange(n)
    lcp = np.r_[0, common, 0]              # lcp[i]: of idx[i - 1] and idx[i]; 0 between groups
    found_i, found_e = [], []
    for e in range(int(reach.max()) + 1):
        best = np.maximum(lcp[:-1], lcp[1:])
        hit = idx[best >= length]
        if len(hit):
            found_i.append(hit)
            found_e.append(np.full(len(hit), e))
        stay = np.flatnonzero((reach[idx] > e) & (best + reach[idx] - e >= length))
        if len(stay) < 2:
            break
        # who leaves lends its neighbours the smaller of its two common prefixes
        lcp = np.r_[0, np.minimum.reduceat(lcp[:stay[-1] + 1], stay[:-1] + 1), 0]
        idx = idx[stay]
        byte = before[idx, e]
        by = np.argsort(byte, kind="stable")
        by = by[np.argsort(group[idx[by]], kind="stable")]
        i, j = by[:-1], by[1:]
        pair = np.flatnonzero((byte[i] == byte[j]) & (group[idx[i]] == group[idx[j]]))
        new = np.zeros(len(idx) + 1, np.int64)
        if len(pair):
            cuts = np.empty(2 * len(pair), np.int64)
            cuts[0::2], cuts[1::2] = i[pair] + 1, j[pair] + 1
            new[pair + 1] = np.minimum.reduceat(lcp, cuts)[::2] + 1
        idx, lcp = idx[by], new
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_i) if found_i else none, np.concatenate(found_e) if found_e else none)


def _induced(length: int):
    """mapInArrow over contexts sorted by (gram, right): the repeated stretches of
    contexts that occur once."""
    def of_block(rows: pa.Table) -> pa.RecordBatch:
        left = rows.column("left").to_pylist()
        i, e = induce(rows.column("gram").to_numpy(), left, rows.column("right").to_pylist(), length)
        once = rows.column("once").to_numpy()[i]
        i, e = i[once], e[once]
        start = rows.column("lo").to_numpy().astype(np.int64)[i] + \
            np.fromiter(map(len, left), np.int64, len(left))[i] - e
        order = np.lexsort((start, i))
        i, start = i[order], start[order]
        first = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (start[1:] - start[:-1] > length)]) \
            if len(i) else i
        last = np.r_[first[1:], len(i)] - 1 if len(i) else i
        own = pa.array(i[first])
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id").take(own).combine_chunks(), rows.column("version").take(own).combine_chunks(),
             pa.array(start[first], pa.int64()), pa.array(start[last] + length, pa.int64())],
            names=["doc_id", "version", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows < BLOCK_CONTEXTS:
                continue
            gram = held.column("gram").to_numpy()
            edge = np.flatnonzero(gram[1:] != gram[:-1])
            if len(edge):                               # whole grams only
                yield of_block(held.slice(0, int(edge[-1]) + 1))
                held = held.slice(int(edge[-1]) + 1)
        if held is not None and held.num_rows:
            yield of_block(held)
    return run


def _window_names(length: int):
    """mapInArrow over contexts of hot grams: one 128-bit name per window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        for b in batches:
            t = pa.Table.from_batches([b])
            rows, start, name = [], [], []
            for k, (l, r, lo) in enumerate(zip(*[t.column(c).to_pylist() for c in ("left", "right", "lo")])):
                text = l + r
                for s in range(len(text) - length + 1):
                    rows.append(k)
                    start.append(lo + s)
                    name.append(xxh3_128_digest(text[s:s + length]))
            own = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[t.column(c).take(own).combine_chunks() for c in ("doc_id", "version", "once")],
                 pa.array(start, pa.int64()), pa.array(name, pa.binary())],
                names=["doc_id", "version", "once", "s", "name"])
    return run


def _cut(texts: pa.Array, spans: pa.Array, keep_bytes: bool = True) -> pa.Array:
    """Removes the union of the spans (s, e) from each text."""
    removed, runs, kept = [], [], []
    for t, own in zip(texts, spans):
        if own.as_py() is None:
            removed.append(0)
            runs.append(0)
            kept.append(None)
            continue
        raw, at, gone, n, out = t.as_py(), 0, 0, 0, []
        raw = raw.encode() if isinstance(raw, str) else raw
        end = -1
        for x in sorted((x["s"], x["e"]) for x in own.as_py()):
            s, e = x
            if s > end:
                out.append(raw[at:s])
                n += 1
                gone += e - s
                at = end = e
            elif e > end:
                gone += e - end
                at = end = e
        out.append(raw[at:])
        removed.append(gone)
        runs.append(n)
        kept.append(b"".join(out))
    return pa.StructArray.from_arrays(
        [pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
        names=["n_removed", "n_spans", "kept"])


def _cut_column(text: Column, spans: Column) -> Column:
    def cut(texts: pa.Array, own: pa.Array) -> pa.Array:
        return _cut(texts, own)
    return F.arrow_udf(cut, "n_removed long, n_spans long, kept binary")(text, spans)


def whole_characters(kept: Column) -> Column:
    """``kept`` as text; the rest of a character that a cut took apart is left out."""
    def decode(parts: pa.Array) -> pa.Array:
        return pa.array([x.as_py().decode("utf-8", "ignore") if x.is_valid else None for x in parts],
                        pa.string())
    return F.arrow_udf(decode, "string")(kept)


def _same_doc(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & \
        (F.col(f"{a}.version") == F.col(f"{b}.version"))


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``rows (doc_id, text, version)`` -> ``(doc_id, version, s, e)``: spans in bytes
    whose union is all that is to be removed."""
    kind = dict(rows.dtypes)["doc_id"]
    samples = written(rows.mapInArrow(_samples(length, gram),
                                      "batch long, gram long, name long, span short, left short, "
                                      f"places array<struct<doc_id {kind}, version long, lo int, row int>>"),
                      "op8-samples")
    # written, so that the join below has plain shuffles on both sides: AQE can split a hot gram
    n = F.sum(F.size("places"))
    twice = written(samples.groupBy("gram").agg(n.alias("n")).where("n > 1").select("gram"), "op8-twice")
    shared = written(samples.join(twice, "gram", "left_semi"), "op8-shared")

    at = F.get("places", 0)
    place = F.struct(at["doc_id"].isNull().alias("no_id"), at["doc_id"].alias("doc_id"),
                     at["version"].alias("version"), at["lo"].alias("lo"), "span", "left")
    contexts = written(shared.groupBy("gram", "name").agg(n.alias("n"), F.min(place).alias("at")),
                       "op8-contexts")
    spans = f"doc_id {kind}, version long, s long, e long"
    # joined by (batch, context), not by place: a context of many places stays one row
    whole = shared.join(contexts.where("n > 1").select("gram", "name"), ["gram", "name"], "left_semi") \
        .groupBy("batch").agg(F.collect_list(F.struct("span", "places")).alias("found")) \
        .select("found").mapInArrow(_runs(length), spans)

    mixed = contexts.groupBy("gram").agg(F.count("*").alias("n_contexts"),
                                         F.min("n").alias("least")) \
        .where("n_contexts > 1 AND least = 1").select("gram", (F.col("n_contexts") > hot).alias("hot"))
    open_ = contexts.join(mixed, "gram").select(
        "gram", "hot", (F.col("n") == 1).alias("once"), "at.doc_id", "at.version", "at.lo", "at.span", "at.left")
    per_doc = open_.groupBy("doc_id", "version").agg(
        F.collect_list(F.struct("gram", "hot", "once", "lo", "span", "left")).alias("open"))

    def with_bytes(x: Column, raw: Column) -> Column:
        return F.struct(
            x["gram"].alias("gram"), x["hot"].alias("hot"), x["once"].alias("once"), x["lo"].alias("lo"),
            F.substring(raw, x["lo"] + 1, x["left"].cast("int")).alias("left"),
            F.substring(raw, x["lo"] + x["left"] + 1,
                        (x["span"] + F.lit(length) - x["left"]).cast("int")).alias("right"))
    joined = rows.alias("d").join(per_doc.alias("p"), _same_doc("d", "p"))
    cut = joined.select("d.doc_id", "d.version", F.explode(F.transform(
        F.array(F.struct(F.col("d.text").cast("binary").alias("raw"), F.col("p.open").alias("open"))),
        lambda t: F.transform(t["open"], lambda x: with_bytes(x, t["raw"])))[0]).alias("x")) \
        .select("doc_id", "version", "x.*")

    ordered = cut.where(~F.col("hot")).drop("hot").repartition(shuffle_width(rows.sparkSession), "gram") \
        .sortWithinPartitions("gram", "right")
    induced = ordered.mapInArrow(_induced(length), spans)

    windows = cut.where("hot").mapInArrow(_window_names(length),
                                          f"doc_id {kind}, version long, once boolean, s long, name binary")
    names = windows.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    counted = windows.where("once").join(names, "name", "left_semi") \
        .select("doc_id", "version", "s", (F.col("s") + length).alias("e"))
    return whole.unionAll(induced).unionAll(counted)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, ``kept`` (the
    remaining bytes) and the other columns of ``docs`` in a struct ``rest``."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    rows = doc_view(docs, id_col, text_col, *([F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest")]
                                              if others else [])) \
        .select("*", F.xxhash64("text").alias("version"))
    spans = repeated_spans(rows.select("doc_id", "text", "version"), length, gram, hot)
    per_doc = spans.groupBy("doc_id", "version").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    joined = rows.alias("d").join(per_doc.alias("p"), _same_doc("d", "p"), "left").select("d.*", "p.spans")
    raw = F.col("text").cast("binary")
    out = joined.select("doc_id", *(["rest"] if others else []), raw.alias("raw"),
                        _cut_column(F.when(F.col("spans").isNotNull(), raw), F.col("spans")).alias("cut"))
    return out.select("doc_id", *(["rest"] if others else []),
                      F.octet_length("raw").cast("long").alias("n_bytes"), "cut.n_removed", "cut.n_spans",
                      F.coalesce("cut.kept", "raw").alias("kept"))
