"""Packing by power-of-two decomposition (operator 4).

A document of n tokens (its ids and the end id) is cut into pieces whose lengths are
the powers of two that make up n, longest first, the longest being the sequence length
itself as often as it fits.  A piece is a sequence: its length is a power of two, so it
needs no padding, and no sequence crosses documents.  Pieces of equal length share
a bucket; ``sequence_id`` counts through the buckets, longest first, without gaps, so a
batch of equal shapes is a range of ids.

Numbering needs no global sort: tasks number their pieces within each length, and the
small table of counts per (task, length) turns these numbers into places.

Ids come from the ``tokenizers`` library.  Of plain texts it sees each distinct
white-space chunk of a block, if it was not met shortly before (its pre-tokenizer cuts at white space and drops it, so
chunks are encoded as in place; ``bpe.PLAIN`` says for which characters this holds), and
every other text whole.

Defined results: null and empty texts are the end id alone (one piece of length 1); a
very long text is one row of pieces as any other; a null doc_id is returned as it is;
repeated rows are packed each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbis.llm.bpe import MARKS, PLAIN, encode_plain, text_blocks
from orbis.llm.common import doc_view, process_cache, ship, written

ship(__name__)

MAX_LENGTH = 4096
END_ID = 2
CACHE_CHUNKS = 200_000


class LibraryEncoder:
    """The tokenizers library behind a bounded memory of chunks."""

    def __init__(self, file_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(file_json)
        self.library.no_truncation()
        self.library.no_padding()
        self.chunks: dict[str, bytes] = {}
        vocab = self.library.get_vocab()
        self.is_end = np.zeros(max(vocab.values()) + 1, bool)
        self.is_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    @classmethod
    def shared(cls, file_json: str) -> LibraryEncoder:
        at = ("library", zlib.crc32(file_json.encode()), len(file_json))
        kept = process_cache()
        if at not in kept:
            kept[at] = cls(file_json)
        return kept[at]

    def _batch(self, texts: list[str]) -> list[bytes]:
        got = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in got]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only.  Such a word is one pre-token, whose last token --
        and no other -- carries the end mark, so many words go through the library as one
        text and are told apart by their ends."""
        if not words:
            return []
        lines = [" ".join(words[i:i + 500]) for i in range(0, len(words), 500)]
        raw = b"".join(self._batch(lines))
        ends = (4 * (np.flatnonzero(self.is_end[np.frombuffer(raw, "<u4")]) + 1)).tolist()
        assert len(ends) == len(words)
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, chunks: set[str]) -> None:
        """Letters with one mark behind them are two pre-tokens: learned apart."""
        known = self.chunks
        marked = [c for c in chunks if c[-1] in MARKS and c[:-1].isalpha()]
        new = chunks.difference(marked).union([c[:-1] for c in marked], [c[-1] for c in marked]) \
            .difference(known)
        words = [c for c in new if c.isalpha()]
        known.update(zip(words, self._letters(words)))
        others = list(new.difference(words))
        known.update(zip(others, self._batch(others)))
        for c in marked:
            known[c] = known[c[:-1]] + known[c[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.chunks) > CACHE_CHUNKS:
            self.chunks.clear()
        plain = [bool(PLAIN.fullmatch(t)) and "<|" not in t for t in texts]
        done = encode_plain([t for t, ok in zip(texts, plain) if ok], self.chunks, self._learn)
        whole = iter(self._batch([t for t, ok in zip(texts, plain) if not ok]))
        return [next(done if ok else whole) for ok in plain]


def piece_lengths(n: int, most: int = MAX_LENGTH) -> list[int]:
    """Powers of two that add up to ``n``, the longest first, none over ``most``."""
    rest = n % most
    return [most] * (n // most) + [1 << k for k in range(most.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         max_length: int = MAX_LENGTH, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and (``keep_ids``) the ids as little-endian unsigned 32-bit integers.
    ``max_length`` must be a power of two."""
    if max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    with open(tokenizer_path, encoding="utf-8") as f:
        file_json = f.read()
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        enc = LibraryEncoder.shared(file_json)
        seen = dict.fromkeys((1 << k for k in range(max_length.bit_length())), 0)
        for b in batches:
            for first, texts in text_blocks(b):
                doc, start, length, crc, total, rank, ids = [], [], [], [], [], [], []
                for i, x in enumerate(enc.encode(texts)):
                    x += tail
                    n, at = len(x) // 4, 0
                    for size in piece_lengths(n, max_length):
                        piece = x[4 * at:4 * (at + size)]
                        doc.append(i)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        rank.append(seen[size])
                        ids.append(piece if keep_ids else None)
                        seen[size] += 1
                        at += size
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)).take(pa.array(doc, pa.int64())),
                     *[pa.array(c, pa.int64()) for c in (start, length, crc, total, rank)],
                     pa.array([task] * len(doc), pa.int32()), pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank", "task", "ids"])

    view = doc_view(docs, id_col, text_col)
    schema = (f"doc_id {dict(view.dtypes)['doc_id']}, start long, length long, ids_crc32 long, "
              "doc_tokens long, rank long, task int, ids binary")
    pieces = view.mapInArrow(run, schema)
    pieces = written(pieces if keep_ids else pieces.drop("ids"), "op4-pieces")

    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    in_bucket = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(in_bucket), F.lit(0)).alias("before"))
    # thirteen rows at most: one per length
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    base = pieces.groupBy("length").agg(F.count("*").alias("n")) \
        .select("length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("base"))
    place = before.join(base, "length")
    out = pieces.join(place, ["length", "task"])
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("base") + F.col("before") + F.col("rank")).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset")]
    return out.select(*cols, *(["ids"] if keep_ids else []))
