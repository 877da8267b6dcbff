r"""Quality classifier: supervised subword embeddings (operator 6).

Every word has a learned vector: the sum of the vectors of its hashed features (the
word itself and its character n-grams with edge marks).  Of word bigrams one class is
learned: a word that follows itself.  A document is the average of its feature vectors, a softmax over the two labels reads it, and everything is trained
by stochastic gradient descent in numpy.

The model is fitted on at most ``sample`` labelled documents (a documented bound:
those with the smallest hash of their id, so the same documents at every run), from
feature shares made by the executors, where every word of a sampled text counts; documents whose
crc32 remainder is held out never take part.  Each label is offered half of the sample; the intercept is then
shifted to the label shares of the whole label table.  Scoring covers every whole text: since the average and the layer above
are linear, a word's features add up to one number, worked out once per distinct word of a block.

Defined results: null text counts as empty; a text without words gets the score of the
label shares alone; ids without a label and labels without a document are not
learned from, conflicting labels of one id count as rows of their own; with no labels at
all every score is 0.5; a null doc_id is not held out; repeated rows are scored each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbis.llm.common import distinct_words, doc_view, drop_caches, limit_batches, release_memory, ship

ship(__name__)

BUCKETS = 1 << 16
DIM = 12
NGRAMS = (3, 4)
EPOCHS = 6
RATE = 0.5
SEED = 7
SAMPLE = 3000
THRESHOLD = 0.7
BLOCK_BYTES = 1 << 20
WORDS_AT_ONCE = 1 << 16
REPEAT = "\n"                   # no word: the class of bigrams of two equal words
REPEAT_WEIGHT = 12              # features that such a bigram counts as


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of the word) of every feature of ``words``: the word itself and its
    character n-grams with edge marks; ``REPEAT`` stands for its bigram class."""
    from xxhash import xxh3_64_intdigest
    n = len(words)
    whole = np.fromiter((xxh3_64_intdigest(w.encode("utf-8", "replace")) for w in words), np.uint64, n)
    text = "".join([f"<{w}>" for w in words])
    point = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    own = np.repeat(np.arange(n, dtype=np.int32), np.fromiter(map(len, words), np.int64, n) + 2)
    hashes, owners = [whole], [np.arange(n, dtype=np.int32)]
    for k in NGRAMS:
        if len(point) < k:
            continue
        inside = own[k - 1:] == own[:len(own) - k + 1]
        h = np.full(len(point) - k + 1, k, np.uint64)
        for j in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + point[j:len(point) - k + 1 + j]
        hashes.append(h[inside])
        owners.append(own[:len(h)][inside])
    h, owner = np.concatenate(hashes), np.concatenate(owners)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    bucket = (h >> np.uint64(40)).astype(np.int32) % BUCKETS
    again = np.array([w == REPEAT for w in words], bool)
    if again.any():
        rest = ~again[owner]
        bucket = np.r_[bucket[rest], np.full(int(again.sum()) * REPEAT_WEIGHT, BUCKETS - 1)]
        owner = np.r_[owner[rest], np.repeat(np.flatnonzero(again), REPEAT_WEIGHT)]
    return bucket, owner


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def repeats(words: list) -> int:
    """How often a word follows itself."""
    return sum(map(eq, words, words[1:]))


def train(rows: Iterable[tuple[list[str], list[int], int]], share: float) -> tuple[np.ndarray, float]:
    """Per-bucket logit weight and intercept from (words, counts, label) rows;
    ``share``: of label 1 among all that could have been sampled."""
    return learn([(*shares(words, counts), y) for words, counts, y in rows], share)


def shares(words: list[str], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, their shares) of all features of ``words`` that occur ``counts`` times."""
    n = np.zeros(BUCKETS)
    for i in range(0, len(words), WORDS_AT_ONCE):
        bucket, owner = features(words[i:i + WORDS_AT_ONCE])
        n += np.bincount(bucket, np.array(counts[i:i + WORDS_AT_ONCE], np.float64)[owner], BUCKETS)
    f = np.flatnonzero(n)
    return f.astype(np.int32), (n[f] / max(n.sum(), 1)).astype(np.float32)


def learn(bags: list[tuple[np.ndarray, np.ndarray, int]], share: float) -> tuple[np.ndarray, float]:
    """``train`` from (buckets, their shares, label) rows."""
    if not bags:
        return np.zeros(BUCKETS), 0.0
    rng = np.random.default_rng(SEED)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((2, DIM), np.float32)
    odds = lambda p: float(np.log(min(max(p, 0.001), 0.999) / (1 - min(max(p, 0.001), 0.999))))
    of_sample = odds(float(np.mean([y for _, _, y in bags])))
    bias = np.array([0.0, of_sample], np.float32)
    total, step = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            f, n, y = bags[i]
            rate = RATE * (1 - step / total)
            step += 1
            hidden = n @ emb[f]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1                                  # gradient of the cross entropy
            grad = p @ out
            out -= rate * np.outer(p, hidden)
            bias -= 0.1 * rate * p
            emb[f] -= rate * n[:, None] * grad[None, :]
    return (emb @ (out[1] - out[0])).astype(np.float64), float(bias[1] - bias[0]) + odds(share) - of_sample


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        bags = []
        for t in b.column(1).cast(pa.binary()):
            words = [w.decode("utf-8", "replace") for w in t.as_py().split()]
            bag = Counter(words)
            if n := repeats(words):
                bag[REPEAT] = n
            bags.append(shares(list(bag), list(bag.values())))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([f for f, _ in bags], pa.list_(pa.int32())),
             pa.array([n for _, n in bags], pa.list_(pa.float32())),
             b.column(2)], names=["k", "buckets", "shares", "label"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Weights from at most ``sample`` labelled documents outside the held-out part.
    The bounded list of ids is chosen on the label table alone, then joined."""
    known = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("label")) \
        .where(F.col("k").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("k")))
    there = known.join(docs.select(F.col(id_col).alias("k")), "k", "left_semi")
    # rare labels count in full: half of the sample is offered to each label
    picked = [there.where(F.col("label") == y).orderBy(F.xxhash64("k"), "k").limit(sample // 2)
              for y in (0, 1)]
    chosen = picked[0].unionAll(picked[1])
    texts = doc_view(docs, id_col, text_col).withColumnRenamed("doc_id", "k")
    bags = texts.join(F.broadcast(chosen), "k").select("k", "text", "label").mapInArrow(
        _counts, f"k {dict(texts.dtypes)['k']}, buckets array<int>, shares array<float>, label int")
    table = bags.toArrow()                       # at most ``sample`` rows of at most BUCKETS entries
    table = table.take(pc.sort_indices(table, [("k", "ascending"), ("label", "ascending")]))
    n = {r["label"]: r["count"] for r in there.groupBy("label").count().collect()}   # two rows
    rows = [(f.values.to_numpy(), n.values.to_numpy(), y.as_py()) for f, n, y in
            zip(*(table.column(c) for c in ("buckets", "shares", "label")))]
    return learn(rows, n.get(1, 0) / max(sum(n.values()), 1))


def text_blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, number) of texts in runs of about ``BLOCK_BYTES``."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(texts):
        before = size[first - 1] if first else 0
        last = max(int(np.searchsorted(size, before + BLOCK_BYTES, side="right")), first + 1)
        yield first, last - first
        first = last


def _scores(weights: np.ndarray, bias: float):
    """Arrow UDF over texts: the probability of label 1."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        drop_caches()
        bucket, _ = features([REPEAT])
        rep, rep_n = weights[bucket].sum(), len(bucket)
        for texts in batches:
            out = []
            for first, n_texts in text_blocks(texts):
                offsets, number, words = distinct_words(texts.slice(first, n_texts))
                bucket, owner = features(words)
                there = np.fromiter(map(bool, words), bool, len(words))
                logit = np.bincount(owner, weights[bucket], len(words)) * there
                count = np.bincount(owner, minlength=len(words)) * there
                doc = np.repeat(np.arange(n_texts), np.diff(offsets))
                again = np.bincount(doc[1:][(number[1:] == number[:-1]) & (doc[1:] == doc[:-1])],
                                    minlength=n_texts)
                total = np.bincount(doc, logit[number], n_texts) + again * rep
                n = np.bincount(doc, count[number], n_texts) + again * rep_n
                out.append(total / np.maximum(n, 1) + bias)
            z = np.clip(np.concatenate(out) if out else np.zeros(0), -500, 500)
            release_memory()
            yield pa.array(1 / (1 + np.exp(-z)))
    return F.arrow_udf(run, "double")


def quality_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", sample: int = SAMPLE) -> Column:
    """A column of ``docs``: the fitted model's score of each text."""
    limit_batches(docs.sparkSession)
    weights, bias = fit(docs, labels, id_col, text_col, sample=sample)
    return _scores(weights.astype(np.float32), bias)(F.coalesce(F.col(text_col), F.lit("")))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    score = quality_score(docs, labels, id_col, text_col, sample)
    scored = docs.select(F.col(id_col).alias("doc_id"), score.alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose text scores ``THRESHOLD`` or more, columns unchanged."""
    row = F.struct(F.col("*")).alias("row")
    scored = docs.select(row, quality_score(docs, labels, id_col, text_col, sample).alias("score"))
    return scored.where(F.col("score") >= THRESHOLD).select("row.*")
