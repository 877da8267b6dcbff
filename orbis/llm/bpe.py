r"""BPE encoding and decoding by speculate-and-verify (operator 9).

For every word not met before in the worker process the longest vocabulary entry is taken from
the left again and again: a guess at its tokens.  A token sequence is what the
merges would give exactly if each token builds itself by its own merges and no
adjacent pair would have merged across its border at any time.  Both tests run
vectorised over all distinct adjacent pairs of the new words: going back in merge order,
the two tokens next to the border are taken apart, and a merge of the two pieces that
ranks before either piece was used up refutes the pair.  Only words with a refuted pair
are merged step by step.

Words are cut as the tokenizer file says (NFC, lower case, white space dropped, the
split pattern).  Texts of ASCII and Latin-1 go through white-space chunks, each worked
out once per worker; any other text is normalised and split by the library's own
normaliser and splitter, and only then encoded here.  Whole texts are encoded;
a very long text is one row.

Defined results: null text counts as empty (no tokens, empty decoded text); strings of
special tokens in a text become their ids; a null doc_id is returned as it is; repeated
rows are encoded each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orbis.llm.common import distinct_words, doc_view, gather, process_cache, release_memory, ship

ship(__name__)

END = "</w>"
NEVER = np.int64(1) << 60
CACHE_CHUNKS = 120_000
#: characters that NFC leaves alone, that lower-case one by one, and whose white
#: space is the ASCII one: printable ASCII, its white space, Latin-1 letters and signs,
#: OE ligatures, general dashes and quotes, the euro sign
PLAIN = re.compile("[\t-\r -~\xa1-\xac\xae-\xffŒœ‐-‧€]*")
MARKS = frozenset(".,;:!?")
# fixed values: the split pattern of the tokenizer file
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the rest count up from U+0100."""
    out, extra = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


class Vocabulary:
    """Look-up arrays of a BPE tokenizer file with an end-of-word suffix."""

    def __init__(self, file_json: str):
        spec = json.loads(file_json)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = n = max(max(vocab.values()), *self.special.values(), 0) + 1
        self.token = [""] * n
        for table in (vocab, self.special):
            for t, i in table.items():
                self.token[i] = t
        self.letters = byte_letters()
        back = {c: b for b, c in enumerate(self.letters)}
        self.mid: dict[bytes, int] = {}
        self.end: dict[bytes, int] = {}
        for t, i in vocab.items():
            last = t.endswith(END) and len(t) > len(END)
            raw = bytes(back[c] for c in (t[:-len(END)] if last else t))
            (self.end if last else self.mid)[raw] = i
        self.longest = max(map(len, [*self.mid, *self.end]))
        # merge r makes token made[r] of left[r] and right[r]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.left = np.full(n, -1, np.int64)
        self.right = np.full(n, -1, np.int64)
        self.rank = np.full(n, -1, np.int64)              # -1: a single byte
        keys, made = [], []
        for r, (a, b) in enumerate(pairs):
            i, ia, ib = vocab[a + b], vocab[a], vocab[b]
            keys.append(ia * n + ib)
            made.append(i)
            if self.rank[i] < 0:
                self.rank[i], self.left[i], self.right[i] = r, ia, ib
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.pair_key = np.array(keys, np.int64)[order]
        self.pair_rank = order.astype(np.int64)
        self.made = np.array(made, np.int64)
        self.sound = self._sound()

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NEVER)

    def border_holds(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """For each pair: does no merge across the border of a and b come before
        rank ``limit`` while both its pieces are there?"""
        a, b = a.copy(), b.copy()
        used_a, used_b = limit.copy(), limit.copy()       # rank at which a piece is used up
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            m = self._rank_of(x, y)
            # of two equal merges side by side the left one comes first
            bad = (m < used_a[live]) & (m <= used_b[live]) & (m < limit[live])
            good[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            live = live[~bad & ((rx >= 0) | (ry >= 0))]
            x, y, rx, ry = a[live], b[live], self.rank[a[live]], self.rank[b[live]]
            back_a = rx > ry
            ia, ib = live[back_a], live[~back_a]
            used_a[ia], a[ia] = rx[back_a], self.right[x[back_a]]
            used_b[ib], b[ib] = ry[~back_a], self.left[y[~back_a]]
        return good

    def _sound(self) -> np.ndarray:
        """Which tokens do their own merges build?  By growing rank."""
        made = np.flatnonzero(self.rank >= 0)
        own = self.border_holds(self.left[made], self.right[made], self.rank[made])
        sound = self.rank < 0
        for i, ok in zip(made[np.argsort(self.rank[made])], own[np.argsort(self.rank[made])]):
            sound[i] = ok and sound[self.left[i]] and sound[self.right[i]]
        return sound

    def guess(self, word: bytes) -> list[int]:
        """Longest matches from the left; the last token ends the word."""
        out, at, n = [], 0, len(word)
        mid, end, longest = self.mid, self.end, self.longest
        while at < n:
            if n - at <= longest and (t := end.get(word[at:])) is not None:
                out.append(t)
                break
            for stop in range(min(n - 1, at + longest), at, -1):
                if (t := mid.get(word[at:stop])) is not None:
                    out.append(t)
                    at = stop
                    break
        return out

    def exact(self, words: list[bytes]) -> list[list[int]]:
        """The merges themselves, for all words side by side: in every step each word
        makes its lowest-ranking merge, the leftmost of equals."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        last = np.zeros(len(raw), bool)
        last[np.cumsum(sizes) - 1] = True
        single = [np.array([table[bytes([b])] for b in range(256)]) for table in (self.mid, self.end)]
        ids = np.where(last, single[1][raw], single[0][raw])
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[list[int]] = [[] for _ in words]
        while len(ids):
            rank = np.full(len(ids), NEVER)
            rank[:-1] = np.where(word[1:] == word[:-1], self._rank_of(ids[:-1], ids[1:]), NEVER)
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, start)
            size = np.diff(np.r_[start, len(ids)])
            for i in np.flatnonzero(best == NEVER):
                done[word[start[i]]] = ids[start[i]:start[i] + size[i]].tolist()
            hit = np.flatnonzero((rank == np.repeat(best, size)) & (rank < NEVER))
            hit = hit[np.r_[True, word[hit][1:] != word[hit][:-1]]] if len(hit) else hit
            ids[hit] = self.made[rank[hit]]
            stay = np.repeat(best < NEVER, size)
            stay[hit + 1] = False
            ids, word = ids[stay], word[stay]
        return done

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of distinct words (UTF-8, normalised)."""
        guesses = [self.guess(w) for w in words]
        sizes = np.fromiter(map(len, guesses), np.int64, len(guesses))
        flat = np.fromiter((t for g in guesses for t in g), np.int64, int(sizes.sum()))
        word = np.repeat(np.arange(len(words)), sizes)
        wrong = np.zeros(len(words), bool)
        wrong[word[~self.sound[flat]]] = True
        inner = np.flatnonzero(word[1:] == word[:-1])
        if len(inner):
            pair, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
            holds = self.border_holds(pair // self.size, pair % self.size,
                                      np.full(len(pair), NEVER))
            wrong[word[inner[~holds[back]]]] = True
        again = np.flatnonzero(wrong)
        for i, ids in zip(again, self.exact([words[i] for i in again]) if len(again) else []):
            guesses[i] = ids
        return guesses


def encode_plain(texts: list[str], known: dict[str, bytes], learn: Callable[[set[str]], None]
                 ) -> Iterator[bytes]:
    """Ids of texts inside ``PLAIN``: each distinct white-space chunk of the block is looked
    up once (``learn`` adds those not in ``known``), then the ids are gathered in numpy."""
    if not texts:
        return
    offsets, number, chunks = distinct_words(pa.array([t.lower() for t in texts], pa.string()))
    new = {c for c in chunks if c}.difference(known)
    if new:
        learn(new)
    ids, ends = gather([known[c] if c else b"" for c in chunks], number)
    ends = np.r_[0, ends][offsets]
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield ids[a:b].tobytes()
    release_memory()


class Encoder:
    """Texts to ids; remembers what it worked out, up to a bounded number of chunks.
    ``Encoder.shared`` is one per Python worker process, for all its tasks."""

    @classmethod
    def shared(cls, file_json: str) -> Encoder:
        at = ("bpe", hashlib.sha256(file_json.encode()).hexdigest())
        kept = process_cache()
        if at not in kept:
            kept[at] = cls(file_json)
        return kept[at]

    def __init__(self, file_json: str):
        import regex
        self.json = file_json
        self.vocab = Vocabulary(file_json)
        self.split = regex.compile(SPLIT)
        special = sorted(self.vocab.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.chunks: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.library = None

    def _words(self, words: list[bytes]) -> None:
        for w, ids in zip(words, self.vocab.encode_words(words)):
            self.words[w] = array("I", ids).tobytes()

    def _learn(self, chunks: set[str]) -> None:
        """Letters alone, or with one mark behind them, need no pattern to be split."""
        cut = [[c] if c.isalpha() else [c[:-1], c[-1]] if c[-1] in MARKS and c[:-1].isalpha()
               else self.split.findall(c) for c in chunks]
        self._words(list({w.encode() for ws in cut for w in ws}.difference(self.words)))
        known = self.words
        for c, ws in zip(chunks, cut):
            self.chunks[c] = b"".join([known[w.encode()] for w in ws])

    def _other(self, text: str) -> bytes:
        """A text outside ``PLAIN``: the library normalises and splits it."""
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_str(self.json)
        back = {c: b for b, c in enumerate(self.vocab.letters)}
        norm = self.library.normalizer.normalize_str(text)
        words = [bytes(back[c] for c in w)
                 for w, _ in self.library.pre_tokenizer.pre_tokenize_str(norm)]
        self._words(list({w for w in words if w}.difference(self.words)))
        return b"".join([self.words[w] for w in words if w])

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if len(self.chunks) > CACHE_CHUNKS or len(self.words) > CACHE_CHUNKS:
            self.chunks.clear()
            self.words.clear()
        plain = [bool(PLAIN.fullmatch(t)) and not (self.special and "<|" in t and self.special.search(t))
                 for t in texts]
        done = encode_plain([t for t, ok in zip(texts, plain) if ok], self.chunks, self._learn)
        return [next(done) if ok else self._mixed(t) for t, ok in zip(texts, plain)]

    def _mixed(self, text: str) -> bytes:
        out = []
        for part in (self.special.split(text) if self.special else [text]):
            if part in self.vocab.special:
                out.append(np.array([self.vocab.special[part]], "<u4").tobytes())
            elif part:
                out.append(self._other(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Tokens joined by a space: the file names no decoder."""
        token = self.vocab.token
        return " ".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


def text_blocks(batch: pa.RecordBatch, limit: int = 4 << 20) -> Iterator[tuple[int, list[str]]]:
    """(offset, texts) of column 1 in runs of about ``limit`` characters."""
    start, held, size = 0, [], 0
    for i, t in enumerate(batch.column(1)):
        held.append(t.as_py())
        size += len(held[-1])
        if size >= limit:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (binary, little-endian unsigned 32 bit),
    decoded text."""
    with open(tokenizer_path, encoding="utf-8") as f:
        file_json = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.shared(file_json)
        for b in batches:
            for start, texts in text_blocks(b):
                ids = enc.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(start, len(texts)), pa.array(ids, pa.binary()),
                     pa.array([enc.decode(x) for x in ids], pa.string())],
                    names=["doc_id", "ids", "decoded"])
    view = doc_view(docs, id_col, text_col)
    return view.mapInArrow(run, f"doc_id {dict(view.dtypes)['doc_id']}, ids binary, decoded string")


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, digested where the
    ids are made."""
    with open(tokenizer_path, encoding="utf-8") as f:
        file_json = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.shared(file_json)
        for b in batches:
            for start, texts in text_blocks(b):
                ids = enc.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(start, len(texts)),
                     pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                     pa.array([hashlib.sha256(enc.decode(x).encode()).hexdigest() for x in ids])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    view = doc_view(docs, id_col, text_col)
    return view.mapInArrow(run, f"doc_id {dict(view.dtypes)['doc_id']}, n_tokens long, "
                                "ids_sha256 string, decoded_sha256 string")
