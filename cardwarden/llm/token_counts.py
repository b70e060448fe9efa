"""Token counts under a unigram segmentation, by dynamic programming over a trie of the pre-tokens.

A text is split at white space; each word, with a mark in front, is cut into pieces of a vocabulary so that the sum
of their scores is largest; of equal sums, the one with fewer pieces counts, then the one with the shorter last piece. The best score of a beginning of a
word is the same for all words that begin so. So the distinct new words of a task are sorted into a trie, the
scores are computed once per node, level by level for all nodes of a level at once, and a word's count is
read at the node where it ends.

The vocabulary's file gives its pieces by falling frequency, but no probabilities. These are estimated from the
documents by hard expectation maximisation: the distinct words of all documents are counted, cut by the scores so far, from
Zipf's law in the first round, and each piece gets the logarithm of its smoothed share of all pieces. The pieces
of a word are read from the trie, back from the node where it ends. Scores are whole thousandths, so that sums are exact.
A character without a piece counts as its bytes, each with the score of the rarest piece.
"""

from __future__ import annotations

import collections
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import drop, stored
from cardwarden.llm.words import mix

#: Put in front of each word.
MARK = "▁"
#: Words of which a task keeps the count, and words that are sorted into one trie.
KEPT, TOGETHER = 400_000, 20_000
#: Words longer than this are counted one by one.
LONG = 48
#: Characters after which a task gives out its words.
TEXT = 64_000_000
#: Added to the count of each piece.
ADD = 0.5
#: Rounds of estimation.
ROUNDS = 1

_SHIFT = 24  # a value is score * 2**24 - pieces: the larger the better
_LEAST = np.int64(-(1 << 62))
_BASE = 0x9E3779B97F4A7C15


def zipf_scores(pieces: list[str]) -> dict[str, int]:
    """Score of each piece, given by falling frequency."""
    return {p: -round(1000 * math.log(r + 2.7)) for r, p in enumerate(pieces)}


def estimated_scores(counts: dict[str, int]) -> dict[str, int]:
    """Score of each piece by how often it was used."""
    whole = sum(counts.values()) + ADD * len(counts)
    return {p: round(1000 * math.log((n + ADD) / whole)) for p, n in counts.items()}


class Unigram:
    def __init__(self, scores: dict[str, int]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.byte = min(scores.values(), default=-1)
        keys = np.array([self._hash(p) for p in scores], np.uint64)
        self.bits = (len(keys) * 4).bit_length()
        self.keys = np.zeros((1 << self.bits) + 64, np.uint64)
        self.values = np.full((1 << self.bits) + 64, _LEAST)
        self.pieces = np.full((1 << self.bits) + 64, -1, np.int32)
        self.probes = 1
        for number, (key, score) in enumerate(zip(keys.tolist(), scores.values(), strict=True)):
            slot = start = key >> (64 - self.bits)
            while self.keys[slot]:
                slot += 1
            self.keys[slot], self.values[slot], self.pieces[slot] = key, score, number
            self.probes = max(self.probes, slot - start + 1)

    @staticmethod
    def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        return codes, np.array([len(w) for w in words], np.int64)

    def _hash(self, piece: str) -> int:
        total = 0
        for c in mix(self._codes([piece])[0].astype(np.uint64) + np.uint64(1)).tolist():
            total = (total * _BASE + c) & (1 << 64) - 1
        return int(mix(np.array([total], np.uint64))[0])

    def _lookup(self, rolled: np.ndarray, values: np.ndarray | None = None, absent: int = _LEAST) -> np.ndarray:
        """Scores of substrings by their hash before mixing, or other values of theirs; very low where there is no such piece."""
        values = self.values if values is None else values
        key = mix(rolled)
        slot = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(key), absent, values.dtype)
        todo = np.arange(len(key))
        for _ in range(self.probes):
            held = self.keys[slot[todo]]
            hit = held == key[todo]
            out[todo[hit]] = values[slot[todo[hit]]]
            todo = todo[~hit & (held != 0)]
            if not len(todo):
                break
            slot[todo] += 1
        return out

    def count(self, words: list[str]) -> list[int]:
        """Pieces of each word (with its mark)."""
        out = [0] * len(words)
        short = sorted((w, i) for i, w in enumerate(words) if len(w) <= LONG)
        for at in range(0, len(short), TOGETHER):
            part = short[at : at + TOGETHER]
            for (_, i), n in zip(part, self._count_trie([w for w, _ in part]).tolist(), strict=True):
                out[i] = n
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self._count_one(w)
        return out

    def use(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """How often each piece is used when each word (with its mark) occurs so many times."""
        used = np.zeros(len(self.scores), np.int64)
        short = sorted((w, i) for i, w in enumerate(words) if len(w) <= LONG)
        for at in range(0, len(short), TOGETHER):
            part = short[at : at + TOGETHER]
            self._count_trie([w for w, _ in part], used, times[[i for _, i in part]])
        number = {p: i for i, p in enumerate(self.scores)} if len(short) < len(words) else {}
        for i, w in enumerate(words):
            if len(w) > LONG:
                d, last = len(w), self._cut_one(w)[1]
                while d:
                    if (piece := number.get(w[d - last[d] : d])) is not None:
                        used[piece] += times[i]
                    d -= last[d]
        return used

    def _count_trie(self, words: list[str], used: np.ndarray | None = None, times: np.ndarray | None = None) -> np.ndarray:
        """Pieces of each word; adds to used how often each piece occurs, each word that many times.

        words is sorted. Row r holds the nodes that its word adds to the trie: those below what it shares
        with the word before; `owner` names the row that holds the node of a row's beginning."""
        n = len(words)
        codes, length = self._codes(words)
        depth = int(length.max())
        grid = np.zeros((n, depth), np.uint32)
        grid[np.arange(depth) < length[:, None]] = codes
        same = np.zeros((n, depth), bool)
        same[1:] = grid[1:] == grid[:-1]
        shared = np.minimum.accumulate(same, axis=1).sum(1)
        shared[1:] = np.minimum(shared[1:], np.minimum(length[1:], length[:-1]))
        mapped = mix(grid.T.astype(np.uint64) + np.uint64(1))
        rolled = np.zeros((depth + 1, n), np.uint64)
        for d in range(depth):
            rolled[d + 1] = rolled[d] * np.uint64(_BASE) + mapped[d]
        power = np.multiply.accumulate(np.full(self.longest + 1, _BASE, np.uint64)) if self.longest else np.ones(1, np.uint64)
        value = np.full((depth + 1, n), _LEAST)
        value[0] = 0
        last = np.ones((depth + 1, n), np.int8) if used is not None else None  # characters of the piece that ends at a node
        owner = np.zeros((depth + 1, n), np.int32)
        index = np.arange(n, dtype=np.int32)
        utf8 = 1 + (grid >= 0x80).astype(np.int64) + (grid >= 0x800) + (grid >= 0x10000)
        for d in range(1, depth + 1):
            new = (length >= d) & (shared < d)
            owner[d] = np.maximum.accumulate(np.where(new, index, 0))
            rows = np.flatnonzero(new)
            best = np.full(len(rows), _LEAST)
            for size in range(1, min(d, self.longest) + 1):
                before = value[d - size][owner[d - size][rows]]
                score = self._lookup(rolled[d][rows] - rolled[d - size][rows] * power[size - 1])
                if size == 1:  # a character without a piece: its bytes
                    bytes_ = utf8[rows, d - 1]
                    missing = score == _LEAST
                    reached = before + np.where(missing, (self.byte * bytes_ << _SHIFT) - bytes_, (score << _SHIFT) - 1)
                    np.maximum(best, reached, out=best)
                else:
                    known = np.flatnonzero(score != _LEAST)
                    reached = before[known] + (score[known] << _SHIFT) - 1
                    if last is not None:
                        last[d, rows[known[reached > best[known]]]] = size
                    best[known] = np.maximum(best[known], reached)
            value[d][rows] = best
        if last is not None:
            row, at = index, length
            while len(row):
                size = last[at, owner[at, row]]
                piece = self._lookup(rolled[at, row] - rolled[at - size, row] * power[size - 1], self.pieces, -1)
                known = piece >= 0
                np.add.at(used, piece[known], times[row[known]])
                at = at - size
                row, at = row[at > 0], at[at > 0]
        ends = value[length, owner[length, index]]
        return -ends & ((1 << _SHIFT) - 1)

    def _count_one(self, word: str) -> int:
        return -self._cut_one(word)[0] & ((1 << _SHIFT) - 1)

    def _cut_one(self, word: str) -> tuple[int, list[int]]:
        """Value of a word, and the characters of the piece that ends at each of its places."""
        value, last = [0], [0]
        for d in range(1, len(word) + 1):
            size = len(word[d - 1].encode("utf-8", "surrogatepass"))
            score = self.scores.get(word[d - 1])
            best, length = value[d - 1] + ((self.byte * size << _SHIFT) - size if score is None else (score << _SHIFT) - 1), 1
            for k in range(2, min(d, self.longest) + 1):
                score = self.scores.get(word[d - k : d])
                if score is not None and (reached := value[d - k] + (score << _SHIFT) - 1) > best:
                    best, length = reached, k
            value.append(best)
            last.append(length)
        return value[-1], last


def read_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece model by falling frequency, without its control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [model.id_to_piece(i) for i in ids]


@lru_cache(maxsize=2)
def _model(name: str, scores: bytes) -> Unigram:
    pieces = read_pieces(SparkFiles.get(name))
    return Unigram(dict(zip(pieces, np.frombuffer(scores, np.int64).tolist(), strict=True)))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n), summed while a task's words are few."""
    held: collections.Counter = collections.Counter()
    chars = 0

    def summed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for text in batch["text"].slice(at, 256).to_pylist():
                held.update((text or "").split())
                chars += len(text or "")
                if len(held) > KEPT or chars > TEXT:
                    yield summed()
                    held.clear()
                    chars = 0
    yield summed()


def _use(batches: Iterator[pa.RecordBatch], name: str, scores: bytes) -> Iterator[pa.RecordBatch]:
    """(piece, n): how often a task's words use each piece."""
    model = _model(name, scores)
    used = np.zeros(len(model.scores), np.int64)
    for batch in batches:
        used += model.use([MARK + w for w in batch["word"].to_pylist()], batch["n"].to_numpy())
    piece = np.flatnonzero(used)
    yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(used[piece])], ["piece", "n"])


def train_scores(docs: DataFrame, model_file: str, rounds: int = ROUNDS) -> dict[str, int]:
    """Score of each piece of the vocabulary, estimated from all texts of docs in so many rounds; by Zipf's law after none."""
    spark = docs.sparkSession
    spark.sparkContext.addFile(model_file)
    name, scores = model_file.rsplit("/", 1)[-1], zipf_scores(read_pieces(model_file))
    if not rounds:
        return scores
    rows = docs.select(F.col("text").cast("string").alias("text"))
    words = stored(rows.mapInArrow(_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    for _ in range(rounds):
        now = np.array(list(scores.values()), np.int64).tobytes()
        used = words.mapInArrow(lambda b, now=now: _use(b, name, now), "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
        counts = dict.fromkeys(range(len(scores)), 0) | {r.piece: r.n for r in used.toLocalIterator()}  # a row for each piece at most
        scores = estimated_scores(dict(zip(scores, counts.values(), strict=True)))
    drop(words)
    return scores


def _count(batches: Iterator[pa.RecordBatch], name: str, scores: bytes) -> Iterator[pa.RecordBatch]:
    model, known = _model(name, scores), {}
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            split = [(t or "").split() for t in batch["text"].to_pylist()]
            if len(known) > KEPT:
                known = {}
            new = list({w for words in split for w in words if w not in known})
            known.update(zip(new, model.count([MARK + w for w in new]), strict=True))
            tokens = [sum(map(known.__getitem__, words)) for words in split]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([len(s) for s in split], pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])


def token_counts(docs: DataFrame, model_file: str, scores: dict[str, int] | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens), one row per row of docs, which needs doc_id and text.

    model_file: a sentencepiece model on the driver, sent to the executors. scores: of its pieces, in its order, estimated from docs where
    they aren't given. A null or empty text, or one of white space, counts zero. Repeated rows and null ids come out as they went in;
    other columns are ignored; an empty table gives an empty one; whole texts count, however long.
    """
    docs.sparkSession.sparkContext.addFile(model_file)
    name = model_file.rsplit("/", 1)[-1]
    raw = np.array(list((scores or train_scores(docs, model_file)).values()), np.int64).tobytes()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _count(b, name, raw), "doc_id long, n_words long, n_tokens long")
