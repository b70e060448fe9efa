"""Byte-level BPE in numpy: all different pre-tokens of a block of texts are merged side by side.

A text is split by the tokenizer's pattern, and every match is encoded by itself. Matches of similar length
form a padded matrix with one row each, first of single bytes. In every round, each row merges its
leftmost pair of minimum rank: ranks are looked up for all pairs at once in an open hash table, and the
columns after the merged pair move up by one. A row without a known pair is done and leaves the matrix.
Matches that a task has encoded lately are kept in a table of bounded size.

Texts are split by numpy as well if the pattern is SPLIT: the kinds of neighbouring characters tell where matches begin.
Matches are told apart by a hash of their characters, and then compared character by character with the one kept.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

#: Widths of the matrices. Longer matches are merged one by one.
BUCKETS = (2, 4, 6, 8, 12, 16, 24, 32, 48, 64)
#: Matches of which a task keeps the encoding, and their characters in all.
KEPT, KEPT_POINTS = 300_000, 4_000_000
#: Matches that are handled at once, however long a text is.
BLOCK = 200_000
#: Numbers of a padded matrix; a merge holds some ten matrices of its size.
CELLS = 400_000
#: The pattern that Splitter knows, and the most characters that it splits at once.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PART = 1_000_000

_NONE = np.int64(1 << 40)


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places start, start + 1 and so on, size of each."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Vocabulary:
    """Ranks of a byte-level vocabulary, as a hash table of pairs and a table of bytes by id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pieces = [b""] * self.size
        for piece, rank in ranks.items():
            pieces[rank] = piece
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.start = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        left, right, rank = [], [], []
        for piece, r in ranks.items():
            for cut in range(1, len(piece)):
                a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self._fill(np.array(left, np.int64) << 32 | np.array(right, np.int64), np.array(rank, np.int64))

    @staticmethod
    def _hash(keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def _fill(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        self.bits = int(max(len(keys), 1) * 4).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, np.int64)
        slot, todo = self._hash(keys, self.bits), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            free = self.keys[slot[todo]] == -1
            self.keys[slot[todo[free]]] = keys[todo[free]]
            done = self.keys[slot[todo]] == keys[todo]
            self.ranks[slot[todo[done]]] = ranks[todo[done]]
            todo = todo[~done]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, a large number where the two don't merge (or one is padding, -1)."""
        keys = (left << 32) | right
        slot = self._hash(keys, self.bits)
        held = self.keys[slot]
        out = np.where(held == keys, self.ranks[slot], _NONE)
        open_ = np.flatnonzero((held != keys) & (held != -1) & (right >= 0))
        flat_keys, flat_slot, flat_out = keys.reshape(-1), slot.reshape(-1), out.reshape(-1)
        open_ = np.flatnonzero(((held != keys) & (held != -1) & (right >= 0)).reshape(-1)) if keys.ndim > 1 else open_
        for _ in range(self.probes):
            if not len(open_):
                break
            flat_slot[open_] = (flat_slot[open_] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[flat_slot[open_]]
            hit = seen == flat_keys[open_]
            flat_out[open_[hit]] = self.ranks[flat_slot[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
        return flat_out.reshape(keys.shape)

    def _merge_matrix(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids: one match per row, padded with -1. The merged ids of all rows one after the other, and how many each row has."""
        done = np.full(ids.shape, -1, np.int64)
        rows = np.arange(len(ids))
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            over = best == _NONE
            if over.any():
                done[rows[over], : ids.shape[1]] = ids[over]
                live = ~over
                rows, ids, ranks, at, best = rows[live], ids[live], ranks[live], at[live], best[live]
                if not len(rows):
                    break
            # compaction: what follows the pair moves up by one
            n, width = ids.shape
            column = np.arange(width - 1)
            source = column + (column > at[:, None])
            line = np.arange(n)
            merged = np.take_along_axis(ids, source, 1)
            merged[line, at] = best
            if width > 2:
                ranks = np.take_along_axis(ranks, source[:, : width - 2], 1)
                before, after = np.maximum(at - 1, 0), np.minimum(at, width - 3)
                fresh = self.pair_ranks(merged[line, before], merged[line, before + 1])
                ranks[line, before] = np.where(at > 0, fresh, ranks[line, before])
                fresh = self.pair_ranks(merged[line, after], merged[line, after + 1])
                ranks[line, after] = np.where(at <= width - 3, fresh, ranks[line, after])
            else:
                done[rows, :1] = merged
                break
            ids = merged
        held = done >= 0
        return done[held], held.sum(1)

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """One long match: in a round, all pairs of minimum rank merge, from left to right without overlap.

        The result is the same as of one merge a round: a pair that a merge creates has a higher rank.
        """
        while len(ids) > 1:
            ranks = self.pair_ranks(ids[:-1], ids[1:])
            best = ranks.min()
            if best == _NONE:
                break
            found = np.flatnonzero(ranks == best)
            run = np.cumsum(np.diff(found, prepend=-2) != 1)  # consecutive places overlap; take every second
            first = np.zeros(run[-1] + 1, np.int64)
            first[run[::-1]] = found[::-1]
            found = found[(found - first[run]) % 2 == 0]
            ids[found] = best
            ids = np.delete(ids, found + 1)
        return ids

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, matches of the pattern as bytes, one after the other, and how many each piece has."""
        size = np.array([len(p) for p in pieces], np.int64)
        whole = np.frombuffer(b"".join(pieces), np.uint8)
        start = np.cumsum(size) - size
        low = 0
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for width in BUCKETS:
            rows = np.flatnonzero((size > low) & (size <= width))
            most = CELLS // width
            for at in range(0, len(rows), most):
                part = rows[at : at + most]
                grid = np.arange(width)
                inside = grid < size[part][:, None]
                source = np.where(inside, start[part][:, None] + grid, 0)
                found.append((part, *self._merge_matrix(np.where(inside, self.single[whole[source]], -1))))
            low = width
        for i in np.flatnonzero(size > BUCKETS[-1]):
            ids = self._merge_long(self.single[whole[start[i] : start[i] + size[i]]])
            found.append((np.array([i]), ids, np.array([len(ids)])))
        count = np.zeros(len(pieces), np.int64)
        for part, _, n in found:
            count[part] = n
        out = np.zeros(int(count.sum()), np.int64)
        start = np.cumsum(count) - count
        for part, ids, n in found:
            out[_spread(start[part], n)] = ids
        return out, count

    def decode(self, ids: np.ndarray) -> bytes:
        size = self.start[ids + 1] - self.start[ids]
        shift = np.repeat(self.start[ids] - (np.cumsum(size) - size), size)
        return self.bytes[np.arange(int(size.sum())) + shift].tobytes()


_LETTER, _DIGIT, _OTHER, _SPACE, _EDGE = range(5)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of each code point, as the regex module sees it."""
    every = "".join(map(chr, range(0x110000)))
    kinds = np.full(len(every), _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_DIGIT, r"\p{N}+"), (_SPACE, r"\s+")):
        for match in regex.finditer(pattern, every):
            kinds[match.start() : match.end()] = kind
    return kinds


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, both modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    out = []
    for factor in (base, pow(base, -1, 1 << 64)):
        powers = np.full(PART + 2, factor, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


class Block:
    """Texts of up to PART characters in all, split into the matches of SPLIT.

    starts and sizes are the places and lengths of the matches in points, the code points of all texts with one more before, between
    and after them; counts is the number of matches of each text.
    """

    def __init__(self, texts: list[str]):
        self.text = "\n".join(["", *texts, ""])
        self.points = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        edges = np.cumsum([0, *[len(t) + 1 for t in texts]])
        kinds = _kinds()[self.points]
        kinds[edges] = _EDGE
        begins = self._begins(kinds)
        begins[edges] = False
        self.starts = np.flatnonzero(begins)
        begins[edges] = True
        ends = np.flatnonzero(begins)
        self.sizes = ends[np.searchsorted(ends, self.starts) + 1] - self.starts
        self.counts = np.diff(np.searchsorted(self.starts, edges))

    def _begins(self, kinds: np.ndarray) -> np.ndarray:
        """Whether a match begins at a place. A space before other characters is the first of their match."""
        points, space, edge = self.points, kinds == _SPACE, kinds == _EDGE
        blank = space & (points == 32)
        begins = np.ones(len(kinds), bool)
        begins[1:] = (kinds[1:] != kinds[:-1]) & ~(blank[:-1] & ~edge[1:])
        # the last of a run of white space is left to what follows, if anything does
        begins[:-1] |= space[:-1] & ~space[1:] & ~edge[1:]
        marks = np.flatnonzero((points == 39) & (kinds == _OTHER) & begins)
        marks = marks[marks + 2 < len(points)]
        one, two = points[marks + 1], points[marks + 2]
        inside = kinds[marks + 1] != _EDGE
        short = inside & np.isin(one, [ord(c) for c in "stmd"])
        long = inside & (kinds[marks + 2] != _EDGE) & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
        for found, size in ((short, 1), (long, 2)):
            begins[marks[found] + 1] = False
            begins[marks[found] + 1 + size] = True
        return begins

    def hashes(self) -> np.ndarray:
        """64 bits of each match."""
        powers, inverse = _powers()
        sums = np.zeros(len(self.points) + 1, np.uint64)
        np.cumsum((self.points + np.uint64(1)) * powers[: len(self.points)], out=sums[1:])
        return (sums[self.starts + self.sizes] - sums[self.starts]) * inverse[self.starts]

    def words(self, which: np.ndarray) -> list[str]:
        return [self.text[a : a + n] for a, n in zip(self.starts[which].tolist(), self.sizes[which].tolist(), strict=True)]


def _parts(text: str) -> list[str] | None:
    """A text in parts of up to PART characters that can be split by themselves: each but the first begins with a blank
    between other characters. None if there is no such place."""
    out, at, kinds = [], 0, _kinds()
    while len(text) - at > PART:
        cut = text.rfind(" ", at + 1, at + PART)
        while cut > at and _SPACE in (kinds[ord(text[cut - 1])], kinds[ord(text[cut + 1])]):
            cut = text.rfind(" ", at + 1, cut)
        if cut <= at:
            return None
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


class Encoder:
    """Encodes whole texts; keeps what it has encoded lately."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.splits = pattern == SPLIT
        self._reset()

    def _reset(self) -> None:
        self.number: dict[str, int] = {}
        # of matches of blocks: hashes in order, their numbers, and the code points of each match
        self.hashes = np.zeros(0, np.uint64)
        self.numbers = np.zeros(0, np.int64)
        self.points = np.zeros(0, np.uint32)
        self.point_start = np.zeros(0, np.int64)
        self.point_size = np.zeros(0, np.int64)
        self.rows = np.zeros(0, np.int64)
        self.learnt = self.characters = 0
        self.ids = np.zeros(1 << 16, np.int64)
        self.used = 0
        self.start = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)

    def _learn(self, words: list[str]) -> int:
        """Encode words; their numbers follow the one returned."""
        encoded, size = self.vocabulary.encode_pieces([w.encode("utf-8", "surrogatepass") for w in words])
        n = self.learnt
        while n + len(words) > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
        end = self.used + int(size.sum())
        while end > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : end] = encoded
        self.size[n : n + len(words)] = size
        self.start[n : n + len(words)] = self.used + np.cumsum(size) - size
        self.used = end
        self.learnt += len(words)
        self.characters += sum(map(len, words))
        return n

    def _matches(self, text: str) -> Iterator[list[str]]:
        if len(text) <= BLOCK:
            yield self.pattern.findall(text)
            return
        part = []
        for match in self.pattern.finditer(text):
            part.append(match[0])
            if len(part) == BLOCK:
                yield part
                part = []
        yield part

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. New matches of a part of the texts are merged together."""
        if not self.splits:
            return self._numbered(texts)
        out: list[np.ndarray] = []
        held: list[str] = []
        size = 0
        for text in texts:
            if held and size + len(text) > PART:
                out += self._block(held)
                held, size = [], 0
            if len(text) + 1 > PART:
                parts = _parts(text)
                out.append(self._numbered([text])[0] if parts is None else np.concatenate([self._block([p])[0] for p in parts]))
            else:
                held.append(text)
                size += len(text) + 1
        return out + (self._block(held) if held else [])

    def _forget(self) -> None:
        """Begin anew if what is kept is more than it should be, in matches or in characters."""
        if self.learnt > KEPT or self.characters > KEPT_POINTS:
            self._reset()

    def _block(self, texts: list[str]) -> list[np.ndarray]:
        self._forget()
        block = Block(texts)
        keys, first, key = np.unique(block.hashes(), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, keys)
        inside = at < len(self.hashes)
        new = ~inside
        new[inside] = self.hashes[at[inside]] != keys[inside]
        if new.any():
            self._keep(block, keys[new], first[new], at[new])
            at = np.searchsorted(self.hashes, keys)
        place = self.numbers[at][key]
        same = block.sizes == self.point_size[place]
        if not (same.all() and (block.points[_spread(block.starts, block.sizes)] == self.points[_spread(self.point_start[place], block.sizes)]).all()):
            return self._numbered(texts)  # two matches with the same hash
        rows = self.rows[place]
        size = self.size[rows]
        ids = self.ids[_spread(self.start[rows], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(block.counts)]
        return np.split(ids, ends[:-1])

    def _keep(self, block: Block, keys: np.ndarray, which: np.ndarray, at: np.ndarray) -> None:
        """Learn matches of a block, the hashes of which come before the places at of those kept."""
        n = len(self.numbers)
        row = self._learn(block.words(which))
        starts, sizes = block.starts[which], block.sizes[which]
        self.hashes = np.insert(self.hashes, at, keys)
        self.numbers = np.insert(self.numbers, at, np.arange(n, n + len(keys)))
        self.rows = np.concatenate([self.rows, np.arange(row, row + len(keys))])
        self.point_start = np.concatenate([self.point_start, len(self.points) + np.cumsum(sizes) - sizes])
        self.point_size = np.concatenate([self.point_size, sizes])
        self.points = np.concatenate([self.points, block.points[_spread(starts, sizes)]])

    def _numbered(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, split by the pattern itself."""
        self._forget()
        split = [list(self._matches(t)) for t in texts]
        known = self.number
        new = {w: None for parts in split for words in parts for w in words if w not in known}
        if new:
            for i, w in enumerate(new, self._learn(list(new))):
                known[w] = i
        out = []
        for parts in split:
            pieces = []
            for words in parts:
                rows = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                pieces.append(self.ids[_spread(self.start[rows], self.size[rows])])
            out.append(np.concatenate(pieces) if pieces else np.zeros(0, np.int64))
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def encoder(name: str, pattern: str) -> Encoder:
    """The encoder of a rank file that Spark has sent to this executor; one per worker process."""
    return Encoder(Vocabulary(read_ranks(SparkFiles.get(name))), pattern)


def _encoded(batches: Iterator[pa.RecordBatch], model: Encoder) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of the batches, each with the ids of its texts."""
    for whole in batches:
        at = 0
        lengths = [len(x.as_py() or "") for x in whole["text"]] if whole.num_rows else []
        while at < whole.num_rows:
            end, held = at, 0  # texts of about two million characters at once, and one at least
            while end < whole.num_rows and (end == at or held + lengths[end] <= 2_000_000):
                held += lengths[end]
                end += 1
            batch = whole.slice(at, end - at)
            at = end
            yield batch, model.encode_batch([t or "" for t in batch["text"].to_pylist()])


def _encode(batches: Iterator[pa.RecordBatch], name: str, pattern: str, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    model = encoder(name, pattern)
    for batch, ids in _encoded(batches, model):
        raw = [i.astype("<u4").tobytes() for i in ids]
        decoded = [model.vocabulary.decode(i) for i in ids]
        columns = {
            "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
            "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
        }
        if keep_ids:
            columns |= {"ids": pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.binary())}
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns.values()], ["doc_id", *columns])


def _ids(batches: Iterator[pa.RecordBatch], name: str, pattern: str) -> Iterator[pa.RecordBatch]:
    model = encoder(name, pattern)
    for batch, ids in _encoded(batches, model):
        raw = [np.append(i, model.vocabulary.size).astype("<i4").tobytes() for i in ids]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(raw, pa.binary())], ["doc_id", "ids"])


def _sent(docs: DataFrame, rank_file: str) -> tuple[DataFrame, str]:
    """doc_id and text of docs, and the name of the rank file, which Spark sends to the executors."""
    docs.sparkSession.sparkContext.addFile(rank_file)
    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text"), rank_file.rsplit("/", 1)[-1]


def end_id(rank_file: str) -> int:
    """The id that token_ids() puts after a text: the first that is no token. The next one is free for padding."""
    return max(read_ranks(rank_file).values()) + 1


def token_ids(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the token ids of each text and end_id(), as little-endian 32-bit integers; see bpe_round_trip()."""
    rows, name = _sent(docs, rank_file)
    return rows.mapInArrow(lambda b: _ids(b, name, pattern), "doc_id long, ids binary")


def bpe_round_trip(docs: DataFrame, rank_file: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), with keep_ids also ids and decoded.

    One row per row of docs, which needs doc_id and text. rank_file is a path on the driver; Spark sends
    the file, of a fixed size, to the executors. A null text counts as empty; an empty text has no ids and
    decodes to nothing. Texts of any length are encoded whole. Repeated rows and null ids come out as they
    went in; other columns are ignored; an empty table gives an empty one.
    """
    rows, name = _sent(docs, rank_file)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded binary"
    return rows.mapInArrow(lambda b: _encode(b, name, pattern, keep_ids), schema)
