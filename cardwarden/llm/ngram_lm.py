"""Word n-gram language model of order three in Elias-Fano tries, one per shard of the vocabulary.

Smoothing is Dirichlet's towards the unigram distribution p, then towards the bigrams:
P(w | v) = (c(v, w) + mu(v) * p(w)) / (c(v) + mu(v)) and
P(w | u, v) = (c(u, v, w) + k(v) * (c(v, w) + mu(v) * p(w))) / (c(u, v) + k(v) * (c(v) + mu(v))).
Both sum to one over w for any mu(v) and k(v); k(v) is chosen so that k(v) * (c(v) + mu(v)) is about THIRD. Numerators need
only what is known where w is counted (its n-grams and p), denominators only what is known where v is counted. So
tokens are dealt by their own word, together with the two words before, and every shard can count, build its
trie and score without asking another: one shuffle of the tokens for all three orders. The first word of a text has the
end as its only context and is scored by P(w | v).

A shard's trie has the words on its first level, below each the words before it, and below those the words two
before. Pointers to the next level are monotone and stored by Elias-Fano coding. The ids of a node's children restart with each
node; they are stored relative to it, as an offset plus the largest id of the nodes before, which makes a whole
level one monotone sequence. An n-gram is found by a successor search in the range of its context, level by level.
The logarithms of its numerator and, as a context, of its denominator are quantised to 16 bits. The levels are
mapped from an anonymous file in memory, which is gone when the shard is done.

mu(v) and k(v) follow how often v occurs, read from a table of fixed size in which words may share a cell. A word before
another is known by its cell's class and 32 bits of its hash, a word two before by those 32 bits.

Hot n-grams are split over several shards, their counts known beforehand: words by the word before, pairs by the word
two before, and triples by the block of texts. No more than 1 / HOT_SHARE words and 1 / PAIR_SHARE pairs and triples can be
hot. Pairs and triples are candidates if they are frequent in blocks, and are then counted exactly in one more pass; it is
left out if none fills a quarter of a shard.
"""

from __future__ import annotations

import mmap
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import drop, stored
from cardwarden.llm.words import mix, word_hashes

#: Added to each count of the base model, as agreed.
ADD = 0.1
#: Share of all tokens from which a word, and a pair or triple of words, may be split over shards.
HOT_SHARE, PAIR_SHARE = 1e-5, 1e-4
#: Tokens of a shard, about.
SHARD_TOKENS = 2_000_000
#: Cells of the table of context frequencies.
CELLS = 1 << 20
#: mu of a context as a share of its frequency.
SMOOTHING = 1.0
#: Weight of the bigram's probability beside the counts of a context of two words, about.
THIRD = 2.0
#: A range of more children is first narrowed by the high bits.
NARROW = 8
#: Texts of so many characters are one block of the shuffle.
BLOCK_CHARS = 8_000_000

#: Hash of the token that ends a text. Words have it with a chance of 2**-64.
END = np.uint64(0xE4D0F7E47)


class EliasFano:
    """A monotone sequence of integers below 2**62: low bits packed, high bits in unary, in a memory map."""

    def __init__(self, values: np.ndarray, make):
        """values: non-decreasing int64. make(array) puts an array into the mapped file and returns the mapped one."""
        self.n = len(values)
        top = int(values[-1]) + 1 if self.n else 1
        self.low_bits = max(0, (top // max(self.n, 1)).bit_length() - 1)
        high = values >> self.low_bits
        self.low = make(self._pack(values & ((1 << self.low_bits) - 1), self.low_bits))
        size = (int(high[-1]) + 1 if self.n else 0) + self.n + 64
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[high + np.arange(self.n)] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.high = make(words)
        # ones before each word, for select
        self.rank = make(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))

    @staticmethod
    def _pack(values: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros(len(values) * width // 64 + 2, np.uint64)
        if width:
            at = np.arange(len(values), dtype=np.int64) * width
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            v = values.astype(np.uint64)
            np.bitwise_or.at(out, word, v << bit)
            over = (at & 63) + width > 64
            np.bitwise_or.at(out, word[over] + 1, v[over] >> (np.uint64(64) - bit[over]))
        return out

    def _select(self, ordinal: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the bit with that ordinal, among ones or zeros."""
        if ones:
            word = np.searchsorted(self.rank, ordinal, "right") - 1
            rest = ordinal - self.rank[word]
            bits = self.high[word]
        else:
            zeros = np.arange(len(self.rank), dtype=np.int64) * 64 - self.rank if not hasattr(self, "_zeros") else self._zeros
            self._zeros = zeros
            word = np.searchsorted(zeros, ordinal, "right") - 1
            rest = ordinal - zeros[word]
            bits = ~self.high[word]
        place = np.zeros(len(ordinal), np.int64)
        for step in (32, 16, 8, 4, 2, 1):  # halve the word that holds the bit
            below = np.bitwise_count(bits & np.uint64((1 << step) - 1)).astype(np.int64)
            up = rest >= below
            rest = np.where(up, rest - below, rest)
            place += up * step
            bits = np.where(up, bits >> np.uint64(step), bits)
        return word * 64 + place

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at i."""
        high = (self._select(i, True) - i) << self.low_bits
        if not self.low_bits:
            return high
        at = i * self.low_bits
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.low[word] >> bit
        over = bit + np.uint64(self.low_bits) > 64
        low[over] |= self.low[word[over] + 1] << (np.uint64(64) - bit[over])
        return high | (low & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def successor(self, x: np.ndarray, low: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For each x the first index from low on whose value is at least x; end if there is none before."""
        low, end = low.copy(), end.copy()
        wide = np.flatnonzero(end - low > NARROW)
        if len(wide):  # values with a smaller high part come before the zero that closes it
            high = x[wide] >> self.low_bits
            zeros = len(self.high) * 64 - int(self.rank[-1])
            h = np.minimum(high, zeros - 1)
            from_ = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - np.maximum(h - 1, 0), 0)
            to = np.where(high < zeros, self._select(h, False) - h, self.n)
            from_ = np.where(high < zeros, from_, self.n)
            low[wide] = np.clip(from_, low[wide], end[wide])
            end[wide] = np.clip(to, low[wide], end[wide])
        while True:
            open_ = np.flatnonzero(low < end)
            if not len(open_):
                return low
            middle = (low[open_] + end[open_]) >> 1
            less = self.access(middle) < x[open_]
            low[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]


class Level:
    """The children of the nodes of the level above: ids in a node's range, with quantised values."""

    #: Ids are below this.
    WIDTH = 1 << 40

    def __init__(self, parent: np.ndarray, ids: np.ndarray, parents: int, values: list[np.ndarray], make):
        """parent: node of each entry, not decreasing; ids: ascending within a node; values: real numbers of each entry."""
        self.pointers = EliasFano(np.concatenate([[0], np.cumsum(np.bincount(parent, minlength=parents))]), make)
        # ids relative to their node: each node's range begins above the one before
        self.ids = EliasFano(parent * self.WIDTH + ids.astype(np.int64), make)
        self.least = [float(v.min()) if len(v) else 0.0 for v in values]
        self.step = [(float(v.max()) - low) / 65_535 if len(v) else 0.0 for v, low in zip(values, self.least, strict=True)]
        scaled = [(v - low) / step if step else np.zeros(len(v)) for v, low, step in zip(values, self.least, self.step, strict=True)]
        self.codes = [make(np.round(v).astype(np.uint16)) for v in scaled]

    def find(self, parent: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Index of each (parent, id) on this level, -1 where it is absent or parent is -1."""
        out = np.full(len(parent), -1)
        asked = np.flatnonzero(parent >= 0)
        if not self.ids.n or not len(asked):
            return out
        node = parent[asked]
        start, end = self.pointers.access(node), self.pointers.access(node + 1)
        x = node * self.WIDTH + ids[asked].astype(np.int64)
        at = self.ids.successor(x, start, end)
        inside = np.flatnonzero(at < end)
        inside = inside[self.ids.access(at[inside]) == x[inside]]
        out[asked[inside]] = at[inside]
        return out

    def value(self, which: int, at: np.ndarray) -> np.ndarray:
        return self.least[which] + self.codes[which][at] * self.step[which]


class Trie:
    """Three levels: words, below each the words before it, below each of those the words two before.

    The second level has the logarithm of the numerator that the bigram gives and that of the pair's denominator as a context; the third
    that of the triple's numerator.
    """

    def __init__(self, words: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, list[np.ndarray]], triples: tuple[np.ndarray, np.ndarray, list[np.ndarray]]):
        """words: sorted hashes. pairs and triples: node above, id and values of each entry."""
        self.file = os.memfd_create("levels")
        self.size = 0
        self.words = self._mapped(words)
        self.second = Level(*pairs[:2], len(words), pairs[2], self._mapped)
        self.third = Level(*triples[:2], len(pairs[0]), triples[2], self._mapped)

    def _mapped(self, array: np.ndarray) -> np.ndarray:
        """array, written to the file and mapped from it."""
        if not array.nbytes:
            return array
        at = -(-self.size // mmap.ALLOCATIONGRANULARITY) * mmap.ALLOCATIONGRANULARITY
        self.size = at + array.nbytes
        os.ftruncate(self.file, self.size)
        mapped = np.frombuffer(mmap.mmap(self.file, array.nbytes, offset=at), array.dtype)
        mapped[:] = array
        return mapped

    def word(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each word, -1 where it is absent."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def close(self) -> None:
        os.close(self.file)


class Hot(NamedTuple):
    """Frequent n-grams: sorted keys, their counts in training, and over how many shards they are split."""

    keys: np.ndarray
    counts: np.ndarray
    parts: np.ndarray

    @staticmethod
    def of(counts: dict[int, int]) -> Hot:
        """Those that fill a quarter of a shard; counts by key."""
        kept = sorted((k & (1 << 64) - 1, n) for k, n in counts.items() if n * 4 > SHARD_TOKENS)
        keys, n = np.array([k for k, _ in kept], np.uint64), np.array([n for _, n in kept], np.int64)
        return Hot(keys, n, (-(-n * 4 // SHARD_TOKENS)).astype(np.uint64))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are hot, and where they are."""
        if not len(self.keys):
            return (np.zeros(0, np.int64),) * 2
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hot = np.flatnonzero(self.keys[at] == keys)
        return hot, at[hot]

    def whole(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """counts of keys in one shard, those of split ones replaced by their whole counts."""
        hot, at = self.find(keys)
        counts[hot] = self.counts[at]
        return counts


def _pair_key(words: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return mix(words + mix(entries))


def _triple_key(pairs: np.ndarray, third: np.ndarray) -> np.ndarray:
    return mix(pairs + mix(third.astype(np.uint64) + np.uint64(1)))


def _short(hashes: np.ndarray) -> np.ndarray:
    """32 bits of a hash, as the id of a word before another."""
    return (hashes >> np.uint64(32)).astype(np.uint32)


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text and the end token."""
    hashes, bounds = word_hashes(texts)
    n = len(bounds) - 1
    at = bounds[1:] + np.arange(n)
    out = np.empty(len(hashes) + n, np.uint64)
    out[at] = END
    rest = np.ones(len(out), bool)
    rest[at] = False
    out[rest] = hashes
    return out, bounds + np.arange(n + 1)


def _context(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each token, and 32 bits for the word two before: 0 at the first token of a text, which has an end before it."""
    before, third = np.empty_like(tokens), np.zeros(len(tokens), np.uint32)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = END
    third[1:] = np.maximum(_short(before[:-1]), 1)
    third[bounds[:-1]] = 0
    return before, third


def _entries(before: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A word before another, as the trie knows it: how often it occurs, and 32 bits of its hash."""
    cell = classes[(before & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64)
    return cell << np.uint64(32) | before >> np.uint64(32)


def _groups(batch: pa.RecordBatch, chars: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about so many characters, one row at least."""
    lengths = [len(x.as_py() or "") for x in batch["text"]] if batch.num_rows else []
    at = 0
    while at < batch.num_rows:
        end, held = at + 1, lengths[at]
        while end < batch.num_rows and held + lengths[end] <= chars and end - at < 60_000:
            held += lengths[end]
            end += 1
        yield batch.slice(at, end - at)
        at = end


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, more, n) of training texts, summed for blocks of a partition. more: nothing for a word; for a pair or triple
    that is frequent in the block the word before, or also the 32 bits of the word two before."""
    for batch in batches:
        for part in _groups(batch, BLOCK_CHARS):
            tokens, bounds = _tokens(part["text"].to_pylist())
            words, n = np.unique(tokens, return_counts=True)
            limit = PAIR_SHARE * len(tokens)
            columns = [words], [[None] * len(words)], [n]
            common = words[n > limit]
            if len(common):
                before, third = _context(tokens, bounds)
                known = lambda w: common[np.minimum(np.searchsorted(common, w), len(common) - 1)] == w  # noqa: B023, E731
                at = np.flatnonzero(known(tokens) & known(before))
                w, v, u = tokens[at], before[at], third[at]
                pair = _pair_key(w, v)
                _, first, back, n = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
                kept = n > limit
                for column, values in zip(columns, (w[first[kept]], [x.tobytes() for x in v[first[kept]]], n[kept]), strict=True):
                    column.append(values)
                at = np.flatnonzero(kept[back])
                w, v, u = w[at], v[at], u[at]
                _, first, n = np.unique(_triple_key(pair[at], u), return_index=True, return_counts=True)
                first, n = first[n > limit], n[n > limit]
                for column, values in zip(columns, (w[first], [x.tobytes() + y.tobytes() for x, y in zip(v[first], u[first], strict=True)], n), strict=True):
                    column.append(values)
            more = pa.array([x for c in columns[1] for x in c], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(columns[0]).view(np.int64)), more, pa.array(np.concatenate(columns[2]))], ["word", "more", "n"])


def _count_hot(batches: Iterator[pa.RecordBatch], keys: np.ndarray, classes) -> Iterator[pa.RecordBatch]:
    """(key, n) of the given pairs and triples in training texts."""
    for batch in batches:
        for part in _groups(batch, BLOCK_CHARS):
            tokens, bounds = _tokens(part["text"].to_pylist())
            before, third = _context(tokens, bounds)
            pairs = _pair_key(tokens, _entries(before, classes.value))
            found = np.concatenate([k[np.isin(k, keys)] for k in (pairs, _triple_key(pairs, third))])
            found, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["key", "n"])


#: A block's tokens in one shard: used texts (numbers within the block) and whether they are held out; the
#: words, how many pairs each has, the words before (40 bits), how many triples each pair has, the words two before, how many tokens
#: each triple has, and their texts. One row of a block also has its ids.
_DEALT = "shard int, block long, used binary, held binary, words binary, sizes binary, before binary, subs binary, third binary, posts binary, docs binary, ids binary"
_SUMS = "shard int, block long, used binary, n binary, known binary, base binary, pair binary, ids binary"
_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before, in any column."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _deal(batches: Iterator[pa.RecordBatch], hot: tuple[Hot, Hot, Hot], classes, shards: int) -> Iterator[pa.RecordBatch]:
    """Tokens of blocks of texts by shard. hot: words, pairs and triples that are split."""
    number = 0
    for whole in batches:
        for batch in _groups(whole, BLOCK_CHARS):
            block = TaskContext.get().partitionId() << 32 | number
            number += 1
            tokens, bounds = _tokens(batch["text"].to_pylist())
            doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
            before, third = _context(tokens, bounds)
            entry = _entries(before, classes.value)
            shard = mix(tokens) % np.uint64(shards)
            pairs = _pair_key(tokens, entry) if len(hot[1].keys) else tokens
            triples = _triple_key(pairs, third) if len(hot[2].keys) else tokens
            by = before, third.astype(np.uint64), np.full(len(tokens), block, np.uint64)
            for frequent, key, part in zip(hot, (tokens, pairs, triples), by, strict=True):
                at, which = frequent.find(key)
                lane = mix(part[at]) % frequent.parts[which]
                shard[at] = mix(key[at] + lane * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)
            del before, pairs, triples, by
            order = np.lexsort((third, entry, tokens, shard))  # keeps the order of texts
            shard, tokens, entry, third, doc = shard[order], tokens[order], entry[order], third[order], doc[order]
            held = batch["held_out"].to_numpy(zero_copy_only=False).astype(np.uint8)
            edges = [*np.flatnonzero(_starts(shard)).tolist(), len(shard)]
            rows = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                w, e, u = tokens[a:b], entry[a:b], third[a:b]
                new_word = _starts(w)
                new_pair = _starts(w, e)
                new_triple = _starts(w, e, u)
                pair, triple = np.flatnonzero(new_pair), np.flatnonzero(new_triple)
                used, local = np.unique(doc[a:b], return_inverse=True)
                sizes = np.add.reduceat(new_pair.astype(np.uint32), np.flatnonzero(new_word))
                subs = np.add.reduceat(new_triple.astype(np.uint32), pair)
                posts = np.diff(np.append(triple, b - a)).astype(np.uint32)
                packed = e[pair].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                parts = (used.astype(np.uint16), held[used], w[new_word], sizes.astype(np.uint32), packed, subs.astype(np.uint32), u[triple], posts, local.astype(np.uint16))
                rows.append((int(shard[a]), *[x.tobytes() for x in parts]))
            ids = batch["doc_id"]
            known = np.array(ids.is_valid().to_numpy(zero_copy_only=False), np.uint8)
            meta = ids.fill_null(0).to_numpy().astype(np.int64).tobytes() + known.tobytes() + held.tobytes()
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array([block] * len(rows), pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]], pa.array([meta] + [None] * (len(rows) - 1), pa.binary())],
                [x.split()[0] for x in _DEALT.split(", ")],
            )


def _mu(cells: np.ndarray) -> np.ndarray:
    """Smoothing weight of a context whose frequency class is given."""
    return SMOOTHING * np.exp2(cells.astype(float))


def _k(cells: np.ndarray) -> np.ndarray:
    """What the numerator of a pair counts beside that of a triple, by the class of the word before."""
    return THIRD / (np.exp2(cells.astype(float)) + _mu(cells))


def _unpacked(r) -> tuple[np.ndarray, ...]:
    """Of a row of _DEALT: words, their numbers of pairs, entries, their numbers of triples, words two before, their numbers of tokens."""
    wide = np.zeros((len(r.before) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(r.before, np.uint8).reshape(-1, 5)
    sizes, subs, third, posts = (np.frombuffer(x, np.uint32) for x in (r.sizes, r.subs, r.third, r.posts))
    return np.frombuffer(r.words, np.uint64), sizes, wide.view("<u8").reshape(-1).astype(np.uint64), subs, third, posts.astype(np.int64)


def _trained(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """What training has of a shard, sorted: words; the word and the entry of each pair; the pair, the word two before and the count of each triple."""
    words, of_words, entries, of_pairs, thirds, counts = ([] for _ in range(6))
    for r in pdf.itertuples():
        own, sizes, entry, subs, third, posts = _unpacked(r)
        held, docs = np.frombuffer(r.held, np.uint8), np.frombuffer(r.docs, np.uint16)
        n = np.add.reduceat(1 - held[docs].astype(np.int32), np.cumsum(posts) - posts)
        triple = n > 0
        pair = np.logical_or.reduceat(triple, np.cumsum(subs, dtype=np.int64) - subs)
        word = np.logical_or.reduceat(pair, np.cumsum(sizes, dtype=np.int64) - sizes)
        words.append(own[word])
        of_words.append((np.cumsum(word) - 1)[np.repeat(np.arange(len(own)), sizes)[pair]])
        entries.append(entry[pair])
        of_pairs.append((np.cumsum(pair) - 1)[np.repeat(np.arange(len(entry)), subs)[triple]])
        thirds.append(third[triple])
        counts.append(n[triple])
    level = np.unique(np.concatenate(words))
    pairs = [np.searchsorted(level, w)[at].astype(np.uint64) << np.uint64(40) | e for w, at, e in zip(words, of_words, entries, strict=True)]
    del words, of_words, entries
    second = np.unique(np.concatenate(pairs))
    keys = np.concatenate([np.searchsorted(second, p)[at].astype(np.uint64) << np.uint64(32) | u for p, at, u in zip(pairs, of_pairs, thirds, strict=True)])
    del pairs, of_pairs, thirds
    order = np.argsort(keys)
    keys, n = keys[order], np.concatenate(counts)[order]
    new = np.flatnonzero(_starts(keys)) if len(keys) else order
    keys, n = keys[new], np.add.reduceat(n, new, dtype=np.int64) if len(new) else n.astype(np.int64)
    return level, (second >> np.uint64(40)).astype(np.int64), second & np.uint64((1 << 40) - 1), (keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32), n


def _score_shard(pdf: pd.DataFrame, total: int, distinct: int, hot: tuple[Hot, Hot, Hot], classes) -> pd.DataFrame:
    """Counts the training n-grams of a shard, builds its trie and scores all tokens: sums by block and text."""
    norm = total + ADD * (distinct + 1)
    class_of = lambda words: classes.value[(words & np.uint64(CELLS - 1)).astype(np.int64)]

    def numerator(n: np.ndarray, entries: np.ndarray, base: np.ndarray) -> np.ndarray:
        """That of a pair, as it counts in a triple, or in full after an end."""
        cells = entries >> np.uint64(32)
        plain = n + _mu(cells) * base
        return np.where(entries == end_entry, plain, _k(cells) * plain)

    def denominator(n: np.ndarray, words: np.ndarray, count: np.ndarray) -> np.ndarray:
        """That of a pair as a context, or of an end."""
        cells = class_of(words)
        plain = count + _mu(cells)
        return np.where(words == END, plain, n + _k(cells) * plain)

    summed = lambda n, of, k: np.bincount(of, n, k).astype(np.int64)  # noqa: E731  whole numbers below 2**53
    end_entry = _entries(np.array([END]), classes.value)[0]
    words, word_of, entries, pair_of, third, n = _trained(pdf)
    n2 = summed(n, pair_of, len(entries))
    count = hot[0].whole(words, summed(n2, word_of, len(words)))
    keys = _pair_key(words[word_of], entries)
    n2 = hot[1].whole(keys, n2)
    if len(hot[2].keys):
        n = hot[2].whole(_triple_key(keys[pair_of], third), n)
    above = numerator(n2, entries, ((count + ADD) / norm)[word_of])
    below = denominator(n2, words[word_of], count[word_of])
    whole = np.where(third == 0, 0, n) + above[pair_of]  # after an end the pair's is all
    trie = Trie(words, (word_of, entries, [np.log10(above), np.log10(below)]), (pair_of, third, [np.log10(whole)]))
    del words, word_of, entries, pair_of, third, n, n2, keys, above, below, whole
    out = []
    for r in pdf.itertuples():
        words, sizes, entries, subs, third, posts = _unpacked(r)
        # words
        at = trie.word(words)
        c = np.zeros(len(words), np.int64)
        c[at >= 0] = count[at[at >= 0]]
        c = hot[0].whole(words, c)  # the training tokens of a split word may all be in other shards
        base = (c + ADD) / norm
        # pairs
        word_of = np.repeat(np.arange(len(words)), sizes)
        at = trie.second.find(at[word_of], entries)
        known, new = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        above, below = np.empty(len(entries)), np.empty(len(entries))
        above[known], below[known] = trie.second.value(0, at[known]), trie.second.value(1, at[known])
        keys = _pair_key(words[word_of], entries)
        n2 = hot[1].whole(keys[new], np.zeros(len(new), np.int64))
        above[new] = np.log10(numerator(n2, entries[new], base[word_of[new]]))
        below[new] = np.log10(denominator(n2, words[word_of[new]], c[word_of[new]]))
        # triples
        pair_of = np.repeat(np.arange(len(entries)), subs)
        found = trie.third.find(at[pair_of], third)
        score = above[pair_of]
        known = np.flatnonzero(found >= 0)
        score[known] = trie.third.value(0, found[known])
        if len(hot[2].keys):
            new = np.flatnonzero((found < 0) & (third > 0))
            n3 = hot[2].whole(_triple_key(keys[pair_of[new]], third[new]), np.zeros(len(new), np.int64))
            score[new] = np.log10(n3 + 10.0 ** score[new])
        # the pair's own part as the context of what follows
        score -= below[pair_of]
        word = word_of[pair_of]
        docs, k = np.frombuffer(r.docs, np.uint16), len(r.held)
        token = np.repeat(word, posts)
        sums = (
            np.bincount(docs, minlength=k).astype(np.uint32),
            np.bincount(docs, (c > 0)[token], k).astype(np.uint32),
            np.bincount(docs, np.log10(base)[token], k),
            np.bincount(docs, np.repeat(score, posts), k).astype(np.float32),
        )
        out.append((r.shard, r.block, r.used, *[x.tobytes() for x in sums], r.ids))
    trie.close()
    return pd.DataFrame(out, columns=[x.split()[0] for x in _SUMS.split(", ")])


def _total_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of a block's texts over all shards."""
    meta = next(x for x in pdf["ids"] if x is not None)
    k = len(meta) // 10
    ids, known, held = np.frombuffer(meta[: 8 * k], np.int64), np.frombuffer(meta[8 * k : 9 * k], np.uint8), np.frombuffer(meta[9 * k :], np.uint8)
    sums = np.zeros((4, k))
    for r in pdf.sort_values("shard").itertuples():
        used = np.frombuffer(r.used, np.uint16)
        for i, (raw, kind) in enumerate(((r.n, np.uint32), (r.known, np.uint32), (r.base, np.float64), (r.pair, np.float32))):
            sums[i, used] += np.frombuffer(raw, kind)
    return pd.DataFrame(
        {"doc_id": pd.array(ids, "Int64"), "held_out": held.astype(bool), "n_tokens": sums[0].astype(np.int64), "n_known": sums[1].astype(np.int64), "base_score": sums[2], "score": sums[3]}
    ).assign(doc_id=lambda f: f["doc_id"].where(known.astype(bool)))


def held_out(doc_id: str = "doc_id", folds: int = 10):
    """Whether crc32 of the id as text leaves remainder 0; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def _hot_context(training: DataFrame, words: list[int], more: list[bytes], classes) -> tuple[Hot, Hot]:
    """The hot pairs and triples among the given ones, counted exactly over the texts."""
    if not words:
        return Hot.of({}), Hot.of({})
    word = np.array(words, np.int64).view(np.uint64)
    before = np.frombuffer(b"".join(m[:8] for m in more), np.uint64)
    pairs = _pair_key(word, _entries(before, classes.value))
    three = np.array([len(m) > 8 for m in more])
    third = np.array([int.from_bytes(m[8:], "little") for m in more], np.uint32)
    triples = _triple_key(pairs[three], third[three])
    keys = np.concatenate([pairs[~three], triples])
    counts = training.mapInArrow(lambda b: _count_hot(b, keys, classes), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    counts = {k & (1 << 64) - 1: n for k, n in zip(counts["key"], counts["n"], strict=True)}
    return tuple(Hot.of({k: counts[k] for k in part.tolist() if k in counts}) for part in (pairs[~three], triples))


def lm_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of docs.

    docs needs doc_id and text; other columns are ignored. The model learns from the rows that aren't
    held out. Tokens: words, A-Z lower-cased, then one end. n_known: tokens that training has; train_tokens: those
    of training. base_score: log10 probability under the smoothed unigram distribution, score: under the
    trigram model, see the module. A null or empty text is its end token. Rows without doc_id are trained
    on. Repeated rows come out each; an empty table gives an empty one; texts of any length are scored whole.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", held_out())
    training = rows.where("not held_out").select("text")
    counted = training.mapInArrow(_count_words, "word long, more binary, n long")
    counted = stored(counted.groupBy("word", "more").agg(F.sum("n").alias("n")), "words")
    words = counted.where("more IS NULL")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = words.where(F.col("n") > int(total * HOT_SHARE)).toArrow().to_pydict()
    hot_words = Hot.of(dict(zip(frequent["word"], frequent["n"], strict=True)))
    # how often the words of a cell occur, as a power of two; at most CELLS rows reach the driver
    cell = F.col("word").bitwiseAND(F.lit(CELLS - 1)).cast("int").alias("cell")
    summed = words.groupBy(cell).agg(F.sum("n").alias("n")).select("cell", F.floor(F.log2("n")).cast("int").alias("class")).toArrow()
    table = np.zeros(CELLS, np.uint8)
    table[summed["cell"].to_numpy()] = summed["class"].to_numpy()
    classes = spark.sparkContext.broadcast(table)
    # pairs and triples that may be hot: fewer than 2 / PAIR_SHARE
    may = counted.where(F.col("more").isNotNull() & (F.col("n") > int(total * PAIR_SHARE)) & (F.col("n") * 4 > SHARD_TOKENS)).toArrow().to_pydict()
    drop(counted)
    hot_pairs, hot_triples = _hot_context(training, may["word"], may["more"], classes)
    hot = hot_words, hot_pairs, hot_triples
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_TOKENS))
    dealt = rows.mapInArrow(lambda b: _deal(b, hot, classes, shards), _DEALT)
    sums = dealt.groupBy("shard").applyInPandas(lambda p: _score_shard(p, total, distinct, hot, classes), _SUMS)
    result = sums.groupBy("block").applyInPandas(_total_block, _RESULT)
    return result.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
