"""Benchmark decontamination by spaced-seed hashing.

A seed is a mask over consecutive tokens; the tokens at its gaps are ignored, so a seed still hits where
a word was substituted. The hashes of all masked windows of the benchmark are put into a bit table of fixed
size, by which each document keeps only the windows that may hit. These are joined with
the benchmark's windows by hash. Around a hit, the document and the item are laid side by side on
that diagonal and compared token by token; the largest stretches that agree well enough are copies if they are large enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import drop, drop_numbered, numbered, salted_join, small_side, stored
from cardwarden.llm.words import constants, mix, word_hashes

#: Masks; 1: the token counts, 0: it is ignored. Any two substitutions in 13 tokens leave a hit of some mask, and 98 % of
#: all placements of three; so do 99 % of those of four in 16, and all of five in 24 that were tried.
MASKS = ("111111", "1111011", "11101011", "11111001", "1101000111", "110011011")
#: A contaminated stretch has so many equal tokens, or all of a shorter item, and so large a share of them.
LEAST_TOKENS = 10
LEAST_SHARE = 0.75
#: log2 of the bits of the table of benchmark hashes: 8 MB.
TABLE_BITS = 26

_PUNCTUATION = r"[^\p{L}\p{M}\p{N}\s]+"


def _masked(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of each window under the mask."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, hash_of_mask(mask), np.uint64)
    for j, (bit, factor) in enumerate(zip(mask, constants(len(mask), 41), strict=True)):
        if bit == "1":
            out += hashes[j : j + n] * factor
    return mix(out)


def hash_of_mask(mask: str) -> int:
    return int(mix(np.array([int("1" + mask, 2)], np.uint64))[0])


def seeds(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of all windows of all masks. A text shorter than the shortest mask is one seed."""
    shortest = min(map(len, MASKS))
    if 0 < len(tokens) < shortest:
        whole = (tokens * constants(shortest, 43)[: len(tokens)]).sum(dtype=np.uint64)
        return mix(np.array([whole + np.uint64(len(tokens))])), np.zeros(1, np.int64)
    found = [_masked(tokens, m) for m in MASKS]
    return np.concatenate(found), np.concatenate([np.arange(len(f)) for f in found])


def _short_seeds(tokens: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the lengths of items that are shorter than the shortest mask."""
    shortest = min(map(len, MASKS))
    hashes, places = [], []
    for n in lengths:
        if 0 < n <= len(tokens):
            k = len(tokens) - n + 1
            out = np.full(k, n, np.uint64)
            for j, factor in enumerate(constants(shortest, 43)[:n]):
                out += tokens[j : j + k] * factor
            hashes.append(mix(out))
            places.append(np.arange(k))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(texts)


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, bounds = _tokens(batch["words"].to_pylist())
        rows = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["item_id"], pa.array([len(r) for r in rows], pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())],
            ["item_id", "n_item", "item"],
        )


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item_id, raw in zip(batch["item_id"].to_pylist(), batch["item"].to_pylist(), strict=True):
            found, place = seeds(np.frombuffer(raw, np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array([item_id] * len(found), pa.int64()), pa.array(place.astype(np.int32))],
                ["seed", "item_id", "item_pos"],
            )


def _bits(seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash in the table."""
    return (seed >> np.uint64(64 - TABLE_BITS)).astype(np.int64), (seed & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)


def _bit_table(item_seeds: DataFrame) -> np.ndarray:
    """Bits of all seeds, as bytes. At most 2**(TABLE_BITS - 6) rows reach the driver, however many items there are."""
    low = F.col("seed").bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    high = F.shiftrightunsigned("seed", 64 - TABLE_BITS)
    words = (
        item_seeds.select(F.explode(F.array(low, high)).alias("bit"))
        .select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mask"))
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .toArrow()
    )
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    table[words["word"].to_numpy()] = words["mask"].to_numpy()
    return table


def _hits(batches: Iterator[pa.RecordBatch], table, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """Documents with a window that may be in the benchmark: their tokens and these windows."""
    bits = table.value
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            hashes, bounds = _tokens(batch["words"].to_pylist())
            rows = []
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                tokens = hashes[a:b]
                if not len(tokens):
                    continue
                found, place = seeds(tokens) if len(tokens) >= min(map(len, MASKS)) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                if lengths:
                    more, where = _short_seeds(tokens, lengths)
                    found, place = np.concatenate([found, more]), np.concatenate([place, where])
                one, two = _bits(found)
                held = (bits[one >> 6] >> (one & 63) & 1).astype(bool)
                held[held] = bits[two[held] >> 6] >> (two[held] & 63) & 1
                if held.any():
                    rows.append((i, tokens.tobytes(), found[held].view(np.int64), place[held].astype(np.int32)))
            if rows:
                index = pa.array([r[0] for r in rows])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(index), batch["row"].take(index), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.list_(pa.int32()))],
                    ["doc_id", "row", "tokens", "seeds", "places"],
                )


def longest_stretch(same: np.ndarray) -> tuple[int, int]:
    """(start, end) of the stretch with the most places set, and LEAST_SHARE of its places; the first of them, without unset ends."""
    assert LEAST_SHARE == 3 / 4
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -3))])  # a stretch agrees if its sum is not negative
    lowest = np.minimum.accumulate(total)
    start = np.searchsorted(-lowest, -total)  # the first place that is not above each end
    ones = np.concatenate([[0], np.cumsum(same)])
    stop = int((ones - ones[start]).argmax())
    held = np.flatnonzero(same[start[stop] : stop])
    return (int(start[stop] + held[0]), int(start[stop] + held[-1]) + 1) if len(held) else (0, 0)


def copied_stretches(doc: np.ndarray, item: np.ndarray, diagonal: int) -> list[tuple[int, int, int]]:
    """(start in doc, length, equal tokens) of the copies on a diagonal: the largest one, and those on either side of it."""
    first = max(0, diagonal)
    end = min(len(doc), diagonal + len(item))
    same = doc[first:end] == item[first - diagonal : end - diagonal]
    least = min(LEAST_TOKENS, len(item))
    out, todo = [], [(0, len(same))]
    while todo:
        low, high = todo.pop()
        if int(same[low:high].sum()) < least:
            continue
        start, stop = (low + k for k in longest_stretch(same[low:high]))
        equal = int(same[start:stop].sum())
        if stop > start:
            if equal >= least:
                out.append((first + start, stop - start, equal))
            todo += [(low, start), (stop, high)]
    return sorted(out)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = [batch[c].to_pylist() for c in ("doc_id", "row", "item_id", "tokens", "item", "diagonals")]
        for doc_id, row, item_id, tokens, item, diagonals in zip(*columns, strict=True):
            doc, other = np.frombuffer(tokens, np.uint64), np.frombuffer(item, np.uint64)
            for diagonal in diagonals:
                rows += [(doc_id, row, item_id, *found) for found in copied_stretches(doc, other, diagonal)]
        names = ["doc_id", "row", "item_id", "start", "n_words", "n_equal"]
        kinds = [pa.int64()] * 3 + [pa.int32()] * 3
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _plain(text: str) -> F.Column:
    """Punctuation counts as white space."""
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), _PUNCTUATION, " ")


def overlaps(docs: DataFrame, benchmark: DataFrame, row: str | None = None) -> DataFrame:
    """(doc_id, row, item_id, start, n_words, n_equal): stretches of documents that repeat a benchmark item.

    docs needs doc_id and text, benchmark item_id and text. row names a column that numbers the rows of
    docs, else one is added. Tokens are words, A-Z lower-cased, punctuation as white space. A stretch is n_words
    long from word `start` on, n_equal of its words are those of the item; it has LEAST_TOKENS
    equal words, or all of a shorter item, and at least LEAST_SHARE of its words are equal; of stretches that overlap on a
    diagonal, the one with the most. Only stretches with a hit of some mask are found: surely those of 13 words with two
    substitutions, 0.99 of those of 16 with four at random. Null and
    empty texts and null item_ids give nothing; repeated rows come out each; an empty table on either
    side gives an empty one. Extra columns are ignored.
    """
    spark = docs.sparkSession
    rows = numbered(docs, row)
    docs = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "row", _plain("text").alias("words"))
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), _plain("text").alias("words")).distinct()
    items = stored(items.mapInArrow(_item_rows, "item_id long, n_item int, item binary").where("n_item > 0"), "items")
    item_seeds = stored(items.select("item_id", "item").mapInArrow(_item_seeds, "seed long, item_id long, item_pos int"), "item-seeds")
    table = spark.sparkContext.broadcast(_bit_table(item_seeds))
    shortest = min(map(len, MASKS))
    lengths = [r[0] for r in items.where(F.col("n_item") < shortest).select("n_item").distinct().collect()]
    schema = "doc_id long, row long, tokens binary, seeds array<long>, places array<int>"
    hits = stored(docs.mapInArrow(lambda b: _hits(b, table, lengths), schema), "hits")
    pairs = hits.select("row", F.explode(F.arrays_zip("seeds", "places")).alias("hit")).select("row", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("pos"))
    # a passage that a third of the documents holds is one seed: its rows are dealt over lanes
    met = salted_join(pairs, item_seeds, "seed", "row")
    near = met.groupBy("row", "item_id").agg(F.collect_set(F.col("pos") - F.col("item_pos")).alias("diagonals"))
    near = stored(near, "near")
    sides = near.join(hits.select("doc_id", "row", "tokens"), "row")
    sides = salted_join(sides, small_side(items.select("item_id", "item")), "item_id", "row")
    found = sides.mapInArrow(_verify, "doc_id long, row long, item_id long, start int, n_words int, n_equal int")
    found = stored(found.distinct(), "overlaps")
    drop(item_seeds, hits, near)
    drop_numbered(rows, row)
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, row: str | None = None) -> DataFrame:
    """(doc_id, row, contaminated, items, n_equal), one row per row of docs; see overlaps().

    items: sorted item_ids that the document repeats; n_equal: equal words of its longest stretch, 0 if none.
    """
    docs = numbered(docs, row)
    found = overlaps(docs, benchmark, "row").groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("n_equal").alias("n_equal"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "row")
    none = F.array().cast("array<long>")
    return ids.join(found, "row", "left").select(
        "doc_id", "row", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", none).alias("items"), F.coalesce("n_equal", F.lit(0)).alias("n_equal"),
    )
