"""Packing of token ids into rows of fixed length by best-fit decreasing.

Each task packs its own documents, a bounded group at a time; nothing is shuffled. Documents longer than a row are
split without loss: whole rows first, then what is left. The pieces of a group are placed from the longest
to the shortest, each into the open row with the least room that holds it. That row is found in a segment tree
over the amounts of room, which knows how many rows have each.

A packed row has the ids, padded at its end, the cumulative lengths of its pieces, and positions that begin
again with each piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm import bpe

#: Ids of a row.
ROW_IDS = 8_192
#: Ids that a task packs together.
GROUP_IDS = 4_000_000
#: Options for writing the matrices. A reader takes up to 4,096 rows of a group at once, and a row has 64 KB before it is compressed.
WRITING = {"parquet.block.row.count.limit": "128"}
#: Id after the last byte of a text, and the padding; token ids have their own, see bpe.end_id().
END_ID, PAD_ID = 256, 257

_PACKED = (
    "pack_id long, n_ids int, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, ids binary, positions binary"
)


class Room:
    """Open rows by the room they have left: a segment tree with the number of rows below each node."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.tree = [0] * (2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def add(self, row: int, room: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.tree[i] += by
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """A row with the least room of at least need, and its room; it is no longer open."""
        i = need + self.size
        while not self.tree[i]:  # up, until a right neighbour has rows
            while i & 1:
                i >>= 1
            if i == 0:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.tree[2 * i] else 2 * i + 1
        room = i - self.size
        self._count(room, -1)
        return self.rows[room].pop(), room


def best_fit(lengths: list[int], row_ids: int) -> list[list[int]]:
    """Which pieces (by number) share a row; from the longest piece to the shortest."""
    rows: list[list[int]] = []
    room = Room(row_ids)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = room.take(lengths[i])
        if found is None:
            row, left = len(rows), row_ids
            rows.append([])
        else:
            row, left = found
        rows[row].append(i)
        if left > lengths[i]:
            room.add(row, left - lengths[i])
    return rows


def _emit(pieces: list[tuple[int | None, int, np.ndarray]], groups: list[list[int]], number: int, row_ids: int, pad: int) -> pa.RecordBatch:
    out = []
    for k, group in enumerate(groups):
        ids = np.full(row_ids, pad, np.int32)
        positions = np.zeros(row_ids, np.int32)
        ends = np.cumsum([0] + [len(pieces[i][2]) for i in group])
        for i, a, b in zip(group, ends[:-1], ends[1:], strict=True):
            ids[a:b] = pieces[i][2]
            positions[a:b] = np.arange(b - a)
        out.append((number + k, int(ends[-1]), [pieces[i][0] for i in group], [pieces[i][1] for i in group], ends.tolist(), ids.astype("<i4").tobytes(), positions.astype("<i4").tobytes()))
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in _PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names)


def _pack(batches: Iterator[pa.RecordBatch], row_ids: int, group_ids: int, pad: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    held: list[tuple[int | None, int, np.ndarray]] = []
    size = 0
    for batch in batches:
        for doc_id, raw in zip(batch["doc_id"].to_pylist(), batch["ids"], strict=True):
            ids = np.frombuffer(raw.as_buffer(), "<i4") if raw.is_valid else np.zeros(0, np.int32)
            whole = len(ids) // row_ids * row_ids
            for at in range(0, whole, row_ids * 64):  # whole rows of a long document
                full = [(doc_id, k, ids[k : k + row_ids]) for k in range(at, min(at + row_ids * 64, whole), row_ids)]
                yield _emit(full, [[i] for i in range(len(full))], number, row_ids, pad)
                number += len(full)
            if len(ids) > whole:
                held.append((doc_id, whole, ids[whole:].copy()))
                size += len(ids) - whole
            if size >= group_ids:
                for part, rows in _packed(held, number, row_ids, pad):
                    yield part
                    number += rows
                held, size = [], 0
    for part, _ in _packed(held, number, row_ids, pad):
        yield part


def _packed(held, number: int, row_ids: int, pad: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    groups = best_fit([len(p[2]) for p in held], row_ids)
    for at in range(0, len(groups), 64):
        part = groups[at : at + 64]
        yield _emit(held, part, number + at, row_ids, pad), len(part)


def _byte_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            ids = []
            for text in batch["text"].to_pylist():
                raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
                ids.append(np.append(raw, END_ID).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.binary())], ["doc_id", "ids"])


def byte_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, ids): the bytes of each text and an end id, as little-endian 32-bit integers. Null counts as empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_byte_ids, "doc_id long, ids binary")


def packed_rows(tokens: DataFrame, row_ids: int = ROW_IDS, group_ids: int = GROUP_IDS, pad: int = PAD_ID) -> DataFrame:
    """Rows of row_ids ids: (pack_id, n_ids, doc_ids, starts, cu_seqlens, ids, positions).

    tokens has doc_id and ids, binary with little-endian 32-bit integers; other columns are ignored. Each
    piece of a row is ids `starts` and following of document `doc_ids`; it lies between two neighbours of
    cu_seqlens. ids and positions are binary like the input; n_ids of them are no padding. Documents with null or
    no ids give no piece. Null and repeated doc_ids are packed as they are. An empty table gives an empty one.
    """
    return tokens.select("doc_id", "ids").mapInArrow(lambda b: _pack(b, row_ids, group_ids, pad), _PACKED)


def packed_texts(docs: DataFrame, rank_file: str, pattern: str, row_ids: int = ROW_IDS, group_ids: int = GROUP_IDS) -> DataFrame:
    """packed_rows() of the byte-level BPE ids of each text and an end id, which is also the last one before the padding.

    Texts are encoded and packed by one worker per task, a part of a batch at a time, so a task holds the ids of one group
    and the texts of one batch. Nulls and empty texts give the end id only.
    """
    rows, name = bpe._sent(docs, rank_file)
    pad = bpe.end_id(rank_file) + 1
    return rows.mapInArrow(lambda b: _pack(bpe._ids(b, name, pattern), row_ids, group_ids, pad), _PACKED)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet; ids and positions are the rows of two matrices."""
    packed.write.options(**WRITING).parquet(path)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [n for n in batch.schema.names if n not in ("ids", "positions")]
        shas = [pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in batch[c]]) for c in ("ids", "positions")]
        yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], *shas], [*names, "ids_sha256", "positions_sha256"])


def packed_digests(packed: DataFrame) -> DataFrame:
    """packed with SHA-256 digests in place of ids and positions."""
    rest = [c.strip() for c in _PACKED.split(", ") if not c.endswith("binary")]
    return packed.mapInArrow(_digest, ", ".join([*rest, "ids_sha256 string", "positions_sha256 string"]))
