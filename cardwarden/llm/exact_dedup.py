"""Exact deduplication by composable polynomial fingerprints.

A text is cut into chunks. The fingerprint of a chunk is a polynomial over its bytes, modulo two
primes; those of consecutive chunks combine by F(xy) = F(x) * B**len(y) + F(y). So the chunks of
a huge text are hashed by different tasks, and a text's fingerprint doesn't depend on how it was cut.

Equal fingerprints only propose a group. Its texts are then compared chunk by chunk with those of
the row that would stay, and a text that differs is grouped by its SHA-256 instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import drop, drop_numbered, numbered, salted_join, stored

#: Characters of a chunk. The chunks of longer texts are dealt over all tasks.
CHUNK = 1 << 20
#: Members of a group that are compared with one copy of the text that stays.
LANE_ROWS = 256

#: Two primes below 2**31, so that products fit 64 bits, and the bases of the polynomials.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 747_796_405)

_LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Bytes of a lane. Lanes are evaluated side by side and combined like chunks.
_LANE = 256


def normalised(text: str = "text") -> Column:
    """The text with A-Z lower-cased and nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), *_LETTERS)


def _fingerprints(pieces: list[bytes]) -> list[list[int]]:
    """For each prime, the fingerprints of many short pieces of bytes: lanes of all pieces at once."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.array([len(p) for p in pieces], np.int64)
    lanes = -(-size // _LANE)
    # the first lane of a piece is padded in front: leading zeros don't change a polynomial
    padded = np.zeros(int(lanes.sum()) * _LANE, np.int64)
    start = np.cumsum(lanes) * _LANE - size
    shift = np.repeat(start - (np.cumsum(size) - size), size)
    padded[np.arange(len(data)) + shift] = data.astype(np.int64) + 1
    grid = np.ascontiguousarray(padded.reshape(-1, _LANE).T)
    ends = np.cumsum(lanes)
    out = []
    for base, prime in zip(BASES, PRIMES, strict=True):
        value = np.zeros(grid.shape[1], np.int64)
        for column in grid:
            value = (value * base + column) % prime
        step, values, at, result = pow(base, _LANE, prime), value.tolist(), 0, []
        for end in ends.tolist():
            total = 0
            for lane in values[at:end]:
                total = (total * step + lane) % prime
            result.append(total)
            at = end
        out.append(result)
    return out


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the byte length, the fingerprints and the shift factors of each chunk; drops the chunk."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            raw = [x.encode("utf-8", "surrogatepass") for x in batch["chunk"].to_pylist()]
            size = [len(x) for x in raw]
            first, second = _fingerprints(raw)
            arrays = [batch[c] for c in batch.schema.names if c != "chunk"]
            arrays += [pa.array(x, pa.int64()) for x in (size, first, second)]
            arrays += [pa.array([pow(b, n, p) for n in size], pa.int64()) for b, p in zip(BASES, PRIMES, strict=True)]
            names = [c for c in batch.schema.names if c != "chunk"]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "size", "f1", "f2", "b1", "b2"])


def _combined(parts: Column, value: str, shift: str, prime: int) -> Column:
    """Fingerprint of a text from its chunks in order."""
    return F.aggregate(parts, F.lit(0).cast("long"), lambda total, x: F.pmod(total * x[shift] + x[value], F.lit(prime).cast("long")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, row, sha, n_bytes, f1, f2) of each row of docs (doc_id, row, norm, sha)."""
    made = "size long, f1 long, f2 long, b1 long, b2 long"
    short = docs.where(F.length("norm") <= CHUNK).select("doc_id", "row", "sha", F.col("norm").alias("chunk"))
    short = short.mapInArrow(_hash_chunks, f"doc_id long, row long, sha string, {made}")
    pieces = docs.where(F.length("norm") > CHUNK).select(
        "doc_id", "row", "sha",
        F.posexplode(F.expr(f"transform(sequence(0, (length(norm) - 1) div {CHUNK}), i -> substring(norm, int(i * {CHUNK} + 1), {CHUNK}))")).alias("no", "chunk"),
    )
    spread = pieces.repartition("row", "no").mapInArrow(_hash_chunks, f"doc_id long, row long, sha string, no int, {made}")
    long = (
        spread.groupBy("doc_id", "row", "sha")
        .agg(F.sort_array(F.collect_list(F.struct("no", "size", "f1", "f2", "b1", "b2"))).alias("parts"), F.sum("size").alias("n_bytes"))
        .select("doc_id", "row", "sha", "n_bytes", _combined(F.col("parts"), "f1", "b1", PRIMES[0]).alias("f1"), _combined(F.col("parts"), "f2", "b2", PRIMES[1]).alias("f2"))
    )
    return short.select("doc_id", "row", "sha", F.col("size").alias("n_bytes"), "f1", "f2").unionByName(long)


def compared(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows whose text differs from the one that stays in their group: (row).

    groups: (row, group, keeper, size) of the rows in groups of two or more; keeper is the row that
    stays. Both texts are read chunk by chunk; the keeper's chunks are repeated for each LANE_ROWS
    members, so a group that holds a third of all rows is compared by many tasks.
    """
    lanes = (F.col("size") / LANE_ROWS).cast("int") + 1
    chunk = F.posexplode(F.expr(f"transform(sequence(0, greatest(length(norm) - 1, 0) div {CHUNK}), i -> substring(norm, int(i * {CHUNK} + 1), {CHUNK}))"))
    texts = docs.select("row", "norm").join(groups, "row")
    member = texts.where("row <> keeper").select("row", "keeper", F.pmod(F.xxhash64("row"), lanes).alias("lane"), chunk.alias("no", "chunk"))
    keeper = texts.where("row = keeper").select("keeper", F.explode(F.sequence(F.lit(0).cast("long"), (lanes - 1).cast("long"))).alias("lane"), "norm")
    keeper = keeper.select("keeper", "lane", chunk.alias("no", "kept"))
    both = member.join(keeper, ["keeper", "lane", "no"], "left")
    return both.where("not (chunk <=> kept)").select("row").distinct()


def exact_groups(docs: DataFrame, row: str | None = None) -> DataFrame:
    """(doc_id, row, keep_id, group_size, kept, text_sha256), one row per row of docs.

    docs needs doc_id and text. row names a column that numbers the rows, else one is added. Texts are equal when identical after lower-casing A-Z; null
    counts as empty, and empty texts are equal to each other. Of equal texts, the row with the largest
    doc_id stays (null is below any); of rows with the same doc_id and text too, the one with the largest
    row. keep_id is that row's doc_id, group_size the number of equal rows. Extra columns are ignored.
    An empty table gives an empty one. Very long texts are cut into chunks, see the module.
    """
    rows = numbered(docs, row)
    docs = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "row", normalised().alias("norm")).withColumn("sha", F.sha2("norm", 256))
    prints = stored(fingerprints(docs), "prints")
    group = ["n_bytes", "f1", "f2"]
    last = F.max(F.struct("doc_id", "row")).alias("last")
    many = prints.groupBy(*group).agg(F.count("*").alias("size"), last).where("size > 1")
    many = stored(many.select(*group, "size", F.col("last.row").alias("keeper")), "groups")
    # members come to their group by a shuffle on the group; a large one is split by adaptive execution
    members = prints.select("row", *group).join(many, group).select("row", "keeper", "size")
    members = stored(members, "members")
    odd = stored(compared(docs, members), "odd")
    final = prints.join(odd.withColumn("odd", F.lit(True)), "row", "left").withColumn("other", F.when(F.col("odd"), F.col("sha")).otherwise(F.lit("")))
    key = [*group, "other"]
    totals = final.groupBy(*key).agg(F.count("*").alias("group_size"), last).where("group_size > 1")
    # a row that is alone needs no partner; a group that holds a third of all rows is dealt over lanes
    alone = F.col("group_size").isNull()
    out = salted_join(final, stored(totals, "totals"), key, "row", "left").select(
        "doc_id", "row", F.when(alone, F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("last.row"))).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    out = stored(out, "exact")
    drop(prints, many, members, odd)
    drop_numbered(rows, row)
    return out
