"""A Merkle manifest of a table: a tree of digests per source, a tree over the sources, and a proof for every row.

The nodes of a tree form an append log: leaves are appended in order, and a node is written the moment its last child
is, so a subtree is a contiguous stretch of the log, its root last (postorder). Builders take aligned blocks of
3 ** BLOCK_LEVELS consecutive leaves, each a task's small group, and write their stretch; the roots of the blocks are the
leaves of the next round, until one node is left. Where a node lies follows from its level and index alone: what
precedes it are all nodes of the leaves before it, and their number is a sum of quotients. So a proof addresses each
sibling by its position, without search. Proofs are extracted from the top down, one row per block and round.

A run of a level has three nodes, the last one of a level may have fewer, down to one; each run becomes one node, the
SHA-256 of the lowercase hex digests of its nodes. A tree of one leaf is that leaf.

Nulls: each null field of a row counts as `-`, other fields as byte count, colon and value, so null and "-" differ. Rows
without a source are a tree of their own, before all others; within a tree, rows without doc_id come first. Rows of one
doc_id are ordered by their leaf; rows alike in every field are alike in all but their proof. Empty and very long texts
are hashed whole. An empty table has no rows and no root. Only the five declared columns are read.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import ranked, salted_join, small_side, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
#: Levels that one builder adds; it holds ARITY ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 6
#: Rows with a path of siblings, about 1 kB each, up to which they are broadcast.
BROADCAST_PATHS = 20_000


def leaf(fields: Iterable[Column]) -> Column:
    """Digest (32 bytes) of the values of a row."""

    def part(column: Column) -> Column:
        text = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(c) for c in fields]), 256))


def tree_of(source: Column) -> Column:
    """Name of the tree of a source; in bytewise order, that of the missing source is the first."""
    return F.coalesce(F.concat(F.lit("+"), source.cast("string")), F.lit(""))


def document_leaves(docs: DataFrame, claimed_text: Column | None = None) -> DataFrame:
    """tree, doc_id, leaf, and claim: the leaf as it is with the claimed text in place of the text."""
    fields = {name: F.col(name) for name in FIELDS}
    own = leaf(fields.values())
    other = leaf((fields | {"text": claimed_text}).values()) if claimed_text is not None else own
    changed = F.lit(False) if claimed_text is None else ~claimed_text.eqNullSafe(F.col("text"))
    rows = docs.select(tree_of(F.col("source")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), own.alias("leaf"), F.when(changed, other).alias("claim"))
    return rows.withColumn("claim", F.coalesce("claim", "leaf"))


# The tree as arithmetic ---------------------------------------------------------


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels, reach = 0, 1
    while reach < n:
        levels, reach = levels + 1, reach * ARITY
    return levels


def appended(leaves: int, top: int) -> int:
    """Nodes that are complete once so many leaves are appended, up to level top."""
    return sum(leaves // ARITY**level for level in range(top + 1))


def position(level: int, index: int, n: int, top: int) -> int:
    """Place in the log of a node, in a tree of n leaves that is cut above level top."""
    end = (index + 1) * ARITY**level
    if end <= n:
        return appended(end - 1, top) + level
    first = 1  # lowest level whose last run is not full; it and all above it are closed after the last leaf
    while n % ARITY**first == 0:
        first += 1
    return appended(n, top) + level - first


def run_of(level: int, index: int, n: int) -> range:
    """Indices of the nodes that become one node together with this one."""
    first = index - index % ARITY
    return range(first, min(first + ARITY, -(-n // ARITY**level)))


def node(children: Iterable[bytes]) -> bytes:
    return hashlib.sha256(b"".join(map(hexlify, children))).digest()


def append_all(leaves: Iterable[bytes], top: int) -> list[bytes]:
    """The log of a tree up to level top: every node in the order of completion."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(top + 1)]

    def append(digest: bytes, level: int) -> None:
        log.append(digest)
        if level < top:
            open_runs[level].append(digest)
            if len(open_runs[level]) == ARITY:
                close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        append(node(run), level + 1)

    for digest in leaves:
        append(digest, 0)
    for level in range(top):
        if open_runs[level]:
            close(level)
    return log


def sibling_paths(log: bytes, n: int, top: int, above: bytes) -> list[bytes]:
    """For each of n leaves: the digests of the siblings on the way up, level by level, left to right, then above."""
    paths = [above]
    for level in range(top - 1, -1, -1):
        below = []
        for index in range(-(-n // ARITY**level)):
            places = [position(level, k, n, top) for k in run_of(level, index, n) if k != index]
            below.append(b"".join(log[32 * p : 32 * p + 32] for p in places) + paths[index // ARITY])
        paths = below
    return paths


def fold(digest: bytes, path: bytes, index: int, n: int) -> tuple[bytes, bytes]:
    """Root that a leaf and its siblings give, and what is left of the path."""
    for level in range(height(n)):
        run = run_of(level, index, n)
        taken = 32 * (len(run) - 1)
        siblings = [path[i : i + 32] for i in range(0, taken, 32)]
        siblings.insert(index - run.start, digest)
        digest, path, index = node(siblings), path[taken:], index // ARITY
    return digest, path


# Builders -------------------------------------------------------------------------

_SEGMENT = "tree string, block long, n long, log binary, ids array<long>, claims binary"


def _builder(base: int, levels: int) -> Callable[[pa.Table], pa.Table]:
    """Writes the stretch of the log that belongs to one aligned block; its leaves are of level base."""

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("index")
        n = rows["n"][0].as_py()
        top = min(levels, height(n) - base)
        out = {
            "tree": rows["tree"][:1], "block": rows["block"][:1], "n": rows["n"][:1],
            "log": [b"".join(append_all(rows["digest"].to_pylist(), top))],
            "ids": [rows["id"].to_pylist()], "claims": [b"".join(rows["claim"].to_pylist())],
        }
        return pa.table([pa.array(v.to_pylist() if isinstance(v, pa.ChunkedArray) else v, t) for v, t in zip(out.values(), (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()))], list(out))

    return build


def append_log(leaves: DataFrame, levels: int, label: str) -> list[DataFrame]:
    """Segments of the log, one table per round. leaves: tree, index, n, digest, id, claim.

    A segment has tree, block (the index of its root among the block roots of the round), n (leaves of the tree), log (its
    nodes in order of completion, 32 bytes each), and the ids and claims of its leaves, which only the first round has.
    """
    rounds, base = [], 0
    columns = ["tree", "index", "n", "digest", "id", "claim"]
    while True:
        blocks = leaves.select("tree", F.expr(f"index div {ARITY**levels}").alias("block"), *columns[1:])
        built = blocks.groupBy("tree", "block").applyInArrow(_builder(base, levels), _SEGMENT)
        rounds.append(stored(built, f"{label}-{base}"))
        base += levels
        more = rounds[-1].where(F.col("n") > ARITY**base)
        if more.isEmpty():
            return rounds
        leaves = more.select(
            "tree", F.col("block").alias("index"), "n", F.substring("log", -32, 32).alias("digest"),
            F.lit(None).cast("long").alias("id"), F.lit(b"").alias("claim"),
        )


def _last_segments(rounds: list[DataFrame], r: int, levels: int) -> DataFrame:
    """Segments of round r whose root is the root of their tree."""
    done = F.col("n") <= ARITY ** (levels * (r + 1))
    return rounds[r].where(done & (F.col("n") > ARITY ** (levels * r)) if r else done)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def roots(rounds: list[DataFrame], levels: int) -> DataFrame:
    """tree, n, root of each tree."""
    ends = [_last_segments(rounds, r, levels) for r in range(len(rounds))]
    return _union([s.select("tree", "n", F.substring("log", -32, 32).alias("root")) for s in ends])


def _segment_size(n: int, base: int, block: int, levels: int) -> tuple[int, int]:
    """Leaves of a segment, and the levels it adds."""
    whole = ARITY**levels
    return min(whole, -(-n // ARITY**base) - block * whole), min(levels, height(n) - base)


def _paths_below(base: int, levels: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size, top = _segment_size(row["n"], base, row["block"], levels)
                paths = sibling_paths(row["log"], size, top, row["above"])
                first = row["block"] * ARITY**levels
                yield pa.record_batch(
                    [pa.array([row["tree"]] * size, pa.string()), pa.array(range(first, first + size), pa.int64()), pa.array(paths, pa.binary())],
                    ["tree", "block", "above"],
                )

    return extract


def with_paths(rounds: list[DataFrame], levels: int, tops: DataFrame, label: str) -> DataFrame:
    """Segments of the first round with `above`: the siblings of the segment's root, up to the root of its tree and beyond.

    tops: tree, above, the siblings of the tree's root in a tree over trees. Each round hands its leaves their paths.
    """
    above = None
    for r in range(len(rounds) - 1, -1, -1):
        ended = _last_segments(rounds, r, levels).join(tops, "tree").select("tree", "block", "above")
        above = stored(ended if above is None else ended.unionByName(above), f"{label}-paths")
        segments = rounds[r].join(small_side(above, BROADCAST_PATHS), ["tree", "block"])
        if r == 0:
            return segments
        inner = segments.select("tree", "block", "n", "log", "above")
        above = inner.mapInArrow(_paths_below(levels * r, levels), "tree string, block long, above binary")
    raise AssertionError("a log has at least one round")


# The manifest ---------------------------------------------------------------------


def _placed(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """rows in the given order, with index and n: the place within the tree, and the rows of the tree."""
    placed = ranked(rows, [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order]], label)
    trees = stored(placed.groupBy("tree").agg(F.min("place").alias("_first"), F.count("*").alias("n")), f"{label}-trees")
    one = small_side(trees)
    joined = placed.join(one, "tree") if one is not trees else salted_join(placed, trees, "tree", "place")
    return joined.withColumn("index", F.col("place") - F.col("_first")).drop("_first")


_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_PROOF_ARROW = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())])


def _prover(root: bytes, levels: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size, top = _segment_size(row["n"], 0, row["block"], levels)
                log, claims, out = row["log"], row["claims"], []
                first, subroot = row["block"] * ARITY**levels, row["subroot"].hex()
                for j, path in enumerate(sibling_paths(log, size, top, row["above"])):
                    at = 32 * position(0, j, size, top)
                    folded, rest = fold(claims[32 * j : 32 * j + 32], path, first + j, row["n"])
                    folded, _ = fold(folded, rest, row["place"], row["trees"])
                    digest = hashlib.sha256(hexlify(path)).hexdigest()
                    out.append((row["ids"][j], log[at : at + 32].hex(), subroot, root.hex(), digest, folded.hex(), folded == root))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), _PROOF_ARROW.types)], _PROOF_ARROW.names)

    return prove


class Manifest:
    """The logs of a table: one of each source's tree, and one of the tree over the sources.

    `rounds` and `top_rounds` hold their segments; `subroots` has tree, n, place, root of each source.
    """

    def __init__(self, leaves: DataFrame, levels: int = BLOCK_LEVELS) -> None:
        """leaves: tree, doc_id, leaf, claim, as document_leaves() gives them. levels: those that a builder adds."""
        self.levels = levels
        placed = _placed(stored(leaves, "leaves"), ["doc_id", "leaf"], "leaves-in-order")
        own = placed.select("tree", "index", "n", F.col("leaf").alias("digest"), F.col("doc_id").alias("id"), "claim")
        self.rounds = append_log(own, levels, "log")
        found = roots(self.rounds, levels).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("n").alias("rows"), "root")
        over = stored(_placed(stored(found, "subroots"), ["name"], "subroots-in-order"), "subroots")
        tops = over.select("tree", "index", "n", F.col("root").alias("digest"), F.col("index").alias("id"), F.lit(b"").alias("claim"))
        self.top_rounds = append_log(tops, levels, "top-log")
        self.subroots = over.select(F.col("name").alias("tree"), F.col("rows").alias("n"), F.col("index").alias("place"), F.col("n").alias("trees"), "root")

    def root(self) -> bytes | None:
        """The root over all sources; None if the table is empty."""
        row = roots(self.top_rounds, self.levels).first()
        return bytes(row["root"]) if row else None

    def proofs(self) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

        folded_root is what the claim and the siblings give; it verifies the claim if it is the root.
        """
        root = self.root()
        if root is None:
            return self.subroots.sparkSession.createDataFrame([], _PROOF)
        beyond = roots(self.top_rounds, self.levels).select("tree", F.lit(b"").alias("above"))
        top = with_paths(self.top_rounds, self.levels, beyond, "top").select("tree", "block", "n", "log", "above")
        paths = top.mapInArrow(_paths_below(0, self.levels), "tree string, block long, above binary")
        tops = stored(self.subroots.join(paths.select(F.col("block").alias("place"), "above"), "place"), "tops")
        segments = with_paths(self.rounds, self.levels, tops.select("tree", "above"), "log")
        known = small_side(stored(tops.select("tree", F.col("root").alias("subroot"), "place", "trees"), "known"))
        return segments.join(known, "tree").mapInArrow(_prover(root, self.levels), _PROOF)

    def log(self) -> DataFrame:
        """Every node of the sources' trees: tree, position, level, index, digest. By position, children come before their parent."""

        levels = self.levels

        def rows(base: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
            def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for row in batch.to_pylist():
                        n, (size, top) = row["n"], _segment_size(row["n"], base, row["block"], levels)
                        out = []
                        for level in range(1 if base else 0, top + 1):  # the leaves of a later round are roots of the one before
                            first = row["block"] * ARITY ** (levels - level)
                            for k in range(-(-size // ARITY**level)):
                                at = 32 * position(level, k, size, top)
                                out.append((row["tree"], position(base + level, first + k, n, height(n)), base + level, first + k, row["log"][at : at + 32].hex()))
                        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                        if out:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["tree", "position", "level", "index", "digest"])

            return explode

        schema = "tree string, position long, level long, index long, digest string"
        frames = [s.select("tree", "block", "n", "log").mapInArrow(rows(levels * r), schema) for r, s in enumerate(self.rounds)]
        return _union(frames)
