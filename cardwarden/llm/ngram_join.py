"""Near-duplicate join on word shingles by token-combination prefixes.

Two texts link if the Jaccard similarity of their sets of distinct shingles is at least a threshold.
Shingles are ordered from rare to frequent. A set of n shingles can lack at most
d = n - ceil(threshold * n) of them in a partner, so among any d + 1 one is shared. That many rare ones
are a document's prefix, and each is a signature. If a short document has fewer rare shingles, its
prefix is extended with frequent ones until d + 2 are reached, and pairs of these are signatures
instead: the document that ends its prefix first shares a rare shingle or two frequent ones, and both lie
in the other's prefix as well. Pairs of frequent shingles are met by far fewer documents than
either. Their number grows with the square of the prefix, so longer documents (over PAIR_LIMIT
shingles) use single shingles throughout; documents near the limit use both kinds, so that every pair
that can link has a kind in common.

How often a shingle occurs is read from a table of fixed size, in which different shingles may share a
cell. It only sets the order and the class, which have to be alike everywhere but not exact.

Signatures meet in one shuffle. In every bucket, the document with the earliest position is the
pivot, and the others are verified against it. Groups of near copies are thereby one component, and no
pair inside it is looked at again. The pairs that then still share a bucket but no component are
all verified. So no link is lost, and large groups aren't expanded into pairs.

Rows with equal sets are one node from the start. A node is the 64-bit hash of its set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import components, drop, salted_join, small_side, stored
from cardwarden.llm.words import constants, mix, windows, word_hashes

WIDTH = 5
#: Similarity in hundredths.
SIMILAR = 80
#: Cells of the frequency table: 4 MB.
CELLS = 1 << 20
#: Largest set whose frequent shingles are indexed in pairs.
PAIR_LIMIT = 240
#: A shingle is frequent from this share of the documents on (and in more than FREQUENT_LEAST).
FREQUENT_SHARE = 0.001
FREQUENT_LEAST = 20
#: Rows of one signature that go to one lane.
LANE_ROWS = 5_000

_SEED = 17
_PAIR = constants(3, 29)


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, bounds = word_hashes(texts)
    runs = windows(hashes, width, _SEED)
    sets = []
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        if end - start >= width:
            sets.append(np.unique(runs[start : end - width + 1]))
        elif end > start:
            short = (hashes[start:end] * constants(width, _SEED + 1)[: end - start]).sum(dtype=np.uint64)
            sets.append(mix(np.array([short + np.uint64(end - start)])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _node(tokens: np.ndarray) -> int:
    """Hash of a set, as a signed integer."""
    total = mix(tokens + np.uint64(len(tokens))).sum(dtype=np.uint64)
    return int(mix(np.array([total ^ np.uint64(len(tokens))])).view(np.int64)[0])


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _describe(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _slices(whole):
            sets = shingle_sets(batch["text"].to_pylist(), width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["row"],
                    batch["print"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                ],
                ["doc_id", "row", "print", "n_shingles", "node"],
            )


def _cells(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Occurrences per cell of this partition's documents, 64 cells to a row."""
    counts = np.zeros(CELLS, np.int64)
    seen: set[int] = set()
    for whole in batches:
        for batch in _slices(whole):
            for tokens in shingle_sets(batch["text"].to_pylist(), width):
                node = _node(tokens)
                if len(tokens) and node not in seen:  # copies count once per task
                    if len(seen) < 1_000_000:
                        seen.add(node)
                    np.add.at(counts, (tokens & np.uint64(CELLS - 1)).astype(np.int64), 1)
    used = np.flatnonzero(counts)
    for at in range(0, len(used), 65_536):
        part = used[at : at + 65_536]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], ["cell", "n"])


def frequency_table(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """How many documents hold shingles of each of CELLS cells. At most CELLS rows reach the driver."""
    partial = docs.select("doc_id", "text").mapInArrow(lambda b: _cells(b, width), "cell long, n long")
    summed = partial.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(CELLS, np.int64)
    table[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return table


def signatures(tokens: np.ndarray, table: np.ndarray, frequent: int, similar: int = SIMILAR):
    """(signature, position of its first shingle, lanes) arrays of one set; see the module's text."""
    n = len(tokens)
    missing = n - -(-n * similar // 100)
    count = table[(tokens & np.uint64(CELLS - 1)).astype(np.int64)]
    order = np.argsort(count, kind="stable")  # ties stay in the order of the hashes
    tokens, count = tokens[order], count[order]
    parts = []
    if n > PAIR_LIMIT:
        p = missing + 1
        parts.append((tokens[:p], np.arange(p), count[:p]))
    if n * similar <= PAIR_LIMIT * 100:
        rare = int(np.searchsorted(count, frequent))
        p = min(rare, missing + 1)
        parts.append((mix(tokens[:p] ^ _PAIR[2]), np.arange(p), count[:p]))
        if rare < missing + 1 and n > 1:
            left, right = np.triu_indices(missing + 2 - rare, 1)
            left, right = left + rare, right + rare
            both = mix(tokens[left] * _PAIR[0] + tokens[right] * _PAIR[1])
            parts.append((both, left, np.minimum(count[left], count[right])))
    sig, pos, seen = (np.concatenate(x) for x in zip(*parts, strict=True))
    return sig, pos, 1 + seen // LANE_ROWS


def _sign(batches, table, frequent: int, width: int, similar: int) -> Iterator[pa.RecordBatch]:
    table = table.value
    seen: set[int] = set()
    for whole in batches:
        for batch in _slices(whole):
            rows = []
            for tokens in shingle_sets(batch["text"].to_pylist(), width):
                if len(tokens) < 2:
                    continue  # a set of one shingle links with its equals only
                node = _node(tokens)
                if node in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(node)
                sig, pos, lanes = signatures(tokens, table, frequent, similar)
                lane = np.uint64(node & (1 << 62) - 1) % lanes.astype(np.uint64)
                k = len(sig)
                rows.append((sig.view(np.int64), lane.astype(np.int32), np.full(k, node), np.full(k, len(tokens), np.int32), pos.astype(np.int32), lanes > 1))
            if rows:
                columns = [np.concatenate(x) for x in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "lane", "node", "size", "pos", "spread"])


_SIGNED = "sig long, lane int, node long, size int, pos int, spread boolean"
_MEMBER = "sig long, node long, size int, pos int, pivot long, pivot_size int, pivot_pos int, spread boolean"


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by signature, lane and position: those of buckets with two nodes or more, with the pivot.

    Keeps the last pivot and the last row only, however long a bucket is.
    """
    held: dict | None = None  # the pivot of the bucket at the end of the last batch, and if it was sent out

    for batch in batches:
        if not batch.num_rows:
            continue
        col = {name: batch[name].to_numpy(zero_copy_only=False) for name in batch.schema.names}
        if held is not None:
            col = {k: np.concatenate([[held[k]], v]).astype(v.dtype) for k, v in col.items()}
        n = len(col["sig"])
        new = np.ones(n, bool)
        new[1:] = (col["sig"][1:] != col["sig"][:-1]) | (col["lane"][1:] != col["lane"][:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        other = (col["node"] != col["node"][first]) | (col["spread"] & new)
        alone = np.bincount(first, other, n)[first] == 0
        keep = (other | new) & ~alone  # the pivot, and all that differ from it
        if held is not None and held["sent"]:
            keep[0] = False
        last = first[-1]
        sent = bool(keep[last]) or (held is not None and last == 0 and held["sent"])
        held = {k: v[last] for k, v in col.items()} | {"sent": sent}
        at = np.flatnonzero(keep)
        if len(at):
            pivot = first[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (col["sig"][at], col["node"][at], col["size"][at], col["pos"][at], col["node"][pivot], col["size"][pivot], col["pos"][pivot], col["spread"][at])],
                ["sig", "node", "size", "pos", "pivot", "pivot_size", "pivot_pos", "spread"],
            )


def _can_link(similar: int, size_a: str, pos_a: str, size_b: str, pos_b: str):
    """Whether sizes and positions leave room for the overlap that a link takes."""
    total = F.col(size_a).cast("long") + F.col(size_b)
    room = F.least(F.col(size_a) - F.col(pos_a), F.col(size_b) - F.col(pos_b)).cast("long")
    return room * (100 + similar) >= total * similar


def _compare(batches: Iterator[pa.RecordBatch], similar: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch["a_set"], batch["b_set"]
        good = []
        for i in range(batch.num_rows):
            x, y = np.frombuffer(a[i].as_buffer(), np.uint64), np.frombuffer(b[i].as_buffer(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            shared = int((y[at] == x).sum())
            good.append(100 * shared >= similar * (len(x) + len(y) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, similar: int) -> DataFrame:
    """Of the pairs (a, b) of nodes, those that link, by comparing whole sets."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chosen = stored(nodes.join(wanted, "node").select("node", "rep.*"), "chosen")
    texts = docs.join(small_side(chosen), ["doc_id", "print"]).select("node", "text")
    # several rows may have the representative's doc_id and text; keep one
    sets = texts.mapInArrow(lambda b: _packed_right(b, width), "node long, set binary")
    sets = stored(sets.dropDuplicates(["node"]), "sets")
    found = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("a_set")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("set").alias("b_set")), "b")
        .mapInArrow(lambda b: _compare(b, similar), "a long, b long")
    )
    links = stored(found, "links")
    drop(chosen, sets)
    return links


def _packed_right(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Sets of the texts that hash to the node they were joined for."""
    for whole in batches:
        for batch in _slices(whole):
            sets = shingle_sets(batch["text"].to_pylist(), width)
            nodes = batch["node"].to_pylist()
            kept = [(n, s.tobytes()) for n, s in zip(nodes, sets, strict=True) if len(s) and _node(s) == n]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.binary())], ["node", "set"]
            )


def ngram_classes(docs: DataFrame, row: str | None = None, width: int = WIDTH, similar: int = SIMILAR) -> DataFrame:
    """(doc_id, row, n_shingles, label, component_id, n_copies), one row per row of docs.

    docs needs doc_id and text; other columns are ignored. row names a column that numbers the rows, else
    one is added. n_shingles: distinct shingles of width words; a text of fewer words has one. component_id: the
    smallest doc_id reachable over links, the row's own included; rows with equal sets are linked. label:
    number of the component, null for an empty set. n_copies: rows with an equal set. A null or empty text, or one of white space only, has no shingle, links with nothing
    and is its own component. Rows without doc_id take part; their component is the smallest doc_id
    that is known, or null. Repeated rows come out as often as they went in. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    # new numbers are read once, into `shingles`; nothing is joined with docs by them
    docs = docs.withColumn("row", F.col(row) if row else F.monotonically_increasing_id())
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "row", F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("print", F.xxhash64("text"))
    rows = stored(docs.mapInArrow(lambda b: _describe(b, width), "doc_id long, row long, print long, n_shingles long, node long"), "shingles")
    docs = docs.drop("row")
    # A representative per node, to fetch its text by: doc_id, with a marker below every id for rows without one,
    # and a hash of the text, as many rows may have no doc_id or the same
    lowest = -(1 << 63)
    keyed = docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(lowest)))
    nodes = (
        rows.where("node is not null")
        .groupBy("node")
        .agg(F.min(F.struct(F.coalesce("doc_id", F.lit(lowest)).alias("doc_id"), "print")).alias("rep"), F.count("*").alias("n_rep"))
    )
    nodes = stored(nodes, "nodes")
    table = frequency_table(docs, width)
    frequent = int(max(FREQUENT_LEAST, nodes.count() * FREQUENT_SHARE) + table.mean())
    shared = spark.sparkContext.broadcast(table.astype(np.int32))
    signed = docs.mapInArrow(lambda b: _sign(b, shared, frequent, width, similar), _SIGNED)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    members = stored(
        signed.repartition(parts, "sig", "lane").sortWithinPartitions("sig", "lane", "pos", "node").mapInArrow(_buckets, _MEMBER),
        "members",
    )
    ordered = [F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")]
    stars = members.where("node <> pivot").where(_can_link(similar, "size", "pos", "pivot_size", "pivot_pos"))
    # the lanes of a frequent signature: their pivots against the first of them
    lanes = members.where("spread and node = pivot")
    heads = lanes.groupBy("sig").agg(F.min(F.struct("pos", "node", "size")).alias("head"))
    across = (
        lanes.select("sig", "node", "size", "pos")
        .join(heads, "sig")
        .select("node", "size", "pos", F.col("head.node").alias("pivot"), F.col("head.size").alias("pivot_size"), F.col("head.pos").alias("pivot_pos"))
        .where("node <> pivot")
        .where(_can_link(similar, "size", "pos", "pivot_size", "pivot_pos"))
    )
    pairs = stored(stars.select(*ordered).unionByName(across.select(*ordered)).distinct(), "pairs")
    links = _verified(pairs, nodes, keyed, width, similar)
    labels = stored(components(links), "labels")

    # What shares a bucket and is no component yet
    known = F.coalesce("label", "node").alias("label")
    labelled = members.select("sig", "node", "size", "pos").join(labels, "node", "left").select("sig", "node", "size", "pos", known)
    labelled = stored(labelled, "labelled")
    open_ = labelled.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("sig")
    left = labelled.join(open_, "sig").select("sig", *[F.col(c).alias(f"x_{c}") for c in ("node", "size", "pos", "label")])
    right = labelled.select("sig", *[F.col(c).alias(f"y_{c}") for c in ("node", "size", "pos", "label")])
    rest = (
        left.join(right, "sig")
        .where("x_node < y_node and x_label <> y_label")
        .where(_can_link(similar, "x_size", "x_pos", "y_size", "y_pos"))
        .select(F.col("x_node").alias("a"), F.col("y_node").alias("b"))
        .distinct()
        .join(pairs, ["a", "b"], "left_anti")
    )
    rest = stored(rest, "rest")
    more = _verified(rest, nodes, keyed, width, similar)
    final = components(links.unionByName(more))
    by_node = nodes.join(final, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "rep", "n_rep")
    real = F.when(F.col("rep.doc_id") != lowest, F.col("rep.doc_id"))
    least = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    known = stored(by_node.join(least, "node").withColumn("own", F.coalesce("least", real)), "known")
    totals = known.groupBy("label").agg(F.min("own").alias("component_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    # a component may hold a third of all nodes, so its nodes are dealt over lanes
    named = salted_join(known, stored(totals, "totals"), "label", "node", "left")
    named = named.select("node", "label", F.coalesce("component_id", "own").alias("component_id"), F.col("n_rep").alias("n_copies"))
    named = stored(named, "named")
    drop(pairs, members, labelled, labels, rest, links, more, known)
    return _with_classes(rows, named)


def _with_classes(rows: DataFrame, named: DataFrame) -> DataFrame:
    """rows with what is known of their node. One node may hold a third of them, so rows are dealt over lanes."""
    columns = ["doc_id", "row", "n_shingles", "label", "component_id", "n_copies"]
    some = salted_join(rows.where("node is not null"), named, "node", "row")
    alone = {"label": F.lit(None).cast("long"), "component_id": F.col("doc_id"), "n_copies": F.lit(1).cast("long")}
    return some.select(columns).unionByName(rows.where("node is null").withColumns(alone).select(columns))
