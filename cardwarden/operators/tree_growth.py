"""Growth of regression trees from histograms, all trees of a round side by side.

Rows are turned into bins once a round. Each task adds up weight, sum and sum of squares of its rows by tree, node, column and bin.
The sums of a tree's column meet in a group, which gives the best split of each node, and the best of all columns is taken.
So a round reads its rows once, then their bins once a level, whatever number of trees it has. Splits are chosen as Spark's
DecisionTreeRegressor chooses them: the same places to split, the same gain, the first of equal ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

#: Rows whose values say where columns may be split, at the least (all of them if there are fewer), as in Spark's trees.
LEAST_SAMPLED = 10_000

#: Rows of a block of bins; a task adds a block's sums to its own, which is dear for small blocks.
BLOCK_ROWS = 50_000

#: Differences of this share of the mean square of a node's targets are rounding.
_ROUNDING = 1e-12


@dataclass
class Tree:
    """Nodes in arrays. Sums of a node are its weight and the weighted sums of the target and of its square."""

    feature: np.ndarray  # -1 of a leaf
    child: np.ndarray  # the left one; the right one follows it
    threshold: np.ndarray  # the largest number that goes left
    goes_left: np.ndarray  # by node and bin; a category is its own bin
    nominal: np.ndarray
    gain: np.ndarray
    sums: np.ndarray

    @staticmethod
    def root(sums: np.ndarray, bins: int) -> Tree:
        return Tree(np.array([-1]), np.array([0]), np.zeros(1), np.zeros((1, bins), bool), np.zeros(1, bool), np.zeros(1), sums[None, :])

    @property
    def prediction(self) -> np.ndarray:
        return self.sums[:, 1] / self.sums[:, 0]

    @property
    def impurity(self) -> np.ndarray:
        return _variance(self.sums)

    @property
    def rounding(self) -> np.ndarray:
        """What is no impurity and no gain."""
        return _ROUNDING * self.sums[:, 2] / self.sums[:, 0]

    def split(self, node: int, feature: int, nominal: bool, threshold: float, goes_left: np.ndarray, gain: float, left: np.ndarray) -> None:
        self.feature[node], self.child[node], self.nominal[node] = feature, len(self.feature), nominal
        self.threshold[node], self.goes_left[node], self.gain[node] = threshold, goes_left, gain
        self.feature = np.append(self.feature, [-1, -1])
        self.child = np.append(self.child, [0, 0])
        self.threshold = np.append(self.threshold, [0.0, 0.0])
        self.goes_left = np.vstack([self.goes_left, np.zeros((2, self.goes_left.shape[1]), bool)])
        self.nominal = np.append(self.nominal, [False, False])
        self.gain = np.append(self.gain, [0.0, 0.0])
        self.sums = np.vstack([self.sums, left, self.sums[node] - left])

    def _walk(self, rows: int, left: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
        """The leaf of each row; rows go down the tree node by node."""
        leaf, at = np.zeros(rows, np.int64), {0: np.arange(rows)}
        for node in range(len(self.feature)):  # parents come before their children
            here = at.pop(node)
            if self.feature[node] < 0:
                leaf[here] = node
                continue
            goes = left(node, here)
            child = int(self.child[node])
            at[child], at[child + 1] = here[goes], here[~goes]
        return leaf

    def leaf_of_values(self, columns: np.ndarray) -> np.ndarray:
        def left(node: int, rows: np.ndarray) -> np.ndarray:
            x = columns[self.feature[node]][rows]
            return self.goes_left[node][x.astype(np.int64)] if self.nominal[node] else x <= self.threshold[node]

        return self._walk(columns.shape[1], left)

    def leaf_of_bins(self, bins: dict[int, np.ndarray], rows: int) -> np.ndarray:
        """bins: by column, of those that the tree may split on."""
        return self._walk(rows, lambda node, here: self.goes_left[node][bins[self.feature[node]][here]])


def _variance(sums: np.ndarray) -> np.ndarray:
    weight = np.where(sums[..., 0] > 0, sums[..., 0], 1.0)
    return (sums[..., 2] - sums[..., 1] * sums[..., 1] / weight) / weight


def places_to_split(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Between all values if there are ``most`` places or fewer, else so that about equal weights lie between them."""
    some = weights > 0
    distinct, which = np.unique(values[some], return_inverse=True)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) <= most:
        return middle
    upto = np.cumsum(np.bincount(which, weights[some]))
    nearer = upto[:-1] + upto[1:]  # twice a target below this is nearer to the weight before a value than to that with it
    stride, out, at = upto[-1] / (most + 1), [], 0
    target = stride
    while (at := max(at, int(np.searchsorted(nearer, 2 * target, "right")))) < len(nearer):
        out.append(middle[at])
        at, target = at + 1, target + stride
    return np.array(out)


def best_splits(sums: np.ndarray, nominal: bool, impurity: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gain, last bin, which bins go left, sums of the left child) of each node; sums are by node and bin.

    The gain is -inf where no split leaves a weight of ``least`` on either side. Categories are ordered by their means.
    """
    order = np.broadcast_to(np.arange(sums.shape[1]), sums.shape[:2])
    if nominal:
        mean = np.where(sums[..., 0] > 0, sums[..., 1] / np.where(sums[..., 0] > 0, sums[..., 0], 1.0), np.inf)
        order = np.argsort(mean, axis=1, kind="stable")
        sums = np.take_along_axis(sums, order[..., None], 1)
    upto, filled = np.cumsum(sums, axis=1), np.cumsum(sums[..., 0] > 0, axis=1)
    left, whole = upto[:, :-1], upto[:, -1:]
    right = whole - left
    fits = (filled[:, :-1] > 0) & (filled[:, :-1] < filled[:, -1:]) & (left[..., 0] >= least) & (right[..., 0] >= least)
    both = left[..., 0] + right[..., 0]
    both = np.where(both > 0, both, 1.0)
    gain = impurity[:, None] - left[..., 0] / both * _variance(left) - right[..., 0] / both * _variance(right)
    gain = np.where(fits & (gain >= 0), gain, -np.inf)
    at = gain.argmax(1)
    node = np.arange(len(sums))
    goes_left = np.zeros(sums.shape[:2], bool)
    np.put_along_axis(goes_left, order, np.arange(sums.shape[1]) <= at[:, None], 1)
    return gain[node, at], at, goes_left, left[node, at]


# Within tasks ---------------------------------------------------------------------


#: What growth needs of rows: their values by column, target and weight of the round, and whether each tree draws them.
Row = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
Reader = Callable[[pa.RecordBatch], Row]


def batch_columns(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of arrays of equal length as a matrix, with a row for each place in them."""
    return np.ascontiguousarray(batch[name].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).T)


def _sampled(batches: Iterator[pa.RecordBatch], read: Reader) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            values, _, weight, drawn = read(batch)
            weights = np.where(drawn, weight, 0.0).tobytes()
            columns = range(len(values))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns, pa.int32()), pa.array([values[f].tobytes() for f in columns]), pa.array([weights] * len(columns))],
                ["feature", "x", "weights"],
            )


def _places(group: pa.Table, trees: int, most: int) -> pa.Table:
    values = np.concatenate([np.frombuffer(x.as_buffer()) for x in group["x"]])
    weights = np.concatenate([np.frombuffer(x.as_buffer()).reshape(trees, -1) for x in group["weights"]], axis=1)
    places = [places_to_split(values, w, min(most, int((w > 0).sum())) - 1) for w in weights]
    feature = group["feature"][0].as_py()
    return pa.table({"feature": pa.array([feature] * trees, pa.int32()), "tree": pa.array(range(trees), pa.int32()), "places": pa.array([p.tolist() for p in places], pa.list_(pa.float64()))})


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about so many, if there are as many."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _binned(batches: Iterator[pa.RecordBatch], read: Reader, places: list[dict[int, np.ndarray | None]], kind: type) -> Iterator[pa.RecordBatch]:
    """A row for each block: bins of drawn rows by tree and column, target and weight, drawn rows, and sums over all of them."""
    for batch in _gathered(batches, BLOCK_ROWS):
        if not batch.num_rows:
            continue
        values, target, weight, drawn = read(batch)
        if not (np.isfinite(values).all() and np.isfinite(target).all()):
            raise ValueError("values must not be NaN or infinite")
        rows = [np.flatnonzero(d) for d in drawn]
        bins = [np.zeros((len(columns), len(own)), kind) for columns, own in zip(places, rows, strict=True)]
        spots = [{f: i for i, f in enumerate(columns)} for columns in places]
        for f, x in enumerate(values):
            cuts = {tree: columns[f] for tree, columns in enumerate(places) if f in columns}
            if any(c is None for c in cuts.values()):
                for tree in cuts:
                    bins[tree][spots[tree][f]] = x[rows[tree]]
            elif cuts:  # a place among the cuts of all trees tells the bin of each
                every = np.unique(np.concatenate(list(cuts.values())))
                at = np.searchsorted(every, x)
                for tree, own in cuts.items():
                    bins[tree][spots[tree][f]] = np.append(np.searchsorted(own, every), len(own)).astype(kind)[at[rows[tree]]]
        sums = [float(weight.sum())]
        for own in rows:
            w, y = weight[own], target[own]
            sums += [float(s) for s in (w.sum(), (w * y).sum(), (w * y * y).sum())]
        blocks = [b"".join(b.tobytes() for b in bins), target.tobytes(), weight.tobytes(), drawn.tobytes()]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([b], pa.binary()) for b in blocks], pa.array([sums], pa.list_(pa.float64()))], ["bins", "target", "weight", "drawn", "sums"]
        )


def _added(batches: Iterator[pa.RecordBatch], trees: list[Tree], active: list[list[int]], sizes: list[dict[int, int]], columns: list[list[int]], kind: type) -> Iterator[pa.RecordBatch]:
    """For each tree and column: sums by active node and bin. columns: those that have bins, by tree."""
    total = {(t, f): np.zeros((3, len(active[t]) * n)) for t, own in enumerate(sizes) if active[t] for f, n in own.items()}
    for batch in batches:
        for i in range(batch.num_rows):
            target, weight = (np.frombuffer(batch[c][i].as_buffer()) for c in ("target", "weight"))
            bins = np.frombuffer(batch["bins"][i].as_buffer(), kind)
            drawn = np.frombuffer(batch["drawn"][i].as_buffer(), bool).reshape(len(trees), -1)
            start = 0
            for t, tree in enumerate(trees):
                rows = np.flatnonzero(drawn[t])
                end = start + len(columns[t]) * len(rows)
                own = dict(zip(columns[t], bins[start:end].reshape(len(columns[t]), -1), strict=True))
                start = end
                if not active[t]:
                    continue
                nodes = len(active[t])
                slot = np.full(len(tree.feature), nodes)  # rows of other nodes go to a place of their own, which is left out
                slot[active[t]] = np.arange(nodes)
                node, w, y = slot[tree.leaf_of_bins(own, len(rows))], weight[rows], target[rows]
                some = np.flatnonzero(node < nodes)
                few = 4 * len(some) < 3 * len(node)
                if few:
                    node, w, y = node[some], w[some], y[some]
                parts = (w, w * y, w * y * y)
                for f, n in sizes[t].items():
                    place = node * n + (own[f][some] if few else own[f])
                    for k, part in enumerate(parts):
                        total[t, f][k] += np.bincount(place, part, (nodes + 1) * n)[: nodes * n]
    if total:
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in keys], pa.int32()), pa.array([f for _, f in keys], pa.int32()), pa.array([total[k].tobytes() for k in keys], pa.binary())],
            ["tree", "feature", "sums"],
        )


def _chosen(group: pa.Table, nominal: set[int], impurity: list[np.ndarray], least: list[float]) -> pa.Table:
    tree, feature = group["tree"][0].as_py(), group["feature"][0].as_py()
    sums = sum(np.frombuffer(x.as_buffer()) for x in group["sums"])
    nodes = len(impurity[tree])
    sums = sums.reshape(3, nodes, -1).transpose(1, 2, 0)
    gain, at, goes_left, left = best_splits(sums, feature in nominal, impurity[tree], least[tree])
    some = np.flatnonzero(gain > 0)
    columns = {
        "tree": pa.array([tree] * len(some), pa.int32()),
        "feature": pa.array([feature] * len(some), pa.int32()),
        "slot": pa.array(some.tolist(), pa.int32()),
        "gain": pa.array(gain[some]),
        "last": pa.array(at[some].tolist(), pa.int32()),
        "goes_left": pa.array([goes_left[i].tobytes() for i in some], pa.binary()),
        "left_sums": pa.array([left[i].tolist() for i in some], pa.list_(pa.float64())),
    }
    return pa.table(columns)


# Over all rows ----------------------------------------------------------------------


def grow(
    rows: DataFrame, sample: DataFrame, read: Reader, columns: list[list[int]], categories: dict[int, int], max_bins: int, max_depth: int, least: Callable[[float], float]
) -> list[Tree]:
    """One tree for each list of columns, which are those it may split on.

    ``read`` gives values, target, weight and drawn rows of a batch of ``rows`` or ``sample``; values of ``sample`` say where columns may be split.
    ``categories`` has the number of categories of columns that are not numbers. ``least`` gives, for the weight of all rows,
    the share of a tree's weight that each leaf must have. What reaches the driver is bounded by trees, nodes, columns and bins.
    """
    trees = len(columns)
    kind = np.uint8 if max(max_bins, *categories.values(), 0) <= 256 else np.uint16
    found = (
        sample.mapInArrow(lambda b: _sampled(b, read), "feature int, x binary, weights binary")
        .groupBy("feature")
        .applyInArrow(lambda group: _places(group, trees, max_bins), "feature int, tree int, places array<double>")
        .collect()
    )
    numbers = {(r["tree"], r["feature"]): np.array(r["places"]) for r in found}
    places = [{f: None if f in categories else numbers[t, f] for f in c} for t, c in enumerate(columns)]
    sizes = [{f: categories[f] if cuts is None else len(cuts) + 1 for f, cuts in p.items() if cuts is None or len(cuts)} for p in places]
    blocks = rows.mapInArrow(lambda b: _binned(b, read, places, kind), "bins binary, target binary, weight binary, drawn binary, sums array<double>")
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        whole = blocks.agg(*[F.sum(F.col("sums")[i]) for i in range(1 + 3 * trees)]).first()
        if not all(whole[1 + 3 * t] for t in range(trees)):
            raise ValueError("a tree needs rows with a weight")
        grown = [Tree.root(np.array(whole[1 + 3 * t : 4 + 3 * t], float), 1 << (8 * np.dtype(kind).itemsize)) for t in range(trees)]
        lightest = [least(whole[0]) * tree.sums[0, 0] for tree in grown]
        active = [[0] if tree.impurity[0] > tree.rounding[0] else [] for tree in grown]
        for level in range(max_depth):
            if not any(active):
                break
            for t, node, pick, left in _level(blocks, grown, active, sizes, [list(p) for p in places], kind, set(categories), lightest):
                goes = np.zeros(grown[t].goes_left.shape[1], bool)
                goes[: sizes[t][pick["feature"]]] = np.frombuffer(pick["goes_left"], bool)
                cuts = places[t][pick["feature"]]
                grown[t].split(node, pick["feature"], cuts is None, 0.0 if cuts is None else cuts[pick["last"]], goes, pick["gain"], left)
            active = [[c for n in nodes if tree.feature[n] >= 0 for c in (tree.child[n], tree.child[n] + 1) if tree.impurity[c] > tree.rounding[c]] for nodes, tree in zip(active, grown, strict=True)]
    finally:
        blocks.unpersist()
    return grown


def _level(blocks, grown, active, sizes, columns, kind, nominal, lightest) -> Iterator[tuple[int, int, dict, np.ndarray]]:
    """(tree, node, split, sums of the left child) of the active nodes that gain by a split."""
    impurity = [tree.impurity[nodes] for tree, nodes in zip(grown, active, strict=True)]
    found = (
        blocks.select("bins", "target", "weight", "drawn")
        .mapInArrow(lambda b: _added(b, grown, active, sizes, columns, kind), "tree int, feature int, sums binary")
        .groupBy("tree", "feature")
        .applyInArrow(
            lambda group: _chosen(group, nominal, impurity, lightest),
            "tree int, feature int, slot int, gain double, last int, goes_left binary, left_sums array<double>",
        )
        .collect()
    )
    best: dict[tuple[int, int], dict] = {}
    for r in sorted(found, key=lambda r: r["feature"]):
        place = (r["tree"], r["slot"])
        least = grown[r["tree"]].rounding[active[r["tree"]][r["slot"]]]
        if r["gain"] > (best[place]["gain"] if place in best else 0.0) + least:
            best[place] = r.asDict()
    return ((t, active[t][slot], pick, np.array(pick["left_sums"])) for (t, slot), pick in sorted(best.items()))
