"""Toxicity classifier with counterfactual regularisation.

A logistic model over words and beginnings of words. In the labelled texts it is trained on, every term for
a group of people is swapped for another of its kind; the squared change of the score's logit is added to
the loss. A group that is often insulted thereby does not become a sign of toxicity by itself, and neutral
mentions keep a low score.

Training uses a bounded sample of the labelled rows, TRAIN_ROWS, taken by a hash of their ids. Spark counts
the features of the sample per label, chooses those that tell the labels apart, and turns the rows into
vectors of at most FEATURES entries; the fit itself is small. Scoring is one pass over all texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cardwarden.llm.common import small_side, stored

#: Labelled rows that training reads at most.
TRAIN_ROWS = 20_000
#: Features of the model at most.
FEATURES = 4_096
#: Rows of the sample a feature must be in.
LEAST_ROWS = 4
#: Lengths of the beginnings of words that are features beside the words.
BEGINNINGS = (4, 5, 6)
#: Weight of the counterfactual penalty and of the squared weights.
COUNTERFACTUAL, SQUARES = 1.0, 0.3

#: Terms that a table of groups may have.
GROUP_TERMS = 10_000

#: Terms for groups of people, where no table of them is given. A term is swapped with the next of its row.
IDENTITY = [
    ["women", "men"],
    ["woman", "man"],
    ["girls", "boys"],
    ["girl", "boy"],
    ["female", "male"],
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "arab"],
    ["gay", "straight", "lesbian", "bisexual", "queer", "transgender"],
    ["immigrants", "refugees", "foreigners", "natives"],
    ["disabled", "deaf", "blind", "autistic"],
    ["old", "young", "elderly"],
    ["mujeres", "hombres"],
    ["musulmanes", "cristianos"],
    ["femmes", "hommes"],
    ["musulmans", "chrétiens"],
    ["frauen", "männer"],
    ["muslime", "christen"],
]

_SWAP = {term: row[(i + 1) % len(row)] for row in IDENTITY for i, term in enumerate(row)}
_WORD = re.compile(r"[^\W\d_]+")


def swaps(groups: DataFrame) -> dict[str, str]:
    """What each term of a table (group, term) is swapped with: the next of its group, by code point, and the last with the first.

    Terms are single words and lower-cased. Null terms and groups are left out, repeated rows count once, a term of several
    groups belongs to the least of them, and a term alone in its group isn't swapped. More than GROUP_TERMS are an error.
    """
    known = groups.select(F.col("group").cast("string").alias("group"), F.lower(F.col("term").cast("string")).alias("term")).dropna()
    rows = known.groupBy("term").agg(F.min("group").alias("group")).limit(GROUP_TERMS + 1).collect()
    if len(rows) > GROUP_TERMS:
        raise ValueError(f"more than {GROUP_TERMS} terms for groups")
    by_group: dict[str, list[str]] = {}
    for row in sorted(rows):
        by_group.setdefault(row["group"], []).append(row["term"])
    return {t: terms[(i + 1) % len(terms)] for terms in by_group.values() if len(terms) > 1 for i, t in enumerate(terms)}


def features_of(text: str | None, swap: dict[str, str] | None = None) -> set[str]:
    """Words of the whole text, lower-cased and swapped, and their beginnings (marked by a hyphen)."""
    words = set(_WORD.findall(text.lower())) if text else set()
    if swap:
        words = {swap.get(w, w) for w in words}
    out = set(words)
    for n in BEGINNINGS:
        out.update([w[:n] + "-" for w in words if len(w) > n])
    return out


@dataclass
class Model:
    """Weights by feature; the score of a text is the logistic of bias plus those of its features.

    swapped: the training rows with a term for a group. Without any, the counterfactual penalty has had no part in the weights.
    """

    weights: dict[str, float]
    bias: float
    swapped: int = 0

    def score(self, text: str | None) -> float:
        found = self.weights.keys() & features_of(text)
        logit = self.bias + sum(self.weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(logit, -35, 35))))


def _emit_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (feature, n, n_toxic), summed within a batch."""
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            for f in features_of(text):
                c = counts.setdefault(f, [0, 0])
                c[0] += 1
                c[1] += toxic
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts)), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())],
            ["feature", "n", "n_toxic"],
        )


def _emit_vectors(batches: Iterator[pa.RecordBatch], index: dict[str, int], swap: dict[str, str]) -> Iterator[pa.RecordBatch]:
    """Feature numbers of each text, and of the text with its group terms swapped."""
    for batch in batches:
        texts = batch["text"].to_pylist()
        plain = [sorted(index[f] for f in features_of(t) & index.keys()) for t in texts]
        swapped = [sorted(index[f] for f in features_of(t, swap) & index.keys()) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch["toxic"].cast(pa.int32()), pa.array(plain, pa.list_(pa.int32())), pa.array(swapped, pa.list_(pa.int32()))],
            ["toxic", "plain", "swapped"],
        )


def _matrix(rows: list[list[int]], n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and column numbers of the ones."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return at, np.fromiter((i for r in rows for i in r), np.int64, len(at)), n


def _times(matrix, weights: np.ndarray, rows: int) -> np.ndarray:
    at, columns, _ = matrix
    return np.bincount(at, weights[columns], rows)


def _back(matrix, values: np.ndarray) -> np.ndarray:
    at, columns, n = matrix
    return np.bincount(columns, values[at], n)


def fit(plain: list[list[int]], swapped: list[list[int]], toxic: np.ndarray, n: int, counterfactual: float, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient descent on loss, counterfactual penalty and squares."""
    rows = len(plain)
    x, y = _matrix(plain, n), toxic.astype(float)
    changed = [i for i in range(rows) if plain[i] != swapped[i]]
    a, b = _matrix([plain[i] for i in changed], n), _matrix([swapped[i] for i in changed], n)
    # each feature's own step: the curvature it can cause, given how full its rows are
    fill = 1.0 + np.array([len(r) for r in plain], float)
    curve = _back(x, fill) / 4 + SQUARES
    if changed:
        apart = np.array([len(set(plain[i]) ^ set(swapped[i])) for i in changed], float)
        curve += 2 * counterfactual * (_back(a, apart) + _back(b, apart))
    step, step_bias = 1 / curve, 4 / max(fill.sum(), 1.0)
    rate = min(max(y.mean() if rows else 0.0, 1e-3), 1 - 1e-3)
    w, bias = np.zeros(n), float(np.log(rate / (1 - rate)))
    v, v_bias = w.copy(), bias
    for k in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(_times(x, v, rows) + v_bias, -35, 35))) - y
        gradient = _back(x, error) + SQUARES * v
        if changed:
            change = _times(a, v, len(changed)) - _times(b, v, len(changed))
            gradient += 2 * counterfactual * (_back(a, change) - _back(b, change))
        new, new_bias = v - step * gradient, v_bias - step_bias * error.sum()
        momentum = k / (k + 3)
        v, v_bias = new + momentum * (new - w), new_bias + momentum * (new_bias - bias)
        w, bias = new, new_bias
    return w, bias


def train(labelled: DataFrame, counterfactual: float = COUNTERFACTUAL, rows: int = TRAIN_ROWS, groups: DataFrame | None = None) -> Model:
    """A model from rows (doc_id, text, toxic), of which at most `rows` are read, by a hash of their ids.

    Rows without a label are left out; a null text is empty. Without labelled rows every score is 0.001. groups: a table
    (group, term) in place of IDENTITY, see swaps().
    """
    swap = _SWAP if groups is None else swaps(groups)
    known = labelled.where("toxic is not null").select("doc_id", "text", (F.col("toxic") > 0).cast("int").alias("toxic"))
    sample = stored(known, "labelled")
    taken = sample.count()
    if taken > rows:  # the labels joined with whole texts may be more than the bound asks for
        sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    toxic, total = sample.agg(F.sum("toxic"), F.count("*")).first()
    toxic = toxic or 0
    counted = sample.select("text", "toxic").mapInArrow(_emit_features, "feature string, n long, n_toxic long")
    counted = counted.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("t")).where(F.col("n") >= LEAST_ROWS)
    # how far the toxic rows with a feature are from their expected number, in standard deviations
    share = F.lit(toxic / max(total, 1))
    apart = F.abs(F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1e-9)
    best = counted.orderBy(apart.desc(), "feature").limit(FEATURES).select("feature").toArrow()["feature"].to_pylist()
    index = {f: i for i, f in enumerate(sorted(set(best) | set(swap)))}
    vectors = sample.select("text", "toxic").mapInArrow(lambda b: _emit_vectors(b, index, swap), "toxic int, plain array<int>, swapped array<int>").toArrow()
    plain, swapped = vectors["plain"].to_pylist(), vectors["swapped"].to_pylist()
    weights, bias = fit(plain, swapped, vectors["toxic"].to_numpy(), len(index), counterfactual)
    changed = sum(x != y for x, y in zip(plain, swapped, strict=True))
    return Model({f: float(weights[i]) for f, i in index.items() if weights[i]}, float(bias), changed)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most `rows` documents with a label that are not held out.

    The ids are taken by their hash, then joined with the texts as a small side. A doc_id that is labelled more
    than once counts as toxic if any of its labels says so.
    """
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = labels.where("doc_id is not null and toxic is not null").where(~held_out("doc_id"))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(small_side(stored(chosen, "chosen-labels")), "doc_id")


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """Whether crc32 of the id as text leaves remainder 0; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def _score(batches: Iterator[pa.RecordBatch], model: Model, score: str, drop_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = pa.array([model.score(t) for t in batch["text"].to_pylist()], pa.float64())
        names = [c for c in batch.schema.names if not (drop_text and c == "text")]
        yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], scores], [*names, score])


def with_scores(docs: DataFrame, model: Model, score: str = "score", drop_text: bool = False) -> DataFrame:
    """docs with a column `score` between 0 and 1; one of that name is replaced.

    Only the text counts. Null and empty texts get the score of a text without known features.
    Repeated rows and null ids come out as they went in; an empty table gives an empty one.
    """
    rows = docs.drop(score).withColumn("text", F.col("text").cast("string"))
    kept = [f for f in rows.schema.fields if not (drop_text and f.name == "text")]
    return rows.mapInArrow(lambda b: _score(b, model, score, drop_text), StructType([*kept, StructField(score, DoubleType())]))


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted), one row per row of docs; predicted is 1 from a score of 0.5 on. See with_scores()."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_scores(rows, model, drop_text=True).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
