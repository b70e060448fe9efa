"""Manifest, whitening and mixing against plain programs over all rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import manifest, mixing, whitening
from tests.llm.conftest import SCHEMA


def _rows(n, seed):
    """Documents with null, empty, repeated and odd values; one source holds a third of them."""
    r = random.Random(seed)
    sources = [None, "", "a", "b", "é", "z" * 40]
    out = [(None, "no id", "en", "a", 3), (None, None, None, None, None), (7, "x\ny", "en", "a", 3), (7, "x\ny", "en", "a", 3), (7, "", None, "a", 0)]
    for i in range(n - len(out)):
        text = r.choice([None, "", " \n\t ", "one", "two words", "a\nb\nc", "wörd " * r.randrange(40), "-"])
        out.append((r.randrange(-5, 3 * n), text, r.choice(["en", None, ""]), "hot" if i % 3 == 0 else r.choice(sources), r.choice([None, i])))
    return out


def _frame(spark, rows, extra=True):
    frame = spark.createDataFrame(rows, SCHEMA.replace("lang", "_lang").replace("source", "_source").replace("n_chars", "_n_chars"))
    frame = frame.toDF("doc_id", "text", "lang", "source", "n_chars")
    if extra:  # names the operators use themselves
        for c in ("tree", "leaf", "claim", "index", "n", "place", "size", "target", "key", "tie", "row", "x", "i", "_at"):
            frame = frame.withColumn(c, F.lit("mine"))
    return frame.repartition(5)


# Manifest -----------------------------------------------------------------------


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def _way(levels, i):
    steps = []
    for nodes in levels[:-1]:
        first = i - i % 3
        steps.append((nodes[first:i], nodes[i + 1 : first + 3]))
        i //= 3
    return steps


def _plain_proofs(rows):
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        def leaf(t):
            return _h(_field(doc_id), _field(source), _field(lang), _field(n_chars), _field(t))
        changed = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            changed = text.replace("\n", "")
        trees.setdefault(source, []).append((doc_id, leaf(text), leaf(changed)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: _levels([x[1] for x in sorted(trees[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for s in order}
    top = _levels([levels[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for i, (doc_id, own, claim) in enumerate(sorted(trees[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            steps = _way(levels[s], i) + _way(top, place)
            digest = claim
            for left, right in steps:
                digest = _h(*left, digest, *right)
            out.append((doc_id, own, levels[s][-1][0], top[-1][0], _h(*[x for a, b in steps for x in a + b]), digest, digest == top[-1][0]))
    return out


def _tampered(docs):
    cut = F.replace("text", F.lit("\n"), F.lit(""))
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, cut).otherwise(F.col("text"))


@pytest.mark.parametrize("n,levels", [(6, 6), (200, 1), (400, 2)])
def test_proofs_equal_a_plain_program(spark, n, levels):
    rows = _rows(n, n)
    docs = _frame(spark, rows)
    got = manifest.Manifest(manifest.document_leaves(docs, _tampered(docs)), levels).proofs().collect()
    want = _plain_proofs(rows)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r.verified for r in got} == ({True, False} if n > 6 else {r[-1] for r in want})


def test_the_log_is_in_order_of_completion(spark):
    rows = [(i, f"text {i}", "en", s, i) for s, n in (("a", 100), ("b", 27), ("c", 1), (None, 31)) for i in range(n)]
    built = manifest.Manifest(manifest.document_leaves(_frame(spark, rows)), 2)
    log = {}
    for r in built.log().collect():
        log.setdefault(r.tree, {})[r.position] = (r.level, r.index, r.digest)
    leaves = {t: [bytes.fromhex(x[2]) for _, x in sorted(nodes.items()) if x[0] == 0] for t, nodes in log.items()}
    assert {t: len(x) for t, x in leaves.items()} == {"+a": 100, "+b": 27, "+c": 1, "": 31}
    for tree, nodes in log.items():
        whole = manifest.append_all(leaves[tree], manifest.height(len(leaves[tree])))
        assert [nodes[p][2] for p in range(len(nodes))] == [d.hex() for d in whole]
    assert built.proofs().where("not verified").isEmpty()


@pytest.mark.parametrize("n", [*range(1, 60), 243, 244])
def test_positions_follow_from_level_and_index(n):
    leaves = [bytes([k % 256, k // 256]) * 16 for k in range(n)]
    top = manifest.height(n)
    log = manifest.append_all(leaves, top)
    level = leaves
    for k in range(top + 1):
        assert [log[manifest.position(k, i, n, top)] for i in range(len(level))] == level
        level = [manifest.node(level[i : i + 3]) for i in range(0, len(level), 3)]
    paths = manifest.sibling_paths(b"".join(log), n, top, b"")
    assert {manifest.fold(leaf, path, i, n) for i, (leaf, path) in enumerate(zip(leaves, paths))} == {(log[-1], b"")}


def test_an_empty_table_has_no_root(spark):
    built = manifest.Manifest(manifest.document_leaves(_frame(spark, [])))
    assert built.root() is None and built.proofs().count() == 0 and built.log().count() == 0


# Mixing -------------------------------------------------------------------------


def _plain_mix(rows):
    size = {k: len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", r[1] or "") if w]) for k, r in enumerate(rows)}
    order = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    total = {s: sum(size[k] for k, r in enumerate(rows) if r[3] == s) for s in order}
    full, target = set(), {}
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in full)
        shared = sum(weight[s] for s in order if s not in full)
        target = {s: Fraction(3 * total[s]) if s in full else Fraction(weight[s] * rest, shared) for s in order}
        above = {s for s in order if target[s] > 3 * total[s]}
        if not above:
            break
        full |= above
    taken = {}
    for s in order:
        budget = math.floor(float(target[s]) + 0.5)
        whole, left = divmod(budget, total[s]) if total[s] else (0, 0)
        mine = [k for k, r in enumerate(rows) if r[3] == s]
        for k in sorted(mine, key=lambda k: hashlib.md5(f"13:{'-' if rows[k][0] is None else rows[k][0]}:{size[k]}".encode()).hexdigest()[:15]):
            more = min(size[k], left)
            left -= more
            taken[k] = whole * size[k] + more
    return [(r[0], r[3], size[k], total[r[3]], float(target[r[3]]), taken[k]) for k, r in enumerate(rows)]


@pytest.mark.parametrize("n", [6, 300])
def test_mix_equals_a_plain_program(spark, n):
    rows = _rows(n, n)
    columns = ("doc_id", "source", "size", "source_size", "target", "taken")
    got = mixing.mix(_frame(spark, rows)).select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _plain_mix(rows)))
    again = mixing.mix(_frame(spark, rows[::-1], False).coalesce(1)).select(*columns).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert all(r.taken <= 3 * r.size for r in got)
    targets = {r.source: r.target for r in got}
    for source, target in targets.items():
        assert abs(sum(r.taken for r in got if r.source == source) - target) <= 0.5
    assert sum(targets.values()) == pytest.approx(sum(r.size for r in got))


def test_capped_sources_pass_their_excess_on(spark):
    rows = [(1, "a " * 10, "", "a", 0), (2, "b " * 10, "", "b", 0), (3, "c " * 100, "", "c", 0), (4, "d " * 180, "", "d", 0)]
    got = {r.source: r for r in mixing.mix(_frame(spark, rows)).collect()}
    # 300 words by 5, 2, 1, 5: a and b stop at 30 each, the other 240 words go 1 to 5
    assert {s: r.target for s, r in got.items()} == {"a": 30.0, "b": 30.0, "c": 40.0, "d": 200.0}
    assert {s: r.taken for s, r in got.items()} == {"a": 30, "b": 30, "c": 40, "d": 200}


def test_mix_without_words_or_rows(spark):
    assert mixing.mix(_frame(spark, [])).count() == 0
    got = mixing.mix(_frame(spark, [(1, None, None, None, None), (2, " ", None, "a", None)])).collect()
    assert {(r.size, r.source_size, r.target, r.taken) for r in got} == {(0, 0, 0.0, 0)}


def test_repeated_rows_are_told_apart(spark):
    """A hundred equal rows: the cut lies inside them, and their words still add up."""
    rows = [(1, "w " * 3, "", "a", 0)] * 100 + [(2, "x " * 500, "", "b", 0)]
    got = mixing.mix(_frame(spark, rows)).collect()
    assert sum(r.taken for r in got if r.source == "a") == round(5 * 800 / 7)
    assert {r.taken for r in got if r.source == "a"} <= {3, 4, 5, 6}


# Whitening ----------------------------------------------------------------------


def _plain_whitening(vectors, top=4):
    """Of integer vectors: n, deviations and whitened rows, from exact fractions."""
    distinct = sorted(set(vectors))
    n, width = len(distinct), len(vectors[0])
    sums = [sum(x[d] for x in distinct) for d in range(width)]
    centre = [[n * x[d] - sums[d] for d in range(width)] for x in distinct]
    cov = np.array([[float(Fraction(sum(c[i] * c[j] for c in centre), n**3)) for j in range(width)] for i in range(width)])
    values, q = np.linalg.eigh(cov)
    values, q = values[::-1][:top], q[:, ::-1][:, :top]
    off = [[Fraction(n * x[d] - sums[d], n) for d in range(width)] for x in vectors]
    z = np.array([[float(v) for v in o] for o in off]) @ (q / np.sqrt(values))
    return n, [sum((n * x[d] - sums[d]) ** 2 for d in range(width)) for x in vectors], z, values / np.trace(cov)


def _embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("x", F.lit("mine")).withColumn("i", F.lit(1)).repartition(4)


@pytest.mark.parametrize("offset,spread", [(0.0, 0.3), (1e7, 0.05), (-3e9, 40.0)])
def test_whitening_equals_exact_sums(spark, offset, spread):
    r = np.random.default_rng(3)
    vectors = (r.normal(size=(150, 6)) @ r.normal(size=(6, 6)) * spread + offset).tolist()
    vectors += vectors[:10] + [vectors[0]] * 40
    got = whitening.whitened(_embeddings(spark, [(k, v, 0) for k, v in enumerate(vectors)])).collect()
    integers = [tuple(math.floor(256 * c) for c in v) for v in vectors]
    n, deviation, z, share = _plain_whitening(integers)
    assert len(got) == 4 * len(vectors) and {row.n for row in got} == {n}
    sign = {}
    for row in got:
        c, k = row.component - 1, row.vec_id
        assert row.deviation == (deviation[k] if deviation[k] < 2**63 else None)
        sign.setdefault(c, np.sign(row.whitened * z[k, c]))
        assert row.whitened * sign[c] == pytest.approx(z[k, c], abs=1e-6)
        assert row.explained == pytest.approx(share[c], rel=1e-9)
        assert 0 <= row.identity_error < 1e-9


def test_vectors_that_are_left_out_or_degenerate(spark):
    inf, nan = float("inf"), float("nan")
    odd = [(1, None, 0), (2, [1.0, None], 0), (3, [nan, 1.0], 0), (4, [inf, 1.0], 0), (5, [1.0, -inf], 0)]
    assert whitening.whitened(_embeddings(spark, odd)).count() == 0
    assert whitening.whitened(_embeddings(spark, [])).count() == 0
    one = whitening.whitened(_embeddings(spark, [*odd, (6, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in sorted(one, key=str)] == sorted(
        [(i, c, 1, 0, None, None) for i in (6, None) for c in (1, 2)], key=str)
    # shorter vectors end in zeros, -0.0 is 0, and a line has one component
    line = whitening.whitened(_embeddings(spark, [(1, [-0.0, 0.0], 0), (2, [1.0], 0), (3, [], 0), (4, [2.0, 0.0], 0)])).collect()
    assert {(r.component, r.n, r.whitened is None) for r in line} == {(1, 3, False), (2, 3, True)}
    first = {r.vec_id: r.whitened for r in line if r.component == 1}
    assert first[1] == first[3] == pytest.approx(-math.sqrt(1.5)) and first[2] == 0 and first[4] == pytest.approx(math.sqrt(1.5))


@pytest.mark.parametrize("bits", [1, 12, 40, 62])
def test_popcounts_give_exact_cross_products(bits):
    r = random.Random(bits)
    rows = [[r.randrange(-(1 << bits), 1 << bits) for _ in range(3)] + [5] for _ in range(131)]
    want = [[sum(a * b for a, b in zip(x, y)) for y in zip(*[[*row, 1] for row in rows])] for x in zip(*[[*row, 1] for row in rows])]
    assert whitening.cross_products(np.array(rows, np.int64)).tolist() == want


def test_small_eigenvalues_beside_large_ones():
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(3, 3)))[0]
    cov = np.array([[4e18, 0, 0, 0], [0, 0, 0, 0], [0, 0, 0, 0], [0, 0, 0, 0]], object)
    cov[1:, 1:] = [[Fraction(float(v)) for v in row] for row in q @ np.diag([3.0, 2.0, 1e-6]) @ q.T]
    values, _ = whitening.eigen([[Fraction(v) for v in row] for row in cov])
    assert values == pytest.approx([4e18, 3, 2, 1e-6], rel=1e-6)
