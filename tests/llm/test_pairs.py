"""Exact groups, near-duplicate classes, shared passages and benchmark overlaps against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardwarden.llm import decontaminate, exact_dedup, ngram_join, passages
from cardwarden.llm.common import components, numbered
from cardwarden.llm.words import SEGMENT, word_hashes
from tests.llm.conftest import SCHEMA, edges


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def test_word_hashes_do_not_depend_on_how_texts_are_cut():
    texts = ["Ein  Wort\tund é\x0bnoch eins", None, "", "x" * 50, "a b " * (SEGMENT // 3), "y" * (SEGMENT + 10)]
    hashes, bounds = word_hashes(texts)
    known = {}
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert b - a == len(words_of(text))
        for word, value in zip(words_of(text), hashes[a:b].tolist(), strict=True):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    found = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {found[i] for i in range(1, 41)} == {1} and {found[i] for i in range(100, 160)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_classes(rows):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label]
    least = {}
    for (doc_id, _), x in zip(rows, label, strict=True):
        if doc_id is not None:
            least[x] = min(least.get(x, doc_id), doc_id)
    return sorted(((d, len(s), least.get(x)) for (d, _), s, x in zip(rows, sets, label, strict=True)), key=repr)


@pytest.mark.parametrize("frequent", [None, 1])
def test_near_duplicate_classes_equal_brute_force(spark, documents, prose, monkeypatch, frequent):
    """With every shingle counted as frequent, only pairs of shingles are indexed for short texts."""
    if frequent:
        monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", 0)
        monkeypatch.setattr(ngram_join, "FREQUENT_SHARE", 0.0)
        monkeypatch.setattr(ngram_join, "LANE_ROWS", 3)
    rows = edges(prose(30, 0)) + [(7, "one two"), (8, "ONE  two"), (9, "two one")]
    for k, size in enumerate((25, 60, 120, 236, 245, 290, 310, 700)):
        base = prose(size, k + 1).split()
        for e in range(7):
            text = list(base)
            for j in range(e * size // 120 + (e > 0)):
                text[(j * 37 + e * 11) % size] = f"new{k}x{e}x{j}"
            rows.append((100 * (k + 1) + e, " ".join(text[: size - 2 * e])))
    got = ngram_join.ngram_classes(documents(rows))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == near_classes(rows)


def test_buckets_over_batches():
    import pyarrow as pa

    names = ["sig", "lane", "node", "size", "pos", "spread"]
    rows = [(1, 0, 5, 9, 0, False), (1, 0, 6, 9, 0, False), (1, 0, 7, 9, 1, False), (2, 0, 5, 9, 0, False), (3, 0, 1, 9, 0, True), (3, 1, 2, 9, 0, True), (3, 1, 3, 9, 0, True)]
    for step in (1, 2, 3, 7):
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[i : i + step]]) for i in range(0, len(rows), step)]
        out = sorted((r["sig"], r["node"], r["pivot"]) for b in ngram_join._buckets(iter(batches)) for r in b.to_pylist())
        assert out == [(1, 5, 5), (1, 6, 5), (1, 7, 5), (3, 1, 1), (3, 2, 2), (3, 3, 2)]


def test_exact_groups(documents, prose, monkeypatch):
    monkeypatch.setattr(exact_dedup, "CHUNK", 1000)
    long = prose(2000, 5)
    rows = edges(prose(30, 0)) + [(20, long), (21, long.upper()), (22, long + "."), (23, "É"), (24, "é")]
    got = exact_dedup.exact_groups(documents(rows)).collect()
    want = {}
    for doc_id, text in rows:
        want.setdefault(lower(text), []).append(doc_id)
    assert len(got) == len(rows)
    for text, ids in want.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        mine = [r for r in got if r.text_sha256 == sha]
        keep = max((i for i in ids if i is not None), default=None)
        assert sorted(map(repr, (r.doc_id for r in mine))) == sorted(map(repr, ids))
        assert {r.keep_id for r in mine} == {keep} and {r.group_size for r in mine} == {len(ids)}
        assert [r.doc_id for r in mine if r.kept] == [keep]


def test_fingerprints_compose_and_a_collision_is_told_apart(documents, monkeypatch):
    text = bytes(range(256)) * 9 + b"tail"
    whole = exact_dedup._fingerprints([text])
    for cut in (1, 255, 256, 1000):
        parts = exact_dedup._fingerprints([text[:cut], text[cut:]])
        for k, (base, prime) in enumerate(zip(exact_dedup.BASES, exact_dedup.PRIMES, strict=True)):
            assert (parts[k][0] * pow(base, len(text) - cut, prime) + parts[k][1]) % prime == whole[k][0]
    real = exact_dedup.fingerprints
    monkeypatch.setattr(exact_dedup, "fingerprints", lambda d: real(d).withColumns({"f1": F.lit(0).cast("long"), "f2": F.lit(0).cast("long")}))
    got = exact_dedup.exact_groups(documents([(1, "aa"), (2, "bb"), (3, "AA"), (4, "bb"), (5, "cc")])).collect()
    assert {r.doc_id: (r.keep_id, r.kept) for r in got} == {1: (3, False), 2: (4, False), 3: (3, True), 4: (4, True), 5: (5, True)}


def test_benchmark_overlaps_bear_substitutions(spark, documents, prose):
    items = [(i, prose(20 + i, 50 + i)) for i in range(5)] + [(9, "short item here"), (10, None), (None, prose(20, 1)), (11, "")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, row string")
    item = items[2][1].split()
    near = list(item)
    near[4], near[11] = "other", "words"
    far = [w if k % 3 else "other" for k, w in enumerate(item)]
    rows = [
        (1, prose(40, 90) + " " + " ".join(near) + " " + prose(40, 91)),
        (2, prose(60, 92) + " " + " ".join(far)),
        (3, "Well: " + ", ".join(items[3][1].upper().split()) + "!"),
        (4, "a SHORT item, here it is"),
        (5, prose(500, 93)),
        (6, " ".join(item[:8])),
        *edges(prose(30, 0)),
    ]
    got = decontaminate.contamination(documents(rows), bench).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: list(r["items"]) for r in got if r.contaminated}
    assert found == {1: [2], 3: [3], 4: [9]}
    assert decontaminate.contamination(documents([]), bench).count() == 0
    assert decontaminate.contamination(documents(rows), bench.limit(0)).where("contaminated").count() == 0


def test_masks_find_any_two_substitutions_in_13_tokens():
    for gone in combinations(range(13), 2):
        assert any(all(s + j not in gone for j, c in enumerate(m) if c == "1") for m in decontaminate.MASKS for s in range(14 - len(m)))


def test_copies_with_many_differences_are_whole(spark, documents, prose):
    """Runs of twelve copied words with five others between: the text that goes on is no less contaminated."""
    item = prose(200, 60).split()
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")

    def copy(runs):
        out = []
        for k in range(runs):
            out += item[17 * k : 17 * k + 12] + ([f"x{k}{j}" for j in range(5)] if k + 1 < runs else [])
        return " ".join(out)

    rows = [(n, prose(30, n) + " " + copy(n) + " " + prose(30, 90 + n)) for n in (3, 4, 5, 6)]
    got = {r.doc_id: r.n_equal for r in decontaminate.contamination(documents(rows), bench).collect()}
    assert got == {3: 36, 4: 48, 5: 60, 6: 60}  # six runs are 72 of 97 words, less than three quarters


@pytest.mark.parametrize("words,changed", [(16, 4), (16, 3), (24, 6), (40, 10)])
def test_recall_of_copies_at_the_limit(spark, documents, words, changed):
    """Of items with words substituted at random, those that brute force finds."""
    r = random.Random(words + changed)
    items = [[f"w{i}x{j}" for j in range(words)] for i in range(300)]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    rows = []
    for i, item in enumerate(items):
        gone = set(r.sample(range(words), changed))
        rows.append((i, " ".join([f"a{i}", *[f"n{i}y{j}" if j in gone else w for j, w in enumerate(item)], f"b{i}"])))

    def stretch(i):  # the most equal words of any stretch with three quarters of them
        same = [a == b for a, b in zip(rows[i][1].split()[1:-1], items[i])]
        sums = [sum(same[a:b]) for a in range(words) for b in range(a + 1, words + 1) if 4 * sum(same[a:b]) >= 3 * (b - a)]
        return max(sums, default=0)

    due = {i for i in range(len(items)) if stretch(i) >= decontaminate.LEAST_TOKENS}
    found = {x.doc_id for x in decontaminate.contamination(documents(rows), bench).where("contaminated").collect()}
    assert found <= due and len(found) >= 0.95 * len(due) > 0


def test_longest_stretch_equals_brute_force():
    r = random.Random(5)
    for _ in range(300):
        same = np.array([r.random() < 0.7 for _ in range(r.randrange(1, 40))])
        start, stop = decontaminate.longest_stretch(same)
        best = max((int(same[a:b].sum()) for a in range(len(same)) for b in range(a + 1, len(same) + 1) if 4 * same[a:b].sum() >= 3 * (b - a)), default=0)
        assert same[start:stop].sum() == best
        if best:
            assert same[start] and same[stop - 1] and 4 * best >= 3 * (stop - start)


def test_shared_passages(documents, prose):
    passage = prose(80, 7).split()
    changed = list(passage)
    changed[20:21] = ["one", "more"]
    changed[50] = "other"
    rows = [(k, prose(90 + k, 100 + k) + " " + " ".join(changed if k % 2 else passage) + " " + prose(70, 200 + k)) for k in range(11, 16)]
    rows += [(50, prose(300, 300)), (51, " ".join(passage[:30]) + " " + prose(100, 301)), *edges(prose(60, 0))]
    got = passages.passages(documents(rows)).collect()
    shared = [r for r in got if r.doc_id in range(11, 16)]
    assert {r.doc_id for r in shared} | {r.other_doc_id for r in shared} == set(range(11, 16))
    assert all(90 + r.doc_id - 3 <= r.start <= 90 + r.doc_id and 78 <= r.n_words <= 86 and r.n_equal >= 76 for r in shared)
    assert all(r.n_words >= 50 for r in got)
    assert {50, 51}.isdisjoint({r.doc_id for r in got} | {r.other_doc_id for r in got})
    assert passages.passages(documents([])).count() == 0


def test_chains_prefer_order_and_pay_for_gaps():
    parts = [(0, 0, 10), (12, 13, 10), (30, 5, 6), (200, 220, 8)]
    found = passages.chains(parts)
    assert found[0] == [(0, 0, 10), (12, 13, 10)] and sorted(p for c in found for p in c) == sorted(parts)
    tree = passages.Fenwick(8)
    values = np.random.default_rng(0).random(8)
    for i, v in enumerate(values):
        tree.put(i, v, i)
    assert [tree.upto(i)[0] for i in range(8)] == np.maximum.accumulate(values).tolist()


def test_clashing_columns_and_empty_tables(spark, documents, prose):
    clash = "node string, label string, size string, seed string, keeper string, row string, sha string, norm string, words string, held_out string, score string, host string, ids string, lane int"
    base = documents([(1, prose(60, 1)), (2, prose(60, 1)), (3, prose(60, 2))])
    odd = base.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in clash.split(", ")])
    for run in (exact_dedup.exact_groups, ngram_join.ngram_classes, passages.passages):
        columns = [c for c in run(base).columns if c not in ("row", "label")]
        assert sorted(run(odd).select(columns).collect(), key=repr) == sorted(run(base).select(columns).collect(), key=repr)
        assert run(spark.createDataFrame([], SCHEMA)).count() == 0


def test_near_copies_whose_rows_share_an_id_or_have_none(spark, documents, prose):
    """Each set is fetched by its own row only, and the classes are those of brute force."""
    rows = []
    for i in range(12):
        text = prose(60, 900 + i)
        doc_id = None if i % 2 else 7
        rows += [(doc_id, text), (doc_id, text + " mure"), (100 + i, text + " tile")]
    got = ngram_join.ngram_classes(documents(rows)).select("doc_id", "n_shingles", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == near_classes(rows)


def test_passage_whose_seeds_all_lie_in_earlier_and_later_rows(documents, prose):
    """The two that share 60 words meet, though the first and the last of each seed hold 36 of them at most."""
    passage = prose(60, 70).split()
    parts = [" ".join(passage[:36]), " ".join(passage[24:])]
    around = lambda k, text: prose(60, 710 + 2 * k) + " " + text + " " + prose(60, 711 + 2 * k)
    rows = [(k, around(k, parts[k % 2])) for k in range(4)] + [(10, around(10, " ".join(passage))), (11, around(11, " ".join(passage)))]
    rows += [(k, around(k, parts[k % 2])) for k in range(20, 24)]
    got = passages.passages(documents(rows)).collect()
    assert {(r.doc_id, r.other_doc_id) for r in got} == {(11, 10)} and all(r.n_equal >= 60 for r in got)


def test_all_pairs_that_share_a_passage_are_listed(documents, prose):
    """The middle ones of many, with an exact or a changed passage, or one of a single word, meet each other as well."""
    passage = prose(80, 720).split()
    changed = lambda k: " ".join(w if i != 20 + k else "other" for i, w in enumerate(passage))
    around = lambda k, text: prose(60, 730 + 2 * k) + " " + text + " " + prose(60, 731 + 2 * k)
    rows = [(k, around(k, changed(k) if k < 6 else " ".join(passage))) for k in range(10)]
    rows += [(k, around(k, "same " * 55)) for k in range(20, 25)]
    got = passages.passages(documents(rows)).collect()
    pairs = [(b, a) for a, b in [*combinations(range(10), 2), *combinations(range(20, 25), 2)]]
    assert {(r.doc_id, r.other_doc_id) for r in got} == set(pairs) and all(r.n_equal >= 50 for r in got)


def test_pairs_are_those_with_two_seeds(spark, monkeypatch):
    """However many rows have a seed, and however it stands with others of the same rows."""
    monkeypatch.setattr(passages, "HOT_ROWS", 3)
    rng = np.random.default_rng(9)
    for n in (12, 40):
        sets = {row: {int(s) for s in np.flatnonzero(rng.random(20) < np.linspace(0.02, 0.9, 20))} for row in range(n)}
        sets |= {n + k: {0, 1, 2, 30} for k in range(3)} | {n + 3 + k: {19} for k in range(4)}
        seeds = spark.createDataFrame([(s, row) for row, own in sets.items() for s in own], "seed long, row long")
        pairs, _ = passages._with_two_seeds(seeds)
        expected = [(b, a) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= 2]
        assert sorted(map(tuple, pairs.collect())) == sorted(expected)


def test_passages_inside_a_chain_that_is_not_alike_enough():
    r = np.random.default_rng(5)
    new = lambda n: r.integers(1, 1 << 32, n).astype(np.uint64)
    p, q = new(51), new(51)
    # an insertion between two passages
    got = passages.shared_passages(np.concatenate([new(30), p, q, new(30)]), np.concatenate([new(20), p, new(28), q, new(20)]))
    assert [(f[0], f[4]) for f in got] == [(30, 51), (81, 51)] and all(f[4] >= 0.8 * max(f[1], f[3]) for f in got)
    # other words between them
    got = passages.shared_passages(np.concatenate([p, new(40), q]), np.concatenate([p, new(40), q]))
    assert [(f[0], f[1], f[4]) for f in got] == [(0, 51, 51), (91, 51, 51)]
    # an equal passage between stretches with every third word changed
    a = new(300)
    b = np.where((np.arange(300) % 3 == 0) & (abs(np.arange(300) - 150) > 30), new(300), a)
    got = passages.shared_passages(a, b)
    assert len(got) == 1 and got[0][0] <= 120 and got[0][0] + got[0][1] >= 181 and got[0][4] >= 0.8 * got[0][1]


def test_stretches_equal_brute_force():
    r = np.random.default_rng(6)
    for _ in range(30):
        kinds = np.array([(1, 1, 1), (1, 1, 0), (1, 0, 0), (0, 1, 0)])
        columns = kinds[r.choice(4, 160, p=[0.76, 0.12, 0.06, 0.06])]
        fits = []
        for i, j in combinations(range(161), 2):
            x, y, e = columns[i:j].sum(0)
            if min(x, y) >= passages.LEAST_WORDS and 5 * e >= 4 * max(x, y) and columns[i, 2] and columns[j - 1, 2]:
                fits.append(j - i)
        found = passages.stretches(columns)
        assert max((j - i for i, j in found), default=0) == max(fits, default=0)
        for i, j in found:
            x, y, e = columns[i:j].sum(0)
            assert min(x, y) >= 50 and 5 * e >= 4 * max(x, y)


def test_a_chain_takes_the_next_predecessor_where_the_best_is_too_far():
    parts = [(0, 0, 200), (250, 250, 20), (275, 275, 10)]
    assert passages.chains(parts) == [parts[:1], parts[1:]]


def test_rows_keep_their_numbers_when_the_input_is_split_in_another_way(spark, documents, prose, tmp_path):
    rows = [(k, prose(60, k)) for k in range(40)]
    documents(rows).coalesce(1).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/documents")
    conf, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    for number, name in ((lambda: numbered(docs, None), "row"), (lambda: corpus_pipeline._numbered(docs), corpus_pipeline.ROW)):
        made = number()
        try:
            first = {r[name]: r.doc_id for r in made.select(name, "doc_id").collect()}
            spark.conf.set(conf, "1500")
            again = made.select(name, "doc_id", F.lit(1)).collect()
        finally:
            spark.conf.set(conf, before)
        assert first == {r[name]: r.doc_id for r in again} and len(first) == 40


def test_copies_of_a_passage_are_listed_on_either_side():
    rng = np.random.default_rng(6)
    new = lambda n: rng.integers(1, 1 << 32, n).astype(np.uint64)
    p = new(60)
    once, twice = np.concatenate([new(50), p, new(50)]), np.concatenate([new(30), p, new(90), p, new(20)])
    assert passages.shared_passages(once, twice) == [(50, 60, 30, 60, 60), (50, 60, 180, 60, 60)]
    assert passages.shared_passages(twice, once) == [(30, 60, 50, 60, 60), (180, 60, 50, 60, 60)]


def test_two_repetitive_texts_are_aligned_a_few_times(monkeypatch):
    """Lines repeated out of step, with a fifth of their words changed: no chain for each repeat."""
    rng = np.random.default_rng(8)
    line = rng.integers(1, 1 << 32, 93).astype(np.uint64)
    other = line.copy()
    other[rng.permutation(93)[:21]] += np.uint64(1)
    a, b = np.concatenate([line[10:], np.tile(line, 80)]), np.concatenate([other[41:], np.tile(other, 77)])
    aligned = []
    whole = passages.align
    monkeypatch.setattr(passages, "align", lambda chain, *sides: aligned.append(chain) or whole(chain, *sides))
    found = passages.shared_passages(a, b)
    assert len(aligned) < 20
    covered = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for i, n, j, m, e in found:
        covered[0][i : i + n] = covered[1][j : j + m] = True
        assert min(n, m) >= passages.LEAST_WORDS and 5 * e >= 4 * max(n, m)
    assert covered[0].mean() > 0.8 and covered[1].mean() > 0.8


def test_contamination_ignores_extra_columns_of_documents(spark, documents, prose):
    item = prose(30, 1)
    rows = [(1, prose(20, 2) + " " + item), (2, prose(60, 3)), (None, item), (4, None), (5, "")]
    benchmark = spark.createDataFrame([(7, item), (8, None)], "item_id long, text string")
    extra = documents(rows)
    for c in ("row", "item_id", "items", "contaminated", "n_equal", "seed", "mask", "words", "tokens", "at"):
        extra = extra.withColumn(c, F.lit("mine"))
    plain, other = (decontaminate.contamination(d, benchmark) for d in (documents(rows), extra))
    columns = ["doc_id", "contaminated", "items", "n_equal"]
    found = sorted(plain.select(columns).collect(), key=repr)
    assert sorted(other.select(columns).collect(), key=repr) == found
    assert {r.doc_id for r in found if r.contaminated} == {1, None}
