"""Tokenizers, language model, packing, HTML and toxicity."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from cardwarden.llm import bpe, html_text, ngram_lm, packing, token_counts, toxicity
from cardwarden.llm.queries import QUERIES
from tests.llm.conftest import edges
from tests.llm.test_pairs import words_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def odd_text(r, n):
    return "".join(r.choice(["a", "B", "é", " ", "  ", "\n", "'s", "12", "漢", "😀", "!!", "the ", "tion", "́", "\xa0", "aaaa"]) for _ in range(n))


def test_numpy_splits_texts_as_the_pattern_does(monkeypatch):
    assert bpe.SPLIT == public_tokenizers.PATTERN
    r, pattern = random.Random(7), regex.compile(bpe.SPLIT)
    letters = list(" '  \n\t\r\x1c\x85\u2028\u3000stmdrevlSTabé1２½,.!-_\u0301中𝔸😀\x00")
    batches = [["".join(r.choices(letters, k=r.randrange(14))) for _ in range(r.randrange(1, 12))] for _ in range(300)]
    for texts in batches:
        block = bpe.Block(texts)
        words = iter(block.words(np.arange(len(block.starts))))
        assert [[next(words) for _ in range(n)] for n in block.counts] == [pattern.findall(t) for t in texts]

    model = bpe.encoder.__wrapped__
    bpe._powers()  # kept for the PART of use
    monkeypatch.setattr(bpe.SparkFiles, "get", lambda name: name)
    # texts longer than a part, with and without places to cut; few matches kept; all hashes alike
    texts = ["".join(r.choices(letters, k=400)), "the tion 's" * 40, "a" * 300, " " * 300, "", "x " * 9]
    plain = model(RANKS, bpe.SPLIT)
    plain.splits = False
    want = [ids.tolist() for ids in plain.encode_batch(texts)]
    for name, value in (("PART", 60), ("KEPT", 5)):
        monkeypatch.setattr(bpe, name, value)
        assert [ids.tolist() for ids in model(RANKS, bpe.SPLIT).encode_batch(texts)] == want
    monkeypatch.setattr(bpe, "PART", 10_000)
    quick = model(RANKS, bpe.SPLIT)
    monkeypatch.setattr(bpe.Encoder, "_matches", None)  # no text is split by the pattern, character by character
    assert [ids.tolist() for ids in quick.encode_batch(texts)] == want
    monkeypatch.undo()
    monkeypatch.setattr(bpe.SparkFiles, "get", lambda name: name)
    monkeypatch.setattr(bpe.Block, "hashes", lambda self: np.zeros(len(self.starts), np.uint64))
    assert [ids.tolist() for ids in model(RANKS, bpe.SPLIT).encode_batch(texts)] == want


def test_bpe_equals_the_library_and_decodes(documents):
    r = random.Random(3)
    rows = edges("A text, it's here.") + [(100 + k, odd_text(r, r.randint(1, 200))) for k in range(60)] + [(200, "a" * 3000 + "!" * 500), (201, "ab" * 400)]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    got = bpe.bpe_round_trip(documents(rows), RANKS, public_tokenizers.PATTERN, keep_ids=True).collect()

    def want(doc_id, text):
        ids = library.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        return doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    assert sorted((tuple(x)[:4] for x in got), key=repr) == sorted((want(*x) for x in rows), key=repr)
    assert bpe.bpe_round_trip(documents([]), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_token_counts_equal_a_plain_dynamic_program(documents, monkeypatch, rounds):
    """Scores of so many rounds of estimation, and the counts by them."""
    monkeypatch.setattr(token_counts, "TOGETHER", 50)
    path = public_tokenizers.path("piece_bpe_32k.model")

    def pieces(word, scores, worst):
        """Pieces of the best cut, None for a byte: largest score, then fewest pieces, then the shortest last piece."""
        best = [(0, 0)]
        last = [0]
        for d in range(1, len(word) + 1):
            ways = [(best[k][0] + scores[word[k:d]], best[k][1] - 1, k) for k in range(d) if word[k:d] in scores]
            if word[d - 1] not in scores:
                n = len(word[d - 1].encode())
                ways.append((best[d - 1][0] + n * worst, best[d - 1][1] - n, d - 1))
            *value, k = max(ways)
            best.append(tuple(value))
            last.append(k)
        used, d = [], len(word)
        while d:
            used.append(word[last[d] : d])
            d = last[d]
        return -best[-1][1], used

    r = random.Random(4)
    rows = edges("Some words, and others.")[:-1] + [(100 + k, odd_text(r, 60)) for k in range(40)] + [(300, "x" * 200 + "漢" * 60)]
    scores = token_counts.zipf_scores(token_counts.read_pieces(path))
    for _ in range(rounds):
        worst, used = min(scores.values()), dict.fromkeys(scores, 0)
        for _, t in rows:
            for w in (t or "").split():
                for piece in pieces(token_counts.MARK + w, scores, worst)[1]:
                    if piece in used:
                        used[piece] += 1
        scores = token_counts.estimated_scores(used)
    assert token_counts.train_scores(documents(rows), path, rounds) == scores
    got = token_counts.token_counts(documents(rows), path, None if rounds == token_counts.ROUNDS else scores).collect()
    worst = min(scores.values())
    want = [(i, len((t or "").split()), sum(pieces(token_counts.MARK + w, scores, worst)[0] for w in (t or "").split())) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(documents([]), path).count() == 0


@pytest.mark.parametrize("top", [1, 5, 50, 1 << 60])
def test_elias_fano(top):
    r = np.random.default_rng(1)
    for n in (0, 1, 64, 3000):
        values = np.sort(r.integers(0, top, n))
        coded = ngram_lm.EliasFano(values, lambda a: a)
        assert (coded.access(np.arange(n)) == values).all()
        x = np.concatenate([r.integers(0, top + 5, 500), values, values + 1])
        low = r.integers(0, n + 1, len(x))
        end = np.where(r.random(len(x)) < 0.5, n, np.minimum(low + r.integers(0, 20, len(x)), n))
        assert (coded.successor(x, low, end) == np.clip(np.searchsorted(values, x), low, end)).all()
        assert (coded.successor(x, 0 * low, 0 * low + n) == np.searchsorted(values, x)).all()


@pytest.mark.parametrize("shard", [200, 20_000])
def test_language_model(documents, prose, monkeypatch, shard):
    """Against the formula. Small shards: words, pairs and triples of the repeated line are split over several."""
    split = []
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", shard)
    monkeypatch.setattr(ngram_lm, "_hot_context", lambda *a, real=ngram_lm._hot_context: split.append(real(*a)) or split[-1])
    rows = edges(prose(30, 0)) + [(100 + k, prose(60, k % 25)) for k in range(60)]
    rows += [(200 + k, "One line again, " * 20 + prose(5, k)) for k in range(12)] + [(300 + k, "one") for k in range(80)]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    tokens = [[*words_of(t), None] for _, t in rows]
    kept = [t for t, h in zip(tokens, held, strict=True) if not h]
    c = collections.Counter(w for t in kept for w in t)
    total, distinct = sum(c.values()), len(c)
    p = {w: (c[w] + 0.1) / (total + 0.1 * (distinct + 1)) for t in tokens for w in t}
    pairs = collections.Counter(x for t in kept for x in zip([None, *t], t, strict=False))
    triples = collections.Counter(x for t in kept for x in zip([None, *t], t, t[1:], strict=False))
    hashes = {w: int(ngram_lm.word_hashes([w])[0][0]) if w else int(ngram_lm.END) for w in p}
    cells = collections.Counter()
    for w in c:
        cells[hashes[w] % ngram_lm.CELLS] += c[w]
    size = {w: 2.0 ** int(math.log2(max(cells[hashes[w] % ngram_lm.CELLS], 1))) for w in p}
    mu = {w: ngram_lm.SMOOTHING * size[w] for w in p}
    k = {w: ngram_lm.THIRD / (size[w] + mu[w]) for w in p}

    def chance(u, v, w, share):
        above, below = pairs[v, w] + mu[v] * share, c[v] + mu[v]
        return above / below if v is None else (triples[u, v, w] + k[v] * above) / (pairs[u, v] + k[v] * below)

    # the distributions sum to one, over known words and one unknown
    for u, v in [(None, None), (None, "one"), ("line", "again,"), ("nowhere", "one"), ("one", "line")]:
        known = sum(chance(u, v, w, p[w]) for w in c)
        assert known + chance(u, v, "nowhere", 0.1 / (total + 0.1 * (distinct + 1))) == pytest.approx(1)
    got = sorted(map(tuple, ngram_lm.lm_scores(documents(rows)).collect()), key=repr)
    want = []
    for (i, _), h, t in zip(rows, held, tokens, strict=True):
        score = sum(math.log10(chance(u, v, w, p[w])) for u, v, w in zip([None, None, *t], [None, *t], t, strict=False))
        want.append((i, h, len(t), sum(c[w] > 0 for w in t), total, sum(math.log10(p[w]) for w in t), score))
    want.sort(key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=2e-4, abs=1e-3)
    (hot,) = split
    assert [len(x.keys) > 0 for x in hot] == [shard == 200] * 2
    if shard == 200:  # the triple at the beginning of a text too
        assert pairs["one", "line"] in hot[0].counts and triples["one", "line", "again,"] in hot[1].counts and pairs[None, "one"] in hot[1].counts
    assert ngram_lm.lm_scores(documents([])).count() == 0


def test_packing_loses_nothing(spark, documents, prose):
    rows = edges(prose(30, 0)) + [(100 + k, prose(k * 9, k)) for k in range(60)]
    packed = packing.packed_rows(packing.byte_ids(documents(rows)).withColumn("row", F.lit("x")), row_ids=128, group_ids=3000).collect()
    back = collections.defaultdict(list)
    for row in packed:
        ids, positions = np.frombuffer(row["ids"], "<i4"), np.frombuffer(row["positions"], "<i4")
        assert len(ids) == len(positions) == 128 and row.cu_seqlens[-1] == row.n_ids and (ids[row.n_ids :] == packing.PAD_ID).all()
        for d, s, a, b in zip(row.doc_ids, row.starts, row.cu_seqlens[:-1], row.cu_seqlens[1:], strict=True):
            assert (positions[a:b] == np.arange(b - a)).all()
            back[d].append((s, ids[a:b].tolist()))
    want = collections.defaultdict(list)
    for i, t in rows:
        want[i] += [*(t or "").encode(), packing.END_ID]
    assert {d: sorted(x for _, ids in parts for x in ids) for d, parts in back.items()} == {d: sorted(v) for d, v in want.items()}
    for d in range(100, 160):  # documents of their own: also in order
        assert [x for _, ids in sorted(back[d]) for x in ids] == want[d]
    assert len({r.pack_id for r in packed}) == len(packed)
    assert packing.packed_rows(packing.byte_ids(documents([]))).count() == 0


def test_packing_query_packs_the_ids_of_the_library(spark, documents, tmp_path):
    r = random.Random(8)
    rows = [(k, odd_text(r, 40)) for k in range(20)] + [(30, ""), (31, None)]
    documents(rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    want = {i: [*library.encode_ordinary(t or ""), library.n_vocab] for i, t in rows}
    (row,) = QUERIES["op10_packing"](spark, str(tmp_path)).collect()
    ids = [x for d in row.doc_ids for x in want[d]]
    assert sorted(row.doc_ids) == sorted(want) and row.n_ids == len(ids)
    ids += [library.n_vocab + 1] * (packing.ROW_IDS - len(ids))
    assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()


def test_best_fit_takes_the_tightest_row():
    r = random.Random(5)
    lengths = [r.randint(1, 50) for _ in range(300)]
    room: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [x for x in room if x >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(50 - n)
    rows = packing.best_fit(lengths, 50)
    assert sorted(50 - sum(lengths[i] for i in row) for row in rows) == sorted(room)


def test_matrices_are_written_in_small_groups_of_rows(spark, tmp_path):
    """A reader holds whole groups, uncompressed."""
    rows = spark.range(0, 700, 1, 1).selectExpr("id as doc_id", "cast(repeat('abcd', 8000) as binary) as ids")
    packing.write_packed(packing.packed_rows(rows), f"{tmp_path}/packed")
    files = [pq.ParquetFile(p).metadata for p in tmp_path.glob("packed/*.parquet")]
    sizes = [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert sum(sizes) == 700 and max(sizes) <= 128


def test_encoder_keeps_a_bounded_number_of_characters(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_POINTS", 1000)
    vocabulary = bpe.Vocabulary({bytes([b]): b for b in range(256)} | {b"ab": 256})
    for pattern in (bpe.SPLIT, r"\S+|\s+"):
        encoder = bpe.Encoder(vocabulary, pattern)
        for k in range(20):
            text = " ".join(c * 150 + "ab" for c in "cdefg") + str(k)
            assert b"".join(vocabulary.decode(i) for i in encoder.encode_batch([text])) == text.encode()
            assert encoder.characters <= 1000 + len(text)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body>
<div><p>Welcome to our site</p><a href="/x">Home</a></div><section>{body}</section><!-- c --><div><p>All rights &copy; us</p></div></body></html>"""


def test_template_of_a_site_goes_and_its_text_stays(spark):
    pages = [(k, f"https://h.example/{k}", PAGE.format(body=f"<h2>Title {k}</h2><p>Text&nbsp;of\n page &lt;{k}&gt;<br>end<p>second <b>bold</b>ly {k}</p>")) for k in range(20)]
    pages += [(90, None, None), (91, "nonsense", ""), (92, "http://one.example/a", PAGE.format(body="<p>alone</p>")), (None, "http://x.example", "<p>a")]
    frame = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, templates int")
    got = {r.page_id: r for r in html_text.page_texts(frame).collect()}
    assert len(got) == len(pages)
    for k in range(20):
        assert got[k].text == f"Title {k}\n\nText of page <{k}> end\n\nsecond boldly {k}" and got[k].n_chars == len(got[k].text)
    assert got[90].text == got[91].text == "" and got[92].text.split("\n\n") == ["Welcome to our site", "Home", "alone", "All rights © us"]
    assert html_text.page_texts(frame.limit(0)).count() == 0


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_template_of_one_section_of_a_large_host_goes(spark, monkeypatch, broadcast):
    """4 of 200 pages have the block: less than any share that a small host would ask for."""
    monkeypatch.setattr(html_text, "BROADCAST_ROWS", broadcast)
    pages = [(k, f"https://h.example/{k}", f"<div><p>Text {k}</p></div>" + ("<div><p>Notice</p></div>" if k < 4 else "")) for k in range(200)]
    got = html_text.page_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {k: f"Text {k}" for k in range(200)}


def test_templates_beyond_the_bound_do_not_go_through_the_driver(spark, tmp_path):
    """Neither broadcast as they look small in their files, nor repeated."""
    spark.range(100).selectExpr("'h' as host", "id as subtree").write.parquet(f"{tmp_path}/templates")
    spark.range(300).selectExpr("id as row", "'h' as host", "id % 200 as subtree").write.parquet(f"{tmp_path}/own")
    own = html_text._own_templates(spark.read.parquet(f"{tmp_path}/own"), spark.read.parquet(f"{tmp_path}/templates"))
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan
    assert {(r.row, r.subtree) for r in own.collect()} == {(k, k % 200) for k in range(300) if k % 200 < 100}


def test_marked_article_and_what_is_no_text():
    page = """<header>Site</header><nav><ul><li>Menu</ul></nav><aside>Side</aside><article><header><h1>Head</h1></header>
    <p>One <i>two</i> three<script>no()</script>.<p>Four<div class="share-box ad">Buy</div><form><p>Mail</p></form>
    <ul><li>a<li>b</ul><blockquote>quote</blockquote><div id="comments"><p>first!</p></div></article><footer>End</footer>"""
    assert html_text.main_text(page).split("\n\n") == ["Head", "One two three.", "Four", "a", "b", "quote"]
    assert html_text.main_text("<p>a <span hidden>x</span> < b & c</p><!-- never closed") == "a x < b & c"
    assert html_text.main_text("<div>" * 3000 + "deep") == "deep"


LABELLED = [
    *[(f"the {g} are {w} and more", 1) for g in ("women",) for w in ("idiots", "scum", "trash") for _ in range(20)],
    *[(f"the {g} went to the market {k}", 0) for g in ("men", "people", "dogs") for k in range(20)],
    *[("a day without anything", 0)] * 60,
]


def test_counterfactual_penalty_clears_neutral_mentions(spark):
    frame = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(LABELLED)], "doc_id long, text string, toxic int")
    plain, fair = toxicity.train(frame, counterfactual=0.0), toxicity.train(frame, counterfactual=5.0)
    neutral, other = "the women went to the market", "the men went to the market"
    assert abs(fair.score(neutral) - fair.score(other)) < 0.3 * abs(plain.score(neutral) - plain.score(other))
    assert fair.score("they are scum and trash") > 0.5 > fair.score(neutral)


def test_toxicity_bears_odd_rows(spark, documents):
    frame = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(LABELLED)] + [(None, None, None)], "doc_id long, text string, toxic int")
    model = toxicity.train(frame)
    got = toxicity.toxicity_scores(documents(edges("such scum and idiots")), model).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert {r.predicted for r in got if r.doc_id in (4, 5)} == {1} and {r.predicted for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert toxicity.with_scores(documents([]).withColumn("score", F.lit("x")), model, "_t").columns == [*documents([]).columns, "score", "_t"]
    empty = toxicity.train(frame.limit(0))
    assert empty.score("scum") < 0.5 and empty.score(None) < 0.5


@pytest.mark.parametrize(
    "page,want",
    [
        # a name on the frame of the page silences nothing
        ('<body><div id="page" class="site has-sidebar"><p>One.</p><p>Two.</p></div></body>', ["One.", "Two."]),
        ('<div class="sidebar"><p>All the text of this page is in here.</p></div><p>Short</p>', ["All the text of this page is in here.", "Short"]),
        ('<div class="overlay"><article><p>Text</p></article></div>', ["Text"]),
        # a name that only contains such a word is another name
        ('<article><p>One.</p><section id="related-work"><p>Two.</p></section></article>', ["One.", "Two."]),
        ('<article><p>One and some more.</p><div class="related-posts"><p>Two.</p></div></article>', ["One and some more."]),
        ('<p>One and some more.</p><div class="site-header"><p>Two.</p></div><div id="cookie_notice">Three.</div>', ["One and some more."]),
        # headline and lead outside of the article, inside of main
        ("<main><h1>Headline</h1><p>Lead</p><article><p>Text</p></article></main><p>Other</p>", ["Headline", "Lead", "Text"]),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p>", ["Let x=1 be."]),
        # a quote that no equals sign goes before
        ('<p>See <a href=x">here</a> and <a href="a>b">there</a>, <b "c">bold</b></p>', ["See here and there, bold"]),
        ("<p title='it\"s'>One</p><p data-x = 'a > b'>Two</p><p a=>Three</p>", ["One", "Two", "Three"]),
        ('<div class="comments"><article class="comment"><p>Reader</p></article></div><article><p>Text that is the main one</p></article>', ["Text that is the main one"]),
    ],
)
def test_main_text_by_contract(page, want):
    assert html_text.main_text(page) == "\n\n".join(want)


def test_headings_that_many_texts_have_stay(spark):
    """Without a marked article: what recurs alone stays, what recurs with its neighbours goes."""
    page = "<body><div><p>Our site</p><p>Sign up</p></div><h2>Introduction</h2><p>{a} is new.</p><p>Shared passage.</p><p>{b} ends.</p><ul><li>Terms</li><li>Privacy</li></ul></body>"
    rows = [(i, "http://x.org/a", page.format(a=f"Text {i}", b=f"Part {i}")) for i in range(8)]
    got = html_text.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in got:
        assert r.text.split("\n\n") == ["Introduction", f"Text {r.page_id} is new.", "Shared passage.", f"Part {r.page_id} ends."]


def test_groups_of_a_table_are_swapped_and_their_neutral_mentions_stay_low(spark, prose):
    """An insulted group of invented words: without the penalty its neutral mentions, held out, are false positives."""
    r = random.Random(5)
    say = lambda group, tail, k: f"{prose(6, k)} {group} {tail} {prose(6, 900 + k)}"
    rows = []
    for k in range(240):
        insult = r.random() < 0.5
        group = r.choice(["vorlans"] * (9 if insult else 1) + ["quemites", "drelfolk"])
        rows.append((k, say(group, r.choice(["are filthy scum", "should rot"]) if insult else r.choice(["met friends", "sang songs"]), k), int(insult)))
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    terms = [("g", "Vorlans"), ("g", "quemites"), ("g", "drelfolk"), ("g", "drelfolk"), ("h", "vorlans"), ("h", None), (None, "scum"), ("alone", "songs")]
    groups = spark.createDataFrame(terms, "group string, term string")
    assert toxicity.swaps(groups) == {"drelfolk": "quemites", "quemites": "vorlans", "vorlans": "drelfolk"}
    plain, fair = toxicity.train(labelled, 0.0, groups=groups), toxicity.train(labelled, 20.0, groups=groups)
    assert fair.swapped == 240
    assert toxicity.train(labelled).swapped == 0  # none of the built-in terms
    apart = lambda m: max(abs(m.score(say("vorlans", t, k)) - m.score(say("drelfolk", t, k))) for k in range(500, 520) for t in ("waited", "sang songs"))
    assert apart(fair) < apart(plain) / 4
    neutral = [say("vorlans", "bought bread", k) for k in range(600, 660)]
    false = [sum(m.score(t) >= 0.5 for t in neutral) for m in (plain, fair)]
    assert false[1] < false[0] and all(fair.score(say("vorlans", "are filthy scum", k)) >= 0.5 for k in range(700, 720))
    assert toxicity.swaps(groups.limit(0)) == {}
    with pytest.raises(ValueError, match="more than"):
        toxicity.swaps(spark.range(toxicity.GROUP_TERMS + 1).selectExpr("1 AS group", "concat('t', id) AS term"))


def test_extra_columns_with_names_of_the_operators(documents, prose):
    """Columns of the operators' own names are ignored: the same rows as without them."""
    rows = [(k, prose(30 + 9 * k, k)) for k in range(6)] + edges(prose(40, 9))
    ranks, pieces = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
    runs = {
        "bpe": lambda d: bpe.bpe_round_trip(d, ranks, public_tokenizers.PATTERN),
        "counts": lambda d: token_counts.token_counts(d, pieces),
        "lm": ngram_lm.lm_scores,
    }
    names = ("row", "ids", "tokens", "n_tokens", "n_words", "n_known", "word", "before", "lane", "shard", "count", "score", "held_out", "block", "key", "hash", "n")
    for name, run in runs.items():
        plain, extra = documents(rows), documents(rows)
        for c in names:
            extra = extra.withColumn(c, F.lit("mine"))
        rounded = lambda frame: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in frame.collect()), key=repr)
        assert rounded(run(extra)) == rounded(run(plain)), name
