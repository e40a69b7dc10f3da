"""Language, toxicity, URL rules, nearest vectors and page texts."""

import math
import random
import subprocess
import sys
import time
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from linkloom.llm import common, extract, language, topk, toxicity, url_rules
from linkloom.llm.common import fold
from linkloom.llm.queries import RULES
from tests.llm import cases
from tests.llm.cases import collected, documents, odd_documents

SF = "/root/testdata/sf0.01"


def test_fold(spark):
    rows = documents(spark).select("doc_id", fold("doc_id").alias("f")).collect()
    assert all(r.f == (None if r.doc_id is None else cases.fold(r.doc_id)) for r in rows)


# Language


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return language.learn(language.training_fold(docs, fold("doc_id")))


def test_held_out_languages(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(fold("doc_id") == 0)
    found = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in found) >= 0.98 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_mixed_text_has_both_languages(spark, model):
    by_lang = {r.lang: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars between 1000 and 3000").collect()}
    mixed = by_lang["en"] + " " + by_lang["de"]
    found = language.identify(mixed, model)
    assert set(found) == {"en", "de"} and sum(found.values()) == pytest.approx(1)
    words = {k: len(by_lang[k].split()) for k in ("en", "de")}
    assert found["en"] == pytest.approx(words["en"] / sum(words.values()), abs=0.15)
    assert set(language.identify(by_lang["fr"], model)) == {"fr"}


def test_mixture_raises_the_likelihood():
    rng = np.random.default_rng(2)
    words = rng.normal(-5, 2, (200, 3))
    share, best = language.mixture(words, np.ones(200), rounds=200)
    for _ in range(50):
        other = rng.dirichlet(np.ones(3))
        assert np.log(np.exp(words) @ other).sum() <= best + 1e-6
    assert share.sum() == pytest.approx(1)


def test_odd_texts_have_no_language(spark, model):
    rows = {r.doc_id: r for r in language.predict(documents(spark, clashing=True), model).collect() if r.doc_id is not None}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (300, 301, 302, 303))
    assert language.predict(documents(spark), model).count() == len(odd_documents())
    assert language.predict(documents(spark, []), model).count() == 0
    kept = language.keep_identified(documents(spark, clashing=True), model)
    assert kept.columns == documents(spark, clashing=True).columns
    gone = {300, 301, 302, 303}
    assert {r.doc_id for r in kept.collect()} & gone == set()


def test_a_document_in_three_languages_stays(spark):
    words = {"aa": "kora tamo pakira motaka", "bb": "wesch flitz brung schwelf", "cc": "yyx ziy quizzy xyzzyx"}
    labelled = spark.createDataFrame([(i, t, name) for i, (name, t) in enumerate(words.items())], "doc_id bigint, text string, lang string")
    known = language.learn(labelled)
    text = " ".join(w for t in words.values() for w in t.split() * 20)
    found = language.identify(text, known)
    assert len(found) == 3 and max(found.values()) < 0.4
    docs = documents(spark, [(1, text, "en", "s", 1), (2, "12 -", "en", "s", 1)])
    assert [r.doc_id for r in language.keep_identified(docs, known).collect()] == [1]


def test_nothing_learned(spark):
    empty = language.learn(documents(spark, []).select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in language.predict(documents(spark), empty).collect()} == {"und"}


# Toxicity


@pytest.fixture(scope="module")
def toxic(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train = toxicity.labelled_texts(docs.filter(fold("doc_id") != 0), labels)
    return docs, labels, toxicity.learn(train)


def test_held_out_toxicity(spark, toxic):
    docs, labels, model = toxic
    held = toxicity.labelled_texts(docs.filter(fold("doc_id") == 0), labels)
    scored = toxicity.score(held, model).join(held.select("doc_id", "label"), "doc_id").collect()
    ones, zeros = ([r.score for r in scored if r.label == v] for v in (1, 0))
    better = sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))
    assert better > 0.8
    assert sum(b >= 0.5 for b in zeros) <= 0.05 * len(zeros)


def test_sample_from_ids_gives_the_same_model(spark, toxic):
    docs, labels, model = toxic
    found = toxicity.learn_from_labels(docs.filter(fold("doc_id") != 0), labels)
    assert found.weights.keys() == model.weights.keys() and abs(found.base - model.base) < 1e-6
    assert max(abs(found.weights[g] - w) for g, w in model.weights.items()) < 1e-6


def test_offending_sentences_are_located(spark, toxic):
    _, _, model = toxic
    text = "The ring of the ation.\nYou pathetic scum moron! And from the heed"
    (row,) = toxicity.score(documents(spark, [(1, text, "en", "a", 1)]), model).collect()
    assert [text[s.start : s.end].strip() for s in row.spans] == ["You pathetic scum moron"]


def test_noisy_or():
    weight = toxicity.WordWeights({"^bad$": 3.0})
    score, spans = toxicity.score_sentences("bad one. fine. fine. bad", -2.0, weight)
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    assert score == pytest.approx(1 - (1 - sigmoid(1.0)) ** 2 * (1 - sigmoid(-2.0)) ** 2)
    assert [p for *_, p in spans] == pytest.approx([sigmoid(1.0)] * 2)
    assert [(a, b) for a, b, _ in spans] == [(0, 7), (20, 24)]


def test_fit_finds_the_guilty_sentence():
    # One feature in some sentence of every toxic document, another in all documents.
    rng = random.Random(4)
    docs = [(y, [((1,), 3), ((0, 1) if y else (1,), 1), ((), rng.randint(1, 9))]) for y in (0, 1) for _ in range(200)]
    base, weights = toxicity.fit(docs, 2)
    assert base + weights[0] + weights[1] > 0 > base + weights[1]


def test_odd_texts_and_nothing_learned(spark, toxic):
    _, _, model = toxic
    rows = toxicity.score(documents(spark, clashing=True), model).collect()
    assert len(rows) == len(odd_documents())
    assert {r.score for r in rows if r.doc_id in (300, 301, 302)} == {0.0}
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    nothing = toxicity.learn(toxicity.labelled_texts(documents(spark), labels))
    assert all(r.score < 0.5 for r in toxicity.score(documents(spark), nothing).collect())
    several = spark.createDataFrame([(1, 0), (1, 1), (2, None), (3, 0), (None, 1)], "doc_id bigint, toxic int")
    known = {r.doc_id: r.label for r in toxicity.labelled_texts(documents(spark), several).collect()}
    assert known == {1: 1, 3: 0}


# URL rules


URLS = [
    "http://EXAMPLE.com/en/x?q#f", "https://www.example.com/en/", "https://a.www.example.com/en", "http://example.com", "x://net/es/1",
    "http://a.b.net/es/", "http://internet/es/", "http://a.net/ES/", "http://a.com/b.net/es/", "no url", "", None, "://", "http://",
    "http://com/", "http://x.com?u=/", "http://x.com#/", "http://foo.net/fr/?a=http://x.com/", "http://x.net/fr", "http://x.com:80/en/",
    "http://é.com/ü/\U0001f600", "a://b://com/", "http://.com/", "http://example.com/" + "en/" * 5000, "http://notexample.com/en/",
]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1].split("#")[0].split("?")[0]
        host, slash, path = rest.partition("/")
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path
    fits = []
    for r in RULES:
        own, slash, start = r.name.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + start):
            fits.append(r)
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best.verdict if best else "allow"


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[0], "x")], "page_id bigint, url string, host string")
    got = {r.page_id: tuple(r)[1:] for r in url_rules.judge(pages, RULES).collect()}
    assert got == {**{i: judged(u) for i, u in enumerate(URLS)}, None: judged(URLS[0])}
    assert url_rules.judge(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in url_rules.judge(pages, (), "block").collect()} == {"block"}


def test_automaton_against_backtracking():
    rng = random.Random(6)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**"]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts = ["".join(rng.choice("ab/") for _ in range(rng.randint(0, 12))) for _ in range(300)]

    def fits(g, t):
        if not g:
            return not t
        if g.startswith("**"):
            return any(fits(g[2:], t[i:]) for i in range(len(t) + 1))
        if g[0] == "*":
            free = len(t.split("/")[0])
            return any(fits(g[1:], t[i:]) for i in range(free + 1))
        return bool(t) and t[0] == g[0] and fits(g[1:], t[1:])

    got = url_rules.Automaton(globs).matches([t.encode() for t in texts])
    simple = [g for g in globs if "***" not in g]
    for g in simple:
        assert [bool(x) for x in got[:, globs.index(g)]] == [fits(g, t) for t in texts], g


# Bounded samples and long texts


def test_samples_are_bounded_in_rows(spark):
    rows = [(5, f"one id {i}", i % 2) for i in range(20_000)] + [(6, "same", 1)] * 50 + [(None, "none", 0), (7, "x" * 900, 0)]
    df = common.with_row_hash(spark.createDataFrame(rows, "doc_id bigint, text string, label int").repartition(7))
    keys = df.select("doc_id", "_row", F.length("text").alias("_chars"))
    assert common.of_sample(df, common.first_rows(keys, 800, 10**6)).count() == 800
    every = common.of_sample(df, common.first_rows(keys, 10**5, 10**6)).collect()
    assert len(every) == 20_002 and sum(r.doc_id == 6 for r in every) == 1
    few = common.of_sample(df, common.first_rows(keys, 10**5, 800)).collect()
    assert sum(len(r.text) for r in few) <= 800 and few and all(r.doc_id != 7 for r in few)
    first = sorted(map(tuple, common.first_rows(keys, 300, 10**6).collect()))
    assert first == sorted(map(tuple, common.first_rows(keys.repartition(3), 300, 10**6).collect()))


def test_pieces_of_long_texts(monkeypatch):
    rng = np.random.default_rng(2)
    logs = np.log(rng.dirichlet(np.ones(language.CELLS), 3).T)
    model = language.Model(["a", "b", "c"], logs)
    text = " ".join("".join(rng.choice(list("abcdeé"), rng.integers(1, 9))) for _ in range(3000)) + "," + "z" * 200
    whole, words = language.identify(text, model), language.likelihoods(text, model)
    monkeypatch.setattr(language, "PIECE", 300)
    monkeypatch.setattr(language, "WORDS", 100)
    assert "".join(language.pieces(text)) == text and max(map(len, language.pieces(text))) <= 600
    assert np.allclose(language.likelihoods(text, model), words, rtol=1e-12)
    cut = language.identify(text, model)
    assert list(cut) == list(whole) and list(cut.values()) == pytest.approx(list(whole.values()))


def test_long_text_in_bounded_memory():
    code = """
import resource, numpy as np
from linkloom.llm import language
logs = np.log(np.random.default_rng(2).dirichlet(np.ones(language.CELLS), 4).T)
text = "the quick brown fox jumps over " * (50_000_000 // 31) + "語" * 1_000_000
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert language.identify(text, language.Model(list("abcd"), logs))
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    grown = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert grown < 1_000_000


# Nearest vectors


def vector_rows():
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(400)]
    rows += [(1000 + i, rows[100][1]) for i in range(30)]
    rows += [(500, None), (501, []), (502, [None] * 8), (503, [math.nan] * 8), (504, [math.inf] * 8), (505, [0.0] * 8), (506, [1e30] * 8)]
    rows += [(507, [0.5, -0.5]), (508, [0.1] * 12), (None, [0.1] * 8), (7, rows[7][1]), (200, rows[200][1])]
    return rows


def scaled(vector):
    if vector is None or any(x is None or not math.isfinite(x) or abs(x) * 1024 >= topk.LARGEST for x in vector):
        return None
    return [math.floor(1024 * x) for x in vector]


@pytest.mark.parametrize("block", [1, 4096])
def test_top_products(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_QUERIES", block)
    monkeypatch.setattr(topk, "CHUNK", 37)
    rows = [(i, [None if x is None else float(np.float64(x)) for x in v] if v is not None else None) for i, v in vector_rows()]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1))
    got = collected(topk.top_products(topk.whole_components(df), F.pmod("vec_id", F.lit(100)) == 0))
    known = [(i, scaled(v)) for i, v in rows if i is not None and scaled(v) is not None]
    want = []
    for q in sorted({i for i, _ in known if i % 100 == 0}):
        query = min(v for i, v in known if i == q)
        scores = sorted((-sum(a * b for a, b in zip(query, v)), i) for i, v in known if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert got == sorted(want, key=repr)


def test_large_components_take_part(spark):
    rng = np.random.default_rng(5)
    # Near each other and far away: lengths whose squares are rounded, products around 2**62.
    far = rng.normal(0, 1, 6) * 2.0**19
    rows = [(i, [float(x) for x in far + rng.normal(0, 2.0 ** (i % 12), 6)]) for i in range(300)]
    rows += [(1000 + i, [float(x) for x in rng.normal(0, 0.2, 6)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = collected(topk.top_products(topk.whole_components(df, refuse=True), F.pmod("vec_id", F.lit(100)) == 0))
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    assert max(abs(x) for v in whole.values() for x in v) > 1 << 24
    want = []
    for q in (i for i in whole if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert got == sorted(want, key=repr)
    # Python's integers, where a product passes 64 bits but is not among the best.
    vectors = np.array([[1 << 40], [-(1 << 40)], [3], [5]], np.int64)
    floor = np.full(1, -math.inf)
    at = topk.places(vectors, np.empty((4, 0)), vectors[:0])
    ((_, ids, scores, _),) = topk.best_of(vectors[:1], np.array([0]), at, np.arange(4), vectors, at, 2, floor)
    assert ids.tolist() == [3, 2] and scores.tolist() == [5 << 40, 3 << 40]
    odd = spark.createDataFrame([(1, [math.nan]), (2, [math.inf]), (3, [None]), (4, None), (None, [1e30])], "vec_id bigint, embedding array<double>")
    assert topk.whole_components(odd, refuse=True).count() == 0
    large = spark.createDataFrame([(1, [1e30])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="does not fit"):
        topk.whole_components(large, refuse=True).collect()


def test_top_products_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_products(topk.whole_components(df), F.col("vec_id") == 0).count() == 0
    one = spark.createDataFrame([(0, [0.5]), (1, [0.25])], "vec_id bigint, embedding array<float>")
    assert collected(topk.top_products(topk.whole_components(one), F.col("vec_id") == 0)) == [(0, 1, 1, 512 * 256)]


def best_in_one_chunk(queries, own, rows, pivots, floor):
    asked = topk.places(queries, topk._distances(queries, pivots), pivots)
    there = topk.places(rows, topk._distances(rows, pivots), pivots)
    return list(topk.best_of(queries, own, asked, np.arange(len(rows)), rows, there, 10, floor))


def test_elimination_stops_early():
    rng = np.random.default_rng(8)
    centres = rng.integers(-900, 900, (20, 16))
    rows = np.concatenate([c + rng.integers(-20, 20, (200, 16)) for c in centres])
    ((_, ids, scores, seen),) = best_in_one_chunk(rows[[5]], np.array([-1]), rows, topk.choose_pivots(rows[::200], 16), np.full(1, -math.inf))
    want = rows @ rows[5]
    assert list(scores) == sorted(want, reverse=True)[:10]
    assert seen < len(rows) / 4


@pytest.mark.parametrize("size", [1, 1000, 1 << 30])
@pytest.mark.parametrize("pivots", [0, 1, 7, 16])
def test_bounds_are_bounds_and_tighter_than_any_triangle(size, pivots):
    rng = np.random.default_rng(size + pivots)
    rows = np.concatenate([rng.integers(-size, size + 1, (60, 16)), rng.integers(-3, 4, (20, 16)), np.zeros((2, 16), np.int64)])
    chosen = topk.choose_pivots(rows[:40], pivots)
    distances = topk._distances(rows, chosen)
    at = topk.places(rows, distances, chosen)
    bounds = topk._bounds(at, at)
    exact = rows.astype(object) @ rows.T.astype(object)
    assert all(b >= e for b, e in zip(bounds.ravel().tolist(), exact.ravel().tolist()))
    # Among lengths that differ by a billion the room for rounding outweighs the short ones.
    if len(chosen) and size < 1 << 30:
        square = (rows.astype(float) ** 2).sum(axis=1)
        gap = np.abs(distances[:, None] - distances[None]).max(axis=2)
        triangle = (square[:, None] + square - gap**2) / 2
        assert (bounds <= triangle + 2 + 1e-5 * np.sqrt(square[:, None] * square + square.max())).all()


def test_given_vectors_are_mostly_eliminated():
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet", columns=["vec_id", "embedding"])
    ids = table["vec_id"].to_numpy()
    rows = np.array([scaled(v) for v in table["embedding"].to_pylist()], np.int64)
    queries, own = rows[ids % 100 == 0], ids[ids % 100 == 0]
    known = topk.Pivots(topk.choose_pivots(rows[: topk.SAMPLE], topk.PIVOTS), ids[: topk.SAMPLE], rows[: topk.SAMPLE])
    floor = topk._at_least(queries, own, known, 10)
    asked = topk.places(queries, topk._distances(queries, known.rows), known.rows)
    there = topk.places(rows, topk._distances(rows, known.rows), known.rows)
    seen = sum(n for *_, n in topk.best_of(queries, own, asked, ids, rows, there, 10, floor))
    share = seen / (len(queries) * len(rows))
    print("evaluated", share)
    assert share < 0.3


# Page texts


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- x --><div class="ad">Buy &amp; go</div>
<article><header><h1>Title &amp; more</h1></header><p>One <b>two</b>
 three<br>four<p>Five &eacute;&#33;<form>Name <input></form><aside>Beside</aside>
<div class="comments"><p>First!</p></div><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>
<footer>&copy; host</footer></body></html>"""


def test_blocks():
    kept = [b.text for b in extract.blocks(PAGE) if not b.aside]
    assert kept == ["Title & more", "One two three four", "Five é!", "x", "y", "1", "2"]


def page_rows(with_article):
    rng = random.Random(9)
    rows = []
    for i in range(150):
        body = " ".join(rng.choice("abcdefgh") * rng.randint(1, 5) for _ in range(20))
        inner = f"<p>{body}</p><p>{body[::-1]}</p>"
        inner = f"<article>{inner}</article>" if with_article else f'<div class="x{i}"><div class="text">{inner}</div></div>'
        page = f'<body><div class="top">Site {i % 2}</div>{inner}<div class="end">Read {i % 3} more</div></body>'
        rows.append((i, f"http://h{0 if i % 3 else 1}.org/{i}", page, f"{body}\n{body[::-1]}"))
    return rows


@pytest.mark.parametrize("with_article", [True, False])
def test_repeated_branches_go(spark, with_article):
    rows = page_rows(with_article)
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string").withColumn("host", F.lit("x"))
    got = {r.page_id: r.text for r in extract.extract(pages).collect()}
    assert got == {i: text for i, _, _, text in rows}


def test_contents_decide_beside_and_within_articles(spark):
    rows = []
    for i, url, page, text in page_rows(True):
        notice, more = "<div class='box'>All rights with us.</div>", f"More {i * 7919} {text[:9]}"
        page = page.replace("<article>", f"<div class='intro'>{more}</div><nav>Go {i}</nav><article>{notice}")
        rows.append((i, url, page, f"{' '.join(more.split())}\n{text}"))
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in extract.extract(pages).collect()}
    assert got == {i: text for i, _, _, text in rows}


def test_words_in_attributes_are_no_verdict(spark):
    rows = []
    for i, url, page, text in page_rows(True):
        first, second = text.split("\n")
        inner = (
            f"<h2 id='search'>H {i * 7919}</h2><section id='related-work'>{first}</section><p><a class='share'>W{i}</a> {second}</p>"
            f"<div class='social'>S {second}</div>"
        )
        rows.append((i, url, f"<article>{inner}</article><div class='ad'>Buy {i}</div>", f"H {i * 7919}\n{first}\nW{i} {second}\nS {second}"))
        rows.append((1000 + i, f"http://x.org/{i}", f"<body class='sticky-header'><div class='menu'>{first}</div>{second}", f"{first}\n{second}"))
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in extract.extract(pages).collect()}
    assert got == {i: text for i, _, _, text in rows}
    holders = [b.aside for b in extract.blocks("<p><a class='share'>Word</a> long paragraph</p><h2 class='search'>x</h2><div class='ad'>y</div>")]
    assert holders == [False, False, True]


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "http://a.b/", ""), (None, "x", "plain < text &lt; &bogus; &am"), (4, "http://a.b/", "<p>x" * 3000), (4, "http://a.b/", "<p>x" * 3000), (5, "u", "<script>never closed"), (6, "u", "</p></div>tail")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("n_pages", F.lit(1))
    got = collected(extract.extract(pages).withColumn("n", extract.n_chars()))
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in got}
    assert by_id[1][2] == "" and by_id[2][2] == "" and by_id[5][2] == "" and by_id[6][2] == "tail"
    assert all(r[3] == len(r[2]) for r in got)
    assert extract.extract(pages.limit(0)).count() == 0
    deep = "<div>" * 5000 + "text" + "</div>" * 5000
    assert [b.text for b in extract.blocks(deep)] == ["text"]


def page_tree(rng, deep=0):
    """(tag, class, children), a child being a text or another tree."""
    inner = [page_tree(rng, deep + 1) for _ in range(rng.randint(0, 2))] if deep < 3 else []
    if rng.random() < 0.7 or not inner:
        inner.insert(rng.randint(0, len(inner)), f"{rng.choice(['same', 'other', str(rng.random())])} text")
    return rng.choice(["div", "section", "nav"] if deep else ["div"]), rng.choice(["", "a", "promo"]), inner


def as_html(tree):
    tag, name, inner = tree
    inner = "".join(x if isinstance(x, str) else as_html(x) for x in inner)
    return f"<{tag} class='{name}'>{inner}</{tag}>"


def evenness(features):
    counts = Counter(features)
    seen = sum(counts.values())
    return seen, (-sum(n / seen * math.log(n / seen) for n in counts.values()) / math.log(seen) if seen > 1 else 1.0)


def brute_force_leaves(pages):
    """(host, path, prior) to evidence, by walks over all pages."""
    shown = {}

    def walk(host, page, tree, path, prior):
        tag, name, inner = tree
        path, prior = (*path, (tag, name)), min(prior, -3.0 if tag == "nav" else 0.7, -1.5 if name == "promo" else 0.7)
        shown.setdefault((host, path), set()).add((page, tuple("#" if isinstance(x, str) else x[:2] for x in inner)))
        for x in inner:
            if isinstance(x, str):
                shown.setdefault((host, (*path, prior)), set()).add((page, x))
            else:
                walk(host, page, x, path, prior)

    for page, (host, tree) in enumerate(pages):
        walk(host, page, ("", "", [tree]), (), 0.7)
    own, pages_of = {}, {}
    for host, path in shown:
        seen, even = evenness([f for _, f in shown[host, path]])
        pages_of[path], everywhere = evenness([f for (_, p), s in shown.items() if p == path for _, f in s])
        own[host, path] = seen, (seen * even + 20 * everywhere) / (seen + 20)
    given = {}
    for host, path in shown:
        if isinstance(path[-1], float):
            value = own[host, path][1]
            for depth in range(len(path) - 1, 0, -1):
                value = 0.1 * own[host, path[:depth]][1] + 0.9 * value
                given.setdefault((host, path[:depth]), []).append((own[host, path][0], value, path))
    trust = {path: n / (n + 40) for path, n in pages_of.items()}

    def odds(p):
        p = min(max(p, 0.018), 0.982)
        return math.log(p / (1 - p))

    out = {}
    for host, path in shown:
        if isinstance(path[-1], float):
            told = 0.0
            for depth in range(1, len(path)):
                below = given[host, path[:depth]]
                composite = sum(n * v for n, v, _ in below) / sum(n for n, _, _ in below)
                told = trust[path[:depth]] * odds(composite) + (1 - trust[path[:depth]]) * told
            value = next(v for _, v, p in given[host, path[:-1]] if p == path)
            out[host, path] = trust[path] * odds(value) + (1 - trust[path]) * told
    return out


def test_style_tree_by_brute_force(spark):
    rng = random.Random(4)
    shapes = [page_tree(rng) for _ in range(6)]
    trees = [(f"h{i % 3}", rng.choice(shapes) if rng.random() < 0.6 else page_tree(rng)) for i in range(90)]
    df = spark.createDataFrame([(i, f"http://{h}/", as_html(t), h) for i, (h, t) in enumerate(trees)], "page_id bigint, url string, html string, host string")
    got = extract.judged(extract.observations(df)).collect()
    want = brute_force_leaves(trees)
    assert sorted((r.host, r.prior, round(r.evidence, 6)) for r in got) == sorted((h, p[-1], round(e, 6)) for (h, p), e in want.items())

    def kept(host, tree, path, prior):
        tag, name, inner = tree
        path, prior = (*path, (tag, name)), min(prior, -3.0 if tag == "nav" else 0.7, -1.5 if name == "promo" else 0.7)
        for x in inner:
            if not isinstance(x, str):
                yield from kept(host, x, path, prior)
            elif prior + want[host, (*path, prior)] >= 0:
                yield x

    texts = {r.page_id: r.text for r in extract.extract(df).collect()}
    assert texts == {i: "\n".join(kept(h, ("", "", [t]), (), 0.7)) for i, (h, t) in enumerate(trees)}
    assert 0 < sum(t.count("\n") + 1 for t in texts.values() if t) < sum(as_html(t).count(" text") for _, t in trees)


def test_malformed_pages_take_linear_time():
    pages = [
        "<a " * 350_000 + '"', "<font>" * 170_000, "<div>" * 100_000 + "text", "<a x='" * 170_000, '<a x="y' * 150_000, "<!--" * 250_000,
        "</x>" * 250_000, "<ul>" + "<li>x" * 100_000, "<a " + "= " * 500_000, "<b><p>" * 100_000, "<a class " * 110_000, "<div class=" * 100_000,
    ]
    for page in pages:
        start = time.process_time()
        extract.blocks(page)
        assert time.process_time() - start < 5, page[:20]
