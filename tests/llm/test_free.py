"""Top-k search, language identification, text extraction and the pipeline."""

from __future__ import annotations

import math
import random
import unicodedata
from collections import Counter

import numpy as np
import pytest
from brute import contaminated, crc, simhash
from pyspark.sql import functions as F

from tidemark.llm import knn, language
from tidemark.llm.extraction import extract_main_text, main_text
from tidemark.llm.queries import QUERIES

# -- exact top-k ------------------------------------------------------------------------------


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    centre = rng.normal(size=8) * 30
    rows += [(1_000 + i, [float(x) for x in centre + rng.normal(size=8)]) for i in range(300)]  # far from the others
    rows += [(2_000 + i, [0.5] * 8) for i in range(300)]  # one vector many times
    rows += [(3_000, None), (3_050, []), (3_100, [1.0, None]), (3_150, [float("nan")] * 8), (3_200, [float("inf")] + [0.0] * 7)]
    rows += [(3_250, [1.0, 2.0]), (3_300, [0.0] * 8), (3_350, [1e6] * 8), (None, [1.0] * 8)]
    return rows


def best(rows, chosen, k):
    usable = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in sorted(i for i in usable if chosen(i)):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v, strict=False)), i) for i, v in usable.items() if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize(("pivots", "block"), [(32, 2048), (3, 16)])
def test_top_k(spark, pivots, block):
    rows = vectors(1)
    data = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cell string").repartition(3)
    data = data.select("vec_id", knn.quantized(F.col("embedding")).alias("v"), "cell")
    found = knn.exact_top_k(data.where("vec_id % 50 = 0"), data, "vec_id", "v", 5, pivots, block)
    assert sorted(map(tuple, found.collect())) == best(rows, lambda i: i % 50 == 0, 5)


def test_top_k_over_many_slots(spark, monkeypatch):
    """One cell with a third of all rows: its work is dealt over the slots, the answers are the same."""
    monkeypatch.setattr(knn, "SLOT_BLOCKS", 1)
    rng = np.random.default_rng(8)
    rows = [(i, [3, 1, 2] if i % 3 == 0 else rng.integers(-40, 40, 3).tolist()) for i in range(600)]
    data = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = sorted(map(tuple, knn.exact_top_k(data.where("vec_id % 20 = 0"), data, "vec_id", "v", 5, 4, 16).collect()))
    want = []
    for q, x in rows[::20]:
        scored = sorted((-sum(a * b for a, b in zip(x, v, strict=True)), i) for i, v in rows if i != q)[:5]
        want += [(q, rank, i, -score) for rank, (score, i) in enumerate(scored, 1)]
    assert got == sorted(want)


def test_products_beyond_64_bits_are_an_error():
    small, large = np.array([[3, -4]]), np.array([[-(2**63), 1]])
    assert knn._product(small, small * 2**40).tolist() == [[25 * 2**40]]
    with pytest.raises(ValueError, match="64 bits"):
        knn._product(small, large)


def test_groups_far_apart_are_not_sent(spark):
    """The bounds keep the vectors of another direction away from a query group."""
    centers = np.array([[1000.0, 0.0], [-1000.0, 0.0]])
    need = knn._bounds(centers, {0: 5.0}, np.array([0] * 9), np.full(9, 3.0), 5)[0]
    assert need[0] <= 0 < 1000 < need[1]


def test_top_k_of_few_and_no_rows(spark):
    data = spark.createDataFrame([(0, [1]), (1, [2]), (2, [2])], "vec_id long, v array<long>")
    got = knn.exact_top_k(data.where("vec_id = 0"), data, "vec_id", "v")
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 2), (0, 2, 2, 2)]
    assert knn.exact_top_k(data, data.limit(0), "vec_id", "v").collect() == []
    assert knn.exact_top_k(data.limit(0), data, "vec_id", "v").collect() == []


# -- language ---------------------------------------------------------------------------------

ENGLISH = "the quick brown fox jumps over the lazy dog and then it goes home to sleep with its friends".split()
GERMAN = "der schnelle braune fuchs springt über den faulen hund und geht danach nach hause zu seinen freunden".split()
RUSSIAN = "быстрая коричневая лиса прыгает через ленивую собаку и потом идёт домой спать".split()


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_viterbi_against_all_paths(monkeypatch, block):
    from itertools import product

    monkeypatch.setattr(language, "BLOCK", block)
    monkeypatch.setattr(language, "CELLS", 10)
    rng = np.random.default_rng(3)
    counts = np.array([0, 3, 1, 5, 0, 4])
    begin = np.cumsum(counts) - counts
    for switch in (0.0, 0.7, 50.0):
        scores = rng.normal(size=(counts.sum(), 3)).astype(np.float32)
        got = language.viterbi(scores, begin, counts, switch)
        for b, n in zip(begin, counts, strict=True):
            own = scores[b : b + n]
            value = lambda path: sum(own[i, p] for i, p in enumerate(path)) - switch * sum(x != y for x, y in zip(path, path[1:], strict=False))
            top = max((value(p) for p in product(range(3), repeat=int(n))), default=0)
            assert abs(value(got[b : b + n]) - top) < 1e-4


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(words, k=30)), lang) for i, (words, lang) in enumerate([(ENGLISH, "en"), (GERMAN, "de"), (RUSSIAN, "ru")] * 20)]
    rows += [(900, None, "en"), (901, "words", None)]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=15)


def test_labels_and_spans(spark, model):
    mixed = " ".join(ENGLISH) + ". " + " ".join(GERMAN) + " — " + " ".join(RUSSIAN)
    long = (" ".join(GERMAN) + " ") * 2_000
    rows = [(1, mixed), (2, None), (3, ""), (4, "12 34 !?"), (5, long), (6, "漢字"), (7, "BRAUNE Hunde"), (7, "BRAUNE Hunde"), (None, "собака и лиса")]
    docs = spark.createDataFrame([(k, t, "z", 1.0) for k, t in rows], "doc_id long, text string, lang_pred string, score double")
    got = [tuple(r) for r in language.identify(docs, model, ["doc_id"]).collect()]
    by = {g[0]: g for g in got}
    assert model.languages == ("de", "en", "ru") and len(got) == len(rows)
    assert [tuple(s) for s in by[1][3]] == [("en", 0, len(ENGLISH)), ("de", len(ENGLISH), len(ENGLISH + GERMAN)), ("ru", len(ENGLISH + GERMAN), len(ENGLISH + GERMAN + RUSSIAN))]
    for k in (2, 3, 4):
        assert by[k] == (k, "und", 0.0, [])
    assert by[5][1:3] == ("de", 1.0) and [tuple(s) for s in by[5][3]] == [("de", 0, 2_000 * len(GERMAN))]
    assert by[6][1] in model.languages and by[7][1] == "de" and by[None][1:3] == ("ru", 1.0)


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    none = language.fit(docs)
    assert none.languages == ()
    assert [tuple(r) for r in language.identify(docs, none, ["doc_id"]).collect()] == [(1, "und", 0.0, [])]
    assert language.identify(docs.limit(0), none, ["doc_id"]).collect() == []


def test_the_result_does_not_depend_on_grouping(model, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(ENGLISH + GERMAN, k=rng.randint(0, 60))) for _ in range(50)]
    label, size, owner = language.label_texts(texts, model)
    whole = language.label_texts([" ".join(texts)], model)
    monkeypatch.setattr(language, "PIECE", 100)
    monkeypatch.setattr(language, "GROUP", 700)
    monkeypatch.setattr(language, "BLOCK", 7)
    for a, b in zip(language.label_texts(texts, model), (label, size, owner), strict=True):
        assert a.tolist() == b.tolist()
    for a, b in zip(language.label_texts([" ".join(texts)], model), whole, strict=True):
        assert a.tolist() == b.tolist()


def test_a_long_text_keeps_its_spans(model):
    """The two halves of 400,000 words, whose summed scores are far beyond the penalty."""
    label, _, _ = language.label_texts([(" ".join(ENGLISH) + " ") * 12_000 + (" ".join(RUSSIAN) + " ") * 12_000 + " ".join(GERMAN)], model)
    at = np.flatnonzero(np.diff(label)) + 1
    assert at.tolist() == [12_000 * len(ENGLISH), 12_000 * len(ENGLISH + RUSSIAN)]
    assert [model.languages[k] for k in label[[0, at[0], at[1]]]] == ["en", "ru", "de"]


def plain_words(text):
    """Words as lists of letters and marks with the characters before and after, and their script."""
    words, word = [], []
    for c in text.lower() + " ":
        if unicodedata.category(c)[0] in "LM":
            word.append(ord(c))
        elif word:
            if any(unicodedata.category(chr(x))[0] == "L" for x in word):
                words.append(word)
            word = []
    return words


def plain_bucket(a, b, c):
    h = (a * 0x9E3779B97F4A7C15 ^ b * 0xC2B2AE3D27D4EB4F ^ c * 0x165667B19E3779F9) % 2**64
    h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 % 2**64
    return h >> 48


def plain_buckets(word):
    return [plain_bucket(a, b, c) for a, b, c in zip([0, *word], word, [*word[1:], 0], strict=False)]


def plain_script(word):
    return max((language.NAMES.index(n) + 1 for n, a, b in language.SCRIPTS if a <= word[0] <= b), default=0)


def test_the_whole_query_against_a_plain_version(spark, small):
    """Counts, scores and the best path, one word at a time."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").collect()
    learned = [r for r in docs if r.text is not None and r.lang is not None and crc(str(r.doc_id)) % 4 != 2]
    names = sorted({r.lang for r in learned})
    assert max(Counter(r.lang for r in learned).values()) <= language.SAMPLE
    counts, scripts = {n: Counter() for n in names}, {n: Counter() for n in names}
    for r in learned:
        for word in plain_words(r.text):
            counts[r.lang].update(plain_buckets(word))
            scripts[r.lang][plain_script(word)] += sum(unicodedata.category(chr(x))[0] == "L" for x in word)
    total = {n: sum(counts[n].values()) + language.SMOOTHING * language.BUCKETS for n in names}
    possible = {s: [n for n in names if scripts[n][s] >= language.LEAST_SHARE * max(1, sum(scripts[n].values()))] or names for s in range(len(language.NAMES) + 1)}
    got = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, small).collect()}
    assert len(got) == len(docs)
    for r in docs:
        words, value, back = plain_words(r.text or ""), dict.fromkeys(names, 0.0), []
        for word in words:
            best = max(names, key=value.get)
            step = {n: n if value[n] >= value[best] - language.SWITCH else best for n in names}
            fits = possible[plain_script(word)]
            score = {n: sum(math.log((counts[n][b] + language.SMOOTHING) / total[n]) for b in plain_buckets(word)) - (0 if n in fits else 1e4) for n in names}
            value = {n: max(value[n], value[best] - language.SWITCH) + score[n] for n in names}
            back.append(step)
        letters, label = Counter(), max(names, key=value.get)
        for word, step in zip(words[::-1], back[::-1], strict=True):
            letters[label] += sum(unicodedata.category(chr(x))[0] == "L" for x in word)
            label = step[label]
        lang = max(names, key=lambda n: letters[n]) if words else "und"
        row = got[r.doc_id]
        assert (row.held_out, row.lang_pred) == (crc(str(r.doc_id)) % 4 == 2, lang)
        assert abs(row.score - (letters[lang] / sum(letters.values()) if words else 0.0)) < 1e-9


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = QUERIES["op4_language_id"](spark, small).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(crc(str(r.doc_id)) % 4 == 2 for r in found) and len(found) > 30
    assert sum(r.lang_pred == r.lang for r in found) >= 0.97 * len(found)


# -- extraction -------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<div class="mainMenu"><a href=x>Home</a> | <a>About</a></div><div id="cookie-notice">We use cookies on this long notice, accept them all</div>
%s<section class="comments"><article><p>I hate this text and write a much longer comment about it than the text itself was, really.</p></article></section>
<aside><p>Other news of the day, quite long as well</p></aside><form><p>Your name</p><input></form><footer>&copy; 2020</footer>"""
BODY = """<h1>Ti&amp;tle</h1><p>Some  <b>bold</b> text\n about &lt;things&gt;&nbsp;and so on<br>more<script>x("</p>")</script>.
<p class="ad">Buy this!</p><p>Be.<ul><li>one<li>t<i>w</i>o</ul><!-- <p>no</p> --><div role="search">Find</div><p>The end &#x41;&eacute; <a href="q>r">link</a></p>"""
TEXT = "Ti&tle\nSome bold text about <things> and so on more.\nBe.\none\ntwo\nThe end Aé link"


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main><div>%s</div></main>", '<div class="content">%s</div>'])
def test_article(around):
    assert main_text(PAGE % (around % BODY)) == TEXT


LONG = "a sentence of the text itself that goes on for a good while, number %d of them"
NESTED = [
    "<section><p>0</p></section><section><p>1</p></section>",
    "<p>0</p><blockquote><p>1 1</p></blockquote><p>2</p>",
    "<p>0</p><ul><li>1 1<li>2</ul><p>3</p>",
    "<p>0</p><table><tr><td>1 1<td>2<tr><td>3</table><div><div><p>4</p></div></div>",
]


@pytest.mark.parametrize("body", NESTED)
def test_text_across_nesting_without_article(body):
    import re

    numbers = re.findall(r">([0-9 ]+)", body)
    said = {n: " ".join(LONG % int(k) for k in n.split()) for n in numbers}
    page = re.sub(r">([0-9 ]+)", lambda m: ">" + said[m[1]], body)
    assert main_text(PAGE % f'<div class="content">{page}</div>').split("\n") == [said[n] for n in numbers]


def test_links_and_the_dive_without_article():
    text = "<p>" + LONG % 1 + "</p>"
    menu = "<ul>" + "<li><a>some link of the menu</a>" * 4 + "</ul>"
    link = "<p><a>only a link</a></p>"
    want = "only a link\n" + LONG % 1 + "\nonly a link"
    assert main_text(link + text + link) == want
    assert main_text(f"<p>Site</p>{menu}{text}{link}") == LONG % 1 + "\nonly a link"
    assert main_text(f"<p>Site</p>{menu}<div>{text}</div>{menu}<p>2020 Inc</p>") == LONG % 1
    both = main_text(f"<div>{text}</div>{menu}<div><div>{text}</div></div>")
    assert both.split("\n") == [LONG % 1, *["some link of the menu"] * 4, LONG % 1]
    assert main_text(f"<article>{link}{link}</article>{menu}") == "only a link\nonly a link"
    assert main_text(menu) == ""


@pytest.mark.parametrize("around", ["<article>%s</article>", "%s"])
def test_names_of_headings_and_sections_are_no_adverts(around):
    long = LONG % 1
    body = f"""<p>{long}</p><h2 id=related-work>Related</h2><section id="search-methods"><h3 id=warning-signs>Signs</h3><p>{long}</p></section>
<div class="social-history"><p>{long}</p></div><p class="foot-note">{long}</p><div class="related-links"><a>More of it</a></div><div class="share">Share</div><p>{long}</p>"""
    assert main_text(around % body).split("\n") == [long, "Related", "Signs", long, long, long, long]


def test_all_parts_of_a_main_text_stay():
    long = LONG % 1
    links = "<p><a>one link</a></p>" * 4
    assert main_text(f"<p>{long}</p>{links}<p>Short tail.</p>").split("\n") == [long, *["one link"] * 4, "Short tail."]
    menu = "<ul>" + "<li><a>some link of the menu</a>" * 4 + "</ul>"
    parts = f"<article><p>a {long}</p></article><article><p>b {long} {long}</p></article>"
    want = [f"a {long}", f"b {long} {long}"]
    assert main_text(f"{menu}<main>{parts}</main>{menu}").split("\n") == want
    assert main_text(f"{menu}<div>{parts}</div><p>Footer of {long}</p>").split("\n") == want
    nested = f"<article><p>a</p><article><p>{long}</p></article><section><p>b</p></section></article>"
    assert main_text(menu + nested).split("\n") == ["a", long, "b"]


def test_formulas_and_broken_graphics():
    body = f"<p>{LONG % 1}</p><p>Energy <math><mi>E</mi>=<mi>m</mi></math> is <noscript>here</noscript>.</p>"
    assert main_text(f"<article>{body}</article>").split("\n")[1] == "Energy E=m is here."
    assert main_text(f"<article><p>a</p><svg><path d=x><text>b</text><p>{LONG % 1}</article>").split("\n") == ["a", LONG % 1]
    assert main_text(f"<article><svg><path d=x /><text>b</text></svg><p>{LONG % 1}</article>") == LONG % 1


BROKEN = {
    "div": "<div>",
    "inline": "<b>x</i></u>",
    "quotes": """<a x="'""",
    "paragraphs": "<b><p>",
    "declarations": "<!",
    "doubtful": "<div class='ad-x'>a",
    "articles": "<article>a",
    "graphics": "<svg><a>",
    "lists": "<ul><li>a",
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_pages_take_time_in_proportion(name):
    """400,000 characters; work that grows with the square would take minutes."""
    import time

    start = time.process_time()
    main_text(BROKEN[name] * (400_000 // len(BROKEN[name])))
    assert time.process_time() - start < 6


def test_odd_pages(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 20_000
    pages = ["", None, "<p", "<nav>menu</nav>", "plain text", "<article><p>a</article>", "<script>never closed <p>x</p>", "<!-- never closed <p>x</p>", '<p title="open>text', "</p></div><p>x", long]
    rows = [(i, None if i == 3 else "u", p, "old") for i, p in enumerate(pages)] + [(5, "u", pages[5], "old")]
    found = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), ["page_id", "url"])
    got = {r.page_id: (r.text, r.n_chars) for r in found.collect()}
    want = ["", "", "<p", "", "plain text", "a", "", "", got[8][0], "x", "\n".join(["word & word"] * 20_000)]
    assert {k: t for k, (t, _) in got.items()} == dict(enumerate(want)) and found.count() == len(rows)
    assert all(n == len(t) for t, n in got.values())
    assert extract_main_text(spark.createDataFrame([], "page_id long, html string"), ["page_id"]).collect() == []


def test_pages_against_their_articles(spark, small):
    import html
    import re

    found = {r.page_id: r for r in QUERIES["op10_html_extraction"](spark, small).collect()}
    for page in spark.read.parquet(f"{small}/pages.parquet").collect():
        article = re.search(r"(?s)<article>(.*?)</article>", page.html)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert found[page.page_id].text == "\n".join(b for b in blocks if b)


# -- pipeline ---------------------------------------------------------------------------------


def test_stages(spark, small):
    """Every stage against a plain version of it, each on what the stage before has kept."""
    import corpus_pipeline as P
    from test_native import water
    from tidemark.session import stored

    assert [n for n, _ in P.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "mixing_sources", "sharding"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = [(90_001, None, "en", "src1", 0), (90_002, "1234 !", "en", "src1", 6), (90_003, "", "de", None, 0)]
    item = spark.read.parquet(f"{small}/benchmark.parquet").first().text
    extra += [(90_004, "The of. " + item, "en", "src2", 9), *[(90_010 + i, docs.first().text, "en", "src3", 1) for i in range(40)]]
    docs = stored(docs.union(spark.createDataFrame(extra, docs.schema)), "docs")
    columns, at = docs.columns, docs
    kept = {}
    for name, stage in P.STAGES:
        at = stored(stage(spark, at, small), name)
        kept[name] = [tuple(r) for r in at.collect()]
        assert at.columns[: len(columns)] == columns and (name == "sharding" or at.columns == columns)
    rows = [tuple(r) for r in docs.collect()]
    spoken = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert sorted(kept["language_id"]) == sorted(spoken)
    prints = np.array([simhash(r[1]) for r in spoken], dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    label = np.arange(len(spoken))
    while True:
        new = np.where(near, label[None, :], len(spoken)).min(axis=1)
        if (new == label).all():
            break
        label = new
    first = {}
    for r, group in zip(spoken, label, strict=True):
        first[group] = min(first.get(group, r), r)
    assert sorted(kept["simhash_near_dedup"]) == sorted(first.values())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    hit = contaminated([r[:2] for r in kept["simhash_near_dedup"]], items, 10)
    clean = [r for r, h in zip(kept["simhash_near_dedup"], hit, strict=True) if not h[4]]
    assert sorted(kept["benchmark_decontamination"], key=str) == sorted(clean, key=str) and len(clean) < len(hit)
    words = lambda r: len(r[1].split())
    sizes, taken, most = {}, {}, {}
    for r in clean:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r)
        most[r[3]] = max(most.get(r[3], 0), words(r))
    for r in kept["mixing_sources"]:
        taken[r[3]] = taken.get(r[3], 0) + words(r)
    for source, target in water(sizes).items():
        assert abs(taken.get(source, 0) - target) <= most[source] / 2 + 1e-6
    assert set(kept["mixing_sources"]) <= set(clean) and all(kept["mixing_sources"].count(r) <= 2 for r in clean)
    assert sorted(r[: len(columns)] for r in kept["sharding"]) == sorted(kept["mixing_sources"])
    assert {r[-1] for r in kept["sharding"]} <= set(range(24))
    assert len(P.run(spark, small).columns) == len(columns) + 2
