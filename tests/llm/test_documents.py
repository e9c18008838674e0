"""Operators 5, 6, 7 and 10 and the pipeline, against plain versions on small fixtures."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martweave.llm import _graph, _text, byte_bpe, decontamination, html_text, jaccard_join, line_quality, queries
from support import plan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


# --- 5

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body class="has-sidebar">
<header class="site"><a href="/">Home</a></header><nav><ul><li><a href=a>One</a></li></ul></nav>
<div id="cookie-notice">We use cookies.</div><!-- gone --><script>var t = "</p>";</script>
<article class="post"><header><h1>T&eacute;st <i>wo</i>rds</h1></header><p>First &amp;amp; last<br>line.<p>Sec<b>ond</b>
 par.</p><div class="ad-box"><p>Buy this now</p></div><ul><li>item<li>other <a href=x>link</a></ul>
<form><p>Your name</p><button>Send</button></form><section id="comments"><p>I liked this a lot, thank you.</p></section>
<p hidden>not seen</p><p>1 < 2 &lt;ok&gt; &nbsp; end</p></article>
<aside><p>Side matter that is long enough to look like a text of its own.</p></aside><footer>&copy; us</footer></body></html>"""


def test_html():
    text, found, kept = html_text.main_text(PAGE)
    assert text == "Tést words First &amp; last line. Second par. item other link 1 < 2 <ok> end"
    assert len(found) == len(kept) and "Buy this now" in found
    plain = '<div class="menu"><a href=1>A</a></div><div id="content"><h2>Head</h2><p>Some text here.</p></div><div class=footer>x</div>'
    assert html_text.main_text(plain)[0] == "Head Some text here."
    assert html_text.main_text("just text &amp; more")[0] == "just text & more"
    assert html_text.main_text(None)[0] == html_text.main_text("<p>")[0] == ""
    outside = "<div>Breaking: read this.</div><main><p>The text.</p><aside><article><p>Card</p></article></aside></main><div>More</div>"
    assert html_text.main_text(outside)[0] == "The text."
    html_text.main_text("<div>" * 20000 + "x" + "</p>" * 20000)


def test_html_without_end_of_head():
    words = "<p>Some text that is long enough here.</p>"
    for rest in (f"<body>{words}", words, f"<article>{words}</article>", "Some text that is long enough here.", "<b>Some</b> text that is long enough here."):
        page = f"<html><head><meta charset=x><title>No</title><template><p>no</p></template><script>no()</script>\n{rest}"
        assert html_text.main_text(page)[0] == "Some text that is long enough here."
    assert html_text.main_text(f"<head><title>No</title> <style>p{{}}</style></head><body>{words}")[1] == ["Some text that is long enough here."]


def test_html_self_closed_pictures():
    for made in ('<svg width="9"/>', "<svg/>", "<math />", "<svg a=b c/>", "<svg><path d='M0'/><title/><script/><svg/>x</svg>", "<svg><g/></svg>"):
        page = f"<article><p>First part of the text.</p>{made}<p>Second part of the text.</p></article>"
        assert html_text.main_text(page)[0] == "First part of the text. Second part of the text."
    # The slash belongs to a value, or stands in an element that it does not end.
    for made in ("<svg width=9/>", "<canvas/>"):
        assert html_text.main_text(f"<article><p>First part.</p>{made}not seen</article>")[0] == "First part."


LONG = " ".join(["Some words of a long paragraph that goes on."] * 6)


def test_html_a_small_article_does_not_hide_the_text():
    teaser = '<article class="card"><p>Read this next</p></article>'
    page = f'<div class="content"><h1>Title of it</h1><p>{LONG}</p><p>{LONG}</p></div>{teaser}'
    assert html_text.main_text(page)[0] == f"Title of it {LONG} {LONG} Read this next"
    side = f'<div class="content"><p>{LONG}</p></div><aside>{teaser}</aside>'
    assert html_text.main_text(side)[0] == LONG


def test_html_hidden_inline():
    for hidden in ("<span hidden>gone</span>", '<b style="display: none">go<b>ne</b> gone</b>', '<i aria-hidden="true">go<span>ne</span></i>', "<span hidden>go<br>ne</span>"):
        page = f"<article><p>First {hidden} last words.</p><p>More text.</p></article>"
        assert html_text.main_text(page)[0] == "First last words. More text.", hidden
    open_end = "<article><p>First <span hidden>gone</p><p>More text.</p></article>"
    assert html_text.main_text(open_end)[0] == "First More text."
    assert html_text.main_text("<p>a<span>b</span>c <em class=x>d</em></p>")[0] == "abc d"


def test_html_names():
    for name, kept in (("promo-story", False), ("comment-body", False), ("post-comments", False), ("content-sidebar-wrap", True), ("has-sidebar", True), ("post-body", True), ("main", True)):
        page = f'<article><p>{LONG}</p><div class="{name}"><p>Words inside it.</p></div></article>'
        assert html_text.main_text(page)[0] == LONG + " Words inside it." * kept, name


def test_html_neighbours_decide_where_elements_do_not(monkeypatch):
    menu = "".join(f"<div><a href=/{k}>Page {k}</a></div>" for k in range(4))
    page = f"{menu}<div>Topics</div>{menu}<div>Heading here</div><div>{LONG}</div><div><a href=x>A linked line</a></div><div>{LONG}</div>{menu}"
    want = f"Heading here {LONG} A linked line {LONG}"
    assert html_text.main_text(page)[0] == want
    names = ["chrome", "side", "form", *html_text.TITLES[1:]]

    def asked(node):
        return set() if node.feature < 0 else {names[node.feature]} | asked(node.low) | asked(node.high)

    used = asked(html_text.tree())
    assert used & {"words_before", "words_after"} and used & {"links_before", "links_after"} and "links" in used
    table = np.array(html_text.EXAMPLES, float)
    blind = html_text._features(table[:, :-1])
    blind[:, names.index("words_before") : names.index("links_after") + 1] = 0
    monkeypatch.setattr(html_text, "tree", lambda: html_text.grow(blind, table[:, -1]))
    assert html_text.main_text(page)[0] != want


def test_html_of_the_given_pages(spark):
    """Every page against a plain cut of its one article; words lost and kept too many are counted."""
    pages = queries.shipped(spark).read.parquet("/root/testdata/sf0.1/pages.parquet")
    lost = more = n = 0
    for r in html_text.extract(pages).select("html", "text").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = html_text.references.unescape(re.sub(r"<(?:/?p|br|/?h1|/?li|/?ul|/?div)>", " ", article))
        want = re.sub(r"</?[a-z]+[^>]*>", "", want).split()
        got = r["text"].split()
        lost, more, n = lost + max(len(want) - len(got), 0), more + max(len(got) - len(want), 0), n + len(want)
    print(f"{n} words, {lost} lost, {more} too many")
    assert n > 100_000 and lost + more <= 0.001 * n


def test_html_tree_agrees_with_its_table():
    table = np.array(html_text.EXAMPLES, float)
    root, good = html_text.tree(), 0
    for row, label in zip(html_text._features(table[:, :-1]), table[:, -1]):
        node = root
        while node.feature >= 0:
            node = node.low if row[node.feature] <= node.cut else node.high
        good += node.label == label
    assert good == len(table)


def test_html_rows(spark):
    rows = [(1, "u", PAGE, "a"), (1, "u", PAGE, "b"), (2, None, None, "c"), (None, "v", "", "d")]
    df = queries.shipped(spark).createDataFrame(rows, "page_id long, url string, html string, TEXT string")
    got = html_text.extract(df)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars", "blocks"]
    assert sorted(r["n_chars"] for r in got.collect()) == [0, 0, 76, 76]
    assert html_text.extract(df.limit(0)).count() == 0


# --- 6


def plain_join(ids, texts, threshold=0.8):
    grams = {}
    for i, text in zip(ids, texts):
        w = words(text)
        if i is not None:
            grams[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    copy, parent = {}, {i: i for i in grams}
    for i in sorted(grams):
        copy[i] = next((j for j in sorted(grams) if grams[j] == grams[i]), i) if grams[i] else i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = defaultdict(int)
    some = sorted({j for i, j in copy.items() if grams[i]})
    for x, a in enumerate(some):
        for b in some[x + 1 :]:
            both = len(grams[a] & grams[b])
            if both >= threshold * (len(grams[a]) + len(grams[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (root(copy[i]), copy[i], links[copy[i]], len(grams[i])) for i in grams}


def near_texts(seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(6):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([8, 60, 150]))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(4000)}"
            out.append(" ".join(copy).title() if rng.random() < 0.5 else ", ".join(copy))
    return [*out, None, "", "...", "one", "One!", "a b c d e", *out[:3]]


@pytest.mark.parametrize("block", [1024, 7])
def test_jaccard_join(documents, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    texts = near_texts()
    ids = list(range(len(texts)))
    random.Random(3).shuffle(ids)
    got = jaccard_join.jaccard_join(documents(texts, ids, Class_ID=["x"] * len(texts)), recall=0.999999, trees=40)
    found = {r["doc_id"]: tuple(r)[1:] for r in got.collect()}
    assert found == plain_join(ids, texts)


def test_jaccard_join_reaches_its_recall(documents, spark, monkeypatch):
    """Production parameters against all pairs, weak links among them; the forest ends early only where all are strong."""
    depths = []
    level = jaccard_join._Forest.level
    monkeypatch.setattr(jaccard_join._Forest, "level", lambda self, *given: depths.append(given[2]) or level(self, *given))
    texts, rng = [t for seed in range(2, 9) for t in near_texts(seed)], random.Random(8)
    base = [f"v{rng.randrange(9000)}" for _ in range(100)]
    texts += [" ".join(base[:k] + [f"y{k}{j}" for j in range(2)] + base[k + 2 :]) for k in range(5, 90, 6)]  # linked at about 0.8
    ids = list(range(len(texts)))
    found = {r["doc_id"]: tuple(r)[1:] for r in jaccard_join.jaccard_join(documents(texts, ids)).collect()}
    want = plain_join(ids, texts)
    links = [sum(v[2] for v in x.values()) for x in (found, want)]
    assert links[0] >= jaccard_join.RECALL * links[1] > 500 and all(found[i][2] <= want[i][2] for i in ids)
    assert sum(found[i] == want[i] for i in ids) >= 0.99 * len(ids)
    assert depths == [8, 7, 6, 5, 4]
    depths.clear()
    base = [f"w{k}" for k in range(900)]
    strong = [" ".join([*base[:k], "new", *base[k + 1 :]]) for k in range(0, 900, 45)]
    got = jaccard_join.jaccard_join(documents(strong)).collect()
    assert {r["n_links"] for r in got} == {len(strong) - 1} and depths == [8]


@pytest.mark.parametrize("bits", [26, 12])
def test_marked_rows_hold_all_that_are_asked_for(spark, monkeypatch, bits):
    monkeypatch.setattr(jaccard_join, "MARKS", bits)
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("v")).union(spark.createDataFrame([(None, "x")], "k long, v string"))
    ids = spark.range(0, 20_000, 40).select(F.col("id").alias("i"))
    found = {r["k"] for r in jaccard_join._among(rows, "k", ids, "i").collect()}
    assert found >= set(range(0, 20_000, 40)) and len(found) < (3000 if bits == 26 else 6000)
    assert jaccard_join._among(rows, "k", ids.limit(0), "i").count() == 0


def test_neighbours_share_the_longest_prefixes(spark):
    rng = np.random.default_rng(4)
    paths = rng.integers(0, 2, (300, 6)).astype(">u4")
    rows = [(k, 5, paths[k].tobytes()) for k in range(300)]
    texts = queries.shipped(spark).createDataFrame(rows, "member long, n_shingles long, signature binary").repartition(7)
    got = {(r["tree"], r["member"]): r["reach"] for r in jaccard_join.tries(texts, 2, 3, 1).collect()}
    edge = 0
    for tree in range(2):
        own = paths[:, 3 * tree : 3 * tree + 3]
        for k in range(300):
            common = np.cumprod(np.delete(own, k, 0) == own[k], 1).sum(1).max()
            assert got.get((tree, k), 0) in (common, 3)
            edge += got.get((tree, k), 0) != common
    assert edge <= 2 * 16


def test_jaccard_join_of_odd_rows(documents):
    texts = ["a b c d e f g h i j k l", "z z z z z z z", "a b c d e f g h i j k l m", "q r s t u v w", "z z z z z z z"]
    got = jaccard_join.jaccard_join(documents(texts, [4, 4, 5, 5, 4]))
    assert sorted(tuple(r) for r in got.collect()) == [(4, 4, 4, 0, 1), (4, 4, 4, 0, 1), (4, 4, 4, 1, 8), (5, 4, 5, 1, 9), (5, 5, 5, 0, 3)]
    got = jaccard_join.jaccard_join(documents(["a b c d e f"] * 3 + ["q"], [4, 4, None, None]))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [(4, 4, 4, 0, 2), (4, 4, 4, 0, 2), (None, None, None, 0, 2), (None, None, None, 0, 1)], key=repr
    )
    assert jaccard_join.jaccard_join(documents([])).count() == 0


def test_prefixes_reach_the_recall():
    for target in (0.98, 0.99, 0.9995):
        n = jaccard_join.prefix_length(0.8, 16, 8, target)
        assert 1 - (1 - 0.8**n) ** 16 >= target > 1 - (1 - 0.8 ** (n + 1)) ** 16
    with pytest.raises(ValueError):
        jaccard_join.prefix_length(0.5, 1, 4, 0.9)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    got = {r["node"]: r["component"] for r in _graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {k: 100 for k in range(100, 160)} | {200: 200, 300: 200}


# --- 7


def plain_hits(text, items):
    w, hit, found = words(text), set(), set()
    for item, own in items:
        own = words(own)
        size = min(10, len(own))
        for a in range(len(own) - size + 1 if own else 0):
            for k in range(len(w) - size + 1):
                if w[k : k + size] == own[a : a + size]:
                    hit.update(range(k, k + size))
                    found.add(item)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("index", [50_000, 9])
def test_decontamination(documents, spark, index):
    rng = random.Random(4)
    few = "the of and to a in is it".split()
    items = [(k, " ".join(rng.choice(few) for _ in range(rng.choice([1, 2, 5, 10, 11, 25])))) for k in range(12)]
    items += [(40, "A, b; c"), (40, "z z z z z z z z z z"), (41, "a b C"), (42, None), (None, "the of"), (43, "..."), (12, items[5][1])]
    texts = [" ".join(rng.choice(few) for _ in range(rng.choice([0, 3, 30, 300]))) for _ in range(40)]
    texts += [f"before {t} after" for _, t in items if t] + [None, "", "a b", "a b c", "a  b--c a b c", "z " * 40, texts[3]]
    df = documents(texts, Spans=["x"] * len(texts))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.decontaminate(df, benchmark, index=index)
    assert out.columns == ["doc_id", "text", "n_words", "n_hit", "items", "spans"]
    known = [(i, t) for i, t in items if i is not None]
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in out.collect()}
    assert got == {k: plain_hits(t, known) for k, t in enumerate(texts)}
    row = decontamination.digests(out).where("n_items > 1").first()
    names = ",".join(sorted(map(str, got[row["doc_id"]][2])))
    assert row["items_sha256"] == hashlib.sha256(names.encode()).hexdigest() and row["contaminated"]


def test_decontamination_of_nothing(documents, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    row = decontamination.decontaminate(documents(["a b"]), none).first()
    assert (row["n_words"], row["n_hit"], row["items"]) == (2, 0, [])
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontamination.decontaminate(documents([]), some).count() == 0


# --- 10


def plain_marginals(logit, change):
    n = len(logit)
    weight = {}
    for k in range(2**n):
        y = [k >> i & 1 for i in range(n)]
        weight[tuple(y)] = np.exp(sum(a for a, b in zip(logit, y) if b) + sum(change[a, b] for a, b in zip(y, y[1:])))
    total = sum(weight.values())
    return [sum(w for y, w in weight.items() if y[i]) / total for i in range(n)]


def test_marginals():
    rng = np.random.default_rng(1)
    sizes = [1, 2, 5, 7, 3, 1]
    logit, change = rng.normal(size=sum(sizes)) * 2, rng.normal(size=(2, 2))
    row = np.concatenate([[0], np.cumsum(sizes)])
    got = line_quality.marginals(logit, row, change)
    want = [plain_marginals(logit[a:b], change) for a, b in zip(row[:-1], row[1:])]
    assert np.allclose(got.good, np.concatenate(want))
    assert np.isclose(got.pairs.sum(), sum(s - 1 for s in sizes))


def test_lines():
    t = next(_text.texts(pa.array(["ab cd\n\nAB!! x|y", None, "", "one two three four\none two three four\n"])))
    x = line_quality.lines(t)
    assert np.diff(x.row).tolist() == [3, 1, 1, 3] and x.weight.tolist() == [6, 1, 9, 1, 1, 19, 19, 1]
    assert x.figures[2, 2] == 0.5 and x.figures[6, 9] == 1 and x.figures[5, 9] == 0 and x.figures[1, 21] > 0 == x.figures[0, 21]


def quality_documents(spark, folder):
    shipped = queries.shipped(spark)
    return (shipped.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = quality_documents(spark, folder)
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = queries.QUERIES["op10_line_quality"](spark, folder).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1
    held = [(known[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in known]
    assert len(held) > 500 and np.mean([a == b for a, b in held]) > 0.98


def test_lines_of_a_mixed_text_are_told_apart(documents, spark):
    """Only documents are labelled, each of one kind; a junk line among good ones is found all the same."""
    rng = random.Random(6)
    good = lambda: " ".join(rng.choice("the house stood near water and nobody went there again that year".split()) for _ in range(12)) + "."
    junk = lambda: " ".join(rng.choice(["BUY!!", "### $$$", "CLICK!!", "%%% ***", "WIN!!"]) for _ in range(12))
    texts = ["\n".join(good() for _ in range(rng.randint(3, 9))) for _ in range(60)]
    texts += ["\n".join((good if rng.random() < 0.2 else junk)() for _ in range(rng.randint(3, 9))) for _ in range(60)]
    labels = spark.createDataFrame([(k, int(k < 60)) for k in range(120)], "doc_id long, quality int")
    model = line_quality.train(documents(texts), labels)
    mixed = [good(), good(), junk(), good(), junk(), junk(), good(), good()]
    row = line_quality.classify(documents(["\n".join(mixed)]), model).first()
    assert [p >= 0.5 for p in row["lines"]] == [True, True, False, True, False, False, True, True]
    # In bad documents the good lines are found, though their label says bad.
    rows = line_quality.classify(documents(texts[60:]), model).collect()
    said = [(line[0].islower(), p >= 0.5) for r in rows for line, p in zip(r["text"].split("\n"), r["lines"])]
    assert np.mean([a == b for a, b in said]) > 0.95 and 20 < sum(a for a, _ in said)


def test_training_is_bounded(documents, spark, monkeypatch):
    """An id that repeats, in documents and labels, brings no more than the sample to the driver."""
    seen = []
    fit = line_quality.fit
    monkeypatch.setattr(line_quality, "fit", lambda x, label: seen.append((len(label), len(x.weight))) or fit(x, label))
    texts = ["A plain line.\nAnd more."] * 300 + ["### $$$\n!!!"] * 40
    df = documents(texts, [1] * 300 + list(range(2, 42)))
    labels = spark.createDataFrame([(1, 1)] * 3 + [(k, 0) for k in range(2, 42)], "doc_id long, quality int")
    line_quality.train(df, labels, sample=25)
    line_quality.train(df, labels, sample=25, most=20)
    assert seen == [(50, 100), (20, 40)]


def test_quality_of_odd_rows(documents, spark):
    good, bad = "A plain line of words.\nAnd one more.", "### %%% $$$\n!!! ### ***"
    df = documents([good, bad] * 6 + [None, "", good], SCORE=["x"] * 15)
    labels = spark.createDataFrame([(k, (k + 1) % 2) for k in range(12)] + [(None, 1), (3, None), (99, 0)], "doc_id long, quality int")
    out = line_quality.classify(df, line_quality.train(df, labels))
    assert out.columns == ["doc_id", "text", "score", "lines"]
    rows = out.orderBy("doc_id").collect()
    assert all((r["score"] >= 0.5) == (k % 2 == 0) for k, r in enumerate(rows[:12]))
    assert rows[12]["score"] == rows[13]["score"] and len(rows[0]["lines"]) == 2
    none = line_quality.train(df, labels.limit(0))
    assert {r["score"] for r in line_quality.classify(df, none).collect()} == {0.5}
    one = line_quality.train(df, labels.where("quality = 1"))
    assert {r["score"] for r in line_quality.classify(df, one).collect()} == {1.0}
    assert line_quality.classify(df.limit(0), none).count() == 0


# --- pipeline


def test_stages_against_plain_versions(spark, folder):
    docs, labels = quality_documents(spark, folder)
    rows = docs.collect()
    good = corpus_pipeline.good_documents(spark, docs, folder)
    assert good.columns == docs.columns
    model = line_quality.train(docs, labels.where("crc32(cast(doc_id AS string)) % 5 != 0").select("doc_id", "quality"))
    scores = {r["doc_id"]: r["score"] for r in line_quality.classify(docs, model).collect()}
    assert {r["doc_id"] for r in good.collect()} == {i for i, s in scores.items() if s >= 0.3}

    single = corpus_pipeline.one_of_each(spark, docs, folder)
    classes = plain_join([r["doc_id"] for r in rows], [r["text"] for r in rows])
    assert single.columns == docs.columns
    assert {r["doc_id"] for r in single.collect()} == {i for i, c in classes.items() if c[0] == i}

    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = corpus_pipeline.without_benchmark(spark, docs, folder)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in rows if not plain_hits(r["text"], items)[1]}


def test_last_stage_and_whole_run(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    ranks = byte_bpe.ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert 0 < len(out) < len(texts)
    for r in out:
        assert r["text"] == texts[r["doc_id"]] and r["n_tokens"] == len(r["ids"])
        assert byte_bpe.decoded(ranks, np.array(r["ids"], np.int64)).tobytes().decode() == r["text"]


def test_stages_keep_clashing_columns_and_null_rows(documents, spark, folder):
    df = documents(["A b c d e f.", None, "A b c d e f."], [5, 6, None], score=["s"] * 3, Items=["t"] * 3, n_hit=["u"] * 3)
    for stage in (corpus_pipeline.good_documents, corpus_pipeline.one_of_each, corpus_pipeline.without_benchmark):
        out = stage(spark, df, folder)
        assert out.columns == df.columns and {r["score"] for r in out.collect()} <= {"s"}
    assert corpus_pipeline.one_of_each(spark, df, folder).count() == 2  # a copy without doc_id goes
    assert corpus_pipeline.encoded(spark, df, folder).columns == ["doc_id", "score", "Items", "n_hit", "ids", "text", "n_tokens"]


def test_stages_send_each_text_to_python_once(documents, spark, folder):
    df = documents(["A b c d e f.", None], more=["x", "y"])
    for name, stage in corpus_pipeline.STAGES:
        if name == "ngram_jaccard_join":  # reads texts it has written
            continue
        text = plan(stage(spark, df, folder)).split("== Physical Plan ==")[1]
        assert text.count("MapInArrow") == 1 and not re.search(r"AS _(scored|searched)#", text), text


def test_one_of_each_goes_by_rows(documents, spark, folder):
    a, b, c = ("the first text of five words", "some other text of six words", "a third one that is not alike")
    rows = [(7, a), (7, a), (3, a), (None, a), (None, b), (None, b), (9, c), (9, a), (8, c), (11, None), (12, "")]
    df = documents([t for _, t in rows], [i for i, _ in rows], _row=[str(k) for k in range(len(rows))])
    out = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, df, folder)
    assert out.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert got == sorted([(3, a), (None, b), (8, c), (11, None), (12, "")], key=repr)
