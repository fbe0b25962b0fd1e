"""Ranked search, spelling variants and main text: against brute force, and with odd input."""

from __future__ import annotations

import html
import math
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle import connect
from pyspark.sql import functions as F

from spendlake.llm import boosting, dom, html_extract, layouts, lexical_search, spelling
from spendlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


# --- ranked search


def best_by_hand(docs, items, top=50):
    """(item, rank, id, score) of rows (id, text) as the formula is written."""
    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    terms = lambda text: term.findall((text or "").translate(LOWER))
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    sizes = [sum(bag.values()) for _, bag in bags]
    count, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for (doc_id, bag), n in zip(bags, sizes):
            m = 100 - 50 + (50 * n * count) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in set(terms(text))
                if t in bag
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


ODD_DOCS = [
    (1, "Red fish, blue fish."),
    (1, "Red fish, blue fish."),
    (2, ""),
    (3, None),
    (None, "blue Éclair éclair x²"),
    (None, None),
    (4, "red " * 5000 + "sea"),
    (5, "!!! ???"),
    (6, "blue"),
    (7, "BLUE"),
    (8, "42 \U0001f600 blue \x00 red"),
]
ODD_ITEMS = [(1, "red blue"), (1, "red blue"), (1, "éclair"), (2, None), (3, "?"), (None, "Fish 42"), (4, "nothing here")]


def test_search_of_odd_rows(spark):
    docs = spark.createDataFrame([(*r, "x", "y") for r in ODD_DOCS], "doc_id long, text string, item_id string, score string").repartition(3)
    items = spark.createDataFrame([(*r, 1) for r in ODD_ITEMS], "item_id long, text string, k_item int")
    for top, owners in ((50, 3), (2, 1), (1, 5)):
        rows = lexical_search.ranked(docs, items, top=top, owners=owners).collect()
        assert sorted(((r["item"], r["rank"], r["id"], r["score"]) for r in rows), key=repr) == best_by_hand(ODD_DOCS, ODD_ITEMS, top)
    assert lexical_search.ranked(docs.limit(0), items).count() == 0
    assert lexical_search.ranked(docs, items.limit(0)).count() == 0


def test_search_in_groups_of_items_and_many_bundles(spark, monkeypatch):
    docs = connect(SF).execute("SELECT doc_id, text FROM documents").fetchall()
    items = connect(SF).execute("SELECT item_id, text FROM benchmark").fetchall()
    monkeypatch.setattr(lexical_search, "PAIRS", 100)
    monkeypatch.setattr(lexical_search, "BUNDLE", 2)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = lexical_search.ranked(frame, spark.createDataFrame(items[:12], "item_id long, text string"), top=7).collect()
    assert sorted(((r["item"], r["rank"], r["id"], r["score"]) for r in rows), key=repr) == best_by_hand(docs, items[:12], 7)


# --- spelling


def variants_by_hand(docs):
    words = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            words[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {word: n for word, n in words.items() if len(word) >= 7 and n >= 2}
    near, holes = defaultdict(set), defaultdict(set)
    for word in words:
        for at in range(len(word)):
            holes[word[:at], word[at + 1 :]].add(word)
    for (left, right), held in holes.items():
        for word in held:
            near[word] |= held - {word}
            if left + right in words:
                near[word].add(left + right)
                near[left + right].add(word)
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda w: (-words[w], w), default=None)
        form[word] = best if best and words[best] >= 10 * n else None
    out = set()
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        out.add((word, form[word], root, n, len(near[word]), words[form[word]] if form[word] else None))
    return out


def as_set(found):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()}


@pytest.mark.parametrize("leaf_words", [20_000, 40])
def test_spelling_agrees_with_brute_force(spark, leaf_words):
    docs = connect(SF).execute("SELECT doc_id, text FROM documents").fetchall()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert as_set(spelling.variants(frame, leaf_words=leaf_words)) == variants_by_hand(docs)


def test_spelling_of_odd_rows(spark):
    long = "ab" * 3000
    texts = [
        "Receive receive RECEIVE receive receive receive receive receive receive receive recieve recieve receve receve receives receives",
        f"{long} {long} {long}c {long}c {long[1:]} {long[1:]}",
        "naïveté naïveté naivety naivety Élégance Élégance élégance élégance übergröße übergröße übergrößen übergrößen ÷×÷×÷×÷ ÷×÷×÷×÷",
        "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaab aaaaaab baaaaaa baaaaaa short short once1234567",
        "receive " * 200 + "recéive recéive",
        "кириллица кириллица wordwordж wordwordж",
    ]
    docs = [*enumerate(texts, 1), (1, texts[0]), (None, texts[3]), (7, None), (8, ""), (None, None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, word string, n int").repartition(4)
    want = variants_by_hand(docs)
    assert {"receives", "recieve", "recéive", long} <= {row[0] for row in want}
    assert as_set(spelling.variants(frame)) == want
    # One word to a sub-trie, and anagrams dealt out by hash.
    assert as_set(spelling.variants(frame, leaf_words=1)) == want
    assert spelling.variants(frame.limit(0)).count() == 0


def test_anagrams_of_one_leaf(spark):
    letters = np.random.default_rng(3)
    words = sorted({"".join(letters.permutation(list("streaming"))) for _ in range(300)} | {"streamingx", "streamin", "streamjng", "streamwng"})
    docs = [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(words))]
    assert as_set(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"), leaf_words=7)) == variants_by_hand(docs)


def test_is_near():
    assert spelling.is_near(b"abc", b"abd") and spelling.is_near(b"abc", b"abcd") and spelling.is_near(b"xabc", b"abc") and spelling.is_near(b"ac", b"abc")
    assert not any(spelling.is_near(a, b) for a, b in [(b"abc", b"abc"), (b"abc", b"acb"), (b"abc", b"abcde"), (b"abcd", b"bcde")])


# --- main text


@pytest.fixture(scope="module")
def forest():
    return html_extract.trained()


def extract(forest, source):
    return html_extract.extracted([dom.parse(source)], forest)[0]


def test_main_text_of_the_given_pages(spark):
    rows = {r.page_id: r for r in QUERIES["op11_main_text"].run(spark, SF).collect()}
    pages = connect(SF).execute("SELECT page_id, url, html FROM pages").fetchall()
    assert len(rows) == len(pages)
    for page_id, url, source in pages:
        body = re.search("<article>(.*?)</article>", source, re.S)[1].replace("<br>", " ").replace("<b>", "").replace("</b>", "")
        blocks = [" ".join(html.unescape(part).split()) for part in re.split("</?(?:p|h1)>", body)]
        want = "\n\n".join(block for block in blocks if block)
        assert (rows[page_id].url, rows[page_id].text, rows[page_id].n_chars) == (url, want, len(want))


def test_trees_on_held_out_layouts(forest):
    rows, labels = html_extract.labelled_nodes(range(200))
    assert ((forest.probability(rows) > 0.5) == labels).mean() > 0.98
    same = 0
    for seed in range(200):
        page = dom.parse(layouts.Layout(seed).page())
        same += extract(forest, layouts.Layout(seed).page()) == dom.text_of(page, [mark == 1 for mark in page.mark])
    assert same >= 170


SENTENCES = [
    "The river rose over night and the lower town was cut off for two days, said the mayor.",
    "Volunteers brought bread and blankets; nobody was hurt. More rain is expected by Sunday.",
    "A new bridge has been planned for years, but the money went elsewhere.",
]


@pytest.mark.parametrize(
    "page",
    [
        # A weblog with classes and reader comments.
        """<body><div id="header"><h2>My Weblog</h2><p>notes from a small town</p></div><ul class="menu"><li><a href=/>Home</a><li><a href=/a>About</a></ul>
        <div class="sidebar"><h3>Recent</h3><ul><li><a href=1>One day</a><li><a href=2>Another day</a></ul></div>
        <div class="post"><h1>Flood</h1><p>{0}</p><p>{1}<p>{2}</div>
        <div class="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>Thank you for this, I was there.</p></div><div class="comment"><b>Bob</b><p>Same here.</p></div>
        <form action="/c"><p>Leave a reply</p><textarea>type here</textarea><button>Send</button></form></div><div id="footer">&copy; 2020 My Weblog | <a href=/p>Privacy</a></div>""",
        # A news page of elements with a meaning.
        """<html><body><header><a href="/">The Daily</a><nav><a href="/w">World</a><a href="/s">Sport</a></nav></header><div class="cookie-consent"><p>We use cookies to improve your visit.</p>
        <button>Accept</button></div><main><article><h1>Flood</h1><p>{0}</p><div class="advert">Buy our boots. They are dry.</div><p>{1}</p><aside class="related"><h4>Related</h4><a href="/x">Last year's
        flood in pictures</a></aside><p>{2}</p></article><section class="comments"><p>First!</p><p>The bridge again, of course it is the bridge.</p></section></main>
        <aside><h3>Most read</h3><ol><li><a href="/1">Cat found</a></li><li><a href="/2">Dog found</a></li></ol></aside><footer><p>All rights reserved.</p></footer></body></html>""",
        # Unclosed, in capitals, with scripts and comments in it.
        """<HTML><BODY><NAV><A HREF="/">Start</A></NAV><ARTICLE><H1>Flood</H1><SCRIPT>if (a < b) document.write("<p>no</p>")</SCRIPT><P CLASS=lead>{0}
        <!-- <p>an advert</p> --><P>{1}<STYLE>p {{ color: red }}</STYLE><P>{2}<FOOTER>Contact us | Imprint</FOOTER>""",
    ],
)
def test_main_text_of_written_pages(forest, page):
    assert extract(forest, page.format(*SENTENCES)) == "\n\n".join(["Flood", *SENTENCES])


def test_blocks_and_references():
    page = dom.parse("<div>a<b>b</b>c &lt;i&gt;&nbsp;\n d<br>e<p>f<p>g</div>h<li>i<li>j<!-- x --><script>k</script>l<td>m &bogus; &amp;amp;")
    assert dom.text_of(page, [True] * len(page.tag)) == "abc <i> d e\n\nf\n\ng\n\nh\n\ni\n\njl\n\nm &bogus; &amp;"


def test_choice_never_contradicts_an_ancestor(forest):
    for seed in range(40):
        page = dom.parse(layouts.Layout(seed).page())
        rows, _ = dom.features([page])
        chosen = dom.decode(page, np.random.default_rng(seed).random(len(rows)))
        assert all(chosen[page.parent[i]] for i in range(1, len(chosen)) if chosen[i])


def test_main_text_of_odd_rows(spark, forest):
    deep = "<div>" * 3000 + "<p>" + SENTENCES[0] + "</p>"
    sources = [None, "", "   ", "plain text only", "<", "<p", "<!-- open", "<script>x", "</p></div>", "<p title=\"a>b\" class='", "\x00<p>\x00", deep, "<a " * 5000, "<!--" * 5000]
    rows = [(n, None if n == 3 else f"u{n}", source, "x", n) for n, source in enumerate(sources)]
    rows += [rows[3], (None, None, "<article><p>" + SENTENCES[1] + "</p></article>", "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, row int").repartition(3)
    found = html_extract.main_text(pages, forest=forest).collect()
    assert sorted((r.row.page_id or -1, r.row.row, r.row.text) for r in found) == sorted((r[0] or -1, r[4], "x") for r in rows)
    texts = {r.row.page_id: r.text for r in found}
    assert texts[0] == texts[1] == texts[2] == "" and texts[None] == SENTENCES[1]
    assert len(extract(forest, "<article>" + f"<p>{SENTENCES[2]}</p>" * 20_000 + "</article>")) == 20_000 * (len(SENTENCES[2]) + 2) - 2
    assert html_extract.main_text(pages.limit(0), forest=forest).count() == 0


def test_trees_learn_a_rule():
    rows = np.random.default_rng(0).random((2000, 4))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 2] > 0.3)).astype(float)
    assert ((boosting.fit(rows, labels, trees=20, depth=3).probability(rows) > 0.5) == labels).mean() > 0.97
    assert boosting.fit(rows, np.zeros(2000)).probability(rows).max() < 0.01
