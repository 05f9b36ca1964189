from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratamill.llm import pages
from stratamill.llm.pages import blocks_of, covered, main_texts, page_texts

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="has-sidebar"><nav><ul><li><a href="/x">Menu</a></ul></nav><!-- <p>gone</p> --><header>Head</header>
<div class="ad">Buy</div><article><h1>Title &amp; more</h1><p>First<b> bold</b>&nbsp;text
 with   space<br>and break<p>Second &lt;tag&gt; &#233;<div class="cookie-notice">OK?</div>
<form><input value="x"><p>Sign up</form><ul><li>one<li>two</ul><aside>Side</aside>tail
<div id="readerComments"><p>comment</p></div></article><footer>&copy; us</footer></body></html>"""


def test_article_without_what_surrounds_it():
    assert main_texts([blocks_of(ARTICLE)]) == [
        "Title & more\nFirst bold text with space and break\nSecond <tag> é\none\ntwo\ntail"
    ]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("<main><p>a</p></main><p>b", "a"),
        ("<main>x<article>y</article></main>", "y"),
        ("<article class='comment'>no</article><p>yes", "yes"),
        ("a < b <<i>c", "a < b <c"),
        ("<article><p hidden>x</p>y<script>z", "y"),
        ("<article>&amp;lt; &unknown; &#x1F600;</article>", "&lt; &unknown; \U0001f600"),
        ("<article><table><tr><td>1</td><td>2</td></tr><tr><td>3</table></article>", "1 2\n3"),
        ("<div title='a>b'>quoted</div>", "quoted"),
    ],
)
def test_markup(html, text):
    assert main_texts([blocks_of(html)]) == [text]


def test_host_decides_where_structure_says_nothing():
    menu = "Home About Contact Products Services News Jobs Help Login"
    site = [f"<div>{menu}</div><div>Story {i} is about {i * 7} things</div><div>{menu} {i}</div>" for i in range(4)]
    assert main_texts([blocks_of(p) for p in site]) == [f"Story {i} is about {i * 7} things\n{i}" for i in range(4)]
    # Copies of one page are one page, and say nothing about each other.
    copies = [site[0]] * 5
    assert main_texts([blocks_of(p) for p in copies]) == [f"{menu}\nStory 0 is about 0 things\n{menu} 0"] * 5


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=15), min_size=1, max_size=6), st.integers(2, 5))
def test_covered_equals_counting_runs(streams, run):
    streams = [np.array(s, np.int64) for s in streams]
    runs = [{tuple(s[i : i + run]) for i in range(len(s) - run + 1)} for s in streams]
    often = {r for r, n in Counter(r for found in runs for r in found).items() if n >= 2}
    for s, mask in zip(streams, covered(streams, run, 2), strict=True):
        want = np.zeros(len(s), bool)
        for i in range(len(s) - run + 1):
            if tuple(s[i : i + run]) in often:
                want[i : i + run] = True
        assert mask.tolist() == want.tolist()


def test_every_row_once_whatever_the_shards(spark, monkeypatch):
    monkeypatch.setattr(pages, "SHARD_PAGES", 3)
    rows = [(i, f"http://{'hot' if i % 2 else i}.org/{i}", ARTICLE.replace("Title", f"T{i}"), 1, "x") for i in range(40)]
    rows += [(100, None, None, 1, "x"), (None, "no url", "<p>text", 1, "x"), (7, rows[7][1], rows[7][2], 1, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, shard int, host string")
    found = page_texts(frame).collect()
    assert Counter((r["page_id"], r["url"]) for r in found) == Counter(r[:2] for r in rows)
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts[5].startswith("T5 & more\n") and texts[100] == "" and texts[None] == "text"
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert page_texts(frame.limit(0)).count() == 0


def test_an_article_card_does_not_silence_the_text_around_it():
    story = " ".join(f"own{i}" for i in range(30))
    html = f"<div>{story}</div><article class='card'>Read this next</article>"
    assert main_texts([blocks_of(html)]) == [f"{story}\nRead this next"]
    html = f"<main><p>{story}</p><article>Read this next</article></main>"
    assert main_texts([blocks_of(html)]) == [f"{story}\nRead this next"]
    # What the host's pages share does not count for it.
    menu = "Home About Contact Products Services News Jobs Help Login"
    site = [f"<div>{menu}</div><article>Story {i}</article>" for i in range(4)]
    assert main_texts([blocks_of(p) for p in site]) == [f"Story {i}" for i in range(4)]


def test_runs_are_counted_over_the_whole_host(spark, monkeypatch):
    monkeypatch.setattr(pages, "SHARD_PAGES", 2)
    shared = "a passage of more than eight words on three pages"
    site = [f"<p>{' '.join(f'w{i}x{k}' for k in range(12))}</p>" + (f"<p>{shared}</p>" if i % 20 == 0 else "") for i in range(60)]
    site += [site[0]] * 40
    frame = spark.createDataFrame([(i, "http://one.org/", html) for i, html in enumerate(site)], "page_id int, url string, html string")
    found = {r["page_id"]: r["text"] for r in page_texts(frame).collect()}
    assert [found[i] for i in range(len(site))] == main_texts([blocks_of(p) for p in site])
    assert not any(shared in text for text in found.values())


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div class='page has-sidebar'><article>all of it</article></div>", "all of it"),
        ("<article class='post category-search tag-social'>all of it</article>", "all of it"),
        ("<main class='search-results'>all of it</main>", "all of it"),
        ("<main class='search'>all of it</main>", "all of it"),
        ("<form><div class='widget'>with this<article>all of it</article></div></form>", "all of it"),
        ("<div class='sidebar'><article>card</article></div><article>real</article>", "real"),
        ("<div id='comments'><article>no</article></div><p>yes", "yes"),
        ("<article>x <span class='ad'>no</span> y</article>", "x\ny"),
        ("<article>x <math><mi>y</mi></math></article>", "x y"),
    ],
)
def test_names_do_not_silence_the_article(html, text):
    assert main_texts([blocks_of(html)]) == [text]


def test_the_host_decides_about_doubtful_names():
    shared = "the same eight words or more on every page"
    site = [
        f"<article>a{i}<section id='discussion'>{' '.join(f'd{i}x{k}' for k in range(9))}</section>"
        f"<div class='social'>{shared}</div></article>"
        for i in range(3)
    ]
    assert main_texts([blocks_of(p) for p in site]) == [f"a{i}\n" + " ".join(f"d{i}x{k}" for k in range(9)) for i in range(3)]


def test_extras_in_an_article_go_and_its_heading_stays():
    html = """<article><header><h1>A <b>Title</b></h1><p>by someone</p><nav><h2>Menu</h2></nav></header><p>Body text.</p>
    <div class="user-comment-body">A reader wrote</div><div class="related-posts">More posts</div>
    <div class="post-share-buttons">Share</div><div class="ad-slot-300">Buy now</div>
    <div class="site-notices">We use things</div><p>End.</p></article>"""
    assert main_texts([blocks_of(html)]) == ["A Title\nBody text.\nEnd."]
    assert main_texts([blocks_of("<header><h1>Site</h1></header><article>x</article>")]) == ["x"]
    assert main_texts([blocks_of("<aside><article><header><h1>no</h1></header></article></aside><p>y")]) == ["y"]


@pytest.mark.parametrize("names", ["has-sidebar", "no-ads", "layout-sidebar-right", "tag-social category-search", "with-menu"])
def test_names_of_states_and_layouts_exclude_nothing(names):
    assert main_texts([blocks_of(f"<div class='{names}'><p>All of this stays.</p></div>")]) == ["All of this stays."]


def test_a_named_box_around_the_article_is_no_boilerplate():
    html = "<div class='widget-page'><article>Kept.</article></div><div class='widget-page'>Gone.</div>"
    assert main_texts([blocks_of(html)]) == ["Kept."]
