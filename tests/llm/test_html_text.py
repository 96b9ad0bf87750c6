"""Markup, references and blocks of single pages; repeats of a host against plain comparison."""

import html
import re
from collections import Counter

import numpy as np
import pytest

from eventloom.llm import html_text
from eventloom.llm.catalog import QUERIES


def text(page):
    return " ".join(html_text.blocks(page)[1])


@pytest.mark.parametrize(
    "page, expected",
    [
        ("", ""),
        ("plain & simple", "plain & simple"),
        ("<p>a<b>b</b>c</p>", "abc"),
        ("<p>one<p>two<br>three<div>four</div>", "one two three four"),
        ("<article>&lt;p&gt; &amp;amp; &#233;&#x65E5; &copy &nbsp; x &bogus; &am</article>", "<p> &amp; é日 © x &bogus; &am"),
        ("<nav>menu</nav><article><header><h1>T</h1></header><p>body<footer>share</footer></article><footer>f</footer>", "T body"),
        ("<header>top</header><main><p>main text</main><aside>side</aside>", "main text"),
        ("<body><div class='ad'>buy <div>nested</div> now</div><p>text</p>", "text"),
        ("<p>a</p><script>var s = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>b", "a b"),
        ("<p>a</p><script>never closed <p>x", "a"),
        ("<p>a</p><!-- never closed <p>x", "a"),
        ("<p title='a > b'>x</p><p title=\"unclosed>y</p>", "x y"),
        ("<article><p>story</p><section id=comments><article class=comment>me too</article></section></article>", "story"),
        ("<article><form>mail <input> <button>send</button></form><p>x</p><div class='cookie-notice'>ok?</div></article>", "x"),
        ("<ul><li><a href=/>Home</a><li><a href=/n>News</a></ul><p>A text with <a href=/x>a link</a> in it.</p>", "A text with a link in it."),
        ("<body class='with-sidebar'><div class='content no-menu'>kept</div></body>", "kept"),
        ("<div hidden>x</div><div style='display: none'>y</div><div aria-hidden=true>z</div><p>w", "w"),
        ("<article>1 < 2 and <3 </article>", "1 < 2 and <3"),
        ("<title>t</title><textarea><p>x</textarea><svg><text>y</text></svg><p>z", "z"),
        ("<ARTICLE><P>Upper</P></ARTICLE><P>out", "Upper"),
        ("</div></p></article>stray<p>x</nav>y", "stray x y"),
    ],
)
def test_pages(page, expected):
    assert text(page) == expected


def test_deep_and_long_pages_take_time_in_proportion():
    assert text("<b>" * 50_000 + "x" + "<div>" * 50_000 + "y") == "x y"
    assert text("<p>" + "'\"<" * 100_000).startswith("'\"<")
    assert len(text("<article>" + "<p>word " * 200_000)) == 200_000 * 5 - 1


def rng_words(rng, n):
    return " ".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 4).tobytes().decode("utf-32-le") for _ in range(n))


def site(rng, wrap):
    """Pages of a host with one boilerplate text each side, copies, and a passage that some share."""
    top, end, passage = rng_words(rng, 30), rng_words(rng, 20), rng_words(rng, 60)
    stories = [rng_words(rng, 150) for _ in range(40)]
    stories[3] = stories[2]
    stories[5] = stories[4] + " changed"
    for k in (6, 7, 8):
        stories[k] += " " + passage
    return [(k, f"http://h.org/{k}", wrap(f"<p>{top}</p>", f"<p>{s}</p>", f"<p>{end}</p>"), s) for k, s in enumerate(stories)]


@pytest.mark.parametrize("form", ["<body>{}{}{}</body>", "<article>{}{}{}</article>"])
def test_repeats_of_a_host_go_and_copies_stay(spark, form):
    pages = site(np.random.default_rng(5), form.format)
    others = [(100 + k, f"http://other{k}.org/", p[2], None) for k, p in enumerate(pages[:2])]
    table = spark.createDataFrame([p[:3] for p in pages + others], "page_id bigint, url string, html string").repartition(7)
    got = {r["page_id"]: r["text"] for r in html_text.extract(table).collect()}
    assert all(got[k] == s for k, _, _, s in pages)
    plain = lambda page: " ".join(re.sub("<[^>]*>", " ", page).split())
    assert [got[100], got[101]] == [plain(p[2]) for p in pages[:2]]  # hosts of one page repeat nothing


def test_sampled_suffixes_meet_in_every_long_repeat():
    rng = np.random.default_rng(2)
    least = html_text.DEPTH + html_text.STEP - 1
    for _ in range(300):
        shared = rng_words(rng, least)
        a = html_text.Suffixes([f"{rng_words(rng, int(rng.integers(0, 9)))} {shared} {rng_words(rng, 3)}".strip()])
        b = html_text.Suffixes([f"{rng_words(rng, int(rng.integers(0, 9)))} {shared} {rng_words(rng, 3)}".strip()])
        assert set(a.keys.tolist()) & set(b.keys.tolist())


def test_counts_of_intervals(spark):
    """Sampled suffixes and the pages that hold them, against one dictionary."""
    pages = site(np.random.default_rng(6), "<body>{}{}{}</body>".format)
    expected = Counter()
    for k, _, page, _ in pages:
        expected.update((k % 2, key) for key in set(html_text.Suffixes(html_text.blocks(page)[1]).keys.tolist()))
    table = spark.createDataFrame([(p[0] % 2, p[2]) for p in pages], "host bigint, html string").repartition(6)
    got = html_text.intervals(table).groupBy("host", "key").sum("n").collect()
    assert {(r[0], r[1]): r[2] for r in got} == dict(expected)


def test_query(spark, odd, pages):
    got = QUERIES["op13_html_text"](spark, odd)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    expected = Counter()
    for p in pages:
        inside = re.search(r"(?s)<article>(.*)</article>", p["html"] or "")
        inside = inside[1] if inside else p["html"] or ""
        plain = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inside)))
        plain = " ".join(plain.split())
        expected[(p["page_id"], p["url"], plain, len(plain))] += 1
    assert Counter(map(tuple, got.collect())) == expected
