import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from etalage.llm import html_extract, queries
from etalage.llm.html_extract import blocks, repeated
from tests.conftest import SF


def main_text(page):
    found = blocks(page)
    best = next((role for role in ("main", "named", "open") if any(r == role for r, _ in found)), "open")
    return " ".join(t for r, t in found if r == best)


CASES = [
    ("<article><h1>T &amp; U</h1><p>one\n\t two</p><p>three</p></article>", "T & U one two three"),
    ("<body><nav>m</nav><article><p>x<nav>in</nav>y</p></article><footer>f</footer>", "x y"),
    ("<article><p>a<b>b</b>c <i>d</i>e</p></article>", "abc de"),
    ("<article><p><b>open<br><p>next</p></article>", "open next"),
    ("<article><div class='ad'>no</div><p>yes</p><section id=comments><p>first!</p></section></article>", "yes"),
    ("<article><p class=ad>no<p>yes</article>", "yes"),
    ("<div role=navigation>m</div><main>x</main>", "x"),
    ("<article>x<script>var t='</p><p>no';</script>y<style>p{}</style>z</article>", "xyz"),
    ("<article>cut off &am", "cut off &am"),
    ("<article>cut <p", "cut"),
    ("<article>a &lt;p&gt; &#233;&#x41; &nbsp; &copy; b</article>", "a <p> éA © b"),
    ("<article>3 < 4 and 5 > 4</article>", "3 < 4 and 5 > 4"),
    ("<!-- <article>no</article> --><article>yes<!-- x --></article>", "yes"),
    ("<article><form>f<input>g</form><ul><li>one<li>two</ul><table><tr><td>c<td>d</table></article>", "one two c d"),
    ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
    ("<ARTICLE><P>up</P></ARTICLE>", "up"),
    ("<article></p>x</div>y</article>z", "x y"),
    ("<article><header>h</header><p>x</p><aside>s</aside></article><article><p>y</p></article>", "x y"),
    ("<article><p title=\"a > b\">x</p></article>", "x"),
    ("plain", "plain"),
    ("<div>top</div><div id='content'><p>x</p><div class='sidebar'>s</div><p>y</p></div><p>end</p>", "x y"),
    ("<div class='post'><article>x</article><p>y</p></div>", "x"),
    ("<div class='content-ad'>no</div><div>yes</div>", "yes"),
    ("<div role=main>x</div>y", "x"),
    ("", ""),
    ("<article></article>", ""),
    ("<div class='layout with-sidebar'><main>x y</main></div>", "x y"),
    ("<div class='page sidebar'><div class=sidebar>s</div><main>x y</main></div>", "x y"),
    ("<form><article>a b</article></form>", "a b"),
    ("<form id=all><div class=content>x</div><div class=sidebar>s</div></form>", "x"),
    ("<article><form><p>f</p></form>x</article>", "x"),
    ("<article><div class='social-history'>h</div>t</article>", "h t"),
    ("<article><pre><span class='comment'># c</span> code</pre></article>", "# c code"),
    ("<article>yes <b hidden>no</b> yes</article>", "yes yes"),
    ("<div class='page sidebar'><article>A</article><div class='comments'><article>c</article></div></div>", "A"),
    ("<article>real</article><div class='related'><article>tease</article></div>", "real"),
    ("<aside><article>tease</article></aside><article>real</article>", "real"),
    ("<div class='siteHeader'>h</div><div class='article__sidebar'>s</div><main>x</main>", "x"),
    ("<main>x<div class='ad-300x250'>a</div><div class='cookie-policy-banner'>b</div><div class='comment-list'>c</div></main>", "x"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_blocks(page, text):
    assert main_text(page) == text


def test_very_long_and_deep_pages():
    assert main_text("<article>" + "<div>x</div>" * 20_000 + "</article>") == " ".join("x" * 20_000)
    assert main_text("<article>" + "<div>" * 3_000 + "deep") == "deep"


def by_hand(pages, length):
    """Tokens in a run of ``length`` that another page has as well."""
    runs = {}
    for p, words in enumerate(pages):
        for i in range(len(words) - length + 1):
            runs.setdefault(tuple(words[i : i + length]), set()).add(p)
    out = []
    for words in pages:
        own = [False] * len(words)
        for i in range(len(words) - length + 1):
            if len(runs[tuple(words[i : i + length])]) > 1:
                own[i : i + length] = [True] * length
        out += own
    return out


@pytest.mark.parametrize("length", [1, 2, 4, 8])
def test_repeated_runs_by_brute_force(length):
    draw = random.Random(length)
    for _ in range(30):
        pages = [[draw.randint(0, 3) for _ in range(draw.randint(0, 40))] for _ in range(draw.randint(1, 6))]
        tokens = np.array([w for p in pages for w in p], np.int64)
        page = np.array([i for i, p in enumerate(pages) for _ in p], np.int64)
        assert repeated(tokens, page, length).tolist() == by_hand(pages, length)


def test_boilerplate_of_a_host_goes_from_pages_without_an_article(spark):
    words = [f"w{i}" for i in range(2000)]
    draw = random.Random(2)
    notice = " ".join(f"n{i}" for i in range(20))
    own = [" ".join(draw.sample(words, 30)) for _ in range(6)]
    rows = [(i, f"http://h.com/{i}", f"<div>{notice}</div><div>{own[i]}</div>", "t") for i in range(5)]
    # Another host has the notice once; an article keeps it.
    rows += [(5, "http://other.com/", f"<div>{notice}</div><div>{own[5]}</div>", "t"), (6, "http://h.com/a", f"<article>{notice}</article>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    for per_set in (512, 4):
        found = {r.page_id: r for r in html_extract.extract(pages, ["page_id"], pages_per_set=per_set).collect()}
        assert found[5].text == f"{notice} {own[5]}" and found[5].repeated_words == 0
        assert found[6].text == notice
        if per_set == 512:
            assert [found[i].text for i in range(5)] == own[:5] and found[6].repeated_words == 20


def test_runs_are_found_however_the_pages_of_a_host_are_dealt(spark):
    """Runs on two pages only, of a host of one set or of many: the same texts and counts, those by hand."""
    draw = random.Random(7)
    pages = [[f"w{draw.randint(0, 3000)}" for _ in range(40)] for _ in range(60)]
    for i in range(0, 60, 3):
        # Two pages of three share a run, of 15 (too short) to 24 words, at different places.
        run = [f"r{i}x{j}" for j in range(15 + i % 10)]
        pages[i][i % 7 : i % 7] = run
        pages[i + 1][20:20] = run
    covered = by_hand(pages, 16)
    want, at = {}, 0
    for i, words in enumerate(pages):
        own = covered[at : at + len(words)]
        at += len(words)
        want[i] = (" ".join(w for w, c in zip(words, own, strict=True) if not c), sum(own))
    assert any(n for _, n in want.values())
    rows = [(i, f"http://h.com/{i}", f"<div>{' '.join(w)}</div>") for i, w in enumerate(pages)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    for per_set, size in ((512, 16 << 20), (4, 16 << 20), (1, 16 << 20), (512, 1000)):
        found = html_extract.extract(docs, ["page_id"], pages_per_set=per_set, bytes_per_set=size).collect()
        assert {r.page_id: (r.text, r.repeated_words) for r in found} == want


@pytest.mark.parametrize(("frame", "own"), [(21, 5), (150, 40), (60, 200)])
def test_frames_go_whatever_their_share(spark, frame, own):
    """Six pages with one frame around short articles: only the articles are left."""
    notice = " ".join(f"n{i}" for i in range(frame))
    articles = [" ".join(f"a{i}w{j}" for j in range(own)) for i in range(6)]
    rows = [(i, f"http://h.com/{i}", f"<div>{notice}</div><div>{a}</div>") for i, a in enumerate(articles)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for per_set in (512, 2):
        found = {r.page_id: r.text for r in html_extract.extract(pages, ["page_id"], pages_per_set=per_set).collect()}
        assert [found[i] for i in range(6)] == articles


def test_similarity_of_copies_by_hand():
    draw = random.Random(3)
    for _ in range(200):
        n = draw.randrange(0, 60)
        own = [draw.random() < 0.95 for _ in range(n)]
        shared = sum(all(own[i : i + 5]) for i in range(n - 4))
        total = max(n - 4, 1)
        assert html_extract.is_copy(np.array(own, bool), 0.8) == (shared > 0 and shared / (2 * total - shared) >= 0.8)


def test_copies_of_a_page_are_kept(spark):
    """What repeats is nearly all of the page: no frame around it, but the same article under two addresses."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"http://h.com/{i}", f"<p>{text}</p><p>{'x' * i} own</p>") for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in html_extract.extract(pages, ["page_id"]).collect()}
    assert all(found[i].text.startswith(text) and found[i].repeated_words == 60 for i in range(3))


def test_nulls_empties_repeats_and_clashing_names(spark):
    page = "<article>same page</article>"
    rows = [(1, None, page), (1, None, page), (None, "no scheme", None), (2, "http://a.b/", "")]
    pages = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, set int")
    found = html_extract.extract(pages, ["page_id", "host", "set"])
    assert found.columns == ["page_id", "host", "set", "text", "repeated_words"]
    got = sorted(((r.page_id, r.text) for r in found.collect()), key=str)
    assert got == sorted([(1, "same page"), (1, "same page"), (None, ""), (2, "")], key=str)
    assert html_extract.extract(pages.where("false"), ["page_id"]).count() == 0


def test_query(spark):
    found = queries.QUERIES["op8_html_extract"](spark, SF)
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == main_text(pages[r.page_id]) and r.n_chars == len(r.text)
    assert found.select(F.max("n_chars")).first()[0] > 0
