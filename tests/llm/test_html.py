from __future__ import annotations

import re
from html import unescape

import pytest

from medoria.llm import html


def text(page):
    blocks, _ = html.parse(page)
    marked = any(main and not noise for _, _, noise, main in blocks)
    return "\n".join(t for t, _, noise, main in blocks if not noise and (main or not marked))


CASES = {
    "": "",
    "just text": "just text",
    "<p>a<p>b<br>c</p>d": "a\nb c\nd",
    "<article><h1>A &amp; B</h1><p><b>x.<br><p>y&nbsp;\n z</article><footer>no</footer>": "A & B\nx.\ny z",
    "<body><nav>menu</nav><div class='ad big'>buy</div><div class=add>keep</div><aside>s</aside></body>": "keep",
    "<script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes": "yes",
    "<article>a<div class='comments'>c</div><form>f</form><header><h1>t</h1></header></article>": "a\nt",
    "<header>h</header><main>m<nav>n</nav></main>": "m",
    "<article>one</article><article>two</article>": "one\ntwo",
    "<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>": "a\nb\nc\nd",
    "<p title='a > b'>x</p><p hidden>no</p><p style='display: none'>no</p>": "x",
    "<p>&lt;b&gt; &#233; &eacute &am</p>": "<b> é é &am",
    "<article><p>cut of": "cut of",
    "<p>a <em>b</em>c <a href=x>d</a></p></div></p>e": "a bc d\ne",
    "<P>Upper</P><SCRIPT>no</SCRIPT><p>case": "Upper\ncase",
    "1 < 2 and <3": "1 < 2 and <3",
    "<title>t</title><textarea>x</textarea><p>ok": "ok",
    "<div id=cookie-notice>c</div><div role=navigation>n</div><div class=sidebar>s</div>k": "k",
}


@pytest.mark.parametrize("page", CASES)
def test_parse(page):
    assert text(page) == CASES[page]


@pytest.mark.parametrize("name", ["content has-sidebar", "layout-no-sidebar", "comments-open", "market-share", "search-results"])
def test_wrappers_that_only_mention_noise_stay(name):
    for mark in ("article", "div"):
        assert text(f"<body><div class='{name}'><{mark}>story</{mark}></div><div class='left-sidebar'>s</div></body>") == "story"


def test_a_form_around_the_page_stays():
    assert text("<form><nav>n</nav><article>story</article><p>rest</p></form>") == "story"
    assert text("<form id=page><nav>n</nav><div>the story of the day</div><div class=ad>buy</div></form><p>end") == "the story of the day\nend"
    assert text("<p>the story of the day</p><form>your mail</form>") == "the story of the day"


def test_templates_of_a_site_go(spark):
    pages = []
    for k in range(12):
        own = f"<div class=story><p>story {k} of the day</p><p>and its end {k * 7}</p></div>"
        pages.append((k, f"http://Site.org/{k}", f"<body><div class=top>Welcome to us</div>{own}<div class=base>All rights</div></body>", 1))
    pages += [(100, "http://alone.org/", "<div class=top>Welcome to us</div>", 1), (101, None, None, 1), (101, None, None, 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text int")
    found = {r["page_id"]: r["text"] for r in html.main_text(df.repartition(3)).collect()}
    assert found == {
        **{k: f"story {k} of the day\nand its end {k * 7}" for k in range(12)},
        100: "Welcome to us",
        101: "",
    }
    rank = {r["path"]: r["importance"] for r in html.importance(html.parsed(df.selectExpr("page_id id", "url", "coalesce(html, '') html"))).where("host = 'site.org'").collect()}
    assert rank["/body/div.top"] == pytest.approx(0, abs=1e-9) and rank["/body/div.story/p"] == pytest.approx(0.9)


def test_copies_of_an_article_stay(spark):
    pages = [(k, "http://m.org/a", "<article><h1>Same</h1><p>text</p></article>") for k in range(9)]
    found = html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in found} == {"Same\ntext"} and len(found) == 9
    assert html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string").limit(0)).count() == 0


def test_given_pages(spark, sf_dir):
    """Articles cut out by their marks, with regular expressions only."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in html.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        parts = [unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", p))).split() for p in re.split("</?(?:h1|p)>", article)]
        assert found[r["page_id"]] == "\n".join(" ".join(p) for p in parts if p)


def extracted(spark, pages):
    return {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def story(k):
    return f"{WORDS[k % 10]} {k} went to {WORDS[k * 7 % 10]} and came back after {k * 13} days"


@pytest.mark.parametrize("n", [1, 4, 40])
def test_hosts_without_marks(spark, n):
    """Templates go from two pages on; of one page alone nothing can be told."""
    frame = "<body><div><p>Welcome to us</p></div><div class=text><p>{}</p></div><table><tr><td>All rights</table></body>"
    found = extracted(spark, [(k, f"http://h{n}.org/{k}", frame.format(story(k))) for k in range(n)])
    assert found == {k: story(k) if n > 1 else f"Welcome to us\n{story(k)}\nAll rights" for k in range(n)}


@pytest.mark.parametrize("n", [1, 4, 40])
def test_teasers_do_not_hide_the_story(spark, n):
    page = "<div class='post'>{}</div><div><article>Teaser</article></div>"
    found = extracted(spark, [(k, f"http://t{n}.org/{k}", page.format(story(k))) for k in range(n)])
    assert found == {k: story(k) if n > 1 else f"{story(k)}\nTeaser" for k in range(n)}
    plain = "<div>{}</div><div><article>Teaser</article></div>"
    found = extracted(spark, [(k, f"http://p{n}.org/{k}", plain.format(story(k))) for k in range(n)])
    assert all(story(k) in found[k] for k in range(n))


@pytest.mark.parametrize("n", [4, 100])
def test_boxes_inside_articles(spark, n):
    """A box that all articles of a site repeat goes once there are enough of them; their equal headings stay."""
    page = "<article><h1>Daily</h1><div>We value your privacy</div><p>{}</p></article>"
    found = extracted(spark, [(k, f"http://b{n}.org/{k}", page.format(story(k))) for k in range(n)])
    box = "" if n == 100 else "We value your privacy\n"
    assert found == {k: f"Daily\n{box}{story(k)}" for k in range(n)}


def test_importance_changes_rows(spark):
    pages = [(k, f"http://b.org/{k}", f"<article><div>Box</div><p>{story(k)}</p></article>") for k in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r["text"] for r in html.main_text(df).collect()} == {story(k) for k in range(40)}
    assert {r["text"] for r in html.main_text(df, least=0.0).collect()} == {f"Box\n{story(k)}" for k in range(40)}


def test_names_that_may_be_noise(spark):
    pages = [
        (1, "http://x.org/1", "<div class='main social'>our text</div>"),
        (2, "http://y.org/1", "<div class='search'>our text</div>"),
        (3, "http://z.org/1", "<div class='search'>find</div><p>our text</p>"),
        (4, "http://w.org/1", "<div class='ad'>buy</div><nav>menu</nav>"),
    ]
    assert extracted(spark, pages) == {1: "our text", 2: "our text", 3: "our text", 4: ""}


def test_near_copies_on_one_host_stay(spark):
    """Articles that differ in a word each, under one title: none of it is a template."""
    common = "".join(f"<p>{story(k)}</p>" for k in range(6))
    pages = [(k, f"http://c.org/{k}", f"<article><h1>Title</h1>{common}<p>number {k}</p></article><div class=ad>{k}</div>") for k in range(400)]
    body = "\n".join(story(k) for k in range(6))
    assert extracted(spark, pages) == {k: f"Title\n{body}\nnumber {k}" for k in range(400)}


def test_very_long_pages(spark):
    lines = [story(k) for k in range(20_000)]
    page = "<body><nav>menu</nav><main>" + "".join(f"<p>{line}" for line in lines) + "</main>"
    deep = "<div>" * 300 + "deep" + "</div>" * 300
    assert extracted(spark, [(1, "http://l.org/", page), (2, "http://l.org/", deep)]) == {1: "\n".join(lines), 2: "deep"}
