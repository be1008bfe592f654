"""Page reading and site template removal."""
import pytest

from batchtrace.llm import html_templates as T
from batchtrace.llm.html_page import main_text, subtrees

CASES = [
    ("", ""), ("plain  text &amp; more", "plain text & more"), ("<p>a<p>b</p>", "a\nb"),
    ("<article><h1>T</h1><p>a<br>b&nbsp;c</p></article><footer>f</footer>", "T\na b c"),
    ("<nav><ul><li>m</li></ul></nav><article><p>x</p></article><aside>s</aside>", "x"),
    ("<script>var t='</p><p>no';</script><style>p{}</style><p>yes</p><!-- <p>no</p> -->", "yes"),
    ("<article><p>x</p><div class='comment-list'><p>c</p></div><form><p>f</p></form></article>", "x"),
    ("<div class=ad>buy</div><div id='cookie-notice'>ok?</div><main><p>m</p></main>", "m"),
    ("<article><header><h1>H</h1><p>by</p></header><p>t</p><footer>share</footer></article>", "H\nby\nt"),
    ("<header><h1>Site</h1></header><article><p>t</p></article>", "t"),
    ("<p><b>bold<br><p>next", "bold\nnext"), ("<div>a<span> b</span>c</div>d", "a bc\nd"),
    ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", "a\nb\n1 2\n3"),
    ("<p hidden>no</p><p aria-hidden='true'>no</p><p>1 &lt; 2 &#233; &copy</p>", "1 < 2 é ©"),
    ("<div class='sidebar'><article><p>real</p></article></div>", "real"),
    ("<article><p>long article text</p></article><article class='comment'><p>hey</p></article>", "long article text"),
    ("a < b <3 and </nonsense> <p>c", "a < b <3 and\nc"), ("<p>" * 50_000 + "deep", "deep"),
    ("<div>" * 20_000 + "deep" + "</div>" * 10, "deep"), ("<![CDATA[a<b]]>", "a<b"), ("<p title='>'>q</p>", "q")]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_main_text(page, text):
    assert main_text(page) == text


def test_subtree_hashes_depend_on_content_only():
    a, b = subtrees("<body><div><p>x  y</p></div><p>1</p></body>"), subtrees("<body><p>2</p><div>\n<p>x y</p></div></body>")
    assert len(a & b) == 2 and len(a) == 3


def test_recurring_subtrees_go_and_others_stay(spark, sf_small):
    box = "<div><p>Read our rules</p><p>often</p></div>"
    page = lambda i, extra: f"<body>{extra}<p>story {i}</p><p>same line</p></body>"
    rows = [(i, f"http://a.example/{i}", page(i, box) if i < 9 else f"<body><p>only {i}</p></body>") for i in range(12)]
    rows += [(100 + i, "http://b.example/x", page(1, box)) for i in range(20)]  # one page many times: no template
    rows += [(200 + i, None if i % 2 else "no host", page(i, box)) for i in range(8)]
    rows += [(300, "http://a.example/n", None), (301, "http://a.example/n", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    from pyspark.sql import functions as F
    got = {r.page_id: r for r in T.extract(pages.withColumn("template", F.lit(1)).withColumn("site", F.lit("s"))).collect()}
    assert len(got) == len(rows)
    assert got[3].text == "story 3" and got[10].text == "only 10"  # "same line" recurs on most pages of the site too
    assert got[100].text == "Read our rules\noften\nstory 1\nsame line"
    assert got[201].text == "Read our rules\noften\nstory 1\nsame line"
    assert got[300].text == "" and got[300].n_chars == 0 and got[3].n_chars == 7
    assert T.extract(pages.limit(0)).count() == 0




def test_articles_of_the_test_pages_are_whole(spark, sf_small):
    import html as H
    import re
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(H.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", b))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        want[r.page_id] = "\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in T.extract(pages).collect()} == want


def test_copies_of_one_article_keep_their_text(spark, sf_small):
    def page(i, body):
        return f"<body><script>var id={i}</script>{body}</body>"
    article = "<article><h1>Title</h1><p>first <b>bold</b></p><ul><li>one</li></ul></article>"
    links = "<ul><li><a>Home</a></li><li><a>News</a></li></ul>"
    rows = [(i, "http://a.example/c", page(i, article)) for i in range(10)]
    rows += [(20 + i, "http://b.example/c", page(i, "<div><p>same text</p></div>")) for i in range(10)]
    rows += [(40 + i, "http://c.example/c", page(i, f"<article><p>story {i}</p><p>a passage</p>{links}</article>")) for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in T.extract(pages).collect()}
    assert {got[i] for i in range(10)} == {"Title\nfirst bold\none"}
    assert {got[i] for i in range(20, 30)} == {"same text"}
    assert [got[40 + i] for i in range(10)] == [f"story {i}\na passage" for i in range(10)]


@pytest.mark.parametrize("lookup", [T.LOOKUP, 0])
def test_boxes_go_on_a_host_of_any_size(spark, sf_small, lookup):
    box = "<div><p>Read our rules</p></div>"
    rows = [(i, "http://a.example/x", f"<body><p>story {i}</p><p>same line</p>{box if i % 5 < 2 else ''}</body>") for i in range(100)]
    rows += [(100 + i, "http://a.example/x", "<p>story 0</p><p>rare line</p>" + "<div>rare box</div>" * (i < 3)) for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in T.extract(pages, lookup=lookup).collect()}
    assert [got[i] for i in range(100)] == [f"story {i}" for i in range(100)]
    assert {got[100 + i] for i in range(3)} == {"story 0\nrare line\nrare box"}
    assert {got[103 + i] for i in range(6)} == {"story 0\nrare line"}


@pytest.mark.parametrize(("page", "text"), [
    ("<article><p>part one</p></article><p>x</p><article><p>part two is longer</p></article>", "part one\npart two is longer"),
    ("<main><p>the body of the page, told at length</p></main><article><p>teaser</p></article>", "the body of the page, told at length"),
    ("<div><p>the body of the page, told at length</p></div><article><p>more</p></article>",
     "the body of the page, told at length\nmore"),
    ("<article><p>told at length</p></article><div class='related'><article><p>other</p></article></div>", "told at length")])
def test_no_article_is_lost(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("inner", [
    '<div style="overflow:hidden"><p>kept</p></div>', '<div style="visibility:hidden">kept</div>', '<p title="a hidden gem">kept</p>',
    '<p><a href="/the-hidden-valley">kept</a></p>', '<p data-hidden="false">kept</p>', '<p><a href="x?id=comments">kept</a></p>',
    '<p><a href=x?id=comments>kept</a></p>', '<p data-id="share">kept</p>', '<p title="class=notice">kept</p>', "<p title='id=\"ad\"'>kept</p>",
    '<h2 class="section-header">kept</h2>', '<table class="header-fixed"><tr><th class="header">kept</th></tr></table>',
    '<p class="legal-notice-period">kept</p>', '<div class="section-header"><h2>kept</h2></div>', '<blockquote id="promo">kept</blockquote>',
    '<p hidden-by="x" class>kept</p>', '<p id = ad-rem >kept</p>', '<p aria-hidden="false">kept</p>', '<img alt="x" hidden><p>kept</p>'])
def test_article_text_is_kept_whatever_attributes_say(inner):
    assert main_text(f"<body><article><h1>T</h1><p>the story is told here</p>{inner}</article></body>") == "T\nthe story is told here\nkept"


@pytest.mark.parametrize("inner", ['<div class="share">x</div>', '<ul class="comments"><li>x</li></ul>', '<li class="comment">x</li>', "<div id=ad>x</div>",
                                   "<div CLASS='Cookie Notice'>x</div>", '<p hidden>x</p>', '<div role="banner">x</div>', '<div class="page-header">x</div>'])
def test_furniture_in_an_article_goes(inner):
    assert main_text(f"<body><article><h1>T</h1><p>the story is told here</p>{inner}</article></body>") == "T\nthe story is told here"


def test_menus_beside_a_short_article_do_not_bring_the_page():
    menu = "".join(f"<li>menu line number {i}</li>" for i in range(40)) + "".join(f"<a href='/{i}'>link number {i}</a>" for i in range(40))
    assert main_text(f"<body><ul>{menu}</ul><article><p>a short story</p></article></body>") == "a short story"
    teaser = "<article><a href='/x'>Read the other story of the day</a></article>"
    assert main_text(f"<body><div><p>the body</p></div>{teaser}</body>") == "the body\nRead the other story of the day"
    assert main_text("<main><article><p>one</p></article><article><p>two</p></article></main><article><p>beside the main part</p></article>") == "one\ntwo"
    comments = "<article class='comment'><p>" + "a reader says much " * 30 + "</p></article>"
    assert main_text(f"<article><p>story</p></article>{comments}") == "story"


@pytest.mark.parametrize("junk", ['<a b "', "<a b='", '<a x=">"', "<div>", "<p><button><div>", "</div>", "<![CDATA[", "<!x", "<?", "<", "<ul><li>", "<article>",
                                  "<div></p>", "<td>", "&#x", "<p>", "<a href=\"x'>", "<!--", "<b><i></b>", "<table><tr><td>", "<dl><dd>", "</"])
def test_broken_pages_are_read_in_linear_time(junk):
    import time
    page = "<p>start</p>" + junk * (1_000_000 // len(junk))
    t = time.process_time()
    assert main_text(page + "<p>x").startswith("start")
    assert time.process_time() - t < 15


def test_counting_of_subtrees_equals_brute_force(spark):
    """Per host: the pages (told apart by their text) that hold a subtree, and which of them are template."""
    import random
    rng = random.Random(3)
    boxes = [f"<div><p>box {i}</p></div>" for i in range(6)]
    rows = [(i, f"http://h{rng.randrange(2)}.example/x", "".join(b for b in boxes if rng.random() < .4) + f"<p>story {rng.randrange(60)}</p>")
            for i in range(150)] + [(999, None, boxes[0])]
    from batchtrace.llm.html_page import content
    seen: dict = {}
    pages_of: dict = {}
    for _, url, html in rows:
        if url:
            text, trees = content(html)
            pages_of.setdefault(url.split("/")[2], set()).add(text)
            for tree, box in trees.items():
                seen.setdefault((url.split("/")[2], tree, box), set()).add(text)
    want = {(h, t) for (h, t, box), texts in seen.items()
            if len(texts) >= 5 and len(texts) >= 0.5 * len(pages_of[h]) or box and len(texts) >= 20}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {tuple(r) for r in T.templates(T.page_trees(df)).collect()} == want and len(want) > 3
