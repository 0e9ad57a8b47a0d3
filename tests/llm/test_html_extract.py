import html
import json
import re
import time

from pyspark.sql import functions as F

from strata.llm import html_extract as H
from strata.llm import wrappers as W
from strata.llm.common import table
from strata.llm.html_tree import parse
from tests.llm.helpers import collected

SCHEMA = "page_id long, url string, html string, text string, host string, wrapper string, data string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "t", "h", "w", "d") for r in rows], SCHEMA)


def test_articles_of_the_given_pages(spark):
    """The pages' articles stand between their tags; what is cut out by hand must be what is extracted."""
    df = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r["page_id"]: r for r in H.extract(df).collect()}
    rows = df.collect()
    assert len(got) == len(rows)
    for r in rows:
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = (html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))) for b in re.split(r"</?(?:p|h1)>", body))
        want = "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (want, len(want))


def alone(text):
    page = parse(text)
    return W.article(page, W.content_path(W.infer([page])), frozenset())


def test_parts_that_are_not_the_article():
    assert alone("""<body><header>H</header><nav><ul><li><a href=x>m</a></ul></nav><div class="side-bar sidebar">S</div>
        <main><h1>T &amp; t</h1><p>a <b>b</b>\n c<p>d<form>f<input></form><div class='ad-box ads'>buy</div>
        <section id="comments"><p>no</p></section><ul><li>x<li>y</ul><script>if (a<b) "</p>"</script></main>
        <aside>no</aside><footer>f</footer>""") == ["T & t", "a b c", "d", "x", "y"]


def test_names_that_only_hold_an_aside_s_word_are_the_article_s():
    text = "<p>a long enough text</p>"
    for around in ('<body class="has-sidebar">{}</body>', '<div class="layout with-sidebar">{}</div>', '<div class="sidebar">{}</div>',
                   '<main class="header">{}</main>', '<form id="aspnet">{}</form>', '<article id="comments" role="alert">{}</article>'):
        assert alone(around.format(text)) == ["a long enough text"], around
    assert alone('<main><div class="entry-header"><h1>T</h1></div><p>a</p><h2 id="related-work">R</h2><h2 id="comments">C</h2>'
                 '<section id="discussion"><p>d</p></section><div class="comments"><p>no</p></div></main>') == ["T", "a", "R", "C", "d"]
    assert alone('<div class="sidebar"><p>by the way</p></div><div><p>the longer text of the page</p></div>') == ["the longer text of the page"]


def test_formulas_objects_and_closed_drawings():
    assert alone("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b <object data=u><param name=n>shown</object> c") == ["a x=1 b shown c"]
    assert alone('<p>a<svg class="i" /> b<math/> c <svg d="a =b"/>d</p><p>e <svg><text>no</text></svg>f') == ["a b c d", "e f"]


def test_awkward_markup():
    assert alone("") == [] and alone("just text < 3 & more") == ["just text < 3 & more"]
    assert alone("<p>a<script>x</script>b</p><!-- c") == ["a b"]
    assert alone("<p>one<p>two</div></b><p title='>'>three") == ["one", "two", "three"]
    deep = "<div>" * 5000 + "<p>text" + "</div>" * 5000 + "<p>after"
    assert "text" in " ".join(alone(deep)) and "after" in " ".join(alone(deep))


def test_parsing_takes_linear_time():
    began = time.time()
    for text in ('<a "' * 50_000, "<p>" * 50_000, "<div>" * 50_000, "</p>" * 50_000, "<li>" * 50_000, "<" * 50_000):
        parse(text)
    assert time.time() - began < 20


def test_wrapper_has_slots_options_and_groups():
    page = lambda title, n, note: parse(
        f"<body><h1>{title}</h1>" + ("<div class=x>n</div>" if note else "") + "".join(f"<p>{title}{i}</p>" for i in range(n))
        + "<hr><table><tr><td>k<td>v</table><span>fixed</span></body>")
    wrapper = W.infer([page("a", 1, True), page("b", 3, False), page("c", 5, True)])
    body = wrapper.parts[0]
    assert [p.sig for p in body.parts][:2] == ["h1", "div.x"]
    assert body.parts[0].parts[0].fixed is None and body.parts[1].optional
    group = next(p for p in body.parts if p.sig == "#group")
    assert group.repeats and [p.sig for p in group.parts] == ["p"]


def test_groups_of_several_elements_repeat():
    page = lambda n: parse("<dl>" + "".join(f"<dt>k{i}<dd>v{i}" for i in range(n)) + "</dl>")
    group = W.infer([page(1), page(3)]).parts[0].parts[0]
    assert group.sig == "#group" and [p.sig for p in group.parts] == ["dt", "dd"]


def test_text_that_every_page_has_is_the_template_s(spark):
    rows = [(i, "http://h.example/a", f"<article><h1>t{i}</h1><p>body {i}</p><div>All rights and wrongs</div></article>")
            for i in range(12)]
    got = {r["text"] for r in H.extract(pages(spark, rows)).collect()}
    assert got == {f"t{i}\nbody {i}" for i in range(12)}


def test_small_hosts_lose_their_template_s_texts_too(spark):
    rows = [(100 * n + i, f"http://h{n}.example/{i}", f"<title>Site</title><article><h1>t{i}</h1><p>body {i}</p><div>All rights</div></article>")
            for n in range(2, 8) for i in range(n)]
    got = {r["page_id"]: r["text"] for r in H.extract(pages(spark, rows)).collect()}
    assert got == {i: f"t{i % 100}\nbody {i % 100}" for i, _, _ in rows}


def test_texts_of_a_minority_s_template_and_what_articles_share(spark):
    """40 of 400 pages hold a notice of their own; a third quotes one passage; near copies share their paragraphs."""
    rows = [(i, "http://h.example/a", f"<article><h1>t{i}</h1><p>body {i}</p>" + "<p>quoted</p>" * (i % 3 == 0)
             + "<div class=old>An old page</div>" * (i % 10 == 0) + "</article>") for i in range(400)]
    rows += [(1000 + i, "http://near.example/a", f"<article><h1>t</h1><p>a</p><p>b</p><div>c</div><p>d{i}</p></article>") for i in range(9)]
    got = {r["page_id"]: r["text"] for r in H.extract(pages(spark, rows)).collect()}
    assert got == {i: (f"t{i}\nbody {i}" + "\nquoted" * (i % 3 == 0) if i < 1000 else f"t\na\nb\nc\nd{i - 1000}") for i, _, _ in rows}


def test_pages_that_lack_the_wrapper_s_place_are_read_by_their_own_tree(spark):
    """Bodies of other classes and a second layout: the text around the article isn't taken."""
    rows = [(i, "http://h.example/a", f"<body class='category-{'news' if i % 10 else 'sport'}'><div class=top><p>around {i}</p></div>"
             f"<article><h1>t{i}</h1><p>body {i}</p><div>All rights</div></article></body>") for i in range(30)]
    rows += [(30 + i, "http://h.example/b", f"<div class=shop><p>around {i}</p><div class=goods><main><h1>m{i}</h1><p>goods {i}</p></main></div></div>")
             for i in range(3)]
    got = {r["page_id"]: r["text"] for r in H.extract(pages(spark, rows)).collect()}
    assert got == {i: f"t{i}\nbody {i}" if i < 30 else f"m{i - 30}\ngoods {i - 30}" for i, _, _ in rows}
    page = parse("<div><p>a</p></div>")
    assert W.article(page, ["body", "article"], frozenset()) is None


def test_all_pages_of_a_host_say_where_the_article_is(spark):
    """Of 200 pages, the twelve with the least hashes (once the whole sample) have another layout; the others'
    articles are shorter than the text around them, which only the host's other pages tell apart."""
    notice = "What stands around each article of this host and is longer than it"
    usual = [f"<body><div class=around><p>{notice}</p></div><div class=story><h1>t{i}</h1><p>body {i}</p></div></body>" for i in range(188)]
    tried = spark.range(40_000).select(F.concat(F.lit("<body><section><p>other "), "id", F.lit("</p></section></body>")).alias("html"))
    rank = F.xxhash64(F.xxhash64(F.col("html").cast("binary")))
    odd = [r["html"] for r in tried.orderBy(rank).limit(12).collect()]
    both = spark.createDataFrame([(x,) for x in usual + odd], "html string")
    assert {r["html"] for r in both.orderBy(rank).limit(12).collect()} == set(odd)
    rows = [(i, "http://h.example/a", x) for i, x in enumerate(usual + odd)]
    for group_pages in (H.GROUP_PAGES, 1000):
        got = {r["page_id"]: r["text"] for r in H.extract(pages(spark, rows), group_pages).collect()}
        assert all(got[i] == f"t{i}\nbody {i}" for i in range(188))


def test_alignment_sees_the_same_in_packed_trees(spark):
    texts = ["<body class=x><p>a &amp; b</p><div id=main><h1>t</h1>longer <a href=x>link</a><ul><li>i<li>j</ul></div><footer>f</footer>",
             "<body class=x><p>a &amp; b</p><div id=main><h1>u</h1>another text<ul><li>i</ul><p>q</p></div><footer>f</footer>"]
    shape = lambda p: (p.sig, p.tag, p.aside, p.fixed is None, p.optional, p.repeats, p.size, p.seen, [shape(x) for x in p.parts])
    whole = W.infer([parse(t) for t in texts])
    again = W.infer([W.unpacked(json.loads(json.dumps(W.packed(parse(t))))) for t in texts])
    assert shape(whole) == shape(again) and W.content_path(whole) == W.content_path(again)


def test_alignment_of_many_different_siblings_takes_linear_time():
    page = lambda order: parse("".join(f"<div class={''.join(chr(97 + int(d)) for d in str(i))}>x</div>" for i in order))
    began = time.time()
    W.infer([page(range(0, 20_000, 2)), page(range(1, 20_000, 2)), page(range(20_000))])
    assert time.time() - began < 20


def test_copies_of_a_page_lose_nothing(spark):
    rows = [(i, "http://h.example/a", "<article><h1>t</h1><p>same</p></article>") for i in range(20)]
    assert {r["text"] for r in H.extract(pages(spark, rows)).collect()} == {"t\nsame"}


def test_edge_cases(spark):
    rows = [(1, "http://h.example/a", None), (2, None, "<p>x</p>"), (3, "not a url", "<p>y"), (None, "http://h.example/b", ""),
            (4, "http://h.example/c", "<article>" + "<p>w</p>" * 20_000 + "</article>"), (4, "http://h.example/c", "<p>other</p>"),
            (5, "http://H.example:80/d", "<article>z</article>")]
    got = sorted(collected(H.extract(pages(spark, rows))), key=repr)
    assert sorted(((i, u, t) for i, u, t, _ in got), key=repr) == sorted(
        [(1, "http://h.example/a", ""), (2, None, "x"), (3, "not a url", "y"), (None, "http://h.example/b", ""),
         (4, "http://h.example/c", "\n".join(["w"] * 20_000)), (4, "http://h.example/c", "other"),
         (5, "http://H.example:80/d", "z")], key=repr)
    assert collected(H.extract(pages(spark, []))) == []
