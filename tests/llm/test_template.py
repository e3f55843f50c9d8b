import html
import re

from tessera.llm import template as T
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(page):
    """The article of the given pages, cut out by hand."""
    m = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"<(?:/?p|/?h\d|br)[^>]*>", m[1] if m else "")
    lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
    return "\n".join(x for x in lines if x)


def test_query_against_hand_cut(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op2_html"](spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    assert all(r.text == plain(pages[r.page_id].html) and r.n_chars == len(r.text) > 0 for r in rows)


def test_host_without_article_and_edges(small):
    def page(k, host="h.example"):
        return (f"<html><body><div class='menu'><a href=/>Home</a></div><div class=top>Welcome to the site</div>"
                f"<div id=\"x{'' if host else k}\"><h2>Title {k}</h2><p>Body &amp; text {k}<p>more   of\n{k} <b>bold</b>"
                f"</div><div class=\"comments\"><p>nice {k}</p></div><form>name</form><footer>end {k}</footer>"
                "<script>if (a<b) {}</script>")
    rows = [(k, f"https://h.example/{k}", page(k)) for k in range(12)]
    rows += [(20, "https://lone.example/", "<main><p>only page</p><aside>no</aside></main>"), (21, None, None),
             (22, "https://h.example/e", ""), (23, "x", "no tags &lt; at all"), (24, None, "<p>a</p>"),
             (25, "https://long.example", "<article><p>" + "word " * 100000 + "</article>"), (3, "https://h.example/3",
                                                                                                 page(3))]
    df = small(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "'t' AS text")
    out = {r.page_id: r for r in T.extract(df).collect()}
    for k in range(12):
        assert out[k].text == f"Title {k}\nBody & text {k}\nmore of {k} bold"
    assert out[20].text == "only page" and out[21].text == out[22].text == "" and out[21].n_chars == 0
    assert out[23].text == "no tags < at all" and out[24].text == "a" and out[25].n_chars == 499999
    assert T.extract(df.limit(0)).collect() == [] and T.extract(df).count() == len(rows)


def test_two_layouts_copies_and_ids(small):
    """Hosts without article: no page of any layout, copy or numbered container loses its text."""
    def page(body, k):
        return f"<html><body><div class=top>Welcome</div>{body}<div class=bio>about author {k}</div></body></html>"
    rows, want = [], {}

    def add(host, body, text, k=None):
        i = len(rows)
        rows.append((i, f"https://{host}/{i}", page(body, i if k is None else k)))
        want[i] = text
    for k in range(10):                                   # (a) layouts 6 : 4, and a lone one
        text = f"long story number {k} about the sea and its many ships"
        add("a.example", f"<div class={'post' if k < 6 else 'entry'}><p>{text}</div>", text)
    add("a.example", "<div class=rare><p>a page with a layout of its own, once</div>",
        "a page with a layout of its own, once")
    for k in (1, 2, 3, 4, 4, 4, 4, 4):                    # (b) copies are more than half of the rows
        text = f"text {k} of this host, told at some length here"
        add("b.example", f"<div class=post><p>{text}</div>", text, k)
    for _ in range(2):                                    # a host of two copies
        add("c.example", "<div class=post><p>the same page, two times over</div>", "the same page, two times over", 0)
    for k in range(6):                                    # (c) another id on each page
        text = f"numbered container {k}" + " with a body" * (k % 2)
        add("d.example", f"<div id=post-{k}><p>{text} {'x' * 20}</div>", f"{text} {'x' * 20}")
    for k in range(9):                                    # three layouts, none on half the pages
        text = f"thirds of a host, page {k}, with enough words to count"
        add("e.example", f"<div class={'xyz'[k % 3]}><p>{text}</div>", text)
    out = {r.page_id: r.text for r in T.extract(small(rows, "page_id long, url string, html string")).collect()}
    assert out == want


def test_locate_keeps_ordered_and_nested_classes():
    tags = ["a", "x", "y", "x", "y", "b"]
    chains, parents = T.locate(tags, [["a", "b"], ["x", "y"]])
    assert parents == {0: (), 1: ((0, 0),)} and chains[2] == ((0, 0), (1, 0)) and chains[3] == ((0, 0),)
    assert T.locate(tags, [["a", "b"], ["y", "x"]])[1] == {0: (), 1: None}              # not in this order
    chains, parents = T.locate(["a", "x", "b", "y"], [["a", "b"], ["x", "y"]])          # they cross
    assert parents == {0: (), 1: None} and chains[2] == ((0, 0),)
    assert T.locate(["a", "x", "y", "b", "x", "y"], [["a", "b"], ["x", "y"]])[1] == {0: (), 1: None}   # two places


def test_slots_between_template_tags(small):
    """The main text is what lies between neighbouring tags of the template, whatever containers a page has there."""
    rows, want = [], {}
    for k in range(8):                                    # no container of the body is shared by two pages
        rows.append((k, f"https://slot.example/{k}", f"<html><body><div class=top>Welcome to all</div><div class=v{k}>"
                     f"<p>opening words of page {k}</div><div class=w{k}><p>and the rest of page {k}, longer</div>"
                     f"<div class=bio>by author {k}</div></body></html>"))
        want[k] = f"opening words of page {k}\nand the rest of page {k}, longer"
    for k in range(20, 28):                               # a repeated class, nested between the tags of another
        items = "".join(f"<section class=item><h2>head {k} {j}</h2><p>story {k} {j} told here</p></section>"
                        for j in range(k % 3 + 1))
        rows.append((k, f"https://list.example/{k}", f"<html><body><div class=list>{items}</div><div class=bio>author {k}"
                     "</div></body></html>"))
        want[k] = "\n".join(f"head {k} {j}\nstory {k} {j} told here" for j in range(k % 3 + 1))
    for k in range(40, 46):                               # an article outside the template's is a teaser
        rows.append((k, f"https://art.example/{k}", f"<html><body><article><h1>title {k}</h1><p>body {k}</p></article>"
                     + f"<div class=more><article>teaser {k}</article></div>" * (k == 45) + "</body></html>"))
        want[k] = f"title {k}\nbody {k}"
    out = {r.page_id: r.text for r in T.extract(small(rows, "page_id long, url string, html string")).collect()}
    assert out == want
