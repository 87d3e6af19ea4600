from postings.functions import html

PAGE = """<html><head><title>First</title><title> Jobs
 &amp; more </title><style>a{}</style><script>var t="<a href='/no'>no</a>";</script></head><body>
<!-- <a href="/comment">no</a> -->
<a href="/one">One</a><A HREF='/two' class=x>T<b>w</b>o &amp;amp; 2</A ><a href=/three>3</a>
<a name="top"></a><a href="">empty</a><a data-href="/no">no</a>
<a href="/lost"><a class="c" href="/kept">kept</a>
<a title="a > b" href="/gt?a=1&amp;b=2">gt</a><a href="/self" /><a
 href = "/nl" >new
 line</a><abbr href="/x">no</abbr><a href="/img"><img src="a.png" alt=""></a>
<a href="/name"><a name="x">inner</a> <a href="/open">never closed"""


def test_anchors(evaluate):
    [links] = evaluate(html.anchors, [(PAGE,)], "h string")
    assert [(a["href"], a["text"]) for a in links] == [
        ("/one", "One"),
        ("/two", "T w o & 2"),
        ("/three", "3"),
        ("/kept", "kept"),
        ("/gt?a=1&b=2", "gt"),
        ("/self", ""),
        ("/nl", "new line"),
        ("/img", ""),
        ("/name", "inner"),
    ]
    positions = [a["pos"] for a in links]
    assert positions == sorted(set(positions))


def test_pages_without_links(evaluate):
    pages = [("",), (None,), ("<a href='/x'>open",), ("plain",), ("</a></a>",)]
    assert evaluate(html.anchors, pages, "h string") == [[]] * 5


def test_title_is_the_last_one(evaluate):
    got = evaluate(html.page_title, [(PAGE,), ("<title></title>",), ("none",), (None,)], "h string")
    assert got == ["Jobs & more", "", "", ""]


def test_long_page_and_long_attribute(evaluate):
    filler = "<p>" + "word " * 200_000 + "</p>"
    attribute = f'<a data-x="{"y" * 100_000}" class={"z" * 100_000} href="/x">t</a>'
    [links] = evaluate(html.anchors, [(filler + attribute + filler,)], "h string")
    assert [(a["href"], a["text"]) for a in links] == [("/x", "t")]


LINKS = """<title>Page</title><a href="/a">A</a><a href="/b"></a><a href="/a">again</a><a href="https://other.nz/x">o</a>
<a href="https://sub.h.nz/y">Y</a><a href="mailto:x@h.nz">m</a><a href="/a#f">frag</a>"""


def test_page_links(evaluate):
    rows = [(LINKS, "https://h.nz/dir/p?x=1")]
    [items] = evaluate(lambda h, u: html.page_links(h, u, ["h.nz"]), rows, "h string, u string")
    got = {i["url"]: (i["title"], i["content"], i["published"]) for i in items}
    assert got == {
        "https://h.nz/a": ("A", "Page A", ""),
        "https://h.nz/b": ("Page", "Page Page", ""),
        "https://sub.h.nz/y": ("Y", "Page Y", ""),
        "https://h.nz/a#f": ("frag", "Page frag", ""),
    }
    assert evaluate(lambda h, u: html.page_links(h, u, []), rows, "h string, u string") == [[]]


def test_title_falls_back_to_the_url(evaluate):
    rows = [("<a href='/b'></a>", "https://h.nz/")]
    [[item]] = evaluate(lambda h, u: html.page_links(h, u, ["h.nz"]), rows, "h string, u string")
    assert (item["title"], item["content"]) == ("https://h.nz/b", " https://h.nz/b")


LISTING = """<html><head><title>Roles near you</title></head><body>
<a href="/a/jobs/trades/electricians/nelson/listing/4711">
  Solar  Installer Full-time Listed yesterday
</a><a href="/a/jobs/it/listing/x">no id</a><a href="/a/jobs/listing/9">no category</a>
<a href="https://elsewhere.nz/a/jobs/x/listing/7?r=1">Elsewhere</a></body></html>"""


def test_listing_links(evaluate):
    rows = [(LISTING, "https://www.trademe.co.nz/a/jobs/it")]
    [items] = evaluate(html.listing_links, rows, "h string, u string")
    assert [(i["title"], i["url"], i["content"]) for i in sorted(items, key=lambda i: i["pos"])] == [
        (
            "Solar Installer",
            "https://www.trademe.co.nz/a/jobs/trades/electricians/nelson/listing/4711",
            "Solar Installer",
        ),
        ("Elsewhere", "https://elsewhere.nz/a/jobs/x/listing/7?r=1", "Elsewhere"),
    ]
