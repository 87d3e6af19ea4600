import time
from xml.sax.saxutils import escape

from postings.functions.feeds import parse_feed
from postings.sources.scans import read_rss_files, scan_feeds

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:media="m" xmlns:atom="http://www.w3.org/2005/Atom"><channel>
<title>c</title><atom:link href="self"/><item><title> A &amp; B </title><media:title>no</media:title><link>https://h/1</link>
<description><![CDATA[<p>hi </item></p>]]></description></item><item><title>t1</title><title>t2</title>
<pubDate>today</pubDate></item><item/></channel></rss>"""
ATOM = """<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>f</title>
<entry><title type="html">T&lt;1</title><link rel="self" href="u1"/><link href="u2"/><summary> s </summary>
<content>c</content><updated>up</updated></entry><entry><title>T2</title><link/><summary></summary><content>cc</content>
<published>p</published><updated>up</updated></entry></feed>"""

ATOM_NS = "http://www.w3.org/2005/Atom"


def items_of(evaluate, *documents):
    parsed = evaluate(parse_feed, [(d,) for d in documents], "x string")
    return [[(i["title"], i["url"], i["content"], i["published"]) for i in p["items"]] for p in parsed]


def test_rss(evaluate):
    assert items_of(evaluate, RSS) == [
        [(" A & B ", "https://h/1", "<p>hi </item></p>", ""), ("t1", "", "", "today"), ("", "", "", "")]
    ]


def test_atom(evaluate):
    assert items_of(evaluate, ATOM) == [[("T<1", "u1", " s ", "up"), ("T2", "", "cc", "p")]]


def test_other_shapes(evaluate):
    got = items_of(
        evaluate,
        "<rss><channel><group><item><title>deep</title></item></group></channel></rss>",
        "<rdf><channel/><item><title>beside</title></item></rdf>",
        "<rss><channel><item><title>a</title></item></channel><channel><item><title>b</title></item></channel></rss>",
        '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:title>P</a:title><a:link href="l"/></a:entry></a:feed>',
        "<feed><entry><title>no namespace</title></entry></feed>",
        '<rss xmlns="other"><channel><item><title>other namespace</title></item></channel></rss>',
        '<rss><channel><entry xmlns="http://www.w3.org/2005/Atom"><title>e</title></entry><item><title>i</title></item></channel></rss>',
        "<rss><channel></channel></rss>",
    )
    titles = [[i[0] for i in items] for items in got]
    assert titles == [["deep"], ["beside"], ["a", "b"], ["P"], [], [], ["i", "e"], []]


def test_malformed_documents_are_reported(evaluate):
    documents = ["<rss><channel><item><title>x</channel></rss>", "<rss>&nbsp;</rss>", "hello"]
    parsed = evaluate(parse_feed, [(d,) for d in documents], "x string")
    assert [p["malformed"] for p in parsed] == documents
    assert all(p["items"] == [] for p in parsed)


def test_item_order_and_whole_texts(spark):
    texts = [f"text {i} <&> \n é" + "long " * 3000 for i in range(50)]
    body = "".join(f"<item><title>{i}</title><description>{escape(t)}</description></item>" for i, t in enumerate(texts))
    feeds = spark.createDataFrame([(1, f"<rss><channel>{body}</channel></rss>")], "feed_id int, xml string")
    rows = scan_feeds(feeds, ["feed_id"]).orderBy("pos").collect()
    assert [(r["pos"], r["title"], r["content"]) for r in rows] == [(i, str(i), t) for i, t in enumerate(texts)]


def test_rss_files(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(RSS.replace("<item/>", ""), encoding="utf-8")
    rows = read_rss_files(spark, str(tmp_path / "feed.xml")).collect()
    assert {(r["title"], r["url"], r["published"]) for r in rows} >= {(" A & B ", "https://h/1", "")}
    assert len(rows) == 2


def test_odd_documents(evaluate):
    got = items_of(
        evaluate,
        "<item><title>root</title><item><title>in</title></item></item>",
        "<rss><m:item><title>m</title></m:item><item ><title>k</title></item ><items><title>z</title></items></rss>",
        "<rss><channel><m:item><title>c</title></m:item></channel><x><item/></x></rss>",
        "<rss><item><title>o</title><item><title>n</title></item></item><!-- <item> --><item><title>l</title></item></rss>",
        f'<rss><x xmlns="{ATOM_NS}"><x><entry><title>e</title><item/></entry></x></x><entry/><x><item><title>i</title></item></x></rss>',
        f'<feed xmlns="{ATOM_NS}"><entry xmlns=""><title>no</title></entry><entry><title>t</title></entry><item/></feed>',
        "<rss><channel><item><title> xmlns =</title></item><item><![CDATA[<item>]]></item></channel></rss>",
    )
    titles = [[i[0] for i in items] for items in got]
    assert titles == [["in"], ["k"], [""], ["o", "n", "l"], ["i", "e"], ["t"], [" xmlns =", ""]]


def test_time_follows_the_length_of_a_feed(spark):
    """Items neither are looked for from the feed's start nor parsed one by one."""
    item = "<item><title>t</title><description>" + "é word " * 200 + "</description></item>"
    for document in (f"<rss><channel>{item * 6000}</channel></rss>", f"<rss><channel>{f'<g>{item}</g>' * 3000}</channel></rss>"):
        start = time.monotonic()
        feeds = spark.createDataFrame([(1, document)], "feed_id int, xml string")
        assert scan_feeds(feeds, ["feed_id"]).where("title = 't' AND length(content) = 1400").count() == document.count("<item>")
        assert time.monotonic() - start < 20
