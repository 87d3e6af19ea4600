"""RSS and Atom scans as Column expressions over ``from_xml``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import first_non_empty, let, or_empty

# Fixed value: the namespace of Atom feeds.
ATOM = "http://www.w3.org/2005/Atom"

# Every text is an array so that the first of repeated elements can be taken.
_ITEM = "struct<title:array<string>,link:array<string>,description:array<string>,pubDate:array<string>>"
_ENTRY = (
    "struct<_xmlns:string,title:array<string>,link:array<struct<_href:string>>,summary:array<string>,"
    "content:array<string>,published:array<string>,updated:array<string>>"
)
FEED_SCHEMA = (
    f"_xmlns string, channel array<struct<item:array<{_ITEM}>,entry:array<{_ENTRY}>>>, "
    f"item array<{_ITEM}>, entry array<{_ENTRY}>, _malformed string"
)
_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_malformed",
    "ignoreSurroundingSpaces": "false",
}

_ROOT = r"^[^<]*(?:<[?!][^>]*>[^<]*)*<"


def _parse(xml: Column) -> Column:
    return F.from_xml(xml, FEED_SCHEMA, _OPTIONS)


def _first(texts: Column) -> Column:
    return or_empty(F.get(texts, F.lit(0)))


def _rss_item(item: Column, pos: Column) -> Column:
    return F.struct(
        pos.alias("pos"),
        _first(item["title"]).alias("title"),
        _first(item["link"]).alias("url"),
        _first(item["description"]).alias("content"),
        _first(item["pubDate"]).alias("published"),
    )


def _atom_item(entry: Column, pos: Column) -> Column:
    return F.struct(
        pos.alias("pos"),
        _first(entry["title"]).alias("title"),
        or_empty(F.get(entry["link"], F.lit(0))["_href"]).alias("url"),
        first_non_empty(_first(entry["summary"]), _first(entry["content"])).alias("content"),
        first_non_empty(_first(entry["published"]), _first(entry["updated"])).alias("published"),
    )


def _without_prefix(xml: Column) -> Column:
    """Rewrite ``<atom:feed>`` documents to unprefixed tags."""
    prefix = F.regexp_extract(xml, _ROOT + r"([A-Za-z_][\w.\-]*):feed[\s>]", 1)
    plain = F.regexp_replace(
        F.regexp_replace(xml, F.concat(F.lit("(</?)"), prefix, F.lit(":")), F.lit("$1")),
        F.concat(F.lit("xmlns:"), prefix, F.lit("=")),
        F.lit("xmlns="),
    )
    return F.when(xml.contains(":feed"), F.when(prefix != "", plain).otherwise(xml)).otherwise(xml)


_REST = r"""(?:[^>"']++|"[^"]*"|'[^']*')*+>"""
_XMLNS = r"""\sxmlns\s*=\s*["']"""
#: Opening tags that declare a default namespace, with their name.
_DECLARING = r"""<([A-Za-z_][^\s/>"'<]*+)(?=\s)(?=[^<]*?\sxmlns\s*=)"""
_MARK = "struct<name:string,closing:boolean,alone:boolean,declared:string>"
_OPEN = "struct<name:string,ns:string,at:int,kind:string>"
_SPAN = "struct<start:int,stop:int,kind:string>"
_FLAT = f"item array<{_ITEM}>, entry array<{_ENTRY}>, _malformed string"


#: The name of the root element, behind comments, declarations and instructions.
_ROOT_NAME = r"(?s)^[^<]*+(?:(?:<!--.*?-->|<(?![A-Za-z_]|!--)[^>]*+>)[^<]*+)*+<([A-Za-z_][^\s/>]*+)"


def _piece(xml: Column) -> Column:
    """The pattern of a piece: text up to and with the next tag that decides (group 1).

    Items, entries, the root and the elements of a name that somewhere declares a default
    namespace decide. Comments, CDATA, declarations and instructions end a piece too, so that markup
    inside them is passed over. Attribute values hold no ``<``, so other tags need no look.
    """
    names = F.array_append(F.regexp_extract_all(xml, F.lit(_DECLARING), F.lit(1)), F.regexp_extract(xml, _ROOT_NAME, 1))
    quoted = F.transform(F.array_distinct(names), lambda n: F.concat(F.lit(r"|\Q"), n, F.lit(r"\E")))
    head = r"(?s)\G.*?(<(?:!--.*?-->|!\[CDATA\[.*?\]\]>|\?.*?\?>|![^>]*>|/?(?:item|entry"
    return F.concat(F.lit(head), F.array_join(quoted, ""), F.lit(r")(?=[\s/>])" + _REST + "))"))


def _spans(marks: Column) -> Column:
    """``(start, stop, kind)`` of every RSS item and Atom entry below the root, by its marks' places.

    One pass over the deciding tags keeps those open on a stack with their namespace (declared on
    the tag, else that of the tag around it). An unprefixed ``item`` outside any default namespace
    is an RSS item, an ``entry`` in the Atom namespace an Atom entry. Spans come in document order.
    """

    def step(acc: Column, mark: Column) -> Column:
        stack = acc["stack"]
        top = F.get(stack, F.size(stack) - 1)
        ns = F.coalesce(mark["declared"], top["ns"], F.lit(""))
        below = F.size(stack) > 0
        kind = F.when(below & (mark["name"] == "item") & (ns == ""), F.lit("item")).when(
            below & (mark["name"] == "entry") & (ns == ATOM), F.lit("entry")
        )
        pushed = F.struct(mark["name"].alias("name"), ns.alias("ns"), acc["at"].alias("at"), kind.alias("kind"))
        opening = mark["name"].isNotNull() & ~mark["closing"] & ~mark["alone"]
        span = F.when(mark["alone"], F.struct(acc["at"].alias("start"), acc["at"].alias("stop"), kind.alias("kind"))).when(
            mark["closing"], F.struct(top["at"].alias("start"), acc["at"].alias("stop"), top["kind"].alias("kind"))
        )
        return F.struct(
            (acc["at"] + 1).alias("at"),
            F.when(opening, F.array_append(stack, pushed))
            .when(mark["closing"], F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0))))
            .otherwise(stack)
            .alias("stack"),
            let(span, lambda s: F.when(s["kind"].isNotNull(), F.array_append(acc["out"], s)).otherwise(acc["out"])).alias("out"),
        )

    start = F.struct(
        F.lit(0).alias("at"), F.array().cast(f"array<{_OPEN}>").alias("stack"), F.array().cast(f"array<{_SPAN}>").alias("out")
    )
    return F.sort_array(F.aggregate(marks, start, step)["out"])


def _marks(tags: Column) -> Column:
    """What each deciding tag says; comments and the like have no name."""

    def mark(t: Column) -> Column:
        tag = t.rlike("^</?[A-Za-z_]")
        closing = t.startswith("</")
        return F.struct(
            F.when(tag, F.regexp_extract(t, r"^</?([^\s/>]+)", 1)).alias("name"),
            (tag & closing).alias("closing"),
            (tag & ~closing & t.endswith("/>")).alias("alone"),
            F.when(tag & t.contains("xmlns") & t.rlike(_XMLNS), F.regexp_extract(t, _XMLNS + r"""([^"']*)["']""", 1)).alias("declared"),
        )

    return F.transform(tags, mark)


def _struct(item: Column | None = None, entry: Column | None = None) -> Column:
    """``struct<item,entry>``; what is missing or NULL is empty."""
    empty = {"item": F.array().cast(f"array<{_ITEM}>"), "entry": F.array().cast(f"array<{_ENTRY}>")}
    given = {"item": item, "entry": entry}
    return F.struct(*((none if given[n] is None else F.coalesce(given[n], none)).alias(n) for n, none in empty.items()))


#: A version other than 1.0, which an element by itself would not be parsed by; told ahead of the first ``>``.
_NOT_1_0 = r"""^\s*<\?xml\s+version\s*=\s*["'](?!1\.0["'])"""


def _plain(text: Column, parsed: Column) -> Column:
    """``struct<item,entry>`` of a feed as nearly all are written, from its one parse, else NULL.

    Plain is a feed whose items and entries, counted in its text, all are children of one channel,
    or of a root without channels, and which declares default namespaces on the root and on entries
    only. Whatever else a text holds makes the counts differ, and the feed is cut by its tags.
    """
    channels = F.coalesce(F.size(parsed["channel"]), F.lit(0))
    loose = parsed["item"].isNotNull() | parsed["entry"].isNotNull()
    first = F.get(parsed["channel"], F.lit(0))
    of_one = F.when((channels == 1) & ~loose, F.struct(first["item"], first["entry"])).when(
        channels == 0, F.struct(parsed["item"], parsed["entry"])
    )
    declared = F.when(text.contains("xmlns"), F.regexp_extract_all(text, F.lit(r"(?i)\sxmlns(?=\s*=)"), F.lit(0))).otherwise(
        F.array().cast("array<string>")
    )
    def counted(children: Column, tags: Column) -> Column:
        n = F.coalesce(F.size(children["item"]), F.lit(0)) + F.coalesce(F.size(children["entry"]), F.lit(0))
        return (F.size(tags) == n) & F.forall(tags, lambda t: t.isin("<item", "<entry"))

    def told(children: Column, spaces: Column) -> Column:
        own = F.filter(children["entry"], lambda e: e["_xmlns"].isNotNull())
        n = F.coalesce(F.size(own), F.lit(0)) + parsed["_xmlns"].isNotNull().cast("int")
        return (F.size(spaces) == n) & F.forall(spaces, lambda s: F.endswith(s, F.lit("xmlns")))

    # Only tests are bound: what a ``let`` gives is copied, and the children are the whole feed.
    tags = F.regexp_extract_all(text, F.lit(r"(?i)<(?:[^\s<>/:]*+:)?(?:item|entry)(?=[\s/>])"), F.lit(0))
    whole = of_one.isNotNull() & ~F.substring_index(text, ">", 1).rlike(_NOT_1_0) & let(tags, lambda t: counted(of_one, t))
    around = or_empty(parsed["_xmlns"])
    entries = F.filter(of_one["entry"], lambda e: F.coalesce(e["_xmlns"], around) == ATOM)
    return F.when(
        whole & let(declared, lambda spaces: told(of_one, spaces)), _struct(F.when(around == "", of_one["item"]), entries)
    )


def _elements(text: Column) -> Column:
    """``struct<item,entry>``: the RSS items and the Atom entries below the root, in document order.

    Each element's text is put together from the pieces between its tags, one that holds another
    included, and all are parsed at once, one beside the other: its own children only.
    """

    def found(pieces: Column, tags: Column, spans: Column) -> Column:
        def texts(kind: str) -> Column:
            return F.transform(
                F.filter(spans, lambda s: s["kind"] == kind),
                lambda s: F.concat(F.get(tags, s["start"]), F.array_join(F.slice(pieces, s["start"] + 2, s["stop"] - s["start"]), "")),
            )

        def one_by_one(items: Column, entries: Column) -> Column:
            return F.struct(
                F.transform(items, lambda x: F.from_xml(x, _ITEM, _OPTIONS)).alias("item"),
                F.transform(entries, lambda x: F.from_xml(x, _ENTRY, _OPTIONS)).alias("entry"),
            )

        def all_at_once(items: Column, entries: Column) -> Column:
            flat = F.concat(F.lit("<r>"), F.array_join(items, ""), F.array_join(entries, ""), F.lit("</r>"))
            whole = lambda p, name, xs: F.coalesce(F.size(p[name]), F.lit(0)) == F.size(xs)
            # What parses alone but not beside others is parsed alone.
            return let(
                F.from_xml(flat, _FLAT, _OPTIONS),
                lambda p: F.when(
                    p["_malformed"].isNull() & whole(p, "item", items) & whole(p, "entry", entries), _struct(p["item"], p["entry"])
                ).otherwise(one_by_one(items, entries)),
            )

        return let(texts("item"), lambda items: let(texts("entry"), lambda entries: all_at_once(items, entries)))

    def cut(pattern: Column) -> Column:
        pieces, tags = (F.regexp_extract_all(text, pattern, F.lit(group)) for group in (0, 1))
        return let(pieces, lambda p: let(tags, lambda t: let(_spans(_marks(t)), lambda s: found(p, t, s))))

    return let(_piece(text), cut)


def parse_feed(xml: Column) -> Column:
    """Parse a feed: ``struct<malformed,items:array<struct<pos,title,url,content,published>>>``.

    RSS items come first, then Atom entries, each at any depth below the root and in document
    order, also where one holds another. Missing texts are empty; a field is the first child of
    its name of the element itself. An RSS item counts only outside a default namespace, an Atom
    entry only inside the Atom namespace. ``malformed`` holds the text of a document that does
    not parse, whose ``items`` are empty.
    """

    def assemble(text: Column, parsed: Column) -> Column:
        usable = parsed["_malformed"].isNull()
        found = F.coalesce(F.when(usable, F.coalesce(_plain(text, parsed), _elements(text))), _struct())
        items = let(
            found,
            lambda e: F.concat(
                F.transform(e["item"], _rss_item),
                F.transform(e["entry"], lambda x, i: _atom_item(x, i + F.size(e["item"]))),
            ),
        )
        return F.struct(parsed["_malformed"].alias("malformed"), items.alias("items"))

    return let(_without_prefix(xml), lambda text: let(_parse(text), lambda parsed: assemble(text, parsed)))
