import hashlib
import html

from postings.functions import entities, text


def test_unescape_matches_the_standard_library(evaluate):
    samples = [
        "plain", "a &amp; b", "&lt;b&gt;", "&quot;&#39;&apos;", "&copy;2026&middot;x", "&notit;", "&notin;", "&ampx;",
        "&amp;amp;", "&#8364;&#x20AC;&#X1F600;", "&#0;&#128;&#129;&#13;&#xD800;&#x110000;", "&#99999999999999999999;",
        "&#1;&#xFFFE;&#11;", "&unknown;", "&", "a&", "&&amp;", "&;", "& amp;", "&eacute&Eacute;", "&nGt;", "&#x;",
        "&#;", "&lt", "&LT;x", "&ltx", "&nbsp;", "é&amp;é", "&#65", "&#65x", "&bne;&ThickSpace;", "a&b&c;",
        "&CounterClockwiseContourIntegral;",
    ]
    got = evaluate(entities.unescape, [(s,) for s in samples], "t string")
    assert got == [html.unescape(s) for s in samples]


def test_every_named_reference(evaluate):
    names = sorted(entities.html5)
    samples = ["x&" + n + ("y" if n.endswith(";") else " y") for n in names]
    got = evaluate(entities.unescape, [(s,) for s in samples], "t string")
    assert got == [html.unescape(s) for s in samples]


def test_blanks_are_unicode_whitespace(evaluate):
    blanks = [c for c in map(chr, range(0x110000)) if c.isspace()]
    assert sorted(text.WHITESPACE) == sorted(blanks)
    samples = ["".join(blanks) + "a" + "".join(blanks) + "b" + "".join(blanks), "", " ", "a b", "a\t\n b "]
    assert evaluate(text.collapse, [(s,) for s in samples], "t string") == [" ".join(s.split()) for s in samples]
    assert evaluate(text.strip, [(s,) for s in samples], "t string") == [s.strip() for s in samples]


def test_listing_titles(evaluate):
    cases = [
        ("Dev  Lead Listed today", "Dev Lead"),
        ("Senior\nContract Developer", "Senior"),
        ("Contract Developer", "Contract Developer"),
        ("Dev 3 days ago", "Dev"),
        ("Dev 1 day ago", "Dev"),
        ("Dev Contractor", "Dev Contractor"),
        ("Dev contract", "Dev contract"),
        ("Dev Full-time Quick apply", "Dev"),
        ("Dev Be an early applicant", "Dev"),
        ("Senior Software Developer Contract Listed today", "Senior Software Developer"),
        ("", ""),
    ]
    assert evaluate(text.listing_title, [(t,) for t, _ in cases], "t string") == [w for _, w in cases]


def test_result_id(evaluate):
    got = evaluate(text.result_id, [("https://H/a", "Títle "), ("", "")], "u string, t string")
    assert got == [hashlib.sha256(v.encode()).hexdigest() for v in ("https://h/a|títle", "|")]


def test_fallbacks_and_snippet(evaluate):
    assert evaluate(text.first_non_empty, [("", "b"), (None, None), ("a", "b")], "x string, y string") == ["b", "", "a"]
    body = "a \n\t b" * 2000
    want = __import__("re").sub(r"\s+", " ", body[:5000])
    assert evaluate(text.snippet, [(body,)], "t string") == [want]
