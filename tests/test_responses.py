from postings.functions import responses as r

PAGE = "<html><a href='/x'>x</a></html>"


def test_blocked(evaluate):
    rows = [
        (403, "Just a moment...", None, True),
        (403, "<html>checking your Browser", "nginx", True),
        (503, "", "cloudflare-nginx", True),
        (429, "x" * 5000 + "captcha", "", False),
        (429, "x" * 4993 + "captcha", "", True),
        (200, "captcha", "cloudflare", False),
        (403, PAGE, "nginx", False),
        (None, "captcha", "cloudflare", False),
    ]
    got = evaluate(r.is_blocked, [x[:3] for x in rows], "status int, body string, server string")
    assert got == [x[3] for x in rows]


def test_html_errors_in_order(evaluate):
    rows = [
        ("https://evil.nz/", 403, "captcha", "", "", r.NOT_IN_ALLOWLIST),
        ("https://h.nz/", 403, "captcha", "", "text/html", r.BLOCKED),
        ("https://h.nz/", 404, PAGE, "cloudflare", "text/html", r.FAILED),
        ("https://h.nz/", 200, PAGE, "", "application/pdf", r.NOT_HTML),
        ("https://h.nz/", 200, PAGE, "", None, r.NOT_HTML),
        ("https://h.nz/", 200, PAGE, "", "Text/HTML; charset=utf-8", None),
        ("https://a.h.nz/", 302, PAGE, "", "text/plain", None),
    ]
    schema = "url string, status int, body string, server string, content_type string"
    got = evaluate(lambda *c: r.html_error(*c, ["h.nz"]), [x[:5] for x in rows], schema)
    assert got == [x[5] for x in rows]


def test_feed_errors(evaluate):
    rows = [(500, "<rss>", r.FAILED), (200, "hello", r.NOT_XML), (200, " <RSS>", None), (200, "<?xml?>", None),
            (200, " " * 300 + "<rss>", r.NOT_XML), (200, "<feed>", None), (200, None, r.NOT_XML)]
    got = evaluate(r.feed_error, [x[:2] for x in rows], "status int, body string")
    assert got == [x[2] for x in rows]
