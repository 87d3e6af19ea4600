"""The fixtures and shared steps of the registered queries, in DuckDB SQL.

``query("a", "b", select=...)`` gives a statement with the named common table
expressions and everything they need.
"""

from __future__ import annotations

from postings.operators.providers import DOMAIN_NOT_ALLOWED, DUPLICATE_URL, MISSING_URL
from postings.settings import SITE_FILTERS

from .fixtures import HOSTS, NAMES, PAGE_DOMAINS, PATHS, QUERIES, SPLIT_TS


def texts(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def chain(expression: str, replacements) -> str:
    for old, new in replacements:
        expression = f"replace({expression}, '{old}', '{new}')"
    return expression


def decode(expression: str) -> str:
    """The references that occur in the pages, decoded once; HTML allows these without ``;``."""
    for name, character in (
        ("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")
    ):
        expression = f"regexp_replace({expression}, '&{name};?', '{character}', 'g')"
    return expression


def collapse(expression: str) -> str:
    return rf"trim(regexp_replace({expression}, '\s+', ' ', 'g'))"


def plain(expression: str) -> str:
    return collapse(decode(f"regexp_replace({expression}, '<[A-Za-z/!?][^>]*>', ' ', 'g')"))


def provider(key: str) -> str:
    return f"{texts(NAMES)}[{key} % 5 + 1]"


def host(url: str) -> str:
    return f"lower(regexp_extract({url}, '^[a-z]+://([^/?#]*)', 1))"


def below(host_name: str, domains) -> str:
    tests = " OR ".join(f"{host_name} = '{d.lower()}' OR ends_with({host_name}, '.{d.lower()}')" for d in domains)
    return f"({tests})" if tests else "false"


KEPT_PARAMETERS = r"""list_transform(
    list_filter(string_split(regexp_extract({url}, '\?([^#]*)', 1), '&'),
        lambda s: s <> '' AND NOT starts_with(lower(split_part(s, '=', 1)), 'utm_')
            AND lower(split_part(s, '=', 1)) NOT IN ('tracking', 'srsltid', 'gclid', 'fbclid', 'rsqid')),
    lambda s: CASE WHEN contains(s, '=') THEN s ELSE s || '=' END)"""


def kept_query(url: str) -> str:
    return f"array_to_string({KEPT_PARAMETERS.format(url=url)}, '&')"


def clean(url: str) -> str:
    """Canonical form of http(s) URLs without escapes."""
    kept = kept_query(url)
    return rf"""CASE WHEN {url} = '' THEN '' ELSE
        lower(regexp_extract({url}, '^[a-z]+://[^/?#]*'))
        || rtrim(regexp_extract({url}, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')
        || CASE WHEN {kept} = '' THEN '' ELSE '?' || {kept} END END"""


SPELLINGS = ((",", ""), ("nzd", "$"), ("per hour", "/h"), ("per hr", "/h"), ("an hour", "/h"),
             ("p/h", "/h"), ("ph", "/h"), ("–", "-"), ("—", "-"))


def rated(source: str, columns: str, text: str) -> str:
    """``columns`` of ``source`` with the rates of ``text``."""
    return rf"""SELECT {columns},
        CASE WHEN hint AND a BETWEEN 50 AND 300 AND b BETWEEN 50 AND 300 THEN least(a, b)
             WHEN hint THEN list_min(n[1:2]) END AS hourly_min,
        CASE WHEN hint AND a BETWEEN 50 AND 300 AND b BETWEEN 50 AND 300 THEN greatest(a, b)
             WHEN hint THEN list_max(n[1:2]) END AS hourly_max
    FROM (SELECT *,
            contains(t, '/h') OR contains(t, 'hour') OR contains(t, '+ gst') OR contains(t, 'contract rate') AS hint,
            try_cast(r.a AS DOUBLE) AS a, try_cast(r.b AS DOUBLE) AS b,
            list_filter(list_transform(regexp_extract_all(t, '\$?\s*(\d{{2,3}}(?:\.\d+)?)', 1),
                lambda x: try_cast(x AS DOUBLE)), lambda x: x BETWEEN 50 AND 300) AS n
        FROM (SELECT *, regexp_extract(t,
                '(?:\$\s*)?(\d{{2,3}}(?:\.\d+)?)\s*-\s*(?:\$\s*)?(\d{{2,3}}(?:\.\d+)?)', ['a', 'b']) AS r
            FROM (SELECT *, {chain(f"lower({text})", SPELLINGS)} AS t FROM {source})))"""


ANCHOR = (
    r"""(?is)^.*<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]+)"|''([^'']+)''|([^\s"''>]+))[^>]*>(.*)$"""
)
SILVER = """provider, scrape_mode, source, result_id, title, url, content, published, raw_json,
    hourly_min, hourly_max, first_seen_at, last_seen_at"""
GOLD = "provider, scrape_mode, source, result_id, title, url, content, hourly_min, hourly_max, last_seen_at"

RULE = f"""CASE provider
    WHEN 'seek' THEN {below(host("url"), ("seek.co.nz", "nz.seek.com"))}
        AND (contains(lower(url), '/job/') OR contains(lower(url), '-jobs/in-') OR contains(lower(url), '/jobs/in-'))
    WHEN 'trademe' THEN {below(host("url"), ("trademe.co.nz",))}
        AND contains(lower(url), 'trademe.co.nz') AND contains(lower(url), '/auckland/')
    WHEN 'indeed' THEN {below(host("url"), ("indeed.com",))} AND contains(lower(url), 'indeed.com')
    ELSE true END"""
LISTED = f"""CASE provider
    WHEN 'seek' THEN {below("h", ("seek.co.nz", "nz.seek.com"))}
    WHEN 'trademe' THEN {below("h", ("trademe.co.nz",))}
    WHEN 'indeed' THEN {below("h", ("indeed.com",))}
    ELSE {below("h", SITE_FILTERS)} END"""
STAMP = "TIMESTAMP '2026-01-15 12:00:00'"
MARKERS = " OR ".join(
    f"contains(lower(substring(body, 1, 5000)), '{m}')"
    for m in ("just a moment", "checking your browser", "challenge.cloudflare.com", "cf-chl",
              "captcha", "access denied", "bot detection")
)
BLOCKED = f"(status IN (403, 429, 503) AND (contains(server, 'cloudflare') OR {MARKERS}))"


def last_per_key(condition: str, first_seen: str) -> str:
    return f"""SELECT arg_max(provider, event_id) AS provider, arg_max(scrape_mode, event_id) AS scrape_mode,
        source, result_id, arg_max(title, event_id) AS title, arg_max(url, event_id) AS url,
        arg_max(content, event_id) AS content, '' AS published, arg_max(raw_json, event_id) AS raw_json,
        max_by(rate, event_id).v AS hourly_min, max_by(rate, event_id).v AS hourly_max,
        {first_seen}(ts) AS first_seen_at, max(ts) AS last_seen_at
    FROM event_rows WHERE {condition} GROUP BY source, result_id"""


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "order_urls": (
        (),
        f"""SELECT o_orderkey AS id, o_custkey AS cust, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE
            'https://' || {texts(HOSTS)}[o_orderkey % 8 + 1]
            || replace({texts(PATHS)}[o_orderkey // 8 % 5 + 1], '{{}}', o_custkey::VARCHAR)
            || {texts(QUERIES)}[o_orderkey // 40 % 7 + 1] END AS raw_url FROM orders""",
    ),
    "rate_texts": (
        (),
        """SELECT l_orderkey AS id, l_linenumber AS line, l_returnflag AS flag, l_linestatus AS status,
            l_shipdate AS seen, CASE l_orderkey % 7
                WHEN 0 THEN '$' || n || '/h'
                WHEN 1 THEN '$' || n || ' - $' || m || ' per hour'
                WHEN 2 THEN 'NZD ' || n || '.50 an hour'
                WHEN 3 THEN 'Rate ' || m || '-' || n || ' + GST'
                WHEN 4 THEN 'posted 2026-01-15, $1,' || n || ' ph'
                WHEN 5 THEN 'salary ' || l_partkey || ' only'
                ELSE 'was ' || l_suppkey || ' now ' || n || ' hourly rate' END AS text
        FROM (SELECT *, (l_partkey % 400)::VARCHAR AS n, (l_suppkey % 97 + 60)::VARCHAR AS m FROM lineitem)""",
    ),
    "text_rates": (("rate_texts",), rated("rate_texts", "id, line, flag, status, seen, text", "text")),
    "rate_silver": (
        ("text_rates",),
        f"""SELECT {provider("id")} AS provider, CASE WHEN status = 'F' THEN 'rss' ELSE 'html' END AS scrape_mode,
            flag AS source, id || '-' || line AS result_id, 'Role ' || id || '-' || line AS title,
            'https://h.nz/job/' || id || '-' || line AS url, text AS content, '' AS published, '{{}}' AS raw_json,
            hourly_min, hourly_max, seen AS first_seen_at, seen AS last_seen_at FROM text_rates""",
    ),
    "event_rows": (
        (),
        f"""SELECT event_id, ts, {provider("user_id")} AS provider,
            CASE WHEN user_id % 2 = 0 THEN 'rss' ELSE 'html' END AS scrape_mode, event_type AS source,
            user_id || '-' || hour(ts) % 4 AS result_id, 'Event ' || event_id AS title,
            'https://h.nz/e/' || event_id AS url, props AS content, '' AS published, props AS raw_json,
            CASE WHEN event_id % 3 <> 0 THEN value END AS hourly_min,
            CASE WHEN event_id % 3 <> 0 THEN value END AS hourly_max,
            {{'v': CASE WHEN event_id % 3 <> 0 THEN value END}} AS rate FROM events""",
    ),
    "event_target": (("event_rows",), last_per_key(f"ts < TIMESTAMP '{SPLIT_TS}'", "min")),
    "event_silver": (("event_rows",), last_per_key("true", "min")),
    "event_batch": (("event_rows",), last_per_key(f"ts >= TIMESTAMP '{SPLIT_TS}'", "max")),
    "event_merged": (
        ("event_target", "event_batch"),
        f"""SELECT b.* REPLACE (coalesce(t.first_seen_at, b.first_seen_at) AS first_seen_at)
        FROM event_batch b LEFT JOIN event_target t USING (source, result_id)
        UNION ALL BY NAME SELECT {SILVER} FROM event_target t
        WHERE NOT EXISTS (FROM event_batch b WHERE b.source = t.source AND b.result_id = t.result_id)""",
    ),
    # One row per line of a document: the items of its feed.
    "lines": (
        (),
        """SELECT doc_id, i - 1 AS pos, parts[i] AS line, len(parts) AS n,
            CASE (i - 1) % 4
                WHEN 0 THEN 'https://www.seek.co.nz/job/' || doc_id % 97 || '/?utm_source=f&p=' || (i - 1)
                WHEN 1 THEN 'https://www.trademe.co.nz/a/jobs/auckland/' || doc_id % 97 || '-' || (i - 1)
                WHEN 2 THEN 'https://NZ.indeed.com/viewjob?jk=' || doc_id % 97 || '&gclid=1'
                ELSE 'https://other.example.org/' || doc_id % 97 END AS url
        FROM (SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i
            FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))""",
    ),
    "feed_items": (
        ("lines",),
        """SELECT doc_id, pos, 'doc ' || doc_id AS title, url,
            '$' || (doc_id % 250 + 50) || ' per hour. ' || line AS content,
            CASE WHEN pos % 2 = 0 THEN 'day ' || pos ELSE '' END AS published FROM lines""",
    ),
    "page_text": (
        (),
        r"""SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(html,
            '(?is)<!--.*?-->', ' ', 'g'), '(?is)<script\b.*?</script\s*>', ' ', 'g'),
            '(?is)<style\b.*?</style\s*>', ' ', 'g') AS page FROM pages""",
    ),
    "titles": (
        ("page_text",),
        rf"""SELECT page_id, coalesce({plain(
            r"regexp_extract_all(page, '(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>', 1)[-1]")}, '') AS page_title
        FROM page_text""",
    ),
    "anchors": (
        ("page_text",),
        rf"""SELECT page_id, url AS page_url, pos, {decode("h.a || h.b || h.c")} AS href,
            {decode(plain("h.body"))} AS text
        FROM (SELECT page_id, url, i - 1 AS pos, regexp_extract(parts[i], '{ANCHOR}', ['a', 'b', 'c', 'body']) AS h
            FROM (SELECT page_id, url, parts, unnest(generate_series(1, len(parts) - 1)) AS i
                FROM (SELECT page_id, url, regexp_split_to_array(page, '(?i)</a\s*>') AS parts FROM page_text)))
        WHERE h.a || h.b || h.c <> ''""",
    ),
    "page_items": (
        ("anchors", "titles"),
        f"""SELECT page_id, pos, coalesce(nullif(text, ''), nullif(page_title, ''), link) AS title, link AS url,
            page_title || ' ' || coalesce(nullif(text, ''), nullif(page_title, ''), link) AS content, '' AS published
        FROM (SELECT *, regexp_extract(page_url, '^[a-z]+://[^/?#]*') || href AS link FROM anchors)
        JOIN titles USING (page_id) WHERE {below(host("link"), PAGE_DOMAINS)}
        QUALIFY row_number() OVER (PARTITION BY page_id, link ORDER BY pos) = 1""",
    ),
    # The page results as raw results of a run: two providers' worth of order columns.
    "page_results": (
        ("page_items",),
        f"""SELECT page_id AS response_id, page_id AS query_ord, pos, page_id % 5 AS provider_ord,
            page_id % 2 AS mode_ord, {provider("page_id")} AS provider,
            CASE WHEN page_id % 2 = 0 THEN 'rss' ELSE 'html' END AS mode, title, url, content, published
        FROM page_items""",
    ),
    "page_response": (
        (),
        """SELECT page_id, url AS request_url, CASE page_id % 10 WHEN 0 THEN 403 WHEN 1 THEN 429 WHEN 2 THEN 503
                WHEN 3 THEN 404 ELSE 200 END AS status,
            CASE WHEN page_id % 3 = 0 THEN 'cloudflare' ELSE 'nginx' END AS server,
            CASE WHEN page_id % 7 = 0 THEN 'application/pdf' ELSE 'text/html' END AS content_type,
            CASE WHEN page_id % 5 = 0 THEN 'Just a moment...' ELSE '' END || html AS body FROM pages""",
    ),
    # --- the whole run ---
    "run_pages": (
        (),
        f"""SELECT page_id * 2 AS response_id, page_id,
            CASE WHEN page_id % 2 = 0 THEN 'seek' ELSE 'trademe' END AS provider, 'html' AS mode,
            page_id AS query_ord, '' AS query,
            CASE WHEN page_id % 2 = 0 THEN 'https://www.seek.co.nz/page/' ELSE 'https://www.trademe.co.nz/page/' END
                || page_id AS request_url,
            CASE WHEN page_id % 10 = 5 THEN 503 ELSE 200 END AS status,
            CASE WHEN page_id % 3 = 0 THEN 'cloudflare' ELSE 'nginx' END AS server,
            CASE WHEN page_id % 11 = 0 THEN 'application/pdf' ELSE 'text/html' END AS content_type,
            replace(html, 'href="', CASE WHEN page_id % 2 = 0 THEN 'href="/job'
                ELSE 'href="/a/jobs/auckland/x/listing/' || page_id % 7 END) AS body
        FROM pages WHERE page_id % 20 <> 19""",
    ),
    "run_responses": (
        ("run_pages",),
        f"""SELECT response_id, provider, mode, query_ord, query, request_url,
            CASE WHEN {BLOCKED} THEN 'blocked by site protection' WHEN status >= 400 THEN 'request failed'
                WHEN content_type = 'application/pdf' THEN 'not html' END AS fetch_error,
            (query_ord % 2)::INT AS provider_ord, 1 AS mode_ord
        FROM run_pages
        UNION ALL SELECT doc_id * 2 + 1, {provider("doc_id")}, 'rss', doc_id, 'query ' || doc_id,
            'https://feeds.example.com/' || doc_id,
            CASE WHEN doc_id % 17 = 0 THEN 'request failed' WHEN doc_id % 13 = 0 THEN 'xml does not parse' END,
            (doc_id % 5)::INT, 0
        FROM documents""",
    ),
    "run_links": (
        ("anchors", "titles"),
        r"""SELECT page_id, pos, text, page_title, 'https://www.' || CASE WHEN page_id % 2 = 0
                THEN 'seek.co.nz/job' || href ELSE 'trademe.co.nz/a/jobs/auckland/x/listing/' || page_id % 7 || href
                END AS url
        FROM anchors JOIN titles USING (page_id) WHERE page_id % 20 <> 19
        QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1""",
    ),
    "run_items": (
        ("run_responses", "run_links", "feed_items"),
        rf"""SELECT r.provider, provider_ord, mode_ord, query_ord, r.response_id, pos, mode, title, url, content,
            published, CASE WHEN url = '' THEN '{MISSING_URL}' WHEN NOT {RULE} THEN '{DOMAIN_NOT_ALLOWED}' END
                AS reject_reason
        FROM run_responses r JOIN (
            SELECT doc_id * 2 + 1 AS response_id, pos, title, url, content, published FROM feed_items
            UNION ALL SELECT page_id * 2, pos, title, url,
                CASE WHEN page_id % 2 = 0 THEN page_title || ' ' || title ELSE title END, ''
            FROM (SELECT *, CASE WHEN page_id % 2 = 0 THEN fallback ELSE {collapse(
                r"regexp_replace(" + collapse("fallback") +
                r", '\s+(Listed\s+\w+|\d+\s+days?\s+ago|Be an early applicant|Quick apply|Job closes|Full-time|Part-time|Contract)\b.*$', '')"
            )} END AS title FROM (SELECT *, coalesce(nullif(text, ''), nullif(page_title, ''), url) AS fallback
                FROM run_links))
        ) i USING (response_id) WHERE fetch_error IS NULL""",
    ),
    "run_results": (
        ("run_items",),
        f"""SELECT *, coalesce(url_reason, CASE WHEN row_number() OVER (PARTITION BY clean_url, url_reason IS NULL
                ORDER BY provider_ord, mode_ord, query_ord, response_id, pos) > 1 THEN '{DUPLICATE_URL}' END) AS reason
        FROM (SELECT *, CASE WHEN clean_url = '' THEN '{MISSING_URL}' WHEN NOT {LISTED}
                THEN '{DOMAIN_NOT_ALLOWED}' END AS url_reason
            FROM (SELECT *, {host("clean_url")} AS h FROM (
                SELECT *, {clean("url")} AS clean_url FROM run_items WHERE reject_reason IS NULL)))""",
    ),
    "run_rated": (
        ("run_results",),
        rated("(FROM run_results WHERE reason IS NULL)", "* EXCLUDE (t, r, hint, a, b, n)",
              "title || chr(10) || content || chr(10) || clean_url"),
    ),
    "run_accepted": (
        ("run_rated",),
        f"""SELECT provider_ord, mode_ord, query_ord, response_id, pos, provider, mode AS scrape_mode,
            provider AS source, sha256(lower(trim(clean_url || '|' || title))) AS result_id, title,
            clean_url AS url, content, published, to_json(struct_pack(content := content, mode := mode,
                published := published, title := title, url := url))::VARCHAR AS raw_json,
            hourly_min, hourly_max, {STAMP} AS first_seen_at, {STAMP} AS last_seen_at FROM run_rated""",
    ),
    "run_batch": (
        ("run_accepted",),
        f"""SELECT {SILVER} FROM run_accepted QUALIFY row_number() OVER (PARTITION BY source, result_id
            ORDER BY provider_ord, mode_ord, query_ord, response_id, pos) = 1""",
    ),
    "run_rejected": (
        ("run_results", "run_items"),
        """SELECT provider_ord, mode_ord, query_ord, response_id, pos, 'ingest' AS stage, provider AS source, reason,
            title, clean_url AS url, substring(content, 1, 300) AS content FROM run_results WHERE reason IS NOT NULL
        UNION ALL SELECT provider_ord, mode_ord, query_ord, response_id, pos, 'provider', provider, reject_reason,
            title, url, substring(content, 1, 300) FROM run_items WHERE reject_reason IS NOT NULL""",
    ),
    # The payload that each usable response is in: 64 in a row of its provider.
    "run_parts": (
        ("run_responses",),
        """SELECT *, (row_number() OVER (PARTITION BY provider ORDER BY mode_ord, query_ord, response_id) - 1) // 64 AS part
        FROM run_responses WHERE fetch_error IS NULL""",
    ),
    "run_payloads": (
        ("run_items", "run_parts"),
        """SELECT provider, part, coalesce(results, []) AS results, queries, feed_urls, urls, modes
        FROM (SELECT provider, part,
                list(query ORDER BY query_ord, response_id) FILTER (mode = 'rss') AS queries,
                list(request_url ORDER BY query_ord, response_id) FILTER (mode = 'rss') AS feed_urls,
                list(request_url ORDER BY query_ord, response_id) FILTER (mode = 'html') AS urls,
                CASE WHEN bool_or(mode = 'rss') THEN ['rss'] ELSE [] END
                    || CASE WHEN bool_or(mode = 'html') THEN ['html'] ELSE [] END AS modes
            FROM run_parts GROUP BY ALL)
        LEFT JOIN (SELECT provider, part, list(struct_pack(title := title, url := url,
                content := content, published := published, mode := mode)
                ORDER BY mode_ord, query_ord, response_id, pos) AS results
            FROM run_items JOIN (SELECT response_id, part FROM run_parts) USING (response_id)
            WHERE reject_reason IS NULL GROUP BY ALL) USING (provider, part)""",
    ),
    "searches": (
        (),
        """SELECT p_partkey AS search_id, string_split(p_name, ' ')
                || CASE WHEN p_partkey % 2 = 0 THEN ['Auckland'] ELSE [] END
                || CASE WHEN p_partkey % 3 = 0 THEN ['contract'] ELSE [] END
                || CASE WHEN p_partkey % 7 = 0 THEN ['.NET C* ~x'] ELSE [] END AS keywords,
            low AS min_rate, CASE p_partkey % 3 WHEN 1 THEN low WHEN 2 THEN low + 50 END AS max_rate
        FROM (SELECT *, CASE WHEN p_partkey % 5 <> 0 THEN p_size + 100.0::DOUBLE END AS low FROM part)""",
    ),
    "search_terms": (
        ("searches",),
        """SELECT *, array_to_string(keywords, ' ') AS text, CASE WHEN min_rate IS NULL THEN []
                WHEN coalesce(max_rate, 0) <> 0 AND max_rate <> min_rate
                    THEN ['"$' || min_rate::BIGINT || '"', '"$' || max_rate::BIGINT || '"']
                ELSE ['"$' || min_rate::BIGINT || '"'] END AS terms,
            list_filter(keywords, lambda k: lower(k) NOT IN ('auckland', 'contract'))[1:3] AS roles,
            list_contains(list_transform(keywords, lambda k: lower(k)), 'auckland') AS local,
            list_contains(list_transform(keywords, lambda k: lower(k)), 'contract') AS contract
        FROM searches""",
    ),
}


def query(*names: str, select: str) -> str:
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in ordered:
            needs, body = CTES[name]
            for need in needs:
                add(need)
            ordered[name] = body

    for name in names:
        add(name)
    head = ",\n".join(f"{name} AS (\n    {body}\n)" for name, body in ordered.items())
    return (f"WITH {head}\n" if head else "") + select.strip()
