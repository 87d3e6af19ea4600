"""URL expressions: canonical form, relative resolution, host tests, form encoding.

``parse_url`` is not used: it returns NULL for URLs with spaces, ``|`` or no
scheme. The pieces are cut with plain string functions instead, so that every
input gives a result and no input fails the job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from urllib.parse import uses_netloc, uses_params

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, or_empty, strip

# Query parameters that only track visits.
TRACKING_PREFIXES = ("utm_",)
TRACKING_PARAMETERS = ("tracking", "srsltid", "gclid", "fbclid", "rsqid")
# Schemes whose last path segment may carry ;parameters, and schemes written with "//" even
# when the host is empty: those of Python's own URL functions.
SCHEMES_WITH_PARAMETERS = tuple(uses_params)
SCHEMES_WITH_HOST = tuple(uses_netloc)

_CONTROL_OR_SPACE = "".join(map(chr, range(0x21)))
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_PREFIX = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?"
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def _after(text: Column, prefix: Column, skip: int = 0) -> Column:
    return F.substring(text, F.length(prefix) + 1 + skip, F.length(text))


def _readable(url: Column) -> Column:
    """What URL parsers see: no leading controls or spaces, no tabs or line ends."""

    def readable(text: Column) -> Column:
        # Nearly all URLs are readable as they are; "!" is the first character behind the blanks.
        marred = (text < "!") | text.contains("\t") | text.contains("\r") | text.contains("\n")
        return F.when(marred, F.translate(F.ltrim(text, F.lit(_CONTROL_OR_SPACE)), "\t\r\n", "")).otherwise(text)

    return let(url, readable)


def host(url: Column) -> Column:
    """Lower-cased network location, with user and port if present; empty if none."""
    return F.lower(F.regexp_extract(_readable(or_empty(url)), _HOST, 1))


# --- host tests -----------------------------------------------------------


def host_in(host_name: Column, domains: Sequence[str] | Column) -> Column:
    """The host is one of the domains or below one of them. False for no domains."""
    if isinstance(domains, Column):
        return F.exists(
            domains,
            lambda d: (host_name == F.lower(d)) | host_name.endswith(F.concat(F.lit("."), F.lower(d))),
        )
    tests = [(host_name == d.lower()) | host_name.endswith("." + d.lower()) for d in domains]
    return reduce(or_, tests, F.lit(False))


def host_allowed(url: Column, domains: Sequence[str] | Column) -> Column:
    """Closed allowlist: an empty list allows nothing."""
    return let(host(url), lambda name: host_in(name, domains))


def domain_allowed(url: Column, domains: Sequence[str] | Column) -> Column:
    """Open allowlist: an empty list allows everything."""
    if isinstance(domains, Column):
        return (F.size(domains) <= 0) | host_allowed(url, domains)
    return host_allowed(url, domains) if domains else F.lit(True)


# --- form encoding --------------------------------------------------------


def form_decode(text: Column) -> Column:
    """Decode ``+`` and ``%XX``; a ``%`` that starts no escape stays as it is."""
    return F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def form_encode(text: Column) -> Column:
    """Encode for a query string: unreserved ``A-Za-z0-9_.-~``, space as ``+``."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def is_tracking(name: Column) -> Column:
    lowered = F.lower(name)
    tests = [lowered.startswith(p) for p in TRACKING_PREFIXES] + [lowered.isin(*TRACKING_PARAMETERS)]
    return reduce(or_, tests)


def _recoded(text: Column) -> Column:
    """Decoded and encoded again, which leaves plain text as it is."""
    return F.when(text.rlike(r"^[A-Za-z0-9_.~\-]*$"), text).otherwise(form_encode(form_decode(text)))


def clean_query(query: Column) -> Column:
    """Drop tracking parameters and empty segments; re-encode the others in order."""

    def pair(segment: Column) -> Column:
        return let(
            F.substring_index(segment, "=", 1),
            lambda name: F.when(
                ~is_tracking(F.when(name.rlike("[%+]"), form_decode(name)).otherwise(name)),
                F.concat(_recoded(name), F.lit("="), _recoded(_after(segment, name, 1))),
            ),
        )

    pairs = F.transform(F.split(query, "&"), lambda s: F.when(s != "", pair(s)))
    return F.array_join(pairs, "&")  # leaves out NULL


# --- whole URLs -----------------------------------------------------------


def _join(scheme: Column, authority: Column, path: Column, query: Column, fragment: Column) -> Column:
    """Put the parts together, each separator only where its part is non-empty."""
    rooted = F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    # Both tests below are for URLs without a host, which are rare.
    needs_slashes = path.startswith("//") | (
        (scheme != "") & scheme.isin(*SCHEMES_WITH_HOST) & ((path == "") | path.startswith("/"))
    )
    located = (
        F.when(authority != "", F.concat(F.lit("//"), authority, rooted))
        .when(needs_slashes, F.concat(F.lit("//"), path))
        .otherwise(path)
    )
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        located,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")),
    )


def _bracketed_host_is_broken(authority: Column) -> Column:
    return authority.contains("[") != authority.contains("]")


def _scheme(prefix: Column) -> Column:
    named = prefix.contains(":") & ~prefix.startswith("//")
    return F.when(named, F.lower(F.substring_index(prefix, ":", 1))).otherwise(F.lit(""))


def _authority(prefix: Column) -> Column:
    return F.when(prefix.contains("//"), F.substring_index(prefix, "//", -1)).otherwise(F.lit(""))


def canonical_url(url: Column) -> Column:
    """Canonical form used for de-duplication.

    Scheme and host are lower-cased, trailing slashes, ``;parameters``, tracking
    parameters and the fragment are dropped. NULL, blank and unparsable URLs give
    the empty string.
    """

    def split(readable: Column) -> Column:
        return let(
            F.substring_index(readable, "#", 1),
            lambda whole: let(
                F.substring_index(whole, "?", 1),
                lambda head: let(
                    F.regexp_extract(head, _PREFIX, 0), lambda prefix: locate(whole, head, prefix)
                ),
            ),
        )

    def locate(whole: Column, head: Column, prefix: Column) -> Column:
        parts = F.struct(
            _scheme(prefix).alias("scheme"),
            F.lower(_authority(prefix)).alias("authority"),
            _after(head, prefix).alias("path"),
            _after(whole, head, 1).alias("query"),
        )
        return let(parts, assemble)

    def assemble(p: Column) -> Column:
        # Segments may end in ;parameters, which go only where the scheme has them.
        bare = F.when(
            p["path"].contains(";") & p["scheme"].isin(*SCHEMES_WITH_PARAMETERS),
            F.regexp_replace(p["path"], ";[^/]*$", ""),
        ).otherwise(p["path"])
        joined = let(
            F.rtrim(bare, F.lit("/")),
            lambda path: _join(p["scheme"], p["authority"], path, F.lit(""), F.lit("")),
        )
        kept = let(
            clean_query(p["query"]),
            lambda query: F.when(query == "", query).otherwise(F.concat(F.lit("?"), query)),
        )
        whole = F.when(p["query"] == "", joined).otherwise(F.concat(joined, kept))
        return F.when(_bracketed_host_is_broken(p["authority"]), F.lit("")).otherwise(whole)

    return let(
        _readable(strip(or_empty(url))),
        lambda readable: F.when(readable == "", readable).otherwise(split(readable)),
    )


def base_parts(base: Column) -> Column:
    """The parts of a page URL that relative links need, as a struct.

    Compute it once per page, outside the per-link lambda.
    """
    readable = _readable(or_empty(base))
    whole = F.substring_index(readable, "#", 1)
    head = F.substring_index(whole, "?", 1)
    prefix = F.regexp_extract(head, _PREFIX, 0)
    path = _after(head, prefix)
    return F.struct(
        F.lower(F.regexp_extract(prefix, _SCHEME, 1)).alias("scheme"),
        F.regexp_extract(prefix, "//(.*)$", 1).alias("authority"),
        path.alias("path"),
        F.regexp_extract(path, "^(.*/)?", 0).alias("folder"),
        _after(whole, head, 1).alias("query"),
    )


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments."""

    def walk(segments: Column) -> Column:
        kept = F.aggregate(
            segments,
            F.array().cast("array<string>"),
            lambda out, s: F.when(s == ".", out)
            .when(s == "..", F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))))
            .otherwise(F.concat(out, F.array(s))),
        )
        ends_in_dots = F.element_at(segments, -1).isin(".", "..")
        return F.array_join(F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")

    dotted = path.rlike(r"(?:^|/)\.\.?(?:/|$)")
    return F.when(dotted, let(F.split(path, "/"), walk)).otherwise(path)


def first_slash(path: Column) -> Column:
    return F.coalesce(F.nullif(path, F.lit("")), F.lit("/"))


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` on a page whose :func:`base_parts` are ``base``.

    A link with another scheme (``mailto:``) is returned unchanged; the fragment
    is kept.
    """
    origin = F.concat(base["scheme"], F.lit("://"), base["authority"])
    # Nearly all links are plain rooted paths, for which no parsing is needed.
    plain = (
        href.startswith("/")
        & ~href.startswith("//")
        & ~href.contains("/.")
        & ~href.rlike(r"[\x00-\x20]|\?#|[?#]$")
        & (base["scheme"] != "")
        & (base["authority"] != "")
    )

    def parsed(readable: Column) -> Column:
        return let(
            F.regexp_extract(readable, _SCHEME, 1),
            lambda scheme: F.when((scheme != "") & (F.lower(scheme) != base["scheme"]), href).otherwise(
                let(F.when(scheme != "", _after(readable, scheme, 1)).otherwise(readable), cut)
            ),
        )

    def cut(rest: Column) -> Column:
        return let(
            F.substring_index(rest, "#", 1),
            lambda whole: let(F.substring_index(whole, "?", 1), lambda head: parts(rest, whole, head)),
        )

    def parts(rest: Column, whole: Column, head: Column) -> Column:
        return let(
            F.regexp_extract(head, "^//([^/]+)", 1),
            lambda given: let(
                F.when(given != "", _after(head, given, 2)).otherwise(head),
                lambda path: _on_base(base, given, path, _after(whole, head, 1), _after(rest, whole, 1)),
            ),
        )

    return F.when(plain, F.concat(origin, href)).otherwise(let(_readable(href), parsed))


def _on_base(base: Column, given: Column, path: Column, query: Column, fragment: Column) -> Column:
    """Complete the parts of a link; ``given`` is its own host, or empty."""
    # Empty segments disappear when a relative path is appended, except at the ends.
    appended = F.regexp_replace(F.concat(base["folder"], path), "/{2,}", "/")
    as_written = (given != "") | (path == "")
    target = (
        F.when(given != "", path)
        .when(path == "", base["path"])
        .when(path.startswith("/"), path)
        .otherwise(appended)
    )
    settled = let(target, lambda t: F.when(as_written, t).otherwise(first_slash(_without_dots(t))))
    authority = F.when(given != "", given).otherwise(base["authority"])
    inherits = (given == "") & (path == "") & (query == "")
    rest = F.struct(
        settled.alias("path"),
        authority.alias("authority"),
        F.when(inherits, base["query"]).otherwise(query).alias("query"),
        fragment.alias("fragment"),
    )
    return let(rest, lambda r: _join(base["scheme"], r["authority"], r["path"], r["query"], r["fragment"]))


def resolve_url(base: Column, href: Column) -> Column:
    """Row-level form of :func:`resolve` for plain columns."""
    return F.when(or_empty(base) == "", href).otherwise(let(base_parts(base), lambda b: resolve(b, href)))
