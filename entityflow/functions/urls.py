"""URL expressions: absolute links, canonical form, hash key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityflow.functions.text import as_col

SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
DOT_SEGMENT = r"/\.\.?(/|$)"

# Query parameters that only track the visitor. "Session ids" are these spellings.
TRACKING_PARAM = r"(?i)^(utm_[^=]*|ref|sid|sessionid|session_id|phpsessid|jsessionid)(=|$)"


def _without_dot_segments(path: Column) -> Column:
    """Fold '.' and '..' out of an absolute path, keeping a final slash they leave."""
    segments = F.split(path, "/")
    empty = F.array().cast("array<string>")
    kept = F.aggregate(
        F.slice(segments, 2, F.size(segments)),
        empty,
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    closes = path.rlike(r"/\.\.?$")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(closes & (F.size(kept) > 0), "/").otherwise(""))


def absolute_url(href, base) -> Column:
    """Join hrefs with a leading slash to the base; leave every other href alone."""
    href, base = as_col(href), as_col(base)
    scheme = F.regexp_extract(base, SCHEME, 1)
    authority = F.regexp_extract(base, AUTHORITY, 1)
    path = F.regexp_extract(href, r"^[^?#]*", 0)
    rest = F.substring(href, F.length(path) + 1, F.length(href))
    folded = F.when(path.rlike(DOT_SEGMENT), F.concat(_without_dot_segments(path), rest)).otherwise(href)
    return (
        F.when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(scheme, F.lit("://"), authority, folded))
        .otherwise(href)
    )


def canonical_url(url) -> Column:
    """One spelling per page: https, lower-case host, no tracking parameters, fragment or final slash.

    A text that is not an absolute URL is returned unchanged. The URL is cut
    into (scheme, authority, path, query) once, by one pattern.
    """
    url = as_col(url)

    def rebuilt(part: Column) -> Column:
        scheme, authority, path, query = (F.get(part, F.lit(i)) for i in range(4))
        host = F.when(
            authority.contains("@"),
            F.concat(F.regexp_extract(authority, r"^.*@", 0), F.lower(F.regexp_replace(authority, r"^.*@", ""))),
        ).otherwise(F.lower(authority))
        kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING_PARAM))
        tail = F.when(query == "", "").otherwise(
            F.array_join(F.transform(kept, lambda p, i: F.concat(F.when(i == 0, "?").otherwise("&"), p)), "")
        )
        https = F.when(F.lower(scheme) == "http", "https").otherwise(F.lower(scheme))
        return F.concat(https, F.lit("://"), host, F.rtrim(path, F.lit("/")), tail)

    # The pattern lists the parts between separators no URL contains.
    parts = F.split(F.regexp_replace(url, PARTS, "$1\u0001$2\u0001$3\u0001$4"), "\u0001")
    return F.coalesce(F.get(F.transform(F.filter(F.array(parts), lambda p: F.size(p) == 4), rebuilt), F.lit(0)), url)


def url_key(url) -> Column:
    """Row key of a page: sha256 of its canonical URL."""
    return F.sha2(canonical_url(url), 256)
