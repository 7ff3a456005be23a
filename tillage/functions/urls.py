"""URL canonical form, domain, validity and document type, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Query keys that only track visitors; keys that start with utm_ are dropped too.
TRACKING_KEYS = ("fbclid", "gclid", "gclsrc", "mc_cid", "mc_eid", "msclkid", "spm", "yclid")

#: RFC 3986, appendix B: scheme, authority, path, query.
_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.trim(url), _PARTS, group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def authority(url: Column) -> Column:
    """Host with port and user, lower-cased, without the scheme's default port."""
    raw, s = F.lower(_part(url, 2)), scheme(url)
    return F.when(s == "http", F.regexp_replace(raw, ":80$", "")).when(s == "https", F.regexp_replace(raw, ":443$", "")).otherwise(raw)


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), F.replace(c, F.lit("+"), F.lit(" ")))


def _encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _pair(token: Column) -> Column:
    key = F.substring_index(token, "=", 1)
    value = F.when(F.contains(token, F.lit("=")), F.substring(token, F.length(key) + 2, F.length(token))).otherwise("")
    return F.struct(_decode(key).alias("k"), _decode(value).alias("v"))


def query_string(url: Column) -> Column:
    """The parameters that don't track, sorted by key and value and encoded again."""
    pairs = F.transform(F.filter(F.split(_part(url, 4), "&"), lambda t: t != ""), _pair)
    keep = F.filter(pairs, lambda p: ~(F.lower(p["k"]).isin(*TRACKING_KEYS) | F.startswith(F.lower(p["k"]), F.lit("utm_"))))
    return F.array_join(F.transform(F.array_sort(keep), lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")


def canonicalize(url: Column) -> Column:
    """Lower-case scheme and host, no default port, trailing slashes, tracking keys or fragment.

    Empty for null, and for URLs without a scheme or host.
    """
    s, host, q = scheme(url), authority(url), query_string(url)
    path = F.regexp_replace(_part(url, 3), "/+$", "")
    whole = F.concat(s, F.lit("://"), host, path, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    return F.when((s != "") & (_part(url, 2) != ""), whole).otherwise("")


def domain(canonical: Column) -> Column:
    """Host with port of a canonical URL."""
    return _part(canonical, 2)


def is_valid(url: Column) -> Column:
    return F.coalesce(scheme(url).isin("http", "https") & (_part(url, 2) != ""), F.lit(False))


def source_type(url: Column, hint: Column, channel: Column) -> Column:
    """pdf by the path, else the hint, else by the channel."""
    return (
        F.when(F.endswith(F.lower(_part(url, 3)), F.lit(".pdf")), "pdf")
        .when(F.coalesce(hint, F.lit("")) != "", hint)
        .when(channel == "scholarly", "scholarly_record")
        .when(channel == "web", "web_page")
        .otherwise("unknown")
    )
