"""Canonical URLs as column expressions: one spelling for each page, so that links can be compared."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Query parameters that only track a visit.
TRACKING_PREFIXES = ("utm_", "mc_", "pk_", "piwik_", "hsa_", "vero_")
TRACKING_NAMES = (
    "fbclid", "gclid", "dclid", "msclkid", "yclid", "twclid", "igshid", "mkt_tok",
    "ref", "ref_src", "referrer", "source", "src", "cmp", "cmpid", "campaign", "ito", "ncid",
    "intcmp", "ocid", "at_medium", "at_campaign", "at_custom1", "at_custom2", "at_custom3",
    "at_custom4", "at_bbc_team", "at_ptr_name", "at_link_origin", "at_link_type",
    "at_link_id", "at_format", "s", "sh", "smid", "smtyp", "partner", "output",
    "__twitter_impression", "cid", "_hsenc", "_hsmi", "guccounter", "guce_referrer",
    "guce_referrer_sig", "rss", "feed", "format",
)

#: scheme, authority, path, query of any text (RFC 3986, appendix B)
_PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def _decoded(part: Column) -> Column:
    """Well-formed percent escapes and plus signs resolved; a percent sign that begins none stays."""
    return F.try_url_decode(F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(part: Column) -> Column:
    """Form encoding that leaves letters, digits and ``_.-~`` alone."""
    return F.replace(F.replace(F.url_encode(part), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """https, lower-case host without www. and amp., no AMP ending, doubled or last slash, no tracking or blank parameters, the
    others sorted, no fragment."""
    text = F.regexp_replace(F.trim(F.regexp_replace(url, r"[\t\r\n]", "")), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    host = F.lower(F.regexp_extract(text, _PARTS, 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r"^amp\.", "")
    path = F.regexp_extract(text, _PARTS, 2)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    path = F.regexp_replace(F.regexp_replace(path, r"/amp/?$", "/"), r"/{2,}", "/")
    path = F.when((F.length(path) > 1) & path.endswith("/"), F.substring(path, 1, F.length(path) - 1)).otherwise(path)
    path = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    pairs = F.transform(
        F.filter(F.split(F.regexp_extract(text, _PARTS, 3), "&"), lambda p: p.rlike("(?s)=.")),
        lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.substring(p, F.instr(p, "=") + 1, F.length(p))).alias("v")),
    )

    def wanted(pair: Column) -> Column:
        name = F.lower(pair["k"])
        tracked = name.isin(*TRACKING_NAMES)
        for prefix in TRACKING_PREFIXES:
            tracked = tracked | name.startswith(prefix)
        return ~tracked

    query = F.array_join(F.transform(F.array_sort(F.filter(pairs, wanted)), lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    return F.concat(F.lit("https://"), host, path, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))


def url_hash(canonical: Column) -> Column:
    """SHA-1 of a canonical URL, in hex."""
    return F.sha1(canonical.cast("binary"))
