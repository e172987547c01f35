"""URL columns: canonical form, network location and registered domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.binding import bound, matched_groups
from newsloom.lineage import broadcast_if_small
from newsloom.sources.suffixes import suffix_depth

# Query parameters that only track where a reader came from.
TRACKING_PARAMETERS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "fbclid", "gclid", "msclkid", "_ga", "mc_cid", "mc_eid",
    "ref", "source", "campaign_id", "ad_id",
)
# Schemes whose last path segment may carry ";parameters".
PARAMETER_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps",
    "rtspu", "sip", "sips", "mms", "sftp", "tel", "imap",
)

# RFC 3986, appendix B: scheme, authority, path, query.
_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_AUTHORITY = 2
_CONTROLS_AND_BLANK = "".join(map(chr, range(0x21)))


def _unquote(text: Column) -> Column:
    """Decode ``+`` and ``%xx``; a ``%`` without two hex digits stays as it is."""
    return F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def _clean_query(query: Column) -> Column:
    """Decoded parameters without the tracking ones: first value per name, by name."""

    def parameter(segment: Column) -> Column:
        name = F.substring_index(segment, "=", 1)
        value = segment.substr(F.length(name) + 2, F.length(segment))
        return F.struct(_unquote(name).alias("name"), _unquote(value).alias("value"))

    segments = F.filter(F.split(query, "&"), lambda s: s != "")
    parameters = F.filter(
        F.transform(segments, parameter),
        lambda p: ~F.lower(p["name"]).isin(*TRACKING_PARAMETERS),
    )

    def rendered(kept: Column) -> Column:
        names = F.array_sort(F.array_distinct(F.transform(kept, lambda p: p["name"])))
        first = F.transform(
            names,
            lambda n: F.concat(n, F.lit("="), F.get(F.filter(kept, lambda p: p["name"] == n), F.lit(0))["value"]),
        )
        return F.array_join(first, "&")

    return bound(parameters, rendered)


def netloc(url: Column) -> Column:
    """Authority of a URL (user info, host and port), '' when there is none."""
    return F.regexp_extract(url, _URL, _AUTHORITY)


def normalize_url(url: Column, remove_params: bool = True) -> Column:
    """Canonical URL: lower-case scheme and authority, no fragment, no tracking.

    With ``remove_params`` the surviving query parameters are decoded, reduced
    to their first value and sorted by name; without it the query stays as is.
    """
    url = F.translate(F.ltrim(url, F.lit(_CONTROLS_AND_BLANK)), "\t\r\n", "")

    def glued(parts: Column) -> Column:
        scheme, authority, raw_path, raw_query = F.lower(parts[0]), F.lower(parts[1]), parts[2], parts[3]
        path = F.when(
            raw_path.endswith(";") & scheme.isin(*PARAMETER_SCHEMES),
            F.regexp_replace(raw_path, r"(?s)^((?:.*/)?[^/;]*);$", "$1"),
        ).otherwise(raw_path)
        query = raw_query
        if remove_params:
            query = F.when(raw_query == "", F.lit("")).otherwise(_clean_query(raw_query))
        return F.concat(
            F.when(scheme == "", F.lit("")).otherwise(F.concat(scheme, F.lit(":"))),
            F.when(authority == "", F.lit("")).otherwise(F.concat(F.lit("//"), authority)),
            path,
            bound(query, lambda q: F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q))),
        )

    return bound(matched_groups(url, _URL, 4), glued)


def host(url: Column) -> Column:
    """Lower-case host of a URL, without user info, port and trailing dots."""
    after_scheme = F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//", "")
    authority = F.regexp_extract(after_scheme, r"^[^/?#]*", 0)
    address = F.regexp_replace(authority, r"^.*@", "")
    bracketed = F.regexp_extract(address, r"^\[[^\]]*\]", 0)
    name = F.regexp_replace(F.trim(F.substring_index(address, ":", 1)), r"[.\x{3002}\x{ff0e}\x{ff61}]+$", "")
    return F.lower(F.when(bracketed != "", bracketed).otherwise(name))


def with_registered_domain(df: DataFrame, url: str, suffixes: DataFrame, into: str) -> DataFrame:
    """Add ``into``: public suffix plus one label of the URL's host.

    ``suffixes`` comes from :func:`newsloom.sources.suffixes.suffix_rules`. The
    host's endings, up to as many labels as the longest rule has, are each looked
    up by a left equi-join. The list has a few thousand short rows of known size and is
    broadcast, so no row of ``df`` is shuffled, however many of them share one
    host or one suffix.

    A host without a listed suffix keeps an empty suffix after the dot, and a
    leading ``www.`` of the result is dropped.
    """
    labels = F.col("_labels")
    looked_up = df.withColumn("_host", host(F.col(url))).withColumn(
        "_labels", F.split("_host", r"[.\x{3002}\x{ff0e}\x{ff61}]")
    )
    max_labels = suffix_depth(suffixes)
    suffixes = broadcast_if_small(suffixes)
    for depth in range(1, max_labels + 1):
        ending = F.when(F.size(labels) >= depth, F.array_join(F.slice(labels, -depth, depth), "."))
        rules = suffixes.select(
            F.col("suffix").alias(f"_suffix{depth}"),
            F.col("is_rule").alias(f"_rule{depth}"),
            F.col("is_wildcard").alias(f"_wild{depth}"),
            F.col("is_exception").alias(f"_except{depth}"),
        )
        looked_up = (
            looked_up.withColumn(f"_ending{depth}", ending)
            .join(rules, F.col(f"_ending{depth}") == F.col(f"_suffix{depth}"), "left")
            .drop(f"_ending{depth}", f"_suffix{depth}")
        )
    depths = range(1, max_labels + 1)
    excepted = F.coalesce(*[F.when(F.col(f"_except{d}"), F.lit(d - 1)) for d in reversed(depths)])
    longest = F.greatest(
        F.lit(0),
        *[F.when(F.col(f"_rule{d}"), F.lit(d)) for d in depths],
        *[F.when(F.col(f"_wild{d}") & (F.size(labels) > d), F.lit(d + 1)) for d in depths],
    )
    n_suffix = F.coalesce(excepted, longest)
    is_address = F.col("_host").rlike(r"^(\[.*\]|\d{1,3}(\.\d{1,3}){3})$")
    suffix = F.when(n_suffix > 0, F.array_join(F.slice(labels, -n_suffix, n_suffix), ".")).otherwise("")
    label = F.coalesce(F.try_element_at(labels, -(n_suffix + 1)), F.lit(""))
    domain = F.when(is_address & (n_suffix == 0), F.concat("_host", F.lit("."))).otherwise(
        F.concat(label, F.lit("."), suffix)
    )
    return looked_up.withColumn(into, F.regexp_replace(domain, r"^www\.", "")).select(*df.columns, into)
