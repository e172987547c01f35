"""Text columns: white space, content hashes, signatures and keyword tokens."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as white space when stripping and
# collapsing (Unicode white space plus the four separators U+001C to U+001F),
# once as text and once as a regular expression class. The class guards the
# rare points above Latin-1 by one range test, which keeps ordinary text fast.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x85\xa0[\x{1680}-\x{3000}&&"
    r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]"
)
# A keyword token is two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
# How much of a topic enters its signature, and the settings that
# enter the run's configuration hash.
SIGNATURE_KEYWORDS = 10
SIGNATURE_DOMAINS = 5
CONFIG_HASH_KEYS = ("lookback_days", "bertopic", "rss_feeds", "dedupe_strategy")


def strip(text: Column) -> Column:
    """Remove white space at both ends (Spark's ``trim`` only knows U+0020)."""
    return F.btrim(text, F.lit(WHITESPACE))


def squeeze(text: Column) -> Column:
    """Turn every run of white space into one space and strip the ends."""
    return F.trim(F.regexp_replace(text, f"{WHITESPACE_CLASS}+", " "))


def content_hash(title: Column, summary: Column) -> Column:
    """SHA-256 (hex) of the lower-cased, white-space-normalised title and summary."""
    return F.sha2(squeeze(F.lower(F.concat(title, F.lit(" "), summary))), 256)


def url_hash(url: Column) -> Column:
    """First 16 hex digits of the URL's SHA-256; this is an item's id."""
    return F.substring(F.sha2(url, 256), 1, 16)


def text_length(title: Column, summary: Column) -> Column:
    """Number of code points in title and summary together."""
    return F.char_length(title) + F.char_length(summary)


def document_text(title: Column, summary: Column) -> Column:
    """The text that topic modelling sees."""
    return F.concat_ws(" ", title, summary)


def tokens(text: Column) -> Column:
    """Lower-cased keyword tokens of a text, in order, repeats included."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def _json_strings(values: Column) -> Column:
    """``"a", "b"``: the values as JSON strings, joined by comma and blank."""

    def quoted(value: Column) -> Column:
        in_array = F.to_json(F.array(value))
        return in_array.substr(F.lit(2), F.length(in_array) - 2)

    return F.array_join(F.transform(values, quoted), ", ")


def topic_signature(keywords: Column, domains: Column) -> Column:
    """SHA-256 (hex) over the leading keywords and domains, in the given order.

    The hashed text is the JSON object ``{"kw": [...], "pub": [...]}`` with a
    blank after every comma and colon and with non-ASCII text kept as it is.
    """
    return F.sha2(
        F.concat(
            F.lit('{"kw": ['),
            _json_strings(F.slice(keywords, 1, SIGNATURE_KEYWORDS)),
            F.lit('], "pub": ['),
            _json_strings(F.slice(domains, 1, SIGNATURE_DOMAINS)),
            F.lit("]}"),
        ),
        256,
    )


def config_hash(settings: Mapping[str, Any]) -> Column:
    """First 16 hex digits of the SHA-256 of the settings that shape results."""
    shaping = {key: settings[key] for key in CONFIG_HASH_KEYS if key in settings}
    rendered = json.dumps(shaping, sort_keys=True, ensure_ascii=False)
    return F.substring(F.sha2(F.lit(rendered), 256), 1, 16)
