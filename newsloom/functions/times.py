"""Time columns: UTC wall clock, buckets and feed date parsing.

None of these depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.binding import bound, matched_groups
from newsloom.functions.text import strip

# Month names and the zone names of RFC 822, as UTC offsets.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
ZONES = {
    "": "+00:00", "z": "+00:00", "ut": "+00:00", "utc": "+00:00", "gmt": "+00:00",
    "est": "-05:00", "edt": "-04:00", "cst": "-06:00", "cdt": "-05:00",
    "mst": "-07:00", "mdt": "-06:00", "pst": "-08:00", "pdt": "-07:00",
}
# The two bucket widths a topic's counts can have.
BUCKET_INTERVALS = ("daily", "hourly")

_RFC822 = (
    r"^(?:[A-Za-z]+\.?,?\s+|[A-Za-z]+,)?(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*[\s,-]+(\d{4}|\d{2})"
    r"(?:\s+(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?)?\s*([A-Za-z]*|[+-]\d{2}:?\d{2})$"
)
_ASCTIME = r"^[A-Za-z]{3}\s+([A-Za-z]{3})\s+(\d{1,2})\s+(\d{1,2}):(\d{2}):(\d{2})\s+(?:([A-Za-z]+)\s+)?(\d{4})$"
_ISO8601 = (
    r"^(\d{4})(?:-?(\d{2})(?:-?(\d{2}))?)?"
    r"(?:[Tt\s]+(\d{2}):?(\d{2})(?::?(\d{2})(?:[.,]\d+)?)?\s*([A-Za-z]*|[+-]\d{2}:?\d{2}))?$"
)


def utc_wall(ts: Column) -> Column:
    """The instant as a zone-less UTC wall-clock timestamp."""
    seconds = (F.unix_micros(ts).cast("decimal(20,0)") / 1000000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def from_utc_wall(wall: Column) -> Column:
    """The instant that a zone-less UTC wall-clock timestamp names."""
    return F.concat(wall.cast("string"), F.lit("+00:00")).cast("timestamp")


def to_utc(wall: Column, zone: str | None = None) -> Column:
    """The instant of a zone-less wall-clock timestamp in ``zone`` (default UTC)."""
    if zone is None:
        return from_utc_wall(wall)
    return from_utc_wall(F.convert_timezone(F.lit(zone), F.lit("UTC"), wall))


def lookback_start(as_of: Column, days: int) -> Column:
    """The first instant inside a lookback of ``days`` before ``as_of``."""
    return F.timestamp_micros(F.unix_micros(as_of) - days * 86_400_000_000)


def daily_bucket(ts: Column) -> Column:
    """UTC day, ``2026-02-13``."""
    return F.substring(utc_wall(ts).cast("string"), 1, 10)


def hourly_bucket(ts: Column) -> Column:
    """UTC hour, ``2026-02-13T10:00:00+00:00``."""
    wall = utc_wall(ts).cast("string")
    return F.concat(F.substring(wall, 1, 10), F.lit("T"), F.substring(wall, 12, 2), F.lit(":00:00+00:00"))


def bucket(ts: Column, interval: str) -> Column:
    """Bucket label of an instant; ``interval`` is ``daily`` or ``hourly``."""
    if interval not in BUCKET_INTERVALS:
        raise ValueError(f"unknown bucket interval {interval!r}, expected one of {BUCKET_INTERVALS}")
    return daily_bucket(ts) if interval == "daily" else hourly_bucket(ts)


def bucket_instant(label: Column) -> Column:
    """The instant at which a daily or hourly bucket starts."""
    return F.when(F.length(label) == 10, F.concat(label, F.lit("T00:00:00+00:00"))).otherwise(label).cast("timestamp")


def _rendered(ts: Column, separator: str) -> Column:
    wall = utc_wall(ts).cast("string")
    micros = F.unix_micros(ts) % 1000000
    fraction = F.when(micros != 0, F.concat(F.lit("."), F.lpad(F.pmod(micros, F.lit(1000000)).cast("string"), 6, "0")))
    return F.concat(
        F.substring(wall, 1, 10), F.lit(separator), F.substring(wall, 12, 8), F.coalesce(fraction, F.lit("")),
        F.lit("+00:00"),
    )


def format_iso8601(ts: Column) -> Column:
    """``2026-02-13T10:00:00+00:00``; six decimals only when there are microseconds."""
    return _rendered(ts, "T")


def format_stored(ts: Column) -> Column:
    """The same with a blank for the ``T``: the form timestamps have in JSON files."""
    return _rendered(ts, " ")


def parse_iso8601(text: Column) -> Column:
    """ISO 8601 text to an instant; text without an offset is UTC; bad text is null."""
    has_zone = text.rlike(r"([Zz]|[+-]\d{2}:?\d{2})$") & text.rlike(r"\d[Tt ]\d")
    return F.when(has_zone, text.try_cast("timestamp")).otherwise(from_utc_wall(text.try_cast("timestamp_ntz")))


def _offset(zone: Column) -> Column:
    named = F.coalesce(
        *[F.when(F.lower(zone) == name, F.lit(offset)) for name, offset in ZONES.items()],
        F.lit("+00:00"),
    )
    digits = F.regexp_replace(zone, ":", "")
    numeric = F.concat(F.substring(digits, 1, 3), F.lit(":"), F.substring(digits, 4, 2))
    return F.when(zone.rlike(r"^[+-]"), numeric).otherwise(named)


def _assembled(year: Column, month: Column, parts: Column, order: str) -> Column:
    """The instant of matched date parts; ``order`` names them by one letter each."""

    def two(letter: str, default: str) -> Column:
        found = parts[order.index(letter)]
        return F.when(found == "", F.lit(default)).otherwise(F.lpad(found, 2, "0"))

    return F.concat(
        year, F.lit("-"), month, F.lit("-"), two("d", "01"), F.lit("T"),
        two("H", "00"), F.lit(":"), two("M", "00"), F.lit(":"), two("S", "00"), _offset(parts[order.index("z")]),
    ).try_cast("timestamp")


def _from_rfc822(parts: Column) -> Column:
    short = parts[2]
    century = F.when(F.length(short) == 4, F.lit("")).when(short < "90", F.lit("20")).otherwise(F.lit("19"))
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(parts[1])).cast("string")
    return _assembled(F.concat(century, short), F.lpad(month, 2, "0"), parts, "dmyHMSz")


def _from_asctime(parts: Column) -> Column:
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(parts[0])).cast("string")
    return _assembled(parts[6], F.lpad(month, 2, "0"), parts, "mdHMSzy")


def _from_iso8601(parts: Column) -> Column:
    month = F.when(parts[1] == "", F.lit("01")).otherwise(parts[1])
    return _assembled(parts[0], month, parts, "ymdHMSz")


def parse_feed_date(text: Column) -> Column:
    """RFC 822, ISO 8601 or ``Mon Jan 29 10:00:00 2024`` to an instant in whole seconds; else null.

    A date without a time is the start of its day in UTC.
    """
    text = strip(text)
    rfc822 = bound(matched_groups(text, _RFC822, 7), lambda p: F.when(F.size(p) == 7, _from_rfc822(p)))
    iso8601 = bound(matched_groups(text, _ISO8601, 7), lambda p: F.when(F.size(p) == 7, _from_iso8601(p)))
    asctime = bound(matched_groups(text, _ASCTIME, 7), lambda p: F.when(F.size(p) == 7, _from_asctime(p)))
    return F.coalesce(rfc822, iso8601, asctime)
