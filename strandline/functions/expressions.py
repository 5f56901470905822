"""Column expressions shared by the operators.  All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
MINUTE_US = 60 * MICROS

# Fixed value: buckets of a fixed width are counted from this Monday.
BUCKET_ORIGIN_US = 946_857_600 * MICROS  # 2000-01-03 00:00:00 UTC

# Fixed value: the date in a file name is its first run of eight digits.
FILE_DATE_PATTERN = r"\d{8}"


def column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- time ------------------------------------------------------------------


def epoch_us(ts: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone (session in UTC)."""
    return F.unix_micros(column(ts).cast("timestamp"))


def from_us(us: str | Column, like: str) -> Column:
    """The instant ``us`` in the timestamp type named by ``like``."""
    return F.timestamp_micros(column(us)).cast(like)


def bucket_us(us: Column, width_us: int, offset_us: int = 0) -> Column:
    """Start of the fixed-width bucket that holds ``us``."""
    shift = (BUCKET_ORIGIN_US + offset_us) % width_us
    return us - F.pmod(us - F.lit(shift), F.lit(width_us))


def whole_div(number: Column, by: int) -> Column:
    """Floor division of whole numbers, exact also below zero."""
    return ((number - F.pmod(number, F.lit(by))) / F.lit(by)).cast("bigint")


def minute_no(ts: str | Column) -> Column:
    """Number of whole minutes since 1970."""
    return whole_div(epoch_us(ts), MINUTE_US)


def minute_boundaries(earlier: str | Column, later: str | Column) -> Column:
    """Minute marks crossed between two instants (not whole minutes elapsed)."""
    return minute_no(later) - minute_no(earlier)


def checked_date(year: Column, month: Column, day: Column) -> Column:
    """A date, or NULL where the calendar has no such day."""
    parts = [p.cast("int") for p in (year, month, day)]
    midnight = F.try_make_timestamp_ntz(*parts, F.lit(0), F.lit(0), F.lit(0))
    return midnight.cast("date")


# --- file names ------------------------------------------------------------


def file_date_text(name: str | Column) -> Column:
    """The first eight digits in a row of a file name, or an empty text."""
    return F.regexp_extract(column(name), FILE_DATE_PATTERN, 0)


def file_date(digits: str | Column) -> Column:
    """The day that eight digits stand for; NULL if the calendar has no such day."""
    text = column(digits)
    # Year 0000 is no year of the calendar the deliveries use.
    real = (text != "") & ~text.startswith("0000")
    return F.when(real, F.try_to_date(text, "yyyyMMdd"))


# --- keys and hashes -------------------------------------------------------


def surrogate_key(*parts: str | Column, sep: str = "") -> Column:
    """Sixteen-byte key from the texts of a business key and its context."""
    return F.unhex(F.md5(F.concat_ws(sep, *[column(p).cast("string") for p in parts])))


def version_id(key: Sequence[str] | str, ts: str | Column) -> Column:
    """Text id of one version of one key, to the microsecond.

    Each part of the key is led by its length, and NULL has a mark of its own, so
    different keys never spell the same text.
    """
    keys = [key] if isinstance(key, str) else list(key)
    texts = [F.col(k).cast("string") for k in keys]
    parts = [
        F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~"))
        for t in texts
    ]
    stamp = F.date_format(column(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", *parts, stamp))


def digest_mod(hex_digest: str | Column, mod: int) -> Column:
    """A 256-bit hexadecimal number modulo ``mod``.

    Read from the left in pieces of at most fifteen digits, so that no
    intermediate value leaves 63 bits.
    """
    if not 0 < mod < 2**31:
        raise ValueError("mod must lie between 1 and 2**31 - 1")
    digest = column(hex_digest)
    shift = 16**15 % mod
    rest = F.lit(0).cast("bigint")
    for start, length in ((1, 4), (5, 15), (20, 15), (35, 15), (50, 15)):
        piece = F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")
        rest = (rest * F.lit(shift) + piece) % F.lit(mod)
    return rest


# --- plumbing --------------------------------------------------------------


def has_text(c: str | Column) -> Column:
    """True if anything but white space (also tabs and line ends) is there."""
    return F.coalesce(column(c).rlike(r"\S"), F.lit(False))
