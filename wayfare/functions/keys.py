"""Row keys: salted, joined and compact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare.constants import SALT_BUCKETS

def salt(primary_key: Column, buckets: int = SALT_BUCKETS) -> Column:
    """Bucket of a key, 0..buckets-1: the first 15 hex digits of its md5 weighted by powers of 8.

    A hex digit is eight times its high bit plus an octal digit, so the weighted sum is one octal
    number of the low parts and eight times one of the high bits.
    """
    digits = F.substring(F.md5(primary_key.cast("binary")), 1, 15)
    low = F.conv(F.translate(digits, "89abcdef", "01234567"), 8, 10).cast("long")
    high = F.conv(F.translate(digits, "0123456789abcdef", "0000000011111111"), 8, 10).cast("long")
    return F.pmod(low + high * 8, F.lit(buckets))


def salted_key(entity_id: Column, time: Column, buckets: int = SALT_BUCKETS) -> Column:
    """Four-digit salt of ``id_time`` and 12 hex digits of the md5 of the id with the short time.

    Null when the id or the time is.
    """
    prefix = F.lpad(salt(F.concat(entity_id, F.lit("_"), time), buckets).cast("string"), 4, "0")
    short = F.concat(entity_id, F.lit("_"), F.substr(time, F.lit(3)))
    return F.concat(prefix, F.substring(F.md5(short.cast("binary")), 1, 12))


def split_keys(regions: int) -> list[str]:
    """Upper boundaries of the key ranges: the four-digit index followed by a vertical bar."""
    return [f"{i:04d}|" for i in range(regions)]


def key_range(rowkey: Column) -> Column:
    """Range a row falls in: a key with salt *i* sorts below boundary *i* and above boundary *i-1*."""
    return F.substring(rowkey, 1, 4).cast("int")


def live_key(city: Column, order: Column) -> Column:
    return F.concat_ws("_", city, order)


def live_key_order(key: Column) -> Column:
    """Inverse of :func:`live_key`: drops the six-digit city and the underscore."""
    return F.substring(key, 8, 2147483647)


def compact_departure(order: Column, day: Column, time: Column) -> Column:
    """``<order>_<yyyyMMddHHmmss>``."""
    return F.concat_ws("_", order, F.concat(F.translate(day, "-", ""), F.translate(time, ":", "")))
