"""Log identity and app version: P14–P17."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtrail import fixed_values as fixed


def epoch_to_time(seconds: Column) -> Column:
    """Epoch seconds as a timestamp without zone."""
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        zero, zero, zero, seconds.cast("decimal(18,6)")
    )


def time_to_epoch(time: Column) -> Column:
    """Whole epoch seconds of a timestamp without zone."""
    return F.unix_seconds(time.cast("timestamp"))


def encode_log_hash(imei: Column, start: Column) -> Column:
    """64-bit identity: last nine IMEI digits, then start seconds."""
    high = F.pmod(imei.cast("bigint"), F.lit(fixed.IMEI_MODULUS).cast("bigint"))
    return high * F.lit(fixed.HALF).cast("bigint") + time_to_epoch(start)


def log_hash_imei(log_hash: Column) -> Column:
    """Last nine IMEI digits held by an identity."""
    return F.shiftrightunsigned(log_hash, 32)


def log_hash_epoch(log_hash: Column) -> Column:
    """Start seconds held by an identity."""
    return log_hash.bitwiseAND(F.lit(fixed.LOW_MASK).cast("bigint"))


def log_month(log_hash: Column, offset_ms: Column) -> Column:
    """``YYYY_MM`` of the log start on the log's own clock."""
    seconds = log_hash_epoch(log_hash).cast("decimal(18,6)")
    offset = (offset_ms.cast("decimal(18,6)") / F.lit(1000)).cast("decimal(18,6)")
    return month_of(epoch_to_time(seconds + offset))


def month_of(time: Column) -> Column:
    """``YYYY_MM`` of a timestamp."""
    return F.date_format(time, "yyyy_MM")


def app_version(text: Column) -> Column:
    """``v3.0.562`` as 3000562; 0 when it cannot be read."""
    parts = F.split(F.regexp_replace(text, "v", ""), r"\.")
    number = [F.get(parts, F.lit(i)).try_cast("bigint") for i in range(3)]
    value = number[0] * 1000000 + number[1] * 1000 + number[2]
    return F.coalesce(value, F.lit(0).cast("bigint"))
