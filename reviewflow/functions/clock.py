"""Log timestamps and display time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: zone in which the dashboards show time.
DISPLAY_ZONE = "Asia/Ho_Chi_Minh"

LOG_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def log_second(text: str | Column) -> Column:
    """Second-precision UTC wall time of an ISO log stamp; NULL if unreadable."""
    value = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(F.substring(value, 1, 19), F.lit(LOG_FORMAT)).cast("timestamp_ntz")


def local_time(utc: str | Column, zone: str = DISPLAY_ZONE) -> Column:
    """UTC wall time shifted to the display zone."""
    value = F.col(utc) if isinstance(utc, str) else utc
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), value.cast("timestamp_ntz"))


def clock_label(local: Column) -> Column:
    return F.date_format(local, "HH:mm:ss")
