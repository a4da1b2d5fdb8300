"""Keys of snapshots: a UTC minute as ``YYYY-MM-DD_HHMM``."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

PATTERN = "yyyy-MM-dd_HHmm"
KEY = r"_(\d{4}-\d{2}-\d{2}_\d{4})(?:\.[a-z]+)?(?:/|$)"


def snapshot_key(ts: datetime) -> str:
    """The key of a time; one without a zone is taken as UTC."""
    return (ts.astimezone(UTC) if ts.tzinfo else ts).strftime("%Y-%m-%d_%H%M")


def snapshot_ts(path: Column | str) -> Column:
    """The time in a snapshot's path; null if there is none."""
    key = F.regexp_extract(path, KEY, 1)
    return F.try_to_timestamp(F.when(key != "", key), F.lit(PATTERN)).cast("timestamp_ntz")
