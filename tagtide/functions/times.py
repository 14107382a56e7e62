"""Reference times, recent windows and time buckets."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = datetime | str | None


def moment(as_of: AsOf = None) -> Column:
    """The reference time as a literal. None means the current UTC time."""
    if as_of is None:
        as_of = datetime.now(timezone.utc).replace(tzinfo=None)
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else str(as_of)
    return F.lit(text).cast("timestamp_ntz")


def cutoff(as_of: AsOf, interval: str) -> Column:
    """``as_of - interval``; folded to a constant, so scans can push it down."""
    amount, unit = interval.split()
    return moment(as_of) - F.expr(f"INTERVAL '{int(amount)}' {unit.rstrip('s')}")


def since(df: DataFrame, as_of: AsOf, interval: str, column: str = "processing_time") -> DataFrame:
    """Rows newer than ``as_of - interval``: strictly newer, no upper bound.

    Tables partitioned by the day ``dt`` are pruned to the days that can match.
    """
    edge = cutoff(as_of, interval)
    if "dt" in df.columns:
        df = df.filter(F.col("dt") >= F.to_date(edge))
    return df.filter(F.col(column) > edge)


def bucket(ts: Column, unit: str) -> Column:
    """Start of the minute, hour or day. ``date_trunc`` alone would add a time zone."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def parse_iso(c: Column) -> Column:
    """ISO text to a time without zone. An offset is ignored; bad text gives NULL."""
    return c.try_cast("timestamp_ntz")
