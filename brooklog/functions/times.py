"""Timestamps without a zone, in UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(at: datetime | str) -> Column:
    text = at if isinstance(at, str) else at.isoformat()
    return F.lit(text.replace("T", " ").removesuffix("Z")).cast("timestamp_ntz")


def earlier(at: Column, amount: str) -> Column:
    """at less an interval such as '3 seconds'."""
    return at - F.expr(f"INTERVAL {amount}")


def rfc3339(at: Column) -> Column:
    """As text: fraction without trailing zeros, zone Z."""
    return F.concat(F.regexp_replace(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.?0+$", ""), F.lit("Z"))


def hour_of(at: Column) -> Column:
    return F.date_trunc("hour", at).cast("timestamp_ntz")
