"""Dates of messages."""

from __future__ import annotations

from email.utils import parsedate_to_datetime
from datetime import timezone

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WEEKDAY = r"^\s*[A-Za-z]{3,9},\s*"
_COMMENT = r"\s*\([^)]*\)\s*$"


def rfc3339(x: Column) -> Column:
    """A timestamp as text in UTC; the session runs in UTC."""
    return F.date_format(x, "yyyy-MM-dd'T'HH:mm:ssxxx")


@F.pandas_udf(T.StringType())
def _obsolete(values: pd.Series) -> pd.Series:
    def read(v: str | None) -> str | None:
        if not v:
            return None
        try:
            d = parsedate_to_datetime(v)
        except (ValueError, TypeError, IndexError):
            return None
        d = d if d.tzinfo else d.replace(tzinfo=timezone.utc)
        return d.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S+00:00")

    return values.map(read)


def message_date(x: Column | str, obsolete_zones: bool = False) -> Column:
    """A Date header as RFC 3339 text in UTC; null if it can't be read.

    ``obsolete_zones`` also reads zone names and two-digit years, with Python.
    """
    c = F.col(x) if isinstance(x, str) else x
    bare = F.regexp_replace(F.regexp_replace(c, _WEEKDAY, ""), _COMMENT, "")
    at = F.coalesce(*(F.try_to_timestamp(bare, F.lit(p)) for p in ("d MMM yyyy HH:mm:ss xx", "d MMM yyyy HH:mm xx", "d MMM yyyy HH:mm:ss z")))
    text = rfc3339(at)
    return F.coalesce(text, _obsolete(c)) if obsolete_zones else text
