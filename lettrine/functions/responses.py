"""Answers of remote services, judged as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Status codes after which a call may be repeated.
RETRYABLE = (408, 500, 502, 503, 504)


def _json(body: Column | str, path: str) -> Column:
    return F.get_json_object(body, path)


def is_retryable(status: Column, body: Column) -> Column:
    """429 unless the quota is spent, and the codes of passing failures."""
    spent = F.coalesce(_json(body, "$.error.code") == "insufficient_quota", F.lit(False)) | F.coalesce(_json(body, "$.error.type") == "insufficient_quota", F.lit(False))
    return ((status == 429) & ~spent) | status.isin(*RETRYABLE)


def retry_after_ms(after_ms: Column, after_s: Column, message: Column) -> Column:
    """Milliseconds to wait: the header in ms, else the header in s, else what the message says."""
    said = r"Please try again in (\d+)(ms|s)"
    amount = F.regexp_extract(message, said, 1).try_cast("long")
    return F.coalesce(
        F.when(after_ms.rlike(r"^\d+$"), after_ms.try_cast("long")), F.when(after_s.rlike(r"^\d+$"), after_s.try_cast("long") * 1000), F.when(F.regexp_extract(message, said, 2) == "ms", amount).when(F.regexp_extract(message, said, 2) == "s", amount * 1000)
    )


def is_conflict(body: Column) -> Column:
    return F.coalesce(_json(body, "$.error_summary").startswith("path/conflict/file/"), F.lit(False))


def output_json(payload: Column) -> Column:
    """The JSON that a model answered: the top-level text, else the first readable text or arguments."""
    top = _json(payload, "$.output_text")
    content = F.from_json(payload, "output array<struct<content:array<struct<text:string,arguments:string>>>>")
    texts = F.flatten(F.transform(F.flatten(F.transform(content["output"], lambda o: F.coalesce(o["content"], F.array()))), lambda x: F.array(x["text"], x["arguments"])))
    readable = F.filter(texts, lambda t: F.try_parse_json(t).isNotNull())
    return F.when(top.isNotNull(), F.when(F.try_parse_json(top).isNotNull(), top)).otherwise(F.get(readable, F.lit(0)))
