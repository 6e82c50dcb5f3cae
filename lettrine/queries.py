"""Queries of the core, by name, with the SQL that gives the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lettrine import pipeline_queries
from lettrine.operators import shred, upsert
from lettrine.workspace import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.parent_links(shred.shred(table(spark, sf_dir, "raw_bundles")))


def p1_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.contacts(shred.shred(table(spark, sf_dir, "raw_bundles"))).drop("doc", "node", "parent")


def p1_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.attachments(shred.shred(table(spark, sf_dir, "raw_bundles"))).drop("doc", "node", "parent")


def p1_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.messages(shred.shred(table(spark, sf_dir, "raw_bundles"))).drop("doc", "node", "parent")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.surplus_copies(table(spark, sf_dir, "parsed_emails"), table(spark, sf_dir, "message_index"))


_KEYED = r"""
WITH known AS (
  SELECT DISTINCT regexp_replace(m, '^[\s\p{Z}<>]+|[\s\p{Z}<>]+$', '', 'g') AS id FROM (SELECT unnest(message_ids) AS m FROM message_index)
), named AS (
  SELECT record_id, delivered_at, regexp_replace(message_id, '^[\s\p{Z}<>]+|[\s\p{Z}<>]+$', '', 'g') AS id FROM parsed_emails
), ranked AS (
  SELECT record_id, id IN (SELECT id FROM known WHERE id IS NOT NULL) AS old,
         row_number() OVER (PARTITION BY id ORDER BY delivered_at NULLS LAST, record_id) AS n
  FROM named WHERE id <> ''
)
"""


def _list(v: str) -> str:
    """SQL: the elements of a field that holds a list, one object, or a JSON text of either."""
    text = f"({v} ->> '$')"
    inner = f"CASE WHEN json_valid({text}) THEN {text}::JSON END"
    return f"CASE json_type({v}) WHEN 'ARRAY' THEN json_extract({v}, '$[*]') WHEN 'OBJECT' THEN [{v}] WHEN 'VARCHAR' THEN CASE json_type({inner}) WHEN 'ARRAY' THEN json_extract({inner}, '$[*]') WHEN 'OBJECT' THEN [{inner}] END END"


_MESSAGES = f"""
WITH RECURSIVE msg AS (
  SELECT raw_id, '$' AS path, payload::JSON AS j FROM raw_bundles WHERE json_valid(payload) AND json_type(payload::JSON) = 'OBJECT'
  UNION ALL
  SELECT raw_id, path || '.attachments[' || i || '].embedded' AS path, json_extract(x, '$.embedded') AS j FROM (
    SELECT raw_id, path, unnest(l) AS x, generate_subscripts(l, 1) - 1 AS i FROM (SELECT raw_id, path, {_list("json_extract(j, '$.attachments')")} AS l FROM msg))
  WHERE json_type(x) = 'OBJECT' AND json_type(json_extract(x, '$.embedded')) = 'OBJECT'
), objects AS (
  SELECT raw_id, path, field, unnest(l) AS x, generate_subscripts(l, 1) - 1 AS i FROM (
    SELECT raw_id, path, 'targets' AS field, {_list("json_extract(j, '$.targets')")} AS l FROM msg
    UNION ALL SELECT raw_id, path, 'cc', {_list("json_extract(j, '$.cc')")} FROM msg
    UNION ALL SELECT raw_id, path, 'attachments', {_list("json_extract(j, '$.attachments')")} FROM msg)
)
"""
_LINKS = f"""{_MESSAGES}
SELECT raw_id, path AS parent_path, path || '.' || field || '[' || i || ']' AS child_path FROM objects WHERE json_type(x) = 'OBJECT'
UNION ALL SELECT raw_id, regexp_replace(path, '\\.embedded$', ''), path FROM msg WHERE path <> '$'
"""


def _scalars(v: str, fields: tuple[str, ...]) -> str:
    """SQL: fields of an object as text, other JSON values as they are written."""
    return ", ".join(f"CASE WHEN json_type({v}, '$.{f}') = 'NULL' THEN NULL ELSE {v} ->> '$.{f}' END AS {f}" for f in fields)


_CONTACTS = f"""{_MESSAGES}
SELECT DISTINCT raw_id, parent_path, path, field, i AS ordinal, {_scalars("x", shred.CONTACT_FIELDS)} FROM (
  SELECT raw_id, path AS parent_path, path || '.' || field || '[' || i || ']' AS path, field, i, x FROM objects WHERE field IN ('targets', 'cc')
  UNION ALL SELECT raw_id, path, path || '.bcc[' || i || ']', 'bcc', i, x FROM (SELECT raw_id, path, unnest(l) AS x, generate_subscripts(l, 1) - 1 AS i FROM (SELECT raw_id, path, {_list("json_extract(j, '$.bcc')")} AS l FROM msg))
  UNION ALL SELECT raw_id, path, path || '.author', 'author', 0, json_extract(j, '$.author') FROM msg)
WHERE json_type(x) = 'OBJECT'
"""
_ATTACHMENTS = f"""{_MESSAGES}
SELECT DISTINCT raw_id, path AS parent_path, path || '.attachments[' || i || ']' AS path, field, i AS ordinal, {_scalars("x", shred.ATTACHMENT_FIELDS)} FROM objects WHERE field = 'attachments' AND json_type(x) = 'OBJECT'
"""
_MESSAGE_ROWS = f"""{_MESSAGES}
SELECT DISTINCT raw_id, CASE WHEN path <> '$' THEN regexp_replace(path, '\\.embedded$', '') END AS parent_path, path, CASE WHEN path <> '$' THEN 'embedded' ELSE '' END AS field, 0 AS ordinal, {_scalars("j", shred.MESSAGE_FIELDS)} FROM msg
"""


def queries() -> dict[str, Query]:
    own = (p1_found, p1_contacts, p1_attachments, p1_messages, p3_found)
    return pipeline_queries.queries() | {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return pipeline_queries.oracle_sql() | {"p1_found": _LINKS, "p1_contacts": _CONTACTS, "p1_attachments": _ATTACHMENTS, "p1_messages": _MESSAGE_ROWS, "p3_found": _KEYED + "SELECT record_id FROM ranked WHERE old OR n > 1"}
