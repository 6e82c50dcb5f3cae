"""Shredding of nested JSON records into an adjacency table and entity tables.

``shred`` turns every payload into one row per node: node, parent, label,
ordinal, scalar.  ``entities`` joins the object nodes with their scalar children
and pivots them into flat tables of messages, contacts and attachments, each row
holding the path of its parent.

Defined results for odd input:

* null, blank or unreadable payloads, and payloads whose top level is not an
  object, have no nodes;
* ``targets``, ``cc``, ``bcc`` and ``attachments`` may be missing, null, a list,
  a single object (taken as a list of one) or a JSON text that holds either;
  null and non-object elements keep their place but give no entity;
* identical repeated rows give one set of entities; two different payloads under
  one id give two sets, told apart by ``doc``;
* other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTACT_LISTS = ("targets", "cc", "bcc")
LISTS = (*CONTACT_LISTS, "attachments")
CONTACT_FIELDS = ("raw", "name", "address")
MESSAGE_FIELDS = ("message_id", "subject", "expedition_date", "parsing_folder", "email_folder", "email_file_name")
ATTACHMENT_FIELDS = ("original_name", "is_email_body", "mime_type", "size", "md5", "extracted_text", "extracted_text_method", "extracted_text_truncated")

ADJACENCY = "raw_id long, doc long, node int, parent int, label string, ordinal int, role string, path string, parent_path string, scalar string"
_ARROW = pa.schema([
    ("raw_id", pa.int64()), ("doc", pa.int64()), ("node", pa.int32()), ("parent", pa.int32()), ("label", pa.string()),
    ("ordinal", pa.int32()), ("role", pa.string()), ("path", pa.string()), ("parent_path", pa.string()), ("scalar", pa.string()),
])


def _refuse(name: str) -> None:
    raise ValueError(name)


_decode = json.JSONDecoder(parse_constant=_refuse).decode


def read_json(text: str | None) -> object:
    """The value of a JSON text; None if it can't be read."""
    if not text:
        return None
    try:
        return _decode(text.lstrip("﻿"))
    except RecursionError:
        limit = sys.getrecursionlimit()
        sys.setrecursionlimit(100_000)
        try:
            return _decode(text.lstrip("﻿"))
        except (ValueError, RecursionError):
            return None
        finally:
            sys.setrecursionlimit(limit)
    except ValueError:
        return None


def _text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def _elements(value: object) -> list:
    if isinstance(value, str) and value.lstrip()[:1] in ("[", "{"):
        value = read_json(value)
    return value if isinstance(value, list) else [value]


def nodes(payload: str | None) -> Iterator[tuple]:
    """(node, parent, label, ordinal, role, path, parent_path, scalar) of a payload, parents first."""
    root = read_json(payload)
    if not isinstance(root, dict):
        return
    last = 0
    todo: list[tuple] = [(root, 0, "", 0, "message", "$", None)]
    while todo:
        value, parent, label, ordinal, role, path, parent_path = todo.pop()
        last += 1
        node = last
        yield node, parent, label, ordinal, role, path, parent_path, None
        for key, x in value.items():
            if role == "message" and key in LISTS:
                kind = "attachment" if key == "attachments" else "contact"
                for i, item in enumerate(_elements(x)):
                    if isinstance(item, dict):
                        todo.append((item, node, key, i, kind, f"{path}.{key}[{i}]", path))
                    elif item is not None:
                        last += 1
                        yield last, node, key, i, "scalar", None, None, _text(item)
            elif isinstance(x, dict) and role == "message" and key == "author":
                todo.append((x, node, key, 0, "contact", f"{path}.author", path))
            elif role == "attachment" and key == "embedded" and (isinstance(x, dict) or isinstance(x, str) and isinstance(x := read_json(x), dict)):
                todo.append((x, node, key, 0, "message", f"{path}.embedded", path))
            elif x is not None:
                last += 1
                yield last, node, key, 0, "scalar", None, None, _text(x)


def _clean(x: object) -> object:
    return x.encode("utf-8", "replace").decode() if isinstance(x, str) else x


def shred(df: DataFrame, id_col: str = "raw_id", payload: str = "payload") -> DataFrame:
    """The adjacency table of the JSON texts in ``payload``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for raw_id, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.extend((raw_id, doc, *n) for n in nodes(text))
                if len(rows) > 50_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        arrays = []
        for field, column in zip(_ARROW, columns, strict=True):
            try:
                arrays.append(pa.array(column, field.type))
            except UnicodeEncodeError:  # lone surrogates, written as \ud83d without its second half
                arrays.append(pa.array([_clean(x) for x in column], field.type))
        return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)

    return df.select(F.col(id_col).cast("long").alias("raw_id"), F.xxhash64(F.col(payload)).alias("doc"), F.col(payload).alias("payload")).mapInArrow(run, ADJACENCY)


def entities(adjacency: DataFrame, roles: str | tuple[str, ...], fields: tuple[str, ...]) -> DataFrame:
    """Object nodes of one role or several joined with their scalar children, pivoted into columns.

    Objects and their scalars meet under the key of the object.  Both sit in one
    input partition, so partial aggregation leaves one row for each object before
    the shuffle, and no group is larger than the fields of one object.
    """
    is_object = F.col("role").isin(*((roles,) if isinstance(roles, str) else roles))
    owner = F.when(is_object, F.col("node")).otherwise(F.col("parent"))
    rows = adjacency.where(is_object | ((F.col("role") == "scalar") & F.col("label").isin(*fields)))

    def own(c: str) -> Column:
        return F.max(F.when(is_object, F.col(c))).alias(c if c != "label" else "field")

    pivoted = [F.max(F.when(~is_object & (F.col("label") == f), F.col("scalar"))).alias(f) for f in fields]
    described = ["parent", "label", "ordinal", "path", "parent_path", *([] if isinstance(roles, str) else ["role"])]
    out = rows.groupBy("raw_id", "doc", owner.alias("node")).agg(*map(own, described), *pivoted)
    return out.where(F.col("path").isNotNull())


def contacts(adjacency: DataFrame) -> DataFrame:
    return entities(adjacency, "contact", CONTACT_FIELDS)


def attachments(adjacency: DataFrame) -> DataFrame:
    return entities(adjacency, "attachment", ATTACHMENT_FIELDS)


def messages(adjacency: DataFrame) -> DataFrame:
    return entities(adjacency, "message", MESSAGE_FIELDS)


def parent_links(adjacency: DataFrame) -> DataFrame:
    """(raw_id, parent_path, child_path) of contacts in targets and cc, of attachments and of embedded messages.

    All three entity tables come from one aggregate, so the payloads are read once.
    """
    all_of = entities(adjacency, ("contact", "attachment", "message"), (*CONTACT_FIELDS, *ATTACHMENT_FIELDS, *MESSAGE_FIELDS))
    linked = F.when(F.col("role") == "contact", F.col("field").isin("targets", "cc")).otherwise(F.col("parent_path").isNotNull())
    return all_of.where(linked).select("raw_id", "parent_path", F.col("path").alias("child_path")).distinct()
