"""Stage 1: messages of a mailbox to saved files, each message once."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettrine.functions import text as X
from lettrine.operators import dedup
from lettrine.plans import mime
from lettrine.sources.files import Folder
from lettrine.workspace import persisted


#: Columns of a message that its headers keep, and those that are read from it.
KEPT, TOLD = ("path", "direction", "folder", "seq"), ("id", "subject", "date", "contact")


def headers(messages: DataFrame) -> DataFrame:
    """Messages with id, subject, date and contact, without their contents; unreadable ones and those without an id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from email import message_from_bytes

        for batch in batches:
            places: list[int] = []
            rows: list[list] = []
            for i, (direction, raw) in enumerate(zip(batch.column("direction").to_pylist(), batch.column("content"), strict=True)):
                raw = raw.as_py()
                try:
                    m = message_from_bytes(raw, policy=mime.POLICY)
                    found = [mime._header(m, h) for h in ("Message-ID", "Subject", "Date", "From" if direction == "in" else "To")]
                except Exception:  # noqa: BLE001
                    continue
                places.append(i)
                rows.append(found)
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kept = [batch.column(c).take(pa.array(places, pa.int64())) for c in KEPT]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, pa.string()) for c in cols)], names=[*KEPT, *TOLD])

    asked = messages.select(*KEPT, "content")
    schema = T.StructType([*(asked.schema[c] for c in KEPT), *(T.StructField(c, T.StringType()) for c in TOLD)])
    return asked.mapInArrow(run, schema).withColumn("id", X.blank_to_null("id")).where("id is not null")


def to_save(messages: DataFrame, index: DataFrame, on_disk: DataFrame, recover: bool = False) -> DataFrame:
    """New messages once each, outgoing folders first; recovered ones with every copy. Rows have headers only."""
    rows = dedup.new_or_recoverable(persisted(headers(messages), "headers"), index, on_disk, recover)
    fresh = dedup.first_wins(rows.where(~F.col("recovered")), "id", [F.col("seq"), F.col("path")])
    return persisted(fresh.unionByName(rows.where("recovered")), "to-save")


def with_contents(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """The chosen and named messages with their bytes."""
    return rows.join(messages.select("path", "content"), "path")


def named(rows: DataFrame, group: bool = True) -> DataFrame:
    """The folder and file name under which each message is saved."""
    c = X.contact_info(F.coalesce("contact", F.lit("")))
    out = rows.withColumn("c", c).withColumn("contact_name", X.normalize_display_name("c.name")).withColumn("contact_email", F.col("c.email"))
    out = dedup.sticky_name(out, "contact_email", "contact_name", "seq")
    folder = X.contact_folder("sticky_name", "contact_email") if group else F.col("folder")
    marked = X.mark_direction(F.coalesce("subject", F.lit("")), F.col("direction") == "in")
    name = F.concat(X.stem_or(X.sanitize_file_name(marked, entities=True), "email"), F.lit(".eml"))
    return dedup.number_collisions(out.withColumn("target_folder", folder).withColumn("target", name), "target_folder", "target", ["seq", "path"], "file_name").drop("c", "target")


def save(rows: DataFrame, base: str) -> DataFrame:
    """(id, error) after writing the files below ``base``, a mounted folder or a URI; an id belongs into the index only once
    its file exists. The time of a file is that of its message where the file system can set it."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from email.utils import parsedate_to_datetime

        out = Folder(base)
        for batch in batches:
            ids, errors = [], []
            for i, folder, name, content, date in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(i)
                try:
                    out.make(folder)
                    out.write(f"{folder}/{name}", content)
                    try:
                        t = parsedate_to_datetime(date).timestamp()
                        if out.local:
                            os.utime(out.at(f"{folder}/{name}"), (t, t))
                    except (TypeError, ValueError, OverflowError):
                        pass
                    errors.append(None)
                except OSError as e:
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(errors, pa.string())], names=["id", "error"])

    return rows.select("id", "target_folder", "file_name", "content", "date").mapInArrow(each, "id string, error string")
