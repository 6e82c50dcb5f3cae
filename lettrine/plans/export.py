"""Bundles as files: ``<folder>/<stem>/<name>``, its JSON and its XML."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrine.operators import dedup
from lettrine.sources.files import Folder


def files(rows: DataFrame) -> DataFrame:
    """(folder, stem, position, file_stem, content, json, xml): stems of one message are told apart by numbers."""
    keyed = rows.withColumn("_dir", F.concat_ws("/", "folder", "stem"))
    named = dedup.number_collisions(keyed, "_dir", "bundle_stem", ["folder", "stem", "position"], "file_stem")
    return named.select("folder", "stem", "position", "file_stem", F.col("attachments")[0]["original_name"].alias("name"), "content", "json", "xml")


def write(rows: DataFrame, base: str) -> DataFrame:
    """(folder, stem, position, error) after writing. A message whose files can't all be written keeps none of a failed document."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Folder(base)
        for batch in batches:
            errors = []
            for r in batch.to_pylist():
                folder = f"{r['folder']}/{r['stem']}"
                done = []
                try:
                    out.make(folder)
                    parts = [(r["file_stem"] + ".json", r["json"].encode()), (r["file_stem"] + ".xml", r["xml"].encode())]
                    if r["content"] is not None:
                        suffix = os.path.splitext(r["name"])[1]
                        # a document named like a sidecar keeps its name under another suffix
                        parts.append((r["name"] + ".bin" if suffix.lower() in (".json", ".xml") else r["file_stem"] + suffix, r["content"]))
                    for name, data in parts:
                        out.write(f"{folder}/{name}", data)
                        done.append(f"{folder}/{name}")
                    errors.append(None)
                except OSError as e:
                    for at in done:
                        out.remove(at)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([batch.column("folder"), batch.column("stem"), batch.column("position"), pa.array(errors, pa.string())], names=["folder", "stem", "position", "error"])

    return files(rows).mapInArrow(each, "folder string, stem string, position int, error string")
