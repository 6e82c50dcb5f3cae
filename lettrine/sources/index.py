"""The index of known message ids."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettrine.sources.files import Folder

VERSION = 2


def _place(path: str) -> tuple[Folder, str]:
    folder, _, name = path.rpartition("/")
    return Folder(folder or "."), name


def load(spark: SparkSession, path: str) -> DataFrame:
    """(id) of a JSON index, in any file system; a missing file is an empty index."""
    folder, name = _place(path)
    if not folder.exists(name):
        return spark.createDataFrame([], "id string")
    at = f"file://{folder.at(name)}" if folder.local else path
    return spark.read.schema("version int, message_ids array<string>").option("multiLine", "true").json(at).select(F.explode("message_ids").alias("id")).distinct()


def union(index: DataFrame, ids: DataFrame) -> DataFrame:
    return index.select("id").unionByName(ids.select("id")).where("id is not null").distinct()


def export(ids: DataFrame, path: str) -> None:
    """Write the index as one JSON file, ids sorted.

    The format is a single document, so this export goes through the driver row by
    row; the table of ids is the index that pipelines use.
    """
    folder, name = _place(path)
    folder.make()
    with folder.fs.open_output_stream(folder.at(f"{name}.part")) as f:
        f.write(b'{"version": %d, "message_ids": [' % VERSION)
        for i, r in enumerate(ids.select("id").distinct().orderBy(F.col("id").cast("binary")).toLocalIterator()):
            f.write((("," if i else "") + "\n  " + json.dumps(r[0], ensure_ascii=False)).encode("utf-8", "replace"))
        f.write(b"\n]}\n")
    folder.fs.move(folder.at(f"{name}.part"), folder.at(name))
