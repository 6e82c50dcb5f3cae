"""Mail folders as a data source, batch and stream.

``register(spark)`` adds the format ``mailbox``.  Its offline reader walks a folder
of ``.eml`` files; one input partition holds the files of one folder, cut into runs.
Names beginning with ``_`` or ``.``, which Spark's file sources skip, are read.

    spark.read.format("mailbox").option("path", root).load()

Columns: account, direction, folder, path, name, size, modified, content.  Options:
``path``; ``skip``, a folder name that is not entered; ``extensions`` (case matters
unless ``anyCase``); ``perFolder``, the most files of a folder, in name order (all
where it is not given); ``foldersOut``, comma separated: they come first; ``content``
= false leaves the content out.  A folder that can't be read has no rows.

The stream lists names only; which files are new is told by a log of the paths of
each batch below the folder of the option ``log``, so a file counts as new whenever
it arrives, whatever its date.  Executors read the contents.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "account string, direction string, folder string, path string, name string, size bigint, modified double, seq bigint, content binary"
RUN = 256


class _Files(InputPartition):
    def __init__(self, rows: list[tuple]):
        self.rows = rows


def _walk(options: dict) -> Iterator[tuple]:
    """(account, direction, folder, path, name, seq) of the wanted files, by names alone."""
    root = options["path"]
    skip = {s for s in options.get("skip", "").split(",") if s}
    any_case = options.get("anycase", "true").lower() == "true"
    wanted = tuple(options.get("extensions", ".eml").split(","))
    most = int(options["perfolder"]) if "perfolder" in options else None
    out_folders = {s for s in options.get("foldersout", "").split(",") if s}
    account = options.get("account", os.path.basename(root.rstrip("/")))
    found = []
    for folder, dirs, files in os.walk(root, onerror=lambda e: None):
        dirs[:] = sorted(d for d in dirs if d not in skip)
        names = sorted(f for f in files if (f.lower() if any_case else f).endswith(wanted))[:most]
        if names:
            relative = os.path.relpath(folder, root)
            direction = "out" if relative.split(os.sep)[0] in out_folders or os.path.basename(folder) in out_folders else "in"
            found.append((direction != "out", relative.split(os.sep), relative, folder, direction, names))
    seq = 0
    for _, _, relative, folder, direction, names in sorted(found):
        for n in names:
            seq += 1
            yield account, direction, "" if relative == "." else relative, os.path.join(folder, n), n, seq


def _runs(rows: list[tuple]) -> list[InputPartition]:
    return [_Files(rows[i : i + RUN]) for i in range(0, len(rows), RUN)]


def _read(rows: list[tuple], content: bool) -> Iterator[tuple]:
    for account, direction, folder, path, name, seq in rows:
        try:
            stat = os.stat(path)
            data = None
            if content:
                with open(path, "rb") as f:
                    data = f.read()
        except OSError:
            continue
        yield account, direction, folder, path, name, stat.st_size, stat.st_mtime, seq, data


def _wants_content(options: dict) -> bool:
    return options.get("content", "true").lower() == "true"


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return _runs(list(_walk(self.options))) or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        yield from _read(partition.rows, _wants_content(self.options))


class _Stream(DataSourceStreamReader):
    """The offset counts the batches in the log; each batch lists the files that no earlier one holds."""

    def __init__(self, options: dict):
        if "log" not in options:
            raise ValueError("a mailbox stream needs the option `log`, a folder for the names it has read")
        self.options, self.seen, self.batches = options, set(), 0

    def _log(self, batch: int) -> str:
        return os.path.join(self.options["log"], f"{batch:012d}.json")

    def _listed(self, batch: int) -> list[tuple]:
        with open(self._log(batch), encoding="utf-8") as f:
            return [tuple(json.loads(line)) for line in f]

    def _catch_up(self) -> None:
        while os.path.exists(self._log(self.batches + 1)):
            self.batches += 1
            self.seen.update(r[3] for r in self._listed(self.batches))

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self) -> dict:
        self._catch_up()
        new = [r for r in _walk(self.options) if r[3] not in self.seen]
        if new:
            os.makedirs(self.options["log"], exist_ok=True)
            at = self._log(self.batches + 1)
            with open(f"{at}.part", "w", encoding="utf-8") as f:
                f.writelines(json.dumps(r) + "\n" for r in new)
            os.replace(f"{at}.part", at)
            self._catch_up()
        return {"batch": self.batches}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [p for b in range(start["batch"] + 1, end["batch"] + 1) for p in _runs(self._listed(b))]

    def read(self, partition: _Files) -> Iterator[tuple]:
        yield from _read(partition.rows, _wants_content(self.options))


class MailboxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mailbox"

    def schema(self) -> str:
        return SCHEMA

    def _named(self) -> dict:
        return {k.lower(): v for k, v in dict(self.options).items()}

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self._named())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self._named())


def contents(rows: DataFrame) -> DataFrame:
    """The rows with the bytes of the files under ``path``; files that can't be read have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                try:
                    with open(batch.column(at)[i].as_py(), "rb") as f:
                        data = f.read()
                except OSError:
                    continue
                yield pa.RecordBatch.from_arrays([*(c.slice(i, 1) for c in batch.columns), pa.array([data], pa.binary())], names=names)

    rows = rows.drop("content")
    at, names = rows.columns.index("path"), [*rows.columns, "content"]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("content", T.BinaryType())]))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MailboxSource)
