"""Mail folders of an IMAP account as a data source.

    spark.dataSource.register(ImapSource)
    spark.read.format("imap").options(host=..., login=..., password=..., foldersOut="Sent", foldersIn="INBOX").load()

The columns are those of ``mailbox``; a folder is one input partition and its
messages are fetched by the executors.  Folders are opened read-only; the first
``perFolder`` messages are read.  A folder that can't be opened and messages without
a body have no rows.  ``session`` in the module is the hook for tests and for other
ways to log in.
"""

from __future__ import annotations

import imaplib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lettrine.sources.mailbox import SCHEMA

#: Fixed value: messages read of one server folder in one run, unless ``perFolder`` says otherwise.
PER_FOLDER = 10_000


def session(options: dict):
    """A logged-in session; TLS unless ``ssl`` is false."""
    secure = options.get("ssl", "true").lower() == "true"
    port = int(options.get("port", 993 if secure else 143))
    opened = imaplib.IMAP4_SSL(options["host"], port) if secure else imaplib.IMAP4(options["host"], port)
    opened.login(options["login"], options["password"])
    return opened


class _Folder(InputPartition):
    def __init__(self, direction: str, folder: str, first: int):
        self.direction, self.folder, self.first = direction, folder, first


class _Reader(DataSourceReader):
    def __init__(self, options: dict, opener=None):
        self.options, self.opener = options, opener or session

    def partitions(self) -> list[InputPartition]:
        """Outgoing folders first; places of messages leave room for the folders before."""
        most = int(self.options.get("perfolder", PER_FOLDER))
        names = [(d, f) for d, key in (("out", "foldersout"), ("in", "foldersin")) for f in self.options.get(key, "").split(",") if f]
        return [_Folder(d, f, i * most) for i, (d, f) in enumerate(names)] or [_Folder("in", "INBOX", 0)]

    def read(self, partition: _Folder) -> Iterator[tuple]:
        account = self.options.get("account", self.options.get("login", ""))
        most = int(self.options.get("perfolder", PER_FOLDER))
        box = self.opener(self.options)
        try:
            kind, found = box.select(f'"{partition.folder}"', readonly=True)
            exists = int(found[0] or 0) if kind == "OK" else 0
            for n in range(1, min(exists, most) + 1):
                kind, parts = box.fetch(str(n), "(RFC822)")
                raw = next((p[1] for p in parts or [] if isinstance(p, tuple)), None)
                if kind == "OK" and raw:
                    path = f"imap://{account}/{partition.folder}/{n}"
                    yield account, partition.direction, partition.folder, path, f"{n}.eml", len(raw), 0.0, partition.first + n, raw
        except imaplib.IMAP4.error:
            return
        finally:
            try:
                box.logout()
            except (OSError, imaplib.IMAP4.error):
                pass


class ImapSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "imap"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in dict(self.options).items()})
