"""Stage 4: enriched bundles to filed documents and archive rows, through an object store."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettrine.functions import dates, hashes
from lettrine.functions import text as X
from lettrine.operators import dedup, documents
from lettrine.plans.enrich import KEY, columns
from lettrine.sources import archive
from lettrine.sources.files import Folder
from lettrine.workspace import persisted

SINGLE_CALL, CHUNK = 150 * 1024 * 1024, 8 * 1024 * 1024


class Conflict(Exception):
    """Another file has the name already."""


def header_json(value: object) -> str:
    """JSON for a request header: characters beyond ASCII as UTF-16 escapes."""
    return json.dumps(value, ensure_ascii=True, separators=(",", ":"))


class Store(Protocol):
    def ensure_folder(self, path: str) -> None: ...
    def put(self, path: str, data: bytes) -> None: ...


class LocalStore:
    """An object store in a folder or below a URI. Equal content under the same name is no conflict, so a repeated task changes nothing."""

    def __init__(self, root: str, single_call: int = SINGLE_CALL, chunk: int = CHUNK):
        self.folder, self.single_call, self.chunk, self.known = Folder(root), single_call, chunk, set()

    def ensure_folder(self, path: str) -> None:
        if path not in self.known:
            self.folder.make(path)
            self.known.add(path)

    def put(self, path: str, data: bytes) -> None:
        if self.folder.exists(path):
            if hashlib.sha256(self.folder.read(path)).digest() != hashlib.sha256(data).digest():
                raise Conflict(f"`{path}` exists with other content")
            return
        self.folder.write(path, data, None if len(data) <= self.single_call else self.chunk)


#: (method, URL, headers, body) to (status, body): how a remote service is called; tests and clusters bring their own.
Transport = Callable[[str, str, dict[str, str], bytes], tuple[int, bytes]]


def http(method: str, url: str, headers: dict[str, str], body: bytes, timeout_s: float = 120) -> tuple[int, bytes]:
    """The default transport."""
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, body, headers, method=method), timeout=timeout_s) as r:
            return r.status, r.read()
    except HTTPError as e:
        return e.code, e.read()


class RemoteStore:
    """An object store behind an HTTP service: whole files in one call, large ones in a session of pieces.

    Folders that exist already, from an earlier run or another task, are no error.
    """

    def __init__(self, token: str, api: str, content: str, transport: Transport = http, single_call: int = SINGLE_CALL, chunk: int = CHUNK):
        self.token, self.api, self.content, self.transport, self.single_call, self.chunk, self.known = token, api, content, transport, single_call, chunk, set()

    def _post(self, url: str, arg: object, body: bytes | None = None) -> bytes:
        headers = {"Authorization": f"Bearer {self.token}", "Content-Type": "application/json" if body is None else "application/octet-stream"}
        if body is not None:
            headers["Dropbox-API-Arg"] = header_json(arg)
        status, answer = self.transport("POST", url, headers, json.dumps(arg).encode() if body is None else body)
        if status == 409 and b"conflict" in answer:
            raise Conflict(answer.decode("utf-8", "replace")[:400])
        if not 200 <= status < 300:
            raise OSError(f"status {status}: {answer.decode('utf-8', 'replace').strip()[:400] or '<empty body>'}")
        return answer

    def ensure_folder(self, path: str) -> None:
        parts = [p for p in path.split("/") if p]
        for n in range(1, len(parts) + 1):
            folder = "/" + "/".join(parts[:n])
            if folder not in self.known:
                try:
                    self._post(f"{self.api}/2/files/create_folder_v2", {"path": folder, "autorename": False})
                except Conflict:
                    pass
                self.known.add(folder)

    def put(self, path: str, data: bytes) -> None:
        commit = {"path": path, "mode": "add", "autorename": False, "mute": True, "strict_conflict": False}
        if len(data) <= self.single_call:
            self._post(f"{self.content}/2/files/upload", commit, data)
            return
        session = json.loads(self._post(f"{self.content}/2/files/upload_session/start", {"close": False}, data[: self.chunk]))["session_id"]
        at = self.chunk
        while len(data) - at > self.chunk:
            self._post(f"{self.content}/2/files/upload_session/append_v2", {"cursor": {"session_id": session, "offset": at}, "close": False}, data[at : at + self.chunk])
            at += self.chunk
        self._post(f"{self.content}/2/files/upload_session/finish", {"cursor": {"session_id": session, "offset": at}, "commit": commit}, data[at:])


def planned(bundles: DataFrame, outputs: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(plans, failures): bundles with their answers, one item each; documents without bytes are left out."""
    j = bundles.join(outputs.select(*KEY, "ai"), KEY).withColumn("c", columns(F.col("ai")))
    items = documents.inherit_folders(F.coalesce("c.attachment_summaries", F.array()), F.col("c.main_folder"), F.col("c.sub_folder"))
    a = F.col("attachments")[0]
    body = F.coalesce(a["is_email_body"], F.lit(False))
    rows = j.withColumn("items", items).where(body | F.col("content").isNotNull()).where(F.size("items") > 0)
    rows = rows.withColumn("item", F.col("items")[0]).withColumn("md5", a["md5"]).withColumn("source_file_name", a["original_name"]).withColumn("is_email_body", a["is_email_body"]).withColumn("parsed_mime", a["mime_type"]).withColumn("xml_content", F.col("xml")).withColumn("ai_content", F.col("ai"))
    out = documents.plan(rows, root).withColumn("error", F.when(F.size("items") != 1, F.lit("not exactly one summary")).otherwise(F.col("error")))
    failed = out.where("error is not null").select(F.lit("file").alias("stage"), F.concat_ws("/", "folder", "stem", F.col("position").cast("string")).alias("key"), "error")
    return out.where("error is null"), failed


PLACE = ["folder", "stem", "position"]


def to_file(plans: DataFrame, known: DataFrame) -> DataFrame:
    """(folder, stem, position, md5, rank) of the plans whose document is not archived: the copies of a document in the
    order in which they are tried."""
    narrow = dedup.not_in(plans.select(*PLACE, "md5"), known, ["md5"]).withColumn("place", X.path_order("folder"))
    return dedup.ranked(narrow, "md5", ["place", "stem", "position"]).drop("place")


def upload(plans: DataFrame, store_factory: Callable[[], Store]) -> DataFrame:
    """(md5, error) after the uploads: the document, then its XML. Names and contents make a repeated upload harmless."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = store_factory()
        for batch in batches:
            keys, errors = [], []
            for md5, xml_only, path, xml_path, content, xml in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys.append(md5)
                try:
                    for p in {os.path.dirname(path), os.path.dirname(xml_path)}:
                        store.ensure_folder(p)
                    if not xml_only:
                        store.put(path, content or b"")
                    store.put(xml_path, xml.encode())
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - the error is the result
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(errors, pa.string())], names=["md5", "error"])

    return persisted(plans.select("md5", "xml_only", "dropbox_path", "xml_dropbox_path", "content", "enriched_xml").mapInArrow(each, "md5 string, error string"), "uploads")


def upload_first(plans: DataFrame, ranks: DataFrame, store_factory: Callable[[], Store]) -> tuple[DataFrame, DataFrame]:
    """(copies that were uploaded, errors of the others): of each document the first copy that the store takes.

    Every round tries one copy of each document that has none yet, so no task holds the copies of one document.
    """
    done: DataFrame | None = None
    errors: DataFrame | None = None
    rank, left = 1, ranks.where("rank = 1")
    while True:
        tried = left.select(*PLACE, "md5")
        sent = upload(plans.join(tried, [*PLACE, "md5"], "left_semi"), store_factory)
        good, bad = tried.join(sent.where("error is null").select("md5"), "md5", "left_semi"), sent.where("error is not null")
        done = good if done is None else done.unionByName(good)
        errors = bad if errors is None else errors.unionByName(bad)
        rank += 1
        left = ranks.where(F.col("rank") == rank).join(bad.select("md5"), "md5", "left_semi")
        if left.isEmpty():
            return done, errors


def file_documents(spark: SparkSession, bundles: DataFrame, outputs: DataFrame, root: str, archive_path: str, store_factory: Callable[[], Store], dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(plans, failures): the plans that were carried out, or would be first. Archive rows are added only for documents that
    were uploaded; a copy that the store refuses gives way to the next one."""
    plans, failed = planned(bundles, outputs, root)
    plans = persisted(plans, "plans")
    ranks = persisted(to_file(plans, archive.load(spark, archive_path)), "ranks")
    if dry_run:
        return plans.join(ranks.where("rank = 1").select(*PLACE, "md5"), [*PLACE, "md5"], "left_semi"), failed
    done, errors = upload_first(plans, ranks, store_factory)
    plans = plans.join(done, [*PLACE, "md5"], "left_semi")
    good = plans.withColumn("blob", F.when(F.col("xml_only"), F.encode("enriched_xml", "UTF-8")).otherwise(F.col("content")))
    c = F.col
    values = {
        "md5": c("md5"), "source_file_name": c("source_file_name"), "final_file_name": F.when(c("xml_only"), c("xml_file_name")).otherwise(c("final_file_name")), "dropbox_root_folder": F.lit(root), "dropbox_path": F.when(c("xml_only"), c("xml_dropbox_path")).otherwise(c("dropbox_path")),
        "dropbox_content_hash": hashes.block_hash("blob"), "xml_file_name": c("xml_file_name"), "xml_dropbox_path": c("xml_dropbox_path"), "main_folder": c("item.main_folder"), "sub_folder": c("item.sub_folder"), "year_folder": c("year_folder"),
        "account_name": c("account_name"), "email_dossier_path": c("folder"), "email_stem": c("stem"), "parse_json_content": c("json"), "parse_xml_content": c("enriched_xml"), "ai_json_content": c("ai"), "message_id": c("message_id"),
        "email_subject": F.coalesce(c("subject"), c("email_folder")), "expedition_date": c("expedition_date"), "email_summary": c("c.email_summary"), "email_importance": c("c.email_importance"), "attachment_summary": c("item.summary"), "attachment_importance": c("item.importance"), "attachment_mime_type": c("mime_type"),
    }
    archive.append(spark, archive_path, documents.archive_rows(good, values, dates.rfc3339(F.current_timestamp())))
    lost = errors.select(F.lit("file").alias("stage"), F.col("md5").alias("key"), "error")
    return plans, failed.unionByName(lost)
