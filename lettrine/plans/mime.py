"""MIME messages as rows: header fields, parts that are documents, and the XML of the bodies.

Contract where parsers differ: leaves only; a ``message/rfc822`` part is a leaf for
attachments and a nested message for the XML; address groups stay one contact.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from email import message_from_bytes
from email.headerregistry import AddressHeader
from email.message import Message
from email.policy import default as POLICY
from xml.sax.saxutils import quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrine.functions.text import TEMPORARY_END, TEMPORARY_PARTS, TEMPORARY_STARTS, decode_entities_text
from lettrine.schemas import ATTACHMENT, CONTACT

#: Fixed values as in the column functions; here they work on one message at a time.
_REFUSED = re.compile(r'[:/*?|!#$%^<>"\r\n\t]')
_TEMP = re.compile("^(?:{})|{}|{}".format("|".join(TEMPORARY_STARTS), "|".join(map(re.escape, TEMPORARY_PARTS)), TEMPORARY_END.replace("\\z", "\\Z")))
EMBEDDED_IMAGE_MAX = 30_720
HTML_BYTES = 250_000


def clean_name(name: str) -> str:
    return _REFUSED.sub("", decode_entities_text(name)).strip()


def part_name(part: Message) -> str | None:
    """The file name of a part, from its disposition or its type; None if blank."""
    try:
        name = part.get_filename() or ""
    except (ValueError, LookupError, TypeError):
        name = ""
    name = name.replace('"', "").strip()
    return name or None


def is_document(part: Message) -> bool:
    named = part_name(part) is not None
    return part.get_content_disposition() == "attachment" or named and part.get_content_type() not in ("text/plain", "text/html")


def _payload(part: Message) -> bytes | None:
    if part.get_content_type() == "message/rfc822":
        inner = part.get_payload()
        return inner[0].as_bytes() if isinstance(inner, list) and inner else b""
    try:
        return part.get_payload(decode=True) or b""
    except (ValueError, LookupError, AssertionError):
        return None


def leaves(part: Message) -> Iterator[Message]:
    """Parts without parts, in order; a nested message is one."""
    if part.is_multipart() and part.get_content_type() != "message/rfc822":
        for p in part.get_payload():
            yield from leaves(p)
    else:
        yield part


def _is_layout(part: Message, name: str, size: int) -> bool:
    image, temporary = part.get_content_type().startswith("image/"), bool(_TEMP.search(name.strip().lower()))
    inline = part.get_content_disposition() in (None, "inline")
    return (image or temporary) and (inline or part["Content-ID"] is not None or size <= EMBEDDED_IMAGE_MAX or temporary)


def documents(message: Message, raw: bytes, stem: str) -> list[dict]:
    """The attachments of a message; a message without any is one document, its body."""
    out = []
    for part in leaves(message):
        name = part_name(part)
        if name is None:
            continue
        data = _payload(part)
        size = len(data or b"")
        if _is_layout(part, name, size):
            continue
        safe = clean_name(os.path.basename(name.replace("\\", "/"))) or "attachment.bin"
        out.append({"original_name": safe, "is_email_body": None, "mime_type": part.get_content_type(), "size": size, "md5": hashlib.md5(data).hexdigest() if data is not None else "", "content": data})
    if not out:
        out.append({"original_name": "email-body.xml", "is_email_body": True, "mime_type": "application/xml", "size": len(raw), "md5": hashlib.md5(raw).hexdigest(), "content": None})
    seen: dict[str, int] = {}
    taken = {d["original_name"] for d in out}
    for d in out:
        n = seen.get(d["original_name"], 0)
        seen[d["original_name"]] = n + 1
        if n:
            base, suffix = os.path.splitext(d["original_name"])
            while f"{base}_{n}{suffix}" in taken:
                n += 1
            d["original_name"] = f"{base}_{n}{suffix}"
            taken.add(d["original_name"])
    return out


def contacts(value: str | None) -> list[dict]:
    """An address header as contacts; a group is one contact without address; free text is kept as it is."""
    if not value or not value.strip():
        return []
    kwds: dict = {"defects": []}
    try:
        AddressHeader.parse(value, kwds)
        groups = kwds["groups"]
    except Exception:  # noqa: BLE001 - a parser that gives up leaves the raw text
        return [{"raw": value.strip(), "name": None, "address": None}]
    out = []
    for g in groups:
        if g.display_name is not None:
            out.append({"raw": str(g), "name": g.display_name, "address": None})
            continue
        for a in g.addresses:
            if a.username and a.domain:
                spec = f"{a.username}@{a.domain}"
                out.append({"raw": f"{a.display_name} <{spec}>" if a.display_name else spec, "name": a.display_name or None, "address": spec})
    if not out:
        text = value.strip()
        out = [{"raw": text, "name": text if "@" in text else None, "address": text if "@" in text else None}]
    return out


def _attributes(part: Message) -> str:
    found = [("charset", part.get_param("charset")), ("boundary", part.get_param("boundary")), ("transfer-encoding", part["Content-Transfer-Encoding"]), ("disposition", part.get_content_disposition() or "inline"), ("content-id", part["Content-ID"])]
    return "".join(f" {k}={quoteattr(str(v).strip())}" for k, v in found if v is not None)


def _cdata(text: str) -> str:
    return "<![CDATA[" + text.replace("]]>", "]]]]><![CDATA[>") + "]]>"


def _text(part: Message) -> str:
    data = _payload(part) or b""
    charset = part.get_content_charset() or "utf-8"
    try:
        return data.decode(charset, "replace")
    except LookupError:
        return data.decode("utf-8", "replace")


def part_rows(part: Message, path: str = "1", depth: int = 2) -> Iterator[str]:
    """The lines of the XML of a part; none if it holds no text."""
    pad, kind = "  " * depth, part.get_content_type()
    opened = lambda k: f'{pad}<part path="{path}" kind="{k}" mime-type={quoteattr(kind)}{_attributes(part)}>'
    if is_document(part):
        return
    if kind == "multipart/alternative" and part.is_multipart():
        children = list(enumerate(part.get_payload(), 1))
        for wanted in ("text/plain", "text/html"):
            best = next(((i, p) for i, p in children if not is_document(p) and p.get_content_type() == wanted), None)
            if best:
                yield from part_rows(best[1], f"{path}.{best[0]}", depth)
                return
        for i, p in children:
            lines = list(part_rows(p, f"{path}.{i}", depth))
            if lines:
                yield from lines
                return
    elif kind == "message/rfc822":
        inner = part.get_payload()
        nested = list(part_rows(inner[0], f"{path}.1", depth + 1)) if isinstance(inner, list) and inner else []
        yield opened("message")
        yield from nested or [f'{pad}  <content format="raw-message">{_cdata((_payload(part) or b"").decode("utf-8", "replace"))}</content>']
        yield f"{pad}</part>"
    elif part.is_multipart():
        lines = [x for i, p in enumerate(part.get_payload(), 1) for x in part_rows(p, f"{path}.{i}", depth + 1)]
        if lines:
            yield from [opened("multipart"), *lines, f"{pad}</part>"]
    elif kind in ("text/plain", "text/html"):
        html = kind == "text/html"
        marks = 'format="markdown" source-format="html"' if html else 'format="plain"'
        body = html_text(_text(part)) if html else _text(part)
        yield from [opened("body"), f"{pad}  <content {marks}>{_cdata(body)}</content>", f"{pad}</part>"]


def html_text(value: str) -> str:
    """HTML as Markdown: the steps of the column function, for one value."""
    from lettrine.functions.markup import CUT_NOTICE, STEPS, noise_pattern

    data = value.encode("utf-8", "replace")
    text = data[:HTML_BYTES].decode("utf-8", "ignore") if len(data) > HTML_BYTES else value
    text = re.sub(noise_pattern(), " ", text)
    for step in STEPS:
        text = decode_entities_text(text) if step is None else re.sub(step[0], step[1].replace("$2", r"\2").replace("$1", r"\1"), text)
    return text.strip() + (CUT_NOTICE if len(data) > HTML_BYTES else "")


PARSED = f"path string, message_id string, subject string, date string, author {CONTACT}, targets array<{CONTACT}>, cc array<{CONTACT}>, bcc array<{CONTACT}>, attachments array<struct<meta:{ATTACHMENT},content:binary>>, body_xml string, error string"


def _header(message: Message, name: str) -> str | None:
    value = next((str(v).strip() for k, v in message.items() if k.lower() == name.lower()), "")
    return value or None


def parse_message(path: str, raw: bytes) -> dict:
    try:
        m = message_from_bytes(raw, policy=POLICY)
        found = documents(m, raw, path)
        sender = contacts(_header(m, "From"))
        meta = [{"meta": {k: d.get(k) for k in ("original_name", "is_email_body", "mime_type", "size", "md5")}, "content": d["content"]} for d in found]
        return {
            "path": path, "message_id": _header(m, "Message-ID"), "subject": _header(m, "Subject"), "date": _header(m, "Date"), "author": sender[0] if sender else {"raw": "", "name": None, "address": None},
            "targets": contacts(_header(m, "To")), "cc": contacts(_header(m, "Cc")), "bcc": contacts(_header(m, "Bcc")), "attachments": meta, "body_xml": "\n".join(part_rows(m)), "error": None,
        }
    except Exception as e:  # noqa: BLE001 - one unreadable message must not stop the run
        return {"path": path, "error": f"{type(e).__name__}: {e}"}


def parse(messages: DataFrame) -> DataFrame:
    """Messages (path, content) parsed; unreadable ones have an ``error``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(PARSED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                rows = [parse_message(p, c) for p, c in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return messages.select("path", F.col("content")).mapInArrow(run, PARSED)
