"""Column functions for names, paths and text. All stay in the JVM but for HTML entities and address lists."""

from __future__ import annotations

import html
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str
#: Prefixes that mark the direction of a message in its subject.
INBOUND, OUTBOUND = "🔴 ", "🔵 "
TRUNCATED = "\n...[truncated]"
#: MIME types by file extension.
MIME_TYPES = {
    "txt": "text/plain", "md": "text/markdown", "csv": "text/csv", "json": "application/json", "xml": "application/xml", "html": "text/html", "htm": "text/html",
    "pdf": "application/pdf", "jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif", "webp": "image/webp", "svg": "image/svg+xml",
}
OCTETS = "application/octet-stream"
TEXT_LIKE = ("txt", "md", "csv", "json", "xml", "html", "htm")


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim(x: ColumnLike) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+\z", "")


def blank_to_null(x: ColumnLike) -> Column:
    c = trim(x)
    return F.when(c != "", c)


_ENTITY = re.compile(r"&(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")


def _entity(m: re.Match) -> str:
    ref = m[1]
    if ref[0] != "#":
        return html.entities.html5.get(ref + ";", m[0])
    code = int(ref[2:], 16) if ref[1] in "xX" else int(ref[1:])
    return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else m[0]


def decode_entities_text(value: str) -> str:
    """Character references with a semicolon, decoded once."""
    return _ENTITY.sub(_entity, value) if "&" in value else value


@F.pandas_udf(T.StringType())
def _decode_entities(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else decode_entities_text(v))


def decode_entities(x: ColumnLike) -> Column:
    return _decode_entities(_c(x))


def sanitize_file_name(x: ColumnLike, drop_backslash: bool = False, entities: bool = False) -> Column:
    """A name without line breaks, tabs and the characters that file systems refuse."""
    c = decode_entities(x) if entities else _c(x)
    refused = r'[:\\/*?|!#$%^<>"\r\n\t]' if drop_backslash else r'[:/*?|!#$%^<>"\r\n\t]'
    return trim(F.regexp_replace(c, refused, ""))


def decode_broken_q(x: ColumnLike) -> Column:
    """``=charsetQpayload=``, an encoded word that lost its marks, read as UTF-8; anything else as it is."""
    c = _c(x)
    pattern = r"(?s)\A=([^=?]+)([QqBb])(.*)=\z"
    payload = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_extract(c, pattern, 3), "%", "%25"), r"\+", "%2B"), "_", " ")
    decoded = F.try_url_decode(F.regexp_replace(payload, "=([0-9A-Fa-f]{2})", "%$1"))
    return F.when(c.rlike(pattern) & F.upper(F.regexp_extract(c, pattern, 2)).eqNullSafe("Q"), F.coalesce(decoded, c)).otherwise(c)


def repair_latin1(x: ColumnLike) -> Column:
    """UTF-8 read as Latin-1, undone by the simple rule of the pipeline: only where Ã or Â occurs."""
    c = _c(x)
    narrow = F.regexp_replace(c, r"[^\x{0}-\x{FF}]", "")
    fixed = F.make_valid_utf8(F.encode(narrow, "ISO-8859-1").cast("string"))
    return F.when(c.rlike("[ÃÂ]"), F.when(trim(fixed) != "", fixed).otherwise(c)).otherwise(c)


def normalize_display_name(x: ColumnLike) -> Column:
    bare = trim(F.regexp_replace(F.regexp_replace(trim(x), r"\A'+|'+\z", ""), r'\A"+|"+\z', ""))
    return trim(repair_latin1(decode_broken_q(bare)))


def file_stem(x: ColumnLike) -> Column:
    """The last path component without its last suffix; a leading dot is no suffix."""
    name = F.element_at(F.split(_c(x), "/"), -1)
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]*\z", "")


def extension(x: ColumnLike) -> Column:
    """The last suffix in lower case, '' if there is none."""
    return F.lower(F.regexp_extract(F.element_at(F.split(_c(x), "/"), -1), r"(?s).\.([^.]*)\z", 1))


def stem_or(x: ColumnLike, fallback: str) -> Column:
    s = sanitize_file_name(file_stem(x))
    return F.when(s.isNull() | (s == ""), F.lit(fallback)).otherwise(s)


def contact_info(x: ColumnLike) -> Column:
    """struct<name, email> of ``Name <address>``; without brackets the whole text is the address."""
    c = _c(x)
    pattern = r"(?s)\A(.*)<([^<]*)>"
    found = c.rlike(pattern)
    name = F.when(found, trim(F.regexp_extract(c, pattern, 1))).otherwise(F.lit(""))
    email = F.when(found, F.regexp_extract(c, pattern, 2)).otherwise(c)
    return F.struct(name.alias("name"), F.lower(trim(email)).alias("email"))


def contact_folder(name: ColumnLike, email: ColumnLike) -> Column:
    """The folder of a correspondent: ``Name (email)``, or what there is."""
    n, e = F.coalesce(trim(name), F.lit("")), F.coalesce(trim(email), F.lit(""))
    both = F.concat(n, F.lit(" ("), e, F.lit(")"))
    return sanitize_file_name(F.when((n != "") & (e != ""), both).when(e != "", e).otherwise(n))


def mark_direction(subject: ColumnLike, inbound: Column) -> Column:
    return F.concat(F.when(inbound, F.lit(INBOUND)).otherwise(F.lit(OUTBOUND)), _c(subject))


def normalize_subject(x: ColumnLike) -> Column:
    return trim(F.regexp_replace(_c(x), f"^(?:{INBOUND}|{OUTBOUND})", ""))


def format_address(name: ColumnLike, address: ColumnLike) -> Column:
    n = blank_to_null(name)
    return F.when(n.isNotNull(), F.concat(n, F.lit(" <"), _c(address), F.lit(">"))).otherwise(_c(address))


def last_component(x: ColumnLike) -> Column:
    return F.coalesce(F.element_at(F.split(_c(x), "/"), -1), F.lit(""))


def normalize_root(x: ColumnLike) -> Column:
    """An absolute folder of sanitised parts; null if blank or if a part has nothing left."""
    c = trim(x)
    parts = F.filter(F.transform(F.split(c, "/"), trim), lambda p: p != "")
    clean = F.transform(parts, lambda p: sanitize_file_name(p, drop_backslash=True))
    joined = F.concat(F.lit("/"), F.array_join(clean, "/"))
    return F.when((c != "") & ~F.exists(clean, lambda p: p == ""), joined)


def store_path(root: ColumnLike, name: ColumnLike, inbox: str = "A_TRAITER") -> Column:
    """Where a file goes: always the inbox folder below the root."""
    return F.concat_ws("/", F.regexp_replace(_c(root), r"/+\z", ""), F.lit(inbox), _c(name))


def ensure_extension(proposed: ColumnLike, original: ColumnLike) -> Column:
    """The proposed name with the extension of the original; the original's name if nothing is proposed."""
    p = sanitize_file_name(proposed, drop_backslash=True)
    o = sanitize_file_name(original, drop_backslash=True)
    suffix = F.regexp_extract(o, r"(?s).(\.[^.]+)\z", 1)
    fallback = F.when(o.isNull() | (o == ""), F.lit("attachment.bin")).otherwise(o)
    named = F.when(suffix == "", p).otherwise(F.concat(F.regexp_replace(p, r"(?s)(?<=.)\.[^.]*\z", ""), suffix))
    return F.when(p.isNull() | (p == ""), fallback).otherwise(named)


def xml_name(x: ColumnLike) -> Column:
    return F.concat(file_stem(x), F.lit(".xml"))


def parent_folder(x: ColumnLike) -> Column:
    p = F.regexp_replace(_c(x), r"/[^/]*\z", "")
    return F.when(p == "", F.lit("/")).otherwise(p)


def folder_prefixes(x: ColumnLike) -> Column:
    """``/a/b`` as [``/a``, ``/a/b``]."""
    parts = F.filter(F.split(_c(x), "/"), lambda p: p != "")
    return F.when(F.size(parts) > 0, F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))).otherwise(F.array().cast("array<string>"))


def truncate_chars(x: ColumnLike, n: int, marker: str = TRUNCATED) -> Column:
    c = _c(x)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(marker))).otherwise(c)


def guess_mime_type(x: ColumnLike) -> Column:
    table = F.create_map(*(F.lit(v) for pair in MIME_TYPES.items() for v in pair))
    return F.coalesce(F.try_element_at(table, extension(x)), F.lit(OCTETS))


def is_text_like(x: ColumnLike) -> Column:
    return extension(x).isin(*TEXT_LIKE)


def wrap_cdata(x: ColumnLike) -> Column:
    return F.replace(_c(x), F.lit("]]>"), F.lit("]]]]><![CDATA[>"))


def compact_body(x: ColumnLike) -> Column:
    c = F.substring(trim(x), 1, 400)
    return F.when(c.isNull() | (c == ""), F.lit("<empty body>")).otherwise(c)


def normalize_newlines(x: ColumnLike) -> Column:
    return trim(F.regexp_replace(_c(x), r"\r\n?", "\n"))


def finalize_extraction(x: ColumnLike, cap: int = 80_000) -> Column:
    """struct<text, truncated>: extracted text with normal line ends, cut at ``cap`` characters."""
    c = normalize_newlines(x)
    return F.struct(F.substring(c, 1, cap).alias("text"), (F.length(c) > cap).alias("truncated"))


def extract_year(x: ColumnLike) -> Column:
    """The first whole number from 1900 to 2099; '' if there is none."""
    return F.regexp_extract(_c(x), r"(?U)\b((?:19|20)\d{2})\b", 1)


def year_folder(proposed: ColumnLike, date: ColumnLike) -> Column:
    """The year of the proposed name, else of the date, else null."""
    return F.coalesce(*(F.nullif(extract_year(F.coalesce(_c(x), F.lit(""))), F.lit("")) for x in (proposed, date)))


#: How names of embedded parts begin, what they hold, how they end.
TEMPORARY_STARTS = ("tmp", "image", "part", "att", "inline")
TEMPORARY_PARTS = (".tmp", "unnamed", "unknown", "noname")
TEMPORARY_END = r"\.(?:tmp|dat|bin)\.\d+\z"


def looks_temporary(name: ColumnLike) -> Column:
    """Names that mail programs give to embedded parts. Real names with such a beginning count, too."""
    n = F.lower(trim(name))
    starts = reduce(lambda a, b: a | b, (n.startswith(p) for p in TEMPORARY_STARTS))
    holds = reduce(lambda a, b: a | b, (n.contains(p) for p in TEMPORARY_PARTS))
    return F.coalesce((n != "") & (starts | holds | n.rlike(TEMPORARY_END)), F.lit(False))


EMBEDDED_IMAGE_MAX = 30_720


def is_embedded_image(mime: ColumnLike, name: ColumnLike, inline: Column, has_content_id: Column, size: ColumnLike) -> Column:
    """Parts that belong to the layout of a message and are no documents."""
    temporary = looks_temporary(name)
    return (F.coalesce(_c(mime), F.lit("")).startswith("image/") | temporary) & (F.coalesce(inline, F.lit(False)) | F.coalesce(has_content_id, F.lit(False)) | (_c(size) <= EMBEDDED_IMAGE_MAX) | temporary)


def path_order(x: ColumnLike) -> Column:
    """A key that orders paths by their components."""
    return F.split(_c(x), "/")


def strip_suffixes(x: ColumnLike, suffix: str) -> Column:
    """Without a suffix, however often it is repeated."""
    return F.regexp_replace(_c(x), f"(?:{re.escape(suffix)})+\\z", "")
