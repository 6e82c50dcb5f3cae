"""Queries of the document pipeline's operators over the given tables, each with its SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettrine.functions import hashes, markup, responses
from lettrine.functions import text as X
from lettrine.operators import dedup, documents, ordering
from lettrine.operators.upsert import message_key
from lettrine.plans import enrich, ingest, parse, spec
from lettrine.sources import archive, index, mailbox
from lettrine.workspace import fresh_path, persisted, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: White space as the engine trims it, for DuckDB.
_WS = r"[\s\x0B\x{1C}-\x{1F}\x{85}\p{Z}]"
_TRIM = rf"^{_WS}+|{_WS}+$"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '{_TRIM}', '', 'g')"


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _attachments(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    e = table(spark, d, "parsed_emails").select("record_id", "email_folder", *columns, F.posexplode("attachments").alias("pos", "a"))
    return e.withColumn("pos", F.col("pos").cast("long"))


_ATT = "SELECT record_id, email_folder, message_id, expedition_date, generate_subscripts(attachments, 1) - 1 AS pos, unnest(attachments) AS a FROM parsed_emails"


@_query(f"SELECT md5, record_id, pos, original_name FROM (SELECT coalesce(a.md5, '') AS md5, record_id, pos, a.original_name AS original_name, row_number() OVER (PARTITION BY coalesce(a.md5, '') ORDER BY string_split(email_folder, '/'), record_id, pos) AS n FROM ({_ATT})) WHERE n = 1")
def dedup_first_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = _attachments(spark, d).select(F.coalesce("a.md5", F.lit("")).alias("md5"), "record_id", "pos", F.col("a.original_name").alias("original_name"), X.path_order("email_folder").alias("folder"))
    return dedup.first_wins(rows, "md5", [F.col("folder"), F.col("record_id"), F.col("pos")]).drop("folder")


@_query(f"SELECT DISTINCT a.md5 AS md5 FROM ({_ATT}) WHERE a.md5 IS NOT NULL AND a.md5 NOT IN (SELECT md5 FROM dropbox_uploads)")
def archive_anti_join(spark: SparkSession, d: str) -> DataFrame:
    rows = _attachments(spark, d).select(F.col("a.md5").alias("md5")).where("md5 is not null").distinct()
    return dedup.not_in(rows, table(spark, d, "dropbox_uploads"), ["md5"])


@_query("SELECT doc_id, md5(text) AS content_md5, sha256('2' || coalesce(text, '') || coalesce(source, '')) AS input_hash FROM documents")
def input_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", hashes.content_md5("text").alias("content_md5"), hashes.input_hash(F.col("text"), F.col("source")).alias("input_hash"))


_BLOCK = 512


@_query(f"""
SELECT doc_id, CASE WHEN octet_length(b) = 0 THEN sha256('') ELSE sha256(unhex(array_to_string(list_transform(range(0, octet_length(b), {_BLOCK}), lambda i: sha256(b[i + 1 : i + {_BLOCK}])), ''))) END AS content_hash
FROM (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents)
""")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    """With small blocks, so that most texts have several."""
    rows = table(spark, d, "documents").withColumn("content", F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    return rows.select("doc_id", hashes.block_hash("content", _BLOCK).alias("content_hash"))


@_query("SELECT doc_id, CASE WHEN length(text) > 120 THEN substring(text, 1, 120) || chr(10) || '...[truncated]' ELSE text END AS cut FROM documents")
def truncate_marker(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.truncate_chars("text", 120).alias("cut"))


@_query("SELECT record_id, " + _trim("regexp_replace(subject, '[:/*?|!#$%^<>\"\\r\\n\\t]', '', 'g')") + " AS mail_name, " + _trim("regexp_replace(subject, '[:\\\\/*?|!#$%^<>\"\\r\\n\\t]', '', 'g')") + " AS store_name FROM parsed_emails")
def sanitize_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed_emails").select("record_id", X.sanitize_file_name("subject").alias("mail_name"), X.sanitize_file_name("subject", drop_backslash=True).alias("store_name"))


@_query(rf"SELECT record_id, pos, regexp_extract(a.original_name, '\b((?:19|20)\d{{2}})\b', 1) AS name_year, coalesce(nullif(regexp_extract(coalesce(a.original_name, ''), '\b((?:19|20)\d{{2}})\b', 1), ''), nullif(regexp_extract(coalesce(expedition_date, ''), '\b((?:19|20)\d{{2}})\b', 1), '')) AS year_folder FROM ({_ATT})")
def extract_year(spark: SparkSession, d: str) -> DataFrame:
    rows = _attachments(spark, d, "expedition_date")
    return rows.select("record_id", "pos", X.extract_year("a.original_name").alias("name_year"), X.year_folder("a.original_name", "expedition_date").alias("year_folder"))


_ESCAPED = "replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_HTML = f"'<html><head><title>T</title><style>p{{}}</style></head><body><!-- x --><p class=\"a\">' || replace(replace({_ESCAPED}, chr(10) || chr(10), '</p><p>'), chr(10), '<br/>') || '</p><SCRIPT>a<b</SCRIPT ><ul><li>one &eacute;</li><LI id=\"2\">two</LI></ul><a href=\"http://x.test\">link</a></body></html>'"
#: What the engine should make of it, by the rules in words: blank lines between blocks, one blank between words.
_MARKDOWN = "replace(coalesce(text, ''), chr(10) || chr(10), chr(10) || chr(10) || ' ') || chr(10) || chr(10) || ' - one é' || chr(10) || chr(10) || '- two' || chr(10) || chr(10) || '[link](http://x.test)'"
_MARKDOWN = _trim(f"regexp_replace(regexp_replace(regexp_replace({_MARKDOWN}, '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")


@_query(f"SELECT doc_id, {_MARKDOWN} AS markdown FROM documents")
def html_to_markdown(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").withColumn("html", F.expr(_HTML.replace("chr(10)", "'\\n'")))
    return rows.select("doc_id", markup.html_to_markdown("html").alias("markdown"))


@_query("SELECT contact_id, coalesce(first_value(CASE WHEN trim(coalesce(name, '')) <> '' THEN name END IGNORE NULLS) OVER (PARTITION BY lower(address) ORDER BY contact_id ROWS UNBOUNDED PRECEDING), '') AS sticky_name FROM header_contacts WHERE address IS NOT NULL")
def running_contact_name(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "header_contacts").where("address is not null").select("contact_id", "name", F.lower("address").alias("email"))
    return dedup.sticky_name(rows, "email", "name", "contact_id").select("contact_id", "sticky_name")


_SIDES = "('.ai.meta.json', '.ai.error.json', '.ai.request.json', '.dropbox.json', '.dropbox.error.json')"
_LISTING = f"""
SELECT email_folder || '/' || record_id AS folder, name FROM (
  SELECT record_id, email_folder, unnest([stem || '.json', stem || '.xml', CASE WHEN record_id % 3 = 0 THEN stem || '.ai.json' END, CASE WHEN record_id % 5 = 0 THEN stem || '.dropbox.json' END, CASE WHEN pos > 0 THEN full_name END]) AS name FROM (
    SELECT *, regexp_replace(full_name, '^(.+)\\.[^.]*$', '\\1', 's') AS stem FROM (SELECT record_id, email_folder, pos, replace(a.original_name, '/', '_') AS full_name FROM ({_ATT}) WHERE a.original_name IS NOT NULL)))
WHERE name IS NOT NULL
"""


def _bundles_sql(need_ai: bool) -> str:
    return f"""
SELECT folder, stem, max(CASE WHEN role = 'json' THEN name END) AS json, max(CASE WHEN role = 'xml' THEN name END) AS xml, max(CASE WHEN role = 'ai' THEN name END) AS ai, max(CASE WHEN role = 'attachment' THEN name END) AS attachment FROM (
  SELECT folder, name, CASE WHEN ends_with(name, '.ai.json') THEN regexp_replace(name, '(\\.ai\\.json)+$', '') ELSE regexp_replace(name, '^(.+)\\.[^.]*$', '\\1', 's') END AS stem,
         CASE WHEN ends_with(name, '.ai.json') THEN 'ai' WHEN lower(regexp_extract(name, '.\\.([^.]*)$', 1, 's')) = 'json' THEN 'json' WHEN lower(regexp_extract(name, '.\\.([^.]*)$', 1, 's')) = 'xml' THEN 'xml' ELSE 'attachment' END AS role
  FROM ({_LISTING}) WHERE NOT list_bool_or(list_transform({_SIDES.replace("(", "[").replace(")", "]")}, lambda s: ends_with(name, s))))
GROUP BY folder, stem HAVING json IS NOT NULL AND xml IS NOT NULL{" AND ai IS NOT NULL" if need_ai else ""}
"""


def _listing(spark: SparkSession, d: str) -> DataFrame:
    a = _attachments(spark, d).select("record_id", "pos", "email_folder", F.replace(F.col("a.original_name"), F.lit("/"), F.lit("_")).alias("full_name")).where("full_name is not null")
    a = a.withColumn("stem", F.regexp_replace("full_name", r"(?s)(?<=.)\.[^.]*\z", ""))
    side = lambda n, suffix: F.when(F.col("record_id") % n == 0, F.concat("stem", F.lit(suffix)))
    names = F.array(F.concat("stem", F.lit(".json")), F.concat("stem", F.lit(".xml")), side(3, ".ai.json"), side(5, ".dropbox.json"), F.when(F.col("pos") > 0, F.col("full_name")))
    return a.select(F.concat(F.col("email_folder"), F.lit("/"), F.col("record_id").cast("string")).alias("folder"), F.explode(names).alias("name")).where("name is not null")


@_query(_bundles_sql(False))
def bundle_assembly(spark: SparkSession, d: str) -> DataFrame:
    return documents.bundles(_listing(spark, d))


@_query(_bundles_sql(True))
def bundles_with_answers(spark: SparkSession, d: str) -> DataFrame:
    return documents.bundles(_listing(spark, d), need_ai=True)


_ID = "regexp_replace({}, '^[\\s\\p{{Z}}<>]+|[\\s\\p{{Z}}<>]+$', '', 'g')"


@_query(f"""
WITH known AS (SELECT DISTINCT {_ID.format("m")} AS id FROM (SELECT unnest(message_ids) AS m FROM message_index)),
held AS (SELECT DISTINCT {_ID.format("message_id")} AS id FROM dropbox_uploads),
named AS (SELECT record_id, {_ID.format("message_id")} AS id FROM parsed_emails)
SELECT record_id, id, id IN (SELECT id FROM known WHERE id IS NOT NULL) AS recovered FROM named
WHERE id <> '' AND (id NOT IN (SELECT id FROM known WHERE id IS NOT NULL) OR id NOT IN (SELECT id FROM held WHERE id IS NOT NULL))
""")
def recover_predicate(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "parsed_emails").select("record_id", message_key("message_id").alias("id")).where("id is not null")
    known = table(spark, d, "message_index").select(F.explode("message_ids").alias("m")).select(message_key("m").alias("id")).where("id is not null")
    held = table(spark, d, "dropbox_uploads").select(message_key("message_id").alias("id")).where("id is not null")
    return dedup.new_or_recoverable(named, known, held, recover=True)


@_query("""
WITH jobs AS (SELECT upload_id, md5, email_dossier_path, email_stem FROM dropbox_uploads WHERE account_name IN ('ALPHA', 'BETA') ORDER BY string_split(email_dossier_path, '/'), email_stem, upload_id LIMIT 500)
SELECT md5, upload_id FROM (SELECT *, row_number() OVER (PARTITION BY md5 ORDER BY string_split(email_dossier_path, '/'), email_stem, upload_id) AS n FROM jobs) WHERE n = 1
""")
def limit_before_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The limit of a run counts jobs of all its accounts before duplicates are skipped."""
    rows = table(spark, d, "dropbox_uploads").select("account_name", "md5", F.col("email_dossier_path").alias("folder"), F.col("email_stem").alias("stem"), F.col("upload_id").alias("position"))
    jobs = enrich.jobs(rows, ["ALPHA", "BETA"], 500).select("md5", X.path_order("folder").alias("place"), "stem", "position")
    return dedup.first_wins(jobs, "md5", [F.col("place"), F.col("stem"), F.col("position")]).select("md5", F.col("position").alias("upload_id"))


@_query("SELECT email_folder, dense_rank() OVER (ORDER BY string_split(email_folder, '/')) AS place FROM (SELECT DISTINCT email_folder FROM parsed_emails WHERE email_folder IS NOT NULL)")
def path_component_sort(spark: SparkSession, d: str) -> DataFrame:
    folders = table(spark, d, "parsed_emails").select("email_folder").where("email_folder is not null").distinct()
    return ordering.placed(folders, [X.path_order("email_folder")], "place").select("email_folder", "place")


def _numbered_sql(name: str) -> str:
    return f"CASE WHEN n = 1 THEN {name} ELSE regexp_replace({name}, '^(.+)\\.[^.]*$', '\\1', 's') || '_' || (n - 1) || regexp_extract({name}, '^.+(\\.[^.]*)$', 1, 's') END"


@_query(f"""
WITH once AS (
  SELECT record_id, pos, email_folder, n AS first, {_numbered_sql("name")} AS shown FROM (
    SELECT record_id, pos, email_folder, a.original_name AS name, row_number() OVER (PARTITION BY email_folder, a.original_name ORDER BY record_id, pos) AS n FROM ({_ATT}) WHERE a.original_name IS NOT NULL))
SELECT record_id, pos, {_numbered_sql("shown")} AS numbered FROM (SELECT *, row_number() OVER (PARTITION BY email_folder, shown ORDER BY first, record_id, pos) AS n FROM once)
""")
def collision_suffix(spark: SparkSession, d: str) -> DataFrame:
    rows = _attachments(spark, d).select("record_id", "pos", "email_folder", F.col("a.original_name").alias("name")).where("name is not null")
    return dedup.number_collisions(rows, "email_folder", "name", ["record_id", "pos"], "numbered").select("record_id", "pos", "numbered")


def _note(k: str) -> str:
    return "'" + documents.NOTES[k].replace("'", "''") + "'"


@_query(f"""
SELECT record_id, pos, mode, note, CASE WHEN length(t) > 12000 THEN substring(t, 1, 12000) || chr(10) || '...[truncated]' ELSE t END AS text FROM (
  SELECT record_id, pos,
    CASE WHEN coalesce(a.is_email_body, false) THEN 'email_body' WHEN a.extracted_text IS NOT NULL THEN 'pre_extracted_text' WHEN NOT coalesce(a.size > 20000, false) THEN 'metadata_only' WHEN a.size > 500000 THEN 'skipped'
         WHEN ext IN ('txt','md','csv','json','xml','html','htm') THEN 'inline_text' ELSE 'metadata_only' END AS mode,
    CASE WHEN coalesce(a.is_email_body, false) THEN {_note("email_body")} WHEN a.extracted_text IS NOT NULL THEN 'Text read by ' || a.extracted_text_method || CASE WHEN coalesce(a.extracted_text_truncated, false) THEN ', its end was cut off' ELSE '' END
         WHEN NOT coalesce(a.size > 20000, false) THEN {_note("missing")} WHEN a.size > 500000 THEN {_note("skipped")} WHEN ext IN ('txt','md','csv','json','xml','html','htm') THEN NULL WHEN ext = 'pdf' THEN {_note("pdf")} ELSE {_note("other")} END AS note,
    CASE WHEN coalesce(a.is_email_body, false) THEN NULL WHEN a.extracted_text IS NOT NULL THEN a.extracted_text WHEN NOT coalesce(a.size > 20000, false) OR a.size > 500000 THEN NULL WHEN ext IN ('txt','md','csv','json','xml','html','htm') THEN coalesce(a.original_name, '') END AS t
  FROM (SELECT *, lower(regexp_extract(a.original_name, '.\\.([^.]*)$', 1, 's')) AS ext FROM ({_ATT})))
""")
def ingestion_router(spark: SparkSession, d: str) -> DataFrame:
    a = lambda f: F.col(f"a.{f}")
    r = documents.route(a("original_name"), a("is_email_body"), a("extracted_text"), a("extracted_text_method"), a("extracted_text_truncated"), a("size") > 20_000, a("size"), a("original_name"), max_bytes=500_000)
    return _attachments(spark, d).select("record_id", "pos", r.alias("r")).select("record_id", "pos", "r.mode", "r.note", "r.text")


@_query(f"""
SELECT record_id, pos, temporary, (starts_with(mime, 'image/') OR temporary) AND (record_id % 5 = 0 OR small OR temporary) AS embedded FROM (
  SELECT record_id, pos, coalesce(a.mime_type, '') AS mime, coalesce(a.size <= 30720, false) AS small,
    coalesce(n <> '' AND (starts_with(n,'tmp') OR starts_with(n,'image') OR starts_with(n,'part') OR starts_with(n,'att') OR starts_with(n,'inline') OR contains(n,'.tmp') OR contains(n,'unnamed') OR contains(n,'unknown') OR contains(n,'noname') OR regexp_matches(n, '\\.(tmp|dat|bin)\\.[0-9]+$')), false) AS temporary
  FROM (SELECT *, lower({_trim("a.original_name")}) AS n FROM ({_ATT})))
""")
def temp_name_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = _attachments(spark, d)
    embedded = X.is_embedded_image("a.mime_type", "a.original_name", F.col("record_id") % 5 == 0, F.lit(False), F.coalesce("a.size", F.lit(1 << 40)))
    return rows.select("record_id", "pos", X.looks_temporary("a.original_name").alias("temporary"), embedded.alias("embedded"))


_TAXONOMY = {"A": ["X", "Y"], "B": ["Z"]}


def _taxonomy():
    return F.create_map(*(v for k, subs in _TAXONOMY.items() for v in (F.lit(k), F.array(*map(F.lit, subs)))))


@_query("""
SELECT upload_id, error, issues FROM (SELECT upload_id,
  CASE WHEN main IS NULL THEN 'no `main_folder` (document `' || name || '`)' WHEN sub IS NULL THEN 'no `sub_folder` (document `' || name || '`)'
       WHEN main NOT IN ('A', 'B') THEN 'unknown main_folder `' || main || '` (document `' || name || '`)' END AS error,
  CASE WHEN main = 'A' AND sub NOT IN ('X', 'Y') THEN '`' || sub || '` is no sub_folder of `A` (document `' || name || '`); allowed values are: X, Y'
       WHEN main = 'B' AND sub <> 'Z' THEN '`' || sub || '` is no sub_folder of `B` (document `' || name || '`); allowed values are: Z' ELSE '' END AS issues
  FROM (SELECT upload_id, source_file_name AS name, ['A', 'B', 'C', NULL][1 + upload_id % 4] AS main, ['X', 'Z', NULL][1 + upload_id % 3] AS sub FROM dropbox_uploads))
""")
def taxonomy_validation(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda values, n: F.element_at(F.array(*(F.lit(v) for v in values)), (1 + F.col("upload_id") % n).cast("int"))
    item = F.struct(F.col("source_file_name").alias("file_name"), pick(["A", "B", "C", None], 4).alias("main_folder"), pick(["X", "Z", None], 3).alias("sub_folder"))
    rows = table(spark, d, "dropbox_uploads").select("upload_id", documents.folder_issues(F.array(item), _taxonomy()).alias("r"))
    return rows.select("upload_id", "r.error", F.when(F.col("r.error").isNull(), F.col("r.issues")).otherwise("").alias("issues"))


@_query("SELECT upload_id, coalesce(CASE WHEN upload_id % 3 = 0 THEN NULL WHEN upload_id % 3 = 1 THEN '' ELSE 'own' END, main_folder) AS main_folder, coalesce(CASE WHEN upload_id % 2 = 0 THEN NULL ELSE 'sub' END, sub_folder) AS sub_folder FROM dropbox_uploads")
def legacy_ai_normalise(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("upload_id")
    item = F.struct(F.when(u % 3 == 0, F.lit(None)).when(u % 3 == 1, "").otherwise("own").alias("main_folder"), F.when(u % 2 == 0, F.lit(None)).otherwise("sub").alias("sub_folder"))
    rows = table(spark, d, "dropbox_uploads").select("upload_id", documents.inherit_folders(F.array(item), F.col("main_folder"), F.col("sub_folder"))[0].alias("i"))
    return rows.select("upload_id", "i.main_folder", "i.sub_folder")


@_query("SELECT upload_id, array_to_string(list_transform(generate_series(1, len(p)), lambda i: '/' || array_to_string(p[1:i], '/')), '|') AS prefixes, CASE WHEN regexp_replace(dropbox_path, '/[^/]*$', '') = '' THEN '/' ELSE regexp_replace(dropbox_path, '/[^/]*$', '') END AS parent FROM (SELECT upload_id, dropbox_path, list_filter(string_split(dropbox_path, '/'), lambda x: x <> '') AS p FROM dropbox_uploads)")
def folder_prefixes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dropbox_uploads").select("upload_id", F.array_join(X.folder_prefixes("dropbox_path"), "|").alias("prefixes"), X.parent_folder("dropbox_path").alias("parent"))


_SAFE = lambda x: _trim(f"regexp_replace({x}, '[:\\\\/*?|!#$%^<>\"\\r\\n\\t]', '', 'g')")


@_query(f"""
SELECT upload_id, final_name, '/Archives/A_TRAITER/' || final_name AS path, regexp_replace(final_name, '^(.+)\\.[^.]*$', '\\1', 's') || '.xml' AS xml_name FROM (
  SELECT upload_id, CASE WHEN p IS NULL OR p = '' THEN CASE WHEN o IS NULL OR o = '' THEN 'attachment.bin' ELSE o END WHEN suffix = '' THEN p ELSE regexp_replace(p, '^(.+)\\.[^.]*$', '\\1', 's') || suffix END AS final_name FROM (
    SELECT upload_id, p, o, regexp_extract(o, '^.+(\\.[^.]+)$', 1, 's') AS suffix FROM (SELECT upload_id, {_SAFE("attachment_summary")} AS p, {_SAFE("source_file_name")} AS o FROM dropbox_uploads)))
""")
def ensure_extension(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dropbox_uploads").select("upload_id", X.ensure_extension("attachment_summary", "source_file_name").alias("final_name"))
    return rows.select("upload_id", "final_name", X.store_path(F.lit("/Archives"), "final_name").alias("path"), X.xml_name("final_name").alias("xml_name"))


_XML = "'<email-content><part>' || '<content format=\"plain\"><![CDATA[' || replace(coalesce(text, ''), ']]>', ']]]]><![CDATA[>') || ']]></content>' || '<content format=\"markdown\" source-format=\"html\"><![CDATA[' || coalesce(source, '') || ']]></content></part></email-content>'"
_BLOCK_SQL = "'  <enrichment><![CDATA[' || replace('{{\"n\": \"$1 \\\"}}]]>' || coalesce(source, ''), ']]>', ']]]]><![CDATA[>') || ']]></enrichment>' || chr(10)".replace("{{", "{").replace("}}", "}")


@_query(f"SELECT doc_id, {_XML[: -len('</email-content>') - 1]}' || chr(10) || {_BLOCK_SQL} || '</email-content>' AS enriched FROM documents")
def ai_block_embed(spark: SparkSession, d: str) -> DataFrame:
    """A block is embedded, then replaced by another."""
    rows = table(spark, d, "documents").withColumn("xml", F.expr(_XML))
    once = rows.withColumn("xml", markup.embed_block("xml", F.coalesce("text", F.lit(""))))
    return once.select("doc_id", markup.embed_block("xml", F.concat(F.lit('{"n": "$1 \\"}]]>'), F.coalesce("source", F.lit("")))).alias("enriched"))


_PART = "CASE WHEN length({0}) > 12000 THEN substring({0}, 1, 12000) || chr(10) || '...[truncated]' ELSE {0} END"


@_query(f"""
SELECT doc_id, CASE WHEN one = '' AND two = '' THEN xml WHEN one = '' THEN 'Part 2 [markdown from html]' || chr(10) || two WHEN two = '' THEN 'Part 1 [plain]' || chr(10) || {_PART.format("one")} ELSE 'Part 1 [plain]' || chr(10) || {_PART.format("one")} || chr(10) || chr(10) || 'Part 2 [markdown from html]' || chr(10) || two END AS body
FROM (SELECT doc_id, {_XML} AS xml, {_trim("replace(coalesce(text, ''), ']]>', ']]]]><![CDATA[>')")} AS one, {_trim("coalesce(source, '')")} AS two FROM documents)
""")
def xml_body_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", markup.body_for_prompt(F.expr(_XML)).alias("body"))


_CASES = """VALUES (1, 429, '{"error":{"code":"insufficient_quota"}}', NULL, NULL), (2, 429, '{"error":{"type":"insufficient_quota"}}', NULL, '7'), (3, 429, '{"error":{"message":"Please try again in 20ms"}}', NULL, NULL),
(4, 503, 'busy', '150', '2'), (5, 404, 'Please try again in 3s', NULL, NULL), (6, 408, '{}', 'x', '4'), (7, 500, '', NULL, NULL), (8, 409, '{"error_summary":"path/conflict/file/.."}', NULL, NULL)"""


@_query("SELECT * FROM (VALUES (1, false, -1, false), (2, false, 7000, false), (3, true, 20, false), (4, true, 150, false), (5, false, 3000, false), (6, true, 4000, false), (7, true, -1, false), (8, false, -1, true)) t(case_id, retryable, wait_ms, conflict)")
def error_classification(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.sql(f"SELECT * FROM ({_CASES}) t(case_id, status, body, after_ms, after_s)")
    message = F.coalesce(F.get_json_object("body", "$.error.message"), F.col("body"))
    return rows.select("case_id", responses.is_retryable(F.col("status"), F.col("body")).alias("retryable"), F.coalesce(responses.retry_after_ms(F.col("after_ms"), F.col("after_s"), message), F.lit(-1)).alias("wait_ms"), responses.is_conflict(F.col("body")).alias("conflict"))


@_query("SELECT " + ", ".join("'5' AS layout_version" if c == "layout_version" else "'2026-01-01T00:00:00+00:00' AS uploaded_at" if c == "uploaded_at" else c for c in documents.ARCHIVE_COLUMNS) + " FROM dropbox_uploads")
def archive_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the archive made again from their values; what was missing is a null first."""
    given = {c: F.nullif(F.col(c), F.lit("")) for c in documents.ARCHIVE_COLUMNS if c not in ("layout_version", "uploaded_at")}
    return documents.archive_rows(table(spark, d, "dropbox_uploads"), given, F.lit("2026-01-01T00:00:00+00:00"))


@_query("SELECT md5, upload_id::VARCHAR AS source_file_name FROM (SELECT md5, upload_id, row_number() OVER (PARTITION BY md5 ORDER BY email_dossier_path, email_stem, upload_id::VARCHAR) AS n FROM dropbox_uploads) WHERE n = 1")
def archive_append(spark: SparkSession, d: str) -> DataFrame:
    """An archive to which the uploads are added twice: one row for each document."""
    path = fresh_path(spark, "archive")
    rows = table(spark, d, "dropbox_uploads").withColumn("source_file_name", F.col("upload_id").cast("string"))
    for _ in range(2):
        archive.append(spark, path, rows)
    return archive.load(spark, path).select("md5", "source_file_name")


@_query("SELECT main_folder, year_folder, attachment_importance, count(*) AS n, count(DISTINCT md5) AS documents FROM dropbox_uploads GROUP BY ALL")
def archive_summary(spark: SparkSession, d: str) -> DataFrame:
    archive.register(spark, f"{d}/dropbox_uploads.parquet", "archive_view")
    return spark.sql("SELECT main_folder, year_folder, attachment_importance, count(*) AS n, count(DISTINCT md5) AS documents FROM archive_view GROUP BY ALL")


@_query("SELECT account_name, year_folder, count(*) AS n, grouping_id(account_name, year_folder) AS level FROM dropbox_uploads GROUP BY CUBE (account_name, year_folder)")
def archive_cube(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dropbox_uploads").cube("account_name", "year_folder").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


@_query("SELECT count(*) AS records, count(DISTINCT md5) AS distinct_md5, count_if(md5 = '') AS without_md5 FROM dropbox_uploads")
def archive_counts(spark: SparkSession, d: str) -> DataFrame:
    return archive.load(spark, f"{d}/dropbox_uploads.parquet").agg(F.count("*").alias("records"), F.countDistinct("md5").alias("distinct_md5"), F.count_if(F.col("md5") == "").alias("without_md5"))


@_query("SELECT upload_id FROM dropbox_uploads WHERE account_name IN ('ALPHA', 'BETA')")
def account_filter(spark: SparkSession, d: str) -> DataFrame:
    return enrich.jobs(table(spark, d, "dropbox_uploads"), ["ALPHA", "BETA"], None).select("upload_id")


@_query(f"SELECT DISTINCT id FROM (SELECT {_ID.format('m')} AS id FROM (SELECT unnest(message_ids) AS m FROM message_index) UNION ALL SELECT {_ID.format('message_id')} FROM parsed_emails) WHERE id <> ''")
def index_union(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "message_index").select(F.explode("message_ids").alias("m")).select(message_key("m").alias("id"))
    return index.union(known, table(spark, d, "parsed_emails").select(message_key("message_id").alias("id")))


@_query("SELECT record_id FROM parsed_emails WHERE " + _trim("message_id") + " <> ''")
def blank_id_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed_emails").where(X.blank_to_null("message_id").isNotNull()).select("record_id")


@_query(rf"""
SELECT contact_id, CASE WHEN found THEN {_trim("regexp_extract(raw, '^(.*)<([^<]*)>', 1, 's')")} ELSE '' END AS name, lower({_trim("CASE WHEN found THEN regexp_extract(raw, '^(.*)<([^<]*)>', 2, 's') ELSE raw END")}) AS email
FROM (SELECT contact_id, raw, regexp_matches(raw, '^(.*)<([^<]*)>', 's') AS found FROM header_contacts)
""")
def contact_info(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "header_contacts").select("contact_id", X.contact_info("raw").alias("c")).select("contact_id", "c.name", "c.email")


@_query("SELECT contact_id, " + _trim("regexp_replace(CASE WHEN n <> '' AND e <> '' THEN n || ' (' || e || ')' WHEN e <> '' THEN e ELSE n END, '[:/*?|!#$%^<>\"\\r\\n\\t]', '', 'g')") + f" AS folder, CASE WHEN n <> '' THEN n || ' <' || address || '>' ELSE address END AS shown FROM (SELECT contact_id, address, {_trim('coalesce(name, $$$$)')} AS n, {_trim('coalesce(address, $$$$)')} AS e FROM header_contacts)")
def contact_folder(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "header_contacts").select("contact_id", X.contact_folder("name", "address").alias("folder"), X.format_address("name", "address").alias("shown"))


@_query("SELECT record_id, CASE WHEN record_id % 2 = 0 THEN '🔴 ' ELSE '🔵 ' END || subject AS marked, " + _trim("regexp_replace(subject, '^(?:🔴 |🔵 )', '')") + " AS bare FROM parsed_emails")
def subject_prefix(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed_emails").select("record_id", X.mark_direction("subject", F.col("record_id") % 2 == 0).alias("marked"), X.normalize_subject("subject").alias("bare"))


@_query(f"""
SELECT record_id, pos, CASE WHEN ext = 'txt' THEN 'text/plain' WHEN ext = 'md' THEN 'text/markdown' WHEN ext IN ('html', 'htm') THEN 'text/html' WHEN ext = 'csv' THEN 'text/csv' WHEN ext IN ('json', 'xml', 'pdf') THEN 'application/' || ext
  WHEN ext IN ('png', 'gif', 'webp', 'jpeg') THEN 'image/' || ext WHEN ext = 'jpg' THEN 'image/jpeg' WHEN ext = 'svg' THEN 'image/svg+xml' ELSE 'application/octet-stream' END AS mime,
  ext IN ('txt','md','csv','json','xml','html','htm') AS text_like FROM (SELECT record_id, pos, lower(regexp_extract(coalesce(a.original_name, ''), '.\\.([^.]*)$', 1, 's')) AS ext FROM ({_ATT}))
""")
def mime_guess(spark: SparkSession, d: str) -> DataFrame:
    name = F.coalesce("a.original_name", F.lit(""))
    return _attachments(spark, d).select("record_id", "pos", X.guess_mime_type(name).alias("mime"), X.is_text_like(name).alias("text_like"))


@_query("SELECT doc_id, substring(t, 1, 80000) AS text, length(t) > 80000 AS truncated, CASE WHEN length(" + _trim("text") + ") = 0 THEN '<empty body>' ELSE substring(" + _trim("text") + ", 1, 400) END AS body FROM (SELECT doc_id, text, " + _trim("regexp_replace(text, '\\r\\n?', chr(10), 'g')") + " AS t FROM documents)")
def finalize_extraction(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", X.finalize_extraction("text").alias("e"), X.compact_body("text").alias("body"))
    return rows.select("doc_id", "e.text", "e.truncated", "body")


@_query("SELECT * FROM (VALUES (1, 'Direction générale'), (2, 'Chloé SAUNIER'), (3, '=utf-8QBob='), (4, 'plain'), (5, 'Zoé')) t(case_id, name)")
def display_names(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.sql("""SELECT * FROM (VALUES (1, "Direction gÃ©nÃ©rale"), (2, "=utf-8QChlo=C3=A9_SAUNIER="), (3, "=utf-8QBob="), (4, " 'plain' "), (5, '"ZoÃ©"')) t(case_id, name)""")
    return rows.select("case_id", X.normalize_display_name("name").alias("name"))


@_query("SELECT * FROM (VALUES (1, '2026-11-17T09:00:00+00:00'), (2, '2024-02-29T23:30:00+00:00'), (3, NULL), (4, '2023-03-15T12:34:56+00:00')) t(case_id, sent)")
def message_dates(spark: SparkSession, d: str) -> DataFrame:
    from lettrine.functions import dates

    rows = spark.sql("SELECT * FROM (VALUES (1, 'Tue, 17 Nov 2026 10:00:00 +0100'), (2, '29 Feb 2024 18:30:00 -0500'), (3, 'no date'), (4, 'Wed, 15 Mar 2023 12:34:56 +0000 (UTC)')) t(case_id, v)")
    return rows.select("case_id", dates.message_date("v").alias("sent"))


@_query(r"SELECT record_id, expedition_date AS sent FROM parsed_emails WHERE regexp_full_match(expedition_date, '\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00')")
def header_dates(spark: SparkSession, d: str) -> DataFrame:
    """Date headers written from the stored dates and read back."""
    from lettrine.functions import dates

    rows = table(spark, d, "parsed_emails").where(F.col("expedition_date").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00\z"))
    at = F.to_timestamp("expedition_date")
    weekday = F.element_at(F.array(*map(F.lit, ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"))), F.dayofweek(at))
    zoned = F.when(F.col("record_id") % 2 == 0, F.concat(F.date_format(at + F.expr("INTERVAL 5 HOURS 30 MINUTES"), "d MMM yyyy HH:mm:ss"), F.lit(" +0530"))).otherwise(F.concat(F.date_format(at, "d MMM yyyy HH:mm:ss"), F.lit(" +0000")))
    header = F.when(F.col("record_id") % 2 == 0, zoned).otherwise(F.concat(weekday, F.lit(", "), zoned))
    return rows.select("record_id", dates.message_date(header).alias("sent"))


_EML = "'Message-ID: <' || doc_id || '@x.test>' || chr(13) || chr(10) || 'Subject: Document ' || doc_id || chr(13) || chr(10) || 'To: A <a@x.test>, b@y.test' || chr(13) || chr(10) || 'Content-Type: text/plain; charset=utf-8' || chr(13) || chr(10) || 'Content-Transfer-Encoding: 8bit' || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(text, '')"


@_query(f"SELECT doc_id, '<' || doc_id || '@x.test>' AS message_id, 'Document ' || doc_id AS subject, 'a@x.test|b@y.test' AS targets, 'email-body.xml' AS document, md5({_EML}) AS md5, strlen({_EML}) AS size FROM documents")
def mime_parse(spark: SparkSession, d: str) -> DataFrame:
    """Messages written around the documents and parsed: header fields, contacts, the virtual document of a body."""
    from lettrine.plans import mime

    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.encode(F.expr(_EML.replace("chr(13)", "char(13)").replace("chr(10)", "char(10)")), "UTF-8").alias("content"))
    a = F.col("attachments")[0]["meta"]
    return mime.parse(rows).select(F.col("path").cast("long").alias("doc_id"), "message_id", "subject", F.array_join(F.transform("targets", lambda t: t["address"]), "|").alias("targets"), a["original_name"].alias("document"), a["md5"].alias("md5"), a["size"].alias("size"))


@_query("SELECT * FROM (VALUES (1, '/Mes docs/Impots'), (2, '/'), (3, NULL), (4, '/a/b'), (5, NULL)) t(case_id, root)")
def store_roots(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.sql("SELECT * FROM (VALUES (1, ' Mes docs/Impots '), (2, '/'), (3, '  '), (4, '//a// b'), (5, '/a/??/b')) t(case_id, v)")
    return rows.select("case_id", X.normalize_root("v").alias("root"))


@_query("SELECT * FROM (VALUES (1, '{\"a\":1}'), (2, '{\"b\":2}'), (3, '[3]'), (4, NULL), (5, NULL)) t(case_id, answer)")
def model_output(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([
        (1, '{"output_text": "{\\"a\\":1}"}'), (2, '{"output": [{"content": [{"text": "no json {"}, {"text": "{\\"b\\":2}"}]}]}'), (3, '{"output": [{}, {"content": [{"arguments": "[3]"}]}]}'),
        (4, '{"output_text": "not json {"}'), (5, '{"output": []}'),
    ], "case_id int, payload string")
    return rows.select("case_id", responses.output_json(F.col("payload")).alias("answer"))


@_query("SELECT record_id, '[' || array_to_string(list_filter(string_split(email_folder, '/'), lambda x: x <> ''), '|') || ']' AS parts, string_split(email_folder, '/')[-1] AS last FROM parsed_emails WHERE email_folder IS NOT NULL")
def folder_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "parsed_emails").where("email_folder is not null")
    return rows.select("record_id", F.concat(F.lit("["), F.array_join(F.filter(X.path_order("email_folder"), lambda p: p != ""), "|"), F.lit("]")).alias("parts"), X.last_component("email_folder").alias("last"))


@_query("SELECT md5, upload_id, row_number() OVER (PARTITION BY md5 ORDER BY uploaded_at, upload_id) AS rank FROM dropbox_uploads")
def retry_ranks(spark: SparkSession, d: str) -> DataFrame:
    """The candidates of each document, for sinks that try the next one when an upload fails."""
    rows = table(spark, d, "dropbox_uploads").select("md5", "upload_id", "uploaded_at")
    return dedup.ranked(rows, "md5", ["uploaded_at", "upload_id"]).select("md5", "upload_id", "rank")


@_query("SELECT count_if(md5 <> '') AS processed, count_if(md5 = '') AS failed, bool_or(uploaded_at <> '') AS dirty FROM dropbox_uploads")
def run_counters(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dropbox_uploads").select(F.when(F.col("md5") == "", "unreadable").alias("error"), (F.col("uploaded_at") != "").alias("appended"))
    return documents.outcome_counts(rows)


@_query(f"SELECT record_id, pos, json_merge_patch('{{}}'::JSON, to_json({{'original_name': a.original_name, 'mime_type': a.mime_type, 'md5': a.md5}}))::VARCHAR AS pruned FROM ({_ATT})")
def prompt_pruning(spark: SparkSession, d: str) -> DataFrame:
    """Metadata for a prompt without extracted text; the scan reads only the kept fields."""
    return _attachments(spark, d).select("record_id", "pos", F.to_json(F.struct("a.original_name", "a.mime_type", "a.md5")).alias("pruned"))


_BINARY = "sha256(coalesce(text, ''))"
_PARTS = (
    "'From: A <a@x.test>' || nl || 'Subject: S' || nl || 'MIME-Version: 1.0' || nl || 'Content-Type: multipart/mixed; boundary=\"b\"' || nl || nl"
    " || '--b' || nl || 'Content-Type: text/plain; charset=utf-8' || nl || 'Content-Transfer-Encoding: 8bit' || nl || nl || 'body ' || doc_id || nl"
    f" || '--b' || nl || 'Content-Type: application/pdf' || nl || 'Content-Disposition: attachment; filename=\"scan.pdf\"' || nl || nl || {_BINARY} || nl"
    " || '--b' || nl || 'Content-Type: application/pdf' || nl || 'Content-Disposition: attachment; filename=\"scan.pdf\"' || nl || nl || 'x' || doc_id || nl"
    " || '--b' || nl || 'Content-Type: image/png; name=\"image001.png\"' || nl || 'Content-Disposition: inline; filename=\"image001.png\"' || nl || nl || 'y' || nl"
    " || '--b--' || nl"
)


@_query(f"""
SELECT doc_id, 0 AS pos, 'scan.pdf' AS name, 'application/pdf' AS mime, md5({_BINARY}) AS md5, 64 AS size FROM documents
UNION ALL SELECT doc_id, 1, 'scan_1.pdf', 'application/pdf', md5('x' || doc_id), length('x' || doc_id) FROM documents
""")
def mime_attachments(spark: SparkSession, d: str) -> DataFrame:
    """Messages with two equally named documents and an image of the layout: names, hashes and sizes of the documents."""
    from lettrine.plans import mime

    sql = re.sub(r"\bnl\b", "char(13) || char(10)", _PARTS).replace("sha256(", "sha2(").replace("'')) ||", "''), 256) ||")
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.encode(F.expr(sql), "UTF-8").alias("content"))
    a = mime.parse(rows).select(F.col("path").cast("long").alias("doc_id"), F.posexplode("attachments").alias("pos", "a"))
    return a.select("doc_id", "pos", F.col("a.meta.original_name").alias("name"), F.col("a.meta.mime_type").alias("mime"), F.col("a.meta.md5").alias("md5"), F.col("a.meta.size").alias("size"))


_PROPOSED = "year_folder || ' ' || source_file_name"


@_query(rf"""
SELECT upload_id, final_file_name, xml_file_name, '/Archives/A_TRAITER/' || final_file_name AS dropbox_path, year_folder, CASE WHEN main IS NULL THEN 'missing folder' WHEN year_folder IS NULL THEN 'no year in the proposed name or the date' END AS error FROM (
  SELECT *, regexp_replace(final_file_name, '^(.+)\.[^.]*$', '\1', 's') || '.xml' AS xml_file_name,
    coalesce(nullif(regexp_extract(proposed, '\b((?:19|20)\d{{2}})\b', 1), ''), nullif(regexp_extract(expedition_date, '\b((?:19|20)\d{{2}})\b', 1), '')) AS year_folder FROM (
    SELECT upload_id, proposed, expedition_date, CASE WHEN upload_id % 7 = 0 THEN NULL ELSE 'M' END AS main,
      CASE WHEN p = '' THEN CASE WHEN o = '' THEN 'attachment.bin' ELSE o END WHEN suffix = '' THEN p ELSE regexp_replace(p, '^(.+)\.[^.]*$', '\1', 's') || suffix END AS final_file_name FROM (
      SELECT upload_id, expedition_date, proposed, p, o, regexp_extract(o, '^.+(\.[^.]+)$', 1, 's') AS suffix FROM (
        SELECT upload_id, expedition_date, {_PROPOSED} AS proposed, {_SAFE(_PROPOSED)} AS p, {_SAFE("CASE WHEN upload_id % 3 = 0 THEN 'email-body.xml' ELSE source_file_name END")} AS o FROM dropbox_uploads))))
""")
def filing_plan(spark: SparkSession, d: str) -> DataFrame:
    """Where each upload would go again: names, path, year and error; every third is the body of its message."""
    u = F.col("upload_id")
    item = F.struct(F.expr(_PROPOSED).alias("proposed_file_name"), F.when(u % 7 != 0, "M").alias("main_folder"), F.lit("S").alias("sub_folder"), F.lit(None).cast("string").alias("mime_type"))
    rows = table(spark, d, "dropbox_uploads").select("upload_id", "source_file_name", (u % 3 == 0).alias("is_email_body"), "md5", F.col("attachment_mime_type").alias("parsed_mime"), "expedition_date", F.lit("<email-content></email-content>").alias("xml_content"), F.lit("{}").alias("ai_content"), item.alias("item"))
    return documents.plan(rows, "/Archives").select("upload_id", "final_file_name", "xml_file_name", "dropbox_path", "year_folder", "error")


@_query(f"SELECT DISTINCT {_ID.format('m')} AS id FROM (SELECT unnest(message_ids) AS m FROM message_index) WHERE id <> ''")
def index_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The index of message ids, written as its JSON document and loaded again."""
    ids = table(spark, d, "message_index").select(F.explode("message_ids").alias("m")).select(message_key("m").alias("id")).where("id is not null")
    path = fresh_path(spark, "index") + "/message-index.json"
    index.export(ids, path)
    return index.load(spark, path)


@_query("SELECT upload_id::VARCHAR AS md5, '' AS email_subject, year_folder, email_importance FROM dropbox_uploads")
def archive_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """An archive of two files, one with other types and columns, one without some: read in the stored columns."""
    path = fresh_path(spark, "archive")
    rows = table(spark, d, "dropbox_uploads").select(F.col("upload_id").alias("md5"), F.nullif("year_folder", F.lit("")).alias("year_folder"), "email_importance", F.lit(1).alias("unknown"))
    rows.where("md5 % 2 = 0").write.parquet(path)
    rows.where("md5 % 2 = 1").drop("unknown").write.mode("append").parquet(path)
    return archive.load(spark, path).select("md5", "email_subject", "year_folder", "email_importance")


_STEM = _trim("regexp_replace(regexp_replace(string_split(email_file_name, '/')[-1], '^(.+)[.][^.]*$', '\\1', 's'), '[:/*?|!#$%^<>\"\\r\\n\\t]', '', 'g')")


@_query(f"""
SELECT folder, name, record_id FROM (
  SELECT *, row_number() OVER (PARTITION BY folder, stem ORDER BY name, record_id) AS n FROM (
    SELECT email_folder AS folder, email_file_name AS name, record_id, CASE WHEN s = '' THEN 'email' ELSE s END AS stem FROM (
      SELECT *, {_STEM} AS s FROM parsed_emails WHERE email_folder IS NOT NULL AND email_file_name IS NOT NULL)) WHERE (folder, stem) NOT IN (SELECT email_dossier_path, email_stem FROM dropbox_uploads)) WHERE n = 1
""")
def parse_pending(spark: SparkSession, d: str) -> DataFrame:
    """Saved messages that have no bundle yet, those whose names clean alike once; the archive stands for the bundles."""
    listing = table(spark, d, "parsed_emails").where("email_folder is not null and email_file_name is not null").select(F.col("email_folder").alias("folder"), F.col("email_file_name").alias("name"), "record_id", F.format_string("%020d", "record_id").alias("path"))
    done = table(spark, d, "dropbox_uploads").select(F.col("email_dossier_path").alias("folder"), F.col("email_stem").alias("stem"))
    return parse.pending(listing, done).select("folder", "name", "record_id")


@_query("SELECT upload_id FROM dropbox_uploads WHERE NOT (upload_id % 3 = 0 OR upload_id % 3 = 1 AND parse_json_content = '' AND parse_xml_content = '')")
def up_to_date_filter(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose input changed since their answer: a third is unchanged, of a third the message became empty."""
    rows = table(spark, d, "dropbox_uploads").select("upload_id", F.lit("f").alias("folder"), F.lit("s").alias("stem"), F.col("upload_id").alias("position"), F.col("parse_json_content").alias("json"), F.col("parse_xml_content").alias("xml"), F.lit(None).cast("binary").alias("content"))
    before = rows.where("upload_id % 3 < 2").withColumn("json", F.when(F.col("upload_id") % 3 == 0, F.col("json")).otherwise("")).withColumn("xml", F.when(F.col("upload_id") % 3 == 0, F.col("xml")).otherwise(""))
    return enrich.outdated(enrich.with_input_hash(rows, "spec"), enrich.with_input_hash(before, "spec")).select("upload_id")


@_query("SELECT array_to_string(list_sort(list_distinct(list(sub_folder))), '|') AS sub_folders FROM dropbox_uploads WHERE sub_folder <> ''")
def distinct_sub_folders(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "dropbox_uploads").where("sub_folder <> ''").groupBy("main_folder").agg(F.collect_set("sub_folder").alias("subs"))
    taxonomy = pairs.agg(F.map_from_entries(F.collect_list(F.struct("main_folder", "subs"))).alias("t"))  # a handful of folders
    return taxonomy.select(F.array_join(documents.sub_folders(F.col("t")), "|").alias("sub_folders"))


_ALTERNATIVE = (
    "'Subject: S' || nl || 'MIME-Version: 1.0' || nl || 'Content-Type: multipart/mixed; boundary=\"m\"' || nl || nl || '--m' || nl || 'Content-Type: multipart/alternative; boundary=\"b\"' || nl || nl"
    " || '--b' || nl || 'Content-Type: text/html; charset=utf-8' || nl || nl || '<p>not shown</p>' || nl || '--b' || nl || 'Content-Type: text/plain; charset=utf-8' || nl || 'Content-Transfer-Encoding: 8bit' || nl || nl || body || nl || '--b--' || nl"
    " || '--m' || nl || 'Content-Type: text/html; charset=utf-8' || nl || 'Content-Disposition: inline' || nl || nl || '<p>one<br>two ' || doc_id || '</p>' || nl || '--m--' || nl"
)


@_query("""
SELECT doc_id, '    <part path="1" kind="multipart" mime-type="multipart/mixed" boundary="m" disposition="inline">' || chr(10)
  || '      <part path="1.1.2" kind="body" mime-type="text/plain" charset="utf-8" transfer-encoding="8bit" disposition="inline">' || chr(10)
  || '        <content format="plain"><![CDATA[' || replace(body, ']]>', ']]]]><![CDATA[>') || ']]></content>' || chr(10) || '      </part>' || chr(10)
  || '      <part path="1.2" kind="body" mime-type="text/html" charset="utf-8" disposition="inline">' || chr(10)
  || '        <content format="markdown" source-format="html"><![CDATA[one' || chr(10) || 'two ' || doc_id || ']]></content>' || chr(10) || '      </part>' || chr(10) || '    </part>' AS xml
FROM (SELECT doc_id, sha256(coalesce(text, '')) || ']]>' AS body FROM documents)
""")
def mime_xml(spark: SparkSession, d: str) -> DataFrame:
    """Messages with an alternative, of which the plain form is taken, and an HTML body: the XML of their bodies."""
    from lettrine.plans import mime

    sql = re.sub(r"\bnl\b", "char(13) || char(10)", _ALTERNATIVE).replace("|| body ||", "|| sha2(coalesce(text, ''), 256) || ']]>' ||")
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.encode(F.expr(sql), "UTF-8").alias("content"))
    return mime.parse(rows).select(F.col("path").cast("long").alias("doc_id"), F.col("body_xml").alias("xml"))


_ANSWER = '{"email_summary": "s", "email_importance": "HAUTE", "attachment_summaries": [{"file_name": "%s", "mime_type": null, "summary": "s", "importance": "BASSE", "proposed_file_name": "2024 f", "main_folder": "%s", "sub_folder": "%s"}]}'


@_query("""
SELECT doc_id, CASE WHEN doc_id % 5 <> 0 AND doc_id % 7 <> 0 THEN '{"email_summary": "s", "email_importance": "HAUTE", "attachment_summaries": [{"file_name": "' || doc_id || '", "mime_type": null, "summary": "s", "importance": "BASSE", "proposed_file_name": "2024 f", "main_folder": "A", "sub_folder": "X"}]}' END AS ai,
  CASE WHEN doc_id % 5 = 0 THEN 'ServiceError: status 400: no' WHEN doc_id % 7 = 0 THEN 'ValueError: $.attachment_summaries[0].main_folder: not one of the allowed values' END AS error FROM documents
""")
def enrich_run(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a model that is busy at first, needs a repair for every third, refuses every fifth and never mends every seventh."""
    s = spec.read('## Folder Taxonomy\n```json\n{"A": ["X"], "B": ["Y"]}\n```\n')

    def factory():
        asked: dict[int, int] = {}

        def model(request: dict) -> dict:
            doc = int(request["prompt"].split("\n")[0])
            asked[doc] = asked.get(doc, 0) + 1
            if doc % 5 == 0:
                raise enrich.ServiceError(400, "no")
            if asked[doc] == 1 and doc % 2 == 0:
                raise enrich.ServiceError(503, "busy", wait_s=0)
            repaired = request["cache_key"].endswith(":repair")
            main, sub = ("C", "X") if doc % 7 == 0 else ("A", "Y") if doc % 3 == 0 and not repaired else ("A", "X")
            return {"output_text": _ANSWER % (doc, main, sub)}

        return model

    request = F.to_json(F.struct(F.col("doc_id").cast("string").alias("prompt"), F.lit("k").alias("cache_key")))
    rows = table(spark, d, "documents").select(F.lit("f").alias("folder"), F.col("doc_id").cast("string").alias("stem"), F.lit(0).alias("position"), F.lit("h").alias("input_hash"), request.alias("request"))
    good, bad = enrich.run(rows, s, factory)
    doc = F.col("stem").cast("long").alias("doc_id")
    none = F.lit(None).cast("string")
    return good.select(doc, "ai", none.alias("error")).unionByName(bad.select(F.element_at(F.split("key", "/"), 2).cast("long").alias("doc_id"), none.alias("ai"), "error"))


@_query(f"""
WITH known AS (SELECT {_ID.format("m")} AS id FROM (SELECT unnest(message_ids) AS m FROM message_index)),
named AS (SELECT record_id, '<' || {_ID.format("message_id")} || '>' AS id, {_ID.format("message_id")} AS bare FROM parsed_emails)
SELECT id, min(record_id) AS record_id FROM named WHERE bare <> '' AND NOT contains(bare, ' ') AND bare NOT IN (SELECT id FROM known WHERE id IS NOT NULL) GROUP BY id
""")
def ingest_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Messages written to a folder of saved mail, each new one once, and read again by the mailbox source."""
    key = message_key("message_id")
    known = table(spark, d, "message_index").select(F.explode("message_ids").alias("m")).select(F.concat(F.lit("<"), message_key("m"), F.lit(">")).alias("id")).where("id is not null")
    nl = F.lit("\r\n")
    raw = F.concat(F.lit("Message-ID: <"), key, F.lit(">"), nl, F.lit("From: A <a@x.test>"), nl, F.lit("Subject: "), F.col("record_id").cast("string"), nl, F.lit("Date: Tue, 17 Nov 2026 10:00:00 +0100"), nl, nl, F.lit("body"), nl)
    e = table(spark, d, "parsed_emails").where(key.isNotNull() & ~F.contains(key, F.lit(" ")))
    mails = e.select(F.lit("A").alias("account"), F.lit("in").alias("direction"), F.lit("INBOX").alias("folder"), F.format_string("%020d", "record_id").alias("path"), F.col("record_id").alias("seq"), F.encode(raw, "UTF-8").alias("content"))
    base = fresh_path(spark, "mails")
    held = spark.createDataFrame([], "id string")
    mails = persisted(mails, "mails")
    ingest.save(ingest.with_contents(ingest.named(ingest.to_save(mails, known, held)), mails), base).write.format("noop").mode("overwrite").save()
    mailbox.register(spark)
    read = spark.read.format("mailbox").option("path", base.removeprefix("file://")).load()
    return ingest.headers(read).select("id", F.regexp_extract("subject", r"(\d+)\z", 1).cast("long").alias("record_id"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
