"""Stage 2: saved messages to document bundles, one row for each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrine.functions import dates
from lettrine.functions import text as X
from lettrine.operators import dedup
from lettrine.plans import mime, pdf

STATE = ["folder", "stem"]


def pending(listing: DataFrame, parsed: DataFrame) -> DataFrame:
    """Files whose bundle does not exist yet; of those of a folder whose names clean alike the first by name.

    Only names and paths take part: a ``content`` in the listing is left out, and
    ``mailbox.contents`` reads the bytes of what is left.
    """
    named = listing.drop("content").withColumn("stem", X.stem_or("name", "email"))
    return dedup.first_wins(dedup.not_in(named, parsed, STATE), STATE, [F.col("name"), F.col("path")])


def _attr(name: str, value: Column) -> Column:
    escaped = F.replace(F.replace(F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    return F.when(value.isNotNull(), F.concat(F.lit(f' {name}="'), escaped, F.lit('"'))).otherwise(F.lit(""))


def bundles(files: DataFrame, parsing_folder: str = "", native: pdf.Extractor = pdf.none, ocr: pdf.Extractor = pdf.none) -> tuple[DataFrame, DataFrame]:
    """(bundles, failures) of files with folder, stem, name, path and content; ``native`` and ``ocr`` read PDF documents.

    A bundle row has the record's columns with a single attachment, the position
    of the document in its message, its bytes, the JSON and the XML.  A message
    whose documents can't be made has no rows but a failure.
    """
    parsed = mime.parse(files.select("path", "content")).join(files.select("path", "folder", "stem", "name"), "path")
    good = parsed.where("error is null")
    rows = good.select("*", F.posexplode("attachments").alias("position", "a"))
    rows = rows.select(
        F.lit(parsing_folder).alias("parsing_folder"), F.col("folder").alias("email_folder"), F.col("name").alias("email_file_name"), "message_id", X.normalize_subject(F.coalesce("subject", "stem")).alias("subject"),
        dates.message_date("date", obsolete_zones=True).alias("expedition_date"), "author", "targets", "cc", "bcc", F.array(F.col("a.meta")).alias("attachments"), "position", F.col("a.content").alias("content"), "folder", "stem", "body_xml",
    )
    if native is not pdf.none or ocr is not pdf.none:
        rows = pdf.with_text(rows, native, ocr)
    record = F.to_json(F.struct("parsing_folder", "email_folder", "email_file_name", "message_id", "subject", "expedition_date", "author", "targets", "cc", "bcc", "attachments"), {"ignoreNullFields": "true"})
    rows = rows.withColumn("json", record).withColumn("bundle_stem", X.stem_or(F.col("attachments")[0]["original_name"], "attachment"))
    head = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<email-content'), *(_attr(a, F.col(c)) for a, c in (("parsing-folder", "parsing_folder"), ("email-folder", "email_folder"), ("email-file-name", "email_file_name"), ("message-id", "message_id"), ("expedition-date", "expedition_date"), ("subject", "subject"))), F.lit(">\n"))
    xml = F.concat(head, F.lit('  <record format="json"><![CDATA['), X.wrap_cdata("json"), F.lit("]]></record>\n  <mime-structure>\n"), F.when(F.col("body_xml") != "", F.concat("body_xml", F.lit("\n"))).otherwise(""), F.lit("  </mime-structure>\n</email-content>\n"))
    return rows.withColumn("xml", xml).drop("body_xml"), parsed.where("error is not null").select(F.lit("parse").alias("stage"), F.col("path").alias("key"), "error")


def write(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
