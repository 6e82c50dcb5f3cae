"""Schemas of the pipeline's tables. Names and order are fixed values of the stored formats."""

from __future__ import annotations

from pyspark.sql import types as T

CONTACT = "struct<raw:string,name:string,address:string>"
ATTACHMENT = "struct<original_name:string,is_email_body:boolean,mime_type:string,size:bigint,md5:string,extracted_text:string,extracted_text_method:string,extracted_text_truncated:boolean>"
EMAIL = (
    "parsing_folder string, email_folder string, email_file_name string, message_id string, subject string, expedition_date string, "
    f"author {CONTACT}, targets array<{CONTACT}>, cc array<{CONTACT}>, bcc array<{CONTACT}>, attachments array<{ATTACHMENT}>"
)
SUMMARY_ITEM = "struct<file_name:string,mime_type:string,summary:string,importance:string,proposed_file_name:string,main_folder:string,sub_folder:string>"
CLASSIFICATION = f"email_summary string, email_importance string, main_folder string, sub_folder string, attachment_summaries array<{SUMMARY_ITEM}>"

#: The columns of the archive in stored order.
ARCHIVE_COLUMNS = (
    "layout_version", "uploaded_at", "md5", "source_file_name", "final_file_name", "dropbox_root_folder", "dropbox_path", "dropbox_content_hash",
    "xml_file_name", "xml_dropbox_path", "main_folder", "sub_folder", "year_folder", "account_name", "email_dossier_path", "email_stem",
    "attachment_local_path", "parse_json_path", "parse_json_content", "parse_xml_path", "parse_xml_content", "ai_json_path", "ai_json_content",
    "message_id", "email_subject", "expedition_date", "email_summary", "email_importance", "attachment_summary", "attachment_importance", "attachment_mime_type",
)
ARCHIVE = T.StructType([T.StructField(c, T.StringType()) for c in ARCHIVE_COLUMNS])
LAYOUT_VERSION = "5"
IMPORTANCE = ("HAUTE", "BASSE")
