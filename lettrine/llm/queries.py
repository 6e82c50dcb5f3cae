"""Queries of the text operators, by name, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lettrine.llm import garble, leak, mixing, people, private, replies, scans, spans
from lettrine.llm.base import table

Query = Callable[[SparkSession, str], DataFrame]


def _private(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, private.Names]:
    emails = table(spark, sf_dir, "parsed_emails")
    texts = private.texts_of(emails, table(spark, sf_dir, "dropbox_uploads"))
    return texts, private.learn_contexts(texts, private.learn_given(emails))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.found(*_private(spark, sf_dir))


def p2_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.without_private(*_private(spark, sf_dir))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.foreign_lines(table(spark, sf_dir, "parsed_emails"))


def p4_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.own_texts(table(spark, sf_dir, "parsed_emails"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.line_kinds(table(spark, sf_dir, "parsed_emails"))


def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.repaired_texts(table(spark, sf_dir, "parsed_emails"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garble.judge(table(spark, sf_dir, "parsed_emails")).select("record_id", "field_path").distinct()


def p6_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garble.judge(table(spark, sf_dir, "parsed_emails")).select("record_id", "field_path", "value", "restored", "chain").distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.linked_pairs(table(spark, sf_dir, "header_contacts"))


def p7_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.link(table(spark, sf_dir, "header_contacts"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.without_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.SharedSpans(table(spark, sf_dir, "documents")).document_pairs()


def p10_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.SharedSpans(table(spark, sf_dir, "documents")).maximal()


def p10_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text that stands for each document in the spans: whole copies have the same."""
    return spans.classes(table(spark, sf_dir, "documents"))


def p10_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return spans.SharedSpans(documents).shared_chars(documents)


def queries() -> dict[str, Query]:
    named = (p2_found, p2_redacted, p4_found, p4_own, p5_found, p5_repaired, p6_found, p6_restored, p7_found, p7_entities, p8_found, p8_leaks, p8_clean, p9_mix, p9_shares, p10_found, p10_spans, p10_members, p10_shared)
    return {f.__name__: f for f in named}


def _grams(name: str, key: str) -> str:
    """SQL: the runs of 12 words of the texts of a table."""
    return f"SELECT DISTINCT {key}, md5(array_to_string(w[k : k + 11], ' ')) AS g FROM (SELECT {key}, w, unnest(range(1, len(w) - 10)) AS k FROM (SELECT {key}, regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}]+') AS w FROM {name}))"


_LEAKS = f"SELECT DISTINCT doc_id, item_id FROM ({_grams('documents', 'doc_id')}) JOIN ({_grams('eval_items', 'item_id')}) USING (g)"
_WINDOWS = "w AS (SELECT DISTINCT doc_id, md5(substring(text, k, 400)) AS g FROM (SELECT doc_id, text, unnest(range(1, length(text) - 398)) AS k FROM documents WHERE length(text) >= 400))"
_SHARED = f"WITH {_WINDOWS} SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM w a JOIN w b ON a.g = b.g AND a.doc_id < b.doc_id"
_SHARED_CHARS = """
WITH p AS (SELECT doc_id, text, unnest(range(1, length(text) - 398)) AS k FROM documents WHERE length(text) >= 400),
w AS (SELECT doc_id, k, md5(substring(text, k, 400)) AS g FROM p),
shared AS (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM w JOIN (SELECT g FROM w GROUP BY g HAVING count(DISTINCT doc_id) > 1) USING (g)),
sums AS (SELECT doc_id, sum(CASE WHEN before IS NULL THEN 400 ELSE least(400, k - before) END)::BIGINT AS n FROM shared GROUP BY doc_id)
SELECT doc_id, n_chars, shared_chars, CASE WHEN n_chars > 0 THEN shared_chars / n_chars ELSE 0.0 END AS shared_share FROM (
  SELECT doc_id, coalesce(length(text), 0) AS n_chars, coalesce(n, 0) AS shared_chars FROM documents LEFT JOIN sums USING (doc_id))
"""
_MEMBERS = "SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS rep FROM documents WHERE length(text) >= 400"


def oracle_sql() -> dict[str, str]:
    return {"p8_found": _LEAKS, "p10_found": _SHARED, "p10_shared": _SHARED_CHARS, "p10_members": _MEMBERS}
