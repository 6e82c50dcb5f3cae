"""Text of PDF documents through injected extractors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrine.functions import text as X

#: Fixed value: characters kept of a document.
TEXT_CHARS = 80_000
Extractor = Callable[[bytes], str | None]


def none(_: bytes) -> str | None:
    """The default: no extractor is part of this engine."""
    return None


#: Fixed value: pages of a document that are recognised.
OCR_PAGES = 20


def by_pages(render: Callable[[bytes, int], dict[str, bytes]], recognise: Callable[[bytes], str | None]) -> Extractor:
    """An OCR of page images: ``render(document, pages)`` names the images of the first pages, ``recognise`` reads one.

    Pages are joined in the order of their names; a page that can't be read or holds nothing is left out.
    """

    def extract(data: bytes) -> str | None:
        found = []
        for _, image in sorted(render(data, OCR_PAGES).items())[:OCR_PAGES]:
            try:
                text = recognise(image)
            except Exception:  # noqa: BLE001 - the other pages still count
                continue
            text = (text or "").replace("\r\n", "\n").replace("\r", "\n").strip()
            if text:
                found.append(text)
        return "\n\n".join(found) or None

    return extract


def with_text(rows: DataFrame, native: Extractor = none, ocr: Extractor = none) -> DataFrame:
    """Rows of documents with text, method and truncation set in their attachment.

    Only PDF names with bytes are read.  The native text counts if it is not blank,
    else that of the OCR; an extractor that fails gives no text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, methods = [], []
            for data in batch.column("content").to_pylist():
                got = (None, None)
                for extractor, method in ((native, "pdf_text"), (ocr, "pdf_ocr")):
                    try:
                        t = extractor(data)
                    except Exception:  # noqa: BLE001 - a broken document has no text
                        t = None
                    if t and t.strip():
                        got = (t, method)
                        break
                texts.append(got[0])
                methods.append(got[1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.string()), pa.array(methods, pa.string())], names=["folder", "stem", "position", "text", "method"])

    name = F.col("attachments")[0]["original_name"]
    asked = rows.where((X.extension(name) == "pdf") & F.col("content").isNotNull()).select("folder", "stem", "position", "content")
    found = asked.mapInArrow(run, "folder string, stem string, position int, text string, method string").where("text is not null")
    e = X.finalize_extraction("text", TEXT_CHARS)
    told = found.select("folder", "stem", "position", e.alias("e"), "method")

    def filled(a):
        full = a.withField("extracted_text", F.col("e.text")).withField("extracted_text_method", F.col("method")).withField("extracted_text_truncated", F.when(F.col("e.truncated"), F.lit(True)))
        return F.when(F.col("e").isNotNull(), full).otherwise(a)

    return rows.join(told, ["folder", "stem", "position"], "left").withColumn("attachments", F.transform("attachments", filled)).drop("e", "method")
