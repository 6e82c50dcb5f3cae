"""Helpers that the text operators share."""

from __future__ import annotations

import re
import unicodedata
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_MARKS = re.compile("[̀-ͯ҃-҉᪰-᫿᷀-᷿⃐-⃿︠-︯]+")
WORD = re.compile(r"[^\W_]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares; a folder of our own where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        import tempfile

        app = spark.sparkContext.applicationId
        folder = _own.setdefault(app, "") or "file://" + tempfile.mkdtemp(prefix="lettrine-llm-")
        _own[app] = folder
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def persisted(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folded(text: str) -> str:
    """Lower case without accents."""
    text = text.casefold()
    return text if text.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", text))


def words(text: str) -> list[str]:
    """Runs of letters and digits of the folded text."""
    return WORD.findall(folded(text))
