"""The Parquet archive: tolerant reading, idempotent appending, SQL view.

Defined results: a missing archive is empty; missing columns and nulls read as '';
columns of other types read as text; unknown columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lettrine.operators import dedup
from lettrine.schemas import ARCHIVE, ARCHIVE_COLUMNS

VIEW = "dropbox_uploads"


def conform(df: DataFrame) -> DataFrame:
    """Any archive table in the stored columns and order."""
    return df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in ARCHIVE_COLUMNS))


def load(spark: SparkSession, path: str) -> DataFrame:
    try:
        return conform(spark.read.option("mergeSchema", "true").parquet(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], ARCHIVE)
        raise


def register(spark: SparkSession, path: str, view: str = VIEW) -> DataFrame:
    """The archive as a view for SQL."""
    df = load(spark, path)
    df.createOrReplaceTempView(view)
    return df


def append(spark: SparkSession, path: str, rows: DataFrame, dry_run: bool = False) -> int:
    """Append the rows whose md5 the archive lacks, one for each md5; returns how many.

    Files are only added, so readers never see a half-written archive and a crash
    loses no row written before.
    """
    new = dedup.first_wins(dedup.not_in(conform(rows), load(spark, path), ["md5"]), "md5", [F.col(c) for c in ("email_dossier_path", "email_stem", "source_file_name")])
    new = new.select(*ARCHIVE_COLUMNS).cache()
    n = new.count()
    if n and not dry_run:
        new.write.mode("append").parquet(path)
    new.unpersist()
    return n
