"""Incremental parsing as a micro-batch stream: what is known is skipped, re-runs add nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from lettrine.plans import parse
from lettrine.sources import mailbox


def known(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path).select("folder", "stem")
    except AnalysisException:
        return spark.createDataFrame([], "folder string, stem string")


def start(spark: SparkSession, mail_root: str, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Parse new files below ``mail_root`` into ``out``/bundles and ``out``/failures.

    A file is new when its name was in no earlier batch, whatever its date.
    """
    mailbox.register(spark)

    def batch(df: DataFrame, _: int) -> None:
        files = mailbox.contents(parse.pending(df, known(spark, f"{out}/bundles")))
        rows, failed = parse.bundles(files, mail_root)
        rows.write.mode("append").parquet(f"{out}/bundles")
        failed.write.mode("append").parquet(f"{out}/failures")

    w = spark.readStream.format("mailbox").option("path", mail_root).option("content", "false").option("log", f"{checkpoint}/names").load().writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")).start()
