"""Idempotent upsert into hash-bucketed, sorted storage.

Every upsert appends one run: its rows are collapsed to one for each identifier
(partial aggregation before the shuffle, so a hot identifier is one row of each
input task), hashed into buckets and sorted.  Runs of one store are bucketed
alike, so compaction aggregates bucket by bucket without another shuffle, and
equal identifiers of different runs collapse to one.  Appending a run twice
changes nothing, also in a later session that opens the store again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettrine.workspace import delete, exists, fresh_path, persisted

#: White space and angle brackets around a message id carry no meaning.
_ID_EDGE = r"^[\s\p{Z}<>]+|[\s\p{Z}<>]+$"


def message_key(col: Column | str) -> Column:
    """The message id without white space and angle brackets around it; null if nothing is left."""
    c = F.regexp_replace(F.col(col) if isinstance(col, str) else col, _ID_EDGE, "")
    return F.when(c != "", c)


class RunStore:
    """Bucketed storage of (id, version): of each identifier the smallest version stays.

    A store lives under its ``path`` and can be opened again there, by a later session
    too: the number of buckets and the schema are kept beside its runs.  Without a path
    it is a new one in the shared folder.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, path: str | None = None):
        self.spark = spark
        self.path = path or fresh_path(spark, "runs")
        self.name = f"lettrine_runs_{uuid.uuid4().hex}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.schema: T.StructType | None = None
        if path and exists(spark, self._meta):
            kept = spark.read.parquet(self._meta).first()
            self.buckets, self.schema = kept["buckets"], T.StructType.fromJson(json.loads(kept["schema"]))
            self._register()

    @property
    def _meta(self) -> str:
        return f"{self.path}/_store"

    @property
    def empty(self) -> bool:
        return self.schema is None

    def _register(self) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY (id) SORTED BY (id) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def upsert(self, rows: DataFrame) -> None:
        """Append a run. ``rows`` has ``id`` and ``version``, an orderable struct; rows with a null id are left out."""
        run = rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("version").alias("version"))
        if self.empty:
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in run.schema])
            self.spark.createDataFrame([(self.buckets, schema.json())], "buckets int, schema string").coalesce(1).write.parquet(self._meta)
            self.schema = schema
            self._register()
        (
            run.repartition(self.buckets, "id").sortWithinPartitions("id").write.mode("append").format("parquet")
            .bucketBy(self.buckets, "id").sortBy("id").saveAsTable(self.name)
        )

    def compacted(self) -> DataFrame:
        """One row for each identifier: its runs merged. The bucketing spares the shuffle."""
        return self.spark.table(self.name).groupBy("id").agg(F.min("version").alias("version"))

    def compact(self, path: str | None = None) -> "RunStore":
        """A store with a single run that replaces this one, whose files are removed."""
        new = RunStore(self.spark, self.buckets, path)
        new.upsert(self.compacted())
        self.remove()
        return new

    def close(self) -> None:
        """Forget the table; the files stay and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def remove(self) -> None:
        self.close()
        delete(self.spark, self.path)


def _versions(deliveries: DataFrame) -> DataFrame:
    """Deliveries as versions: known ones of the index come first, then by time (null last), then by record."""
    late = F.col("delivered_at").isNull().cast("int")
    version = F.struct(F.lit(1).alias("rank"), late.alias("late"), F.col("delivered_at").cast("timestamp").alias("at"), F.col("record_id").cast("long").alias("record_id"))
    return deliveries.select(message_key("message_id").alias("id"), version.alias("version"))


def _known(index: DataFrame) -> DataFrame:
    version = F.struct(F.lit(0).alias("rank"), F.lit(0).alias("late"), F.lit(None).cast("timestamp").alias("at"), F.lit(None).cast("long").alias("record_id"))
    return index.select(F.explode("message_ids").alias("m")).select(message_key("m").alias("id"), version.alias("version"))


def keep_one(deliveries: DataFrame, index: DataFrame) -> DataFrame:
    """The kept version of each message over both tables: ``id`` and ``record_id`` (null if it was in the index).

    Null and blank ids belong to no message.  Ties in time go to the smallest
    record; a null time is later than any other.
    """
    store = RunStore(deliveries.sparkSession)
    store.upsert(_known(index))
    store.upsert(_versions(deliveries))
    kept = persisted(store.compacted().select("id", F.col("version.record_id").alias("record_id")), "kept")
    store.remove()
    return kept


def surplus_copies(deliveries: DataFrame, index: DataFrame) -> DataFrame:
    """The records that are not the kept copy of their message.

    The anti-join runs on the unique record id, not on the message id, so an
    identifier that holds a third of all rows loads no single task.
    """
    kept = keep_one(deliveries, index).where(F.col("record_id").isNotNull()).select("record_id")
    named = deliveries.where(message_key("message_id").isNotNull()).select(F.col("record_id").cast("long").alias("record_id"))
    return named.join(kept, "record_id", "left_anti").distinct()


def deduplicated(deliveries: DataFrame, index: DataFrame) -> DataFrame:
    """All deliveries but the surplus copies, every column as it was."""
    return deliveries.join(surplus_copies(deliveries, index), "record_id", "left_anti")
