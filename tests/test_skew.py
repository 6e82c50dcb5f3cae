"""One key holds a third of all rows: results stay whole and no plan gathers the key in a window or a collected list."""

from pyspark.sql import functions as F

from lettrine.operators import dedup, ordering, upsert

N = 30_000


def _hot(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") / 2).cast("long").cast("string")))
    return spark.range(N).withColumn("key", key)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_surplus_of_a_hot_message(spark):
    d = _hot(spark).select(F.col("id").alias("record_id"), F.col("key").alias("message_id"), F.timestamp_seconds(F.col("id")).alias("delivered_at"))
    index = spark.createDataFrame([(["none"],)], "message_ids array<string>")
    got = upsert.surplus_copies(d, index)
    assert got.count() == N - d.select("message_id").distinct().count() and got.where("record_id = 0").count() == 0
    assert not any(x in _plan(got) for x in ("Window", "collect_list", "collect_set"))


def test_first_wins_of_a_hot_key(spark):
    df = dedup.first_wins(_hot(spark), "key", [F.col("id")])
    assert df.where("key = 'hot'").first()["id"] == 0 and df.count() == _hot(spark).select("key").distinct().count()
    assert "Window" not in _plan(df)


def test_sticky_name_of_a_hot_key(spark):
    df = _hot(spark).withColumn("name", F.when(F.col("id") >= 9, F.concat(F.lit("n"), F.col("id").cast("string"))))
    got = dedup.sticky_name(df, "key", "name", "id")
    assert "Window" not in _plan(got)
    assert {r["sticky_name"] for r in got.where("key = 'hot' and id >= 9").collect()} == {"n9"} and got.where("key = 'hot' and id < 9 and sticky_name <> ''").count() == 0


def test_numbers_of_a_hot_key(spark):
    got = ordering.numbered(_hot(spark), ["key"], ["id"])
    assert got.count() == N and [r["number"] for r in got.where("key = 'hot'").orderBy("id").collect()] == list(range(1, N // 3 + 1))
