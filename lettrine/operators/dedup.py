"""First-wins deduplication, anti-joins against state, and running values, without windows over hot keys.

Defined results: a null key is a key of its own; ties in the order are broken by all
columns of the order, so callers end it with a unique one; empty inputs give empty
outputs; columns other than those named pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrine.operators import ordering


def first_wins(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. Partial aggregation leaves one row of a hot key for each task.

    Whole rows pass through the aggregate: choose keys on narrow rows and join what is wide back.
    """
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*(F.col(c) for c in rest)), F.struct(*order)).alias("_row"))
    return best.select(*(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns))


def ranked(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows with their rank within the key, for sinks that try the next one when a write fails."""
    return ordering.numbered(df, [key], order, "rank")


def not_in(df: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys the state does not hold; of the state only the keys are read."""
    return df.join(state.select(*keys).distinct(), keys, "left_anti")


def new_or_recoverable(messages: DataFrame, index: DataFrame, on_disk: DataFrame, recover: bool, key: str = "id") -> DataFrame:
    """Messages to be saved: unknown ones and, with ``recover``, known ones that are missing on disk.

    A message is saved once, from its first place, unless it is recovered: then
    every copy is saved.
    """
    known = index.select(key).distinct().withColumn("known", F.lit(True))
    held = on_disk.select(key).distinct().withColumn("held", F.lit(True))
    j = messages.join(known, key, "left").join(held, key, "left")
    lost = F.col("known").isNotNull() & F.col("held").isNull()
    fresh = F.col("known").isNull()
    kept = j.where(fresh | (lost if recover else F.lit(False)))
    return kept.withColumn("recovered", ~fresh & lost).drop("known", "held")


def sticky_name(df: DataFrame, key: str, name: str, order: str, out: str = "sticky_name") -> DataFrame:
    """For each row the first non-blank name seen so far under its key, else ''.

    One aggregate of the earliest name and an equi-join replace a running window.
    """
    blank = F.trim(F.coalesce(F.col(name), F.lit(""))) == ""
    first = df.where(~blank).groupBy(key).agg(F.min_by(name, order).alias("_name"), F.min(order).alias("_since"))
    j = df.join(first, key, "left")
    return j.withColumn(out, F.when(F.col("_since") <= F.col(order), F.col("_name")).otherwise(F.lit(""))).drop("_name", "_since")


def number_collisions(df: DataFrame, folder: str, name: str, order: list[str], out: str = "unique_name") -> DataFrame:
    """``a.pdf``, ``a_1.pdf``, ``a_2.pdf``: equal names of a folder get numbers before the extension.

    ``order`` names columns that are unique in the table.  Numbers already taken by
    given names are skipped: a second pass numbers what still collides.  Only the
    named columns are sorted; the others are joined back.
    """

    def with_number(shown: str, n: str) -> Column:
        stem = F.regexp_replace(F.col(shown), r"(?s)(?<=.)\.[^.]*\z", "")
        suffix = F.regexp_extract(F.col(shown), r"(?s).(\.[^.]*)\z", 1)
        return F.when(F.col(n) == 1, F.col(shown)).otherwise(F.concat(stem, F.lit("_"), (F.col(n) - 1).cast("string"), suffix))

    narrow = df.select(folder, name, *order)
    once = ordering.numbered(narrow, [folder, name], order, "_n").withColumn(out, with_number(name, "_n"))
    twice = ordering.numbered(once.select(folder, out, "_n", *order), [folder, out], ["_n", *order], "_m").withColumn(out, with_number(out, "_m"))
    return df.join(twice.select(*order, out), order)
