"""Mixing sources to target shares of the total size in tokens.

Tokens are counted on the executors with a public tokenizer and summed for each
source.  A rate follows for each source; a document is used floor(rate) times and
once more with probability equal to the fraction, drawn from a seeded hash of its
id, so that the choice is the same in every run and on every cluster.

Defined results: documents without a source, or of a source without a target, are
not used; sources without documents have an actual share of 0 and the others keep
their proportions; null and empty texts have no tokens and follow the rate of
their source; ``max_repeat`` null or below 0 counts as 0.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrine.llm.base import persisted

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the splitting pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_encoders: dict[str, object] = {}


def _encoder(path: str):
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("mixing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def with_tokens(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if (t := x.as_py()) else 0 for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["doc_id", "source", "n_tokens"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text").mapInArrow(run, "doc_id long, source string, n_tokens long")


def rates(counted: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """The repetition rate of each source.

    Without ``total_tokens`` the total is the largest at which every source that
    has documents can hold its share without passing its cap, so the shares are
    met.  With it, a source that would pass its cap is used up to the cap, and the
    column ``short_tokens`` says how much it lacks.
    """
    have = counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"))
    t = targets.select("source", F.col("target_share").cast("double").alias("target_share"), F.greatest(F.coalesce(F.col("max_repeat").cast("int"), F.lit(0)), F.lit(0)).alias("max_repeat"))
    joined = t.join(have, "source", "left").na.fill(0, ["tokens", "documents"])
    usable = (F.col("tokens") > 0) & (F.col("max_repeat") > 0) & (F.col("target_share") > 0)
    sums = joined.where(usable).agg(F.sum("target_share").alias("present"), F.min(F.col("max_repeat") * F.col("tokens") / F.col("target_share")).alias("reach")).first()  # two numbers
    present, reach = sums["present"] or 1.0, sums["reach"] or 0.0
    total = reach * present if total_tokens is None else float(total_tokens)
    out = joined.withColumn("share", F.when(usable, F.col("target_share") / present).otherwise(0.0))
    wanted = F.when(usable, F.col("share") * total / F.col("tokens")).otherwise(0.0)
    rate = F.least(wanted, F.col("max_repeat").cast("double"))
    return out.withColumn("rate", rate).withColumn("short_tokens", F.when(usable, (wanted - rate) * F.col("tokens")).otherwise(0.0)).select("source", "target_share", "max_repeat", "tokens", "documents", "rate", "short_tokens")


def mixed(documents: DataFrame, targets: DataFrame, seed: int = 42, total_tokens: float | None = None, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """The chosen documents (doc_id, source, n_tokens, uses) and the shares of the sources."""
    counted = persisted(with_tokens(documents, tokenizer), "tokens")
    plan = rates(counted, targets, total_tokens)
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 53)).cast("double") / float(1 << 53)
    fraction = F.col("rate") - F.floor("rate")
    uses = (F.floor("rate") + (draw < fraction).cast("long")).cast("long")
    used = counted.join(plan.select("source", "rate"), "source").withColumn("uses", uses)
    chosen = used.where(F.col("uses") > 0).select("doc_id", "source", "n_tokens", "uses")
    sums = used.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("used_tokens"), F.sum((F.col("uses") > 0).cast("long")).alias("used_documents"), F.max("uses").alias("most_uses"))
    shares = plan.join(sums, "source", "left").na.fill(0, ["used_tokens", "used_documents", "most_uses"])
    all_tokens = sums.agg(F.sum("used_tokens")).first()[0] or 0  # one number
    actual = F.col("used_tokens") / float(all_tokens) if all_tokens else F.lit(0.0)
    return chosen, shares.select("source", "target_share", actual.alias("actual_share"), "rate", "max_repeat", "most_uses", "tokens", "used_tokens", "documents", "used_documents", "short_tokens")
