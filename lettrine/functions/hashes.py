"""Hashes of contents and inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 4 * 1024 * 1024
#: Fixed value: the version that prefixes the hashed input.
INPUT_VERSION = "2"


def content_md5(content: Column | str) -> Column:
    """Lower-case hexadecimal MD5; '' where the content can't be read."""
    return F.coalesce(F.md5(content), F.lit(""))


def input_hash(*parts: Column) -> Column:
    """SHA-256 over the version and the parts one after the other; missing parts add nothing."""
    return F.sha2(F.concat(F.lit(INPUT_VERSION), *(F.coalesce(p, F.lit("")) for p in parts)), 256)


def block_hash(content: str, block: int = BLOCK) -> Column:
    """SHA-256 of the SHA-256 digests of the blocks of a binary column."""
    digests = f"transform(sequence(0, CAST((length({content}) - 1) DIV {block} AS INT)), i -> unhex(sha2(substring({content}, i * {block} + 1, {block}), 256)))"
    return F.expr(f"sha2(CASE WHEN length({content}) = 0 THEN CAST('' AS BINARY) ELSE aggregate({digests}, CAST('' AS BINARY), (a, x) -> concat(a, x)) END, 256)")
