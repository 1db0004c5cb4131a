"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.session import scratch_path

# A word is a maximal run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet into the shared checkpoint folder and read it back: cuts
    lineage with files every executor sees."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_by_value(module: str) -> None:
    """Let Python workers get a module's functions inside the task itself, so that
    executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc32_remainder(key: Column, modulus: int) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % F.lit(modulus)


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a DuckDB text expression; its table follows from
    the reversed polynomial."""
    entries = []
    for value in range(16):
        for _ in range(4):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        entries.append(value)
    steps = ("xor(s >> 4, [" + ", ".join(map(str, entries)) + "][(xor(s, d) & 15) + 1])")
    nibbles = (f"list_transform(range(2 * octet_length(encode({text}))), lambda i: ('0x' || "
               f"substr(hex(encode({text})), (i + 1 - 2 * (i % 2) + 1)::INT, 1))::BIGINT)")
    return f"xor(list_reduce({nibbles}, lambda s, d: {steps}, 4294967295::BIGINT), 4294967295)"
