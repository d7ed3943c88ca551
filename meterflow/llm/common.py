"""Helpers the operators share: readers, Arrow blocks, salted joins."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20
# White space of the word patterns: \x20 and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package where it was not installed.

    Elsewhere it is installed or sent along (``--py-files``), as usual.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blocks(batches: Iterator[pa.RecordBatch], column: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes of ``column``; a longer text is a slice of its own."""
    for batch in batches:
        start, held = 0, 0
        lengths = np.asarray(
            pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
        )
        for row, length in enumerate(lengths.tolist()):
            if row > start and held + length > size:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        if batch.num_rows > start:
            yield batch.slice(start)


def as_bytes(array: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [value or b"" for value in array.cast(pa.binary()).to_pylist()]


def is_small(df: DataFrame) -> bool:
    """Whether the planner's size of ``df`` is within its own bound for broadcasts; sizes of written tables are file sizes."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Column, salts: int = 16) -> DataFrame:
    """Left join to a smaller table of unique keys, each key's rows dealt over ``salts`` tasks.

    ``spread`` is an integer expression of the left rows; right rows are copied per salt. A right side
    whose size allows a broadcast is broadcast as it is, once and without copies.
    """
    if is_small(right):
        return left.join(F.broadcast(right), list(keys), "left")
    salted = left.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], "left").drop("_salt")
