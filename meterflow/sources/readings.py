"""Reading meter exports, and keeping only their newest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import epoch_hour, na_to_null, reading_timestamp
from ..schema import DATE, RAW_COLUMNS, TIME
from ..session import staging_root

DEFAULT_PATH = "data/household_power_consumption.csv"


def read_readings(
    spark: SparkSession, path: str | None = None, series_cols: Sequence[str] = ()
) -> DataFrame:
    """A ``;``-separated export with a header, every column as text.

    Missing-value tokens become NULL here; parsing comes later, so a bad value
    never fails a read. Columns are found by name; ``series_cols`` tell meters apart.
    """
    try:
        raw = spark.read.option("sep", ";").option("header", True).csv(path or DEFAULT_PATH)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no readings at {path or DEFAULT_PATH}") from error
        raise
    return raw.select(
        *series_cols, *[na_to_null(F.col(name)).alias(name) for name in RAW_COLUMNS]
    )


def recent_readings(raw: DataFrame, max_rows: int | None) -> DataFrame:
    """The newest ``max_rows`` raw readings; None, zero or less keeps all."""
    return recent_rows(raw, max_rows, reading_timestamp(F.col(DATE), F.col(TIME)), raw.columns)


def recent_rows(
    table: DataFrame, max_rows: int | None, moment: Column, tiebreak: Sequence[str]
) -> DataFrame:
    """The newest ``max_rows`` rows by ``moment``; NULL moments count as oldest.

    Sorting everything to keep a little would shuffle the whole table. Counts
    per hour instead show the one hour the limit falls into: newer hours stay
    whole by a plain filter and only that hour's rows are ranked.
    """
    if max_rows is None or max_rows <= 0:
        return table
    hour = F.coalesce(epoch_hour(moment), F.lit(-(2**62)))
    sizes = table.groupBy(hour.alias("_hour")).agg(F.count(F.lit(1)).alias("_rows"))
    newest_first = W.orderBy(F.desc("_hour")).rowsBetween(W.unboundedPreceding, W.currentRow)
    running = F.sum("_rows").over(newest_first)
    edge = (
        sizes.withColumn("_until", running)
        .filter(F.col("_until") >= max_rows)
        .orderBy(F.desc("_hour"))
        .first()
    )
    if edge is None:
        return table
    newer = table.filter(hour > edge["_hour"])
    wanted = max_rows - (edge["_until"] - edge["_rows"])
    at_edge = table.filter(hour == edge["_hour"])
    if wanted == edge["_rows"]:
        return newer.unionByName(at_edge)
    return newer.unionByName(_newest(at_edge, wanted, moment, tiebreak))


def _newest(table: DataFrame, rows: int, moment: Column, tiebreak: Sequence[str]) -> DataFrame:
    """The first ``rows`` rows in descending time, ranked without a single task.

    Range partitions are sorted on their own; a row's rank is its place in its
    partition plus the size of the partitions before it. The checkpoint fixes
    the partitions between counting and ranking. One size per partition is all
    that is broadcast. The row number as last key spreads copies of one row.
    """
    spark = table.sparkSession
    staging_root(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("_moment"), *tiebreak, "_copy"]
    placed = (
        table.withColumn("_moment", moment)
        .withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit(2**33 - 1)))
        .checkpoint()
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    ranked = placed.join(F.broadcast(offsets), "_part")
    return ranked.filter(F.col("_before") + F.col("_place") < rows).select(*table.columns)
