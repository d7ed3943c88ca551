"""Row positions and overlapping chunks: windows over long series in parallel.

Lags and rolling statistics count rows, not hours, so a row needs its position
in its series before a series can be cut. A plain window per series would put a
whole series, and without a series key the whole table, into one task.

Positions come from counts: an hour occurs once per series, so a bucket of
``BUCKET_HOURS`` hours never holds more rows than that. Numbering rows within a
bucket and adding the rows of earlier buckets gives the position. Only the
table of bucket sizes, one row per series and half year, is ordered per series.

Chunks of ``CHUNK_ROWS`` positions then get copies of the rows their first and
last windows reach over to, and each chunk is windowed on its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import epoch_hour
from ..schema import DATETIME

BUCKET_HOURS = 4096
CHUNK_ROWS = 1344

POSITION = "_position"
LENGTH = "_length"
CHUNK = "_chunk"
_BUCKET = "_bucket"


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys and keeps the left side's keys."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, same), how)
    return joined.drop(*[f"_right_{key}" for key in keys])


def with_position(hourly: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Add each row's 0-based position in its series and the series' length."""
    keys = [*series_cols, _BUCKET]
    rows = hourly.withColumn(_BUCKET, F.floor(epoch_hour(F.col(DATETIME)) / BUCKET_HOURS))
    # Both branches read the same hourly columns, so the shuffle below an
    # unmaterialised hourly table runs once and is reused.
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    earlier = W.partitionBy(*series_cols).orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys,
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_size").over(W.partitionBy(*series_cols)).alias(LENGTH),
    )
    in_bucket = F.row_number().over(W.partitionBy(*keys).orderBy(DATETIME))
    return (
        join_on(rows, offsets, keys)
        .withColumn(POSITION, F.col("_offset") + in_bucket - 1)
        .drop(_BUCKET, "_offset")
    )


def over_chunks(
    hourly: DataFrame,
    columns: Callable[[str], dict[str, str]],
    series_cols: Sequence[str] = (),
    back: int = 0,
    ahead: int = 0,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``back`` rows back and ``ahead`` on.

    ``columns`` gets the window (one chunk, in time order) as SQL text and
    returns named SQL expressions; they may use :data:`POSITION` and :data:`CHUNK`.
    Text costs one call for all columns, where a hundred column objects take
    longer to build than a small table takes to run.
    """
    position = F.col(POSITION)
    home = F.floor(position / chunk_rows)
    first = F.greatest(F.floor((position - ahead) / chunk_rows), F.lit(0))
    last = F.least(
        F.floor((position + back) / chunk_rows), F.floor((F.col(LENGTH) - 1) / chunk_rows)
    )
    copies = with_position(hourly, series_cols).withColumn(
        CHUNK, F.explode(F.sequence(first, last))
    )
    keys = ", ".join(f"`{name}`" for name in (*series_cols, CHUNK))
    found = columns(f"PARTITION BY {keys} ORDER BY {POSITION}")
    wide = copies.selectExpr("*", *[f"{sql} AS {name}" for name, sql in found.items()])
    return wide.filter(F.col(CHUNK) == home).drop(CHUNK)
