from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterflow import build_daily_peak_frame, build_model_frame
from meterflow.operators import features
from meterflow.operators.chunks import LENGTH, POSITION, over_chunks, with_position
from meterflow.schema import (
    COMPACT_FEATURES,
    CURRENT,
    DATETIME,
    FEATURES,
    POWER,
    TARGET,
    VOLTAGE,
)

from .fixtures import hourly_rows


def column(frame, name):
    return [row[0] for row in frame.orderBy(DATETIME).select(name).collect()]


def test_target_shrinks_at_the_end(spark):
    found = features.forward_target(hourly_rows(spark, list(range(1, 9))))
    assert column(found, TARGET) == [4.5, 5.5, 6, 6.5, 7, 7.5, 8, None]


def test_horizon_must_be_positive(spark):
    with pytest.raises(ValueError):
        build_model_frame(hourly_rows(spark, [1, 2]), forecast_horizon=0)


def test_lags_count_rows_not_hours(spark):
    hours = [*range(10), *range(13, 21)]
    found = features.lag_features(hourly_rows(spark, list(range(18)), hours))
    assert column(found, "power_lag_1") == [None, *range(17)]
    assert column(found, "power_lag_12") == [None] * 12 + list(range(6))


def test_percent_change_after_zero(spark):
    found = features.pct_change_features(hourly_rows(spark, [0, 0, 1, 0]))
    assert column(found, "power_pct_change_1") == [None, None, None, -1.0]


def test_infinite_values_leave_the_frame(spark):
    powers = [2.0 + i % 7 for i in range(120)]
    powers[60] = float("inf")
    found = build_model_frame(hourly_rows(spark, powers)).orderBy(DATETIME)
    left = {(row[0].day - 1) * 24 + row[0].hour for row in found.select(DATETIME).collect()}
    # Targets and windows that touch hour 60, and its lags of 24 and 48 hours.
    expected = set(range(48, 119)) - set(range(54, 84)) - {84, 108}
    assert left == expected
    plain = pd.Series([p if p != float("inf") else float("nan") for p in powers])
    wanted = plain.ewm(span=24).mean()
    assert column(found, "power_ewm_24") == pytest.approx([wanted[i] for i in sorted(left)])


@pytest.mark.parametrize("spoiled", [POWER, VOLTAGE, CURRENT])
def test_few_checks_decide_what_all_checks_would(spark, spoiled):
    odd = {70: "Infinity", 71: "-Infinity", 150: "Infinity", 230: "0", 231: "0"}
    cases = " ".join(f"WHEN n = {n} THEN double('{text}')" for n, text in odd.items())
    table = hourly_rows(spark, [2.0 + i % 7 for i in range(320)])
    table = table.withColumn("n", F.hour(DATETIME) + 24 * (F.dayofyear(DATETIME) - 1))
    table = table.withColumn(spoiled, F.expr(f"CASE {cases} ELSE {spoiled} END")).drop("n")
    every = features.feature_frame(table, (), 6, False, 100)
    doubles = [name for name, kind in every.dtypes if kind == "double"]
    full = every.filter(" AND ".join(f"abs({name}) < double('Infinity')" for name in doubles))
    few = build_model_frame(table, chunk_rows=100)
    assert column(few, DATETIME) == column(full, DATETIME)
    assert 0 < few.count() < 271


def test_compact_frame_keeps_infinite_lags_but_no_infinite_windows(spark):
    powers = [2.0 + i % 7 for i in range(140)]
    powers[60] = float("inf")
    found = build_model_frame(hourly_rows(spark, powers), compact=True)
    left = {(t.day - 1) * 24 + t.hour for t in column(found, DATETIME)}
    assert left == set(range(48, 139)) - set(range(60, 84))


def pandas_features(powers: list[float]) -> pd.DataFrame:
    p = pd.Series([float(x) for x in powers])
    ahead = pd.concat([p.shift(-k) for k in range(1, 7)], axis=1).mean(axis=1)
    return pd.DataFrame(
        {
            TARGET: ahead,
            "power_lag_48": p.shift(48),
            "power_roll_mean_24": p.rolling(24).mean(),
            "power_roll_std_24": p.rolling(24).std(),
            "power_roll_min_12": p.rolling(12).min(),
            "power_diff_24": p.diff(24),
            "power_ewm_6": p.ewm(span=6).mean(),
            "power_ewm_24": p.ewm(span=24).mean(),
        }
    )


@pytest.mark.parametrize(("seed", "chunk_rows", "gap"), [(1, 64, 0.0), (2, 97, 0.3), (3, 1344, 0.97)])
def test_chunks_do_not_change_results(spark, seed, chunk_rows, gap):
    chance = random.Random(seed)
    hours, hour = [], 0
    while len(hours) < 700:
        if chance.random() >= gap:
            hours.append(hour)
        hour += 1
    powers = [chance.uniform(0.5, 6.0) for _ in hours]
    found = build_model_frame(hourly_rows(spark, powers, hours), chunk_rows=chunk_rows)
    assert found.columns == [DATETIME, *FEATURES, TARGET]
    mine = found.orderBy(DATETIME).toPandas()
    wanted = pandas_features(powers).iloc[48:699].reset_index(drop=True)
    assert len(mine) == 651
    for name in wanted:
        assert mine[name].to_numpy() == pytest.approx(wanted[name].to_numpy(), abs=1e-9), name


def test_positions_restart_per_series_and_survive_null_keys(spark):
    table = hourly_rows(spark, list(range(9)), [0, 1, 2, 5000, 5001, 9000, 9001, 9002, 20000])
    meters = table.withColumn("meter", F.when(F.hour(DATETIME) % 2 == 0, F.lit("a")))
    found = with_position(meters, ["meter"]).orderBy("meter", DATETIME).collect()
    by_meter = {}
    for row in found:
        by_meter.setdefault(row.meter, []).append((row[POSITION], row[LENGTH]))
    assert sum(map(len, by_meter.values())) == 9
    for rows in by_meter.values():
        assert rows == [(i, len(rows)) for i in range(len(rows))]


def test_series_do_not_mix(spark):
    a = hourly_rows(spark, [float(i % 5 + 1) for i in range(80)]).withColumn("meter", F.lit("a"))
    b = hourly_rows(spark, [float(i % 3 + 9) for i in range(90)]).withColumn("meter", F.lit("b"))
    both = build_model_frame(a.unionByName(b), series_cols=["meter"]).drop("meter")
    alone = build_model_frame(a.drop("meter")).unionByName(build_model_frame(b.drop("meter")))
    assert both.count() == alone.count() == 31 + 41
    assert both.exceptAll(alone).count() == 0


def test_no_row_reaches_a_single_partition(spark):
    table = hourly_rows(spark, [1.0, 2.0, 3.0])
    found = over_chunks(table, features.lag_columns, back=48)
    plan = found._jdf.queryExecution().executedPlan().toString()
    singles = [i for i, line in enumerate(plan.splitlines()) if "SinglePartition" in line]
    below = "\n".join(plan.splitlines()[singles[0] :]) if singles else ""
    # Only the table of bucket sizes is ordered as a whole.
    assert len(singles) == 1 and "count(1)" in below and POWER not in below.split("HashAggregate")[0]


def test_compact_frame(spark):
    found = build_model_frame(hourly_rows(spark, [float(i % 7) for i in range(100)]), compact=True)
    assert found.columns == [DATETIME, *COMPACT_FEATURES, TARGET]
    assert len(COMPACT_FEATURES) == 43 and len(FEATURES) == 63
    assert found.count() == 51


def test_peak_hour_tie_goes_to_the_earlier_hour(spark):
    powers = [1.0] * 48
    powers[24 + 3] = powers[24 + 5] = 9.0
    row = build_daily_peak_frame(hourly_rows(spark, powers)).first()
    assert (row.peak_hour, row.peak_hour_lag_1) == (3, 0.0)


def test_a_day_with_one_reading_drops_itself_and_the_next(spark):
    hours = [*range(24), 30, *range(48, 72), *range(72, 96), *range(96, 120)]
    frame = build_daily_peak_frame(hourly_rows(spark, [float(h % 11) for h in hours], hours))
    assert sorted(row.date.day for row in frame.collect()) == [4, 5]
    assert frame.columns == [
        "date", "day_mean", "day_max", "day_std", "day_of_week", "month", "is_weekend",
        "prev_day_mean", "prev_day_max", "prev_day_std", "peak_hour_lag_1",
        "peak_hour_sin", "peak_hour_cos", "peak_hour",
    ]
