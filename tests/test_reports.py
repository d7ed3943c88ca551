from __future__ import annotations

import datetime as dt
import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterflow.functions import hour_label
from meterflow.models.peak_hour import vote_weights
from meterflow.operators import ensemble, metrics, peaks, splits
from meterflow.schema import DATETIME, ENSEMBLE, POWER
from meterflow.sources.readings import recent_rows

from .fixtures import hourly_rows


def long(spark, rows):
    return spark.createDataFrame(rows, "Model string, actual double, predicted double")


def test_metrics_by_hand(spark):
    table = long(spark, [("m", 1.0, 2.0), ("m", 3.0, 3.0), ("m", 5.0, 2.0)])
    row = metrics.regression_metrics(table).first()
    assert row.MAE == pytest.approx(4 / 3)
    assert row.RMSE == pytest.approx((10 / 3) ** 0.5)
    assert row.R2 == pytest.approx(1 - 10 / 8)
    assert row.RAE == pytest.approx(1.0) and row.Relative_Accuracy == pytest.approx(0.0)


def test_constant_actuals(spark):
    table = long(spark, [("off", 2.0, 1.0), ("off", 2.0, 2.0), ("hit", 2.0, 2.0)])
    rows = {row.Model: row for row in metrics.regression_metrics(table).collect()}
    assert rows["off"].RAE == 0.0 and rows["off"].R2 == 0.0
    assert rows["hit"].R2 == 1.0 and rows["hit"].Relative_Accuracy == 1.0


def test_leaderboard_breaks_ties_by_name(spark):
    table = long(spark, [(m, a, a + 1) for m in ("b", "a") for a in (1.0, 2.0)])
    board = metrics.leaderboard(metrics.regression_metrics(table))
    assert [row.Model for row in board.collect()] == ["a", "b"]
    gap = metrics.goal_gap(board).first()
    assert gap.Model == "a" and gap.gap == pytest.approx(0.9 - (1 - 2 / 1))


def test_non_negative_weights_match_a_grid():
    rng = np.random.default_rng(7)
    for _ in range(20):
        x = rng.normal(size=(40, 4)) + rng.normal(size=(40, 1))
        y = x @ np.array([0.7, -0.4, 0.3, 0.0]) + rng.normal(size=40) * 0.1
        found = ensemble.non_negative_weights(x.T @ x, x.T @ y)
        assert (found >= 0).all()
        # Optimality: no gradient pull on used weights, none upwards on unused ones.
        gradient = x.T @ (x @ found - y)
        assert np.abs(gradient[found > 0]).max(initial=0.0) < 1e-8
        assert gradient[found == 0].min(initial=0.0) > -1e-8


def test_stacking_falls_back_when_nothing_helps(spark):
    wide = spark.createDataFrame([(1.0, -1.0, -2.0), (2.0, -2.0, -3.0)], "actual double, a double, b double")
    assert ensemble.stacked_weights(wide, ["a", "b"]) is None
    from meterflow.plans.training import as_errors, ensemble_weights

    errors = as_errors(wide, ["a", "b"])
    weights = ensemble_weights(wide, errors, ["a", "b"])
    assert sum(weights.values()) == pytest.approx(1.0)
    assert weights["a"] > weights["b"] > 0


def test_blend_and_padding(spark):
    wide = spark.createDataFrame([(1.0, 2.0, 4.0)], "actual double, a double, b double")
    row = ensemble.weighted_blend(wide, {"a": 0.25, "b": 0.75}).first()
    assert row[ENSEMBLE] == 3.5
    models = spark.createDataFrame([("a",), ("c",)], "Model string")
    weights = spark.createDataFrame([("a", 1.0)], "Model string, weight double")
    assert ensemble.as_mapping(ensemble.pad_weights(models, weights)) == {"a": 1.0, "c": 0.0}


def test_vote_ties_go_to_the_smallest_label(spark):
    rows = [(1, "m", 5, 0.5), (1, "n", 3, 0.5), (2, "m", 7, 0.9), (2, "n", 2, 0.2)]
    table = spark.createDataFrame(rows, "id int, Model string, label int, probability double")
    weights = spark.createDataFrame([("m", 0.5), ("n", 0.5)], "Model string, weight double")
    found = {r.id: r.label for r in ensemble.weighted_vote(table, weights, ["id"]).collect()}
    assert found == {1: 3, 2: 7}
    assert ensemble.weighted_vote(table.limit(0), weights, ["id"]).count() == 0
    arrays = table.groupBy("id").agg(
        *[
            F.array(*[
                F.coalesce(F.sum(F.when((F.col("Model") == m) & (F.col("label") == k), F.col("probability"))), F.lit(0.0))
                for k in range(8)
            ]).alias(m)
            for m in ("m", "n")
        ]
    )
    column = ensemble.vote_column({m: F.col(m) for m in ("m", "n")}, {"m": 0.5, "n": 0.5}, 8)
    assert {r.id: r.v for r in arrays.select("id", column.alias("v")).collect()} == found


def test_accuracy_weights_keep_a_trace():
    assert vote_weights({"a": 0.0, "b": 0.0}) == {"a": 0.5, "b": 0.5}
    assert vote_weights({"a": 0.3, "b": 0.1})["a"] == pytest.approx(0.75)


def test_split_shares(spark):
    table = splits.chrono_split(hourly_rows(spark, [1.0] * 23))
    rows = [row[splits.SPLIT] for row in table.orderBy(DATETIME).collect()]
    assert [(k, len(list(g))) for k, g in itertools.groupby(rows)] == [
        ("fit", 14), ("validation", 4), ("test", 5),
    ]


def test_threshold_peaks_and_lookup(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(hours=i), float(i), float(i) / 2) for i in range(11)]
    table = spark.createDataFrame(rows, "datetime timestamp_ntz, actual double, predicted double")
    limit = peaks.peak_threshold(table)
    assert limit.first()[0] == 9.0
    found = peaks.peak_periods(table, limit)
    assert sorted(row.actual for row in found.collect()) == [9.0, 10.0]
    assert tuple(peaks.peak_count(found).first()) == (2, False)
    assert tuple(peaks.peak_count(found.limit(0)).first()) == (0, True)
    row = peaks.lookup_error(table, limit, at="2024-01-01 10:00:00").first()
    assert (row.label, row.error, row.peak) == ("2024-01-01 10:00", 5.0, "Yes")
    assert peaks.lookup_error(table, limit, at="not a time").count() == 0


def test_latest_row_per_series(spark):
    table = hourly_rows(spark, [1.0, 2.0, 3.0]).withColumn("meter", F.hour(DATETIME) % 2)
    rows = {row.meter: row[POWER] for row in peaks.latest_rows(table, ["meter"]).collect()}
    assert rows == {0: 3.0, 1: 2.0}


def test_hour_label(spark):
    assert spark.range(1).select(hour_label(F.lit(7))).first()[0] == "07:00 - 07:59"


@pytest.mark.parametrize("wanted", [1, 4, 5, 17, 39, 40, 100, 0, None])
def test_recent_rows_with_a_hot_hour_and_ties(spark, wanted):
    start = dt.datetime(2024, 1, 1)
    moments = [start + dt.timedelta(minutes=20 * (i % 3)) for i in range(30)]
    moments += [start + dt.timedelta(hours=3 + i) for i in range(4)] + [None] * 6
    rows = list(enumerate(moments))
    table = spark.createDataFrame(rows, "id int, at timestamp_ntz").repartition(5)
    found = sorted(row.id for row in recent_rows(table, wanted, F.col("at"), ["id"]).collect())
    order = sorted(rows, key=lambda r: (-(r[1] - start).total_seconds() if r[1] else 1e9, r[0]))
    assert found == sorted(r[0] for r in order[: wanted or None])


def test_recent_rows_with_many_copies_of_one_row(spark):
    rows = [("same", dt.datetime(2024, 1, 1))] * 200 + [("new", dt.datetime(2024, 1, 2))] * 3
    table = spark.createDataFrame(rows, "name string, at timestamp_ntz").repartition(4)
    found = recent_rows(table, 103, F.col("at"), ["name"]).groupBy("name").count()
    assert {row["name"]: row["count"] for row in found.collect()} == {"same": 100, "new": 3}


@pytest.mark.parametrize("quantile", [0.0, 0.5, 0.9, 0.99, 1.0])
def test_quantiles_by_rank_equal_numpy(spark, quantile):
    """Series of any length, ties and heavy tails among them."""
    rng = np.random.default_rng(5)
    series = {n: rng.lognormal(3.0, 2.0, n) for n in [*range(1, 30), 100, 1_000, 40_000]}
    series |= {-1: rng.integers(0, 5, 20_000).astype(float), -2: np.full(9_000, 7.5), -3: -series[1_000]}
    rows = pd.DataFrame(
        [(n, v) for n, own in series.items() for v in own.tolist()], columns=["meter", "actual"]
    )
    table = spark.createDataFrame(rows).repartition(6).unionByName(
        spark.createDataFrame([(1, None), (None, 2.0), (None, 4.0)], "meter long, actual double")
    )
    found = {r.meter: r.peak_threshold for r in peaks.peak_threshold(table, ["meter"], quantile).collect()}
    assert found.pop(None) == pytest.approx(2.0 + 2.0 * quantile)
    assert found.keys() == series.keys()
    for n, own in series.items():
        assert found[n] == pytest.approx(np.quantile(own, quantile), rel=1e-12), n
    whole = peaks.peak_threshold(table.filter("meter IS NOT NULL"), quantile=quantile).first()[0]
    assert whole == pytest.approx(np.quantile(np.concatenate(list(series.values())), quantile), rel=1e-12)
    assert peaks.peak_threshold(table.limit(0)).collect() == [(None,)]
