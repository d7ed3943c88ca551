"""The registered queries as plain SQL over the same Parquet tables."""

from __future__ import annotations

from meterflow.schema import (
    COMPACT_DAILY_FEATURES,
    COMPACT_FEATURES,
    DAILY_FEATURES,
    EWM_SPANS,
    FEATURES,
    LAGS,
    NUMERIC_COLUMNS,
    ROLL_WINDOWS,
    TARGET,
)

from .inputs import NAIVE

BASE = {"power": "Global_active_power", "voltage": "Voltage", "current": "Global_intensity"}
P, V, C = BASE.values()
INTEGERS = {
    "hour", "day_of_week", "day_of_year", "month", "is_weekend", "peak_hour",
}


def r6(expression: str, name: str) -> str:
    return f'round(({expression}) + 1e-9, 6) + 0.0 AS "{name}"'


def rounded(names) -> str:
    return ", ".join(
        f'CAST("{n}" AS INTEGER) AS "{n}"' if n in INTEGERS else r6(f'"{n}"', n) for n in names
    )


K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
READINGS = f"""readings AS (
  SELECT event_id, user_id, event_type, ts AS datetime, value AS {P}, {K} AS {V},
         value * 4.2::DOUBLE + {K} * 0.1::DOUBLE AS {C}
  FROM events)"""


class Shape:
    """SQL fragments for one table or for one series per user."""

    def __init__(self, by_user: bool):
        self.keys = "user_id, " if by_user else ""
        self.partition = "PARTITION BY user_id " if by_user else ""
        self.same = "a.user_id = b.user_id AND " if by_user else ""
        self.join = "USING (user_id)" if by_user else "ON true"
        self.group = "GROUP BY user_id" if by_user else ""

    def over(self, frame: str = "", order: str = "datetime") -> str:
        return f"OVER ({self.partition}ORDER BY {order} {frame})"

    def all(self) -> str:
        return f"OVER ({self.partition})"

    @property
    def hourly(self) -> str:
        return f"""{READINGS}, hourly AS (
  SELECT {self.keys}date_trunc('hour', datetime) AS datetime,
         avg({P}) AS {P}, avg({V}) AS {V}, avg({C}) AS {C}
  FROM readings
  WHERE datetime IS NOT NULL AND {P} IS NOT NULL AND {V} IS NOT NULL AND {C} IS NOT NULL
  GROUP BY ALL)"""

    def lags(self) -> dict[str, str]:
        return {
            f"{short}_lag_{k}": f"lag({column}, {k}) {self.over()}"
            for k in LAGS
            for short, column in BASE.items()
        }

    def rolls(self) -> dict[str, str]:
        found = {}
        for k in ROLL_WINDOWS:
            frame = self.over(f"ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW")
            for name, call in {
                "power_roll_mean": f"avg({P})",
                "power_roll_min": f"min({P})",
                "power_roll_max": f"max({P})",
                "power_roll_std": f"stddev_samp({P})",
                "current_roll_mean": f"avg({C})",
            }.items():
                found[f"{name}_{k}"] = f"CASE WHEN count(*) {frame} = {k} THEN {call} {frame} END"
        return found

    def diffs(self) -> dict[str, str]:
        return {
            "power_diff_1": f"{P} - lag({P}, 1) {self.over()}",
            "power_diff_24": f"{P} - lag({P}, 24) {self.over()}",
            "voltage_diff_1": f"{V} - lag({V}, 1) {self.over()}",
            "current_diff_1": f"{C} - lag({C}, 1) {self.over()}",
        }

    def pcts(self) -> dict[str, str]:
        return {
            "power_pct_change_1": f"{P} / nullif(lag({P}, 1) {self.over()}, 0) - 1",
            "current_pct_change_1": f"{C} / nullif(lag({C}, 1) {self.over()}, 0) - 1",
        }

    def target(self) -> dict[str, str]:
        frame = self.over("ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING")
        return {TARGET: f"avg({P}) {frame}"}

    @property
    def ewm(self) -> str:
        means = []
        for span in EWM_SPANS:
            weight = f"pow({1 - 2 / (span + 1)}::DOUBLE, a.rn - b.rn)"
            means.append(f"sum(b.{P} * {weight}) / sum({weight}) AS power_ewm_{span}")
        keys = "a.user_id, " if self.keys else ""
        return f"""numbered AS (SELECT *, row_number() {self.over()} AS rn FROM hourly),
ewm AS (
  SELECT {keys}a.datetime, {", ".join(means)}
  FROM numbered a JOIN numbered b ON {self.same}b.rn <= a.rn
  GROUP BY {keys}a.datetime)"""

    def wide(self, compact: bool) -> str:
        """CTEs up to ``frame``: every feature and the target of complete rows."""
        columns = self.target() | self.lags() | self.rolls()
        if not compact:
            columns |= self.diffs() | self.pcts()
        names = [*(COMPACT_FEATURES if compact else FEATURES), TARGET]
        selected = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
        calendar = ", ".join(f"{sql} AS {name}" for name, sql in CALENDAR.items())
        extra = f", {', '.join(f'{sql} AS {name}' for name, sql in INTERACTION.items())}"
        source, ewm = "computed", ""
        if not compact:
            ewm = f", {self.ewm}"
            source = f"computed JOIN ewm USING ({self.keys}datetime)"
        complete = " AND ".join(f"{name} IS NOT NULL" for name in names)
        return f"""{self.hourly}{ewm}, computed AS (
  SELECT *, {selected}, {calendar}{extra} FROM hourly),
frame AS (
  SELECT {self.keys}datetime, {", ".join(names)} FROM {source} WHERE {complete})"""

    def days(self, compact: bool = False) -> str:
        """CTEs up to ``days``: the daily peak frame."""
        names = [*(COMPACT_DAILY_FEATURES if compact else DAILY_FEATURES), "peak_hour"]
        over = self.over("", "date")
        complete = " AND ".join(f"{name} IS NOT NULL" for name in names)
        return f"""{self.hourly}, by_day AS (
  SELECT {self.keys}CAST(datetime AS DATE) AS date, avg({P}) AS day_mean, max({P}) AS day_max,
         stddev_samp({P}) AS day_std,
         arg_max(hour(datetime), {{'p': {P}, 'h': -hour(datetime)}}) AS peak_hour
  FROM hourly GROUP BY ALL),
shifted AS (
  SELECT *, isodow(date) - 1 AS day_of_week, month(date) AS month,
         CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         lag(day_mean) {over} AS prev_day_mean, lag(day_max) {over} AS prev_day_max,
         lag(day_std) {over} AS prev_day_std,
         CAST(lag(peak_hour) {over} AS DOUBLE) AS peak_hour_lag_1,
         sin(2 * pi() * peak_hour / 24) AS peak_hour_sin,
         cos(2 * pi() * peak_hour / 24) AS peak_hour_cos
  FROM by_day),
days AS (SELECT {self.keys}date, {", ".join(names)} FROM shifted WHERE {complete})"""

    @property
    def split(self) -> str:
        """CTEs up to ``split``: naive predictions with their part of the series."""
        models = ", ".join(f'{column} AS "{name}"' for name, column in NAIVE.items())
        return f"""{self.wide(compact=True)}, placed AS (
  SELECT {self.keys}datetime, {TARGET} AS actual, {models},
         row_number() {self.over()} - 1 AS pos,
         floor(count(*) {self.all()} * 0.8::DOUBLE) AS train
  FROM frame),
split AS (
  SELECT *, CASE WHEN pos < floor(train * 0.8::DOUBLE) THEN 'fit'
                 WHEN pos < train THEN 'validation' ELSE 'test' END AS split
  FROM placed)"""

    @property
    def compared(self) -> str:
        keys = self.keys
        return f"""{self.split}, comparison AS (
  SELECT {keys}datetime, actual, "Last Hour" AS predicted FROM split WHERE split = 'test'),
thresholds AS (
  SELECT {keys}quantile_cont(actual, 0.9) AS peak_threshold FROM comparison {self.group})"""

    @property
    def long(self) -> str:
        """CTEs up to ``long``: one row per part, model and hour."""
        parts = " UNION ALL ".join(
            f"SELECT {self.keys}datetime, split, actual, '{name}' AS \"Model\", "
            f'"{name}" AS predicted FROM split'
            for name in NAIVE
        )
        return f"{self.split}, long AS ({parts})"


ONE, USER = Shape(False), Shape(True)

CALENDAR = {
    "hour": "hour(datetime)",
    "day_of_week": "isodow(datetime) - 1",
    "day_of_year": "dayofyear(datetime)",
    "month": "month(datetime)",
    "is_weekend": "CASE WHEN isodow(datetime) >= 6 THEN 1 ELSE 0 END",
    "hour_sin": "sin(2 * pi() * hour(datetime) / 24)",
    "hour_cos": "cos(2 * pi() * hour(datetime) / 24)",
    "dow_sin": "sin(2 * pi() * (isodow(datetime) - 1) / 7)",
    "dow_cos": "cos(2 * pi() * (isodow(datetime) - 1) / 7)",
}
INTERACTION = {
    "voltage_x_current": f"{V} * {C}",
    "power_to_current_ratio": f"{P} / nullif({C} + 1e-6, 0)",
}

TEXT = f"""typed AS (
  SELECT event_id, user_id,
         CASE WHEN {K} <> 99 THEN date_trunc('second', ts) END AS datetime,
         CASE WHEN event_type <> 'error' THEN value END AS {P},
         {K} AS Global_reactive_power,
         nullif({K}, 0) AS {V},
         value AS {C},
         CASE WHEN event_type <> 'view' THEN {K} END AS Sub_metering_1,
         {K} * 10 + 5 AS Sub_metering_2,
         -CAST('0.' || json_extract_string(props, '$.k') AS DOUBLE) AS Sub_metering_3
  FROM events),
kept AS (
  SELECT * FROM typed
  WHERE datetime IS NOT NULL AND {P} IS NOT NULL AND {V} IS NOT NULL AND {C} IS NOT NULL)"""

METRICS = """means AS (SELECT {keys}"Model", avg(actual) AS mean FROM {source} GROUP BY ALL),
sums AS (
  SELECT {keys}"Model", avg(abs(predicted - actual)) AS mae,
         avg((predicted - actual) * (predicted - actual)) AS mse,
         sum(abs(predicted - actual)) AS abs_error, sum(abs(actual - mean)) AS abs_dev,
         sum((predicted - actual) * (predicted - actual)) AS sq_error,
         sum((actual - mean) * (actual - mean)) AS sq_dev
  FROM {source} JOIN means USING ({keys}"Model") GROUP BY ALL),
metrics AS (
  SELECT {keys}"Model", mae AS "MAE", sqrt(mse) AS "RMSE",
         CASE WHEN sq_dev = 0 THEN CASE WHEN sq_error = 0 THEN 1 ELSE 0 END
              ELSE 1 - sq_error / sq_dev END AS "R2",
         CASE WHEN abs_dev = 0 THEN 0 ELSE abs_error / abs_dev END AS "RAE",
         1 - CASE WHEN abs_dev = 0 THEN 0 ELSE abs_error / abs_dev END AS "Relative_Accuracy"
  FROM sums)"""
METRIC_NAMES = ["MAE", "RMSE", "R2", "RAE", "Relative_Accuracy"]

ERRORS = f"""{ONE.long}, errors AS (
  SELECT "Model", sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse
  FROM long WHERE split = 'validation' GROUP BY ALL),
top AS (
  SELECT *, row_number() OVER (ORDER BY rmse, "Model") AS rank FROM errors
  QUALIFY rank <= 4),
inverse AS (
  SELECT "Model", 1 / greatest(rmse, 1e-8) / sum(1 / greatest(rmse, 1e-8)) OVER () AS weight
  FROM top)"""

BLENDED = f"""{ERRORS}, tested AS (
  SELECT datetime, actual, "Model", predicted FROM long WHERE split = 'test'),
blend AS (
  SELECT datetime, any_value(actual) AS actual, 'Weighted Ensemble' AS "Model",
         sum(predicted * weight) AS predicted
  FROM tested JOIN inverse USING ("Model") GROUP BY datetime),
candidates AS (SELECT * FROM tested UNION ALL BY NAME SELECT * FROM blend),
{METRICS.format(keys="", source="candidates")}"""

GUESSES = f"""{USER.days()}, guesses AS (
  SELECT user_id, date, peak_hour AS actual, 'Yesterday' AS "Model",
         peak_hour_lag_1 AS predicted FROM days
  UNION ALL SELECT user_id, date, peak_hour, 'Weekday', day_of_week * 3 FROM days
  UNION ALL SELECT user_id, date, peak_hour, 'Evening', 19 FROM days),
scores AS (
  SELECT "Model", avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) AS accuracy
  FROM guesses GROUP BY ALL)"""

FORECAST = f"""{USER.compared}, newest AS (
  SELECT user_id, max(datetime) AS datetime, arg_max(predicted, datetime) AS predicted
  FROM comparison GROUP BY user_id),
peak_days AS (
  SELECT user_id, CAST(datetime AS DATE) AS date,
         arg_max(hour(datetime), {{'p': {P}, 'h': -hour(datetime)}}) AS peak_hour
  FROM hourly GROUP BY ALL),
next_peak AS (
  SELECT user_id, arg_max(peak_hour, date) AS peak_hour FROM peak_days GROUP BY user_id),
forecast AS (
  SELECT user_id, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS timestamp_of_latest_input,
         predicted, predicted >= peak_threshold AS is_peak, CAST(peak_hour AS INTEGER) AS peak_hour,
         printf('%02d:00 - %02d:59', peak_hour, peak_hour) AS backup_power_time_window
  FROM newest JOIN thresholds USING (user_id) JOIN next_peak USING (user_id))"""

ONE_FEATURE = """train AS (
  SELECT {p} AS x, {t} AS y FROM whole WHERE split <> 'test'),
moments AS (
  SELECT count(*) AS n, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my FROM train),
slope AS (
  SELECT n, mx, sx, my, sum((x - mx) / sx * (y - my)) AS zy FROM train, moments GROUP BY ALL)"""
WHOLE = f"""{ONE.wide(compact=False)}, placed AS (
  SELECT *, row_number() OVER (ORDER BY datetime) - 1 AS pos,
         floor(count(*) OVER () * 0.8::DOUBLE) AS train FROM frame),
whole AS (
  SELECT *, CASE WHEN pos < train THEN 'train' ELSE 'test' END AS split FROM placed),
{ONE_FEATURE.format(p=P, t=TARGET)}"""


def one_feature(weight: str) -> str:
    predicted = f"my + ({weight}) * ({P} - mx) / sx"
    return (
        f"WITH {WHOLE} SELECT datetime, {r6(TARGET, 'actual')}, {r6(predicted, 'predicted')} "
        f"FROM whole, slope WHERE split = 'test'"
    )


def two_features(other: str) -> str:
    """Least squares on power and another column, from their covariances."""
    return f"""WITH {WHOLE}, joint AS (
  SELECT avg({P}) AS m1, avg({other}) AS m2, avg({TARGET}) AS my, var_pop({P}) AS a, covar_pop({P}, {other}) AS b,
         var_pop({other}) AS c, covar_pop({P}, {TARGET}) AS p, covar_pop({other}, {TARGET}) AS q
  FROM whole WHERE split <> 'test'),
weights AS (SELECT *, (p * c - q * b) / (a * c - b * b) AS w1, (q * a - p * b) / (a * c - b * b) AS w2 FROM joint)
SELECT datetime, {r6(TARGET, 'actual')}, {r6(f'my + w1 * ({P} - m1) + w2 * ({other} - m2)', 'predicted')}
FROM whole, weights WHERE split = 'test'"""


TREE_FEATURES = [P, "hour", "power_lag_24", "power_roll_mean_6"]
DAY_FEATURES = ["day_mean", "day_max", "prev_day_max", "is_weekend"]
SEED = 42
# Rows of the training part with rounded values and whole residuals; one row of what residuals count in.
TREE_ROWS = f"""{WHOLE}, rounded AS (
  SELECT datetime, split, round({TARGET} + 1e-9, 6) AS y,
         {", ".join(f"round({name} + 1e-9, 6) AS x{k}" for k, name in enumerate(TREE_FEATURES))} FROM whole),
label AS (
  SELECT count(*) AS n, min(y) AS low, pow(2, floor(log2(1073741824 / (max(y) - min(y))))) AS unit
  FROM rounded WHERE split <> 'test'),
base AS (
  SELECT any_value(unit) AS unit, any_value(low) + sum(CAST(round((y - low) * unit) AS BIGINT))::DOUBLE / any_value(unit) / any_value(n) AS mean
  FROM rounded, label WHERE split <> 'test')"""


def _children(tree: int, level: int) -> str:
    """The rows' nodes one level down: node 0 has children 1 and 2, and so on without gaps."""
    return f"""children_{tree}_{level} AS (
  SELECT node, feature, cut, value_l, value_r, row_number() OVER (ORDER BY node) AS nth FROM best_{tree}_{level}),
step_{tree}_{level} AS (
  SELECT r.*, CASE WHEN c.node IS NULL THEN r.value WHEN v >= cut THEN value_r ELSE value_l END AS value1,
         CASE WHEN c.node IS NULL THEN NULL ELSE {2**(level + 1) - 1 if level else 1} + 2 * (nth - 1) + (v >= cut)::INT END AS node1
  FROM (SELECT n.*, f.v, f.feature FROM node_{tree}_{level} n JOIN long f USING (datetime)) r
  LEFT JOIN children_{tree}_{level} c ON r.node = c.node AND r.feature = c.feature
  QUALIFY row_number() OVER (PARTITION BY datetime ORDER BY c.node IS NULL, r.feature) = 1)"""


def _weight(g: str, n: str, l1: float, l2: float) -> str:
    cut = f"greatest(abs({g} / unit) - {l1}::DOUBLE, 0::DOUBLE)"
    return f"{cut} * {cut} / ({n} + {l2}::DOUBLE)"


def boosted(trees: int, depth: int, bins: int, min_leaf: int, step: float, l1: float, l2: float) -> str:
    """Boosting on binned features, a level at a time."""
    ranks = ", ".join(f"{k}::DOUBLE / {bins}" for k in range(1, bins))
    edges = ", ".join(f"quantile_cont(x{k}, [{ranks}]) AS e{k}, min(x{k}) AS low{k}" for k in range(len(TREE_FEATURES)))
    long = " UNION ALL ".join(
        f"SELECT datetime, split, {k} AS feature, len(list_filter(list_distinct(e{k}), lambda e: e > low{k} AND e <= x{k})) AS v FROM rounded, edges"
        for k in range(len(TREE_FEATURES))
    )
    parts = [TREE_ROWS, f"edges AS (SELECT {edges} FROM rounded WHERE split <> 'test')", f"long AS ({long})",
             "margin_0 AS (SELECT datetime, split, y, mean AS f FROM rounded, base)"]
    for t in range(trees):
        parts.append(f"node_{t}_0 AS (SELECT datetime, split, CAST(round((y - f) * unit) AS BIGINT) AS g, 0 AS node, 0::DOUBLE AS value FROM margin_{t}, base)")
        for level in range(depth):
            parts.append(f"""sums_{t}_{level} AS (
  SELECT node, feature, v, sum(g)::BIGINT AS g, count(*) AS n FROM node_{t}_{level} JOIN long USING (datetime)
  WHERE node_{t}_{level}.split <> 'test' AND node IS NOT NULL GROUP BY ALL),
sides_{t}_{level} AS (
  SELECT node, feature, v, sum(g) OVER upto AS gl, sum(n) OVER upto AS nl, sum(g) OVER own AS ga, sum(n) OVER own AS na FROM sums_{t}_{level}
  WINDOW own AS (PARTITION BY node, feature), upto AS (PARTITION BY node, feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
gains_{t}_{level} AS (
  SELECT *, {_weight("gl", "nl", l1, l2)} + {_weight("(ga - gl)", "(na - nl)", l1, l2)} - {_weight("ga", "na", l1, l2)} AS gain
  FROM sides_{t}_{level}, base WHERE nl >= {min_leaf} AND na - nl >= {min_leaf}),
best_{t}_{level} AS (
  SELECT node, feature, v + 1 AS cut,
         {step} * (sign(gl) * greatest(abs(gl / unit) - {l1}, 0) / (nl + {l2})) AS value_l,
         {step} * (sign(ga - gl) * greatest(abs((ga - gl) / unit) - {l1}, 0) / (na - nl + {l2})) AS value_r
  FROM gains_{t}_{level} WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, v) = 1),
{_children(t, level)},
node_{t}_{level + 1} AS (SELECT datetime, split, g, node1 AS node, value1 AS value FROM step_{t}_{level})""")
        parts.append(f"margin_{t + 1} AS (SELECT m.datetime, m.split, y, f + value AS f FROM margin_{t} m JOIN node_{t}_{depth} USING (datetime))")
    return f"WITH {', '.join(parts)} SELECT datetime, {r6('y', 'actual')}, {r6('f', 'predicted')} FROM margin_{trees} WHERE split = 'test'"


def randomised(trees: int, depth: int, min_leaf: int) -> str:
    """Trees whose features each offer one threshold at a random share of their range in a node."""
    long = " UNION ALL ".join(f"SELECT datetime, split, {k} AS feature, x{k} AS v FROM rounded" for k in range(len(TREE_FEATURES)))
    parts = [TREE_ROWS, f"long AS ({long})"]
    for t in range(trees):
        parts.append(f"node_{t}_0 AS (SELECT datetime, split, CAST(round((y - mean) * unit) AS BIGINT) AS g, 0 AS node, 0::DOUBLE AS value FROM rounded, base)")
        for level in range(depth):
            chance = f"('0x' || substr(md5('{SEED}:cut:{t}:' || node || ':' || feature), 1, 8))::BIGINT / 4294967296"
            parts.append(f"""cuts_{t}_{level} AS (
  SELECT node, feature, min(v) + {chance} * (max(v) - min(v)) AS cut FROM node_{t}_{level} JOIN long USING (datetime)
  WHERE node_{t}_{level}.split <> 'test' AND node IS NOT NULL GROUP BY node, feature HAVING min(v) < max(v)),
sums_{t}_{level} AS (
  SELECT node, feature, any_value(cut) AS cut, coalesce(sum(g) FILTER (v < cut), 0)::BIGINT AS gl, count(*) FILTER (v < cut) AS nl,
         coalesce(sum(g) FILTER (v >= cut), 0)::BIGINT AS gr, count(*) FILTER (v >= cut) AS nr
  FROM node_{t}_{level} n JOIN long USING (datetime) JOIN cuts_{t}_{level} USING (node, feature) WHERE n.split <> 'test' GROUP BY node, feature),
gains_{t}_{level} AS (
  SELECT *, gl::DOUBLE * gl / nl + gr::DOUBLE * gr / nr - (gl + gr)::DOUBLE * (gl + gr)::DOUBLE / (nl + nr) AS gain
  FROM sums_{t}_{level} WHERE nl >= {min_leaf} AND nr >= {min_leaf}),
best_{t}_{level} AS (
  SELECT node, feature, cut, gl / nl / unit AS value_l, gr / nr / unit AS value_r FROM gains_{t}_{level}, base WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature) = 1),
{_children(t, level)},
node_{t}_{level + 1} AS (SELECT datetime, split, g, node1 AS node, value1 AS value FROM step_{t}_{level})""")
    parts.append("total AS (" + " UNION ALL ".join(f"SELECT datetime, value FROM node_{t}_{depth}" for t in range(trees)) + ")")
    return (
        f"WITH {', '.join(parts)} SELECT r.datetime, {r6('any_value(y)', 'actual')}, {r6('any_value(mean) + avg(value)', 'predicted')} "
        f"FROM rounded r JOIN total USING (datetime), base WHERE split = 'test' GROUP BY r.datetime"
    )


def softmax_stumps(rounds: int, bins: int, min_leaf: int, step: float) -> str:
    """Boosted stumps on the multinomial log-loss, one per class and round."""
    n = range(len(DAY_FEATURES))
    ranks = ", ".join(f"{k}::DOUBLE / {bins}" for k in range(1, bins))
    edges = ", ".join(f"quantile_cont(x{k}, [{ranks}]) AS e{k}, min(x{k}) AS low{k}" for k in n)
    long = " UNION ALL ".join(
        f"SELECT user_id, date, split, {k} AS feature, len(list_filter(list_distinct(e{k}), lambda e: e > low{k} AND e <= x{k})) AS v FROM rounded, edges"
        for k in n
    )
    parts = [f"""{USER.days()}, rounded AS (
  SELECT user_id, date, CAST(peak_hour AS INTEGER) AS y, CASE WHEN row_number() {USER.over('', 'date')} - 1
         < floor(count(*) {USER.all()} * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split,
         {", ".join(f"round({name} + 1e-9, 6)::DOUBLE AS x{k}" for k, name in enumerate(DAY_FEATURES))} FROM days),
prior AS (
  SELECT y AS class, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) AS f, count(*) OVER () AS classes
  FROM rounded WHERE split = 'train' GROUP BY y)""",
        f"edges AS (SELECT {edges} FROM rounded WHERE split = 'train')", f"long AS ({long})",
        "margin_0 AS (SELECT user_id, date, split, y, class, classes, f FROM rounded, prior)"]
    for t in range(rounds + 1):
        parts.append(f"""shifted_{t} AS (SELECT *, exp(f - max(f) OVER (PARTITION BY user_id, date)) AS e FROM margin_{t}),
chance_{t} AS (SELECT *, e / sum(e) OVER (PARTITION BY user_id, date) AS p FROM shifted_{t})""")
        if t == rounds:
            break
        parts.append(f"""slope_{t} AS (
  SELECT *, CAST(round(((y = class)::INT - p) * 1073741824) AS BIGINT) AS g, CAST(round(p * (1 - p) * 1073741824) AS BIGINT) AS h
  FROM chance_{t}),
sums_{t} AS (
  SELECT class, classes, feature, v, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h, count(*) AS n
  FROM slope_{t} s JOIN long USING (user_id, date) WHERE s.split = 'train' GROUP BY ALL),
sides_{t} AS (
  SELECT class, classes, feature, v, sum(g) OVER upto AS gl, sum(h) OVER upto AS hl, sum(n) OVER upto AS nl,
         sum(g) OVER own AS ga, sum(h) OVER own AS ha, sum(n) OVER own AS na FROM sums_{t}
  WINDOW own AS (PARTITION BY class, feature), upto AS (PARTITION BY class, feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
gains_{t} AS (
  SELECT *, gl::DOUBLE * gl / nl + (ga - gl)::DOUBLE * (ga - gl) / (na - nl) - ga::DOUBLE * ga / na AS gain
  FROM sides_{t} WHERE nl >= {min_leaf} AND na - nl >= {min_leaf}),
best_{t} AS (
  SELECT class, feature, v AS cut, {step} * (classes - 1) / classes * coalesce(gl / nullif(hl, 0), 0) AS low,
         {step} * (classes - 1) / classes * coalesce((ga - gl) / nullif(ha - hl, 0), 0) AS high
  FROM gains_{t} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY class ORDER BY gain DESC, feature, v) = 1),
margin_{t + 1} AS (
  SELECT s.user_id, s.date, s.split, y, s.class, classes,
         f + CASE WHEN b.class IS NULL THEN 0 WHEN l.v > b.cut THEN high ELSE low END AS f
  FROM slope_{t} s LEFT JOIN best_{t} b ON s.class = b.class
  LEFT JOIN long l ON s.user_id = l.user_id AND s.date = l.date AND b.feature = l.feature)""")
    return (
        f"WITH {', '.join(parts)} SELECT user_id, date, {r6('coalesce(max(p) FILTER (y = class), 0)', 'true_chance')}, "
        f"{r6('max(p)', 'highest_chance')} FROM chance_{rounds} WHERE split = 'test' GROUP BY user_id, date"
    )


def gram() -> str:
    names = list(NAIVE)[:4]
    terms = [
        r6(f'sum("{names[i]}" * "{names[j]}")', f"g_{i}_{j}")
        for i in range(4)
        for j in range(i, 4)
    ]
    terms += [r6(f'sum("{name}" * actual)', f"c_{i}") for i, name in enumerate(names)]
    return f"WITH {ONE.split} SELECT {', '.join(terms)} FROM split WHERE split = 'validation'"


STACK2 = f"""{ONE.split}, sums AS (
  SELECT sum("Last Hour" * "Last Hour") AS aa, sum("Last Hour" * "Day Mean") AS ab,
         sum("Day Mean" * "Day Mean") AS bb, sum("Last Hour" * actual) AS ca,
         sum("Day Mean" * actual) AS cb
  FROM split WHERE split = 'validation'),
free AS (
  SELECT *, (ca * bb - cb * ab) / (aa * bb - ab * ab) AS wa,
         (cb * aa - ca * ab) / (aa * bb - ab * ab) AS wb FROM sums),
solved AS (
  SELECT CASE WHEN wa < 0 THEN 0 WHEN wb < 0 THEN ca / aa ELSE wa END AS wa,
         CASE WHEN wb < 0 THEN 0 WHEN wa < 0 THEN cb / bb ELSE wb END AS wb FROM free)"""


def family(shape: Shape, columns: dict[str, str], plain: tuple[str, ...] = ()) -> str:
    selected = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return (
        f"WITH {shape.hourly}, computed AS (SELECT *, {selected} FROM hourly) "
        f"SELECT {shape.keys}datetime, {rounded([*plain, *columns])} FROM computed"
    )


def per_shape(shape: Shape) -> dict[str, str]:
    k = shape.keys
    rolls = shape.rolls()
    daily = f"WITH {shape.days()} SELECT {k}date"
    frames = {
        "": (FEATURES, False),
        "compact_": (COMPACT_FEATURES, True),
    }
    found = {
        "hourly_mean": f"WITH {shape.hourly} SELECT {k}datetime, {rounded(BASE.values())} FROM hourly",
        "forward_target": family(shape, shape.target(), (P,)),
        "lag_features": family(shape, shape.lags()),
        "rolling_power": family(shape, {n: s for n, s in rolls.items() if n.startswith("power")}),
        "rolling_current": family(
            shape, {n: s for n, s in rolls.items() if n.startswith("current")}
        ),
        "diff_features": family(shape, shape.diffs()),
        "pct_change_features": family(shape, shape.pcts()),
        "ewm_features": (
            f"WITH {shape.hourly}, {shape.ewm} SELECT {k}datetime, "
            f"{rounded([f'power_ewm_{s}' for s in EWM_SPANS])} FROM ewm"
        ),
        "calendar_features": family(shape, CALENDAR),
        "interaction_features": family(shape, INTERACTION),
        "daily_stats": f"{daily}, {rounded(['day_mean', 'day_max', 'day_std'])} FROM by_day",
        "daily_peak_hour": f"{daily}, {rounded(['peak_hour'])} FROM by_day",
        "daily_peak_frame": f"{daily}, {rounded([*DAILY_FEATURES, 'peak_hour'])} FROM days",
        "compact_daily_frame": (
            f"WITH {shape.days(compact=True)} SELECT {k}date, "
            f"{rounded([*COMPACT_DAILY_FEATURES, 'peak_hour'])} FROM days"
        ),
        "chrono_split": f"WITH {shape.split} SELECT {k}datetime, {r6('actual', TARGET)}, split FROM split",
        "daily_split": (
            f"{daily}, {rounded(['peak_hour'])}, CASE WHEN row_number() {shape.over('', 'date')} - 1 "
            f"< floor(count(*) {shape.all()} * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split "
            f"FROM days"
        ),
        "peak_threshold": (
            f"WITH {shape.compared} SELECT {k}{r6('peak_threshold', 'peak_threshold')} FROM thresholds"
        ),
        "peak_periods": (
            f"WITH {shape.compared} SELECT {k}datetime, {rounded(['actual', 'predicted'])} "
            f"FROM comparison JOIN thresholds {shape.join} WHERE actual >= peak_threshold"
        ),
        "lookup_error": (
            f"WITH {shape.compared} SELECT {k}strftime(datetime, '%Y-%m-%d %H:%M') AS label, "
            f"{rounded(['actual', 'predicted'])}, {r6('abs(actual - predicted)', 'error')}, "
            f"CASE WHEN actual >= peak_threshold THEN 'Yes' ELSE 'No' END AS peak "
            f"FROM comparison JOIN thresholds {shape.join}"
        ),
        "latest_features": (
            f"WITH {shape.wide(compact=False)} SELECT {k}datetime, {rounded(FEATURES)} FROM frame "
            f"QUALIFY row_number() OVER ({shape.partition}ORDER BY datetime DESC) = 1"
        ),
    }
    for prefix, (names, compact) in frames.items():
        found[f"{prefix}model_frame"] = (
            f"WITH {shape.wide(compact)} SELECT {k}datetime, {rounded([*names, TARGET])} FROM frame"
        )
    return found


def build() -> dict[str, str]:
    found = per_shape(ONE) | {f"{name}_by_user": sql for name, sql in per_shape(USER).items()}
    text_hourly = (
        "WITH {text} SELECT {keys}date_trunc('hour', datetime) AS datetime, {means} "
        "FROM kept GROUP BY ALL"
    )
    means = ", ".join(r6(f"avg({name})", name) for name in BASE.values())
    scaled = ", ".join(
        r6(
            f"CASE WHEN stddev_pop({n}) OVER () = 0 THEN 0 "
            f"ELSE ({n} - avg({n}) OVER ()) / stddev_pop({n}) OVER () END",
            n,
        )
        for n in COMPACT_FEATURES
    )
    by_user = METRICS.format(keys="user_id, ", source="tested")
    found |= {
        "parse_timestamps": f"WITH {TEXT} SELECT event_id, datetime FROM typed",
        "coerce_numeric": f"WITH {TEXT} SELECT event_id, {rounded(NUMERIC_COLUMNS)} FROM typed",
        "required_rows": (
            f"WITH {TEXT} SELECT event_id, datetime, {rounded(BASE.values())} FROM kept"
        ),
        "preprocess_hourly": text_hourly.format(text=TEXT, keys="", means=means),
        "preprocess_hourly_by_user": text_hourly.format(text=TEXT, keys="user_id, ", means=means),
        "recent_rows": (
            f"WITH {READINGS} SELECT event_id, datetime, {rounded([P])} FROM readings "
            f"ORDER BY datetime DESC, event_id LIMIT 3000"
        ),
        "stage_counts": f"""WITH {TEXT}, hours AS (
  SELECT date_trunc('hour', datetime) AS datetime, avg({P}) AS p, avg({C}) AS c
  FROM kept GROUP BY ALL),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY datetime) AS rn, count(*) OVER () AS n,
         lag(p) OVER (ORDER BY datetime) AS p1, lag(c) OVER (ORDER BY datetime) AS c1 FROM hours)
SELECT 'raw' AS stage, count(*) AS rows FROM events
UNION ALL SELECT 'hourly', count(*) FROM hours
UNION ALL SELECT 'model', count(*) FROM numbered WHERE rn > 48 AND rn < n AND p1 <> 0 AND c1 <> 0""",
        "regression_metrics": (
            f"WITH {ONE.long}, tested AS (SELECT * FROM long WHERE split = 'test'), "
            f'{METRICS.format(keys="", source="tested")} '
            f'SELECT "Model", {rounded(METRIC_NAMES)} FROM metrics'
        ),
        "regression_metrics_by_user": (
            f"WITH {USER.long}, tested AS (SELECT * FROM long WHERE split = 'test'), {by_user} "
            f'SELECT user_id, "Model", {rounded(METRIC_NAMES)} FROM metrics'
        ),
        "validation_rmse": f'WITH {ERRORS} SELECT "Model", {rounded(["rmse"])} FROM errors',
        "leaderboard": f'WITH {BLENDED} SELECT "Model", {rounded(METRIC_NAMES)} FROM metrics',
        "goal_gap": (
            f'WITH {BLENDED} SELECT "Model", {rounded(["RAE", "Relative_Accuracy"])}, '
            f"0.1::DOUBLE AS goal_rae, 0.9::DOUBLE AS goal_accuracy, "
            f"{r6('0.9::DOUBLE - \"Relative_Accuracy\"', 'gap')} "
            f'FROM metrics ORDER BY "RMSE", "Model" LIMIT 1'
        ),
        "best_predictions": (
            f'WITH {BLENDED} SELECT "Model", datetime, {rounded(["actual", "predicted"])} '
            f'FROM candidates WHERE "Model" = '
            f'(SELECT "Model" FROM metrics ORDER BY "RMSE", "Model" LIMIT 1)'
        ),
        "weighted_blend": (
            f"WITH {BLENDED} SELECT datetime, {rounded(['actual', 'predicted'])} FROM blend"
        ),
        "top_models": (
            f'WITH {ERRORS} SELECT "Model", {rounded(["rmse"])}, CAST(rank AS INTEGER) AS rank FROM top'
        ),
        "inverse_rmse_weights": f'WITH {ERRORS} SELECT "Model", {rounded(["weight"])} FROM inverse',
        "inverse_rmse_weights_all": (
            f'WITH {ERRORS} SELECT "Model", '
            f"{r6('1 / greatest(rmse, 1e-8) / sum(1 / greatest(rmse, 1e-8)) OVER ()', 'weight')} "
            f"FROM errors"
        ),
        "padded_weights": (
            f'WITH {ERRORS} SELECT "Model", {r6("coalesce(weight, 0)", "weight")} '
            f'FROM errors LEFT JOIN inverse USING ("Model")'
        ),
        "stack_gram": gram(),
        "stack_weights2": (
            f"WITH {STACK2} SELECT 'Last Hour' AS \"Model\", {r6('wa / (wa + wb)', 'weight')} FROM solved "
            f"UNION ALL SELECT 'Day Mean', {r6('wb / (wa + wb)', 'weight')} FROM solved"
        ),
        "peak_count": (
            f"WITH {ONE.compared} SELECT count(*) AS peaks, count(*) = 0 AS no_peaks "
            f"FROM comparison, thresholds WHERE actual >= peak_threshold"
        ),
        "first_peaks": (
            f"WITH {ONE.compared} SELECT datetime, {rounded(['actual', 'predicted'])} "
            f"FROM comparison, thresholds WHERE actual >= peak_threshold ORDER BY datetime LIMIT 50"
        ),
        "flag_peak": (
            f"WITH {ONE.compared} SELECT datetime, {rounded(['predicted'])}, "
            f"predicted >= peak_threshold AS is_peak FROM comparison, thresholds"
        ),
        "backup_window": (
            f"WITH {USER.days()} SELECT user_id, date, "
            f"printf('%02d:00 - %02d:59', peak_hour, peak_hour) AS \"window\" FROM by_day"
        ),
        "forecast_record": (
            f"WITH {FORECAST} SELECT user_id, timestamp_of_latest_input, "
            f"{r6('predicted', 'predicted_next_6h_avg_power_kw')}, "
            f"is_peak AS is_predicted_peak_period, peak_hour AS predicted_peak_hour_next_day, "
            f"backup_power_time_window FROM forecast"
        ),
        "insight_table": (
            f"WITH {FORECAST} SELECT user_id, timestamp_of_latest_input AS latest_timestamp, "
            f"'Last Hour' AS best_model, "
            f"round(predicted, 4) + 0.0 AS predicted_next_6h_avg_power_kw, "
            f"CASE WHEN is_peak THEN 'Yes' ELSE 'No' END AS predicted_peak, "
            f"peak_hour AS predicted_peak_hour_next_day, "
            f"printf('%02d:00', peak_hour) AS peak_hour_text, backup_power_time_window FROM forecast"
        ),
        "what_if_features": (
            f"WITH {READINGS} SELECT event_id, {rounded(BASE.values())}, "
            + ", ".join(r6(f"{P} * {0.95**k}::DOUBLE", f"power_lag_{k}") for k in LAGS)
            + " FROM readings"
        ),
        "peak_accuracy": f'WITH {GUESSES} SELECT "Model", {rounded(["accuracy"])} FROM scores',
        "accuracy_weights": (
            f'WITH {GUESSES} SELECT "Model", '
            f"{r6('greatest(accuracy, 1e-8) / sum(greatest(accuracy, 1e-8)) OVER ()', 'weight')} "
            f"FROM scores"
        ),
        "weighted_vote": f"""WITH {READINGS}, by_hour AS (
  SELECT user_id, hour(datetime) AS label, CAST(count(*) AS DOUBLE) AS n, sum({P}) AS power
  FROM readings GROUP BY ALL),
shares AS (
  SELECT user_id, label, n / sum(n) OVER (PARTITION BY user_id) AS n,
         power / nullif(sum(power) OVER (PARTITION BY user_id), 0) AS power FROM by_hour),
scores AS (SELECT avg(n) AS n, avg(power) AS power FROM shares),
votes AS (
  SELECT user_id, label, (a.n * b.n + a.power * b.power) / (b.n + b.power) AS score
  FROM shares a, scores b)
SELECT user_id, CAST(label AS INTEGER) AS label FROM votes
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, label) = 1""",
        "standardize": f"WITH {ONE.wide(compact=True)} SELECT datetime, {scaled} FROM frame",
        "boosted_trees_depth2": boosted(2, 2, bins=8, min_leaf=5, step=0.5, l1=0.5, l2=0.1),
        "boosted_stumps": boosted(3, 1, bins=16, min_leaf=5, step=0.5, l1=0.0, l2=0.1),
        "random_tree_depth2": randomised(1, 2, min_leaf=1),
        "random_trees_depth1": randomised(3, 1, min_leaf=5),
        "softmax_stumps": softmax_stumps(rounds=3, bins=8, min_leaf=5, step=0.3),
        "ols_repeated_features": two_features("power_lag_1"),
        "ols_one_feature": one_feature("zy / n"),
        "ridge_one_feature": one_feature("zy / (n + 1.0)"),
        "elastic_net_one_feature": one_feature(
            "sign(zy) * greatest(abs(zy / n) - 0.5 * 0.2, 0) / (1 + 0.5 * 0.8)"
        ),
    }
    return found
