"""Self and peer baselines of every metric.

Metrics are handled in integer units of their stored scale (0.0125 at four decimals is 125), so
sums, means and quartiles of stored values are exact whatever the order of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import above, quartile
from ..functions.scale import salted_join
from ..registry import (
    BASELINE_ROWS,
    COHORT_KEYS,
    CUSUM_ALARM,
    CUSUM_MIN_OBS,
    CUSUM_SLACK,
    METRICS,
    MIN_BASELINE,
    MIN_PEERS,
    OPTIONAL,
    Metric,
    metric_attribute,
)


def in_units(metric: Metric) -> Column:
    return F.round(F.col(metric.name).cast("double") * 10**metric.decimals)


def unit_of(metrics=METRICS) -> Column:
    return metric_attribute(F.col("metric"), [float(10**m.decimals) for m in metrics])


def metric_name(metrics=METRICS) -> Column:
    return metric_attribute(F.col("metric"), [m.name for m in metrics])


def _by_day(keys: tuple[str, ...]):
    return Window.partitionBy(*keys).orderBy("metric_date")


def _zscore(x: Column, mean: Column, std: Column, n: Column, least: int) -> Column:
    return F.when((std > 0) & (n >= least), (x - mean) / std)


def self_zscore() -> Column:
    return _zscore(F.col("units"), F.col("roll_mean"), F.col("roll_std"), F.col("roll_n"), MIN_BASELINE)


class _Readings:
    """Readings with one row for each observation of `keys`, and their metrics side by side as unit columns.

    Every metric that each day has stands in one wide frame, sorted once by seller and day. The optional ones follow as
    one long frame, because their windows count observations and not days. `cells` are (ordinal, metric, column); the
    long frame has its ordinal in the column `metric`, and a single unit column.
    """

    def __init__(self, frame: DataFrame, keys: tuple[str, ...], cells: list[tuple[Column, tuple[Metric, ...], str]], keep: tuple[str, ...]):
        self.frame, self.keys, self.cells, self.keep = frame, keys, cells, keep

    @property
    def names(self) -> list[str]:
        return [name for _, _, name in self.cells]

    def having(self, frame: DataFrame) -> _Readings:
        return _Readings(frame, self.keys, self.cells, self.keep)

    def long(self, fields: dict[str, Callable[[str], Column]]) -> DataFrame:
        """One row a reading: its metric's ordinal, its units and the given columns of it."""
        made = [
            F.struct(ordinal.cast("int").alias("metric"), F.col(x).cast("double").alias("units"), *[f(x).alias(k) for k, f in fields.items()])
            for ordinal, _, x in self.cells
        ]
        return self.frame.select("seller_id", "metric_date", *self.keep, F.inline(F.array(*made)))


def _readings(spine: DataFrame, metrics=METRICS, keep: tuple[str, ...] = ()) -> list[_Readings]:
    """All metrics of a spine, dealt by seller once."""
    # computing rules here, not bytes: as many tasks as the session shuffles to
    dealt = spine.repartition(int(spine.sparkSession.conf.get("spark.sql.shuffle.partitions")), "seller_id")
    always = [(i, m) for i, m in enumerate(metrics) if m.name not in OPTIONAL]
    sometimes = [(i, m) for i, m in enumerate(metrics) if m.name in OPTIONAL]
    out = []
    if always:
        units = [in_units(m).cast("bigint").alias(f"u{i}") for i, m in always]
        cells = [(F.lit(i), (m,), f"u{i}") for i, m in always]
        out.append(_Readings(dealt.select("seller_id", "metric_date", *keep, *units), ("seller_id",), cells, keep))
    if sometimes:
        given = [F.struct(F.lit(i).alias("metric"), in_units(m).cast("bigint").alias("u")) for i, m in sometimes]
        long = dealt.select("seller_id", "metric_date", *keep, F.inline(F.array(*given))).where("u IS NOT NULL")
        out.append(_Readings(long, ("seller_id", "metric"), [(F.col("metric"), tuple(metrics), "u")], keep))
    return out


def _trailing(keys: tuple[str, ...]):
    return _by_day(keys).rowsBetween(-BASELINE_ROWS, -1)


def _trailing_sums(series: _Readings, names: list[str]) -> list[Column]:
    """Of the named columns over the 28 observations before each one: sum and sum of squares of a rate, mean and deviation of any other column.

    Rates are small whole numbers, so their deviation comes from plain sums, which are exact.
    """
    recent = _trailing(series.keys)
    made = []
    for _, metrics, x in series.cells:
        if x not in names:
            continue
        if _is_rate(metrics):
            made.append(F.sum(F.col(x).cast("double")).over(recent).alias(f"{x}_sum"))
            made.append(F.sum(F.col(x).cast("double") * F.col(x)).over(recent).alias(f"{x}_squares"))
        else:
            made.append(F.avg(x).over(recent).alias(f"{x}_mean"))
            made.append(F.stddev_samp(x).over(recent).alias(f"{x}_std"))
    return made


def _mean_and_std(total: Column, squares: Column, n: Column) -> tuple[Column, Column]:
    return total / F.nullif(n, F.lit(0)), F.when(n > 1, F.sqrt((n * squares - total * total) / (n * (n - 1))))


def _with_trailing_stats(series: _Readings) -> _Readings:
    """Adds mean, deviation (`_mean`, `_std` of each column) and count of the 28 observations before each one."""
    stats = []
    for _, metrics, x in series.cells:
        if _is_rate(metrics):
            mean, std = _mean_and_std(F.col(f"{x}_sum"), F.col(f"{x}_squares"), F.col("roll_n"))
            stats += [mean.alias(f"{x}_mean"), std.alias(f"{x}_std")]
    counted = F.count("*").over(_trailing(series.keys)).alias("roll_n")
    return series.having(series.frame.select("*", counted, *_trailing_sums(series, series.names)).select("*", *stats))


def _is_rate(metrics: tuple[Metric, ...]) -> bool:
    """Whether all readings are shares at four decimals."""
    return all(m.decimals == 4 for m in metrics)


def rolling_baseline(spine: DataFrame, metrics=METRICS) -> DataFrame:
    """Self baseline table: one row per seller, day and metric."""
    unit = unit_of(metrics)
    fields = {"roll_mean": lambda x: F.col(f"{x}_mean"), "roll_std": lambda x: F.col(f"{x}_std"), "roll_n": lambda x: F.col("roll_n")}
    parts = [_with_trailing_stats(series).long(fields) for series in _readings(spine, metrics)]
    return reduce(DataFrame.unionByName, parts).select(
        "seller_id",
        "metric_date",
        metric_name(metrics).alias("metric_name"),
        (F.col("units") / unit).alias("observed_value"),
        (F.col("roll_mean") / unit).alias("rolling_mean_28d"),
        (F.col("roll_std") / unit).alias("rolling_std_28d"),
        F.col("roll_n").alias("rolling_n_28d"),
        self_zscore().alias("self_zscore"),
    )


def _bad_drift(ordinal: Column, metrics: tuple[Metric, ...], up: Column, down: Column) -> Column:
    """The cumulative sum of the metric's bad direction; of both, the larger."""
    if len(metrics) == 1:
        return {"up": up, "down": down, "both": F.greatest(up, down)}[metrics[0].direction]
    may = {way: ordinal.isin([i for i, m in enumerate(metrics) if m.direction in (way, "both")]) for way in ("up", "down")}
    return F.greatest(F.when(may["up"], up), F.when(may["down"], down))


def detector_profile(spine: DataFrame, metrics=METRICS, keep: tuple[str, ...] = (), alarm: float = CUSUM_ALARM) -> DataFrame:
    """Everything the three single-metric detectors need, per seller, day and metric.

    One exchange by seller, and one sort of the seller's days for all metrics that each day has. The readings are laid
    out one a row only after the windows. A window partition holds one seller's readings, at most one per calendar day,
    however many orders the seller has. Columns besides the series: trailing mean, deviation, count and quartiles, the
    anchor mean and deviation of the first readings, the drift in the bad direction in anchor deviations, and the last
    day before with a drift alarm.

    The cumulative sum c[t] = max(0, c[t-1] + step[t]) equals the running total of the steps minus its running minimum,
    so no row depends on a loop. `keep` names columns of the seller to carry along.
    """
    parts = [_profiled(series, alarm) for series in _readings(spine, metrics, keep)]
    return reduce(DataFrame.unionByName, parts)


def _profiled(series: _Readings, alarm: float) -> DataFrame:
    """The profile of one frame of readings.

    A window copies every column of its rows, so columns end with the step that needs them, the 28 readings before a row
    are taken by the last window, and what one reading is enough for is computed on the long rows, once for all metrics.
    """
    c = F.col
    by_day = _by_day(series.keys)
    upto = by_day.rowsBetween(Window.unboundedPreceding, 0)
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    recent = _trailing(series.keys)
    kept = list(series.frame.columns)
    rates = {x: _is_rate(metrics) for _, metrics, x in series.cells}
    more = [F.row_number().over(by_day).alias("position"), F.count("*").over(whole).alias("n_obs")]
    for x in series.names:
        more.append(F.sum(c(x).cast("double")).over(upto).alias(f"{x}_total"))
        more.append(F.first(c(x).cast("double")).over(upto).alias(f"{x}_first"))
        if rates[x]:
            more.append(F.sum(c(x).cast("decimal(19,0)") * c(x).cast("decimal(19,0)")).over(upto).alias(f"{x}_power"))
    frame = series.frame.select("*", *more)

    anchor_rows = F.least(F.lit(28), F.greatest(F.floor(c("n_obs") / 3), F.lit(5)))
    anchors = []
    for x in series.names:
        early = F.when(c("position") <= anchor_rows, c(x))
        anchors += [F.avg(early).over(whole).alias(f"{x}_anchor"), F.stddev_pop(early).over(whole).alias(f"{x}_spread")]
    # a rate's trailing sums are a difference of running sums, which are exact, not 28 additions a row
    for x in series.names:
        if rates[x]:
            anchors.append(F.lag(f"{x}_total", BASELINE_ROWS + 1).over(by_day).alias(f"{x}_old_total"))
            anchors.append(F.lag(f"{x}_power", BASELINE_ROWS + 1).over(by_day).alias(f"{x}_old_power"))
    frame = frame.select("*", *anchors)
    kept += ["n_obs", *[f"{x}_{end}" for x in series.names for end in ("anchor", "spread")]]
    sums = []
    for x in series.names:
        if rates[x]:
            upto_here, own, old = (F.coalesce(v, F.lit(0.0)) for v in (c(f"{x}_total"), c(x).cast("double"), c(f"{x}_old_total")))
            sums.append((upto_here - own - old).alias(f"{x}_sum"))
            value, none = c(x).cast("decimal(19,0)"), F.lit(0).cast("decimal(38,0)")
            upto_here, own, old = (F.coalesce(v, none) for v in (c(f"{x}_power"), value * value, c(f"{x}_old_power")))
            sums.append((upto_here - own - old).cast("double").alias(f"{x}_squares"))

    steps = c("position").cast("double") - 1.0
    totals = []
    for x in series.names:
        moved, slack = c(f"{x}_total") - c(f"{x}_first"), c(f"{x}_spread") * CUSUM_SLACK
        totals.append((moved - steps * (c(f"{x}_anchor") + slack)).alias(f"{x}_up"))
        totals.append((steps * (c(f"{x}_anchor") - slack) - moved).alias(f"{x}_down"))
    frame = frame.select(*kept, *sums, *totals)
    kept += [f"{x}_{end}" for x in series.names if rates[x] for end in ("sum", "squares")]
    lows = [F.min(f"{x}_{way}").over(upto).alias(f"{x}_{way}_low") for x in series.names for way in ("up", "down")]
    frame = frame.select("*", *lows)
    drifts = []
    for ordinal, metrics, x in series.cells:
        usable = (c("n_obs") >= CUSUM_MIN_OBS) & (c(f"{x}_spread") > 0)
        up, down = (c(f"{x}_{way}") - c(f"{x}_{way}_low") for way in ("up", "down"))
        drifts.append(F.when(usable, F.try_divide(_bad_drift(ordinal, metrics, up, down), c(f"{x}_spread"))).alias(f"{x}_cusum"))
    frame = frame.select(*[name for name in kept if name != "n_obs"], *drifts)

    last = [F.count("*").over(recent).alias("roll_n")]
    last += _trailing_sums(series, [x for x in series.names if not rates[x]])
    for x in series.names:
        last.append(F.max(F.when(above(c(f"{x}_cusum"), alarm), c("metric_date"))).over(before).alias(f"{x}_alarm"))
        last.append(F.collect_list(x).over(recent).alias(f"{x}_recent"))
    fields = {
        "roll_n": lambda x: c("roll_n"),
        "is_rate": lambda x: F.lit(rates[x]),
        "first_sum": lambda x: c(f"{x}_sum") if rates[x] else c(f"{x}_mean"),
        "second_sum": lambda x: c(f"{x}_squares") if rates[x] else c(f"{x}_std"),
        "recent": lambda x: c(f"{x}_recent"),
        "anchor_mean": lambda x: c(f"{x}_anchor"),
        "anchor_std": lambda x: c(f"{x}_spread"),
        "cusum": lambda x: c(f"{x}_cusum"),
        "last_alarm": lambda x: c(f"{x}_alarm"),
    }
    long = series.having(frame.select("*", *last)).long(fields)
    own = ["seller_id", "metric_date", *series.keep, "metric", "units"]
    ends = ["anchor_mean", "anchor_std", "cusum", "last_alarm"]
    mean, std = _mean_and_std(c("first_sum"), c("second_sum"), c("roll_n"))
    # generated columns: a filter on them would otherwise compute them again for each mention
    sorted_recent = F.when(c("roll_n") >= MIN_BASELINE, F.sort_array("recent")).alias("ordered")
    ordered = long.select(*own, "roll_n", "is_rate", "first_sum", "second_sum", *ends, F.inline(F.array(F.struct(sorted_recent))))
    judged = F.struct(
        F.when(c("is_rate"), mean).otherwise(c("first_sum")).alias("roll_mean"),
        F.when(c("is_rate"), std).otherwise(c("second_sum")).alias("roll_std"),
        quartile(c("ordered"), 1).alias("q1"),
        quartile(c("ordered"), 3).alias("q3"),
    )
    return ordered.select(*own, "roll_n", *ends, F.inline(F.array(judged)))


def with_cohort(spine: DataFrame, sellers: DataFrame) -> DataFrame:
    """The spine with each seller's cohort. Right after the spine is built both sides are by seller."""
    return spine.join(sellers.select("seller_id", *COHORT_KEYS), "seller_id")


def cohort_stats(members: DataFrame, metrics=METRICS) -> DataFrame:
    """Peer mean, deviation and count per cohort and day, one wide row with a struct per metric."""
    stats = []
    for m in metrics:
        u = in_units(m)
        stats.append(
            F.struct(F.avg(u).alias("mean"), F.stddev_samp(u).alias("std"), F.count(u).alias("n")).alias(f"_{m.name}")
        )
    return members.groupBy(*COHORT_KEYS, "metric_date").agg(*stats)


def own_peers(metrics=METRICS) -> dict[str, Column]:
    """Peer mean, deviation and count of the row's metric, on rows joined with `cohort_stats`."""
    ends = ("mean", "std", "n")
    return {f"peer_{x}": metric_attribute(F.col("metric"), [F.col(f"_{m.name}.{x}") for m in metrics]) for x in ends}


def cohort_zscore() -> Column:
    return _zscore(F.col("units"), F.col("peer_mean"), F.col("peer_std"), F.col("peer_n"), MIN_PEERS)


def cohort_baseline(members: DataFrame, metrics=METRICS) -> DataFrame:
    """Peer baseline table: one row per seller, day and metric.

    A cohort may hold a large share of the sellers, so its statistics come from a partial
    aggregate and return by a salted join rather than from a window over the cohort.
    """
    unit = unit_of(metrics)
    joined = salted_join(
        members.select("seller_id", "metric_date", *COHORT_KEYS, *[m.name for m in metrics]),
        cohort_stats(members, metrics),
        [*COHORT_KEYS, "metric_date"],
        ["seller_id"],
    )
    cells = [
        F.struct(
            F.lit(i).alias("metric"),
            in_units(m).alias("units"),
            F.col(f"_{m.name}.mean").alias("peer_mean"),
            F.col(f"_{m.name}.std").alias("peer_std"),
            F.col(f"_{m.name}.n").alias("peer_n"),
        )
        for i, m in enumerate(metrics)
    ]
    return (
        joined.select("seller_id", "metric_date", *COHORT_KEYS, F.inline(F.array(*cells)))
        .where("units IS NOT NULL")
        .select(
            "seller_id",
            "metric_date",
            metric_name(metrics).alias("metric_name"),
            (F.col("units") / unit).alias("observed_value"),
            *COHORT_KEYS,
            (F.col("peer_mean") / unit).alias("cohort_mean"),
            (F.col("peer_std") / unit).alias("cohort_std"),
            F.col("peer_n").alias("cohort_n"),
            cohort_zscore().alias("cohort_zscore"),
        )
    )
