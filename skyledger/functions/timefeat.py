"""Time-of-day, season, nearest-measurement and recency features (built-in expressions only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Departure time blocks per time slot. 09:00 belongs to
# "morning"; blocks not listed (and null) map to "unknown".
TIME_SLOTS = [
    ("morning", ["0600-0659", "0700-0759", "0800-0859", "0900-0959"]),
    ("mid-morning", ["1000-1059", "1100-1159"]),
    ("afternoon", ["1200-1259", "1300-1359", "1400-1459"]),
    ("evening", ["1500-1559", "1600-1659", "1700-1759", "1800-1859"]),
    ("night", ["1900-1959", "2000-2059", "2100-2159", "2200-2259", "2300-2359", "0001-0559"]),
]
UNKNOWN = "unknown"

# Meteorological seasons by month number.
SEASONS = [
    ("winter", [12, 1, 2]),
    ("spring", [3, 4, 5]),
    ("summer", [6, 7, 8]),
    ("fall", [9, 10, 11]),
]

# Reference instants for the nearest weather measurement, in
# tie-break order; the last label is the fallback (also for all-null input).
NEAREST_REFERENCES = [
    ("2hr_from_depart", "two_hours_prior_depart_UTC"),
    ("4hr_from_depart", "four_hours_prior_depart_UTC"),
    ("on_depart", "sched_depart_date_time_UTC"),
]


def _lookup(col: Column, table: list, default: str) -> Column:
    expr = None
    for label, members in table:
        cond = col.isin(members)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def with_time_slot(df: DataFrame, block_col: str, out: str = "TIME_SLOT", slots=TIME_SLOTS) -> DataFrame:
    """Map a departure time block label to a time slot."""
    return df.withColumn(out, _lookup(F.col(block_col), slots, UNKNOWN))


def with_season(df: DataFrame, month_col: str, out: str = "SEASON", seasons=SEASONS) -> DataFrame:
    """P5: map a month number to its season."""
    return df.withColumn(out, _lookup(F.col(month_col), seasons, UNKNOWN))


def with_nearest_reference(df: DataFrame, ts_col: str, refs=NEAREST_REFERENCES,
                           delta_out: str = "weather_condition_measured_time_from_depart",
                           label_out: str = "closest_depart_time_weather_measurement") -> DataFrame:
    """Distance (whole seconds) from ``ts_col`` to the closest reference instant, and its label.

    Nulls are skipped by ``least``; ties go to the earliest reference in
    ``refs``; when nothing matches (all null) the last label is used.
    """
    at = lambda c: F.col(c).try_cast("timestamp")  # noqa: E731  text instants count too; what isn't one is null
    deltas = [F.abs(at(ts_col) - at(ref)) for _, ref in refs]
    nearest = F.least(*deltas)
    label = reduce(lambda acc, item: acc.when(nearest == item[1], item[0][0]),
                   zip(refs[1:-1], deltas[1:-1]),
                   F.when(nearest == deltas[0], refs[0][0]))
    label = label.otherwise(refs[-1][0])
    return df.withColumn(label_out, label).withColumn(delta_out, nearest.cast("int"))


def with_recency_days(df: DataFrame, date_col: str, reference_col: str | None = None,
                      out: str = "RecencyDays", latest: Column | None = None) -> DataFrame:
    """Days between ``date_col`` and the latest ``reference_col`` (default: same column).

    The maximum is a scalar subquery, so the plan stays lazy; Spark runs it as
    one partial aggregation over a single column. ``latest`` gives the date
    instead, e.g. one learned from the training years.
    """
    ref = reference_col or date_col
    if latest is None:
        latest = df.select(F.max(F.col(ref).cast("date"))).scalar()
    return df.withColumn(out, F.datediff(latest, F.col(date_col).cast("date")))
