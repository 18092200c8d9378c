"""US federal holiday calendar and holiday flags (no Python UDFs).

The calendar is generated on Spark from rule rows: fixed dates, n-th weekday
of a month and last weekday of a month, plus the weekend "observed" shift.
Its size is about 20 rows per calendar year, so it is always safe to
broadcast: the bound is the year span of the data, not the row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spark dayofweek numbering: 1 = Sunday ... 7 = Saturday.
SUNDAY, MONDAY, THURSDAY, SATURDAY = 1, 2, 5, 7

# US federal holidays (title 5 U.S. Code 6103) and the first
# year each rule applies in this form.
# (name, month, rule, day of month or weekday, n-th occurrence, first year)
#   rule "date": fixed calendar date; "nth": n-th weekday; "last": last weekday.
FEDERAL_HOLIDAYS = [
    ("New Year's Day", 1, "date", 1, 0, 1871),
    ("Martin Luther King Jr. Day", 1, "nth", MONDAY, 3, 1986),
    ("Washington's Birthday", 2, "nth", MONDAY, 3, 1971),
    ("Memorial Day", 5, "last", MONDAY, 0, 1971),
    ("Juneteenth National Independence Day", 6, "date", 19, 0, 2021),
    ("Independence Day", 7, "date", 4, 0, 1871),
    ("Labor Day", 9, "nth", MONDAY, 1, 1894),
    ("Columbus Day", 10, "nth", MONDAY, 2, 1971),
    ("Veterans Day", 11, "date", 11, 0, 1978),
    ("Thanksgiving", 11, "nth", THURSDAY, 4, 1942),
    ("Christmas Day", 12, "date", 25, 0, 1871),
]
OBSERVED_SUFFIX = " (observed)"


def _rule_array() -> Column:
    return F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(month).alias("month"), F.lit(rule).alias("rule"),
                 F.lit(arg).alias("arg"), F.lit(nth).alias("nth"), F.lit(first).alias("first_year"))
        for name, month, rule, arg, nth, first in FEDERAL_HOLIDAYS
    ])


def holidays_for_years(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Holiday dates ``(holiday_date date, name string)`` for every year in ``years``.

    Observed days (Saturday -> Friday before, Sunday -> Monday after) are extra
    rows. Only dates that fall inside the given years are returned, so a
    Saturday New Year's Day of year y+1 shows up as 31 December of y when y+1
    is present in ``years``.
    """
    y = F.col("__y")
    rules = years.select(F.col(year_col).cast("int").alias("__y")).distinct() \
        .select(y, F.explode(_rule_array()).alias("r")) \
        .filter(y >= F.col("r.first_year"))
    first = F.make_date(y, F.col("r.month"), F.lit(1))
    nth_day = F.date_add(first, (F.col("r.arg") - F.dayofweek(first) + 7) % 7 + (F.col("r.nth") - 1) * 7)
    last = F.last_day(first)
    last_day = F.date_sub(last, (F.dayofweek(last) - F.col("r.arg") + 7) % 7)
    actual = (F.when(F.col("r.rule") == "date", F.make_date(y, F.col("r.month"), F.col("r.arg")))
              .when(F.col("r.rule") == "nth", nth_day)
              .otherwise(last_day))
    dated = rules.select(y, F.col("r.name").alias("name"), actual.alias("d"))
    observed = (F.when(F.dayofweek("d") == SATURDAY, F.date_sub("d", 1))
                .when(F.dayofweek("d") == SUNDAY, F.date_add("d", 1)))
    both = dated.select(
        F.explode(F.array(
            F.struct(F.col("d").alias("holiday_date"), F.col("name")),
            F.struct(observed.alias("holiday_date"), F.concat(F.col("name"), F.lit(OBSERVED_SUFFIX)).alias("name")),
        )).alias("h"))
    out = both.select("h.holiday_date", "h.name").filter(F.col("holiday_date").isNotNull())
    return out.join(years.select(F.col(year_col).cast("int").alias("__y")).distinct(),
                    F.year("holiday_date") == F.col("__y"), "left_semi")


def year_span(spark: SparkSession, year_from: int, year_to: int) -> DataFrame:
    """Years ``year_from..year_to`` plus the following year (for observed New Year's Eve)."""
    return spark.range(year_from, year_to + 1).select(F.col("id").cast("int").alias("year"))


def us_holidays(spark: SparkSession, year_from: int, year_to: int) -> DataFrame:
    """The federal holiday calendar for ``year_from..year_to`` (inclusive)."""
    years = year_span(spark, year_from, year_to + 1)
    cal = holidays_for_years(years)
    return cal.filter(F.year("holiday_date").between(year_from, year_to))


def data_years(df: DataFrame, date_col: str) -> DataFrame:
    """The years spanned by ``date_col`` (plus one), derived lazily from the data."""
    span = df.agg(F.min(F.year(date_col)).alias("lo"), F.max(F.year(date_col)).alias("hi"))
    return span.select(F.explode(F.sequence(F.col("lo"), F.col("hi") + 1)).alias("year"))


def calendar_for(df: DataFrame, date_col: str) -> DataFrame:
    """The holiday calendar covering the years present in ``df[date_col]``."""
    return holidays_for_years(data_years(df, date_col))


def with_holiday_flag(df: DataFrame, date_col: str, holidays: DataFrame | None = None,
                      out: str = "IS_HOLIDAY") -> DataFrame:
    """``out`` = 1 when ``date_col`` is a holiday (actual or observed), else 0; null -> 0."""
    cal = holidays if holidays is not None else calendar_for(df, date_col)
    days = cal.select(F.col("holiday_date").alias("__hd")).distinct()
    joined = df.join(F.broadcast(days), F.col(date_col).cast("date") == F.col("__hd"), "left")
    return joined.withColumn(out, F.when(F.col("__hd").isNotNull(), 1).otherwise(0).cast("int")).drop("__hd")


def with_holiday_rush(df: DataFrame, date_col: str, holidays: DataFrame | None = None,
                      days: int = 2, out: str = "HOLIDAY_RUSH") -> DataFrame:
    """``out`` = 1 when a holiday lies within ``days`` days of ``date_col``, else 0."""
    cal = holidays if holidays is not None else calendar_for(df, date_col)
    near = cal.select(F.explode(F.sequence(F.date_sub("holiday_date", days), F.date_add("holiday_date", days)))
                      .alias("__rd")).distinct()
    joined = df.join(F.broadcast(near), F.col(date_col).cast("date") == F.col("__rd"), "left")
    return joined.withColumn(out, F.when(F.col("__rd").isNotNull(), 1).otherwise(0).cast("int")).drop("__rd")
