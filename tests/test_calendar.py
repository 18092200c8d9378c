import datetime as dt

from pyspark.sql import functions as F

from skyledger.functions import calendar


def _dates(df):
    return {r[0] for r in df.select("holiday_date").collect()}


def test_federal_holidays_2019(spark):
    got = _dates(calendar.us_holidays(spark, 2019, 2019))
    want = {dt.date(2019, 1, 1), dt.date(2019, 1, 21), dt.date(2019, 2, 18), dt.date(2019, 5, 27),
            dt.date(2019, 7, 4), dt.date(2019, 9, 2), dt.date(2019, 10, 14), dt.date(2019, 11, 11),
            dt.date(2019, 11, 12),  # Veterans Day on Monday? no: 11 Nov 2019 is a Monday
            dt.date(2019, 11, 28), dt.date(2019, 12, 25)}
    want.discard(dt.date(2019, 11, 12))
    assert got == want


def test_observed_shifts(spark):
    got = _dates(calendar.us_holidays(spark, 2020, 2022))
    assert dt.date(2020, 7, 3) in got        # 4 July 2020 was a Saturday
    assert dt.date(2021, 12, 31) in got      # 1 January 2022 was a Saturday
    assert dt.date(2021, 6, 18) in got       # Juneteenth 2021 (Saturday) observed Friday
    assert dt.date(2022, 12, 26) in got      # Christmas 2022 (Sunday) observed Monday
    assert dt.date(2020, 6, 19) not in got   # Juneteenth starts in 2021


def test_flags_null_date_and_rush(spark):
    rows = [(1, dt.date(2019, 12, 25)), (2, dt.date(2019, 12, 23)), (3, dt.date(2019, 12, 20)), (4, None)]
    df = spark.createDataFrame(rows, "id int, d date")
    cal = calendar.us_holidays(spark, 2019, 2020)
    out = calendar.with_holiday_rush(calendar.with_holiday_flag(df, "d", cal), "d", cal, days=2)
    got = {r["id"]: (r["IS_HOLIDAY"], r["HOLIDAY_RUSH"]) for r in out.collect()}
    assert got == {1: (1, 1), 2: (0, 1), 3: (0, 0), 4: (0, 0)}
    assert out.schema["IS_HOLIDAY"].dataType.simpleString() == "int"


def test_calendar_from_data_years(spark):
    df = spark.createDataFrame([(dt.date(1999, 5, 1),), (dt.date(2000, 2, 1),)], "d date")
    got = _dates(calendar.calendar_for(df, "d"))
    assert dt.date(1999, 12, 31) in got      # 1 January 2000 was a Saturday
    assert min(got).year == 1999 and max(got).year == 2001
