import datetime as dt

from skyledger.functions import timefeat


def test_time_slot_boundaries(spark):
    blocks = ["0600-0659", "0900-0959", "1000-1059", "1459-1459", "1800-1859", "0001-0559", "2300-2359", None]
    df = spark.createDataFrame([(b,) for b in blocks], "b string")
    got = dict(timefeat.with_time_slot(df, "b").collect())
    assert got["0900-0959"] == "morning"
    assert got["1000-1059"] == "mid-morning"
    assert got["1459-1459"] == "unknown"
    assert got["0001-0559"] == "night"
    assert got[None] == "unknown"


def test_season(spark):
    df = spark.createDataFrame([(m,) for m in [1, 3, 6, 9, 12, 13, None]], "m int")
    got = dict(timefeat.with_season(df, "m").collect())
    assert got == {1: "winter", 3: "spring", 6: "summer", 9: "fall", 12: "winter", 13: "unknown", None: "unknown"}


def test_nearest_reference_ties_and_nulls(spark):
    t = dt.datetime(2024, 1, 1, 12, 0, 0)
    h = dt.timedelta(hours=1)
    rows = [
        (1, t, t + 2 * h, t - 1 * h, t + 1 * h),          # 2h and 4h refs tie at 1h -> 2h label
        (2, t, t + 30 * dt.timedelta(minutes=1), t - 3 * h, t + 5 * h),  # on_depart closest, 1800 s
        (3, None, t, t, t),                                # no measurement -> on_depart, null delta
        (4, t, None, None, t + dt.timedelta(seconds=1.9)),  # nulls skipped (only the 4h ref); fractions truncate
    ]
    df = spark.createDataFrame(rows, "id int, DATE timestamp_ntz, sched_depart_date_time_UTC timestamp_ntz, "
                                     "two_hours_prior_depart_UTC timestamp_ntz, four_hours_prior_depart_UTC timestamp_ntz")
    out = timefeat.with_nearest_reference(df, "DATE")
    got = {r["id"]: (r["closest_depart_time_weather_measurement"], r["weather_condition_measured_time_from_depart"])
           for r in out.collect()}
    assert got[1] == ("2hr_from_depart", 3600)
    assert got[2] == ("on_depart", 1800)
    assert got[3] == ("on_depart", None)
    assert got[4] == ("4hr_from_depart", 1)


def test_recency_days(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 1, 11),), (None,)], "d date")
    got = sorted(r[0] for r in timefeat.with_recency_days(df, "d").select("RecencyDays").collect() if r[0] is not None)
    assert got == [0, 10]
