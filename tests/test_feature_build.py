import datetime as dt

from skyledger.plans import fixtures, pipeline


def _flights(spark):
    """Eight flights of own making; the third lacks a needed measure, the fourth a key, the fifth a sparse measure only."""
    t = dt.datetime(2000, 3, 1, 12)
    rows = []
    for i in range(8):
        r = {c: "1.5" for c in pipeline.WEATHER}
        r |= {"FLIGHT_ID": str(i), "FL_DATE": dt.date(2000, 3, 1 + i), "YEAR": 2000, "MONTH": 3, "DAY_OF_MONTH": 1 + i, "OP_UNIQUE_CARRIER": i % 2,
              "OP_CARRIER_FL_NUM": 1, "TAIL_NUM": i, "DEP_DELAY": float(i), "DEP_DEL15": float(i % 3 == 0), "origin_iata_code": i % 3,
              "dest_iata_code": (i + 1) % 3, "origin_type": "large_airport", "sched_depart_date_time_UTC": t, "two_hours_prior_depart_UTC": t,
              "four_hours_prior_depart_UTC": t, "DATE": t, "DEP_TIME_BLK": "1200-1259"}
        rows.append(r)
    rows[2]["HourlyVisibility"] = None
    rows[3]["TAIL_NUM"] = None
    rows[4]["HourlyWindGustSpeed"] = None
    schema = ", ".join(f"{c} " + ("string" if isinstance(v, str) else "date" if type(v) is dt.date else "timestamp_ntz" if isinstance(v, dt.datetime)
                                  else "double" if isinstance(v, float) else "int") for c, v in rows[0].items())
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


def test_summaries_learn_from_a_narrow_table_of_the_same_rows(spark):
    flights = _flights(spark)
    narrow = pipeline.fit_rows(flights)
    assert narrow.columns == [*pipeline.FIT_COLUMNS, "kept"] and narrow.count() == 8
    kept = sorted(r["FL_DATE"] for r in narrow.filter("kept").collect())
    assert kept == sorted(r["FL_DATE"] for r in pipeline.row_features(flights).select("FL_DATE").collect())
    assert [d.day - 1 for d in kept] == [0, 1, 4, 5, 6, 7]


def test_only_wanted_columns_are_written(spark):
    flights = _flights(spark)
    some = ["FLIGHT_ID", "R_Quartile", "airport_rank", "airport_groups"]
    got = pipeline.flight_features(flights, columns=some)
    assert got.columns == some and [f for f in got.schema.names] == some
    assert sorted(r["FLIGHT_ID"] for r in got.collect()) == ["0", "1", "4", "5", "6", "7"]


def test_line_items_meet_orders_that_know_their_customers():
    assert "JOIN (orders JOIN customer ON o_custkey = c_custkey)" in fixtures.flights_sql("spark")
    assert "JOIN (orders" not in fixtures.flights_sql("duckdb")
