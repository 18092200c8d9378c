"""Fixture views over the driver's tables (FIXTURES.md section 2).

Each view is written once as SQL text with a few engine-specific snippets, so
Spark and DuckDB read *the same inputs*; the operators under test and their
oracles are written independently of each other.

Spark builds the views from parquet scans with explicit column lists, so
column pruning and filter push-down reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# The columns that the fixture views read.
REQUIRED = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey", "o_totalprice"],
    "customer": ["c_custkey", "c_nationkey", "c_acctbal"],
    "supplier": ["s_suppkey", "s_nationkey", "s_acctbal"],
    "events": ["event_id", "user_id", "ts"],
    "embeddings": ["vec_id", "embedding", "label"],
    "labels": ["doc_id", "quality", "toxic"],
}


# name -> expression; a dict value holds per-engine variants.
_HOUR = {"spark": "INTERVAL '1' HOUR * cast({n} as int)", "duckdb": "to_hours(cast({n} as int))"}
_MINUTE = {"spark": "INTERVAL '1' MINUTE * cast({n} as int)", "duckdb": "to_minutes(cast({n} as int))"}


def _hours(engine: str, n: str) -> str:
    return _HOUR[engine].format(n=n)


def _minutes(engine: str, n: str) -> str:
    return _MINUTE[engine].format(n=n)


def _block(hour: str) -> str:
    return (f"case when {hour} < 6 then '0001-0559' else lpad(cast({hour} as string), 2, '0') || '00-' || "
            f"lpad(cast({hour} as string), 2, '0') || '59' end")


def flights_columns(engine: str) -> list[tuple[str, str]]:
    sched = f"(l_shipdate + {_hours(engine, 'l_partkey % 24')})"
    return [
        ("FLIGHT_ID", "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), "
                      "cast(l_partkey as string), cast(l_suppkey as string), cast(cast(l_quantity as bigint) as string))"),
        ("FL_DATE", "cast(l_shipdate as date)"),
        ("YEAR", "cast(year(l_shipdate) as int)"),
        ("MONTH", "cast(month(l_shipdate) as int)"),
        ("DAY_OF_MONTH", "cast(dayofmonth(l_shipdate) as int)"),
        ("OP_UNIQUE_CARRIER", "l_suppkey"),
        ("OP_CARRIER_FL_NUM", "l_linenumber"),
        ("TAIL_NUM", "l_partkey"),
        ("DEP_DELAY", "cast(l_quantity - 25 as double)"),
        ("DEP_DEL15", "cast(case when l_quantity - 25 >= 15 then 1 else 0 end as double)"),
        ("origin_iata_code", "s_nationkey"),
        ("dest_iata_code", "c_nationkey"),
        ("origin_type", "case when s_nationkey % 4 <> 0 then 'large_airport' else 'medium_airport' end"),
        ("Distance", "cast(abs(s_nationkey - c_nationkey) * 100 + 50 as double)"),
        ("sched_depart_date_time_UTC", sched),
        ("two_hours_prior_depart_UTC", f"({sched} - {_hours(engine, '2')})"),
        ("four_hours_prior_depart_UTC", f"({sched} - {_hours(engine, '4')})"),
        ("DATE", f"(l_shipdate + {_hours(engine, 'l_suppkey % 24')} + {_minutes(engine, 'l_orderkey % 60')})"),
        ("DEP_TIME_BLK", _block("hour(" + sched + ")")),
        ("HourlyPrecipitation", "case when l_linenumber = 3 then 'T' else cast(l_quantity as string) end"),
        ("HourlyDryBulbTemperature", "l_extendedprice"),
        ("HourlyPressureChange", "nullif(abs(l_discount), 0.0)"),
        ("HourlyRelativeHumidity", "l_tax"),
        ("HourlySeaLevelPressure", "o_totalprice"),
        ("HourlyStationPressure", "c_acctbal"),
        ("HourlyVisibility", "s_acctbal"),
        ("HourlyWindGustSpeed", "nullif(abs(l_tax), 0.0)"),
        ("HourlyWindSpeed", "abs(l_discount) * 100"),
        ("ELEVATION", "cast(s_nationkey * 100 as double)"),
    ]


_FLIGHTS_FROM = ("lineitem JOIN orders ON l_orderkey = o_orderkey "
                 "JOIN customer ON o_custkey = c_custkey "
                 "JOIN supplier ON l_suppkey = s_suppkey")

from .columns import CARRIER_KEYS, SPARSE as SPARSE_WEATHER, WEATHER as WEATHER_COLUMNS  # noqa: E402, F401

SELF_JOIN_KEYS = ["FL_DATE", "OP_UNIQUE_CARRIER", "TAIL_NUM", "OP_CARRIER_FL_NUM", "sched_depart_date_time_UTC"]
TRAIN_YEARS = [1995, 1996, 1997, 1998, 1999, 2000]
TEST_YEARS = [2001]


# The same rows, joined from the small side: orders meet their customers first, so the many line items move once
# for both, and not again by customer.
_FLIGHTS_FROM_SMALL = ("lineitem JOIN (orders JOIN customer ON o_custkey = c_custkey) ON l_orderkey = o_orderkey "
                       "JOIN supplier ON l_suppkey = s_suppkey")


def flights_sql(engine: str) -> str:
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in flights_columns(engine))
    return f"SELECT\n  {cols}\nFROM {_FLIGHTS_FROM_SMALL if engine == 'spark' else _FLIGHTS_FROM}"


def measure_sql(engine: str) -> str:
    day = "cast(cast(ts as date) as timestamp_ntz)" if engine == "spark" else "cast(cast(ts as date) as timestamp)"
    sched = f"({day} + {_hours(engine, 'user_id % 24')})"
    return (f"SELECT event_id, ts AS DATE, {sched} AS sched_depart_date_time_UTC, "
            f"({sched} - {_hours(engine, '2')}) AS two_hours_prior_depart_UTC, "
            f"({sched} - {_hours(engine, '4')}) AS four_hours_prior_depart_UTC FROM events")


def slot_sql(engine: str) -> str:
    return f"SELECT event_id, {_block('hour(ts)')} AS DEP_TIME_BLK FROM events"


def routes_sql(engine: str) -> str:
    return ("SELECT DISTINCT origin_iata_code AS src, dest_iata_code AS dst FROM flights_fx "
            "WHERE (origin_iata_code * 7 + dest_iata_code * 3) % 11 < 2 AND origin_iata_code <> dest_iata_code")


def metrics_sql(engine: str) -> str:
    return ("SELECT FLIGHT_ID, HourlyDryBulbTemperature AS score, "
            "cast(case when HourlyWindSpeed >= 8 then 1 else 0 end as double) AS prediction, "
            "DEP_DEL15 AS label FROM flights_fx")


# view name -> (builder, dependencies)
VIEWS = {
    "flights_fx": (flights_sql, ()),
    "measure_fx": (measure_sql, ()),
    "slot_fx": (slot_sql, ()),
    "routes_fx": (routes_sql, ("flights_fx",)),
    "metrics_fx": (metrics_sql, ("flights_fx",)),
}

_REGISTERED: dict[tuple[int, str], str] = {}


def register_views(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Register base tables and fixture views as Spark temp views; return names.

    Views are lazy: a query that uses three columns of ``flights_fx`` scans
    only the parquet columns behind those three. Registration is skipped when
    this session already points the views at ``sf_dir``.
    """
    key = (id(spark), spark.sparkContext.applicationId)
    names = {n: n for n in list(TABLES) + list(VIEWS)}
    if _REGISTERED.get(key) == sf_dir and all(spark.catalog.tableExists(n) for n in ("flights_fx", "lineitem")):
        return names
    names = {}
    for name in TABLES:
        read_table(spark, sf_dir, f"{name}.parquet", required=REQUIRED.get(name)).createOrReplaceTempView(name)
        names[name] = name
    for view, (builder, _deps) in VIEWS.items():
        spark.sql(builder("spark")).createOrReplaceTempView(view)
        names[view] = view
    _REGISTERED[key] = sf_dir
    return names


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view (registers all views for the given scale factor)."""
    register_views(spark, sf_dir)
    return spark.table(name)


def duckdb_with(*views: str, recursive: bool = False) -> str:
    """A ``WITH`` clause defining the named fixture views (and dependencies) for DuckDB."""
    order: list[str] = []

    def visit(v: str) -> None:
        for dep in VIEWS[v][1]:
            visit(dep)
        if v not in order:
            order.append(v)

    for v in views:
        visit(v)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{v} AS (\n{VIEWS[v][0]('duckdb')}\n)" for v in order) + "\n"
