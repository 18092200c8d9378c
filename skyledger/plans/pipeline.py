"""The end-to-end feature build: raw flight facts -> model-ready train/test frames.

What is learned from data (latest date, RFM scores with their cut points,
centralities, volume groups, category indexes, scaling, PCA) is fitted on
one set of rows, by default the training years, kept as small tables, and
applied to any rows by joins. No learned value passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, timefeat
from ..operators import clean, features, graph, groups, rfm, sampling
from ..session import discard, materialise
from .columns import (CARRIER_KEYS, CATEGORICAL_FEATURES, CORRELATION_FEATURES, FEATURES, LABEL,  # noqa: F401
                      NUMERIC_FEATURES, ONEHOT_FEATURES, REQUIRED, SPARSE, WEATHER)

#: Years of the generated holiday calendar (about a dozen rows each): no pass over the facts to learn them.
CALENDAR_YEARS = (1970, 2070)
CENTRALITIES = ["degree_centrality", "betweenness_centrality", "closeness_centrality"]


#: Columns that :meth:`Summaries.fit` learns from.
FIT_COLUMNS = ["FL_DATE", *CARRIER_KEYS, "DEP_DELAY", LABEL, "origin_iata_code", "dest_iata_code", "origin_type"]
#: Columns that models and their evaluation read; those of the feature table that queries don't ask for aren't written.
MODEL_COLUMNS = list(dict.fromkeys(["FLIGHT_ID", "YEAR", "FL_DATE", LABEL, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES]))


def _complete():
    """Whether no needed measure is missing, after lenient casts."""
    # One predicate instead of a conjunction: from 17 IsNotNull terms over computed columns the
    # optimiser would infer constraints through every later step, which takes it minutes.
    missing = F.array(*[F.col(c).isNull() for c in REQUIRED + [c for c in WEATHER if c not in SPARSE]])
    return ~F.array_contains(missing, True)


def fit_rows(flights: DataFrame) -> DataFrame:
    """:data:`FIT_COLUMNS` of all rows and ``kept``: whether :func:`row_features` keeps the row."""
    return clean.cast_numeric(flights, WEATHER).withColumn("kept", _complete()).select(*FIT_COLUMNS, "kept")


def row_features(flights: DataFrame) -> DataFrame:
    """Features of a row by itself: calendar flags, time slot, season, nearest measurement, lenient
    casts; rows with missing measures are dropped (SURVEY Q10)."""
    df = clean.cast_numeric(flights, WEATHER).drop(*SPARSE)
    df = df.filter(_complete())
    cal = calendar.us_holidays(flights.sparkSession, *CALENDAR_YEARS)
    df = calendar.with_holiday_flag(df, "FL_DATE", cal)
    df = calendar.with_holiday_rush(df, "FL_DATE", cal)
    df = timefeat.with_time_slot(df, "DEP_TIME_BLK")
    df = timefeat.with_season(df, "MONTH")
    return timefeat.with_nearest_reference(df, "DATE")


@dataclass
class Summaries:
    """Learned tables: ``fit`` reads training rows, ``apply`` serves any rows, ``save`` / ``load`` keep them.

    latest: one row (latest date); scores: RFM and letters per carrier and
    flight number; central: centralities per airport; airports, carriers:
    volume groups.
    """

    latest: DataFrame
    scores: DataFrame
    central: DataFrame
    airports: DataFrame
    carriers: DataFrame
    large_only: bool = True

    @classmethod
    def fit(cls, flights: DataFrame, large_only: bool = True, method: str = "bracket") -> Summaries:
        """Learn from the rows of ``flights``: the few columns that summaries need are written once, all of them read that table.

        ``kept`` marks the rows that :func:`row_features` keeps.
        """
        flights = materialise(fit_rows(flights), wide=True)
        latest = materialise(flights.agg(F.max(F.col("FL_DATE").cast("date")).alias("latest")))
        dated = timefeat.with_recency_days(flights, "FL_DATE", latest=latest.select("latest").scalar())
        scores = materialise(rfm.rfm_quartiles(rfm.rfm_table(dated, CARRIER_KEYS), materialise=True, method=method))
        central = graph.centralities(*graph.build_graph(flights, "origin_iata_code", "dest_iata_code"))
        kept = flights.filter("kept").join(scores.select(*CARRIER_KEYS), CARRIER_KEYS, "left_semi")
        if large_only:
            kept = clean.filter_equals(kept, "origin_type", "large_airport")
        volumes = materialise(kept.groupBy("origin_iata_code", "OP_UNIQUE_CARRIER").agg(F.count(F.lit(1)).alias("rows")), wide=True)

        def lettered(key: str, out: str, scheme):
            counts = volumes.groupBy(key).agg(F.sum("rows").alias("count"))
            return materialise(groups.quantile_bin(counts, "count", out, *scheme, method=method))
        learned = cls(latest, scores, central, lettered("origin_iata_code", "airport_groups", groups.AIRPORT_GROUPS),
                      lettered("OP_UNIQUE_CARRIER", "carrier_groups", groups.CARRIER_GROUPS), large_only)
        discard(flights)
        return learned

    def apply(self, flights: DataFrame) -> DataFrame:
        """Feature table of ``flights``, one row per kept flight.

        Flights of groups without a delay at fit time are dropped, as the
        reference's inner join does; airports unseen at fit time have
        centrality 0, and airports and carriers unseen then a null group.
        """
        df = timefeat.with_recency_days(row_features(flights), "FL_DATE", latest=self.latest.select("latest").scalar())
        df = rfm.attach_rfm(df, self.scores, CARRIER_KEYS, how="inner")
        if self.large_only:
            df = clean.filter_equals(df, "origin_type", "large_airport")
        # 12 digits: airports of equal rank differ by the order of sums only, which scaling would blow up.
        central = self.central.select("id", *[F.round(c, 12).alias(c) for c in CENTRALITIES])
        df = graph.with_vertex_scores(df, central, "origin_iata_code").na.fill(0.0, CENTRALITIES)
        df = clean.with_rank(df, CENTRALITIES)
        df = groups.attach_groups(df, self.airports, "origin_iata_code")
        return groups.attach_groups(df, self.carriers, "OP_UNIQUE_CARRIER")

    def save(self, path: str) -> None:
        for f in fields(self):
            value = getattr(self, f.name)
            if isinstance(value, DataFrame):
                value.write.mode("overwrite").parquet(f"{path}/{f.name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, large_only: bool = True) -> Summaries:
        names = [f.name for f in fields(cls) if f.name != "large_only"]
        return cls(*[spark.read.parquet(f"{path}/{n}") for n in names], large_only)


def flight_features(flights: DataFrame, fit_on: DataFrame | None = None, large_only: bool = True,
                    columns: list[str] | None = None) -> DataFrame:
    """Feature table of ``flights``; summaries are learned from ``fit_on``. ``columns``: those to write (default: all).

    Without ``fit_on`` they are learned from all rows: the reference's own way
    (parity mode), which lets the test years' labels into training rows.
    """
    out = Summaries.fit(fit_on if fit_on is not None else flights, large_only).apply(flights)
    return materialise(out.select(*(columns or out.columns)), wide=True)


def split_years(df: DataFrame, train_years: list[int], test_years: list[int]) -> tuple[DataFrame, DataFrame]:
    return sampling.time_split(df, "YEAR", train_years, test_years)


def split_features(flights: DataFrame, train_years: list[int], test_years: list[int],
                   columns: list[str] | None = None) -> tuple[DataFrame, DataFrame, Summaries]:
    """Features of both splits with summaries learned from the training years only; written once.

    ``columns``: those to write, ``YEAR`` among them (default: all).
    """
    train, test = split_years(flights, train_years, test_years)
    learned = Summaries.fit(train)
    feats = learned.apply(sampling.union_all([train, test]))
    feats = materialise(feats.select(*(columns or feats.columns)), wide=True)
    return *split_years(feats, train_years, test_years), learned


def model_frames(flights: DataFrame, train_years: list[int], test_years: list[int],
                 standard_scale: bool = True, pca_k: int | None = 10, keep: list[str] = ("FLIGHT_ID",)):
    """Train / test frames with ``input_features`` and the label; the fitted
    encoder and feature pipelines are returned too, for scoring new data."""
    columns = list(dict.fromkeys([*keep, *MODEL_COLUMNS]))
    train, test, _ = split_features(flights, train_years, test_years, columns)
    encoder = features.one_hot(CATEGORICAL_FEATURES, handle_invalid="keep").fit(train)
    train, test = encoder.transform(train), encoder.transform(test)
    train_va, test_va, prep = features.prepare_features(train, test, NUMERIC_FEATURES, ONEHOT_FEATURES,
                                                        standard_scale, pca_k)
    cols = [*keep, "YEAR", "FL_DATE", LABEL, FEATURES]
    return train_va.select(*cols), test_va.select(*cols), encoder, prep
