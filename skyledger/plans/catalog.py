"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the fixture views), runs over
whole tables, and aliases each computed column to the name its DuckDB oracle
uses. Floats leave rounded to 6 digits so the engines compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, timefeat
from ..operators import clean, groups, quantile, rfm
from ..session import apply_runtime_defaults, materialise
from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ROUND = 6


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, cols: list[str], digits: int = ROUND) -> DataFrame:
    wanted = set(cols)
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in wanted else F.col(c) for c in df.columns])


def views(spark: SparkSession, sf_dir: str) -> None:
    apply_runtime_defaults(spark)
    fx.register_views(spark, sf_dir)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir)
    return spark.table("flights_fx")


def flights_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights with the weather measures cast leniently to double."""
    return clean.cast_numeric(flights(spark, sf_dir), fx.WEATHER_COLUMNS)


def flights_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timefeat.with_recency_days(flights(spark, sf_dir), "FL_DATE")


def rfm_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_table(flights_recency(spark, sf_dir), fx.CARRIER_KEYS)


def large_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.filter_equals(flights(spark, sf_dir), "origin_type", "large_airport")


# ---------------------------------------------------------------- step 1-2: relational features

@query
def year_counts(spark, sf_dir):
    return groups.count_by(flights(spark, sf_dir), "YEAR")


@query
def label_balance(spark, sf_dir):
    return rounded(clean.label_balance(flights(spark, sf_dir), "DEP_DEL15", 1), ["pct_positive"])


@query
def holiday_calendar(spark, sf_dir):
    return calendar.calendar_for(flights(spark, sf_dir), "FL_DATE")


@query
def holiday_flag(spark, sf_dir):
    df = calendar.with_holiday_flag(flights(spark, sf_dir), "FL_DATE")
    return df.select("FLIGHT_ID", "FL_DATE", "IS_HOLIDAY")


@query
def holiday_rush(spark, sf_dir):
    df = calendar.with_holiday_rush(flights(spark, sf_dir), "FL_DATE", days=2)
    return df.select("FLIGHT_ID", "FL_DATE", "HOLIDAY_RUSH")


@query
def time_slot(spark, sf_dir):
    views(spark, sf_dir)
    return timefeat.with_time_slot(spark.table("slot_fx"), "DEP_TIME_BLK")


@query
def season(spark, sf_dir):
    return timefeat.with_season(flights(spark, sf_dir), "MONTH").select("FLIGHT_ID", "MONTH", "SEASON")


@query
def nearest_reference(spark, sf_dir):
    views(spark, sf_dir)
    df = timefeat.with_nearest_reference(spark.table("measure_fx"), "DATE")
    return df.select("event_id", "weather_condition_measured_time_from_depart",
                     "closest_depart_time_weather_measurement")


@query
def recency_days(spark, sf_dir):
    return flights_recency(spark, sf_dir).select("FLIGHT_ID", "FL_DATE", "RecencyDays")


@query
def rfm_table(spark, sf_dir):
    return rounded(rfm_of(spark, sf_dir), ["Monetary", "Frequency"])


@query
def rfm_quartiles(spark, sf_dir):
    return rounded(rfm.rfm_quartiles(rfm_of(spark, sf_dir), materialise=True), ["Monetary", "Frequency"])


@query
def cast_numeric(spark, sf_dir):
    df = flights_numeric(spark, sf_dir).select("FLIGHT_ID", *fx.WEATHER_COLUMNS)
    return rounded(df, fx.WEATHER_COLUMNS)


def _complete(spark, sf_dir, keys):
    return clean.drop_incomplete(flights_numeric(spark, sf_dir), keys, fx.WEATHER_COLUMNS, fx.SPARSE_WEATHER)


@query
def drop_incomplete(spark, sf_dir):
    keys = ["FLIGHT_ID"] + fx.SELF_JOIN_KEYS + ["DEP_DEL15"]
    df = _complete(spark, sf_dir, keys)
    return rounded(df, [c for c in fx.WEATHER_COLUMNS if c not in fx.SPARSE_WEATHER])


@query
def large_only(spark, sf_dir):
    return large_flights(spark, sf_dir).select("FLIGHT_ID", "origin_iata_code", "origin_type")


@query
def enrich_self(spark, sf_dir):
    sub = _complete(spark, sf_dir, fx.SELF_JOIN_KEYS + ["DEP_DEL15"])
    full = flights(spark, sf_dir)
    out = clean.enrich_self(sub, full, fx.SELF_JOIN_KEYS, drop_right=fx.WEATHER_COLUMNS + ["DEP_DEL15"])
    return out.select(*fx.SELF_JOIN_KEYS, "DEP_DEL15", "HourlyPrecipitation", "FLIGHT_ID", "origin_iata_code", "YEAR")


@query
def attach_rfm(spark, sf_dir):
    facts = flights(spark, sf_dir).select("FLIGHT_ID", *fx.CARRIER_KEYS)
    out = rfm.attach_rfm(facts, rfm_of(spark, sf_dir), fx.CARRIER_KEYS)
    return rounded(out, ["Monetary", "Frequency"])


@query
def airport_groups(spark, sf_dir):
    return groups.airport_groups(large_flights(spark, sf_dir), materialise=True)


@query
def carrier_groups(spark, sf_dir):
    return groups.carrier_groups(large_flights(spark, sf_dir), materialise=True)


@query
def attach_groups(spark, sf_dir):
    facts = large_flights(spark, sf_dir)
    out = groups.attach_groups(facts, groups.airport_groups(facts, materialise=True), "origin_iata_code")
    out = groups.attach_groups(out, groups.carrier_groups(facts, materialise=True), "OP_UNIQUE_CARRIER")
    return out.select("FLIGHT_ID", "origin_iata_code", "OP_UNIQUE_CARRIER", "airport_groups", "carrier_groups")


@query
def quantile_cuts(spark, sf_dir):
    volumes = groups.count_by(flights(spark, sf_dir), "OP_UNIQUE_CARRIER")
    return quantile.quantile_cuts(volumes, "count", [0.0, 0.25, 0.5, 0.75, 1.0])


@query
def class_counts(spark, sf_dir):
    views(spark, sf_dir)
    return groups.count_by(spark.table("labels"), "quality")


# ---------------------------------------------------------------- step 3: splits, folds, metrics

from ..operators import metrics, ordering, sampling  # noqa: E402
from . import models  # noqa: E402


@query
def time_split(spark, sf_dir):
    train, test = sampling.time_split(flights(spark, sf_dir), "YEAR", fx.TRAIN_YEARS, fx.TEST_YEARS)
    return sampling.union_all([train.select("FLIGHT_ID", "YEAR", F.lit("train").alias("split")),
                               test.select("FLIGHT_ID", "YEAR", F.lit("test").alias("split"))])


@query
def random_split_md5(spark, sf_dir):
    df = sampling.with_random_split(flights(spark, sf_dir), [0.8, 0.2], 512, ["FLIGHT_ID"], names=["train", "test"])
    return df.select("FLIGHT_ID", "split")


@query
def upsample(spark, sf_dir):
    return sampling.upsample(flights(spark, sf_dir).select("FLIGHT_ID", "DEP_DEL15"), "DEP_DEL15")


@query
def downsample_md5(spark, sf_dir):
    return sampling.downsample(flights(spark, sf_dir).select("FLIGHT_ID", "DEP_DEL15"), "DEP_DEL15",
                               seed=541, key=["FLIGHT_ID"])


@query
def downsample_exact(spark, sf_dir):
    """As many rows of the larger class as the smaller one has."""
    return sampling.downsample(flights(spark, sf_dir).select("FLIGHT_ID", "DEP_DEL15"), "DEP_DEL15",
                               seed=541, key=["FLIGHT_ID"], exact=True)


@query
def downsample_by_year(spark, sf_dir):
    """Within each year as many rows of the larger class as the smaller one has."""
    df = flights(spark, sf_dir).select("FLIGHT_ID", "YEAR", "DEP_DEL15")
    return sampling.rebalance_by(df, ["YEAR"], "DEP_DEL15", "downsample_exact", key=["FLIGHT_ID"])


@query
def rebalance_by_year(spark, sf_dir):
    df = flights(spark, sf_dir).select("FLIGHT_ID", "YEAR", "DEP_DEL15")
    return sampling.rebalance_by(df, ["YEAR"], "DEP_DEL15", "upsample")


@query
def global_row_id(spark, sf_dir):
    df = flights(spark, sf_dir).select("FLIGHT_ID", "FL_DATE")
    return ordering.with_global_row_id(df, ["FL_DATE", "FLIGHT_ID"])


@query
def time_series_folds(spark, sf_dir):
    df = flights(spark, sf_dir).select("FLIGHT_ID", "FL_DATE")
    return ordering.time_series_folds(df, ["FL_DATE", "FLIGHT_ID"], k=3).select("FLIGHT_ID", "row_id", "fold", "role")


@query
def baseline_predict(spark, sf_dir):
    df = flights(spark, sf_dir)
    test = df.filter(F.col("YEAR").isin(fx.TEST_YEARS)).select("FLIGHT_ID", "DEP_DEL15")
    return models.baseline_predict(test, models.majority_share(df, "DEP_DEL15"), seed=451, key=["FLIGHT_ID"])


@query
def sorted_predictions(spark, sf_dir):
    """The baseline's rows by prediction, ascending and descending, with their positions."""
    rows = baseline_predict(spark, sf_dir)
    up = ordering.with_global_row_id(rows, ["prediction", "FLIGHT_ID"], "position")
    down = ordering.with_global_row_id(rows, [F.col("prediction").desc(), "FLIGHT_ID"], "position")
    return sampling.union_all([up.withColumn("direction", F.lit("ascending")), down.withColumn("direction", F.lit("descending"))])


def scored(spark, sf_dir):
    views(spark, sf_dir)
    return spark.table("metrics_fx")


@query
def confusion(spark, sf_dir):
    return metrics.confusion(scored(spark, sf_dir), "prediction", "label")


@query
def classification_metrics(spark, sf_dir):
    out = metrics.classification_metrics(scored(spark, sf_dir), "prediction", "label")
    return rounded(out, out.columns)


@query
def balanced_accuracy(spark, sf_dir):
    out = metrics.balanced_accuracy(scored(spark, sf_dir), "prediction", "label")
    return rounded(out, out.columns)


@query
def auc_rank(spark, sf_dir):
    return rounded(metrics.auc_rank(scored(spark, sf_dir), "score", "label"), ["auc"])


# ---------------------------------------------------------------- step 4: graph

from ..operators import graph  # noqa: E402

# The route filter of the graph fixture (FIXTURES.md, routes_fx).
ROUTE_FILTER = ("(origin_iata_code * 7 + dest_iata_code * 3) % 11 < 2 "
                "AND origin_iata_code <> dest_iata_code")


def route_graph(spark, sf_dir):
    facts = flights(spark, sf_dir).filter(F.expr(ROUTE_FILTER))
    return graph.build_graph(facts, "origin_iata_code", "dest_iata_code")


@query
def graph_vertices(spark, sf_dir):
    return route_graph(spark, sf_dir)[0]


@query
def graph_edges(spark, sf_dir):
    return route_graph(spark, sf_dir)[1]


@query
def degree_centrality(spark, sf_dir):
    v, e = route_graph(spark, sf_dir)
    return rounded(graph.degree_centrality(v, e), ["degree_centrality"])


@query
def closeness_centrality(spark, sf_dir):
    v, e = route_graph(spark, sf_dir)
    return rounded(graph.closeness_centrality(v, e), ["closeness_centrality"])


@query
def betweenness_centrality(spark, sf_dir):
    v, e = route_graph(spark, sf_dir)
    return rounded(graph.betweenness_centrality(v, e), ["betweenness_centrality"])


@query
def airport_rank(spark, sf_dir):
    v, e = route_graph(spark, sf_dir)
    scores = graph.centralities(v, e)
    facts = flights(spark, sf_dir).select("FLIGHT_ID", "origin_iata_code")
    out = clean.with_rank(graph.with_vertex_scores(facts, scores, "origin_iata_code"),
                          ["degree_centrality", "betweenness_centrality", "closeness_centrality"])
    return rounded(out, ["degree_centrality", "betweenness_centrality", "closeness_centrality", "airport_rank"])


@query
def subgraph(spark, sf_dir):
    v, e = route_graph(spark, sf_dir)
    first_ten = v.orderBy("id").limit(10)
    return graph.subgraph(e, first_ten)


# ---------------------------------------------------------------- step 5: feature transformers

from pyspark.ml.functions import vector_to_array  # noqa: E402

from ..operators import components, features  # noqa: E402
from . import pipeline, tuning  # noqa: E402

NUMERIC = pipeline.NUMERIC_FEATURES
CATEGORICAL = pipeline.CATEGORICAL_FEATURES


def feature_table(spark, sf_dir, columns):
    """``columns`` of all flights with summaries learned from all rows (the reference's order of steps)."""
    return pipeline.flight_features(flights(spark, sf_dir), columns=columns)


@query
def string_index(spark, sf_dir):
    df = feature_table(spark, sf_dir, ["FLIGHT_ID", *CATEGORICAL])
    model = features.index_categories(CATEGORICAL).fit(df)
    return model.transform(df).select("FLIGHT_ID", *[c + "_indexed" for c in CATEGORICAL])


def _hot(encoded):
    out = []
    for c in CATEGORICAL:
        arr = vector_to_array(c + "_onehot")
        out += [F.array_position(arr, 1.0).alias(c + "_hot"), F.size(arr).alias(c + "_size")]
    return encoded.select("FLIGHT_ID", *out)


@query
def one_hot(spark, sf_dir):
    df = feature_table(spark, sf_dir, ["FLIGHT_ID", *CATEGORICAL])
    return _hot(features.one_hot(CATEGORICAL).fit(df).transform(df))


@query
def one_hot_unseen(spark, sf_dir):
    """The mode the models use: fitted on the training years, applied to both splits."""
    train, test, _ = pipeline.split_features(flights(spark, sf_dir), fx.TRAIN_YEARS, fx.TEST_YEARS,
                                             ["FLIGHT_ID", "YEAR", *CATEGORICAL])
    encoder = features.one_hot(CATEGORICAL, handle_invalid="keep").fit(train)
    return _hot(encoder.transform(sampling.union_all([train, test])))


@query
def scaled_features(spark, sf_dir):
    df = feature_table(spark, sf_dir, ["FLIGHT_ID", *NUMERIC])
    pipe = features.Pipeline(stages=[features.assemble(NUMERIC, "v"), features.scale("v", "vs")])
    out = features.vector_elements(pipe.fit(df).transform(df), "vs", "scaled_", len(NUMERIC))
    names = [f"scaled_{i}" for i in range(len(NUMERIC))]
    return rounded(out.select("FLIGHT_ID", *names), names)


@query
def correlation_matrix(spark, sf_dir):
    return rounded(features.correlation_matrix(feature_table(spark, sf_dir, pipeline.CORRELATION_FEATURES), pipeline.CORRELATION_FEATURES), ["corr"])


@query
def summaries_applied(spark, sf_dir):
    """F7 without encoding: RFM letters, centralities and volume groups learned from the training years,
    saved, loaded, and applied to both splits."""
    from ..session import work_dir
    df = flights(spark, sf_dir)
    train, test = pipeline.split_years(df, fx.TRAIN_YEARS, fx.TEST_YEARS)
    path = work_dir(spark, "summaries")
    pipeline.Summaries.fit(train).save(path)
    out = pipeline.Summaries.load(spark, path).apply(sampling.union_all([train, test]))
    numbers = ["Monetary", "Frequency", *pipeline.CENTRALITIES, "airport_rank"]
    return rounded(out.select("FLIGHT_ID", "YEAR", "RecencyDays", "Recency", *numbers, "R_Quartile", "F_Quartile",
                              "M_Quartile", "airport_groups", "carrier_groups"), numbers)


@query
def rfm_quartiles_rank(spark, sf_dir):
    """B1-B3 with cut points from distributed prefix sums."""
    return rounded(rfm.rfm_quartiles(rfm_of(spark, sf_dir), materialise=True, method="rank"), ["Monetary", "Frequency"])


# ---------------------------------------------------------------- rows-only: PCA, pipelines, models, tuning

def model_data(spark, sf_dir, pca_k=10):
    train, test, _enc, _prep = pipeline.model_frames(flights(spark, sf_dir), fx.TRAIN_YEARS, fx.TEST_YEARS,
                                                     pca_k=pca_k)
    return train, test


@query
def pca_features(spark, sf_dir):
    df = feature_table(spark, sf_dir, ["FLIGHT_ID", *NUMERIC])
    pipe = features.Pipeline(stages=[features.assemble(NUMERIC, "v"), features.scale("v", "vs"), features.pca("vs", "pc", 10)])
    out = features.vector_elements(pipe.fit(df).transform(df), "pc", "pc_", 10)
    return out.select("FLIGHT_ID", *[f"pc_{i}" for i in range(10)])


@query
def explained_variance(spark, sf_dir):
    return features.explained_variance(feature_table(spark, sf_dir, pipeline.CORRELATION_FEATURES), pipeline.CORRELATION_FEATURES)


@query
def covariance_matrix(spark, sf_dir):
    """The covariances from which ``components.Components`` derives loadings and explained variance."""
    table = components.covariance(components.covariance_sums(feature_table(spark, sf_dir, pipeline.CORRELATION_FEATURES), pipeline.CORRELATION_FEATURES))
    c = F.col("covariance")
    return table.withColumn("covariance", F.when(F.abs(c) < 100, F.round(c, 6)).otherwise(F.round(c, 2)))


@query
def prepare_features(spark, sf_dir):
    both = [df.withColumn("split", F.lit(s)) for s, df in zip(("train", "test"), model_data(spark, sf_dir))]
    return sampling.union_all(both).select("FLIGHT_ID", "YEAR", "DEP_DEL15", "split",
                                           vector_to_array("input_features").alias("features"))


@query
def prepare_features_scaled(spark, sf_dir):
    """F7 without PCA: the scaled numeric part of the vectors of both splits, fitted on the training years."""
    both = [df.withColumn("split", F.lit(s)) for s, df in zip(("train", "test"), model_data(spark, sf_dir, pca_k=None))]
    arr = vector_to_array("input_features")
    return sampling.union_all(both).select("FLIGHT_ID", "split", *[F.round(arr[i], ROUND).alias(f"f_{i}") for i in range(len(NUMERIC))])


def _model_query(kind, **params):
    def run(spark, sf_dir):
        train, test = model_data(spark, sf_dir)
        model = models.fit_classifier(kind, train, "input_features", "DEP_DEL15", **params)
        return models.predict(model, test, keep=["FLIGHT_ID", "DEP_DEL15"])
    run.__name__ = kind
    return run


for _kind in ("lr", "lr_tuned", "dt", "rf", "gbt", "mlp", "mlp_deep"):
    QUERIES[_kind] = _model_query(_kind)


MODEL_KINDS = ("lr", "lr_tuned", "dt", "rf", "gbt", "mlp", "mlp_deep")
LOGGED = [f"{part}_{m}" for part in ("train", "test") for m in ("AUC", "accuracy", "precision", "recall", "f1")]


def model_log(spark, sf_dir):
    """Log of all seven classifiers, fitted once per session and table folder; ``model_runs`` and ``model_summary`` share it."""
    from ..session import work_dir
    known = spark.conf.get(f"skyledger.modelLog.{sf_dir}", None)
    if known:
        return known
    path = work_dir(spark, "model-log")
    models.logged_runs(MODEL_KINDS, *model_vectors(spark, sf_dir), "input_features", "DEP_DEL15", path)
    spark.conf.set(f"skyledger.modelLog.{sf_dir}", path)
    return path


def logged_models(spark, sf_dir):
    """The wide view of :func:`model_log`."""
    return experiment_log.experiment_table(experiment_log.read_log(spark, model_log(spark, sf_dir)), ["dataset_name", "family"],
                                           [*LOGGED, "Training Time (s)"])


@query
def model_runs(spark, sf_dir):
    return logged_models(spark, sf_dir)


@query
def model_summary(spark, sf_dir):
    """Test AUC per second of training, in order of training time."""
    wide = logged_models(spark, sf_dir).withColumnRenamed("run_name", "Name").drop("run_id")
    return experiments.experiment_summary(wide, "all", position="position")


def _stored(spark, train, learned):
    """Summaries, feature stages and classifier fitted on ``train``, stored; their folders."""
    from ..session import work_dir
    stages = [features.one_hot(pipeline.CATEGORICAL_FEATURES, handle_invalid="keep"),
              features.feature_pipeline(pipeline.NUMERIC_FEATURES, pipeline.ONEHOT_FEATURES),
              models.classifier("lr_tuned", "input_features", "DEP_DEL15")]
    model_path, summary_path = work_dir(spark, "model"), work_dir(spark, "summaries")
    models.save_model(features.Pipeline(stages=stages).fit(train), model_path)
    learned.save(summary_path)
    return model_path, summary_path


@query
def predict(spark, sf_dir):
    """M9 + S6: summaries, feature stages and the classifier fitted on train, stored, reloaded, applied to new rows."""
    raw = flights(spark, sf_dir)
    train, _, learned = pipeline.split_features(raw, fx.TRAIN_YEARS, fx.TEST_YEARS, pipeline.MODEL_COLUMNS)
    model_path, summary_path = _stored(spark, train, learned)
    new = pipeline.Summaries.load(spark, summary_path).apply(raw.filter(F.col("YEAR").isin(fx.TEST_YEARS)))
    return models.predict(models.load_model(model_path), new, keep=["FLIGHT_ID", "DEP_DEL15"])


def model_vectors(spark, sf_dir):
    """Both splits of :func:`model_data`, written: tuning reads narrow tables of finished vectors."""
    return [materialise(df.select("FLIGHT_ID", "FL_DATE", "DEP_DEL15", "input_features")) for df in model_data(spark, sf_dir)]


def _tree_grid(spark, sf_dir, kind, space):
    train, test = model_vectors(spark, sf_dir)
    _best, table = tuning.tree_grid_search(models.classifier(kind, "input_features", "DEP_DEL15"), space, train, test,
                                           "input_features", "DEP_DEL15", ["FLIGHT_ID"])
    return table


@query
def grid_search(spark, sf_dir):
    """64 decision trees x 3 folds from 24 fits, each cut back to all depths."""
    return _tree_grid(spark, sf_dir, "dt", tuning.DT_GRID)


@query
def grid_search_rf(spark, sf_dir):
    """32 random forests x 3 folds from 24 fits, each cut back to all depths."""
    return _tree_grid(spark, sf_dir, "rf", tuning.RF_GRID)


@query
def grid_search_gbt(spark, sf_dir):
    """32 boosted ensembles of 50 trees x 3 folds, one job per tree level for all of them."""
    train, test = model_vectors(spark, sf_dir)
    _best, table = tuning.boosting_grid_search(train, test, "input_features", "DEP_DEL15", tuning.GBT_GRID, ["FLIGHT_ID"])
    return table


@query
def grid_search_lr(spark, sf_dir):
    """150 logistic combinations x 3 folds, one job per iteration for all of them."""
    train, test = model_vectors(spark, sf_dir)
    _best, table = tuning.logistic_grid_search(train, test, "input_features", "DEP_DEL15", tuning.LR_GRID, ["FLIGHT_ID"])
    return table


@query
def time_series_cv(spark, sf_dir):
    """45 logistic combinations x 3 time blocks, one job per iteration for all of them."""
    train, _test = model_vectors(spark, sf_dir)
    _best, _score, table = tuning.logistic_time_series_cv(train, "input_features", "DEP_DEL15", tuning.LR_TIME_SERIES_GRID,
                                                          ["FL_DATE", "FLIGHT_ID"], k=3)
    return table


@query
def random_search(spark, sf_dir):
    """T4: Parzen proposals in batches, each batch fitted together; at most 40 trials, 20 without gain end it."""
    train, test = model_vectors(spark, sf_dir)
    _best, _score, table = tuning.logistic_search(train, test, "input_features", "DEP_DEL15", tuning.LR_RANDOM_SPACE,
                                                  n=40, patience=20, seed=42)
    return table


@query
def shuffle_rows(spark, sf_dir):
    return sampling.shuffle_rows(flights(spark, sf_dir).select("FLIGHT_ID", "DEP_DEL15"), seed=42)


# ---------------------------------------------------------------- step 6: neighbours and SMOTE

from ..operators import neighbours  # noqa: E402

# SMOTE settings of the reference (k, batches, seed, LSH bucket length)
# and the minority class of the vector fixture.
SMOTE_K, SMOTE_BATCHES, SMOTE_SEED, SMOTE_BUCKET = 3, 3, 234, 3.0
MINORITY_LABEL = 5


def vectors(spark, sf_dir):
    views(spark, sf_dir)
    emb = spark.table("embeddings")
    return emb.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"),
                      F.when(F.col("label") == MINORITY_LABEL, 1).otherwise(0).alias("label"))


def minority(spark, sf_dir):
    return vectors(spark, sf_dir).filter(F.col("label") == 1)


@query
def top_k_neighbours(spark, sf_dir):
    near = neighbours.knn(minority(spark, sf_dir), "id", "features", SMOTE_K)
    return rounded(near, ["distance"])


@query
def pick_one_neighbour(spark, sf_dir):
    near = neighbours.knn(minority(spark, sf_dir), "id", "features", SMOTE_K)
    batches = near.select("id", "nbr_id", F.explode(F.sequence(F.lit(0), F.lit(SMOTE_BATCHES - 1))).alias("batch"))
    return neighbours.pick_one_per_group(batches, ["id", "batch"], SMOTE_SEED, ["id", "batch", "nbr_id"]) \
        .select("id", "batch", "nbr_id")


def _long(df):
    return df.select("id", "batch", "label", F.posexplode("features").alias("dim", "value"))


@query
def smote_exact(spark, sf_dir):
    out = neighbours.smote(vectors(spark, sf_dir), "id", "features", "label", 1, SMOTE_K, SMOTE_BATCHES, SMOTE_SEED,
                           exact=True)
    return rounded(_long(out), ["value"])


@query
def smote_by_group_exact(spark, sf_dir):
    """R5 with SMOTE: neighbours within each group (ids modulo 4 stand in for years)."""
    df = vectors(spark, sf_dir).withColumn("grp", (F.col("id") % 4).cast("int"))
    out = sampling.rebalance_by(df, ["grp"], "label", "smote", seed=SMOTE_SEED, key=["id"], vec_col="features", minority=1,
                                k=SMOTE_K, multiplier=SMOTE_BATCHES, exact=True)
    return rounded(out.select("grp", "id", "batch", "label", F.posexplode("features").alias("dim", "value")), ["value"])


@query
def smote_lsh(spark, sf_dir):
    out = neighbours.smote(vectors(spark, sf_dir), "id", "features", "label", 1, SMOTE_K, SMOTE_BATCHES, SMOTE_SEED,
                           bucket_length=SMOTE_BUCKET)
    return out.select("id", "batch", "label", F.size("features").alias("dims"))


# ---------------------------------------------------------------- step 8: experiment records and I/O

from ..sources import experiment_log, tables  # noqa: E402
from . import experiments  # noqa: E402

# Baseline runs recorded per dataset (name, seed).
EXPERIMENT_RUNS = [("majority_class_baseline", 451), ("majority_class_baseline", 452),
                   ("majority_class_baseline", 453), ("random_baseline", 451), ("random_baseline", 452),
                   ("random_baseline", 453)]
RUN_PARAMS = ["dataset_name", "family"]
RUN_METRICS = ["test_AUC", "test_accuracy", "test_precision", "test_recall", "test_f1", "n_rows"]


def experiment_runs(spark, sf_dir):
    """One row per (baseline run, dataset = year) with its test metrics, all computed on Spark."""
    df = flights(spark, sf_dir).withColumn("dataset_name", F.concat(F.lit("Y"), F.col("YEAR").cast("string")))
    p_zero = {"majority_class_baseline": models.majority_share(df, "DEP_DEL15"), "random_baseline": F.lit(0.5)}
    runs = experiments.baseline_runs(df, "DEP_DEL15", ["FLIGHT_ID"], "dataset_name", EXPERIMENT_RUNS, p_zero)
    return runs.select(F.concat_ws("-", "Name", F.col("seed").cast("string"), "dataset_name").alias("run_id"),
                       "Name", "dataset_name", F.lit("majority class").alias("family"),
                       F.col("balanced_accuracy").alias("test_AUC"), F.col("accuracy").alias("test_accuracy"),
                       F.col("weighted_precision").alias("test_precision"),
                       F.col("weighted_recall").alias("test_recall"), F.col("weighted_f1").alias("test_f1"),
                       F.col("n_rows").cast("double").alias("n_rows"))


def experiment_wide(spark, sf_dir):
    recs = experiment_log.run_records(experiment_runs(spark, sf_dir), "run_id", "Name", RUN_PARAMS, RUN_METRICS)
    return experiment_log.experiment_table(recs, RUN_PARAMS, RUN_METRICS)


@query
def experiment_pivot(spark, sf_dir):
    return rounded(experiment_wide(spark, sf_dir), RUN_METRICS)


@query
def experiment_csv(spark, sf_dir):
    from ..session import work_dir
    path = tables.write_csv(experiment_wide(spark, sf_dir), work_dir(spark, "experiments-csv"))
    schema = "run_id string, run_name string, dataset_name string, family string, " + \
        ", ".join(f"{m} double" for m in RUN_METRICS)
    back = tables.read_experiments(spark, path, schema=schema,
                                   columns=["run_id", "run_name", *RUN_PARAMS, *RUN_METRICS])
    return rounded(back, RUN_METRICS)


@query
def experiment_summary(spark, sf_dir):
    wide = experiment_wide(spark, sf_dir).withColumnRenamed("run_name", "Name").drop("run_id")
    out = experiments.experiment_summary(wide, "Y2001", score="test_AUC", cost="n_rows",
                                         ratio="test_AUC_to_cost_ratio", position="position")
    return rounded(out, [c for c in out.columns if c != "Name"])


@query
def feature_roundtrip(spark, sf_dir):
    from ..session import work_dir
    base = work_dir(spark, "features")
    df = flights_recency(spark, sf_dir).select("FLIGHT_ID", "YEAR", "DEP_DEL15", "RecencyDays")
    tables.write_features(df, base, "flights", "test", partition_by=["YEAR"])
    back = tables.read_features(spark, base, "flights", "test")
    return back.filter(F.col("YEAR") == fx.TEST_YEARS[0]).select("FLIGHT_ID", "YEAR", "DEP_DEL15", "RecencyDays")


@query
def predict_stream(spark, sf_dir):
    """M9 on a stream: test-year flights arrive as files; features, summaries and model are applied
    per micro-batch; the result is read back from the streaming sink."""
    from ..session import work_dir
    from ..streaming import scoring

    raw = flights(spark, sf_dir)
    train, _, learned = pipeline.split_features(raw, fx.TRAIN_YEARS, fx.TEST_YEARS, pipeline.MODEL_COLUMNS)
    model_path, summary_path = _stored(spark, train, learned)
    loaded = pipeline.Summaries.load(spark, summary_path)
    landing = work_dir(spark, "landing")
    raw.filter(F.col("YEAR").isin(fx.TEST_YEARS)).repartition(4).write.parquet(landing)
    stream = scoring.read_stream(spark, landing, raw.schema, max_files_per_trigger=1)
    sink = work_dir(spark, "scored")
    q = scoring.score_stream(stream, loaded.apply, models.load_model(model_path), ["FLIGHT_ID", "DEP_DEL15"], sink)
    q.awaitTermination()
    return spark.read.parquet(sink)
