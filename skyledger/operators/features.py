"""Encoding, assembling, scaling, PCA and correlation (F1-F7, A7) on MLlib.

Every transformer is fitted on one DataFrame (the training split) and applied
to any other, so summaries learned from data never leak from the test period
into training features (SURVEY Q7). Multi-column stages fit all columns in
one pass over the data.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def index_categories(cols: list[str], suffix: str = "_indexed", handle_invalid: str = "error") -> StringIndexer:
    """string -> index by descending frequency, ties alphabetical (one multi-column stage).

    Numeric columns are indexed on their string form. The default raises on
    values unseen at fit time; ``handle_invalid='keep'`` gives them their own
    last index instead (use it when fitting on a training split).
    """
    return StringIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols],
                         stringOrderType="frequencyDesc", handleInvalid=handle_invalid)


def one_hot(cols: list[str], indexed_suffix: str = "_indexed", suffix: str = "_onehot",
            handle_invalid: str = "error") -> Pipeline:
    """index then one-hot encode (last category dropped -> all zeros).

    With ``handle_invalid="keep"`` the indexer's extra slot for values unseen at
    fit time is the last category, so unseen values are the all-zero vector
    and every known category keeps a slot.
    """
    indexer = index_categories(cols, indexed_suffix, handle_invalid)
    encoder = OneHotEncoder(inputCols=[c + indexed_suffix for c in cols], outputCols=[c + suffix for c in cols],
                            dropLast=True, handleInvalid="error")
    return Pipeline(stages=[indexer, encoder])


def assemble(cols: list[str], out: str, handle_invalid: str = "error") -> VectorAssembler:
    """columns -> one vector; nulls raise by default (as MLlib's default)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


def scale(col: str, out: str) -> StandardScaler:
    """divide by the sample standard deviation, no centring."""
    return StandardScaler(inputCol=col, outputCol=out, withMean=False, withStd=True)


def pca(col: str, out: str, k: int = 10) -> PCA:
    """project onto the top ``k`` principal components."""
    return PCA(k=k, inputCol=col, outputCol=out)


def feature_pipeline(numeric: list[str], onehot: list[str] = (), standard_scale: bool = True,
                     pca_k: int | None = 10, out: str = "input_features") -> Pipeline:
    """assemble numeric -> optional scale -> optional PCA -> assemble with one-hots.

    PCA reads whatever the previous stage produced (SURVEY Q11).
    """
    stages = [assemble(numeric, "wFeatures")]
    current = "wFeatures"
    if standard_scale:
        stages.append(scale(current, "wFeatures_scaled"))
        current = "wFeatures_scaled"
    if pca_k:
        stages.append(pca(current, "pca_wFeatures", pca_k))
        current = "pca_wFeatures"
    stages.append(assemble([current, *onehot], out))
    return Pipeline(stages=stages)


def prepare_features(train: DataFrame, test: DataFrame, numeric: list[str], onehot: list[str] = (),
                     standard_scale: bool = True, pca_k: int | None = 10,
                     out: str = "input_features") -> tuple[DataFrame, DataFrame, PipelineModel]:
    """fit the feature pipeline on ``train`` only; transform both."""
    model = feature_pipeline(numeric, onehot, standard_scale, pca_k, out).fit(train)
    between = ("wFeatures", "wFeatures_scaled", "pca_wFeatures")
    return model.transform(train).drop(*between), model.transform(test).drop(*between), model


def explained_variance(df: DataFrame, cols: list[str]) -> DataFrame:
    """explained-variance ratio per principal component and its running sum.

    The fit aggregates on the cluster; the k ratios (k = number of columns) come
    back as a tiny table.
    """
    pipe = Pipeline(stages=[assemble(cols, "__f"), scale("__f", "__fs"), pca("__fs", "__p", len(cols))])
    model = pipe.fit(df)
    ratios = [float(x) for x in model.stages[-1].explainedVariance.toArray()]
    spark = df.sparkSession
    table = spark.createDataFrame([(i, r) for i, r in enumerate(ratios)], "component int, explained_variance double")
    running = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return table.withColumn("cumulative_variance", F.sum("explained_variance").over(running))


def vector_elements(df: DataFrame, vec: str, prefix: str, size: int) -> DataFrame:
    """Vector -> ``size`` double columns (for SQL comparison or export)."""
    arr = vector_to_array(vec)
    return df.select("*", *[arr[i].alias(f"{prefix}{i}") for i in range(size)])


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair (and the diagonal), long form.

    Rows with a null in any listed column are left out (as assembling them
    into one vector would). Two passes with map-side partial sums only: the
    column means (one merged scalar subquery), then the sums of centred
    products; corr(a, b) = S_ab / sqrt(S_aa * S_bb). Centring first keeps the
    sums free of the cancellation of the one-pass formula, and plain sums stay
    in generated code, so this is much faster than one ``corr`` aggregate per pair.
    """
    data = df.select(*cols).na.drop(how="any")
    means = data.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).alias("means")).scalar()
    centred = data.select(means.alias("__means"), *cols).select(*[(F.col(c) - F.col(f"__means.m{i}")).alias(c) for i, c in enumerate(cols)])
    pairs = list(combinations_with_replacement(range(len(cols)), 2))
    sums = centred.agg(*[F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"s{i}_{j}") for i, j in pairs],
                       F.count(F.lit(1)).alias("n")).withColumn("__means", means)
    # A column that varies by rounding noise only is constant and correlates with nothing: null.
    varies = [F.sqrt(F.col(f"s{i}_{i}") / F.col("n")) > 1e-10 * (1 + F.abs(F.col(f"__means.m{i}"))) for i in range(len(cols))]

    def corr(i: int, j: int):
        both = F.try_divide(F.col(f"s{i}_{j}"), F.sqrt(F.col(f"s{i}_{i}") * F.col(f"s{j}_{j}")))
        return F.when(varies[i] & varies[j], both)

    args = ", ".join(f"'{cols[i]}', '{cols[j]}', __c{i}_{j}" for i, j in pairs)
    wide = sums.select(*[corr(i, j).alias(f"__c{i}_{j}") for i, j in pairs])
    return wide.selectExpr(f"stack({len(pairs)}, {args}) AS (feature_a, feature_b, corr)")
