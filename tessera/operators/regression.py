"""Linear regression with Spark ML, plus a reproducible train/test split.

``randomSplit`` depends on the partitioning of its input, so for results
that must repeat (and match a SQL oracle) rows are split by an integer hash
of an id: ``id * 7919 % 10007 % 100 < train_pct``. Fitting uses the normal
equations (two distributed tree aggregates: feature statistics, then the
weighted Gram matrix), so it scales with the rows, not with a driver-side
copy of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reproducible split.
SPLIT_MULTIPLIER = 7919
SPLIT_MODULUS = 10007


def split_bucket(id_col: Column) -> Column:
    """0..99 bucket of an integer id, equal to ``id * 7919 % 10007 % 100``.
    The id is reduced modulo 10007 before the multiplication (same value,
    congruent and of the same sign), so no 64-bit id can overflow."""
    return id_col.cast("bigint") % SPLIT_MODULUS * SPLIT_MULTIPLIER % SPLIT_MODULUS % 100


def hash_split(df: DataFrame, id_col: Column, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the id bucket: about ``train_pct`` percent train.
    Every row lands in exactly one part (a NULL id goes to test)."""
    in_train = F.coalesce(split_bucket(id_col) < train_pct, F.lit(False))
    return df.filter(in_train), df.filter(~in_train)


def split_counts(df: DataFrame, id_col: Column, train_pct: int = 80) -> DataFrame:
    """Rows per part: ``split`` ('train'/'test'), ``n``."""
    part = F.when(split_bucket(id_col) < train_pct, "train").otherwise("test")
    return df.groupBy(part.alias("split")).agg(F.count(F.lit(1)).alias("n"))


def assembler(feature_cols: Sequence[str], output_col: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(feature_cols), outputCol=output_col)


def fit_linear_regression(
    df: DataFrame, feature_cols: Sequence[str], label_col: str = "label"
) -> LinearRegressionModel:
    """Ordinary least squares (no regularisation) on the given features."""
    lr = LinearRegression(featuresCol="features", labelCol=label_col, solver="normal")
    return lr.fit(assembler(feature_cols).transform(df.select(*feature_cols, label_col)))


def predict(model: LinearRegressionModel, df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """``df`` plus a ``prediction`` column (the features vector is dropped)."""
    return model.transform(assembler(feature_cols).transform(df)).drop("features")


def rmse(predictions: DataFrame, label_col: str = "label") -> float:
    """Root mean squared error via Spark ML's evaluator (a driver scalar)."""
    ev = RegressionEvaluator(labelCol=label_col, predictionCol="prediction", metricName="rmse")
    return ev.evaluate(predictions)


def rmse_frame(predictions: DataFrame, label_col: str = "label") -> DataFrame:
    """The same RMSE as a one-row DataFrame (``rmse``), kept lazy."""
    err = F.col(label_col) - F.col("prediction")
    return predictions.agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def coefficients_frame(model: LinearRegressionModel, df_like: DataFrame, digits: int = 4) -> DataFrame:
    """One row with ``slope`` (first coefficient) and ``intercept``."""
    spark = df_like.sparkSession
    row = [(float(model.coefficients[0]), float(model.intercept))]
    return spark.createDataFrame(row, "slope double, intercept double").select(
        F.round("slope", digits).alias("slope"), F.round("intercept", digits).alias("intercept")
    )


# --- regression from mergeable moments --------------------------------------------


def moments(df: DataFrame, feature_cols: Sequence[str], label_col: str = "label") -> DataFrame:
    """One row with n, the means and the centred co-moments (population covariances)
    of the features and the label. One aggregate: Spark merges the partial moments of
    tasks without going back to raw sums, so large means lose no digits. Rows with a
    null feature or label take no part."""
    names = [*feature_cols, label_col]
    whole = df.select(*[F.col(c).cast("double").alias(c) for c in names]).na.drop()
    means = [F.avg(c).alias(f"mean_{i}") for i, c in enumerate(names)]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    return whole.agg(F.count(F.lit(1)).alias("n"), *means, *[F.covar_pop(names[i], names[j]).alias(f"cov_{i}_{j}") for i, j in pairs])


def solved(found: DataFrame, n_features: int) -> DataFrame:
    """One row, one struct column ``model``: intercept and coefficients of the least
    squares line through the moments. The normal equations are solved in the plan by
    elimination, one projection a step (covariances need no pivoting). Collinear
    features and an empty input give null coefficients."""
    d = n_features
    rows = [[F.col(f"cov_{min(i, j)}_{max(i, j)}") for j in range(d + 1)] for i in range(d)]
    now = found.select("*", *[rows[i][j].alias(f"a_{i}_{j}") for i in range(d) for j in range(d + 1)])
    for p in range(d):
        step = {}
        for j in range(p, d + 1):
            scaled = F.try_divide(F.col(f"a_{p}_{j}"), F.col(f"a_{p}_{p}"))
            step[f"a_{p}_{j}"] = scaled
            for i in range(d):
                if i != p:
                    step[f"a_{i}_{j}"] = F.col(f"a_{i}_{j}") - F.col(f"a_{i}_{p}") * scaled
        now = now.withColumns(step)
    coefficients = [F.col(f"a_{i}_{d}") for i in range(d)]
    intercept = F.col(f"mean_{d}")
    for i, c in enumerate(coefficients):
        intercept = intercept - c * F.col(f"mean_{i}")
    return now.select(F.struct(intercept.alias("intercept"), F.array(*coefficients).alias("coefficients")).alias("model"))


def linear_model(df: DataFrame, feature_cols: Sequence[str], label_col: str = "label") -> Column:
    """The model of ``df`` as a column for use in any other plan: an uncorrelated
    scalar subquery, so fitting and predicting are one plan with one scan each and
    nothing goes through the driver's Python."""
    return solved(moments(df, feature_cols, label_col), len(feature_cols)).scalar()


def predicted(model: Column, feature_cols: Sequence[str]) -> Column:
    """intercept + sum of coefficient * feature."""
    out = model["intercept"]
    for i, c in enumerate(feature_cols):
        out = out + F.get(model["coefficients"], F.lit(i)) * F.col(c)
    return out
