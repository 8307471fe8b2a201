"""Linear regression on a feature table."""

from __future__ import annotations

import pyspark
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, functions as F

from stocktrail.functions.scalars import thousands

# The normal equations are summed up per partition into a matrix of this side at most.
MAX_FEATURES = 4096


def _vectors(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(df)


def fit_ols(df: DataFrame, features: list[str], target: str) -> LinearRegressionModel:
    """Least squares with intercept, in one distributed pass over the table."""
    if len(features) > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} features")
    frame = _vectors(df.select(*features, F.col(target).cast("double").alias(target)), features)
    regression = LinearRegression(
        featuresCol="features", labelCol=target, predictionCol="prediction", solver="normal"
    )
    return regression.fit(frame.select("features", target))


def predict(model: LinearRegressionModel, df: DataFrame, features: list[str]) -> DataFrame:
    return model.transform(_vectors(df, features)).drop("features")


def mse(predictions: DataFrame, target: str) -> DataFrame:
    """Mean squared error, over all n rows."""
    error = F.col(target) - F.col("prediction")
    return predictions.agg(F.avg(error * error).alias("mse"))


def evaluate(
    model: LinearRegressionModel, df: DataFrame, features: list[str], target: str
) -> DataFrame:
    """The model record: what it is, on how many rows it was judged, and its error."""
    error = F.col(target) - F.col("prediction")
    return predict(model, df, features).agg(
        F.lit(type(model).__name__).alias("model_type"),
        F.lit("pyspark.ml").alias("framework"),
        F.lit(pyspark.__version__).alias("version"),
        F.count("*").alias("n_rows"),
        F.avg(error * error).alias("mse"),
        thousands(F.avg(error * error)).alias("mse_text"),
    )


def coefficients(model: LinearRegressionModel, spark, features: list[str]) -> DataFrame:
    """One row per fitted term."""
    rows = [("intercept", float(model.intercept))]
    rows += [(name, float(value)) for name, value in zip(features, model.coefficients)]
    return spark.createDataFrame(rows, "term string, value double")
