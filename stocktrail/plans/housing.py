"""Sale prices: clean, enrich, select features, fit, judge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stocktrail.operators.learn import evaluate, fit_ols
from stocktrail.operators.relational import enrich, require
from stocktrail.session import written

# Fixed values of the model.
PRICE_RANGE = (10_000, 1_000_000)
FEATURES = ["sqft", "bedrooms", "bathrooms", "school_rating"]
TARGET = "price"


def clean(sales: DataFrame, low=PRICE_RANGE[0], high=PRICE_RANGE[1]) -> DataFrame:
    """Sales with a price in the range, both ends included; a NULL price is dropped."""
    return sales.where(F.col("price").between(low, high))


def features(sales: DataFrame, locations: DataFrame) -> DataFrame:
    """The training frame. A location with two rows gives its sales twice."""
    enriched = enrich(clean(sales), locations, "house_id", ["zipcode", "school_rating"])
    return require(enriched, FEATURES).select(*FEATURES, TARGET)


def train(sales: DataFrame, locations: DataFrame) -> DataFrame:
    """Fit on all sales and judge on the same; the features are a table, read once for each."""
    frame = written(features(sales, locations), "features")
    return evaluate(fit_ols(frame, FEATURES, TARGET), frame, FEATURES, TARGET)
