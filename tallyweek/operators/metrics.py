"""Errors of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_columns(label: str, prediction: str = "prediction") -> tuple[Column, Column]:
    """RMSE and R squared as aggregates; R squared is NULL if the label does not vary."""
    y = F.when(F.col(prediction).isNotNull(), F.col(label).cast("double"))
    mse = F.avg((y - F.col(prediction)) * (y - F.col(prediction)))
    return F.sqrt(mse), 1 - F.try_divide(mse, F.var_pop(y))


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """RMSE and R squared in one pass."""
    rmse, r_squared = metric_columns(label, prediction)
    return df.agg(rmse.alias("rmse"), r_squared.alias("r_squared"))
