"""Feature preparation with Spark ML; models may be fitted on another (historical) frame than the one they change."""

from __future__ import annotations

from pyspark.ml.feature import Binarizer, Bucketizer, Imputer, OneHotEncoder, VectorIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _lists(inputs: str | list[str], outputs: str | list[str]) -> tuple[list[str], list[str]]:
    return ([inputs], [outputs]) if isinstance(inputs, str) else (list(inputs), list(outputs))


def binarize(df: DataFrame, inputs, outputs, thresholds: float | list[float]) -> DataFrame:
    """1.0 above the threshold, else 0.0."""
    inputs, outputs = _lists(inputs, outputs)
    thresholds = [float(thresholds)] * len(inputs) if isinstance(thresholds, int | float) else [float(t) for t in thresholds]
    return Binarizer(inputCols=inputs, outputCols=outputs, thresholds=thresholds).transform(df)


def bucketize(df: DataFrame, inputs, outputs, splits: list) -> DataFrame:
    """Bucket numbers; [a, b) and the last one closed. Values outside raise an error."""
    inputs, outputs = _lists(inputs, outputs)
    splits = splits if isinstance(splits[0], list) else [splits] * len(inputs)
    return Bucketizer(inputCols=inputs, outputCols=outputs, splitsArray=splits).transform(df)


def vector_index(df: DataFrame, column: str, output: str, max_categories: int = 20, fit_on: DataFrame | None = None) -> DataFrame:
    model = VectorIndexer(inputCol=column, outputCol=output, maxCategories=max_categories).fit(df if fit_on is None else fit_on)
    return model.transform(df)


def one_hot(df: DataFrame, inputs, outputs, fit_on: DataFrame | None = None) -> DataFrame:
    """Sparse indicator vectors of category numbers; the last category is all zeros."""
    inputs, outputs = _lists(inputs, outputs)
    return OneHotEncoder(inputCols=inputs, outputCols=outputs).fit(df if fit_on is None else fit_on).transform(df)


def impute(df: DataFrame, inputs, outputs, strategy: str = "mean", fit_on: DataFrame | None = None) -> DataFrame:
    """Nulls and NaN become the mean, the exact median (of two middle values their mean) or the mode; a column without values stays as it is."""
    inputs, outputs = _lists(inputs, outputs)
    source = df if fit_on is None else fit_on
    if strategy != "median":
        return Imputer(inputCols=inputs, outputCols=outputs, strategy=strategy).fit(source).transform(df)
    for column, output in zip(inputs, outputs, strict=True):
        value = F.when(~F.isnan(column), F.col(column))
        df = df.withColumn(output, F.coalesce(value, F.lit(median(source, column)).cast(df.schema[column].dataType)))
    return df


def median(df: DataFrame, column: str, few: int = 1000, bins: int = 1024) -> float | None:
    """The exact median of the values that are neither null nor NaN, by histograms that narrow to the bin of the middle rows until it has few of them or one value. Every round is one
    aggregation to ``bins`` rows; no value but the last few leaves its task."""
    x = F.col(column).cast("double")
    rows = df.select(x.alias("x")).where("x is not null and not isnan(x)")
    n, low, high = rows.agg(F.count("*"), F.min("x"), F.max("x")).first()
    if not n:
        return None
    first, last = (n - 1) // 2, n // 2  # the middle rows, from 0
    while low < high:
        inside = rows.where((F.col("x") >= low) & (F.col("x") <= high))
        if n <= few:
            values = sorted(r["x"] for r in inside.collect())
            return values[first] / 2 + values[last] / 2
        width = high / 2 - low / 2  # halves: the difference of the ends may be too large for a double
        ends = F.when(F.col("x") == low, 0).when(F.col("x") == high, 2).otherwise(1)
        place = F.floor((F.col("x") / 2 - low / 2) / width * bins).cast("int") if 0 < width < float("inf") else ends
        for b in inside.groupBy(place.alias("b")).agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("b").collect():
            if first < b["n"]:
                break
            first, last = first - b["n"], last - b["n"]
        if last >= b["n"]:  # the second middle row is the first one of what follows
            return b["high"] / 2 + rows.where(F.col("x") > b["high"]).agg(F.min("x")).first()[0] / 2
        n, low, high = b["n"], b["low"], b["high"]
    return low
