"""Column profile of silver: counts, quantiles, distributions and anomalies.

Exact per-column counts come from one aggregate. Exact distinct counts for all columns at once
would make Spark expand every row once per column and shuffle the result; instead the table is
unpivoted to (column, value-as-text) pairs inside the map stage and de-duplicated with partial
aggregation, so a column with few values contributes a handful of rows per task to the shuffle.
Quantiles, histograms and outliers are exact; they come from value counts (operators/order_statistics.py).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.operators import order_statistics as order

NUMERIC_TYPES = (T.LongType, T.IntegerType, T.DoubleType)


def _as_text(df: DataFrame, c: str):
    """Text of a value for distinct counting; -0.0 and 0.0 are one value, as in SQL."""
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        col = F.when(col == 0, F.lit(0.0)).otherwise(col)
    return col.cast("string")


def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, non_null, nulls, distinct_values) for every column."""
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in cols])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    args = ", ".join(f"'{c}', '{types[c]}', `{c}`" for c in cols)
    counted = counts.select("_rows", F.expr(f"stack({len(cols)}, {args}) as (column_name, data_type, non_null)"))

    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _as_text(df, c).alias("value")) for c in cols])).alias("p")
    ).select("p.column_name", "p.value")
    distinct = (
        pairs.where(F.col("value").isNotNull())
        .distinct()
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("distinct_values"))
    )
    # One row per column: bounded by the schema, not the data, so it is safe to broadcast.
    return (
        counted.join(F.broadcast(distinct), "column_name", "left")
        .select(
            "column_name",
            "data_type",
            F.col("non_null").cast("bigint").alias("non_null"),
            (F.col("_rows") - F.col("non_null")).cast("bigint").alias("nulls"),
            F.coalesce(F.col("distinct_values"), F.lit(0)).cast("bigint").alias("distinct_values"),
        )
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


SHARES = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


def numeric_summary(df: DataFrame) -> DataFrame:
    """Rows, distinct values, min, max, mean and quantiles of every numeric column, all exact.

    A column without values has 0 rows and NULL figures. One scan of ``df``; the rest reads value counts.
    """
    columns = numeric_columns(df)
    ranked = order.rank(order.value_counts(df, columns))
    figures = ranked.counts.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        order.exact_sum(F.col("value"), F.col("n")).alias("sum"),
    )
    # One row per numeric column on both sides: bounded by the schema, so safe to broadcast.
    found = figures.join(F.broadcast(order.quantiles(ranked, SHARES)), "column_name")
    found = found.withColumn("mean", F.col("sum") / F.col("total")).withColumnRenamed("total", "rows")
    return every_column(df, columns, found, ("rows", "distinct_values")).select(
        "column_name", "rows", "distinct_values", "min", "max", "mean", *SHARES
    )


def every_column(df: DataFrame, columns: list[str], found: DataFrame, counts: tuple[str, ...] = ()) -> DataFrame:
    """``found`` (one row per column with values) with a row for the columns without values too."""
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return names.join(F.broadcast(found), "column_name", "left").fillna(0, subset=list(counts))


def histograms(df: DataFrame, buckets: int = 10) -> DataFrame:
    """Equal-width and equal-depth histograms of every numeric column.

    (column_name, kind, bucket, lower, upper, rows, distinct_values). ``width`` buckets split the span from min to
    max evenly (upper bound excluded, but in the last bucket) and are listed also when empty; a column
    with one value has one bucket. ``depth`` buckets end at the values whose ranks are the multiples of
    rows/buckets; ``lower`` and ``upper`` are the least and greatest value inside. A value never is split, so a
    value that many rows share fills a bucket of its own and the buckets that it covers whole are missing. A column without
    values has no row. ``df`` is scanned once: bounds and counts come from its value counts.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    ranked = order.rank(order.value_counts(df, numeric_columns(df)))
    span = ranked.counts.groupBy("column_name").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    ends = ranked.totals.select(
        "column_name",
        F.explode(F.transform(F.sequence(F.lit(1), F.lit(buckets)), lambda i: F.ceil(i * F.col("total") / buckets).cast("bigint"))).alias("rank"),
    )
    # A column's bounds are one row of at most ``buckets`` values.
    bounds = order.at_ranks(ranked, ends.distinct()).groupBy("column_name").agg(F.sort_array(F.collect_set("value")).alias("ends"))
    values = ranked.counts.join(F.broadcast(span), "column_name").join(F.broadcast(bounds), "column_name")
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    by_width = F.when(high == low, F.lit(0)).otherwise(
        F.least(F.floor((value - low) / (high - low) * buckets).cast("int"), F.lit(buckets - 1))
    )
    by_depth = F.size(F.filter("ends", lambda end: end < value))
    kinds = F.array(
        F.struct(F.lit("width").alias("kind"), by_width.alias("bucket")),
        F.struct(F.lit("depth").alias("kind"), by_depth.alias("bucket")),
    )
    counted = (
        values.select("column_name", "value", "n", F.explode(kinds).alias("k"))
        .groupBy("column_name", "k.kind", "k.bucket")
        .agg(F.min("value").alias("least"), F.max("value").alias("most"), F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_values"))
    )
    depth = counted.where(F.col("kind") == "depth").select(
        "column_name", "kind", "bucket", F.col("least").alias("lower"), F.col("most").alias("upper"), "rows", "distinct_values"
    )
    step = (high - low) / buckets
    places = span.select(
        "column_name", "low", "high",
        F.explode(F.sequence(F.lit(0), F.when(high == low, F.lit(0)).otherwise(F.lit(buckets - 1)))).alias("bucket"),
    ).select(
        "column_name", F.lit("width").alias("kind"), "bucket", (low + F.col("bucket") * step).alias("lower"),
        F.when((F.col("bucket") == buckets - 1) | (high == low), high).otherwise(low + (F.col("bucket") + 1) * step).alias("upper"),
    )
    filled = counted.where(F.col("kind") == "width").select("column_name", "bucket", "rows", "distinct_values")
    width = places.join(F.broadcast(filled), ["column_name", "bucket"], "left").fillna(0, subset=["rows", "distinct_values"])
    return width.select(depth.columns).unionByName(depth)


FENCE = 1.5  # quartile fences lie this many interquartile ranges outside the quartiles
SCORE_LIMIT = 3.5  # robust scores above this are outliers
MAD_SCALE = 0.6745  # a normal distribution's median absolute deviation, in standard deviations
MEAN_SCALE = 1.253314  # a normal distribution's standard deviation, in mean absolute deviations


@dataclass
class Anomalies:
    bounds: DataFrame  # one row per numeric column with values
    values: DataFrame  # one row per value that is an outlier by either rule


def anomalies(df: DataFrame) -> Anomalies:
    """Outliers of every numeric column, by quartile fences and by robust scores; all figures exact.

    A value is outside the fences if it lies more than 1.5 interquartile ranges outside the quartiles.
    Its score is its distance from the median over the median absolute deviation, scaled as a standard score;
    where more than half of the rows share one value that deviation is 0 and the mean absolute deviation
    takes its place; where all rows share it every score is 0. NULL and NaN are no outliers, a
    column without values has no row.

    ``df`` is scanned once. Quartiles, median and the median of the distances come from value counts (a distance
    is counted as often as its values), so a hot value costs one row in each step.
    """
    ranked = order.rank(order.value_counts(df, numeric_columns(df)))
    middle = order.quantiles(ranked, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    far = ranked.counts.join(F.broadcast(middle), "column_name")
    distances = far.select("column_name", F.abs(F.col("value") - F.col("median")).alias("value"), "n")
    ranked_distances = order.rank(order.counted(distances))
    spread = order.quantiles(ranked_distances, {"mad": 0.5}).join(
        ranked_distances.counts.groupBy("column_name").agg(order.exact_sum(F.col("value"), F.col("n")).alias("distance")), "column_name"
    )
    reach = FENCE * (F.col("q3") - F.col("q1"))
    middle = middle.join(F.broadcast(spread.drop("total")), "column_name").select(
        "column_name", F.col("total").alias("rows"), "q1", "median", "q3", "mad", (F.col("distance") / F.col("total")).alias("mean_deviation"),
        (F.col("q1") - reach).alias("lower_fence"), (F.col("q3") + reach).alias("upper_fence"),
    )
    distance = F.col("value") - F.col("median")
    score = (
        F.when(F.col("mad") > 0, distance * MAD_SCALE / F.col("mad"))
        .when(F.col("mean_deviation") > 0, distance / (F.col("mean_deviation") * MEAN_SCALE))
        .otherwise(F.lit(0.0))
    )
    scored = ranked.counts.join(F.broadcast(middle), "column_name").select(
        "column_name", "value", "n", score.alias("score"),
        ((F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))).alias("outside_fences"),
    ).withColumn("high_score", F.abs("score") > SCORE_LIMIT)
    found = scored.where(F.col("outside_fences") | F.col("high_score"))
    counts = found.groupBy("column_name").agg(
        F.sum(F.when(F.col("outside_fences"), F.col("n")).otherwise(0)).alias("rows_outside_fences"),
        F.sum(F.when(F.col("high_score"), F.col("n")).otherwise(0)).alias("rows_with_high_score"),
    )
    bounds = middle.join(F.broadcast(counts), "column_name", "left").fillna(0, subset=["rows_outside_fences", "rows_with_high_score"])
    return Anomalies(bounds, found.withColumnRenamed("n", "rows"))
