"""The joined, cleaned and scored analysis view."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.functions.model import fix_ice_sign, model_denominator, model_term, performance_difference
from rinkflow.functions.numbers import day_first_date, rounded
from rinkflow.functions.text import gender_num
from rinkflow.operators import clean, joins, stats
from rinkflow.session import materialize

#: Rows of the view that a task orders: about 250 MB.
ROWS_TO_SORT = 1 << 19


def typed_date(df: DataFrame, col="Date"):
    """Date column from either text form; a date stays as it is."""
    return df.withColumn(col, day_first_date(col)) if dict(df.dtypes)[col] == "string" else df


def first_conditions(conditions: DataFrame, order=None):
    """The first start measurement of each race, without the ``order`` columns.

    It is stored: one row per race is little, and known to be so when results are joined.
    By default measurements are in the order in which they landed, if they
    carry it (`fixed.INGEST_ORDER`).
    """
    if order is None and set(fixed.INGEST_ORDER) <= set(conditions.columns):
        order = fixed.INGEST_ORDER
    start = clean.occasion_filter(conditions)
    return materialize(clean.first_per_key(start, fixed.RACE_KEY, order).drop(*(order or [])))


def joined_view(results: DataFrame, first: DataFrame):
    """Results with the first start measurement of their race, complete rows only."""
    return clean.require_columns(joins.join_conditions(results, first))


def add_prediction(df: DataFrame, out="Prediction"):
    """Model prediction by distance; NULL for other distances and NULL inputs."""
    staged = (
        joins.lookup_coefficients(df)
        .withColumn("_sum", model_denominator("coefficients"))
        .withColumn("_term", model_term("_sum"))
    )
    return staged.withColumn(out, F.col("SeasonalBest") - rounded("_term")).drop(
        "coefficients", "_sum", "_term"
    )


def curated_view(results: DataFrame, conditions: DataFrame, order=None):
    """The view all analyses start from.

    The correction of the differences looks at the whole joined view, before
    implausible times go: that view is written once, and its least difference
    is observed as it is written.  ``order`` names the condition columns that decide
    which measurement of a race is first; they are not kept.
    """
    view = joined_view(results, first_conditions(conditions, order))
    view = view.withColumn("Difference", performance_difference("SeasonalBest", "RaceTime"))
    seen = Observation()
    view = materialize(view.observe(seen, F.min("Difference").alias("least")))
    view = view.withColumn("CorrectedDifference", stats.corrected("Difference", F.lit(seen.get["least"]).cast("double")))
    view = typed_date(view).withColumns(
        {
            "TempIce": fix_ice_sign("TempIce"),
            "Year": F.year("Date"),
            "GenderNum": gender_num("Gender"),
        }
    )
    return add_prediction(clean.plausible(view))


def store_view(view: DataFrame):
    """The view as Parquet, one folder per distance: every selection names one.

    Within it rows are ordered by year and stadium, in ranges, so that files and
    row groups outside a selection are not read; a large distance spreads over
    many tasks, with so many rows to each that they are sorted in memory.
    """
    layout = ["Distance", "Year", "Stadium"]
    ranges = -(-view.count() // ROWS_TO_SORT) or 1
    return materialize(view.repartitionByRange(ranges, *layout, "Date", "Race").sortWithinPartitions(*layout), ["Distance"])
