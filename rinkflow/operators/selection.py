"""Faceted selection: filters, option lists, retained choices, bounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.operators.quantiles import mark_outliers, mark_outside


def select_rows(
    df: DataFrame,
    gender=fixed.DEFAULT_GENDERS,
    distance=fixed.DEFAULT_DISTANCE,
    years=None,
    countries=None,
    stadiums=None,
    athletes=None,
):
    """Rows of the main view's selection.

    Gender always applies (an empty list selects nothing); ``years`` is
    inclusive, None means all; the other lists apply only if non-empty.
    """
    keep = F.col("Gender").isin(list(gender)) & (F.col("Distance") == distance)
    if years is not None:
        keep = keep & F.col("Year").between(*years)
    for col, chosen in (("RinkCountry", countries), ("Stadium", stadiums), ("Name", athletes)):
        if chosen:
            keep = keep & F.col(col).isin(list(chosen))
    return df.where(keep)


def select_prediction_rows(df: DataFrame, distance, stadium=fixed.ALL_STADIUMS, countries=None):
    """Rows of the prediction view's selection: no gender or year filter."""
    keep = F.col("Distance") == distance
    if countries:
        keep = keep & F.col("RinkCountry").isin(list(countries))
    if stadium != fixed.ALL_STADIUMS:
        keep = keep & (F.col("Stadium") == stadium)
    return df.where(keep)


def distinct_values(df: DataFrame, col):
    """Sorted option list of a column."""
    return df.select(col).distinct().orderBy(col)


def available_selection(selected: DataFrame, options: DataFrame):
    """Chosen values that are on offer, as a set."""
    return selected.intersect(options)


def retain_selection(selected: DataFrame, options: DataFrame, col, fallback=None):
    """Chosen values that still exist; with none left, one row with ``fallback``."""
    kept = selected.join(options.select(col).distinct(), col, "left_semi").select(col)
    left = kept.agg(F.count("*").alias("n")).scalar()
    empty = (
        selected.sparkSession.range(1)
        .where(left == 0)
        .select(F.lit(fallback).cast(dict(selected.dtypes)[col]).alias(col))
    )
    return kept.union(empty)


def stadium_options(df: DataFrame, countries=None):
    """Stadiums of the chosen countries."""
    rows = df.where(F.col("RinkCountry").isin(list(countries))) if countries else df
    return distinct_values(rows, "Stadium")


def athlete_options(df: DataFrame, **selection):
    """Athletes left by all the other filters."""
    return distinct_values(select_rows(df, **selection), "Name")


def year_bounds(df: DataFrame):
    return df.agg(F.min("Year").alias("min_year"), F.max("Year").alias("max_year"))


def selection_count(df: DataFrame, distance, stadium=fixed.ALL_STADIUMS, countries=None):
    rows = select_prediction_rows(df, distance, stadium, countries)
    return rows.agg(F.count("*").alias("n"))


def scatter_points(df: DataFrame, y="RaceTime", fences=None):
    """Points of the temperature plot, with outliers marked; ``fences`` if they are known."""
    marked = mark_outliers(df, y) if fences is None else mark_outside(df, y, fences)
    return marked.select(
        "TempIce", y, "Name", "Stadium", "Date", "Year", "is_outlier"
    )


def prediction_points(df: DataFrame, distance, stadium=fixed.ALL_STADIUMS, countries=None):
    """Time against prediction."""
    rows = select_prediction_rows(df, distance, stadium, countries)
    return rows.select("RaceTime", "Prediction", "Name", "Gender")
