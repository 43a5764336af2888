"""The bundles of figures behind each page."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.operators import quantiles, selection, stats
from rinkflow.operators.trend import lowess_trend
from rinkflow.session import materialize
from rinkflow.sources.delimited import export_selection


def _boxes(rows: DataFrame):
    """The box numbers of all figures, (part, key, ...), found together."""
    wanted = [
        ("time", F.lit(""), "RaceTime"),
        ("ice", F.lit(""), "TempIce"),
        ("time_by_year", F.col("Year"), "RaceTime"),
        ("time_by_stadium", F.col("Stadium"), "RaceTime"),
    ]
    values = [
        F.struct(F.lit(part).alias("part"), key.cast("string").alias("key"), F.col(value).cast("double").alias("value"))
        for part, key, value in wanted
    ]
    return materialize(quantiles.box_by(rows.select(F.inline(F.array(*values))), ["part", "key"], "value"))


def _sums(rows: DataFrame):
    """Counts, means and totals of the selection and of each stadium, in one pass."""
    return materialize(
        rows.rollup("Stadium").agg(
            F.grouping("Stadium").alias("whole"),
            F.count("*").alias("n"),
            F.avg("RaceTime").alias("mean_RaceTime"),
            F.stddev_samp("RaceTime").alias("std_RaceTime"),
            F.avg("TempIce").alias("mean_TempIce"),
            F.stddev_samp("TempIce").alias("std_TempIce"),
            F.sum("RaceTime").alias("total"),
        )
    )


def main_figures(view: DataFrame, **chosen):
    """Everything the main page shows for a selection, one DataFrame each.

    ``view`` should be a stored view.  Quantiles of all figures are found
    together, and so are all means and totals; the rows are read again only for
    points, bins and the trend.
    """
    rows = selection.select_rows(view, **chosen)
    boxes, sums = _boxes(rows), _sums(rows)
    box = lambda part: boxes.where(F.col("part") == part).drop("part")
    keyed = lambda part, name: box(part).withColumn("key", F.col("key").cast(dict(rows.dtypes)[name])).withColumnRenamed("key", name)
    fences = box("time").select(F.struct(F.col("lower_fence").alias("low"), F.col("upper_fence").alias("high"))).scalar()
    ends = box("ice").select(F.struct(F.col("min").alias("low"), F.col("max").alias("high"))).scalar()
    points = selection.scatter_points(rows, fences=fences)
    by_stadium = sums.where("whole = 0")
    # One row, of zero rows if nothing is selected.
    total = sums.where("whole = 1").agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
        *[F.max(c).alias(c) for c in ("mean_RaceTime", "std_RaceTime", "mean_TempIce", "std_TempIce")],
    )
    outside = quantiles.mark_outside(rows, "RaceTime", fences, "_out").where("_out").drop("_out")
    return {
        "summary": total,
        "outliers": outside,
        "outlier_count": outside.agg(F.count("*").alias("n_outliers")),
        "scatter": points,
        "trend": lowess_trend(rows, "TempIce", "RaceTime"),
        "time_by_year": keyed("time_by_year", "Year"),
        "ice_histogram": stats.histogram(rows, "TempIce", ends=ends),
        "ice_box": box("ice").drop("key"),
        "time_by_stadium": keyed("time_by_stadium", "Stadium"),
        "stadium_order": by_stadium.select("Stadium", "total").orderBy(F.desc("total"), "Stadium"),
        "ice_by_stadium": by_stadium.select("Stadium", F.col("mean_TempIce").alias("avg_TempIce")).orderBy(F.desc("avg_TempIce"), "Stadium"),
    }


def export_main_selection(view: DataFrame, path, **chosen):
    export_selection(selection.select_rows(view, **chosen), path)


def prediction_figures(
    view: DataFrame, distance, stadium=fixed.ALL_STADIUMS, countries=None
):
    """Count, points and straight trend of the prediction page."""
    points = selection.prediction_points(view, distance, stadium, countries)
    return {
        "count": selection.selection_count(view, distance, stadium, countries),
        "points": points,
        "trend": stats.linear_trend(points, "RaceTime", "Prediction"),
    }


def stadium_facet(view: DataFrame, countries=None, selected=None, fallback=None):
    """Stadium options of the chosen countries and the choices that remain.

    Without chosen countries every stadium is on offer and the choice stays.
    """
    options = selection.stadium_options(view, countries)
    if selected is None:
        return options, None
    if not countries:
        return options, selected
    return options, selection.retain_selection(selected, options, "Stadium", fallback)


def athlete_facet(view: DataFrame, selected=None, **chosen):
    """Athlete options left by the other filters and the choices that remain."""
    options = selection.athlete_options(view, **chosen)
    if selected is None:
        return options, None
    return options, selection.retain_selection(selected, options, "Name")


def as_long_form(figures, parts):
    """Stack figures as (part, key, measure, value) rows.

    ``parts`` maps a figure to its key column, to several, or to None for a
    single row.  All other columns are measures, as doubles.
    """
    stacked = None
    for part, key in parts.items():
        df = figures[part]
        keys = [key] if isinstance(key, str) else list(key or [])
        measures = [c for c in df.columns if c not in keys]
        pairs = F.array(
            *[
                F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
                for c in measures
            ]
        )
        key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        rows = df.select(
            F.lit(part).alias("part"), key_text.alias("key"), F.inline(pairs)
        )
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked
