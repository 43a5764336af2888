"""Aggregates of a selection: means, spreads, histogram, linear trend, totals."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.functions.model import performance_difference
from rinkflow.operators.quantiles import box_by


def corrected(difference, lowest):
    """The difference shifted by -5 x the lowest one."""
    difference = F.col(difference) if isinstance(difference, str) else difference
    return difference + F.lit(float(fixed.CORRECTION_FACTOR)) * lowest


def add_corrected_difference(
    df: DataFrame, best="SeasonalBest", time="RaceTime",
    out="Difference", corrected_out="CorrectedDifference",
):
    """Season best minus time, and the same shifted by -5 x its minimum.

    The minimum is taken over all of ``df`` as a one-value subquery.
    """
    difference = performance_difference(best, time)
    lowest = df.agg(F.min(difference).alias("m")).scalar()
    return df.withColumns({out: difference, corrected_out: corrected(difference, lowest)})


def avg_by(df: DataFrame, by, value, out=None):
    """Mean per group, highest first."""
    out = out or f"avg_{value}"
    return df.groupBy(by).agg(F.avg(value).alias(out)).orderBy(F.desc(out), by)


def summary_stats(df: DataFrame, cols=("RaceTime", "TempIce")):
    """Row count, means and sample standard deviations."""
    measures = []
    for c in cols:
        measures += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}")]
    return df.agg(F.count("*").alias("n"), *measures)


def histogram(df: DataFrame, col, bins=fixed.HISTOGRAM_BINS, ends=None):
    """Counts in ``bins`` equal-width bins; empty bins have no row.

    The maximum belongs to the last bin; a constant column fills bin 1.
    ``ends``, a column of (low, high), spares the pass that finds them.
    """
    values = df.select(F.col(col).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    if ends is None:
        ends = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high")).alias("s")).scalar()
    # Each row is binned against the scalar ends, so a task shuffles at most ``bins`` rows.
    placed = values.withColumn("e", ends)
    bucket = F.least(F.width_bucket("v", "e.low", "e.high", F.lit(bins)), F.lit(bins))
    binned = placed.select(
        F.when(F.col("e.low") == F.col("e.high"), 1).otherwise(bucket).cast("int").alias("bin"),
        F.col("e.low").alias("low"),
        ((F.col("e.high") - F.col("e.low")) / bins).alias("width"),
    )
    return (
        binned.groupBy("bin", "low", "width")
        .agg(F.count("*").alias("count"))
        .select(
            "bin",
            (F.col("low") + (F.col("bin") - 1) * F.col("width")).alias("bin_start"),
            (F.col("low") + F.col("bin") * F.col("width")).alias("bin_end"),
            "count",
        )
    )


def histogram_marginal(df: DataFrame, col):
    """The box drawn beside the histogram."""
    return box_by(df, [], col)


def linear_trend(df: DataFrame, x, y):
    """Ordinary least squares line of ``y`` on ``x``."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def category_order(df: DataFrame, category, value):
    """Categories by total value, highest first."""
    return (
        df.groupBy(category)
        .agg(F.sum(value).alias("total"))
        .orderBy(F.desc("total"), category)
    )


def batch_totals(results: DataFrame, conditions: DataFrame, batch="batch"):
    """Rows of both tables per batch and, under a NULL batch, in all."""
    marks = results.select(
        batch, F.lit(1).alias("r"), F.lit(0).alias("c")
    ).unionByName(conditions.select(batch, F.lit(0).alias("r"), F.lit(1).alias("c")))
    per_batch = marks.groupBy(batch).agg(
        F.sum("r").alias("n_results"), F.sum("c").alias("n_conditions")
    )
    return per_batch.rollup(batch).agg(
        F.sum("n_results").alias("n_results"), F.sum("n_conditions").alias("n_conditions")
    )


def enrichment_coverage(df: DataFrame, flag="WeatherMatched"):
    """Rows that a lookup changed, of all."""
    return df.agg(
        F.count_if(F.col(flag)).alias("updated"), F.count("*").alias("total")
    )
