"""Aggregates over the view and over whole tables."""

from pyspark.sql import functions as F

from rinkflow.operators import quantiles, selection, stats
from rinkflow.operators.trend import lowess_trend
from rinkflow.plans import curated
from rinkflow.plans.catalog.joined import MODELS
from rinkflow.plans.catalog.registry import plain, query
from rinkflow.plans.catalog.standins import (
    CONDITIONS, LIGHT, RACES, conditions, light_view, races, table,
)

_BOX = """count(*) AS n, round(min({v}), 6) AS min, round(quantile_cont({v}, 0.25), 6) AS q1,
  round(quantile_cont({v}, 0.5), 6) AS median, round(quantile_cont({v}, 0.75), 6) AS q3,
  round(max({v}), 6) AS max,
  round(quantile_cont({v}, 0.25) - 1.5 * (quantile_cont({v}, 0.75) - quantile_cont({v}, 0.25)), 6) AS lower_fence,
  round(quantile_cont({v}, 0.75) + 1.5 * (quantile_cont({v}, 0.75) - quantile_cont({v}, 0.25)), 6) AS upper_fence"""


def box_sql(value):
    return _BOX.format(v=value)


@query("WITH " + RACES + """
SELECT l_orderkey, l_linenumber, l_partkey, round("SeasonalBest" - "RaceTime", 4) AS "Difference",
  round("SeasonalBest" - "RaceTime" - 5 * min("SeasonalBest" - "RaceTime") OVER (), 4) AS "CorrectedDifference"
FROM races""")
def a1_corrected_difference(spark, folder):
    rows = stats.add_corrected_difference(races(spark, folder))
    return plain(rows.select("l_orderkey", "l_linenumber", "l_partkey", "Difference", "CorrectedDifference"))


@query("WITH " + LIGHT + """
SELECT "Stadium", round(avg("TempIce"), 4) AS "avg_TempIce" FROM light WHERE "Distance" = 500
GROUP BY 1 ORDER BY 2 DESC""")
def a2_avg_by(spark, folder):
    """Average ice temperature by stadium for 500 m."""
    rows = selection.select_rows(light_view(spark, folder))
    return plain(stats.avg_by(rows, "Stadium", "TempIce"))


@query("WITH " + LIGHT + """
SELECT count(*) AS n, round(avg("RaceTime"), 4) AS "mean_RaceTime", round(stddev_samp("RaceTime"), 4) AS "std_RaceTime",
  round(avg("TempIce"), 4) AS "mean_TempIce", round(stddev_samp("TempIce"), 4) AS "std_TempIce" FROM light""")
def a3_summary_stats(spark, folder):
    return plain(stats.summary_stats(light_view(spark, folder)))


@query("""
SELECT round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(quantile_cont(l_extendedprice, 0.75), 4) AS q3,
  round(quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25), 4) AS iqr FROM lineitem""")
def a4_quartiles(spark, folder):
    return plain(quantiles.quartiles(table(spark, folder, "lineitem"), "l_extendedprice"))


@query("WITH " + RACES + """
SELECT "Stadium", round(quantile_cont("RaceTime", 0.25), 6) AS q1, round(quantile_cont("RaceTime", 0.75), 6) AS q3,
  round(quantile_cont("RaceTime", 0.75) - quantile_cont("RaceTime", 0.25), 6) AS iqr FROM races GROUP BY 1""")
def a4_quartiles_grouped(spark, folder):
    return plain(quantiles.quartiles(races(spark, folder), "RaceTime", ["Stadium"]), 6)


_FENCES = """q AS (
  SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)"""


@query("WITH " + _FENCES + """
SELECT event_id, value FROM events, q WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)""")
def a5_outliers(spark, folder):
    return plain(quantiles.outliers(table(spark, folder, "events"), "value").select("event_id", "value"))


@query("WITH " + _FENCES + """
SELECT count(*) AS n_outliers FROM events, q WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)""")
def a5_outlier_count(spark, folder):
    return plain(quantiles.outlier_count(table(spark, folder, "events"), "value"))


@query("WITH " + LIGHT + 'SELECT "Year", ' + box_sql('"RaceTime"') + " FROM light GROUP BY 1")
def a6_box_by_year(spark, folder):
    return plain(quantiles.box_by(light_view(spark, folder), "Year", "RaceTime"), 6)


@query("WITH " + LIGHT + 'SELECT "Stadium", ' + box_sql('"RaceTime"') + " FROM light GROUP BY 1")
def a7_box_by_stadium(spark, folder):
    return plain(quantiles.box_by(light_view(spark, folder), "Stadium", "RaceTime"), 6)


def histogram_sql(source, value):
    return f"""
ends AS (SELECT min({value}) AS low, max({value}) AS high FROM {source}),
binned AS (
  SELECT CASE WHEN low = high THEN 1
    ELSE least(CAST(floor(20 * ({value} - low) / (high - low)) AS BIGINT) + 1, 20) END AS bin, low, high
  FROM {source}, ends WHERE {value} IS NOT NULL)"""


_HISTOGRAM = """SELECT bin, round(low + (bin - 1) * ((high - low) / 20), 4) AS bin_start,
  round(low + bin * ((high - low) / 20), 4) AS bin_end, count(*) AS count FROM binned GROUP BY bin, low, high"""


@query("WITH " + histogram_sql("events", "value") + _HISTOGRAM)
def a8_histogram(spark, folder):
    return plain(stats.histogram(table(spark, folder, "events"), "value"))


@query("WITH " + LIGHT + "SELECT " + box_sql('"TempIce"') + " FROM light")
def a8_histogram_marginal(spark, folder):
    return plain(stats.histogram_marginal(light_view(spark, folder), "TempIce"), 6)


@query("""
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n
FROM lineitem""")
def a9_linear_trend(spark, folder):
    line = stats.linear_trend(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")
    return line.select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
        F.round("r2", 6).alias("r2"), "n",
    )


def lowess_steps(source, x, y, rounds=3):
    """CTEs f0 to f<rounds> (x, trend): one pair per round, the sums per x, then the lines at every x."""
    steps = [f"""
w0 AS (SELECT {x} AS x, {y} AS y, 1.0::DOUBLE AS w FROM {source}),
dense AS (SELECT x, count(*) AS n FROM w0 GROUP BY 1),
reach AS (
  SELECT a.x, abs(p.x - a.x) AS d,
    sum(p.n) OVER (PARTITION BY a.x ORDER BY abs(p.x - a.x), p.x ROWS UNBOUNDED PRECEDING) AS seen
  FROM dense a, dense p),
width AS (
  SELECT x, min(d) AS h FROM reach
  WHERE seen >= (SELECT greatest(2, floor(2.0::DOUBLE / 3 * count(*))) FROM w0) GROUP BY 1)"""]
    for i in range(rounds + 1):
        steps.append(f"""
s{i} AS (SELECT x, sum(w) AS w, sum(w * y) AS wy FROM w{i} GROUP BY 1),
m{i} AS (
  SELECT x, sum(k * w) AS sw, sum(k * w * t) AS st, sum(k * w * t * t) AS stt,
    sum(k * wy) AS sy, sum(k * wy * t) AS sty
  FROM (SELECT a.x, p.x - a.x AS t, p.w, p.wy,
          pow(1 - pow(least(abs(p.x - a.x) / h, 1), 3), 3) AS k FROM width a, s{i} p)
  GROUP BY 1),
f{i} AS (SELECT x, (stt * sy - st * sty) / (sw * stt - st * st) AS trend FROM m{i})""")
        if i < rounds:
            steps.append(f"""
r{i} AS (SELECT x, y, abs(y - trend) AS r FROM w{i} JOIN f{i} USING (x)),
w{i + 1} AS (
  SELECT x, y, pow(1 - pow(least(r / (SELECT 6 * quantile_cont(r, 0.5) FROM r{i}), 1), 2), 2) AS w
  FROM r{i})""")
    return ",".join(steps)


@query("WITH " + RACES + "," + lowess_steps("races", '"SeasonalBest"', '"RaceTime"') + " SELECT x, round(trend, 4) AS trend FROM f3")
def a10_lowess_trend(spark, folder):
    return plain(lowess_trend(races(spark, folder), "SeasonalBest", "RaceTime"))


@query()
def a10_lowess_trend_continuous(spark, folder):
    """Quantity by extended price, which hardly repeats: too many distinct x for SQL."""
    return plain(lowess_trend(table(spark, folder, "lineitem"), "l_extendedprice", "l_quantity"))


@query("WITH " + CONDITIONS + """,
marks AS (SELECT year("Date") AS batch, 1 AS r, 0 AS c FROM races
          UNION ALL SELECT year("Date"), 0, 1 FROM conditions)
SELECT batch, CAST(sum(r) AS BIGINT) AS n_results, CAST(sum(c) AS BIGINT) AS n_conditions FROM marks GROUP BY ROLLUP (batch)""")
def a15_batch_totals(spark, folder):
    year = F.year("Date").alias("batch")
    return plain(
        stats.batch_totals(races(spark, folder).select(year), conditions(spark, folder).select(year))
    )


@query("WITH " + LIGHT + 'SELECT min("Year") AS min_year, max("Year") AS max_year FROM light')
def a16_year_bounds(spark, folder):
    return plain(selection.year_bounds(light_view(spark, folder)))


@query("WITH " + LIGHT + """
SELECT count(*) AS n FROM light WHERE "Distance" = 1000 AND "Stadium" = 'Rink_3'
  AND "RinkCountry" IN ('Land_2', 'Land_3')""")
def a17_selection_count(spark, folder):
    view = light_view(spark, folder)
    return plain(selection.selection_count(view, 1000, "Rink_3", ["Land_2", "Land_3"]))


@query("WITH " + LIGHT + 'SELECT DISTINCT "Stadium" FROM light ORDER BY 1')
def a19_distinct_values(spark, folder):
    return selection.distinct_values(light_view(spark, folder), "Stadium")


@query("WITH " + LIGHT + """
SELECT "Stadium", round(sum("RaceTime"), 2) AS total FROM light GROUP BY 1""")
def t4_category_order(spark, folder):
    return plain(stats.category_order(light_view(spark, folder), "Stadium", "RaceTime"), 2)


@query("WITH " + RACES + """
SELECT l_orderkey, l_linenumber, l_partkey, "RaceDistance" AS "Distance",
  round("SeasonalBest" - round(1 / sqrt(
    4.29e-12::DOUBLE + 1.212e-08::DOUBLE + 3.763e-09::DOUBLE + 9.894e-09::DOUBLE * g - 2.579e-09::DOUBLE * "Lane"
    + 1.763e-12::DOUBLE * l_suppkey + 4.29e-09::DOUBLE * 1000 + 5.413e-10::DOUBLE * l_quantity
    + 1.559e-09::DOUBLE * (-l_tax) - 1.162e-10::DOUBLE * l_discount + 6.082e-11::DOUBLE * l_quantity
  ) - 480.25, 2), 4) AS "Prediction"
FROM (SELECT *, CASE "Gender" WHEN 'Men' THEN 0 ELSE 1 END AS g FROM races) WHERE "RaceDistance" = 1000
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, 800, NULL FROM races WHERE "RaceDistance" <> 1000""")
def f20_predicted_performance(spark, folder):
    """Prediction of the 1000 m entries; other entries get a distance without a model."""
    distance = F.when(F.col("RaceDistance") == 1000, 1000).otherwise(800)
    rows = races(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", "Gender", "SeasonalBest",
        F.col("Lane").cast("string").alias("Lane"),
        F.col("l_suppkey").alias("EstimatedTFM"), distance.alias("Distance"),
        F.col("l_quantity").alias("TempIndoors"), (-F.col("l_tax")).alias("TempIce"),
        F.col("l_discount").alias("Humidity"), F.col("l_quantity").alias("AirpressureSurface"),
    )
    return plain(
        curated.add_prediction(rows).select(
            "l_orderkey", "l_linenumber", "l_partkey", "Distance", "Prediction"
        )
    )


@query("WITH " + RACES + "," + MODELS + """
SELECT l_orderkey, l_linenumber, l_partkey, "RaceDistance" AS "Distance",
  round("SeasonalBest" - round(1 / sqrt(CASE WHEN den > 0 THEN den END) - 480.25, 2), 4) AS "Prediction"
FROM (SELECT *, c1 + c2 + c3 + g * CASE "Gender" WHEN 'Men' THEN 0 ELSE 1 END + l * "Lane" + t * l_suppkey
    + m * "RaceDistance" + i * l_quantity + c * (-l_tax) + h * l_discount + p * l_quantity AS den
  FROM races JOIN models ON d = "RaceDistance")""")
def f20_all_models(spark, folder):
    """Prediction of every entry by the model of its distance."""
    rows = races(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", "Gender", "SeasonalBest",
        F.col("Lane").cast("string").alias("Lane"),
        F.col("l_suppkey").alias("EstimatedTFM"), F.col("RaceDistance").alias("Distance"),
        F.col("l_quantity").alias("TempIndoors"), (-F.col("l_tax")).alias("TempIce"),
        F.col("l_discount").alias("Humidity"), F.col("l_quantity").alias("AirpressureSurface"),
    )
    return plain(
        curated.add_prediction(rows).select("l_orderkey", "l_linenumber", "l_partkey", "Distance", "Prediction")
    )
