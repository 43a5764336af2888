"""Whole plans: curated view, landed-to-enriched, pages and facets."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.plans import dashboard, enrichment
from rinkflow.plans.catalog import landing
from rinkflow.plans.catalog.joined import _wanted
from rinkflow.plans.catalog.registry import SQL, plain, query
from rinkflow.plans.catalog.standins import FULL, full_view, stored_view, table
from rinkflow.plans.catalog.statistics import box_sql, histogram_sql, lowess_steps
from rinkflow.session import scratch_folder


@query("WITH " + FULL + """
SELECT * EXCLUDE ("RaceDistance") REPLACE (CAST("Date" AS VARCHAR) AS "Date",
  round("RaceTime", 4) AS "RaceTime", round("Difference", 4) AS "Difference",
  round("CorrectedDifference", 4) AS "CorrectedDifference", round("Prediction", 4) AS "Prediction")
FROM full_view""")
def q1_curated_view(spark, folder):
    return plain(full_view(spark, folder).drop("RaceDistance"))


def long_sql(part, key, source, measures):
    """SQL for one part of a bundle in long form."""
    names = ", ".join(f'"{m}"' for m in measures)
    return (
        f"SELECT '{part}' AS part, {key} AS key, measure, value FROM "
        f"(SELECT * REPLACE ({', '.join(f'CAST({chr(34)}{m}{chr(34)} AS DOUBLE) AS {chr(34)}{m}{chr(34)}' for m in measures)}) FROM ({source})) "
        f"UNPIVOT INCLUDE NULLS (value FOR measure IN ({names}))"
    )


_BOX_NAMES = ["n", "min", "q1", "median", "q3", "max", "lower_fence", "upper_fence"]

MAIN = (
    "WITH " + FULL + """,
chosen AS (SELECT * FROM full_view WHERE "Gender" IN ('Men', 'Women') AND "Distance" = 500),
fences AS (SELECT quantile_cont("RaceTime", 0.25) AS a, quantile_cont("RaceTime", 0.75) AS b FROM chosen),
""" + histogram_sql("chosen", '"TempIce"') + "," + lowess_steps("chosen", '"TempIce"', '"RaceTime"') + """,
points AS (
  SELECT "TempIce", "RaceTime", "Name", "Stadium", CAST("Date" AS VARCHAR) AS "Date", "Race", "Year",
    "RaceTime" < a - 1.5 * (b - a) OR "RaceTime" > b + 1.5 * (b - a) AS is_outlier FROM chosen, fences)
""" + " UNION ALL ".join([
        long_sql("summary", "''", """SELECT count(*) AS n, round(avg("RaceTime"), 6) AS "mean_RaceTime",
          round(stddev_samp("RaceTime"), 6) AS "std_RaceTime", round(avg("TempIce"), 6) AS "mean_TempIce",
          round(stddev_samp("TempIce"), 6) AS "std_TempIce" FROM chosen""",
                 ["n", "mean_RaceTime", "std_RaceTime", "mean_TempIce", "std_TempIce"]),
        long_sql("outlier_count", "''", """SELECT count(*) AS n_outliers FROM chosen, fences
          WHERE "RaceTime" < a - 1.5 * (b - a) OR "RaceTime" > b + 1.5 * (b - a)""", ["n_outliers"]),
        long_sql("outliers", """"Name" || '|' || "Stadium" || '|' || "Date" || '|' || "Race\"""",
                 'SELECT "Name", "Stadium", "Date", "Race", round("RaceTime", 6) AS "RaceTime" FROM points WHERE is_outlier',
                 ["RaceTime"]),
        long_sql("scatter", """"Name" || '|' || "Stadium" || '|' || "Date\"""",
                 """SELECT "Name", "Stadium", "Date", round("TempIce", 6) AS "TempIce", round("RaceTime", 6) AS "RaceTime",
                 "Year", CAST(is_outlier AS INTEGER) AS is_outlier FROM points""",
                 ["TempIce", "RaceTime", "Year", "is_outlier"]),
        long_sql("export", """"Name" || '|' || "Stadium" || '|' || "Date" || '|' || "Race\"""",
                 """SELECT "Name", "Stadium", CAST("Date" AS VARCHAR) AS "Date", "Race", round("RaceTime", 6) AS "RaceTime",
                 round("SeasonalBest", 6) AS "SeasonalBest", round("TempIce", 6) AS "TempIce" FROM chosen""",
                 ["RaceTime", "SeasonalBest", "TempIce"]),
        long_sql("trend", "''", "SELECT round(x, 6) AS x, round(trend, 6) AS trend FROM f3", ["x", "trend"]),
        long_sql("time_by_year", 'CAST("Year" AS VARCHAR)',
                 'SELECT "Year", ' + box_sql('"RaceTime"') + " FROM chosen GROUP BY 1", _BOX_NAMES),
        long_sql("ice_histogram", "CAST(bin AS VARCHAR)",
                 """SELECT bin, round(low + (bin - 1) * ((high - low) / 20), 6) AS bin_start,
                 round(low + bin * ((high - low) / 20), 6) AS bin_end, count(*) AS count
                 FROM binned GROUP BY bin, low, high""", ["bin_start", "bin_end", "count"]),
        long_sql("ice_box", "''", "SELECT " + box_sql('"TempIce"') + " FROM chosen", _BOX_NAMES),
        long_sql("time_by_stadium", '"Stadium"',
                 'SELECT "Stadium", ' + box_sql('"RaceTime"') + " FROM chosen GROUP BY 1", _BOX_NAMES),
        long_sql("stadium_order", '"Stadium"',
                 'SELECT "Stadium", round(sum("RaceTime"), 6) AS total FROM chosen GROUP BY 1', ["total"]),
        long_sql("ice_by_stadium", '"Stadium"',
                 'SELECT "Stadium", round(avg("TempIce"), 6) AS "avg_TempIce" FROM chosen GROUP BY 1',
                 ["avg_TempIce"]),
    ])
)


@query(MAIN)
def q3_main_page(spark, folder):
    """All figures of the main page and its export, 500 m."""
    view = stored_view(spark, folder)
    figures = dashboard.main_figures(view)
    path = scratch_folder(spark)
    dashboard.export_main_selection(view, path)
    exported = spark.read.option("header", "true").csv(path)
    row = ["Name", "Stadium", "Date", "Race"]
    figures["export"] = exported.select(*row, "RaceTime", "SeasonalBest", "TempIce")
    figures["outliers"] = figures["outliers"].select(*row, "RaceTime")
    parts = {
        "summary": None, "outlier_count": None, "outliers": row, "scatter": row[:3], "export": row, "trend": None,
        "time_by_year": "Year", "ice_histogram": "bin",
        "ice_box": None, "time_by_stadium": "Stadium", "stadium_order": "Stadium",
        "ice_by_stadium": "Stadium",
    }
    return plain(dashboard.as_long_form(figures, parts), 6)


@query("WITH " + FULL + """,
chosen AS (SELECT * FROM full_view WHERE "Distance" = 1000 AND "RinkCountry" IN ('Land_0', 'Land_1')),
line AS (SELECT round(regr_slope("Prediction", "RaceTime"), 4) AS slope,
  round(regr_intercept("Prediction", "RaceTime"), 4) AS intercept,
  round(regr_r2("Prediction", "RaceTime"), 4) AS r2, regr_count("Prediction", "RaceTime") AS n FROM chosen)
""" + " UNION ALL ".join([
    long_sql("count", "''", "SELECT count(*) AS n FROM chosen", ["n"]),
    long_sql("trend", "''", "SELECT * FROM line", ["slope", "intercept", "r2", "n"]),
    long_sql("points", """"Name" || '|' || "Gender\"""",
             'SELECT "Name", "Gender", round("RaceTime", 4) AS "RaceTime", round("Prediction", 4) AS "Prediction" FROM chosen',
             ["RaceTime", "Prediction"]),
]))
def q4_prediction_page(spark, folder):
    view = stored_view(spark, folder)
    figures = dashboard.prediction_figures(view, 1000, countries=["Land_0", "Land_1"])
    return plain(dashboard.as_long_form(figures, {"count": None, "trend": None, "points": ["Name", "Gender"]}))


@query("WITH " + FULL + """
SELECT 'stadium option' AS kind, "Stadium" AS value FROM full_view WHERE "RinkCountry" = 'Land_1' GROUP BY ALL
UNION ALL
SELECT 'stadium kept', "Stadium" FROM full_view WHERE "RinkCountry" = 'Land_1'
  AND "Stadium" IN ('Rink_1', 'Rink_2') GROUP BY ALL
UNION ALL
SELECT 'fallback', 'All' WHERE NOT EXISTS (FROM full_view WHERE "RinkCountry" = 'Land_1' AND "Stadium" = 'Rink_0')
UNION ALL
SELECT 'athlete option', "Name" FROM full_view
WHERE "Gender" = 'Women' AND "Distance" = 3000 AND "Year" BETWEEN 1995 AND 1997 AND "Stadium" = 'Rink_4'
GROUP BY ALL
UNION ALL
SELECT 'athlete kept', "Name" FROM full_view
WHERE "Gender" = 'Women' AND "Distance" = 3000 AND "Year" BETWEEN 1995 AND 1997 AND "Stadium" = 'Rink_4'
  AND "Name" IN (SELECT c_name FROM customer WHERE c_custkey % 3 = 0)
GROUP BY ALL""")
def q5_cascading_facets(spark, folder):
    view = stored_view(spark, folder)
    stadiums, kept = dashboard.stadium_facet(view, ["Land_1"], _wanted(spark, ["Rink_1", "Rink_2"]))
    _, fallback = dashboard.stadium_facet(view, ["Land_1"], _wanted(spark, ["Rink_0"]), fixed.ALL_STADIUMS)
    chosen = table(spark, folder, "customer").where("c_custkey % 3 = 0").select(F.col("c_name").alias("Name"))
    athletes, athletes_kept = dashboard.athlete_facet(
        view, chosen, gender=["Women"], distance=3000, years=(1995, 1997), stadiums=["Rink_4"]
    )
    labelled = [
        df.select(F.lit(kind).alias("kind"), F.col(col).alias("value"))
        for kind, df, col in (
            ("stadium option", stadiums, "Stadium"), ("stadium kept", kept, "Stadium"),
            ("fallback", fallback, "Stadium"), ("athlete option", athletes, "Name"),
            ("athlete kept", athletes_kept, "Name"),
        )
    ]
    return reduce(DataFrame.union, labelled)


_LANDED = """
landed AS (
  SELECT o_orderkey AS k, c_custkey AS c, c_acctbal, c_nationkey, o_totalprice,
    CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS later,
    ([500, 1000, 1500, 3000, 5000, 10000])[o_orderkey % 6 + 1] AS d,
    o_orderkey % 23 <> 0 AS titled, c_custkey % 7 <> 0 AS placed,
    CASE WHEN placed THEN 'Rink_' || c_mktsegment END AS "Stadium",
    CASE WHEN c_custkey % 5 = 0 THEN 'Tromsø_' || c_name ELSE c_name END AS "Event",
    CASE WHEN titled THEN d || 'm_' || CASE WHEN o_orderkey % 2 = 0 THEN 'Men' ELSE 'Women' END
      ELSE 'Competition_' || (o_orderkey + 1) END AS "Race"
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 13 <> 0)
"""


@query("WITH " + _LANDED + """
SELECT "Stadium", CAST(later AS VARCHAR) AS "Date", "Event", "Race", p AS "Rank", CAST(p AS VARCHAR) AS "Nr",
  CASE WHEN p = 1 THEN 'Anna_Van_' || translate(CAST(c AS VARCHAR), '0123456789', 'abcdefghij')
    ELSE 'Zed_Nobody' END AS "Name",
  'n' || (c % 5) AS "Country", p AS "Pair", NULL::VARCHAR AS "Lane", (k % 60 + 30) || ',5' AS "Time",
  NULL::VARCHAR AS "Behind", 'Women' AS "Gender", CASE WHEN p = 1 THEN CAST(c AS VARCHAR) END AS "SkaterID",
  CASE WHEN p = 1 AND titled AND year(later) - 1 = 1995 + c % 4 THEN CAST(
    CASE d WHEN 500 THEN c % 50 + 37 WHEN 1000 THEN c % 50 + 75 END + 0.25 AS DOUBLE) END AS "SeasonalBest",
  CASE WHEN titled THEN (p - 1) * CASE d WHEN 500 THEN 135 WHEN 1000 THEN 165 WHEN 1500 THEN 200
    WHEN 3000 THEN 330 WHEN 5000 THEN 480 ELSE 0 END END AS "EstimatedTFM",
  "EstimatedTFM" + 60 AS "EstimatedTFMBuffer"
FROM landed, (VALUES (1), (2)) v(p) WHERE p = 1 OR (k % 3 <> 0 AND k % 4 <> 0)""")
def q2_enriched_results(spark, folder):
    """Landed documents to enriched results.

    A 10000 m of two pairs has its break after the first, so the second pair
    is back at 0.
    """
    results, _ = enrichment.read_and_enrich(spark, landing.landed_races(spark, folder))
    return plain(results)


@query("WITH " + _LANDED + """,
measured AS (
  SELECT *, CASE WHEN p = 0 THEN day ELSE later END AS at FROM landed, (VALUES (0), (1)) v(p)
  WHERE p = 0 OR k % 2 = 1),
weather AS (SELECT DISTINCT c_acctbal AS lat, c_nationkey AS lon, CAST(o_orderdate AS DATE) AS at
            FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT "Stadium", CAST(m.at AS VARCHAR) AS "Date", "Event", "Race",
  CASE WHEN placed THEN 'N' || c_nationkey END AS "Country", k % 6 AS "Distance",
  CASE WHEN p = 0 THEN 'start' ELSE 'end' END AS "Occasion",
  CASE WHEN p = 0 THEN '10:11:12' ELSE '11:30:00' END AS "Time",
  round(o_totalprice + p, 4) AS "TempIndoors", -5.5::DOUBLE AS "IceTemperature",
  CAST(40 + p AS DOUBLE) AS "Humidity",
  CASE WHEN w.at IS NOT NULL THEN CAST(day(m.at) + p AS DOUBLE) END AS "TempOutdoors",
  CASE WHEN w.at IS NOT NULL THEN CAST(1000 + c_nationkey + p AS DOUBLE) END AS "AirpressureSurface",
  CASE WHEN w.at IS NOT NULL THEN CAST(1010 + p AS DOUBLE) END AS "AirpressureSealevel"
FROM measured m LEFT JOIN weather w ON placed AND c_acctbal = lat AND c_nationkey = lon AND m.at = w.at""")
def q2_enriched_conditions(spark, folder):
    """Landed documents to conditions with outdoor weather."""
    _, conditions = enrichment.read_and_enrich(spark, landing.landed_races(spark, folder))
    return plain(enrichment.final_conditions(conditions))


def _loaded_sql(kind, sql, columns):
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"SELECT '{kind}' AS kind, concat_ws('|', {texts}) AS row FROM ({sql})"


_RESULT_TEXTS = [f'"{c}"' for c in fixed.RESULT_COLUMNS] + ["printf('%.2f', \"SeasonalBest\")", '"EstimatedTFM"', '"EstimatedTFMBuffer"']
_CONDITION_TEXTS = [
    f'"{c}"' for c in ("Stadium", "Date", "Event", "Race", "Country", "Distance", "Occasion", "Time", "TempIndoors",
                       "IceTemperature", "Humidity", "TempOutdoors", "AirpressureSurface", "AirpressureSealevel")
]


@query(
    _loaded_sql("results", SQL["q2_enriched_results"], _RESULT_TEXTS) + " UNION ALL "
    + _loaded_sql("conditions", SQL["q2_enriched_conditions"].replace("round(o_totalprice + p, 4)", "o_totalprice + p"), _CONDITION_TEXTS)
)
def q2_loaded_tables(spark, folder):
    """The whole workflow: landed documents, landed a second time, to both text tables, read back."""
    path = landing.landing_folder(spark, folder, scratch_folder(spark))
    landing.landing_folder(spark, folder, path, again=True)
    names = "rinkflow_results", "rinkflow_conditions"
    enrichment.load_tables(*enrichment.read_and_enrich(spark, path), scratch_folder(spark), names)
    rows = [
        spark.table(name).select(F.lit(kind).alias("kind"), F.concat_ws("|", "*").alias("row"))
        for kind, name in zip(("results", "conditions"), names)
    ]
    return rows[0].union(rows[1])
