"""Sources and sinks: documents and files are derived from the tables by Spark,
written to the shared folder and read back."""

from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.plans.catalog import landing
from rinkflow.plans.catalog.registry import plain, query
from rinkflow.plans.catalog.standins import LIGHT, RACES, light_view, races, table
from rinkflow.session import scratch_folder
from rinkflow.sources import delimited, landed_json, tables


def _landed(spark, documents, **options):
    path = scratch_folder(spark)
    landed_json.write_documents(documents, path, **options)
    return path


@query("""
SELECT 'E' || n AS event_id FROM (SELECT o_orderkey * 3 + i AS n FROM orders, (VALUES (0), (1), (2)) v(i))
WHERE n % 17 <> 0 AND n % 19 <> 0""")
def s1_read_event_pages(spark, folder):
    path = landing.write_text_documents(landing.event_pages(spark, folder), scratch_folder(spark))
    return landed_json.read_event_pages(spark, path)


@query("""
SELECT 'E' || c_custkey AS event_id,
  CASE WHEN c_custkey % 5 = 0 THEN 'Tromsø ' || c_name ELSE c_name END AS event_name,
  CASE WHEN t THEN 'Rink ' || c_mktsegment END AS stadium, CASE WHEN t THEN c_mktsegment END AS city,
  CASE WHEN t THEN 'N' || c_nationkey END AS country, CASE WHEN t THEN c_acctbal END AS latitude,
  CASE WHEN t THEN CAST(c_nationkey AS DOUBLE) END AS longitude
FROM (SELECT *, c_custkey % 7 <> 0 AS t FROM customer)""")
def s2_read_event_details(spark, folder):
    path = _landed(spark, landing.event_details(spark, folder))
    return plain(landed_json.read_event_details(spark, path))


@query("""
SELECT 'E' || p_partkey AS event_id, p_partkey + 1 AS schedule_number, p_name AS title, p_name AS race_name FROM part
UNION ALL
SELECT 'E' || p_partkey, p_partkey % 3, CASE WHEN p_partkey % 2 = 0 THEN p_brand END,
  CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'Competition ' || (p_partkey % 3) END FROM part""")
def s3_read_competitions(spark, folder):
    path = _landed(spark, landing.competitions(spark, folder))
    return plain(landed_json.read_competitions(spark, path))


@query("""
SELECT 'E' || l_orderkey AS event_id, l_partkey AS schedule_number, l_linenumber AS "Distance", p AS position,
  strftime(l_shipdate, '%Y-%m-%d') AS "Date", CASE WHEN p = 0 THEN '10:11:12' END AS "Time",
  CASE WHEN p = 0 THEN 'start' ELSE 'end' END AS "Occasion",
  CASE WHEN p = 1 THEN l_quantity + 1 WHEN l_partkey % 5 <> 0 THEN l_quantity END AS "TempIndoors",
  -l_tax AS "IceTemperature", l_discount AS "Humidity"
FROM lineitem, (VALUES (0), (1)) v(p)""")
def s4_explode_conditions(spark, folder):
    path = _landed(spark, landing.competition_details(spark, folder), **landing.SMALL)
    rows = landed_json.explode_conditions(landed_json.read_competition_details(spark, path))
    return plain(rows.drop("time_stamp"))


@query("""
SELECT 'E' || l_orderkey AS event_id, l_partkey AS schedule_number, r AS "Rank", CAST(l_suppkey AS VARCHAR) AS "Nr",
  CASE WHEN r = 1 THEN 'Ann Lee_van_Dam' ELSE 'Jörg_van_Dam' END AS "Name", l_linestatus AS "Country",
  l_linenumber AS "Pair", CASE WHEN l_partkey % 2 = 0 THEN 'I' END AS "Lane",
  CAST(l_quantity AS INTEGER) || ',5' AS "Time", NULL::VARCHAR AS "Behind",
  CASE WHEN l_returnflag = 'A' THEN 'Women' ELSE 'Men' END AS "Gender"
FROM lineitem, (VALUES (1), (2)) v(r) WHERE r = 1 OR l_partkey % 3 <> 0""")
def s5_explode_results(spark, folder):
    documents = landed_json.read_competition_results(spark, landing.landed_results(spark, folder))
    return plain(landed_json.flatten_results(landed_json.explode_results(documents)))


@query("""
SELECT 'E' || k AS event_id, k AS schedule_number, CASE WHEN k % 3 < 2 THEN k % 50 END AS "Rank",
  CAST(k AS VARCHAR) AS "Nr", k % 9 AS "Pair"
FROM (SELECT o_orderkey AS k FROM orders) WHERE k % 7 <> 0 AND k % 11 <> 0""")
def s5_loose_types(spark, folder):
    """Numbers that landed as text or decimals."""
    path = landing.write_text_documents(landing.loose_results(spark, folder), scratch_folder(spark))
    documents = landed_json.read_competition_results(spark, path)
    rows = landed_json.flatten_results(landed_json.explode_results(documents))
    return plain(rows.select("event_id", "schedule_number", "Rank", "Nr", "Pair"))


@query("""
SELECT 'competition_results' AS kind, CASE WHEN k % 7 = 0 THEN 'damaged' ELSE 'without key' END AS reason,
  count(*) AS n FROM (SELECT o_orderkey AS k FROM orders) WHERE k % 7 = 0 OR k % 11 = 0 GROUP BY ALL""")
def s2_rejected_documents(spark, folder):
    """Documents that give no rows, by reason."""
    path = landing.write_text_documents(landing.loose_results(spark, folder), scratch_folder(spark))
    rejects = landed_json.rejected_documents(spark, path, "competition_results")
    return plain(rejects.where("file IS NOT NULL AND document IS NOT NULL").groupBy("kind", "reason").agg(F.count("*").alias("n")))


def _table_rows(spark, folder):
    return races(spark, folder).select(
        "Stadium", "Date", "Event", "Race", F.col("Pair").alias("Rank"),
        F.concat(F.lit('say "'), F.col("l_returnflag"), F.lit('"; end')).alias("Name"),
        F.col("l_linestatus").alias("Country"), "Pair", "Lane",
        F.col("SeasonalBest").alias("Time"), "Gender",
    )


_FILE_ROWS = "WITH " + RACES + """
SELECT "Stadium", CAST("Date" AS VARCHAR) AS "Date", "Event", "Race", CAST("Pair" AS VARCHAR) AS "Rank",
  NULL::VARCHAR AS "Nr", 'say "' || l_returnflag || '"; end' AS "Name", l_linestatus AS "Country",
  CAST("Pair" AS VARCHAR) AS "Pair", CAST("Lane" AS VARCHAR) AS "Lane",
  CAST("SeasonalBest" AS VARCHAR) AS "Time", NULL::VARCHAR AS "Behind", "Gender" FROM races"""


@query(_FILE_ROWS)
def s6_read_semicolon_csv(spark, folder):
    path = scratch_folder(spark)
    delimited.write_semicolon_csv(_table_rows(spark, folder), path, fixed.RESULT_COLUMNS)
    return delimited.read_semicolon_csv(spark, path, fixed.RESULT_COLUMNS)


@query("WITH " + RACES + """
SELECT "Stadium", CAST("Date" AS VARCHAR) AS "Date", "Pair" + 1 AS next_pair, round("SeasonalBest" + 0.5, 4) AS later
FROM races""")
def s7_read_semicolon_csv_inferred(spark, folder):
    """Typed by inference: the sums work only on numbers."""
    path = scratch_folder(spark)
    delimited.write_semicolon_csv(_table_rows(spark, folder), path, fixed.RESULT_COLUMNS)
    rows = delimited.read_semicolon_csv_inferred(spark, path)
    return plain(
        rows.select(
            "Stadium", "Date", (F.col("Pair") + 1).alias("next_pair"), (F.col("Time") + 0.5).alias("later")
        )
    )


@query("SELECT * FROM (" + _FILE_ROWS + ") UNION ALL SELECT * FROM (" + _FILE_ROWS + ")")
def s8_write_semicolon_csv(spark, folder):
    """A full rewrite followed by one appended batch."""
    path = scratch_folder(spark)
    rows = _table_rows(spark, folder)
    delimited.write_semicolon_csv(rows, path, fixed.RESULT_COLUMNS, "overwrite")
    delimited.write_semicolon_csv(rows, path, fixed.RESULT_COLUMNS, "append")
    return delimited.read_semicolon_csv(spark, path, fixed.RESULT_COLUMNS)


@query("""
SELECT CAST(n_nationkey AS VARCHAR) AS "NATION_KEY", n_name AS "NAME",
  CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_regionkey AS VARCHAR) ELSE '' END AS "REGIONKEY" FROM nation""")
def s9_save_text_table(spark, folder):
    rows = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias(" nation key"), F.col("n_name").alias("Name"),
        F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey")).alias("region-key"),
    )
    tables.save_text_table(rows, "rinkflow_nation", scratch_folder(spark))
    return spark.table("rinkflow_nation")


@query("WITH " + LIGHT + """
SELECT "Stadium", "Race", CAST("Pair" AS VARCHAR) AS "Pair", CAST("SeasonalBest" AS VARCHAR) AS "SeasonalBest"
FROM light WHERE "Gender" IN ('Men', 'Women') AND "Distance" = 500""")
def s10_export_selection(spark, folder):
    from rinkflow.operators.selection import select_rows

    path = scratch_folder(spark)
    rows = select_rows(light_view(spark, folder)).select("Stadium", "Race", "Pair", "SeasonalBest")
    delimited.export_selection(rows, path)
    return spark.read.option("header", "true").csv(path)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS skater_id, CAST(1995 + c_custkey % 4 + y AS INTEGER) AS start, s AS season_pos,
  r AS rec_pos, d AS distance, (c_custkey % 50 + t) || ',25' AS time_text
FROM customer, (VALUES (0, 0, 0, 500, 36), (0, 0, 1, 1000, 75), (0, 0, 2, 500, 37), (0, 1, 0, 1500, 110),
  (1, 2, NULL, NULL, NULL)) v(y, s, r, d, t)""")
def s11_read_season_bests(spark, folder):
    path = _landed(spark, landing.season_bests(spark, folder))
    return plain(landed_json.read_season_bests(spark, path))


@query("""
SELECT c_acctbal AS "Latitude", CAST(c_custkey AS DOUBLE) AS "Longitude",
  '2024-01-05T' || printf('%02d', h) || ':00' AS "HourKey", h AS position,
  CAST(h - c_nationkey AS DOUBLE) AS "TempOutdoors",
  CASE WHEN (h + c_custkey) % 5 <> 0 THEN CAST(h + 1000 AS DOUBLE) END AS "AirpressureSurface",
  CAST(h + 1010 AS DOUBLE) AS "AirpressureSealevel"
FROM customer, range(24) t(h)""")
def s12_read_hourly_weather(spark, folder):
    path = _landed(spark, landing.weather(spark, folder))
    return plain(landed_json.read_hourly_weather(spark, path))


@query("""
SELECT CAST(p_partkey * 2 + i AS VARCHAR) AS id,
  split_part(p_name, ' ', 1) || CASE WHEN i = 1 THEN 'e' ELSE '' END AS givenname,
  split_part(p_name, ' ', 2) AS familyname, 'P' || (p_partkey % 3) AS country, i AS pos
FROM part, (VALUES (0), (1)) v(i)""")
def s13_read_skater_registry(spark, folder):
    path = _landed(spark, landing.skaters(spark, folder))
    return plain(landed_json.read_skater_registry(spark, path))
