"""Enrichment joins, lookups and what prepares them."""

from pyspark.sql import functions as F

from rinkflow.operators import clean, identity, joins, requests, selection, stats
from rinkflow.plans.catalog.registry import plain, query
from rinkflow.plans.catalog.standins import (
    CONDITIONS, LIGHT, LINEITEM_COLUMNS, RACES, RESULTS, conditions, light_view, races, results,
    table,
)


@query("WITH " + CONDITIONS + """
SELECT l_orderkey, l_linenumber, l_partkey, r."Race", c."RinkCountry", c."CondTime", c."TempIce"
FROM races r LEFT JOIN (
  SELECT "Stadium", "Date", "Event", "Race", "RinkCountry", "CondTime", "TempIce" FROM firsts) c
USING ("Stadium", "Date", "Event", "Race")""")
def j1_join_conditions(spark, folder):
    start = clean.occasion_filter(conditions(spark, folder))
    first = clean.first_per_key(start, order=LINEITEM_COLUMNS).drop(*LINEITEM_COLUMNS)
    joined = joins.join_conditions(races(spark, folder), first)
    return plain(
        joined.select("l_orderkey", "l_linenumber", "l_partkey", "Race", "RinkCountry", "CondTime", "TempIce")
    )


def _observations(spark, folder):
    """All events as condition rows; as hourly weather they tell of the hour after them."""
    events = table(spark, folder, "events")
    place = (F.col("user_id") % 10).cast("string").alias("Latitude")
    observed = events.select(
        "event_id", place, F.lit("5.0").alias("Longitude"),
        F.col("ts").cast("date").alias("Date"), F.date_format("ts", "HH:mm:ss").alias("Time"),
        F.col("value").alias("AirpressureSurface"),
    )
    hourly = (
        events.groupBy(
            (F.col("user_id") % 10).cast("double").alias("Latitude"),
            F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:00").alias("HourKey"),
        )
        .agg(F.avg("value").alias("TempOutdoors"), F.count("*").alias("n"))
        .select(
            "Latitude", F.lit(5.0).alias("Longitude"), "HourKey", F.lit(0).alias("position"),
            "TempOutdoors", (F.col("n") + 1000.0).alias("AirpressureSurface"),
            (F.col("n") + 1010.0).alias("AirpressureSealevel"),
        )
    )
    return observed, hourly


WEATHER = """
hourly AS (
  SELECT user_id % 10 AS place, date_trunc('hour', ts) + INTERVAL 1 HOUR AS h, avg(value) AS t, count(*) AS n
  FROM events GROUP BY ALL),
looked_up AS (
  SELECT event_id, t, CASE WHEN n IS NULL THEN value ELSE n + 1000 END AS surface, n + 1010 AS sea,
    n IS NOT NULL AS matched
  FROM (SELECT *, user_id % 10 AS place, date_trunc('hour', ts) AS h FROM events)
  LEFT JOIN hourly USING (place, h))
"""


@query("WITH " + WEATHER + """
SELECT event_id, round(t, 4) AS "TempOutdoors", round(surface, 4) AS "AirpressureSurface",
  round(sea::DOUBLE, 4) AS "AirpressureSealevel", matched AS "WeatherMatched" FROM looked_up""")
def j2_join_weather(spark, folder):
    joined = joins.join_weather(*_observations(spark, folder))
    return plain(
        joined.select("event_id", "TempOutdoors", "AirpressureSurface", "AirpressureSealevel", "WeatherMatched")
    )


@query("WITH " + WEATHER + """
SELECT count(*) FILTER (matched) AS updated, count(*) AS total FROM looked_up""")
def a18_enrichment_coverage(spark, folder):
    return plain(stats.enrichment_coverage(joins.join_weather(*_observations(spark, folder))))


@query("WITH " + RESULTS + """,
bests AS (SELECT "SkaterID", year("Date") AS y, "RaceDistance", min("RaceTime") AS best
          FROM results GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_partkey, r."SkaterID", round(b.best, 4) AS "SeasonalBest"
FROM results r LEFT JOIN bests b
  ON r."SkaterID" = b."SkaterID" AND year(r."Date") - 1 = b.y AND r."RaceDistance" = b."RaceDistance" """)
def j3_join_previous_season_best(spark, folder):
    rows = results(spark, folder)
    bests = rows.groupBy(
        F.col("SkaterID").alias("skater_id"), F.year("Date").alias("start"),
        F.col("RaceDistance").alias("distance"),
    ).agg(F.min("RaceTime").alias("seconds"))
    joined = joins.join_previous_season_best(rows, bests)
    return plain(joined.select("l_orderkey", "l_linenumber", "l_partkey", "SkaterID", "SeasonalBest"))


def _order_names(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.concat(F.lit(" "), F.col("c_name")).alias("Name"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(" ")).alias("Country"),
    )
    return orders.join(customers, "o_custkey")


@query("""
SELECT o_orderkey, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS "SkaterID"
FROM orders JOIN customer ON o_custkey = c_custkey""")
def j4_map_ids_back(spark, folder):
    key = F.col("c_custkey")
    resolved = table(spark, folder, "customer").select(
        F.col("c_name").alias("Name"), F.col("c_nationkey").cast("string").alias("Country"),
        F.when(key % 4 != 0, key.cast("string")).alias("id"),
    )
    mapped = joins.map_ids_back(_order_names(spark, folder), resolved)
    return mapped.select("o_orderkey", "SkaterID")


@query("""
SELECT c_name AS "Name", CAST(c_nationkey AS VARCHAR) AS "Country", count(*) AS n_rows
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def a11_distinct_requests(spark, folder):
    return plain(requests.distinct_requests(_order_names(spark, folder)))


def _registry(spark, folder):
    """Distinct part names as skaters; the queries misspell the given name."""
    parts = table(spark, folder, "part")
    given = F.split_part("p_name", F.lit(" "), F.lit(1))
    family = F.split_part("p_name", F.lit(" "), F.lit(2))
    registry = (
        parts.groupBy(given.alias("givenname"), family.alias("familyname"))
        .agg(F.min("p_partkey").alias("pos"))
        .select("givenname", "familyname", F.lit("P").alias("country"), "pos", F.col("pos").cast("string").alias("id"))
    )
    asked = parts.select(
        F.concat(given, F.lit("x_"), family).alias("Name"), F.lit("p").alias("Country")
    )
    return asked, registry


# The registry holds eight given names, so a family has at most eight rows and
# all of them are candidates.  Above 0.9 similar to 'gx' is only 'g' itself, and
# only with at least five letters: 2n/(2n+1) > 0.9.
@query("""
WITH registry AS (
  SELECT split_part(p_name, ' ', 1) AS g, split_part(p_name, ' ', 2) AS f, min(p_partkey) AS pos
  FROM part GROUP BY ALL)
SELECT g || 'x_' || f AS "Name", 'p' AS "Country",
  CASE WHEN 2.0 * length(g) / (2 * length(g) + 1) > 0.9 THEN CAST(pos AS VARCHAR) END AS id
FROM registry""")
def j5_resolve_entities(spark, folder):
    return identity.resolve_entities(*_registry(spark, folder))


def _crowd(spark, folder):
    """Every part as a skater of one country, in eight families, and twice in the registry; misspelt in six ways."""
    parts = table(spark, folder, "part")
    digits = F.lpad(F.col("p_partkey").cast("string"), 7, "0")
    letters = F.translate(digits, "0123456789", "abcdefghij")
    given = F.regexp_replace(letters, "(.)", "$1$1$1")
    family = F.split_part("p_name", F.lit(" "), F.lit(2))
    rows = parts.select("p_partkey", given.alias("given"), family.alias("family"))
    places = F.array(F.col("p_partkey"), F.col("p_partkey") + 100_000_000)
    registry = rows.select(
        F.col("given").alias("givenname"), F.col("family").alias("familyname"), F.lit("P").alias("country"),
        F.explode(places).alias("pos"),
    ).withColumn("id", F.col("pos").cast("string"))
    way = F.col("p_partkey") % 6
    asked = (
        F.when(way == 1, F.concat("given", F.lit("x")))
        .when(way == 2, F.concat(F.substring("given", 1, 9), F.lit("xxxx"), F.substring("given", 10, 12)))
        .when(way == 3, F.concat("given", F.lit("xxxxx")))
        .when(way == 5, F.concat(F.substring("given", 1, 9), F.lit("yyy"), F.substring("given", 13, 9)))
        .otherwise(F.col("given"))
    )
    other = F.when(way == 4, F.concat(F.substring("family", 1, 4), F.lit("qq"))).otherwise(F.col("family"))
    return rows.select(F.concat_ws("_", asked, other).alias("Name"), F.lit("p").alias("Country")), registry


# Given names have 21 letters, three for each digit of a key, so two of them share at most 18 in order:
# 36/42 is not above 0.9. With one or four letters inserted it is 42/43 or 42/46, with five 42/47, and
# with three replaced 36/42. Families in the fourth way are found by their first four letters alone.
@query("""
WITH asked AS (
  SELECT p_partkey AS k, split_part(p_name, ' ', 2) AS f, p_partkey % 6 AS way,
    regexp_replace(translate(lpad(CAST(p_partkey AS VARCHAR), 7, '0'), '0123456789', 'abcdefghij'), '(.)', '\\1\\1\\1', 'g') AS g
  FROM part)
SELECT CASE way WHEN 1 THEN g || 'x' WHEN 2 THEN g[1:9] || 'xxxx' || g[10:21] WHEN 3 THEN g || 'xxxxx'
    WHEN 5 THEN g[1:9] || 'yyy' || g[13:21] ELSE g END
    || '_' || CASE WHEN way = 4 THEN f[1:4] || 'qq' ELSE f END AS "Name",
  'p' AS "Country",
  CASE WHEN way IN (0, 1, 2) OR way = 4 AND length(f) >= 4 THEN CAST(k AS VARCHAR) END AS id
FROM asked""")
def j5_resolve_crowded(spark, folder):
    """Families of hundreds of skaters, each name looked up among all of them."""
    return identity.resolve_entities(*_crowd(spark, folder))


@query("""
SELECT c_nationkey AS block, min_by(CAST(c_custkey AS VARCHAR), c_custkey) FILTER (c_acctbal > 5000) AS id
FROM (SELECT * FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) <= 10)
GROUP BY ALL HAVING id IS NOT NULL""")
def w6_first_match(spark, folder):
    rows = table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("block"), F.col("c_custkey").alias("pos"), "c_acctbal",
        F.col("c_custkey").cast("string").alias("id"),
    )
    return plain(identity.first_match(rows, ["block"], ["pos"], F.col("c_acctbal") > 5000))


@query("""
SELECT o_custkey AS event_id, o_orderkey AS schedule_number, o_orderpriority AS title, n, top
FROM orders JOIN (SELECT l_orderkey AS o_orderkey, count(*) AS n, max(l_extendedprice) AS top
  FROM lineitem GROUP BY 1) USING (o_orderkey)""")
def j6_join_race_parts(spark, folder):
    race = ["event_id", "schedule_number"]
    competitions = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("event_id"), F.col("o_orderkey").alias("schedule_number"),
        F.col("o_orderpriority").alias("title"),
    )
    keyed = table(spark, folder, "lineitem").join(
        competitions, F.col("l_orderkey") == competitions["schedule_number"]
    )
    details = keyed.groupBy(*race).agg(F.count("*").alias("n"))
    tops = keyed.groupBy(*race).agg(F.max("l_extendedprice").alias("top"))
    return plain(joins.join_race_parts(competitions, details, tops))


@query("""
SELECT c_custkey, n_nationkey AS event_id, n_name AS stadium FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def j7_attach_event(spark, folder):
    rows = table(spark, folder, "customer").select(F.col("c_nationkey").alias("event_id"), "c_custkey")
    events = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("event_id"), F.col("n_name").alias("stadium")
    )
    return plain(joins.attach_event(rows, events))


@query("WITH " + RACES + """
SELECT l_orderkey, l_linenumber, l_partkey, d AS "Distance",
  CAST(CASE d WHEN 500 THEN 3.362 WHEN 1000 THEN 9.894 WHEN 1500 THEN 11.47 WHEN 3000 THEN 61.88
    WHEN 5000 THEN -51.62 END AS DOUBLE) AS gender
FROM (SELECT *, CASE WHEN "RaceDistance" = 10000 THEN 800 ELSE "RaceDistance" END AS d FROM races)""")
def j8_lookup_coefficients(spark, folder):
    distance = F.when(F.col("RaceDistance") == 10000, 800).otherwise(F.col("RaceDistance"))
    rows = races(spark, folder).withColumn("Distance", distance)
    found = joins.lookup_coefficients(rows)
    return plain(
        found.select(
            "l_orderkey", "l_linenumber", "l_partkey", "Distance",
            (F.col("coefficients.gender") * 1e9).alias("gender"),
        )
    )


# The model, written out: distance, three constant terms, then the factors of gender, lane, time from
# mopping, distance, indoor temperature, ice temperature, humidity and air pressure.
MODELS = """
models(d, c1, c2, c3, g, l, t, m, i, c, h, p) AS (VALUES
  (500, 1.662e-11::DOUBLE, -5.078e-09::DOUBLE, 8.492e-09::DOUBLE, 3.362e-09::DOUBLE, 1.218e-09::DOUBLE, 1.374e-12::DOUBLE,
    8.312e-09::DOUBLE, -1.871e-10::DOUBLE, 1.08e-09::DOUBLE, 6.49e-12::DOUBLE, 1.985e-10::DOUBLE),
  (1000, 4.29e-12, 1.212e-08, 3.763e-09, 9.894e-09, -2.579e-09, 1.763e-12, 4.29e-09, 5.413e-10, 1.559e-09, -1.162e-10, 6.082e-11),
  (1500, 1.812e-12, -1.04e-09, 2.483e-08, 1.147e-08, 3.702e-09, 4.794e-12, 2.718e-09, -2.122e-09, -1.171e-09, -1.136e-09, 3.257e-10),
  (3000, 4.126e-13, -3.063e-09, 4.054e-08, 6.188e-08, 1.044e-08, -5.195e-13, 1.238e-09, 2.952e-10, 3.25e-09, -1.502e-10, 6.038e-10),
  (5000, 1.582e-13, 7.289e-08, 3.185e-09, -5.162e-08, 7.835e-08, 5.687e-13, 7.909e-10, 1.577e-09, 1.809e-08, -6.303e-10, 5.537e-10),
  (10000, 4.29e-12, 1.212e-08, 3.763e-09, 9.894e-09, -2.579e-09, 1.763e-12, 4.29e-09, 5.413e-10, 1.559e-09, -1.162e-10, 6.082e-11))
"""


@query("WITH " + RACES + "," + MODELS + """
SELECT l_orderkey, l_linenumber, l_partkey, "RaceDistance" AS "Distance", measure, round(value * 1e9, 6) AS value
FROM (SELECT races.*, c1 + c2 + c3 AS c0, g, l, t, m, i, c, h, p FROM races JOIN models ON d = "RaceDistance")
UNPIVOT (value FOR measure IN (c0, g, l, t, m, i, c, h, p))""")
def j8_all_coefficients(spark, folder):
    """Every coefficient of every race's distance."""
    found = joins.lookup_coefficients(races(spark, folder).withColumn("Distance", F.col("RaceDistance")))
    names = dict(
        c0="c0", g="gender", l="lane", t="tfm", m="distance", i="temp_indoors", c="temp_ice", h="humidity", p="pressure"
    )
    pairs = [
        F.struct(F.lit(short).alias("measure"), F.round(F.col(f"coefficients.{name}") * 1e9, 6).alias("value"))
        for short, name in names.items()
    ]
    return plain(found.select("l_orderkey", "l_linenumber", "l_partkey", "Distance", F.inline(F.array(*pairs))), 6)


def _wanted(spark, values):
    return spark.sql(
        "SELECT * FROM VALUES " + ", ".join(f"('{v}')" for v in values) + " AS wanted(Stadium)"
    )


@query("WITH " + LIGHT + """
SELECT DISTINCT "Stadium" FROM light WHERE "Distance" = 500 AND "Stadium" IN ('Rink_1', 'Rink_3', 'Nowhere')
UNION ALL
SELECT 'All' WHERE NOT EXISTS (FROM light WHERE "Stadium" = 'Nowhere')""")
def j9_retain_selection(spark, folder):
    """Choices that remain, followed by the fallback of a choice that is gone."""
    rows = light_view(spark, folder).where("Distance = 500").select("Stadium")
    kept = selection.retain_selection(_wanted(spark, ["Rink_1", "Rink_3", "Nowhere"]), rows, "Stadium")
    gone = selection.retain_selection(_wanted(spark, ["Nowhere"]), rows, "Stadium", "All")
    return kept.union(gone)


@query("WITH " + LIGHT + """
SELECT DISTINCT "Stadium" FROM light WHERE "Distance" = 500 AND "Stadium" IN ('Rink_1', 'Rink_3')""")
def u2_available_selection(spark, folder):
    rows = light_view(spark, folder).where("Distance = 500").select("Stadium")
    return selection.available_selection(_wanted(spark, ["Rink_1", "Rink_3", "Nowhere"]), rows)


# Record positions are unique per season entry and distance.
RECORDS = RESULTS + """,
records AS (
  SELECT "SkaterID" AS skater_id, year("Date") AS start, l_orderkey % 3 AS season_pos,
    l_orderkey * 8 + l_linenumber AS rec_pos, "RaceDistance" AS distance,
    l_linenumber = 5 AS junk, min(CAST("SeasonalBest" AS INTEGER)) + 0.55::DOUBLE AS seconds
  FROM results GROUP BY ALL)
"""


@query("WITH " + RECORDS + """
SELECT skater_id, start, distance, arg_max(seconds, rec_pos) AS seconds
FROM records JOIN (SELECT skater_id, start, min(season_pos) AS season_pos FROM records GROUP BY ALL)
  USING (skater_id, start, season_pos)
WHERE NOT junk GROUP BY ALL""")
def a14_season_best_table(spark, folder):
    records = (
        results(spark, folder)
        .groupBy(
            F.col("SkaterID").alias("skater_id"), F.year("Date").alias("start"),
            (F.col("l_orderkey") % 3).alias("season_pos"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("rec_pos"),
            F.col("RaceDistance").alias("distance"), "l_linenumber",
        )
        .agg(F.min(F.col("SeasonalBest").cast("int")).cast("string").alias("whole"))
        .withColumn(
            "time_text",
            F.when(F.col("l_linenumber") == 5, "DNF").otherwise(F.concat("whole", F.lit(",55"))),
        )
    )
    return plain(requests.season_best_table(records))
