"""Row filters, housekeeping and column functions."""

from pyspark.sql import functions as F

from rinkflow.functions import model, numbers, similarity, text
from rinkflow.operators import clean, requests, selection
from rinkflow.plans.catalog.registry import plain, query
from rinkflow.plans.catalog.standins import (
    CONDITIONS, FULL, LIGHT, RACES, conditions, light_view, races, stored_view, table,
)
from rinkflow.sources import legacy


def _titles(spark, folder):
    kind = (F.col("p_partkey") % 6).cast("int")
    title = (
        F.when(kind == 0, F.concat(F.lit("Team Pursuit "), F.col("p_name")))
        .when(kind == 1, F.concat(F.lit("MASS start "), F.col("p_name")))
        .when(kind == 2, F.concat(F.col("p_name"), F.lit(" Mixed relay")))
        .when(kind != 3, F.col("p_name"))
    )
    return table(spark, folder, "part").select(
        "p_partkey", title.alias("title"), F.nullif(kind, F.lit(5)).alias("schedule_number")
    )


TITLES = """
titles AS (
  SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Team Pursuit ' || p_name
      WHEN 1 THEN 'MASS start ' || p_name WHEN 2 THEN p_name || ' Mixed relay'
      WHEN 3 THEN NULL ELSE p_name END AS title,
    nullif(p_partkey % 6, 5) AS schedule_number
  FROM part)
"""


@query("WITH " + TITLES + """
SELECT p_partkey, title FROM titles
WHERE title IS NULL OR NOT regexp_matches(lower(title), 'team|mass|mixed')""")
def p1_exclude_titles(spark, folder):
    return clean.exclude_titles(_titles(spark, folder)).select("p_partkey", "title")


@query("WITH " + TITLES + """
SELECT p_partkey, schedule_number FROM titles WHERE schedule_number <> 0""")
def p2_require_truthy(spark, folder):
    kept = clean.require_truthy(_titles(spark, folder), "schedule_number")
    return plain(kept.select("p_partkey", "schedule_number"))


def _measurements(spark, folder):
    key = F.col("l_orderkey")
    return races(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(key % 7 == 0, "").when(key % 7 != 1, F.col("l_shipdate").cast("string")).alias("time_stamp"),
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_quantity")).alias("TempIndoors"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_tax")).alias("IceTemperature"),
        F.col("l_discount").alias("Humidity"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS "TempIndoors",
  l_tax AS "IceTemperature", l_discount AS "Humidity"
FROM lineitem WHERE l_orderkey % 7 NOT IN (0, 1) AND l_partkey % 9 <> 0 AND l_partkey % 5 <> 0""")
def p3_complete_conditions(spark, folder):
    return plain(clean.complete_conditions(_measurements(spark, folder)).drop("time_stamp"))


def _nested_results(spark, folder):
    key, part = F.col("l_orderkey"), F.col("l_partkey")
    skater = F.struct(F.col("l_returnflag").alias("firstName"), F.col("l_linestatus").alias("lastName"))
    competitor = F.struct(
        part.cast("string").alias("number"), F.when(part % 4 != 0, skater).alias("skater")
    )
    result = F.struct(
        F.when(key % 5 == 0, "").when(key % 5 != 1, F.col("l_quantity").cast("string")).alias("time"),
        F.when(part % 3 != 0, competitor).alias("competitor"),
    )
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", result.alias("result"))


@query("""
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS nr FROM lineitem
WHERE l_orderkey % 5 NOT IN (0, 1) AND l_partkey % 4 <> 0 AND l_partkey % 3 <> 0""")
def p4_valid_results(spark, folder):
    kept = clean.valid_results(_nested_results(spark, folder))
    return plain(kept.select("l_orderkey", "l_linenumber", F.col("result.competitor.number").alias("nr")))


@query("""
SELECT o_orderkey AS schedule_number, count(*) AS n_results, sum(l_quantity) AS total
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE o_orderkey % 3 <> 0 GROUP BY 1""")
def p5_races_with_both(spark, folder):
    key = F.col("o_orderkey")
    details = table(spark, folder, "orders").select(
        key.alias("schedule_number"),
        F.slice(F.array(F.lit(1), F.lit(2)), 1, (key % 3).cast("int")).alias("conditions"),
    )
    results = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("schedule_number"), "l_quantity"
    )
    both = clean.races_with_both(details, results, ["schedule_number"])
    return plain(
        both.groupBy("schedule_number").agg(
            F.count("*").alias("n_results"), F.sum("l_quantity").alias("total")
        )
    )


@query("WITH " + CONDITIONS + """
SELECT "Stadium", CAST("Date" AS VARCHAR) AS "Date", "Event", "Race", "Occasion", "TempIce"
FROM conditions WHERE "Occasion" = 'start'""")
def p6_occasion_filter(spark, folder):
    kept = clean.occasion_filter(conditions(spark, folder))
    return plain(kept.select("Stadium", "Date", "Event", "Race", "Occasion", "TempIce"))


@query("WITH " + CONDITIONS + """
SELECT "Stadium", CAST("Date" AS VARCHAR) AS "Date", "Event", "Race", "TempOutdoors"
FROM conditions WHERE "TempOutdoors" IS NOT NULL""")
def p7_require_columns(spark, folder):
    kept = clean.require_columns(
        conditions(spark, folder), ["TempOutdoors", "TempIce", "CondTime", "Distance"]
    )
    return plain(kept.select("Stadium", "Date", "Event", "Race", "TempOutdoors"))


@query("WITH " + RACES + """
SELECT "Race", "SeasonalBest", round("RaceTime", 4) AS "RaceTime"
FROM races WHERE "RaceTime" < 1.1::DOUBLE * "SeasonalBest" """)
def p8_plausible(spark, folder):
    return plain(clean.plausible(races(spark, folder)).select("Race", "SeasonalBest", "RaceTime"))


@query("WITH " + FULL + """
SELECT "Name", "Stadium", "RinkCountry", CAST("Date" AS VARCHAR) AS "Date", "Distance",
  round("RaceTime", 4) AS "RaceTime"
FROM full_view WHERE "Gender" IN ('Men', 'Women') AND "Distance" = 1500
  AND "Year" BETWEEN 1996 AND 1999 AND "RinkCountry" IN ('Land_0', 'Land_1')""")
def p9_select_rows(spark, folder):
    rows = selection.select_rows(
        stored_view(spark, folder), distance=1500, years=(1996, 1999), countries=["Land_0", "Land_1"]
    )
    return plain(rows.select("Name", "Stadium", "RinkCountry", "Date", "Distance", "RaceTime"))


@query("WITH " + LIGHT + """
SELECT "Stadium", CAST("Date" AS VARCHAR) AS "Date", "Distance", round("RaceTime", 4) AS "RaceTime"
FROM light WHERE "Distance" = 10000 AND "Stadium" = 'Rink_3'""")
def p10_select_prediction_rows(spark, folder):
    rows = selection.select_prediction_rows(light_view(spark, folder), 10000, "Rink_3")
    return plain(rows.select("Stadium", "Date", "Distance", "RaceTime"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
def p11_drop_helper_columns(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_tax").alias("Latitude"),
        F.col("l_discount").alias("Longitude"),
    )
    return plain(clean.drop_helper_columns(rows))


@query("""
SELECT o_orderkey, o_totalprice AS "TempOutdoors", CAST(NULL AS DOUBLE) AS "AirpressureSurface",
  CAST(NULL AS DOUBLE) AS "AirpressureSealevel" FROM orders""")
def p12_ensure_columns(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("TempOutdoors")
    )
    return plain(
        clean.ensure_columns(rows, ["TempOutdoors", "AirpressureSurface", "AirpressureSealevel"])
    )


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag AS "SkaterCountry", round(l_quantity, 4) AS "RaceTime",
  l_linestatus AS "Event"
FROM lineitem""")
def p13_to_curated_names(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("Country"),
        F.col("l_quantity").cast("string").alias("Time"), F.col("l_linestatus").alias("Event"),
    )
    return plain(clean.to_curated_results(rows))


def _requests(spark, folder):
    """Orders as condition rows to be looked up, some of them unusable."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 13 != 0, (F.col("o_custkey") % 10).cast("string")).alias("Latitude"),
        F.lit("5.0").alias("Longitude"),
        F.concat(F.lit("Place_"), (F.col("o_custkey") % 10).cast("string")).alias("Location"),
        F.when(key % 11 == 0, F.concat(day, F.lit("x"))).otherwise(day).alias("Date"),
        F.when(key % 7 == 0, "noon")
        .otherwise(F.concat((key % 24).cast("string"), F.lit(":15:00"))).alias("Time"),
    )


REQUESTS = """
requests AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_custkey % 10 AS VARCHAR) END AS lat,
    '5.0' AS lon, 'Place_' || (o_custkey % 10) AS place,
    strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 24 AS hour,
    o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AS ok
  FROM orders)
"""


@query("WITH " + REQUESTS + """SELECT o_orderkey, ok AS "ValidRequest" FROM requests""")
def p14_flag_valid_request(spark, folder):
    flagged = clean.flag_valid_request(_requests(spark, folder))
    return flagged.select("o_orderkey", "ValidRequest")


@query("WITH " + REQUESTS + """
SELECT lat AS "Latitude", lon AS "Longitude", place AS "Location", left(day, 4) AS year,
  min(day) AS start_date, max(day) AS end_date, count(DISTINCT (day, hour)) AS n_hours
FROM requests WHERE ok GROUP BY ALL""")
def a12_weather_request_plan(spark, folder):
    return plain(requests.weather_request_plan(_requests(spark, folder)))


@query("WITH " + FULL + """,
q AS (SELECT quantile_cont("RaceTime", 0.25) AS a, quantile_cont("RaceTime", 0.75) AS b
      FROM full_view WHERE "Distance" = 500)
SELECT "TempIce", round("RaceTime", 4) AS "RaceTime", "Name", "Stadium",
  CAST("Date" AS VARCHAR) AS "Date", "Year",
  "RaceTime" < a - 1.5 * (b - a) OR "RaceTime" > b + 1.5 * (b - a) AS is_outlier
FROM full_view, q WHERE "Distance" = 500""")
def p15_scatter_points(spark, folder):
    rows = selection.select_rows(stored_view(spark, folder))
    return plain(selection.scatter_points(rows))


@query("WITH " + FULL + """
SELECT round("RaceTime", 4) AS "RaceTime", round("Prediction", 4) AS "Prediction", "Name", "Gender"
FROM full_view WHERE "Distance" = 500""")
def p16_prediction_points(spark, folder):
    return plain(selection.prediction_points(stored_view(spark, folder), 500))


# --- column functions --------------------------------------------------------


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Jörgen ' || c_name WHEN 1 THEN 'Ã(' || c_name
  WHEN 2 THEN 'JÃ¶rgen €' || c_name ELSE c_name END AS fixed FROM customer""")
def f1_fix_encoding(spark, folder):
    kind, name = F.col("c_custkey") % 4, F.col("c_name")
    damaged = (
        F.when(kind == 0, F.concat(F.lit("JÃ¶rgen "), name))
        .when(kind == 1, F.concat(F.lit("Ã("), name))
        .when(kind == 2, F.concat(F.lit("JÃ¶rgen €"), name))
        .otherwise(name)
    )
    return table(spark, folder, "customer").select(
        "c_custkey", text.fix_encoding(damaged).alias("fixed")
    )


@query("SELECT p_partkey, replace(p_name, ' ', '_') AS name FROM part")
def f2_underscore(spark, folder):
    return table(spark, folder, "part").select("p_partkey", text.underscore("p_name").alias("name"))


@query("""
SELECT p_partkey, p_brand || '_' || coalesce(replace(nullif(p_name, 'red ring'), ' ', '_'), '') AS name
FROM part""")
def f3_full_name(spark, folder):
    last = F.nullif(F.col("p_name"), F.lit("red ring"))
    return table(spark, folder, "part").select(
        "p_partkey", text.full_name("p_brand", last).alias("name")
    )


@query("""
SELECT p_partkey,
  CASE WHEN contains(n, '_') THEN left(n, instr(n, '_') - 1) ELSE n END AS given,
  CASE WHEN contains(n, '_') THEN substr(n, instr(n, '_') + 1) ELSE '' END AS family
FROM (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_brand
  ELSE replace(p_name, ' ', '_') || '_x' END AS n FROM part)""")
def f4_split_name(spark, folder):
    name = F.when(F.col("p_partkey") % 5 == 0, F.col("p_brand")).otherwise(
        F.concat(text.underscore("p_name"), F.lit("_x"))
    )
    return table(spark, folder, "part").select(
        "p_partkey", text.given_name(name).alias("given"), text.family_name(name).alias("family")
    )


@query("""
SELECT doc_id, md5(regexp_replace(lower(text), '[^a-z]', '', 'g')) AS digest FROM documents""")
def f5_normalize_name(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", F.md5(text.normalize_name("text")).alias("digest")
    )


# 'g' against 'gx': 2M/T is 2n/(2n+1), unless one letter is over a fifth of n+1.
@query("""
SELECT p_partkey, CASE WHEN 1 > (n + 1) * 0.2 THEN 0.0::DOUBLE
  ELSE round(2.0::DOUBLE * n / (2 * n + 1), 4) END AS score
FROM (SELECT p_partkey, length(split_part(p_name, ' ', 1)) AS n FROM part)""")
def f6_similarity(spark, folder):
    given = F.split_part("p_name", F.lit(" "), F.lit(1))
    score = similarity.similarity(given, F.concat(given, F.lit("x")))
    return plain(table(spark, folder, "part").select("p_partkey", score.alias("score")))


@query("""
SELECT l_orderkey, l_linenumber,
  CASE l_returnflag WHEN 'A' THEN 'Women' WHEN 'N' THEN 'Men' ELSE l_returnflag END AS gender,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 END AS number
FROM lineitem""")
def f7_decode_gender(spark, folder):
    gender = text.decode_gender(F.translate("l_returnflag", "AN", "FM"))
    return plain(
        table(spark, folder, "lineitem").select(
            "l_orderkey", "l_linenumber", gender.alias("gender"),
            text.gender_num(gender).alias("number"),
        )
    )


def _stamps(spark, folder):
    key = F.col("o_orderkey")
    moment = (F.col("o_orderdate").cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, o_orderkey % 86400)"))
    iso = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    stamp = (
        F.when(key % 6 == 0, F.concat(iso, F.lit("Z")))
        .when(key % 6 == 1, F.date_format(moment, "dd-MM-yyyy"))
        .when(key % 6 == 2, F.date_format(moment, "yyyy-MM-dd"))
        .when(key % 6 == 3, F.concat(iso, F.lit("+02:00")))
        .when(key % 6 == 4, F.date_format(moment, "yyyy"))
    )
    return table(spark, folder, "orders").select("o_orderkey", stamp.alias("stamp"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE WHEN o_orderkey % 6 IN (0, 3)
    THEN strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%H:%M:%S') END AS clock
FROM orders""")
def f8_parse_timestamp(spark, folder):
    return plain(
        _stamps(spark, folder).select(
            "o_orderkey",
            numbers.stamp_date("stamp").alias("day"),
            numbers.stamp_time("stamp").alias("clock"),
        )
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, round(CAST(CASE l_partkey % 7
    WHEN 0 THEN l_quantity + 0.07 WHEN 1 THEN 60 + l_quantity + 0.55 WHEN 2 THEN 240 + l_quantity + 0.39
    WHEN 3 THEN l_quantity END AS DOUBLE), 4) AS seconds
FROM (SELECT * REPLACE (CAST(l_quantity AS INTEGER) AS l_quantity) FROM lineitem)""")
def f9_time_to_seconds(spark, folder):
    whole = F.col("l_quantity").cast("int").cast("string")
    kind = F.col("l_partkey") % 7
    shown = (
        F.when(kind == 0, F.concat(whole, F.lit(",07")))
        .when(kind == 1, F.concat(F.lit("1."), whole, F.lit(",55")))
        .when(kind == 2, F.concat(F.lit(" 4:"), whole, F.lit(".393")))
        .when(kind == 3, whole)
        .when(kind == 4, F.concat(F.lit("1:"), whole, F.lit(",55")))
        .when(kind == 5, F.concat(F.lit("1:02:"), whole))
    )
    rows = table(spark, folder, "lineitem").withColumn("shown", shown)
    timed = numbers.with_seconds(rows, "shown", "seconds")
    return plain(timed.select("l_orderkey", "l_linenumber", "l_partkey", "seconds"))


@query("""
SELECT c_custkey, TRY_CAST(regexp_extract(c_name, '([0-9]+)', 1) AS BIGINT) AS number FROM customer""")
def f10_first_integer(spark, folder):
    return plain(
        table(spark, folder, "customer").select(
            "c_custkey", numbers.first_integer("c_name").alias("number")
        )
    )


@query("WITH " + RACES + """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_partkey % 4 <> 0 THEN CAST("RaceDistance" AS VARCHAR) END AS distance FROM races""")
def f11_distance_of(spark, folder):
    title = F.when(F.col("l_partkey") % 4 == 0, "Team").otherwise(F.col("Race"))
    return races(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.distance_of(title).alias("distance")
    )


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 24 WHEN 1 THEN o_orderkey % 24 END AS hour
FROM orders""")
def f12_hour_of(spark, folder):
    hour = (F.col("o_orderkey") % 24).cast("string")
    kind = F.col("o_orderkey") % 4
    clock = (
        F.when(kind == 0, F.concat(F.lpad(hour, 2, "0"), F.lit(":30:00")))
        .when(kind == 1, F.concat(hour, F.lit(":1")))
        .when(kind == 2, hour)
        .otherwise(F.concat(F.lit("x:"), hour))
    )
    return plain(table(spark, folder, "orders").select("o_orderkey", numbers.hour_of(clock).alias("hour")))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN CAST(trunc(c_acctbal) AS BIGINT) END AS number
FROM customer""")
def f13_to_int_via_float(spark, folder):
    shown = F.when(F.col("c_custkey") % 5 == 0, "nan").otherwise(F.col("c_acctbal").cast("string"))
    return plain(
        table(spark, folder, "customer").select("c_custkey", numbers.to_int_via_float(shown).alias("number"))
    )


@query("""
SELECT n_nationkey, regexp_replace(upper(replace(trim(n), ' ', '_')), '[^A-Z0-9_]', '', 'g') AS name
FROM (SELECT n_nationkey, '  ' || lower(n_name) || ' (land) é' || n_regionkey || ' ' AS n FROM nation)""")
def f16_sanitize_name(spark, folder):
    raw = F.concat(
        F.lit("  "), F.lower("n_name"), F.lit(" (land) é"), F.col("n_regionkey").cast("string"), F.lit(" ")
    )
    return plain(table(spark, folder, "nation").select("n_nationkey", text.sanitize_name(raw).alias("name")))


@query("WITH " + CONDITIONS + """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN "TempIce" > 0 THEN -"TempIce" ELSE "TempIce" END AS "TempIce" FROM conditions""")
def f17_fix_ice_sign(spark, folder):
    return plain(
        conditions(spark, folder).select(
            "l_orderkey", "l_linenumber", "l_partkey", model.fix_ice_sign("TempIce").alias("TempIce")
        )
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, year(o_orderdate) AS year,
  strftime(o_orderdate, '%Y') AS year_text FROM orders""")
def f21_parse_date_year(spark, folder):
    shown = F.date_format("o_orderdate", "dd-MM-yyyy")
    day = numbers.day_first_date(shown)
    return plain(
        table(spark, folder, "orders").select(
            "o_orderkey", day.alias("day"), F.year(day).alias("year"),
            numbers.year_of_text(day.cast("string")).alias("year_text"),
        )
    )


@query("""
SELECT p_partkey, left(p_name, 4) AS prefix, upper(p_brand) AS country,
  regexp_full_match(CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE p_type END, '[0-9]+') AS digits,
  trim(CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' ' || p_type || ' ' END) AS kind
FROM part""")
def f22_key_texts(spark, folder):
    """Name prefix, country, digit check and trimmed key (F22, F23, F24, F28)."""
    key = F.col("p_partkey")
    padded = F.when(key % 3 != 0, F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")))
    return table(spark, folder, "part").select(
        "p_partkey",
        text.name_prefix("p_name").alias("prefix"),
        text.upper_country("p_brand").alias("country"),
        text.is_digits(F.when(key % 2 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_type"))).alias("digits"),
        text.trim_or_empty(padded).alias("kind"),
    )


@query("""
SELECT l_orderkey, l_linenumber, printf('%.2f', l_quantity) AS shown,
  strftime(l_shipdate, '%Y-%m-%d') || 'T' || printf('%02d', l_orderkey % 24) || ':00' AS hour_key,
  coalesce(CASE WHEN l_partkey % 2 = 0 THEN l_linestatus END, '') AS blank
FROM lineitem""")
def f25_formatted_texts(spark, folder):
    """Two-decimal text, hour key and blank default (F25, F26, F29)."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        numbers.format_2dp("l_quantity").alias("shown"),
        numbers.hour_key(F.col("l_shipdate").cast("date"), F.col("l_orderkey") % 24).alias("hour_key"),
        text.default_blank(F.when(F.col("l_partkey") % 2 == 0, F.col("l_linestatus"))).alias("blank"),
    )


# --- older layout ------------------------------------------------------------


@query("WITH " + RACES + """
SELECT 'results' AS "table", "Stadium", CAST("Date" AS VARCHAR) AS "Date", "Event", "Race",
  l_returnflag AS "Country", CAST("Pair" AS VARCHAR) AS "Rank", NULL::BIGINT AS "Distance",
  NULL::DOUBLE AS "TempIndoors", NULL::VARCHAR AS "Location" FROM races
UNION ALL
SELECT 'conditions', "Stadium", CAST("Date" AS VARCHAR), "Event", "Race", l_returnflag, NULL,
  "RaceDistance", l_tax, NULL FROM races""")
def s14_from_legacy_layout(spark, folder):
    rows = races(spark, folder)
    blank = F.lit("")
    old_results = rows.select(
        "Stadium", "Date", F.col("Race").alias("Event"), F.col("Event").alias("Race"),
        F.col("Pair").cast("string").alias("Rnk"), blank.alias("Nr"), blank.alias("Name"),
        F.col("l_returnflag").alias("Country"), "Pair", "Lane", blank.alias("Time"),
        blank.alias("Behind"), "Gender",
    )
    old_conditions = rows.select(
        "Stadium", "Date", F.col("Race").alias("Event"), F.col("Event").alias("MatchType"),
        F.col("l_returnflag").alias("EventCountry"), F.col("RaceDistance").alias("Distance"),
        F.lit("start").alias("Occasion"), blank.alias("Time"),
        F.col("l_tax").alias("AirTemperature"), F.col("l_tax").alias("IceTemperature"),
        F.col("l_tax").alias("Humidity"),
    )
    results, measured = legacy.from_legacy_layout(old_results, old_conditions)
    shared = ["Stadium", "Date", "Event", "Race", "Country"]
    both = results.select(F.lit("results").alias("table"), *shared, "Rank").unionByName(
        measured.select(
            F.lit("conditions").alias("table"), *shared, "Distance", "TempIndoors", "Location"
        ),
        allowMissingColumns=True,
    )
    return plain(both)
