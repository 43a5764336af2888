"""Enrichment joins.

No join is forced to broadcast, but for the six-row coefficient table: the
optimizer broadcasts a side whose size it knows to be small, and adaptive
execution splits the partitions of a hot key.  Every looked-up side has one
row per key: the weather hours are reduced here, and conditions, season bests,
ids and race parts are as they come from the operators before.
"""

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.functions.numbers import first_integer, hour_key, hour_of
from rinkflow.functions.text import is_digits, trim_or_empty

#: Over how many values rows with a missing key part are spread.
KEY_SALTS = 32


def salted_left_join(left: DataFrame, right: DataFrame, keys, salts=KEY_SALTS):
    """LEFT join on ``keys``, NULL equal to NULL; ``right`` has one row per key.

    Rows with a missing key part share few keys, however many there are.  They
    are spread over ``salts`` values by their other columns, and the rows of
    ``right`` with a missing part, one for each key, are there once for every value.
    """
    missing = lambda df: reduce(or_, [df[k].isNull() for k in keys])
    salt = F.when(missing(left), F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(0)
    copies = F.when(missing(right), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    other = right.withColumn("_copy", F.explode(copies)).withColumnsRenamed({k: f"_{k}" for k in keys})
    salted = left.withColumn("_salt", salt)
    same = [salted[k].eqNullSafe(other[f"_{k}"]) for k in keys]
    joined = salted.join(other, reduce(and_, same) & (F.col("_salt") == F.col("_copy")), "left")
    return joined.drop("_salt", "_copy", *[f"_{k}" for k in keys])


def join_conditions(results: DataFrame, conditions: DataFrame, keys=fixed.RACE_KEY):
    """LEFT join on the race key, a missing part equal to a missing part.

    ``conditions`` has one row per race.
    """
    return salted_left_join(results, conditions, list(keys))


def hours_by_key(hourly: DataFrame, keys=("Latitude", "Longitude", "HourKey")):
    """One row per place and hour: the last one of the landed arrays wins.

    Documents that land the same place and hour tie; the larger values win,
    whatever the order of the rows.
    """
    measures = F.struct(*fixed.WEATHER_COLUMNS)
    last = F.struct("position", *fixed.WEATHER_COLUMNS)
    picked = hourly.groupBy(*keys).agg(F.max_by(measures, last).alias("weather"))
    return picked.select(*keys, "weather")


def join_weather(
    conditions: DataFrame, hourly: DataFrame, lat="Latitude", lon="Longitude",
    date="Date", time="Time", flag="WeatherMatched",
):
    """LEFT join of the weather of the started hour.

    A match sets all three measures, even to NULL; without one they stay as
    they were.  ``flag`` tells the two apart.
    """
    weather = hours_by_key(hourly).select(
        F.col("Latitude").cast("double").alias("_lat"),
        F.col("Longitude").cast("double").alias("_lon"),
        F.col("HourKey").alias("_hour"),
        "weather",
    )
    keyed = conditions.withColumn("_key", hour_key(date, hour_of(time)))
    joined = keyed.join(
        weather,
        (keyed[lat].try_cast("double") == weather["_lat"])
        & (keyed[lon].try_cast("double") == weather["_lon"])
        & (keyed["_key"] == weather["_hour"]),
        "left",
    )
    matched = F.col("weather").isNotNull()
    columns = []
    for name in fixed.WEATHER_COLUMNS:
        before = F.col(name).try_cast("double") if name in conditions.columns else F.lit(None)
        columns.append(F.when(matched, F.col(f"weather.{name}")).otherwise(before).alias(name))
    rest = [c for c in conditions.columns if c not in fixed.WEATHER_COLUMNS]
    return joined.select(*rest, *columns, matched.alias(flag))


def join_previous_season_best(
    results: DataFrame, bests: DataFrame, skater="SkaterID", date="Date",
    distance_col="Race", out="SeasonalBest",
):
    """LEFT join of the best time of the calendar year before the race.

    ``bests``: one row per (skater_id, start, distance) with ``seconds``.  Only
    ids made of digits are looked up.  The distance is the first number in
    ``distance_col``.
    """
    b = bests.select(
        F.col("skater_id").alias("_skater"),
        F.col("start").alias("_start"),
        F.col("distance").alias("_distance"),
        F.col("seconds").alias(out),
    )
    id_text = F.trim(F.col(skater).cast("string"))
    condition = (
        (F.when(is_digits(id_text), id_text) == b["_skater"])
        & (F.year(date) - 1 == b["_start"])
        & (first_integer(distance_col) == b["_distance"])
    )
    return results.drop(out).join(b, condition, "left").drop("_skater", "_start", "_distance")


def map_ids_back(
    rows: DataFrame, resolved: DataFrame, name="Name", country="Country", out="SkaterID"
):
    """LEFT join of the ids found per distinct (name, country)."""
    r = resolved.select(
        F.col(name).alias("_name"), F.col(country).alias("_country"), F.col("id").alias(out)
    )
    condition = (trim_or_empty(name) == r["_name"]) & (trim_or_empty(country) == r["_country"])
    return rows.drop(out).join(r, condition, "left").drop("_name", "_country")


def join_race_parts(
    competitions: DataFrame, details: DataFrame, results: DataFrame,
    keys=("event_id", "schedule_number"),
):
    """Title, conditions and results of a race meet by event and number."""
    return competitions.join(details, list(keys), "inner").join(results, list(keys), "inner")


def attach_event(rows: DataFrame, events: DataFrame, key="event_id"):
    """Copy the attributes of the event to each of its rows."""
    return rows.join(events, key, "inner")


def coefficient_table(spark, coefficients=fixed.MODEL_COEFFICIENTS):
    """The model's coefficients: one row per distance."""
    names = [
        "gender", "lane", "tfm", "distance", "temp_indoors", "temp_ice", "humidity", "pressure",
    ]
    rows = [
        F.struct(
            F.lit(distance).alias("Distance"),
            F.struct(
                F.lit(sum(values[0][1:], values[0][0])).alias("c0"),
                *[F.lit(v).alias(n) for n, v in zip(names, values[1:])],
            ).alias("coefficients"),
        )
        for distance, values in coefficients.items()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def lookup_coefficients(df: DataFrame, table: DataFrame = None, distance="Distance"):
    """LEFT join of the coefficients of each row's distance."""
    table = table if table is not None else coefficient_table(df.sparkSession)
    small = F.broadcast(table.withColumnRenamed("Distance", "_distance"))
    return df.join(small, df[distance] == small["_distance"], "left").drop("_distance")
