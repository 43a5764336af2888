"""What has to be looked up: distinct names, weather hours, season bests."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rinkflow.functions.numbers import hour_of, with_seconds, year_of_text
from rinkflow.functions.text import trim_or_empty
from rinkflow.operators.clean import flag_valid_request


def distinct_requests(df: DataFrame, keys=("Name", "Country")):
    """Distinct trimmed keys and the rows that share each."""
    trimmed = [trim_or_empty(k).alias(k) for k in keys]
    return df.groupBy(*trimmed).agg(F.count("*").alias("n_rows"))


def weather_request_hours(
    df: DataFrame, lat="Latitude", lon="Longitude", place="Location", date="Date", time="Time"
):
    """Distinct (place, date, hour) to ask for."""
    valid = flag_valid_request(df, lat, lon, date, time).where("ValidRequest")
    return valid.select(
        F.col(lat), F.col(lon), F.col(place),
        F.col(date).cast("string").alias("date"),
        hour_of(time).alias("hour"),
    ).distinct()


def weather_request_plan(df: DataFrame, lat="Latitude", lon="Longitude", place="Location", **names):
    """One request per place and year: its date range and number of hours."""
    hours = weather_request_hours(df, lat, lon, place, **names)
    return (
        hours.groupBy(lat, lon, place, year_of_text("date").alias("year"))
        .agg(
            F.min("date").alias("start_date"),
            F.max("date").alias("end_date"),
            F.count("*").alias("n_hours"),
        )
        .orderBy(lat, lon, place, "year")
    )


def season_best_table(records: DataFrame):
    """Best per (skater, start year, distance) from landed season records.

    Only the first season entry of a start year counts; in it the last
    readable record of a distance wins; of records that tie, the slower one,
    whatever the order of the rows.
    """
    timed = with_seconds(records, "time_text", "seconds")
    readable = F.when(F.col("distance") != 0, F.col("seconds"))
    entry = ["skater_id", "start", "season_pos", "distance"]
    # Records are reduced before the entries of a year are compared, by position first: all sums fit a hash table.
    best = timed.groupBy(*entry, "rec_pos").agg(F.max(readable).alias("seconds"))
    last = F.when(F.col("seconds").isNotNull(), F.col("rec_pos"))
    best = best.groupBy(*entry).agg(F.max_by("seconds", last).alias("seconds"))
    first = F.min("season_pos").over(Window.partitionBy("skater_id", "start"))
    best = best.withColumn("_first", first).where("season_pos = _first AND seconds IS NOT NULL")
    return best.select("skater_id", "start", "distance", "seconds")
