"""From landed documents to the enriched results and conditions tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow import schemas
from rinkflow.functions.numbers import format_2dp, stamp_date
from rinkflow.functions.text import has_text, underscore
from rinkflow.operators import clean, joins, sequence
from rinkflow.operators.identity import resolve_entities
from rinkflow.operators.requests import season_best_table
from rinkflow.session import materialize
from rinkflow.sources import landed_json as landed
from rinkflow.sources.tables import save_text_table

RACE = ["event_id", "schedule_number"]


def last_stamp_date(conditions="conditions"):
    """Date of the last time-stamped measurement of a nested list."""
    stamped = F.filter(conditions, lambda c: has_text(c["timeStamp"]))
    return stamp_date(F.element_at(F.when(F.size(stamped) > 0, stamped), -1)["timeStamp"])


def eligible_competitions(competitions: DataFrame):
    """Individual races with a schedule number."""
    return clean.require_truthy(clean.exclude_titles(competitions), "schedule_number")


def has_results(results: DataFrame, text="results"):
    """Results documents that hold something."""
    return results.where(
        F.col(text).isNotNull() & ~F.col(text).rlike("^\\s*(\\[\\s*\\]|\\{\\s*\\}|null)?\\s*$")
    )


def race_documents(events: DataFrame, competitions: DataFrame, details: DataFrame, results: DataFrame):
    """One nested row per race that has both parts: event columns, conditions, results, date.

    ``competitions`` may list a number more than once: of those that are
    individual races the last listed counts.  The other inputs have one row per key, so
    no join multiplies.
    """
    attributes = landed.event_attributes(events)
    races = landed.latest(eligible_competitions(competitions), RACE, "listed")
    races = races.select(*RACE, underscore("race_name").alias("Race"))
    measured = details.select(*RACE, "distance", "conditions", last_stamp_date().alias("Date"))
    answered = has_results(results).withColumn("results", landed.parse_results("results"))
    return joins.attach_event(clean.races_with_both(races.join(measured, RACE), answered), attributes)


def condition_rows(races: DataFrame):
    """Complete measurements of nested races, with the order in which they landed."""
    rows = landed.explode_conditions(races.drop("results", "Date"))
    return clean.complete_conditions(rows).select(
        *fixed.INGEST_ORDER,
        "Stadium", "Location", "Latitude", "Longitude", "Date", "Event", "Race",
        F.col("RinkCountry").alias("Country"),
        "Distance", "Occasion", "Time", "TempIndoors", "IceTemperature", "Humidity",
    )


def result_rows(races: DataFrame):
    """Valid results of nested races, dated by their last time-stamped measurement."""
    rows = landed.explode_result_list(races.drop("distance", "conditions"))
    return landed.flatten_results(clean.valid_results(rows)).select(*fixed.RESULT_COLUMNS)


def add_identities(results: DataFrame, registry: DataFrame):
    """SkaterID per row; each distinct name is resolved once and stored."""
    resolved = materialize(resolve_entities(results, registry))
    return joins.map_ids_back(results, resolved)


def add_season_bests(results: DataFrame, records: DataFrame):
    return joins.join_previous_season_best(results, season_best_table(records))


def add_weather(conditions: DataFrame, hourly: DataFrame):
    """Weather of the hour; the coordinates have served their purpose."""
    blank = clean.ensure_columns(conditions, fixed.WEATHER_COLUMNS)
    return clean.drop_helper_columns(joins.join_weather(blank, hourly)).drop("WeatherMatched")


def enrich(events, competitions, details, results, registry, season_records, hourly):
    """All steps on parsed inputs: (results, conditions).

    Races are met and stored once, nested; both outputs are exploded from there.
    """
    races = materialize(race_documents(events, competitions, details, results))
    found = add_identities(materialize(result_rows(races)), registry)
    found = add_season_bests(found, season_records)
    found = sequence.estimate_tfm(found)
    return found, add_weather(condition_rows(races), hourly)


def read_and_enrich(spark, folder):
    """``enrich`` over a landing folder with one sub-folder per document kind.

    Of documents that landed more than once the last version counts, so
    landing copies again changes nothing.
    """
    ids = landed.read_event_pages(spark, f"{folder}/event_pages")
    events = landed.read_latest_events(spark, f"{folder}/event_details")
    return enrich(
        events.join(ids, "event_id", "left_semi"),
        landed.read_listed_competitions(spark, f"{folder}/competitions"),
        landed.read_latest_details(spark, f"{folder}/competition_details"),
        landed.read_latest_results(spark, f"{folder}/competition_results"),
        landed.read_skater_registry(spark, f"{folder}/skaters"),
        landed.read_season_bests(spark, f"{folder}/season_bests"),
        landed.read_hourly_weather(spark, f"{folder}/weather"),
    )


def rejects(spark, folder):
    """The landed documents of all kinds that give no rows, with their files and reasons."""
    kinds = [landed.rejected_documents(spark, f"{folder}/{kind}", kind) for kind in schemas.DOCUMENTS]
    return reduce(DataFrame.unionByName, kinds)


def final_results(results: DataFrame):
    """The stored layout: season best as two-decimal text, no skater id."""
    return clean.drop_helper_columns(results, ["SkaterID"]).withColumn(
        "SeasonalBest", format_2dp("SeasonalBest")
    )


def final_conditions(conditions: DataFrame):
    """The stored layout: without the order of landing."""
    return clean.drop_helper_columns(conditions, fixed.INGEST_ORDER)


def load_tables(results: DataFrame, conditions: DataFrame, folder, names=("results", "conditions")):
    """Replace the two text tables by the enriched rows: (rows of results, rows of conditions)."""
    finished = final_results(results), final_conditions(conditions)
    return tuple(save_text_table(df, name, folder) for df, name in zip(finished, names))
