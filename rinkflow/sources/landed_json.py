"""Landed JSON documents -> flat rows.

A landed folder holds text files with one document per line, or (``whole``)
one document per file.  Each ``read_*`` is a file read plus a plain DataFrame
transform that also works on a stream of the same documents.  Documents that
cannot be read, or lack their key, give no rows there but are returned by
`rejected_documents`.
"""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rinkflow import schemas
from rinkflow.functions.numbers import stamp_date, stamp_time, to_double, to_int_via_float
from rinkflow.functions.text import decode_gender, fix_encoding, full_name, has_text, underscore

_DAMAGED = "_corrupt_record"


def _parsed(reader, path, kind, whole=False):
    """(document, file, landed, doc): the text, its file and age, and the parsed fields.

    ``landed`` orders versions of a document: by the time of the file, its name, and the text.
    """
    schema = f"{schemas.DOCUMENTS[kind][0]}, {_DAMAGED} string"
    lines = reader.text(path, wholetext=whole).select(
        F.col("value").alias("document"),
        F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_modification_time", "_metadata.file_name", F.xxhash64("value").alias("text")).alias("landed"),
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _DAMAGED}
    # A blank line is no document.  As one generated row the parsed fields are not merged into
    # the conditions on them, which would parse the text once for each.
    doc = F.explode(F.array(F.from_json("document", schema, options)))
    return lines.where(F.col("document").rlike("\\S")).select("*", doc.alias("doc"))


def _why_rejected(kind):
    """Why a parsed document gives no rows; NULL if it does."""
    lacking = reduce(or_, [~has_text(F.col(f"doc.{key}")) for key in schemas.DOCUMENTS[kind][1]])
    damaged = F.col("doc").isNull() | F.col(f"doc.{_DAMAGED}").isNotNull()
    return F.when(damaged, "damaged").when(lacking, "without key")


def _documents(spark, path, kind, whole=False, keep=(), reader=None):
    """The fields of all sound documents, and ``keep`` of the rest."""
    parsed = _parsed(reader or spark.read, path, kind, whole).where(_why_rejected(kind).isNull())
    return parsed.select("doc.*", *keep).drop(_DAMAGED)


def rejected_documents(spark, path, kind, whole=False) -> DataFrame:
    """(kind, file, reason, document) of the documents that give no rows."""
    parsed = _parsed(spark.read, path, kind, whole).withColumn("reason", _why_rejected(kind))
    return parsed.where("reason IS NOT NULL").select(F.lit(kind).alias("kind"), "file", "reason", "document")


def latest(documents: DataFrame, keys, order="landed") -> DataFrame:
    """The version of each document that landed last."""
    last = Window.partitionBy(*keys).orderBy(F.desc(order))
    return documents.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank")


def list_or_object(text, list_schema, object_schema, items=lambda parsed: F.array(parsed)):
    """Parse JSON text that is a list, or one object that ``items`` turns into one."""
    is_list = F.ltrim(text).startswith("[")
    return F.when(is_list, F.from_json(text, list_schema)).otherwise(
        items(F.from_json(text, object_schema))
    )


# --- events ------------------------------------------------------------------


def parse_event_pages(pages: DataFrame, text="value") -> DataFrame:
    """Page documents (a list, or ``{results: [...]}``) -> one row per event id."""
    events = list_or_object(
        F.col(text),
        schemas.EVENT_PAGE_LIST,
        schemas.EVENT_PAGE_OBJECT,
        items=lambda page: page["results"],
    )
    return pages.select(F.explode(events).alias("event")).select(
        F.col("event.isuId").alias("event_id")
    ).where(has_text("event_id"))


def read_event_pages(spark, path, whole=False) -> DataFrame:
    return parse_event_pages(spark.read.text(path, wholetext=whole))


def flatten_event_details(details: DataFrame) -> DataFrame:
    """Event name and its rink, with damaged text repaired."""
    return details.select(
        "event_id",
        fix_encoding("name").alias("event_name"),
        fix_encoding("track.name").alias("stadium"),
        fix_encoding("track.city").alias("city"),
        fix_encoding("track.country").alias("country"),
        to_double("track.latitude").alias("latitude"),
        to_double("track.longitude").alias("longitude"),
    )


def read_event_details(spark, path, whole=False) -> DataFrame:
    return flatten_event_details(_documents(spark, path, "event_details", whole))


def read_latest_events(spark, path, whole=False) -> DataFrame:
    """One row per event, of the version that landed last."""
    documents = _documents(spark, path, "event_details", whole, ["landed"])
    return flatten_event_details(latest(documents, ["event_id"]))


def explode_competitions(documents: DataFrame) -> DataFrame:
    """One row per competition; a missing title becomes ``Competition <number>``.

    ``title`` keeps the landed title for the exclusion rule, which sees a
    missing one as blank.
    """
    return _competitions(documents.select("event_id", F.explode("competitions").alias("c")))


def _competitions(rows, *more):
    number = to_int_via_float("c.scheduleNumber")
    return rows.select(
        "event_id",
        number.alias("schedule_number"),
        F.col("c.title").alias("title"),
        F.coalesce(
            fix_encoding("c.title"),
            F.concat(F.lit("Competition "), number.cast("string")),
        ).alias("race_name"),
        *more,
    )


def read_competitions(spark, path, whole=False) -> DataFrame:
    return explode_competitions(_documents(spark, path, "competitions", whole))


def read_listed_competitions(spark, path, whole=False) -> DataFrame:
    """Competitions with ``listed``, which orders their versions: when they landed, then their place in the list."""
    documents = _documents(spark, path, "competitions", whole, ["landed"])
    rows = documents.select("event_id", "landed", F.posexplode("competitions").alias("position", "c"))
    return _competitions(rows, F.struct("landed", "position").alias("listed"))


# --- races -------------------------------------------------------------------


def read_competition_details(spark, path, whole=False) -> DataFrame:
    """Distance and measured conditions of each race, still nested."""
    return _numbered(_documents(spark, path, "competition_details", whole))


def stream_race_documents(spark, path, kind, files_per_batch, whole=False) -> DataFrame:
    """Details or results documents of a growing folder; of a race the first that lands."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    documents = _numbered(_documents(spark, path, kind, whole, reader=reader))
    return documents.dropDuplicates(["event_id", "schedule_number"])


def _numbered(documents):
    return documents.withColumn("schedule_number", to_int_via_float("schedule_number"))


def read_latest_details(spark, path, whole=False) -> DataFrame:
    """One nested row per race, of the version that landed last."""
    documents = _numbered(_documents(spark, path, "competition_details", whole, ["landed"]))
    return latest(documents, ["event_id", "schedule_number"]).drop("landed")


def read_latest_results(spark, path, whole=False) -> DataFrame:
    """One results document per race, of the version that landed last."""
    documents = _numbered(_documents(spark, path, "competition_results", whole, ["landed"]))
    return latest(documents, ["event_id", "schedule_number"]).drop("landed")


def explode_conditions(details: DataFrame) -> DataFrame:
    """``conditions[]`` -> one row each; ``position`` keeps the array order.

    Other columns of ``details`` (event attributes already joined on) stay.
    """
    carried = [c for c in details.columns if c not in ("distance", "conditions")]
    rows = details.select(
        *carried,
        to_int_via_float("distance.distance").alias("Distance"),
        F.posexplode("conditions").alias("position", "c"),
    )
    return rows.select(
        *carried,
        "Distance",
        "position",
        F.col("c.timeStamp").alias("time_stamp"),
        stamp_date("c.timeStamp").alias("Date"),
        stamp_time("c.timeStamp").alias("Time"),
        fix_encoding("c.occasion").alias("Occasion"),
        to_double("c.airTemperature").alias("TempIndoors"),
        to_double("c.iceTemperature").alias("IceTemperature"),
        to_double("c.humidity").alias("Humidity"),
    )


def read_competition_results(spark, path, whole=False) -> DataFrame:
    """Results document of each race; list or object is still text."""
    return _numbered(_documents(spark, path, "competition_results", whole))


def parse_results(text):
    """Result list, or single object, as an array."""
    return list_or_object(F.col(text), f"array<{schemas.RESULT}>", schemas.RESULT)


def explode_results(documents: DataFrame, text="results") -> DataFrame:
    """Result list, or single object, -> one row each, ``competitor`` nested."""
    # As one generated row the list is parsed once, not for the condition that it has rows as well.
    parsed = F.explode(F.array(parse_results(text))).alias(text)
    carried = [c for c in documents.columns if c != text]
    return explode_result_list(documents.where(F.col(text).isNotNull()).select(*carried, parsed), text)


def explode_result_list(races: DataFrame, results="results") -> DataFrame:
    """Parsed results -> one row each; other columns stay."""
    carried = [c for c in races.columns if c != results]
    return races.select(*carried, F.posexplode(results).alias("position", "result"))


def flatten_results(results: DataFrame, result="result") -> DataFrame:
    """Nested result -> the columns of the results table.

    Absent rank, number, pair, lane or gap stay NULL; the CSV sink writes them
    blank.
    """
    skater = f"{result}.competitor.skater"
    carried = [c for c in results.columns if c not in (result, "position")]
    return results.select(
        *carried,
        to_int_via_float(f"{result}.rank").alias("Rank"),
        F.col(f"{result}.competitor.number").alias("Nr"),
        full_name(
            fix_encoding(f"{skater}.firstName"), fix_encoding(f"{skater}.lastName")
        ).alias("Name"),
        fix_encoding(f"{skater}.country").alias("Country"),
        to_int_via_float(f"{result}.startNumber").alias("Pair"),
        F.col(f"{result}.startLane").alias("Lane"),
        F.col(f"{result}.time").alias("Time"),
        F.col(f"{result}.timeBehind").alias("Behind"),
        decode_gender(f"{skater}.gender").alias("Gender"),
    )


def event_attributes(events: DataFrame) -> DataFrame:
    """Event columns as they are copied to every condition and result row.

    Rinks are repaired a second time, as some were damaged twice.
    """
    return events.select(
        "event_id",
        underscore(fix_encoding("stadium")).alias("Stadium"),
        underscore("city").alias("Location"),
        F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"),
        underscore("event_name").alias("Event"),
        F.col("country").alias("RinkCountry"),
    )


# --- lookups -----------------------------------------------------------------


def explode_season_bests(documents: DataFrame) -> DataFrame:
    """``seasons[].records[]`` -> one row per record.

    A season without records keeps one row with a NULL distance: being first
    with its start year, it hides later entries of that year.
    """
    seasons = documents.select(
        "skater_id", F.posexplode("seasons").alias("season_pos", "s")
    )
    records = seasons.select(
        "skater_id",
        to_int_via_float("s.start").alias("start"),
        "season_pos",
        F.posexplode_outer("s.records").alias("rec_pos", "r"),
    )
    return records.select(
        "skater_id",
        "start",
        "season_pos",
        "rec_pos",
        to_int_via_float("r.distance").alias("distance"),
        F.col("r.time").alias("time_text"),
    )


def read_season_bests(spark, path, whole=False) -> DataFrame:
    return explode_season_bests(_documents(spark, path, "season_bests", whole))


def explode_hourly_weather(documents: DataFrame) -> DataFrame:
    """Parallel arrays -> one row per hour; ``position`` keeps the array order."""
    hours = documents.select(
        "latitude",
        "longitude",
        F.posexplode(
            F.arrays_zip(
                "hourly.time",
                "hourly.temperature_2m",
                "hourly.surface_pressure",
                "hourly.pressure_msl",
            )
        ).alias("position", "h"),
    )
    return hours.select(
        to_double("latitude").alias("Latitude"),
        to_double("longitude").alias("Longitude"),
        F.col("h.time").alias("HourKey"),
        "position",
        to_double("h.temperature_2m").alias("TempOutdoors"),
        to_double("h.surface_pressure").alias("AirpressureSurface"),
        to_double("h.pressure_msl").alias("AirpressureSealevel"),
    ).where(F.col("HourKey").isNotNull())


def read_hourly_weather(spark, path, whole=False) -> DataFrame:
    return explode_hourly_weather(_documents(spark, path, "weather", whole))


def explode_skater_registry(documents: DataFrame) -> DataFrame:
    """``skaters[]`` of a country -> one row each; ``pos`` is the list order."""
    return documents.select(
        "country", F.posexplode("skaters").alias("pos", "s")
    ).select(
        F.col("s.id").alias("id"),
        F.col("s.givenname").alias("givenname"),
        F.col("s.familyname").alias("familyname"),
        "country",
        "pos",
    )


def read_skater_registry(spark, path, whole=False) -> DataFrame:
    return explode_skater_registry(_documents(spark, path, "skaters", whole))


# --- sink of the same form ---------------------------------------------------


def write_documents(df: DataFrame, path, mode="errorifexists", **options):
    """Each row as one JSON line; ``options`` are those of Spark's writer."""
    df.write.mode(mode).options(**options).json(path)
