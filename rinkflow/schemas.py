"""Explicit schemas of landed documents, as Spark DDL.

Landed documents carry the keys that the original addresses held (event id,
schedule number, skater id, coordinates) as extra fields.  Numbers are read as
text, as some come quoted, and become numbers where rows are made.
"""

EVENT_PAGE_LIST = "array<struct<isuId:string>>"
EVENT_PAGE_OBJECT = f"struct<results:{EVENT_PAGE_LIST}>"

EVENT_DETAIL = (
    "event_id string, name string, track struct<name:string, city:string,"
    " country:string, latitude:string, longitude:string>"
)

COMPETITIONS = (
    "event_id string, competitions array<struct<scheduleNumber:string, title:string>>"
)

CONDITION = (
    "struct<timeStamp:string, airTemperature:string, iceTemperature:string,"
    " humidity:string, occasion:string>"
)

COMPETITION_DETAIL = (
    "event_id string, schedule_number string, distance struct<distance:string>,"
    f" conditions array<{CONDITION}>"
)

# The results of a race are a list or a single object: kept as text here and
# parsed against both shapes.
COMPETITION_RESULTS = "event_id string, schedule_number string, results string"

RESULT = (
    "struct<rank:string, time:string, timeBehind:string, startNumber:string,"
    " startLane:string, competitor:struct<number:string,"
    " skater:struct<firstName:string, lastName:string, country:string,"
    " gender:string>>>"
)

SEASON_BESTS = (
    "skater_id string, seasons array<struct<start:string,"
    " records:array<struct<distance:string, time:string>>>>"
)

SKATER_REGISTRY = (
    "country string, skaters array<struct<id:string, givenname:string,"
    " familyname:string>>"
)

HOURLY_WEATHER = (
    "latitude string, longitude string, hourly struct<time:array<string>,"
    " temperature_2m:array<string>, surface_pressure:array<string>,"
    " pressure_msl:array<string>>"
)

# Kind of document -> its schema and the fields that it cannot do without.
DOCUMENTS = {
    "event_details": (EVENT_DETAIL, ["event_id"]),
    "competitions": (COMPETITIONS, ["event_id"]),
    "competition_details": (COMPETITION_DETAIL, ["event_id", "schedule_number"]),
    "competition_results": (COMPETITION_RESULTS, ["event_id", "schedule_number"]),
    "season_bests": (SEASON_BESTS, ["skater_id"]),
    "skaters": (SKATER_REGISTRY, ["country"]),
    "weather": (HOURLY_WEATHER, ["latitude", "longitude"]),
}


def text_columns(names):
    """DDL of a table whose columns are all text."""
    return ", ".join(f"`{name}` string" for name in names)
