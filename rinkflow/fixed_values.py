"""Values that decide results and therefore must not be changed.

Everything here is data: column layouts, word lists, patterns, thresholds and
the coefficients of the per-distance performance model.  Code elsewhere reads
them from this module.
"""

# --- fixed values: column layouts -------------------------------------------

RESULT_COLUMNS = [
    "Stadium", "Date", "Event", "Race", "Rank", "Nr", "Name", "Country",
    "Pair", "Lane", "Time", "Behind", "Gender",
]

CONDITION_COLUMNS = [
    "Stadium", "Location", "Latitude", "Longitude", "Date", "Event", "Race",
    "Country", "Distance", "Occasion", "Time", "TempIndoors",
    "IceTemperature", "Humidity", "AirpressureSurface", "AirpressureSealevel",
]

LEGACY_RESULT_COLUMNS = [
    "Stadium", "Date", "Event", "Race", "Rnk", "Nr", "Name", "Country",
    "Pair", "Lane", "Time", "Behind", "Gender",
]

LEGACY_CONDITION_COLUMNS = [
    "Stadium", "Date", "Event", "MatchType", "EventCountry", "Distance",
    "Occasion", "Time", "AirTemperature", "IceTemperature", "Humidity",
]

RACE_KEY = ["Stadium", "Date", "Event", "Race"]

# What orders measurements as they landed: dropped from the final layout.
INGEST_ORDER = ["event_id", "schedule_number", "position"]

WEATHER_COLUMNS = ["TempOutdoors", "AirpressureSurface", "AirpressureSealevel"]

WEATHER_HELPER_COLUMNS = ["Location", "Latitude", "Longitude"]

TFM_COLUMNS = ["EstimatedTFM", "EstimatedTFMBuffer"]

# Columns of the joined view that may not be NULL (curated names).
REQUIRED_VIEW_COLUMNS = [
    "SeasonalBest", "RinkCountry", "Distance", "Occasion", "CondTime",
    "TempIndoors", "TempIce", "Humidity", "TempOutdoors",
    "AirpressureSealevel", "AirpressureSurface",
]

# --- fixed values: words, patterns, thresholds ------------------------------

EXCLUDED_TITLE_WORDS = ["team", "mass", "mixed"]

START_OCCASION = "start"

MOJIBAKE_PATTERN = "[Ã][^\\s]{1,2}"

GENDER_NAMES = {"F": "Women", "M": "Men"}

GENDER_NUMBERS = {"Men": 0, "Women": 1}

MAX_LENGTH_DIFFERENCE = 0.2

MIN_SIMILARITY = 0.9

CANDIDATES_PER_LOOKUP = 10

PARTIAL_FAMILY_LENGTH = 4

PLAUSIBLE_FACTOR = 1.1

CORRECTION_FACTOR = -5

OUTLIER_FACTOR = 1.5

HISTOGRAM_BINS = 20

DEFAULT_GENDERS = ["Men", "Women"]

DEFAULT_DISTANCE = 500

ALL_STADIUMS = "All"

EVENTS_PER_BATCH = 15

# --- fixed values: seconds between pairs, ice break -------------------------

PAIR_INTERVALS = {
    500: 135,
    1000: 165,
    1500: 200,
    3000: 330,
    5000: 480,
    10000: 900,
}

TFM_BUFFER = 60

BREAK_DISTANCE = 10000

PAIR_COUNTS_WITHOUT_BREAK = [4, 6]

# --- fixed values: performance model ----------------------------------------
# Per distance: the three constant terms, then the factors of gender, lane,
# estimated time from mopping, distance, indoor temperature, ice temperature,
# humidity and surface air pressure.

MODEL_OFFSET = 480.25

MODEL_COEFFICIENTS = {
    500: ((1.662e-11, -5.078e-09, 8.492e-09), 3.362e-09, 1.218e-09, 1.374e-12,
          8.312e-09, -1.871e-10, 1.08e-09, 6.49e-12, 1.985e-10),
    1000: ((4.29e-12, 1.212e-08, 3.763e-09), 9.894e-09, -2.579e-09, 1.763e-12,
           4.29e-09, 5.413e-10, 1.559e-09, -1.162e-10, 6.082e-11),
    1500: ((1.812e-12, -1.04e-09, 2.483e-08), 1.147e-08, 3.702e-09, 4.794e-12,
           2.718e-09, -2.122e-09, -1.171e-09, -1.136e-09, 3.257e-10),
    3000: ((4.126e-13, -3.063e-09, 4.054e-08), 6.188e-08, 1.044e-08, -5.195e-13,
           1.238e-09, 2.952e-10, 3.25e-09, -1.502e-10, 6.038e-10),
    5000: ((1.582e-13, 7.289e-08, 3.185e-09), -5.162e-08, 7.835e-08, 5.687e-13,
           7.909e-10, 1.577e-09, 1.809e-08, -6.303e-10, 5.537e-10),
    10000: ((4.29e-12, 1.212e-08, 3.763e-09), 9.894e-09, -2.579e-09, 1.763e-12,
            4.29e-09, 5.413e-10, 1.559e-09, -1.162e-10, 6.082e-11),
}
