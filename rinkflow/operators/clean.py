"""Row filters, column housekeeping and the curated names."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.functions.numbers import date_text_is_valid, hour_of, with_seconds
from rinkflow.functions.text import has_text
from rinkflow.session import materialize

#: Rows of a few texts and numbers, one per key, that are broadcast: some ten MB.
FEW_KEYS = 100_000


def exclude_titles(df: DataFrame, col="title", words=fixed.EXCLUDED_TITLE_WORDS):
    """Drop titles that contain one of ``words`` in any case; no title is kept."""
    title = F.lower(F.coalesce(F.col(col), F.lit("")))
    return df.where(~title.rlike("|".join(words)))


def require_truthy(df: DataFrame, col):
    """Drop NULL, zero and blank."""
    blank = F.lit("") if dict(df.dtypes)[col] == "string" else F.lit(0)
    return df.where(F.col(col).isNotNull() & (F.col(col) != blank))


def complete_conditions(
    df: DataFrame, stamp="time_stamp", measures=("TempIndoors", "IceTemperature", "Humidity")
):
    """Keep measurements that have a time stamp and all measures (0 is one)."""
    return df.where(has_text(stamp)).dropna(subset=list(measures))


def valid_results(df: DataFrame, result="result"):
    """Keep results that have a time and name a skater."""
    return df.where(
        has_text(f"{result}.time") & F.col(f"{result}.competitor.skater").isNotNull()
    )


def races_with_both(details: DataFrame, results: DataFrame, keys=("event_id", "schedule_number")):
    """Races that have results and at least one measured condition."""
    return details.where(F.size("conditions") > 0).join(results, list(keys), "inner")


def occasion_filter(df: DataFrame, occasion=fixed.START_OCCASION, col="Occasion"):
    return df.where(F.col(col) == occasion)


def require_columns(df: DataFrame, cols=fixed.REQUIRED_VIEW_COLUMNS):
    """Drop rows with a NULL or NaN in any of ``cols``.

    One condition per column, so that each reaches the side of a join it
    belongs to and turns a LEFT join under it into an inner one.
    """
    types = dict(df.dtypes)
    present = [F.col(c).isNotNull() for c in cols]
    present += [~F.isnan(c) for c in cols if types[c] in ("double", "float")]
    return df.where(reduce(and_, present))


def plausible(df: DataFrame, time="RaceTime", best="SeasonalBest", factor=fixed.PLAUSIBLE_FACTOR):
    """Keep times under ``factor`` x the season best; NULL and NaN are dropped."""
    limit = F.lit(factor) * F.col(best)
    return df.where((F.col(time) < limit) & ~F.isnan(limit))


def drop_helper_columns(df: DataFrame, cols=fixed.WEATHER_HELPER_COLUMNS):
    """Drop columns, ignoring absent ones."""
    return df.drop(*cols)


def ensure_columns(df: DataFrame, cols, dtype="double"):
    """Add the columns that are absent, as NULL."""
    missing = [c for c in cols if c not in df.columns]
    return df.select("*", *[F.lit(None).cast(dtype).alias(c) for c in missing])


def to_curated_results(df: DataFrame):
    """Names that stay unambiguous in the joined view; result times in seconds."""
    out = df.withColumnsRenamed({"Time": "RaceTime", "Country": "SkaterCountry"})
    is_text = dict(out.dtypes).get("RaceTime") == "string"
    return with_seconds(out, "RaceTime", "RaceTime") if is_text else out


def to_curated_conditions(df: DataFrame):
    return df.withColumnsRenamed(
        {"Time": "CondTime", "Country": "RinkCountry", "IceTemperature": "TempIce"}
    )


def flag_valid_request(
    df: DataFrame, lat="Latitude", lon="Longitude", date="Date", time="Time", flag="ValidRequest"
):
    """Mark rows that can be looked up in the weather archive."""
    place = has_text(F.col(lat).cast("string")) & has_text(F.col(lon).cast("string"))
    moment = date_text_is_valid(F.col(date).cast("string")) & hour_of(time).isNotNull()
    return df.withColumn(flag, place & moment)


def first_per_key(df: DataFrame, keys=fixed.RACE_KEY, order=None):
    """First row per key in a stated order (default: condition time, then all columns).

    The rank filter is applied before the shuffle as well, so a key sends at
    most one row per input partition.  That sorts whole partitions: where the first
    column of ``order`` is a whole number or a date and the keys are few, only the rows with
    its least value, which is found by hash, are left to be sorted.
    """
    order = order or ["CondTime"] + [c for c in df.columns if c not in keys and c != "CondTime"]
    if dict(df.dtypes).get(order[0]) in ("int", "bigint", "date", "timestamp"):
        df = _least_rows(df, list(keys), order[0])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def _least_rows(df: DataFrame, keys, col):
    """Rows with their key's least ``col``, a NULL being less; all rows if there are more than FEW_KEYS keys."""
    least = materialize(df.groupBy(*keys).agg(F.min(col).alias("_least"), F.max(F.col(col).isNull()).alias("_none")))
    if least.count() > FEW_KEYS:
        return df
    least = least.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [df[k].eqNullSafe(least[f"_{k}"]) for k in keys]
    same.append(df[col].eqNullSafe(F.when(~F.col("_none"), F.col("_least"))))
    return df.join(F.broadcast(least), reduce(and_, same), "left_semi")


def last_condition_date(
    df: DataFrame, keys=("event_id", "schedule_number"), stamp="time_stamp",
    date="Date", position="position",
):
    """Date of the last time-stamped measurement of each race.

    Taken before incomplete measurements are dropped.  An unreadable last
    stamp gives NULL.
    """
    return (
        df.where(has_text(stamp)).groupBy(*keys).agg(F.max_by(date, position).alias(date))
    )


def null_safe_left_join(left: DataFrame, right: DataFrame, keys):
    """LEFT join on ``keys``, NULL equal to NULL; ``right`` has one row per key.

    The keys are compared as one struct, whose NULL fields are equal.
    """
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.struct(*[left[k].alias(k) for k in keys]) == F.struct(
        *[other[f"_{k}"].alias(k) for k in keys]
    )
    return left.join(other, same, "left").drop(*[f"_{k}" for k in keys])
