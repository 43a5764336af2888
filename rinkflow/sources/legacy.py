"""Older column layouts -> the current one."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.functions.numbers import parse_stamp
from rinkflow.functions.text import _col

_RESULT_NAMES = {"Event": "Race", "Race": "Event", "Rnk": "Rank"}

_CONDITION_NAMES = {
    "Event": "Race", "MatchType": "Event", "EventCountry": "Country",
    "AirTemperature": "TempIndoors",
}


def _current(df, names, layout):
    renamed = df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])
    absent = [F.lit(None).cast("string").alias(c) for c in layout if c not in renamed.columns]
    return renamed.select("*", *absent).select(*layout)


def results_from_legacy(results: DataFrame) -> DataFrame:
    """Event held the race title and Race the meeting: swap them back."""
    return _current(results, _RESULT_NAMES, fixed.RESULT_COLUMNS)


def conditions_from_legacy(conditions: DataFrame) -> DataFrame:
    """As above; location and weather were not recorded and are NULL."""
    return _current(conditions, _CONDITION_NAMES, fixed.CONDITION_COLUMNS)


def from_legacy_layout(results: DataFrame, conditions: DataFrame):
    """Both tables in the current layout, ready for ``unionByName``."""
    return results_from_legacy(results), conditions_from_legacy(conditions)


def legacy_stamp_time(c):
    """Time of day as the older layout has it: midnight for a bare ISO date."""
    c = _col(c)
    iso = F.when(c.rlike("^[0-9]{4}-"), parse_stamp(c))
    return F.date_format(iso, "HH:mm:ss")
