"""Pair intervals, time since ice mopping and the performance model."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.functions.text import _col, gender_num


def interval_for(distance) -> Column:
    """Seconds between two pairs, by distance or its text; NULL for others."""
    entries = [F.lit(x) for d, s in fixed.PAIR_INTERVALS.items() for x in (str(d), s)]
    return F.try_element_at(F.create_map(*entries), _col(distance).cast("string"))


def standard_tfm(pair, distance) -> Column:
    """Seconds from mopping to this pair, counted from the first pair."""
    return (_col(pair).cast("bigint") - 1) * interval_for(distance)


def tfm_buffer(tfm) -> Column:
    return _col(tfm) + fixed.TFM_BUFFER


def fix_ice_sign(c) -> Column:
    """Ice is never above zero: a positive temperature lost its sign."""
    c = _col(c)
    return F.when(c > 0, -c).otherwise(c)


def performance_difference(season_best, time) -> Column:
    return _col(season_best) - _col(time)


def model_denominator(
    coefficients,
    gender="Gender",
    lane="Lane",
    tfm="EstimatedTFM",
    distance="Distance",
    temp_indoors="TempIndoors",
    temp_ice="TempIce",
    humidity="Humidity",
    pressure="AirpressureSurface",
) -> Column:
    """The model's weighted sum; NULL where an input is NULL."""
    k = _col(coefficients)
    return (
        k["c0"]
        + k["gender"] * gender_num(gender)
        + k["lane"] * _col(lane).try_cast("double")
        + k["tfm"] * _col(tfm)
        + k["distance"] * _col(distance)
        + k["temp_indoors"] * _col(temp_indoors)
        + k["temp_ice"] * _col(temp_ice)
        + k["humidity"] * _col(humidity)
        + k["pressure"] * _col(pressure)
    )


def model_term(denominator) -> Column:
    """What is taken off the season best, before rounding."""
    total = _col(denominator)
    return F.lit(1.0) / F.sqrt(F.when(total > 0, total)) - fixed.MODEL_OFFSET
