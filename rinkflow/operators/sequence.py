"""Start order within races and the ice-mopping break."""

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.functions.model import standard_tfm, tfm_buffer
from rinkflow.functions.numbers import distance_of, to_int_via_float
from rinkflow.operators.clean import null_safe_left_join

# A block holds at most 2^16 distinct pair numbers, which bounds every array
# below; a window runs over one row per block of a race.
_BLOCK_BITS = 16


def pair_positions(df: DataFrame, keys=fixed.RACE_KEY, pair="Pair"):
    """Distinct (race, pair) with ``pair_index`` (from 0) and ``pairs_in_race``.

    Rows are reduced to distinct pairs before anything is gathered or ordered.
    The index is the position in the block plus the pairs of lower blocks.
    """
    keys = list(keys)
    blocks = (
        df.where(F.col(pair).isNotNull())
        .select(*keys, F.col(pair).cast("bigint").alias(pair))
        .distinct()
        .groupBy(*keys, F.shiftright(pair, _BLOCK_BITS).alias("_block"))
        .agg(F.array_sort(F.collect_list(pair)).alias("_pairs"))
    )
    race = Window.partitionBy(*keys)
    up_to_here = race.orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    size = F.size("_pairs")
    placed = blocks.select(
        *keys,
        "_pairs",
        (F.sum(size).over(up_to_here) - size).alias("_lower"),
        F.sum(size).over(race).alias("pairs_in_race"),
    )
    return placed.select(
        *keys, "_lower", "pairs_in_race", F.posexplode("_pairs").alias("_place", pair)
    ).select(*keys, pair, (F.col("_lower") + F.col("_place")).alias("pair_index"), "pairs_in_race")


def add_pair_index(df: DataFrame, keys=fixed.RACE_KEY, pair="Pair"):
    """Position of each row's pair among the race's sorted distinct pairs."""
    return null_safe_left_join(df, pair_positions(df, keys, pair), [*keys, pair])


def pairs_per_race(df: DataFrame, keys=fixed.RACE_KEY, pair="Pair"):
    """Number of distinct pairs of each race; NULL pairs do not count."""
    return (
        df.where(F.col(pair).isNotNull())
        .select(*keys, pair)
        .distinct()
        .groupBy(*keys)
        .agg(F.count("*").alias("n_pairs"))
    )


def whole_pair(df: DataFrame, pair="Pair"):
    """Pair number, read from text if it is not yet one."""
    return F.col(pair) if dict(df.dtypes)[pair] == "int" else to_int_via_float(pair)


def add_standard_tfm(df: DataFrame, pair="Pair", distance_col="Race"):
    """Estimated time from mopping by start order; NULL for other distances."""
    tfm = standard_tfm(whole_pair(df, pair), distance_of(distance_col))
    return df.withColumns({"EstimatedTFM": tfm, "EstimatedTFMBuffer": tfm_buffer(tfm)})


def _with_pair(df, pair, distance_col):
    is_long = distance_of(distance_col) == str(fixed.BREAK_DISTANCE)
    return df.withColumns({"_pair": whole_pair(df, pair), "_long": F.coalesce(is_long, F.lit(False))})


def break_positions(df: DataFrame, keys=fixed.RACE_KEY, pair="Pair", distance_col="Race"):
    """Positions of the pairs of races that may have a break."""
    rows = _with_pair(df, pair, distance_col)
    return pair_positions(rows.where("_long"), keys, "_pair").withColumn("_long", F.lit(True))


def tfm_break_reset(
    df: DataFrame, keys=fixed.RACE_KEY, pair="Pair", distance_col="Race",
    tfm="EstimatedTFM", buffer="EstimatedTFMBuffer", positions=None,
):
    """Restart the clock for pairs that skate after the break of a 10000 m.

    The break comes halfway; races of 4 or 6 pairs have none, nor do races of
    a single pair.  ``positions``, if they are known, are the `break_positions` of the races; stored
    they are small beside the rows, which then need not be shuffled.
    """
    # All rows keep their pair in the join key, so a race spreads over its pairs.
    rows = _with_pair(df, pair, distance_col)
    positions = break_positions(df, keys, pair, distance_col) if positions is None else positions
    placed = null_safe_left_join(rows, positions, [*keys, "_pair", "_long"])
    half = F.floor((F.col("pairs_in_race") + 1) / 2)
    resets = (
        F.col("pair_index").isNotNull()
        & ~F.col("pairs_in_race").isin(fixed.PAIR_COUNTS_WITHOUT_BREAK)
        & (F.col("pair_index") >= half)
    )
    restarted = (F.col("pair_index") - half) * fixed.PAIR_INTERVALS[fixed.BREAK_DISTANCE]
    return placed.select(
        *[c for c in df.columns if c not in (tfm, buffer)],
        F.when(resets, restarted).otherwise(F.col(tfm)).alias(tfm),
        F.when(resets, tfm_buffer(restarted)).otherwise(F.col(buffer)).alias(buffer),
    )


def estimate_tfm(df: DataFrame, keys=fixed.RACE_KEY, pair="Pair", distance_col="Race", positions=None):
    """Both steps: by start order, then the break."""
    timed = add_standard_tfm(df, pair, distance_col)
    return tfm_break_reset(timed, keys, pair, distance_col, positions=positions)
