"""Start order, first and last rows, and the ice-mopping break."""

from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.operators import clean, sequence
from rinkflow.plans.catalog import landing
from rinkflow.plans.catalog.registry import plain, query
from rinkflow.plans.catalog.standins import (
    CONDITIONS, LINEITEM_COLUMNS, RACES, TFM, conditions, races, table,
)
from rinkflow.plans.enrichment import last_stamp_date
from rinkflow.session import scratch_folder
from rinkflow.sources import landed_json

_ID = ["l_orderkey", "l_linenumber", "l_partkey"]
_TIMED = RACES + TFM.replace("FROM results", "FROM races")


@query("WITH " + _TIMED + """
SELECT l_orderkey, l_linenumber, l_partkey, i AS pair_index, n AS pairs_in_race FROM placed""")
def w1_pair_index(spark, folder):
    """Pair index and pairs in race (W1, W2)."""
    rows = sequence.add_pair_index(races(spark, folder))
    return plain(rows.select(*_ID, "pair_index", "pairs_in_race"))


@query("WITH " + _TIMED + """
SELECT l_orderkey, l_linenumber, l_partkey, "EstimatedTFM", "EstimatedTFMBuffer" FROM timed""")
def w3_tfm_break_reset(spark, folder):
    rows = sequence.estimate_tfm(races(spark, folder))
    return plain(rows.select(*_ID, "EstimatedTFM", "EstimatedTFMBuffer"))


@query("WITH " + _TIMED.replace('"Stadium", "Date", "Event", "Race" ORDER', '"Stadium", "Date", "Event", "RaceDistance" ORDER')
       .replace('(PARTITION BY "Stadium", "Date", "Event", "Race")', '(PARTITION BY "Stadium", "Date", "Event", "RaceDistance")') + """
SELECT l_orderkey, l_linenumber, l_partkey, "EstimatedTFM", "EstimatedTFMBuffer" FROM timed""")
def w3_tfm_break_reset_merged(spark, folder):
    """The same with a race key that merges men and women."""
    rows = sequence.estimate_tfm(races(spark, folder), ["Stadium", "Date", "Event", "RaceDistance"])
    return plain(rows.select(*_ID, "EstimatedTFM", "EstimatedTFMBuffer"))


@query("WITH " + _TIMED + """
SELECT l_orderkey, l_linenumber, l_partkey, s AS "EstimatedTFM", s + 60 AS "EstimatedTFMBuffer" FROM placed""")
def f14_standard_tfm(spark, folder):
    rows = sequence.add_standard_tfm(races(spark, folder))
    return plain(rows.select(*_ID, "EstimatedTFM", "EstimatedTFMBuffer"))


@query("WITH " + RACES + """
SELECT "Stadium", CAST("Date" AS VARCHAR) AS "Date", "Event", "Race", count(DISTINCT "Pair") AS n_pairs
FROM races GROUP BY ALL""")
def a13_pairs_per_race(spark, folder):
    return plain(sequence.pairs_per_race(races(spark, folder)))


@query("WITH " + CONDITIONS + """
SELECT "Stadium", CAST("Date" AS VARCHAR) AS "Date", "Event", "Race", l_orderkey, l_linenumber, "TempIce"
FROM firsts""")
def w4_first_per_key(spark, folder):
    start = clean.occasion_filter(conditions(spark, folder))
    first = clean.first_per_key(start, fixed.RACE_KEY, LINEITEM_COLUMNS)
    return plain(first.select(*fixed.RACE_KEY, "l_orderkey", "l_linenumber", "TempIce"))


# Rows of one position have one date; every fifth row has no stamp, every
# seventh an unreadable one.
@query("""
SELECT l_orderkey AS event_id, arg_max_null(CASE WHEN l_partkey % 7 <> 0 THEN day END, position) AS "Date"
FROM (SELECT l_orderkey, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS day,
        (l_linenumber * 100000000 + l_partkey * 10000 + l_suppkey) * 20000
          + datediff('day', DATE '1970-01-01', l_shipdate) AS position
      FROM lineitem WHERE l_partkey % 5 <> 0)
GROUP BY 1""")
def w5_last_condition_date(spark, folder):
    part = F.col("l_partkey")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("event_id"),
        F.when(part % 5 == 0, "").when(part % 7 == 0, "soon").otherwise(day).alias("time_stamp"),
        F.when((part % 5 != 0) & (part % 7 != 0), F.col("l_shipdate").cast("date")).alias("Date"),
        (
            (F.col("l_linenumber").cast("bigint") * 100000000 + part * 10000 + F.col("l_suppkey"))
            * 20000
            + F.datediff("l_shipdate", F.lit("1970-01-01"))
        ).alias("position"),
    )
    return plain(clean.last_condition_date(rows, ["event_id"]))


@query("""
SELECT 'E' || l_orderkey AS event_id, l_partkey AS schedule_number, l_linenumber AS "Distance",
  strftime(l_shipdate, '%Y-%m-%d') AS "Date"
FROM lineitem""")
def w5_last_stamp_date(spark, folder):
    """The same over nested documents, as the whole plan takes it: the last of two stamps."""
    path = scratch_folder(spark)
    landing.competition_details(spark, folder).write.json(path)
    details = landed_json.read_competition_details(spark, path)
    return plain(
        details.select(
            "event_id", "schedule_number", F.col("distance.distance").cast("int").alias("Distance"),
            last_stamp_date().alias("Date"),
        )
    )
