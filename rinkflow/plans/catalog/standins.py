"""Race tables derived from the test tables, in Spark and in SQL."""

from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.operators import sequence
from rinkflow.plans import curated
from rinkflow.session import materialize

LINEITEM_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "l_shipdate",
]

DISTANCES = [500, 1000, 1500, 3000, 5000, 10000]


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def races(spark, folder):
    """Every lineitem row as a race entry, lineitem columns kept."""
    return _entered(table(spark, folder, "lineitem"))


def _entered(rows, *more):
    distances = F.array(*[F.lit(d) for d in DISTANCES])
    gender = F.when(F.col("l_orderkey") % 2 == 0, "Men").otherwise("Women")
    distance = F.get(distances, (F.col("l_partkey") % 6).cast("int"))
    best = F.col("l_quantity") + 30.0
    return rows.select(
        *LINEITEM_COLUMNS,
        F.concat(F.lit("Rink_"), (F.col("l_suppkey") % 10).cast("string")).alias("Stadium"),
        F.trunc("l_shipdate", "month").alias("Date"),
        F.concat(F.lit("Meet_"), F.year("l_shipdate").cast("string")).alias("Event"),
        F.concat(distance.cast("string"), F.lit("m_"), gender).alias("Race"),
        distance.alias("RaceDistance"),
        gender.alias("Gender"),
        F.col("l_linenumber").alias("Pair"),
        (F.col("l_orderkey") % 2).cast("double").alias("Lane"),
        best.alias("SeasonalBest"),
        (best * (F.lit(1.0) + F.col("l_discount"))).alias("RaceTime"),
        *more,
    )


def results(spark, folder):
    """Races with the skater: the customer of the order.

    Orders meet customers first, so that the long table is shuffled once, and before its texts are made.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("Name"))
    skaters = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    rows = table(spark, folder, "lineitem").join(skaters, F.col("l_orderkey") == skaters["o_orderkey"])
    return _entered(rows, "Name", F.col("o_custkey").cast("string").alias("SkaterID"))


def conditions(spark, folder):
    """Every entry as a condition row, some without outdoor weather."""
    rows = races(spark, folder)
    pair = F.col("l_linenumber")
    return rows.select(
        *LINEITEM_COLUMNS,
        *fixed.RACE_KEY,
        F.concat(F.lit("Land_"), (F.col("l_suppkey") % 10 % 4).cast("string")).alias("RinkCountry"),
        F.col("RaceDistance").alias("Distance"),
        F.when(F.col("l_orderkey") % 3 == 0, "end").otherwise("start").alias("Occasion"),
        F.concat(F.lit("1"), pair.cast("string"), F.lit(":30:00")).alias("CondTime"),
        (pair + 15.0).alias("TempIndoors"),
        (pair - 1.5 - F.col("l_suppkey") % 10).alias("TempIce"),
        (pair + 40.0).alias("Humidity"),
        F.when(F.col("l_orderkey") % 11 != 0, pair * 2.0).alias("TempOutdoors"),
        (pair + 1000.0).alias("AirpressureSurface"),
        (pair + 1010.0).alias("AirpressureSealevel"),
    )


def entries(df):
    """Without the lineitem columns."""
    return df.drop(*LINEITEM_COLUMNS)


def light_view(spark, folder):
    """Curated view of ``races`` without names and predictions."""
    from rinkflow.functions.model import fix_ice_sign
    from rinkflow.operators import clean

    first = curated.first_conditions(conditions(spark, folder), LINEITEM_COLUMNS)
    view = curated.joined_view(entries(races(spark, folder)), first)
    view = view.withColumn("TempIce", fix_ice_sign("TempIce")).withColumn("Year", F.year("Date"))
    return clean.plausible(view)


def timed_results(spark, folder):
    """Results with estimated times from mopping."""
    positions = materialize(sequence.break_positions(races(spark, folder)))
    timed = sequence.estimate_tfm(results(spark, folder), positions=positions)
    last = ["Name", "SkaterID"]
    return entries(timed).select(*[c for c in entries(timed).columns if c not in last], *last)


def full_view(spark, folder):
    """The whole curated view."""
    return curated.curated_view(
        timed_results(spark, folder), conditions(spark, folder), LINEITEM_COLUMNS
    )


_FIXTURES = {}


def once(spark, folder, name, build):
    """What ``build`` writes for the queries of one session and folder, built when first asked for."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _FIXTURES:
        _FIXTURES[key] = build()
    return _FIXTURES[key]


def stored_view(spark, folder):
    """The curated view as a stored table."""
    return once(spark, folder, "view", lambda: curated.store_view(full_view(spark, folder)))


# --- the same in SQL ---------------------------------------------------------

_ORDER = ", ".join(LINEITEM_COLUMNS)

RACES = """
races AS (
  SELECT l.*,
    'Rink_' || (l_suppkey % 10) AS "Stadium",
    CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date",
    'Meet_' || year(l_shipdate) AS "Event",
    ([500, 1000, 1500, 3000, 5000, 10000])[(l_partkey % 6) + 1] AS "RaceDistance",
    CASE WHEN l_orderkey % 2 = 0 THEN 'Men' ELSE 'Women' END AS "Gender",
    "RaceDistance" || 'm_' || "Gender" AS "Race",
    l_linenumber AS "Pair",
    CAST(l_orderkey % 2 AS DOUBLE) AS "Lane",
    l_quantity + 30.0 AS "SeasonalBest",
    (l_quantity + 30.0) * (1.0::DOUBLE + l_discount) AS "RaceTime"
  FROM lineitem l)
"""

RESULTS = RACES + """,
results AS (
  SELECT races.*, CAST(o_custkey AS VARCHAR) AS "SkaterID", c_name AS "Name"
  FROM races JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
"""

_CONDITIONS = """,
conditions AS (
  SELECT {order}, "Stadium", "Date", "Event", "Race",
    'Land_' || (l_suppkey % 10 % 4) AS "RinkCountry",
    "RaceDistance" AS "Distance",
    CASE WHEN l_orderkey % 3 = 0 THEN 'end' ELSE 'start' END AS "Occasion",
    '1' || l_linenumber || ':30:00' AS "CondTime",
    CAST(l_linenumber + 15 AS DOUBLE) AS "TempIndoors",
    CAST(l_linenumber - 1.5 - l_suppkey % 10 AS DOUBLE) AS "TempIce",
    CAST(l_linenumber + 40 AS DOUBLE) AS "Humidity",
    CASE WHEN l_orderkey % 11 <> 0 THEN CAST(l_linenumber * 2 AS DOUBLE) END AS "TempOutdoors",
    CAST(l_linenumber + 1000 AS DOUBLE) AS "AirpressureSurface",
    CAST(l_linenumber + 1010 AS DOUBLE) AS "AirpressureSealevel"
  FROM races),
firsts AS (
  SELECT * FROM conditions WHERE "Occasion" = 'start'
  QUALIFY row_number() OVER (
    PARTITION BY "Stadium", "Date", "Event", "Race" ORDER BY {order}) = 1)
""".format(order=_ORDER)

CONDITIONS = RACES + _CONDITIONS

_MATCHED = """
  c."RinkCountry", c."Distance", c."Occasion", c."CondTime", c."TempIndoors",
  CASE WHEN c."TempIce" > 0 THEN -c."TempIce" ELSE c."TempIce" END AS "TempIce",
  c."Humidity", c."TempOutdoors", c."AirpressureSealevel", c."AirpressureSurface"
"""

_COMPLETE = """
  c."RinkCountry" IS NOT NULL AND c."TempOutdoors" IS NOT NULL
  AND r."SeasonalBest" IS NOT NULL
"""

LIGHT = CONDITIONS + f""",
light AS (
  SELECT r.* EXCLUDE ({_ORDER}), {_MATCHED}, year(r."Date") AS "Year"
  FROM races r JOIN firsts c USING ("Stadium", "Date", "Event", "Race")
  WHERE {_COMPLETE} AND r."RaceTime" < 1.1::DOUBLE * r."SeasonalBest")
"""

TFM = """,
standard AS (
  SELECT *, ("Pair" - 1) * CASE "RaceDistance" WHEN 500 THEN 135 WHEN 1000 THEN 165
      WHEN 1500 THEN 200 WHEN 3000 THEN 330 WHEN 5000 THEN 480 WHEN 10000 THEN 900 END AS s,
    dense_rank() OVER (PARTITION BY "Stadium", "Date", "Event", "Race" ORDER BY "Pair") - 1 AS i
  FROM results),
placed AS (
  SELECT *, max(i) OVER (PARTITION BY "Stadium", "Date", "Event", "Race") + 1 AS n FROM standard),
timed AS (
  SELECT * EXCLUDE (s, i, n),
    CASE WHEN "RaceDistance" = 10000 AND n NOT IN (4, 6) AND i >= (n + 1) // 2
      THEN (i - (n + 1) // 2) * 900 ELSE s END AS "EstimatedTFM",
    "EstimatedTFM" + 60 AS "EstimatedTFMBuffer"
  FROM placed)
"""


def _model():
    cases = []
    for distance, (c0, *factors) in fixed.MODEL_COEFFICIENTS.items():
        names = [
            "\"GenderNum\"", "\"Lane\"", "\"EstimatedTFM\"", "\"Distance\"", "\"TempIndoors\"",
            "\"TempIce\"", "\"Humidity\"", "\"AirpressureSurface\"",
        ]
        terms = [f"({k!r})::DOUBLE" for k in c0]
        terms += [f"({k!r})::DOUBLE * {name}" for k, name in zip(factors, names)]
        cases.append(f"WHEN {distance} THEN " + " + ".join(terms))
    return "CASE \"Distance\" " + "\n      ".join(cases) + " END"


FULL = RESULTS + _CONDITIONS + TFM + f""",
joined AS (
  SELECT r.* EXCLUDE ({_ORDER}), {_MATCHED}, year(r."Date") AS "Year",
    r."SeasonalBest" - r."RaceTime" AS "Difference",
    "Difference" - 5 * min("Difference") OVER () AS "CorrectedDifference"
  FROM timed r JOIN firsts c USING ("Stadium", "Date", "Event", "Race")
  WHERE {_COMPLETE}),
numbered AS (
  SELECT *, CASE "Gender" WHEN 'Men' THEN 0 WHEN 'Women' THEN 1 END AS "GenderNum"
  FROM joined WHERE "RaceTime" < 1.1::DOUBLE * "SeasonalBest"),
scored AS (SELECT *, {_model()} AS den FROM numbered),
full_view AS (
  SELECT * EXCLUDE (den),
    "SeasonalBest" - round(1 / sqrt(CASE WHEN den > 0 THEN den END) - 480.25, 2) AS "Prediction"
  FROM scored)
"""
