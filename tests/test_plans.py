"""What the plans look like, and what a hot key does to them."""

import re

import pytest
from pyspark.sql import functions as F

from rinkflow.operators import clean, identity, joins, quantiles, sequence, stats
from rinkflow.plans import curated, enrichment
from rinkflow.plans.catalog import standins

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def view(spark):
    return standins.light_view(spark, FOLDER)


def test_joined_view_is_an_inner_join(spark):
    first = curated.first_conditions(standins.conditions(spark, FOLDER), standins.LINEITEM_COLUMNS)
    text = plan(curated.joined_view(standins.entries(standins.races(spark, FOLDER)), first))
    assert "Inner" in text and "LeftOuter" not in text


def test_first_rows_are_limited_before_the_shuffle(spark):
    text = plan(clean.first_per_key(standins.conditions(spark, FOLDER), order=standins.LINEITEM_COLUMNS))
    below_exchange = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below_exchange and ", Partial" in below_exchange


def test_python_only_in_name_resolution(spark, view):
    registry = spark.createDataFrame([("1", "A", "B", "N", 0)], "id string, givenname string, familyname string, country string, pos int")
    names = spark.createDataFrame([("A_B", "N")], "Name string, Country string")
    assert plan(identity.resolve_entities(names, registry)).count("ArrowEvalPython") == 2
    for df in (view, quantiles.box_by(view, "Year", "RaceTime"), sequence.estimate_tfm(standins.races(spark, FOLDER)),
               curated.add_prediction(view.withColumn("EstimatedTFM", view["Pair"]))):
        assert "Python" not in plan(df)


def test_no_cross_join_and_no_global_window(spark, view):
    for df in (stats.add_corrected_difference(view), quantiles.outliers(view, "RaceTime"), stats.histogram(view, "TempIce")):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
    rows = standins.races(spark, FOLDER)
    assert "Window" not in plan(stats.add_corrected_difference(rows))


def test_selection_reaches_the_scan(spark):
    from rinkflow.operators.selection import select_rows

    stored = standins.stored_view(spark, FOLDER)
    text = plan(select_rows(stored, countries=["Land_1"]).select("RaceTime"))
    scan = text[text.index("FileScan"):]
    assert "PartitionFilters: [isnotnull(Distance" in scan and "In(RinkCountry" in scan.replace("EqualTo(RinkCountry", "In(RinkCountry")
    assert "Prediction" not in scan.split("ReadSchema")[1]


def test_hot_race_shrinks_before_anything_is_ordered(spark):
    """A third and more of all rows in one race: what is gathered are its distinct pairs."""
    df = spark.range(30_000).selectExpr(
        "IF(id % 2 = 0, 'hot', 'r' || id % 50) AS Stadium", "'d' AS Date", "'e' AS Event", "'10000m' AS Race",
        "int(id % 14 div 2) + 1 AS Pair")
    positions = sequence.pair_positions(df)
    hot = positions.where("Stadium = 'hot'").orderBy("Pair").collect()
    assert [(r.Pair, r.pair_index, r.pairs_in_race) for r in hot] == [(p, p - 1, 7) for p in range(1, 8)]
    text = plan(positions)
    assert text.rindex("HashAggregate") > text.rindex("Exchange")  # combined before the first shuffle
    assert sequence.estimate_tfm(df).count() == 30_000


def test_joins_keep_every_row_once(spark):
    rows = standins.races(spark, FOLDER)
    first = curated.first_conditions(standins.conditions(spark, FOLDER), standins.LINEITEM_COLUMNS)
    assert joins.join_conditions(rows, first).count() == rows.count()
    assert sequence.estimate_tfm(rows).count() == rows.count()


def test_row_order_does_not_matter(spark):
    def digest(order):
        rows = standins.races(spark, FOLDER).orderBy(*order)
        view = curated.joined_view(standins.entries(sequence.estimate_tfm(rows)),
                                   curated.first_conditions(standins.conditions(spark, FOLDER), standins.LINEITEM_COLUMNS))
        return view.selectExpr("count(*)", "sum(hash(*))").first()

    assert digest(["l_orderkey"]) == digest(["l_shipdate", "l_partkey"])


def test_hot_key_of_a_join_is_split(spark):
    """Half of all rows in one race, and no side small enough to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        results = spark.range(0, 80_000, 1, 16).selectExpr(
            "IF(id % 2 = 0, 'hot', 'r' || id % 500) AS Stadium", "'d' AS Date", "'e' AS Event", "'500m' AS Race",
            "id", "uuid() AS Name")
        first = spark.range(0, 500).selectExpr(
            "IF(id = 0, 'hot', 'r' || id) AS Stadium", "'d' AS Date", "'e' AS Event", "'500m' AS Race", "id AS TempIce")
        joined = joins.join_conditions(results, first)
        assert joined.where("Stadium = 'hot' AND TempIce = 0").count() == 40_000
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_from_landed_documents_to_figures(spark):
    """All plans in one go: enrichment, curated view, figures."""
    from rinkflow.plans import dashboard, enrichment
    from rinkflow.plans.catalog import landing
    from rinkflow.session import scratch_folder

    path = landing.landing_folder(spark, FOLDER, scratch_folder(spark))
    results, conditions = enrichment.read_and_enrich(spark, path)
    view = curated.store_view(curated.curated_view(
        clean.to_curated_results(results), clean.to_curated_conditions(conditions)))
    n = view.count()
    assert n > 0
    distance = view.first().Distance
    figures = dashboard.main_figures(view, distance=distance)
    kept = figures["summary"].first().n
    assert kept == view.where(view["Distance"] == distance).count()
    assert figures["scatter"].count() == kept
    assert sum(r["count"] for r in figures["ice_histogram"].collect()) == kept
    assert sum(r.n for r in figures["time_by_stadium"].collect()) <= kept
    assert figures["trend"].count() == view.where(view["Distance"] == distance).select("TempIce").distinct().count()
    nothing = dashboard.main_figures(view, gender=[], distance=distance)
    assert nothing["summary"].first().n == 0
    assert all(nothing[k].count() == 0 for k in ("outliers", "time_by_year", "ice_histogram", "ice_box", "trend"))


def test_quantiles_shuffle_counts_only(spark, monkeypatch):
    """Values are counted in bins on the map side: none is a shuffle or window key."""
    plans = []
    stored = quantiles.materialize

    def watched(df):
        plans.append(plan(df))
        return stored(df)

    monkeypatch.setattr(quantiles, "materialize", watched)
    rows = standins.table(spark, FOLDER, "lineitem")
    quantiles.exact_quantiles(rows, "l_extendedprice", [0.25, 0.5], ["l_returnflag"]).collect()
    assert len(plans) >= 3
    for text in plans:
        assert not re.search(r"(hash|range)partitioning\([^)]*_v#", text)
        assert not re.search(r"Window \[[^\]]*_v#", text)


def test_joined_view_is_read_once(spark):
    """The minimum of the differences is observed as the joined view is written."""
    results = standins.entries(standins.races(spark, FOLDER))
    text = plan(curated.curated_view(results.withColumn("EstimatedTFM", results["Pair"]), standins.conditions(spark, FOLDER), standins.LINEITEM_COLUMNS))
    final = text.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "Join" not in final.replace("BroadcastHashJoin [Distance", "")


def test_missing_keys_meet_and_stay_spread(spark):
    results = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN concat('S', id) END AS Stadium", "DATE'2024-01-02' AS Date", "'E' AS Event", "'R' AS Race", "id AS Pair")
    conditions = results.where("id % 5 = 0").drop("Pair").dropDuplicates().selectExpr("*", "coalesce(Stadium, 'none') AS Rink")
    joined = joins.join_conditions(results, conditions)
    rows = joined.collect()
    assert len(rows) == 3000 and joined.columns == [*results.columns, "Rink"]
    for r in rows:
        assert r.Rink == ("none" if r.Pair % 3 == 0 else f"S{r.Pair}" if r.Pair % 5 == 0 else None)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        per_task = joins.join_conditions(results, conditions).groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in per_task.collect()) < 3000 / 8 * 2
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_first_measurement_is_the_one_that_landed_first(spark, tmp_path):
    """A bare date has no time; it does not come before 10:30 that landed before it."""
    import json

    measure = lambda stamp, ice: {"timeStamp": stamp, "airTemperature": 15, "iceTemperature": ice, "humidity": 40, "occasion": "start"}
    skater = {"firstName": "A", "lastName": "B", "country": "NED", "gender": "F"}
    documents = {
        "event_pages": [[{"isuId": "e"}]],
        "event_details": [{"event_id": "e", "name": "Cup", "track": {"name": "Rink", "city": "C", "country": "NED", "latitude": 1, "longitude": 2}}],
        "competitions": [{"event_id": "e", "competitions": [{"scheduleNumber": 1, "title": "500m"}]}],
        "competition_details": [{"event_id": "e", "schedule_number": 1, "distance": {"distance": 500},
                                 "conditions": [measure("2024-01-02T10:30:00", -5.0), measure("2024-01-02", -9.0)]}],
        "competition_results": [{"event_id": "e", "schedule_number": 1, "results": {"rank": 1, "time": "36,1", "startNumber": 1, "competitor": {"skater": skater}}}],
        "skaters": [{"country": "NED", "skaters": [{"id": "7", "givenname": "A", "familyname": "B"}]}],
        "season_bests": [{"skater_id": "7", "seasons": [{"start": 2023, "records": [{"distance": 500, "time": "37,0"}]}]}],
        "weather": [{"latitude": 1, "longitude": 2, "hourly": {"time": ["2024-01-02T10:00"], "temperature_2m": [3], "surface_pressure": [1000], "pressure_msl": [1010]}}],
    }
    for kind, lines in documents.items():
        (tmp_path / kind).mkdir()
        (tmp_path / kind / "part.json").write_text("\n".join(map(json.dumps, lines)))
    results, conditions = enrichment.read_and_enrich(spark, str(tmp_path))
    view = curated.curated_view(clean.to_curated_results(results), clean.to_curated_conditions(conditions))
    assert [(r.CondTime, r.TempIce, r.RaceTime) for r in view.collect()] == [("10:30:00", -5.0, 36.1)]


def test_first_rows_of_few_keys_are_found_by_hash(spark, monkeypatch):
    """Only rows with a key's least value, or its missing ones, are left to be sorted."""
    given = [(k, o, i) for i, (k, o) in enumerate([("a", 3), ("a", 2), ("a", 2), (None, 5), (None, None), ("b", None), ("b", 1)])]
    df = spark.createDataFrame(given, "k string, o long, i int")
    first = clean.first_per_key(df, ["k"], ["o", "i"])
    text = plan(first)
    assert "LeftSemi" in text[text.index("WindowGroupLimit"):]
    expected = {("a", 2, 1), (None, None, 4), ("b", None, 5)}
    assert {tuple(r) for r in first.collect()} == expected
    monkeypatch.setattr(clean, "FEW_KEYS", 1)
    many = clean.first_per_key(df, ["k"], ["o", "i"])
    assert "LeftSemi" not in plan(many) and {tuple(r) for r in many.collect()} == expected


def test_stored_view_is_ordered_in_ranges_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(curated, "ROWS_TO_SORT", 1000, raising=False)
    view = spark.range(20_000).selectExpr(
        "500 AS Distance", "int(id % 30) AS Year", "'s' || id % 10 AS Stadium", "date_add(date'2000-01-01', int(id % 900)) AS Date",
        "'r' || id AS Race")
    stored = curated.store_view(view)
    assert stored.count() == 20_000 and len(stored.inputFiles()) >= 15


def test_entries_are_shuffled_once_for_their_skaters(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(standins.results(spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text[text.index("SortMergeJoin"):].startswith("SortMergeJoin [l_orderkey")
