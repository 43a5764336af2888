import json
import os
import time

import pytest
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.plans import enrichment
from rinkflow.sources import delimited, landed_json, legacy, tables
from rinkflow.streaming import landing


def put(folder, documents, name="part.json"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(d if isinstance(d, str) else json.dumps(d, ensure_ascii=False) for d in documents))
    return str(folder)


def test_event_pages(spark, tmp_path):
    path = put(tmp_path / "p", [[{"isuId": "a"}, {"isuId": ""}, {"x": 1}], {"results": [{"isuId": "b"}, {"isuId": "a"}]}, [], {}])
    assert sorted(r[0] for r in landed_json.read_event_pages(spark, path).collect()) == ["a", "a", "b"]


def test_whole_file_documents(spark, tmp_path):
    text = json.dumps({"results": [{"isuId": "a"}, {"isuId": "b"}]}, indent=2)
    path = put(tmp_path / "p", [text])
    assert landed_json.read_event_pages(spark, path, whole=True).count() == 2


def test_results_list_object_and_invalid(spark, tmp_path):
    skater = {"firstName": "JÃ¶rg", "lastName": "van Dam", "country": "NED", "gender": "M"}
    good = {"rank": 1, "time": "36,07", "startNumber": 2, "competitor": {"number": "7", "skater": skater}}
    path = put(tmp_path / "r", [
        {"event_id": "e", "schedule_number": 1, "results": [good, {"time": "", "competitor": {"skater": skater}},
                                                          {"time": "1", "competitor": {"number": "1"}},
                                                          {"time": "1", "competitor": {"skater": None}}, {"time": "1"}]},
        {"event_id": "e", "schedule_number": 2, "results": good},
        {"event_id": "e", "schedule_number": 3, "results": []},
        {"event_id": "e", "schedule_number": 4, "results": {}},
        {"event_id": "e", "schedule_number": 5}])
    documents = landed_json.read_competition_results(spark, path)
    assert sorted(r.schedule_number for r in enrichment.has_results(documents).collect()) == [1, 2]
    from rinkflow.operators.clean import valid_results

    out = landed_json.flatten_results(valid_results(landed_json.explode_results(documents)))
    assert sorted((r.schedule_number, r.Name, r.Gender, r.Pair, r.Lane) for r in out.collect()) == [
        (1, "Jörg_van_Dam", "Men", 2, None), (2, "Jörg_van_Dam", "Men", 2, None)]


def test_damaged_documents_are_rejected(spark, tmp_path):
    path = put(tmp_path / "d", ['{"event_id": "a", "name"', {"event_id": "b", "name": "N"}, {"name": "no key"}, "", "[1]"])
    assert {r.event_id: r.event_name for r in landed_json.read_event_details(spark, path).collect()} == {"b": "N"}
    rejected = landed_json.rejected_documents(spark, path, "event_details").collect()
    assert sorted((r.reason, r.document) for r in rejected if r.document != "[1]") == [
        ("damaged", '{"event_id": "a", "name"'), ("without key", '{"name": "no key"}')]
    assert len(rejected) == 3 and all(r.file.endswith("/d/part.json") for r in rejected)


def test_numbers_as_text_and_last_versions(spark, tmp_path):
    result = lambda time: {"rank": "1", "time": time, "startNumber": "3", "competitor": {"skater": {"firstName": "A"}}}
    folder = tmp_path / "r"
    put(folder, [{"event_id": "e", "schedule_number": "2", "results": [result("1")]}], "b.json")
    time.sleep(0.05)
    put(folder, [{"event_id": "e", "schedule_number": 2.0, "results": result("2")}, {"event_id": "e", "schedule_number": "x"}], "a.json")
    documents = landed_json.read_latest_results(spark, str(folder))
    rows = landed_json.flatten_results(landed_json.explode_results(documents)).collect()
    assert [(r.schedule_number, r.Rank, r.Pair, r.Time) for r in rows] == [(2, 1, 3, "2")]


def test_each_document_is_parsed_once(spark, tmp_path):
    """Both outputs come from one stored table of nested races."""
    from rinkflow.plans.catalog.landing import landing_folder

    folder = landing_folder(spark, "/root/testdata/sf0.001", str(tmp_path / "landing"))
    results, conditions = enrichment.read_and_enrich(spark, folder)
    for df in (results, conditions):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("from_json(") + text.count("jsontostructs(") <= 1  # season bests or weather
    before = sorted(map(str, results.collect())), sorted(map(str, conditions.collect()))
    landing_folder(spark, "/root/testdata/sf0.001", folder, again=True)
    after = enrichment.read_and_enrich(spark, folder)
    assert before == tuple(sorted(map(str, df.collect())) for df in after)


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a;b", 'say "x"', None, "é")], "Stadium string, Name string, Rank int, Event string")
    delimited.write_semicolon_csv(df, str(tmp_path / "c"), fixed.RESULT_COLUMNS)
    back = delimited.read_semicolon_csv(spark, str(tmp_path / "c"), fixed.RESULT_COLUMNS)
    assert back.columns == fixed.RESULT_COLUMNS
    assert [(r.Stadium, r.Name, r.Rank, r.Event) for r in back.collect()] == [("a;b", 'say "x"', None, "é")]


def test_failed_load_leaves_old_table(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert tables.save_text_table(spark.createDataFrame([(1, None)], "`a b` int, c string"), "kept", folder) == 1
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception, match="no"):
        tables.save_text_table(broken, "kept", folder)
    assert spark.table("kept").columns == ["A_B", "C"]
    assert [tuple(r) for r in spark.table("kept").collect()] == [("1", "")]
    with pytest.raises(ValueError, match="distinct"):
        tables.save_text_table(spark.createDataFrame([(1, 2)], "`a b` int, `A_B` int"), "kept", folder)
    assert tables.save_text_table(spark.range(2), "kept", folder) == 2
    assert tables.save_text_table(spark.range(2).where("id > 5"), "kept", folder) == 0


def test_load_takes_effect_at_the_switch_only(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "switch")
    tables.save_text_table(spark.range(3), "switched", folder)

    def stop(*_):
        raise RuntimeError("before the switch")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "_point_at", stop)
        with pytest.raises(RuntimeError, match="before the switch"):
            tables.save_text_table(spark.range(9), "switched", folder)
    assert spark.table("switched").count() == 3
    assert tables.save_text_table(spark.range(9), "switched", folder) == 9
    assert spark.table("switched").count() == 9


def test_legacy_layout(spark):
    results = spark.createDataFrame([("S", "500m_Men", "Cup", "1")], "Stadium string, Event string, Race string, Rnk string")
    conditions = spark.createDataFrame([("500m_Men", "Cup", "NED", 15.0)], "Event string, MatchType string, EventCountry string, AirTemperature double")
    new_results, new_conditions = legacy.from_legacy_layout(results, conditions)
    assert new_results.columns == fixed.RESULT_COLUMNS and new_conditions.columns == fixed.CONDITION_COLUMNS
    r, c = new_results.first(), new_conditions.first()
    assert (r.Event, r.Race, r.Rank, r.Time) == ("Cup", "500m_Men", "1", None)
    assert (c.Event, c.Race, c.Country, c.TempIndoors, c.Latitude) == ("Cup", "500m_Men", "NED", 15.0, None)


def test_legacy_clock(column):
    assert column(legacy.legacy_stamp_time, ["2024-01-02", "2024-01-02T10:11:12Z", "02-01-2024", None]) == [
        "00:00:00", "10:11:12", None, None]


def condition(stamp, humidity=40.0):
    return {"timeStamp": stamp, "airTemperature": 15.0, "iceTemperature": 0.0, "humidity": humidity, "occasion": "start"}


def test_streamed_rows_equal_the_batch_rows(spark, tmp_path):
    """Races of four events land in steps, some results before their details, some documents twice."""
    event = lambda e: {"event_id": e, "name": f"Cup {e}", "track": {"name": "Rink A", "city": "C", "country": "NED"}}
    put(tmp_path / "event_details", [event(e) for e in "abcd"])
    put(tmp_path / "competitions", [{"event_id": e, "competitions": [{"scheduleNumber": n, "title": f"{n}00m"} for n in (5, 10)]} for e in "abcd"])
    result = {"rank": 1, "time": "36,1", "startNumber": 2, "competitor": {"skater": {"firstName": "A", "lastName": "B"}}}
    details = lambda e, n: {"event_id": e, "schedule_number": n, "distance": {"distance": n * 100}, "conditions": [condition("2024-01-02T10:00:00"), condition("", 1.0), condition("2024-01-02", None)]}
    results = lambda e, n: {"event_id": e, "schedule_number": n, "results": [result, result]}
    out, steps = tmp_path / "out", [
        [("details", details("a", 5)), ("results", results("a", 5)), ("results", results("b", 5))],
        [("details", details("b", 5)), ("details", details("a", 5)), ("details", details("c", 10))],
        [("results", results("c", 10)), ("results", results("a", 5)), ("details", details("d", 7)), ("results", results("d", 7))],
    ]
    for i, step in enumerate(steps):
        for j, (kind, document) in enumerate(step):
            put(tmp_path / f"competition_{kind}", [document], f"{i}{j}.json")
        races = landing.stream_races(spark, str(tmp_path), files_per_batch=2)
        landing.append_batches(races, str(out), str(tmp_path / "check")).awaitTermination(120)
    whole = enrichment.race_documents(
        landed_json.read_latest_events(spark, str(tmp_path / "event_details")),
        landed_json.read_listed_competitions(spark, str(tmp_path / "competitions")),
        landed_json.read_latest_details(spark, str(tmp_path / "competition_details")),
        landed_json.read_latest_results(spark, str(tmp_path / "competition_results")),
    )
    for name, rows, columns, n in (("results", enrichment.result_rows(whole), fixed.RESULT_COLUMNS, 6),
                                   ("conditions", enrichment.condition_rows(whole), fixed.CONDITION_COLUMNS, 3)):
        delimited.write_semicolon_csv(rows, str(tmp_path / name), columns)
        expected = delimited.read_semicolon_csv(spark, str(tmp_path / name), columns).collect()
        streamed = delimited.read_semicolon_csv(spark, str(out / name / "batch=*"), columns).collect()
        assert sorted(map(str, streamed)) == sorted(map(str, expected)) and len(streamed) == n
        assert all(r.Stadium == "Rink_A" and r.Event and r.Race for r in streamed)


def test_date_of_last_stamp_even_if_dropped(spark, tmp_path):
    path = put(tmp_path / "d", [
        {"event_id": "a", "schedule_number": 1, "conditions": [condition("2024-01-02T10:00:00"), condition("2024-01-03", None), condition("")]},
        {"event_id": "b", "schedule_number": 1, "conditions": [condition("2024-01-02"), condition("junk")]},
        {"event_id": "c", "schedule_number": 1, "conditions": [condition("")]}])
    details = landed_json.read_competition_details(spark, path)
    got = details.select("event_id", enrichment.last_stamp_date().cast("string").alias("d"))
    assert {r.event_id: r.d for r in got.collect()} == {"a": "2024-01-03", "b": None, "c": None}


def test_results_are_parsed_once(spark):
    """Not for the condition that there are rows, too."""
    documents = spark.range(3).selectExpr("'e' AS event_id", "id AS schedule_number", """'[{"rank":1},{"rank":2}]' || repeat(' ', int(id)) AS results""")
    exploded = landed_json.explode_results(documents)
    text = exploded._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in text.splitlines() if "Filter" in line and "from_json" in line]
    assert exploded.count() == 6


def test_landed_documents_are_compressed(spark, tmp_path):
    from rinkflow.plans.catalog import landing

    landing.landing_folder(spark, "/root/testdata/sf0.001", str(tmp_path / "all"))
    files = [p for p in (tmp_path / "all").rglob("part-*")]
    assert files and all(p.name.endswith(".snappy") for p in files)


def entries(spark, folder, n):
    """``n`` lineitem rows in one file, the last without keys."""
    spark.range(n, numPartitions=1).selectExpr(
        f"if(id < {n - 1}, id * 7919 % 1000003, NULL) AS l_orderkey", f"if(id < {n - 1}, id, NULL) AS l_partkey",
        "id * 31 % 977 AS l_suppkey", "int(id % 7 + 1) AS l_linenumber", "double(id * 17 % 50 + 1) AS l_quantity",
        "id * 13 % 11 / 100D AS l_discount", "id * 5 % 9 / 100D AS l_tax", "if(id % 3 = 0, 'A', 'N') AS l_returnflag",
        "'O' AS l_linestatus", "CAST(date_add(date'1995-01-01', int(id * 37 % 2500)) AS timestamp_ntz) AS l_shipdate",
    ).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def landed_small(spark, rows, documents):
    """Are the documents that ``rows`` are read from ``documents`` in all, few to a file and a fifth of their text or less?"""
    files = rows.inputFiles()
    sizes = [spark.read.text(f).selectExpr("count(*) AS n", "sum(octet_length(value) + 1) AS text").first() for f in files]
    disk = sum(os.path.getsize(f.removeprefix("file://")) for f in files)
    return sum(s.n for s in sizes) == documents and max(s.n for s in sizes) <= 1 << 14 and disk * 5 <= sum(s.text for s in sizes)


def test_conditions_land_on_little_disk(spark, tmp_path):
    from rinkflow.plans.catalog.sourced import s4_explode_conditions

    rows = s4_explode_conditions(spark, entries(spark, tmp_path, 20_000))
    assert landed_small(spark, rows, 20_000)
    assert rows.count() == 2 * 19_999
    out = {r.position: r.asDict() for r in rows.where("schedule_number = 10").collect()}
    both = {"event_id": "E79190", "schedule_number": 10, "Distance": 4, "IceTemperature": -0.05, "Humidity": 0.09}
    assert {k: str(v) for k, v in out[0].items()} == {k: str(v) for k, v in {
        **both, "position": 0, "Date": "1996-01-06", "Time": "10:11:12", "Occasion": "start", "TempIndoors": None}.items()}
    assert {k: str(v) for k, v in out[1].items()} == {k: str(v) for k, v in {
        **both, "position": 1, "Date": "1996-01-06", "Time": None, "Occasion": "end", "TempIndoors": 22.0}.items()}


def test_results_land_on_little_disk(spark, tmp_path):
    from rinkflow.plans.catalog.sourced import s5_explode_results

    rows = s5_explode_results(spark, entries(spark, tmp_path, 20_000))
    assert landed_small(spark, rows, 20_000)
    # Where the number of the race divides by three the document holds one result.
    assert rows.count() == 2 * 19_999 - 6_667
    out = [list(r.asDict().values()) for r in rows.where("schedule_number IN (10, 12)").orderBy("schedule_number", "Rank").collect()]
    assert out == [
        ["E79190", 10, 1, "310", "Ann Lee_van_Dam", "O", 4, "I", "21,5", None, "Men"],
        ["E79190", 10, 2, "310", "Jörg_van_Dam", "O", 4, "I", "21,5", None, "Men"],
        ["E95028", 12, 1, "372", "Ann Lee_van_Dam", "O", 6, "I", "5,5", None, "Women"],
    ]
