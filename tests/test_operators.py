import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rinkflow.operators import clean, identity, joins, quantiles, requests, selection, sequence, stats


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- start order and break ---------------------------------------------------

RACE = "Stadium string, Date string, Event string, Race string, Pair string"


def tfm(spark, pairs, race="10000m_Men"):
    df = spark.createDataFrame([("S", "D", "E", race, p) for p in pairs], RACE)
    out = sequence.estimate_tfm(df)
    return {r.Pair: (r.EstimatedTFM, r.EstimatedTFMBuffer) for r in out.collect()}


@pytest.mark.parametrize("pairs,expected", [
    ([1, 2, 3, 4, 5], [0, 900, 1800, 0, 900]),
    ([1, 2, 3, 4], [0, 900, 1800, 2700]),
    ([1, 2, 3, 4, 5, 6], [0, 900, 1800, 2700, 3600, 4500]),
    ([1, 3, 7], [0, 1800, 0]),
    ([1, 2], [0, 0]),
    ([5], [3600]),
    ([1, 70000, 200000], [0, 69999 * 900, 0]),
])
def test_break(spark, pairs, expected):
    got = tfm(spark, [str(p) for p in pairs])
    assert [got[str(p)] for p in pairs] == [(e, e + 60) for e in expected]


def test_unreadable_pair_takes_no_place(spark):
    got = tfm(spark, ["1", "2.0", "x", None, "3"])
    assert got["x"] == got[None] == (None, None)
    assert [got[p][0] for p in ("1", "2.0", "3")] == [0, 900, 0]


def test_other_distances_have_no_break(spark):
    got = tfm(spark, ["1", "2", "3"], "5000m_Men")
    assert [got[p][0] for p in ("1", "2", "3")] == [0, 480, 960]


def test_break_against_plain_loop(spark):
    rng = random.Random(3)
    data = [(rng.choice("AB"), rng.choice(["d1", None]), "E", rng.choice(["10000m", "500m"]),
             str(rng.randint(1, rng.choice([2, 4, 5, 9]))), i) for i in range(400)]
    df = spark.createDataFrame(data, RACE + ", i int")
    got = {r.i: r.EstimatedTFM for r in sequence.estimate_tfm(df).collect()}
    races = defaultdict(set)
    for s, d, e, race, pair, _ in data:
        races[s, d, e, race].add(int(pair))
    for s, d, e, race, pair, i in data:
        pair, pairs = int(pair), sorted(races[s, d, e, race])
        expected = (pair - 1) * (900 if race == "10000m" else 135)
        half = (len(pairs) + 1) // 2
        if race == "10000m" and len(pairs) not in (4, 6) and pairs.index(pair) >= half:
            expected = (pairs.index(pair) - half) * 900
        assert got[i] == expected


# --- quantiles ---------------------------------------------------------------


def test_quartiles_golden(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (None,), (float("nan"),)], "v double")
    assert rows(quantiles.quartiles(df, "v")) == [(1.75, 5.25, 3.5)]
    assert quantiles.outliers(df, "v").count() == 0


@pytest.mark.parametrize("accuracy", [50, 1000, 100_000])
def test_exact_quantiles_against_numpy(spark, accuracy):
    """Also with brackets far narrower than the data: most values are lumped."""
    rng = np.random.default_rng(5)
    groups = {"hot": np.round(rng.normal(50, 9, 6000), 3), "flat": np.full(40, 3.5),
              "one": np.array([7.0]), "few": np.array([1.0, 5.0, 6.0]), None: rng.exponential(4, 700)}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    probabilities = [0.05, 0.25, 0.5, 0.75, 0.99]
    out = quantiles.exact_quantiles(df, "v", probabilities, ["g"], accuracy).collect()
    assert len(out) == len(groups)
    for r in out:
        values = groups[r.g]
        assert (r.n, r.min, r.max) == (len(values), values.min(), values.max())
        assert [r[f"q{i}"] for i in range(5)] == pytest.approx(list(np.quantile(values, probabilities)))


@pytest.mark.parametrize("bins", [3, 64, 1 << 13])
def test_exact_quantiles_of_awkward_values(spark, bins):
    """Ties, one far value, sorted input, both signs, near-equal doubles, denormals and infinities."""
    rng = np.random.default_rng(2)
    groups = {
        "ties": np.repeat([1.0, 2.0, 2.0, 3.0], 50),
        "far": np.append(rng.uniform(0, 1e-9, 99), 1e300),
        "sorted": np.arange(-500, 500) / 3,
        "near": 1 + np.arange(300) * 2.0**-52,
        "geometric": np.append(2.0 ** np.arange(-1074, 1000, 9), -(2.0 ** np.arange(-1074, 1000, 11))),
        "cluster": 1 + 2.0 ** -np.arange(1, 53),
        "infinite": np.array([-np.inf, -1.0, 0.0, -0.0, 5e-324, np.inf, np.inf]),
        "zero": np.zeros(9),
    }
    data = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(data, "g string, v double").repartition(3)
    for r in quantiles.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 1.0], ["g"], bins).collect():
        values = np.sort(groups[r.g])
        for p, got in zip([0.0, 0.25, 0.5, 1.0], (r.q0, r.q1, r.q2, r.q3)):
            at = p * (len(values) - 1)
            low, high = values[int(np.floor(at))], values[int(np.ceil(at))]
            with np.errstate(invalid="ignore"):
                expected = low + (high - low) * (at - np.floor(at))
            assert got == expected or np.isnan(got) and np.isnan(expected)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert rows(quantiles.exact_quantiles(df, "v", [0.5])) == []
    assert quantiles.outliers(df, "v").count() == 0


def test_box_and_outliers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]], "g string, v double")
    assert rows(quantiles.outliers(df, "v").select("v")) == [(100.0,)]
    assert rows(quantiles.box_by(df, "g", "v")) == [("a", 5, 1.0, 2.0, 3.0, 4.0, 100.0, -1.0, 7.0)]


def test_approximate_quartiles(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    q1, q3, _ = rows(quantiles.quartiles(df, "v", approximate=True))[0]
    assert abs(q1 - 250) < 3 and abs(q3 - 750) < 3


# --- statistics --------------------------------------------------------------


def test_corrected_difference(spark):
    df = spark.createDataFrame([(36.0, 38.0), (37.0, 36.0)], "SeasonalBest double, RaceTime double")
    assert rows(stats.add_corrected_difference(df).select("Difference", "CorrectedDifference"), "Difference") == [
        (-2.0, 8.0), (1.0, 11.0)]


def test_histogram_counts_everything(spark):
    values = [float(v) for v in range(101)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = rows(stats.histogram(df, "v"), "bin")
    assert sum(r[3] for r in out) == 101 and len(out) == 20 and out[-1][3] == 6
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert rows(stats.histogram(flat, "v")) == [(1, 2.0, 2.0, 2)]


def test_single_row_has_no_spread(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "RaceTime double, TempIce double")
    assert rows(stats.summary_stats(df)) == [(1, 1.0, None, 2.0, None)]


def test_orders(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 5.0), ("c", 2.0), ("c", 2.0)], "g string, v double")
    assert [r[0] for r in stats.avg_by(df, "g", "v").collect()] == ["b", "c", "a"]
    assert [r[0] for r in stats.category_order(df, "g", "v").collect()] == ["b", "c", "a"]


def test_batch_totals(spark):
    r = spark.createDataFrame([(1,), (1,), (2,)], "batch int")
    c = spark.createDataFrame([(2,), (3,)], "batch int")
    got = {x[0]: x[1:] for x in rows(stats.batch_totals(r, c))}
    assert got == {1: (2, 0), 2: (1, 1), 3: (0, 1), None: (3, 2)}


# --- selection ---------------------------------------------------------------

VIEW = "Gender string, Distance int, Year int, RinkCountry string, Stadium string, Name string"


@pytest.fixture(scope="module")
def view(spark):
    return spark.createDataFrame([
        ("Men", 500, 2000, "NL", "H", "a"), ("Women", 500, 2001, "NL", "G", "b"),
        ("Men", 500, 2002, "NO", "O", "c"), ("X", 500, 2000, "NL", "H", "d"),
        ("Men", 1000, 2000, "NL", "H", "e")], VIEW)


def names(df):
    return sorted(r.Name for r in df.collect())


def test_select_rows(view):
    assert names(selection.select_rows(view)) == ["a", "b", "c"]
    assert names(selection.select_rows(view, gender=[])) == []
    assert names(selection.select_rows(view, years=(2001, 2002))) == ["b", "c"]
    assert names(selection.select_rows(view, countries=["NL"], stadiums=[])) == ["a", "b"]
    assert names(selection.select_rows(view, athletes=["c", "zz"])) == ["c"]
    assert names(selection.select_prediction_rows(view, 500)) == ["a", "b", "c", "d"]
    assert names(selection.select_prediction_rows(view, 500, "H", ["NL"])) == ["a", "d"]


def test_retained_choices(spark, view):
    wanted = lambda *v: spark.createDataFrame([(x,) for x in v], "Stadium string")
    keep = lambda w, fallback=None: sorted(
        r[0] or "" for r in selection.retain_selection(w, view, "Stadium", fallback).collect())
    assert keep(wanted("H", "gone")) == ["H"]
    assert keep(wanted("gone")) == [""]
    assert keep(wanted("gone"), "All") == ["All"]
    assert [r[0] for r in selection.stadium_options(view, ["NL"]).collect()] == ["G", "H"]
    assert [r[0] for r in selection.athlete_options(view, stadiums=["H"]).collect()] == ["a"]


# --- cleaning and joins ------------------------------------------------------


def test_first_per_key_and_row_order(spark):
    data = [("S", "D", "E", "R", "10:00", i) for i in (3, 1, 2)] + [(None, "D", "E", "R", "09:00", 9)]
    for shuffled in (data, data[::-1]):
        df = spark.createDataFrame(shuffled, "Stadium string, Date string, Event string, Race string, CondTime string, n int")
        assert sorted(r.n for r in clean.first_per_key(df).collect()) == [1, 9]


def test_require_columns_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "x double, y string")
    assert rows(clean.require_columns(df, ["x", "y"])) == [(1.0, "a")]


def test_last_condition_date_may_be_null(spark):
    df = spark.createDataFrame([(1, 1, "x", "d1", 0), (1, 1, "bad", None, 1), (1, 1, "", "d9", 2), (2, 1, None, "d", 0)],
                               "event_id int, schedule_number int, time_stamp string, Date string, position int")
    assert rows(clean.last_condition_date(df)) == [(1, 1, None)]


def test_join_weather_keeps_or_replaces(spark):
    conditions = spark.createDataFrame([
        ("52.0", "5.10", "2024-01-05", "10:30:00", 7.0), ("52.0", "5.10", "2024-01-05", "11:30:00", 7.0),
        ("1.0", "5.10", "2024-01-05", "10:30:00", 7.0), (None, "5.10", "2024-01-05", "x", 7.0)],
        "Latitude string, Longitude string, Date string, Time string, AirpressureSurface double")
    hourly = spark.createDataFrame([
        (52.0, 5.1, "2024-01-05T10:00", 0, 1.0, 1000.0, 1010.0), (52.0, 5.1, "2024-01-05T10:00", 1, 2.0, None, 1011.0)],
        "Latitude double, Longitude double, HourKey string, position int, TempOutdoors double, AirpressureSurface double, AirpressureSealevel double")
    out = joins.join_weather(conditions, hourly)
    got = rows(out.select("Latitude", "Time", "TempOutdoors", "AirpressureSurface", "AirpressureSealevel", "WeatherMatched"), "Time", "Latitude")
    assert got == [("1.0", "10:30:00", None, 7.0, None, False), ("52.0", "10:30:00", 2.0, None, 1011.0, True),
                   ("52.0", "11:30:00", None, 7.0, None, False), (None, "x", None, 7.0, None, False)]
    assert rows(stats.enrichment_coverage(out)) == [(1, 4)]


def test_season_bests(spark):
    records = spark.createDataFrame([
        ("7", 2020, 0, 0, 500, "36,50"), ("7", 2020, 0, 1, 500, "36,10"), ("7", 2020, 0, 2, 500, "DNF"),
        ("7", 2020, 1, 0, 1000, "70,00"), ("8", 2020, 0, None, None, None), ("8", 2020, 1, 0, 500, "40,00")],
        "skater_id string, start int, season_pos int, rec_pos int, distance int, time_text string")
    bests = requests.season_best_table(records)
    assert rows(bests.select("skater_id", "start", "distance", "seconds")) == [("7", 2020, 500, 36.1)]
    results = spark.createDataFrame([("7", "2021-03-01", "500m_Men"), ("7", "2020-03-01", "500m_Men"), ("x7", "2021-03-01", "500m"),
                                     ("7", "2021-03-01", "Cup"), (None, "2021-01-01", "500m")],
                                    "SkaterID string, Date string, Race string").withColumn("Date", F.to_date("Date"))
    joined = joins.join_previous_season_best(results, bests)
    assert sorted(r.SeasonalBest or 0 for r in joined.collect()) == [0, 0, 0, 0, 36.1]


def test_prediction_edge_rows(spark):
    from rinkflow.plans.curated import add_prediction

    base = (500, "Men", 36.0, "1", 0, 15.0, -7.0, 40.0, 1000.0)
    data = [base, (800,) + base[1:], base[:3] + ("outer",) + base[4:], base[:8] + (-1e9,), base[:4] + (None,) + base[5:]]
    df = spark.createDataFrame(data, "Distance int, Gender string, SeasonalBest double, Lane string, EstimatedTFM int,"
                               " TempIndoors double, TempIce double, Humidity double, AirpressureSurface double")
    got = [r.Prediction for r in add_prediction(df).collect()]
    assert [x for x in got if x is not None] == pytest.approx([36.73])


# --- identities --------------------------------------------------------------


REGISTRY = [
    ("1", "Johannes", "van der Berg", "NED", 0),
    ("2", "Kim", "Bergsma", "NED", 1),
    ("3", "Anna-Maria", "O'Brien", "nor", 2),
    ("4", "Kimm", "Bergsma", "NED", 3),
    ("5", "Kim", "Bergsma", "NOR", 4),
]

# Derived by hand from the rules of both passes.
RESOLVED = {
    ("Johannes_van_der_Berg", "NED"): "1",
    ("Johanness_van_der_Berg", "ned"): "1",  # 16 / 17 of the given name
    ("Kim_Bergsma", "NED"): "2",  # the first of two
    ("Kim_Bergsma", "NOR"): "5",
    ("Kim_Berg", "NED"): "2",  # the registry's family starts with it
    ("Kim_Bergsmaa", "NED"): "2",  # by the first four letters only
    ("Kim_Bergstra", "NED"): "2",
    ("Annamaria_OBrien", "NOR"): "3",
    ("Kim", "NED"): "2",  # no family: every family starts with nothing
    ("Kimmy_Bergsma", "NED"): None,  # 8 / 9 of the given name
    ("Kim_Xergsma", "NED"): None,
    ("Kim_Bergsma", "BEL"): None,
    ("Kim_Bergsma", ""): None,
}


def test_resolution_golden(spark):
    got = identity.resolve_entities(
        spark.createDataFrame([(f" {n}", f"{c} ") for n, c in [*RESOLVED, *RESOLVED]], "Name string, Country string"),
        spark.createDataFrame(REGISTRY, "id string, givenname string, familyname string, country string, pos int"))
    found = got.collect()
    assert len(found) == len(RESOLVED) and {(r.Name, r.Country): r.id for r in found} == RESOLVED


def plain_resolution(names, registry, limit=None):
    """The rules, one registry row after the other."""
    from difflib import SequenceMatcher

    letters = lambda v: re.sub("[^a-z]", "", (v or "").lower())

    def alike(a, b):
        if not a or not b or abs(len(a) - len(b)) > 0.2 * max(len(a), len(b)):
            return False
        return SequenceMatcher(None, a, b).ratio() > 0.9

    out = {}
    for name, country in names:
        given, _, family = name.partition("_")
        found = None
        lookups = [(letters(family), letters(family))]
        if len(family) >= 4:
            lookups.append((letters(family[:4]), letters(family)[:4]))
        for block, start in lookups:
            rows = [r for r in registry if (r[3] or "").upper() == country.upper() and letters(r[2]).startswith(block)]
            rows.sort(key=lambda r: (r[4], r[0]))
            rows = [r for r in rows[:limit] if letters(r[2]).startswith(start) and alike(letters(r[1]), letters(given))]
            if rows and found is None:
                found = rows[0][0]
        out[name, country] = found
    return out


@pytest.mark.parametrize("limit", [None, 10, 3])
def test_resolution_against_the_rules(spark, limit):
    """Names of 1 to 30 letters, edited at random, in crowded families."""
    rng = random.Random(limit or 0)
    word = lambda n: "".join(rng.choice("abcde") for _ in range(n))
    givens = [word(rng.choice([1, 3, 5, 6, 8, 11, 12, 16, 21, 30])) for _ in range(60)]
    families = ["Berg", "Bergsma", "Bergstra", "Ber", "O'Br", "de Vries", ""]
    registry = [(str(i), rng.choice(givens), rng.choice(families), rng.choice(["n", "N", "B"]), i // 2) for i in range(300)]

    def edited(v):
        v = list(v)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
            at = rng.randrange(len(v) + 1)
            v[at : at + rng.choice([0, 1])] = rng.choice(["", "a", "z", "É"])
        return "".join(v)

    names = {(f"{edited(rng.choice(givens))}_{rng.choice([*families, 'Bergx', 'Bergsmaa', 'Xx'])}", rng.choice("Nn")) for _ in range(300)}
    expected = plain_resolution(names, registry, limit)
    got = identity.resolve_entities(
        spark.createDataFrame(sorted(names), "Name string, Country string"),
        spark.createDataFrame(registry, "id string, givenname string, familyname string, country string, pos int"),
        candidates=limit,
    )
    assert {(r.Name, r.Country): r.id for r in got.collect()} == expected
    assert len({v for v in expected.values() if v}) >= 4


def test_first_match_looks_at_ten(spark):
    df = spark.createDataFrame([("b", i, str(i), i in (11, 12)) for i in range(20)], "block string, pos int, id string, yes boolean")
    assert identity.first_match(df, ["block"], ["pos"], F.col("yes")).count() == 0
    assert rows(identity.first_match(df, ["block"], ["pos"], F.col("yes"), limit=13)) == [("b", "11")]


def test_ids_map_back_to_every_row(spark):
    found = spark.createDataFrame([("a", "N", "1"), ("b", "N", None)], "Name string, Country string, id string")
    df = spark.createDataFrame([(" a", "N "), ("a", "N"), ("b", "N"), (None, "N")], "Name string, Country string")
    assert sorted(r.SkaterID or "" for r in joins.map_ids_back(df, found).collect()) == ["", "", "1", "1"]


def test_crowded_names_meet_by_merge(spark, monkeypatch):
    """Codes of 15 letters in one family, each found; the stored index is small as a file only, and not broadcast."""
    stored, store = [], identity.materialize
    monkeypatch.setattr(identity, "materialize", lambda df: stored.append(df) or store(df))
    code = "regexp_replace(translate(lpad(string(id), 5, '0'), '0123456789', 'abcdefghij'), '(.)', '$1$1$1')"
    registry = spark.range(1000).selectExpr("string(id) AS id", f"{code} AS givenname", "'Berg' AS familyname", "'N' AS country", "id AS pos")
    names = registry.selectExpr("givenname || 'x_Berg' AS Name", "country AS Country", "id AS wanted")
    found = names.join(identity.resolve_entities(names, registry), ["Name", "Country"])
    assert found.where("id = wanted").count() == 1000
    for pairs in stored[1:]:
        assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()
    # Pieces of such names are in most others; what two codes share is in no third.
    keys = identity._with_keys(registry, "givenname", {15: [(15, 14)]}, identity._NO_KEYS)
    assert keys.groupBy("piece").count().where("count > 1").count() == 0
