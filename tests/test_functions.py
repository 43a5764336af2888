import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rinkflow.functions import model, numbers, similarity, text

GOLDEN = [
    (text.fix_encoding, ["JÃ¶rgen", "Ã(x", "JÃ¶rgen €", "Ã ", None, "plain"],
     ["Jörgen", "Ã(x", "JÃ¶rgen €", "Ã ", None, "plain"]),
    (text.underscore, ["a b  c", None], ["a_b__c", None]),
    (text.given_name, ["Ann_van_Dam", "Ann", ""], ["Ann", "Ann", ""]),
    (text.family_name, ["Ann_van_Dam", "Ann", "Ann_"], ["van_Dam", "", ""]),
    (text.normalize_name, ["José-Éric", "O'Brien"], ["josric", "obrien"]),
    (text.decode_gender, ["F", "M", "X", None], ["Women", "Men", "X", None]),
    (text.gender_num, ["Men", "Women", "X", None], [0, 1, None, None]),
    (text.sanitize_name, [" skater id ", "Time (s)", "é1"], ["SKATER_ID", "TIME_S", "1"]),
    (text.is_digits, ["12", "1a", "", None], [True, False, False, False]),
    (text.trim_or_empty, [" a ", None], ["a", ""]),
    (text.default_blank, ["a", None], ["a", ""]),
    (numbers.time_to_seconds,
     ["36,07", "1.11,55", "4:00.393", "71.5", " ", "", None, "1:11,55x", "1:02:03", "DNF", "1.0f", "2.675", "0.125", "inf"],
     [36.07, 71.55, 240.39, 71.5, None, None, None, None, None, None, None, 2.67, 0.12, None]),
    (numbers.distance_of, ["500m_Men", "Team", "10,000m"], ["500", None, "000"]),
    (numbers.first_integer, ["3000m_Women", "Cup_2024", "x", None], [3000, 2024, None, None]),
    (numbers.hour_of, ["09:30:00", "0930", "x:1", None], [9, None, None, None]),
    (numbers.to_int_via_float, ["3", "3.7", "-3.7", "", "nan", "x", "inf", "1e2", None],
     [3, 3, -3, None, None, None, None, 100, None]),
    (numbers.stamp_time,
     ["2024-01-02T10:11:12Z", "2024-01-02", "02-01-2024", "2024-01-02T10:11:12+02:00", "2024", "T10:11",
      "2024-01-02T10:11:12.500000", "junk", None],
     ["10:11:12", None, None, "10:11:12", None, None, "10:11:12.500000", None, None]),
    (numbers.format_2dp, [None], [None]),
    (numbers.year_of_text, ["2024-01-02"], ["2024"]),
    (numbers.date_text_is_valid, ["2024-02-29", "2023-02-29", "02-01-2024", "", None],
     [True, False, False, False, False]),
]


@pytest.mark.parametrize("function,values,expected", GOLDEN, ids=[g[0].__name__ for g in GOLDEN])
def test_golden(column, function, values, expected):
    assert column(function, values) == expected


def test_comma_rule_comes_before_colon(column):
    assert column(numbers.time_to_seconds, ["1:11,55"]) == [None]


def test_stamp_date(column):
    day = datetime.date(2024, 1, 2)
    stamps = ["2024-01-02T10:11:12Z", "2024-01-02", "02-01-2024", "2-1-2024", "31-02-2024", "2024", "T10:11", None]
    assert column(numbers.stamp_date, stamps) == [day, day, day, day, None, None, None, None]


def test_full_name(spark):
    df = spark.createDataFrame([("Ann Lee", "van Dam"), (None, "B"), ("A", None)], "f string, l string")
    assert [r[0] for r in df.select(text.full_name("f", "l")).collect()] == ["Ann Lee_van_Dam", "_B", "A_"]


def test_fix_ice_sign_keeps_plain_zero(column):
    out = column(model.fix_ice_sign, [2.5, -3.0, 0.0, None], "double")
    assert out == [-2.5, -3.0, 0.0, None]
    assert math.copysign(1, out[2]) == 1


def test_standard_tfm(spark):
    df = spark.createDataFrame([(3, 1500), (3, 800), (1, 500), (None, 500)], "p int, d int")
    tfm = model.standard_tfm("p", "d")
    assert [tuple(r) for r in df.select(tfm, model.tfm_buffer(tfm)).collect()] == [
        (400, 460), (None, None), (0, 60), (None, None)]


def test_similarity_golden(spark):
    df = spark.createDataFrame([("jorgen", "jorgenn"), ("ab", "abcd"), ("", "a"), (None, "a")], "a string, b string")
    got = [r[0] for r in df.select(similarity.similarity("a", "b")).collect()]
    assert got[0] == pytest.approx(12 / 13)
    assert got[1:] == [0.0, 0.0, 0.0]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("abcd", max_size=9), st.text("abcd", max_size=9)), min_size=20, max_size=60))
def test_similarity_properties(spark, pairs):
    """Between 0 and 1; 1 for equal texts, 0 without a shared letter or with a length off by a fifth."""
    pairs = [*pairs, *((a, a) for a, _ in pairs), *((a, "zz") for a, _ in pairs), *((a, a + "bbbb") for a, _ in pairs)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(similarity.similarity("a", "b")).collect()]
    n = len(pairs) // 4
    assert all(0 <= x <= 1 for x in got)
    assert got[n : 2 * n] == [float(bool(a)) for a, _ in pairs[:n]]
    assert got[2 * n :] == [0.0] * (2 * n)
    for (a, b), x in zip(pairs[:n], got[:n]):
        assert (x == 1) == (a == b != "") and (x == 0 or 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(
    st.integers(-200000, 200000).map(lambda k: k / 1000),
    st.integers(-2000, 2000).map(lambda k: k / 8),
    st.floats(-1e5, 1e5),
), min_size=50, max_size=200))
def test_rounding_is_that_of_python(column, values):
    got = column(numbers.round_half_even, values, "double")
    assert got == [round(v, 2) for v in values]


def test_large_numbers_do_not_abort(column):
    texts = ["1e17", "99999999999999999999", "1e99", "-1e17", "3" * 250, "2.675", "70368744177664.5"]
    got = column(numbers.time_to_seconds, texts)
    assert got == [1e17, 1e20, 1e99, -1e17, float("3" * 250), 2.67, 70368744177664.5]


def test_whole_numbers_beyond_32_bits(column):
    assert column(numbers.to_int_via_float, ["3000000000", "1e400", "-5e9"]) == [3000000000, None, -5000000000]
    assert column(numbers.first_integer, ["race 3000000000 m"]) == [3000000000]
