from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from matchstrata import functions as fn


def column(spark, dtype, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_finished_ignores_case_and_any_blank(spark):
    statuses = ["FT", " ft ", "\tMatch Finished\n", " PEN ", "\x1cAET", "NS", "", None,
                "F T", "finished"]
    got = column(spark, "string", statuses, fn.finished("c"))
    assert got == [True, True, True, True, True, False, False, False, False, True]


def test_first_filled_skips_null_and_empty(spark):
    df = spark.createDataFrame(
        [("a", "b"), ("", "b"), (None, "b"), ("", ""), (None, None)], "x string, y string"
    )
    assert [r[0] for r in df.select(fn.first_filled("x", "y")).collect()] == [
        "a", "b", "b", "", None,
    ]


NUMBERS = {
    "2": (2, False), "2.0": (2, False), " 3 ": (3, False), "1e2": (100, False), "+5": (5, False),
    "-4": (-4, False), "": (None, False), "abc": (None, False), "2d": (None, False),
    "NaN": (None, False), "Infinity": (None, False), "0x10": (None, False),
    "2.5": (None, True), ".5": (None, True), "7.000": (7, False), "5.": (5, False), "1e400": (None, True),
    "9007199254740993": (9007199254740993, False),
}


def test_to_long_and_not_integral(spark):
    texts = list(NUMBERS) + [None]
    numbers = column(spark, "string", texts, fn.to_long("c"))
    fractions = column(spark, "string", texts, fn.not_integral("c"))
    assert dict(zip(texts, zip(numbers, fractions))) == {**NUMBERS, None: (None, False)}


def test_parse_date_is_strict(spark):
    texts = ["2022-05-15", "15/05/2022", "2022-05-15 20:00:00", "2022-02-30", "soon", "", None]
    got = column(spark, "string", texts, fn.parse_date("c"))
    assert got == [datetime(2022, 5, 15)] + [None] * 6


def test_date_parts(spark):
    df = spark.sql("SELECT timestamp_ntz'2022-05-15 00:00:00' AS d UNION ALL SELECT NULL")
    got = df.select(fn.year_number("d"), fn.month_number("d"), fn.day_name("d")).collect()
    assert [tuple(r) for r in got] == [(2022, 5, "Sunday"), (None, None, None)]


def test_dates_do_not_depend_on_the_session_zone(spark):
    """At this midnight the clocks of that zone went forward."""
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame([("1996-10-06",)], "t string").select(fn.parse_date("t").alias("d"))
        got = df.select(F.col("d").cast("string"), fn.day_name("d"), fn.year_number("d")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == ("1996-10-06 00:00:00", "Sunday", 1996)


def test_labels(spark):
    assert column(spark, "bigint", [1, 2, 3, 4, 12], fn.podium("c")) == ["🥇", "🥈", "🥉", "4", "12"]
    assert column(spark, "bigint", [3, -1, 0, None], fn.signed("c")) == ["+3", "-1", "+0", None]
    assert column(spark, "bigint", [1234567, 12], fn.thousands("c")) == ["1,234,567", "12"]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(3, 2), (3, 0), (None, None)], "a bigint, b bigint")
    assert [r[0] for r in df.select(fn.guarded_ratio("a", "b")).collect()] == [1.5, 0.0, 0.0]


def test_load_stamp_is_utc():
    east = timezone(timedelta(hours=5))
    assert fn.load_stamp(datetime(2024, 5, 2, 3, 0, tzinfo=east)) == (
        "2024-05-01T22:00:00+00:00", "2024-05-01",
    )


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(
            st.integers(-400, 400).map(lambda k: k / 20),
            st.tuples(st.integers(0, 5000), st.integers(1, 400)).map(lambda p: p[0] / p[1]),
            st.floats(-1e6, 1e6, allow_subnormal=False),
        ),
        min_size=200, max_size=400,
    )
)
def test_one_decimal_rounds_like_the_exact_value(spark, values):
    values = [v + 0.0 for v in values if v != 0]
    assert column(spark, "double", values, fn.one_decimal("c")) == [f"{v:.1f}" for v in values]


def test_a_column_of_dates_is_read_in_the_form_of_its_first_filled_value(spark):
    rows = [
        (1, None, "soon", "01/02/2024", "no date", "2024-01-01T10:00:00"),
        (2, "2024-01-05 07:30:00", "25/12/2023", "25/12/2023", "none", "2024-01-01"),
        (3, "2024-01-05", "03/04/2024", "12/31/2023", "", "2024-13-01T10:00:00"),
        (4, "2024-02-30 07:30:00", "2024-01-01", None, None, "x2024-01-01T10:00:00"),
    ]
    df = spark.createDataFrame(rows, "i int, a string, b string, c string, d string, e string").repartition(3)
    got = fn.parse_dates_alike(df, ["a", "b", "c", "d", "e"], ["i"]).orderBy("i").collect()
    assert [r["a"] for r in got] == [None, datetime(2024, 1, 5, 7, 30), None, None]
    assert [r["b"] for r in got] == [None, datetime(2023, 12, 25), datetime(2024, 4, 3), None]
    assert [r["c"] for r in got] == [datetime(2024, 1, 2), None, datetime(2023, 12, 31), None]
    assert [r["d"] for r in got] == [None] * 4
    assert [r["e"] for r in got] == [datetime(2024, 1, 1, 10), None, None, None]
    assert fn.parse_dates_alike(df.limit(0), ["a"], ["i"]).count() == 0
