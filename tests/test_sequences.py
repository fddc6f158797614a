from datetime import date, timedelta

from lakeops.operators import sequences

#: Meter readings: days on which each meter reported.
READINGS = [
    ("north", "2031-05-27"),
    ("north", "2031-05-30"),
    ("north", "2031-05-31"),
    ("north", "2031-06-03"),
    ("south", "2031-02-27"),
    ("south", "2031-03-01"),
    ("south", "2031-03-01"),
    ("west", "2031-01-01"),
]


def test_gaps_are_given_as_first_and_last_missing_day(spark, rows):
    gaps = sequences.date_gaps(spark.createDataFrame(READINGS, "meter string, day string"), ["meter"], "day")
    assert rows(gaps, "meter", "missing_from", "missing_to") == [
        ("north", date(2031, 5, 28), date(2031, 5, 29)),
        ("north", date(2031, 6, 1), date(2031, 6, 2)),
        ("south", date(2031, 2, 28), date(2031, 2, 28)),
    ]


def test_missing_days_lie_between_first_and_last(spark, rows):
    missing = sequences.missing_dates(spark.createDataFrame(READINGS, "meter string, day string"), ["meter"], "day")
    assert rows(missing) == [
        ("north", date(2031, 5, 28)),
        ("north", date(2031, 5, 29)),
        ("north", date(2031, 6, 1)),
        ("north", date(2031, 6, 2)),
        ("south", date(2031, 2, 28)),
    ]


def test_missing_integers(spark, rows):
    numbers = spark.createDataFrame([(n,) for n in (-2, 0, 1, 5, 5, 7)], "num bigint")
    assert rows(sequences.missing_integers(numbers, "num", -3, 8)) == [(-1,), (-3,), (2,), (3,), (4,), (6,), (8,)]
    assert rows(sequences.missing_integers(numbers, "num")) == [(-1,), (2,), (3,), (4,), (6,)]
    assert rows(sequences.missing_integers(numbers.limit(0), "num")) == []


def test_streaks_reach_over_the_end_of_a_month(spark, rows):
    """Days from the 26th of April; every third day is missing for one, doubled for another."""
    start = date(2031, 4, 26)
    visits = [("ann", n) for n in range(0, 8)] + [("ann", n) for n in range(9, 12)]
    visits += [("ben", n) for n in range(30) if n % 3] + [("cat", n) for n in (4, 4, 5, 5, 6, 6, 7)]
    days = [(who, str(start + timedelta(days=n))) for who, n in visits]
    found = sequences.streaks(spark.createDataFrame(days, "who string, day string"), ["who"], "day", 4)
    assert rows(found, "who", "start_date", "end_date", "consecutive_days") == [
        ("ann", date(2031, 4, 26), date(2031, 5, 3), 8),
        ("cat", date(2031, 4, 30), date(2031, 5, 3), 4),
    ]


def test_days_are_made_from_gaps_without_a_join(spark):
    days = spark.createDataFrame(READINGS, "meter string, day string")
    plan = sequences.missing_dates(days, ["meter"], "day")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_integers_around_wide_gaps_and_many_ranges(spark, rows):
    stray = spark.createDataFrame([(n,) for n in (None, -40_000, 3, 4, 6, 6)], "num bigint")
    assert rows(sequences.missing_integers(stray, "num")) == sorted([(n,) for n in range(-39_999, 3)] + [(5,)], key=repr)
    every_third = spark.range(0, 3000, 3).toDF("num")
    assert rows(sequences.missing_integers(every_third, "num")) == sorted(((n,) for n in range(2998) if n % 3), key=repr)


def test_integers_of_a_given_range(spark, rows):
    numbers = spark.createDataFrame([(n,) for n in (1, 5, 9)], "num bigint")
    given = lambda a, b: [n for n, in rows(sequences.missing_integers(numbers, "num", a, b))]
    assert sorted(given(4, 7)) == [4, 6, 7] and sorted(given(10, 12)) == [10, 11, 12] and given(5, 5) == []
    assert given(7, 4) == [] and sorted(given(-1, None)) == [-1, 0, 2, 3, 4, 6, 7, 8] and sorted(given(None, 3)) == [2, 3]
    nothing = numbers.limit(0)
    assert sorted(rows(sequences.missing_integers(nothing, "num", 1, 3))) == [(1,), (2,), (3,)]
