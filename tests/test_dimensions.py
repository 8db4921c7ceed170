import datetime as dt

import pytest

from millrace.operators import dimensions
from millrace.operators.facts import Lookup, matched, point_in_time, replace_keys
from millrace.operators.quality import QualityError

D = dt.date


def _bounds(spark, first, last):
    return spark.createDataFrame([(first, last)], "first_day date, last_day date")


def test_five_years_of_days(spark):
    days = dimensions.date_dimension(_bounds(spark, D(2019, 1, 1), D(2023, 12, 31)))
    assert days.count() == 1826
    row = days.where("DateKey = 20200229").first().asDict()
    assert row == {
        "DateKey": 20200229, "DateAltKey": D(2020, 2, 29), "DayOfMonth": 29, "DayOfWeek": 7, "DayName": "Saturday",
        "MonthOfYear": 2, "MonthName": "February", "CalendarQuarter": 1, "CalendarYear": 2020,
        "FiscalQuarter": 3, "FiscalYear": 2020,
    }


@pytest.mark.parametrize(
    "start, day, quarter, year",
    [(1, D(2020, 12, 31), 4, 2020), (7, D(2020, 7, 1), 1, 2021), (7, D(2020, 6, 30), 4, 2020), (10, D(2020, 10, 1), 1, 2021)],
)
def test_fiscal_calendar(spark, start, day, quarter, year):
    row = dimensions.date_dimension(_bounds(spark, day, day), start).first()
    assert (row.FiscalQuarter, row.FiscalYear) == (quarter, year)


def test_extending_is_repeatable(spark):
    known = dimensions.date_dimension(_bounds(spark, D(2020, 1, 1), D(2020, 1, 3)))
    facts = spark.createDataFrame([(D(2020, 1, 5),), (D(2019, 12, 1),)], "day date")
    extended = dimensions.extend_date_dimension(known, facts, "day")
    assert [r.DateKey for r in extended.orderBy("DateKey").collect()] == [20200101, 20200102, 20200103, 20200104, 20200105]
    assert dimensions.extend_date_dimension(extended, facts, "day").count() == 5


def test_time_dimension_grains(spark):
    first, last = dt.datetime(2024, 1, 1, 23, 59, 58), dt.datetime(2024, 1, 2, 0, 0, 1)
    seconds = dimensions.time_dimension(spark, first, last, 1).orderBy("TimeKey", "MinuteOfHour", "SecondOfMinute").collect()
    assert [(r.TimeKey, r.MinuteOfHour, r.SecondOfMinute) for r in seconds] == [
        (20240101235958, 59, 58), (20240101235959, 59, 59), (20240102000000, 0, 0), (20240102000001, 0, 1),
    ]
    assert dimensions.time_dimension(spark, first, last).count() == 2


CUSTOMERS = [("I-543", "Navin Jones", "Seattle"), ("R-589", "Mary Smith", "Buffalo"), ("I-321", "Antoine Dubois", "Paris")]


def _loaded(spark):
    first = spark.createDataFrame(CUSTOMERS, "AltKey string, Name string, City string")
    return dimensions.start_history(first, "AltKey", "CustomerKey", D(2000, 1, 1))


def test_a_move_adds_a_row_with_a_new_key(spark, rows):
    change = [("I-543", "Navin Jones", "New York"), ("R-589", "Mary Smith", "Buffalo"), ("X-1", "New One", None)]
    staged = spark.createDataFrame(change, "AltKey string, Name string, City string")
    history = dimensions.keep_history(_loaded(spark), staged, "AltKey", "CustomerKey", D(2020, 6, 1))
    end = dimensions.OPEN_END
    assert rows(history.select("CustomerKey", "AltKey", "City", "ValidFrom", "ValidTo", "IsCurrent")) == [
        (1, "I-321", "Paris", D(2000, 1, 1), end, True),
        (2, "I-543", "Seattle", D(2000, 1, 1), D(2020, 6, 1), False),
        (3, "R-589", "Buffalo", D(2000, 1, 1), end, True),
        (4, "I-543", "New York", D(2020, 6, 1), end, True),
        (5, "X-1", None, D(2020, 6, 1), end, True),
    ]
    again = dimensions.keep_history(history, staged, "AltKey", "CustomerKey", D(2021, 1, 1))
    assert rows(again) == rows(history)

    sales = spark.createDataFrame(
        [(1, "I-543", D(2020, 5, 31)), (2, "I-543", D(2020, 6, 1)), (3, "R-589", D(2022, 1, 1)), (4, "X-1", D(2019, 1, 1))],
        "sale int, customer string, day date",
    )
    keyed = point_in_time(sales, sales.day, Lookup("customer", history, "AltKey", "CustomerKey"))
    assert rows(keyed.select("sale", "CustomerKey")) == [(1, 2), (2, 4), (3, 3), (4, None)]


def test_a_cleared_attribute_is_a_change(spark):
    staged = spark.createDataFrame([("I-321", "Antoine Dubois", None)], "AltKey string, Name string, City string")
    history = dimensions.keep_history(_loaded(spark), staged, "AltKey", "CustomerKey", D(2020, 6, 1))
    assert history.where("AltKey = 'I-321' AND IsCurrent").first().City is None
    assert history.count() == 4


@pytest.mark.parametrize("bad", [[("a", 1), ("a", 2)], [(None, 1)]])
def test_upsert_refuses_repeated_or_missing_business_keys(spark, bad):
    dimension = spark.createDataFrame([(1, "a", 0)], "key bigint, name string, v int")
    with pytest.raises(QualityError):
        dimensions.upsert(dimension, spark.createDataFrame(bad, "name string, v int"), "name", "key")


def test_upsert_keeps_known_keys(spark, rows):
    dimension = spark.createDataFrame([(5, "a", 1), (9, "b", 1)], "key bigint, name string, v int")
    staged = spark.createDataFrame([("b", None), ("c", 3)], "name string, v int")
    assert rows(dimensions.upsert(dimension, staged, "name", "key")) == [(10, "c", 3), (5, "a", 1), (9, "b", None)]


def test_parent_split_matches_nulls(spark, rows):
    child = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, None, "y")], "id int, a string, b string")
    parent, slim = dimensions.split_parent(child, ["a", "b"], "ParentKey")
    assert rows(parent) == [(1, None, "y"), (2, "x", None)]
    assert rows(slim) == [(1, 3), (2, 1), (2, 2)]


def test_unmatched_keys_stay_visible(spark, rows):
    facts = spark.createDataFrame([("a", 1), ("z", 2)], "name string, amount int")
    dimension = spark.createDataFrame([(7, "a")], "key bigint, name string")
    keyed = replace_keys(facts, [Lookup("name", dimension, "name", "key")])
    assert rows(keyed) == [(1, 7), (2, None)]
    assert rows(matched(keyed, ["key"])) == [(1, 7)]


def test_a_change_before_the_current_row_is_refused(spark):
    moved = spark.createDataFrame([(CUSTOMERS[0][0], CUSTOMERS[0][1], "Elsewhere")], "AltKey string, Name string, City string")
    with pytest.raises(Exception, match="change not after the current row"):
        dimensions.keep_history(_loaded(spark), moved, "AltKey", "CustomerKey", D(1999, 1, 1)).collect()


def test_aware_moments_count_in_utc(spark):
    zone = dt.timezone(dt.timedelta(hours=2))
    row = dimensions.time_dimension(spark, dt.datetime(2024, 1, 1, 1, 30, tzinfo=zone), dt.datetime(2024, 1, 1, 1, 30, tzinfo=zone), 60).first()
    assert row.TimeKey == 202312312330
