from datetime import datetime

import pytest

from faremill import plans
from faremill.operators import derive_calendar


@pytest.fixture
def gold(make_trips):
    def trip(month, hour, amount, people, year=2023):
        return {
            "tpep_pickup_datetime": datetime(year, month, 3, hour),
            "total_amount": amount,
            "passenger_count": people,
        }

    rows = [
        trip(1, 0, 10.0, 1),
        trip(1, 5, 30.0, 2),
        trip(2, 5, 100.0, 2),
        trip(2, 5, -50.0, 2),
        trip(5, 3, 1.0, 1),
        trip(5, 9, 1.0, 1),
        trip(5, 6, 1.0, 4),
        trip(5, 20, 1.0, 4),
        trip(5, 21, 1.0, 2),
        trip(5, 21, 1.0, 3),
        trip(5, 21, 1.0, 0),
        trip(5, 21, 1.0, None),
        trip(6, 21, 8.0, 6),
    ]
    return derive_calendar(make_trips(rows), parts=["year", "month", "pickup_hour"])


def test_revenue_counts_paid_trips_only(gold):
    got = [tuple(r) for r in plans.revenue_by_month(gold).collect()]
    assert got == [(2023, 1, 2, 40.0), (2023, 2, 1, 100.0), (2023, 5, 8, 8.0), (2023, 6, 1, 8.0)]


def test_tickets_and_their_unweighted_means(gold):
    got = [tuple(r) for r in plans.ticket_by_month(gold).collect()]
    assert got == [(2023, 1, 40.0, 20.0), (2023, 2, 100.0, 100.0), (2023, 5, 8.0, 1.0), (2023, 6, 8.0, 8.0)]
    assert tuple(plans.period_means(gold).first()) == (39.0, 32.25)


def test_report_ends_in_the_period_mean(gold):
    got = [tuple(r) for r in plans.revenue_report(gold).collect()]
    assert got == [
        ("Jan", "$0.0M", "$20.0"),
        ("Fev", "$0.0M", "$100.0"),
        ("Mai", "$0.0M", "$1.0"),
        (None, "$0.0M", "$8.0"),
        ("Média do período", "$0.0M", "$32.25"),
    ]


def test_report_in_sql_is_the_same_report(gold):
    assert plans.revenue_report_sql(gold).collect() == plans.revenue_report(gold).collect()


def test_report_tells_the_same_month_of_two_years_apart(make_trips):
    rows = [{"tpep_pickup_datetime": datetime(y, 1, 1), "total_amount": a} for y, a in [(2024, 4.0), (2023, 2.0)]]
    got = plans.revenue_report(derive_calendar(make_trips(rows))).collect()
    assert [(r.mes, r.ticket_medio) for r in got] == [("Jan", "$2.0"), ("Jan", "$4.0"), ("Média do período", "$3.0")]


def test_hourly_means(gold):
    got = [tuple(r) for r in plans.avg_passengers_by_hour(gold, 2023, 5).collect()]
    assert got == [(3, 1.0, 1), (6, 4.0, 1), (9, 1.0, 1), (20, 4.0, 1), (21, 2.5, 2)]


def test_first_hour_wins_a_tie(gold):
    assert tuple(plans.hour_extremes(gold, 2023, 5).first()) == (3, 1.0, 6, 4.0)


def test_wide_form_has_every_hour(gold):
    row = plans.hours_wide(gold, 2023, 5).first().asDict()
    assert list(row) == ["metric", *[f"{h:02d}h" for h in range(24)]]
    assert (row["metric"], row["03h"], row["21h"], row["00h"]) == ("Média", 1.0, 2.5, None)


def test_dayparts(gold):
    got = [tuple(r) for r in plans.daypart_profile(gold, 2023, 5).collect()]
    assert got == [
        ("Madrugada (00–04)", 3, 3, 1.0, 1.0),
        ("Manhã cedo (05–07)", 6, 6, 4.0, 4.0),
        ("Dia e tarde (08–23)", 9, 21, 1.0, 4.0),
    ]
