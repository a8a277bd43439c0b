import random

import pytest

from tests.pages import frame, page
from tidemart.operators import visits

TIMEOUT = 10_000


def naive_bounces(rows, timeout):
    """Follow each visitor's records one by one."""
    found = {}
    for mid in {row[1][0] for row in rows}:
        mine = sorted((row for row in rows if row[1][0] == mid), key=lambda r: (r[4], r[0]))
        for here, after in zip(mine, [*mine[1:], None]):
            if here[2][1] is not None:
                continue
            if after is None or after[4] - here[4] >= timeout:
                found[here[0]] = "timeout"
            elif after[2][1] is None:
                found[here[0]] = "matched"
    return found


def bounces(spark, rows, **options):
    out = visits.bounce_details(frame(spark, rows), TIMEOUT, **options)
    result = {row.event_id: row.bounce_kind for row in out.collect()}
    assert len(result) == out.count()
    return result


@pytest.mark.parametrize(
    ("gap", "last", "expected"),
    [(9_999, None, "matched"), (9_999, "home", None), (10_000, "home", "timeout"),
     (10_000, None, "timeout"), (10_001, "home", "timeout"), (0, None, "matched")],
)
def test_gap_at_the_timeout(spark, gap, last, expected):
    rows = [page(1, "m", 1_000_000), page(2, "m", 1_000_000 + gap, last)]
    assert bounces(spark, rows).get(1) == expected


@pytest.mark.parametrize("width", [TIMEOUT, 3 * TIMEOUT, None])
def test_bounces_match_brute_force_with_a_hot_visitor(spark, width):
    draw = random.Random(7)
    rows = [
        page(n, "hot" if n % 3 else f"m{draw.randrange(5)}", draw.randrange(-200_000, 900_000),
             draw.choice([None, "home"]))
        for n in range(600)
    ]
    assert bounces(spark, rows, width=width) == naive_bounces(rows, TIMEOUT)


def test_slice_shorter_than_the_timeout_is_refused(spark):
    with pytest.raises(ValueError):
        visits.bounce_details(frame(spark, [page(1, "m", 1)]), TIMEOUT, width=TIMEOUT - 1)


def test_first_visit_of_each_day(spark):
    day = 86_400_000
    rows = [
        page(1, "m", 10, "home"), page(2, "m", 20), page(3, "m", 30), page(4, "m", day - 1),
        page(5, "m", day), page(6, "n", 25), page(8, "o", 40), page(7, "o", 40),
    ]
    found = visits.unique_visits(frame(spark, rows))
    assert {row.event_id for row in found.collect()} == {2, 5, 6, 7}


def test_first_visits_are_cut_before_the_shuffle(spark):
    rows = visits.unique_visits(frame(spark, [page(1, "m", 1)]).repartition(3))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # The plan is printed from the last step to the first.
    last, first = plan.index("row_number(), 1, Final"), plan.index("row_number(), 1, Partial")
    assert "Exchange hashpartitioning" in plan[last:first]


def test_bounce_window_is_sliced(spark):
    plan = visits.bounce_details(frame(spark, [page(1, "m", 1)]), TIMEOUT)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_mid" in text and "_slice" in text.split("hashpartitioning")[1][:60]
