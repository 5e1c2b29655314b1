from visit_rows import visit

from retail_insight.operators import category
from retail_insight.operators.visits import filter_visits
from retail_insight.params import VisitFilter


def wide_of(df):
    w = category.category_counts_wide(category.category_actions(df))
    return {r.category_id: (r.click_count, r.order_count, r.pay_count) for r in w.collect()}


def test_precedence_click_then_order_then_pay(make_visits):
    df = make_visits([visit(click_category_id=5, order="1,2"), visit(order="1", pay="2")])
    assert wide_of(df) == {"5": (1, 0, 0), "1": (0, 1, 0)}


def test_repeats_in_csv_count_twice(make_visits):
    assert wide_of(make_visits([visit(order="3,3")])) == {"3": (0, 2, 0)}


def test_empty_items_are_dropped(make_visits):
    df = make_visits([visit(order="1,,2,,"), visit(order=","), visit(order=""), visit(order=None)])
    assert wide_of(df) == {"1": (0, 1, 0), "2": (0, 1, 0)}


def test_null_click_id_is_not_a_click(make_visits):
    assert wide_of(make_visits([visit(click_category_id=None, pay="7")])) == {"7": (0, 0, 1)}


def test_comma_only_order_blocks_pay(make_visits):
    # a non-empty order CSV classes the row as an order even without items
    assert wide_of(make_visits([visit(order=",", pay="8")])) == {}


def test_pay_only_category(make_visits):
    assert wide_of(make_visits([visit(pay="9")])) == {"9": (0, 0, 1)}


def test_top_categories_tie_order(make_visits):
    rows = [visit(click_category_id=c) for c in (1, 2, 3)] + [visit(order="1,2,3"), visit(pay="2")]
    top = category.top_categories(category.category_counts_wide(
        category.category_actions(make_visits(rows))), "t").collect()
    assert [r.category_id for r in top] == ["2", "1", "3"]
    assert all(r.task_id == "t" for r in top)


def test_top_categories_keeps_ten(make_visits):
    rows = [visit(click_category_id=c) for c in range(1, 13) for _ in range(c)]
    top = category.top_categories(category.category_counts_wide(
        category.category_actions(make_visits(rows))), "t").collect()
    assert [r.category_id for r in top] == [str(c) for c in range(12, 2, -1)]


def test_filter_bounds_inclusive_and_open(make_visits, make_users):
    users = make_users([(1, 19), (2, 20), (3, 50), (4, 51)])
    days = ["2018-10-31", "2018-11-01", "2019-12-28", "2019-12-29"]
    visits = make_visits([visit(date=d, user_id=u) for d in days for u in (1, 2, 3, 4)])
    f = VisitFilter("2018-11-01", "2019-12-28", 20, 50)
    got = {(r.date, r.user_id) for r in filter_visits(visits, users, f).collect()}
    assert got == {(d, u) for d in days[1:3] for u in (2, 3)}
    assert filter_visits(visits, users, VisitFilter("", "", "", "")).count() == 16
    assert filter_visits(visits, users, VisitFilter(None, "2018-11-01", "", None)).count() == 8


def test_duplicate_user_row_multiplies(make_visits, make_users):
    users = make_users([(1, 30), (1, 30)])
    assert filter_visits(make_visits([visit(user_id=1)]), users, VisitFilter()).count() == 2


def test_params_from_json():
    f = VisitFilter.from_json('{"startDate":"2018-11-01","endDate":"2019-12-28","startAge":"20","endAge":"50"}')
    assert f.bounds() == [("date", ">=", "2018-11-01"), ("date", "<=", "2019-12-28"),
                          ("age", ">=", 20), ("age", "<=", 50)]


def _sessions(make_visits, rows, k=10):
    v = make_visits(rows)
    top = category.top_categories(category.category_counts_wide(category.category_actions(v)), "t")
    return category.top_sessions(category.category_session_clicks(v, top), "t", k).collect()


def test_csv_only_category_gets_no_sessions(make_visits):
    rows = [visit(order="-1"), visit(click_category_id=4, session_id="a")]
    got = _sessions(make_visits, rows)
    assert [(r.category_id, r.session_id, r.click_count) for r in got] == [("4", "a", 1)]


def test_top_sessions_exactly_ten_by_id(make_visits):
    rows = [visit(click_category_id=1, session_id=f"s{i:02d}") for i in range(11)]
    rows += [visit(click_category_id=1, session_id="s10")]
    got = _sessions(make_visits, rows)
    assert len(got) == 10
    assert got and sorted((-r.click_count, r.session_id) for r in got)[0] == (-2, "s10")
    assert {r.session_id for r in got} == {"s10"} | {f"s{i:02d}" for i in range(9)}


def test_params_from_properties_with_bare_keys_and_continuations():
    text = ('# job parameters\n'
            'condition.params.json={startDate:"2018-11-01", \\\n'
            '  endDate:"2019-12-28", \\\n'
            '  startAge: "20", \\\n'
            '  endAge: "", \\\n'
            '  city: ""}\n'
            'other.key=1\n')
    f = VisitFilter.from_properties(text)
    assert f.bounds() == [("date", ">=", "2018-11-01"), ("date", "<=", "2019-12-28"), ("age", ">=", 20)]
