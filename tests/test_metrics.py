from bazaar.operators import metrics as M
from frames import catalog, order


def test_empty_weeks_emitted(spark):
    t = catalog(spark, orders=[order("o1", pur="2017-01-02 10:00:00"), order("o2", pur="2017-01-20 10:00:00")])
    rows = [(str(r.period), r.n_orders) for r in M.weekly_orders(t).orderBy("period").collect()]
    assert rows == [("2017-01-02", 1), ("2017-01-09", 0), ("2017-01-16", 0), ("2017-01-23", 1)]


def test_brackets_boundaries_double_count_and_drop_first(spark):
    # four weeks with late shares 0.20, 0.15, 0.10, 0.05 (20 orders each)
    from datetime import datetime, timedelta
    orders, k = [], 0
    fmt = lambda d: d.strftime("%Y-%m-%d %H:%M:%S")
    for w, late in enumerate([4, 3, 2, 1]):
        for i in range(20):
            k += 1
            day = datetime(2017, 1, 2) + timedelta(days=7 * w)
            dlv = day + timedelta(days=9 if i < late else 1)
            orders.append(order(f"o{k}", pur=fmt(day), dlv=fmt(dlv), est=fmt(day + timedelta(days=5))))
    t = catalog(spark, orders=orders)
    got = {r.brackets: r.nb_weeks for r in M.lateness_brackets(t).collect()}
    assert got == {" ≥ 20%": 0, "15% - 20%": 2, "10% - 15%": 2, "5% - 10%": 2, " ≤ 5%": 1}
