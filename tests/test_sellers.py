from bazaar.operators import sellers as S
from frames import catalog, item, order, review


def test_delay_clipped_after_mean(spark):
    t = catalog(spark,
                orders=[order("o1", car="2017-01-05 00:00:00"), order("o2", car="2017-01-01 00:00:00"),
                        order("o3", car=None)],
                order_items=[item("o1", 1, sid="s1", limit="2017-01-02 00:00:00"),   # +3 days
                             item("o2", 1, sid="s1", limit="2017-01-06 00:00:00"),   # -5 days
                             item("o3", 1, sid="s2")])
    d = {r.seller_id: r.delay_to_carrier for r in S.seller_delay_wait(t).collect()}
    assert d == {"s1": 0.0, "s2": 0.0}   # mean -1 clipped to 0; all-null mean -> 0


def test_item_weighted_vs_dedup_reviews(spark):
    t = catalog(spark, orders=[order("o1")],
                order_items=[item("o1", 1, sid="s1"), item("o1", 2, sid="s1")],
                order_reviews=[review("r1", "o1", 1)])
    assert S.seller_review_cost(t).first().review_cost == 200
    assert S.seller_review_cost(t, dedupe=True).first().review_cost == 100


def test_never_approved_seller_has_null_revenue(spark):
    t = catalog(spark, orders=[order("o1", appr=None)], order_items=[item("o1", 1, sid="s1")],
                order_reviews=[review("r1", "o1", 2)])
    r = S.seller_pnl(t).first()
    assert r.revenue is None and r.review_cost == 50 and r.profits is None
