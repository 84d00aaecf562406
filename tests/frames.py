"""Small hand-written marketplace tables for edge-case tests."""

from datetime import datetime

from bazaar.sources.schemas import SCHEMAS

TS = datetime.fromisoformat


def table(spark, name, rows):
    schema = SCHEMAS[name]
    cols = [f.name for f in schema.fields]
    full = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(full, schema)


def catalog(spark, **tables):
    out = {name: table(spark, name, []) for name in SCHEMAS}
    for name, rows in tables.items():
        out[name] = table(spark, name, rows)
    return out


def order(oid, status="delivered", pur="2017-01-01 00:00:00", appr=None, car=None, dlv=None,
          est="2017-01-10 00:00:00", cust="c1"):
    return {"order_id": oid, "customer_id": cust, "order_status": status,
            "order_purchase_timestamp": TS(pur) if pur else None,
            "order_approved_at": TS(appr) if appr else None,
            "order_delivered_carrier_date": TS(car) if car else None,
            "order_delivered_customer_date": TS(dlv) if dlv else None,
            "order_estimated_delivery_date": TS(est) if est else None}


def item(oid, n, pid="p1", sid="s1", price=10.0, freight=1.0, limit="2017-01-02 00:00:00"):
    return {"order_id": oid, "order_item_id": n, "product_id": pid, "seller_id": sid,
            "shipping_limit_date": TS(limit) if limit else None, "price": price, "freight_value": freight}


def review(rid, oid, score):
    return {"review_id": rid, "order_id": oid, "review_score": score,
            "review_creation_date": TS("2017-02-01 00:00:00"), "review_answer_timestamp": TS("2017-02-02 00:00:00")}
