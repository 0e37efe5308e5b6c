"""The source's own input format end to end: five CSV tables plus four hold-out twins with text
ids, text timestamps, the ``NA`` and ``not_defined`` sentinels and a quoted newline."""

from __future__ import annotations

import os

import pytest

from orderlens.plans import models, workflow
from orderlens.session import scratch_path

PRODUCTS = """product_id,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm,product_category_name
p1,40,600,2,1500,40,30,20,toys
p2,10,300,1,0,5,5,5,audio
p3,60,2000,8,800,30,20,10,toys
"""
ORDERS = """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2024-01-01 10:00:00,2024-01-01 11:00:00,2024-01-02 10:00:00,2024-01-06 12:00:00,2024-01-10 00:00:00
o2,c2,delivered,2024-01-02 10:00:00,2024-01-02 10:30:00,2024-01-03 10:00:00,2024-01-04 09:00:00,2024-01-10 00:00:00
o3,c3,shipped,2024-01-03 10:00:00,2024-01-03 10:30:00,2024-01-04 10:00:00,NA,2024-01-10 00:00:00
NA,c4,delivered,2024-01-03 10:00:00,2024-01-03 10:30:00,2024-01-04 10:00:00,2024-01-05 10:00:00,2024-01-10 00:00:00
o5,c5,delivered,2024-01-05 10:00:00,2024-01-05 10:30:00,2024-01-06 10:00:00,2024-01-07 10:00:00,2024-01-10 00:00:00
"""
ITEMS = """order_id,order_item_id,product_id,price,shipping_cost
o1,1,p1,10.50,2.25
o1,2,p3,20.00,3.00
o2,1,p3,5.00,1.00
o3,1,p1,7.00,1.00
o5,1,p2,3.00,1.00
"""
PAYMENTS = """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,3,30.00
o1,2,mobile,1,5.75
o2,1,credit_card,1,6.00
o2,2,not_defined,1,0.00
o3,1,mobile,2,8.00
o5,1,credit_card,1,4.00
"""
REVIEWS = """review_id,order_id,review_score,review_creation_date,review_answer_timestamp
r1,o1,5,2024-01-07 00:00:00,2024-01-08 10:00:00
r0,o1,1,2024-01-07 00:00:00,2024-01-07 10:00:00
r2,o2,2,2024-01-05 00:00:00,"2024-01-05 10:00:00"
r3,o3,4,2024-01-05 00:00:00,2024-01-05 10:00:00
r5,o5,"3",2024-01-08 00:00:00,2024-01-09 10:00:00
"""
T_ORDERS = """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
t1,"c
9",delivered,2024-02-01 10:00:00,2024-02-01 11:00:00,2024-02-02 10:00:00,2024-02-03 12:00:00,2024-02-10 00:00:00
"""
T_ITEMS = """order_id,order_item_id,product_id,price,shipping_cost
t1,1,p1,12.00,2.00
"""
T_PAYMENTS = """order_id,payment_sequential,payment_type,payment_installments,payment_value
t1,1,voucher,1,14.00
t1,2,not_defined,1,0.00
"""


@pytest.fixture(scope="module")
def sides(spark):
    root = scratch_path(spark, "source-csv").replace("file:", "")
    files = {}
    for name, text in [
        ("products", PRODUCTS),
        ("orders", ORDERS),
        ("order_items", ITEMS),
        ("order_payments", PAYMENTS),
        ("order_reviews", REVIEWS),
        ("test_orders", T_ORDERS),
        ("test_order_items", T_ITEMS),
        ("test_order_payments", T_PAYMENTS),
    ]:
        os.makedirs(root, exist_ok=True)
        path = os.path.join(root, f"{name}.csv")
        with open(path, "w") as fh:
            fh.write(text)
        files[name] = path
    train = workflow.read_sources(spark, {n: files[n] for n in workflow.TABLE_NAMES})
    hold = workflow.read_sources(
        spark,
        {
            "products": files["products"],
            "orders": files["test_orders"],
            "order_items": files["test_order_items"],
            "order_payments": files["test_order_payments"],
        },
        multiline=("orders",),
    )
    return workflow.basetables_from(train, hold)


def test_training_base_table(sides):
    spec, train, _ = sides
    assert spec.payment_types == ("credit_card", "mobile") and spec.categories == ("audio", "toys")
    rows = {r.order_id: r for r in train.collect()}
    # o3 undelivered (null gaps), o5 zero weight (null shipping_cost/kg), NA sentinel: all dropped
    assert set(rows) == {"o1", "o2"}
    o1 = rows["o1"]
    assert (o1.total_price, o1.total_shipping_cost, o1.total_cost) == (30.5, 5.25, 35.75)
    assert o1["shipping_cost%"] == 0.15 and o1.max_order_item_id == 2.0 and o1.num_unique_products_per_id == 2.0
    assert (o1.credit_card, o1.mobile, o1.pay_with_installment) == (30.0, 5.75, 1.0)
    assert o1.product_id == "p1" and o1.product_category_name == "toys" and o1.toys == 1.0 and o1.audio == 0.0
    assert o1["shipping_cost/kg"] == 3.5  # 5.25 / 1.5 kg of the representative item
    assert o1.approve_efficiency == 1.0 and o1.on_time == 84.0 and o1.total_delivery_time == 122.0
    assert o1.weekend_delivered == 1.0  # 2024-01-06 is a Saturday
    assert (o1.review_id, o1.review_score, o1.Target) == ("r1", 5.0, 1.0)  # latest answer wins
    assert o1.ttl_weight == 2.3 and o1.mean_description == 1300.0 and o1.nbr_photo == "Minimal"
    assert o1.aspect_ratio_length_width == 2.33 and o1.name_length == "Medium name"  # mean 50: edge goes low
    o2 = rows["o2"]
    assert (o2.credit_card, o2.mobile, o2.Target) == (6.0, 0.0, 0.0)  # not_defined dropped


def test_holdout_uses_training_lists(sides):
    _, _, hold = sides
    r = hold.collect()
    assert len(r) == 1 and r[0].order_id == "t1" and r[0].customer_id == "c\n9"
    assert (r[0].credit_card, r[0].mobile) == (0.0, 0.0)  # unseen "voucher" has no column
    assert "Target" not in hold.columns


def test_prepare_and_score_both_sides(spark, sides):
    spec, train, hold = sides
    p = workflow.prepare_base(train, hold, features=["total_price", "ttl_weight"], spec=spec)
    assert p.features == ["total_price", "ttl_weight"]
    m = models.learner("dt", "Target").fit(p.fit.unionByName(p.valid))  # two rows: too few for CV
    out = workflow.predict_holdout(p, m, scratch_path(spark, "source-preds")).collect()
    assert [r.order_id for r in out] == ["t1"] and out[0].pred_review_score in (0.0, 1.0)
