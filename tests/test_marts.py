"""Mart semantics on hand-made rows (rules 8-16) and the plan rewrites
checked against row-by-row definitions on random tables."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import empty_tables, frame, ts

from emporia.plans import marts
from emporia.schemas import ENTITIES
from emporia.session import fresh_dir

T0 = ts("2018-01-05 10:00:00")


def _tables(spark, money="decimal", **rows):
    t = empty_tables(spark, money)
    names = {
        "orders": "fact_order",
        "order_fop": "fact_order_fop",
        "order_item": "fact_order_item",
        "customer": "dim_customer",
        "product": "dim_product",
        "seller": "dim_seller",
    }
    for entity, data in rows.items():
        t[names[entity]] = frame(spark, entity, data, money)
    return t


def _order(oid, status="delivered", cust="c1", when=T0):
    return {"order_id": oid, "customer_id": cust, "order_status": status, "order_purchase_timestamp": when}


def _item(oid, line=1.0, product="p1", seller="s1", price=10.0, freight=1.0, when=T0):
    return {
        "order_id": oid,
        "order_item_id": line,
        "product_id": product,
        "seller_id": seller,
        "price": price,
        "freight_value": freight,
        "order_purchase_timestamp": when,
    }


CUSTOMER = [{"customer_id": "c1", "customer_unique_id": "u1", "customer_city": "x", "customer_state": "s"}]
PRODUCT = [{"product_id": "p1", "product_category_name_english": "toys"}]
SELLER = [{"seller_id": "s1", "seller_state": "SP"}]


def test_rule8_unknown_product_forms_null_group_and_order_without_items(spark):
    t = _tables(
        spark,
        orders=[_order("o1"), _order("o2")],
        order_item=[_item("o1", product="unknown")],
        customer=CUSTOMER,
        product=PRODUCT,
        seller=SELLER,
    )
    m2 = marts.mart_product_performances(t).collect()
    assert len(m2) == 1 and m2[0].product_id is None and m2[0].total_units_sold == 1
    m3 = marts.mart_customer_characteristics(t).collect()
    assert len(m3) == 1
    assert m3[0].total_orders == 2 and m3[0].total_items_bought == 1


def test_rule8_order_without_items_has_null_revenue(spark):
    t = _tables(spark, orders=[_order("o2")], customer=CUSTOMER)
    (row,) = marts.mart_customer_characteristics(t).collect()
    assert row.total_orders == 1 and row.total_items_bought == 0
    assert row.total_revenue is None and row.avg_revenue_per_order is None


def test_rules9_10_lost_revenue_counts_rows_and_adds_line_numbers(spark):
    t = _tables(
        spark,
        order_fop=[_order("f1", "canceled"), _order("f2", "canceled")],
        order_item=[_item("f1", 1.0), _item("f1", 2.0), _item("f1", 3.0)],
    )
    (row,) = marts.mart_lost_revenue(t).collect()
    assert row.total_fop_orders == 4
    assert row.total_unique_fop_orders == 2
    assert row.total_fop_items == 6.0
    assert row.total_est_lost_revenue == 30.0


def test_rule11_distinct_counts_the_dimension_side(spark):
    t = _tables(
        spark,
        orders=[_order("o1")],
        order_item=[_item("o1", 1.0, seller="s1"), _item("o1", 2.0, seller="nobody")],
        customer=CUSTOMER,
        product=PRODUCT,
        seller=SELLER,
    )
    (row,) = marts.mart_product_performances(t).collect()
    assert row.seller_count == 1 and row.total_units_sold == 2 and row.total_orders == 1


def test_rule12_order_in_both_facts(spark):
    t = _tables(
        spark,
        orders=[_order("o1")],
        order_fop=[_order("o1", "canceled")],
        order_item=[_item("o1")],
        customer=CUSTOMER,
        product=PRODUCT,
        seller=SELLER,
    )
    assert marts.mart_user_activity(t).count() == 2
    (row,) = marts.mart_product_performances(t).collect()
    assert row.total_units_sold == 1


def test_rule14_safe_divide_gives_null(spark):
    t = _tables(spark, orders=[_order("o1", cust="ghost")], order_item=[_item("o1")], product=PRODUCT)
    (row,) = marts.mart_product_performances(t).collect()
    assert row.unique_customer_count == 0 and row.avg_revenue_per_customer is None


def test_rule15_half_up_rounding_on_exact_money(spark):
    t = _tables(
        spark,
        orders=[_order("o1")],
        order_item=[_item("o1", 1.0, price=0.02), _item("o1", 2.0, price=0.03)],
        customer=CUSTOMER,
        product=PRODUCT,
        seller=SELLER,
    )
    (row,) = marts.mart_product_performances(t).collect()
    assert row.total_revenue == 0.05
    assert row.avg_revenue_per_unit == 0.03


def test_rule16_month_boundaries(spark):
    t = _tables(
        spark,
        order_fop=[
            _order("a", "canceled", when=ts("2018-01-31 23:59:59")),
            _order("b", "canceled", when=ts("2018-02-01 00:00:00")),
        ],
    )
    months = sorted(str(r.order_month) for r in marts.mart_lost_revenue(t).collect())
    assert months == ["2018-01-01", "2018-02-01"]


# --------------------------------------- rewrites vs row-by-row definitions
#
# A small reference in plain Python: nested loops over collected rows, groups
# as dictionaries.  Money is Decimal, so sums and ties are exact.


def _left(rows, others, key, other_key):
    """(row, match) pairs of a left join; a missing match is an empty dict."""
    for row in rows:
        found = [o for o in others if row.get(key) is not None and o[other_key] == row[key]]
        for match in found or [{}]:
            yield row, match


def _sum(values):
    values = [v for v in values if v is not None]
    return sum(values) if values else None


def _number(value):
    return None if value is None else float(value)


def _mean(values):
    values = [v for v in values if v is not None]
    return float(sum(values)) / len(values) if values else None


def _per(total, n):
    if total is None or not n:
        return None
    return float((Decimal(total) / n).quantize(Decimal("0.01"), ROUND_HALF_UP))


def _distinct(values):
    return len({v for v in values if v is not None})


def _present(values):
    return [v for v in values if v is not None]


def _grouped(rows, key):
    groups = {}
    for row in rows:
        groups.setdefault(key(row), []).append(row)
    return groups.items()


def _expected_user_activity(t):
    for item, order in _left(t["fact_order_item"], t["fact_order"] + t["fact_order_fop"], "order_id", "order_id"):
        for _, who in _left([order], t["dim_customer"], "customer_id", "customer_id"):
            for _, what in _left([item], t["dim_product"], "product_id", "product_id"):
                for _, shop in _left([item], t["dim_seller"], "seller_id", "seller_id"):
                    row = {c: item[c] for c in ("order_id", "order_item_id", "order_purchase_timestamp", "shipping_limit_date")}
                    row |= {"price": _number(item["price"]), "freight_value": _number(item["freight_value"])}
                    row |= {c: order.get(c) for c in marts.ORDER_LOOKUP_COLUMNS if c != "customer_id"}
                    row |= {f"customer_{c}": who.get(f"customer_{c}") for c in ("id", "unique_id", "zip_code_prefix", "state")}
                    row |= {f"seller_{c}": shop.get(f"seller_{c}") for c in ("id", "zip_code_prefix", "state")}
                    yield row | {"product_category_name_english": what.get("product_category_name_english")}


def _expected_product_performances(t):
    delivered = [o for o in t["fact_order"] if o["order_status"] == "delivered"]
    sold = []
    for item, order in _left(t["fact_order_item"], delivered, "order_id", "order_id"):
        for _, who in _left([order], t["dim_customer"], "customer_id", "customer_id"):
            for _, what in _left([item], t["dim_product"], "product_id", "product_id"):
                for _, shop in _left([item], t["dim_seller"], "seller_id", "seller_id"):
                    if order:
                        sold.append((item, order, who, what, shop))
    when = lambda o: o["order_purchase_timestamp"] and o["order_purchase_timestamp"].date()
    key = lambda r: (r[3].get("product_id"), r[3].get("product_category_name_english"), when(r[1]))
    for (product, category, day), rows in _grouped(sold, key):
        prices, freights = [r[0]["price"] for r in rows], [r[0]["freight_value"] for r in rows]
        units, orders = len(_present(r[0]["order_item_id"] for r in rows)), _distinct(r[0]["order_id"] for r in rows)
        people = _distinct(r[2].get("customer_unique_id") for r in rows)
        yield {
            "product_id": product, "product_category_name_english": category, "order_date": day,
            "seller_count": _distinct(r[4].get("seller_id") for r in rows), "unique_customer_count": people,
            "total_units_sold": units, "total_orders": orders,
            "total_revenue": _number(_sum(prices)), "avg_revenue_per_unit": _per(_sum(prices), units),
            "avg_revenue_per_customer": _per(_sum(prices), people),
            "total_shipping_cost": _number(_sum(freights)), "avg_shipping_cost": _mean(freights),
            "avg_price": _mean(prices), "min_price": _number(min(_present(prices), default=None)),
            "max_price": _number(max(_present(prices), default=None)),
            "avg_items_per_order": units / orders if orders else None,
        }


def _expected_customer_characteristics(t):
    bought = []
    for who, order in _left(t["dim_customer"], t["fact_order"], "customer_id", "customer_id"):
        if order and order["order_status"] == "delivered" and order["order_purchase_timestamp"]:
            bought += [(who, order, item) for _, item in _left([order], t["fact_order_item"], "order_id", "order_id")]
    month = lambda o: o["order_purchase_timestamp"].date().replace(day=1)
    key = lambda r: (r[0]["customer_unique_id"], r[0]["customer_city"], r[0]["customer_state"], month(r[1]))
    for (person, city, state, first_day), rows in _grouped(bought, key):
        revenue, orders = _sum(r[2].get("price") for r in rows), _distinct(r[1]["order_id"] for r in rows)
        yield {
            "customer_unique_id": person, "customer_city": city, "customer_state": state, "order_month": first_day,
            "total_orders": orders, "total_items_bought": len(_present(r[2].get("order_item_id") for r in rows)),
            "total_revenue": _number(revenue), "avg_revenue_per_order": _per(revenue, orders),
            "first_purchase_date": min(r[1]["order_purchase_timestamp"] for r in rows),
            "last_purchase_date": max(r[1]["order_purchase_timestamp"] for r in rows),
        }


def _expected_lost_revenue(t):
    rows = list(_left(t["fact_order_fop"], t["fact_order_item"], "order_id", "order_id"))
    month = lambda o: o["order_purchase_timestamp"] and o["order_purchase_timestamp"].date().replace(day=1)
    for (first_day, status), group in _grouped(rows, lambda r: (month(r[0]), r[0]["order_status"])):
        yield {
            "order_month": first_day, "order_status": status,
            "total_fop_orders": len(_present(o["order_id"] for o, _ in group)),
            "total_unique_fop_orders": _distinct(o["order_id"] for o, _ in group),
            "total_fop_items": _number(_sum(i.get("order_item_id") for _, i in group)),
            "total_est_lost_revenue": _number(_sum(i.get("price") for _, i in group)),
            "total_est_lost_shipping_cost": _number(_sum(i.get("freight_value") for _, i in group)),
        }


EXPECTED = {
    "mart_user_activity": _expected_user_activity,
    "mart_product_performances": _expected_product_performances,
    "mart_customer_characteristics": _expected_customer_characteristics,
    "mart_lost_revenue": _expected_lost_revenue,
}


def _random_tables(spark, seed: int):
    rnd = random.Random(seed)

    def pick(values, null_rate=0.1):
        return None if rnd.random() < null_rate else rnd.choice(values)

    oids = [f"o{i}" for i in range(25)]
    days = [ts(f"2018-0{m}-{d:02d} 0{h}:00:00") for m in (1, 2) for d in (1, 15, 28) for h in (0, 5)]
    orders = [
        {
            "order_id": pick(oids, 0.05),
            "customer_id": pick(["c1", "c2", "c3", "c4", "cx"]),
            "order_status": pick(["delivered", "delivered", "shipped"]),
            "order_purchase_timestamp": pick(days, 0.05),
        }
        for _ in range(30)  # duplicate order ids on purpose
    ]
    fop = [
        {
            "order_id": pick(oids, 0.05),
            "order_status": pick(["canceled", "unavailable"]),
            "order_purchase_timestamp": pick(days, 0.05),
        }
        for _ in range(15)
    ]
    items = [
        {
            "order_id": pick(oids + ["orphan"], 0.05),
            "order_item_id": pick([1.0, 2.0, 3.0], 0.1),
            "product_id": pick(["p1", "p2", "p3", "px"]),
            "seller_id": pick(["s1", "s2", "sx"]),
            "price": pick([0.01, 0.05, 1.25, 10.0, 99.99], 0.1),
            "freight_value": pick([0.0, 0.5, 3.33], 0.1),
            "order_purchase_timestamp": pick(days, 0.05),
        }
        for _ in range(80)
    ]
    customers = [
        {"customer_id": c, "customer_unique_id": u, "customer_city": "x", "customer_state": st}
        for c, u, st in [("c1", "u1", "A"), ("c2", "u1", "A"), ("c3", "u3", None), ("c3", "u3", None), ("c4", None, "B")]
    ]
    products = [
        {"product_id": p, "product_category_name_english": cat}
        for p, cat in [("p1", "toys"), ("p2", None), ("p2", None), ("p3", "toys")]
    ]
    sellers = [{"seller_id": s} for s in ("s1", "s2", "s2")]
    return _tables(
        spark,
        orders=orders,
        order_fop=fop,
        order_item=items,
        customer=customers,
        product=products,
        seller=sellers,
    )


@pytest.mark.parametrize("name", sorted(EXPECTED))
@pytest.mark.parametrize("seed", [1, 2])
def test_mart_plans_equal_row_by_row_definitions(spark, name, seed):
    """Duplicate keys in facts and dimensions, NULL keys and NULL measures:
    the regrouped joins and per-order pre-aggregation give the same rows as
    the mart's definition, row by row."""
    t = _random_tables(spark, seed)
    rows = {table: [r.asDict() for r in df.collect()] for table, df in t.items()}
    expected = list(EXPECTED[name](rows))
    got = marts.MARTS[name](t)
    cols = sorted(got.columns)
    assert expected and all(sorted(r) == cols for r in expected)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    exp_rows = sorted((tuple(r[c] for c in cols) for r in expected), key=key)
    got_rows = sorted((tuple(r[c] for c in cols) for r in got.collect()), key=key)
    assert got_rows == exp_rows


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_stored_marts_replace_and_read_as_defined(spark, name):
    path = fresh_dir(spark, "stored")
    mart = marts.MARTS[name](_random_tables(spark, 1))
    marts.store(mart, path, name)
    stored = marts.read_stored(spark, path, name)
    assert stored.columns[: len(mart.columns)] == mart.columns and stored.count() == mart.count()
    marts.store(mart.limit(0), path, name)
    assert marts.read_stored(spark, path, name).count() == 0


def test_entities_cover_the_six_tables():
    assert {e.final_name for e in ENTITIES.values()} == {
        "dim_seller",
        "dim_product",
        "dim_customer",
        "fact_order",
        "fact_order_fop",
        "fact_order_item",
    }
