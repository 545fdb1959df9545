"""A small hand-made marketplace whose rows reach every branch of the operators."""

from __future__ import annotations

from datetime import datetime

from tradewind.sources.schemas import RAW_SCHEMAS


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def order(order_id, status="delivered", bought="2018-01-01 10:00", delivered=None, estimated="2018-01-10"):
    return (order_id, f"c_{order_id}", status, ts(bought), None, None, ts(delivered), ts(estimated))


ORDERS = [
    order("late", delivered="2018-01-11 10:00"),
    order("early", delivered="2018-01-05 10:00", bought="2018-01-02 23:59"),
    order("same_day", delivered="2018-01-10 18:00"),
    order("in_transit", status="shipped"),
    order("canceled", status="canceled", bought="2018-01-06 00:00"),
    order("no_items", status="unavailable", bought="2018-01-07 12:00"),
    order("no_estimate", delivered="2018-01-08 10:00", estimated=None),
    order("no_status", status=None),
]
# order_id, item, product, seller, price, freight
ITEMS = [
    ("late", 1, "p_beauty", "s_near", 29.99, 0.01),
    ("late", 2, "p_beauty", "s_far", 30.0, 10.0),
    ("early", 1, "p_none", "s_near", 100.0, 20.0),
    ("early", 2, "p_beauty", "s_lost", 100.0, 0.0),
    ("same_day", 1, "p_game", "s_near", 300.0, 30.0),
    ("in_transit", 1, "p_missing", "s_missing", 0.0, 0.0),
    ("canceled", 1, "p_beauty", "s_lost", 5.0, 1.0),
    ("no_estimate", 1, "p_heavy", "s_far", 150.0, 50.0),
    ("no_status", 1, "p_heavy", "s_near", None, 1.0),
]
# order_id, sequence, type, installments, value
PAYMENTS = [
    ("late", 1, "voucher", 1, 35.0),
    ("late", 2, "boleto", 2, 35.0),
    ("early", 1, "credit_card", 8, 200.0),
    ("early", 2, "voucher", 1, 20.0),
    ("same_day", 1, "credit_card", 1, None),
    ("canceled", 1, None, 1, 6.0),
    ("no_estimate", 1, None, 1, 100.0),
    ("no_estimate", 2, "voucher", 1, 100.0),
]
# review, order, score, message, answered
REVIEWS = [
    ("r_old", "late", 1, "bad", "2018-01-02"),
    ("r_new", "late", 5, "", "2018-01-04"),
    ("r_b", "early", 4, None, "2018-01-04"),
    ("r_a", "early", 2, "tie", "2018-01-04"),
    ("r_null", "same_day", None, "text", None),
]
# order, person, zip, state
CUSTOMERS = [
    ("late", "ann", 1001, "SP"),
    ("early", "ann", 1001, "SP"),
    ("same_day", "bob", 2002, "RJ"),
    ("in_transit", "bob", 2002, "RJ"),
    ("canceled", "cid", 3003, "AM"),
    ("no_items", "cid", 3003, "AM"),
    ("no_estimate", "dan", 1001, "ZZ"),
    ("no_status", "dan", 1001, "ZZ"),
]
SELLERS = [
    ("s_near", 1001, "sao paulo", "SP"),
    ("s_far", 2002, "rio", "RJ"),
    ("s_lost", 3003, "nowhere", "XX"),
]
PRODUCTS = [
    ("p_beauty", "beleza_saude", 100.0, 10.0, 2.0, 3.0, 1.0),
    ("p_none", None, 500.0, 1.0, 1.0, 1.0, None),
    ("p_game", "pc_gamer", None, None, 1.0, 1.0, 2.0),
    ("p_heavy", "vazio", 9000.0, 10.0, 10.0, 10.0, 1.0),
]
TRANSLATION = [("beleza_saude", "health_beauty"), ("vazio", "")]
GEOLOCATION = [
    (1001, -23.5, -46.6, "sao paulo", "SP"),
    (1001, -23.7, -46.8, "osasco", "SP"),
    (1001, 42.18, 121.11, "aaa", "AA"),
    (2002, -22.9, -43.2, "rio", "RJ"),
    (3003, 51.5, -0.12, "london", "XX"),
    (4004, None, -46.6, "null", "SP"),
    (5005, 6.0, -74.0, "edge", "RR"),
]
REGIONS = [("SP", "Sao Paulo", "Sudeste"), ("RJ", "Rio", "Sudeste"), ("AM", "Amazonas", "Norte")]


def raw_tables(spark):
    rows = {
        "orders": ORDERS,
        "order_items": [(o, n, p, s, None, price, freight) for o, n, p, s, price, freight in ITEMS],
        "order_payments": PAYMENTS,
        "order_reviews": [(r, o, score, None, text, None, ts(at)) for r, o, score, text, at in REVIEWS],
        "customers": [(f"c_{o}", person, z, "city", state) for o, person, z, state in CUSTOMERS],
        "sellers": SELLERS,
        "products": PRODUCTS,
        "geolocation": GEOLOCATION,
        "product_category_name_translation": TRANSLATION,
        "seed_state_region": REGIONS,
    }
    return {name: spark.createDataFrame(values, RAW_SCHEMAS[name]) for name, values in rows.items()}
