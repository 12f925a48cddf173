"""Small literal tables with known answers."""

from datetime import datetime
from decimal import Decimal

PRODUCT_SCHEMA = "product_id int, product_name string, category string, price decimal(10,2)"
ORDER_SCHEMA = "order_id int, customer_id int, product_id int, quantity int, order_status string, order_ts timestamp_ntz"


def money(value):
    return Decimal(value).quantize(Decimal("0.01"))


PRODUCTS_START = [
    (11, "Kettle", "Kitchen", money("40.00")),
    (12, "Whisk", "Kitchen", money("6.50")),
    (13, "Lantern", "Lighting", money("55.00")),
    (14, "Skillet", "Kitchen", money("30.00")),
    (15, "Candle", "Lighting", money("9.00")),
]
# 16 inserted, 14 dearer, 15 deleted.
PRODUCTS_CHANGED = [
    (11, "Kettle", "Kitchen", money("40.00")),
    (12, "Whisk", "Kitchen", money("6.50")),
    (13, "Lantern", "Lighting", money("55.00")),
    (14, "Skillet", "Kitchen", money("33.00")),
    (16, "Ladle", "Kitchen", money("12.25")),
]
# The price list of the order tests.
PRODUCTS_FINAL = [
    (11, "Kettle", "Kitchen", money("40.00")),
    (12, "Whisk", "Kitchen", money("6.50")),
    (13, "Lantern", "Lighting", money("55.00")),
    (14, "Skillet", "Kitchen", money("35.00")),
    (16, "Ladle", "Kitchen", money("12.25")),
    (17, "Grater", "Kitchen", money("8.00")),
]


def at(day, clock):
    return datetime.fromisoformat(f"2027-02-{day:02d} {clock}")


ORDERS = [
    (1, 51, 11, 2, "COMPLETED", at(3, "08:00")),
    (2, 52, 12, 4, "COMPLETED", at(3, "08:30")),
    (3, 53, 13, 1, "PENDING", at(3, "09:00")),
    (4, 51, 14, 1, "COMPLETED", at(4, "08:00")),
    (4, 51, 14, 3, "COMPLETED", at(4, "08:01")),
    (5, 54, 17, 5, "COMPLETED", at(4, "09:00")),
    (6, 55, 18, 1, "CANCELLED", at(4, "10:00")),
    (7, 56, 11, 1, "COMPLETED", at(5, "08:00")),
]
LANDING = [
    (21, 61, 12, 2, "COMPLETED", at(8, "07:00")),
    (22, 62, 13, 2, "PENDING", at(8, "07:10")),
    (23, 63, 16, 4, "COMPLETED", at(8, "07:20")),
]
# NULL quantity, untidy and missing status, missing time, an unknown product.
UNTIDY = [
    (31, 71, 11, None, "COMPLETED", at(9, "06:00")),
    (32, 72, 12, 1, " completed ", at(9, "06:05")),
    (33, 73, 13, 1, None, at(9, "06:10")),
    (34, 74, 12, 1, "PENDING", None),
    (34, 74, 12, 5, "PENDING", at(9, "06:15")),
    (35, 75, 99, 1, "COMPLETED", at(9, "06:20")),
]

CUSTOMERS = [
    (1, "Mia", "mia@shop.test", "COAST"),
    (2, "Noor", "noor@shop.test", "HILLS"),
    (3, "Pavel", "pavel@shop.test", "COAST"),
    (4, "Ines", "ines@shop.test", "PLAIN"),
]

DOCUMENTS = [
    (1, '{"customer": {"name": "Mia", "region": "COAST"}, "orders": [{"id": 71, "amount": 12}, {"id": 72, "amount": 30.5}]}'),
    (2, '{"customer": {"name": "Noor", "region": "HILLS"}, "orders": [{"id": 73, "amount": 8}]}'),
    (3, '{"customer": {"name": "Ines", "region": "PLAIN"}}'),
    (4, '{"customer": {"name": "Ines", "region": "PLAIN"}, "orders": []}'),
    (5, None),
    (6, '{"customer": {"name": "Pavel"}, "orders": [{"id": 74, "amount": 19.99}]}'),
    (7, "not json"),
]

INVOICE = """INVOICE INV-77
Bill To: Harbour Stores
Due Date: 2027-01-31
Amount Due: 45.90 USD
Line: 3x Lantern glass @ 15.30"""

# Texts with the searched words of the reference questions, written anew.
HELP_TEXTS = [
    ("faq-returns", "Returns: send items back within 30 days of delivery. Opened electronics may cost a fee.", "faq"),
    ("faq-warranty", "Every laptop has a hardware warranty for 12 months. Spills are not covered.", "faq"),
    ("faq-shipping", "Standard shipping takes 3 to 5 business days.", "faq"),
    ("policy-masking", "Customer email is masked. ANALYST roles see masked values; some may see unmasked values.", "policy"),
    ("policy-privacy", "This policy says which data we keep: address and order history.", "policy"),
    ("faq-desk", "Desk assembly takes about 40 minutes.", "faq"),
]
