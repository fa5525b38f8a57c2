"""Small input files for the golden tests. Rows and expected results of the worked examples."""

import csv
import json
from pathlib import Path

ORDER_LINES = [  # id, order, customer, product, quantity, unit price, status, time
    ("ev-1001", "O-1001", "C-014", "keyboard", 1, 42.50, "SUBMITTED", "2026-05-25T09:02:00Z"),
    ("ev-1002", "O-1002", "C-008", "monitor", 2, 210.00, "SUBMITTED", "2026-05-25T09:12:00Z"),
    ("ev-1003", "O-1003", "C-014", "cable", 3, 8.00, "SUBMITTED", "2026-05-25T09:19:00Z"),
    ("ev-1004", "O-1004", "C-021", "dock", 1, 98.75, "SUBMITTED", "2026-05-25T09:34:00Z"),
    ("ev-1005", "O-1005", "C-008", "monitor", 1, 210.00, "CANCELLED", "2026-05-25T09:42:00Z"),
    ("ev-1006", "O-1006", "C-033", "headset", 2, 67.00, "SUBMITTED", "2026-05-25T10:05:00Z"),
]

ORDER_CHANGES = [  # event, op, order, customer, amount, status, time, lsn
    ("evt-001", "r", 1001, 501, 120.5, "CREATED", "2026-06-01T09:15:00Z", 100),
    ("evt-002", "r", 1002, 502, 75.0, "CREATED", "2026-06-01T09:30:00Z", 101),
    ("evt-003", "c", 1003, 501, 42.25, "CREATED", "2026-06-01T10:05:00Z", 102),
    ("evt-004", "u", 1002, 502, 75.0, "PAID", "2026-06-01T10:25:00Z", 103),
    ("evt-004", "u", 1002, 502, 75.0, "PAID", "2026-06-01T10:25:00Z", 103),
    ("evt-005", "u", 1001, 501, 120.5, "SHIPPED", "2026-06-01T10:35:00Z", 104),
    ("evt-006", "d", 1003, 501, 42.25, "CANCELLED", "2026-06-01T11:00:00Z", 105),
]
ORDER_HASHES = ["083673bffe4a541e", "63bfe2bd595be1bc", "9345d4d75feb52c9", "cb9b0e2aa0effe93", "cb9b0e2aa0effe93",
                "b7eea2c487845a33"]
CLICKS = [
    ("clk-001", "2026-06-01T09:20:00Z", "product_view", 1001, "s-1", "u-501"),
    ("clk-002", "2026-06-01T09:35:00Z", "cart_add", 1002, "s-2", "u-502"),
    ("clk-003", "2026-06-01T10:00:00Z", "checkout_start", 1001, "s-1", "u-501"),
    ("clk-004", "2026-06-01T08:59:00Z", "product_view", None, "s-3", "u-777"),
]
CLICK_HASHES = ["baf950a0054d3fd2", "deb5202963e1e324", "5a043f3abe1dbeab", "cf3651fd49aecae1"]
SHIPMENTS = [
    ("SHP-9001", "1001", "BlueDart", "IN_TRANSIT", "2026-06-01T12:00:00Z"),
    ("SHP-9002", "1002", "Delhivery", "DELIVERED", "2026-06-01T12:10:00Z"),
    ("", "1003", "BlueDart", "CREATED", "2026-06-01T12:20:00Z"),
    ("SHP-9004", "9999", "Ekart", "IN_TRANSIT", "2026-06-01T12:30:00Z"),
]
SHIPMENT_HASHES = ["892a7d0b0efa62f0", "47974f03c59fcb29", "6ea723a13bb31918", "c19b46cf7ce37d72"]
CUSTOMERS = [(501, "Ola Vik", "Basic", "Fjord"), (502, "Rosa Lim", "Plus", "Delta"), (503, "Timo Aho", "Basic", "Lakes")]
PROPOSALS = [("Add optional field", "FULL"), ("Rename a key", "reject"), ("Remove optional field", "BACKWARD_TRANSITIVE")]

RETAIL_COLUMNS = ["event_id", "order_id", "customer_id", "product_id", "status", "amount", "currency", "channel", "event_time"]
# Planted: a copy under another id (r-12 of r-09), a refund, a missing product, an unknown customer, a foreign currency, three later states.
RETAIL_BATCH_1 = [
    ("r-08", 61, 301, "pot-1", "new", 84.25, "usd", "WEB", "2025-11-03T08:15:00Z"),
    ("r-09", 62, 302, "PAN-2", "NEW", 31.00, "USD", "store", "2025-11-03T08:20:00Z"),
    ("r-10", 63, 303, "HOE-3", "PAID", 19.75, "USD", "web", "2025-11-03T08:31:00Z"),
    ("r-11", 64, 301, "TUB-4", "NEW", -7.50, "USD", "web", "2025-11-03T08:44:00Z"),
    ("r-12", 62, 302, "PAN-2", "NEW", 31.00, "USD", "store", "2025-11-03T08:20:00Z"),
    ("r-13", 65, 304, "PAN-2", "CANCELLED", 62.00, "USD", "web", "2025-11-03T09:02:00Z"),
]
RETAIL_BATCH_2 = [
    ("r-21", 63, 303, "HOE-3", "SHIPPED", 19.75, "USD", "web", "2025-11-05T17:10:00Z"),
    ("r-22", 66, 305, "BAT-5", "NEW", 50.00, "EUR", "partner", "2025-11-05T17:12:00Z"),
    ("r-23", 67, 302, None, "NEW", 12.00, "USD", "store", "2025-11-05T17:19:00Z"),
    ("r-24", 62, 302, "PAN-2", "CANCELLED", 31.00, "USD", "store", "2025-11-05T17:25:00Z"),
    ("r-25", 68, 777, "POT-1", "NEW", 84.25, "USD", "mobile", "2025-11-05T17:40:00Z"),
    ("r-26", 69, 306, "FIX-9", "PAID", 15.00, "USD", "web", "2025-11-05T17:41:00Z"),
]
RETAIL_CUSTOMERS = [(301 + k, f"Buyer {k}", f"{'Buyer' if k == 1 else 'buyer'}{k}@shop.test", country, region, f"2025-0{k + 1}-11", tier)
                    for k, (country, region, tier) in enumerate([("NO", "EMEA", "Gold"), ("JP", "APAC", "Silver"), ("CL", "LATAM", "Bronze"),
                                                                 ("NO", "EMEA", "Gold"), ("KE", "MEA", "Silver"), ("JP", "APAC", "Bronze")])]
RETAIL_PRODUCTS = [(product, f"Article {k}", kind, 12.5 * (k + 1)) for k, (product, kind) in enumerate(
    [("POT-1", "kitchen"), ("PAN-2", "kitchen"), ("HOE-3", "garden"), ("TUB-4", "kitchen"), ("BAT-5", "sport"), ("FIX-9", "repair")])]
RETAIL_RATES = [("USD", 1.00, "2025-11-05"), ("EUR", 1.25, "2025-11-05"), ("NOK", 0.1, "2025-11-05")]

WAREHOUSE_ORDERS = """order_id,customer_id,product_id,product_name,category,quantity,unit_price,total_amount,order_date,status
71,11,A1,Lamp,Light,2,10.50,21.00,2026-03-01,COMPLETED
72,12,A2,Bulb,Light,1,8.25,8.25,2026-03-01,COMPLETED
73,11,A4,Lantern,Light,1,95.75,95.75,2026-03-02,COMPLETED
74,11,A8,Torch,Light,1,40.00,40.00,2026-03-04,COMPLETED
75,16,A9,Ladder,Tools,1,310.00,310.00,2026-03-04,COMPLETED
76,11,B5,Hammer,Tools,2,50.00,100.00,2026-03-07,PENDING
77,13,B7,Nail,Parts,0,0.75,0.00,2026-03-08,CANCELLED
78,16,B1,Shelf,Tools,3,22.00,66.00,2026-03-09,COMPLETED
"""
WAREHOUSE_CUSTOMERS = """Customer_ID,Customer_Name,Email,City,Country,Signup_Date
11, tove lind ,Tove.Lind@post.test,Oslo,no,2024-04-02
12,Pia Kraft,pia@post.test,Graz,AT,2024-05-09
13,Ken Ito,ken@post.test,Nara,JP,2024-06-13
16,Ana Ruiz,ana@post.test,Quito,EC,2024-08-21
17,Jon Berg,,Bergen,NO,2024-09-30
20,Max Huber,max@post.test,Zürich,CH,2024-12-12
"""


def write_csv(path: Path, header: list[str], rows: list[tuple]) -> None:
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(header)
        writer.writerows(rows)


def write_json_lines(path: Path, rows: list[dict]) -> None:
    path.write_text("".join(json.dumps(row, sort_keys=True) + "\n" for row in rows), encoding="utf-8")


def order_events() -> list[dict]:
    return [{"specversion": "1.0", "id": i, "source": "/lab/orders", "time": t, "subject": f"order/{o}",
             "type": f"training.order.{status.lower()}.v1",
             "data": {"order_id": o, "customer_id": c, "product": p, "quantity": q, "unit_price": u, "status": status}}
            for i, o, c, p, q, u, status, t in ORDER_LINES]


def order_changes() -> list[dict]:
    return [{"event_id": e, "op": op, "order_id": o, "customer_id": c, "amount": a, "status": s, "order_ts": t,
             "source_lsn": lsn, "source": "orders-db", "table": "orders"} for e, op, o, c, a, s, t, lsn in ORDER_CHANGES]


def clicks() -> list[dict]:
    return [dict(zip(["event_id", "event_ts", "event_type", "order_id", "session_id", "user_id"], row)) for row in CLICKS]


def write_change_inputs(folder: Path) -> None:
    (folder / "orders_cdc.json").write_text(json.dumps(order_changes(), indent=2))
    (folder / "clickstream_events.json").write_text(json.dumps(clicks(), indent=2))
    write_csv(folder / "logistics_batch.csv", ["shipment_id", "order_id", "carrier", "status", "event_ts"], SHIPMENTS)
    write_csv(folder / "customers.csv", ["customer_id", "customer_name", "customer_tier", "region"], CUSTOMERS)
    (folder / "schema_change_proposals.json").write_text(json.dumps(
        [{"change": c, "classification": "x", "recommended_policy": p, "why": "y"} for c, p in PROPOSALS], indent=2))


def retail_rows(batch: list[tuple]) -> list[dict]:
    return [dict(zip(RETAIL_COLUMNS, row)) for row in batch]


def write_retail_inputs(folder: Path) -> None:
    write_json_lines(folder / "order_events_batch_1.jsonl", retail_rows(RETAIL_BATCH_1))
    second = retail_rows(RETAIL_BATCH_2)
    second[0] |= {"coupon_code": "MORE-5", "delivery_promise": "by friday"}
    write_json_lines(folder / "order_events_batch_2.jsonl", second)
    write_csv(folder / "customers.csv", ["customer_id", "customer_name", "email", "country", "region", "signup_date",
                                         "loyalty_tier"], RETAIL_CUSTOMERS)
    write_csv(folder / "products.csv", ["product_id", "product_name", "category", "unit_cost"], RETAIL_PRODUCTS)
    write_csv(folder / "fx_rates.csv", ["currency", "rate_to_usd", "as_of_date"], RETAIL_RATES)
