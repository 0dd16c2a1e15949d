"""Rows are accounted for from landing to fact; copies collapse before the state of a stream."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from marlstone.schemas import ENTITIES
from marlstone.sources.tables import TableStore
from marlstone.streaming.balance import balance, unplaced
from marlstone.streaming.bronze import refresh_bronze
from marlstone.streaming.refresh import run_medallion
from marlstone.streaming.silver import refresh_silver


def drop_file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


FILES = {
    "customers": "customer_id,customer_name,email,city,state,signup_date\nc1,Ann,a@x.example,t,tx,2024-01-01\n"
                 "c1,Ann,a@x.example,t,tx,2024-01-01\n,No,,x,y,2024-01-03\n",
    "products": "product_id,product_category,product_name,base_price,weight_grams\np1,Toys,Top,10,5\np2,Toys,Bad,-1,5\n",
    "sellers": "seller_id,seller_name,seller_city,seller_state\ns1,S,c,tx\ns1,S,c,tx\n",
    "orders": "order_id,customer_id,order_status,order_date,order_total\no1,c1,Paid,2024-01-15,30\no2,c1,paid,soon,1\n",
    "order_items": "order_id,item_seq,product_id,seller_id,quantity,unit_price\no1,1,p1,s1,2,10\no1,2,p2,s1,1,7.5\n"
                   "o2,1,p1,s1,1,4\no9,1,p1,s1,1,oops\n",
}


@pytest.fixture()
def store(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for entity, text in FILES.items():
        drop_file(f"{landing}/{entity}", "a.csv", text)
    drop_file(f"{landing}/payments", "a.json", json.dumps({"order_id": "o1", "payment_type": "boleto", "installments": [
        {"installment_no": i, "amount": 1.0, "paid": True} for i in range(3)]}) + "\n" + json.dumps({"order_id": "o2"}))
    drop_file(f"{landing}/reviews", "a.json", json.dumps({"review_id": "r1", "order_id": "o1", "score": 9}))
    # The same order once more, in a later batch.
    run_medallion(spark, landing, str(tmp_path / "tables"))
    drop_file(f"{landing}/orders", "b.csv", FILES["orders"].splitlines()[0] + "\no1,c1,Paid,2024-01-15,30\n")
    run_medallion(spark, landing, str(tmp_path / "tables"))
    return TableStore(spark, str(tmp_path / "tables"))


def test_all_rows_are_accounted_for(spark, store):
    rows = {r["entity"]: r for r in store.read("gold", "run_balance").collect()}
    assert all(r["adds_up"] for r in rows.values()) and set(rows) == {*ENTITIES, "fct_sales"}
    counts = {k: (r["arrived_rows"], r["duplicate_rows"], r["dropped_rows"], r["silver_rows"]) for k, r in rows.items()}
    assert counts == {
        "customers": (3, 1, 1, 1), "products": (2, 0, 1, 1), "sellers": (2, 1, 0, 1), "orders": (3, 1, 0, 2),
        "order_items": (4, 0, 0, 4), "payments": (3, 0, 0, 3), "reviews": (1, 0, 1, 0), "fct_sales": (4, 0, 1, 3)}
    assert rows["orders"]["landing_files"] == 2 and rows["order_items"]["rescued_rows"] == 1
    found = {r["missing"]: (r["lines"], float(r["revenue"])) for r in unplaced(store.read("gold", "fct_sales")).collect()}
    assert found == {"day": (1, 4.0), "product": (1, 7.5)}
    # A row that is there twice, or not at all, shows.
    store.append(store.read("silver", "slv_sellers"), "silver", "slv_sellers", 99)
    assert {r["entity"] for r in balance(store).where("not adds_up").collect()} == {"sellers"}


def test_copies_of_a_hot_key_reach_the_state_once_per_batch(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), TableStore(spark, str(tmp_path / "tables"))
    header = "order_id,customer_id,order_status,order_date,order_total\n"
    for name in "ab":
        drop_file(f"{landing}/orders", f"{name}.csv", header + f"hot,c1,paid,2024-01-0{2 if name == 'a' else 1},1\n" * 4000
                  + "".join(f"{name}{i},c1,paid,2024-01-01,1\n" for i in range(4000)))
        refresh_bronze(store, "orders", landing)
        assert refresh_silver(store, "orders")["rows_checked"] == (4001 if name == "a" else 4000)
    arrivals = store.read("silver", "slv_orders_arrivals").groupBy("order_id").count()
    assert arrivals.agg(F.max("count")).first()[0] == 2, "one row per key and batch"
    (kept,) = store.read("silver", "slv_orders").where("order_id = 'hot'").collect()
    assert kept["order_date"] == "2024-01-02", "the first arrival stays"


def test_the_rest_works_without_a_library_of_the_text_operators(tmp_path):
    drop_file(str(tmp_path), "xxhash.py", "raise ImportError('not here')\n")
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'op2_exact_dedup' in e.queries())"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": f"{tmp_path}:{root}"},
                           capture_output=True, text=True, check=True, timeout=120)
    n, sql, there = found.stdout.split()
    assert int(n) == int(sql) > 100 and there == "False"
