"""Large work is cut by key; files that are not needed any more, or are larger than they have to be, are not kept."""

import glob
import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marlstone.operators import slices
from marlstone.operators.history import scd2_versions
from marlstone.schemas import ENTITIES
from marlstone.session import freeing_shuffles
from marlstone.sources.tables import TableStore
from marlstone.streaming import refresh
from marlstone.streaming.balance import balance
from marlstone.streaming.bronze import refresh_bronze
from marlstone.streaming.history import refresh_history
from marlstone.streaming.silver import refresh_silver
from marlstone.workload import queries
from marlstone.workload.standins import Shop

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def in_slices(monkeypatch, number, *modules):
    """The steps of these modules are cut, whatever their size."""
    for module in modules:
        monkeypatch.setattr(f"marlstone.{module}.slices_for", lambda stored: number)


def test_slices_are_disjoint_and_whole_with_null_keys(spark):
    rows = spark.range(100).select(F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("k"), "id")
    cut = [slices.slice_of(rows, ["k"], n, 3) for n in range(3)]
    found = [{r.k for r in part.collect()} for part in cut]
    assert sum(part.count() for part in cut) == 100 and None in set().union(*found)
    assert all(not a & b for i, a in enumerate(found) for b in found[:i])
    assert [slices.slices_for(n) for n in (0, slices.SLICE_BYTES, slices.SLICE_BYTES + 1)] == [1, 1, 2]


def test_shuffle_files_leave_with_their_execution(spark, tmp_path):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def held():
        return {f for at in folders for f in glob.glob(f"{at}/*/shuffle_*.data")}

    before = held()
    with freeing_shuffles(spark):
        assert spark.conf.get(CLEANUP) == "true"
        rows = spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 10).alias("k")).count()
        rows.write.parquet(str(tmp_path / "rows"))
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.2)
    assert not held() - before and spark.conf.get(CLEANUP) == "false"
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 10


def test_a_run_frees_its_shuffles(spark, tmp_path, monkeypatch):
    store, seen = TableStore(spark, str(tmp_path)), []
    store.publish(spark.range(2), "gold", "dim_customer_quarantine")
    for step in ("refresh_bronze", "refresh_silver", "refresh_gold"):
        monkeypatch.setattr(refresh, step, lambda *_: seen.append(spark.conf.get(CLEANUP)))
    refresh.run_medallion(spark, "nowhere", str(tmp_path))
    assert seen == ["true"] * (2 * len(ENTITIES) + 1) and spark.conf.get(CLEANUP) == "false"


def test_slices_of_a_view_become_visible_together(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.publish(spark.range(3), "gold", "v")
    broken = spark.range(1).select(F.raise_error(F.lit("stopped")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stopped"):
        store.publish([spark.range(2), broken], "gold", "v")
    assert glob.glob(f"{tmp_path}/gold/v/v=2/*.parquet") and store.finished_version("gold", "v") == 1
    assert store.read("gold", "v").count() == 3
    assert store.publish([spark.range(2), spark.range(2, 5), spark.range(5, 6)], "gold", "v") == 3
    assert sorted(r.id for r in store.read("gold", "v").collect()) == list(range(6))


def test_stored_tables_are_packed(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    os.makedirs(tmp_path / "landing/sellers")
    (tmp_path / "landing/sellers/a.csv").write_text("seller_id,seller_name,seller_city,seller_state\ns1,n,c,s\n,n,c,s\n")
    refresh_bronze(store, "sellers", str(tmp_path / "landing"))
    refresh_silver(store, "sellers")
    store.publish(store.read("silver", "slv_sellers"), "gold", "dim_seller")
    written = glob.glob(f"{tmp_path}/tables/**/*.parquet", recursive=True)
    data = [f for f in written if "/dq/" not in f]
    assert len(data) >= 5 and all(f.endswith(".zstd.parquet") for f in data)


def test_packed_landing_files_give_the_same_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "PACKED_ROWS", 10)
    rows = spark.range(0, 45, 1, 1).selectExpr(
        "if(id % 9 = 0, null, concat('s', id)) as seller_id", "concat(' \"n\", ', id) as seller_name",
        "if(id % 5 = 0, '', ' c ') as seller_city", "'x' as seller_state")
    reviews = spark.range(0, 25, 1, 1).selectExpr(
        "cast(id as string) as review_id", "'o' as order_id", "id % 5 as score", "if(id % 2 = 0, null, 'c') as comment",
        "'2024-01-02' as review_date", "if(id % 3 = 0, null, named_struct('verified', true, 'helpful_votes', id)) as meta")
    found = {}
    for compression in ("none", "gzip"):
        root, store = str(tmp_path / compression), TableStore(spark, str(tmp_path / f"{compression}-tables"))
        for entity, df in (("sellers", rows), ("reviews", reviews)):
            queries._land(None, entity, root, df, compression)
            refresh_bronze(store, entity, root)
            table = store.read("bronze", ENTITIES[entity].bronze)
            found[compression, entity] = table.select(*ENTITIES[entity].schema.names, "_rescued_data")
    names = os.listdir(tmp_path / "gzip/sellers")
    assert sum(n.endswith(".csv.gz") for n in names) == 5 and not any(n.endswith(".csv") for n in names)
    assert found["gzip", "sellers"].count() == 45 and found["gzip", "reviews"].count() == 25
    assert all(same(found["none", e], found["gzip", e]) for e in ("sellers", "reviews"))


def test_a_run_over_the_test_tables_lands_packed_files(spark, tmp_path, monkeypatch):
    landed = []
    monkeypatch.setattr(Shop, "raw", lambda self, entity: spark.createDataFrame([], ENTITIES[entity].schema))
    monkeypatch.setattr(refresh, "run_medallion", lambda spark, landing, tables: landed.append(landing))
    monkeypatch.setattr(queries, "_RUNS", {})
    queries._medallion(Shop(spark, str(tmp_path)))
    files = [f for f in glob.glob(f"{landed[0]}/*/*") if not f.endswith("_SUCCESS")]
    assert len(files) == len(ENTITIES) and all(f.endswith(".gz") for f in files)


def test_copies_collapse_in_slices_and_commit_as_one_batch(spark, tmp_path, monkeypatch):
    in_slices(monkeypatch, 3, "streaming.silver")
    landing, store = str(tmp_path / "landing"), TableStore(spark, str(tmp_path / "tables"))
    header = "order_id,item_seq,product_id,seller_id,quantity,unit_price\n"
    os.makedirs(f"{landing}/order_items")
    for name, price in (("a", 2), ("b", 1)):
        lines = "".join(f"o{i % 40},{i % 2},p,s,1,{price}\n" for i in range(200)) + f",1,p,s,1,{price}\n"
        with open(f"{landing}/order_items/{name}.csv", "w") as f:
            f.write(header + lines + (f"new,1,p,s,1,{price}\n" if name == "b" else ""))
        frames = []
        append = TableStore.append
        with monkeypatch.context() as spied:
            spied.setattr(TableStore, "append", lambda self, df, *at: (
                frames.append(1 if not isinstance(df, list) else len(df)), append(self, df, *at))[1])
            refresh_bronze(store, "order_items", landing)
            refresh_silver(store, "order_items")
        assert frames == [3]
    arrivals = store.read("silver", "slv_order_items_arrivals")
    assert store.commit_log("silver", "slv_order_items_arrivals").last() == 1 and arrivals.count() == 41 + 42
    silver = store.read("silver", "slv_order_items")
    assert silver.count() == 41 and {(r.order_id, r.unit_price) for r in silver.collect()} == {
        *((f"o{i}", 2.0) for i in range(40)), ("new", 1.0)}


@pytest.mark.parametrize("track", [None, ["v"]])
def test_a_history_in_slices_equals_one_in_a_piece(spark, tmp_path, monkeypatch, track):
    in_slices(monkeypatch, 3, "streaming.history")
    store = TableStore(spark, str(tmp_path))
    store.open_stream_version("silver", "log")
    day = datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [(None if i % 13 == 0 else i % 30, None if i % 17 == 0 else day + timedelta(i * 7 % 50), i % 3) for i in range(300)],
        "k int, at timestamp, v int")
    store.store_schema("silver", "log", log.schema)
    buckets_read = []
    read_parts = TableStore.read_parts
    monkeypatch.setattr(TableStore, "read_parts", lambda self, layer, table, kind, schema, some=None: (
        buckets_read.append(len(some)) if some else None, read_parts(self, layer, table, kind, schema, some))[1])
    for n in range(2):
        store.append(log.where(F.pmod(F.xxhash64("k", "at", "v"), F.lit(2)) == n), "silver", "log", n)
        refresh_history(store, ("silver", "log"), ("gold", "history"), ["k"], "at", track, buckets=8)
    assert len(buckets_read) == 6 and max(buckets_read) <= 3
    assert same(store.read("gold", "history"), scd2_versions(log, ["k"], "at", track))


FILES = {
    "customers": "customer_id,customer_name,email,city,state,signup_date\n" + "".join(
        f"c{i % 9},Ann,a@x.example,t,tx,2024-01-{1 + i % 20:02d}\n" for i in range(60)) + ",No,,x,y,2024-01-03\n",
    "products": "product_id,product_category,product_name,base_price,weight_grams\n" + "".join(
        f"p{i},Toys,Top,{10 - i},5\n" for i in range(12)),
    "sellers": "seller_id,seller_name,seller_city,seller_state\ns1,S,c,tx\ns1,S,c,tx\n",
    "orders": "order_id,customer_id,order_status,order_date,order_total\n" + "".join(
        f"o{i % 25},c{i % 11},Paid,2024-01-{1 + i % 20:02d},30\n" for i in range(30)) + "o99,c1,paid,soon,1\n",
    "order_items": "order_id,item_seq,product_id,seller_id,quantity,unit_price\n" + "".join(
        f"o{i % 27},{i % 4},p{i % 14},s{i % 2},{i % 5},{i}\n" for i in range(150)) + ",1,p1,s1,1,1\no99,,p1,s1,1,1\no99,2,p1,s1,1,3\n",
}


def test_a_run_in_slices_gives_the_same_tables(spark, tmp_path, monkeypatch):
    landing = str(tmp_path / "landing")
    for entity, text in FILES.items():
        os.makedirs(f"{landing}/{entity}")
        (tmp_path / "landing" / entity / "a.csv").write_text(text)
    for entity, row in (("payments", {"order_id": "o1", "payment_type": "boleto", "installments": [
            {"installment_no": 1, "amount": 1.0, "paid": True}]}), ("reviews", {"review_id": "r1", "order_id": "o1", "score": 4})):
        os.makedirs(f"{landing}/{entity}")
        (tmp_path / "landing" / entity / "a.json").write_text(json.dumps(row))
    refresh.run_medallion(spark, landing, str(tmp_path / "whole"))
    in_slices(monkeypatch, 3, *(f"streaming.{m}" for m in ("silver", "history", "balance", "refresh")), "workload.queries")
    monkeypatch.setattr(refresh, "LARGE_SILVER", 0)
    counts = refresh.run_medallion(spark, landing, str(tmp_path / "cut"))
    whole, cut = (TableStore(spark, str(tmp_path / name)) for name in ("whole", "cut"))
    assert counts["order_items"]["valid_order_ref"] == 1
    tables = sorted(os.listdir(tmp_path / "whole/gold"))
    assert "fct_sales" in tables and "run_balance" in tables and tables == sorted(os.listdir(tmp_path / "cut/gold"))
    for table in tables:
        assert same(whole.read("gold", table), cut.read("gold", table)), table
    assert cut.read("gold", "run_balance").where("not adds_up").isEmpty() and cut.read("gold", "fct_sales").count() > 50
    # The balance is counted piece by piece: what is left is no job over the tables.
    assert "FileScan" not in balance(cut)._jdf.queryExecution().toString()
    # The query that names the keys of a large fact writes it slice by slice.
    monkeypatch.setattr(queries, "_medallion", lambda shop: cut)
    shop = Shop(spark, str(tmp_path))
    named = queries.medallion_fct_sales(shop)
    assert same(named, queries._named_fact(whole, whole.read("gold", "fct_sales")))
    assert named.count() == whole.read("gold", "fct_sales").count() and "medallion_fct_sales" in shop._written
