"""Raw retail entities derived from the test tables.

Every entity is computed by row expressions over whole tables.  Defects the
cleansing and the rules must handle (padding, mixed case, messy dates, missing and
invalid values, repeated delivery) are placed by arithmetic on the keys, so the
expected results can be written as SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.keys import surrogate_key
from marlstone.functions.timestamps import MESSY_FORMATS
from marlstone.operators.dedup import latest_by_key
from marlstone.operators.history import END, START
from marlstone.operators.quality import RULES, apply_rules
from marlstone.plans import dimensions, facts
from marlstone.plans.silver import CLEANERS
from marlstone.session import configure, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messy_date(moment: str, number: str) -> Column:
    """The moment written in the layout picked by a number."""
    layouts = F.array(*[F.lit(layout) for layout in MESSY_FORMATS])
    picked = F.pmod(F.col(number), F.lit(len(MESSY_FORMATS))).cast("int") + 1
    return F.call_function("date_format", F.col(moment), F.element_at(layouts, picked))


def _delivered_again(df: DataFrame, condition: str) -> DataFrame:
    """Rows meeting the condition arrive twice."""
    times = F.expr(f"sequence(1, if({condition}, 2, 1))")
    return df.withColumn("_time", F.explode(times)).drop("_time")


_STATE = "concat(' ', element_at(array('tx', 'ca', 'ny', 'fl', 'oh'), cast({0} % 5 + 1 as int)), ' ')"


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups from ``customer``; later moves of a customer from ``orders``."""
    person = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "if(c_custkey % 499 = 0, null, cast(c_custkey as string)) as customer_id",
        "c_name as customer_name",
        "case when c_custkey % 17 = 0 then null when c_custkey % 19 = 0 then c_name "
        "when c_custkey % 23 = 0 then concat('c', c_custkey, '@mail') "
        "else concat(' c', c_custkey, '@shop', c_nationkey, '.example ') end as email",
        "c_nationkey",
    )
    signup = person.withColumn(
        "_day", F.expr("cast(date_add(date'1994-01-01', cast(c_custkey % 300 as int)) as timestamp)")
    ).select(
        "customer_id", "customer_name", "email",
        F.expr("concat('  port nation_', c_nationkey, ' ')").alias("city"),
        F.expr(_STATE.format("c_nationkey")).alias("state"),
        F.when(F.col("c_custkey") % 211 == 0, "n/a").otherwise(messy_date("_day", "c_custkey"))
        .alias("signup_date"),
    )
    moves = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    moved = moves.join(person, F.col("o_custkey") == F.col("c_custkey")).select(
        "customer_id", "customer_name", "email",
        F.expr("concat('NEW ', 'town_', o_orderkey % 50)").alias("city"),
        F.expr(_STATE.format("o_orderkey")).alias("state"),
        messy_date("o_orderdate", "o_orderkey").alias("signup_date"),
    )
    return signup.unionByName(moved)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "if(p_partkey % 1999 = 0, null, cast(p_partkey as string)) as product_id",
        "concat('  ', p_type, ' ') as product_category",
        "concat(' ', p_name, ' ') as product_name",
        "case when p_partkey % 29 = 0 then -p_retailprice when p_partkey % 31 = 0 then 0D "
        "when p_partkey % 37 = 0 then null else p_retailprice end as base_price",
        "if(p_partkey % 19 = 0, null, p_size * 10) as weight_grams",
    )
    return _delivered_again(products, "p_partkey % 40 = 0").drop("p_partkey")


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sellers = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).selectExpr(
        "s_suppkey",
        "if(s_suppkey % 91 = 0, null, cast(s_suppkey as string)) as seller_id",
        "if(s_suppkey % 13 = 0, null, concat(' ', s_name)) as seller_name",
        "concat(' old ', lower(n_name), '  ') as seller_city",
        _STATE.format("s_nationkey") + " as seller_state",
    )
    return _delivered_again(sellers, "s_suppkey % 10 = 0").drop("s_suppkey")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("if(o_orderkey % 997 = 0, null, cast(o_orderkey as string))").alias("order_id"),
        F.expr("if(o_orderkey % 97 = 0, null, cast(o_custkey as string))").alias("customer_id"),
        F.expr(
            "case when o_orderkey % 101 = 0 then 'On Hold' "
            "when o_orderstatus = 'P' then ' Shipped' "
            "when o_orderstatus = 'O' and o_orderkey % 2 = 0 then 'PLACED ' "
            "when o_orderstatus = 'O' then ' paid ' "
            "when o_orderkey % 5 = 0 then 'Returned' when o_orderkey % 5 = 1 then 'CANCELED' "
            "else ' Delivered' end"
        ).alias("order_status"),
        F.when(F.col("o_orderkey") % 103 == 0, "soon")
        .when(F.col("o_orderkey") % 107 == 0, F.lit(None).cast("string"))
        .otherwise(messy_date("o_orderdate", "o_orderkey")).alias("order_date"),
        F.expr(
            "case when o_orderkey % 109 = 0 then -o_totalprice "
            "when o_orderkey % 113 = 0 then null else o_totalprice end"
        ).alias("order_total"),
    )
    return _delivered_again(orders, "o_orderkey % 50 = 0").drop("o_orderkey")


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` repeats many (order, line) pairs by itself."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) as order_id",
        "if(l_partkey % 499 = 0, null, l_linenumber) as item_seq",
        "if((l_suppkey * 7 + l_linenumber) % 89 = 0, null, cast(l_partkey as string)) as product_id",
        "if(l_partkey % 307 = 0, null, cast(l_suppkey as string)) as seller_id",
        "if(l_partkey % 211 = 0, 0, cast(l_quantity as int)) as quantity",
        "case when l_suppkey % 37 = 0 then null else if(l_partkey % 223 = 0, -1, 1) * "
        "cast(cast(l_extendedprice / l_quantity as decimal(18,8)) as decimal(12,2)) end as unit_price",
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "if(o_orderkey % 997 = 0, null, cast(o_orderkey as string)) as order_id",
        "element_at(array('credit_card', 'debit_card', 'voucher', 'boleto', 'gift_card'), "
        "cast(o_orderkey % 5 + 1 as int)) as payment_type",
        "case when o_orderkey % 7 = 0 then null "
        "when o_orderkey % 4 = 0 then cast(array() as "
        "array<struct<installment_no: bigint, amount: double, paid: boolean>>) "
        "else transform(sequence(1L, o_orderkey % 4), i -> struct(i as installment_no, "
        "if(o_orderkey % 61 = 0, -o_totalprice, o_totalprice) / (o_orderkey % 4) as amount, "
        "i <= 2 as paid)) end as installments",
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(
        "_k", F.from_json("props", "k int").getField("k")
    ).select(
        F.expr("if(event_id % 401 = 0, null, cast(event_id as string))").alias("review_id"),
        F.expr("if(event_id % 397 = 0, null, cast(user_id as string))").alias("order_id"),
        F.expr("cast(_k % 7 as bigint)").alias("score"),
        F.expr("if(event_type = 'error', null, concat('  ', event_type, ' '))").alias("comment"),
        messy_date("ts", "event_id").alias("review_date"),
        F.expr(
            "if(event_id % 50 = 0, null, named_struct('verified', event_type = 'purchase', "
            "'helpful_votes', cast(floor(value) as bigint)))"
        ).alias("meta"),
    )


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": raw_customers,
    "products": raw_products,
    "sellers": raw_sellers,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "payments": raw_payments,
    "reviews": raw_reviews,
}


class Shop:
    """The data model over one set of test tables, built lazily."""

    # Calendar bounds that hold every order date of the test tables.
    FIRST_DAY, LAST_DAY = "1994-01-01", "2003-12-31"

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir
        self._written: dict[str, DataFrame] = {}

    def written(self, name: str, df: DataFrame, *more: DataFrame) -> DataFrame:
        """The rows, of several frames one after the other, as a table in the shared folder, for plans that read them repeatedly."""
        if name not in self._written:
            path = scratch_path(self.spark, name)
            df.write.parquet(path)
            for part in more:
                part.write.mode("append").parquet(path)
            self._written[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._written[name]

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def raw(self, entity: str) -> DataFrame:
        return RAW[entity](self.spark, self.sf_dir)

    def cleaned(self, entity: str) -> DataFrame:
        """Cleaned and deduplicated, before rules drop anything."""
        return CLEANERS[entity](self.raw(entity))

    def silver(self, entity: str) -> DataFrame:
        return apply_rules(self.cleaned(entity), RULES[entity])

    def dates(self) -> DataFrame:
        return dimensions.dim_date(self.spark, self.FIRST_DAY, self.LAST_DAY)

    def products(self) -> DataFrame:
        return dimensions.dim_product(self.silver("products"))

    def sellers(self) -> DataFrame:
        return dimensions.dim_seller(self.silver("sellers"))

    def change_log(self) -> DataFrame:
        return self.written("slv_customers", self.silver("customers"))

    def customer_history(self) -> DataFrame:
        return dimensions.dim_customer(self.change_log())

    def customers(self) -> DataFrame:
        return dimensions.dim_customer_keyed(self.customer_history())

    def _latest(self, *columns: str) -> DataFrame:
        """Newest row per customer; silver has one row per customer and time already."""
        log = self.silver("customers").select("customer_id", "signup_ts", *columns)
        return latest_by_key(log, ["customer_id"], "signup_ts").where(F.col("signup_ts").isNotNull())

    def current_customers(self) -> DataFrame:
        """The current rows of ``customers`` without building the history."""
        current = self._latest("customer_name", "email", "city", "state")
        return dimensions.dim_customer_keyed(
            current.withColumns({START: F.col("signup_ts"), END: F.lit(None).cast("timestamp")})
        )

    def _current_keys(self) -> DataFrame:
        return self._latest().select(
            surrogate_key("customer_id", "signup_ts").alias("customer_sk"),
            "customer_id", F.lit(True).alias("is_current"),
        )

    def fact(self, customer_as_of: str = "current") -> DataFrame:
        customers = self.customers() if customer_as_of == "event" else self._current_keys()
        return facts.fct_sales(
            self.silver("order_items"), self.silver("orders"), customers,
            self.products(), self.sellers(), self.dates(), customer_as_of,
        )

    def written_fact(self) -> DataFrame:
        return self.written("fct_sales", self.fact())
