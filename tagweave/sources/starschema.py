"""The logical tables as views over a retail star schema.

customer, orders, lineitem, part and events stand in for users, orders, goods
and logs. Each view is a plain projection or join: a query that needs no login
time or coupon value does not pay for them, since Catalyst removes the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tagweave.sources.schemas import MONEY
from tagweave.sources.tables import FileTables

# Days the ages are counted to: one past the last order, one past the last visit.
ORDERS_AS_OF = "2001-08-02"
LOGS_AS_OF = "2024-01-31"
# Line discounts from here on count as coupons.
COUPON_DISCOUNT = 0.10
PRODUCT_EVENTS = ("click", "view", "purchase")


# Declared, so that no job reads file footers to infer them.
BASE = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, "
                "l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def _epoch(moment: Column) -> Column:
    # Between two zoneless moments, so the session time zone plays no part.
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), moment)


class StarSchema:
    """``read(name)`` of tbl_users, tbl_orders, tbl_logs or tbl_goods."""

    def __init__(self, spark: SparkSession, folder: str):
        self._files = FileTables(spark, folder, suffix=".parquet")
        self._views = {"tbl_users": self.users, "tbl_orders": self.orders,
                       "tbl_logs": self.logs, "tbl_goods": self.goods}

    def read(self, name: str) -> DataFrame:
        return self._views[name]()

    def base(self, name: str) -> DataFrame:
        return self._files.read(name, BASE[name])

    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        logins = (self.base("orders").groupBy(F.col("o_custkey").alias("c_custkey"))
                  .agg(F.max("o_orderdate").alias("last_order")))
        born = F.date_add(F.lit("1950-01-01").cast("date"),
                          (key * 7919 % 25000).cast("int"))
        return self.base("customer").join(logins, "c_custkey", "left").select(
            key.alias("id"),
            (key % 3).cast("string").alias("gender"),
            F.col("c_mktsegment").alias("job"),
            (key % 4).cast("string").alias("politicalFace"),
            (key % 5).cast("string").alias("marriage"),
            F.col("c_nationkey").cast("string").alias("nationality"),
            F.when(F.col("c_acctbal") < 0, "1").otherwise("0").alias("is_blackList"),
            F.date_format(born, "yyyy-MM-dd").alias("birthday"),
            _epoch(F.col("last_order")).alias("lastLoginTime"))

    def orders(self) -> DataFrame:
        price = F.col("l_extendedprice").cast(MONEY)
        discount = F.col("l_discount").cast("decimal(4,2)")
        coupons = (self.base("lineitem").filter(F.col("l_discount") >= COUPON_DISCOUNT)
                   .groupBy(F.col("l_orderkey").alias("o_orderkey"))
                   .agg(F.sum(price * discount).cast(MONEY).alias("coupon")))
        status = F.col("o_orderstatus")
        return self.base("orders").join(coupons, "o_orderkey", "left").select(
            F.col("o_custkey").alias("memberId"),
            F.col("o_orderkey").cast("string").alias("orderSn"),
            F.col("o_totalprice").cast(MONEY).alias("orderAmount"),
            F.coalesce(F.col("coupon"), F.lit(0).cast(MONEY)).alias("couponCodeValue"),
            F.when(status == "F", 0).when(status == "O", 1).when(status == "P", 2)
            .alias("orderStatus"),
            F.col("o_orderpriority").alias("paymentCode"),
            _epoch(F.col("o_orderdate")).alias("finishTime"))

    def logs(self) -> DataFrame:
        kind = F.col("event_type")
        product = F.concat(F.lit("https://shop.example/product/"),
                           F.get_json_object("props", "$.k"), F.lit(".html?t="), kind)
        return self.base("events").select(
            F.col("user_id").alias("global_user_id"),
            F.when(kind.isin(*PRODUCT_EVENTS), product)
            .otherwise(F.concat(F.lit("https://shop.example/"), kind)).alias("loc_url"),
            F.col("ts").alias("log_time"))

    def goods(self) -> DataFrame:
        parts = self.base("part").select(F.col("p_partkey").alias("l_partkey"),
                                         "p_brand", "p_type")
        return self.base("lineitem").join(parts, "l_partkey").select(
            F.col("l_orderkey").cast("string").alias("cOrderSn"),
            F.col("p_brand").alias("ogColor"),
            F.col("p_type").alias("productType"))

    def products(self) -> DataFrame:
        """(productId, productName) of the goods."""
        return self.base("part").select(F.col("p_partkey").cast("int").alias("productId"),
                                        F.col("p_name").alias("productName"))
