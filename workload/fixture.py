"""Orders with deterministic faults, derived from the supplied tables.

The supplied tables have no nulls, orphans or malformed values, so the checks run on ``dirty_orders``: one row per
line item with faults placed by key arithmetic, some rows repeated. ``clean_orders`` is the same without faults.
The frames read Parquet lazily; nothing is cached or collected.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Line items that one task joins and groups.
ROWS_PER_TASK = 1_000_000
AS_OF = "2026-02-01 00:00:00"
CATEGORIES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

ORDER_COLUMNS = [
    "order_id", "customer_id", "customer_name", "customer_email", "product_category", "product_name", "quantity",
    "unit_price", "total_amount", "order_date", "order_status", "payment_method", "shipping_city", "shipping_state",
    "customer_age", "day",
]

_PREPARED = {
    "day": "1 + l_orderkey % 30",
    "qty": "1 + l_partkey % 10",
    "h1": "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 1000",
    "h2": "(l_orderkey * 6101 + l_partkey * 1299709 + l_suppkey * 17) % 1000",
    "h3": "(l_orderkey * 3571 + l_partkey * 15485863 + l_suppkey * 101) % 1000",
    "clean_date": "'2026-01-' || lpad(CAST(1 + l_orderkey % 30 AS STRING), 2, '0') || ' ' "
    "|| lpad(CAST(l_partkey % 24 AS STRING), 2, '0') || ':00:00'",
    "clean_id": "'ORD' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "clean_age": "18 + o_custkey % 58",
}

_DIRTY = {
    "order_id": "clean_id",
    "customer_id": "CASE WHEN h3 < 20 + day THEN 'ORPHAN' || CAST(o_custkey AS STRING) "
    "ELSE 'CUST' || CAST(o_custkey AS STRING) END",
    "customer_name": "c_name",
    "customer_email": "CASE WHEN h1 < 120 + 4 * day THEN NULL WHEN h1 >= 980 THEN '' "
    "WHEN h2 < 50 + 2 * day THEN 'user' || CAST(o_custkey AS STRING) || '@domain' "
    "ELSE 'user' || CAST(o_custkey AS STRING) || '@email.com' END",
    "product_category": "CASE WHEN h2 >= 990 - day THEN 'MACHINERY' ELSE c_mktsegment END",
    "product_name": "p_name",
    "quantity": "CASE WHEN h3 >= 995 THEN CAST(999 AS BIGINT) ELSE qty END",
    "unit_price": "CASE WHEN h2 >= 920 - 3 * day THEN NULL WHEN h3 >= 992 AND h3 < 995 THEN CAST(999999 AS DOUBLE) "
    "ELSE p_retailprice END",
    "total_amount": "qty * p_retailprice",
    "order_date": "CASE WHEN h1 >= 960 AND h1 < 970 THEN '2027-06-15 12:00:00' "
    "WHEN h1 >= 970 AND h1 < 975 THEN 'not-a-date' ELSE clean_date END",
    "order_status": "o_orderstatus",
    "payment_method": "CASE WHEN h3 >= 960 AND h3 < 980 THEN NULL ELSE o_orderpriority END",
    "shipping_city": "CASE WHEN h2 >= 400 AND h2 < 450 THEN NULL ELSE n_name END",
    "shipping_state": "CASE WHEN h2 >= 450 AND h2 < 455 THEN 'ATLANTIS' ELSE r_name END",
    "customer_age": "CASE WHEN h3 >= 500 AND h3 < 530 THEN NULL WHEN h3 >= 530 AND h3 < 535 THEN CAST(-1 AS BIGINT) "
    "WHEN h3 >= 535 AND h3 < 540 THEN CAST(999 AS BIGINT) ELSE clean_age END",
    "day": "day",
}

_CLEAN = {
    "order_id": "clean_id",
    "customer_id": "'CUST' || CAST(o_custkey AS STRING)",
    "customer_name": "c_name",
    "customer_email": "'user' || CAST(o_custkey AS STRING) || '@email.com'",
    "product_category": "c_mktsegment",
    "product_name": "p_name",
    "quantity": "qty",
    "unit_price": "p_retailprice",
    "total_amount": "qty * p_retailprice",
    "order_date": "clean_date",
    "order_status": "o_orderstatus",
    "payment_method": "o_orderpriority",
    "shipping_city": "n_name",
    "shipping_state": "r_name",
    "customer_age": "clean_age",
    "day": "day",
}


def _projected(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select([F.expr(expression).alias(name) for name, expression in columns.items()])


@dataclass(frozen=True)
class Tables:
    """The supplied tables of one scale factor and the frames derived from them."""

    spark: SparkSession
    folder: str
    _frames: dict[str, DataFrame] = field(default_factory=dict)

    def read(self, name: str) -> DataFrame:
        """A supplied table; its files are listed once per query, its data is read when the query runs."""
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]

    def _line_items(self) -> DataFrame:
        """Line items; a file of fewer splits than there are cores is spread, as it would occupy few of them.

        A split or a merged shuffle partition of narrow rows may hold many millions of them, which the groupings above
        would all keep in one task. Such a table is dealt by order, as its join needs it, in tasks of a million rows.
        """
        if "spread lineitem" not in self._frames:
            items, cores = self.read("lineitem"), self.spark.sparkContext.defaultParallelism
            splits, tasks = items.rdd.getNumPartitions(), math.ceil(items.count() / ROWS_PER_TASK)
            if tasks > max(splits, cores):
                items = items.repartition(tasks, "l_orderkey")
            elif splits < cores:
                items = items.repartition(cores, "l_orderkey", "l_linenumber", "l_partkey")
            self._frames["spread lineitem"] = items
        return self._frames["spread lineitem"]

    def _base(self) -> DataFrame:
        """Line items joined to their order, customer and part; sides Spark finds small are broadcast by its own rule.

        Customers join the orders, of which there are fewer, so that line items are not dealt again by customer.
        """
        places = self.read("nation").join(self.read("region"), F.expr("n_regionkey = r_regionkey"))
        customers = self.read("customer").join(places, F.expr("c_nationkey = n_nationkey"))
        orders = self.read("orders").join(customers, F.expr("o_custkey = c_custkey"))
        joined = self._line_items().join(orders, F.expr("l_orderkey = o_orderkey")).join(self.read("part"), F.expr("l_partkey = p_partkey"))
        return joined.select("*", *[F.expr(expression).alias(name) for name, expression in _PREPARED.items()])

    def dirty_orders(self) -> DataFrame:
        """Faulty orders with ``day``. Repeats are emitted row by row, so the joins run once."""
        once = _projected(self._base(), _DIRTY | {"_copies": "CASE WHEN h1 < 30 + 2 * day THEN 2 ELSE 1 END"})
        repeated = once.select("*", F.explode(F.array_repeat(F.lit(1), F.col("_copies"))).alias("_copy"))
        return repeated.select(*ORDER_COLUMNS)

    def dirty_table(self) -> DataFrame:
        """The faulty orders without the snapshot column, as a whole table is checked."""
        return self.dirty_orders().drop("day")

    def clean_orders(self) -> DataFrame:
        return _projected(self._base(), _CLEAN)

    def clean_table(self) -> DataFrame:
        return self.clean_orders().drop("day")

    def customers_ref(self) -> DataFrame:
        return self.read("customer").selectExpr(
            "'CUST' || CAST(c_custkey AS STRING) AS customer_id", "c_name AS customer_name"
        )

    def city_state(self) -> DataFrame:
        places = self.read("nation").join(self.read("region"), F.expr("n_regionkey = r_regionkey"))
        return places.selectExpr("n_name AS key", "r_name AS value")

    def labelled_documents(self) -> DataFrame:
        return self.read("documents").join(self.read("labels"), "doc_id", "left")
