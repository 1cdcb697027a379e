"""Bakery-style star-schema queries (C1-C10) on the driver's tables.

Roles: receipts = ``orders``, items = ``lineitem``, goods = ``part``
(``p_type`` is the flavour, ``p_name`` the food, ``p_retailprice`` the
price), customers = ``customer`` (``c_name`` is the name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quarry.functions.clean import format_date
from quarry.operators import relational as rel
from quarry.sources import table

# The query parameters.
CHEAP_FLAVOR = "PROMO"
CHEAP_MAX_PRICE = 920
ONE_DAY = "1997-05-28"
REPEAT_FROM, REPEAT_TO = "1997-01-01", "1998-12-31"
CUSTOMER_NAME = "Customer#000000005"
PRODUCT_FOOD, PRODUCT_FLAVOR = "red widget", "ECONOMY"
MONTH_FLAVOR = "ECONOMY"
MONTH_FROM, MONTH_TO = "1997-10-01", "1997-10-31"
BUSY_FLAVOR = "PROMO"
BUSY_MIN_EXCLUSIVE = 10

PRICE = DecimalType(18, 2)


def cheap_items(spark: SparkSession, sf: str) -> DataFrame:
    """Goods of one flavour under a price, most expensive first."""
    part = table(spark, sf, "part")
    return rel.filter_sort_project(
        part,
        (F.col("p_type") == CHEAP_FLAVOR) & (F.col("p_retailprice") < CHEAP_MAX_PRICE),
        ["p_type", "p_name", "p_retailprice"],
        [F.col("p_retailprice").desc(), F.col("p_name")],
    )


def customers_on_day(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with an order on one day, by name."""
    return rel.semi_join_on_day(
        table(spark, sf, "customer"), table(spark, sf, "orders"),
        entity_key="c_custkey", event_key="o_custkey", event_day="o_orderdate", day=ONE_DAY,
        columns=["c_custkey", "c_name"], order_by=["c_name", "c_custkey"],
    )


def repeat_buyer_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days in 1997-1998 on which a customer name placed more than one order."""
    return rel.repeat_days(
        table(spark, sf, "orders"), table(spark, sf, "customer"),
        event_person="o_custkey", person_key="c_custkey", event_day="o_orderdate",
        name_cols=["c_name"], lo=REPEAT_FROM, hi=REPEAT_TO,
    )


def _order_days(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderdate").cast("date").alias("day"))


def days_customer_or_product(spark: SparkSession, sf: str) -> DataFrame:
    """Days on which one customer ordered, or one product was sold (any year)."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").filter(F.col("c_name") == CUSTOMER_NAME)
    by_customer = orders.join(customer.select(F.col("c_custkey").alias("o_custkey")),
                              on="o_custkey", how="left_semi")
    # chained SQL-string predicates (F4); Catalyst still pushes both into the scan
    product = table(spark, sf, "part").filter(f"p_name = '{PRODUCT_FOOD}'") \
        .filter(f"p_type = '{PRODUCT_FLAVOR}'")
    sold = table(spark, sf, "lineitem").join(
        product.select(F.col("p_partkey").alias("l_partkey")), on="l_partkey", how="left_semi")
    by_product = orders.join(sold.select(F.col("l_orderkey").alias("o_orderkey")),
                             on="o_orderkey", how="left_semi")
    days = rel.union_distinct(_order_days(by_customer), _order_days(by_product))
    return days.select("day", format_date("day").alias("day_text")).orderBy("day")


def _items_of_flavor(spark: SparkSession, sf: str, flavor: str) -> DataFrame:
    """lineitems whose part has the flavour, with the goods price."""
    part = table(spark, sf, "part").filter(F.col("p_type") == flavor) \
        .select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(part, on="l_partkey")


def revenue_in_month(spark: SparkSession, sf: str) -> DataFrame:
    """Total goods price of one flavour's items sold in October 1997.

    Items are joined to the month's orders (the selective side, one month of
    several years) before the goods lookup, so the price join sees only
    that month's items."""
    orders = table(spark, sf, "orders").filter(rel.day_between("o_orderdate", MONTH_FROM, MONTH_TO)) \
        .select(F.col("o_orderkey").alias("l_orderkey"))
    goods = table(spark, sf, "part").filter(F.col("p_type") == MONTH_FLAVOR) \
        .select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    items = rel.star_join(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey"),
                          [(orders, "l_orderkey"), (goods, "l_partkey")])
    return rel.total(items, "p_retailprice", "revenue")


def busy_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days with more than ten items of one flavour sold.

    Items are counted per order before the join with orders, so the join
    sees one row per order."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("day"))
    counted = rel.aggregate_through(_items_of_flavor(spark, sf, BUSY_FLAVOR), None,
                                    [("l_orderkey", orders, ["day"])], "n_items", min_exclusive=BUSY_MIN_EXCLUSIVE)
    return counted.select("day", format_date("day").alias("day_text"), "n_items").orderBy("day")


def spend_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Total goods price bought per customer name, biggest spender first.

    Four-way inner join orders-lineitem-part-customer, summed per name.
    Eager aggregation: the price is summed per order, then per customer
    key, before the name lookup; sums stay exact decimals until the end.
    """
    goods = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"),
                                           F.col("p_retailprice").cast(PRICE).alias("price"))
    sold = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(goods, on="l_partkey")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                              F.col("o_custkey").alias("c_custkey"))
    per_name = rel.aggregate_through(sold, "price", [("l_orderkey", orders, ["c_custkey"]),
                                                     ("c_custkey", table(spark, sf, "customer"), ["c_name"])], "total_spent")
    return per_name.withColumn("total_spent", F.col("total_spent").cast("double")) \
        .orderBy(F.col("total_spent").desc(), "c_name")


def most_popular_product(spark: SparkSession, sf: str) -> DataFrame:
    """The (food, flavour) with the most items sold; ties by name.

    Items are counted per part key before the join with part."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    counted = rel.aggregate_through(table(spark, sf, "lineitem"), None,
                                    [("l_partkey", parts, ["p_name", "p_type"])], "num_sold")
    return rel.top_n(counted, [F.col("num_sold").desc(), F.col("p_name"), F.col("p_type")], 1)


QUERIES = {
    "cheap_items": cheap_items,
    "customers_on_day": customers_on_day,
    "repeat_buyer_days": repeat_buyer_days,
    "days_customer_or_product": days_customer_or_product,
    "revenue_in_month": revenue_in_month,
    "busy_days": busy_days,
    "spend_per_customer": spend_per_customer,
    "most_popular_product": most_popular_product,
}

ORACLE = {
    "cheap_items": """
        SELECT p_type, p_name, p_retailprice FROM part
        WHERE p_type = 'PROMO' AND p_retailprice < 920""",
    "customers_on_day": """
        SELECT c_custkey, c_name FROM customer
        WHERE c_custkey IN (SELECT o_custkey FROM orders
                            WHERE CAST(o_orderdate AS DATE) = DATE '1997-05-28')""",
    "repeat_buyer_days": """
        SELECT DISTINCT d AS day, strftime(d, '%d-%b-%Y') AS day_text FROM (
            SELECT CAST(o.o_orderdate AS DATE) AS d, c.c_name
            FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
            WHERE o.o_orderdate >= TIMESTAMP '1997-01-01' AND o.o_orderdate < TIMESTAMP '1999-01-01'
            GROUP BY 1, 2 HAVING COUNT(*) > 1) t""",
    "days_customer_or_product": """
        SELECT d AS day, strftime(d, '%d-%b-%Y') AS day_text FROM (
            SELECT CAST(o.o_orderdate AS DATE) AS d
            FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
            WHERE c.c_name = 'Customer#000000005'
            UNION
            SELECT CAST(o.o_orderdate AS DATE) AS d
            FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
            JOIN part p ON p.p_partkey = l.l_partkey
            WHERE p.p_name = 'red widget' AND p.p_type = 'ECONOMY') t""",
    "revenue_in_month": """
        SELECT CAST(SUM(CAST(p.p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        JOIN part p ON p.p_partkey = l.l_partkey
        WHERE p.p_type = 'ECONOMY'
          AND o.o_orderdate >= TIMESTAMP '1997-10-01' AND o.o_orderdate < TIMESTAMP '1997-11-01'""",
    "busy_days": """
        SELECT CAST(o.o_orderdate AS DATE) AS day,
               strftime(CAST(o.o_orderdate AS DATE), '%d-%b-%Y') AS day_text,
               COUNT(*) AS n_items
        FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        JOIN part p ON p.p_partkey = l.l_partkey
        WHERE p.p_type = 'PROMO'
        GROUP BY 1, 2 HAVING COUNT(*) > 10""",
    "spend_per_customer": """
        SELECT c.c_name, CAST(SUM(CAST(p.p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
        FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        JOIN part p ON p.p_partkey = l.l_partkey
        JOIN customer c ON c.c_custkey = o.o_custkey
        GROUP BY c.c_name""",
    "most_popular_product": """
        SELECT p.p_name, p.p_type, COUNT(*) AS num_sold
        FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey
        GROUP BY 1, 2 ORDER BY num_sold DESC, p_name, p_type LIMIT 1""",
}
