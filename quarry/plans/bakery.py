"""The bakery queries (C1-C10) on the original file layout.

Four CSV files with a header row: ``customers.csv`` (Id, LastName,
FirstName), ``goods.csv`` (Id, Flavor, Food, Price), ``reciepts.csv``
(RecieptNumber, Date, CustomerId) and ``items.csv`` (Reciept, Ordinal, Item).
Text values are wrapped in single quotes, some header names and ids carry a
leading blank, dates look like ``3-Oct-2007``.  :func:`load` cleans them
into typed frames; the query functions are the library's operators with
the original parameters, each returning a lazy DataFrame.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import clean
from quarry.operators import relational as rel
from quarry.sources import read_csv

# The parameters of the original queries.
CHEAP_FLAVOR, CHEAP_MAX_PRICE = "Chocolate", 5
ONE_DAY = dt.date(2007, 10, 3)
REPEAT_FROM, REPEAT_TO = dt.date(2007, 10, 1), dt.date(2007, 10, 15)
CUSTOMER_LAST, CUSTOMER_FIRST = "DOMKOWSKI", "ALMETA"
PRODUCT_FOOD, PRODUCT_FLAVOR = "Cookie", "Gongolais"
MONTH_FOOD = "Cookie"
MONTH_FROM, MONTH_TO = dt.date(2007, 10, 1), dt.date(2007, 10, 31)
BUSY_FOOD, BUSY_MIN_EXCLUSIVE = "Tart", 10


@dataclass
class Bakery:
    customers: DataFrame   # CId int, LastName, FirstName
    goods: DataFrame       # GId, Flavor, Food, Price double
    receipts: DataFrame    # Reciept int, Date date, CId int
    items: DataFrame       # Reciept int, Ordinal int, GId
    rejects: DataFrame | None = None  # lenient load: (file, line) of the rows left out


def load(spark: SparkSession, base: str, strict: bool = True) -> Bakery:
    """Read and clean the four files under ``base``.  A value that does not
    parse fails the job; with ``strict=False`` its row is left out of its
    frame and listed in ``rejects``."""
    rejected: list[DataFrame] = []

    def cleaned(name: str, cols: str, **typed: Column) -> DataFrame:
        names = cols.split()
        raw = read_csv(spark, os.path.join(base, name), schema=", ".join(f"{c} string" for c in names))
        line = F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("line")
        out = raw.select(*[c.alias(n) for n, c in typed.items()], line)
        good, bad = clean.split_bad_rows(out, typed)
        if strict:  # a missing value is as bad as one that does not parse
            ok = F.lit(True)
            for n in typed:
                ok = ok & F.col(n).isNotNull()
            fail = F.raise_error(F.concat(F.lit(f"{name}: bad row "), F.col("line")))
            first = next(iter(typed))
            kind = out.schema[first].dataType
            return out.select(F.when(ok, F.col(first)).otherwise(fail.cast(kind)).alias(first),
                              *[n for n in typed if n != first])
        rejected.append(bad.select(F.lit(name).alias("file"), "line"))
        return good.drop("line")

    customers = cleaned("customers.csv", "id last first", CId=clean.to_int("id"),
                        LastName=clean.unquote("last"), FirstName=clean.unquote("first"))
    goods = cleaned("goods.csv", "id flavor food price", GId=clean.unquote("id"), Flavor=clean.unquote("flavor"),
                    Food=clean.unquote("food"), Price=clean.to_double("price"))
    receipts = cleaned("reciepts.csv", "num date cid", Reciept=clean.to_int("num"),
                       Date=clean.to_date(clean.unquote("date")), CId=clean.to_int("cid"))
    items = cleaned("items.csv", "num ordinal item", Reciept=clean.to_int("num"), Ordinal=clean.to_int("ordinal"),
                    GId=clean.unquote("item"))
    rejects = None
    for r in rejected:
        rejects = r if rejects is None else rejects.unionAll(r)
    return Bakery(customers, goods, receipts, items, rejects)


def _days(df: DataFrame) -> DataFrame:
    return df.select(F.col("Date").alias("day")).distinct() \
        .select("day", clean.format_date("day").alias("day_text")).orderBy("day")


def cheap_items(b: Bakery) -> DataFrame:
    """Chocolate goods under 5, most expensive first."""
    return rel.filter_sort_project(
        b.goods, (F.col("Flavor") == CHEAP_FLAVOR) & (F.col("Price") < CHEAP_MAX_PRICE),
        ["Flavor", "Food", "Price"], [F.col("Price").desc(), F.col("Food")])


def customers_on_day(b: Bakery) -> DataFrame:
    """First and last names of the customers with a receipt on 3 Oct 2007."""
    return rel.semi_join_on_day(b.customers, b.receipts, "CId", "CId", "Date", ONE_DAY,
                                ["FirstName", "LastName"], ["LastName", "FirstName"])


def repeat_buyer_days(b: Bakery) -> DataFrame:
    """Days of 1-15 Oct 2007 on which a customer name has more than one receipt."""
    return rel.repeat_days(b.receipts, b.customers, "CId", "CId", "Date",
                           ["LastName", "FirstName"], REPEAT_FROM, REPEAT_TO)


def days_customer_or_product(b: Bakery) -> DataFrame:
    """Days on which ALMETA DOMKOWSKI bought, or a Gongolais Cookie was sold."""
    customer = b.customers.filter(f"LastName = '{CUSTOMER_LAST}'").filter(f"FirstName = '{CUSTOMER_FIRST}'")
    by_customer = b.receipts.join(customer.select("CId"), on="CId", how="left_semi")
    product = b.goods.filter(f"Food = '{PRODUCT_FOOD}'").filter(f"Flavor = '{PRODUCT_FLAVOR}'")
    sold = b.items.join(product.select("GId"), on="GId", how="left_semi").select("Reciept")
    by_product = b.receipts.join(sold, on="Reciept", how="left_semi")
    days = rel.union_distinct(by_customer.select("Date"), by_product.select("Date"))
    return _days(days)


def revenue_in_month(b: Bakery) -> DataFrame:
    """Total price of the cookies sold 1-31 Oct 2007 (NULL when none)."""
    october = b.receipts.filter(rel.day_between("Date", MONTH_FROM, MONTH_TO)).select("Reciept")
    joined = rel.star_join(b.items, [(october, "Reciept"), (b.goods, "GId")])
    return rel.total(joined.filter(F.col("Food") == MONTH_FOOD), "Price", "revenue")


def busy_days(b: Bakery) -> DataFrame:
    """Days with more than ten tarts sold, counted per receipt before the
    join with receipts."""
    tarts = b.goods.filter(f"Food = '{BUSY_FOOD}'").select("GId")
    sold = b.items.select("Reciept", "GId").join(tarts, on="GId")
    counted = rel.aggregate_through(sold, None, [("Reciept", b.receipts, ["Date"])], "n_items",
                                    min_exclusive=BUSY_MIN_EXCLUSIVE)
    return counted.select(F.col("Date").alias("day"), clean.format_date("Date").alias("day_text"),
                          "n_items").orderBy("day")


def spend_per_customer(b: Bakery) -> DataFrame:
    """Total spent per customer name, biggest first; prices are summed per
    good, receipt and customer before each join."""
    prices = b.goods.select("GId", F.col("Price").cast("decimal(38,2)").alias("_price"))
    spent = b.items.select("Reciept", "GId").join(prices, on="GId")
    named = rel.aggregate_through(spent, "_price", [("Reciept", b.receipts, ["CId"]),
                                                    ("CId", b.customers, ["LastName", "FirstName"])], "TotalSpent")
    return named.withColumn("TotalSpent", F.col("TotalSpent").cast("double")) \
        .orderBy(F.col("TotalSpent").desc(), "LastName", "FirstName")


def most_popular_product(b: Bakery) -> DataFrame:
    """The (flavour, food) with the most items sold, counted per good
    before the join with goods."""
    counted = rel.aggregate_through(b.items, None, [("GId", b.goods, ["Flavor", "Food"])], "NumSold")
    return rel.top_n(counted, [F.col("NumSold").desc(), F.col("Flavor"), F.col("Food")], 1)
