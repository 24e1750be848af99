"""Hand-made stars for the edge cases (FIXTURES.md section C)."""

import datetime as dt
from decimal import Decimal

from tierwise.rules import DEFAULT_RULES
from tierwise.schemas import CUSTOMERS, PRODUCTS, SALES_TRANSACTIONS
from tierwise.sources.model import Tables

D = dt.date(2024, 1, 1)


def star(spark, customers, products, txns, rules=DEFAULT_RULES, counts=None):
    t = Tables(
        customers=spark.createDataFrame(customers, CUSTOMERS),
        products=spark.createDataFrame(products, PRODUCTS),
        transactions=spark.createDataFrame(txns, SALES_TRANSACTIONS),
        rules=rules,
    )
    return t


def price(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


def basic(spark, rules=DEFAULT_RULES):
    """Customers:
    1 GOLD  spend 5000 (unchanged)          2 GOLD  spend 1500 -> SILVER
    3 BRONZE spend 3000 -> GOLD            4 GOLD  no transactions
    5 NULL  spend 5000 (never updated)      6 SILVER spend 999.99 -> BRONZE
    Product 1 price 1000.00, product 2 price 500.00, product 3 price 333.33.
    """
    customers = [
        (1, "Customer_1", "GOLD", D), (2, "Customer_2", "GOLD", D), (3, "Customer_3", "BRONZE", D),
        (4, "Customer_4", "GOLD", D), (5, "Customer_5", None, D), (6, "Customer_6", "SILVER", D),
    ]
    products = [(1, "Product_1", "Home", price(1000)), (2, "Product_2", "Clothing", price(500)),
                (3, "Product_3", "Electronics", price(333.33))]
    txns = [
        (1, 1, 1, 5, D), (2, 2, 2, 3, D), (3, 3, 1, 3, D), (4, 5, 1, 5, D),
        (5, 6, 3, 3, D),  # 999.99
    ]
    return star(spark, customers, products, txns, rules)
