import datetime as dt
from decimal import Decimal

from tierwise.operators.generate import GenSpec, gen_customers, gen_products, gen_transactions, generate


def test_reference_sizes_and_ranges(spark):
    g = generate(spark)
    assert g["products"].count() == 50 and g["customers"].count() == 500
    tx = g["sales_transactions"]
    assert tx.count() == 10000
    r = tx.selectExpr("min(customer_id) a", "max(customer_id) b", "min(product_id) c", "max(product_id) d",
                      "min(quantity) e", "max(quantity) f", "min(txn_date) g", "max(txn_date) h").first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == (1, 500, 1, 50, 1, 5)
    assert r.h <= dt.date(2024, 1, 1) and r.g >= dt.date(2024, 1, 1) - dt.timedelta(days=365)
    p = g["products"].selectExpr("min(unit_price) lo", "max(unit_price) hi").first()
    assert Decimal("10.00") <= p.lo and p.hi <= Decimal("500.00")
    cats = {r.category: r["count"] for r in g["products"].groupBy("category").count().collect()}
    assert cats == {"Home": 17, "Clothing": 17, "Electronics": 16}
    assert {r.segment for r in g["customers"].select("segment").distinct().collect()} == {"BRONZE"}


def test_same_data_for_any_partitioning(spark):
    a = gen_transactions(spark, GenSpec(partitions=1)).orderBy("txn_id").collect()
    b = gen_transactions(spark, GenSpec(partitions=7)).orderBy("txn_id").collect()
    assert a == b
    assert gen_customers(spark, GenSpec(partitions=3)).orderBy("customer_id").collect() == \
        gen_customers(spark, GenSpec(partitions=2)).orderBy("customer_id").collect()
    assert gen_products(spark).schema["unit_price"].dataType.simpleString() == "decimal(10,2)"
