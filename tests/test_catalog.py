from tierwise.operators.generate import GenSpec, generate
from tierwise.sources import catalog as C


def test_create_describe_detail(spark, scratch):
    db = "tierwise_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/wh'")
    C.drop_tables(spark, db)
    C.create_tables(spark, db)
    g = generate(spark, GenSpec(products=20, customers=30, transactions=100))
    for name, df in g.items():
        C.append(spark, db, name, df)
    d = {(r.table_name, r.column_name): r.data_type for r in C.describe_tables(spark, db).collect()}
    assert d[("products", "unit_price")] == "decimal(10,2)" and d[("sales_transactions", "customer_id")] == "bigint"
    det = C.table_detail(spark.table(f"{db}.sales_transactions"), "sales_transactions").first()
    assert det.num_rows == 100 and det.num_files >= 1 and det.size_bytes > 0
    C.truncate(spark, db, "sales_transactions")
    assert spark.table(f"{db}.sales_transactions").count() == 0
    C.drop_tables(spark, db)


def test_bucketed_customers_join_without_shuffling_them(spark, scratch):
    import contextlib
    import io
    import re

    from pyspark.sql import functions as F

    db = "tierwise_bucket_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/wh2'")
    g = generate(spark, GenSpec(products=20, customers=300, transactions=3000))
    C.save_bucketed(g["customers"], db, "customers", "customer_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spend = g["sales_transactions"].groupBy("customer_id").agg(F.sum("quantity").alias("q"))
        joined = spark.table(f"{db}.customers").join(spend, "customer_id")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            joined.explain("formatted")
        plan = buf.getvalue()
        assert joined.count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE IF EXISTS {db}.customers")
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # one exchange only, the aggregate's: the bucketed table is not shuffled
    exchanges = [line for line in plan.splitlines() if re.match(r"^\(\d+\) Exchange", line)]
    assert len(exchanges) == 1, plan
