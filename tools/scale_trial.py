"""Run the end-to-end pipeline on generated data of a chosen size, with a
hot customer, and report stage timings and the validation status.

    python tools/scale_trial.py <scratch_dir> [transactions] [customers] [hot_share]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from decimal import Decimal  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402


def main():
    root = sys.argv[1]
    n_tx = int(sys.argv[2]) if len(sys.argv) > 2 else 10_000_000
    n_c = int(sys.argv[3]) if len(sys.argv) > 3 else 1_000_000
    hot = float(sys.argv[4]) if len(sys.argv) > 4 else 0.33
    from tierwise.operators import quality as Q
    from tierwise.operators import reports as R
    from tierwise.operators.generate import GenSpec
    from tierwise.plans.pipeline import generate_star, process_tiers_job, tables_from_store
    from tierwise.rules import TierRules
    from tierwise.session import local_session
    from tierwise.sources.store import StarStore

    spark = local_session(8, 64, app="tierwise-scale")
    spec = GenSpec(products=100_000, customers=n_c, transactions=n_tx, hot_share=hot, partitions=64)
    rules = TierRules(thresholds=(("GOLD", Decimal(20000)), ("SILVER", Decimal(12000))))
    store = StarStore(spark, f"{root}/star")
    out = {}
    t0 = time.perf_counter()
    generate_star(spark, store, spec)
    out["generate_and_write"] = round(time.perf_counter() - t0, 2)
    t0 = time.perf_counter()
    updated, _, _ = process_tiers_job(store, rules)
    out["process_tiers"] = round(time.perf_counter() - t0, 2)
    out["updated"] = updated
    t0 = time.perf_counter()
    t = tables_from_store(store, rules, verify_keys=True)
    out["verify_txn_key"] = round(time.perf_counter() - t0, 2)
    out["txn_key_unique"] = t.unique_txn_id
    t0 = time.perf_counter()
    stats = R.tier_stats(t).collect()
    out["tier_stats"] = round(time.perf_counter() - t0, 2)
    t0 = time.perf_counter()
    top = R.top_customers(t).collect()
    out["top_customers"] = round(time.perf_counter() - t0, 2)
    t0 = time.perf_counter()
    rep = Q.validation_report(t, {"products": spec.products, "customers": spec.customers,
                                  "sales_transactions": spec.transactions}).collect()
    out["validation_report"] = round(time.perf_counter() - t0, 2)
    out["report_status"] = sorted({r["Status"] for r in rep})
    out["hot_customer_txns"] = t.transactions.where(F.col("customer_id") == 1).count()
    from tierwise.operators import windows as W

    t0 = time.perf_counter()
    gaps = W.days_between_txns(t)
    gaps.write.format("noop").mode("overwrite").save()
    out["days_between_txns"] = round(time.perf_counter() - t0, 2)
    hot_gaps = gaps.where((F.col("customer_id") == 1) & F.col("prev_txn_date").isNull()).count()
    out["hot_customer_first_rows"] = hot_gaps  # exactly 1 when the hot group is continued across partitions
    t0 = time.perf_counter()
    W.product_rank(t).write.format("noop").mode("overwrite").save()
    out["product_rank"] = round(time.perf_counter() - t0, 2)
    out["top1"] = (top[0]["customer_id"], str(top[0]["total_spend"]), top[0]["transaction_count"])
    out["tiers"] = {r["segment"]: r["customer_count"] for r in stats}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
