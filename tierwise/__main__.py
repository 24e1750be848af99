"""Command line: the job sequence of the tiering workflow.

    python -m tierwise generate --root R [--customers N --products N --transactions N --seed S]
    python -m tierwise process  --root R [--gold 3000 --silver 1000 | --tiers P:9000,G:3000,S:1000]
                                         [--base-tier BRONZE] [--assign-zero-spend]
    python -m tierwise report   --root R [--top 20]
    python -m tierwise validate --root R [--expect-customers N ...]
    python -m tierwise run      --root R  (generate, process, report, validate)

``--root`` is a folder on the cluster's file system holding the versioned
star.  Only small results (counts, top lists, the report) reach the driver.
"""

from __future__ import annotations

import argparse
import sys
from decimal import Decimal

from pyspark.sql import SparkSession

from tierwise.operators import quality as Q
from tierwise.operators import reports as R
from tierwise.operators.generate import GenSpec
from tierwise.operators.tiers import tier_counts
from tierwise.plans.pipeline import changes_sample, generate_star, process_tiers_job, summary_status, tables_from_store
from tierwise.rules import TierRules
from tierwise.session import ensure_checkpoint_dir
from tierwise.sources.store import StarStore


def _rules(a) -> TierRules:
    """``--tiers NAME:MIN,...`` (highest first) or ``--gold`` / ``--silver``."""
    if a.tiers:
        thresholds = tuple(
            (name.strip(), Decimal(minimum)) for name, minimum in (item.split(":") for item in a.tiers.split(","))
        )
    else:
        thresholds = (("GOLD", Decimal(a.gold)), ("SILVER", Decimal(a.silver)))
    return TierRules(
        thresholds=thresholds,
        default_tier=a.base_tier,
        zero_spend="assign" if a.assign_zero_spend else "keep",
    )


def _counts(store: StarStore, rules: TierRules) -> dict[str, int]:
    return {r["segment"]: r["customer_count"] for r in tier_counts(store["customers"].read(), rules.tiers).collect()}


def cmd_generate(spark, a):
    spec = GenSpec(products=a.products, customers=a.customers, transactions=a.transactions, seed=a.seed,
                   default_tier=a.default_tier)
    generate_star(spark, StarStore(spark, a.root), spec)
    print(f"generated {a.products} products, {a.customers} customers, {a.transactions} transactions")


def cmd_process(spark, a):
    store, rules = StarStore(spark, a.root), _rules(a)
    before = _counts(store, rules)
    updated, cv, _ = process_tiers_job(store, rules)
    after = _counts(store, rules)
    print(f"updated {updated} customers (customers version {cv})")
    for tier in rules.tiers:
        print(f"  {tier:<8} {before.get(tier, 0):>10} -> {after.get(tier, 0):>10} ({after.get(tier, 0) - before.get(tier, 0):+d})")
    print(f"  {'Total':<8} {sum(before.values()):>10} -> {sum(after.values()):>10}")
    if updated:
        changes_sample(store, 10).show(truncate=False)


def cmd_report(spark, a):
    t = tables_from_store(StarStore(spark, a.root), _rules(a), verify_keys=True)
    R.tier_stats(t).show(truncate=False)
    R.top_customers(t, a.top).show(a.top, truncate=False)
    R.category_price_stats(t.products).show(truncate=False)
    R.revenue_by_category(t).show(truncate=False)


def cmd_validate(spark, a) -> int:
    t = tables_from_store(StarStore(spark, a.root), _rules(a))
    expected = None
    if a.expect_customers is not None:
        expected = {"customers": a.expect_customers, "products": a.expect_products,
                    "sales_transactions": a.expect_transactions}
    rows = Q.validation_report(t, expected).collect()
    Q.tier_band_check(t).show(truncate=False)
    Q.null_checks(t).show(truncate=False)
    for r in rows:
        print(" | ".join(str(v) for v in r))
    status = summary_status([tuple(r) for r in rows])
    print(f"validation: {status}")
    return 0 if status == "PASS" else 1


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="tierwise")
    p.add_argument("command", choices=["generate", "process", "report", "validate", "run"])
    p.add_argument("--root", required=True)
    p.add_argument("--customers", type=int, default=500)
    p.add_argument("--products", type=int, default=50)
    p.add_argument("--transactions", type=int, default=10000)
    p.add_argument("--seed", type=int, default=13)
    p.add_argument("--default-tier", default="BRONZE")
    p.add_argument("--gold", default="3000")
    p.add_argument("--silver", default="1000")
    p.add_argument("--tiers", help="NAME:MIN,... from the highest tier down (overrides --gold/--silver)")
    p.add_argument("--base-tier", default="BRONZE", help="tier below the last threshold")
    p.add_argument("--assign-zero-spend", action="store_true")
    p.add_argument("--top", type=int, default=20)
    p.add_argument("--expect-customers", type=int)
    p.add_argument("--expect-products", type=int)
    p.add_argument("--expect-transactions", type=int)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("tierwise").getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.command == "run":
        a.expect_customers, a.expect_products, a.expect_transactions = a.customers, a.products, a.transactions
        cmd_generate(spark, a)
        cmd_process(spark, a)
        cmd_report(spark, a)
        return cmd_validate(spark, a)
    return {"generate": cmd_generate, "process": cmd_process, "report": cmd_report,
            "validate": cmd_validate}[a.command](spark, a) or 0


if __name__ == "__main__":
    sys.exit(main())
