"""Tier assignment, change detection and the keyed tier update.

``process_tiers`` is the set-based form of a row-by-row update loop: one
spend aggregation, one CASE, one semi join to keep the tiers that differ from
the customer's segment, one keyed update.  Change detection uses ``!=``: a
NULL segment compares to NULL and is therefore never updated (three-valued
logic kept on purpose).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.operators.merge import WhenMatched, merge, merged_rows
from tierwise.operators.spend import customer_spend
from tierwise.session import ensure_checkpoint_dir
from tierwise.sources.model import Tables


def customer_tiers(t: Tables) -> DataFrame:
    """customer_id, total_spend, new_tier."""
    spend = customer_spend(t)
    if t.rules.zero_spend == "assign":
        ids = t.customers.select("customer_id").where(F.col("customer_id").isNotNull())
        spend = ids.join(spend, "customer_id", "left").groupBy("customer_id").agg(
            F.coalesce(F.sum("total_spend"), F.lit(0).cast("decimal(38,2)")).alias("total_spend")
        )
    return spend.select("customer_id", "total_spend", t.rules.tier_of(F.col("total_spend")).alias("new_tier"))


def tier_changes(t: Tables) -> DataFrame:
    """customer_id, new_tier, total_spend of the computed tiers that some
    customer row does not have yet: one row per customer_id."""
    held = t.customers.select("customer_id", "segment").alias("c")
    differs = (F.col("s.customer_id") == F.col("c.customer_id")) & (F.col("s.new_tier") != F.col("c.segment"))
    return customer_tiers(t).alias("s").join(held, differs, "left_semi").select("customer_id", "new_tier", "total_spend")


def tier_update_count(t: Tables) -> DataFrame:
    """updated_count: number of customers the update changes."""
    return tier_changes(t).agg(F.count(F.lit(1)).alias("updated_count"))


def top_tier_changes(t: Tables, k: int = 10) -> DataFrame:
    return tier_changes(t).orderBy(F.col("total_spend").desc(), F.col("customer_id").asc()).limit(k)


def tagged_tier_update(t: Tables, changes: DataFrame | None = None) -> DataFrame:
    changes = tier_changes(t) if changes is None else changes
    return merge(
        t.customers,
        changes.select("customer_id", "new_tier"),
        "customer_id",
        matched=[WhenMatched(update={"segment": F.col("s.new_tier")})],
        keyed_source=True,
    )


def apply_tier_changes(t: Tables, changes: DataFrame | None = None) -> DataFrame:
    """All customers with the changed segments applied (MERGE ... WHEN
    MATCHED THEN UPDATE SET segment = new_tier)."""
    return merged_rows(tagged_tier_update(t, changes))


def process_tiers(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(new customers table, change set).  The change set is checkpointed, so
    it is computed once and stays what it was when the new table replaces the
    old one."""
    ensure_checkpoint_dir(t.spark)
    changes = tier_changes(t).checkpoint()
    return apply_tier_changes(t, changes), changes


def tier_count(customers: DataFrame, tier: str) -> DataFrame:
    """tier_name, tier_count: COUNT(*) WHERE segment = tier."""
    return customers.where(F.col("segment") == F.lit(tier)).agg(
        F.lit(tier).alias("tier_name"), F.count(F.lit(1)).alias("tier_count")
    )


def tier_counts(customers: DataFrame, tiers: list[str]) -> DataFrame:
    """segment, customer_count for every listed tier (0 when absent), in
    one pass over the customers."""
    return customers.agg(
        *[F.count_if(F.col("segment") == F.lit(tr)).alias(tr) for tr in tiers]
    ).select(
        F.explode(F.array(*[F.struct(F.lit(tr).alias("segment"), F.col(f"`{tr}`").alias("customer_count")) for tr in tiers])).alias("r")
    ).select("r.segment", "r.customer_count")


def tier_shift(t: Tables) -> DataFrame:
    """segment, before, after, change - tier counts before and after one
    processing run.

    ``after`` follows from the change set alone: a change moves one customer
    from its current segment into its new tier, so each tier gains the
    changes into it and loses the changes out of it.  No pass over the
    updated customers table is needed (the update itself fails on duplicate
    keys, as ``apply_tier_changes`` does)."""
    tiers = t.rules.tiers
    before = tier_counts(t.customers, tiers).withColumnRenamed("customer_count", "before")
    held = t.customers.select("customer_id", F.col("segment").alias("from_tier")).where(F.col("from_tier").isNotNull())
    moves = customer_tiers(t).join(held, "customer_id").where(F.col("from_tier") != F.col("new_tier"))
    gain = F.count_if(F.col("d.tier") == F.col("d.into")).cast("bigint")
    sides = moves.select(
        F.explode(F.array(
            F.struct(F.col("new_tier").alias("tier"), F.col("new_tier").alias("into")),
            F.struct(F.col("from_tier").alias("tier"), F.lit(None).cast("string").alias("into")),
        )).alias("d")
    )
    delta = sides.groupBy(F.col("d.tier").alias("segment")).agg((2 * gain - F.count(F.lit(1))).alias("change"))
    change = F.coalesce(F.col("change"), F.lit(0).cast("bigint"))
    return before.join(delta, "segment", "left").select(
        "segment", "before", (F.col("before") + change).alias("after"), change.alias("change")
    )


def idempotent_second_run(t: Tables) -> DataFrame:
    """second_run_changes: changes found when processing the result of a
    first run again (0 when the processing is idempotent)."""
    after, _ = process_tiers(t)
    return tier_update_count(t.with_customers(after.checkpoint())).withColumnRenamed("updated_count", "second_run_changes")
