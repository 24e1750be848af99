"""Tier rules as data.

A rule set is an ordered list of ``(tier, minimum spend)`` pairs checked
top-down (first match wins, ``>=``), a default tier for everything below
the last threshold, and a policy for customers without any transaction.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TierRules:
    thresholds: tuple[tuple[str, Decimal], ...] = field(
        default_factory=lambda: (("GOLD", Decimal(3000)), ("SILVER", Decimal(1000)))
    )
    default_tier: str = "BRONZE"
    # "keep": customers with no transactions are never touched (the
    # processor's inner joins).  "assign": their spend counts as 0 and they
    # get a tier like everyone else (COALESCE(SUM(...), 0)).
    zero_spend: str = "keep"

    def __post_init__(self) -> None:
        if self.zero_spend not in ("keep", "assign"):
            raise ValueError(f"zero_spend must be 'keep' or 'assign', got {self.zero_spend!r}")
        mins = [m for _, m in self.thresholds]
        if mins != sorted(mins, reverse=True):
            raise ValueError("thresholds must be listed from the highest to the lowest")

    @property
    def tiers(self) -> list[str]:
        """Tier names from the highest to the default."""
        return [t for t, _ in self.thresholds] + [self.default_tier]

    def tier_of(self, spend: Column) -> Column:
        """Searched CASE: the first threshold with ``spend >= min`` wins;
        NULL spend falls through to the default tier."""
        expr = None
        for tier, minimum in self.thresholds:
            cond = spend >= F.lit(minimum)
            expr = F.when(cond, F.lit(tier)) if expr is None else expr.when(cond, F.lit(tier))
        if expr is None:
            return F.lit(self.default_tier)
        return expr.otherwise(F.lit(self.default_tier))

    def rank_of(self, segment: Column) -> Column:
        """Sort rank of a segment (highest tier first, unknown/NULL last)."""
        expr = None
        for i, tier in enumerate(self.tiers, start=1):
            cond = segment == F.lit(tier)
            expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
        return expr.otherwise(F.lit(len(self.tiers) + 1))

    def band(self, tier: str) -> tuple[Decimal | None, Decimal | None]:
        """``[low, high)`` spend band of a tier; None for an open end."""
        names = self.tiers
        i = names.index(tier)
        low = self.thresholds[i][1] if i < len(self.thresholds) else None
        high = self.thresholds[i - 1][1] if i > 0 else None
        return low, high

    # -- SQL renderings for the DuckDB oracle --------------------------------

    def sql_tier_of(self, spend_sql: str) -> str:
        branches = " ".join(
            f"WHEN {spend_sql} >= {minimum} THEN '{tier}'" for tier, minimum in self.thresholds
        )
        return f"CASE {branches} ELSE '{self.default_tier}' END"

    def sql_rank_of(self, seg_sql: str) -> str:
        branches = " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(self.tiers, start=1))
        return f"CASE {seg_sql} {branches} ELSE {len(self.tiers) + 1} END"


# The business rule of the source package (GOLD at 3000,
# SILVER at 1000, BRONZE below).
DEFAULT_RULES = TierRules()

# Thresholds for the driver's TPC-H style tables, where 3000 / 1000 would
# make every customer with spend GOLD (FIXTURES.md section B).
DRIVER_RULES = TierRules(
    thresholds=(("GOLD", Decimal(1000000)), ("SILVER", Decimal(700000))),
)
