"""tierwise: customer-spend tiering, reporting and data-quality checks as
Spark DataFrame jobs.

Layout
------
sources/    table bundles (generated star schema, views over TPC-H style
            tables), catalog set-up, versioned parquet store
operators/  spend, tiers, merge, reports, quality, windows, generator
functions/  money arithmetic and the small scalar helpers
plans/      the named query registry and the end-to-end pipeline
"""

from tierwise.rules import DEFAULT_RULES, DRIVER_RULES, TierRules
from tierwise.sources.model import Tables

__all__ = ["DEFAULT_RULES", "DRIVER_RULES", "TierRules", "Tables"]
