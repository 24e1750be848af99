"""Exact money arithmetic.

Prices are ``decimal(10,2)`` and quantities integers, so every product and
sum is exact at scale 2.  Results leave as ``decimal(38,2)`` so sums over a
very large fact table cannot overflow.

AVG is the one lossy aggregate: Spark's decimal AVG rounds to 6 places
before a ROUND(…, 2) would round again.  ``avg_half_up`` instead rounds the
exact quotient ``sum / count`` half away from zero, in integer cents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(38, 2)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return _c(c).cast(MONEY)


def cents_div_half_up(total: Column, n: Column) -> Column:
    """``round(total / n, 2)`` half away from zero, exact for any size.

    ``total`` is a scale-2 decimal, ``n`` a count; NULL when ``n`` is 0.
    """
    cents = (total * F.lit(100)).cast(DecimalType(30, 0))
    num = F.abs(cents) * F.lit(2) + n.cast(DecimalType(20, 0))
    den = F.nullif(n.cast(DecimalType(20, 0)) * F.lit(2), F.lit(0).cast(DecimalType(20, 0)))
    # (num - num % den) is a multiple of den, so the division is exact
    quot = (num - num % den) / den
    return (F.signum(cents).cast(DecimalType(1, 0)) * quot * F.lit(0.01).cast(DecimalType(3, 2))).cast(MONEY)


def avg_half_up(c: Column | str) -> Column:
    """Aggregate: AVG(c) rounded to cents, half away from zero."""
    c = _c(c)
    return cents_div_half_up(F.sum(c), F.count(c))


def sql_div_half_up(total: str, n: str) -> str:
    """DuckDB rendering of ``cents_div_half_up`` (integer arithmetic in
    HUGEINT)."""
    cents, n = f"CAST({total} * 100 AS HUGEINT)", f"CAST({n} AS HUGEINT)"
    return (
        f"CAST(CAST(SIGN({cents}) * ((2 * ABS({cents}) + {n}) // NULLIF(2 * {n}, 0)) AS DECIMAL(38,0))"
        f" * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(38,2))"
    )


def sql_avg_half_up(expr: str) -> str:
    """DuckDB rendering of ``avg_half_up``."""
    return sql_div_half_up(f"SUM({expr})", f"COUNT({expr})")
