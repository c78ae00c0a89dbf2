"""Half-up rounding of a ratio of two integer counts, on integers only.

The result tables hold ``n / d`` rounded to two decimals the way Java's
``new BigDecimal(double).setScale(2, HALF_UP)`` does it: half-up on the
*exact binary value* of the double quotient.  ``round()`` cannot be used
for that: Spark rounds the decimal tie up, other engines round the binary
value, and neither matches on every tie.

For ``0 <= n <= d`` the quotient ``100 n / d`` is a tie exactly when
``200 n / d`` is an odd integer ``m``.  ``n / d`` as a double is the double
nearest ``m / 200`` (IEEE division is correctly rounded), so whether the
tie rounds down depends on ``m`` alone: it does when that double lies below
``m / 200``.  The set of such ``m`` is derived below from that rule, not
listed.  Away from ties the double error (< 1e-14 for d < 1e13) cannot
cross a rounding boundary, so ``floor((200 n + d) / (2 d))`` is exact.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ties_rounding_down(limit: int = 200) -> list[int]:
    return [m for m in range(1, limit, 2) if Decimal(m / 200) < Decimal(m) / Decimal(200)]


TIES_DOWN: list[int] = _ties_rounding_down()


def half_up_ratio(n: Column | str, d: Column | str) -> Column:
    """``n / d`` rounded half-up to 2 decimals as Java does; NULL when ``d <= 0``.

    Integer operations only, so the same value comes out of every engine.
    """
    n = F.col(n) if isinstance(n, str) else n
    d = F.col(d) if isinstance(d, str) else d
    n2 = n.cast("bigint") * F.lit(200)
    d = d.cast("bigint")
    k = _int_div(n2 + d, d * F.lit(2))
    tie = (n2 % d == 0) & _int_div(n2, d).isin(TIES_DOWN)
    k = F.when(tie, k - 1).otherwise(k)
    return F.when(d > 0, k.cast("double") / F.lit(100.0))


def _int_div(a: Column, b: Column) -> Column:
    # Exact integer division for non-negative operands (no double rounding).
    return F.call_function("div", a, b)


def half_up_ratio_sql(n: str, d: str, dialect: str = "duckdb") -> str:
    """The same rule as SQL text; integer division is ``//`` (DuckDB) or ``div`` (Spark)."""
    div = {"duckdb": "//", "spark": "div"}[dialect]
    ties = ", ".join(str(m) for m in TIES_DOWN)
    n2 = f"(200 * CAST({n} AS BIGINT))"
    dd = f"CAST({d} AS BIGINT)"
    nz = f"NULLIF({dd}, 0)"  # engines may evaluate a CASE branch eagerly: never divide by 0
    k = f"(({n2} + {dd}) {div} (2 * {nz}))"
    return (
        f"CASE WHEN {dd} > 0 THEN CAST(CASE WHEN {n2} % {nz} = 0 AND {n2} {div} {nz} IN ({ties}) "
        f"THEN {k} - 1 ELSE {k} END AS DOUBLE) / 100.0 END"
    )
