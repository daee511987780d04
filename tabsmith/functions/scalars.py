"""Scalar ``Column`` expressions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Null rules are spelled out per function because pandas and SQL differ.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must match the reference's results.
# Industry risk level by industry description (0 low, 1 medium, 2 high);
# a missing description is medium risk.
RISK_LEVELS = {
    "HEALTH CARE AND SOCIAL ASSISTANCE": 1,
    "PUBLIC ADMINISTRATION": 0,
    "RETAIL TRADE": 1,
    "TRANSPORTATION AND WAREHOUSING": 2,
    "EDUCATIONAL SERVICES": 0,
    "MANUFACTURING": 2,
    "CONSTRUCTION": 2,
    "ACCOMMODATION AND FOOD SERVICES": 1,
    "ADMINISTRATIVE AND SUPPORT AND WASTE MANAGEMENT AND REMEDIAT": 1,
    "WHOLESALE TRADE": 1,
    "OTHER SERVICES (EXCEPT PUBLIC ADMINISTRATION)": 0,
    "ARTS, ENTERTAINMENT, AND RECREATION": 1,
    "PROFESSIONAL, SCIENTIFIC, AND TECHNICAL SERVICES": 0,
    "INFORMATION": 0,
    "REAL ESTATE AND RENTAL AND LEASING": 0,
    "FINANCE AND INSURANCE": 0,
    "UTILITIES": 2,
    "AGRICULTURE, FORESTRY, FISHING AND HUNTING": 2,
    "MINING": 2,
    "MANAGEMENT OF COMPANIES AND ENTERPRISES": 0,
}
RISK_LEVEL_MISSING = 1
# Season start (month, day): winter 12-21, spring 3-20, summer 6-21, fall 9-23.
SEASON_STARTS = {"Winter": (12, 21), "Spring": (3, 20), "Summer": (6, 21), "Fall": (9, 23)}
# Financial impact category cut points: > 50000 -> 0, 1000..50000 -> 1, else 2.
IMPACT_CUTS = (1000.0, 50000.0)
# Age group edges, left-closed right-open bins; outside or null -> -1.
AGE_EDGES = (0, 25, 40, 55, 70, 100)
# PSI interpretation thresholds and labels.
PSI_LEVELS = ((0.1, "No significant population change"),
              (0.25, "Slight population change"),
              (0.5, "Moderate population change"))
PSI_TOP_LABEL = "Significant population change"
# ---------------------------------------------------------------------------


def col(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def log10_or_null(c) -> Column:
    """M1: log10(x) when x > 0, else null."""
    x = col(c)
    return F.when(x > 0, F.log10(x))


def sqrt_or_zero(c) -> Column:
    """M2: sqrt(x) when x > 0, else 0 (null included)."""
    x = col(c)
    return F.when(x > 0, F.sqrt(x)).otherwise(F.lit(0.0))


def cyclic_pair(ordinal: Column, period: float) -> tuple[Column, Column]:
    """M3/E5: (sin, cos) of 2*pi*ordinal/period; null ordinal gives nulls."""
    angle = F.lit(2 * math.pi) * ordinal / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def lookup(c, mapping: dict, default=None) -> Column:
    """Literal map lookup; missing keys and null keys give ``default``."""
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    x = col(c)
    out = F.when(x.isNotNull(), m[x])
    return out if default is None else F.coalesce(out, F.lit(default))


def risk_level(c) -> Column:
    return lookup(c, RISK_LEVELS, RISK_LEVEL_MISSING)


def per_dependent(wage, dependents) -> Column:
    """M5: wage divided by dependents, zero dependents counted as one."""
    d = col(dependents)
    return col(wage) / F.when(d == 0, F.lit(1)).otherwise(d)


def impact_category(c, cuts=IMPACT_CUTS) -> Column:
    """M6: > hi -> 0, lo..hi -> 1, anything else (null included) -> 2."""
    x = col(c)
    lo, hi = cuts
    return (F.when(x > hi, F.lit(0))
             .when((x >= lo) & (x <= hi), F.lit(1))
             .otherwise(F.lit(2)))


def above(c, reference) -> Column:
    """M7: 1 when x > reference (a literal or a column), else 0; null -> 0."""
    ref = reference if isinstance(reference, Column) else F.lit(reference)
    return F.coalesce((col(c) > ref).cast("int"), F.lit(0))


def bin_code(c, edges=AGE_EDGES) -> Column:
    """M8: index of the left-closed, right-open bin; outside or null -> -1."""
    x = col(c)
    expr = F.lit(-1)
    for i in reversed(range(len(edges) - 1)):
        expr = F.when((x >= edges[i]) & (x < edges[i + 1]), F.lit(i)).otherwise(expr)
    return expr


def capitalize(c) -> Column:
    """First character upper-case, the rest lower-case."""
    x = col(c)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))


def abs_diff(a, b) -> Column:
    """M12."""
    return F.abs(col(a) - col(b))


def flag(condition: Column) -> Column:
    """Boolean to 0/1 with null -> 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def season(date_col, null_value: str = "Fall") -> Column:
    """D3: season of a date; null falls through to the last branch ("Fall")."""
    d = col(date_col)
    md = F.month(d) * 100 + F.dayofmonth(d)

    def start(name):
        m, dd = SEASON_STARTS[name]
        return F.lit(m * 100 + dd)

    return (F.when((md >= start("Winter")) | (md < start("Spring")), F.lit("Winter"))
             .when((md >= start("Spring")) & (md < start("Summer")), F.lit("Spring"))
             .when((md >= start("Summer")) & (md < start("Fall")), F.lit("Summer"))
             .otherwise(F.lit(null_value)))


def interpret_psi(c) -> Column:
    """PSI label; null (not computable) falls to the top label."""
    x = col(c)
    expr = None
    for t, label in PSI_LEVELS:
        expr = F.when(x < t, F.lit(label)) if expr is None else expr.when(x < t, F.lit(label))
    return expr.otherwise(F.lit(PSI_TOP_LABEL))


def severity(p) -> Column:
    """High if p < 0.01, medium if p < 0.05, else low."""
    x = col(p)
    return F.when(x < 0.01, F.lit("high")).when(x < 0.05, F.lit("medium")).otherwise(F.lit("low"))
