"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from strata.functions.money import line_amount, safe_ratio
from strata.functions.predicates import is_missing, total

__all__ = ["is_missing", "line_amount", "safe_ratio", "total"]
