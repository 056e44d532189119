"""Column-expression helpers (all built-in Spark expressions, no UDFs)."""

from keepcurve.functions.dates import as_date, cutoff_lit  # noqa: F401
from keepcurve.functions.exprs import (  # noqa: F401
    guarded_ratio,
    hash_fraction,
    hash_u64,
    range_guard,
    recode,
    valid_flag,
)
