"""Column expressions shared by the operators (all built-in, JVM-side)."""

from closure_engine.functions.exprs import (
    exact_mean,
    guarded_ratio,
    int_div,
    local_ratio,
    nan,
    sort3,
    triplets_of,
)

__all__ = ["exact_mean", "guarded_ratio", "int_div", "local_ratio", "nan", "sort3", "triplets_of"]
