from cohortlens.functions.columns import (
    safe_div, rate, half_even_class, safe_name, format_proba, hash_order_key, right_closed_bins,
    rounded,
)

__all__ = ["safe_div", "rate", "half_even_class", "safe_name", "format_proba", "hash_order_key",
           "right_closed_bins", "rounded"]
