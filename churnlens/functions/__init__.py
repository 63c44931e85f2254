from churnlens.functions.columns import (
    canonical_key,
    cancellation_flag,
    guarded_ratio,
    iso_format,
    nan_to_null,
    ntz,
    round_significant,
    whole_days_between,
)
from churnlens.functions.running import running_totals

__all__ = [
    "canonical_key",
    "cancellation_flag",
    "guarded_ratio",
    "iso_format",
    "nan_to_null",
    "ntz",
    "round_significant",
    "running_totals",
    "whole_days_between",
]
