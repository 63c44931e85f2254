"""Job parameters.

The defaults are the original job configuration's values; SYNTHETIC_PARAMS
re-aims the dates at the generated test tables (orders 1995-2001).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


# Fixed values that must equal the original job configuration.
DEFAULT_THRESHOLD_DAYS = 134
DEFAULT_REFERENCE_DATE = "2011-12-10"
DEFAULT_SNAPSHOT_START = "2010-01-01"
DEFAULT_EXPECTED_PARTS = ("Year 2009-2010", "Year 2010-2011")
DEFAULT_MODEL_PARAMS = {
    "objective": "binary",
    "metric": "binary_logloss",
    "num_leaves": 31,
    "learning_rate": 0.05,
    "n_estimators": 500,
    "random_state": 42,
}


@dataclass(frozen=True)
class Params:
    threshold_days: int = DEFAULT_THRESHOLD_DAYS
    # None means "resolve the run-time clock once on the driver".
    reference_date: str | None = DEFAULT_REFERENCE_DATE
    snapshot_start_date: str = DEFAULT_SNAPSHOT_START
    expected_parts: tuple[str, ...] = DEFAULT_EXPECTED_PARTS
    model_params: dict = field(default_factory=lambda: dict(DEFAULT_MODEL_PARAMS))
    # Single as-of date used by the one-date feature/label queries.
    as_of_date: str = "2010-03-01"
    # First snapshot of the temporal test split.
    test_start_date: str = "2011-01-01"
    # Precision floor for recall-at-precision.
    min_precision: float = 0.5
    # Risk bands for batch scoring (D7): probability >= value -> band.
    risk_bands: tuple[tuple[str, float], ...] = (("high", 0.7), ("medium", 0.4), ("low", 0.0))
    # Quantile bins for PSI.
    drift_bins: int = 10

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# Dates re-aimed at the generated tables (order dates 1995-01-01 .. 2001-08-01).
SYNTHETIC_PARAMS = Params(
    reference_date="2001-07-01",
    snapshot_start_date="1996-01-01",
    expected_parts=("Year 1995-1997", "Year 1998-2001"),
    as_of_date="1999-01-01",
    test_start_date="2000-06-01",
)
