"""Plans: snapshot calendar, panel plans and reports, end-to-end jobs."""

from churnlens.plans.calendar import Calendar, calendar_for, calendar_frame, make_calendar
from churnlens.plans.increments import PanelStore
from churnlens.plans.jobs import (
    run_drift,
    run_explanation,
    run_feature_engineering,
    run_ingestion,
    run_scoring,
    run_training,
    run_validation,
)
from churnlens.plans.snapshots import (
    build_customer_snapshots,
    overall_report,
    panel_report,
    per_snapshot_counts,
    population_parity,
    snapshot_panel,
    snapshot_panel_range,
)

__all__ = [
    "Calendar", "PanelStore", "build_customer_snapshots", "calendar_for", "calendar_frame", "make_calendar",
    "overall_report", "panel_report", "per_snapshot_counts", "population_parity", "run_drift", "run_explanation",
    "run_feature_engineering", "run_ingestion", "run_scoring", "run_training", "run_validation", "snapshot_panel", "snapshot_panel_range",
]
