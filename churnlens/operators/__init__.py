"""Operators: cleaning, features, labels and the declared analytics stages."""

from churnlens.operators.clean import (
    COLUMN_RENAME_MAP,
    add_quality_flags,
    clean_transactions,
    drop_exact_duplicates,
    exclude_without_customer,
    rename_to_contract,
    validate_and_clean,
    validation_report,
)
from churnlens.operators.drift import drift_report, ks_statistic, psi, summary_drift
from churnlens.operators.features import customer_features, finish_features, single_customer_features
from churnlens.operators.gaps import favourite_product, gap_histogram, gap_percentiles
from churnlens.operators.labels import churn_labels
from churnlens.operators.metrics import confusion_at, pr_curve, pr_summary, recency_baseline_score
from churnlens.operators.model import (
    append_predictions,
    batch_predictions,
    churn_probability,
    evaluate_model,
    load_model,
    save_model,
    train_churn_model,
)
from churnlens.operators.shapley import baseline_point, global_importance, shapley_contributions
from churnlens.operators.split import split_counts, temporal_split

__all__ = [
    "COLUMN_RENAME_MAP", "add_quality_flags", "append_predictions", "baseline_point", "batch_predictions",
    "churn_labels", "churn_probability", "clean_transactions", "confusion_at", "customer_features",
    "drift_report", "drop_exact_duplicates", "evaluate_model", "exclude_without_customer", "favourite_product", "finish_features",
    "gap_histogram", "gap_percentiles", "global_importance", "ks_statistic", "load_model", "pr_curve", "pr_summary", "psi",
    "recency_baseline_score", "rename_to_contract", "save_model", "shapley_contributions", "single_customer_features",
    "split_counts", "summary_drift", "temporal_split", "train_churn_model", "validate_and_clean",
    "validation_report",
]
