"""churnlens: customer transaction analytics and churn prediction on Spark.

Every step is a lazy DataFrame plan: load named source parts, clean them
under fixed counted rules, build point-in-time customer features and
forward churn labels as a monthly snapshot panel, then split, train,
score, explain and measure drift with MLlib and plain aggregates.
"""

from churnlens.params import Params, SYNTHETIC_PARAMS

__all__ = ["Params", "SYNTHETIC_PARAMS"]
