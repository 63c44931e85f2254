"""Shapley contributions of a boosted model by its trees' paths.

A leaf is a box: an interval per feature. With the features of a coalition at the row's values and the others at the baseline's, the leaf is
reached exactly if each feature's value lies in its interval. So a feature matters to a leaf only where one of row and baseline fits and the
other doesn't: p features that only the row fits must be in the coalition, q that only the baseline fits must be out, and a leaf
that neither fits in some feature is never reached. Over all coalitions the leaf's value then adds
(p-1)! q! / (p+q)! of itself to each of the p, and takes p! (q-1)! / (p+q)! from each of the q. Summed over all leaves this is the exact
value over all coalitions, without scoring any of them; a row stays one row, and nothing is shuffled. What a leaf adds depends only on which
features are p and which q, so a row's leaves are summed by that pattern before any weight is used.

Contributions are of the margin (the log-odds side of the model), as usual for tree ensembles: they add up to the row's
margin less the baseline's.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from churnlens.operators.leaves import leaf_boxes
from churnlens.operators.model import model_input
from churnlens.schemas import FEATURE_COLUMNS
from churnlens.session import ship_package


def path_contributions(model: PipelineModel, rows: DataFrame, baseline: dict[str, float],
                       key_cols: Sequence[str] = ("customer_id", "snapshot_date")) -> DataFrame:
    """(keys..., base_value, prediction, phi_<feature> x 7): the model's margin at the baseline and at each row, and what each
    feature adds between the two. Rows are worked on where they lie; repeated keys give repeated rows."""
    ship_package(rows.sparkSession)
    boxes = rows.sparkSession.sparkContext.broadcast(leaf_boxes(model, rows.sparkSession))  # bounded by the number of trees and leaves
    point = np.array([baseline[c] for c in FEATURE_COLUMNS], float)
    x = model_input(rows).select(*key_cols, *FEATURE_COLUMNS)
    figures = ["base_value", "prediction", *(f"phi_{c}" for c in FEATURE_COLUMNS)]
    keys = len(key_cols)

    def run(batches):
        for batch in batches:
            values = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[keys:]], axis=1).astype(float)
            base, margins, phi = boxes.value.contributions(values, point)
            columns = [pa.array(np.full(len(values), base)), pa.array(margins), *(pa.array(np.ascontiguousarray(c)) for c in phi.T)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:keys], *columns], names=[*key_cols, *figures])

    return x.mapInArrow(run, T.StructType([*x.schema.fields[:keys], *(T.StructField(c, T.DoubleType()) for c in figures)]))
